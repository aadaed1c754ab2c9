"""Web-access-log analytics as Spark jobs.

Scan log files, number and batch their lines, parse each line once, aggregate
per batch or over everything, publish to run tables, then report on and compare
runs. Every step is a DataFrame or SQL plan; nothing here works row by row in
Python.
"""

__version__ = "0.1.0"
