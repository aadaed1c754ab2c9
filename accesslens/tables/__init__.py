from accesslens.tables.export import export_run, export_tsv, jdbc_options, write_jdbc
from accesslens.tables.run_tables import RunTables

__all__ = ["RunTables", "export_run", "export_tsv", "jdbc_options", "write_jdbc"]
