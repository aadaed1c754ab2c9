"""Operators over frames of lines, parsed lines, batches and runs.

Import them from their modules: `parsing`, `batching`, `aggregates`,
`batch_totals` and `run_history`.
"""
