"""The six run tables: parquet, partitioned by run_id and load_id.

A load is one publishing step: the whole of a batch run (load 0), or one
micro-batch of a streaming run. Each load overwrites exactly its own partition,
so doing it again changes nothing. Batches are not partitions: a run over 100 TB
in batches of 500,000 lines has over a million of them. Rows lie sorted by
batch_id instead, and parquet statistics skip to a batch.

Running an id again loads a new generation of the run beside the old one: its load ids
begin at a multiple of `GENERATION`. Readers see the generation that the run's row is
of, so writing that row switches a run over, and only then does the old one go.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from accesslens.operators.aggregates import ordered_by
from accesslens.schema import (
    BATCH_METADATA,
    MALFORMED_SUMMARY,
    QUERY_TABLES,
    RUN_METADATA,
    TABLE_COLUMNS,
)
from accesslens.session import create_file, delete_path, file_names, make_folder

PARTITIONS = "run_id INT, load_id INT"
# Load ids of a generation, and so the most micro-batches of a run.
GENERATION = 1 << 20
_STATUS = "table_name string, status string"


def _quoted(text: str) -> str:
    """Text for use between single quotes in SQL."""
    return text.replace("\\", "\\\\").replace("'", "\\'")


class RunTables:
    """Result and metadata tables of all runs below one folder."""

    def __init__(self, spark: SparkSession, root: str, database: str = "access_logs"):
        if not re.fullmatch(r"\w+", database):
            raise ValueError(f"not a plain database name: {database!r}")
        self.spark = spark
        self.root = root.rstrip("/")
        self.database = database
        self._reserved = f"{self.root}/_reserved_run_ids"

    def name(self, table: str) -> str:
        if table not in TABLE_COLUMNS:
            raise ValueError(f"unknown table: {table!r}")
        return f"{self.database}.{table}"

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    # -- maintenance -------------------------------------------------------

    def init_tables(self) -> DataFrame:
        """Create what is missing and keep what is there; says which was which.

        Data that another session left below the root is taken over.
        """
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{_quoted(self.root)}'")
        return self._status([(table, self._create(table)) for table in TABLE_COLUMNS])

    def _create(self, table: str) -> str:
        name, known = self.name(table), self.spark.catalog.tableExists(self.name(table))
        held = not make_folder(self.spark, self.path(table))
        if not known:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in TABLE_COLUMNS[table])
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {PARTITIONS}) "
                f"USING parquet PARTITIONED BY (run_id, load_id) LOCATION '{_quoted(self.path(table))}'"
            )
            if held:
                self.spark.sql(f"MSCK REPAIR TABLE {name}")
        return "already exists" if known or held else "created"

    def reset_tables(self, confirm: bool = False) -> DataFrame:
        """Drop all six tables with their data and create them empty."""
        if not confirm:
            raise PermissionError("reset_tables deletes all run data; call it with confirm=True")
        for table in reversed(TABLE_COLUMNS):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")
            delete_path(self.spark, self.path(table))
        delete_path(self.spark, self._reserved)
        return self.init_tables()

    def delete_run(self, run_id: int) -> None:
        """Remove a run from every table; its own row goes first, so nobody takes the rest for complete."""
        for table in TABLE_COLUMNS:
            self._delete_partition(table, run_id)

    def _delete_partition(self, table: str, run_id: int, load_id: int | None = None) -> None:
        spec, folder = f"run_id={int(run_id)}", f"{self.path(table)}/run_id={int(run_id)}"
        if load_id is not None:
            spec, folder = f"{spec}, load_id={int(load_id)}", f"{folder}/load_id={int(load_id)}"
        if delete_path(self.spark, folder):
            self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS PARTITION ({spec})")
            self.spark.catalog.refreshTable(self.name(table))

    # -- generations -------------------------------------------------------

    def _generations(self, table: str) -> set[tuple[int, int]]:
        """(run_id, generation) of all that a table holds; a pair per run, seldom two."""
        parts = [F.regexp_extract("partition", rf"{name}=(\d+)", 1).cast("int") for name in ("run_id", "load_id")]
        held = self._partitions(table).select(parts[0], F.floor(parts[1] / GENERATION).cast("int")).distinct()
        return {(row[0], row[1]) for row in held.collect()}

    def _current(self) -> dict[int, int]:
        """The generation of each run that is complete."""
        current: dict[int, int] = {}
        for run_id, generation in self._generations(RUN_METADATA):
            current[run_id] = max(generation, current.get(run_id, 0))
        return current

    def begin_generation(self, run_id: int) -> int:
        """The number of a new generation of a run; what an earlier try of one left is removed.

        The generation that readers see stays as it is until `end_generation`.
        """
        current = self._current().get(run_id)
        self._drop_generations(run_id, current)
        return 0 if current is None else current + 1

    def end_generation(self, run_id: int, generation: int) -> None:
        """Remove all other generations of a run, whose row is of this one now."""
        self._drop_generations(run_id, generation)

    def _drop_generations(self, run_id: int, kept: int | None) -> None:
        # The run's row goes last: until then its results are hidden, not mixed with others.
        for table in reversed(TABLE_COLUMNS):
            if not any(held == run_id and generation != kept for held, generation in self._generations(table)):
                continue
            loads = self._partitions(table).where(F.col("partition").startswith(f"run_id={run_id}/"))
            for row in loads.select(F.regexp_extract("partition", r"load_id=(\d+)", 1).cast("int")).collect():
                if row[0] // GENERATION != kept:
                    self._delete_partition(table, run_id, row[0])

    def read_generation(self, table: str, run_id: int, generation: int) -> DataFrame:
        """What one generation of a run stored, whether readers see it yet or not."""
        first = generation * GENERATION
        mine = (F.col("run_id") == int(run_id)) & F.col("load_id").between(first, first + GENERATION - 1)
        return self.stored(table).where(mine).select("run_id", "load_id", *TABLE_COLUMNS[table].names)

    def _status(self, rows: Iterable[tuple[str, str]]) -> DataFrame:
        return self.spark.createDataFrame(list(rows), _STATUS)

    # -- writing -----------------------------------------------------------

    def load(self, table: str, rows: DataFrame, run_id: int, load_id: int = 0) -> None:
        """Publish the rows of one load, typed as declared, over any earlier try.

        They are written to the load's own folder: jobs that insert into one table share its
        folder for unfinished files, and the first that ends would take the others' away.
        """
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLE_COLUMNS[table]]
        folder = f"{self.path(table)}/run_id={int(run_id)}/load_id={int(load_id)}"
        rows.select(*columns).write.mode("overwrite").parquet(folder)
        spec = f"run_id={int(run_id)}, load_id={int(load_id)}"
        self.spark.sql(f"ALTER TABLE {self.name(table)} ADD IF NOT EXISTS PARTITION ({spec})")
        self.spark.catalog.refreshTable(self.name(table))

    def load_query_results(self, query: str, rows: DataFrame, run_id: int, load_id: int = 0) -> None:
        """Publish a query's rows, sorted by batch and then in the query's own order."""
        ordered = rows.orderBy("batch_id", *ordered_by(query))
        self.load(QUERY_TABLES[query], ordered, run_id, load_id)

    def load_batches(self, metadata: DataFrame, run_id: int, load_id: int = 0) -> None:
        if "batch_runtime_seconds" not in metadata.columns:
            metadata = metadata.withColumn("batch_runtime_seconds", F.lit(None))
        self.load(BATCH_METADATA, metadata.orderBy("batch_id"), run_id, load_id)

    def load_malformed(self, summary: DataFrame, run_id: int, load_id: int = 0) -> None:
        self.load(MALFORMED_SUMMARY, summary.orderBy("batch_id"), run_id, load_id)

    def write_run_record(self, record: DataFrame, run_id: int, load_id: int = 0) -> None:
        """The one row of a run, written when its results are complete; from then on readers see them."""
        self.load(RUN_METADATA, record, run_id, load_id)

    def next_run_id(self) -> int:
        """One past the highest id that was ever reserved or is in use."""
        used = self._partitions(RUN_METADATA).unionByName(self._partitions(BATCH_METADATA))
        run_id = F.regexp_extract("partition", r"run_id=(\d+)", 1).cast("int")
        highest = used.agg(F.coalesce(F.max(run_id), F.lit(0)).alias("highest")).first()["highest"]
        reserved = [int(name) for name in file_names(self.spark, self._reserved) if name.isdigit()]
        return max(highest, *reserved, 0) + 1

    def reserve_run_id(self, run_id: int | None = None) -> int:
        """An id that no other writer gets, or the given one, marked as used.

        The mark is a file below the root that is created without overwriting, which only
        one writer can do; the others try the next id. (The file system of a single machine
        decides that within one process only.) Marks stay when a run is deleted, so that
        its id is not handed out again; resetting the tables removes them.
        """
        if run_id is not None:
            create_file(self.spark, f"{self._reserved}/{int(run_id)}")
            return int(run_id)
        free = self.next_run_id()
        while not create_file(self.spark, f"{self._reserved}/{free}"):
            free += 1
        return free

    def _partitions(self, table: str) -> DataFrame:
        return self.spark.sql(f"SHOW PARTITIONS {self.name(table)}")

    # -- reading -----------------------------------------------------------

    def stored(self, table: str) -> DataFrame:
        """A table as it lies, with both partition columns."""
        return self.spark.table(self.name(table))

    def read(self, table: str, run_id: int | None = None) -> DataFrame:
        """Stored rows with their run_id first; a run_id prunes to its partitions.

        Of a complete run only the generation that its row is of, also while it is run again.
        """
        rows, current = self.stored(table), self._current()
        if run_id is not None:
            rows = rows.where(F.col("run_id") == int(run_id))
        for held, generation in self._generations(table):
            if current.get(held, generation) != generation and run_id in (None, held):
                loads = F.col("load_id").between(generation * GENERATION, (generation + 1) * GENERATION - 1)
                rows = rows.where((F.col("run_id") != held) | ~loads)
        return rows.select("run_id", *TABLE_COLUMNS[table].names)

    def read_load(self, table: str, run_id: int, load_id: int) -> DataFrame:
        """What one load stored."""
        mine = (F.col("run_id") == int(run_id)) & (F.col("load_id") == int(load_id))
        return self.stored(table).where(mine).select(*TABLE_COLUMNS[table].names)

    def read_ordered(self, table: str, run_id: int) -> DataFrame:
        """A run's rows by batch_id, and within a batch in the query's own order."""
        query = {name: key for key, name in QUERY_TABLES.items()}.get(table)
        rows = self.read(table, run_id)
        if table == RUN_METADATA:
            return rows
        return rows.orderBy("batch_id", *(ordered_by(query) if query else ()))

    def runs(self) -> DataFrame:
        return self.read(RUN_METADATA)

    def results(self, run_ids: Iterable[int] | None = None) -> dict[str, DataFrame]:
        """Query name to the stored rows, of all runs or those listed."""
        stored = {query: self.read(table) for query, table in QUERY_TABLES.items()}
        if run_ids is None:
            return stored
        ids = [int(i) for i in run_ids]
        return {query: rows.where(F.col("run_id").isin(ids)) for query, rows in stored.items()}

    def run(self, run_id: int) -> Row | None:
        return self.read(RUN_METADATA, run_id).first()
