import pytest

from __spark_entry__ import SMOKE_DATA
from hard_rows import CLASHING, COLUMNS, HARD


@pytest.fixture(scope="session")
def hard(spark):
    """The hard rows with an extra column under every name that an operator uses itself."""
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(HARD, COLUMNS).repartition(3)
    for name in CLASHING:
        frame = frame.withColumn(name, F.lit("extra"))
    return frame


@pytest.fixture(scope="session")
def none(hard):
    return hard.where("false")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMOKE_DATA}/documents.parquet").cache()


@pytest.fixture(scope="session")
def texts(documents):
    return [(row.doc_id, row.text) for row in documents.collect()]
