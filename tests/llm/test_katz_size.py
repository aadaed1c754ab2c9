"""What the Katz operator leaves on disk while it works."""

import random
from pathlib import Path

from pyspark.sql import functions as F

from accesslens.llm import katz


def shuffled(spark):
    """Shuffle files and their bytes."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    files = [Path(files.apply(i).getPath()) for i in range(files.size())]
    return {file: file.stat().st_size for file in files if file.name.endswith(".data")}


def test_whole_numbers_are_sent_and_shuffle_files_go(spark, tmp_path, monkeypatch):
    """No probability is sent or kept for an n-gram that training has, and no order's shuffle outlives its tables."""
    rng = random.Random(5)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(120_000)]
    rows = [(i, " ".join(words[i * 300 : i * 300 + 300])) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    monkeypatch.setattr(katz, "scratch_path", lambda spark, label: f"{tmp_path}/{label}")
    before = shuffled(spark)
    scores = katz.katz_scores(docs, F.col("doc_id") % 5 != 1, block_tokens=20_000, bucket_grams=20_000)
    left = sum(size for file, size in shuffled(spark).items() if file not in before)
    folder = tmp_path / "katz"
    size = lambda name: sum(file.stat().st_size for file in (folder / name).rglob("*.parquet"))
    kept = {name: size(name) for name in sorted(path.name for path in folder.iterdir())}
    assert scores.count() == 400
    assert left < 20_000, left
    assert kept["grams-3"] < 0.6 * len(words), kept
