"""Count-based batches of valid records by a distributed running count."""

import random

from pyspark.sql import functions as F

from tillflow.operators.batches import number_rows, valid_batches
from tillflow.plans.explain import plan_text
from tillflow.sources.files import read_messages_in_order


def test_positions_are_the_sorted_order(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), i, rng.random()) for i in rng.sample(range(100_000), 3_000)]
    df = spark.createDataFrame(rows, "file string, line long, x double").repartition(13)
    got = {(r["file"], r["line"]): r["position"] for r in number_rows(df, ["file", "line"]).collect()}
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert got == {(r[0], r[1]): i for i, r in enumerate(want)}


def test_ties_are_numbered_once_and_empty_input_gives_none(spark):
    df = spark.createDataFrame([("a", 1)] * 50 + [("a", 0)], "file string, line long")
    got = number_rows(df, ["file", "line"]).collect()
    assert sorted(r["position"] for r in got) == list(range(51))
    assert [r["line"] for r in got if r["position"] == 0] == [0]
    assert number_rows(df.limit(0), ["file", "line"]).count() == 0


def test_only_valid_records_fill_a_batch(spark):
    rows = [(i, "schema" if i % 3 == 0 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "offset long, reason string").repartition(5)
    got = {r["offset"]: (r["position"], r["batch"]) for r in valid_batches(df, ["offset"], 5).collect()}
    valid = [i for i in range(40) if i % 3]
    for i in range(40):
        assert got[i] == ((valid.index(i), valid.index(i) // 5) if i % 3 else (None, None))
    sizes = [sum(1 for p in got.values() if p[1] == b) for b in range(6)]
    assert sizes[:-1] == [5] * 5 and sizes[-1] == len(valid) - 25  # the rest is flushed as a smaller batch


def test_no_window_without_a_key_over_the_rows(spark):
    """The only unpartitioned window sees one row a partition, below a broadcast."""
    df = spark.range(1_000).select(F.col("id").alias("offset"))
    plan = plan_text(number_rows(df, ["offset"]), "simple")
    assert "BroadcastExchange" in plan
    above, below = plan.split("BroadcastExchange", 1)
    assert "Window" not in above and "SinglePartition" not in above and "Window" in below


def test_files_are_read_in_the_order_of_file_and_line(spark, scratch):
    for name in ("b", "a"):
        lines = [(f"{name}{i:04d}",) for i in range(500)]
        spark.createDataFrame(lines, "value string").coalesce(1).write.text(f"{scratch}/in/part={name}")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")  # a file is read in several blocks
    try:
        df = read_messages_in_order(spark, f"{scratch}/in")
        assert df.rdd.getNumPartitions() > 2
        got = number_rows(df, ["source_file", "block_start", "line"]).orderBy("position").select("value").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r[0] for r in got] == [f"{n}{i:04d}" for n in "ab" for i in range(500)]


def test_the_input_is_computed_once_and_valid_records_lose_their_text(spark):
    df = spark.range(30).selectExpr("id AS offset", "IF(id % 3 = 0, 'schema', NULL) AS reason", "concat('m', id) AS raw")
    got = valid_batches(df, ["offset"], 5)
    assert "Range (" not in plan_text(got, "simple")  # valid and invalid records come from what was stored
    assert {r["offset"]: r["raw"] for r in got.collect()} == {i: None if i % 3 else f"m{i}" for i in range(30)}
