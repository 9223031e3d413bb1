"""What jobs leave on the disk: no shuffle files behind a write, no checkpoints of whole rows, compressed messages."""

import datetime as dt
import os
import pathlib
import time
from decimal import Decimal as D

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tillflow import schema as S
from tillflow.operators.batches import valid_batches
from tillflow.operators.clean import first_per_key
from tillflow.operators.store import upsert_latest
from tillflow.operators.validate import validate_events
from tillflow.plans import explain as X
from tillflow.plans import registry as R
from tillflow.plans import table as TBL
from tillflow.plans import write_queries as W
from tillflow.plans.jobs import ingest_job, ingest_micro_batch, upsert_table
from tillflow.session import checkpoint_dir, freed_shuffles, stored, stored_while
from tillflow.sources.tables import RETAIL_ORDER_COLS, count_events, retail_events

COLS = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.STORE_SCHEMA.fields)


def row(key, month, text, *more):
    return (key, "A", text, 1, dt.datetime(2011, month, 1), D("1.00"), "10", "UK", D("1.00"), *more)


def kept(spark, name):
    """Scratch folders of this name."""
    at = pathlib.Path(checkpoint_dir(spark).removeprefix("file:"), "tillflow", name)
    return {p.name for p in at.glob("*")} if at.exists() else set()


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.getName(): f.length() for i in range(files.size()) if (f := files.apply(i)).getName().startswith("shuffle_")}


def left_by(spark, run, but=0):
    """Bytes of shuffle files that ``run`` leaves, once they are no more than ``but``; they are removed in the background."""
    before = shuffle_files(spark)
    run()
    for _ in range(50):
        now = shuffle_files(spark)
        if (left := sum(n for f, n in now.items() if f not in before)) <= but:
            break
        time.sleep(0.1)
    return left


@pytest.fixture()
def no_checkpoint(monkeypatch):
    def fail(*args, **kwargs):
        raise AssertionError("checkpoint")
    monkeypatch.setattr(DataFrame, "checkpoint", fail)


def test_a_freed_write_leaves_no_shuffle_files(spark, scratch):
    rows = spark.range(1_000).repartition(3, "id")
    assert left_by(spark, lambda: rows.write.parquet(f"{scratch}/a"))
    with freed_shuffles(spark):
        assert not left_by(spark, lambda: rows.write.parquet(f"{scratch}/b"))
    assert not left_by(spark, lambda: stored(rows, "test"))
    assert spark.read.parquet(f"{scratch}/b").count() == 1_000
    assert left_by(spark, lambda: rows.write.parquet(f"{scratch}/c"))  # the setting holds inside only


def test_stored_rows_are_the_rows_and_go_with_their_block(spark):
    rows = spark.createDataFrame([row("1", 1, None), row("2", 2, "x")], COLS).select("*", F.struct("Description").alias("_in"))
    with stored_while(rows, "test_while") as got:
        assert got.schema == stored(rows, "test", "orc").schema
        assert sorted(got.collect()) == sorted(rows.collect()) == sorted(stored(rows, "test", "orc").collect())
        assert len(kept(spark, "test_while")) == 1
    with pytest.raises(RuntimeError), stored_while(rows, "test_while"):
        raise RuntimeError
    assert not kept(spark, "test_while")


def test_batches_leave_no_shuffle_files(spark):
    rows = spark.range(200).selectExpr("200 - id AS offset", "IF(id % 3 = 0, 'schema', NULL) AS reason").repartition(5, "offset")
    got = []
    assert not left_by(spark, lambda: got.append(valid_batches(rows, ["offset"], 5)))
    assert got[0].where("position IS NULL").count() == 67 and got[0].where("batch = 26").count() == 3


def test_message_files_are_compressed(spark, monkeypatch):
    path = pathlib.Path(W._written_files(spark, SF_SMALL).removeprefix("file:"))
    parts = list(path.glob("file=*/part-*"))
    assert len(parts) == R.STREAM_LEAST_FILES and all(p.name.endswith(".lz4") for p in parts)
    before = {n: kept(spark, n) for n in ("stream_ingest", "stream_restart", "stream_distinct")}
    assert W.q_stream_distinct(spark, SF_SMALL).count() and W.q_stream_restart_metrics(spark, SF_SMALL).count()
    assert R.q_stream_ingest(spark, SF_SMALL).count()
    root = pathlib.Path(checkpoint_dir(spark).removeprefix("file:"), "tillflow")
    for name, seen in before.items():
        (run,) = kept(spark, name) - seen
        parts = list((root / name / run / "src").glob("*part-*"))
        assert parts and all(p.name.endswith(".lz4") for p in parts if not p.name.startswith("."))


def test_files_of_the_restarted_stream_grow_in_number(spark):
    rows = retail_events(spark, SF_SMALL)
    assert W._ordered_messages(rows, 20).rdd.getNumPartitions() == 20


def test_events_are_counted_without_joining_them(spark, scratch):
    from tillflow.sources import tables as T
    o = ("o_orderkey long, o_custkey long, o_orderdate timestamp_ntz", [(1, 7, dt.datetime(2011, 1, 1)), (2, None, None), (None, 7, None), (None, 7, None)])
    made = {"lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double",
                         [(1, 3, 1, 1, 2.0, 3.0), (1, 4, 1, 2, 2.0, 3.0), (9, 3, 1, 1, 2.0, 3.0), (None, None, 1, 1, 2.0, 3.0)]),
            "orders": o, "customer": ("c_custkey long, c_nationkey long", [(7, 5), (None, None), (None, 1)]),
            "nation": ("n_nationkey long, n_name string", [(5, "UK")]),
            "part": ("p_partkey long, p_name string, p_retailprice double", [(3, "mug", 1.0), (4, None, None)])}
    for name, (schema, rows) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{scratch}/{name}.parquet")
    with pytest.MonkeyPatch.context() as m:
        m.setattr(T, "retail_events", None)  # not asked for
        assert count_events(spark, scratch) == 4
    events = retail_events(spark, scratch)
    assert events.count() == 4
    got = {(r["InvoiceNo"], r["StockCode"]): (r["InvoiceDate"], r["CustomerID"], r["Country"], r["Description"]) for r in events.collect()}
    assert got == {("1", "3"): ("2011-01-01 00:01:00", 7.0, "UK", "mug"), ("1", "4"): ("2011-01-01 00:01:00", 7.0, "UK", None),
                   ("9", "3"): (None, None, None, "mug"), (None, None): (None, None, None, None)}
    spark.createDataFrame([(5, "UK"), (5, "GB")], "n_nationkey long, n_name string").write.mode("overwrite").parquet(f"{scratch}/nation.parquet")
    assert count_events(spark, scratch) == retail_events(spark, scratch).count() == 6


def test_the_first_row_carries_its_place_once(spark):
    rows = spark.createDataFrame([("k", 2, "b", "y"), ("k", 1, "z", "x"), ("k", None, "a", "w"), (None, 5, "c", "v")],
                                 "InvoiceNo string, seq int, file string, text string").withColumn("StockCode", F.lit("A"))
    got = first_per_key(rows, ["seq", "file"])
    assert got.columns == ["InvoiceNo", "StockCode", "seq", "file", "text", "group_rows"]
    assert {tuple(r) for r in got.collect()} == {("k", "A", None, "a", "w", 3), (None, "A", 5, "c", "v", 1)}
    assert "min_by" not in got._jdf.queryExecution().analyzed().toString()


def test_upserts_make_no_checkpoint(spark, scratch, no_checkpoint):
    inc = spark.createDataFrame([row("1", 9, "first", 1), row("1", 8, "last", 2), row("2", 5, "n", 1)], COLS + ", seq int")
    table = spark.createDataFrame([(*row("1", 1, "old"), "q", 0, "2011_01")], COLS + ", query_id string, batch_id long, invoice_month string")
    TBL.write_partitioned(table, scratch)
    before, target = kept(spark, "changes"), spark.read.parquet(scratch)
    rows = []
    assert not left_by(spark, lambda: rows.append(upsert_latest(target, inc, ["seq"])))
    assert len(kept(spark, "changes") - before) == 1  # the plan that the rows are read from
    assert sorted((r["InvoiceNo"], r["Description"]) for r in rows[0].collect()) == [("1", "last"), ("2", "n")]
    before = kept(spark, "changes")
    assert upsert_table(spark, scratch, inc, ["seq"]) == {"updated": 1, "inserted": 1, "months": 2}
    assert kept(spark, "changes") == before and not kept(spark, "changed")


def test_jobs_and_micro_batches_keep_nothing_but_their_output(spark, scratch, no_checkpoint):
    v = validate_events(retail_events(spark, SF_SMALL))
    said = ingest_job(spark, v, RETAIL_ORDER_COLS, f"{scratch}/t", f"{scratch}/d", f"{scratch}/m")
    assert said["success"] == spark.read.parquet(f"{scratch}/t").count() > 0 and not kept(spark, "resolved")
    cached = spark.sparkContext._jsc.getPersistentRDDs().size()
    for batch, name in ((0, "success"), (0, "already_written"), (1, "failed")):
        got = []
        # counts and counters leave a few numbers, the batch's rows are gone
        assert left_by(spark, lambda: got.append(ingest_micro_batch(
            spark, v, RETAIL_ORDER_COLS, f"{scratch}/t2", f"{scratch}/d2", None, "q", batch)), 20_000) <= 20_000
        assert got[0][name] == said["success"] and not kept(spark, "micro_batch")
    assert spark.read.parquet(f"{scratch}/t2").count() == said["success"]
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == cached


def test_the_table_is_laid_out_from_stored_rows(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(R, "_PLANS", {})
    monkeypatch.setattr(R, "write_partitioned", lambda rows, path, **kw: plans.append(X.plan_text(rows, "simple")) or TBL.write_partitioned(rows, path, **kw))
    assert R.stored_table(spark, SF_SMALL).count() == R.stored_rows(spark, SF_SMALL).count()
    assert "Exchange" not in plans[0] and "Aggregate" not in plans[0] and not kept(spark, "ingested")


def test_keyed_and_sink_queries_make_no_checkpoint(spark, no_checkpoint):
    assert W.q_insert_if_absent_bucketed(spark, SF_SMALL).where("then = 'Duplicate'").count() == R.stored_rows(spark, SF_SMALL).count()


def test_the_sink_query_makes_the_table_first(spark, scratch, monkeypatch):
    class Asked(Exception):
        pass

    def ask(*args):
        raise Asked
    monkeypatch.setattr(W, "shared_path", lambda *_: scratch)
    monkeypatch.setattr(R, "stored_table", ask)
    with pytest.raises(Asked):
        W.q_csv_sink_roundtrip(spark, SF_SMALL)
    assert not os.path.exists(scratch.removeprefix("file:"))
