"""Insert-if-absent and upsert plans: the incoming keys are broadcast only
under a proven row bound, and the big target is then only scanned."""

import datetime as dt
from decimal import Decimal as D

import pytest

from tillflow import schema as S
from tillflow.operators.store import BROADCAST_MAX_ROWS, mark_present, upsert_latest
from tillflow.plans import explain as X

KEYS = "InvoiceNo string, StockCode string, InvoiceDate timestamp_ntz, invoice_month string"


@pytest.fixture()
def target(spark, scratch):
    rows = [(str(i), "A", dt.datetime(2011, 1 + i % 3, 1, 8, 0), f"2011_0{1 + i % 3}")
            for i in range(30)]
    spark.createDataFrame(rows, KEYS).write.partitionBy(S.PARTITION_COLUMN).parquet(
        f"{scratch}/t")
    return spark.read.parquet(f"{scratch}/t")


@pytest.fixture()
def batch(spark):
    rows = [("1", "A", dt.datetime(2011, 2, 1, 8, 0), "2011_02"),
            ("99", "B", dt.datetime(2011, 2, 1, 9, 0), "2011_02")]
    return spark.createDataFrame(rows, KEYS)


@pytest.fixture()
def no_auto_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_bounded_batch_broadcasts_keys(target, batch, no_auto_broadcast):
    marked = mark_present(batch, target, incoming_rows_bound=2)
    text = X.plan_text(marked, "simple")
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    got = {r["InvoiceNo"]: r["outcome"] for r in marked.collect()}
    assert got == {"1": S.REASON_DUPLICATE, "99": "inserted"}


def test_unbounded_batch_is_not_hinted(target, batch, no_auto_broadcast):
    for bound in (None, BROADCAST_MAX_ROWS + 1):
        text = X.plan_text(mark_present(batch, target, incoming_rows_bound=bound), "simple")
        assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text


def test_bounded_upsert_leaves_target_unshuffled(spark, no_auto_broadcast):
    cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.STORE_SCHEMA.fields)
    tgt = spark.createDataFrame(
        [("1", "A", "old", 1, dt.datetime(2011, 1, 1), D("1.00"), "10", "UK", D("1.00"))], cols)
    inc = spark.createDataFrame(
        [("1", "A", "new", 2, dt.datetime(2011, 1, 2), D("1.00"), "10", "UK", D("2.00"), 1)],
        cols + ", seq int")
    out = upsert_latest(tgt, inc, ["seq"], incoming_rows_bound=1)
    assert "BroadcastHashJoin" in X.plan_text(out, "simple")
    row = out.collect()[0]
    assert row["Description"] == "new" and row["InvoiceDate"] == dt.datetime(2011, 1, 1)


def test_upsert_is_the_same_with_and_without_a_bound(spark):
    """A key at two times, an untouched key, a new key: one meaning in both branches."""
    cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.STORE_SCHEMA.fields)
    def row(key, day, desc, *more):
        return (key, "A", desc, 1, dt.datetime(2011, 1, day), D("1.00"), "10", "UK", D("1.00"), *more)
    tgt = spark.createDataFrame([row("1", 3, "late"), row("1", 1, "early"), row("2", 1, "other"), row("2", 2, "other")], cols)
    inc = spark.createDataFrame([row("1", 9, "first", 1), row("1", 8, "last", 2), row("3", 5, "n1", 1), row("3", 6, "n2", 1)],
                                cols + ", seq int")
    got = [sorted((r["InvoiceNo"], r["InvoiceDate"].day, r["Description"]) for r in
                  upsert_latest(tgt, inc, ["seq"], incoming_rows_bound=b).collect()) for b in (4, None)]
    assert got[0] == got[1] == [("1", 1, "last"), ("1", 3, "late"), ("2", 1, "other"), ("2", 2, "other"), ("3", 5, "n2")]


def test_unbounded_insert_if_absent_reads_the_target_once(spark, target, batch, no_auto_broadcast):
    plan = X.plan_text(mark_present(batch, target), "simple")
    assert plan.count("FileScan parquet") == 1 and "BroadcastHashJoin" not in plan


def test_rejects_stay_out_of_the_key_join(spark, target):
    rows = [(None, None, None, None, "schema")] * 5 + [("1", "A", dt.datetime(2011, 2, 1, 8, 0), "2011_02", "clean")]
    marked = mark_present(spark.createDataFrame(rows, KEYS + ", outcome string"), target)
    assert "Union" in X.plan_text(marked, "simple")
    assert sorted(r["outcome"] for r in marked.collect()) == ["Duplicate"] + ["schema"] * 5
