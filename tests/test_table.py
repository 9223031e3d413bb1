"""Partitioned table, pruned reads, plan checks, batch job, connectors."""

import datetime as dt
import json

import pytest

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tillflow import schema as S
from tillflow.operators.validate import validate_events
from tillflow.plans import explain as X
from tillflow.plans import jobs
from tillflow.plans import table as TBL
from tillflow.plans.dashboard import dashboard, read_sales, release
from tillflow.plans.jobs import ingest_job
from tillflow.sources.files import read_event_csv
from tillflow.sources.tables import RETAIL_ORDER_COLS, retail_events


def test_month_range_19_partitions(spark):
    b = spark.createDataFrame([(dt.date(2010, 12, 1), dt.date(2012, 7, 1))], "start date, end date")
    rows = TBL.month_range(b).collect()
    assert len(rows) == 19
    assert rows[0]["partition_name"] == "online_retail_2010_12"
    assert rows[-1]["range_to"] == dt.date(2012, 7, 1)


def _job(spark, scratch, batch_id=0, query_id="batch"):
    v = validate_events(retail_events(spark, SF_SMALL))
    return ingest_job(spark, v, RETAIL_ORDER_COLS, f"{scratch}/table", f"{scratch}/dlq",
                      f"{scratch}/metrics", query_id=query_id, batch_id=batch_id,
                      backup_csv=f"{scratch}/backup")


def test_batch_job_write_replay_and_redelivery(spark, scratch):
    m0 = _job(spark, scratch)
    table = spark.read.parquet(f"{scratch}/table")
    assert table.count() == m0["success"] > 0
    assert TBL.unique_violations(table).count() == 0
    # the same batch again (a retry after the append): nothing new, no duplicates
    m1 = _job(spark, scratch)
    assert m1["already_written"] == m0["success"] and m1["failed"] == 0
    assert spark.read.parquet(f"{scratch}/table").count() == m0["success"]
    assert spark.read.parquet(f"{scratch}/metrics").count() == 1
    # a later batch delivering the same events: all duplicates
    m2 = _job(spark, scratch, batch_id=1)
    assert m2["failed"] == m0["success"] and m2["success"] == 0
    dlq = spark.read.json(f"{scratch}/dlq")
    assert dlq.where("reason = 'Duplicate'").count() == m0["success"]
    assert dlq.where("reason = 'schema' AND batch_id = 0").count() == m0["invalid"]
    backup = spark.read.csv(f"{scratch}/backup")
    # one folder a batch, replaced by its replay
    assert backup.count() == 2 * m0["success"] and len(backup.columns) == 9 + 2


def test_pruned_read_plan(spark, scratch):
    _job(spark, scratch)
    table = spark.read.parquet(f"{scratch}/table")
    now = dt.datetime(1998, 8, 2, 12, 0)
    framed = read_sales(table, "24 hours", now)
    assert X.partition_filters(framed) and "invoice_month" in X.partition_filters(framed)[0]
    assert any("InvoiceDate" in p for p in X.pushed_filters(framed))
    schema = X.read_schemas(framed)[0]
    assert schema.count(":") == 5 and "query_id" not in schema
    assert not X.has_python_udf(framed)
    res = dashboard(table, "All time", now, cache=True)
    assert res["kpi"].first()["total_transactions"] == table.count()
    assert "TakeOrderedAndProject" in X.plan_text(res["top_products"])
    release(res)


def test_csv_source_drops_index(spark, scratch):
    path = f"{scratch}/csv"
    header = ",InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country"
    lines = [header, "0,536365,85123A,WHITE HEART,6,2010-12-01 08:26:00,2.55,17850.0,United Kingdom",
             "1,536366,22633,,6,2010-12-01 08:28:00,1.85,,United Kingdom"]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    df = read_event_csv(spark, path)
    assert df.columns == S.WIRE_NAMES
    got = validate_events(df).collect()
    assert got[0]["reason"] is None and got[0]["Quantity"] == 6
    assert got[1]["error"] == "Description:null;CustomerID:null"


def test_create_and_swap_tables(spark, scratch):
    TBL.create_table(spark, "retail_new", f"{scratch}/t_new")
    TBL.create_table(spark, "retail_cur", f"{scratch}/t_cur")
    TBL.swap_tables(spark, "retail_cur", "retail_new", "retail_old")
    names = {t.name for t in spark.catalog.listTables()}
    assert {"retail_cur", "retail_old"} <= names and "retail_new" not in names
    cols = [c.name for c in spark.catalog.listColumns("retail_cur")]
    assert cols[:9] == S.STORE_COLUMNS and S.PARTITION_COLUMN in cols
    for t in ("retail_cur", "retail_old"):
        spark.sql(f"DROP TABLE {t}")


def test_month_rows_and_unique_rule(spark):
    from tillflow.plans.registry import stored_rows
    stored = stored_rows(spark, SF_SMALL)
    per_month = TBL.month_rows(stored)
    assert per_month.agg(F.sum("n_rows")).first()[0] == stored.count()
    assert TBL.unique_violations(stored).count() == 0


def test_batch_job_prunes_target_to_input_months(spark, scratch):
    from tillflow.plans.jobs import prune_to_batch, read_target
    m0 = _job(spark, scratch)
    # re-deliver one month of the feed: every clean row is a duplicate, and
    # the table scan is limited to the input's months
    feed = retail_events(spark, SF_SMALL)
    month = feed.where("InvoiceDate LIKE '1995-03-%'")
    v = validate_events(month)
    pruned = prune_to_batch(read_target(spark, f"{scratch}/table"), v)
    assert X.partition_filters(pruned) and "invoice_month" in X.partition_filters(pruned)[0]
    assert pruned.select("invoice_month").distinct().collect() == [("1995_03",)]
    m1 = ingest_job(spark, v, RETAIL_ORDER_COLS, f"{scratch}/table", query_id="later",
                    batch_id=0, prune_target=True)
    assert m1["success"] == 0 and m1["failed"] == m1["processed"] > 0
    assert spark.read.parquet(f"{scratch}/table").count() == m0["success"]


def _rows(spark, *dates):
    cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.EVENT_SCHEMA.fields)
    return validate_events(spark.createDataFrame(
        [(i, str(i), "A", "d", 1, d, 1.0, 1.0, "UK") for i, d in enumerate(dates)], "seq long, " + cols))


def test_redelivery_is_found_in_pruned_months(spark, scratch):
    """Months far apart: the pruned target holds each of them, and only them."""
    dates = ("1700-01-05 00:00:00", "2010-12-01 08:26:00", "2261-12-31 00:00:00")
    first = ingest_job(spark, _rows(spark, *dates), ["seq"], f"{scratch}/t", batch_id=0)
    again = ingest_job(spark, _rows(spark, *dates), ["seq"], f"{scratch}/t", batch_id=1, prune_target=True)
    assert (first["success"], again["success"], again["failed"]) == (3, 0, 3)
    target = jobs.prune_to_batch(spark.read.parquet(f"{scratch}/t"), _rows(spark, dates[0], dates[2]))
    assert target.count() == 2


def test_only_a_missing_table_reads_as_none(spark, scratch):
    assert jobs.read_target(spark, f"{scratch}/none") is None
    with pytest.raises(Exception):
        jobs.read_target(spark, "nosuchscheme://x/y")


def test_rows_are_visible_through_the_table_name(spark, scratch):
    TBL.create_table(spark, "retail_new", f"{scratch}/new")
    TBL.create_table(spark, "retail_old", f"{scratch}/old")
    try:
        got = ingest_job(spark, _rows(spark, "2010-12-01 08:26:00", "2011-01-01 08:26:00"), ["seq"],
                         f"{scratch}/new", table_name="retail_new", dlq_messages=f"{scratch}/letters")
        assert spark.table("retail_new").count() == got["success"] == 2
        TBL.swap_tables(spark, "retail_old", "retail_new", "retail_archive")
        assert spark.table("retail_old").count() == 2 and spark.table("retail_archive").count() == 0
    finally:
        for t in ("retail_new", "retail_old", "retail_archive"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_csv_quotes_line_breaks_and_null_cells(spark, tmp_path):
    head = ",InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
    text = head + ('0,1,A,"WHITE ""HEART"", BIG",6,2010-12-01 08:26:00,2.55,17850.0,UK\n'
                   '1,2,B,"two\nlines",6,2010-12-01 08:26:00,2.55,,NA\n2,3,C, x ,1,2010-12-01 08:26:00,1,1.0,null\n')
    path = tmp_path / "x.csv"
    path.write_text(text)
    rows = read_event_csv(spark, str(path), multi_line=True).orderBy("InvoiceNo").collect()
    assert [r["Description"] for r in rows] == ['WHITE "HEART", BIG', "two\nlines", " x "]
    assert [r["Country"] for r in rows] == ["UK", None, None] and rows[1]["CustomerID"] is None


def test_envelope_takes_any_text(spark):
    from tillflow.operators.dlq import envelope_json
    rows = [("e", '{"a": 1}'), ("e", '{bad "x"'), ("e", None)]
    got = [json.loads(r[0]) for r in spark.createDataFrame(rows, "error string, data string").select(envelope_json()).collect()]
    assert [g.get("data") for g in got] == [{"a": 1}, '{bad "x"', None]
