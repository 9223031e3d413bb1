"""Dashboard as a stream (T7), stream distinct (T4/A9), CSV stream sink."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tillflow import schema as S
from tillflow.operators import aggregates as A
from tillflow.plans.jobs import ingest_job
from tillflow.operators.validate import validate_events
from tillflow.sources.files import csv_stream_sink, read_messages_stream, to_messages
from tillflow.sources.tables import RETAIL_ORDER_COLS, retail_events
from tillflow.streaming.dashboard import country_share_from, start_dashboard, start_windowed_dashboard
from tillflow.streaming.dedupe import distinct_unbounded, distinct_within_watermark


def test_dashboard_stream_matches_batch(spark, scratch):
    table = f"{scratch}/table"
    ingest_job(spark, validate_events(retail_events(spark, SF_SMALL)), RETAIL_ORDER_COLS, table)
    queries = start_dashboard(spark, table, f"{scratch}/ckpt", sink="memory", available_now=True)
    for q in queries.values():
        q.awaitTermination(300)
        assert q.exception() is None
    batch = A.dashboard_frame(spark.read.parquet(table))
    assert spark.table("dash_kpi").collect() == A.kpi(batch).collect()
    assert spark.table("dash_top_products").collect() == A.top_products(batch).collect()
    assert spark.table("dash_hourly_revenue").collect() == A.hourly_revenue(batch).collect()
    assert spark.table("dash_category_sales").collect() == A.category_sales(batch).collect()
    streamed = country_share_from(spark.table("dash_country_sales"))
    expected = {r["country"]: r["share_pct"] for r in A.country_share(batch).collect()}
    got = {r["country"]: r["share_pct"] for r in streamed.collect()}
    assert got.keys() == expected.keys()
    assert all(abs(got[k] - expected[k]) < 1e-9 for k in got)


def test_windowed_dashboard_refreshes_over_the_chosen_duration(spark, scratch):
    table = f"{scratch}/table"
    ingest_job(spark, validate_events(retail_events(spark, SF_SMALL)), RETAIL_ORDER_COLS, table)
    rows = spark.read.parquet(table)
    now = rows.agg(F.max("InvoiceDate")).first()[0]
    seen = {}

    def on_refresh(frames, batch_id):
        seen[batch_id] = {k: v.collect() for k, v in frames.items()}
    q = start_windowed_dashboard(spark, table, f"{scratch}/ckpt", "24 hours", on_refresh, now=lambda: now, available_now=True)
    q.awaitTermination(300)
    assert q.exception() is None and seen
    frame = A.dashboard_frame(rows.where(F.col("InvoiceDate") >= F.lit(now) - F.expr("INTERVAL 24 HOURS")))
    last = seen[max(seen)]
    assert last["kpi"] == A.kpi(frame).collect() and last["kpi"][0]["total_transactions"] > 0
    assert last["category_sales"] == A.category_sales(frame).collect()


def _events_stream(spark, scratch):
    src = f"{scratch}/src"
    ev = retail_events(spark, SF_SMALL)
    to_messages(ev).coalesce(1).write.text(src)
    to_messages(ev).coalesce(1).write.mode("append").text(src)   # every event twice
    typed = F.from_json("value", S.EVENT_SCHEMA.simpleString())
    return (read_messages_stream(spark, src).select(typed.alias("e")).select("e.*")
            .withColumn("InvoiceDate", F.try_to_timestamp("InvoiceDate").cast("timestamp")))


def test_stream_distinct_bounded_and_unbounded(spark, scratch):
    pairs = retail_events(spark, SF_SMALL).select(*S.PAIR_KEY).distinct().count()
    for name, fn in [("unbounded", distinct_unbounded),
                     ("bounded", lambda s: distinct_within_watermark(s.where("InvoiceDate IS NOT NULL"),
                                                                     "InvoiceDate", "1 hour"))]:
        out = f"{scratch}/{name}"
        q = (fn(_events_stream(spark, f"{scratch}/{name}_in")).writeStream.format("parquet")
             .option("path", out).option("checkpointLocation", f"{scratch}/{name}_ckpt")
             .trigger(availableNow=True).start())
        q.awaitTermination(300)
        assert q.exception() is None
        got = spark.read.parquet(out)
        assert got.count() == got.select(*S.PAIR_KEY).distinct().count()
        if name == "unbounded":
            assert got.count() == pairs


def test_csv_stream_sink_with_header(spark, scratch):
    src = f"{scratch}/src"
    to_messages(retail_events(spark, SF_SMALL)).limit(50).coalesce(1).write.text(src)
    q = (csv_stream_sink(read_messages_stream(spark, src).select("value"), f"{scratch}/csv",
                         f"{scratch}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination(300)
    back = spark.read.option("header", True).csv(f"{scratch}/csv")
    assert back.columns == ["value"] and back.count() == 50
