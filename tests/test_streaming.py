"""Streaming ingest: stream = batch, restart, re-delivery, replay safety."""

import os

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tillflow import schema as S
from tillflow.operators.validate import validate_messages
from tillflow.plans.ingest import ingest
from tillflow.sources.files import read_messages_stream, to_messages
from tillflow.sources.tables import RETAIL_ORDER_COLS, retail_events
from tillflow.streaming.ingest import batch_writer, start_ingest

KEY_COLS = S.STORE_COLUMNS


def _batch_expected(spark):
    msgs = to_messages(retail_events(spark, SF_SMALL), RETAIL_ORDER_COLS)
    res = ingest(validate_messages(msgs), RETAIL_ORDER_COLS)
    return res, sorted(tuple(r) for r in res.stored().select(*KEY_COLS).collect())


def _write_feed(spark, path, parts=1):
    # Lines are written in arrival order, so "first line in the file" is the
    # same row as "first by arrival columns" in the batch form.
    ev = retail_events(spark, SF_SMALL).orderBy("InvoiceNo", "StockCode", *RETAIL_ORDER_COLS)
    if parts == 1:
        to_messages(ev).coalesce(1).write.mode("append").text(path)
        return
    hi = ev.agg(F.max(F.col("InvoiceNo").cast("long"))).first()[0] + 1
    step = hi // parts + 1
    for i in range(parts):
        lo_k, hi_k = i * step, (i + 1) * step
        part = ev.where(F.col("InvoiceNo").cast("long").between(lo_k, hi_k - 1))
        to_messages(part).coalesce(1).write.mode("append").text(path)


def _run(spark, src, table, ckpt, dlq=None, metrics=None, max_files=None):
    q = start_ingest(read_messages_stream(spark, src, max_files), table, ckpt,
                     dlq_path=dlq, metrics_path=metrics, available_now=True)
    q.awaitTermination(300)
    assert q.exception() is None
    return q


def test_stream_single_file_equals_batch(spark, scratch):
    src, table, ckpt = f"{scratch}/src", f"{scratch}/table", f"{scratch}/ckpt"
    dlq, metrics = f"{scratch}/dlq", f"{scratch}/metrics"
    _write_feed(spark, src)
    _run(spark, src, table, ckpt, dlq, metrics)
    res, expected = _batch_expected(spark)
    got = sorted(tuple(r) for r in spark.read.parquet(table).select(*KEY_COLS).collect())
    assert got == expected
    m = spark.read.parquet(metrics).first().asDict()
    bm = res.metrics().first().asDict()
    for k in ("received", "invalid", "in_batch_duplicates", "sign_dropped", "bad_date", "success"):
        assert m[k] == bm[k], k
    dlq_rows = spark.read.json(dlq)
    assert dlq_rows.where("reason = 'schema'").count() == bm["invalid"]
    # restart from the checkpoint with nothing new: no new batch, no new rows
    _run(spark, src, table, ckpt, dlq, metrics)
    assert spark.read.parquet(table).count() == len(expected)


def test_stream_per_file_batches_equal_batch_when_keys_do_not_cross_files(spark, scratch):
    src, table, ckpt = f"{scratch}/src", f"{scratch}/table", f"{scratch}/ckpt"
    metrics = f"{scratch}/metrics"
    _write_feed(spark, src, parts=3)
    _run(spark, src, table, ckpt, metrics=metrics, max_files=1)
    _, expected = _batch_expected(spark)
    got = sorted(tuple(r) for r in spark.read.parquet(table).select(*KEY_COLS).collect())
    assert got == expected
    per_batch = spark.read.parquet(metrics)
    assert per_batch.count() == 3
    assert per_batch.agg(F.sum("failed")).first()[0] == 0


def test_redelivery_goes_to_dlq_as_duplicates(spark, scratch):
    src, table, ckpt = f"{scratch}/src", f"{scratch}/table", f"{scratch}/ckpt"
    dlq, metrics = f"{scratch}/dlq", f"{scratch}/metrics"
    _write_feed(spark, src)
    _run(spark, src, table, ckpt, dlq, metrics)
    before = spark.read.parquet(table).count()
    _write_feed(spark, src)   # the same messages arrive again
    _run(spark, src, table, ckpt, dlq, metrics)
    assert spark.read.parquet(table).count() == before
    m = spark.read.parquet(metrics).where("batch_id = 1").first()
    assert m["failed"] == before and m["success"] == 0
    dups = spark.read.json(dlq).where("reason = 'Duplicate' AND batch_id = 1")
    assert dups.count() == before
    sample = dups.first()["data"]
    assert '"InvoiceDate":"' in sample and "T" in sample.split('"InvoiceDate":"')[1][:11]
    # the table never holds a key twice
    from tillflow.plans.table import unique_violations
    assert unique_violations(spark.read.parquet(table)).count() == 0


def test_replayed_batch_is_not_a_duplicate(spark, scratch):
    """A batch that failed after its append is replayed with the same ids:
    its rows count as written, nothing is appended twice."""
    src, table = f"{scratch}/src", f"{scratch}/table"
    metrics, dlq = f"{scratch}/metrics", f"{scratch}/dlq"
    _write_feed(spark, src)
    batch = spark.read.text(src).withColumn("source_file", F.input_file_name()) \
        .withColumn("source_mtime", F.current_timestamp())
    seen = []
    fn = batch_writer(table, dlq, metrics, "q1", on_batch=lambda b, m: seen.append(m))
    fn(batch, 7)
    n = spark.read.parquet(table).count()
    fn(batch, 7)
    assert spark.read.parquet(table).count() == n
    assert seen[1]["already_written"] == n and seen[1]["failed"] == 0
    assert seen[1]["success"] == seen[0]["success"]
    assert spark.read.parquet(metrics).count() == 1
    assert os.path.basename(table) == "table"


def test_the_table_is_appended_to_last(spark, scratch, monkeypatch):
    from tillflow.plans import jobs
    _write_feed(spark, f"{scratch}/src")
    batch = spark.read.text(f"{scratch}/src").selectExpr("value", "1 AS offset").withColumn("offset", F.monotonically_increasing_id())

    def fail(*args, **kwargs):
        raise RuntimeError("append")
    monkeypatch.setattr(jobs, "write_partitioned", fail)
    try:
        batch_writer(f"{scratch}/table", f"{scratch}/dlq", f"{scratch}/metrics", "q", ["offset"])(batch, 0)
    except RuntimeError as e:
        assert str(e) == "append"
    # an append drops the cached rows: whatever came after would compute the batch again
    assert spark.read.parquet(f"{scratch}/metrics").count() == 1 and spark.read.json(f"{scratch}/dlq").count() > 0


def test_batch_jobs_are_planned_with_aqe(spark):
    from tillflow.streaming.ingest import adaptive
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "false")
        with adaptive(spark):
            assert spark.conf.get(key) == "true"
        assert spark.conf.get(key) == "false"
    finally:
        spark.conf.set(key, before)


def test_batches_take_as_many_files_as_may_be_broadcast():
    from tillflow.operators.store import BROADCAST_MAX_ROWS
    from tillflow.plans import registry
    assert registry._batch_files(registry.STREAM_LEAST_FILES) == registry.STREAM_LEAST_FILES // 2
    assert registry._batch_files(10_000) * registry.STREAM_FILE_EVENTS == BROADCAST_MAX_ROWS
