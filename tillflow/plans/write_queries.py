"""Registered queries of what writes, streams and restarts: each runs the job itself on the feed, in a
folder of its own below the shared checkpoint folder, and returns what it left there."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow import schema as S
from tillflow.operators.batches import valid_batches
from tillflow.operators.clean import clean_events, mark_missing_ids
from tillflow.operators.metrics import METRIC_COLUMNS
from tillflow.operators.store import mark_present
from tillflow.operators.validate import decode_permissive, validate_messages
from tillflow.plans import registry as R
from tillflow.plans import table as TBL
from tillflow.plans.ingest import ingest
from tillflow.plans.jobs import ingest_job, upsert_table
from tillflow.session import shared_path, stored
from tillflow.sources.files import csv_stream_sink, read_csv_sink, read_messages_in_order, read_messages_stream, to_messages
from tillflow.sources.tables import RETAIL_ORDER_COLS, count_events, read_table
from tillflow.streaming.dashboard import PANELS, start_dashboard
from tillflow.streaming.dedupe import keyed_events, start_distinct
from tillflow.streaming.ingest import start_ingest

# The numbers in InvoiceNo and StockCode: the stand-in feeds are dealt out by them.
def _order() -> Column:
    return F.col("InvoiceNo").cast("bigint")


def _part() -> Column:
    return F.col("StockCode").cast("bigint")

# Place of a message in files read in order.
FILE_LINES = ["source_file", "block_start", "line"]


def _written_files(spark: SparkSession, sf: str) -> str:
    """The faulty messages as JSON-lines files, one folder a file number, lines in key and arrival order."""
    feed = R._feed(spark, sf)
    files = R._stream_files(feed, count_events(spark, sf))
    path = shared_path(spark, "valid_batches")
    # The feed's columns are dealt out, not the longer messages made of them.
    dealt = (feed.withColumn("file", F.pmod(_order(), F.lit(files))).repartition(files, "file")
             .sortWithinPartitions("file", _order(), _part(), *RETAIL_ORDER_COLS))
    R._write_messages(R._faulty_messages(spark, sf, ["InvoiceNo", "StockCode", "file"], dealt).select("value", "file"), path, ("file",))
    return path


def _batched(spark: SparkSession, sf: str) -> DataFrame:
    return R._memo(spark, sf, "batched", lambda: valid_batches(
        validate_messages(read_messages_in_order(spark, _written_files(spark, sf))), FILE_LINES))


def q_valid_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The feed's files in order of file and line, cut into batches of five valid records."""
    return _batched(spark, sf).where("reason IS NULL").select(
        "InvoiceNo", "StockCode", "Description", "Quantity", "UnitPrice", "position", "batch")


def q_valid_batch_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """T1 as the reference uses it: five valid records are the scope of the in-batch dedupe."""
    return ingest(_batched(spark, sf), ["position"], scope_cols=["batch"]).metrics()


def _loaded(spark: SparkSession, sf: str) -> DataFrame:
    """Table rows from before the cut; of every fifth key also one at a later time."""
    rows = R.stored_table(spark, sf).where(F.col("InvoiceDate") < F.lit(R.LOADED_BEFORE).cast("timestamp_ntz"))
    later = F.col("InvoiceDate") + F.expr("INTERVAL 40 DAYS")
    again = rows.where((_order() + _part()) % 5 == 0).withColumn("InvoiceDate", later).withColumn(
        S.PARTITION_COLUMN, F.date_format("InvoiceDate", "yyyy_MM"))
    return rows.select(*S.TABLE_COLUMNS).unionByName(again.select(*S.TABLE_COLUMNS))


def q_upsert_table(spark: SparkSession, sf: str) -> DataFrame:
    """J2 on the stored table: every clean feed row since the cut's year applied onto the rows loaded before the
    cut, of which some pairs have two times; months that nothing touches keep their files."""
    path = shared_path(spark, "upsert_table")
    TBL.write_partitioned(_loaded(spark, sf), path, laid_out=True)
    incoming = R._clean_feed(spark, sf).where(F.col("InvoiceDate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    upsert_table(spark, path, incoming, RETAIL_ORDER_COLS)
    return spark.read.parquet(path).select(*S.STORE_COLUMNS)


# Least buckets of the keyed table in the query below; a larger table gets as many as leave a bucket this many rows, some
# hundred MB, as a bucket is sorted by one task.
KEYED_BUCKETS = 16
BUCKET_ROWS = 2_000_000


def _buckets(n_rows: int) -> int:
    return max(KEYED_BUCKETS, -(-n_rows // BUCKET_ROWS))


def q_insert_if_absent_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """The whole clean feed against a table that is bucketed on the key and holds what came before the cut.
    The new rows are inserted, then every row is looked up again."""
    name = f"keyed_{uuid.uuid4().hex}"
    rows = R.stored_table(spark, sf)
    TBL.create_keyed_table(spark, name, _buckets(rows.count()), shared_path(spark, "keyed"))
    TBL.append_keyed(spark, name, rows.where(F.col("InvoiceDate") < F.lit(R.LOADED_BEFORE).cast("timestamp_ntz")))
    marked = stored(mark_present(rows, spark.table(name)), "keyed")
    TBL.append_keyed(spark, name, marked.where("outcome = 'inserted'"))
    again = mark_present(rows.select(*S.TRIPLE_KEY, S.PARTITION_COLUMN), spark.table(name)).withColumnRenamed("outcome", "then")
    return marked.select(*S.TRIPLE_KEY, "outcome").join(again.select(*S.TRIPLE_KEY, "then"), S.TRIPLE_KEY)


# The deliveries of the distinct stream: days before each cut arrive first, some keys arrive late, again, or again at a later time.
DISTINCT_DELAY = "90 days"
DISTINCT_CUTS = ("1997-01-01 00:00:00", "1999-01-01 00:00:00")


# Events of the whole feed that a state partition of the distinct stands for: some hundred MB of keys, each a store of its own.
STATE_EVENTS = 1_000_000


def _state_partitions(spark: SparkSession, n_events: int) -> int:
    """As many as the feed needs, and two a core: in a small one a store's commits take longer than its keys."""
    return max(2 * spark.sparkContext.defaultParallelism, -(-n_events // STATE_EVENTS))


def _deliveries(feed: DataFrame) -> DataFrame:
    """The feed's events with the number of the ``delivery`` they come in, once for each they come in."""
    first, second = DISTINCT_CUTS
    date, h = F.col("InvoiceDate"), (_order() + _part()) % 10
    old, middle = date < first, (date >= first) & (date < second)
    rescanned = F.date_format(date.cast("timestamp_ntz") + F.expr("INTERVAL 5 YEARS"), S.WIRE_TS_FORMAT)
    comes = [(old & (h != 3), 0, date), (middle | (old & h.isin(3, 4)), 1, date),
             ((date >= second) | (middle & (h == 6)), 2, date), (old & (h == 5), 2, rescanned)]
    times = F.array_compact(F.array(*[F.when(rule, F.struct(F.lit(n).alias("delivery"), at.alias("InvoiceDate")))
                                      for rule, n, at in comes]))
    return feed.where(date != "bad-date").select(*[c for c in S.WIRE_NAMES if c != "InvoiceDate"], F.inline(times))


@contextmanager
def _unsorted_writes(spark: SparkSession, folders: int) -> Iterator[None]:
    """Tasks write up to so many folders at a time, instead of sorting their rows by folder."""
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", str(folders))
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.maxConcurrentOutputFileWriters")


def q_stream_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """Three deliveries, the stream restarted from its checkpoint for each: late events are dropped, repeated ones
    within the delay too, and a key that comes again long after is let through again."""
    root = shared_path(spark, "stream_distinct")
    # The feed is joined and written once; its deliveries then arrive one after the other in the stream's folder.
    with _unsorted_writes(spark, len(DISTINCT_CUTS) + 1):
        R._write_messages(to_messages(_deliveries(R._feed(spark, sf)), ["delivery"]), f"{root}/made", ("delivery",))
    partitions = _state_partitions(spark, read_table(spark, sf, "lineitem").count())
    for n in range(len(DISTINCT_CUTS) + 1):
        _move_files(spark, f"{root}/made/delivery={n}", f"{root}/src", f"delivery-{n}-")
        messages = read_messages_stream(spark, f"{root}/src").select("value")
        events = keyed_events(validate_messages(messages, fields=[*S.PAIR_KEY, "InvoiceDate"]))
        start_distinct(events, f"{root}/out", f"{root}/ckpt", DISTINCT_DELAY, available_now=True, partitions=partitions,
                       count_state=False).awaitTermination()
    return spark.read.parquet(f"{root}/out").select(*S.PAIR_KEY, F.col("event_time").cast("timestamp_ntz").alias("event_time"))


def q_stream_dashboard(spark: SparkSession, sf: str) -> DataFrame:
    """The five answers after two drains of a table that grew between them, each aggregate's state taken up again."""
    root = shared_path(spark, "stream_dashboard")
    rows = R.stored_table(spark, sf)
    before = F.col("InvoiceDate") < F.lit(R.LOADED_BEFORE).cast("timestamp_ntz")
    for part in (rows.where(before), rows.where(~before)):
        TBL.write_partitioned(part, f"{root}/table", laid_out=True)
        for query in start_dashboard(spark, f"{root}/table", f"{root}/ckpt", sink="parquet", out=f"{root}/out",
                                     available_now=True).values():
            query.awaitTermination()
    parts = []
    for panel, (item, values) in PANELS.items():
        frame = spark.read.parquet(f"{root}/out/{panel}")
        name = F.col(item).cast("string") if item else F.lit("")
        parts += [frame.select(F.lit(panel).alias("panel"), name.alias("item"), F.lit(v).alias("measure"),
                               F.col(v).cast("double").alias("value")) for v in values]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class BatchKilled(Exception):
    """Raised behind a batch's writes, before its commit."""


def _kill(batch_id: int, metrics: dict) -> None:
    raise BatchKilled(f"batch {batch_id} after its writes")


def _ordered_messages(rows: DataFrame, files: int) -> DataFrame:
    """Messages of which each key's lie in one file, in arrival order."""
    return to_messages(rows.repartition(files, *S.PAIR_KEY).sortWithinPartitions(*S.PAIR_KEY, *RETAIL_ORDER_COLS))


def q_stream_restart_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """The second batch fails behind its append and is delivered again after the restart; its rows are
    found as already written, and the counters reconcile."""
    root = shared_path(spark, "stream_restart")
    # as many files for either half as would hold the whole feed: one file is sorted and written by one task
    files = R._stream_files(R._feed(spark, sf), count_events(spark, sf))
    odd = _order() % 2 == 1
    for rows, fails in ((R._feed(spark, sf).where(~odd), [None]), (R._feed(spark, sf).where(odd), [_kill, None])):
        R._write_messages(_ordered_messages(rows, files), f"{root}/src")
        for hook in fails:
            query = start_ingest(read_messages_stream(spark, f"{root}/src"), f"{root}/table", f"{root}/ckpt", dlq_path=f"{root}/dlq",
                                 metrics_path=f"{root}/metrics", available_now=True, on_batch=hook)
            try:
                query.awaitTermination()
            except StreamingQueryException as e:
                if hook is None or "BatchKilled" not in str(e):
                    raise
    return spark.read.parquet(f"{root}/metrics").agg(*[F.sum(c).cast("bigint").alias(c) for c in METRIC_COLUMNS])


def _job(spark: SparkSession, sf: str, root: str) -> dict:
    return ingest_job(spark, R._validated(spark, sf), RETAIL_ORDER_COLS, f"{root}/table", f"{root}/dlq", f"{root}/metrics")


def q_observed_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """The counters of a batch job, observed on the action that materialises its rows, as the job stored them."""
    root = shared_path(spark, "observed")
    _job(spark, sf, root)
    return spark.read.parquet(f"{root}/metrics").select(*METRIC_COLUMNS)


def q_dlq_readback(spark: SparkSession, sf: str) -> DataFrame:
    """The dead-letter lines of a batch job as written, read back."""
    root = shared_path(spark, "readback")
    _job(spark, sf, root)
    return spark.read.schema("error string, data string, reason string").json(f"{root}/dlq").select("error", "reason", "data")


# Months that the table of the query below has partitions for.
ODD_MONTHS = [f"{y}_{m:02d}" for y in range(1995, 2001) for m in range(1, 13) if (y, m) >= (1995, 6)]


def _odd_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Messages with customers that aren't numbers, countries too long and prices too large for the table."""
    rows = R._feed(spark, sf)
    nan = F.when((_order() + _part()) % 31 == 0, F.lit(float("nan"))).otherwise(F.col("CustomerID"))
    long = F.when((_order() + 2 * _part()) % 37 == 0, F.repeat(F.lit("x"), 51)).otherwise(F.col("Country"))
    dear = F.when((_order() + 4 * _part()) % 41 == 0, F.lit(1e9)).otherwise(F.col("UnitPrice"))
    return to_messages(rows.withColumn("CustomerID", nan).withColumn("Country", long).withColumn("UnitPrice", dear), RETAIL_ORDER_COLS)


def q_all_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Counters of a feed in which every kind of reject occurs."""
    return ingest(validate_messages(_odd_messages(spark, sf)), RETAIL_ORDER_COLS, allowed_months=ODD_MONTHS).metrics()


def q_outcome_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Why rows of that feed are refused by the table, by error."""
    dlq = ingest(validate_messages(_odd_messages(spark, sf)), RETAIL_ORDER_COLS, allowed_months=ODD_MONTHS).dlq()
    return (dlq.where(F.col("reason").isin(S.REASON_STORE, S.REASON_NO_PARTITION)).groupBy("reason", "error")
            .agg(F.count(F.lit(1)).alias("n_rows")))


def q_permissive_malformed(spark: SparkSession, sf: str) -> DataFrame:
    """P2 on text of which some is no JSON: all fields are null, nothing is rejected."""
    got = decode_permissive(R._faulty_messages(spark, sf, ["InvoiceNo", "StockCode"]).select("value", *[
        F.col(c).alias(f"sent_{c}") for c in S.PAIR_KEY]))
    return got.select("sent_InvoiceNo", "sent_StockCode", *S.WIRE_NAMES)


# The CSV files of the query below are text too.
SINK_CODEC = R.MESSAGE_CODEC


def q_csv_sink_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Clean rows streamed to CSV in two drains. A file that a killed attempt left in the folder isn't in
    the sink's log, and reading through the log leaves it out."""
    root = shared_path(spark, "csv_sink")
    table = R.stored_table(spark, sf)  # made before anything else lies on the disk
    odd = _order() % 2 == 1
    for rows in (R._feed(spark, sf).where(~odd), R._feed(spark, sf).where(odd)):
        R._write_messages(to_messages(rows), f"{root}/src")
        valid = validate_messages(read_messages_stream(spark, f"{root}/src")).where("reason IS NULL")
        clean = clean_events(mark_missing_ids(valid).where("outcome IS NULL").drop("outcome")).where(F.col("outcome") == S.OUTCOME_CLEAN)
        (csv_stream_sink(clean.select(*S.STORE_COLUMNS), f"{root}/out", f"{root}/ckpt", SINK_CODEC)
         .trigger(availableNow=True).start().awaitTermination())
        # an attempt that wrote a file and died before its commit
        (table.select(*S.STORE_COLUMNS).write.mode("append").option("header", True)
         .option("compression", SINK_CODEC).csv(f"{root}/stray"))
        _move_files(spark, f"{root}/stray", f"{root}/out")
    return read_csv_sink(spark, f"{root}/out")


def _move_files(spark: SparkSession, source: str, folder: str, prefix: str = "") -> None:
    """Part files of one folder into another, as an uncommitted attempt leaves them there; with ``prefix`` before their names.
    A source that isn't there holds no files."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    at, to = hadoop.Path(source), hadoop.Path(folder)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(to)
    for status in fs.listStatus(at) if fs.exists(at) else []:
        name = status.getPath().getName()
        if name.startswith("part-") and not fs.rename(status.getPath(), hadoop.Path(to, prefix + name)):
            raise OSError(f"{status.getPath()} can't be moved to {folder}")


def q_swap_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that a reader sees under the published name before the new table is there, while both are, and after the
    swap; each is the old or the new table, whole."""
    run = uuid.uuid4().hex
    old, new, view = f"retail_old_{run}", f"retail_new_{run}", f"retail_{run}"
    rows = R.stored_table(spark, sf)
    before = F.col("InvoiceDate") < F.lit(R.LOADED_BEFORE).cast("timestamp_ntz")
    parts = []

    def seen(step: str) -> None:
        spark.catalog.refreshTable(view)
        parts.append(spark.table(view).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("Quantity").alias("quantity"))
                     .select(F.lit(step).alias("step"), "n_rows", "quantity"))
    for name, part in ((old, rows.where(before)), (new, rows)):
        path = shared_path(spark, "swap")
        TBL.create_table(spark, name, path)
        TBL.write_partitioned(part, path, laid_out=True)
        TBL.register_partitions(spark, name)
        if name == old:
            TBL.publish(spark, view, old)
            seen("old alone")
    seen("both there")
    TBL.publish(spark, view, new)
    seen("published")
    spark.sql(f"DROP VIEW {view}")
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


WRITE_QUERIES = {f.__name__[2:]: f for f in (
    q_valid_batches, q_valid_batch_metrics, q_upsert_table, q_insert_if_absent_bucketed, q_stream_distinct, q_stream_dashboard,
    q_stream_restart_metrics, q_observed_metrics, q_dlq_readback, q_all_outcomes, q_outcome_errors, q_permissive_malformed,
    q_csv_sink_roundtrip, q_swap_rows)}
