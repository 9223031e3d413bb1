"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame
over the driver's tables.  Every query runs over the whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow import schema as S
from tillflow.functions.scalar import (
    anchor_now, count_text, money_text, parse_invoice_ts, percent_text,
)
from tillflow.operators import aggregates as A
from tillflow.operators.clean import clean_events, mark_missing_ids
from tillflow.operators.store import BROADCAST_MAX_ROWS, mark_present, upsert_latest
from tillflow.operators.dlq import envelope_json
from tillflow.operators.validate import decode_permissive, raw_record_json, validate_events, validate_messages
from tillflow.operators.window import coerce_timestamp, time_window
from tillflow.plans import table as TBL
from tillflow.plans.ingest import ingest
from tillflow.plans.table import write_partitioned
from tillflow.session import freed_shuffles, shared_path, stored_while
from tillflow.sources.files import read_event_csv, read_messages_stream, to_messages, write_event_csv
from tillflow.sources.tables import RETAIL_ORDER_COLS, count_events, read_table, retail_events

# Fixed test parameters (shared with the SQL oracle).
# The "existing table" of the replay scenario holds the rows dated before
# LOADED_BEFORE; the re-delivered feed is the whole topic from the start.
LOADED_BEFORE = "1999-01-01 00:00:00"
# Dashboard "now" for the retail windows: the anchor day (P13) moved into
# the data's years, time of day kept; a time whose shortest window has orders.
RETAIL_NOW = anchor_now(dt.datetime(2024, 1, 1, 14, 22, 0), dt.date(1996, 12, 14))
# Dashboard "now" for the events table windows.
EVENTS_NOW = dt.datetime(2024, 1, 15, 12, 0, 0)
WINDOW_KEYS = {"30m": "30 minutes", "1h": "1 hour", "3h": "3 hours",
               "6h": "6 hours", "24h": "24 hours", "all": "All time"}


# Built plans (not data) per (session, sf_dir): the queries share the feed
# and ingest plans, so each is constructed once per session -- plan once,
# run many.  Nothing is cached on the executors.
_PLANS: dict = {}


def _memo(spark: SparkSession, sf: str, name: str, build):
    key = (spark, sf, name)
    if key not in _PLANS:
        _PLANS[key] = build()
    return _PLANS[key]


def _feed(spark: SparkSession, sf: str) -> DataFrame:
    return _memo(spark, sf, "feed", lambda: retail_events(spark, sf))


def _validated(spark: SparkSession, sf: str) -> DataFrame:
    return _memo(spark, sf, "validated", lambda: validate_events(_feed(spark, sf)))


def _ingested(spark: SparkSession, sf: str, replay: bool = False):
    if replay:
        return _memo(spark, sf, "replay", lambda: ingest(
            _validated(spark, sf), RETAIL_ORDER_COLS, target=_existing(spark, sf)))
    return _memo(spark, sf, "ingest", lambda: ingest(_validated(spark, sf), RETAIL_ORDER_COLS))


def stored_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The table after one batch ingest of the whole feed."""
    return _memo(spark, sf, "stored", lambda: _ingested(spark, sf).stored().select(
        *S.STORE_COLUMNS, S.PARTITION_COLUMN))


def _existing(spark: SparkSession, sf: str) -> DataFrame:
    return _memo(spark, sf, "existing", lambda: stored_rows(spark, sf).where(
        F.col("InvoiceDate") < F.lit(LOADED_BEFORE).cast("timestamp_ntz")))


def stored_table(spark: SparkSession, sf: str) -> DataFrame:
    """The month-partitioned table of one batch ingest: written once a session to
    the shared checkpoint folder, and read by every dashboard query."""
    def build():
        path = shared_path(spark, "table")
        # Stored first: the layout's range bounds are sampled from the rows, and the ingest's shuffles are gone by its own.
        with stored_while(_ingested(spark, sf).stored(), "ingested") as rows:
            write_partitioned(rows, path, mode="overwrite")
        return spark.read.parquet(path)
    return _memo(spark, sf, "table", build)


def _dash(spark: SparkSession, sf: str) -> DataFrame:
    return _memo(spark, sf, "dash", lambda: A.dashboard_frame(stored_table(spark, sf)))


def q_retail_raw(spark, sf):
    return _feed(spark, sf)


def q_validation_rejects(spark, sf):
    v = _validated(spark, sf)
    return v.where(F.col("reason").isNotNull()).select(
        "InvoiceNo", "StockCode", "reason", "error", raw_record_json().alias("data"))


def q_clean_rows(spark, sf):
    return stored_rows(spark, sf)


def q_message_ingest(spark, sf):
    """Producer (S7) -> JSON messages -> lax validation (P1-P3) -> clean."""
    msgs = to_messages(_feed(spark, sf), RETAIL_ORDER_COLS)
    res = ingest(validate_messages(msgs), RETAIL_ORDER_COLS)
    return res.stored().select(*S.STORE_COLUMNS, S.PARTITION_COLUMN)


# The stream feed is cut into files of at most this many events, and a
# micro-batch takes a fixed number of files (T1): batches are bounded by
# events, and their number grows with the feed.  A batch may have as many events
# as insert-if-absent broadcasts: each batch scans the table once, so smaller
# ones would scan a growing table more often.
STREAM_FILE_EVENTS = 100_000
STREAM_BATCH_FILES = BROADCAST_MAX_ROWS // STREAM_FILE_EVENTS
STREAM_LEAST_FILES = 8
# Message files are text, several times the size of what it says.
MESSAGE_CODEC = "lz4"


def _stream_files(feed: DataFrame, n_events: int | None = None) -> int:
    n = feed.count() if n_events is None else n_events
    return max(STREAM_LEAST_FILES, -(-n // STREAM_FILE_EVENTS))


def _write_messages(messages: DataFrame, path: str, folders: tuple[str, ...] = ()) -> None:
    """Messages as compressed JSON-lines files, added to ``path``, with a folder for each value of ``folders``."""
    with freed_shuffles(messages.sparkSession):
        messages.write.mode("append").option("compression", MESSAGE_CODEC).partitionBy(*folders).text(path)


def _batch_files(files: int) -> int:
    """Files a micro-batch, at least two batches."""
    return min(STREAM_BATCH_FILES, files // 2)


def q_stream_ingest(spark, sf):
    """T1-T6 end to end: the feed is written as JSON-lines files (S7) to the
    shared checkpoint folder, hash-partitioned by the dedupe key
    (InvoiceNo, StockCode) so every key lives in one file while a hot
    invoice still spreads over many, lines in arrival order; a stream drains them in
    micro-batches of a few files into a fresh month-partitioned table.
    Dedupe per micro-batch then equals dedupe over the whole feed, so the
    table must equal ``clean_rows``."""
    from tillflow.streaming.ingest import start_ingest
    root = shared_path(spark, "stream_ingest")
    files = _stream_files(_feed(spark, sf), count_events(spark, sf))
    feed = (_feed(spark, sf).repartition(files, *S.PAIR_KEY)
            .sortWithinPartitions("InvoiceNo", "StockCode", *RETAIL_ORDER_COLS))
    _write_messages(to_messages(feed), f"{root}/src")
    q = start_ingest(read_messages_stream(spark, f"{root}/src", _batch_files(files)),
                     f"{root}/table", f"{root}/ckpt", dlq_path=f"{root}/dlq",
                     metrics_path=f"{root}/metrics", available_now=True)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(f"{root}/table").select(*S.STORE_COLUMNS, S.PARTITION_COLUMN)


def q_ingest_metrics(spark, sf):
    return _ingested(spark, sf).metrics()


def q_replay_metrics(spark, sf):
    return _ingested(spark, sf, replay=True).metrics()


def q_dlq_all(spark, sf):
    return _ingested(spark, sf, replay=True).dlq().select("error", "reason", "data")


def q_insert_if_absent(spark, sf):
    """Distinct feed keys against a table of those with an early line: other rows
    of the same key are present, the rest is new (J1 on its key alone)."""
    rows = _feed(spark, sf).withColumn(S.PARTITION_COLUMN, F.substring("InvoiceDate", 1, 7))
    keys = [*S.TRIPLE_KEY, S.PARTITION_COLUMN]
    marked = mark_present(rows.select(*keys).distinct(), rows.where("l_linenumber <= 4").select(*keys))
    return marked.select("InvoiceNo", "StockCode", "InvoiceDate", "outcome")


# Faults of the message queries: k and p are the numbers in InvoiceNo and StockCode.
def _key_rule(mult: int, mod: int) -> F.Column:
    return (F.col("InvoiceNo").cast("bigint") + F.lit(mult) * F.col("StockCode").cast("bigint")) % mod


def _faulty_messages(spark, sf, keep=None, feed=None):
    """Messages of which every 43rd key is cut to malformed text; those all have one arrival order, unless
    ``keep`` names the feed's columns that go along whole.  ``feed`` may be the feed already laid out."""
    feed = _feed(spark, sf) if feed is None else feed
    bad = _key_rule(2, 43) == 0
    text = to_messages(feed, keep or ["InvoiceNo", "StockCode", *RETAIL_ORDER_COLS])
    value = F.when(bad, F.concat(F.lit("{bad "), F.col("InvoiceNo"))).otherwise(F.col("value")).alias("value")
    if keep:
        return text.select(value, *keep)
    return text.select(value, *[F.when(~bad, F.col(c)).alias(c) for c in RETAIL_ORDER_COLS])


def _faulty(spark, sf):
    return _memo(spark, sf, "faulty", lambda: ingest(
        validate_messages(_faulty_messages(spark, sf)), RETAIL_ORDER_COLS))


def q_messages_faulty(spark, sf):
    return _faulty(spark, sf).metrics()


def q_messages_faulty_dlq(spark, sf):
    return _faulty(spark, sf).dlq().where(F.col("reason") == S.REASON_MALFORMED).select("error", "reason", "data")


def q_dlq_envelope(spark, sf):
    """Envelopes of malformed messages, whose text travels as a JSON string."""
    return (_faulty(spark, sf).dlq().where(F.col("reason") == S.REASON_MALFORMED)
            .select(envelope_json().alias("envelope")))


def q_messages_lax(spark, sf):
    """Numbers as text, with blanks, underscores, fractions, exponents and booleans."""
    feed = _feed(spark, sf)
    def pick(rule, forms):
        out = F.lit(forms[0])
        for i, form in enumerate(forms):
            out = F.when(rule == i, F.lit(form)).otherwise(out)
        return out
    qty = pick(_key_rule(1, 13), ['6', '"6"', '" 6 "', '"6.0"', '"6d"', '"1_000"', '"6."', 'true', '"0x1p3"', '6.5', '6.0', 'null', '"6.5"'])
    price = pick(_key_rule(2, 11), ['2.5', '"2.5"', '"1e1"', '"0x1p3"', '"2."', '"1_000.5"', '"2f"', 'false', '"x"', 'null', '".5"'])
    text = F.concat(F.lit('{"InvoiceNo":"'), "InvoiceNo", F.lit('","StockCode":"'), "StockCode",
                    F.lit('","Description":"d","Quantity":'), qty,
                    F.lit(',"InvoiceDate":"2010-12-01 08:26:00","UnitPrice":'), price,
                    F.lit(',"CustomerID":1,"Country":"UK"}'))
    got = validate_messages(feed.select("l_linenumber", text.alias("value")))
    return got.select("InvoiceNo", "StockCode", "l_linenumber", "Quantity", "UnitPrice", "error")


def q_permissive_decode(spark, sf):
    """P2 over the feed's messages."""
    return decode_permissive(to_messages(_feed(spark, sf), ["l_linenumber"]))


def q_dates_mixed(spark, sf):
    """F1 on one-digit fields, other forms, and years outside the range."""
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    ts = F.col("o_orderdate") + F.make_dt_interval(mins=(F.col("o_orderkey") % 1440).cast("int"))
    k = F.col("o_orderkey") % 7
    text = (F.when(k == 1, F.date_format(ts, "yyyy-M-d H:m:s"))
            .when(k == 2, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
            .when(k == 3, F.concat(F.lit("0001"), F.date_format(ts, "-MM-dd HH:mm:ss")))
            .when(k == 4, F.concat(F.lit("2999"), F.date_format(ts, "-MM-dd HH:mm:ss")))
            .when(k == 5, F.date_format(ts, "yyyy-MM-dd"))
            .otherwise(F.date_format(ts, S.WIRE_TS_FORMAT)))
    return o.select("o_orderkey", text.alias("text")).select("o_orderkey", "text", parse_invoice_ts("text").alias("ts"))


def q_coerced_window(spark, sf):
    """Event times as text, some of it no time, coerced before the window."""
    ev = read_table(spark, sf, "events")
    text = F.when(F.col("event_id") % 5 == 0, F.lit("soon")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    coerced = coerce_timestamp(ev.select("event_id", text.alias("invoicedate")))
    return time_window(coerced, "24 hours", EVENTS_NOW, "invoicedate")


def _scoped(spark, sf):
    return _memo(spark, sf, "scoped", lambda: ingest(
        _validated(spark, sf).withColumn("scope", F.col("l_linenumber")), RETAIL_ORDER_COLS, scope_cols=["scope"]))


def q_scoped_metrics(spark, sf):
    """Dedupe scopes (a line number each): a key that survives in two scopes is inserted once."""
    return _scoped(spark, sf).metrics()


def q_scoped_dlq(spark, sf):
    return _scoped(spark, sf).dlq().where(F.col("reason") == S.REASON_DUPLICATE).select("error", "reason", "data")


def q_csv_roundtrip(spark, sf):
    """The feed as replay CSV, with quotes and commas in descriptions, read back."""
    path = shared_path(spark, "csv")
    feed = _feed(spark, sf).withColumn("Description", F.when(
        _key_rule(1, 7) == 0, F.concat(F.lit('WHITE "HEART", '), F.col("Description"))).otherwise(F.col("Description")))
    write_event_csv(feed, path)
    return read_event_csv(spark, path)


def q_text_formats(spark, sf):
    """the dashboard's money, count and percent texts per country."""
    share = A.country_share(_dash(spark, sf))
    return share.select("country", money_text("sales").alias("sales"), count_text(F.floor("sales")).alias("whole"),
                        percent_text("share_pct").alias("share"))


def _clean_feed(spark, sf):
    """Every clean feed row, no dedupe."""
    valid = _validated(spark, sf).where(F.col("reason").isNull())
    kept = mark_missing_ids(valid).where(F.col("outcome").isNull()).drop("outcome")
    return clean_events(kept).where(F.col("outcome") == S.OUTCOME_CLEAN)


def q_upsert_latest(spark, sf):
    """Every clean feed row (no dedupe) applied in arrival order onto the stored
    rows loaded before the cut."""
    loaded = stored_table(spark, sf).where(F.col("InvoiceDate") < F.lit(LOADED_BEFORE).cast("timestamp_ntz"))
    return upsert_latest(loaded, _clean_feed(spark, sf), RETAIL_ORDER_COLS)


def q_kpi(spark, sf):
    return A.kpi(_dash(spark, sf))


def q_top_products(spark, sf):
    return A.top_products(_dash(spark, sf))


def q_hourly_revenue(spark, sf):
    return A.hourly_revenue(_dash(spark, sf))


def q_country_share(spark, sf):
    return A.country_share(_dash(spark, sf))


def q_category_sales(spark, sf):
    return A.category_sales(_dash(spark, sf))


def q_category_sales_top5(spark, sf):
    return A.category_sales(_dash(spark, sf), 5)


def q_row_count(spark, sf):
    return A.row_count(stored_table(spark, sf))


def q_month_partitions(spark, sf):
    return TBL.month_partitions(stored_table(spark, sf))


def q_month_rows(spark, sf):
    return TBL.month_rows(stored_table(spark, sf))


def q_unique_violations(spark, sf):
    """D5 on the received feed: keys the table must refuse to hold twice."""
    return TBL.unique_violations(_feed(spark, sf))


def _retail_window_kpi(duration):
    def q(spark, sf):
        framed = time_window(stored_table(spark, sf), duration, RETAIL_NOW,
                             "InvoiceDate", S.PARTITION_COLUMN)
        return A.kpi(A.dashboard_frame(framed))
    return q


def _events_window(duration):
    def q(spark, sf):
        ev = _memo(spark, sf, "events", lambda: read_table(spark, sf, "events")).select(
            "event_id", "ts", "user_id", "event_type", "value")
        return time_window(ev, duration, EVENTS_NOW, "ts")
    return q


def _build() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {
        "retail_raw": q_retail_raw,
        "validation_rejects": q_validation_rejects,
        "clean_rows": q_clean_rows,
        "message_ingest": q_message_ingest,
        "stream_ingest": q_stream_ingest,
        "ingest_metrics": q_ingest_metrics,
        "replay_metrics": q_replay_metrics,
        "dlq_all": q_dlq_all,
        "insert_if_absent": q_insert_if_absent,
        "upsert_latest": q_upsert_latest,
        "kpi": q_kpi,
        "top_products": q_top_products,
        "hourly_revenue": q_hourly_revenue,
        "country_share": q_country_share,
        "category_sales": q_category_sales,
        "category_sales_top5": q_category_sales_top5,
        "row_count": q_row_count,
        "month_partitions": q_month_partitions,
        "month_rows": q_month_rows,
        "unique_violations": q_unique_violations,
        "messages_faulty": q_messages_faulty,
        "messages_faulty_dlq": q_messages_faulty_dlq,
        "messages_lax": q_messages_lax,
        "dlq_envelope": q_dlq_envelope,
        "permissive_decode": q_permissive_decode,
        "dates_mixed": q_dates_mixed,
        "coerced_window": q_coerced_window,
        "scoped_metrics": q_scoped_metrics,
        "scoped_dlq": q_scoped_dlq,
        "csv_roundtrip": q_csv_roundtrip,
        "text_formats": q_text_formats,
    }
    for k, d in WINDOW_KEYS.items():
        if k != "all":
            out[f"kpi_window_{k}"] = _retail_window_kpi(d)
            out[f"events_window_{k}"] = _events_window(d)
    return out


QUERIES = _build()
