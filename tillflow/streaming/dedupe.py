"""Stream-level distinct on (InvoiceNo, StockCode).

The deprecated reference job used ``dropDuplicates`` without a watermark,
so its state grows for ever.  The default here is the micro-batch dedupe
plus the table's insert-if-absent guard (no stream state at all).  Where a
bounded distinct inside the stream is wanted, each key is kept only until the watermark
passes its first time plus the delay, in a RocksDB state store, which keeps the state
on the executors' disks and uploads its changes to the checkpoint, not on the JVM heap."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillflow import schema as S
from tillflow.functions.scalar import parse_invoice_ts

ROCKSDB_PROVIDER = ("org.apache.spark.sql.execution.streaming.state."
                    "RocksDBStateStoreProvider")
_PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"
_COUNT_CONF = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
_PARTITIONS_CONF = "spark.sql.shuffle.partitions"


def distinct_within_watermark(stream: DataFrame, ts_col: str = "InvoiceDate",
                              delay: str = "1 hour", key=S.PAIR_KEY) -> DataFrame:
    return stream.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark(list(key))


def distinct_unbounded(stream: DataFrame, key=S.PAIR_KEY) -> DataFrame:
    """The reference's behaviour (state never expires); kept for parity."""
    return stream.dropDuplicates(list(key))


def keyed_events(validated: DataFrame, key=S.PAIR_KEY) -> DataFrame:
    """Valid events with a time (P5, F1): what a distinct by event time can take."""
    at = parse_invoice_ts("InvoiceDate").cast("timestamp").alias("event_time")
    # Behind inline() the time is parsed once, not for the filter and again for the column.
    return (validated.where("reason IS NULL").select(*key, F.inline(F.array(F.struct(at))))
            .where("event_time IS NOT NULL"))


@contextmanager
def rocksdb_state(spark: SparkSession, partitions: int | None = None, count_rows: bool = True) -> Iterator[None]:
    """Streams that start inside keep their state in RocksDB (a stream takes its settings when it starts,
    and a restart must use the provider its checkpoint was made with)."""
    conf = {_PROVIDER_CONF: ROCKSDB_PROVIDER, _COUNT_CONF: str(count_rows).lower()}
    if partitions:
        conf[_PARTITIONS_CONF] = str(partitions)
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def start_distinct(events: DataFrame, out_path: str, checkpoint: str, delay: str, key=S.PAIR_KEY,
                   available_now: bool = False, processing_time: str = "30 seconds", partitions: int | None = None,
                   count_state: bool = True) -> StreamingQuery:
    """Append the first event of each key to Parquet, exactly once over restarts.

    ``events`` is a stream of key columns and ``event_time``.  An event at or before the watermark (the latest
    time of the batches before, less ``delay``) is late and dropped.  A key that was let through is held until the
    watermark passes its time plus ``delay``; until then further events of it are dropped, afterwards the key
    counts as new.  Of several events of one key in one micro-batch, one is let through.

    ``partitions`` parts the state (default: the session's shuffle partitions; a restart keeps those of its checkpoint).
    Each opens, commits and uploads a store of its own in every batch.  With ``count_state`` off, :func:`state_rows` isn't
    known, and the store needn't look up every key it writes or removes a second time.
    """
    with rocksdb_state(events.sparkSession, partitions, count_state):
        writer = (distinct_within_watermark(events, "event_time", delay, key).writeStream.format("parquet")
                  .option("path", out_path).option("checkpointLocation", checkpoint).outputMode("append"))
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
        return writer.start()


def state_rows(query: StreamingQuery) -> int:
    """Keys that the distinct holds after the last batch that reported its state (0 if it doesn't count them)."""
    for progress in reversed(query.recentProgress):
        if progress["stateOperators"]:
            return int(progress["stateOperators"][0]["numRowsTotal"])
    return 0
