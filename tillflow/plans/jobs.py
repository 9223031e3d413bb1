"""Jobs that write: one ingest pass -> table append, dead-letter rows,
counters, optional CSV backup (S8-S11, S15).

Exactly-once under retries rests on three rules:

* The resolved frame is materialized before the table is appended to.
  Otherwise a lazily re-evaluated insert-if-absent would read the rows this
  very batch just appended and call them duplicates.
* Table rows carry ``query_id``/``batch_id``.  A replayed batch finds its own
  rows and counts them as ``already_written`` (success), not as duplicates,
  and appends nothing again.
* Dead-letter rows and counters are written with dynamic partition
  overwrite on ``(query_id, batch_id)``, so a replay replaces its own output.

Appending to the table is not atomic with the other two writes; concurrent
writers to one table are not supported (the reference has one consumer).
"""

from __future__ import annotations

import datetime as dt
from contextlib import ExitStack

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tillflow import schema as S
from tillflow.functions.scalar import month_label, parse_invoice_ts
from tillflow.operators.dlq import envelope_json
from tillflow.operators.metrics import METRIC_COLUMNS, observe_metrics
from tillflow.operators.store import apply_changes, change_set, find_first, new_rows
from tillflow.plans.ingest import IngestResult, classify, ingest, resolve
from tillflow.plans.table import layout_for_write, register_partitions, write_partitioned
from tillflow.session import freed_shuffles, stored_while
from tillflow.sources.files import write_backup_csv, write_messages

ROWS_PER_FILE = 2_000_000
# Fewer rows than this aren't worth a write task of their own.
ROWS_PER_TASK = 50_000
MAX_MONTHS = 240


# Analysis errors that mean "no table yet"; any other one must surface, as
# inserting without the target would store every duplicate again.
NO_TABLE_YET = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def read_target(spark: SparkSession, table_path: str) -> DataFrame | None:
    """The stored table, or None before the first write."""
    try:
        return spark.read.parquet(table_path)
    except AnalysisException as e:
        if (e.getCondition() or "") in NO_TABLE_YET:
            return None
        raise


def prune_to_batch(target: DataFrame, validated: DataFrame) -> DataFrame:
    """Static partition pruning: keep the months that occur in the batch.

    The distinct months (as stored, from :func:`month_label`) of the
    (stored) batch reach the driver: at most MAX_MONTHS + 1 of them.  A batch
    with more months than that reads the whole table."""
    return _prune(target, validated.where(F.col("reason").isNull())
                  .select(month_label(parse_invoice_ts("InvoiceDate")).alias("m")))


def _prune(target: DataFrame, labels: DataFrame) -> DataFrame:
    months = [r[0] for r in labels.where("m is not null").distinct().limit(MAX_MONTHS + 1).collect()]
    if len(months) > MAX_MONTHS:
        return target
    return target.where(F.col(S.PARTITION_COLUMN).isin(months)) if months else target.limit(0)


def write_outcomes(spark: SparkSession, result: IngestResult, table_path: str,
                   dlq_path: str | None, metrics_path: str | None,
                   backup_csv: str | None = None, dlq_messages: str | None = None,
                   table_name: str | None = None, metrics: dict | None = None) -> dict:
    """Write stored rows, dead-letter rows and counters of one ingest pass;
    ``result.resolved`` must already be materialized.  ``dlq_messages`` gets the
    dead letters as envelope messages (S9), ``table_name`` is a table registered
    at ``table_path`` whose new months are to become visible.  ``metrics`` are the counters if they were observed
    already.  Returns the counters.

    The table comes last: Spark drops every cached plan that read it when it is appended to, so whatever came
    after would compute a cached ``result.resolved`` again.  A batch that fails on the way replaces its own
    dead letters and counters when it is delivered again."""
    metrics = metrics or result.metrics().first().asDict()
    if dlq_path:
        (result.dlq().write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("query_id", "batch_id", "reason").json(dlq_path))
    if dlq_messages:
        folder = f"{dlq_messages}/query_id={result.query_id}/batch_id={result.batch_id}"
        write_messages(result.dlq().select(envelope_json().alias("value")), folder, mode="overwrite")
    if metrics_path:
        row = dict(metrics, query_id=result.query_id, batch_id=result.batch_id,
                   written_at=dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
        cols = METRIC_COLUMNS + ["written_at", "query_id", "batch_id"]
        (spark.createDataFrame([tuple(row[c] for c in cols)],
                               ", ".join(f"{c} bigint" for c in METRIC_COLUMNS)
                               + ", written_at timestamp_ntz, query_id string, batch_id bigint")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("query_id", "batch_id").parquet(metrics_path))
    if backup_csv:
        write_backup_csv(result.clean(), backup_csv, result.query_id, result.batch_id)
    new = metrics["success"] - metrics["already_written"]
    if new > 0:
        # Ranges are sorted by month, so more of them add one file each, and a batch isn't written by one task.
        tasks = max(new // ROWS_PER_FILE, min(spark.sparkContext.defaultParallelism, new // ROWS_PER_TASK)) + 1
        write_partitioned(result.stored(), table_path, mode="append", num_partitions=tasks)
        if table_name:
            register_partitions(spark, table_name)
    return metrics


def ingest_job(spark: SparkSession, validated: DataFrame, order_cols, table_path: str,
               dlq_path: str | None = None, metrics_path: str | None = None,
               query_id: str = "batch", batch_id: int = 0, scope_cols=(),
               allowed_months=None, backup_csv: str | None = None,
               incoming_rows_bound: int | None = None, prune_target: bool = False,
               dlq_messages: str | None = None, table_name: str | None = None) -> dict:
    """Batch ingest of a whole input (S8 + S15 at scale).

    The resolved frame is stored in the shared checkpoint folder
    (reliable storage, survives lost executors) before any write, and removed behind them; the counters
    are observed on that same action.

    ``prune_target`` limits the insert-if-absent scan of the table to the
    months the input spans.  Spark applies no dynamic partition pruning to
    this semi join, so without it every month is scanned; finding the range
    costs one extra pass over the input, which pays off when the input is
    small next to the table (persist ``validated`` first if it is costly to
    recompute)."""
    target = read_target(spark, table_path)
    if target is not None and prune_target:
        target = prune_to_batch(target, validated)
    result = ingest(validated, order_cols, scope_cols, target, query_id, batch_id,
                    allowed_months, incoming_rows_bound)
    observed, counters = observe_metrics(result.resolved)
    with stored_while(observed, "resolved") as result.resolved:
        return write_outcomes(spark, result, table_path, dlq_path, metrics_path, backup_csv,
                              dlq_messages, table_name, counters.get)


def upsert_table(spark: SparkSession, table_path: str, incoming: DataFrame, order_cols, key=S.PAIR_KEY,
                 query_id: str = "upsert", batch_id: int = 0, table_name: str | None = None) -> dict:
    """J2 on the stored table: apply ``incoming`` (clean rows) as :func:`upsert_latest` does, and rewrite
    only the months that change.

    1. The change set, one row a key, is stored: the input is computed once.
    2. The table's key columns are read once to find the row that each known key updates.
    3. The months of those rows and of the new ones are read whole, changed, and stored.
       That is the new content of these months; nothing has been written yet.
    4. Dynamic partition overwrite replaces exactly these months; files of other months stay.
    What was stored on the way is removed at the end.

    A month is at most one distinct value of the time range (7,021 of them), so their list is
    bounded.  Applying the same input again changes nothing.  Changed rows keep the ids of the batch that
    created them; new rows get ``query_id`` and ``batch_id``.  A table that isn't there yet is created.
    Readers that list a month while it is replaced may miss it: see :func:`tillflow.plans.table.publish`.
    """
    with ExitStack() as held:
        return _upsert(spark, table_path, incoming, order_cols, key, query_id, batch_id, table_name, held)


def _upsert(spark: SparkSession, table_path: str, incoming: DataFrame, order_cols, key, query_id: str, batch_id: int,
            table_name: str | None, held: ExitStack) -> dict:
    month = S.PARTITION_COLUMN
    change = held.enter_context(stored_while(change_set(incoming, order_cols, key), "changes"))
    target = read_target(spark, table_path)
    if target is None:
        plan = change.withColumn("_first", F.lit(None).cast("timestamp_ntz")).withColumn(f"_{month}", F.lit(None).cast("string"))
    else:
        plan = held.enter_context(stored_while(change.join(find_first(target, change, key, [month]), list(key), "left"), "changes"))
    touched = F.coalesce(F.col(f"_{month}"), month_label(F.col("_keep.InvoiceDate")))
    counted = (plan.groupBy(touched.alias(month)).agg(F.count_if(F.col("_first").isNotNull()).alias("updated"),
                                                      F.count_if(F.col("_first").isNull()).alias("inserted"))).collect()
    months = [r[month] for r in counted]
    done = {"updated": sum(r["updated"] for r in counted), "inserted": sum(r["inserted"] for r in counted), "months": len(months)}
    if not months:
        return done
    rows = new_rows(plan, key).select(*S.STORE_COLUMNS, F.lit(query_id).alias("query_id"),
                                      F.lit(batch_id).cast("bigint").alias("batch_id"),
                                      month_label(F.col("InvoiceDate")).alias(month))
    if target is not None:
        old = target.where(F.col(month).isin(months)).select(*S.TABLE_COLUMNS)
        rows = apply_changes(old, plan, key).unionByName(rows)
    rows = held.enter_context(stored_while(rows, "changed"))
    with freed_shuffles(spark):
        (layout_for_write(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(month).parquet(table_path))
    if table_name:
        register_partitions(spark, table_name)
    return done


def ingest_micro_batch(spark: SparkSession, validated: DataFrame, order_cols,
                       table_path: str, dlq_path: str | None, metrics_path: str | None,
                       query_id: str, batch_id: int,
                       allowed_months=None, backup_csv: str | None = None) -> dict | None:
    """One streaming micro-batch: the batch is the dedupe scope, its row
    count bounds the keys broadcast for insert-if-absent, the target read
    is pruned to the batch's months.  Returns the counters, None for an empty batch.

    The batch is parsed and deduped once, into stored rows that the row count, the
    months and the join with the table read.  They are removed with the batch, and its shuffles when they have been read:
    a stream's batches don't add up on the executors' disks."""
    with ExitStack() as held:
        classified = held.enter_context(stored_while(classify(validated, order_cols, (), allowed_months), "micro_batch"))
        rows = classified.count()
        if rows == 0:
            return None
        target = read_target(spark, table_path)
        if target is not None:
            target = _prune(target, classified.where(F.col("outcome") == S.OUTCOME_CLEAN)
                            .select(F.col(S.PARTITION_COLUMN).alias("m")))
        result = resolve(classified, order_cols, (), target, query_id, batch_id, rows)
        if target is not None:  # without a table nothing is joined, and the rows are as they were stored
            result.resolved = held.enter_context(stored_while(result.resolved, "micro_batch"))
        return write_outcomes(spark, result, table_path, dlq_path, metrics_path, backup_csv)
