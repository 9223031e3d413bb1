"""Ingest counters (A7) as one aggregate pass over the classified rows.

The reference keeps four monotonic counters (invalid, processed, success,
failed); we count every outcome so the reconciliation
``received = invalid + in-batch duplicates + null drops + sign drops +
bad dates + store rejects + no partition + processed`` can be checked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tillflow import schema as S
from tillflow.operators.clean import GROUP_ROWS
from tillflow.operators.store import OUTCOME_ALREADY, OUTCOME_DUPLICATE, OUTCOME_INSERTED

METRIC_COLUMNS = [
    "received", "malformed", "invalid", "in_batch_duplicates", "null_dropped",
    "sign_dropped", "bad_date", "store_reject", "no_partition", "processed",
    "success", "failed", "already_written",
]


def metric_columns() -> list[Column]:
    """The counters as aggregates over resolved rows: one row per surviving record with
    ``outcome`` (validation rejects carry their reason as outcome) and ``group_rows`` for dedupe winners."""
    o = F.col("outcome")
    n = lambda cond: F.count_if(cond).cast("bigint")
    rows = F.coalesce(F.col(GROUP_ROWS), F.lit(1)).cast("bigint")
    inserted = o.isin(OUTCOME_INSERTED, OUTCOME_ALREADY)
    stored_outcomes = [OUTCOME_INSERTED, OUTCOME_ALREADY, OUTCOME_DUPLICATE]
    return [
        F.coalesce(F.sum(rows), F.lit(0)).cast("bigint").alias("received"),
        n(o == S.REASON_MALFORMED).alias("malformed"),
        n(o.isin(S.REASON_MALFORMED, S.REASON_SCHEMA)).alias("invalid"),
        F.coalesce(F.sum(rows - 1), F.lit(0)).cast("bigint").alias("in_batch_duplicates"),
        n(o == S.OUTCOME_NULL_DROP).alias("null_dropped"),
        n(o == S.OUTCOME_SIGN_DROP).alias("sign_dropped"),
        n(o == S.REASON_BAD_DATE).alias("bad_date"),
        n(o == S.REASON_STORE).alias("store_reject"),
        n(o == S.REASON_NO_PARTITION).alias("no_partition"),
        n(o.isin(stored_outcomes)).alias("processed"),
        n(inserted).alias("success"),
        n(o == OUTCOME_DUPLICATE).alias("failed"),
        n(o == OUTCOME_ALREADY).alias("already_written"),
    ]


def ingest_metrics(resolved: DataFrame) -> DataFrame:
    """One row of counts (see :func:`metric_columns`)."""
    return resolved.agg(*metric_columns())


def observe_metrics(resolved: DataFrame) -> tuple[DataFrame, Observation]:
    """``resolved`` with its counters observed on the way: the first action on the returned frame
    fills the observation (``.get``), so counting needs no pass of its own."""
    observed = Observation()
    return resolved.observe(observed, *metric_columns()), observed
