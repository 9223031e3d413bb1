"""Ingest plan: received events -> one resolved frame with an outcome per
surviving record; the stored rows, dead-letter rows and counters are all
projections of that frame, so they always agree.

    validated -> route (reject / null drop / keep)        P4, P5
              -> first row per key, one aggregate          A8
                 (rejects and drops are groups of one)
              -> clean + classify                          F1, P6-P11, D2
              -> insert-if-absent on the clean rows        J1
              = resolved: one row per surviving record
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow import schema as S
from tillflow.operators.clean import GROUP_ROWS, clean_events, route_and_dedupe
from tillflow.operators.dlq import dlq_rows, stored_record_json
from tillflow.operators.metrics import ingest_metrics
from tillflow.operators.store import (
    OUTCOME_DUPLICATE, OUTCOME_INSERTED, first_in_input, mark_present,
)

RESOLVED_COLUMNS = S.STORE_COLUMNS + [S.PARTITION_COLUMN, "outcome", "reason",
                                      "error", "data", GROUP_ROWS]


@dataclass
class IngestResult:
    resolved: DataFrame
    query_id: str | None = None
    batch_id: int | None = None

    def stored(self) -> DataFrame:
        """Rows to append to the table (with lineage and month)."""
        return (self.resolved.where(F.col("outcome") == OUTCOME_INSERTED)
                .select(*S.STORE_COLUMNS,
                        F.lit(self.query_id).cast("string").alias("query_id"),
                        F.lit(self.batch_id).cast("bigint").alias("batch_id"),
                        S.PARTITION_COLUMN))

    def clean(self) -> DataFrame:
        """Every cleaned row, also those the table refused (CSV backup, S11)."""
        return (self.resolved.where(F.col("outcome").isin(
            OUTCOME_INSERTED, OUTCOME_DUPLICATE, "already_written"))
            .select(*S.STORE_COLUMNS, S.PARTITION_COLUMN))

    def dlq(self) -> DataFrame:
        return dlq_rows(self.resolved.where(F.col("reason").isNotNull()),
                        self.query_id, self.batch_id)

    def metrics(self) -> DataFrame:
        return ingest_metrics(self.resolved)


def ingest(validated: DataFrame, order_cols, scope_cols=(), target: DataFrame | None = None,
           query_id: str | None = None, batch_id: int | None = None,
           allowed_months=None, incoming_rows_bound: int | None = None) -> IngestResult:
    """Classify validated events (see :mod:`tillflow.operators.validate`).

    ``order_cols`` give arrival order inside a key (unique among a key's valid
    rows), ``scope_cols`` the dedupe scope (empty = the whole input is one
    batch).  ``target`` is the stored table for the insert-if-absent split;
    without it every clean row is new.  With scopes, rows of one table key that
    survive in several scopes meet the unique rule among themselves too: the first
    by (scope, arrival) is the one that may be inserted, the rest are duplicates.
    One pass: one shuffle for the first-row aggregate (all rows), plus joins of
    the clean rows alone where there are scopes or a target.
    """
    classified = classify(validated, order_cols, scope_cols, allowed_months)
    return resolve(classified, order_cols, scope_cols, target, query_id, batch_id, incoming_rows_bound)


def classify(validated: DataFrame, order_cols, scope_cols=(), allowed_months=None) -> DataFrame:
    """Deduped and cleaned rows with their outcome, before they meet the table."""
    return clean_events(route_and_dedupe(validated, order_cols, S.PAIR_KEY, scope_cols), allowed_months)


def resolve(classified: DataFrame, order_cols, scope_cols=(), target: DataFrame | None = None,
            query_id: str | None = None, batch_id: int | None = None,
            incoming_rows_bound: int | None = None) -> IngestResult:
    """Insert-if-absent of :func:`classify`'s rows.  With a target they are read up to three times: store them."""
    o = F.col("outcome")
    if scope_cols:
        flagged = first_in_input(classified.where(o == S.OUTCOME_CLEAN), [*scope_cols, *order_cols])
        later = F.when(~F.col("_first"), F.lit(OUTCOME_DUPLICATE)).otherwise(o)
        classified = (flagged.withColumn("outcome", later).drop("_first")
                      .unionByName(classified.where(o != S.OUTCOME_CLEAN)))
    if target is None:
        marked = classified.withColumn(
            "outcome", F.when(o == S.OUTCOME_CLEAN, F.lit(OUTCOME_INSERTED)).otherwise(o))
    else:
        marked = mark_present(classified, target, S.TRIPLE_KEY, incoming_rows_bound,
                              query_id, batch_id)
    if target is not None or scope_cols:
        dup = o == OUTCOME_DUPLICATE
        marked = marked.select(
            *[c for c in marked.columns if c not in ("reason", "error", "data")],
            F.when(dup, F.lit(S.REASON_DUPLICATE)).otherwise(F.col("reason")).alias("reason"),
            F.when(dup, F.lit(S.REASON_DUPLICATE)).otherwise(F.col("error")).alias("error"),
            F.when(dup, stored_record_json()).otherwise(F.col("data")).alias("data"))
    return IngestResult(marked.select(*RESOLVED_COLUMNS), query_id, batch_id)
