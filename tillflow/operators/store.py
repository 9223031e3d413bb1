"""Keyed writes: insert-if-absent (J1/S8) and keep-last upsert.

Both avoid broadcasting or shuffling the big target when the incoming side
has a proven bound: the caller passes ``incoming_rows_bound`` (a micro-batch
counted after it was stored, or ``maxOffsetsPerTrigger``).  Without a
bound nothing is hinted and Spark picks the join from statistics, with AQE
switching to a broadcast at run time only when the measured side is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow import schema as S
from tillflow.session import stored, stored_while

# Largest incoming side (rows) we broadcast on purpose: a few key columns
# per row keeps this well under the default 8 GB broadcast limit.
BROADCAST_MAX_ROWS = 2_000_000
# Largest change set (bytes) an upsert broadcasts: descriptions as measured, and for the other
# columns of a row, whose lengths the schema limits, a fixed allowance.
BROADCAST_MAX_BYTES = 256 << 20
CHANGE_ROW_BYTES = 600

OUTCOME_INSERTED = "inserted"
OUTCOME_DUPLICATE = S.REASON_DUPLICATE
OUTCOME_ALREADY = "already_written"


def _bounded(rows_bound) -> bool:
    return rows_bound is not None and rows_bound <= BROADCAST_MAX_ROWS


def first_in_input(clean: DataFrame, order_cols, key=S.TRIPLE_KEY, flag: str = "_first") -> DataFrame:
    """``clean`` with a flag on the first row (by ``order_cols``) of each key.

    Needed where an input has several dedupe scopes: rows of one table key that
    survive in different scopes meet the table's unique rule among themselves.
    The first position per key is an aggregate (combined map-side), joined back.
    """
    place = F.struct(*[F.col(c) for c in order_cols])
    first = clean.groupBy(*key).agg(F.min(place).alias("_place"))
    return (clean.join(first, on=list(key), how="left")
            .withColumn(flag, F.struct(*[F.col(c) for c in order_cols]) == F.col("_place"))
            .drop("_place"))


def _present(candidates: DataFrame, target: DataFrame, key, bounded: bool, same) -> DataFrame:
    """(key, _same) of the target keys that a batch row may hold.

    Unbounded: one aggregate of the target on the key, joined once.  Bounded: a
    semi join with the broadcast batch keys first, so the target is only
    scanned; the month column is part of the key so partition pruning applies.
    """
    month = S.PARTITION_COLUMN
    lineage = [c for c in ("query_id", "batch_id") if c in target.columns]
    rows = target.select(*key, month, *lineage)
    if bounded:
        rows = rows.join(F.broadcast(candidates.select(*key, month)), on=[*key, month], how="left_semi")
    hits = rows.groupBy(*key).agg(F.max(same.cast("int")).alias("_same"))
    return F.broadcast(hits) if bounded else hits


def mark_present(batch: DataFrame, target: DataFrame, key=S.TRIPLE_KEY,
                 incoming_rows_bound: int | None = None,
                 query_id: str | None = None, batch_id: int | None = None) -> DataFrame:
    """Tag batch rows ``inserted``, ``Duplicate`` or ``already_written``.

    A key that the target holds from this very query and batch id is a replay
    of a batch that failed after its append, so it counts as written, not as a
    duplicate.  When ``batch`` already has an ``outcome`` column only its
    ``clean`` rows take part in the join; the others (whose keys may all be
    null) go around it with their outcome.
    """
    classified = "outcome" in batch.columns
    candidates = batch.where(F.col("outcome") == S.OUTCOME_CLEAN) if classified else batch
    same = F.lit(False)
    if query_id is not None and "query_id" in target.columns:
        same = ((F.col("query_id") == F.lit(query_id))
                & (F.col("batch_id") == F.lit(batch_id)))
    hits = _present(candidates, target, key, _bounded(incoming_rows_bound), same)
    tag = (F.when(F.col("_same").isNull(), F.lit(OUTCOME_INSERTED))
           .when(F.col("_same") == 1, F.lit(OUTCOME_ALREADY))
           .otherwise(F.lit(OUTCOME_DUPLICATE)))
    rest = [c for c in batch.columns if c != "outcome"]
    marked = candidates.join(hits, on=list(key), how="left").select(*rest, tag.alias("outcome"))
    if not classified:
        return marked
    return marked.unionByName(batch.where(F.col("outcome") != S.OUTCOME_CLEAN).select(*rest, "outcome"))


def insert_if_absent(batch: DataFrame, target: DataFrame, key=S.TRIPLE_KEY,
                     incoming_rows_bound: int | None = None):
    """(rows to append, rows already present)."""
    marked = mark_present(batch, target, key, incoming_rows_bound)
    return (marked.where(F.col("outcome") == OUTCOME_INSERTED).drop("outcome"),
            marked.where(F.col("outcome") == OUTCOME_DUPLICATE).drop("outcome"))


# Columns an upsert overwrites; the others keep the value of the row that
# first created the key.
UPSERT_SET = ["Description", "Quantity", "UnitPrice", "TotalAmount"]
UPSERT_KEEP = ["InvoiceDate", "CustomerID", "Country"]


def change_set(incoming: DataFrame, order_cols, key=S.PAIR_KEY) -> DataFrame:
    """One row per key of ``incoming``: ``_keep``, the kept columns of its first row in arrival
    order, and ``_set``, the updated columns of its last.  Ties in arrival order are decided by
    the rows' values.  An aggregate, so a hot key is reduced inside every map task."""
    place = F.struct(*[F.col(c) for c in order_cols])
    # place and value hold every column needed, so the first and the last of them are all an aggregate has to carry
    row = F.struct(place.alias("place"), F.struct(*[c for c in S.STORE_COLUMNS if c not in key]).alias("value"))
    pick = lambda end, cols: F.struct(*[F.col(c) if c in key else F.col(f"{end}.value.{c}").alias(c) for c in cols])
    return (incoming.select(*S.STORE_COLUMNS, *order_cols).groupBy(*key)
            .agg(F.min(row).alias("_first_row"), F.max(row).alias("_last_row"))
            .select(*key, pick("_first_row", UPSERT_KEEP).alias("_keep"), pick("_last_row", UPSERT_SET).alias("_set")))


def _fits_broadcast(change: DataFrame) -> bool:
    """Whether the (stored) change set is small enough in bytes, by measuring it."""
    texts = F.coalesce(F.octet_length("_set.Description"), F.lit(0)) + F.lit(CHANGE_ROW_BYTES)
    return (change.agg(F.sum(texts)).first()[0] or 0) <= BROADCAST_MAX_BYTES


def find_first(target: DataFrame, change: DataFrame, key=S.PAIR_KEY, keep=(), broadcast: bool = False) -> DataFrame:
    """Of each changed key that ``target`` holds, its earliest InvoiceDate ``_first`` (and that row's ``keep`` columns).

    The target is reduced to the changed keys before it is grouped, and read in the key columns only."""
    keys = change.select(*key)
    rows = target.select(*key, "InvoiceDate", *keep).join(F.broadcast(keys) if broadcast else keys, list(key), "left_semi")
    return rows.groupBy(*key).agg(F.min("InvoiceDate").alias("_first"),
                                  *[F.min_by(c, "InvoiceDate").alias(f"_{c}") for c in keep])


def apply_changes(rows: DataFrame, plan: DataFrame, key=S.PAIR_KEY, broadcast: bool = False) -> DataFrame:
    """``rows`` with the updated columns of ``plan`` (change set with ``_first``) in each key's first row."""
    side = plan.where(F.col("_first").isNotNull()).select(*key, "_first", "_set")
    joined = rows.join(F.broadcast(side) if broadcast else side, list(key), "left")
    hit = F.col("InvoiceDate") == F.col("_first")
    return joined.select(*[F.when(hit, F.col(f"_set.{c}")).otherwise(F.col(c)).alias(c) if c in UPSERT_SET else F.col(c)
                           for c in rows.columns])


def new_rows(plan: DataFrame, key=S.PAIR_KEY) -> DataFrame:
    """The rows of keys that the target lacks: kept columns of the first incoming row, updated ones of the last."""
    return plan.where(F.col("_first").isNull()).select(*key, "_keep.*", "_set.*").select(*S.STORE_COLUMNS)


def upsert_latest(target: DataFrame, incoming: DataFrame, order_cols,
                  key=S.PAIR_KEY, incoming_rows_bound: int | None = None) -> DataFrame:
    """Apply incoming rows in arrival order as ``INSERT .. ON CONFLICT
    (pair) DO UPDATE SET Description, Quantity, UnitPrice, TotalAmount``.

    Which rows change: a key that the target lacks gets one new row, with the
    kept columns of its first and the updated ones of its last incoming row.
    Of a key that the target holds, the row with the earliest InvoiceDate gets
    the updated columns of the last incoming row; rows of the key at other
    times, and rows of other keys, stay as they are.

    The change set and the first rows it meets are stored (one row a changed key), so the
    incoming side is computed once and the target read twice: its key columns to find
    the first rows, then whole, in one join.
    With a row bound, and if the measured change set is also small in bytes, it is
    broadcast and the target isn't shuffled; the result is the same.
    """
    with stored_while(change_set(incoming, order_cols, key), "changes") as change:
        small = _bounded(incoming_rows_bound) and _fits_broadcast(change)
        plan = stored(change.join(find_first(target, change, key, broadcast=small), list(key), "left"), "changes", "orc")
    rows = apply_changes(target.select(*S.STORE_COLUMNS), plan, key, small)
    return rows.unionByName(new_rows(plan, key))
