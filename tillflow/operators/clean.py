"""Cleaning chain: null drop (P5), first-row dedupe (A8), timestamp parse
(F1), sign filters (P6/P7), id text (F2), total (P9), store narrowing (P11),
month routing (D2).  Rows are classified, not dropped, so every outcome can
be counted and rejects routed to the dead-letter table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow import schema as S
from tillflow.functions.scalar import (
    customer_id_text, month_label, parse_invoice_ts,
)
from tillflow.operators.validate import fence, raw_record_json

GROUP_ROWS = "group_rows"


def mark_missing_ids(valid: DataFrame) -> DataFrame:
    """P5: CustomerID or InvoiceDate null (or NaN) -> outcome ``null_drop``."""
    cust = F.col("CustomerID")
    missing = cust.isNull() | F.isnan(cust) | F.col("InvoiceDate").isNull()
    return valid.withColumn(
        "outcome", F.when(missing, F.lit(S.OUTCOME_NULL_DROP)))


def first_per_key(df: DataFrame, order_cols, key=S.PAIR_KEY, scope_cols=(),
                  count_col: str = GROUP_ROWS, extra_group=()) -> DataFrame:
    """Keep the first row (by ``order_cols``) of each key within a scope.

    The smallest (order, row) as an aggregate rather than ``row_number`` over a window: the
    aggregate combines map-side, so a hot key that holds a large share of
    the rows is reduced inside every map task before the shuffle and no task
    ever sees the whole group.  ``count_col`` keeps the group size so the
    dropped duplicates can be counted.  The order columns travel once, as the place, not in
    the row too; rows that tie are decided by their values.
    """
    group = [*scope_cols, *key, *extra_group]
    out = [*scope_cols, *key]
    payload = [c for c in df.columns if c not in group]
    rest = [c for c in payload if c not in order_cols]
    row = F.struct(F.struct(*order_cols).alias("place"), F.struct(*rest).alias("rest"))
    first = F.col("_first")
    return (df.groupBy(*group)
            .agg(F.min(row).alias("_first"),
                 F.count(F.lit(1)).alias(count_col))
            .select(*out, *[first["rest" if c in rest else "place"][c].alias(c) for c in payload], count_col))


ROUTE_REJECT, ROUTE_DROP, ROUTE_KEEP = "reject", "drop", "keep"


def route_and_dedupe(validated: DataFrame, order_cols, key=S.PAIR_KEY,
                     scope_cols=()) -> DataFrame:
    """P4 + P5 + A8 in one aggregate, so the input is read once.

    Only valid rows are deduplicated: they group by (scope, key). A rejected
    or null-dropped row gets a row id of its own as an extra grouping value, so
    it is a group of one whatever its key and arrival order are, and passes
    through unchanged.  (Among valid rows arrival order decides, so it must be
    unique within a key: Kafka partition+offset, file+position, or the
    caller's columns.)  The raw text is kept for rejected rows only.
    """
    cust = F.col("CustomerID")
    missing = cust.isNull() | F.isnan(cust) | F.col("InvoiceDate").isNull()
    route = (F.when(F.col("reason").isNotNull(), F.lit(ROUTE_REJECT))
             .when(missing, F.lit(ROUTE_DROP)).otherwise(F.lit(ROUTE_KEEP)))
    staged = validated.select(
        *[c for c in validated.columns if c != "raw"],
        F.when(F.col("reason").isNotNull(), F.col("raw")).alias("raw"),
        route.alias("route"),
        F.when(route != ROUTE_KEEP, F.monotonically_increasing_id()).alias("_solo"))
    return first_per_key(staged, order_cols, key, scope_cols, extra_group=["_solo"])


def clean_events(df: DataFrame, allowed_months=None) -> DataFrame:
    """Type, check and classify rows.

    Output: the nine store columns (stored types), ``invoice_month``,
    ``outcome`` (``sign_drop``, ``bad_date``, ``store_reject``,
    ``no_partition`` or ``clean``; for routed input also the validation
    reasons and ``null_drop``), ``reason``/``error`` for dead-letter rows and
    their ``data`` JSON, plus every non-wire input column.
    """
    routed = "route" in df.columns
    keep = [c for c in df.columns if c not in S.WIRE_NAMES
            and c not in ("outcome", "reason", "error", "raw", "route")]
    # Outcome, month and table row all need the time: behind a fence the text isn't parsed anew at each
    # place that names it.
    df = df.select("*", F.inline(F.array(F.struct(parse_invoice_ts("InvoiceDate").alias("_at")))))
    ts = F.col("_at")
    qty, price = F.col("Quantity"), F.col("UnitPrice")
    sign_ok = (qty >= 0) & (price >= 0) & ~F.isnan(price)
    qty_int = qty.try_cast("int")
    price_dec = price.try_cast(S.MONEY)
    total_dec = (qty * price).try_cast(S.MONEY)
    checks = [
        (qty_int.isNull(), "Quantity:int_range"),
        (price_dec.isNull(), "UnitPrice:decimal_range"),
        (total_dec.isNull(), "TotalAmount:decimal_range"),
    ]
    cust_text = customer_id_text("CustomerID")
    for name, limit in S.VARCHAR_LIMITS.items():
        col = cust_text if name == "CustomerID" else F.col(name)
        checks.append((F.length(col) > limit, f"{name}:length"))
    store_bad = None
    for cond, _ in checks:
        store_bad = cond if store_bad is None else (store_bad | cond)
    month = month_label(ts)
    if allowed_months is not None:
        no_part = ~month.isin(list(allowed_months))
    else:
        no_part = F.lit(False)
    outcome = (F.when(~sign_ok, F.lit(S.OUTCOME_SIGN_DROP))
               .when(ts.isNull(), F.lit(S.REASON_BAD_DATE))
               .when(store_bad, F.lit(S.REASON_STORE))
               .when(no_part, F.lit(S.REASON_NO_PARTITION))
               .otherwise(F.lit(S.OUTCOME_CLEAN)))
    carried = []
    if routed:
        r = F.col("route")
        outcome = (F.when(r == ROUTE_REJECT,
                          F.when(F.col("reason") == S.REASON_MALFORMED, F.lit(S.REASON_MALFORMED))
                          .otherwise(F.lit(S.REASON_SCHEMA)))
                   .when(r == ROUTE_DROP, F.lit(S.OUTCOME_NULL_DROP))
                   .otherwise(outcome))
        carried = [F.col("error").alias("_err_in")]
    # Filters on the outcome and the keys' null checks of a join stay above this fence, so the outcome is worked
    # out once, and branches that take different rows share the shuffle below.
    staged = fence(df.select(
        *keep, *S.WIRE_NAMES, "raw", *carried,
        ts.alias("_ts"), qty_int.alias("_qty"), price_dec.alias("_price"),
        total_dec.alias("_total"), cust_text.alias("_cust"), month.alias("_month"),
        outcome.alias("outcome")))
    o = F.col("outcome")
    # Error text is built for refused rows only (and never inside a filter).
    store_err = F.concat_ws(";", *[F.when(c, F.lit(t)) for c, t in [
        (F.col("_qty").isNull(), "Quantity:int_range"),
        (F.col("_price").isNull(), "UnitPrice:decimal_range"),
        (F.col("_total").isNull(), "TotalAmount:decimal_range"),
        *[(F.length(F.col("_cust") if n == "CustomerID" else F.col(n)) > lim, f"{n}:length")
          for n, lim in S.VARCHAR_LIMITS.items()]]])
    dead = [S.REASON_BAD_DATE, S.REASON_STORE, S.REASON_NO_PARTITION]
    error = (F.when(o == S.REASON_BAD_DATE, F.lit("InvoiceDate:format"))
             .when(o == S.REASON_STORE, store_err)
             .when(o == S.REASON_NO_PARTITION, F.concat(F.lit("invoice_month:"), F.col("_month"))))
    if routed:
        dead += [S.REASON_MALFORMED, S.REASON_SCHEMA]
        error = error.when(o.isin(S.REASON_MALFORMED, S.REASON_SCHEMA), F.col("_err_in"))
    is_dead = o.isin(*dead)
    return staged.select(
        *keep,
        "InvoiceNo", "StockCode", "Description",
        F.col("_qty").alias("Quantity"), F.col("_ts").alias("InvoiceDate"),
        F.col("_price").alias("UnitPrice"), F.col("_cust").alias("CustomerID"),
        "Country", F.col("_total").alias("TotalAmount"),
        F.col("_month").alias(S.PARTITION_COLUMN),
        "outcome",
        F.when(is_dead, o).alias("reason"),
        error.alias("error"),
        F.when(is_dead, raw_record_json()).alias("data"),
    )
