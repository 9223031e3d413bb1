"""Dashboard time window (P12-P14, S5): inclusive bounds as literals, so
the filter reaches the Parquet scan; on a month-partitioned table the
matching month range is added so whole partitions are pruned."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.functions.scalar import month_text, window_bounds


def ntz_literal(t: dt.datetime) -> F.Column:
    """A zone-free timestamp literal (built from text, so the Python
    process time zone never shifts it)."""
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def time_window(df: DataFrame, duration: str, now: dt.datetime,
                ts_col: str = "InvoiceDate", month_col: str | None = None) -> DataFrame:
    """Rows with ``lower <= ts <= now``; "All time" keeps every row."""
    bounds = window_bounds(duration, now)
    if bounds is None:
        return df
    lo, hi = bounds
    cond = (F.col(ts_col) >= ntz_literal(lo)) & (F.col(ts_col) <= ntz_literal(hi))
    if month_col:
        cond = cond & F.col(month_col).between(month_text(lo), month_text(hi))
    return df.where(cond)


def coerce_timestamp(df: DataFrame, col: str = "invoicedate") -> DataFrame:
    """Query-side coercion; text that does not parse becomes NULL."""
    dtype = df.schema[col].dataType.simpleString()
    if dtype.startswith("timestamp"):
        return df
    return df.withColumn(col, F.try_to_timestamp(F.col(col).cast("string")).cast("timestamp_ntz"))
