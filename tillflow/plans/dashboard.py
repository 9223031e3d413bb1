"""Dashboard plan (S4/S5 + A1-A5, W1): one time window, five answers."""

from __future__ import annotations

import datetime as dt

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from tillflow import schema as S
from tillflow.operators import aggregates as A
from tillflow.operators.window import time_window


def read_sales(table: DataFrame, duration: str, now: dt.datetime,
               partitioned: bool = True) -> DataFrame:
    """The five dashboard columns for the chosen window.  On the
    month-partitioned table the month range is added so the scan prunes
    partitions; the timestamp bounds go to the Parquet reader as pushed
    filters (row-group min/max skipping, files are sorted by time)."""
    month_col = S.PARTITION_COLUMN if partitioned and S.PARTITION_COLUMN in table.columns else None
    return A.dashboard_frame(time_window(table, duration, now, "InvoiceDate", month_col))


def dashboard(table: DataFrame, duration: str, now: dt.datetime, n: int = A.TOP_N,
              cache: bool = False) -> dict[str, DataFrame]:
    """All five dashboard results for one window.  With ``cache`` the
    windowed frame is persisted (the reference's client-side cache) because
    five aggregates scan it; call :func:`release` afterwards."""
    frame = read_sales(table, duration, now)
    if cache:
        frame = frame.persist(StorageLevel.MEMORY_AND_DISK)
    return {
        "kpi": A.kpi(frame),
        "top_products": A.top_products(frame, n),
        "hourly_revenue": A.hourly_revenue(frame),
        "country_share": A.country_share(frame, n),
        "category_sales": A.category_sales(frame, n),
        "_frame": frame,
    }


def release(results: dict[str, DataFrame]) -> None:
    frame = results.get("_frame")
    if frame is not None:
        frame.unpersist()
