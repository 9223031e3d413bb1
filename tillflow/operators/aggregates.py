"""Dashboard aggregates over the five-column frame.

All are partial + final hash aggregates; top-k is ``orderBy(..).limit(n)``
which plans as ``TakeOrderedAndProject`` (each task keeps its own top n, no
global sort).  Semantics follow the dashboard's pandas code: null grouping
keys are dropped, ties in a top-k go to the ascending key, and empty input
gives a defined KPI row of zeros.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillflow import schema as S
from tillflow.functions.scalar import first_word, hour_of_day

TOP_N = 10


def dashboard_frame(stored: DataFrame) -> DataFrame:
    """The five lower-case columns the dashboard reads."""
    return stored.select(*[F.col(src).alias(dst) for dst, src in S.DASHBOARD_COLUMNS.items()])


def _money_sum(c: str) -> F.Column:
    # Decimal sum is exact (order independent), then one rounding to double.
    return F.coalesce(F.sum(c), F.lit(0)).cast("double")


def kpi(df: DataFrame) -> DataFrame:
    """A1: total sales, row count ("transactions" counts rows), average."""
    total = F.coalesce(F.sum("totalamount"), F.lit(0)).cast("double")
    n = F.count(F.lit(1))
    return df.agg(total.alias("total_sales"), n.alias("total_transactions"),
                  F.when(n > 0, total / n).otherwise(F.lit(0.0)).alias("avg_transaction_value"))


def top_k(df: DataFrame, key: str, measure: str, n: int = TOP_N) -> DataFrame:
    """K1: largest n by measure, ties to the ascending key, nulls excluded."""
    return df.where(F.col(key).isNotNull()).orderBy(F.desc(measure), F.asc(key)).limit(n)


def top_products(df: DataFrame, n: int = TOP_N) -> DataFrame:
    """A2: quantity sold by description, top n."""
    agg = (df.where(F.col("description").isNotNull()).groupBy("description")
           .agg(F.coalesce(F.sum("quantity"), F.lit(0)).cast("bigint").alias("quantity")))
    return top_k(agg, "description", "quantity", n)


def hourly_revenue(df: DataFrame) -> DataFrame:
    """A3 + K2: revenue by hour of day (all days merged), hour ascending;
    hours without rows are absent."""
    return (df.where(F.col("invoicedate").isNotNull())
            .groupBy(hour_of_day("invoicedate").alias("hour"))
            .agg(_money_sum("totalamount").alias("revenue"))
            .orderBy("hour"))


def country_sales(df: DataFrame, n: int = TOP_N) -> DataFrame:
    """A4: revenue by country, top n."""
    agg = (df.where(F.col("country").isNotNull()).groupBy("country")
           .agg(F.coalesce(F.sum("totalamount"), F.lit(0)).alias("_sales")))
    return top_k(agg, "country", "_sales", n)


def country_share(df: DataFrame, n: int = TOP_N) -> DataFrame:
    """A4 + W1: each top-n country's share of the top-n total, in percent.

    The window has no partition key, but it runs after the limit, so its
    single partition holds at most n rows.
    """
    top = country_sales(df, n)
    total = F.sum("_sales").over(Window.partitionBy())
    return top.select(
        "country", F.col("_sales").cast("double").alias("sales"),
        (F.lit(100.0) * F.col("_sales").cast("double") / total.cast("double")).alias("share_pct"),
    ).orderBy(F.desc("sales"), F.asc("country"))


def category_sales(df: DataFrame, n: int = TOP_N) -> DataFrame:
    """A5: revenue by category (first word of the description), top n."""
    agg = (df.select(first_word("description").alias("category"), "totalamount")
           .where(F.col("category").isNotNull()).groupBy("category")
           .agg(_money_sum("totalamount").alias("revenue")))
    return top_k(agg, "category", "revenue", n)


def row_count(df: DataFrame) -> DataFrame:
    """A6."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))
