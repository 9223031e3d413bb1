"""The dashboard as a stream.  Instead of re-running five queries every
30 seconds over the whole table, a stream over the table's files keeps the
aggregates incrementally (complete mode: state is one row per group) and
refreshes on a processing-time trigger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillflow import schema as S
from tillflow.functions.scalar import anchor_now
from tillflow.operators import aggregates as A
from tillflow.operators.window import time_window

REFRESH = "30 seconds"


def table_stream(spark: SparkSession, table_path: str) -> DataFrame:
    schema = spark.read.parquet(table_path).schema
    return spark.readStream.schema(schema).parquet(table_path)


def dashboard_streams(frame: DataFrame, n: int = A.TOP_N) -> dict[str, DataFrame]:
    """Streaming versions of A1-A5 over the dashboard frame (the all-time
    view; for a moving window see start_windowed_dashboard)."""
    return {
        "kpi": A.kpi(frame),
        "top_products": A.top_products(frame, n),
        "hourly_revenue": A.hourly_revenue(frame),
        "country_sales": A.country_sales(frame, n).withColumnRenamed("_sales", "sales"),
        "category_sales": A.category_sales(frame, n),
    }


#: Of each answer the column that names its rows, and its measures.
PANELS = {
    "kpi": (None, ["total_sales", "total_transactions", "avg_transaction_value"]),
    "top_products": ("description", ["quantity"]),
    "hourly_revenue": ("hour", ["revenue"]),
    "country_sales": ("country", ["sales"]),
    "category_sales": ("category", ["revenue"]),
}


def start_dashboard(spark: SparkSession, table_path: str, checkpoint_root: str,
                    sink: str = "memory", processing_time: str = REFRESH,
                    available_now: bool = False, out: str | None = None):
    """Start one complete-mode query per aggregate; a restart takes up its state from the checkpoint.

    ``sink="memory"`` is for tests; with ``sink="parquet"`` every refresh replaces the answer's few rows in
    ``out/<name>``; any other sink must accept complete mode."""
    frame = A.dashboard_frame(table_stream(spark, table_path))
    queries = {}
    for name, agg in dashboard_streams(frame).items():
        w = agg.writeStream.outputMode("complete").option("checkpointLocation", f"{checkpoint_root}/{name}")
        if sink == "parquet":
            w = w.foreachBatch(_replace(f"{out}/{name}"))
        else:
            w = w.format(sink)
        if sink == "memory":
            w = w.queryName(f"dash_{name}")
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
        queries[name] = w.start()
    return queries


def _replace(path: str):
    """Each refresh is the whole answer (complete mode), at most a few dozen rows."""
    def write(answer: DataFrame, _: int) -> None:
        answer.coalesce(1).write.mode("overwrite").parquet(path)
    return write


def start_windowed_dashboard(spark: SparkSession, table_path: str, checkpoint: str, duration: str, on_refresh,
                             now=None, processing_time: str = REFRESH, available_now: bool = False):
    """T7 for a chosen duration: new files of the table are the tick, and every
    tick answers the questions over the window that ends now.

    The window moves, so nothing incremental can be kept: each refresh reads
    the table pruned to the window's months and times (five columns).
    ``on_refresh(frames, batch_id)`` gets the batch frames by name; ``now`` is a
    function that gives the time a refresh is for."""
    clock = now or anchor_now

    def refresh(_: DataFrame, batch_id: int) -> None:
        rows = time_window(spark.read.parquet(table_path), duration, clock(), "InvoiceDate", S.PARTITION_COLUMN)
        frame = A.dashboard_frame(rows)
        on_refresh({"kpi": A.kpi(frame), "top_products": A.top_products(frame), "hourly_revenue": A.hourly_revenue(frame),
                    "country_share": A.country_share(frame), "category_sales": A.category_sales(frame)}, batch_id)

    writer = (table_stream(spark, table_path).select(S.PARTITION_COLUMN).writeStream.foreachBatch(refresh)
              .option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)).start()


def country_share_from(sales: DataFrame) -> DataFrame:
    """W1 over the (at most n rows) streamed country table."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    total = F.sum("sales").over(Window.partitionBy())
    return sales.select("country", F.col("sales").cast("double").alias("sales"),
                        (F.lit(100.0) * F.col("sales").cast("double") / total.cast("double"))
                        .alias("share_pct"))


__all__ = ["table_stream", "dashboard_streams", "start_dashboard", "start_windowed_dashboard", "country_share_from", "S"]
