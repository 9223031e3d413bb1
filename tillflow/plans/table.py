"""Month-partitioned table management."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow import schema as S
from tillflow.session import freed_shuffles

TABLE_PREFIX = "online_retail_"


def month_partitions(df: DataFrame, ts_col: str = "InvoiceDate",
                     prefix: str = TABLE_PREFIX) -> DataFrame:
    """One row per month over the half-open range [first month of the
    data, month after the last) -> (partition_name, range_from, range_to).

    The range comes from one global min/max aggregate; the months are then
    generated by ``sequence`` + ``explode`` (no driver loop)."""
    bounds = df.agg(F.min(ts_col).alias("_lo"), F.max(ts_col).alias("_hi"))
    start = F.trunc(F.col("_lo").cast("date"), "month")
    end = F.add_months(F.trunc(F.col("_hi").cast("date"), "month"), 1)
    return month_range(bounds.select(start.alias("start"), end.alias("end")), prefix)


def month_range(bounds: DataFrame, prefix: str = TABLE_PREFIX) -> DataFrame:
    """D1 for given ``start``/``end`` date columns (end exclusive)."""
    months = bounds.where(F.col("start") < F.col("end")).select(F.explode(F.sequence(
        F.col("start"), F.add_months(F.col("end"), -1),
        F.expr("INTERVAL 1 MONTH"))).alias("range_from"))
    return months.select(
        F.concat(F.lit(prefix), F.date_format("range_from", "yyyy_MM")).alias("partition_name"),
        F.col("range_from"),
        F.add_months("range_from", 1).alias("range_to"))


def month_rows(stored: DataFrame) -> DataFrame:
    """Rows routed to each month partition."""
    return (stored.groupBy(S.PARTITION_COLUMN)
            .agg(F.count(F.lit(1)).alias("n_rows")))


def unique_violations(df: DataFrame, key=S.TRIPLE_KEY) -> DataFrame:
    """Keys held by more than one row (must be empty for the table)."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"))
            .where(F.col("copies") > 1))


def create_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    """D3: keyed, month-partitioned Parquet table (idempotent)."""
    cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.STORE_SCHEMA.fields)
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}, query_id string, batch_id bigint, "
              f"{S.PARTITION_COLUMN} string) USING parquet PARTITIONED BY ({S.PARTITION_COLUMN}){loc}")


def create_keyed_table(spark: SparkSession, name: str, buckets: int, location: str | None = None) -> None:
    """D3: the table of :func:`create_table` in a keyed layout: bucketed and sorted on the unique key
    (InvoiceNo, StockCode, InvoiceDate) inside each month (idempotent).

    A join on that key reads each bucket of all months as one task and needs no shuffle of the
    table.  ``buckets`` should leave a bucket of all months together a few hundred MB."""
    cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.STORE_SCHEMA.fields)
    key = ", ".join(S.TRIPLE_KEY)
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}, query_id string, batch_id bigint, "
              f"{S.PARTITION_COLUMN} string) USING parquet PARTITIONED BY ({S.PARTITION_COLUMN}) "
              f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS{loc}")


def table_buckets(spark: SparkSession, name: str) -> int:
    """Buckets that a keyed table was created with."""
    said = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where(F.col("col_name") == "Num Buckets").first()
    if said is None:
        raise ValueError(f"{name} isn't a keyed table")
    return int(said["data_type"])


def append_keyed(spark: SparkSession, name: str, stored: DataFrame) -> None:
    """Append rows to a keyed table: one file for each month and bucket that gets any.

    Rows are dealt out by the key exactly as the buckets are, so a hot month spreads
    over all tasks and every task writes its own bucket."""
    with freed_shuffles(spark):
        (stored.select(*S.TABLE_COLUMNS).repartition(table_buckets(spark, name), *S.TRIPLE_KEY)
         .write.mode("append").insertInto(name))


def register_partitions(spark: SparkSession, name: str) -> None:
    """Make months that were written by path visible through the table's name."""
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.catalog.refreshTable(name)


def swap_tables(spark: SparkSession, old: str, new: str, archive: str) -> None:
    """Old -> archive, new -> old."""
    spark.sql(f"ALTER TABLE {old} RENAME TO {archive}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {old}")


def publish(spark: SparkSession, view: str, table: str) -> None:
    """D4 as readers see it: ``view`` shows ``table`` from now on.

    Replacing a view is one change of the catalog, so a reader by the view's name finds the old table or the
    new one, never none (between the two renames of :func:`swap_tables` there is no table of the old name)."""
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {table}")


def layout_for_write(stored: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Range-partition by (month, time) before a partitioned write.

    Hash-partitioning by the month alone would put a hot month (one third
    of all rows) into one task; a range partitioning on (month, time)
    samples the data and cuts a large month into several tasks, each writing
    files sorted by time, so row-group min/max statistics make time-range
    reads inside a month cheap (the B-tree index on InvoiceDate becomes
    clustering)."""
    if num_partitions:
        out = stored.repartitionByRange(num_partitions, S.PARTITION_COLUMN, "InvoiceDate")
    else:
        out = stored.repartitionByRange(S.PARTITION_COLUMN, "InvoiceDate")
    return out.sortWithinPartitions(S.PARTITION_COLUMN, "InvoiceDate")


def write_partitioned(stored: DataFrame, path: str, mode: str = "append",
                      num_partitions: int | None = None, laid_out: bool = False) -> None:
    """Bulk copy into the month-partitioned table.

    ``laid_out`` rows come from the scan of such a table: its splits hold few months each and cut a hot month up, so
    every task sorts and writes what it read, and nothing is shuffled."""
    rows = stored.select(*S.TABLE_COLUMNS)
    laid = rows.sortWithinPartitions(S.PARTITION_COLUMN, "InvoiceDate") if laid_out else layout_for_write(rows, num_partitions)
    with freed_shuffles(stored.sparkSession):
        laid.write.mode(mode).partitionBy(S.PARTITION_COLUMN).parquet(path)
