"""Batches of N valid records, by a running count that no single task makes.

The valid records are range-partitioned by arrival and sorted inside each partition, so a
record's place inside its partition is its row index there. Counts per partition (one row each) are summed
up over the partitions before, and the place plus that sum is the record's
position in the whole feed. The partitioned rows are stored first: range bounds are
sampled, and a second evaluation could draw them elsewhere. They are stored as Parquet in the shared
checkpoint folder, whose columns are compressed, and so is what comes in: the sample, the rows
and the invalid records all read it, and it is parsed once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillflow.session import stored

# Records in one batch of the reference's consumer.
BATCH_RECORDS = 5
# monotonically_increasing_id holds the row index in its lower bits.
_INDEX_BITS = 33


def number_rows(rows: DataFrame, order_cols, position: str = "position") -> DataFrame:
    """``rows`` with their position (from 0) in the order of ``order_cols``.

    Nulls come first; rows that tie are numbered in some order. One shuffle, and a broadcast of
    one row a partition. An empty input gives no rows.
    """
    index, start, part = "_index", "_start", "_part"
    placed = stored(rows.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)
                    .withColumn(index, F.monotonically_increasing_id()), "batches")
    own = F.shiftright(F.col(index), _INDEX_BITS)
    counts = placed.groupBy(own.alias(part)).agg(F.count(F.lit(1)).alias("_rows"))
    # The window without a key sees one row a partition.
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(part, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias(start))
    local = F.col(index).bitwiseAND(F.lit((1 << _INDEX_BITS) - 1))
    return (placed.withColumn(part, own).join(F.broadcast(starts), part, "left")
            .select(*rows.columns, (F.col(start) + local).alias(position)))


def valid_batches(validated: DataFrame, order_cols, size: int = BATCH_RECORDS,
                  batch: str = "batch", position: str = "position") -> DataFrame:
    """Validated events with the number of the batch that each valid one falls into.

    A batch closes after ``size`` valid records in arrival order, whatever invalid ones lie
    between; the last may be smaller. Invalid records have a null batch and position. Give ``batch``
    to ``ingest`` as its scope. The message text (``raw``) is kept for invalid records only.
    """
    if "raw" in validated.columns:
        validated = validated.withColumn("raw", F.when(F.col("reason").isNotNull(), F.col("raw")))
    validated = stored(validated, "batches")
    valid = number_rows(validated.where(F.col("reason").isNull()), order_cols, position)
    none = F.lit(None).cast("bigint")
    return (valid.withColumn(batch, F.floor(F.col(position) / size).cast("bigint"))
            .unionByName(validated.where(F.col("reason").isNotNull())
                         .withColumn(position, none).withColumn(batch, none)))
