"""Message-topic and JDBC connectors as option-level wrappers.

The Kafka and JDBC data sources need their jars (and a broker or database)
at run time; these functions only assemble the reader/writer so a deployment
with the connector on the class path runs the same plan.  Tests use the
JSON-lines stand-ins in :mod:`tillflow.sources.files`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow import schema as S
from tillflow.functions.scalar import row_to_json


def read_topic_stream(spark: SparkSession, servers: str, topic: str,
                      max_offsets_per_trigger: int | None = None,
                      starting_offsets: str = "earliest") -> DataFrame:
    """Subscribe from the earliest offset; offsets live in the stream
    checkpoint (T3), so a restart resumes exactly where the last committed
    micro-batch ended.  ``partition``/``offset`` give the arrival order."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load().select(F.col("value").cast("string").alias("value"),
                                "partition", "offset")


def write_topic(df: DataFrame, servers: str, topic: str) -> None:
    """One JSON object per row to a topic."""
    (df.select(F.col("value").cast("binary").alias("value"))
     .write.format("kafka").option("kafka.bootstrap.servers", servers)
     .option("topic", topic).save())


def events_to_topic(events: DataFrame, servers: str, topic: str) -> None:
    """Replay producer (S1 -> S7) as one batch job; the pacing is dropped."""
    write_topic(events.select(row_to_json(*S.WIRE_NAMES).alias("value")), servers, topic)


def read_jdbc(spark: SparkSession, url: str, table: str, props: dict,
              partition_column: str | None = None, lower=None, upper=None,
              num_partitions: int | None = None) -> DataFrame:
    """Table read; with bounds the read splits into parallel range scans."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in props.items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower)).option("upperBound", str(upper))
                  .option("numPartitions", str(num_partitions or 8)))
    return reader.load()


def append_jdbc(batch: DataFrame, url: str, table: str, props: dict) -> None:
    """Append one micro-batch; errors propagate so the batch is retried
    instead of being committed as done."""
    writer = batch.write.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in props.items():
        writer = writer.option(k, v)
    writer.mode("append").save()
