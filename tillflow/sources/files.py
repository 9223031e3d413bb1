"""File connectors: replay CSV (S1), JSON-lines messages (S7 and the topic
stand-in for S2/S3), and the append-only cleaned-row backup (S11/S14)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow import schema as S
from tillflow.functions.scalar import row_to_json

MESSAGE_SCHEMA = T.StructType([T.StructField("value", T.StringType(), True)])


# Cell texts that the reference's CSV reader takes for null.
NULL_CELLS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
              "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def read_event_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Replay CSV with its unnamed index column dropped.

    The schema is explicit (no inference pass over the data); the header row
    is skipped, so the empty index header does not matter.  A quote inside a quoted
    cell is doubled.  Files split by byte range across tasks; with ``multi_line``
    cells may hold line breaks, and a file is then read by one task.
    """
    rows = (spark.read.schema(S.CSV_SCHEMA)
            .option("header", True).option("mode", "PERMISSIVE")
            .option("quote", '"').option("escape", '"').option("multiLine", multi_line)
            .csv(path)
            .drop(S.CSV_INDEX_COLUMN))
    texts = {n for n, kind in S.WIRE_FIELDS if kind == "str"}
    return rows.select(*[F.when(~F.col(c).isin(NULL_CELLS), F.col(c)).alias(c) if c in texts else F.col(c)
                         for c in rows.columns])


def write_event_csv(events: DataFrame, path: str) -> None:
    """The replay CSV's form: an index column without a name, then the eight fields."""
    (events.select(F.monotonically_increasing_id().alias(S.CSV_INDEX_COLUMN), *S.WIRE_NAMES)
     .write.option("header", True).option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def to_messages(events: DataFrame, extra_cols=()) -> DataFrame:
    """One JSON object per event, nulls kept, in a ``value`` column."""
    return events.select(row_to_json(*S.WIRE_NAMES).alias("value"), *extra_cols)


def write_messages(messages: DataFrame, path: str, mode: str = "append") -> None:
    """S7 stand-in for a topic: JSON-lines text files."""
    messages.select("value").write.mode(mode).text(path)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MESSAGE_SCHEMA).text(path)


def read_messages_in_order(spark: SparkSession, path: str) -> DataFrame:
    """Messages of JSON-lines files with their place: ``source_file``, ``block_start`` (a large file is
    read in blocks) and ``line``, which rises within a block.  Sorted by these three, the lines have the order of
    the files' names and of the lines in each file."""
    return (spark.read.schema(MESSAGE_SCHEMA).text(path)
            .select("value", F.col("_metadata.file_path").alias("source_file"),
                    F.col("_metadata.file_block_start").alias("block_start"),
                    F.monotonically_increasing_id().alias("line")))


def read_messages_stream(spark: SparkSession, path: str,
                         max_files_per_trigger: int | None = None) -> DataFrame:
    """S2/S3 stand-in: a stream of JSON-lines files (one message per line).

    The file source reports which file a line came from; together with the
    line's position that is the arrival order the dedupe needs.
    """
    reader = spark.readStream.schema(MESSAGE_SCHEMA).format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return (reader.load(path)
            .withColumn("source_file", F.col("_metadata.file_path"))
            .withColumn("source_mtime", F.col("_metadata.file_modification_time")))


# Cells as they are: outer blanks kept, a quote inside a quoted cell doubled, as the reference's CSV writer does.
_PLAIN_CELLS = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_backup_csv(clean: DataFrame, path: str, query_id: str | None, batch_id: int | None) -> None:
    """Every cleaned row as CSV without a header.  Each batch has a folder
    of its own, which a replay of the batch replaces."""
    (clean.select(*S.STORE_COLUMNS)
     .withColumn("InvoiceDate", F.date_format("InvoiceDate", S.WIRE_TS_FORMAT))
     .write.mode("overwrite").option("header", False).options(**_PLAIN_CELLS)
     .csv(f"{path}/query_id={query_id}/batch_id={batch_id}"))


def csv_stream_sink(stream: DataFrame, path: str, checkpoint: str, compression: str = "none"):
    """Streaming CSV sink with a header, append mode."""
    return (stream.writeStream.format("csv").option("header", True).options(**_PLAIN_CELLS).option("compression", compression)
            .option("path", path).option("checkpointLocation", checkpoint)
            .outputMode("append"))


def read_csv_sink(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`csv_stream_sink` has committed, as stored rows.  Spark reads a stream's output through the
    sink's log, so files of attempts that never committed are left out."""
    return spark.read.schema(S.STORE_SCHEMA).option("header", True).options(**_PLAIN_CELLS).csv(path).select(*S.STORE_COLUMNS)
