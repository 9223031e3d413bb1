"""Dead-letter rows (S9/S10) and the union of reject kinds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow import schema as S
from tillflow.functions.scalar import iso_timestamp_text, row_to_json


def stored_record_json() -> F.Column:
    """The nine-field record of a refused insert: ISO ``T`` timestamp and
    money as floats, as the duplicate entries of the sample log show."""
    return row_to_json(
        "InvoiceNo", "StockCode", "Description", "Quantity",
        iso_timestamp_text("InvoiceDate").alias("InvoiceDate"),
        F.col("UnitPrice").cast("double").alias("UnitPrice"),
        "CustomerID", "Country",
        F.col("TotalAmount").cast("double").alias("TotalAmount"))


def dlq_rows(df: DataFrame, query_id=None, batch_id=None) -> DataFrame:
    """Project rejects onto the dead-letter shape (``error, reason, data,
    query_id, batch_id``); ``df`` must carry reason/error/data."""
    return df.select(
        F.col("error").cast("string"), F.col("reason").cast("string"),
        F.col("data").cast("string"),
        F.lit(query_id).cast("string").alias("query_id"),
        F.lit(batch_id).cast("bigint").alias("batch_id"))


def envelope_json() -> F.Column:
    """The topic message ``{"error": .., "data": {..}}`` (S9).  Text that is not
    JSON (a malformed message) travels as a JSON string."""
    parsed = F.try_parse_json(F.col("data"))
    text = F.parse_json(F.to_json(F.array(F.col("data"))))
    data = F.coalesce(parsed, F.variant_get(text, "$[0]", "variant"))
    return F.to_json(F.struct(F.col("error"), data.alias("data")), {"ignoreNullFields": "false"})
