"""The one schema module: wire record, stored row, dead-letter row, reasons.

The reference declares the event schema three times (validation model,
streaming StructType and table DDL); every operator here reads it from this
module instead.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The eight wire fields of one retail event and the Python type
# the validator demands for each ("str", "int" or "float").
WIRE_FIELDS = [
    ("InvoiceNo", "str"),
    ("StockCode", "str"),
    ("Description", "str"),
    ("Quantity", "int"),
    ("InvoiceDate", "str"),
    ("UnitPrice", "float"),
    ("CustomerID", "float"),
    ("Country", "str"),
]
WIRE_NAMES = [n for n, _ in WIRE_FIELDS]

_SPARK_OF = {"str": T.StringType(), "int": T.IntegerType(), "float": T.DoubleType()}

# Typed event as it travels (after validation, before cleaning).
EVENT_SCHEMA = T.StructType(
    [T.StructField(n, _SPARK_OF[t], True) for n, t in WIRE_FIELDS])

# Validation of a JSON message keeps Quantity as bigint until the store
# narrows it to int (2147483648 passes validation, the INT column refuses it).
WIRE_SCHEMA = T.StructType(
    [T.StructField(n, T.LongType() if t == "int" else _SPARK_OF[t], True)
     for n, t in WIRE_FIELDS])

# The replay CSV: an unnamed leading index column, then the eight fields.
CSV_INDEX_COLUMN = "Unnamed: 0"
CSV_SCHEMA = T.StructType(
    [T.StructField(CSV_INDEX_COLUMN, T.LongType(), True)] + list(EVENT_SCHEMA.fields))

# Stored table column order, types and length limits.
STORE_COLUMNS = [
    "InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate",
    "UnitPrice", "CustomerID", "Country", "TotalAmount",
]
MONEY = T.DecimalType(10, 2)
STORE_SCHEMA = T.StructType([
    T.StructField("InvoiceNo", T.StringType(), False),
    T.StructField("StockCode", T.StringType(), False),
    T.StructField("Description", T.StringType(), True),
    T.StructField("Quantity", T.IntegerType(), True),
    T.StructField("InvoiceDate", T.TimestampNTZType(), False),
    T.StructField("UnitPrice", MONEY, True),
    T.StructField("CustomerID", T.StringType(), True),
    T.StructField("Country", T.StringType(), True),
    T.StructField("TotalAmount", MONEY, True),
])
VARCHAR_LIMITS = {"InvoiceNo": 20, "StockCode": 20, "CustomerID": 20, "Country": 50}
INT32_MIN, INT32_MAX = -(2 ** 31), 2 ** 31 - 1

PARTITION_COLUMN = "invoice_month"
LINEAGE_COLUMNS = ["query_id", "batch_id"]
TABLE_COLUMNS = STORE_COLUMNS + LINEAGE_COLUMNS + [PARTITION_COLUMN]

# Keys: first-row dedupe inside a batch uses the pair, the table's unique
# rule (and the insert-if-absent guard) uses the triple.
PAIR_KEY = ["InvoiceNo", "StockCode"]
TRIPLE_KEY = ["InvoiceNo", "StockCode", "InvoiceDate"]

# Dashboard frame: the five lower-case columns the dashboard reads.
DASHBOARD_COLUMNS = {
    "description": "Description",
    "quantity": "Quantity",
    "invoicedate": "InvoiceDate",
    "country": "Country",
    "totalamount": "TotalAmount",
}

# Timestamp text format of the wire and of the DLQ record.
WIRE_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
WIRE_TS_PARSE_FORMAT = "yyyy-M-d H:m:s"
# The whole seconds that 64-bit nanoseconds around 1970 can hold.
TS_RANGE = ("1677-09-21 00:12:44", "2262-04-11 23:47:16")
ISO_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"

# Dead-letter reasons.
REASON_MALFORMED = "malformed_json"
REASON_SCHEMA = "schema"
REASON_BAD_DATE = "bad_date"
REASON_STORE = "store_reject"
REASON_NO_PARTITION = "no_partition"
REASON_DUPLICATE = "Duplicate"
DLQ_REASONS = [REASON_MALFORMED, REASON_SCHEMA, REASON_BAD_DATE,
               REASON_STORE, REASON_NO_PARTITION, REASON_DUPLICATE]

# Silent outcomes (dropped as in the reference, but counted).
OUTCOME_IN_BATCH_DUP = "in_batch_duplicate"
OUTCOME_NULL_DROP = "null_drop"
OUTCOME_SIGN_DROP = "sign_drop"
OUTCOME_CLEAN = "clean"

DLQ_SCHEMA = T.StructType([
    T.StructField("error", T.StringType(), True),
    T.StructField("reason", T.StringType(), False),
    T.StructField("data", T.StringType(), True),
    T.StructField("query_id", T.StringType(), True),
    T.StructField("batch_id", T.LongType(), True),
])
