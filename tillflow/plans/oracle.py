"""Reference SQL for every registered query (DuckDB dialect, ANSI where it
can be).  Used by the driver's correctness gate and by our own checker;
tables ``lineitem orders customer nation part events`` are views."""

from __future__ import annotations

# Nothing here comes from the engine: the literals are written out, so that a
# mistake in an engine constant shows as a mismatch.

# The wire fields, the stored columns, the length limits.
WIRE = ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country"]
FLOATS = {"UnitPrice", "CustomerID"}
STORED = ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country", "TotalAmount"]
LIMITS = {"InvoiceNo": 20, "StockCode": 20, "CustomerID": 20, "Country": 50}
# Fault rules of the feed, (multiplier of the part key, modulus).
FAULTS = {"desc_null": (3, 41), "desc_blank": (17, 97), "qty_neg": (5, 29), "price_neg": (7, 53), "cust_null": (11, 37),
          "date_bad": (13, 59)}
BAD_DATE_TEXT = "bad-date"
LOADED_BEFORE = "1999-01-01 00:00:00"
# Whitespace as Python's split() has it.
PY_WHITESPACE_CLASS = (
    r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
# Bounds of the dashboard windows that end at the two "now" times.
RETAIL_WINDOWS = {
    "30m": ("1996-12-14 13:52:00", "1996-12-14 14:22:00"), "1h": ("1996-12-14 13:22:00", "1996-12-14 14:22:00"),
    "3h": ("1996-12-14 11:22:00", "1996-12-14 14:22:00"), "6h": ("1996-12-14 08:22:00", "1996-12-14 14:22:00"),
    "24h": ("1996-12-13 14:22:00", "1996-12-14 14:22:00")}
EVENTS_WINDOWS = {
    "30m": ("2024-01-15 11:30:00", "2024-01-15 12:00:00"), "1h": ("2024-01-15 11:00:00", "2024-01-15 12:00:00"),
    "3h": ("2024-01-15 09:00:00", "2024-01-15 12:00:00"), "6h": ("2024-01-15 06:00:00", "2024-01-15 12:00:00"),
    "24h": ("2024-01-14 12:00:00", "2024-01-15 12:00:00")}


def _hit(rule):
    mult, mod = FAULTS[rule]
    return f"(l.l_orderkey + {mult} * l.l_partkey) % {mod} = 0"


RETAIL = f"""
order_dim AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, n.n_name
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
retail AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) AS InvoiceNo,
         CAST(l.l_partkey AS VARCHAR) AS StockCode,
         CASE WHEN {_hit('desc_null')} THEN NULL
              WHEN {_hit('desc_blank')} THEN ' ' || p.p_name || ' '
              ELSE p.p_name END AS Description,
         CAST(l.l_quantity AS INTEGER) * CASE WHEN {_hit('qty_neg')} THEN -1 ELSE 1 END AS Quantity,
         CASE WHEN {_hit('date_bad')} THEN '{BAD_DATE_TEXT}'
              ELSE strftime(od.o_orderdate + to_minutes(CAST(od.o_orderkey % 1440 AS BIGINT)),
                            '%Y-%m-%d %H:%M:%S') END AS InvoiceDate,
         p.p_retailprice * CASE WHEN {_hit('price_neg')} THEN -1 ELSE 1 END AS UnitPrice,
         CASE WHEN {_hit('cust_null')} THEN NULL ELSE CAST(od.o_custkey AS DOUBLE) END AS CustomerID,
         od.n_name AS Country,
         l.l_linenumber, l.l_suppkey, l.l_extendedprice
  FROM lineitem l
  LEFT JOIN order_dim od ON l.l_orderkey = od.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey)"""

_NULL_CHECKS = ",\n     ".join(
    f"CASE WHEN {n} IS NULL{' OR isnan(' + n + ')' if n in FLOATS else ''} THEN '{n}:null' END"
    for n in WIRE)

# A number that is no number passes the validation of messages, and is dropped as missing afterwards.
_NULLS_ONLY = ",\n     ".join(f"CASE WHEN {n} IS NULL THEN '{n}:null' END" for n in WIRE)

VALIDATED = f"""
validated AS (
  SELECT *, concat_ws(';',
     {_NULL_CHECKS}) AS error
  FROM retail),
valid AS (SELECT * EXCLUDE (error) FROM validated WHERE error = ''),
kept AS (SELECT * FROM valid
         WHERE NOT (CustomerID IS NULL OR isnan(CustomerID) OR InvoiceDate IS NULL))"""

RAW_JSON = ("to_json(struct_pack(" + ", ".join(f"{n} := {n}" for n in WIRE) + "))")

WINNERS = """
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY InvoiceNo, StockCode
                               ORDER BY l_linenumber, l_suppkey, l_extendedprice) AS rn,
         count(*) OVER (PARTITION BY InvoiceNo, StockCode) AS group_rows
  FROM kept),
winners AS (SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1)"""

_LIMITS = ",\n       ".join(
    f"CASE WHEN length({'cust_text' if n == 'CustomerID' else n}) > {lim} THEN '{n}:length' END"
    for n, lim in LIMITS.items())


# The time of a text, within the range of 64-bit nanoseconds around 1970.
TS = ("CASE WHEN try_strptime(text, '%Y-%m-%d %H:%M:%S') BETWEEN TIMESTAMP '1677-09-21 00:12:44' "
      "AND TIMESTAMP '2262-04-11 23:47:16' THEN try_strptime(text, '%Y-%m-%d %H:%M:%S') END")


def classify(name: str, src: str) -> str:
    """Clean chain over ``src`` -> CTE ``name`` with outcome and stored values."""
    return f"""
{name}_staged AS (
  SELECT *, {TS.replace('text', 'InvoiceDate')} AS ts,
         TRY_CAST(Quantity AS INTEGER) AS qty_int,
         TRY_CAST(UnitPrice AS DECIMAL(10,2)) AS price_dec,
         TRY_CAST(Quantity * UnitPrice AS DECIMAL(10,2)) AS total_dec,
         CASE WHEN CustomerID % 1 = 0 AND abs(CustomerID) < 1e18
              THEN CAST(CAST(CustomerID AS BIGINT) AS VARCHAR)
              ELSE CAST(CustomerID AS VARCHAR) END AS cust_text
  FROM {src}),
{name}_err AS (
  SELECT *, concat_ws(';',
       CASE WHEN qty_int IS NULL THEN 'Quantity:int_range' END,
       CASE WHEN price_dec IS NULL THEN 'UnitPrice:decimal_range' END,
       CASE WHEN total_dec IS NULL THEN 'TotalAmount:decimal_range' END,
       {_LIMITS}) AS store_err
  FROM {name}_staged),
{name} AS (
  SELECT *, CASE WHEN NOT (Quantity >= 0 AND UnitPrice >= 0 AND NOT isnan(UnitPrice)) THEN 'sign_drop'
                 WHEN ts IS NULL THEN 'bad_date'
                 WHEN store_err <> '' THEN 'store_reject'
                 ELSE 'clean' END AS outcome
  FROM {name}_err)"""


CLEAN = classify("classified", "winners") + """,
clean AS (
  SELECT InvoiceNo, StockCode, Description, qty_int AS Quantity, ts AS InvoiceDate,
         price_dec AS UnitPrice, cust_text AS CustomerID, Country, total_dec AS TotalAmount,
         strftime(ts, '%Y_%m') AS invoice_month
  FROM classified WHERE outcome = 'clean')"""

BASE = "WITH " + RETAIL + "," + VALIDATED + "," + WINNERS + "," + CLEAN
EXISTING = f"""existing AS (
  SELECT * FROM clean WHERE InvoiceDate < TIMESTAMP '{LOADED_BEFORE}')"""

STORED_JSON = ("to_json(struct_pack(InvoiceNo := InvoiceNo, StockCode := StockCode, "
               "Description := Description, Quantity := qty_int, "
               "InvoiceDate := strftime(ts, '%Y-%m-%dT%H:%M:%S'), "
               "UnitPrice := CAST(price_dec AS DOUBLE), CustomerID := cust_text, "
               "Country := Country, TotalAmount := CAST(total_dec AS DOUBLE)))")

STORE_COLS = ", ".join(STORED)


def _metrics_sql(with_target: bool) -> str:
    failed = ("(SELECT count(*) FROM classified c WHERE c.outcome = 'clean' "
              f"AND c.ts < TIMESTAMP '{LOADED_BEFORE}')") if with_target else "0"
    return BASE + f"""
SELECT (SELECT count(*) FROM retail) AS received,
       CAST(0 AS BIGINT) AS malformed,
       (SELECT count(*) FROM validated WHERE error <> '') AS invalid,
       (SELECT CAST(coalesce(sum(group_rows - 1), 0) AS BIGINT) FROM winners) AS in_batch_duplicates,
       (SELECT count(*) FROM valid) - (SELECT count(*) FROM kept) AS null_dropped,
       (SELECT count(*) FROM classified WHERE outcome = 'sign_drop') AS sign_dropped,
       (SELECT count(*) FROM classified WHERE outcome = 'bad_date') AS bad_date,
       (SELECT count(*) FROM classified WHERE outcome = 'store_reject') AS store_reject,
       CAST(0 AS BIGINT) AS no_partition,
       (SELECT count(*) FROM classified WHERE outcome = 'clean') AS processed,
       (SELECT count(*) FROM classified WHERE outcome = 'clean') - {failed} AS success,
       {failed} AS failed,
       CAST(0 AS BIGINT) AS already_written"""


def _between(col: str, bounds) -> str:
    return f"{col} >= TIMESTAMP '{bounds[0]}' AND {col} <= TIMESTAMP '{bounds[1]}'"


KPI_FROM = """
SELECT CAST(coalesce(sum(TotalAmount), 0) AS DOUBLE) AS total_sales,
       count(*) AS total_transactions,
       CASE WHEN count(*) > 0 THEN CAST(coalesce(sum(TotalAmount), 0) AS DOUBLE) / count(*)
            ELSE 0.0 END AS avg_transaction_value
FROM clean"""

FIRST_WORD = f"nullif(regexp_extract(Description, '([^{PY_WHITESPACE_CLASS}]+)', 1), '')"


def _category(n: int) -> str:
    return BASE + f"""
SELECT category, CAST(sum(TotalAmount) AS DOUBLE) AS revenue
FROM (SELECT {FIRST_WORD} AS category, TotalAmount FROM clean) t
WHERE category IS NOT NULL
GROUP BY category ORDER BY revenue DESC, category ASC LIMIT {n}"""


# Messages of which every 43rd key is malformed text.
BAD_MESSAGE = "(CAST(InvoiceNo AS BIGINT) + 2 * CAST(StockCode AS BIGINT)) % 43 = 0"
FAULTY = ("WITH " + RETAIL.replace("retail AS (", "every AS (", 1) + f""",
retail AS (SELECT * FROM every WHERE NOT ({BAD_MESSAGE})),
broken AS (SELECT '{{bad ' || InvoiceNo AS data FROM every WHERE {BAD_MESSAGE})""")

# One dedupe scope a line number; among equal table keys the first by (scope, arrival) is inserted.
SCOPED = ("WITH " + RETAIL + "," + VALIDATED + """,
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY l_linenumber, InvoiceNo, StockCode ORDER BY l_suppkey, l_extendedprice) AS rn,
         count(*) OVER (PARTITION BY l_linenumber, InvoiceNo, StockCode) AS group_rows
  FROM kept),
winners AS (SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1),""" + classify("classified0", "winners") + """,
classified AS (
  SELECT *, outcome = 'clean' AND row_number() OVER (
    PARTITION BY outcome, InvoiceNo, StockCode, ts ORDER BY l_linenumber, l_suppkey, l_extendedprice) > 1 AS later
  FROM classified0)""")


def _counts(received: str, malformed: str, failed: str) -> str:
    return f"""
SELECT (SELECT count(*) FROM {received}) AS received,
       (SELECT count(*) FROM {malformed}) AS malformed,
       (SELECT count(*) FROM {malformed}) + (SELECT count(*) FROM validated WHERE error <> '') AS invalid,
       (SELECT CAST(coalesce(sum(group_rows - 1), 0) AS BIGINT) FROM winners) AS in_batch_duplicates,
       (SELECT count(*) FROM valid) - (SELECT count(*) FROM kept) AS null_dropped,
       (SELECT count(*) FROM classified WHERE outcome = 'sign_drop') AS sign_dropped,
       (SELECT count(*) FROM classified WHERE outcome = 'bad_date') AS bad_date,
       (SELECT count(*) FROM classified WHERE outcome = 'store_reject') AS store_reject,
       CAST(0 AS BIGINT) AS no_partition,
       (SELECT count(*) FROM classified WHERE outcome = 'clean') AS processed,
       (SELECT count(*) FROM classified WHERE outcome = 'clean') - {failed} AS success,
       {failed} AS failed,
       CAST(0 AS BIGINT) AS already_written"""


def _messages() -> dict[str, str]:
    k, p = "CAST(InvoiceNo AS BIGINT)", "CAST(StockCode AS BIGINT)"
    later = "(SELECT count(*) FROM classified WHERE later)"
    return {
        "messages_faulty": FAULTY + "," + VALIDATED + "," + WINNERS + "," + CLEAN + _counts("every", "broken", "0"),
        "messages_faulty_dlq": FAULTY + "\nSELECT 'malformed_json' AS error, 'malformed_json' AS reason, data FROM broken",
        "dlq_envelope": FAULTY + """
SELECT '{"error":"malformed_json","data":"' || data || '"}' AS envelope FROM broken""",
        "messages_lax": "WITH " + RETAIL + f""",
forms AS (SELECT *, ({k} + {p}) % 13 AS q, ({k} + 2 * {p}) % 11 AS u FROM retail),
read AS (
  SELECT InvoiceNo, StockCode, l_linenumber,
    CAST(CASE WHEN q IN (0, 1, 2, 3, 10) THEN 6 WHEN q = 5 THEN 1000 WHEN q = 7 THEN 1 END AS BIGINT) AS Quantity,
    CAST(CASE WHEN u IN (0, 1) THEN 2.5 WHEN u = 2 THEN 10 WHEN u = 4 THEN 2 WHEN u = 5 THEN 1000.5 WHEN u = 7 THEN 0
         WHEN u = 10 THEN 0.5 END AS DOUBLE) AS UnitPrice, q, u FROM forms)
SELECT InvoiceNo, StockCode, l_linenumber, Quantity, UnitPrice, concat_ws(';',
  CASE WHEN q = 11 THEN 'Quantity:null' WHEN q IN (9, 12) THEN 'Quantity:fraction' WHEN Quantity IS NULL THEN 'Quantity:type' END,
  CASE WHEN u = 9 THEN 'UnitPrice:null' WHEN UnitPrice IS NULL THEN 'UnitPrice:type' END) AS error
FROM read""",
        "permissive_decode": "WITH " + RETAIL + """
SELECT l_linenumber, InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice,
       CAST(CustomerID AS VARCHAR) AS CustomerID, Country FROM retail""",
        "dates_mixed": f"""WITH t AS (
  SELECT o_orderkey, o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS BIGINT)) AS m FROM orders),
x AS (
  SELECT o_orderkey, CASE o_orderkey % 7
    WHEN 1 THEN strftime(m, '%Y-%-m-%-d %-H:%-M:%-S') WHEN 2 THEN strftime(m, '%Y-%m-%dT%H:%M:%S')
    WHEN 3 THEN '0001' || strftime(m, '-%m-%d %H:%M:%S') WHEN 4 THEN '2999' || strftime(m, '-%m-%d %H:%M:%S')
    WHEN 5 THEN strftime(m, '%Y-%m-%d') ELSE strftime(m, '%Y-%m-%d %H:%M:%S') END AS text FROM t)
SELECT o_orderkey, text, {TS} AS ts FROM x""",
        "coerced_window": """
SELECT event_id, date_trunc('second', ts) AS invoicedate FROM events WHERE event_id % 5 <> 0 AND """
                          + _between("date_trunc('second', ts)", EVENTS_WINDOWS["24h"]),
        "scoped_metrics": SCOPED + _counts("retail", "(SELECT 1 WHERE false)", later),
        "scoped_dlq": SCOPED + f"""
SELECT 'Duplicate' AS error, 'Duplicate' AS reason, {STORED_JSON} AS data FROM classified WHERE later""",
        "csv_roundtrip": "WITH " + RETAIL + f"""
SELECT InvoiceNo, StockCode, CASE WHEN ({k} + {p}) % 7 = 0 THEN 'WHITE "HEART", ' || Description ELSE Description END AS Description,
       Quantity, InvoiceDate, UnitPrice, CustomerID, Country FROM retail""",
        "text_formats": BASE + """,
top AS (SELECT Country AS country, CAST(sum(TotalAmount) AS DOUBLE) AS s FROM clean WHERE Country IS NOT NULL
        GROUP BY Country ORDER BY s DESC, country ASC LIMIT 10)
SELECT country, format('${:,.2f}', s) AS sales, format('{:,}', CAST(floor(s) AS BIGINT)) AS whole,
       printf('%.1f%%', 100.0 * s / sum(s) OVER ()) AS share FROM top""",
    }


# Placed in the order of file (its number as text) and line; a batch is five valid records.
PLACED = ("," + VALIDATED + """,
files AS (SELECT greatest(8, CAST(ceil(count(*) / 100000.0) AS BIGINT)) AS n FROM every),
placed AS (
  SELECT *, position // 5 AS batch FROM (
    SELECT v.*, row_number() OVER (ORDER BY CAST(CAST(InvoiceNo AS BIGINT) % n AS VARCHAR), CAST(InvoiceNo AS BIGINT),
      CAST(StockCode AS BIGINT), l_linenumber, l_suppkey, l_extendedprice) - 1 AS position FROM valid v, files))""")
BATCHED = (FAULTY + PLACED + """,
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY batch, InvoiceNo, StockCode ORDER BY position) AS rn,
         count(*) OVER (PARTITION BY batch, InvoiceNo, StockCode) AS group_rows
  FROM placed WHERE NOT (CustomerID IS NULL OR isnan(CustomerID) OR InvoiceDate IS NULL)),
winners AS (SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1),""" + classify("classified0", "winners") + """,
classified AS (
  SELECT *, outcome = 'clean' AND row_number() OVER (
    PARTITION BY outcome, InvoiceNo, StockCode, ts ORDER BY position) > 1 AS later
  FROM classified0)""")

# A feed with customers that aren't numbers, long countries and large prices, for a table with 67 months.
ODD = ("WITH " + RETAIL.replace("retail AS (", "every AS (", 1) + """,
retail AS (
  SELECT * REPLACE (
    CASE WHEN (CAST(InvoiceNo AS BIGINT) + CAST(StockCode AS BIGINT)) % 31 = 0 THEN CAST('nan' AS DOUBLE) ELSE CustomerID END AS CustomerID,
    CASE WHEN (CAST(InvoiceNo AS BIGINT) + 2 * CAST(StockCode AS BIGINT)) % 37 = 0 THEN repeat('x', 51) ELSE Country END AS Country,
    CASE WHEN (CAST(InvoiceNo AS BIGINT) + 4 * CAST(StockCode AS BIGINT)) % 41 = 0 THEN 1e9 ELSE UnitPrice END AS UnitPrice)
  FROM every)""" + "," + VALIDATED.replace(_NULL_CHECKS, _NULLS_ONLY) + "," + WINNERS + ","
       + classify("classified0", "winners") + """,
classified AS (
  SELECT * REPLACE (CASE WHEN outcome = 'clean' AND NOT strftime(ts, '%Y_%m') BETWEEN '1995_06' AND '2000_12'
    THEN 'no_partition' ELSE outcome END AS outcome) FROM classified0)""")

# The three deliveries of the distinct stream, its watermarks, and what each lets through.
DISTINCT = "WITH " + RETAIL + "," + VALIDATED + """,
timed AS (
  SELECT InvoiceNo, StockCode, CAST(InvoiceDate AS TIMESTAMP) AS ts,
         (CAST(InvoiceNo AS BIGINT) + CAST(StockCode AS BIGINT)) % 10 AS h FROM valid WHERE InvoiceDate <> 'bad-date'),
cut AS (SELECT TIMESTAMP '1997-01-01' AS c1, TIMESTAMP '1999-01-01' AS c2, INTERVAL 90 DAY AS delay),
d0 AS (SELECT DISTINCT InvoiceNo, StockCode, ts FROM timed, cut WHERE ts < c1 AND h <> 3),
d1 AS (SELECT DISTINCT InvoiceNo, StockCode, ts FROM timed, cut WHERE (ts >= c1 AND ts < c2) OR (ts < c1 AND h IN (3, 4))),
d2 AS (
  SELECT DISTINCT InvoiceNo, StockCode, ts FROM timed, cut WHERE ts >= c2 OR (ts >= c1 AND ts < c2 AND h = 6)
  UNION SELECT DISTINCT InvoiceNo, StockCode, ts + INTERVAL 5 YEAR FROM timed, cut WHERE ts < c1 AND h = 5),
w AS (
  SELECT (SELECT max(ts) FROM d0) - delay AS w1,
         greatest((SELECT max(ts) FROM d0), (SELECT max(ts) FROM d1)) - delay AS w2, delay FROM cut),
e1 AS (
  SELECT d1.* FROM d1, w WHERE d1.ts > w1 AND NOT EXISTS (
    SELECT 1 FROM d0 WHERE d0.InvoiceNo = d1.InvoiceNo AND d0.StockCode = d1.StockCode AND d0.ts + delay > w1)),
e01 AS (SELECT * FROM d0 UNION ALL SELECT * FROM e1),
e2 AS (
  SELECT d2.* FROM d2, w WHERE d2.ts > w2 AND NOT EXISTS (
    SELECT 1 FROM e01 WHERE e01.InvoiceNo = d2.InvoiceNo AND e01.StockCode = d2.StockCode AND e01.ts + delay > w2))
SELECT InvoiceNo, StockCode, ts AS event_time FROM e01
UNION ALL SELECT InvoiceNo, StockCode, ts FROM e2"""


def _writes() -> dict[str, str]:
    """SQL of the queries that write, stream and restart."""
    later = "(SELECT count(*) FROM classified WHERE later)"
    loaded = f"InvoiceDate < TIMESTAMP '{LOADED_BEFORE}'"
    replayed = "(SELECT count(*) FROM classified WHERE outcome = 'clean' AND CAST(InvoiceNo AS BIGINT) % 2 = 1)"
    panel = "SELECT '{0}' AS panel, {1} AS item, '{2}' AS measure, CAST({3} AS DOUBLE) AS value FROM {4}"
    return {
        "valid_batches": FAULTY + PLACED + """
SELECT InvoiceNo, StockCode, Description, CAST(Quantity AS BIGINT) AS Quantity, UnitPrice, position, batch FROM placed""",
        "valid_batch_metrics": BATCHED + _counts("every", "broken", later),
        "upsert_table": BASE + "," + EXISTING + "," + classify("inc_all", "kept") + f""",
loaded AS (
  SELECT {STORE_COLS} FROM existing
  UNION ALL SELECT {STORE_COLS.replace('InvoiceDate', 'InvoiceDate + INTERVAL 40 DAY')} FROM existing
  WHERE (CAST(InvoiceNo AS BIGINT) + CAST(StockCode AS BIGINT)) % 5 = 0),
incoming AS (
  SELECT InvoiceNo, StockCode, Description, qty_int AS Quantity, ts AS InvoiceDate,
         price_dec AS UnitPrice, cust_text AS CustomerID, Country, total_dec AS TotalAmount,
         row_number() OVER (PARTITION BY InvoiceNo, StockCode ORDER BY l_linenumber, l_suppkey, l_extendedprice) AS up,
         row_number() OVER (PARTITION BY InvoiceNo, StockCode ORDER BY l_linenumber DESC, l_suppkey DESC, l_extendedprice DESC) AS down
  FROM inc_all WHERE outcome = 'clean' AND ts >= TIMESTAMP '1998-01-01'),
held AS (SELECT InvoiceNo, StockCode, min(InvoiceDate) AS first FROM loaded GROUP BY ALL)
SELECT o.InvoiceNo, o.StockCode, CASE WHEN n.up IS NOT NULL THEN n.Description ELSE o.Description END AS Description,
       CASE WHEN n.up IS NOT NULL THEN n.Quantity ELSE o.Quantity END AS Quantity, o.InvoiceDate,
       CASE WHEN n.up IS NOT NULL THEN n.UnitPrice ELSE o.UnitPrice END AS UnitPrice, o.CustomerID, o.Country,
       CASE WHEN n.up IS NOT NULL THEN n.TotalAmount ELSE o.TotalAmount END AS TotalAmount
FROM loaded o JOIN held USING (InvoiceNo, StockCode)
LEFT JOIN incoming n ON n.InvoiceNo = o.InvoiceNo AND n.StockCode = o.StockCode AND n.down = 1 AND o.InvoiceDate = first
UNION ALL
SELECT f.InvoiceNo, f.StockCode, l.Description, l.Quantity, f.InvoiceDate, l.UnitPrice, f.CustomerID, f.Country, l.TotalAmount
FROM incoming f JOIN incoming l USING (InvoiceNo, StockCode)
WHERE f.up = 1 AND l.down = 1 AND NOT EXISTS (
  SELECT 1 FROM held h WHERE h.InvoiceNo = f.InvoiceNo AND h.StockCode = f.StockCode)""",
        "insert_if_absent_bucketed": BASE + f"""
SELECT InvoiceNo, StockCode, InvoiceDate, CASE WHEN {loaded} THEN 'Duplicate' ELSE 'inserted' END AS outcome,
       'Duplicate' AS "then" FROM clean""",
        "stream_distinct": DISTINCT,
        "stream_dashboard": BASE + ",\n" + f"""
sums AS ({KPI_FROM}),
products AS (SELECT Description AS d, sum(Quantity) AS q FROM clean WHERE Description IS NOT NULL GROUP BY 1 ORDER BY q DESC, d LIMIT 10),
hours AS (SELECT hour(InvoiceDate) AS h, sum(TotalAmount) AS r FROM clean GROUP BY 1),
countries AS (SELECT Country AS c, sum(TotalAmount) AS s FROM clean WHERE Country IS NOT NULL GROUP BY 1 ORDER BY s DESC, c LIMIT 10),
categories AS (
  SELECT c, sum(TotalAmount) AS r FROM (SELECT {FIRST_WORD} AS c, TotalAmount FROM clean) WHERE c IS NOT NULL
  GROUP BY 1 ORDER BY r DESC, c LIMIT 10)
""" + "\nUNION ALL ".join(
            [panel.format("kpi", "''", m, m, "sums") for m in ("total_sales", "total_transactions", "avg_transaction_value")]
            + [panel.format("top_products", "d", "quantity", "q", "products"),
               panel.format("hourly_revenue", "CAST(h AS VARCHAR)", "revenue", "r", "hours"),
               panel.format("country_sales", "c", "sales", "s", "countries"),
               panel.format("category_sales", "c", "revenue", "r", "categories")]),
        "stream_restart_metrics": _metrics_sql(False).replace(
            "CAST(0 AS BIGINT) AS already_written", f"{replayed} AS already_written"),
        "observed_metrics": _metrics_sql(False),
        "dlq_readback": BASE + f"""
SELECT error, 'schema' AS reason, {RAW_JSON} AS data FROM validated WHERE error <> ''
UNION ALL SELECT 'InvoiceDate:format', 'bad_date', {RAW_JSON} FROM classified WHERE outcome = 'bad_date'
UNION ALL SELECT store_err, 'store_reject', {RAW_JSON} FROM classified WHERE outcome = 'store_reject'""",
        "all_outcomes": ODD + _counts("retail", "(SELECT 1 WHERE false)", "0").replace(
            "CAST(0 AS BIGINT) AS no_partition", "(SELECT count(*) FROM classified WHERE outcome = 'no_partition') AS no_partition"),
        "outcome_errors": ODD + """
SELECT outcome AS reason, CASE outcome WHEN 'store_reject' THEN store_err ELSE 'invoice_month:' || strftime(ts, '%Y_%m') END AS error,
       count(*) AS n_rows FROM classified WHERE outcome IN ('store_reject', 'no_partition') GROUP BY ALL""",
        "permissive_malformed": "WITH " + RETAIL + f"""
SELECT InvoiceNo AS sent_InvoiceNo, StockCode AS sent_StockCode, CASE WHEN ok THEN InvoiceNo END AS InvoiceNo,
       CASE WHEN ok THEN StockCode END AS StockCode, CASE WHEN ok THEN Description END AS Description,
       CASE WHEN ok THEN Quantity END AS Quantity, CASE WHEN ok THEN InvoiceDate END AS InvoiceDate,
       CASE WHEN ok THEN UnitPrice END AS UnitPrice, CASE WHEN ok THEN CAST(CustomerID AS VARCHAR) END AS CustomerID,
       CASE WHEN ok THEN Country END AS Country
FROM (SELECT *, NOT ({BAD_MESSAGE}) AS ok FROM retail)""",
        "csv_sink_roundtrip": BASE + "," + classify("every_row", "kept") + """
SELECT InvoiceNo, StockCode, Description, qty_int AS Quantity, ts AS InvoiceDate, price_dec AS UnitPrice,
       cust_text AS CustomerID, Country, total_dec AS TotalAmount FROM every_row WHERE outcome = 'clean'""",
        "swap_rows": BASE + f"""
SELECT step, count(*) AS n_rows, CAST(sum(Quantity) AS BIGINT) AS quantity
FROM clean, (VALUES ('old alone', true), ('both there', true), ('published', false)) s(step, old)
WHERE NOT old OR {loaded} GROUP BY step""",
    }


def _build() -> dict[str, str]:
    out = {
        "retail_raw": "WITH " + RETAIL + "\nSELECT * FROM retail",
        "validation_rejects": "WITH " + RETAIL + "," + VALIDATED + f"""
SELECT InvoiceNo, StockCode, 'schema' AS reason, error, {RAW_JSON} AS data
FROM validated WHERE error <> ''""",
        "clean_rows": BASE + "\nSELECT * FROM clean",
        "message_ingest": BASE + "\nSELECT * FROM clean",
        "stream_ingest": BASE + "\nSELECT * FROM clean",
        "ingest_metrics": _metrics_sql(False),
        "replay_metrics": _metrics_sql(True),
        "dlq_all": BASE + f""",
dupes AS (SELECT * FROM classified WHERE outcome = 'clean' AND ts < TIMESTAMP '{LOADED_BEFORE}')
SELECT error, 'schema' AS reason, {RAW_JSON} AS data FROM validated WHERE error <> ''
UNION ALL
SELECT 'InvoiceDate:format', 'bad_date', {RAW_JSON} FROM classified WHERE outcome = 'bad_date'
UNION ALL
SELECT store_err, 'store_reject', {RAW_JSON} FROM classified WHERE outcome = 'store_reject'
UNION ALL
SELECT 'Duplicate', 'Duplicate', {STORED_JSON} FROM dupes""",
        "insert_if_absent": "WITH " + RETAIL + """
SELECT InvoiceNo, StockCode, InvoiceDate,
       CASE WHEN bool_or(l_linenumber <= 4) THEN 'Duplicate' ELSE 'inserted' END AS outcome
FROM retail GROUP BY InvoiceNo, StockCode, InvoiceDate""",
        "upsert_latest": BASE + "," + EXISTING + "," + classify("inc_all", "kept") + f""",
incoming AS (
  SELECT InvoiceNo, StockCode, Description, qty_int AS Quantity, ts AS InvoiceDate,
         price_dec AS UnitPrice, cust_text AS CustomerID, Country, total_dec AS TotalAmount,
         l_linenumber, l_suppkey, l_extendedprice
  FROM inc_all WHERE outcome = 'clean'),
u AS (
  SELECT {STORE_COLS}, 0 AS v, CAST(NULL AS INTEGER) AS l_linenumber,
         CAST(NULL AS BIGINT) AS l_suppkey, CAST(NULL AS DOUBLE) AS l_extendedprice
  FROM existing
  UNION ALL
  SELECT {STORE_COLS}, 1 AS v, l_linenumber, l_suppkey, l_extendedprice FROM incoming),
r AS (
  SELECT *, row_number() OVER (PARTITION BY InvoiceNo, StockCode
              ORDER BY v, l_linenumber, l_suppkey, l_extendedprice) AS rf,
            row_number() OVER (PARTITION BY InvoiceNo, StockCode
              ORDER BY v DESC, l_linenumber DESC, l_suppkey DESC, l_extendedprice DESC) AS rl
  FROM u)
SELECT f.InvoiceNo, f.StockCode, l.Description, l.Quantity, f.InvoiceDate, l.UnitPrice,
       f.CustomerID, f.Country, l.TotalAmount
FROM r f JOIN r l ON f.InvoiceNo = l.InvoiceNo AND f.StockCode = l.StockCode
WHERE f.rf = 1 AND l.rl = 1""",
        "kpi": BASE + KPI_FROM,
        "top_products": BASE + """
SELECT Description AS description, CAST(sum(Quantity) AS BIGINT) AS quantity
FROM clean WHERE Description IS NOT NULL
GROUP BY Description ORDER BY quantity DESC, description ASC LIMIT 10""",
        "hourly_revenue": BASE + """
SELECT CAST(hour(InvoiceDate) AS INTEGER) AS hour, CAST(sum(TotalAmount) AS DOUBLE) AS revenue
FROM clean WHERE InvoiceDate IS NOT NULL GROUP BY 1 ORDER BY 1""",
        "country_share": BASE + """,
top AS (SELECT Country AS country, sum(TotalAmount) AS s FROM clean WHERE Country IS NOT NULL
        GROUP BY Country ORDER BY s DESC, country ASC LIMIT 10)
SELECT country, CAST(s AS DOUBLE) AS sales,
       CAST(100.0 AS DOUBLE) * CAST(s AS DOUBLE) / CAST(sum(s) OVER () AS DOUBLE) AS share_pct
FROM top ORDER BY sales DESC, country ASC""",
        "category_sales": _category(10),
        "category_sales_top5": _category(5),
        "row_count": BASE + "\nSELECT count(*) AS row_count FROM clean",
        "month_partitions": BASE + """,
b AS (SELECT CAST(date_trunc('month', min(InvoiceDate)) AS DATE) AS s,
             CAST(date_trunc('month', max(InvoiceDate)) + INTERVAL 1 MONTH AS DATE) AS e FROM clean)
SELECT 'online_retail_' || strftime(m, '%Y_%m') AS partition_name,
       CAST(m AS DATE) AS range_from, CAST(m + INTERVAL 1 MONTH AS DATE) AS range_to
FROM b, generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP) - INTERVAL 1 MONTH,
                        INTERVAL 1 MONTH) g(m)
WHERE s < e""",
        "month_rows": BASE + """
SELECT invoice_month, count(*) AS n_rows FROM clean GROUP BY invoice_month""",
        "unique_violations": "WITH " + RETAIL + """
SELECT InvoiceNo, StockCode, InvoiceDate, count(*) AS copies
FROM retail GROUP BY InvoiceNo, StockCode, InvoiceDate HAVING count(*) > 1""",
    }
    for k, bounds in RETAIL_WINDOWS.items():
        out[f"kpi_window_{k}"] = BASE + KPI_FROM + " WHERE " + _between("InvoiceDate", bounds)
    for k, bounds in EVENTS_WINDOWS.items():
        out[f"events_window_{k}"] = ("SELECT event_id, ts, user_id, event_type, value FROM events WHERE "
                                     + _between("ts", bounds))
    out.update(_messages())
    out.update(_writes())
    return out


ORACLE_SQL = _build()
