"""Retail event feed derived from the driver's star-schema tables.

No retail CSV ships with the reference, so the feed is a view: one event per
lineitem, joined to its order, customer, nation and part.  The tables are
clean, so faults are injected by key arithmetic both Spark and the SQL oracle
can evaluate; every row is kept (the rules change values, never drop rows).

Join order matters at scale: orders are joined to customer first
(orders is about a quarter of lineitem), then lineitem to that order-level
frame, to part and to nation, whose names needn't be shuffled so.  Only the lineitem x orders join is hinted (sort-merge);
nation is tiny and Spark broadcasts it through ``autoBroadcastJoinThreshold``
(a size check on the scan); customer and part are broadcast or shuffled by
the same size check, and AQE re-plans at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow import schema as S

# Arrival order of events inside one (InvoiceNo, StockCode) key.
RETAIL_ORDER_COLS = ["l_linenumber", "l_suppkey", "l_extendedprice"]

# Fault rules, with k = l_orderkey and p = l_partkey.
#   Description NULL          when (k + 3p)  % 41 = 0
#   Description outer blanks  else (k + 17p) % 97 = 0   (' ' || name || ' ')
#   Quantity negated          when (k + 5p)  % 29 = 0
#   UnitPrice negated         when (k + 7p)  % 53 = 0
#   CustomerID NULL           when (k + 11p) % 37 = 0
#   InvoiceDate 'bad-date'    when (k + 13p) % 59 = 0
# InvoiceDate otherwise = o_orderdate + (o_orderkey % 1440) minutes.
FAULTS = {
    "desc_null": (3, 41),
    "desc_blank": (17, 97),
    "qty_neg": (5, 29),
    "price_neg": (7, 53),
    "cust_null": (11, 37),
    "date_bad": (13, 59),
}
BAD_DATE_TEXT = "bad-date"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _hit(rule: str) -> F.Column:
    mult, mod = FAULTS[rule]
    return (F.col("l_orderkey") + F.lit(mult) * F.col("l_partkey")) % mod == 0


def retail_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed event feed: the eight wire fields plus the arrival-order columns."""
    lineitem = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")

    minutes = F.make_dt_interval(mins=(F.col("o_orderkey") % 1440).cast("int"))
    order_dim = (orders
                 .join(customer, orders.o_custkey == customer.c_custkey, "left")
                 .select("o_orderkey", "o_custkey", (F.col("o_orderdate") + minutes).alias("_at"), "c_nationkey"))
    # lineitem x orders is a big-big join at any real scale: ask for the
    # sort-merge plan so both sides are hash-partitioned on the order key
    # (a small test file would otherwise be broadcast and every later step
    # would run in the one task that reads the other file).
    joined = (lineitem
              .join(order_dim.hint("merge"), lineitem.l_orderkey == order_dim.o_orderkey, "left")
              .join(part, lineitem.l_partkey == part.p_partkey, "left")
              .join(nation, F.col("c_nationkey") == nation.n_nationkey, "left"))

    ts_text = F.date_format(F.col("_at"), S.WIRE_TS_FORMAT)
    sign = lambda rule: F.when(_hit(rule), F.lit(-1)).otherwise(F.lit(1))
    return joined.select(
        F.col("l_orderkey").cast("string").alias("InvoiceNo"),
        F.col("l_partkey").cast("string").alias("StockCode"),
        F.when(_hit("desc_null"), F.lit(None).cast("string"))
         .when(_hit("desc_blank"), F.concat(F.lit(" "), F.col("p_name"), F.lit(" ")))
         .otherwise(F.col("p_name")).alias("Description"),
        (F.col("l_quantity").cast("int") * sign("qty_neg")).alias("Quantity"),
        F.when(_hit("date_bad"), F.lit(BAD_DATE_TEXT)).otherwise(ts_text).alias("InvoiceDate"),
        (F.col("p_retailprice") * sign("price_neg")).alias("UnitPrice"),
        F.when(_hit("cust_null"), F.lit(None).cast("double"))
         .otherwise(F.col("o_custkey").cast("double")).alias("CustomerID"),
        F.col("n_name").alias("Country"),
        *RETAIL_ORDER_COLS,
    )


# The keys that the feed's joins look up.
_LOOKED_UP = {"orders": "o_orderkey", "customer": "c_custkey", "nation": "n_nationkey", "part": "p_partkey"}


def count_events(spark: SparkSession, sf_dir: str) -> int:
    """Rows of :func:`retail_events`, for which lineitem need not be joined unless a looked-up key is held twice."""
    for name, key in _LOOKED_UP.items():
        keys = read_table(spark, sf_dir, name).where(F.col(key).isNotNull())
        if not keys.groupBy(key).count().where("count > 1").isEmpty():
            return retail_events(spark, sf_dir).count()
    return read_table(spark, sf_dir, "lineitem").count()
