"""Cleaning chain semantics on hand-made rows."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillflow import schema as S
from tillflow.operators.validate import validate_events
from tillflow.plans.ingest import ingest

ORDER = ["seq"]


def feed(spark, rows):
    """rows: (seq, InvoiceNo, StockCode, Description, Quantity, InvoiceDate,
    UnitPrice, CustomerID, Country)"""
    schema = "seq long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}"
                                      for f in S.EVENT_SCHEMA.fields)
    return validate_events(spark.createDataFrame(rows, schema))


def R(seq, inv="1", stock="A", q=1, date="2010-12-01 08:26:00", price=1.0,
      cust=17850.0, country="UK", desc="RED MUG"):
    return (seq, inv, stock, desc, q, date, price, cust, country)


def outcomes(res):
    return {r["StockCode"]: r["outcome"] for r in res.resolved.collect() if r["StockCode"]}


def test_dedupe_precedes_sign_filter(spark):
    # first row of key (1, A) is negative: the later valid one is lost too
    res = ingest(feed(spark, [R(2, q=5), R(1, q=-3)]), ORDER)
    m = res.metrics().first()
    assert m["in_batch_duplicates"] == 1 and m["sign_dropped"] == 1 and m["success"] == 0


def test_first_row_by_arrival_not_input_order(spark):
    res = ingest(feed(spark, [R(9, q=9), R(3, q=3), R(5, q=5)]), ORDER)
    assert [r["Quantity"] for r in res.stored().collect()] == [3]


def test_signs_zero_and_nan(spark):
    rows = [R(1, stock="Z", q=0, price=0.0), R(2, stock="N", price=float("nan")),
            R(3, stock="P", price=-0.01), R(4, stock="Q", q=-1)]
    # NaN is refused by validation (it serialises to JSON null)
    res = ingest(feed(spark, rows), ORDER)
    got = outcomes(res)
    assert got["Z"] == "inserted" and got["P"] == S.OUTCOME_SIGN_DROP
    assert got["Q"] == S.OUTCOME_SIGN_DROP
    assert [(d["reason"], d["error"]) for d in res.dlq().collect()] == [
        (S.REASON_SCHEMA, "UnitPrice:null")]


def test_nan_price_from_messages_is_a_sign_drop(spark):
    from tillflow.operators.validate import validate_messages
    text = ('{"InvoiceNo":"1","StockCode":"A","Description":"d","Quantity":1,'
            '"InvoiceDate":"2010-12-01 08:26:00","UnitPrice":"nan","CustomerID":1,"Country":"UK"}')
    df = spark.createDataFrame([(0, text)], "seq long, value string")
    m = ingest(validate_messages(df), ORDER).metrics().first()
    assert m["sign_dropped"] == 1


def test_customer_id_text_and_total(spark):
    rows = [R(1, stock="A", cust=17850.0, q=6, price=1.65), R(2, stock="B", cust=2.5)]
    got = {r["StockCode"]: r for r in ingest(feed(spark, rows), ORDER).stored().collect()}
    assert got["A"]["CustomerID"] == "17850" and got["B"]["CustomerID"] == "2.5"
    assert got["A"]["TotalAmount"] == Decimal("9.90")
    assert got["A"]["UnitPrice"] == Decimal("1.65")
    assert got["A"][S.PARTITION_COLUMN] == "2010_12"


@pytest.mark.parametrize("date", ["bad-date", "2010-12-01", "2010-12-01T08:26:00",
                                  "2010-13-01 00:00:00", "0001-01-01 00:00:00",
                                  "2999-01-01 00:00:00"])
def test_bad_dates_routed(spark, date):
    res = ingest(feed(spark, [R(1, date=date)]), ORDER)
    dlq = res.dlq().collect()
    assert [(d["reason"], d["error"]) for d in dlq] == [(S.REASON_BAD_DATE, "InvoiceDate:format")]
    assert '"InvoiceDate":"%s"' % date in dlq[0]["data"]


def test_store_rejects(spark):
    from tillflow.operators.validate import validate_messages
    big = ('{"InvoiceNo":"1","StockCode":"A","Description":"d","Quantity":2147483648,'
           '"InvoiceDate":"2010-12-01 08:26:00","UnitPrice":1,"CustomerID":1,"Country":"UK"}')
    long_country = (big.replace("2147483648", "1").replace('"UK"', '"%s"' % ("X" * 51))
                    .replace('"A"', '"B"'))
    pricey = (big.replace("2147483648", "1").replace('"UnitPrice":1', '"UnitPrice":1e9')
              .replace('"A"', '"C"'))
    df = spark.createDataFrame([(0, big), (1, long_country), (2, pricey)], "seq long, value string")
    errs = sorted(r["error"] for r in ingest(validate_messages(df), ORDER).dlq().collect())
    assert errs == ["Country:length", "Quantity:int_range;TotalAmount:decimal_range",
                    "UnitPrice:decimal_range;TotalAmount:decimal_range"]


def test_no_partition_rule(spark):
    rows = [R(1, stock="A"), R(2, stock="B", date="2013-01-01 00:00:00")]
    res = ingest(feed(spark, rows), ORDER, allowed_months=["2010_12"])
    assert outcomes(res) == {"A": "inserted", "B": S.REASON_NO_PARTITION}


def test_one_digit_date_fields(spark):
    res = ingest(feed(spark, [R(1, date="2010-12-1 8:26:00")]), ORDER)
    assert str(res.stored().first()["InvoiceDate"]) == "2010-12-01 08:26:00"


def test_scope_limits_dedupe(spark):
    """A key survives once per scope, and the table's unique rule takes the first of them."""
    rows = [R(1, q=1), R(2, q=2), R(3, q=3), R(4, q=4, date="2010-12-01 09:00:00")]
    df = feed(spark, rows).withColumn("scope", F.floor(F.col("seq") / 2))
    res = ingest(df, ORDER, scope_cols=["scope"])
    assert [r["Quantity"] for r in res.stored().collect()] == [1, 4]
    m = res.metrics().first()
    assert (m["in_batch_duplicates"], m["success"], m["failed"]) == (1, 2, 1)
    assert [r["reason"] for r in res.dlq().collect()] == [S.REASON_DUPLICATE]


def test_rejects_of_one_key_and_order_all_arrive(spark):
    from tillflow.operators.validate import validate_messages
    bad = [(0, "{x"), (0, "{y"), (0, "{z"), (0, '{"InvoiceNo": "1"}'), (0, '{"InvoiceNo": "1"}')]
    res = ingest(validate_messages(spark.createDataFrame(bad, "seq long, value string")), ORDER)
    m = res.metrics().first()
    assert (m["received"], m["malformed"], m["invalid"], m["in_batch_duplicates"]) == (5, 3, 5, 0)
    assert sorted(r["data"] for r in res.dlq().collect())[-3:] == ["{x", "{y", "{z"]


def test_reconciliation_and_no_python(spark):
    from tests.conftest import SF_SMALL
    from tillflow.plans.explain import has_python_udf
    from tillflow.plans.registry import q_ingest_metrics, q_clean_rows
    m = q_ingest_metrics(spark, SF_SMALL).first().asDict()
    parts = ["invalid", "in_batch_duplicates", "null_dropped", "sign_dropped", "bad_date",
             "store_reject", "no_partition", "processed"]
    assert m["received"] == sum(m[p] for p in parts)
    assert m["received"] == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert not has_python_udf(q_clean_rows(spark, SF_SMALL))


def test_branches_of_an_ingest_share_the_dedupe_shuffle(spark, scratch):
    """Rows by outcome and the keys' first places come from one aggregate, computed once."""
    spark.createDataFrame(
        [(str(i % 7), "A", "d", 1, "2011-01-02 03:04:05", 1.0, 1.0, "UK", i % 3, i) for i in range(40)],
        "InvoiceNo string, StockCode string, Description string, Quantity int, InvoiceDate string, UnitPrice double, "
        "CustomerID double, Country string, scope int, pos int").write.parquet(scratch)
    rows = spark.read.parquet(scratch)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = ingest(validate_events(rows), ["pos"], scope_cols=["scope"]).dlq()
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("- Exchange hashpartitioning(scope") == 1
        assert found.count() == 14  # seven keys, each in three scopes
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_full_time_text_is_read_like_the_pattern(spark):
    from tillflow.functions.scalar import parse_invoice_ts
    texts = ["2011-01-02 03:04:05", "2011-1-2 3:4:5", "2011-02-30 00:00:00", "2011-01-01 24:00:00", "2012-02-29 23:59:59",
             "2011-01-02 03:04:05\n", "0000-01-01 00:00:00", "1500-01-01 00:00:00", "2011-01-02T03:04:05", " 2011-01-02 03:04:05",
             "2011-01-02 03:04:60", "٢٠١١-01-02 03:04:05", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    by_pattern = F.try_to_timestamp("t", F.lit(S.WIRE_TS_PARSE_FORMAT)).cast("timestamp_ntz")
    lo, hi = (F.lit(t).cast("timestamp_ntz") for t in S.TS_RANGE)
    got = df.select("t", parse_invoice_ts("t").alias("got"), F.when((by_pattern >= lo) & (by_pattern <= hi), by_pattern).alias("want"))
    assert [r for r in got.collect() if r.got != r.want] == []
    assert got.where("got is not null").count() >= 3
