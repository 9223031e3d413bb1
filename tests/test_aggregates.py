"""Dashboard aggregates, window and text functions."""

import datetime as dt

from pyspark.sql import functions as F

from tillflow.functions import scalar as FN
from tillflow.operators import aggregates as A
from tillflow.operators.window import time_window

DASH = "description string, quantity int, invoicedate timestamp_ntz, country string, totalamount decimal(10,2)"


def frame(spark, rows):
    return spark.createDataFrame(rows, DASH)


def T(h, m=0):
    return dt.datetime(2010, 12, 1, h, m)


def test_kpi_empty_is_zero(spark):
    r = A.kpi(frame(spark, [])).first()
    assert (r["total_sales"], r["total_transactions"], r["avg_transaction_value"]) == (0.0, 0, 0.0)


def test_kpi_counts_rows(spark):
    from decimal import Decimal as D
    r = A.kpi(frame(spark, [("a", 1, T(1), "UK", D("1.50")), ("a", 1, T(1), "UK", D("2.50"))])).first()
    assert r["total_sales"] == 4.0 and r["total_transactions"] == 2 and r["avg_transaction_value"] == 2.0


def test_top_k_ties_and_nulls(spark):
    from decimal import Decimal as D
    rows = [(k, 5, T(1), "UK", D("1")) for k in ["d", "c", "b", "a"]] + [(None, 99, T(1), "UK", D("1"))]
    got = [r["description"] for r in A.top_products(frame(spark, rows), 3).collect()]
    assert got == ["a", "b", "c"]


def test_hourly_and_absent_hours(spark):
    from decimal import Decimal as D
    rows = [("a", 1, T(8), "UK", D("1")), ("a", 1, T(8, 30), "UK", D("2")), ("a", 1, T(23), "UK", D("4"))]
    got = [(r["hour"], r["revenue"]) for r in A.hourly_revenue(frame(spark, rows)).collect()]
    assert got == [(8, 3.0), (23, 4.0)]


def test_country_share_of_top_n(spark):
    from decimal import Decimal as D
    rows = [("a", 1, T(1), c, D(v)) for c, v in [("A", "60"), ("B", "30"), ("C", "10"), ("D", "1")]]
    got = {r["country"]: r["share_pct"] for r in A.country_share(frame(spark, rows), 3).collect()}
    assert set(got) == {"A", "B", "C"} and abs(sum(got.values()) - 100.0) < 1e-9
    assert abs(got["A"] - 60.0) < 1e-9


def test_first_word_python_whitespace(spark):
    from decimal import Decimal as D
    rows = [(d, 1, T(1), "UK", D("1")) for d in
            ["  SET 2 TEA", " MUG x", "CUP\x1cLID", "   ", "PLAIN"]]
    got = {r["category"] for r in A.category_sales(frame(spark, rows)).collect()}
    assert got == {"SET", "MUG", "CUP", "PLAIN"}


def test_text_functions(spark):
    df = spark.createDataFrame([(1234.5, 12.25, 1234567)], "m double, p double, n long")
    r = df.select(FN.money_text("m").alias("m"), FN.percent_text("p").alias("p"),
                  FN.count_text("n").alias("n")).first()
    assert (r["m"], r["p"], r["n"]) == ("$1,234.50", "12.3%", "1,234,567")


def test_window_bounds_inclusive(spark):
    from decimal import Decimal as D
    now = dt.datetime(2010, 12, 1, 12, 0)
    rows = [("a", 1, t, "UK", D("1")) for t in [T(11, 30), T(11, 29), T(12, 0), T(12, 1), T(9)]]
    df = frame(spark, rows)
    n = lambda d: time_window(df, d, now, "invoicedate").count()
    assert n("30 minutes") == 2 and n("1 hour") == 3 and n("3 hours") == 4
    assert n("All time") == 5 and n("something else") == n("24 hours") == 4


def test_anchor_now_keeps_time():
    got = FN.anchor_now(dt.datetime(2025, 6, 7, 13, 14, 15))
    assert got == dt.datetime(2010, 12, 1, 13, 14, 15)


def test_iso_and_month_label(spark):
    df = spark.createDataFrame([(T(14, 34),)], "t timestamp_ntz")
    r = df.select(FN.iso_timestamp_text("t").alias("i"), FN.month_label("t").alias("m"),
                  FN.add_month(F.col("t").cast("date")).alias("n")).first()
    assert r["i"] == "2010-12-01T14:34:00" and r["m"] == "2010_12" and r["n"] == dt.date(2011, 1, 1)
