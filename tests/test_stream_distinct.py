"""The bounded distinct: late and repeated events, restarts, and the size of its state."""

import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tillflow import schema as S
from tillflow.operators.validate import validate_messages
from tillflow.plans import write_queries as W
from tillflow.plans.write_queries import DISTINCT_DELAY, q_stream_distinct
from tillflow.sources.files import read_messages_stream, to_messages
from tillflow.streaming.dedupe import ROCKSDB_PROVIDER, keyed_events, start_distinct, state_rows

SCHEMA = "InvoiceNo string, StockCode string, event_time timestamp"


def drain(spark, root, rows):
    days = [(key, "A", dt.datetime(2020, 1, 1) + dt.timedelta(days=day - 1)) for key, day in rows]
    spark.createDataFrame(days, SCHEMA).repartition(2).write.mode("append").parquet(f"{root}/src")
    query = start_distinct(spark.readStream.schema(SCHEMA).parquet(f"{root}/src"), f"{root}/out", f"{root}/ckpt", "5 days", available_now=True)
    query.awaitTermination()
    out = sorted((r[0], (r[2] - dt.datetime(2020, 1, 1)).days + 1) for r in spark.read.parquet(f"{root}/out").collect())
    return out, state_rows(query), query


def test_late_repeated_and_expired(spark, scratch):
    out, held, query = drain(spark, scratch, [("a", 1), ("b", 10), ("c", 3), ("c", 3)])
    assert out == [("a", 1), ("b", 10), ("c", 3)]
    assert any("rocksdb" in name.lower() for name in query.recentProgress[0]["stateOperators"][0]["customMetrics"])
    # the watermark is day 5: on or before it is late, b is held, e is new
    out, held, _ = drain(spark, scratch, [("a", 1), ("l", 5), ("f", 6), ("b", 10), ("g", 20)])
    assert out == [("a", 1), ("b", 10), ("c", 3), ("f", 6), ("g", 20)]
    assert held == 1  # day 15: only g is held any more
    # b came last on day 10, so it is new on day 30; g is held until day 25
    out, held, _ = drain(spark, scratch, [("b", 30), ("g", 20), ("h", 15)])
    assert out == [("a", 1), ("b", 10), ("b", 30), ("c", 3), ("f", 6), ("g", 20)] and held == 1
    # nothing new: nothing is written again
    query = start_distinct(spark.readStream.schema(SCHEMA).parquet(f"{scratch}/src"), f"{scratch}/out", f"{scratch}/ckpt", "5 days", available_now=True)
    query.awaitTermination()
    assert spark.read.parquet(f"{scratch}/out").count() == 6


def test_provider_is_set_for_the_stream_only(spark, scratch):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    drain(spark, scratch, [("a", 1)])
    assert spark.conf.get(name) == before != ROCKSDB_PROVIDER


def test_state_stays_within_the_delay(spark, scratch):
    """Messages of the whole feed, validated on the way: what is held at the end lies within the delay."""
    from tillflow.sources.tables import retail_events
    to_messages(retail_events(spark, SF_SMALL)).write.text(f"{scratch}/src")
    events = keyed_events(validate_messages(read_messages_stream(spark, f"{scratch}/src")))
    query = start_distinct(events, f"{scratch}/out", f"{scratch}/ckpt", DISTINCT_DELAY, available_now=True)
    query.awaitTermination()
    out = spark.read.parquet(f"{scratch}/out")
    last = out.agg(F.max("event_time")).first()[0]
    within = out.where(F.col("event_time") > F.lit(last - dt.timedelta(days=180))).count()
    assert 0 < state_rows(query) <= within < out.count()
    assert out.count() == out.select("InvoiceNo", "StockCode").distinct().count()


def test_query_lets_some_keys_through_twice(spark):
    out = q_stream_distinct(spark, SF_SMALL)
    keys = out.groupBy("InvoiceNo", "StockCode").count()
    assert keys.where("count = 2").count() > 0 and keys.where("count > 2").count() == 0


def test_state_partitions_kept_over_a_restart_and_settings_put_back(spark, scratch):
    names = ["spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"]
    before = [spark.conf.get(n, None) for n in names]

    def run(partitions):
        query = start_distinct(spark.readStream.schema(SCHEMA).parquet(f"{scratch}/src"), f"{scratch}/out", f"{scratch}/ckpt", "5 days",
                               available_now=True, partitions=partitions, count_state=False)
        query.awaitTermination()
        return {p["stateOperators"][0]["numShufflePartitions"] for p in query.recentProgress if p["stateOperators"]}
    spark.createDataFrame([("a", "A", dt.datetime(2020, 1, 1)), ("b", "A", dt.datetime(2020, 1, 9))], SCHEMA).write.parquet(f"{scratch}/src")
    assert run(3) == {3}
    again = [("b", "A", dt.datetime(2020, 1, 9)), ("a", "A", dt.datetime(2020, 1, 2)), ("c", "A", dt.datetime(2020, 1, 8))]
    spark.createDataFrame(again, SCHEMA).write.mode("append").parquet(f"{scratch}/src")
    assert run(5) == {3}  # those of the checkpoint
    # b is held and the second a late, though the held keys aren't counted
    assert sorted(r[0] for r in spark.read.parquet(f"{scratch}/out").collect()) == ["a", "b", "c"]
    assert [spark.conf.get(n, None) for n in names] == before


def test_state_partitions_grow_with_the_feed(spark):
    cores = spark.sparkContext.defaultParallelism
    assert W._state_partitions(spark, 10) == W._state_partitions(spark, 0) == 2 * cores
    assert W._state_partitions(spark, 216_000_000) == 216 and W._state_partitions(spark, 216_000_001) == 217


def test_deliveries_hold_each_event_as_often_as_it_comes(spark):
    """Also repeated events, and ones without a time or a key."""
    dates = ["1996-05-06 07:08:09", "1996-02-29 00:00:00", "1997-01-01 00:00:00", "1998-12-31 23:59:00", "1999-01-01 00:00:00", "bad-date", None]
    rows = [(None if k == 10 else str(k), "20", None, 1, d, 2.0, None, "x") for k in range(11) for d in dates for _ in range(2)]
    feed = spark.createDataFrame(rows, "InvoiceNo string, StockCode string, Description string, Quantity int, InvoiceDate string, "
                                 "UnitPrice double, CustomerID double, Country string")
    expected = []
    for r in rows:
        key, date = r[0], r[4]
        if date is None or date == "bad-date":
            continue
        old, middle, h = date < "1997", "1997" <= date < "1999", None if key is None else (int(key) + 20) % 10
        if old and h is not None and h != 3:
            expected.append((0, key, date))
        if middle or old and h in (3, 4):
            expected.append((1, key, date))
        if date >= "1999" or middle and h == 6:
            expected.append((2, key, date))
        if old and h == 5:
            expected.append((2, key, "2001-05-06 07:08:09" if date.startswith("1996-05") else "2001-02-28 00:00:00"))
    got = [(r["delivery"], r["InvoiceNo"], r["InvoiceDate"]) for r in W._deliveries(feed).collect()]
    order = lambda r: (r[0], r[1] or "", r[2])
    assert sorted(got, key=order) == sorted(expected, key=order)


def test_time_is_parsed_once(spark, scratch):
    to_messages(spark.createDataFrame([("1", "2", "d", 1, "2020-01-01 00:00:00", 2.0, 3.0, "x")], S.WIRE_SCHEMA)).write.text(scratch)
    events = keyed_events(validate_messages(spark.read.text(scratch)))
    assert events._jdf.queryExecution().optimizedPlan().toString().count("RLIKE(InvoiceDate") == 1
    assert events.collect() == [("1", "2", dt.datetime(2020, 1, 1))]


def test_fields_not_wanted_are_checked_all_the_same(spark):
    good = '"InvoiceNo": "1", "StockCode": "2", "Quantity": 1, "InvoiceDate": "2020-01-01 00:00:00", "UnitPrice": 2.5, "CustomerID": 3.0'
    texts = ['{%s, "Description": "d", "Country": "c"}' % good, '{%s, "Description": 4, "Country": "c"}' % good,
             '{%s, "Description": "d", "Country": null}' % good, '{%s, "Country": "c"}' % good,
             '{%s, "Description": "d", "Country": "c"}' % good.replace("2.5", '"x"'), "{bad", "[1]", None]
    frame = spark.createDataFrame([(t,) for t in texts], "value string")
    wanted = ["InvoiceNo", "StockCode", "InvoiceDate"]
    got = validate_messages(frame, fields=wanted)
    assert got.columns == [*wanted, "error", "reason", "raw"]
    assert sorted(map(str, got.collect())) == sorted(map(str, validate_messages(frame).select(got.columns).collect()))
    assert got.where("reason IS NULL").count() == 1
