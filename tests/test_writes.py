"""Upsert into the stored table, the keyed layout, published tables, observed counters, plan metrics."""

import datetime as dt
import json
import os
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tillflow import schema as S
from tillflow.operators.metrics import observe_metrics
from tillflow.operators.store import change_set, find_first, mark_present, upsert_latest
from tillflow.operators.validate import validate_events
from tillflow.plans import explain as X
from tillflow.plans import table as TBL
from tillflow.plans.ingest import ingest
from tillflow.plans.jobs import ingest_job, upsert_table
from tillflow.session import remove_path, shared_path
from tillflow.sources.tables import RETAIL_ORDER_COLS, retail_events

COLS = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.STORE_SCHEMA.fields)
TABLE = COLS + ", query_id string, batch_id long, invoice_month string"


def row(key, month, day, text, *more):
    return (key, "A", text, 1, dt.datetime(2011, month, day), D("1.00"), "10", "UK", D("1.00"), *more)


def stored(spark, rows):
    return spark.createDataFrame([(*r, "q", 0, f"2011_{r[4].month:02d}") for r in rows], TABLE)


def files(path):
    path = path.removeprefix("file:")
    assert os.path.isdir(path)
    return {os.path.relpath(os.path.join(d, f), path) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_upsert_rewrites_touched_months_only(spark, scratch):
    TBL.write_partitioned(stored(spark, [row("1", 1, 3, "late"), row("1", 2, 1, "later"), row("2", 2, 1, "other"), row("3", 3, 1, "far")]), scratch)
    before = files(scratch)
    incoming = spark.createDataFrame([row("1", 9, 9, "first", 1), row("1", 9, 8, "last", 2), row("4", 4, 5, "n1", 1), row("4", 4, 6, "n2", 2)],
                                     COLS + ", seq int")
    said = upsert_table(spark, scratch, incoming, ["seq"], query_id="up", batch_id=7)
    assert said == {"updated": 1, "inserted": 1, "months": 2}
    got = sorted((r["InvoiceNo"], r["InvoiceDate"].month, r["InvoiceDate"].day, r["Description"], r["query_id"], r["batch_id"])
                 for r in spark.read.parquet(scratch).collect())
    assert got == [("1", 1, 3, "last", "q", 0), ("1", 2, 1, "later", "q", 0), ("2", 2, 1, "other", "q", 0), ("3", 3, 1, "far", "q", 0),
                   ("4", 4, 5, "n2", "up", 7)]
    after = files(scratch)
    for month in ("2011_02", "2011_03"):
        assert {f for f in before if month in f} == {f for f in after if month in f}
    assert not {f for f in before if "2011_01" in f} & after
    # the same input again changes nothing
    upsert_table(spark, scratch, incoming, ["seq"], query_id="up", batch_id=7)
    assert got == sorted((r["InvoiceNo"], r["InvoiceDate"].month, r["InvoiceDate"].day, r["Description"], r["query_id"], r["batch_id"])
                         for r in spark.read.parquet(scratch).collect())


def test_upsert_creates_the_table_and_takes_no_rows(spark, scratch):
    incoming = spark.createDataFrame([row("1", 1, 3, "a", 1), row("2", 2, 3, "b", 1)], COLS + ", seq int")
    assert upsert_table(spark, scratch, incoming.limit(0), ["seq"]) == {"updated": 0, "inserted": 0, "months": 0}
    assert upsert_table(spark, scratch, incoming, ["seq"]) == {"updated": 0, "inserted": 2, "months": 2}
    before = files(scratch)
    assert upsert_table(spark, scratch, incoming.limit(0), ["seq"])["months"] == 0
    assert files(scratch) == before and spark.read.parquet(scratch).count() == 2


def test_upsert_computes_its_input_once_and_joins_the_target_once(spark, scratch):
    TBL.write_partitioned(stored(spark, [row("1", 1, 3, "x")]), f"{scratch}/t")
    spark.createDataFrame([row("1", 9, 9, "y", 1)], COLS + ", seq int").write.parquet(f"{scratch}/in")
    plan = X.plan_text(upsert_latest(spark.read.parquet(f"{scratch}/t"), spark.read.parquet(f"{scratch}/in"), ["seq"]), "simple")
    # the key columns were read before the plan; what is left is one read of the whole rows
    assert f"{scratch}/in" not in plan
    reads = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert len(reads) == 1 and "Description" in reads[0]


def test_first_rows_are_found_in_the_key_columns(spark, scratch):
    TBL.write_partitioned(stored(spark, [row("1", 1, 3, "x")]), scratch)
    change = change_set(spark.createDataFrame([row("1", 9, 9, "y", 1)], COLS + ", seq int"), ["seq"])
    (read,) = X.read_schemas(find_first(spark.read.parquet(scratch), change, keep=[S.PARTITION_COLUMN]))
    assert read.count(":") == 3 and "Description" not in read


def test_a_large_change_set_is_not_broadcast(spark, monkeypatch):
    from tillflow.operators import store
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tgt = spark.createDataFrame([row("1", 1, 1, "old")], COLS)
        inc = spark.createDataFrame([row("1", 1, 2, "n" * 5_000, 1)], COLS + ", seq int")
        assert "BroadcastHashJoin" in X.plan_text(upsert_latest(tgt, inc, ["seq"], incoming_rows_bound=1), "simple")
        monkeypatch.setattr(store, "BROADCAST_MAX_BYTES", 1_000)
        plan = X.plan_text(upsert_latest(tgt, inc, ["seq"], incoming_rows_bound=1), "simple")
        assert "BroadcastHashJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_change_set_takes_first_and_last(spark):
    inc = spark.createDataFrame([row("1", 1, 5, "a", 2), row("1", 1, 6, "b", 1), row("1", 1, 7, "c", 3)], COLS + ", seq int")
    got = change_set(inc, ["seq"]).first()
    assert got["_keep"]["InvoiceDate"] == dt.datetime(2011, 1, 6) and got["_set"]["Description"] == "c"


@pytest.fixture()
def keyed(spark, scratch):
    TBL.create_keyed_table(spark, "keyed_test", 6, scratch)
    TBL.append_keyed(spark, "keyed_test", stored(spark, [row(str(i), 1 + i % 3, 1, "x") for i in range(60)]))
    yield "keyed_test"
    spark.sql("DROP TABLE keyed_test")


def test_keyed_join_leaves_the_table_unshuffled(spark, keyed):
    assert TBL.table_buckets(spark, keyed) == 6 and spark.table(keyed).count() == 60
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = stored(spark, [row(str(i), 1 + i % 3, 1, "y") for i in range(50, 70)])
        marked = mark_present(batch, spark.table(keyed))
        lines = X.plan_text(marked, "simple").splitlines()
        scan = next(i for i, line in enumerate(lines) if "FileScan parquet" in line)
        depth = len(lines[scan]) - len(lines[scan].lstrip(" :+-*()0123456789"))
        over = []
        for line in reversed(lines[:scan]):  # the nodes above the scan, by their indent
            own = len(line) - len(line.lstrip(" :+-*()0123456789"))
            if own < depth:
                over.append(line)
                depth = own
        assert any("SortMergeJoin" in line for line in over) and not any("Exchange" in line for line in over)
        assert sorted(r["outcome"] for r in marked.collect()) == ["Duplicate"] * 10 + ["inserted"] * 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_keyed_append_writes_one_file_a_month_and_bucket(spark, keyed, scratch):
    first = files(scratch)
    assert len(first) <= 3 * 6
    TBL.append_keyed(spark, keyed, stored(spark, [row("99", 5, 1, "z")]))
    assert len(files(scratch) - first) == 1 and spark.table(keyed).where("invoice_month = '2011_05'").count() == 1
    with pytest.raises(ValueError, match="isn't a keyed table"):
        TBL.create_table(spark, "plain_test", f"{scratch}_plain")
        TBL.table_buckets(spark, "plain_test")
    spark.sql("DROP TABLE plain_test")


def test_a_reader_never_finds_no_table(spark, scratch):
    for name, rows in (("swap_old", 1), ("swap_new", 2)):
        TBL.create_table(spark, name, f"{scratch}/{name}")
        TBL.write_partitioned(stored(spark, [row(str(i), 1, 1, "x") for i in range(rows)]), f"{scratch}/{name}")
        TBL.register_partitions(spark, name)
    TBL.publish(spark, "swap_view", "swap_old")
    assert spark.table("swap_view").count() == 1
    TBL.publish(spark, "swap_view", "swap_new")
    assert spark.table("swap_view").count() == 2
    spark.sql("DROP VIEW swap_view")
    for name in ("swap_old", "swap_new"):
        spark.sql(f"DROP TABLE {name}")


def test_observed_counters_need_no_job(spark, scratch):
    """The counters of a batch job come with the checkpoint: as many jobs as without counting, one fewer than with."""
    resolved = ingest(validate_events(retail_events(spark, SF_SMALL)), RETAIL_ORDER_COLS).resolved.checkpoint()
    tracker, sc = spark.sparkContext.statusTracker(), spark.sparkContext

    def jobs(name, run):
        sc.setJobGroup(name, name)
        try:
            out = run()
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
        return out, len(tracker.getJobIdsForGroup(name))

    def watched():
        frame, counters = observe_metrics(resolved)
        frame.checkpoint()
        return counters.get
    alone = jobs("alone", resolved.checkpoint)[1]
    got, with_counts = jobs("watched", watched)
    want, extra = jobs("counted", lambda: ingest(validate_events(retail_events(spark, SF_SMALL)), RETAIL_ORDER_COLS).metrics().first().asDict())
    assert got == want and with_counts == alone and extra >= 1


def test_job_stores_observed_counters(spark, scratch):
    v = validate_events(retail_events(spark, SF_SMALL))
    said = ingest_job(spark, v, RETAIL_ORDER_COLS, f"{scratch}/t", None, f"{scratch}/m")
    assert said == ingest(v, RETAIL_ORDER_COLS).metrics().first().asDict()
    assert spark.read.parquet(f"{scratch}/m").first()["received"] == said["received"]


def test_plan_metrics_show_pruned_rows(spark, scratch):
    """Rows out of scan, join and exchange of the plan that ran."""
    TBL.write_partitioned(stored(spark, [row(str(i), 1 + i % 4, 1, "x") for i in range(40)]), scratch)
    table = spark.read.parquet(scratch)
    assert X.rows_out(table, "Scan parquet") == [40]
    assert X.rows_out(table.where("invoice_month = '2011_02'"), "Scan parquet") == [10]
    per = table.groupBy("invoice_month").agg(F.count(F.lit(1)).alias("n"))
    nodes = X.plan_metrics(per)
    assert [n["rows"] for n in nodes if n["node"].startswith("HashAggregate")][0] == 4
    exchange = [n for n in nodes if n["node"].startswith("Exchange")]
    assert exchange and exchange[0]["rows"] >= 4
    assert any(n["time_ms"] is not None for n in nodes) and nodes[-1]["files"] >= 4
    assert "Scan parquet" in X.explain_analyze(per)
    joined = table.alias("a").join(table.alias("b"), ["InvoiceNo"]).where("a.invoice_month = '2011_01'")
    assert any("Join" in n["node"] and n["rows"] == 10 for n in X.plan_metrics(joined))


def test_remove_path_takes_shared_paths_only(spark):
    path = shared_path(spark, "gone")
    spark.range(3).write.parquet(path)
    remove_path(spark, path)
    assert not os.path.exists(path.removeprefix("file:"))
    with pytest.raises(ValueError, match="isn't a shared path"):
        remove_path(spark, "/tmp")


def test_backup_and_sink_keep_blanks_and_quotes(spark, scratch):
    from tillflow.sources.files import write_backup_csv
    write_backup_csv(stored(spark, [row("1", 1, 1, ' a "b", c ')]), scratch, "q", 0)
    text = spark.read.text(f"{scratch}/query_id=q/batch_id=0").first()[0]
    assert json.loads(json.dumps(text)).startswith('1,A," a ""b"", c ",1,2011-01-01 00:00:00')


def test_rows_of_a_table_are_written_without_a_shuffle(spark, scratch, monkeypatch):
    TBL.write_partitioned(stored(spark, [row(str(i), 1 + i % 4, 1, "x") for i in range(40)]), f"{scratch}/a")
    rows = spark.read.parquet(f"{scratch}/a")

    def fail(*args):
        raise AssertionError("shuffled")
    monkeypatch.setattr(TBL, "layout_for_write", fail)
    TBL.write_partitioned(rows, f"{scratch}/b", laid_out=True)
    again = spark.read.parquet(f"{scratch}/b")
    assert sorted(map(str, again.select(*rows.columns).collect())) == sorted(map(str, rows.collect()))


def test_change_set_carries_two_rows_a_key_and_takes_any_key(spark):
    from tillflow import schema as S
    inc = spark.createDataFrame([row("1", 2, 1, "a", 2), row("1", 2, 1, "b", 1), row("1", 3, 1, "c", 3)], COLS + ", seq int")
    change = change_set(inc, ["seq"], S.TRIPLE_KEY)
    assert "min_by" not in change._jdf.queryExecution().analyzed().toString()
    got = {r["InvoiceDate"]: r for r in change.collect()}
    assert len(got) == 2 and all(r["_keep"]["InvoiceDate"] == at for at, r in got.items())
    assert sorted(r["_set"]["Description"] for r in got.values()) == ["a", "c"]


def test_a_larger_table_gets_more_buckets():
    from tillflow.plans import write_queries as W
    assert W._buckets(10) == W.KEYED_BUCKETS and W._buckets(100 * W.BUCKET_ROWS) == 100


def test_csv_sink_query_writes_compressed_text(spark, scratch, monkeypatch):
    import pathlib
    from tests.conftest import SF_SMALL
    from tillflow.plans import write_queries as W
    monkeypatch.setattr(W, "shared_path", lambda *_: scratch)
    rows = W.q_csv_sink_roundtrip(spark, SF_SMALL)
    assert rows.count() > 0
    parts = [p for d in ("src", "out") for p in pathlib.Path(scratch.removeprefix("file:"), d).glob("part-*")]
    assert parts and all(p.name.endswith(".lz4") for p in parts)
