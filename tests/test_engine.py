"""Transform, guards, store, loads, streaming and command line, end to end on a local store."""

from argparse import Namespace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import cli
from tidemark.errors import EngineError
from tidemark.functions import expr
from tidemark.operators import guards, load, lookups, merge, reconcile, verify
from tidemark.operators.store import SnapshotStore
from tidemark.operators.transform import csv_transform, feed_transform
from tidemark.schema import COLUMNS, FACT, FEED_TARGETS
from tidemark.sources.fake import START, FakeFeed

FAST = {"probes": 1, "sleep": lambda s: None}


def one(spark, e, value, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(e(F.col("c"))).first()[0]


@pytest.fixture
def store(spark, tmp_path):
    return SnapshotStore(spark, f"file://{tmp_path}/store")


def test_schema():
    assert len(COLUMNS) == 44 and len(FEED_TARGETS) == 47 and len(FACT) == 48 and "Additional_Details" not in FEED_TARGETS


def test_dates(spark):
    assert one(spark, expr.parse_iso, "2026-08-01T01:02:03.456Z") == datetime(2026, 8, 1, 1, 2, 3, 456000)
    assert one(spark, expr.parse_iso, "2026-08-01") == datetime(2026, 8, 1) and one(spark, expr.parse_iso, "") is None and one(spark, expr.parse_iso, None) is None
    for bad in ("08/01/2026", "2026-13-01", "2026-08-01T00:00:00+05:00", "20260801", "2026-08"):
        with pytest.raises(Exception, match="not an ISO stamp"):
            one(spark, expr.parse_iso, bad)
        assert one(spark, lambda c: expr.parse_iso(c, False), bad) is None
    assert one(spark, expr.parse_csv_date, " 05/09/2026 12:32:59 PM ") == datetime(2026, 5, 9, 12, 32, 59)
    with pytest.raises(Exception, match="not a date"):
        one(spark, expr.parse_csv_date, "2026-05-09")


def test_scalars(spark):
    point = expr.geojson_to_wkt
    assert one(spark, point, '{"type":"Point","coordinates":[-73.90,40]}') == "POINT (-73.9 40)"
    assert [one(spark, point, x) for x in (None, "x", '{"coordinates":[]}', '{"coordinates":[1,2,3]}')] == [None] * 4
    assert one(spark, lambda c: expr.clip(c, 3), "éábc") == "éá" and one(spark, lambda c: expr.clip(c, 3), None) is None
    assert [one(spark, expr.lenient_double, x) for x in ("40.7", "abc", "", "NaN", " 1 ")] == [40.7, None, None, None, 1.0]
    assert [one(spark, expr.null_tokens, x) for x in ("N/A", "", "nan", " ", "x")] == [None, None, None, " ", "x"]
    with pytest.raises(Exception, match="not an integer"):
        one(spark, expr.strict_integer, "12x")


def test_feed_transform(spark):
    rows = [("12345", "2026-08-01T00:00:00.999", "C" * 200, "40.7", '{"coordinates":[-73.9,40.7]}')]
    r = feed_transform(spark.createDataFrame(rows, "unique_key string, created_date string, complaint_type string, latitude string, location string")).first()
    assert r["Unique_Key"] == 12345 and r["Created_Date"] == datetime(2026, 8, 1) and len(r["Problem"]) == 40 and r["Latitude"] == 40.7 and r["Location"] == "POINT (-73.9 40.7)" and r["City"] is None
    assert list(r.asDict()) == [c for c, f, _, _ in COLUMNS if f] + ["agency_id", "cb_id", "lt_id", "at_id"]


def test_guards(spark):
    batch = lambda *rows: spark.createDataFrame(list(rows), "Unique_Key long, Created_Date timestamp_ntz")
    now = datetime(2026, 8, 1)
    assert guards.batch_sanity(batch((1, now), (2, None)))["dated"] == 1 and guards.batch_sanity(batch())["rows"] == 0
    for bad in (batch((1, None), (2, None)), batch((None, now))):
        with pytest.raises(EngineError):
            guards.batch_sanity(bad)
    with pytest.raises(EngineError, match="distinct keys"):
        guards.primary_key(batch((1, now), (1, now)))
    with pytest.raises(EngineError, match="missing"):
        guards.shortfall(1001)
    with pytest.raises(EngineError, match="Closed_Date: 2"):
        guards.dates_parse(spark.createDataFrame([("x",), ("y",), ("",)], "`Closed Date` string"))


def test_lookups(spark):
    rows = spark.createDataFrame([("b",), ("B ",), ("a",), (None,), ("ä",)], "t string")
    dim = lookups.build_dim(rows, "t")
    assert [tuple(r) for r in dim.orderBy("id").collect()] == [(1, "B "), (2, "a"), (3, "ä")]
    more = lookups.extend_dim(spark.createDataFrame([("c",), ("A",), ("C",)], "t string"), "t", dim)
    assert [tuple(r) for r in more.orderBy("id").collect()] == [(1, "B "), (2, "a"), (3, "ä"), (4, "C")]
    assert [r["i"] for r in lookups.stamp_ids(rows, [(F.col("t"), dim, "i")]).collect()] == [1, 1, 2, None, 3]
    plan = lookups.stamp_ids(rows, [(F.col("t"), dim, "i")])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_merge(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, None, "z")], "k long, v string, extra string")
    new = spark.createDataFrame([(2, "B"), (3, None), (4, "d")], "k long, v string")
    assert {tuple(r) for r in merge.upsert(old, new, "k").collect()} == {(1, "a", "x"), (2, "B", "y"), (3, None, "z"), (4, "d", None)}
    assert merge.affected(old, new, "k").first().asDict() == {"inserted": 1, "updated": 1, "unchanged": 1, "affected": 3}


def test_incremental_and_reconcile(spark, store):
    source = FakeFeed(250, timedelta(hours=3))
    got = load.incremental(store, source, default_since=datetime(2026, 7, 1), page_size=100, **FAST)
    assert got["rows"] == 250 and store.fact().count() == 250 and store.manifest().watermark == got["watermark"]
    guards.primary_key(store.fact())
    guards.referenced(store.fact(), store.dims())
    assert {r["check"]: r["n"] for r in verify.orphan_checks(store.fact(), store.dims()).collect()} == {r: 0 for r in [f"{k} {i}" for k in ("orphan", "unmapped") for i in ("agency_id", "cb_id", "lt_id", "at_id")] + ["null Created_Date"]}
    assert store.dim("location_types").count() == 1  # Street and STREET
    source.touch(8)
    again = load.incremental(store, source, page_size=100, **FAST)
    assert again["rows"] >= 8 and store.fact().count() == 250
    assert load.incremental(store, source, page_size=100, dry_run=True, **FAST)["commits"] == 0
    class Counted:
        def counts(self, grain, low=None, high=None):
            return {r["period"]: r["n"] for r in reconcile.counts(store.fact(), "Created_Date", grain).collect()} | {"1999-01": 5}
    compared = cli.reconcile_run(spark, store, Counted(), "month")
    assert reconcile.totals(compared).first()["short"] == 5 and "<- DB short" in reconcile.report("t", compared)


def test_a_failed_load_keeps_the_watermark(spark, store):
    source = FakeFeed(120)
    fetch = source.fetch
    source.fetch = lambda r: [x | {"created_date": None} for x in fetch(r)] if r.ordered else fetch(r)
    with pytest.raises(EngineError):
        load.incremental(store, source, default_since=datetime(2026, 7, 1), page_size=50, **FAST)
    assert store.manifest().version == 0 and store.fact().count() == 0


def test_two_writers(store):
    a, b = store.manifest(), store.manifest()
    store.publish(a)
    with pytest.raises(EngineError, match="another writer"):
        store.publish(b)


def test_sweep(spark, store):
    source, end = FakeFeed(96, timedelta(hours=1)), START + timedelta(days=5)
    first = load.sweep(store, source, START, end, page_size=20)
    assert first["windows"] == 5 and first["rows"] == 96 and store.fact().count() == 96 and store.manifest().watermark is None
    assert load.sweep(store, source, START, end)["skipped"] == 5
    assert load.sweep(store, source, START, end, resweep=True)["affected"] == 0
    assert len(store.manifest().ledger) == 5


def test_parallel_sweep(spark, store):
    options = {"client": "tidemark.sources.fake:from_options", "rows": "500", "spread": "600", "page_size": "60"}
    end = START + timedelta(days=4)
    first = load.sweep_parallel(store, options, START, end)
    assert first["rows"] == 500 and store.fact().count() == 500 and first["windows"] == 4
    assert [e[2] for e in sorted(store.manifest().ledger)] == [144, 144, 144, 68]
    assert load.sweep(store, FakeFeed(500, timedelta(minutes=10)), START, end)["skipped"] == 4  # one ledger
    again = load.sweep_parallel(store, options, START, end + timedelta(days=1))
    assert (again["windows"], again["skipped"], again["rows"]) == (1, 4, 0)


def files(store):
    return {p["path"] for parts in store.manifest().months.values() for p in parts}


def test_a_small_update_leaves_files_in_place(spark, store):
    source = FakeFeed(2000, timedelta(hours=2))  # about six months
    load.sweep(store, source, START, START + timedelta(days=200), timedelta(days=200), page_size=5000)
    store.compact(m := store.manifest())
    store.publish(m)
    before, m = files(store), store.manifest()
    assert len(m.months) == 6 and not m.layers and all(p["lo"] <= p["hi"] for parts in m.months.values() for p in parts)
    source.touch(20)
    load.incremental(store, source, since=source.clock - timedelta(days=1), page_size=100, **FAST)
    assert files(store) == before and store.fact().count() == 2000 and not store.manifest().layers  # only the stamps differ
    m = store.manifest()
    rows = spark.createDataFrame([("100005", "2026-08-01T10:00:00", "2030-01-01T00:00:00", "Closed"), ("999999", "2026-09-03T00:00:00", "2030-01-01T00:00:00", "New")], "unique_key string, created_date string, `:updated_at` string, status string")
    store.publish(m) if load.apply_batch(store, m, rows)["affected"] == 3 else pytest.fail()
    assert files(store) == before and len(store.manifest().layers) >= 1
    status = {r["Unique_Key"]: r["Status"] for r in store.fact().where("Unique_Key IN (100005, 100006, 999999)").collect()}
    assert status == {100005: "Closed", 100006: "Open", 999999: "New"} and store.fact().count() == 2001
    assert store.fact(months=["2026-09"]).where("Unique_Key = 999999").count() == 1 and store.fact(months=["2026-08"]).where("Status = 'Closed'").count() == 1
    months = store.manifest().months
    assert set(store.manifest().layers[-1]["over"]) == {months["2026-08"][0]["path"]}  # keys 100005 and 999999, the latter in no part
    plan = store.fact()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftAnti") == 1 and plan.count("Union") >= 1  # one part lies under the layer, the others are read as they are
    read = store.there(m, spark.createDataFrame([(100005,)], "Unique_Key long")).inputFiles()
    assert any("month=2026-08" in f for f in read) and not any("month=2026-12" in f for f in read)  # spans of keys rule the other months out


def test_compaction_rewrites_touched_months_only(spark, store, monkeypatch):
    from tidemark.operators import store as module

    monkeypatch.setattr(module, "COMPACTED_ROWS", 0)
    load.sweep(store, FakeFeed(2000, timedelta(hours=2)), START, START + timedelta(days=200), timedelta(days=200), page_size=5000)
    before = store.manifest().months
    assert len(before) == 6 and not store.manifest().layers
    monkeypatch.setattr(module, "COMPACTED", 0.0)
    m = store.manifest()
    rows = spark.createDataFrame([("100005", "2026-11-01T10:00:00", "2030-01-01T00:00:00", "Moved")], "unique_key string, created_date string, `:updated_at` string, status string")
    load.apply_batch(store, m, rows)
    store.publish(m)
    after = store.manifest()
    assert not after.layers and {k for k in before if before[k] != after.months[k]} == {"2026-08", "2026-11"}
    assert store.fact().count() == 2000 and store.fact(months=["2026-08"]).where("Unique_Key = 100005").count() == 0 and store.fact(months=["2026-11"]).where("Unique_Key = 100005").count() == 1
    guards.primary_key(store.fact())


def test_append_adds_files(spark, store):
    fact = lambda lo, hi: spark.range(lo, hi).selectExpr("id AS Unique_Key", "TIMESTAMP_NTZ '2026-08-01' + make_dt_interval(0, cast(id AS int)) AS Created_Date")
    for lo, hi in ((0, 100), (100, 300)):
        m = store.manifest()
        store.append(m, fact(lo, hi))
        before = files(store)
        store.publish(m)
        assert before <= files(store)
    assert store.fact().count() == 300 and len(store.manifest().months["2026-08"]) == 2
    with pytest.raises(EngineError, match="there already"):
        store.append(store.manifest(), fact(299, 301))


def test_a_drained_group_is_one_commit(spark, store):
    source = FakeFeed(400)
    source.tie(300, START + timedelta(days=9), 50)
    got = load.incremental(store, source, default_since=datetime(2026, 7, 1), page_size=100, **FAST)
    assert store.fact().count() == 400 and got["commits"] <= 4  # two pages, the group, its end
    assert not list(store._fs.listStatus(store._path("spool")))  # nothing is left behind

    class Broken(FakeFeed):
        def fetch(self, r):
            if r.changed_at and self.left <= 0:
                raise EngineError("gone")
            self.left -= bool(r.changed_at)
            return super().fetch(r)

    broken = Broken(400)
    broken.left = 3
    broken.tie(300, broken.clock + timedelta(days=9), 50)
    mark = store.manifest().watermark
    with pytest.raises(EngineError, match="gone"):
        load.incremental(store, broken, since=broken.clock, page_size=100, **FAST)
    assert store.manifest().watermark == mark and not list(store._fs.listStatus(store._path("spool")))
    broken.left = 10**9
    again = load.incremental(store, broken, overlap=timedelta(0), page_size=100, **FAST)
    assert again["rows"] >= 300 and again["watermark"] == (broken.clock + timedelta(days=9)).isoformat(timespec="milliseconds")


def test_guards_at_commit(spark, store, caplog):
    batch = spark.createDataFrame([("1", "2026-08-01T00:00:00", "2026-08-02T00:00:00", "Parks"), ("2", None, "2026-08-02T00:00:00", "Parks")], "unique_key string, created_date string, `:updated_at` string, agency_name string")
    m = store.manifest()
    load.apply_batch(store, m, batch)
    assert "1 of 2 rows have no Created_Date" in caplog.text
    fact = spark.createDataFrame([(1, 9)], "Unique_Key long, agency_id int").selectExpr("*", "cast(null as int) cb_id", "cast(null as int) lt_id", "cast(null as int) at_id")
    with pytest.raises(EngineError, match="orphan agency_id"):
        guards.referenced(fact, store.dims(m))


def test_format_analyze_retype(spark, store):
    from tidemark.operators.transform import retype

    m = store.manifest()
    store.append(m, spark.range(5).selectExpr("id AS Unique_Key", "TIMESTAMP_NTZ '2026-08-01' AS Created_Date", "cast(id % 2 AS int) AS agency_id"))
    assert store.analyze(m)["agency_id"] == {"rows": 5, "nulls": 0, "distinct": 2, "least": "0", "greatest": "1"}
    store.publish(m)
    assert store.manifest().statistics["Unique_Key"]["greatest"] == "4"
    m.format = 1
    store.publish(m)
    with pytest.raises(EngineError, match="format 1"):
        store.manifest()
    narrow = retype(spark.createDataFrame([(1,), (None,)], "agency_id int"), {"agency_id": "smallint"})
    assert narrow.schema["agency_id"].dataType.typeName() == "short" and [r[0] for r in narrow.collect()] == [1, None]
    with pytest.raises(Exception, match="does not fit"):
        retype(spark.createDataFrame([(70000,)], "agency_id int"), {"agency_id": "smallint"}).collect()


def test_report_layout(spark):
    compared = reconcile.compare(spark.createDataFrame([("2025", 1234567), ("2026", 10)], "period string, n long"), spark.createDataFrame([("2025", 1234565), ("2027", 3), ("2026", 10)], "period string, n long"))
    assert reconcile.report("by year", compared) == "\n".join(
        [
            "by year", "period               API          DB      diff", "-" * 46, "2025           1,234,567   1,234,565        -2  <- DB short",
            "2026                  10          10        +0", "2027                   0           3        +3  <- DB extra", "-" * 46, "total          1,234,577   1,234,578        +1",
        ]
    )
    assert reconcile.shortfall_line(1234, datetime(2026, 9, 6, 1, 2, 3, 4)) == "checked at 2026-09-06T01:02:03; total DB shortfall across periods: 1,234"
    assert reconcile.daily_audit(compared) == "days compared: 3\ndays differing: 2\nrows short: 2; rows extra: 3\ntotal: source 1,234,577, ours 1,234,578"


def test_added_names_clash_with_nothing(spark):
    df = spark.createDataFrame([(1, "a", 1, 5), (1, "b", 2, 6)], "k long, td_nth string, td_kind int, td_k int")
    assert [tuple(r) for r in merge.last_wins(df, "k", "td_kind").collect()] == [(1, "b", 2, 6)]
    assert merge.affected(df.limit(1), df.limit(1), "k").first()["unchanged"] == 1
    assert {r["column"] for r in verify.nonnull_share(df.withColumnRenamed("td_k", "td_rows")).collect()} == {"k", "td_nth", "td_kind", "td_rows"}


def test_csv_import(spark, store, tmp_path):
    (tmp_path / "x.csv").write_text('"Unique Key",Created Date,Agency Name,Additional Details,Borough,Latitude,Location\n1,05/09/2026 02:32:59 AM,Parks,N/A,"BROOKLYN, NY",40.5,POINT (1 2)\n2,05/10/2026 12:00:00 PM,PARKS,kept,,x,\n')
    path = f"file://{tmp_path}/x.csv"
    assert load.import_csv(store, path)["rows"] == 2
    r = {x["Unique_Key"]: x for x in store.fact().collect()}
    assert r[1]["Additional_Details"] is None and r[1]["Borough"] == "BROOKLYN, NY" and r[2]["Latitude"] is None and r[1]["agency_id"] == r[2]["agency_id"] == 1
    with pytest.raises(EngineError, match="there already"):
        load.import_csv(store, path)
    load.import_csv(store, path, truncate=True)
    feed = spark.createDataFrame([("2", "2026-05-10T12:00:00", "2026-06-01T00:00:00", "Closed")], "unique_key string, created_date string, `:updated_at` string, status string")
    m = store.manifest()
    load.apply_batch(store, m, feed)
    store.publish(m)
    r = {x["Unique_Key"]: x for x in store.fact().collect()}
    assert r[2]["Status"] == "Closed" and r[2]["Additional_Details"] == "kept" and store.fact().count() == 2
    with pytest.raises(EngineError, match="lacks required"):
        csv_transform(spark.createDataFrame([("1",)], "a string"))


def test_stream(spark, store, tmp_path):
    from tidemark.streaming.changes import read_changes, write_changes

    stream = read_changes(spark, {"client": "tidemark.sources.fake:from_options", "rows": "130", "since": "2026-07-01", "page_size": "50"})
    query = write_changes(stream, store, f"file://{tmp_path}/checkpoint", processingTime="1 second")
    try:
        for _ in range(60):
            query.awaitTermination(1)
            if store.manifest().rows_total >= 130:
                break
    finally:
        query.stop()
    assert store.fact().count() == 130


def test_arguments():
    for bad in (["sweep", "--store", "s", "--from", "2026-01-01"], ["sweep", "--store", "s", "--from", "2026-01-02", "--to", "2026-01-01"], ["sweep", "--store", "s", "--from", "2026-01-01", "--to", "2026-01-02", "--window-days", "0"]):
        with pytest.raises(SystemExit):
            cli.parse_args(bad)
    assert cli.parse_args(["load", "--store", "s", "--overlap-hours", "2"]).overlap_hours == 2


def test_sql_and_nightly(spark, tmp_path, monkeypatch, caplog):
    assert [r.first()[0] for r in cli.run_sql(spark, "SELECT 1; -- one; two\nSELECT ';' AS x;")] == [1, ";"]
    args, waits = Namespace(lock=f"{tmp_path}/l", attempts=3, pause=9, failed_marker=f"{tmp_path}/FAILED"), []
    assert cli.nightly(args, lambda: 5000, waits.append) == 2 and "exit code 2" in (tmp_path / "FAILED").read_text()
    short, waits[:] = iter([5000, 5000, 10]), []
    assert cli.nightly(args, lambda: next(short), waits.append) == 0 and waits == [9, 9] and not (tmp_path / "FAILED").exists()
    assert "recovered: attempt 3/3" in caplog.text
    assert cli.nightly(args, lambda: 1 / 0, waits.append) == 1
    import fcntl
    import os
    import signal

    assert cli.nightly(args, lambda: os.kill(os.getpid(), signal.SIGTERM), waits.append) == 143
    with open(args.lock, "w") as held:
        fcntl.flock(held, fcntl.LOCK_EX)
        assert cli.nightly(args, lambda: 0, waits.append) == 3
    monkeypatch.setenv("TIDEMARK_MAX_ATTEMPTS", "5")
    monkeypatch.setenv("TIDEMARK_RETRY_INTERVAL_SECONDS", "soon")
    got = cli.parse_args(["nightly", "--store", "s"])
    assert (got.attempts, got.pause) == (5, 7200)
    assert {"orders", "documents"} <= set(cli.table_names(spark, "/root/testdata/sf0.001"))
