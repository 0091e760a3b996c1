"""Feeds larger than the driver, instants wider than a page, and pages committed together."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.errors import EngineError
from tidemark.operators import load
from tidemark.operators.store import SnapshotStore
from tidemark.plans import catalog
from tidemark.schema import KEY
from tidemark.sources import feed
from tidemark.sources.fake import START, FakeFeed, TableFeed
from tidemark.sources.feed import Request
from tidemark.sources.staged import StagedFeed

FAST = {"probes": 1, "sleep": lambda s: None}


@pytest.fixture
def store(spark, tmp_path):
    return SnapshotStore(spark, f"file://{tmp_path}/store")


def test_an_instant_wider_than_a_page_is_swept(spark, store):
    source = FakeFeed(50, timedelta(0))  # F5, F8: was refused
    got = load.sweep(store, source, START, START + timedelta(days=2), page_size=10)
    assert got["rows"] == 50 and store.fact().count() == 50 and [e[2] for e in store.manifest().ledger] == [50, 0]
    assert sum(map(len, feed.drain(source, START, {"100000"}, 10, 10))) == 49
    source.created = dict.fromkeys(source.created)
    assert sum(map(len, feed.undated_rows(source, 10))) == 50
    p = feed.HttpClient.parameters(Request(by_key=True, after_key="o'b"))
    assert p["$where"] == "unique_key > 'o''b'" and p["$order"] == "unique_key ASC"
    fetch = source.fetch
    source.fetch = lambda r: fetch(Request(undated=True, limit=r.limit))  # a feed that knows no keyset
    with pytest.raises(EngineError, match="keys after"):
        list(feed.undated_rows(source, 10))


def test_a_staged_feed_answers_as_one_in_memory(spark, monkeypatch):
    at = lambda n: None if n % 9 == 0 else datetime(2020, 1, 1) + timedelta(hours=n % 40, microseconds=n)
    rows = [(str(n), at(n), datetime(2021, 1, 1) + timedelta(days=n % 7), f"s{n}") for n in range(500)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 20)
    try:
        staged = StagedFeed(spark.createDataFrame(rows, "key string, created timestamp_ntz, changed timestamp_ntz, status string"))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    held = TableFeed([(k, c, t, {"status": s}) for k, c, t, s in rows])
    lo, hi, day = datetime(2020, 1, 1, 3), datetime(2020, 1, 1, 9, 0, 0, 5000), datetime(2021, 1, 4)
    for r in (
        Request(), Request(after=day, ordered=True), Request(after=day, inclusive=True, ordered=True), Request(changed_at=day), Request(created_from=lo, created_to=hi), Request(changed_at=day, created_from=lo, created_to=hi),
        Request(undated=True), Request(undated=True, changed_at=day), Request(created_from=lo, created_to=hi, by_key=True), Request(by_key=True, after_key="3", undated=True), Request(after=datetime(2022, 1, 1)),
    ):
        got = list(staged.fetch(r))
        key = lambda x: x[KEY]
        assert [{k: v for k, v in x.items() if v is not None} for x in sorted(got, key=key)] == sorted(held.fetch(r), key=key), r
        if r.ordered:
            assert [x[":updated_at"] for x in got] == sorted(x[":updated_at"] for x in got)
    page = Request(by_key=True, after_key="2", limit=30)
    assert [x[KEY] for x in staged.fetch(page)] == [x[KEY] for x in held.fetch(page)]
    assert staged.fetch(Request(newest_first=True, limit=1))[0][":updated_at"] == "2021-01-07T00:00:00.000"
    assert len(staged._places) > staged.KEPT >= len(staged._decoded)  # the driver holds a few blocks
    empty = StagedFeed(spark.createDataFrame(rows, "key string, created timestamp_ntz, changed timestamp_ntz, status string").where("false"))
    assert len(empty.fetch(Request())) == 0


def test_the_catalog_holds_no_feed_in_memory(spark):
    assert isinstance(catalog._order_feed(spark, "/root/testdata/sf0.001"), StagedFeed)  # F1, F2, F4, F6, F7


def test_pages_are_committed_together(spark, store, monkeypatch):
    source = FakeFeed(250, timedelta(hours=3))
    got = load.incremental(store, source, default_since=datetime(2026, 7, 1), page_size=40, **FAST)
    assert (got["rows"], got["commits"]) == (250, 1) and store.fact().count() == 250  # was a commit for each page
    source.touch(90)
    fetch, left = source.fetch, [2]

    def failing(r):
        left[0] -= r.ordered
        if left[0] < 0:
            raise EngineError("gone")
        return fetch(r)

    source.fetch = failing
    with pytest.raises(EngineError, match="gone"):
        load.incremental(store, source, since=START + timedelta(days=32, hours=6), page_size=40, **FAST)
    m = store.manifest()
    assert m.version == 2 and m.rows_run == 79  # both whole pages; the second reads the first one's last row again
    source.fetch = fetch
    monkeypatch.setattr(load, "COMMIT_ROWS", 40)
    monkeypatch.setattr(load, "HELD_BYTES", 100)
    again = load.incremental(store, source, overlap=timedelta(0), page_size=40, **FAST)
    assert again["commits"] >= 1 and store.fact().count() == 250 and store.manifest().watermark == source.clock.isoformat(timespec="milliseconds")
    assert not list(store._fs.listStatus(store._path("spool")))
    assert store.fact().where(F.col("Status") == "Open").count() == 250
