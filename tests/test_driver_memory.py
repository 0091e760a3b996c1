"""What the driver holds while feeds are staged and loaded, and what loads of new keys write."""

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.operators import load
from tidemark.operators import store as module
from tidemark.operators.store import SnapshotStore
from tidemark.schema import KEY
from tidemark.sources import feed
from tidemark.sources.fake import START, FakeFeed
from tidemark.sources.feed import Request
from tidemark.sources.staged import StagedFeed

FAST = {"probes": 1, "sleep": lambda s: None}
DAY = datetime(2021, 1, 1)
COLUMNS = "key string, created timestamp_ntz, changed timestamp_ntz, status string"


@pytest.fixture
def store(spark, tmp_path):
    return SnapshotStore(spark, f"file://{tmp_path}/store")


def test_a_feed_is_staged_without_results_on_the_driver(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(str(n), DAY, DAY + timedelta(days=n % 3), "s") for n in range(60)], COLUMNS)
    gone = lambda self, *a, **k: pytest.fail("rows came through the driver's JVM")
    monkeypatch.setattr(type(rows), "toLocalIterator", gone)  # partitions came that way, one job each
    monkeypatch.setattr(type(rows), "collect", gone)
    monkeypatch.setattr("tidemark.sources.staged.shared_dir", lambda spark: f"file://{tmp_path}/shared", raising=False)
    staged = StagedFeed(rows)
    assert not [p for p in Path(f"{tmp_path}/shared").rglob("*") if p.is_file()]
    got = staged.fetch(Request(ordered=True))
    assert sorted(int(r[KEY]) for r in got) == list(range(60)) and [r[":updated_at"] for r in got] == sorted(r[":updated_at"] for r in got)


def test_held_rows_go_to_the_spool_without_a_job(spark, store, monkeypatch):
    monkeypatch.setattr(load, "HELD_BYTES", 100)
    monkeypatch.setattr(module, "SENT_BYTES", 70, raising=False)
    parts = load.Parts(store)
    spark.sparkContext.setJobGroup("F3", "spool")  # a job for each 8 MB of answers
    try:
        for n in range(4):
            parts.add([{KEY: str(n), "status": "Öffen 'x'", "location": {"type": "Point"}}, {KEY: str(n + 10), "agency": None}] * 5)
        assert len(parts.folders) >= 2 and not spark.sparkContext.statusTracker().getJobIdsForGroup("F3")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    df = parts.df()
    assert [r["seq"] for r in df.orderBy("seq").collect()] == list(range(40)) and df.where("agency is null").count() == 40
    assert {tuple(r) for r in df.where(f"{KEY} < '10'").select("status", "location").collect()} == {("Öffen 'x'", '{"type": "Point"}')}
    parts.close()
    assert not list(store._fs.listStatus(store._path("spool")))


def test_answers_with_columns_are_read_without_rows(spark):
    staged = StagedFeed(spark.createDataFrame([(str(n), DAY, DAY + timedelta(days=n // 10), "s") for n in range(40)], COLUMNS))
    batches, cursor, end = feed.next_page(staged, feed.Cursor(DAY, True, frozenset({"3", "4"})), 15, **FAST)
    assert not end and len(batches[0]) == 13 and batches[0]._rows is None  # dicts were made of each row, some of them thrice
    assert {"3", "4"}.isdisjoint(batches[0].values(KEY)) and cursor.at == DAY + timedelta(days=1) and cursor.whole == DAY and len(cursor.boundary) == 5
    got = [r[KEY] for rows in feed.changes(staged, DAY - timedelta(days=1), 15, **FAST) for r in rows]
    assert sorted(map(int, got)) == list(range(40))


def test_many_new_keys_rewrite_no_part(spark, store, monkeypatch):
    monkeypatch.setattr(module, "COMPACTED_ROWS", 20)
    monkeypatch.setattr(module, "MAX_PARTS", 3, raising=False)
    source = FakeFeed(600, timedelta(hours=6))  # five months
    keys, every = sorted(source.created), dict(source.created)
    seen, before = 0, {}
    for n in range(6):  # each brings a sixth of the keys of every month, and edits five rows that are there
        edited = keys[: seen and 5]
        source.created = {k: every[k] for k in keys if int(k) % 6 <= n}
        source.changed = {k: START + timedelta(days=365 * (n + 1)) if int(k) % 6 == n or k in edited else START for k in source.created}
        got = load.incremental(store, source, since=START + timedelta(days=365 * n + 1), page_size=1000, **FAST)
        seen += 100
        m = store.manifest()
        assert got["rows"] >= 100 and store.fact(m).count() == store.fact(m).agg(F.countDistinct("Unique_Key")).first()[0] == seen
        now = {p["path"] for parts in m.months.values() for p in parts}
        assert n != 2 or before < now  # all months were read and written again by each commit
        assert max(map(len, m.months.values())) <= 3 and m.rows() + sum(x["rows"] for x in m.layers) >= seen
        before = now
    assert store.fact().where("Status = 'Open'").count() == 600
    parts = [p for v in m.months.values() for p in v]
    some = spark.createDataFrame([(int(keys[0]),), (int(keys[-1]),)], "Unique_Key long")
    paths, span = store._holding(m, some)
    assert span == (int(keys[0]), int(keys[-1])) and set(paths) == {p["path"] for p in parts if any(p["lo"] <= int(k) <= p["hi"] for k in (keys[0], keys[-1]))}
