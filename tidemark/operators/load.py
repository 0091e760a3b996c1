"""Loads into the store: by changes, by windows of creation time, and from a bulk export.

Rows and progress are published together, so progress is never ahead of what is stored, and a run that fails keeps
what its finished commits brought. A drained group is counted, and put aside in the store's spool answer by answer,
before it is published as one commit.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Sequence
from datetime import datetime, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.errors import EngineError
from tidemark.functions.expr import parse_iso
from tidemark.operators import guards, lookups, merge
from tidemark.operators.store import Manifest, SnapshotStore
from tidemark.operators.transform import csv_transform, feed_transform
from tidemark.schema import CHANGED, DIMENSIONS, FEED, FEED_FIELDS, FEED_TARGETS
from tidemark.sources import feed as feeds

log = logging.getLogger(__name__)
DEFAULT_SINCE = datetime(2020, 1, 1)
#: Rows of whole pages and groups from which on they are committed.
COMMIT_ROWS = 500_000
#: Bytes of answers (as Arrow) from which on they go to the spool.
HELD_BYTES = 8_000_000
#: Feed fields with each row's place in its batch, by which the later of two equal stamps wins.
_BATCH = StructType([*FEED.fields, StructField("seq", LongType())])


def rows_to_arrow(rows: Sequence[dict]) -> pa.Table:
    """Text columns of the fields that some row has; an answer that is an Arrow table (``table``) is taken as it is."""
    if (table := getattr(rows, "table", None)) is not None:
        return table.cast(pa.schema([(c, pa.string()) for c in table.column_names]))
    text = lambda v: v if v is None or isinstance(v, str) else json.dumps(v)
    there = set().union(*rows)
    return pa.table({f: pa.array([text(r.get(f)) for r in rows], pa.string()) for f in (*FEED_FIELDS, CHANGED) if f in there})


class Parts:
    """Rows of one commit, answer by answer: the driver holds about ``HELD_BYTES`` of them, the others go to the spool.
    ``first`` is the place of the first row."""

    def __init__(self, store: SnapshotStore, first: int = 0):
        self.store, self.folders, self.held, self.rows = store, [], [], first

    def add(self, rows: Sequence[dict]) -> Parts:
        self.held.append(rows_to_arrow(rows))
        self.rows += len(rows)
        if sum(t.nbytes for t in self.held) > HELD_BYTES:
            self._flush()
        return self

    def take(self, other: Parts) -> None:
        """Add all rows of ``other``, whose first place is the next one here."""
        if other.folders:
            self._flush()
        self.folders += other.folders
        self.held += other.held
        self.rows, other.folders, other.held = other.rows, [], []
        if sum(t.nbytes for t in self.held) > HELD_BYTES:
            self._flush()

    def _flush(self) -> None:
        if self.held:
            rows = pa.concat_tables(self.held, promote_options="default")
            rows = rows.append_column("seq", pa.array(range(self.rows - rows.num_rows, self.rows), pa.int64()))
            self.folders.append(self.store.spool_held(rows))
            self.held = []

    def df(self) -> DataFrame:
        self._flush()
        spark = self.store.spark
        return spark.read.schema(_BATCH).parquet(*self.folders) if self.folders else spark.createDataFrame([], _BATCH)

    def close(self) -> None:
        self.store.unspool(self.folders)
        self.folders, self.held, self.rows = [], [], 0


def extend_and_stamp(store: SnapshotStore, m: Manifest, rows: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Append unseen names to the draft's dimensions and stamp ids on the rows; an absent text column is null. Returns
    the rows and the dimensions."""
    rows = rows.withColumns({t: F.lit(None).cast("string") for t, *_ in DIMENSIONS if t not in rows.columns})
    dims = {name: lookups.sized(store.dim(name, m)) for _, name, _, _ in DIMENSIONS}
    unseen = lookups.unseen_names(rows, [(text, dims[name]) for text, name, _, _ in DIMENSIONS])
    for text, name, _, _ in DIMENSIONS:
        if text in unseen:
            extended = lookups.extend_dim(rows, text, dims[name])
            store.write_dim(m, name, extended)
            guards.dimension_names(store.dim(name, m))
            dims[name] = lookups.sized(store.dim(name, m))
    return lookups.stamp_ids(rows, [(F.col(text), dims[name], i) for text, name, _, i in DIMENSIONS], counted=True), dims


def apply_batch(store: SnapshotStore, m: Manifest, feed: DataFrame, dry_run: bool = False) -> dict:
    """Transform, guard, stamp and upsert one batch of feed rows into the draft ``m``."""
    typed = feed_transform(feed, extra=("seq",) if "seq" in feed.columns else ())
    if "seq" not in typed.columns:
        typed = typed.withColumn("seq", F.monotonically_increasing_id())
    typed = typed.cache()  # a batch is a page, a group or a window; all checks and the merge see the same rows
    ready = None
    try:
        measures = guards.batch_sanity(typed, changed="changed")
        counts = {"inserted": 0, "updated": 0, "unchanged": 0, "affected": 0}
        if not dry_run and measures["rows"]:
            last = merge.last_wins(typed, "Unique_Key", "changed", "seq").drop("changed", "seq")
            stamped, dims = extend_and_stamp(store, m, last)
            ready = stamped.select(*FEED_TARGETS).cache()
            guards.commit(ready, dims)
            counts = store.upsert(m, ready)
        return counts | {"rows": measures["rows"], "newest": measures["newest"]}
    finally:
        typed.unpersist()
        if ready is not None:
            ready.unpersist()


@feeds.timed("incremental load")
def incremental(store: SnapshotStore, client, since: datetime | None = None, default_since: datetime = DEFAULT_SINCE, overlap: timedelta = feeds.OVERLAP, page_size: int = feeds.PAGE_SIZE, max_pages: int | None = None, dry_run: bool = False, **options) -> dict:
    """Read all changes from the high-water mark less ``overlap`` on. Whole pages and whole drained groups are committed
    together once they are ``COMMIT_ROWS``, at the end, and when the feed fails, with their mark: the greatest stamp of
    which no row is still to come, so a run that fails anywhere is taken up without a gap, whatever the overlap.

    ``since`` is used instead of the mark, which is still written; the mark never goes back."""
    m = store.manifest()
    mark = datetime.fromisoformat(m.watermark) if m.watermark else None
    start = since or (mark - overlap if mark else default_since)
    try:
        if (top := feeds.newest_change(client, 1)) and mark:
            log.info("the feed is %s ahead", top - mark)
    except Exception as e:  # a report only
        log.warning("the feed's newest change is not known: %s", e)
    total, parts, group = {"rows": 0, "affected": 0, "commits": 0, "watermark": m.watermark}, Parts(store), Parts(store)

    def commit() -> None:
        if not parts.rows:
            return
        m = store.manifest()
        done = apply_batch(store, m, parts.df(), dry_run)
        total["rows"] += done["rows"]
        total["affected"] += done["affected"]
        if not dry_run:
            m.watermark, m.rows_run, m.rows_total = mark and mark.isoformat(timespec="milliseconds"), total["rows"], m.rows_total + done["rows"]
            store.publish(m)
            total["commits"] += 1
            total["watermark"] = m.watermark
        parts.close()
        group.rows = 0

    reading = feeds.steps(client, start, page_size, max_pages, keep=group.add, **options)
    try:
        while True:
            try:
                step = next(reading, None)
            except Exception:
                commit()  # what came whole before
                raise
            if step is None:
                break
            batches, whole = step
            for rows in batches:
                if rows is not group:  # a drained group's are there already
                    group.add(rows)
            parts.take(group)
            mark = max(filter(None, [mark, whole]), default=None)
            if parts.rows >= COMMIT_ROWS:
                commit()
        commit()
    finally:
        parts.close()
        group.close()
    return total


def _finished(m: Manifest, resweep: bool) -> set:
    return set() if resweep else {(datetime.fromisoformat(a), datetime.fromisoformat(b)) for a, b, *_ in m.ledger}


def _enter(m: Manifest, lo: datetime, hi: datetime, rows: int) -> None:
    key = [lo.isoformat(), hi.isoformat()]
    m.ledger = [e for e in m.ledger if e[:2] != key] + [[*key, rows, datetime.now().isoformat(timespec="seconds")]]


@feeds.timed("sweep")
def sweep(store: SnapshotStore, client, start: datetime, end: datetime, width: timedelta = feeds.WINDOW, page_size: int = feeds.PAGE_SIZE, resweep: bool = False, dry_run: bool = False) -> dict:
    """Read every row created in [start, end) window by window; finished windows are skipped. One window is one
    commit with its ledger entry, an empty one too. The high-water mark stays."""
    done = _finished(store.manifest(), resweep)
    total, parts = {"windows": 0, "skipped": 0, "rows": 0, "affected": 0}, Parts(store)
    try:
        for lo, hi in feeds.sweep_windows(start, end, width):
            if (lo, hi) in done:
                total["skipped"] += 1
                continue
            for *_, rows in feeds.window_rows(client, lo, hi, page_size, by_key=True):
                parts.add(rows)
            m = store.manifest()
            got = apply_batch(store, m, parts.df(), dry_run) if parts.rows else {"rows": 0, "affected": 0}
            total = total | {"windows": total["windows"] + 1, "rows": total["rows"] + got["rows"], "affected": total["affected"] + got["affected"]}
            if not dry_run:
                _enter(m, lo, hi, got["rows"])
                store.publish(m)
            parts.close()
    finally:
        parts.close()
    return total


@feeds.timed("parallel sweep")
def sweep_parallel(store: SnapshotStore, options: dict, start: datetime, end: datetime, width: timedelta = feeds.WINDOW, resweep: bool = False, dry_run: bool = False) -> dict:
    """The unfinished windows of [start, end) as one distributed read and one commit: each asks the feed from where its
    task runs. The ledger gets an entry for each window, as from ``sweep``."""
    from tidemark.sources.spark_feed import register

    register(store.spark)
    m = store.manifest()
    every = feeds.sweep_windows(start, end, width)
    pending = feeds.sweep_windows(start, end, width, _finished(m, resweep))
    total = {"windows": len(pending), "skipped": len(every) - len(pending), "rows": 0, "affected": 0}
    if not pending:
        return total
    bounds = json.dumps([[a.isoformat(), b.isoformat()] for a, b in pending])
    read = store.spark.read.format("tidemark_feed").options(**options, windows=bounds).load()
    folder = store.spool(read.repartition(min(len(pending), 64)))  # the feed is asked once
    try:
        rows = store.spark.read.schema(FEED).parquet(folder)
        got = apply_batch(store, m, rows, dry_run)
        seconds = F.timestamp_diff("SECOND", F.lit(start).cast("timestamp_ntz"), parse_iso(F.col("created_date")))
        n = {r["nth"]: r["n"] for r in rows.groupBy(F.floor(seconds / F.lit(width.total_seconds())).alias("nth")).agg(F.count("*").alias("n")).collect()}  # a row for each window
        if not dry_run:
            for nth, (lo, hi) in enumerate(every):
                if (lo, hi) in set(pending):
                    _enter(m, lo, hi, n.get(nth, 0))
            store.publish(m)
        return total | {"rows": got["rows"], "affected": got["affected"]}
    finally:
        store.unspool([folder])


@feeds.timed("import")
def import_csv(store: SnapshotStore, path: str, date_format: str | None = None, max_rows: int | None = None, truncate: bool = False) -> dict:
    """Load an export in one commit. The dimension ids are stamped in the same pass."""
    from tidemark.operators.transform import normalize_headers, require_columns
    from tidemark.schema import CSV_DATE
    from tidemark.sources.csv import read_text_csv

    raw = normalize_headers(read_text_csv(store.spark, path, max_rows))
    require_columns(raw)
    guards.dates_parse(raw, "csv", date_format or CSV_DATE)
    m = store.manifest()
    if truncate:
        store.truncate(m)
    rows = csv_transform(raw, date_format or CSV_DATE).cache()
    try:
        measures = guards.batch_sanity(rows)
        guards.column_filled(rows)
        stamped, dims = extend_and_stamp(store, m, rows)
        guards.commit(stamped, dims)
        store.append(m, stamped)
        m.rows_run, m.rows_total = measures["rows"], (0 if truncate else m.rows_total) + measures["rows"]
        store.publish(m)
        return measures
    finally:
        rows.unpersist()
