"""The feed as a Spark data source: one partition for each creation window, read where the partition runs."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidemark.schema import CHANGED, FEED, FEED_FIELDS
from tidemark.sources.feed import PAGE_SIZE, WINDOW, make_client, sweep_windows, undated_rows, window_rows

_NAMES = (*FEED_FIELDS, CHANGED)


class Window(InputPartition):
    def __init__(self, lo, hi):
        super().__init__((lo, hi))
        self.lo, self.hi = lo, hi


class FeedReader(DataSourceReader):
    def __init__(self, options):
        self.options = dict(options)
        self.size = int(options.get("page_size", PAGE_SIZE))

    def partitions(self):
        """At most ``parallel`` runs of windows at a time ask the feed: windows are widened to that number, or those
        of ``windows`` (a list of bounds) are asked for as they are."""
        if "windows" in self.options:
            return [Window(datetime.fromisoformat(a), datetime.fromisoformat(b)) for a, b in json.loads(self.options["windows"])]
        lo, hi = datetime.fromisoformat(self.options["from"]), datetime.fromisoformat(self.options["to"])
        days = float(self.options.get("window_days", WINDOW / timedelta(days=1)))
        most = int(self.options.get("parallel", 64))
        width = max(timedelta(days=days), (hi - lo) / most)
        parts = [Window(a, b) for a, b in sweep_windows(lo, hi, width)]
        return parts + ([Window(None, None)] if self.options.get("undated") == "true" else [])

    def read(self, partition):
        client = make_client(self.options)
        batches = undated_rows(client, self.size) if partition.lo is None else (rows for *_, rows in window_rows(client, partition.lo, partition.hi, self.size, by_key=True))
        for rows in batches:
            for r in rows:
                yield tuple(None if (v := r.get(f)) is None else v if isinstance(v, str) else _text(v) for f in _NAMES)


def _text(value) -> str:
    return json.dumps(value)


class FeedSource(DataSource):
    """Options: url or client, from, to, window_days, or windows, page_size, parallel, undated, token, timeout."""

    @classmethod
    def name(cls):
        return "tidemark_feed"

    def schema(self):
        return FEED

    def reader(self, schema):
        return FeedReader(self.options)


def register(spark) -> None:
    spark.dataSource.register(FeedSource)
