"""The change feed as a Structured Streaming source, and its sink into the store.

The offset is the keyset cursor. A feed that is edited does not give the same rows for one offset range twice; that
is sound here because the sink is idempotent and an edited row comes again further on. The batch id is published
with the rows, so a batch that Spark repeats after a crash is passed over.
"""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from tidemark.schema import CHANGED, FEED, FEED_FIELDS
from tidemark.sources.feed import PAGE_SIZE, Cursor, make_client, next_page


def to_offset(c: Cursor) -> dict:
    return {"at": c.at.isoformat(), "inclusive": c.inclusive, "boundary": sorted(c.boundary)}


def from_offset(o: dict) -> Cursor:
    return Cursor(datetime.fromisoformat(o["at"]), o["inclusive"], frozenset(o["boundary"]))


class ChangeStream(SimpleDataSourceStreamReader):
    def __init__(self, options):
        self.options = dict(options)
        self.client = make_client(self.options)
        self.size = int(self.options.get("page_size", PAGE_SIZE))

    def initialOffset(self):
        return to_offset(Cursor(datetime.fromisoformat(self.options["since"])))

    def _rows(self, batches):
        text = lambda v: v if v is None or isinstance(v, str) else json.dumps(v)
        return iter([tuple(text(r.get(f)) for f in (*FEED_FIELDS, CHANGED)) for b in batches for r in b])

    def read(self, start):
        batches, cursor, end = next_page(self.client, from_offset(start), self.size)
        if end and not batches:
            return iter([]), start
        return self._rows(batches), to_offset(cursor)

    def readBetweenOffsets(self, start, end):
        a, b = from_offset(start), from_offset(end)
        rows, cursor = [], a
        while cursor.at < b.at or not rows:
            batches, cursor, done = next_page(self.client, cursor, self.size)
            rows += batches
            if done:
                break
        return self._rows(rows)


class ChangeSource(DataSource):
    """Options: url or client, since, page_size, token, timeout."""

    @classmethod
    def name(cls):
        return "tidemark_changes"

    def schema(self):
        return FEED

    def simpleStreamReader(self, schema):
        return ChangeStream(self.options)


def read_changes(spark: SparkSession, options: dict) -> DataFrame:
    spark.dataSource.register(ChangeSource)
    return spark.readStream.format("tidemark_changes").options(**options).load()


def write_changes(stream: DataFrame, store, checkpoint: str, **trigger):
    """Start the query that upserts each micro-batch into the store."""
    from tidemark.operators.load import apply_batch

    def sink(batch: DataFrame, batch_id: int) -> None:
        m = store.manifest()
        if m.batch_id is not None and batch_id <= m.batch_id:
            return
        done = apply_batch(store, m, batch)
        m.batch_id = batch_id
        if done["newest"]:
            m.watermark = max(filter(None, [m.watermark, done["newest"].isoformat(timespec="milliseconds")]))
        m.rows_run, m.rows_total = done["rows"], m.rows_total + done["rows"]
        store.publish(m)

    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
