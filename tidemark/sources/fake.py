"""An in-memory feed that is edited while it is read, for tests, dry runs and benchmarks."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from tidemark.schema import CHANGED, CREATED, KEY
from tidemark.sources.feed import Request, stamp

START = datetime(2026, 8, 1)


class FakeFeed:
    """``rows`` rows, one for each ``spread``; ``edits`` are re-stamped after each request; ``jumble`` shuffles equals."""

    def __init__(self, rows: int, spread: timedelta = timedelta(minutes=1), edits: int = 0, jumble: bool = False, seed: int = 0, start: datetime = START):
        self.created = {str(100_000 + i): start + i * spread for i in range(rows)}
        self.changed = dict(self.created)
        self.clock = start + rows * spread + timedelta(days=1)
        self.edits, self.jumble, self.random, self.requests = edits, jumble, random.Random(seed), []

    def touch(self, n: int) -> None:
        for key in self.random.sample(sorted(self.changed), min(n, len(self.changed))):
            self.clock += timedelta(seconds=1)
            self.changed[key] = self.clock

    def tie(self, n: int, at: datetime, first: int = 0) -> None:
        for key in sorted(self.changed)[first : first + n]:
            self.changed[key] = at

    def fetch(self, r: Request) -> list[dict]:
        self.requests.append(r)
        cut = lambda t: t.replace(microsecond=t.microsecond // 1000 * 1000)
        keys = [
            k
            for k, t in self.changed.items()
            if (not r.after or (t >= cut(r.after) if r.inclusive else t > cut(r.after)))
            and (not r.changed_at or t == cut(r.changed_at))
            and (not r.created_from or self.created[k] is not None and self.created[k] >= cut(r.created_from))
            and (not r.created_to or self.created[k] is not None and self.created[k] < cut(r.created_to))
            and (not r.undated or self.created[k] is None)
            and (r.after_key is None or k > r.after_key)
        ]
        if self.jumble:
            self.random.shuffle(keys)
        if r.ordered or r.newest_first:
            keys.sort(key=self.changed.__getitem__, reverse=r.newest_first)
        elif r.by_key:
            keys.sort()
        out = [self.row(k) for k in keys[: r.limit]]
        self.touch(self.edits)
        return out

    def row(self, key: str) -> dict:
        n = int(key)
        created = {CREATED: stamp(self.created[key])} if self.created[key] else {}
        return {KEY: key, CHANGED: stamp(self.changed[key]) + "Z", "agency_name": f"Agency {n % 5}", "location_type": ("Street", "STREET", None)[n % 3], "status": "Open", "location": '{"type":"Point","coordinates":[-73.9,40.7]}'} | created


def from_options(options: dict) -> FakeFeed:
    return FakeFeed(int(options.get("rows", 1000)), timedelta(seconds=float(options.get("spread", 60))))


class TableFeed(FakeFeed):
    """A feed over given rows: (key, created or None, changed, other fields)."""

    def __init__(self, rows: list[tuple[str, datetime | None, datetime, dict]]):
        self.created = {k: c for k, c, *_ in rows}
        self.changed = {k: t for k, _, t, _ in rows}
        self.fields = {k: f for k, _, _, f in rows}
        self.clock = max(self.changed.values(), default=START)
        self.edits, self.jumble, self.random, self.requests = 0, False, random.Random(0), []

    def row(self, key: str) -> dict:
        created = {CREATED: stamp(self.created[key])} if self.created[key] else {}
        return {KEY: key, CHANGED: stamp(self.changed[key])} | created | self.fields[key]


class StaleFeed:
    """Answers each probe from the next of several replicas, some of which lag."""

    def __init__(self, stamps: list[datetime]):
        self.stamps, self.asked = stamps, 0

    def fetch(self, r: Request) -> list[dict]:
        self.asked += 1
        return [{KEY: "1", CHANGED: stamp(self.stamps[(self.asked - 1) % len(self.stamps)]) + "Z"}]
