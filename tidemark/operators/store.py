"""A versioned Parquet store in which rows and progress become visible in one step.

``data/<version>/month=<yyyy-MM>`` holds base parts of the fact by creation month, sorted by key; ``layers/<version>``
what later commits changed, whole rows; ``dims/<version>/<name>`` the dimensions; ``manifest/<version>.json`` names the
parts of each month with their span of keys, the layers in order, and the current dimensions, with the high-water mark,
the sweep ledger and the run's counts. Readers open the highest manifest. A version is published by renaming its
manifest into place, which fails if another writer took the number; what a crashed run wrote before stays unseen.

An upsert reads only parts whose span holds an incoming key and writes only the changed rows, as a new layer; no file
that is there is rewritten; new keys too many for a layer become further parts of their months, which hold ``MAX_PARTS``
at most. A row is the one of the last layer that has its key, else the base's; parts that
no layer's keys may be in are read as they are. When layers hold over
``COMPACTED`` of the base's rows, or are many, the months that they touch are rewritten, and only these. The engine
sizes files by bytes (adaptive rebalancing), so their number follows the data.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from dataclasses import asdict, dataclass, field
from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.errors import EngineError
from tidemark.operators import merge
from tidemark.schema import DIMENSIONS, FACT, FORMAT
from tidemark.shared import free_name

NO_MONTH = "none"
KEY = "Unique_Key"
#: Share of the base's rows (and rows at least) that layers may hold, and layers, before they are merged into the base.
COMPACTED, COMPACTED_ROWS, MAX_LAYERS = 0.1, 100_000, 32
#: Parts of a month from which on they are merged; ranges by which the keys of an upsert are held against parts.
MAX_PARTS, SPANS = 8, 4096
#: Bytes that go to the JVM at once.
SENT_BYTES = 250_000


@dataclass
class Manifest:
    version: int = 0
    format: int = FORMAT
    months: dict[str, list[dict]] = field(default_factory=dict)  # month -> parts: path, lo, hi (keys), rows
    layers: list[dict] = field(default_factory=list)  # path, rows, over (parts that may hold its keys); later ones win
    dims: dict[str, str] = field(default_factory=dict)
    watermark: str | None = None
    rows_run: int = 0
    rows_total: int = 0
    last_run_at: str | None = None
    ledger: list[list] = field(default_factory=list)  # [lo, hi, rows, completed at]
    batch_id: int | None = None
    statistics: dict[str, dict] = field(default_factory=dict)

    def rows(self) -> int:
        """Rows of the base."""
        return sum(p["rows"] for parts in self.months.values() for p in parts)


def month(created="Created_Date"):
    return F.coalesce(F.date_format(created, "yyyy-MM"), F.lit(NO_MONTH))


def as_fact(rows: DataFrame) -> DataFrame:
    """The fact's columns in order, absent ones as nulls."""
    return rows.select(*[F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in FACT])


class SnapshotStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)
        for kind in ("manifest", "spool"):
            self._fs.mkdirs(self._path(kind))

    def _path(self, below: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{below}" if below else self.path)

    def _folder(self, kind: str, m: Manifest) -> str:
        return f"{kind}/{m.version + 1}-{self._jvm.java.util.UUID.randomUUID()}"

    def manifest(self) -> Manifest:
        numbers = [int(n[:-5]) for s in self._fs.listStatus(self._path("manifest")) if (n := s.getPath().getName()).endswith(".json") and n[:-5].isdigit()]
        if not numbers:
            return Manifest()
        stream = self._fs.open(self._path(f"manifest/{max(numbers)}.json"))
        try:
            read = json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        if read.get("format") != FORMAT:
            raise EngineError(f"the store has format {read.get('format')}; this engine reads {FORMAT}")
        return Manifest(**read)

    def publish(self, m: Manifest) -> Manifest:
        m.version += 1
        m.last_run_at = datetime.now().isoformat(timespec="seconds")
        draft, final = self._path(f"manifest/.{m.version}.{self._jvm.java.util.UUID.randomUUID()}"), self._path(f"manifest/{m.version}.json")
        out = self._fs.create(draft, False)
        out.write(bytearray(json.dumps(asdict(m)).encode()))
        out.close()
        options = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = self._jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self._conf).rename(draft, final, options)
        except Exception as e:
            self._fs.delete(draft, False)
            raise EngineError(f"version {m.version} was published by another writer") from e
        return m

    # reading

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(FACT).parquet(*[f"{self.path}/{p}" for p in paths]) if paths else self.spark.createDataFrame([], FACT)

    def _latest(self, m: Manifest) -> DataFrame | None:
        """The last row of each key in the layers."""
        if not m.layers:
            return None
        seq = free_name([f.name for f in FACT], "td_seq")
        out = None
        for n, layer in enumerate(m.layers):
            rows = self._read([layer["path"]]).withColumn(seq, F.lit(n))
            out = rows if out is None else out.union(rows)
        return (out if len(m.layers) == 1 else merge.last_wins(out, KEY, seq)).drop(seq)

    def _base(self, m: Manifest, paths: list[str], latest: DataFrame | None, narrow=lambda rows: rows) -> DataFrame:
        """Rows of base parts less those that a layer replaces; ``narrow`` is applied to what is read."""
        over = {p for layer in m.layers for p in layer["over"]}
        plain = narrow(self._read([p for p in paths if p not in over]))
        if not over.intersection(paths):
            return plain
        rest = narrow(self._read([p for p in paths if p in over]))
        rest = rest.join(latest.select(KEY), KEY, "left_anti").select(*rest.columns)
        return rest if over.issuperset(paths) else plain.unionByName(rest)

    def fact(self, m: Manifest | None = None, months: list[str] | None = None) -> DataFrame:
        """Current rows, of some months only if named: other months' base files are not even listed."""
        m = m or self.manifest()
        latest = self._latest(m)
        base = self._base(m, [p["path"] for k, parts in sorted(m.months.items()) if months is None or k in months for p in parts], latest)
        if latest is None:
            return base
        return base.unionByName(latest if months is None else latest.where(month().isin(list(months))))

    def dim(self, name: str, m: Manifest | None = None) -> DataFrame:
        m = m or self.manifest()
        return self.spark.read.schema("id int, name string").parquet(f"{self.path}/{m.dims[name]}") if name in m.dims else self.spark.createDataFrame([], "id int, name string")

    def dims(self, m: Manifest | None = None) -> dict[str, DataFrame]:
        m = m or self.manifest()
        return {name: self.dim(name, m) for _, name, _, _ in DIMENSIONS}

    def state(self, m: Manifest | None = None) -> DataFrame:
        """One row: version, watermark, rows of the last run and of all, windows in the ledger."""
        m = m or self.manifest()
        return self.spark.createDataFrame([(m.version, m.watermark, m.rows_run, m.rows_total, len(m.ledger))], "version long, watermark string, rows_run long, rows_total long, windows long")

    def ledger(self, m: Manifest | None = None) -> DataFrame:
        """lo, hi, rows of each finished window."""
        m = m or self.manifest()
        return self.spark.createDataFrame([(datetime.fromisoformat(a), datetime.fromisoformat(b), n) for a, b, n, _ in m.ledger], "lo timestamp_ntz, hi timestamp_ntz, rows long")

    # writing into a draft of the next manifest; nothing is visible before it is published

    def write_dim(self, m: Manifest, name: str, df: DataFrame) -> None:
        folder = f"{self._folder('dims', m)}/{name}"
        df.coalesce(1).write.parquet(f"{self.path}/{folder}")
        m.dims[name] = folder

    def _holding(self, m: Manifest, keys: DataFrame) -> tuple[list[str], tuple | None]:
        """Paths of base parts whose span of keys may hold one of ``keys``, and the least and greatest of these. Keys are
        summed up by ``SPANS`` equal ranges, so the work does not grow with the parts."""
        lo, hi = keys.agg(F.min(KEY), F.max(KEY)).first()
        if lo is None:
            return [], None
        if not m.months:
            return [], (lo, hi)
        of = F.expr(f"{KEY} div {(hi - lo) // SPANS + 1}L")
        spans = sorted((r["lo"], r["hi"]) for r in keys.groupBy(of).agg(F.min(KEY).alias("lo"), F.max(KEY).alias("hi")).collect())  # a row for each range
        ends = [b for _, b in spans]
        held = lambda p: (n := bisect_left(ends, p["lo"])) < len(spans) and spans[n][0] <= p["hi"]
        return [p["path"] for parts in m.months.values() for p in parts if held(p)], (lo, hi)

    def there(self, m: Manifest, keys: DataFrame) -> DataFrame:
        """Current rows of ``keys``: only parts and row groups whose span may hold one are read."""
        return self._there(m, keys)[0]

    def _there(self, m: Manifest, keys: DataFrame) -> tuple[DataFrame, list[str]]:
        """The same, and the parts that may hold the keys."""
        keys = keys.select(KEY)
        paths, span = self._holding(m, keys)
        latest = self._latest(m)
        columns = [f.name for f in FACT]
        among = lambda rows: rows.join(keys, KEY, "left_semi").select(*columns)
        base = self._base(m, paths, latest, lambda rows: among(rows.where(F.col(KEY).between(*span)) if span else rows))
        return (base if latest is None else base.unionByName(among(latest))), paths

    def _write_months(self, rows: DataFrame, m: Manifest) -> dict[str, list[dict]]:
        """Write base parts by month and return them."""
        folder = self._folder("data", m)
        rows.withColumn("month", month()).hint("rebalance", "month").sortWithinPartitions("month", KEY).write.partitionBy("month").parquet(f"{self.path}/{folder}")
        written = sorted(s.getPath().getName().removeprefix("month=") for s in self._fs.listStatus(self._path(folder)) if s.isDirectory())
        if not written:
            return {}
        spans = self._read([f"{folder}/month={k}" for k in written]).groupBy(month().alias("m")).agg(F.min(KEY).alias("lo"), F.max(KEY).alias("hi"), F.count("*").alias("rows"))
        return {r["m"]: [{"path": f"{folder}/month={r['m']}", "lo": r["lo"], "hi": r["hi"], "rows": r["rows"]}] for r in spans.collect()}  # a row for each month

    def upsert(self, m: Manifest, incoming: DataFrame) -> dict:
        """Merge ``incoming`` (one row a key, cached or staged) as a new layer of its changed rows; returns the counts.

        A column that ``incoming`` lacks keeps its value."""
        there, over = self._there(m, incoming)
        changed = merge.changes(there, incoming, KEY).cache()  # as many rows as come in
        most = lambda: max(COMPACTED_ROWS, COMPACTED * m.rows())
        try:
            counts = merge.tally(changed).first().asDict()
            kinds, n = "iu", counts["inserted"] + counts["updated"]
            if counts["inserted"] > most():  # too many for a layer; no row of the base has their keys
                self._add(m, as_fact(changed.where("td_kind = 'i'")))
                kinds, n = "u", counts["updated"]
            if n:
                folder = self._folder("layers", m)
                as_fact(changed.where(f"instr('{kinds}', td_kind) > 0")).hint("rebalance").sortWithinPartitions(KEY).write.parquet(f"{self.path}/{folder}")
                m.layers.append({"path": folder, "rows": n, "over": over})
        finally:
            changed.unpersist()
        if len(m.layers) > MAX_LAYERS or sum(layer["rows"] for layer in m.layers) > most():
            self.compact(m)
        elif many := {k for k, parts in m.months.items() if len(parts) > MAX_PARTS}:
            self.compact(m, many)
        return counts

    def compact(self, m: Manifest, also: set[str] = frozenset()) -> None:
        """Merge the layers into the base: months that lose or get a row, and ``also``, are rewritten into one part,
        others stay as they are."""
        touched = set(also)
        if (latest := self._latest(m)) is not None:
            paths = sorted({p for layer in m.layers for p in layer["over"]})
            touched |= {r[0] for r in latest.select(month().alias("m")).distinct().collect()}
            old = self._read(paths).select(KEY, "Created_Date").join(latest.select(KEY), KEY, "left_semi")
            touched |= {r[0] for r in old.select(month().alias("m")).distinct().collect()}
        if not touched:
            return
        made = self._write_months(self.fact(m, sorted(touched)), m)
        m.months = {k: parts for k, parts in m.months.items() if k not in touched} | made
        m.layers = []

    def _add(self, m: Manifest, rows: DataFrame) -> None:
        """Rows of keys that are not there, as further parts of their months."""
        for k, parts in self._write_months(rows, m).items():
            m.months[k] = [*m.months.get(k, []), *parts]

    def append(self, m: Manifest, rows: DataFrame) -> None:
        """Add rows of keys that are not there yet, as further parts of their months."""
        if (m.months or m.layers) and not self.there(m, rows).isEmpty():
            raise EngineError("a key to append is there already")
        self._add(m, as_fact(rows))

    def truncate(self, m: Manifest) -> None:
        m.months, m.layers = {}, []

    def analyze(self, m: Manifest) -> dict[str, dict]:
        """Rows, nulls, distinct values (about), least and greatest of each key, date and id column, kept in the manifest."""
        columns = [f.name for f in FACT if f.dataType.typeName() != "string"]
        each = [a for n, c in enumerate(columns) for a in (F.count(c).alias(f"n{n}"), F.approx_count_distinct(c).alias(f"d{n}"), F.min(c).cast("string").alias(f"a{n}"), F.max(c).cast("string").alias(f"z{n}"))]
        r = self.fact(m).agg(F.count("*").alias("rows"), *each).first()
        m.statistics = {c: {"rows": r["rows"], "nulls": r["rows"] - r[f"n{n}"], "distinct": r[f"d{n}"], "least": r[f"a{n}"], "greatest": r[f"z{n}"]} for n, c in enumerate(columns)}
        return m.statistics

    def register_views(self) -> None:
        """The current fact as view ``fact`` and each dimension under its name, for SQL."""
        self.fact().createOrReplaceTempView("fact")
        for name, df in self.dims().items():
            df.createOrReplaceTempView(name)

    # rows on their way into a commit

    def spool(self, rows: DataFrame) -> str:
        """Write rows that a later commit will read; returns their folder."""
        folder = f"spool/{self._jvm.java.util.UUID.randomUUID()}"
        rows.write.parquet(f"{self.path}/{folder}")
        return f"{self.path}/{folder}"

    def spool_held(self, rows: pa.Table) -> str:
        """The same for rows that the driver holds: it writes the file itself, so they are in no job's tasks."""
        folder, sink = f"spool/{self._jvm.java.util.UUID.randomUUID()}", pa.BufferOutputStream()
        pq.write_table(rows, sink)
        made = memoryview(sink.getvalue())
        out = self._fs.create(self._path(f"{folder}/part-0.parquet"), False)
        try:
            for n in range(0, len(made), SENT_BYTES):
                out.write(bytearray(made[n : n + SENT_BYTES]))
        finally:
            out.close()
        return f"{self.path}/{folder}"

    def unspool(self, folders: list[str]) -> None:
        for f in folders:
            self._fs.delete(self._jvm.org.apache.hadoop.fs.Path(f), True)
