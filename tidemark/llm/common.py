"""Helpers shared by the text operators: staging to the shared folder, joins on uneven keys, Arrow batches, words."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import chain, islice

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.shared import hadoop_path, shared_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Lower-cases A-Z and turns every other ASCII character but letters and digits into a blank.
_ALNUM = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
#: Bytes of text that one slice of an Arrow batch may hold while Python objects exist for it.
SLICE_BYTES = 1 << 20
#: A key of a join with over 1 / HOT of the rows is hot; there are at most that many.
HOT = 1 << 16
#: Rows of a few numbers that one task writes, where their number is known.
FILE_ROWS = 1 << 18
_scratch: list[list[str]] = []


def utf8(text: str | bytes) -> bytes:
    return text if isinstance(text, bytes) else text.encode("utf-8", "surrogatepass")


def spaced_words(text: str | bytes, lower: bool = False) -> list[bytes]:
    """``[^\\x20\\x09-\\x0D]+`` of a text in UTF-8 (bytes are split at just these; they lower-case just A-Z)."""
    text = utf8(text)
    return (text.lower() if lower else text).split()


def alnum_words(text: str | bytes) -> list[bytes]:
    """``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text with A-Z lower-cased, in UTF-8."""
    return utf8(text).translate(_ALNUM).split()


def byte_list(array: pa.Array) -> list[bytes | None]:
    """An Arrow column of texts as Python bytes."""
    return array.cast(pa.binary()).to_pylist()


def packed(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of at most ``rows`` rows, in a partition for each ``FILE_ROWS`` of them, or for each core if that is more."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, rows // FILE_ROWS))


def stage(df: DataFrame, name: str = "stage", keep: bool = False, rows: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends, and its size is known to the planner.

    Within ``scratch`` the files go at its end (of the one around it, if kept); else they stay until ``release`` or
    the session's end. A table of at most ``rows`` rows is ``packed``: on a local file system an executor starts three
    processes for each file that it writes, and small tables would have as many files as a shuffle has partitions.
    """
    spark = df.sparkSession
    folder = shared_dir(spark)
    (df if rows is None else packed(df, rows)).write.parquet(f"{folder}/{name}")
    out = spark.read.schema(df.schema).parquet(f"{folder}/{name}")
    out.staged_in = folder
    if len(_scratch) > keep:
        _scratch[-1 - keep].append(folder)
    return out


def _delete(spark: SparkSession, folder: str) -> None:
    fs, target = hadoop_path(spark, folder)
    fs.delete(target, True)


def release(df: DataFrame) -> None:
    """Delete the files of a staged table that no later plan reads."""
    _delete(df.sparkSession, df.staged_in)


@contextmanager
def scratch(spark: SparkSession):
    """Tables staged within are deleted at the end: what comes out has to be staged with ``keep``."""
    _scratch.append([])
    try:
        yield
    finally:
        for folder in _scratch.pop():
            _delete(spark, folder)


def spread_join(left: DataFrame, right: DataFrame, key: str, rows: str, total: int) -> DataFrame:
    """``left`` joined on ``key`` with ``right`` (staged, one row a key; ``rows``: left rows of the key, ``total``: of all).

    Keys with over 1 / ``HOT`` of the rows, of which there are fewer than ``HOT``, are broadcast, so no task gets them
    whole; the others, each with at most that share, are dealt by key. Both sides are read twice.
    """
    hot = F.col(rows) * HOT > total
    top = F.broadcast(right.where(hot).drop(rows))  # fewer than HOT rows, by the condition
    rest = left.join(F.broadcast(right.where(hot).select(key)), key, "left_anti")
    return left.join(top, key).unionByName(rest.join(right.where(~hot).drop(rows), key))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns that an operator reads, under fixed names; a null text counts as empty."""
    return df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that ``column`` holds about ``limit`` bytes in each part (one row at least)."""
    array, start, held = batch.column(batch.schema.get_field_index(column)), 0, 0
    sizes = pa.compute.binary_length(array).to_pylist()
    for i, size in enumerate(sizes):
        if held and held + (size or 0) > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size or 0
    if start < batch.num_rows:
        yield batch.slice(start)


class Kept:
    """Bytes that stand for fragments of text; ``learn`` gives those of a list of fragments.

    A worker keeps the first ``bound`` fragments that it meets (frequent ones are among them, save after a change of
    the texts' kind: so it starts anew when it has learned ``RENEWED`` times as many) and no fragment over ``LENGTH``
    characters.
    """

    LENGTH, RENEWED = 64, 8

    def __init__(self, bound: int, split: Callable[[str], list[str]], learn: Callable[[list[str]], list[bytes]]):
        self.bound, self.split, self.learn = bound, split, learn
        self.known: dict[str, bytes] = {}
        self.learned = 0

    def join(self, texts: list[str]) -> list[bytes]:
        """For each text the bytes of its fragments, one after the other.

        A text's fragments are looked up at once, while they are in the processor's cache; of a text with unknown
        ones only those fragments stay.
        """
        if self.learned > self.RENEWED * self.bound:
            self.known.clear()
            self.learned = 0
        known, out, gaps = self.known, [], []
        for text in texts:
            fragments = self.split(text)
            found = list(map(known.get, fragments))
            if None not in found:
                out.append(b"".join(found))
                continue
            at, i = [], -1  # fragments that are not known
            for _ in range(found.count(None)):
                at.append(i := found.index(None, i + 1))
            gaps.append((len(out), found, at, [fragments[i] for i in at]))
            out.append(b"")
        new = list(set(chain.from_iterable(g[3] for g in gaps)))
        got = dict(zip(new, self.learn(new), strict=True)) if new else {}
        for k, found, at, fragments in gaps:
            for i, f in zip(at, fragments, strict=True):
                found[i] = got[f]
            out[k] = b"".join(found)
        self.learned += len(new)
        if (room := self.bound - len(known)) > 0:
            known.update(islice(((f, x) for f, x in got.items() if len(f) <= self.LENGTH), room))
        return out


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "double": pa.float64(), "binary": pa.binary(), "int": pa.int32(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in ddl.split(","))])


def record_batch(columns: list, ddl: str) -> pa.RecordBatch:
    schema = arrow_schema(ddl)
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
