"""Upserts as plans: last wins in a batch, then a join with the rows that are there."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.shared import free_name


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def last_wins(batch: DataFrame, key: str, *order: str) -> DataFrame:
    """One row for each key: the last by ``order``. All columns stay, whatever their names."""
    nth = free_name(batch.columns, "td_nth")
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return batch.withColumn(nth, F.row_number().over(w)).where(F.col(nth) == 1).drop(nth)


def upsert(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Rows of ``existing`` whose key does not come in, and all of ``incoming`` (one row a key). A column that
    ``incoming`` lacks is carried over from the row of the same key, else null. ``incoming`` is read twice: pass a
    staged or cached one if it is costly."""
    carried = [c for c in existing.columns if c not in incoming.columns]
    rest = existing.join(incoming.select(key), key, "left_anti")
    if carried:
        incoming = incoming.join(existing.select(key, *carried), key, "left")
    return rest.unionByName(incoming.select(*existing.columns))


def changes(existing: DataFrame, incoming: DataFrame, key: str, kind: str = "td_kind") -> DataFrame:
    """``incoming`` (one row a key) with the columns that only ``existing`` has, and ``kind``: i for a new key, u for a
    row that differs, s for the same. ``existing`` and ``incoming`` are each read once."""
    shared = [c for c in incoming.columns if c != key]
    carried = [c for c in existing.columns if c not in incoming.columns]
    names: list[str] = [*incoming.columns, *carried]
    old = {}
    for c in (key, *shared):
        old[c] = free_name(names, f"td_{c}")
        names.append(old[c])
    there = set(existing.columns)
    side = existing.selectExpr(*[f"{_quoted(c) if c in there else 'NULL'} AS {_quoted(a)}" for c, a in old.items()], *map(_quoted, carried))
    same = " AND ".join(["true", *(f"{_quoted(c)} <=> {_quoted(old[c])}" for c in shared)])
    joined = incoming.join(side, F.col(_quoted(key)) == F.col(_quoted(old[key])), "left")
    return joined.selectExpr(*map(_quoted, (*incoming.columns, *carried)), f"CASE WHEN {_quoted(old[key])} IS NULL THEN 'i' WHEN {same} THEN 's' ELSE 'u' END AS {_quoted(kind)}")


def tally(changed: DataFrame, kind: str = "td_kind") -> DataFrame:
    """inserted, updated, unchanged and affected (an update counts twice) of ``changes``."""
    n = lambda k: F.count_if(F.col(kind) == k)
    return changed.agg(n("i").alias("inserted"), n("u").alias("updated"), n("s").alias("unchanged"), (n("i") + 2 * n("u")).alias("affected"))


def affected(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """The tally of an upsert, without doing it."""
    kind = free_name([*existing.columns, *incoming.columns], "td_kind")
    return tally(changes(existing.select(*[c for c in incoming.columns if c in existing.columns]), incoming, key, kind), kind)
