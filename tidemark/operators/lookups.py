"""Dimensions: build, extend, resolve and stamp their ids. Names match on ``match_key``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expr import match_key
from tidemark.shared import free_name

#: Names of a dimension up to which one is sent to all executors; its rows are counted before.
BROADCAST_NAMES = 65_535


def distinct_names(df: DataFrame, column: str) -> DataFrame:
    """key, name: the spellings of a name that match, as their first by code point."""
    return df.where(F.col(column).isNotNull()).groupBy(match_key(F.col(column)).alias("key")).agg(F.min(column).alias("name"))


def _numbered(names: DataFrame, after: int = 0) -> DataFrame:
    """Ids in the order of names, after ``after``. One partition numbers them; a dimension is some hundred names."""
    return names.select((F.row_number().over(Window.orderBy("name")) + after).cast("int").alias("id"), "name")


def build_dim(df: DataFrame, column: str) -> DataFrame:
    """id, name of each distinct name, numbered from 1 in code point order."""
    return _numbered(distinct_names(df, column))


def missing_names(df: DataFrame, column: str, dim: DataFrame) -> DataFrame:
    known = dim.select(match_key(F.col("name")).alias("key"))
    return distinct_names(df, column).join(known, "key", "left_anti")


def unseen_names(df: DataFrame, dims: list[tuple[str, DataFrame]]) -> set[str]:
    """The text columns that hold a name which their dimension lacks; one pass over ``df``."""
    names = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("name")) for c, _ in dims]))).where("name IS NOT NULL")
    names = names.select("column", match_key(F.col("name")).alias("key")).distinct()
    known = reduce(DataFrame.union, [dim.select(F.lit(c).alias("column"), match_key(F.col("name")).alias("key")) for c, dim in dims])
    return {r[0] for r in names.join(known, ["column", "key"], "left_anti").select("column").distinct().collect()}  # a row for each column


def extend_dim(df: DataFrame, column: str, dim: DataFrame) -> DataFrame:
    """The dimension with unseen names appended after its highest id; ids given before never change."""
    after = dim.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    return dim.select("id", "name").union(_numbered(missing_names(df, column, dim), after))


def sized(dim: DataFrame, limit: int = BROADCAST_NAMES) -> DataFrame:
    """The dimension's rows marked for broadcast if there are ``limit`` at most; else as it is, for a shuffled join.
    Its plan runs once: the rows that were counted are those that are sent."""
    rows = dim.limit(limit + 1).toArrow()  # bounded
    return F.broadcast(dim.sparkSession.createDataFrame(rows, dim.schema)) if rows.num_rows <= limit else dim


def stamp_ids(fact: DataFrame, dims: list[tuple[Column, DataFrame, str]], how: str = "left", counted: bool = False) -> DataFrame:
    """``fact`` with an id column for each (text column, dimension, id name). All joins sit in one stage while the
    dimensions are small (``counted``: ``sized`` has been at them); a null name has a null id."""
    for text, dim, name in dims:
        key = free_name([*fact.columns, name], "td_key")
        side = dim.select(match_key(F.col("name")).alias(key), F.col("id").alias(name))
        side = side if counted else sized(side)
        fact = fact.drop(name).join(side, match_key(text) == F.col(key), how).drop(key)
    return fact
