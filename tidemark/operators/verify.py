"""Integrity checks as queries that should give 0, and the profile after a load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expr import count_where, is_midnight
from tidemark.operators.lookups import sized
from tidemark.schema import DIMENSIONS
from tidemark.shared import free_name


def orphans(fact: DataFrame, dim: DataFrame, id_column: str, dim_id: str = "id") -> DataFrame:
    """Rows whose id names no row of the dimension."""
    return fact.where(F.col(id_column).isNotNull()).join(dim.select(F.col(dim_id).alias(id_column)), id_column, "left_anti")


def named(df: DataFrame, column: str, names) -> DataFrame:
    """Rows whose column is one of ``names``; reaches the scan."""
    return df.where(F.col(column).isin(*names))


def labelled_count(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.count("*").alias("n")).select(F.lit(label).alias("check"), "n")


def orphan_counts(fact: DataFrame, dims: dict[str, DataFrame], more=(), counted: bool = False) -> DataFrame:
    """One row: for each dimension the rows whose id names none of its rows, and ``more`` aggregates over the fact.

    One pass: small dimensions are broadcast side by side (``counted``: ``lookups.sized`` has been at them)."""
    out, counts = fact, []
    for _, dim, _, i in DIMENSIONS:
        key = free_name(out.columns, "td_id")
        ids = dims[dim].select(F.col("id").alias(key)).distinct()
        out = out.join(ids if counted else sized(ids), F.col(i) == F.col(key), "left")
        counts.append(F.count_if(F.col(i).isNotNull() & F.col(key).isNull()).alias(f"orphan {i}"))
    return out.agg(*counts, *more)


def orphan_checks(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """check, n: orphan ids and unmapped names of each dimension, and rows without a creation date."""
    more = [F.count_if(F.col(t).isNotNull() & F.col(i).isNull()).alias(f"unmapped {i}") for t, _, _, i in DIMENSIONS]
    wide = orphan_counts(fact, dims, (*more, F.count_if(F.col("Created_Date").isNull()).alias("null Created_Date")))
    return wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("check"), F.col(f"`{c}`").alias("n")) for c in wide.columns])).alias("x")).select("x.check", "x.n")


def byte_mismatches(fact: DataFrame, dim: DataFrame, text: str, id_column: str, name: str = "td_name") -> DataFrame:
    """Rows whose name differs in bytes from that of the dimension row they point to, which is added as ``name``."""
    key = free_name(fact.columns, "td_id")
    side = dim.select(F.col("id").alias(key), F.col("name").alias(name))
    return fact.where(F.col(text).isNotNull()).join(side, F.col(id_column) == F.col(key)).where(F.col(text) != F.col(name)).drop(key)


def load_profile(fact: DataFrame, key: str = "Unique_Key", created: str = "Created_Date", closed: str = "Closed_Date") -> DataFrame:
    c, d = F.col(created), F.col(closed)
    return fact.agg(
        F.count("*").alias("n_rows"), F.countDistinct(key).alias("n_keys"), count_where(c.isNull()).alias("no_created"), count_where(d.isNull()).alias("no_closed"),
        count_where(is_midnight(c)).alias("at_midnight"), F.min(created).alias("first_created"), F.max(created).alias("last_created"), count_where(d < c).alias("closed_before_created"),
    )


def nonnull_share(df: DataFrame) -> DataFrame:
    """column, n, percent of rows (0 without rows), all columns in one pass."""
    rows = free_name(df.columns, "td_rows")
    wide = df.agg(F.count("*").alias(rows), *[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    share = lambda c: F.when(F.col(rows) > 0, F.round(100.0 * F.col(f"`{c}`") / F.col(rows), 1)).otherwise(0.0)
    return wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("n"), share(c).alias("percent")) for c in df.columns])).alias("x")).select("x.column", "x.n", "x.percent")

