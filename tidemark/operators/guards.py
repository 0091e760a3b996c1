"""Refusals. Each measures with one aggregate and raises ``EngineError``."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.errors import EngineError
from tidemark.functions import expr
from tidemark.schema import COLUMNS, CSV_DATE, DIMENSIONS

log = logging.getLogger(__name__)


def batch_sanity(batch: DataFrame, key: str = "Unique_Key", created: str = "Created_Date", changed: str | None = None) -> dict:
    """Refuses a batch in which no row has a creation date, or any row lacks its key; warns if some lack the date. An
    empty batch passes. With ``changed``, a batch without any change stamp is refused, and ``newest`` is its greatest."""
    stamps = [F.max(changed).alias("newest")] if changed else []
    m = batch.agg(F.count("*").alias("rows"), F.count(created).alias("dated"), F.count_if(F.col(key).isNull()).alias("keyless"), *stamps).first().asDict()
    if changed and m["rows"] and m["newest"] is None:
        raise EngineError("no row of the batch carries a change stamp")
    if m["keyless"]:
        raise EngineError(f"{m['keyless']} rows have no {key}")
    if m["rows"] and not m["dated"]:
        raise EngineError(f"none of {m['rows']} rows has a {created}: the feed's answer is not to be trusted")
    if m["dated"] < m["rows"]:
        log.warning("%d of %d rows have no %s", m["rows"] - m["dated"], m["rows"], created)
    return m


def resolved(stamped: DataFrame) -> None:
    """Refuses rows with a name but no id."""
    counts = stamped.agg(*[F.count_if(F.col(t).isNotNull() & F.col(i).isNull()).alias(i) for t, _, _, i in DIMENSIONS]).first().asDict()
    if bad := {k: v for k, v in counts.items() if v}:
        raise EngineError(f"names without an id: {bad}")


def dates_parse(raw: DataFrame, source: str = "csv", pattern: str = CSV_DATE) -> None:
    """Refuses text in date columns that does not parse, naming each column with its count and three samples."""
    tests = []
    for name, field, header, rule in COLUMNS:
        column = header if source == "csv" else field
        if rule == "date" and column in raw.columns:
            text = expr.null_tokens(F.col(f"`{column}`")) if source == "csv" else F.col(f"`{column}`")
            tests.append((name, text, expr.csv_date_valid(text, pattern) if source == "csv" else expr.iso_valid(text)))
    if not tests:
        return
    bad = raw.select(F.explode(F.array(*[F.when(~ok, F.struct(F.lit(n).alias("column"), t.alias("text"))) for n, t, ok in tests])).alias("x")).where("x IS NOT NULL").select("x.column", "x.text")
    found = bad.groupBy("column").agg(F.count("*").alias("n"), F.min("text").alias("a"), F.max("text").alias("b"), F.any_value("text").alias("c")).collect()
    if found:
        raise EngineError("dates that do not parse: " + "; ".join(f"{r['column']}: {r['n']} ({', '.join(sorted({r['a'], r['b'], r['c']}))})" for r in sorted(found)))


def column_filled(df: DataFrame, column: str = "Created_Date") -> None:
    rows, filled = df.agg(F.count("*"), F.count(column)).first()
    if rows and not filled:
        raise EngineError(f"{column} is null in all {rows} rows")


def primary_key(df: DataFrame, key: str = "Unique_Key") -> None:
    rows, keys = df.agg(F.count("*"), F.countDistinct(key)).first()
    if rows != keys:
        raise EngineError(f"{rows} rows have {keys} distinct keys in {key}")


def dimension_names(dim: DataFrame) -> None:
    rows, names, ids = dim.agg(F.count("*"), F.countDistinct(expr.match_key(F.col("name"))), F.countDistinct("id")).first()
    if not rows == names == ids:
        raise EngineError(f"a dimension of {rows} rows has {names} names and {ids} ids")


def referenced(fact: DataFrame, dims: dict[str, DataFrame]) -> None:
    """Refuses ids that name no row of their dimension; one pass over ``fact``."""
    from tidemark.operators.verify import orphan_counts

    counts = orphan_counts(fact, dims).first().asDict()
    if bad := {k: n for k, n in counts.items() if n}:
        raise EngineError(f"ids that no dimension has: {bad}")


def commit(stamped: DataFrame, dims: dict[str, DataFrame], key: str = "Unique_Key") -> None:
    """What a commit must keep to, in one pass: one row a key, names with ids, ids that their dimension has."""
    from tidemark.operators.verify import orphan_counts

    more = [F.count_if(F.col(t).isNotNull() & F.col(i).isNull()).alias(f"unmapped {i}") for t, _, _, i in DIMENSIONS if t in stamped.columns]
    counts = orphan_counts(stamped, dims, (*more, (F.count("*") - F.countDistinct(key)).alias(f"repeated {key}")), counted=True).first().asDict()
    if bad := {k: n for k, n in counts.items() if n}:
        raise EngineError(f"rows that must not be stored: {bad}")


class RowsMissing(EngineError):
    """The source has rows that are not in the store."""


#: Fixed value: rows that may be missing after a load.
TOLERATED = 1000


def shortfall(short: int, limit: int = TOLERATED) -> None:
    """Refuses a load after which more rows are missing than are tolerated."""
    if short > limit:
        raise RowsMissing(f"{short} rows are missing; {limit} are tolerated")
