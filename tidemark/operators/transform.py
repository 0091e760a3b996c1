"""Typed fact rows from the feed's or a CSV's text columns: projections only, one narrow stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.errors import EngineError
from tidemark.functions import expr
from tidemark.schema import CHANGED, COLUMNS, CSV_DATE, IDS, POINT_WIDTH, REQUIRED_HEADERS


def _typed(text: Column, rule, date) -> Column:
    if rule == "date":
        return expr.to_seconds(date(text))
    if rule == "double":
        return expr.lenient_double(text)
    if isinstance(rule, int):
        return expr.clip(text, rule)
    return text


def feed_transform(feed: DataFrame, strict: bool = True, keep_changed: bool = True, extra: tuple[str, ...] = ()) -> DataFrame:
    """Feed fields to the columns that a feed load writes, absent fields as nulls, dimension ids null; an integer
    key and dates that do not parse raise. ``changed`` (the row's change stamp) is added for last-wins, and ``extra`` columns stay."""
    there = set(feed.columns)
    out = []
    for name, field, _, rule in COLUMNS:
        if field is None:
            continue
        text = F.col(f"`{field}`") if field in there else F.lit(None).cast("string")
        if rule == "key":
            value = expr.strict_integer(text) if strict else expr.lenient_integer(text)
        elif rule == "point":
            value = expr.clip(expr.geojson_to_wkt(text), POINT_WIDTH)
        else:
            value = _typed(text, rule, lambda c: expr.parse_iso(c, strict))
        out.append(value.alias(name))
    out += [F.lit(None).cast("int").alias(i) for i in IDS]
    if keep_changed and CHANGED in there:
        out.append(expr.parse_iso(F.col(f"`{CHANGED}`"), strict).alias("changed"))
    return feed.select(*out, *extra)


def normalize_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().strip('"').strip() for c in df.columns])


def require_columns(df: DataFrame, required=REQUIRED_HEADERS) -> None:
    if missing := sorted(set(required) - set(df.columns)):
        raise EngineError(f"the file lacks required columns: {', '.join(missing)}")


def retype(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Columns cast to other types, in place; a value that does not survive the cast there and back raises."""
    out = df
    for column, kind in types.items():
        c, kept = F.col(f"`{column}`"), F.col(f"`{column}`").try_cast(kind)
        fits = c.isNull() | (kept.try_cast(df.schema[column].dataType) == c)
        out = out.withColumn(column, F.when(fits, kept).otherwise(F.raise_error(F.concat(F.lit(f"{column} does not fit into {kind}: "), c.cast("string"))).cast(kind)))
    return out


def csv_transform(raw: DataFrame, date_format: str = CSV_DATE, strict: bool = True) -> DataFrame:
    """CSV text columns to typed fact columns: mapped headers only, in the fact's order; missing-value texts are
    null; a key that is no integer is null (the key guard refuses it later)."""
    raw = normalize_headers(raw)
    require_columns(raw)
    there, out = set(raw.columns), []
    for name, _, header, rule in COLUMNS:
        if header in there:
            text = expr.null_tokens(F.col(f"`{header}`"))
            value = expr.lenient_integer(text) if rule == "key" else expr.clip(text, POINT_WIDTH) if rule == "point" else _typed(text, rule, lambda c: expr.parse_csv_date(c, date_format, strict))
            out.append(value.alias(name))
    return raw.select(*out)
