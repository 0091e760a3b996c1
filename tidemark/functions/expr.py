"""Scalar functions as Column expressions; none needs a UDF."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schema import CSV_DATE, CSV_NULLS

#: What counts as an ISO stamp: a date, then a time to any depth, then any number of Z.
ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?)?Z*$"
_POINT = "type string, coordinates array<string>"


def is_blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def iso_valid(c: Column) -> Column:
    """True for what ``parse_iso`` takes; null and '' are taken as null."""
    return is_blank(c) | (c.rlike(ISO) & _iso(c).isNotNull())


def _iso(c: Column) -> Column:
    return F.rtrim(c, F.lit("Z")).try_cast("timestamp_ntz")


def parse_iso(c: Column, strict: bool = True) -> Column:
    """ISO stamp to timestamp without zone, its Z dropped. Blank is null; anything else that does not parse raises
    (not strict: null). A zone offset is refused, as a plain cast would drop it silently."""
    bad = F.raise_error(F.concat(F.lit("not an ISO stamp: "), c)).cast("timestamp_ntz") if strict else F.lit(None).cast("timestamp_ntz")
    return F.when(is_blank(c), F.lit(None).cast("timestamp_ntz")).when(c.rlike(ISO) & _iso(c).isNotNull(), _iso(c)).otherwise(bad)


def _csv_date(c: Column, pattern: str) -> Column:
    return F.try_to_timestamp(F.trim(c), F.lit(pattern)).cast("timestamp_ntz")


def csv_date_valid(c: Column, pattern: str = CSV_DATE) -> Column:
    return is_blank(c) | _csv_date(c, pattern).isNotNull()


def parse_csv_date(c: Column, pattern: str = CSV_DATE, strict: bool = True) -> Column:
    """12-hour date to timestamp without zone; blank is null, other text that does not parse raises."""
    parsed = _csv_date(c, pattern)
    bad = F.raise_error(F.concat(F.lit("not a date: "), c)).cast("timestamp_ntz") if strict else F.lit(None).cast("timestamp_ntz")
    return F.when(is_blank(c), F.lit(None).cast("timestamp_ntz")).when(parsed.isNotNull(), parsed).otherwise(bad)


def to_seconds(c: Column) -> Column:
    """Drop fractions of a second."""
    return F.date_trunc("second", c).cast("timestamp_ntz")


def strict_integer(c: Column) -> Column:
    """Blank is null; other text that is no integer raises."""
    return F.when(is_blank(c), F.lit(None).cast("long")).otherwise(F.coalesce(F.trim(c).try_cast("long"), F.raise_error(F.concat(F.lit("not an integer: "), c)).cast("long")))


def lenient_integer(c: Column) -> Column:
    return F.trim(c).try_cast("long")


def lenient_double(c: Column) -> Column:
    """Text that is no number is null, and so is NaN."""
    x = F.trim(c).try_cast("double")
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


def clip(c: Column, width: int) -> Column:
    """The first ``width`` code points."""
    return F.left(c, F.lit(width))


def geojson_to_wkt(c: Column) -> Column:
    """A GeoJSON object's two coordinates as a WKT point; anything else is null."""
    at = F.from_json(c, _POINT)["coordinates"]
    return F.when(F.size(at) == 2, F.format_string("POINT (%s %s)", at[0], at[1]))


def ms_stamp(c: Column) -> Column:
    """Stamp to text with milliseconds, finer digits cut off."""
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS")


#: Grain -> (pattern of a period's label, unit to truncate to, width of the label).
GRAINS = {"year": ("yyyy", "year", 4), "month": ("yyyy-MM", "month", 7), "day": ("yyyy-MM-dd", "day", 10)}


def period(c: Column, grain: str) -> Column:
    return F.date_format(c, GRAINS[grain][0])


def period_by_truncation(c: Column, grain: str) -> Column:
    """The same label cut from a truncated stamp's text, as a source that only truncates gives it."""
    _, unit, width = GRAINS[grain]
    return F.left(ms_stamp(F.date_trunc(unit, c).cast("timestamp_ntz")), F.lit(width))


def is_midnight(c: Column) -> Column:
    return F.date_format(c, "HH:mm:ss") == "00:00:00"


def null_tokens(c: Column, tokens: Iterable[str] = CSV_NULLS) -> Column:
    return F.when(c.isin(*tokens), F.lit(None).cast("string")).otherwise(c)


def match_key(c: Column) -> Column:
    """The one spelling under which names are equal: no case, no blanks at the end. A plain expression, so joins on
    it can broadcast, which joins on collated columns cannot."""
    return F.lower(F.rtrim(c))


def flag(difference: Column) -> Column:
    """difference: source minus ours."""
    return F.when(difference > 0, "<- DB short").when(difference < 0, "<- DB extra").otherwise("")


def count_where(condition: Column) -> Column:
    """Sum of a predicate: null, not 0, over no rows."""
    return F.sum(condition.cast("int"))
