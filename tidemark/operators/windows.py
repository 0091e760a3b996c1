"""Half-open time windows: tiles of a range, rows by tile, what is left to do, and keyset pages."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.errors import EngineError


def tiles(start: datetime, end: datetime, width: timedelta) -> list[tuple[datetime, datetime]]:
    """[start, end) cut into windows of ``width``, the last one clipped."""
    if width <= timedelta(0):
        raise EngineError("a window must have a positive width")
    out = []
    while start < end:
        out.append((start, min(start + width, end)))
        start += width
    return out


def tiles_df(spark: SparkSession, start: str, end: str, width: str) -> DataFrame:
    """lo, hi of the same tiles as a plan; bounds as stamps' text, width as an interval's (``1 day``)."""
    return spark.sql(
        f"SELECT lo, least(lo + INTERVAL {width}, TIMESTAMP_NTZ '{end}') AS hi FROM (SELECT explode(sequence(TIMESTAMP_NTZ '{start}', TIMESTAMP_NTZ '{end}', INTERVAL {width})) AS lo) WHERE lo < TIMESTAMP_NTZ '{end}'"
    )


def count_by_tile(df: DataFrame, stamp: str, start: str, end: str, days: int) -> DataFrame:
    """lo, hi, n for each tile of whole days, empty ones with 0. Rows find their tile by arithmetic, not by a range
    join, and are summed before they meet it."""
    spark, t = df.sparkSession, F.col(stamp)
    low, high = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    inside = df.where((t >= low) & (t < high))
    nth = F.floor(F.timestamp_diff("SECOND", low, t) / F.lit(86400 * days))
    n = inside.groupBy(nth.alias("nth")).agg(F.count("*").alias("n"))
    numbered = tiles_df(spark, start, end, f"{days} day").select("lo", "hi", F.floor(F.timestamp_diff("SECOND", low, F.col("lo")) / F.lit(86400 * days)).alias("nth"))
    return numbered.join(n, "nth", "left").select("lo", "hi", F.coalesce("n", F.lit(0)).alias("n"))


def pending(tiles: DataFrame, ledger: DataFrame) -> DataFrame:
    """Tiles that the ledger has not."""
    return tiles.join(ledger.select("lo", "hi"), ["lo", "hi"], "left_anti")


def keyset_page(df: DataFrame, stamp: str, key: str, after, inclusive: bool, size: int) -> DataFrame:
    """The next rows in the total order (stamp, key): a top-n, never a full sort."""
    bound = F.lit(after).cast("timestamp_ntz")
    return df.where(F.col(stamp) >= bound if inclusive else F.col(stamp) > bound).orderBy(stamp, key).limit(size)


def boundary_keys(page: DataFrame, stamp: str, key: str) -> DataFrame:
    """Keys that carry the page's greatest stamp."""
    top = page.agg(F.max(stamp).alias("td_top"))
    return page.join(F.broadcast(top), F.col(stamp) == F.col("td_top")).select(key)  # one row is broadcast


def tie_groups(df: DataFrame, stamp: str, page_size: int) -> DataFrame:
    """Stamps that as many rows share as fill a page."""
    return df.where(F.col(stamp).isNotNull()).groupBy(stamp).agg(F.count("*").alias("n")).where(F.col("n") >= page_size)


def halves(ask, lo: datetime, hi: datetime, floor: timedelta = timedelta(seconds=1)):
    """(lo, hi, answer) for parts of [lo, hi), oldest first. ``ask(lo, hi)`` gives an answer and whether it may be cut
    short; then its part is halved."""
    left = [(lo, hi)]
    while left:
        lo, hi = left.pop()
        answer, full = ask(lo, hi)
        if not full:
            yield lo, hi, answer
        elif hi - lo <= floor:
            raise EngineError(f"[{lo}, {hi}) is full and cannot be split")
        else:
            middle = lo + (hi - lo) / 2
            left += [(middle, hi), (lo, middle)]


def bisect(count, lo: datetime, hi: datetime, size: int, floor: timedelta = timedelta(seconds=1)) -> list[tuple[datetime, datetime]]:
    """[lo, hi) split by halves until each part counts fewer than ``size``; oldest first."""
    return [(a, b) for a, b, _ in halves(lambda a, b: (None, count(a, b) >= size), lo, hi, floor)]


def since(df: DataFrame, stamp: str, mark, overlap: timedelta = timedelta(0)) -> DataFrame:
    """Rows after the mark less the overlap; the bound reaches the scan."""
    return df.where(F.col(stamp) > F.lit(mark - overlap))


def pinned(df: DataFrame, stamp: str, at, created: str, lo: datetime, hi: datetime) -> DataFrame:
    """Rows of one change stamp created in [lo, hi)."""
    return df.where((F.col(stamp) == F.lit(at)) & (F.col(created) >= F.lit(lo)) & (F.col(created) < F.lit(hi)))


def unseen(page: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows whose key was not read before."""
    return page.join(seen.select(key), key, "left_anti").select(*page.columns)


def marks(df: DataFrame, stamp: str, overlap: timedelta, before=None) -> DataFrame:
    """watermark (the batch's greatest stamp), start (less the overlap) and running (never below ``before``)."""
    top = F.max(stamp)
    return df.agg(top.alias("watermark"), (top - F.lit(overlap)).alias("start"), (top if before is None else F.greatest(top, F.lit(before))).alias("running"))
