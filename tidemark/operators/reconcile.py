"""Two-sided counts by period."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expr import flag, period


def counts(df: DataFrame, stamp: str, grain: str, low=None, high=None) -> DataFrame:
    """period, n over [low, high); rows without a stamp are in no period. The bounds reach the scan."""
    if low is not None:
        df = df.where(F.col(stamp) >= F.lit(low))
    if high is not None:
        df = df.where(F.col(stamp) < F.lit(high))
    return df.where(F.col(stamp).isNotNull()).groupBy(period(F.col(stamp), grain).alias("period")).agg(F.count("*").alias("n"))


def count_by(df: DataFrame, column: str) -> DataFrame:
    """Rows of each value of a column."""
    return df.groupBy(column).agg(F.count("*").alias("n"))


def compare(source: DataFrame, ours: DataFrame) -> DataFrame:
    """period, source, ours, difference (source - ours), flag; a period that one side lacks counts 0 there."""
    both = source.select("period", F.col("n").alias("source")).join(ours.select("period", F.col("n").alias("ours")), "period", "full_outer")
    both = both.select("period", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("source", "ours")])
    difference: Column = F.col("source") - F.col("ours")
    return both.select("period", "source", "ours", difference.alias("difference"), flag(difference).alias("flag"))


def totals(compared: DataFrame) -> DataFrame:
    """One row: sums of both sides, rows short and extra, periods compared and differing."""
    d = F.col("difference")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return compared.agg(
        total("source").alias("source"), total("ours").alias("ours"), total(F.greatest(d, F.lit(0))).alias("short"), total(F.greatest(-d, F.lit(0))).alias("extra"),
        F.count("*").alias("periods"), F.count_if(d != 0).alias("differing"),
    )


def report(title: str, compared: DataFrame) -> str:
    """The comparison as text, periods in order, with a total row; diff is ours less the source."""
    # The layout of the report, which other programs read.
    rule = "-" * 46
    lines = [title, f"{'period':<12}{'API':>12}{'DB':>12}{'diff':>10}", rule]
    rows = compared.orderBy("period").collect()
    for r in rows:
        lines.append(f"{r['period']:<12}{r['source']:>12,}{r['ours']:>12,}{-r['difference']:>+10,}" + (f"  {r['flag']}" if r["flag"] else ""))
    source, ours = (sum(r[c] for r in rows) for c in ("source", "ours"))
    return "\n".join([*lines, rule, f"{'total':<12}{source:>12,}{ours:>12,}{ours - source:>+10,}"])


def shortfall_line(short: int, now: datetime) -> str:
    """The last line of a run, which the nightly run reads."""
    return f"checked at {now.isoformat(timespec='seconds')}; total DB shortfall across periods: {short:,}"


def key_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct keys of either side (one column each)."""
    return a.union(b).distinct()


def key_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct keys of ``a`` that ``b`` lacks."""
    return a.exceptAll(b.distinct()).distinct()


def daily_audit(compared: DataFrame) -> str:
    """Days compared and differing, rows short and extra, and both totals."""
    t = totals(compared).first()
    return f"days compared: {t['periods']}\ndays differing: {t['differing']}\nrows short: {t['short']:,}; rows extra: {t['extra']:,}\ntotal: source {t['source']:,}, ours {t['ours']:,}"
