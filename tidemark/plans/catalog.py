"""Queries over the test tables, one or more for each operator, with DuckDB SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.errors import EngineError
from tidemark.functions import expr
from tidemark.operators import guards, load, lookups, merge, reconcile, verify, windows
from tidemark.operators.store import SnapshotStore
from tidemark.shared import shared_dir
from tidemark.sources import feed
from tidemark.sources.fake import StaleFeed, TableFeed
from tidemark.sources.staged import StagedFeed

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str, name: str | None = None):
    def add(f):
        _QUERIES[name or f.__name__] = f
        _SQL[name or f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# Counts


@query("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def count_by_status(spark, d):
    return reconcile.count_by(table(spark, d, "orders"), "o_orderstatus")


_MIXED = "CASE WHEN o_orderkey % 2 = 0 THEN upper(o_orderpriority) ELSE lower(o_orderpriority) || ' ' END"


def _mixed_case(df):
    return df.withColumn("name", F.when(F.col("o_orderkey") % 2 == 0, F.upper("o_orderpriority")).otherwise(F.concat(F.lower("o_orderpriority"), F.lit(" "))))


@query(f"SELECT lower(rtrim({_MIXED})) AS name, count(*) AS n FROM orders GROUP BY 1")
def count_by_status_ci(spark, d):
    return _mixed_case(table(spark, d, "orders")).groupBy(expr.match_key(F.col("name")).alias("name")).agg(F.count("*").alias("n"))


@query(f"SELECT upper(rtrim({_MIXED})) AS name, count(*) AS n FROM orders GROUP BY 1")
def count_by_collation(spark, d):
    df = _mixed_case(table(spark, d, "orders")).groupBy(F.expr("name COLLATE UTF8_LCASE_RTRIM").alias("c")).agg(F.count("*").alias("n"))
    return df.select(F.expr("upper(rtrim(c)) COLLATE UTF8_BINARY").alias("name"), "n")


def _count_by(grain, pattern):
    @query(f"SELECT strftime(o_orderdate, '{pattern}') AS period, count(*) AS n FROM orders GROUP BY 1", f"count_by_{grain}")
    def run(spark, d):
        return reconcile.counts(table(spark, d, "orders"), "o_orderdate", grain)


for _grain, _pattern in (("year", "%Y"), ("month", "%Y-%m"), ("day", "%Y-%m-%d")):
    _count_by(_grain, _pattern)


@query("SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m') AS period, count(*) AS n FROM orders GROUP BY 1")
def count_by_month_source_side(spark, d):
    return table(spark, d, "orders").groupBy(expr.period_by_truncation(F.col("o_orderdate"), "month").alias("period")).agg(F.count("*").alias("n"))


@query("SELECT strftime(o_orderdate, '%Y-%m') AS period, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1996-03-05' AND o_orderdate < TIMESTAMP '1997-02-01' GROUP BY 1")
def count_bounded_range(spark, d):
    return reconcile.counts(table(spark, d, "orders"), "o_orderdate", "month", datetime(1996, 3, 5), datetime(1997, 2, 1))


@query("SELECT count(*) AS n, min(l_shipdate) AS first, max(l_shipdate) AS last, count(DISTINCT l_orderkey) AS n_orders FROM lineitem")
def count_all(spark, d):
    return table(spark, d, "lineitem").agg(F.count("*").alias("n"), F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last"), F.countDistinct("l_orderkey").alias("n_orders"))


# Reconciliation


def _sides(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    shifted = orders.where("o_orderkey % 101 = 0").withColumn("o_orderdate", F.expr("o_orderdate - INTERVAL 10 YEAR"))
    return orders, orders.where("o_orderkey % 97 != 0").union(shifted)


_SIDES = """
WITH s AS (SELECT strftime(o_orderdate, '%Y-%m') AS period, count(*) AS n FROM orders GROUP BY 1),
o AS (SELECT strftime(x, '%Y-%m') AS period, count(*) AS n FROM (SELECT o_orderdate AS x FROM orders WHERE o_orderkey % 97 <> 0
      UNION ALL SELECT o_orderdate - INTERVAL 10 YEAR FROM orders WHERE o_orderkey % 101 = 0) GROUP BY 1),
c AS (SELECT coalesce(s.period, o.period) AS period, coalesce(s.n, 0) AS source, coalesce(o.n, 0) AS ours, coalesce(s.n, 0) - coalesce(o.n, 0) AS difference FROM s FULL JOIN o ON s.period = o.period)
"""


def _compared(spark, d):
    source, ours = _sides(spark, d)
    return reconcile.compare(reconcile.counts(source, "o_orderdate", "month"), reconcile.counts(ours, "o_orderdate", "month"))


@query(_SIDES + "SELECT *, CASE WHEN difference > 0 THEN '<- DB short' WHEN difference < 0 THEN '<- DB extra' ELSE '' END AS flag FROM c")
def reconcile_by_month(spark, d):
    return _compared(spark, d)


@query(_SIDES + "SELECT sum(source)::BIGINT AS source, sum(ours)::BIGINT AS ours, sum(greatest(difference, 0))::BIGINT AS short, sum(greatest(-difference, 0))::BIGINT AS extra, count(*) AS periods, count(*) FILTER (difference <> 0) AS differing FROM c")
def reconcile_shortfall(spark, d):
    return reconcile.totals(_compared(spark, d))


# Dimensions


@query("SELECT row_number() OVER (ORDER BY name)::INTEGER AS id, name FROM (SELECT min(c_mktsegment) AS name FROM customer WHERE c_custkey % 13 <> 0 GROUP BY lower(rtrim(c_mktsegment)))")
def dim_build(spark, d):
    return lookups.build_dim(table(spark, d, "customer").withColumn("name", F.expr("CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_mktsegment END")), "name")


@query("""WITH p AS (SELECT DISTINCT o_orderpriority AS name FROM orders), old AS (SELECT row_number() OVER (ORDER BY name DESC)::INTEGER AS id, name FROM p ORDER BY name DESC LIMIT 3)
SELECT * FROM old UNION ALL SELECT (3 + row_number() OVER (ORDER BY name))::INTEGER, name FROM p WHERE name NOT IN (SELECT name FROM old)""")
def dim_extend(spark, d):
    orders = table(spark, d, "orders")
    old = orders.select("o_orderpriority").distinct().orderBy(F.desc("o_orderpriority")).limit(3)
    old = old.select(F.row_number().over(Window.orderBy(F.desc("o_orderpriority"))).alias("id"), F.col("o_orderpriority").alias("name"))
    return lookups.extend_dim(orders, "o_orderpriority", old)


_PRIORITIES = "(SELECT row_number() OVER (ORDER BY name)::INTEGER AS id, name FROM (SELECT DISTINCT o_orderpriority AS name FROM orders))"


@query(f"SELECT o.o_orderkey, p.id AS priority_id FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE {_MIXED} END AS name FROM orders) o LEFT JOIN {_PRIORITIES} p ON lower(rtrim(o.name)) = lower(rtrim(p.name))")
def dim_resolve_ci(spark, d):
    orders = _mixed_case(table(spark, d, "orders"))
    dim = lookups.build_dim(orders, "o_orderpriority")
    named = orders.select("o_orderkey", F.when(F.col("o_orderkey") % 13 != 0, F.col("name")).alias("name"))
    return lookups.stamp_ids(named, [(F.col("name"), dim, "priority_id")]).select("o_orderkey", "priority_id")


def _four_way(spark, d, how):
    orders, customer, nation = table(spark, d, "orders"), table(spark, d, "customer"), table(spark, d, "nation")
    fact = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))  # nation has 25 rows at any scale
    fact = fact.select("o_orderkey", F.when(F.col("o_orderkey") % 13 != 0, F.col("o_orderpriority")).alias("priority"), "o_orderstatus", "c_mktsegment", "n_name")
    dims = [
        (F.col("priority"), lookups.build_dim(orders, "o_orderpriority"), "priority_id"),
        (F.col("o_orderstatus"), lookups.build_dim(orders, "o_orderstatus"), "status_id"),
        (F.col("c_mktsegment"), lookups.build_dim(customer, "c_mktsegment"), "segment_id"),
        (F.col("n_name"), lookups.build_dim(nation, "n_name"), "nation_id"),
    ]
    return lookups.stamp_ids(fact, dims, how).select("o_orderkey", "priority_id", "status_id", "segment_id", "nation_id")


def _four_way_sql(join):
    dim = lambda t, c: f"(SELECT row_number() OVER (ORDER BY name)::INTEGER AS id, name FROM (SELECT DISTINCT {c} AS name FROM {t}))"
    return f"""SELECT f.o_orderkey, p.id AS priority_id, s.id AS status_id, m.id AS segment_id, n.id AS nation_id
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 13 <> 0 THEN o_orderpriority END AS priority, o_orderstatus, c_mktsegment, n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey) f
{join} {dim("orders", "o_orderpriority")} p ON f.priority = p.name {join} {dim("orders", "o_orderstatus")} s ON f.o_orderstatus = s.name
{join} {dim("customer", "c_mktsegment")} m ON f.c_mktsegment = m.name {join} {dim("nation", "n_name")} n ON f.n_name = n.name"""


@query(_four_way_sql("LEFT JOIN"))
def stamp_ids_4way(spark, d):
    return _four_way(spark, d, "left")


@query(_four_way_sql("JOIN"))
def stamp_ids_inner(spark, d):
    return _four_way(spark, d, "inner")


# Verification


@query("""SELECT 'orphan customer' AS "check", count(*) AS n FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 50 <> 0) c ON o_custkey = c_custkey WHERE c_custkey IS NULL
UNION ALL SELECT 'orphan nation', count(*) FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey <> 7) n ON c_nationkey = n_nationkey WHERE n_nationkey IS NULL
UNION ALL SELECT 'orphan order', count(*) FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey WHERE o_orderkey IS NULL
UNION ALL SELECT 'unmapped priority', count(*) FROM orders WHERE o_orderkey % 13 = 0""")
def orphan_checks(spark, d):
    orders, customer, nation, lineitem = (table(spark, d, t) for t in ("orders", "customer", "nation", "lineitem"))
    parts = [
        verify.labelled_count(verify.orphans(orders, customer.where("c_custkey % 50 != 0"), "o_custkey", "c_custkey"), "orphan customer"),
        verify.labelled_count(verify.orphans(customer, nation.where("n_nationkey != 7"), "c_nationkey", "n_nationkey"), "orphan nation"),
        verify.labelled_count(verify.orphans(lineitem, orders, "l_orderkey", "o_orderkey"), "orphan order"),
        verify.labelled_count(orders.where("o_orderkey % 13 = 0"), "unmapped priority"),
    ]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


@query(f"""SELECT sum(CASE WHEN o_orderpriority IS NOT NULL AND id IS NULL THEN 1 ELSE 0 END)::BIGINT AS unmapped, sum(CASE WHEN id IS NULL THEN 1 ELSE 0 END)::BIGINT AS without_id, count(*) AS n
FROM orders LEFT JOIN (SELECT * FROM {_PRIORITIES} WHERE id <> 2) p ON o_orderpriority = p.name""")
def unmapped_checks(spark, d):
    orders = table(spark, d, "orders")
    dim = lookups.build_dim(orders, "o_orderpriority").where("id != 2")
    stamped = lookups.stamp_ids(orders, [(F.col("o_orderpriority"), dim, "id")])
    return stamped.agg(expr.count_where(F.col("o_orderpriority").isNotNull() & F.col("id").isNull()).alias("unmapped"), expr.count_where(F.col("id").isNull()).alias("without_id"), F.count("*").alias("n"))


@query(f"SELECT o_orderkey, {_MIXED} AS name, p.name AS dim_name FROM orders JOIN {_PRIORITIES} p ON o_orderpriority = p.name WHERE {_MIXED} <> p.name")
def byte_mismatch(spark, d):
    orders = _mixed_case(table(spark, d, "orders"))
    dim = lookups.build_dim(orders, "o_orderpriority")
    stamped = lookups.stamp_ids(orders, [(F.col("name"), dim, "id")])
    return verify.byte_mismatches(stamped, dim, "name", "id").select("o_orderkey", "name", F.col("td_name").alias("dim_name"))


@query("""SELECT count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_keys, sum((o_orderdate IS NULL)::INT)::BIGINT AS no_created, sum((l_shipdate IS NULL)::INT)::BIGINT AS no_closed,
sum((strftime(o_orderdate, '%H:%M:%S') = '00:00:00')::INT)::BIGINT AS at_midnight, min(o_orderdate) AS first_created, max(o_orderdate) AS last_created, sum((l_shipdate < o_orderdate)::INT)::BIGINT AS closed_before_created
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def post_load_profile(spark, d):
    fact = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return verify.load_profile(fact, "l_orderkey", "o_orderdate", "l_shipdate")


@query("""SELECT * FROM (SELECT 'o_orderkey' AS "column", count(o_orderkey) AS n, round(100.0::DOUBLE * count(o_orderkey) / count(*), 1) AS percent FROM orders
UNION ALL SELECT 'priority', count(CASE WHEN o_orderkey % 13 <> 0 THEN o_orderpriority END), round(100.0::DOUBLE * count(CASE WHEN o_orderkey % 13 <> 0 THEN o_orderpriority END) / count(*), 1) FROM orders)""")
def nonnull_share(spark, d):
    return verify.nonnull_share(table(spark, d, "orders").select("o_orderkey", F.expr("CASE WHEN o_orderkey % 13 != 0 THEN o_orderpriority END AS priority")))


@query("SELECT count(*) AS rows, count(CASE WHEN o_orderkey % 13 <> 0 THEN o_orderdate END) AS dated, 0::BIGINT AS keyless FROM orders")
def batch_sanity(spark, d):
    batch = table(spark, d, "orders").select("o_orderkey", F.expr("CASE WHEN o_orderkey % 13 != 0 THEN o_orderdate END AS created"))
    m = guards.batch_sanity(batch, "o_orderkey", "created")
    return spark.createDataFrame([(m["rows"], m["dated"], m["keyless"])], "rows long, dated long, keyless long")


# Scalar functions


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderdate + to_hours((o_orderkey % 24)::INT) + to_minutes((o_orderkey % 60)::INT) END AS at FROM orders""")
def parse_csv_date(spark, d):
    at = F.expr("o_orderdate + make_dt_interval(0, o_orderkey % 24, o_orderkey % 60, 0)")
    text = F.when(F.col("o_orderkey") % 13 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), F.date_format(at, "MM/dd/yyyy hh:mm:ss a")))
    return table(spark, d, "orders").select("o_orderkey", expr.parse_csv_date(text).alias("at"))


@query("""SELECT event_id, CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 17 = 0 THEN date_trunc('day', ts) ELSE date_trunc('milliseconds', ts) END AS at FROM events""")
def parse_iso(spark, d):
    text = F.when(F.col("event_id") % 13 == 0, F.lit("")).when(F.col("event_id") % 17 == 0, F.date_format("ts", "yyyy-MM-dd")).otherwise(F.concat(expr.ms_stamp(F.col("ts")), F.expr("repeat('Z', cast(event_id % 2 AS int))")))
    return table(spark, d, "events").select("event_id", expr.parse_iso(text).alias("at"))


@query("""SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 7 = 0 THEN NULL ELSE value END AS x, CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_id END AS i FROM events""")
def lenient_number(spark, d):
    text = F.expr("CASE WHEN event_id % 5 = 0 THEN 'n/k' WHEN event_id % 7 = 0 THEN '' ELSE cast(value AS string) END")
    whole = F.expr("CASE WHEN event_id % 5 = 0 THEN '12x' ELSE concat(' ', cast(event_id AS string)) END")
    return table(spark, d, "events").select("event_id", expr.lenient_double(text).alias("x"), expr.lenient_integer(whole).alias("i"))


@query("SELECT event_id, CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN ' ' WHEN 3 THEN NULL ELSE event_type END AS t FROM events")
def null_tokens(spark, d):
    text = F.expr("CASE event_id % 5 WHEN 0 THEN 'N/A' WHEN 1 THEN '' WHEN 2 THEN ' ' WHEN 3 THEN 'null' ELSE event_type END")
    return table(spark, d, "events").select("event_id", expr.null_tokens(text).alias("t"))


@query("SELECT doc_id, left(text, 50) AS clipped FROM documents")
def clip_text(spark, d):
    return table(spark, d, "documents").select("doc_id", expr.clip(F.col("text"), 50).alias("clipped"))


@query("""SELECT event_id, CASE WHEN event_id % 4 IN (1, 2) THEN 'POINT (' || (event_id % 90 + 1)::VARCHAR || '.5 ' || (event_id % 40 + 1)::VARCHAR || ')' END AS wkt FROM events""")
def geojson_to_wkt(spark, d):
    text = F.expr("""CASE event_id % 4 WHEN 0 THEN '{"type":"Point","coordinates":[]}' WHEN 3 THEN 'no object'
    ELSE concat('{"type":"Point","coordinates":[', cast(event_id % 90 + 1 AS string), '.5,', cast(event_id % 40 + 1 AS string), ']}') END""")
    return table(spark, d, "events").select("event_id", expr.geojson_to_wkt(text).alias("wkt"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') AS stamp FROM events")
def ms_stamp(spark, d):
    return table(spark, d, "events").select("event_id", expr.ms_stamp(F.col("ts")).alias("stamp"))


@query("SELECT event_id, strftime(ts, '%H:%M:%S') = '00:00:00' AS at_midnight, date_trunc('second', ts) AS second FROM events")
def midnight_and_seconds(spark, d):
    return table(spark, d, "events").select("event_id", expr.is_midnight(F.col("ts")).alias("at_midnight"), expr.to_seconds(F.col("ts")).alias("second"))


@query("""SELECT o_orderkey AS "Unique_Key", o_orderdate AS "Created_Date", NULL::TIMESTAMP AS "Closed_Date", left(o_orderpriority, 6) AS "Agency", o_orderpriority AS "Location_Type", o_totalprice AS "Latitude",
'POINT (' || (o_orderkey % 90 + 1)::VARCHAR || ' 7)' AS "Location", NULL::INTEGER AS agency_id FROM orders""")
def feed_transform(spark, d):
    from tidemark.operators.transform import feed_transform as transform

    o = table(spark, d, "orders")
    feed = o.select(
        F.col("o_orderkey").cast("string").alias("unique_key"), expr.ms_stamp(F.col("o_orderdate")).alias("created_date"), F.lit("").alias("closed_date"), F.col("o_orderpriority").alias("agency"), F.col("o_orderpriority").alias("location_type"),
        F.col("o_totalprice").cast("string").alias("latitude"), F.expr("""concat('{"coordinates":[', cast(o_orderkey % 90 + 1 AS string), ',7]}')""").alias("location"),
    )
    return transform(feed).select("Unique_Key", "Created_Date", "Closed_Date", "Agency", "Location_Type", "Latitude", "Location", "agency_id")


# Sets and predicates


@query("SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM orders s WHERE s.o_orderkey = o.o_orderkey AND s.o_orderkey % 7 = 0)")
def seen_key_exclusion(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey")
    return windows.unseen(orders, orders.where("o_orderkey % 7 = 0"), "o_orderkey")


@query("SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderstatus IS NOT NULL GROUP BY 1")
def in_list(spark, d):
    wanted = verify.named(table(spark, d, "orders"), "o_orderpriority", ("1-URGENT", "5-LOW")).where(F.col("o_orderstatus").isNotNull())
    return reconcile.count_by(wanted, "o_orderpriority")


@query("SELECT DISTINCT o_custkey AS k FROM orders WHERE o_custkey % 3 = 0 UNION SELECT c_custkey FROM customer WHERE c_custkey % 5 = 0")
def key_union(spark, d):
    return reconcile.key_union(table(spark, d, "orders").where("o_custkey % 3 = 0").select(F.col("o_custkey").alias("k")), table(spark, d, "customer").where("c_custkey % 5 = 0").select("c_custkey"))


@query("SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders")
def key_difference(spark, d):
    return reconcile.key_difference(table(spark, d, "customer").select(F.col("c_custkey").alias("k")), table(spark, d, "orders").select("o_custkey"))


# Upserts


def _batch(orders):
    """Changed rows, new rows and unchanged ones."""
    changed = orders.where("o_orderkey % 7 = 0").withColumn("o_orderstatus", F.lit("X"))
    new = orders.where("o_orderkey % 11 = 0").withColumn("o_orderkey", F.col("o_orderkey") + 10_000_000)
    return changed.union(new).union(orders.where("o_orderkey % 7 != 0 AND o_orderkey % 5 = 0"))


_BATCH = """WITH b AS (SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 7 = 0
UNION ALL SELECT o_orderkey + 10000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 11 = 0
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 5 = 0)
"""


@query(_BATCH + "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b) UNION ALL SELECT * FROM b")
def upsert(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    return merge.upsert(orders, _batch(orders), "o_orderkey")


@query(_BATCH + """SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b)
UNION ALL SELECT b.o_orderkey, b.o_orderstatus, o.o_orderpriority FROM b LEFT JOIN orders o ON b.o_orderkey = o.o_orderkey""")
def upsert_partial_columns(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return merge.upsert(orders, _batch(orders).drop("o_orderpriority"), "o_orderkey")


@query(_BATCH + """SELECT count(*) FILTER (o.o_orderkey IS NULL) AS inserted, count(*) FILTER (o.o_orderkey IS NOT NULL AND b.o_orderstatus IS DISTINCT FROM o.o_orderstatus) AS updated,
count(*) FILTER (o.o_orderkey IS NOT NULL AND b.o_orderstatus IS NOT DISTINCT FROM o.o_orderstatus) AS unchanged,
count(*) FILTER (o.o_orderkey IS NULL) + 2 * count(*) FILTER (o.o_orderkey IS NOT NULL AND b.o_orderstatus IS DISTINCT FROM o.o_orderstatus) AS affected FROM b LEFT JOIN orders o ON b.o_orderkey = o.o_orderkey""")
def upsert_affected(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    return merge.affected(orders, _batch(orders), "o_orderkey")


@query("""SELECT o_orderkey, o_orderstatus, seq FROM (SELECT o_orderkey, o_orderstatus, 1::BIGINT AS seq FROM orders UNION ALL SELECT o_orderkey, 'Y', 2 FROM orders WHERE o_orderkey % 3 = 0)
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY seq DESC) = 1""")
def last_wins_in_batch(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.lit(1).cast("long").alias("seq"))
    twice = orders.union(orders.where("o_orderkey % 3 = 0").select("o_orderkey", F.lit("Y"), F.lit(2).cast("long")))
    return merge.last_wins(twice, "o_orderkey", "seq")


# Increments


@query("SELECT max(ts) AS watermark, max(ts) - INTERVAL 1 HOUR AS start, greatest(max(ts), TIMESTAMP '2024-06-01') AS running FROM events")
def next_watermark(spark, d):
    return windows.marks(table(spark, d, "events"), "ts", timedelta(hours=1), datetime(2024, 6, 1))


@query("SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-28 12:00:00' - INTERVAL 1 HOUR")
def incremental_slice(spark, d):
    return windows.since(table(spark, d, "events"), "ts", datetime(2024, 1, 28, 12), timedelta(hours=1)).select("event_id", "ts")


@query("SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-10' ORDER BY ts, event_id LIMIT 100")
def keyset_page(spark, d):
    return windows.keyset_page(table(spark, d, "events").select("event_id", "ts"), "ts", "event_id", "2024-01-10", False, 100)


_PAGE = "(SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' ORDER BY o_orderdate, o_orderkey LIMIT 100)"


@query(f"SELECT o_orderkey FROM {_PAGE} WHERE o_orderdate = (SELECT max(o_orderdate) FROM {_PAGE})")
def boundary_keys(spark, d):
    page = windows.keyset_page(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", "o_orderkey", "1996-01-01", True, 100)
    return windows.boundary_keys(page, "o_orderdate", "o_orderkey")


@query("SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS moment, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) >= 15")
def tie_groups(spark, d):
    tied = table(spark, d, "orders").select(F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("moment"))
    return windows.tie_groups(tied, "moment", 15)


@query("SELECT o_orderkey FROM orders WHERE date_trunc('month', o_orderdate) = TIMESTAMP '1996-05-01' AND o_orderdate >= TIMESTAMP '1996-05-04' AND o_orderdate < TIMESTAMP '1996-05-20' AND o_orderkey % 7 <> 0")
def tie_drain(spark, d):
    orders = table(spark, d, "orders").withColumn("moment", F.date_trunc("month", "o_orderdate").cast("timestamp_ntz"))
    pinned = windows.pinned(orders, "moment", datetime(1996, 5, 1), "o_orderdate", datetime(1996, 5, 4), datetime(1996, 5, 20))
    return windows.unseen(pinned, orders.where("o_orderkey % 7 = 0"), "o_orderkey").select("o_orderkey")


@query("SELECT x AS lo, least(x + INTERVAL 7 DAY, TIMESTAMP '1996-03-10') AS hi FROM range(TIMESTAMP '1996-01-01', TIMESTAMP '1996-03-10', INTERVAL 7 DAY) AS t(x)")
def window_tiles(spark, d):
    return windows.tiles_df(spark, "1996-01-01", "1996-03-10", "7 day")


@query("""SELECT t.x AS lo, least(t.x + INTERVAL 1 DAY, TIMESTAMP '1997-01-01') AS hi, count(o_orderkey) AS n FROM range(TIMESTAMP '1996-01-01', TIMESTAMP '1997-01-01', INTERVAL 1 DAY) AS t(x)
LEFT JOIN orders ON o_orderdate >= t.x AND o_orderdate < t.x + INTERVAL 1 DAY GROUP BY 1, 2""")
def window_counts(spark, d):
    return windows.count_by_tile(table(spark, d, "orders"), "o_orderdate", "1996-01-01", "1997-01-01", 1)


@query("SELECT count(*) AS n, true AS whole FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'")
def window_bisect(spark, d):
    orders = table(spark, d, "orders")
    inside = lambda lo, hi: orders.where((F.col("o_orderdate") >= F.lit(lo)) & (F.col("o_orderdate") < F.lit(hi)))
    lo, hi = datetime(1996, 1, 1), datetime(1997, 1, 1)
    size = max(50, inside(lo, hi).count() // 3)
    parts = windows.bisect(lambda a, b: inside(a, b).count(), lo, hi, size)
    whole = parts[0][0] == lo and parts[-1][1] == hi and all(a[1] == b[0] for a, b in zip(parts, parts[1:], strict=False))
    out = inside(*parts[0])
    for p in parts[1:]:
        out = out.union(inside(*p))
    return out.agg(F.count("*").alias("n"), F.lit(whole).alias("whole"))


@query("""WITH t AS (SELECT x AS lo, least(x + INTERVAL 7 DAY, TIMESTAMP '1996-03-10') AS hi FROM range(TIMESTAMP '1996-01-01', TIMESTAMP '1996-03-10', INTERVAL 7 DAY) AS t(x))
SELECT lo, hi FROM t WHERE NOT (dayofyear(lo) % 2 = 0)""")
def sweep_resume(spark, d):
    tiles = windows.tiles_df(spark, "1996-01-01", "1996-03-10", "7 day")
    return windows.pending(tiles, tiles.where("dayofyear(lo) % 2 = 0"))


@query("SELECT date_trunc('milliseconds', max(ts)) AS newest FROM events WHERE event_id % 5 < 3")
def newest_probe(spark, d):
    """Probes answered by replicas that lag: the newest answer wins."""
    answers = [r["t"] for r in table(spark, d, "events").where("event_id % 5 < 3").groupBy(F.col("event_id") % 5).agg(F.max("ts").alias("t")).collect()]  # three rows
    return spark.createDataFrame([(feed.newest_change(StaleFeed(answers), 5),)], "newest timestamp_ntz")


# The engine end to end: feed reader, loads and store over the orders table as a feed


def _store(spark) -> SnapshotStore:
    return SnapshotStore(spark, f"{shared_dir(spark)}/store")


#: Orders as fact rows, twenty years on: a year's rows share one change stamp.
_FACT = """SELECT o_orderkey AS "Unique_Key", o_orderdate + INTERVAL 20 YEAR AS "Created_Date", left(o_orderpriority, 6) AS "Agency", o_orderpriority AS "Location_Type", o_orderstatus AS "Status", o_totalprice AS "Latitude",
(dense_rank() OVER (ORDER BY o_orderpriority))::INTEGER AS lt_id FROM orders"""
_SHOWN = ("Unique_Key", "Created_Date", "Agency", "Location_Type", "Status", "Latitude", "lt_id")


def _order_feed(spark, d, where: str = "true", changed: str = "date_trunc('year', created)", status: str = "o_orderstatus") -> StagedFeed:
    """The orders as a feed, of which the driver's memory holds a few blocks."""
    rows = table(spark, d, "orders").where(where).withColumn("created", F.expr("o_orderdate + INTERVAL 20 YEAR"))
    return StagedFeed(rows.selectExpr("cast(o_orderkey AS string) AS key", "created", f"cast({changed} AS timestamp_ntz) AS changed", "o_orderpriority AS agency", "o_orderpriority AS location_type", f"{status} AS status", "cast(o_totalprice AS string) AS latitude"))


_LOAD = {"probes": 1, "sleep": lambda s: None}


@query(_FACT)
def feed_load(spark, d):
    """Keyset pages, a drain of three years' rows of one stamp by windows of creation time, dimensions, merge, publish."""
    store, client = _store(spark), _order_feed(spark, d, changed="greatest(created, TIMESTAMP_NTZ '2018-01-01')")
    load.incremental(store, client, default_since=datetime(2010, 1, 1), page_size=4000, **_LOAD)
    return store.fact().select(*_SHOWN)


@query(_FACT.replace('o_orderstatus AS "Status"', """CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS "Status\""""))
def feed_load_changes(spark, d):
    """A load, then one of what changed since: two thirds are there already, a seventh is edited."""
    store = _store(spark)
    load.incremental(store, _order_feed(spark, d, "o_orderkey % 3 != 0"), default_since=datetime(2010, 1, 1), **_LOAD)
    edited = _order_feed(spark, d, changed="CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 3 = 0 THEN TIMESTAMP '2030-01-01' + make_dt_interval(0, 0, 0, o_orderkey) ELSE date_trunc('year', created) END", status="CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END")
    load.incremental(store, edited, **_LOAD)
    return store.fact().select(*_SHOWN)


@query("SELECT strftime(max(date_trunc('year', o_orderdate + INTERVAL 20 YEAR)), '%Y-%m-%dT%H:%M:%S.000') AS watermark, count(*) AS rows_total, 0::BIGINT AS windows FROM orders")
def load_state(spark, d):
    """The published mark and counts after a load."""
    store = _store(spark)
    load.incremental(store, _order_feed(spark, d), default_since=datetime(2010, 1, 1), **_LOAD)
    return store.state().select("watermark", "rows_total", "windows")


_SWEPT = "range(TIMESTAMP '2016-01-01', TIMESTAMP '2016-04-01', INTERVAL 40 DAY)"


@query(f"""SELECT t.x AS lo, least(t.x + INTERVAL 40 DAY, TIMESTAMP '2016-04-01') AS hi, count(o_orderkey) AS "rows" FROM {_SWEPT} AS t(x)
LEFT JOIN orders ON o_orderdate + INTERVAL 20 YEAR >= t.x AND o_orderdate + INTERVAL 20 YEAR < least(t.x + INTERVAL 40 DAY, TIMESTAMP '2016-04-01') GROUP BY 1, 2""")
def sweep_ledger(spark, d):
    """A sweep that is broken off and taken up again: the ledger has each window once."""
    store, client = _store(spark), _order_feed(spark, d)
    load.sweep(store, client, datetime(2016, 1, 1), datetime(2016, 2, 10), timedelta(days=40), 100)
    load.sweep(store, client, datetime(2016, 1, 1), datetime(2016, 4, 1), timedelta(days=40), 100)
    return store.ledger()


@query(_FACT.replace(" FROM orders", " FROM orders WHERE o_orderdate + INTERVAL 20 YEAR >= TIMESTAMP '2016-01-01' AND o_orderdate + INTERVAL 20 YEAR < TIMESTAMP '2016-04-01'").replace("(dense_rank() OVER (ORDER BY o_orderpriority))::INTEGER AS lt_id", "o_orderkey % 7 AS nth").replace('o_totalprice AS "Latitude",', 'o_totalprice AS "Latitude",'))
def sweep_rows(spark, d):
    store = _store(spark)
    load.sweep(store, _order_feed(spark, d), datetime(2016, 1, 1), datetime(2016, 4, 1), timedelta(days=60), 100)
    return store.fact().select(*_SHOWN[:-1], (F.col("Unique_Key") % 7).alias("nth"))


_FAKE = """SELECT 100000 + i AS "Unique_Key", TIMESTAMP '2026-08-01' + to_minutes(10 * i::INT) AS "Created_Date", 'Agency ' || ((100000 + i) % 5)::VARCHAR AS "Agency_Name", CASE (100000 + i) % 3 WHEN 0 THEN 'Street' WHEN 1 THEN 'STREET' END AS "Location_Type",
CASE WHEN (100000 + i) % 3 < 2 THEN 1 END::INTEGER AS lt_id, 'POINT (-73.9 40.7)' AS "Location" FROM range({n}) AS t(i)"""
_FAKE_SHOWN = ("Unique_Key", "Created_Date", "Agency_Name", "Location_Type", "lt_id", "Location")


@query(_FAKE.format(n=700))
def parallel_sweep(spark, d):
    """Windows asked from where their tasks run; a full answer is halved there."""
    store = _store(spark)
    options = {"client": "tidemark.sources.fake:from_options", "rows": "700", "spread": "600", "page_size": "60"}
    load.sweep_parallel(store, options, datetime(2026, 8, 1), datetime(2026, 8, 10))
    return store.fact().select(*_FAKE_SHOWN)


@query(_FAKE.format(n=130))
def change_stream(spark, d):
    """The change feed as a stream into the store."""
    from tidemark.streaming.changes import read_changes, write_changes

    store = _store(spark)
    stream = read_changes(spark, {"client": "tidemark.sources.fake:from_options", "rows": "130", "spread": "600", "since": "2026-07-01", "page_size": "50"})
    running = write_changes(stream, store, f"{store.path}-checkpoint", processingTime="200 milliseconds")
    try:
        for _ in range(120):
            running.awaitTermination(1)
            if store.manifest().rows_total >= 130:
                break
    finally:
        running.stop()
    return store.fact().select(*_FAKE_SHOWN)


@query("SELECT i::VARCHAR AS unique_key, strftime(TIMESTAMP '2026-08-01' + to_minutes(10 * (i - 100000)::INT), '%Y-%m-%dT%H:%M:%S.000') AS created_date FROM range(100000, 100500) AS t(i)")
def feed_pages(spark, d):
    """The feed as a Spark data source, a partition for each window."""
    from tidemark.sources.spark_feed import register

    register(spark)
    options = {"client": "tidemark.sources.fake:from_options", "rows": "500", "spread": "600", "page_size": "70", "from": "2026-08-01", "to": "2026-08-06", "undated": "true"}
    return spark.read.format("tidemark_feed").options(**options).load().select("unique_key", "created_date")


def _order_facts(spark, d):
    o = table(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("Unique_Key"), F.expr("o_orderdate + INTERVAL 20 YEAR").alias("Created_Date"), F.left("o_orderpriority", F.lit(6)).alias("Agency"), F.col("o_orderpriority").alias("Location_Type"), F.col("o_orderstatus").alias("Status"), F.col("o_totalprice").alias("Latitude"))


@query(_FACT)
def csv_import(spark, d):
    """An export read back by its headers: dates, missing-value texts, dimensions, append and publish."""
    path, facts = f"{shared_dir(spark)}/csv", _order_facts(spark, d)
    headers = {"Unique_Key": "Unique Key", "Created_Date": "Created Date", "Location_Type": "Location Type"}
    facts.withColumn("Created_Date", F.date_format("Created_Date", "MM/dd/yyyy hh:mm:ss a")).withColumn("Borough", F.lit("N/A")).withColumnsRenamed(headers).write.option("header", True).option("ignoreTrailingWhiteSpace", False).csv(path)
    store = _store(spark)
    load.import_csv(store, path)
    return store.fact().where("Borough IS NULL").select(*_SHOWN)


@query("""SELECT "Unique_Key", "Created_Date", "Location_Type", CASE WHEN "Unique_Key" % 5 = 0 THEN 'X' ELSE "Status" END AS "Status" FROM (""" + _FACT + """) f
UNION ALL SELECT "Unique_Key" + 10000000, "Created_Date", "Location_Type", 'X' FROM (""" + _FACT + """) f WHERE "Unique_Key" % 50 = 0""")
def store_upsert(spark, d):
    """Append in two commits, then an upsert of partial rows: absent columns keep their values."""
    store, facts = _store(spark), _order_facts(spark, d)
    for part in ("Unique_Key % 2 = 0", "Unique_Key % 2 = 1"):
        m = store.manifest()
        store.append(m, facts.where(part))
        store.publish(m)
    few = facts.where("Unique_Key % 5 = 0").select("Unique_Key", "Created_Date", "Location_Type", F.lit("X").alias("Status"))
    m = store.manifest()
    store.upsert(m, few.union(few.where("Unique_Key % 50 = 0").withColumn("Unique_Key", F.col("Unique_Key") + 10_000_000)).cache())
    store.publish(m)
    return store.fact().select("Unique_Key", "Created_Date", "Location_Type", "Status")


@query(_FACT.replace(" FROM orders", " FROM orders WHERE strftime(o_orderdate, '%Y-%m') IN ('1996-05', '1997-02')").replace("(dense_rank() OVER (ORDER BY o_orderpriority))::INTEGER AS lt_id", "CASE WHEN o_orderkey % 11 = 0 THEN 'Y' ELSE 'N' END AS edited").replace('o_orderstatus AS "Status"', """CASE WHEN o_orderkey % 11 = 0 THEN 'Y' ELSE o_orderstatus END AS "Status\""""))
def store_months(spark, d):
    """Two months of a store with a layer over its base, before and after compaction."""
    store, facts = _store(spark), _order_facts(spark, d)
    m = store.manifest()
    store.append(m, facts)
    store.upsert(m, facts.where("Unique_Key % 11 = 0").withColumn("Status", F.lit("Y")).cache())
    store.publish(m)
    months = ["2016-05", "2017-02"]
    shown = lambda: store.fact(months=months).select(*_SHOWN[:-1], F.when(F.col("Unique_Key") % 11 == 0, "Y").otherwise("N").alias("edited"))
    before = shown()
    store.compact(m)
    store.publish(m)
    return before.intersectAll(shown())


@query("""SELECT * FROM (VALUES ('orphan agency_id', 0::BIGINT), ('orphan cb_id', 0), ('orphan lt_id', 0), ('orphan at_id', 0), ('unmapped agency_id', 0), ('unmapped cb_id', 0), ('unmapped at_id', 0)) AS t("check", n)
UNION ALL SELECT 'unmapped lt_id', count(*) FROM orders WHERE o_orderkey % 13 = 0 AND o_orderkey % 17 <> 0
UNION ALL SELECT 'null Created_Date', count(*) FROM orders WHERE o_orderkey % 19 = 0""")
def orphan_checks_of_the_store(spark, d):
    """All nine checks in one pass over stamped rows, some ids of which were lost."""
    facts = _order_facts(spark, d).withColumn("Created_Date", F.expr("CASE WHEN Unique_Key % 19 != 0 THEN Created_Date END")).withColumn("Location_Type", F.expr("CASE WHEN Unique_Key % 17 != 0 THEN Location_Type END"))
    stamped, dims = load.extend_and_stamp(store := _store(spark), store.manifest(), facts)
    return verify.orphan_checks(stamped.withColumn("lt_id", F.expr("CASE WHEN Unique_Key % 13 != 0 THEN lt_id END")), dims)


@query("""SELECT * FROM (SELECT 'orphan lt_id' AS "check", count(*) AS n FROM orders WHERE o_orderpriority = '3-MEDIUM')""")
def orphan_ids(spark, d):
    """Ids whose dimension row is gone."""
    stamped, dims = load.extend_and_stamp(store := _store(spark), store.manifest(), _order_facts(spark, d))
    dims["location_types"] = dims["location_types"].where("name != '3-MEDIUM'")
    return verify.orphan_checks(stamped, dims).where("`check` = 'orphan lt_id'")


@query("SELECT false AS passes, true AS says_keys, true AS says_dates")
def refusals(spark, d):
    """What a commit refuses: repeated keys; a batch in which no row has a date."""
    facts = _order_facts(spark, d)
    said = []
    for bad in (lambda: guards.primary_key(facts.union(facts.where("Unique_Key % 100 = 0"))), lambda: guards.batch_sanity(facts.withColumn("Created_Date", F.lit(None).cast("timestamp_ntz")))):
        try:
            bad()
            said.append("")
        except EngineError as e:
            said.append(str(e))
    return spark.createDataFrame([(not all(said), "distinct keys" in said[0], "Created_Date" in said[1])], "passes boolean, says_keys boolean, says_dates boolean")


@query(_SIDES + """, rows AS (SELECT 3 + row_number() OVER (ORDER BY period) AS nth, rpad(period, 12, ' ') || lpad(printf('%,d', source), 12, ' ') || lpad(printf('%,d', ours), 12, ' ') || lpad(CASE WHEN difference > 0 THEN '-' ELSE '+' END || printf('%,d', abs(difference)), 10, ' ') || CASE WHEN difference > 0 THEN '  <- DB short' WHEN difference < 0 THEN '  <- DB extra' ELSE '' END AS line FROM c)
SELECT 1::BIGINT AS nth, 'by month' AS line UNION ALL SELECT 2, 'period               API          DB      diff' UNION ALL SELECT 3, repeat('-', 46) UNION ALL SELECT nth, line FROM rows UNION ALL SELECT 4 + count(*), repeat('-', 46) FROM rows
UNION ALL SELECT 5 + count(*), rpad('total', 12, ' ') || lpad(printf('%,d', sum(source)::BIGINT), 12, ' ') || lpad(printf('%,d', sum(ours)::BIGINT), 12, ' ') || lpad(CASE WHEN sum(ours) < sum(source) THEN '-' ELSE '+' END || printf('%,d', abs(sum(ours) - sum(source))::BIGINT), 10, ' ') FROM c""")
def reconcile_report(spark, d):
    lines = reconcile.report("by month", _compared(spark, d)).split("\n")
    return spark.createDataFrame(list(enumerate(lines, 1)), "nth long, line string")


@query("SELECT o_orderkey, (o_orderkey % 30000)::SMALLINT AS small, o_totalprice::FLOAT::DOUBLE = o_totalprice AS exact FROM orders")
def retype(spark, d):
    from tidemark.operators.transform import retype as narrowed

    orders = table(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % 30000).alias("small"), (F.col("o_totalprice").cast("float").cast("double") == F.col("o_totalprice")).alias("exact"))
    return narrowed(orders, {"small": "smallint"})


@query(_FACT.replace(" FROM orders", " FROM orders WHERE o_orderkey % 2 = 0").replace("(dense_rank() OVER (ORDER BY o_orderpriority))::INTEGER AS lt_id", "1::BIGINT AS months_apart"))
def truncate_load(spark, d):
    """An export that replaces what was there."""
    store, facts, path = _store(spark), _order_facts(spark, d), f"{shared_dir(spark)}/csv"
    m = store.manifest()
    store.append(m, facts.where("Unique_Key % 3 = 0"))
    store.publish(m)
    headers = {"Unique_Key": "Unique Key", "Created_Date": "Created Date", "Location_Type": "Location Type"}
    facts.where("Unique_Key % 2 = 0").withColumn("Created_Date", F.date_format("Created_Date", "MM/dd/yyyy hh:mm:ss a")).withColumnsRenamed(headers).write.option("header", True).option("ignoreTrailingWhiteSpace", False).csv(path)
    load.import_csv(store, path, truncate=True)
    return store.fact().select(*_SHOWN[:-1], F.lit(1).cast("long").alias("months_apart"))


@query("SELECT count(*) AS \"rows\", 0::BIGINT AS commits, 0::BIGINT AS stored, 0::BIGINT AS versions FROM orders")
def dry_run(spark, d):
    """A dry run reads and checks everything and writes nothing."""
    store = _store(spark)
    got = load.incremental(store, _order_feed(spark, d), default_since=datetime(2010, 1, 1), dry_run=True, **_LOAD)
    return spark.createDataFrame([(got["rows"], got["commits"], store.fact().count(), store.manifest().version)], "`rows` long, commits long, stored long, versions long")


_STAMP = "TIMESTAMP '2020-01-01' + to_seconds(o_orderkey // 40 * 3600)"


@query(f"""WITH s AS (SELECT {_STAMP} AS t FROM orders), top AS (SELECT max(t) AS t FROM s)
SELECT (SELECT count(*) FROM s, top WHERE s.t > top.t - INTERVAL 3 HOUR) AS "rows", 0::BIGINT AS affected, strftime((SELECT t FROM top), '%Y-%m-%dT%H:%M:%S.000') AS watermark""")
def overlap_reread(spark, d):
    """The second load starts at the mark less the overlap: those rows come again and change nothing."""
    store, client = _store(spark), _order_feed(spark, d, changed="TIMESTAMP_NTZ '2020-01-01' + make_dt_interval(0, cast(o_orderkey div 40 AS int), 0, 0)")
    load.incremental(store, client, default_since=datetime(2010, 1, 1), **_LOAD)
    got = load.incremental(store, client, overlap=timedelta(hours=3), **_LOAD)
    return spark.createDataFrame([(got["rows"], got["affected"], got["watermark"])], "`rows` long, affected long, watermark string")


@query("SELECT true AS headers, true AS dates, true AS empty_feed, true AS lagging_end, true AS gutted_group, true AS full_second, true AS no_stamp, true AS missing_rows")
def feed_refusals(spark, d):
    """What the readers refuse, one column each."""
    from tidemark.operators.transform import require_columns

    orders = table(spark, d, "orders")
    tied = _order_feed(spark, d, changed="TIMESTAMP_NTZ '2020-01-01'")
    fetch = tied.fetch
    gutted = TableFeed([])
    gutted.fetch = lambda r: fetch(r)[:5] if r.changed_at else fetch(r)
    lagging = TableFeed([])
    lagging.fetch = lambda r: fetch(r) if r.newest_first else []
    second = TableFeed([(str(i), datetime(2020, 1, 1), datetime(2020, 1, 1), {}) for i in range(20)])
    read = lambda client, size: list(feed.changes(client, datetime(2010, 1, 1), size, **_LOAD))
    tries = (
        lambda: require_columns(orders), lambda: guards.dates_parse(orders.select(F.col("o_orderpriority").alias("Closed Date"))), lambda: read(TableFeed([]), 100), lambda: read(lagging, 100),
        lambda: read(gutted, 100), lambda: list(feed.window_rows(second, datetime(2020, 1, 1), datetime(2020, 1, 2), 10)), lambda: feed.newest([{"unique_key": "1"}]), lambda: guards.shortfall(orders.count()),
    )
    said = []
    for f in tries:
        try:
            f()
            said.append(False)
        except EngineError:
            said.append(True)
    return spark.createDataFrame([tuple(said)], "headers boolean, dates boolean, empty_feed boolean, lagging_end boolean, gutted_group boolean, full_second boolean, no_stamp boolean, missing_rows boolean")


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS x FROM events")
def nan_is_null(spark, d):
    text = F.expr("CASE WHEN event_id % 3 = 0 THEN 'NaN' ELSE cast(value AS string) END")
    return table(spark, d, "events").select("event_id", expr.lenient_double(text).alias("x"))


@query("SELECT o_orderkey AS \"Unique_Key\", o_orderdate AS \"Created_Date\", o_orderstatus AS \"Status\" FROM orders")
def mapped_columns_only(spark, d):
    """Headers with blanks and quotes around them; a column that the fact has not is left out."""
    from tidemark.operators.transform import csv_transform

    o = table(spark, d, "orders")
    return csv_transform(o.select(F.col("o_orderkey").cast("string").alias(' "Unique Key" '), F.date_format("o_orderdate", "MM/dd/yyyy hh:mm:ss a").alias("Created Date "), F.col("o_orderstatus").alias("Status"), F.lit("x").alias("Unknown")))


@query("SELECT 'Unique_Key' AS \"column\", count(*) AS \"rows\", 0::BIGINT AS nulls, min(o_orderkey)::VARCHAR AS least, max(o_orderkey)::VARCHAR AS greatest FROM orders UNION ALL SELECT 'lt_id', count(*), count(*), NULL, NULL FROM orders")
def store_statistics(spark, d):
    store = _store(spark)
    m = store.manifest()
    store.append(m, _order_facts(spark, d))
    got = store.analyze(m)
    return spark.createDataFrame([(c, got[c]["rows"], got[c]["nulls"], got[c]["least"], got[c]["greatest"]) for c in ("Unique_Key", "lt_id")], "column string, `rows` long, nulls long, least string, greatest string")


# Reachable as plain SQL only


def _passthrough(name, spark_sql, duck_sql=None):
    @query(duck_sql or spark_sql, f"passthrough_{name}")
    def run(spark, d):
        from tidemark.cli import register_tables

        register_tables(spark, d, ("orders", "customer", "lineitem", "nation", "events"))
        return spark.sql(spark_sql)


_passthrough("rollup", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)")
_passthrough("cube_having", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority) HAVING count(*) > 10")
_passthrough("rank", "SELECT o_orderkey, rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prior FROM orders")
_passthrough("semi", "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 1000)")
_passthrough("intersect", "SELECT o_custkey AS k FROM orders INTERSECT SELECT c_custkey FROM customer WHERE c_acctbal > 0")
_passthrough("range_join", "SELECT n.n_name, count(*) AS n FROM nation n JOIN events e ON e.value >= n.n_nationkey * 4 AND e.value < n.n_nationkey * 4 + 4 GROUP BY n.n_name")
_passthrough(
    "as_of",
    "SELECT o.o_orderkey, max_by(l.l_linenumber, struct(l.l_shipdate, l.l_linenumber)) AS line FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey AND l.l_shipdate <= o.o_orderdate + INTERVAL 60 DAY GROUP BY o.o_orderkey",
    "SELECT o.o_orderkey, arg_max(l.l_linenumber, row(l.l_shipdate, l.l_linenumber)) AS line FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey AND l.l_shipdate <= o.o_orderdate + INTERVAL 60 DAY GROUP BY o.o_orderkey",
)
_passthrough("tumbling", "SELECT window.start AS lo, count(*) AS n FROM events GROUP BY window(ts, '1 day')", "SELECT date_trunc('day', ts)::TIMESTAMP AS lo, count(*) AS n FROM events GROUP BY 1")
_passthrough("grouping_sets", "SELECT o_orderstatus, o_orderpriority, count(*) AS n, grouping(o_orderstatus) AS g FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())")
_passthrough("cross_join", "SELECT a.n_name AS a, b.n_name AS b FROM nation a CROSS JOIN nation b")
_passthrough("nested_loop", "SELECT a.n_name AS a, count(b.n_name) AS n FROM nation a LEFT JOIN nation b ON a.n_name < b.n_name OR a.n_regionkey > b.n_regionkey GROUP BY a.n_name")
_passthrough(
    "interval_join",
    "SELECT o.o_orderkey, count(*) AS n FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey AND l.l_shipdate BETWEEN o.o_orderdate AND o.o_orderdate + INTERVAL 30 DAY GROUP BY o.o_orderkey",
)
_passthrough(
    "arrays",
    "SELECT o_custkey, array_join(array_sort(collect_list(o_orderkey)), ',') AS ks, size(filter(collect_list(o_totalprice), x -> x > 1000)) AS dear, element_at(map('a', count(*)), 'a') AS n FROM orders GROUP BY o_custkey",
    "SELECT o_custkey, array_to_string(list_sort(list(o_orderkey)), ',') AS ks, len(list_filter(list(o_totalprice), lambda x: x > 1000))::INTEGER AS dear, count(*) AS n FROM orders GROUP BY o_custkey",
)
_passthrough(
    "regex",
    "SELECT c_custkey, regexp_extract(c_name, '([0-9]+)', 1) AS digits, regexp_replace(c_mktsegment, '[AEIOU]', '_') AS masked, c_name RLIKE '7$' AS seven FROM customer",
    "SELECT c_custkey, regexp_extract(c_name, '([0-9]+)', 1) AS digits, regexp_replace(c_mktsegment, '[AEIOU]', '_', 'g') AS masked, regexp_matches(c_name, '7$') AS seven FROM customer",
)
_passthrough(
    "sliding",
    "SELECT window.start AS lo, count(*) AS n FROM events GROUP BY window(ts, '2 days', '1 day')",
    "SELECT lo, count(*) AS n FROM (SELECT unnest([date_trunc('day', ts)::TIMESTAMP, date_trunc('day', ts)::TIMESTAMP - INTERVAL 1 DAY]) AS lo FROM events) GROUP BY lo",
)
_passthrough(
    "session",
    "SELECT user_id, session_window.start AS lo, session_window.end AS hi, count(*) AS n FROM events GROUP BY user_id, session_window(ts, '12 hours')",
    """WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 12 HOUR THEN 0 ELSE 1 END AS begins FROM events),
s AS (SELECT user_id, ts, sum(begins) OVER (PARTITION BY user_id ORDER BY ts) AS nth FROM e) SELECT user_id, min(ts) AS lo, max(ts) + INTERVAL 12 HOUR AS hi, count(*) AS n FROM s GROUP BY user_id, nth""",
)


def _streamed(spark, d, name, plan, mode):
    """Run a streaming plan over the events once into a table in memory and return that table."""
    events = spark.readStream.schema(table(spark, d, "events").schema).option("pathGlobFilter", "events.parquet").parquet(d)
    running = plan(events).writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", f"{shared_dir(spark)}/checkpoint").trigger(availableNow=True).start()
    running.awaitTermination()
    return spark.table(name)


@query("SELECT date_trunc('day', ts)::TIMESTAMP AS lo, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def passthrough_watermark(spark, d):
    """Event-time windows with a watermark over a stream."""
    plan = lambda e: e.withColumn("at", F.to_timestamp(F.concat(F.col("ts").cast("string"), F.lit("Z")))).withWatermark("at", "1 day").groupBy(F.window("at", "1 day"), "event_type").agg(F.count("*").alias("n"))
    return _streamed(spark, d, "passthrough_watermark", plan, "complete").select(F.convert_timezone(None, F.lit("UTC"), F.col("window.start").cast("timestamp_ntz")).alias("lo"), "event_type", "n")


@query("SELECT user_id, count(*) AS n, max(value) AS top FROM events GROUP BY user_id")
def passthrough_stateful(spark, d):
    """State of our own for each key of a stream."""
    import pandas as pd

    def step(key, batches, state):
        n, top = state.get if state.exists else (0, float("-inf"))
        for b in batches:
            n, top = n + len(b), max(top, b["value"].max())
        state.update((n, top))
        yield pd.DataFrame({"user_id": [key[0]], "n": [n], "top": [top]})

    plan = lambda e: e.select("user_id", "value").groupBy("user_id").applyInPandasWithState(step, "user_id long, n long, top double", "n long, top double", "update", "NoTimeout")
    return _streamed(spark, d, "passthrough_stateful", plan, "update").groupBy("user_id").agg(F.max("n").alias("n"), F.max("top").alias("top"))  # the last state of each
