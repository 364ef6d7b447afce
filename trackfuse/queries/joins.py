"""Joins, aggregates, weights and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from trackfuse.functions.draws import fold_of
from trackfuse.operators.averages import as_of_average, out_of_fold_join
from trackfuse.operators.enrich import (
    calendar_flag,
    id_map_left,
    inverse_count_weight,
    key_average,
    key_average_join,
    lookup_left,
    mean_of_means,
)
from trackfuse.operators.interval import DAY, interval_join
from trackfuse.operators.lookup import latest_for_key, latest_n, latest_per_key
from trackfuse.queries.domain import HALF_YEAR, HOLIDAYS_SQL, holidays
from trackfuse.queries.registry import query, table
from trackfuse.session import stage

# Customers of one nation have no key.
_LOOKUP_SQL = """SELECT c_custkey, c_name, nullif(c_nationkey, 7) AS c_nationkey, n_name AS place_name, n_regionkey AS place_region
                 FROM customer LEFT JOIN nation ON nullif(c_nationkey, 7) = n_nationkey"""


def _lookup(spark, sf, **how):
    renames = {"n_name": "place_name", "n_regionkey": "place_region"}
    key = F.nullif(F.col("c_nationkey"), F.lit(7)).alias("c_nationkey")
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", key)
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return lookup_left(customers, nations, "c_nationkey", "n_nationkey", renames, **how)


@query("j1_lookup_left", _LOOKUP_SQL)
def lookup(spark, sf):
    return _lookup(spark, sf)


@query("j1_lookup_left_salted", _LOOKUP_SQL)
def lookup_salted(spark, sf):
    return _lookup(spark, sf, max_rows=0)


# A mapping with repeated ids (several users of one kind) and orders with unknown and null ids.
_MAP_SQL = """SELECT o_orderkey, o_id, c_name, c_acctbal
              FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_id FROM orders) o
              LEFT JOIN (SELECT c_custkey AS id, c_name, c_acctbal FROM customer
                         UNION ALL SELECT nullif(c_custkey, 5), c_mktsegment, c_acctbal FROM customer) m ON o_id = id"""


def _mapped(spark, sf, **how):
    customers = table(spark, sf, "customer")
    mapping = customers.select(F.col("c_custkey").alias("o_id"), "c_name", "c_acctbal").unionAll(
        customers.select(F.nullif(F.col("c_custkey"), F.lit(5)), "c_mktsegment", "c_acctbal")
    )
    ids = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("o_id")
    return id_map_left(table(spark, sf, "orders").select("o_orderkey", ids), mapping, "o_id", **how)


@query("j2_id_map_left", _MAP_SQL)
def id_map(spark, sf):
    return _mapped(spark, sf)


@query("j2_id_map_left_salted", _MAP_SQL)
def id_map_salted(spark, sf):
    # A third of the orders have no id; pieces of a thousand rows split them at any scale.
    return _mapped(spark, sf, max_rows=0, min_rows=1000)


_INTERVAL_SQL = f"""SELECT o_orderkey, o_orderdate, l_orderkey, l_linenumber, l_shipdate
                    FROM orders JOIN lineitem ON l_orderkey = o_orderkey
                     AND l_shipdate BETWEEN o_orderdate - to_seconds({HALF_YEAR}) AND o_orderdate + to_seconds({HALF_YEAR})"""


def _interval(spark, sf, **how):
    plan = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    obs = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    on = ("o_orderkey", "l_orderkey")
    return interval_join(plan, obs, on, "o_orderdate", "l_shipdate", HALF_YEAR, HALF_YEAR, **how)


@query("j3_interval_join", _INTERVAL_SQL)
def interval(spark, sf):
    return _interval(spark, sf)


@query("j3_interval_join_salted", _INTERVAL_SQL)
def interval_salted(spark, sf):
    return _interval(spark, sf, max_broadcast_rows=0)


PAIRS_SQL = """SELECT p.event_id AS plan_event, p.ts AS plan_at, p.user_id AS plan_user,
                      c.event_id AS seen_event, c.ts AS seen_at, c.user_id AS seen_user
               FROM events p JOIN events c ON p.user_id = c.user_id
                AND c.ts BETWEEN p.ts - INTERVAL 24 HOUR AND p.ts + INTERVAL 24 HOUR
               WHERE p.event_type = 'purchase' AND c.event_type = 'click'"""


def purchases_and_clicks(events):
    """The two sides of the event pairs, from one table or stream."""

    def side(kind, prefix):
        names = {"event_id": f"{prefix}_event", "ts": f"{prefix}_at", "user_id": f"{prefix}_user"}
        return events.filter(F.col("event_type") == kind).select(*(F.col(c).alias(n) for c, n in names.items()))

    return side("purchase", "plan"), side("click", "seen")


def _pairs(spark, sf, **how):
    plan, seen = purchases_and_clicks(table(spark, sf, "events"))
    return interval_join(plan, seen, ("plan_user", "seen_user"), "plan_at", "seen_at", DAY, DAY, **how)


@query("j3_event_pairs", PAIRS_SQL)
def pairs(spark, sf):
    return _pairs(spark, sf)


@query("j3_event_pairs_salted", PAIRS_SQL)
def pairs_salted(spark, sf):
    return _pairs(spark, sf, max_broadcast_rows=0, min_rows=2)


@query(
    "j4_calendar_flag",
    f"""SELECT o_orderkey, o_orderdate, CASE WHEN h.holiday_date IS NOT NULL THEN 1 ELSE 0 END AS is_holiday
        FROM orders LEFT JOIN ({HOLIDAYS_SQL}) h ON CAST(o_orderdate AS DATE) = h.holiday_date""",
)
def holiday_flag(spark, sf):
    days = holidays(spark)
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return calendar_flag(orders, days.unionAll(days), "o_orderdate", "holiday_date", "is_holiday")


# Average by segment, of which one is filed under no name, so that its customers need the overall mean.
_SEGMENTS = """SELECT nullif(c_mktsegment, 'BUILDING') AS c_mktsegment, avg(c_acctbal) AS mean FROM customer
               GROUP BY nullif(c_mktsegment, 'BUILDING')"""


def _segment_means(spark, sf):
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("c_mktsegment")
    return key_average(table(spark, sf, "customer").select(segment, "c_acctbal"), "c_mktsegment", "c_acctbal", "mean")


@query("a1_key_average", "SELECT l_suppkey, round(avg(l_extendedprice), 4) AS mean FROM lineitem GROUP BY l_suppkey")
def averages(spark, sf):
    means = key_average(table(spark, sf, "lineitem"), "l_suppkey", "l_extendedprice", "mean")
    return means.withColumn("mean", F.round("mean", 4))


@query(
    "a1_key_average_nulls",
    """SELECT nullif(o_orderpriority, '5-LOW') AS k,
              round(avg(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END), 4) AS mean
       FROM orders GROUP BY nullif(o_orderpriority, '5-LOW')""",
)
def averages_with_nulls(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("k"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("v"),
    )
    return key_average(rows, "k", "v", "mean").withColumn("mean", F.round("mean", 4))


@query("a2_mean_of_means", f"SELECT round(avg(mean), 4) AS overall FROM ({_SEGMENTS})")
def overall(spark, sf):
    means = _segment_means(spark, sf)
    return spark.range(1).select(F.round(mean_of_means(means, "mean"), 4).alias("overall"))


_AVERAGED_SQL = f"""WITH m AS ({_SEGMENTS})
        SELECT c_custkey, c.c_mktsegment, round(coalesce(mean, (SELECT avg(mean) FROM m)), 4) AS mean
        FROM customer c LEFT JOIN m ON c.c_mktsegment = m.c_mktsegment"""


def _averaged(spark, sf, **how):
    means = stage(_segment_means(spark, sf), "segment_means")
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return key_average_join(customers, means, "c_mktsegment", "mean", **how).withColumn("mean", F.round("mean", 4))


@query("j5_key_average_join", _AVERAGED_SQL)
def average_join(spark, sf):
    return _averaged(spark, sf)


@query("j5_key_average_join_salted", _AVERAGED_SQL)
def average_join_salted(spark, sf):
    # A fifth of the customers share a segment each.
    return _averaged(spark, sf, max_rows=0, min_rows=100)


@query(
    "w2_inverse_count_weight",
    """SELECT l_orderkey, l_partkey, round(1.0 / count(*) OVER (PARTITION BY l_orderkey), 9) AS weight FROM lineitem""",
)
def weights(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    return inverse_count_weight(lines, "l_orderkey", "weight").withColumn("weight", F.round("weight", 9))


@query(
    "w2_inverse_count_weight_hot",
    """SELECT o_orderkey, nullif(o_orderstatus, 'P') AS kind,
              round(1.0 / count(*) OVER (PARTITION BY nullif(o_orderstatus, 'P')), 9) AS weight FROM orders""",
)
def weights_of_few(spark, sf):
    # Three keys hold a third of all rows each, one of them null.
    kind = F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("kind")
    orders = table(spark, sf, "orders").select("o_orderkey", kind)
    weighted = inverse_count_weight(orders, "kind", "weight", min_rows=1000, max_rows=0)
    return weighted.withColumn("weight", F.round("weight", 9))


@query(
    "t1_latest_for_key",
    "SELECT * FROM events WHERE user_id = 42 ORDER BY ts DESC, event_id DESC LIMIT 1",
)
def newest_of_one(spark, sf):
    return latest_for_key(table(spark, sf, "events"), "user_id", 42, "ts", ["event_id"])


@query(
    "t1_latest_per_key",
    """SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
       ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1""",
)
def newest_of_each(spark, sf):
    return latest_per_key(table(spark, sf, "orders"), "o_custkey", "o_orderdate", ["o_orderkey"])


@query("t2_latest_n", "SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 10")
def newest(spark, sf):
    return latest_n(table(spark, sf, "orders"), "o_orderdate", 10, ["o_orderkey"])


# Orders of the lowest priority are filed under none; pending ones have no price yet. A customer's orders are in one fold.
_FOLDS = 5
_FOLD_ROWS = f"""SELECT o_orderkey, o_custkey, nullif(o_orderpriority, '5-LOW') AS kind,
      CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price,
      (CAST('0x' || substr(md5('45|' || o_custkey), 1, 8) AS BIGINT) % {_FOLDS})::INT AS fold FROM orders"""


def _folded(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("kind"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"),
        fold_of("o_custkey", _FOLDS).alias("fold"),
    )


_OUT_OF_FOLD_SQL = f"""WITH o AS ({_FOLD_ROWS}),
    m AS (SELECT f.fold, o.kind, avg(price) AS mean FROM range({_FOLDS}) AS f(fold) JOIN o ON o.fold <> f.fold GROUP BY f.fold, o.kind),
    g AS (SELECT fold, avg(mean) AS mean FROM m GROUP BY fold)
    SELECT o_orderkey, o.fold, round(coalesce(m.mean, g.mean), 4) AS mean
    FROM o LEFT JOIN m ON m.fold = o.fold AND m.kind = o.kind LEFT JOIN g ON g.fold = o.fold"""


def _out_of_fold(spark, sf, **how):
    joined = out_of_fold_join(_folded(spark, sf), "kind", "price", "fold", _FOLDS, "mean", **how)
    return joined.select("o_orderkey", "fold", F.round("mean", 4).alias("mean"))


@query("a1_out_of_fold", _OUT_OF_FOLD_SQL)
def out_of_fold(spark, sf):
    return _out_of_fold(spark, sf)


@query("a1_out_of_fold_salted", _OUT_OF_FOLD_SQL)
def out_of_fold_salted(spark, sf):
    return _out_of_fold(spark, sf, max_rows=0, min_rows=100)


@query(
    "a1_out_of_fold_rare",
    f"""WITH o AS (SELECT *, o_custkey AS k FROM ({_FOLD_ROWS})),
        m AS (SELECT f.fold, k, avg(price) AS mean FROM range({_FOLDS}) AS f(fold) JOIN o ON o.fold <> f.fold
              WHERE price IS NOT NULL GROUP BY f.fold, k),
        g AS (SELECT fold, avg(mean) AS mean FROM m GROUP BY fold)
        SELECT o_orderkey, round(g.mean, 4) AS mean FROM o JOIN g ON g.fold = o.fold""",
)
def out_of_fold_rare(spark, sf):
    """A key that is the entity itself: other folds never know it, so every row gets the mean of their means."""
    rows = out_of_fold_join(_folded(spark, sf), "o_custkey", "price", "fold", _FOLDS, "mean")
    return rows.select("o_orderkey", F.round("mean", 4).alias("mean"))


# A delay, a whole number, so that sums are exact in any order, is known a month after the order.
_AS_OF_SQL = """WITH o AS (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS kind, o_orderdate AS ts,
        CASE WHEN o_orderstatus <> 'P' THEN o_custkey % 120 * 60 END AS delay FROM orders),
    u AS (SELECT o_orderkey, kind, ts, NULL AS v FROM o UNION ALL SELECT NULL, kind, ts + INTERVAL 30 DAY, delay FROM o WHERE delay IS NOT NULL)
    SELECT o_orderkey, kind, round(mean, 9) AS mean FROM (SELECT o_orderkey, kind, avg(v) OVER (PARTITION BY kind ORDER BY ts
      RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING) AS mean FROM u) WHERE o_orderkey IS NOT NULL"""


def _as_of(spark, sf, **how):
    rows = table(spark, sf, "orders").select(
        "o_orderkey",
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("kind"),
        F.col("o_orderdate").alias("ts"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey") % 120 * 60).alias("delay"),
    )
    known = rows.withColumn("known", F.col("ts") + F.expr("INTERVAL 30 DAYS"))
    found = as_of_average(rows, known, "kind", "delay", "ts", "known", "mean", **how)
    return found.select("o_orderkey", "kind", F.round("mean", 9).alias("mean"))


@query("a1_as_of_average", _AS_OF_SQL)
def as_of(spark, sf):
    return _as_of(spark, sf)


@query("a1_as_of_average_salted", _AS_OF_SQL)
def as_of_salted(spark, sf):
    return _as_of(spark, sf, width=30 * DAY, max_rows=0, min_rows=100)
