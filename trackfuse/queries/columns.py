"""Projections, filters and scalar features."""

from __future__ import annotations

from pyspark.sql import functions as F

from trackfuse.functions import features as feat
from trackfuse.functions.geo import bearing_deg, haversine_km
from trackfuse.operators.project import before_event, drop_derived, key_filter, project_contract, rename_drop
from trackfuse.queries.domain import POSITIONS_SQL, SCHEDULE_SQL, bearing_sql, haversine_sql, positions, schedule
from trackfuse.queries.registry import no_zone, query, table
from trackfuse.schemas import POSITIONS


@query("p2_rename_drop", "SELECT c_custkey AS id, c_nationkey AS place, c_mktsegment AS segment FROM customer")
def renamed(spark, sf):
    renames = {"c_custkey": "id", "c_nationkey": "place", "c_mktsegment": "segment"}
    return rename_drop(table(spark, sf, "customer"), renames, drop=["c_name", "c_acctbal"])


@query("p3_project_contract", f"SELECT {', '.join(POSITIONS.names)} FROM ({POSITIONS_SQL})")
def contract(spark, sf):
    shuffled = positions(table(spark, sf, "lineitem")).withColumn("extra", F.lit(1))
    return project_contract(shuffled.select(*reversed(shuffled.columns)), POSITIONS.names)


@query("p4_drop_derived", "SELECT o_orderkey, o_totalprice, o_totalprice * 2 AS prediction FROM orders")
def without_helpers(spark, sf):
    scored = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_totalprice",
        F.lit(1).alias("status_idx"),
        F.lit(2).alias("status_vec"),
        F.lit(3).alias("features"),
        (F.col("o_totalprice") * 2).alias("prediction"),
    )
    return drop_derived(scored)


_SEEN = """SELECT l_orderkey, l_shipdate, o_orderdate, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS done
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def _seen(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        "o_orderdate",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("done"),
    )
    return table(spark, sf, "lineitem").select("l_orderkey", "l_shipdate").join(orders, "l_orderkey")


@query("p5_before_event", f"SELECT * FROM ({_SEEN}) WHERE l_shipdate < done")
def strictly_before(spark, sf):
    return before_event(_seen(spark, sf), "l_shipdate", "done")


@query("p5_before_event_open", f"SELECT * FROM ({_SEEN}) WHERE l_shipdate < done OR done IS NULL")
def before_or_open(spark, sf):
    return before_event(_seen(spark, sf), "l_shipdate", "done", keep_open=True)


@query("p6_key_filter", "SELECT * FROM events WHERE user_id = 42")
def one_key(spark, sf):
    return key_filter(table(spark, sf, "events"), "user_id", 42)


def _points(spark, sf):
    lines = table(spark, sf, "lineitem")
    part, supp, order = (F.col(c) for c in ("l_partkey", "l_suppkey", "l_orderkey"))
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        ((supp % 170) * 0.99 - 84.7).alias("lat_a"),
        ((part % 360) * 0.97 - 170.3).alias("lon_a"),
        ((order % 160) * 1.01 - 80.3).alias("lat_b"),
        F.when(F.col("l_returnflag") != "N", (order % 350) * 1.03 - 177.7).alias("lon_b"),
    )


_POINTS_SQL = """
SELECT l_orderkey, l_linenumber,
       CAST(l_suppkey % 170 AS DOUBLE) * CAST(0.99 AS DOUBLE) - CAST(84.7 AS DOUBLE) AS lat_a,
       CAST(l_partkey % 360 AS DOUBLE) * CAST(0.97 AS DOUBLE) - CAST(170.3 AS DOUBLE) AS lon_a,
       CAST(l_orderkey % 160 AS DOUBLE) * CAST(1.01 AS DOUBLE) - CAST(80.3 AS DOUBLE) AS lat_b,
       CASE WHEN l_returnflag <> 'N'
            THEN CAST(l_orderkey % 350 AS DOUBLE) * CAST(1.03 AS DOUBLE) - CAST(177.7 AS DOUBLE) END AS lon_b
FROM lineitem
"""
_ENDS = ("lat_a", "lon_a", "lat_b", "lon_b")


@query("f1_haversine_km", f"SELECT l_orderkey, l_linenumber, {haversine_sql(*_ENDS)} AS km FROM ({_POINTS_SQL})")
def distance(spark, sf):
    km = F.round(haversine_km(*(F.col(c) for c in _ENDS)), 2)
    return _points(spark, sf).select("l_orderkey", "l_linenumber", km.alias("km"))


@query("f2_bearing_deg", f"SELECT l_orderkey, l_linenumber, {bearing_sql(*_ENDS)} AS heading FROM ({_POINTS_SQL})")
def heading(spark, sf):
    degrees = F.round(bearing_deg(*(F.col(c) for c in _ENDS)), 4)
    return _points(spark, sf).select("l_orderkey", "l_linenumber", degrees.alias("heading"))


@query(
    "f3_seconds_to_event",
    """SELECT l_orderkey, l_linenumber,
              CAST(epoch(o_orderdate) AS BIGINT) - CAST(epoch(l_shipdate) AS BIGINT) AS seconds_to_event
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def seconds_left(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("epoch")
    )
    left = feat.seconds_to_event(F.col("o_orderdate"), F.col("epoch"))
    return lines.join(orders, "l_orderkey").select("l_orderkey", "l_linenumber", left.alias("seconds_to_event"))


@query(
    "f4_bool_to_int",
    """SELECT l_orderkey, l_linenumber,
              CASE WHEN l_returnflag <> 'N' THEN CAST(l_returnflag = 'R' AS INTEGER) END AS returned
       FROM lineitem""",
)
def flags(spark, sf):
    returned = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag") == "R")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", feat.bool_to_int(returned).alias("returned")
    )


@query(
    "f5_calendar_parts",
    """SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour_of_day, CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week,
              CAST(month(ts) AS INTEGER) AS month_of_year FROM events""",
)
def parts(spark, sf):
    ts = F.col("ts")
    return table(spark, sf, "events").select(
        "event_id",
        feat.hour_of_day(ts).alias("hour_of_day"),
        feat.day_of_week(ts).alias("day_of_week"),
        feat.month_of_year(ts).alias("month_of_year"),
    )


@query(
    "f6_epoch_to_ts",
    "SELECT event_id, date_trunc('second', ts) AS seen FROM events",
)
def from_epoch(spark, sf):
    epoch = F.unix_seconds(F.col("ts").cast("timestamp"))
    return no_zone(table(spark, sf, "events").select("event_id", feat.epoch_to_ts(epoch).alias("seen")))


@query(
    "f7_to_date",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day,
              CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS parsed FROM orders""",
)
def dates(spark, sf):
    text = F.when(F.col("o_orderstatus") == "P", "not a day").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, sf, "orders").select(
        "o_orderkey", feat.event_date(F.col("o_orderdate")).alias("day"), feat.parse_date(text).alias("parsed")
    )


@query("f8_strip_quotes", "SELECT p_partkey, replace('''' || p_name || '''', '''', '') AS name FROM part")
def unquoted(spark, sf):
    quoted = F.concat(F.lit("'"), F.col("p_name"), F.lit("'"))
    return table(spark, sf, "part").select("p_partkey", feat.strip_quotes(quoted).alias("name"))


@query(
    "f9_null_default",
    "SELECT l_orderkey, l_linenumber, coalesce(nullif(l_discount, 0.05), l_tax) AS rate FROM lineitem",
)
def defaults(spark, sf):
    rate = feat.null_default(F.nullif(F.col("l_discount"), F.lit(0.05)), F.col("l_tax"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", rate.alias("rate"))


@query(
    "f10_flag_not_null",
    "SELECT o_orderkey, CASE WHEN nullif(o_orderstatus, 'P') IS NOT NULL THEN 1 ELSE 0 END AS known FROM orders",
)
def known(spark, sf):
    flag = feat.flag_not_null(F.nullif(F.col("o_orderstatus"), F.lit("P")))
    return table(spark, sf, "orders").select("o_orderkey", flag.alias("known"))


@query(
    "w1_entity_id",
    f"""SELECT ident, concat_ws('_', ident, operator, strftime(scheduled_out, '%Y-%m-%d %H:%M:%S')) AS flight_id
        FROM ({SCHEDULE_SQL})""",
)
def entity(spark, sf):
    plan = schedule(table(spark, sf, "orders"))
    return plan.select(
        "ident", feat.entity_id(*(F.col(c) for c in ("ident", "operator", "scheduled_out"))).alias("flight_id")
    )


@query(
    "t3_non_finite_to_null",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'A' THEN l_quantity END AS amount, l_tax FROM lineitem""",
)
def finite(spark, sf):
    flag = F.col("l_returnflag")
    amount = (
        F.when(flag == "A", F.col("l_quantity"))
        .when(F.col("l_linestatus") == "F", float("nan"))
        .when(flag == "R", float("inf"))
        .otherwise(float("-inf"))
    )
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", amount.alias("amount"), "l_tax")
    return feat.non_finite_to_null(rows)
