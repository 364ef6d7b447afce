"""The domain tables, derived from the shared test tables, in Spark and in SQL.

Orders play the plan, lineitems the observations of an order's asset, nations the
places. Nothing is left out: every order and every lineitem takes part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackfuse.operators.enrich import key_average
from trackfuse.schemas import POSITIONS, SCHEDULE, SCHEDULE_TIMES
from trackfuse.session import stage
from trackfuse.sources.scans import calendar_table

HALF_YEAR = 180 * 24 * 3600
HOLIDAYS = [f"{year}-{day}" for year in range(1995, 2002) for day in ("01-01", "05-01", "12-25", "12-26")]


def _after(minutes: str):
    return F.expr(f"o_orderdate + make_dt_interval(0, 0, {minutes}, 0)")


# Minutes from the planned departure; actual times are unknown for status P.
PLANNED_MINUTES = {
    "scheduled_out": "0",
    "scheduled_off": "20",
    "estimated_out": "5",
    "estimated_off": "25",
    "scheduled_on": "120",
    "scheduled_in": "130",
    "estimated_on": "125",
    "estimated_in": "135",
}
DELAY_MINUTES = "CAST(o_custkey % 120 AS INT)"
ACTUAL_MINUTES = {
    "actual_out": DELAY_MINUTES,
    "actual_off": "90 * 1440",
    "actual_on": "91 * 1440",
    "actual_in": "92 * 1440",
}


def schedule(orders: DataFrame) -> DataFrame:
    left = F.col("o_orderstatus") != "P"
    key = F.col("o_orderkey").cast("string")
    delay = F.expr(f"{DELAY_MINUTES} * 60")
    columns = {
        "origin_code_icao": F.concat(F.lit("A"), (F.col("o_custkey") % 30).cast("string")),
        "dest_code_icao": F.col("o_orderstatus"),
        "ident": F.concat(F.lit("T"), key),
        "operator": F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")),
        "diverted": F.col("o_orderstatus") == "F",
        "cancelled": F.col("o_orderstatus") == "O",
        "registration": F.concat(F.lit("R"), key),
        **{name: _after(m).cast("timestamp") for name, m in PLANNED_MINUTES.items()},
        **{name: F.when(left, _after(m)).cast("timestamp") for name, m in ACTUAL_MINUTES.items()},
        "departure_delay": F.when(left, delay),
        "arrival_delay": F.when(left, delay + 60),
    }
    return orders.select(*(columns[n].alias(n) for n in SCHEDULE.names))


def _sql_after(minutes: str) -> str:
    return f"o_orderdate + to_minutes({minutes})"


SCHEDULE_SQL = f"""
SELECT 'A' || CAST(o_custkey % 30 AS VARCHAR) AS origin_code_icao,
       o_orderstatus AS dest_code_icao,
       'T' || CAST(o_orderkey AS VARCHAR) AS ident,
       nullif(o_orderpriority, '5-LOW') AS operator,
       o_orderstatus = 'F' AS diverted,
       o_orderstatus = 'O' AS cancelled,
       'R' || CAST(o_orderkey AS VARCHAR) AS registration,
       {", ".join(f"{_sql_after(m)} AS {n}" for n, m in PLANNED_MINUTES.items())},
       {", ".join(f"CASE WHEN o_orderstatus <> 'P' THEN {_sql_after(m)} END AS {n}" for n, m in ACTUAL_MINUTES.items())},
       CASE WHEN o_orderstatus <> 'P' THEN {DELAY_MINUTES} * 60 END AS departure_delay,
       CASE WHEN o_orderstatus <> 'P' THEN {DELAY_MINUTES} * 60 + 60 END AS arrival_delay
FROM orders
"""


def positions(lineitem: DataFrame) -> DataFrame:
    key = F.col("l_orderkey").cast("string")
    seen = F.unix_seconds(F.col("l_shipdate").cast("timestamp"))
    columns = {
        "icao24": F.concat(F.lit("a"), key),
        "callsign": F.concat(F.lit("T"), key),
        "origin_country": F.col("l_returnflag"),
        "time_position": seen,
        "last_contact": seen + F.col("l_linenumber"),
        "longitude": (F.col("l_partkey") % 360) * 0.97 - 170.3,
        "latitude": (F.col("l_suppkey") % 170) * 0.99 - 84.7,
        "baro_altitude": F.col("l_extendedprice"),
        "on_ground": F.col("l_linestatus") == "O",
        "velocity": F.nullif(F.col("l_quantity"), F.lit(50.0)),
        "true_track": F.col("l_discount"),
        "vertical_rate": F.col("l_tax"),
        "sensors": F.lit(None).cast("string"),
        "geo_altitude": F.col("l_extendedprice") / 2,
        "squawk": F.col("l_linenumber").cast("string"),
        "spi": F.col("l_returnflag") == "R",
        "position_source": F.col("l_linenumber").cast("long"),
    }
    return lineitem.select(*(columns[n].alias(n) for n in POSITIONS.names))


POSITIONS_SQL = """
SELECT 'a' || CAST(l_orderkey AS VARCHAR) AS icao24,
       'T' || CAST(l_orderkey AS VARCHAR) AS callsign,
       l_returnflag AS origin_country,
       CAST(epoch(l_shipdate) AS BIGINT) AS time_position,
       CAST(epoch(l_shipdate) AS BIGINT) + l_linenumber AS last_contact,
       CAST(l_partkey % 360 AS DOUBLE) * CAST(0.97 AS DOUBLE) - CAST(170.3 AS DOUBLE) AS longitude,
       CAST(l_suppkey % 170 AS DOUBLE) * CAST(0.99 AS DOUBLE) - CAST(84.7 AS DOUBLE) AS latitude,
       l_extendedprice AS baro_altitude,
       l_linestatus = 'O' AS on_ground,
       nullif(l_quantity, 50.0) AS velocity,
       l_discount AS true_track,
       l_tax AS vertical_rate,
       CAST(NULL AS VARCHAR) AS sensors,
       l_extendedprice / 2 AS geo_altitude,
       CAST(l_linenumber AS VARCHAR) AS squawk,
       l_returnflag = 'R' AS spi,
       CAST(l_linenumber AS BIGINT) AS position_source
FROM lineitem
"""


def places(nation: DataFrame) -> DataFrame:
    number = F.col("n_nationkey")
    return nation.select(
        F.concat(F.lit("A"), number.cast("string")).alias("ident"),
        (number * 3.1 - 36.2).alias("latitude_deg"),
        (number * 7.3 - 90.4).alias("longitude_deg"),
    )


PLACES_SQL = """
SELECT 'A' || CAST(n_nationkey AS VARCHAR) AS ident,
       CAST(n_nationkey AS DOUBLE) * CAST(3.1 AS DOUBLE) - CAST(36.2 AS DOUBLE) AS latitude_deg,
       CAST(n_nationkey AS DOUBLE) * CAST(7.3 AS DOUBLE) - CAST(90.4 AS DOUBLE) AS longitude_deg
FROM nation
"""


def id_map(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    return orders.select(
        F.concat(F.lit("a"), key).alias("icao24_cln"), F.concat(F.lit("R"), key).alias("registration")
    )


ID_MAP_SQL = """
SELECT 'a' || CAST(o_orderkey AS VARCHAR) AS icao24_cln, 'R' || CAST(o_orderkey AS VARCHAR) AS registration FROM orders
"""


def holidays(spark: SparkSession) -> DataFrame:
    return calendar_table(spark, HOLIDAYS)


HOLIDAYS_SQL = "SELECT CAST(d AS DATE) AS holiday_date FROM (VALUES " + ", ".join(f"('{d}')" for d in HOLIDAYS) + ") v(d)"


def operator_averages(orders: DataFrame) -> DataFrame:
    """The stored averages table, written once like any other dimension."""
    means = key_average(schedule(orders), "operator", "departure_delay", "operator_avg_departure_delay")
    return stage(means, "operator_averages")


OPERATOR_AVERAGES_SQL = (
    "SELECT operator, avg(departure_delay) AS operator_avg_departure_delay FROM schedule GROUP BY operator"
)


def haversine_sql(lat_a: str, lon_a: str, lat_b: str, lon_b: str) -> str:
    half = f"pow(sin((radians({lat_b}) - radians({lat_a})) / 2), 2)"
    across = f"cos(radians({lat_a})) * cos(radians({lat_b})) * pow(sin((radians({lon_b}) - radians({lon_a})) / 2), 2)"
    term = f"{half} + {across}"
    return f"round(2 * 6371.0 * asin(sqrt(CASE WHEN {term} > 1.0 THEN 1.0 ELSE {term} END)), 2)"


def bearing_sql(lat_a: str, lon_a: str, lat_b: str, lon_b: str, digits: int = 4) -> str:
    turn = f"radians({lon_b} - {lon_a})"
    east = f"sin({turn}) * cos(radians({lat_b}))"
    north = (
        f"cos(radians({lat_a})) * sin(radians({lat_b})) - sin(radians({lat_a})) * cos(radians({lat_b})) * cos({turn})"
    )
    wrapped = f"degrees(atan2({east}, {north})) + 360.0"
    return f"round(({wrapped}) - 360.0 * floor(({wrapped}) / 360.0), {digits})"


def schedule_messages(rows: DataFrame) -> DataFrame:
    """Schedule rows as nested JSON bytes, times as ISO text, as a topic would carry them."""
    return rows.select(F.to_json(schedule_entry()).cast("binary").alias("value"))


def schedule_entry():
    times = {n: F.date_format(n, "yyyy-MM-dd'T'HH:mm:ss'Z'") for n in SCHEDULE_TIMES}
    plain = {n: times.get(n, F.col(n)) for n in SCHEDULE.names if n not in ("origin_code_icao", "dest_code_icao")}
    return F.struct(
        F.struct(F.col("origin_code_icao").alias("code_icao")).alias("origin"),
        F.struct(F.col("dest_code_icao").alias("code_icao")).alias("destination"),
        *(c.alias(n) for n, c in plain.items()),
    )


def position_messages(rows: DataFrame) -> DataFrame:
    return rows.select(F.to_json(F.struct(*rows.columns)).cast("binary").alias("value"))


FEATURES_SQL = f"""
WITH schedule AS ({SCHEDULE_SQL}), positions AS ({POSITIONS_SQL}), places AS ({PLACES_SQL}), id_map AS ({ID_MAP_SQL}),
     holidays AS ({HOLIDAYS_SQL}), averages AS ({OPERATOR_AVERAGES_SQL}),
     overall AS (SELECT avg(operator_avg_departure_delay) AS mean FROM averages)
SELECT s.origin_code_icao AS origin_airport_icao, s.dest_code_icao AS dest_airport_icao, s.ident, s.operator, s.diverted,
       s.cancelled, {", ".join(f"s.{n}" for n in SCHEDULE_TIMES)}, s.departure_delay, s.arrival_delay,
       pl.latitude_deg AS airport_lat, pl.longitude_deg AS airport_long, m.icao24_cln, s.registration,
       p.baro_altitude, p.callsign, p.geo_altitude, p.icao24, p.last_contact, p.latitude, p.longitude, p.on_ground,
       p.origin_country, p.position_source, p.sensors, p.spi, p.squawk, p.time_position, p.true_track, p.velocity,
       p.vertical_rate, CAST(to_timestamp(p.time_position) AT TIME ZONE 'UTC' AS TIMESTAMP) AS time_position_iso,
       {haversine_sql("pl.latitude_deg", "pl.longitude_deg", "p.latitude", "p.longitude")} AS aircraft_airport_distance_km,
       CAST(epoch(s.scheduled_out) AS BIGINT) - p.time_position AS seconds_to_scheduled_out,
       CAST(p.on_ground AS INTEGER) AS on_ground_int, CAST(s.diverted AS INTEGER) AS diverted_int,
       CAST(s.cancelled AS INTEGER) AS cancelled_int,
       {bearing_sql("p.latitude", "p.longitude", "pl.latitude_deg", "pl.longitude_deg")} AS aircraft_to_airport_heading,
       CAST(hour(s.scheduled_out) AS INTEGER) AS scheduled_out_hour_of_day,
       CAST(dayofweek(s.scheduled_out) + 1 AS INTEGER) AS scheduled_out_day_of_week,
       CAST(month(s.scheduled_out) AS INTEGER) AS scheduled_out_month_of_year,
       round(coalesce(a.operator_avg_departure_delay, overall.mean), 4) AS operator_avg_departure_delay,
       CASE WHEN h.holiday_date IS NOT NULL THEN 1 ELSE 0 END AS is_holiday
FROM schedule s
LEFT JOIN places pl ON s.origin_code_icao = pl.ident
LEFT JOIN id_map m ON s.registration = m.registration
JOIN positions p ON p.icao24 = m.icao24_cln
 AND p.time_position BETWEEN epoch(s.scheduled_out) - {HALF_YEAR} AND epoch(s.scheduled_out) + {HALF_YEAR}
LEFT JOIN holidays h ON CAST(s.scheduled_out AS DATE) = h.holiday_date
LEFT JOIN averages a ON s.operator = a.operator
CROSS JOIN overall
WHERE p.time_position < epoch(s.actual_off)
"""
