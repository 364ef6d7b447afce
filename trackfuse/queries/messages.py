"""Sources and decoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from trackfuse.operators.project import expand, flatten
from trackfuse.queries.domain import HOLIDAYS_SQL, SCHEDULE_SQL, holidays, schedule, schedule_entry, schedule_messages
from trackfuse.queries.registry import as_glob, no_zone, query, replay, table, written
from trackfuse.schemas import SCHEDULE_MESSAGE, SCHEDULE_TIMES, schema
from trackfuse.sources.decode import (
    SCHEDULE_PICKS,
    decode_flat_json,
    decode_schedule,
    lift,
    paged_payload,
    state_vectors,
)
from trackfuse.sources.scans import csv_scan, quoted_csv_scan, read_stream, table_scan, table_stream


@query("s1_stream_source", "SELECT * FROM orders")
def stream_source(spark, sf):
    path = f"{sf}/orders.parquet"
    unbounded = read_stream(spark, "parquet", {}, spark.read.parquet(path).schema, as_glob(path))
    return replay(unbounded, "s1")


@query(
    "s2_decode_flat_json",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS missing FROM events",
)
def flat_json(spark, sf):
    raw = table(spark, sf, "events").select("event_id", F.col("props").cast("binary").alias("value"))
    return decode_flat_json(raw, schema(k="long", missing="string"), keep=["event_id"])


@query("s3_decode_nested_json", SCHEDULE_SQL)
def nested_json(spark, sf):
    messages = schedule_messages(schedule(table(spark, sf, "orders")))
    return no_zone(decode_schedule(messages))


@query("s4_table_scan", "SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem WHERE l_quantity >= 25")
def scan(spark, sf):
    rows = table_scan(spark, f"{sf}/lineitem.parquet")
    return rows.filter(F.col("l_quantity") >= 25).select("l_orderkey", "l_linenumber", "l_shipdate")


@query("s5_table_stream", "SELECT l_orderkey, l_partkey, l_extendedprice FROM lineitem")
def stored_as_stream(spark, sf):
    path = f"{sf}/lineitem.parquet"
    appended = table_stream(spark, as_glob(path), spark.read.parquet(path).schema)
    return replay(appended.select("l_orderkey", "l_partkey", "l_extendedprice"), "s5")


@query(
    "s6_csv_scan",
    """SELECT CAST(c_custkey AS VARCHAR) AS ident, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS balance
       FROM customer""",
)
def csv(spark, sf):
    balance = F.when(F.col("c_mktsegment") == "BUILDING", "n/a").otherwise(F.col("c_acctbal").cast("string"))
    text = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("ident"), balance.alias("balance"), F.col("c_name").alias("other")
    )
    return csv_scan(spark, written(text, "s6", "csv", header=True), ["ident", "balance"], ["balance"])


@query(
    "s7_quoted_csv_scan",
    "SELECT CAST(o_orderkey AS VARCHAR) AS icao24_cln, o_orderpriority AS registration FROM orders",
)
def quoted_csv(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("icao24"), F.col("o_orderpriority").alias("registration"), "o_orderstatus"
    )
    path = written(rows, "s7", "csv", header=True, quote="'", quoteAll=True)
    return quoted_csv_scan(spark, path, "icao24", "icao24_cln", ["registration"])


@query(
    "s8_state_vectors",
    """SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice AS price FROM orders
       UNION ALL SELECT o_orderkey, NULL, NULL FROM orders
       UNION ALL SELECT NULL, o_orderpriority, NULL FROM orders""",
)
def vectors(spark, sf):
    # A full array with one position too many, a short one, and one with an unreadable number.
    key, price = F.col("o_orderkey").cast("string"), F.col("o_totalprice").cast("string")
    full = F.array(key, F.col("o_orderstatus"), price, F.lit("beyond"))
    states = F.array(full, F.array(key), F.array(F.lit("?"), F.col("o_orderpriority"), F.lit("n/a")))
    pages = table(spark, sf, "orders").select(F.to_json(F.struct(states.alias("states"))).alias("value"))
    return state_vectors(pages, schema(id="long", status="string", price="double"))


@query(
    "s9_paged_payload",
    f"""WITH schedule AS ({SCHEDULE_SQL})
        SELECT * FROM schedule UNION ALL SELECT * FROM schedule WHERE dest_code_icao = 'F'""",
)
def payload(spark, sf):
    # Status F: two entries under the first key. O: the first key is empty. P: it is missing.
    entry, status = schedule_entry(), F.col("dest_code_icao")
    first = F.when(status == "F", F.array(entry, entry)).when(status == "O", F.slice(F.array(entry), 1, 0))
    second = F.when(status != "F", F.array(entry))
    pages = schedule(table(spark, sf, "orders")).select(
        F.to_json(F.struct(first.alias("departures"), second.alias("scheduled_departures"))).alias("value")
    )
    return no_zone(lift(paged_payload(pages, SCHEDULE_MESSAGE), SCHEDULE_PICKS, SCHEDULE_TIMES))


@query(
    "s10_calendar_table",
    f"""SELECT holiday_date, count(o_orderkey) AS orders FROM ({HOLIDAYS_SQL}) h
        LEFT JOIN orders ON CAST(o_orderdate AS DATE) = holiday_date GROUP BY holiday_date""",
)
def calendar(spark, sf):
    per_day = (
        table(spark, sf, "orders")
        .groupBy(F.to_date("o_orderdate").alias("holiday_date"))
        .agg(F.count("*").alias("orders"))
    )
    return holidays(spark).join(per_day, "holiday_date", "left").fillna(0, ["orders"])


@query(
    "p1_struct_flatten",
    "SELECT l_orderkey AS id, l_partkey AS part, l_quantity AS amount FROM lineitem",
)
def struct_flatten(spark, sf):
    nested = table(spark, sf, "lineitem").select(
        "l_orderkey", F.struct("l_partkey", F.struct("l_quantity").alias("inner")).alias("outer")
    )
    return flatten(nested, {"id": "l_orderkey", "part": "outer.l_partkey", "amount": "outer.inner.l_quantity"})


@query("p1_struct_expand", "SELECT event_id, user_id, value FROM events")
def struct_expand(spark, sf):
    return expand(table(spark, sf, "events").select(F.struct("event_id", "user_id", "value").alias("data")))
