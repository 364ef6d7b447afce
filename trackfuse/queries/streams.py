"""Streaming forms. Each runs over the whole table and must equal the batch answer."""

from __future__ import annotations

from pyspark.sql import functions as F

from trackfuse.learning.train import fit_model, score
from trackfuse.operators.enrich import calendar_flag, id_map_left, key_average, key_average_join, lookup_left
from trackfuse.operators.interval import DAY, drop_repeats, interval_join, watermark
from trackfuse.queries.domain import HOLIDAYS_SQL, holidays
from trackfuse.queries.joins import PAIRS_SQL, purchases_and_clicks
from trackfuse.queries.learning import LINE_SQL
from trackfuse.queries.registry import ONCE, no_zone, query, replay, stream, table
from trackfuse.session import file_system, new_name, new_path, stage
from trackfuse.sources.scans import table_scan, table_stream
from trackfuse.streaming.averages import keep_averages, kept_averages, merge_averages
from trackfuse.streaming.batches import append_batches, batch_folders, bloom_filter, compact_batches, drop_merged, read_batches
from trackfuse.streaming.progress import batch_progress, watch_batches
from trackfuse.streaming.sinks import append_files, append_stream, finish, overwrite_table
from trackfuse.streaming.versions import publish_version, read_version, versioned_join, versions_used


@query("x1_watermark", "SELECT event_id, ts, user_id, value FROM events")
def marked(spark, sf):
    """Two polls deliver the same events; the mark bounds how long a repeat is looked for."""
    once = stream(spark, sf, "events").select("event_id", "ts", "user_id", "value")
    again = stream(spark, sf, "events").select("event_id", "ts", "user_id", "value")
    polls = watermark(once.unionAll(again), "ts", "8 hours")
    return no_zone(replay(drop_repeats(polls, ["event_id"]), "x1"))


def _pairs(events, delay="8 hours"):
    plan, seen = purchases_and_clicks(events)
    return interval_join(plan, seen, ("plan_user", "seen_user"), "plan_at", "seen_at", DAY, DAY, delay)


@query("x2_stream_interval_join", PAIRS_SQL)
def stream_pairs(spark, sf):
    return no_zone(replay(_pairs(stream(spark, sf, "events")), "x2"))


@query(
    "x3_stream_static_join",
    f"""WITH means AS (SELECT nullif(event_type, 'view') AS event_type, avg(value) AS mean FROM events GROUP BY 1)
        SELECT event_id, c_name, n_name AS place,
               CASE WHEN h.holiday_date IS NOT NULL THEN 1 ELSE 0 END AS is_holiday,
               round(coalesce(mean, (SELECT avg(mean) FROM means)), 4) AS mean
        FROM events e LEFT JOIN customer ON user_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN ({HOLIDAYS_SQL} UNION ALL SELECT DATE '2024-01-01') h ON CAST(ts AS DATE) = h.holiday_date
        LEFT JOIN means m ON e.event_type = m.event_type""",
)
def stream_static(spark, sf):
    users = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_name", "c_nationkey")
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    days = holidays(spark).unionAll(spark.range(1).select(F.to_date(F.lit("2024-01-01"))))
    kind = F.nullif(F.col("event_type"), F.lit("view")).alias("event_type")
    history = table(spark, sf, "events").select(kind, "value")  # views are filed under no name
    means = stage(key_average(history, "event_type", "value", "mean"), "event_means")

    events = stream(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    named = lookup_left(id_map_left(events, users, "user_id"), nations, "c_nationkey", "n_nationkey", {"n_name": "place"})
    flagged = calendar_flag(named, days, "ts", "holiday_date", "is_holiday")
    averaged = key_average_join(flagged, means, "event_type", "mean").withColumn("mean", F.round("mean", 4))
    return replay(averaged.select("event_id", "c_name", "place", "is_holiday", "mean"), "x3")


@query(
    "x3_stream_static_join_salted",
    "SELECT event_id, user_id, c_name FROM events LEFT JOIN customer ON user_id = c_custkey",
)
def stream_static_salted(spark, sf):
    users = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_name")
    events = stream(spark, sf, "events").select("event_id", "user_id")
    return replay(id_map_left(events, users, "user_id", max_rows=0), "x3")


@query(
    "x3_refresh_under_stream",
    """WITH means AS (SELECT event_type, avg(value) AS mean FROM events WHERE ts < '2024-01-16' GROUP BY event_type)
       SELECT event_id, round(mean, 4) AS mean FROM events LEFT JOIN means USING (event_type)""",
)
def refreshed_under(spark, sf):
    """The stored averages are replaced while a stream runs that has been started with them."""
    events, stored = table(spark, sf, "events"), new_name("x3_means")
    place, folder, out = new_path(spark, "x3_means"), new_path(spark, "x3_in"), new_path(spark, "x3")

    def refresh(history):
        overwrite_table(key_average(history, "event_type", "value", "mean"), stored, path=place)

    refresh(events.filter("ts < '2024-01-16'"))
    events.filter("ts < '2024-01-16'").write.parquet(folder)
    arriving = table_stream(spark, folder, events.schema).select("event_id", "event_type")
    averaged = key_average_join(arriving, stage(spark.table(stored), "averages"), "event_type", "mean")
    rows = averaged.select("event_id", F.round("mean", 4).alias("mean"))
    running = append_files(rows, out, new_path(spark, "x3_checkpoint"))
    running.processAllAvailable()
    refresh(events)
    events.filter("ts >= '2024-01-16'").write.mode("append").parquet(folder)
    running.processAllAvailable()
    running.stop()
    return spark.read.parquet(out)


@query("x2_stream_interval_join_hot", PAIRS_SQL)
def stream_pairs_hot(spark, sf):
    """The stored events tell which users are heavy; their pairs are split."""
    _, history = purchases_and_clicks(table(spark, sf, "events"))
    plan, seen = purchases_and_clicks(stream(spark, sf, "events"))
    on = ("plan_user", "seen_user")
    pairs = interval_join(
        plan, seen, on, "plan_at", "seen_at", DAY, DAY, "8 hours", min_rows=2, history=history
    )
    return no_zone(replay(pairs, "x2"))


@query("s5_table_stream_by_name", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def stream_by_name(spark, sf):
    """A stream appends to a catalog table, and another reads that table by its name."""
    name = new_name("s5")
    orders = stream(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    finish(
        append_stream(
            orders, name, new_path(spark, "s5_checkpoint"), path=new_path(spark, "s5"), trigger=ONCE,
            partition_by=["o_orderstatus"],
        )
    )
    return replay(table_stream(spark, name, per_batch=2), "s5")


@query("s4_table_scan_by_name", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def scan_by_name(spark, sf):
    name = new_name("s4")
    overwrite_table(
        table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), name, path=new_path(spark, "s4")
    )
    return table_scan(spark, name)


def _arrivals(spark, sf, name):
    """A step writes one part of the events into a folder, then runs the stream over it."""
    folder = new_path(spark, f"{name}_in")
    schema = table(spark, sf, "events").schema

    def step(run, part):
        table(spark, sf, "events").filter(part).write.mode("append").parquet(folder)
        run(table_stream(spark, folder, schema))

    return step


@query("x4_late_rows", PAIRS_SQL)
def late(spark, sf):
    """After a first run the old events arrive once more: the join drops them as late."""
    out, checkpoint = new_path(spark, "x4"), new_path(spark, "x4_checkpoint")
    step = _arrivals(spark, sf, "x4")

    def run(events):
        finish(append_files(_pairs(events), out, checkpoint, trigger=ONCE))

    step(run, "ts < '2024-01-20'")
    step(run, "ts >= '2024-01-20' OR ts < '2024-01-15'")
    return no_zone(spark.read.parquet(out))


@query("x5_checkpointed_restart", PAIRS_SQL)
def restarted(spark, sf):
    """The events come in two halves; the second run goes on from the state of the first."""
    out, checkpoint = new_path(spark, "x5"), new_path(spark, "x5_checkpoint")
    step = _arrivals(spark, sf, "x5")

    def run(events):
        finish(append_files(_pairs(events), out, checkpoint, trigger=ONCE))

    step(run, "ts < '2024-01-16'")
    step(run, "ts >= '2024-01-16'")
    return no_zone(spark.read.parquet(out))


@query("x6_trigger", "SELECT user_id, event_type, value FROM events")
def triggered(spark, sf):
    """With no trigger set batches follow back to back; here until all there is has been read."""
    out = new_path(spark, "x6")
    events = stream(spark, sf, "events").select("user_id", "event_type", "value")
    running = append_files(events, out, new_path(spark, "x6_checkpoint"))
    running.processAllAvailable()
    running.stop()
    return spark.read.parquet(out)


@query("x7_stream_score", LINE_SQL)
def stream_scores(spark, sf):
    model = fit_model(table(spark, sf, "lineitem"), "linear_regression", "l_extendedprice", numerical=["l_quantity"])
    scored = score(model, stream(spark, sf, "lineitem"))
    rounded = scored.select("l_orderkey", "l_linenumber", F.round("prediction", 2).alias("prediction"))
    return replay(rounded, "x7")


def _forget_last_batch(spark, checkpoint):
    """As after a crash: the last batch has written its rows, but nobody noted that it was done."""
    fs, commits = file_system(spark, f"{checkpoint}/commits")
    numbers = [int(f.getPath().getName()) for f in fs.listStatus(commits) if f.getPath().getName().isdigit()]
    fs.delete(commits.suffix(f"/{max(numbers)}"), False)


@query("a1_incremental_average", "SELECT event_type, round(avg(value), 4) AS mean FROM events GROUP BY event_type")
def incremental(spark, sf):
    """Three parts, each a run of its own; the second is run twice, and older batches are merged in between."""
    path, checkpoint = new_path(spark, "a1_kept"), new_path(spark, "a1_checkpoint")
    step = _arrivals(spark, sf, "a1")

    def run(events):
        finish(keep_averages(events, "event_type", "value", path, checkpoint, ONCE))

    step(run, "ts < '2024-01-10'")
    step(run, "ts >= '2024-01-10' AND ts < '2024-01-20'")
    _forget_last_batch(spark, checkpoint)
    step(run, "ts >= '2024-01-20'")
    merge_averages(spark, path)
    drop_merged(spark, path)
    return kept_averages(spark, path, "event_type", "mean").withColumn("mean", F.round("mean", 4))


@query(
    "x3_versioned_static",
    """WITH m AS (SELECT 1 AS version, event_type, avg(value) AS mean FROM events WHERE ts < '2024-01-16' GROUP BY event_type
               UNION ALL SELECT 2, event_type, avg(value) FROM events GROUP BY event_type)
       SELECT event_id, version::BIGINT AS version, round(mean, 4) AS mean FROM events
       JOIN m ON m.event_type = events.event_type AND version = CASE WHEN ts < '2024-01-16' THEN 1 ELSE 2 END""",
)
def versioned(spark, sf):
    """New averages are published between two batches; the second batch is run again after a third publication."""
    events = table(spark, sf, "events")
    means, folder, out, checkpoint = (new_path(spark, f"x3_{n}") for n in ("means", "in", "out", "checkpoint"))

    def publish(history):
        publish_version(key_average(history, "event_type", "value", "mean"), means)

    def enrich(batch, means):
        return key_average_join(batch, means, "event_type", "mean").select("event_id", F.round("mean", 4).alias("mean"))

    def run(part):
        if part:
            events.filter(part).write.mode("append").parquet(folder)
        arriving = table_stream(spark, folder, events.schema)
        finish(versioned_join(arriving, {"means": means}, enrich, out, checkpoint, ONCE))

    publish(events.filter("ts < '2024-01-16'"))
    run("ts < '2024-01-16'")
    publish(events)
    run("ts >= '2024-01-16'")
    publish(events.limit(0))
    _forget_last_batch(spark, f"{checkpoint}/stream")
    run(None)
    assert read_version(spark, means).isEmpty()
    written_ = spark.read.schema("event_id bigint, mean double, batch bigint").parquet(out)
    return written_.join(versions_used(spark, checkpoint), "batch").select("event_id", "version", "mean")


@query(
    "x4_late_counts",
    """SELECT count(*) + count(*) FILTER (ts < '2024-01-15') AS rows_in, count(*) FILTER (ts < '2024-01-15') AS dropped_late FROM events""",
)
def late_counts(spark, sf):
    """The old events arrive once more, after the mark has passed them: so many were dropped."""
    told, out, checkpoint = (new_path(spark, f"x4_{n}") for n in ("progress", "out", "checkpoint"))
    step = _arrivals(spark, sf, "x4")
    queries = set()

    def run(events):
        once = drop_repeats(watermark(events, "ts", "8 hours"), ["event_id"])
        running = append_files(once, out, checkpoint, trigger=ONCE)
        finish(running)
        listener.wait_for(running)
        queries.add(running.id)

    listener = watch_batches(spark, told)
    try:
        step(run, "ts < '2024-01-20'")
        step(run, "ts >= '2024-01-20' OR ts < '2024-01-15'")
    finally:
        spark.streams.removeListener(listener)
    rows = batch_progress(spark, told).filter(F.col("query").isin(*queries))
    return rows.agg(F.sum("rows_in").alias("rows_in"), F.sum("dropped_late").alias("dropped_late"))


_SCANNED_SQL = """SELECT 'all' AS seen, event_id, user_id FROM events UNION ALL SELECT 'reader', event_id, user_id FROM events
       WHERE ts < '2024-01-20' UNION ALL SELECT 'user', event_id, user_id FROM events WHERE user_id = 42"""


@query("k1_compacted", _SCANNED_SQL)
def compacted(spark, sf):
    """Batches are merged into fewer files, sorted by user, while a reader is at work and the stream goes on."""
    path, checkpoint = new_path(spark, "k1_batches"), new_path(spark, "k1_checkpoint")
    step, files = _arrivals(spark, sf, "k1"), bloom_filter("user_id")

    def run(events):
        finish(append_batches(events.select("event_id", "user_id"), path, checkpoint, ONCE, options=files))

    step(run, "ts < '2024-01-10'")
    step(run, "ts >= '2024-01-10' AND ts < '2024-01-20'")
    reader = read_batches(spark, path)
    merged = compact_batches(spark, path, ["user_id"], spare=0, options=files)
    step(run, "ts >= '2024-01-20'")
    seen = stage(reader.select(F.lit("reader").alias("seen"), "*"), "reader")
    assert merged == 1 and len(batch_folders(spark, path)[1]) == 2
    drop_merged(spark, path)
    rows = read_batches(spark, path)
    one = rows.filter("user_id = 42").select(F.lit("user").alias("seen"), "*")
    return rows.select(F.lit("all").alias("seen"), "*").unionAll(seen).unionAll(one)
