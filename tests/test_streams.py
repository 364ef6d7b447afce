import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from trackfuse.operators.enrich import id_map_left, key_average_join
from trackfuse.operators.interval import DAY, drop_repeats, interval_join, watermark
from trackfuse.session import ROCKSDB, small_state
from trackfuse.sources import scans
from trackfuse.sources.scans import as_glob, ordered_stream, read_stream, table_scan, table_stream, topic_options
from trackfuse.streaming.sinks import (
    append_files,
    append_stream,
    await_any,
    console_sink,
    ensure_tables,
    fan_out,
    finish,
    key_value_json,
    message_sink,
    metrics_json,
    multi_sink,
    overwrite_table,
    remove_versions,
)

ONCE = {"availableNow": True}
START = dt.datetime(2026, 3, 1)
PLAN = "pid string, planned timestamp, p int"
OBS = "oid string, seen timestamp, o int"


def hours(n):
    return START + dt.timedelta(hours=n)


def put(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))


@pytest.fixture
def feeds(spark, tmp_path):
    """Six days of plans and observations, one file a day each, in time order."""
    plans = [(f"a{i % 3}", hours(i * 4), i) for i in range(36)]
    seen = [(f"a{i % 3}" if i % 2 else "a0", hours(i), i) for i in range(144)]
    for folder, rows, schema in (("plan", plans, PLAN), ("obs", seen, OBS)):
        for day in range(6):
            part = [r for r in rows if hours(24 * day) <= r[1] < hours(24 * day + 24)]
            put(spark, tmp_path / folder, part, schema)

    def open_feeds(**options):
        return [
            table_stream(spark, str(tmp_path / n), spark.read.parquet(str(tmp_path / n)).schema, **options)
            for n in ("plan", "obs")
        ]

    return open_feeds, [spark.read.parquet(str(tmp_path / n)) for n in ("plan", "obs")]


def join(plan, obs, delay=None, **how):
    return interval_join(plan, obs, ("pid", "oid"), "planned", "seen", DAY, DAY, delay, **how)


@pytest.mark.parametrize("salts,by_history", [(1, False), (3, False), (1, True)])
def test_stream_join_equals_batch_and_forgets(spark, feeds, tmp_path, rows, salts, by_history):
    open_feeds, tables = feeds
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == ROCKSDB
    history = {"history": tables[1], "min_rows": 100_000} if by_history else {}
    joined = join(*open_feeds(per_batch=1), "8 hours", stream_salts=salts, **history)
    running = append_files(joined, str(tmp_path / "out"), str(tmp_path / "ck"), trigger=ONCE)
    finish(running)
    expected = rows(join(*tables), "p", "o")
    assert rows(spark.read.parquet(str(tmp_path / "out")), "p", "o") == expected and len(expected) > 300
    states = [p["stateOperators"][0] for p in running.recentProgress if p["stateOperators"]]
    assert sum(s["numRowsRemoved"] for s in states) > 0
    # A plan is kept at most twice per salt, once for each bin it touches.
    assert max(s["numRowsTotal"] for s in states) < (36 * 2 * salts + 144) * 0.9
    assert states[-1]["numRowsTotal"] < states[0]["numRowsUpdated"] * 6


def test_one_batch_keeps_a_plan_twice_and_splits_heavy_ids_only(spark, tmp_path, rows):
    plan = spark.range(100).selectExpr("concat('a', id) pid", "timestamp'2026-03-01' + make_dt_interval(0, int(id)) planned", "int(id) p")
    plan.write.parquet(str(tmp_path / "plan"))
    put(spark, tmp_path / "obs", [("a0", hours(0), 1)] * 30 + [("a1", hours(1), 2)], OBS)
    got = {}
    for min_rows in (100_000, 10):
        feeds = [
            table_stream(spark, str(tmp_path / n), spark.read.parquet(str(tmp_path / n)).schema) for n in ("plan", "obs")
        ]
        history = spark.read.parquet(str(tmp_path / "obs"))
        joined = join(*feeds, "8 hours", history=history, min_rows=min_rows)
        out = str(tmp_path / f"out{min_rows}")
        running = append_files(joined, out, str(tmp_path / f"ck{min_rows}"), trigger=ONCE)
        finish(running)
        states = [s for p in running.recentProgress for s in p["stateOperators"]]
        got[min_rows] = max(s["numRowsUpdated"] for s in states)
        assert rows(spark.read.parquet(out), "p", "o") == [(0, 1)] * 30 + [(1, 2)]
    # 200 plan rows and 31 observations; the heavy id has its two rows once more for each further piece.
    assert got[100_000] <= 231 < got[10] <= 231 + 2 * 3


def test_stored_rows_come_in_the_order_of_their_times(spark, tmp_path, rows):
    """Nothing is late, exact copies and rows without a time take part, and old rows leave the state."""
    at = "timestamp'2026-03-01' + make_dt_interval(0, int(id * 37 % 200) * 6)"
    plan = spark.range(200).selectExpr("concat('a', id % 7) pid", f"if(id = 5, NULL, {at}) planned", "int(id) p")
    seen = spark.range(400).selectExpr("concat('a', id % 7) oid", f"if(id = 9, NULL, {at}) seen", "int(id) o")
    for name, df in (("plan", plan), ("seen", seen.unionAll(seen.limit(20)))):
        df.repartition(3).write.parquet(str(tmp_path / name))
    tables = [spark.read.parquet(str(tmp_path / name)) for name in ("plan", "seen")]
    feeds = [
        ordered_stream(df, time, str(tmp_path / f"{time}_in_order"), 20, 2, key)
        for df, time, key in zip(tables, ("planned", "seen"), ("pid", None), strict=True)
    ]
    with small_state(spark):
        running = append_files(join(*feeds, "8 hours"), str(tmp_path / "out"), str(tmp_path / "ck"), trigger=ONCE)
    finish(running)
    expected = rows(join(*tables), "p", "o")
    assert rows(spark.read.parquet(str(tmp_path / "out")), "p", "o") == expected and len(expected) > 100
    states = [s for p in running.recentProgress for s in p["stateOperators"]]
    assert len(states) >= 9 and max(s["numRowsTotal"] for s in states) < 820 / 3
    assert spark.conf.get("spark.sql.streaming.minBatchesToRetain") != "2"


def test_a_store_without_file_times_gives_one_batch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scans, "_dated_by_place", lambda *_: False)
    stored = spark.range(100).selectExpr("id", "timestamp_seconds(id) at")
    feed = ordered_stream(stored, "at", str(tmp_path / "in_order"), 4, 1)
    running = append_files(feed, str(tmp_path / "out"), str(tmp_path / "ck"), trigger=ONCE)
    finish(running)
    assert [p["numInputRows"] for p in running.recentProgress if p["numInputRows"]] == [100]


def test_refresh_under_a_running_stream(spark, tmp_path, rows):
    """The stream goes on with the averages it began with, and readers of the old files are not disturbed."""

    def refresh(value):
        means = spark.createDataFrame([("a", value)], "k string, mean double")
        overwrite_table(means, "means_now", path=str(tmp_path / "means"))

    refresh(1.0)
    put(spark, tmp_path / "in", [("a", 1)], "k string, n int")
    feed = table_stream(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema)
    old = spark.table("means_now")
    averaged = key_average_join(feed, old, "k", "mean")
    running = append_files(averaged, str(tmp_path / "out"), str(tmp_path / "ck"))
    running.processAllAvailable()
    refresh(2.0)
    put(spark, tmp_path / "in", [("a", 2)], "k string, n int")
    running.processAllAvailable()
    running.stop()
    assert rows(spark.read.parquet(str(tmp_path / "out")), "n", "mean") == [(1, 1.0), (2, 1.0)]
    assert rows(old) == [("a", 1.0)] and rows(spark.table("means_now")) == [("a", 2.0)]
    overwrite_table(spark.createDataFrame([(1,)], "other int"), "means_now", path=str(tmp_path / "means"))
    assert rows(spark.table("means_now")) == [(1,)]


def test_late_rows_are_dropped(spark, tmp_path, rows):
    plan, obs = tmp_path / "plan", tmp_path / "obs"
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")

    def run():
        feeds = [table_stream(spark, str(f), spark.read.parquet(str(f)).schema) for f in (plan, obs)]
        running = append_files(join(*feeds, "8 hours"), out, ck, trigger=ONCE)
        finish(running)
        return sum(
            s["numRowsDroppedByWatermark"] for p in running.recentProgress for s in p["stateOperators"]
        )

    put(spark, plan, [("a", hours(0), 1), ("a", hours(100), 2)], PLAN)
    put(spark, obs, [("a", hours(1), 1), ("a", hours(100), 2)], OBS)
    assert run() == 0
    put(spark, obs, [("a", hours(2), 3), ("a", hours(99), 4)], OBS)
    assert run() == 1
    assert rows(spark.read.parquet(out), "p", "o") == [(1, 1), (2, 2), (2, 4)]


def test_restart_goes_on_from_checkpoint(spark, tmp_path, rows):
    plan, obs = tmp_path / "plan", tmp_path / "obs"
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    put(spark, plan, [("a", hours(0), 1)], PLAN)
    put(spark, obs, [("a", hours(1), 1)], OBS)
    for extra in range(3):
        feeds = [table_stream(spark, str(f), spark.read.parquet(str(f)).schema) for f in (plan, obs)]
        finish(append_files(join(*feeds, "8 hours"), out, ck, trigger=ONCE))
        if extra == 0:
            put(spark, obs, [("a", hours(2), 2)], OBS)
    assert rows(spark.read.parquet(out), "p", "o") == [(1, 1), (1, 2)]


def test_repeated_polls_can_be_dropped(spark, tmp_path, rows):
    put(spark, tmp_path / "in", [("a", hours(0), 1), ("a", hours(0), 1), ("a", hours(0), 2)], OBS)
    feed = table_stream(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema)
    once = drop_repeats(watermark(feed, "seen"), ["oid", "seen", "o"])
    finish(append_files(once, str(tmp_path / "out"), str(tmp_path / "ck"), trigger=ONCE))
    assert rows(spark.read.parquet(str(tmp_path / "out")), "o") == [(1,), (2,)]
    assert rows(drop_repeats(spark.read.parquet(str(tmp_path / "in")), ["oid", "seen", "o"]), "o") == [(1,), (2,)]


@pytest.mark.parametrize("max_rows", [1000, 0])
def test_stream_static_joins(spark, tmp_path, rows, max_rows):
    put(spark, tmp_path / "in", [("a", 1), ("b", 2), (None, 3), ("z", 4)], "k string, n int")
    feed = table_stream(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema)
    dim = spark.createDataFrame([("a", 10.0), ("b", 20.0), ("b", 30.0)], "k string, v double")
    means = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "k string, mean double")
    out = key_average_join(id_map_left(feed, dim, "k", max_rows=max_rows), means, "k", "mean", max_rows=max_rows)
    finish(append_files(out, str(tmp_path / "out"), str(tmp_path / "ck"), trigger=ONCE))
    expected = {(1, 10.0, 1.0), (2, 20.0, 3.0), (2, 30.0, 3.0), (3, None, 2.0), (4, None, 2.0)}
    assert set(rows(spark.read.parquet(str(tmp_path / "out")), "n", "v", "mean")) == expected


def test_stream_of_one_file_and_of_a_folder(spark, tmp_path):
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "t.parquet"))
    single = next((tmp_path / "t.parquet").glob("part-*"))
    for n, path in enumerate((str(tmp_path / "t.parquet"), str(single))):
        feed = read_stream(spark, "parquet", {}, spark.read.parquet(path).schema, as_glob(path))
        finish(append_files(feed, str(tmp_path / f"out{n}"), str(tmp_path / f"ck{n}"), trigger=ONCE))
        assert spark.read.parquet(str(tmp_path / f"out{n}")).count() == 5


@pytest.fixture
def numbers(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "numbers"))
    return table_stream(spark, str(tmp_path / "numbers"), spark.range(1).schema)


def test_tables_by_name(spark, numbers, tmp_path):
    """One stream appends to a partitioned table, another reads it by its name, in bounded batches."""
    named = numbers.selectExpr("id", "id % 2 AS odd")
    where = {"path": str(tmp_path / "t"), "trigger": ONCE, "partition_by": ["odd"]}
    finish(append_stream(named, "chained", str(tmp_path / "ck"), **where))
    assert table_scan(spark, "chained").count() == 5
    again = append_files(table_stream(spark, "chained", per_batch=1), str(tmp_path / "out"), str(tmp_path / "ck2"), trigger=ONCE)
    finish(again)
    assert spark.read.parquet(str(tmp_path / "out")).exceptAll(spark.table("chained")).isEmpty()
    assert sum(p["numInputRows"] > 0 for p in again.recentProgress) > 1
    assert topic_options("s", "t", per_batch=7)["maxOffsetsPerTrigger"] == "7"
    assert "maxOffsetsPerTrigger" not in topic_options("s", "t")


def test_append_to_table(spark, numbers, tmp_path):
    for _ in range(2):
        finish(append_stream(numbers, "appended", str(tmp_path / "ck"), path=str(tmp_path / "t"), trigger=ONCE))
    assert spark.table("appended").count() == 5


def test_multi_sink_and_wait(spark, numbers, tmp_path):
    queries = multi_sink(
        numbers,
        [
            lambda df: append_files(df, str(tmp_path / "a"), str(tmp_path / "ck_a"), trigger=ONCE),
            lambda df: message_sink(
                key_value_json(df, "id"), {"path": str(tmp_path / "b")}, str(tmp_path / "ck_b"), "json", ONCE
            ),
        ],
    )
    assert await_any(spark, 60)
    finish(*queries)
    assert spark.read.parquet(str(tmp_path / "a")).count() == 5
    assert {r.value for r in spark.read.json(str(tmp_path / "b")).collect()} == {f'{{"id":{i}}}' for i in range(5)}


def test_failed_sink_is_reported(spark, numbers, tmp_path):
    spark.streams.resetTerminated()
    bad = numbers.select(F.raise_error(F.lit("broken")).alias("x"))
    append_files(bad, str(tmp_path / "a"), str(tmp_path / "ck"), trigger=ONCE)
    with pytest.raises(Exception, match="broken"):
        await_any(spark, 60)
    spark.streams.resetTerminated()


def test_fan_out_repeats_no_batch(spark, numbers, tmp_path):
    def cached():
        return spark.sparkContext._jsc.sc().getPersistentRDDs().size()

    before = cached()
    paths = {"all": str(tmp_path / "all"), "twice": str(tmp_path / "twice")}
    shapes = {"all": lambda df: df, "twice": lambda df: df.selectExpr("id * 2 AS twice")}
    for _ in range(2):
        finish(fan_out(numbers, paths, shapes, str(tmp_path / "ck"), ONCE))
    assert spark.read.parquet(paths["all"]).count() == 5
    assert spark.read.parquet(paths["twice"]).agg(F.sum("twice")).first()[0] == 20
    assert cached() == before


def test_console_shows_only_the_first_rows(numbers, tmp_path, capfd):
    finish(console_sink(numbers, str(tmp_path / "ck"), 2, ONCE))
    shown = capfd.readouterr().out.splitlines()
    assert shown[0] == "batch 0" and len(shown) == 3 and json.loads(shown[1]).keys() == {"id"}


def test_key_value_json(spark):
    df = spark.sql("SELECT 7 n, string(null) gone, double('NaN') x, struct(1 AS a) s")
    row = key_value_json(df, "n").first()
    assert row.key == "7" and json.loads(row.value) == {"n": 7, "x": "NaN", "s": {"a": 1}}
    assert key_value_json(df, "n", ["n"]).first().value == '{"n":7}'


def test_tables(spark, tmp_path):
    schema = spark.range(1).selectExpr("id", "string(id) AS `a b`").schema
    for _ in range(2):
        ensure_tables(spark, {"shop.goods": schema}, root=str(tmp_path))
    spark.range(3).selectExpr("id", "'x'").write.insertInto("shop.goods")
    ensure_tables(spark, {"shop.goods": schema}, root=str(tmp_path))
    ensure_tables(spark, {"shop.parts": schema}, root=str(tmp_path), partition_by={"shop.parts": ["id"]})
    spark.range(3).selectExpr("'x'", "id").write.insertInto("shop.parts")
    one = spark.table("shop.parts").filter("id = 2")
    assert one.count() == 1 and "PartitionFilters: [isnotnull(id" in one._jdf.queryExecution().toString()
    assert spark.table("shop.goods").count() == 3 and spark.table("shop.goods").schema.names == ["id", "a b"]


def test_overwrite_and_metrics(spark, tmp_path):
    for n in (3, 2):
        overwrite_table(spark.range(n), "replaced", path=str(tmp_path / "t"))
    assert spark.table("replaced").count() == 2
    metrics_json(spark.sql("SELECT 'm' Model, 0.5 R2"), str(tmp_path / "m"))
    assert len(list((tmp_path / "m").glob("part-*.json"))) == 1


def test_console_query_shows_few_rows_and_proves_all(spark, monkeypatch):
    """Only a few lines come to the driver; a sink that shows other rows gives no result."""
    from trackfuse.queries import sinks

    folder, real, lines = "/root/testdata/sf0.001", sinks.console_sink, []

    def kept(df, checkpoint, rows, trigger, out, *more):
        return real(df, checkpoint, rows, trigger, lambda line: (lines.append(line), out(line)), *more)

    monkeypatch.setattr(sinks, "console_sink", kept)
    stored = spark.read.parquet(f"{folder}/orders.parquet").count()
    assert sinks.console(spark, folder).count() == stored > len(lines)

    def wrong(df, *more):
        return real(df.withColumn("o_orderkey", -df.o_orderkey), *more)

    monkeypatch.setattr(sinks, "console_sink", wrong)
    assert sinks.console(spark, folder).count() == 0


@pytest.mark.parametrize("managed", [True, False])
def test_overwriting_a_partitioned_table(spark, tmp_path, rows, managed):
    schema = spark.createDataFrame([], "a int, p string, q int").schema
    name, root = f"over{int(managed)}.t", None if managed else str(tmp_path / "store")
    ensure_tables(spark, {name: schema}, root=root, partition_by={name: ["p", "q"]})
    spark.sql(f"INSERT INTO {name} VALUES (1, 'x', 1), (2, 'y', 1), (3, NULL, 2)")
    old = spark.table(name)
    assert len(old.inputFiles()) == 3
    path = str(tmp_path / "versions")
    # Columns come in any order; the table keeps its own.
    overwrite_table(spark.createDataFrame([("z", 9, 4), (None, 7, 5)], "p string, q int, a int"), name, path=path)
    assert spark.table(name).columns == ["a", "p", "q"]
    assert rows(spark.table(name)) == [(4, "z", 9), (5, None, 7)]
    assert len(rows(old)) == 3
    assert [c.name for c in spark.catalog.listColumns(name) if c.isPartition] == ["p", "q"]
    spark.sql(f"INSERT INTO {name} VALUES (6, 'w', 1)")
    assert rows(spark.table(name)) == [(4, "z", 9), (5, None, 7), (6, "w", 1)]
    for i in range(3):
        overwrite_table(spark.createDataFrame([(i, "z", 9)], schema), name, path=path)
    assert len(remove_versions(spark, name, keep=1)) == 2 and remove_versions(spark, name, keep=1) == []
    assert rows(spark.table(name)) == [(2, "z", 9)]
    # Other columns, or other partitions: the table is made anew, and readers keep what they had.
    old = spark.table(name)
    assert old.inputFiles()
    overwrite_table(spark.createDataFrame([(1, 2.0)], "p int, b double"), name, path=path, partition_by=["p"])
    assert rows(spark.table(name)) == [(2.0, 1)] and rows(old) == [(2, "z", 9)]
    overwrite_table(spark.createDataFrame([(1, 2.0)], "p int, b double"), name, path=path, partition_by=[])
    assert not any(c.isPartition for c in spark.catalog.listColumns(name))
    assert rows(spark.table(name)) == [(1, 2.0)]


def test_readers_of_a_managed_table_outlive_other_columns(spark, tmp_path, rows):
    ensure_tables(spark, {"over2.t": spark.createDataFrame([], "a int").schema})
    spark.sql("INSERT INTO over2.t VALUES (1)")
    old = spark.table("over2.t")
    assert old.inputFiles()
    overwrite_table(spark.createDataFrame([("x",)], "b string"), "over2.t", path=str(tmp_path / "v"))
    assert rows(old) == [(1,)] and rows(spark.table("over2.t")) == [("x",)]


def test_partitions_listed_by_the_catalog_are_refused(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "a int, p string")
    df.write.partitionBy("p").saveAsTable("listed_by_catalog")
    with pytest.raises(ValueError, match="catalog lists"):
        overwrite_table(df, "listed_by_catalog", path=str(tmp_path))


def test_a_stream_appends_to_a_partitioned_table_that_is_replaced_later(spark, tmp_path, rows):
    put(spark, tmp_path / "in", [("a", 1), ("b", 2)], "p string, n int")
    feed = table_stream(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema)
    finish(append_stream(feed, "appended_parts", str(tmp_path / "ck"), path=str(tmp_path / "t"), trigger=ONCE, partition_by=["p"]))
    assert rows(spark.table("appended_parts"), "p", "n") == [("a", 1), ("b", 2)]
    overwrite_table(spark.createDataFrame([("c", 3)], "p string, n int"), "appended_parts", path=str(tmp_path / "v"))
    assert rows(spark.table("appended_parts"), "p", "n") == [("c", 3)]
