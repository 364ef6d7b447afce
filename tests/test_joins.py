import contextlib
import datetime as dt
import io
import random

import pytest
from pyspark.sql import functions as F

from trackfuse.operators import enrich, interval, skew
from trackfuse.operators.interval import DAY, interval_join
from trackfuse.sources.scans import calendar_table


def plan_text(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


FACTS = [(1, "a"), (2, "b"), (3, None), (4, "c"), (5, "a")]
DIM = [("a", 10), ("b", 20), ("b", 21), (None, 99)]
JOINED = [(1, "a", 10), (2, "b", 20), (2, "b", 21), (3, None, None), (4, "c", None), (5, "a", 10)]


@pytest.mark.parametrize("max_rows", [1000, 0])
def test_left_joins(spark, rows, max_rows):
    facts = spark.createDataFrame(FACTS, "n int, k string")
    dim = spark.createDataFrame(DIM, "k string, v int")
    assert rows(enrich.id_map_left(facts, dim, "k", max_rows=max_rows), "n", "k", "v") == sorted(JOINED, key=repr)
    other = dim.withColumnRenamed("k", "dim_k")
    got = enrich.lookup_left(facts, other, "k", "dim_k", {"v": "w"}, max_rows=max_rows)
    assert sorted(got.columns) == ["k", "n", "w"]
    assert rows(got, "n", "k", "w") == sorted(JOINED, key=repr)


@pytest.mark.parametrize(
    "left,right",
    [("string", "string"), ("int", "int"), ("int", "long"), ("long", "int"), ("string", "int"), ("double", "int")],
)
def test_both_sides_of_the_size_limit_behave_alike(spark, left, right):
    """Rows, column order, types and refused keys."""
    facts = spark.sql(f"SELECT n, cast(k AS {left}) k, n * 2 more FROM VALUES (1, '1'), (2, '2'), (3, null) t(n, k)")
    dim = spark.sql(f"SELECT v, cast(k AS {right}) k FROM VALUES (10, '1'), (11, '1'), (12, '9') t(v, k)")
    plan = facts.selectExpr("n", "k", "timestamp_ntz'2026-03-01' planned")
    obs = dim.selectExpr("v", "k seen_k", "timestamp_ntz'2026-03-01 01:00:00' seen")
    ways = {
        "join": [lambda most=most: enrich.id_map_left(facts, dim, "k", max_rows=most) for most in (1000, 0)],
        "lookup": [
            lambda most=most: enrich.lookup_left(facts, dim.withColumnRenamed("k", "d"), "k", "d", {"v": "w"}, max_rows=most)
            for most in (1000, 0)
        ],
        "average": [
            lambda most=most: enrich.key_average_join(facts, dim.filter("v <> 11"), "k", "v", max_rows=most)
            for most in (1000, 0)
        ],
        "interval": [
            lambda most=most: interval_join(plan, obs, ("k", "seen_k"), "planned", "seen", max_broadcast_rows=most)
            for most in (100_000, 0)
        ],
    }
    for name, (small, large) in ways.items():
        if left != right and {left, right} != {"int", "long"}:
            for way in (small, large):
                with pytest.raises(ValueError, match="one type"):
                    way()
            continue
        one, two = small(), large()
        assert one.dtypes == two.dtypes, name
        assert sorted(map(str, one.collect())) == sorted(map(str, two.collect())), name


@pytest.mark.parametrize("n", [5, 500])
def test_left_join_never_takes_a_condition(spark, n):
    left = spark.range(100).selectExpr("'hot' k", "id v")
    right = spark.range(n).selectExpr("'hot' k", "id w")
    with pytest.raises(ValueError, match="condition"):
        skew.salted_join(left, right, ["k"], "left", F.col("v") > F.col("w"), min_rows=10)


def test_shared_names_are_refused_at_any_size(spark):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    for most in (1000, 0):
        with pytest.raises(ValueError, match="rename"):
            skew.sized_join(df, df, ["k"], max_rows=most)


def test_nothing_is_repeated_where_nothing_is_heavy(spark):
    left, right = spark.range(100).selectExpr("id k", "id v"), spark.range(100).selectExpr("id k", "id w")
    text = plan_text(skew.salted_join(left, right, ["k"], measured_large=True))
    assert "Generate" not in text and "BroadcastHashJoin" not in text
    hot = plan_text(skew.salted_join(left.withColumn("k", F.lit(1)), right.selectExpr("int(k) k", "w"), ["k"], min_rows=10))
    assert "Generate" in hot


def test_weights_of_many_entities(spark):
    df = spark.range(1000).selectExpr("if(id % 3 = 0, null, id % 50) k", "id")
    for most in (1000, 0):
        got = enrich.inverse_count_weight(df, "k", min_rows=10, max_rows=most)
        assert got.columns == ["k", "id", "sample_weight"] and got.count() == 1000
        assert got.groupBy("k").agg(F.sum("sample_weight").alias("w")).filter("abs(w - 1) > 1e-9").isEmpty()


def test_plan_bounds_the_observations(spark, tmp_path):
    """Epoch seconds are bounded as stored, so files without such times are not read."""
    spark.range(100).selectExpr("id oid", "id * 86400 seconds").write.parquet(str(tmp_path / "o"))
    obs = spark.read.parquet(str(tmp_path / "o")).withColumn("seen", F.timestamp_seconds("seconds"))
    plan = spark.range(5).selectExpr("id pid", "timestamp_seconds(id * 86400) planned")
    for limit in (100_000, 0):
        joined = interval_join(
            plan, obs, ("pid", "oid"), "planned", "seen", max_broadcast_rows=limit, obs_epoch="seconds"
        )
        text = plan_text(joined)
        assert "GreaterThanOrEqual(seconds,-86400)" in text and "LessThanOrEqual(seconds,432000)" in text
        assert joined.count() == 5
    assert interval_join(plan.limit(0), obs, ("pid", "oid"), "planned", "seen", obs_epoch="seconds").count() == 0


def test_size_check(spark):
    few = spark.createDataFrame([("x" * 1000, 1)] * 10, "s string, n int")
    assert skew.fits_broadcast(few)
    assert not skew.fits_broadcast(few, max_rows=9)
    assert not skew.fits_broadcast(few, max_bytes=9_000)
    assert skew.fits_broadcast(few.limit(0))
    assert not skew.fits_broadcast(few.select(F.array("s").alias("a")), max_bytes=9_000)


def test_hot_keys_finds_heavy_keys_only(spark):
    heavy = spark.range(30_000).select(F.lit("heavy").alias("k"))
    light = spark.range(60_000).select(F.col("id").cast("string").alias("k"))
    both = heavy.unionAll(light).repartition(8)
    got = {r._key: r._parts for r in skew.hot_keys(both, ["k"], min_rows=10).collect()}
    key = both.select(F.xxhash64(F.lit("heavy"))).first()[0]
    assert got.pop(key) in range(333, 340)
    assert not got
    assert {r._parts for r in skew.hot_keys(both, ["k"], min_rows=10_000).collect()} == {3}
    assert skew.hot_keys(both.limit(0), ["k"], min_rows=10).count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join_under_skew(spark, how):
    # A third of the left rows are exact copies of one row, another third have no key.
    left = spark.range(3000).selectExpr(
        "CASE id % 3 WHEN 0 THEN 'hot' WHEN 1 THEN null ELSE string(id) END k", "CASE id % 3 WHEN 0 THEN 0 ELSE id END v"
    )
    right = spark.range(600).selectExpr("CASE id % 3 WHEN 0 THEN 'hot' WHEN 1 THEN null ELSE string(id) END k", "id w")
    salted = skew.salted_join(left, right, ["k"], how, min_rows=10, measured_large=True)
    assert skew._heavy(left, right, ["k"], False, min_rows=10).filter("_lp > 1 AND _rp > 1").count() == 2
    plain = left.join(right, "k", how)
    assert salted.columns == ["k", "v", "w"] == plain.columns
    assert salted.exceptAll(plain).isEmpty() and plain.exceptAll(salted).isEmpty()


def test_salted_join_spreads_the_hot_key(spark):
    left = spark.range(50_000).selectExpr("'hot' k", "id v")
    right = spark.range(1).selectExpr("'hot' k", "1 w")
    joined = skew.salted_join(left, right, ["k"], "left", min_rows=10, measured_large=True)
    # AQE may merge small partitions again: look at the join without it.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(r["count"] for r in sizes) < 35_000


def test_salted_join_of_int_and_long_keys(spark):
    left = spark.range(3000).selectExpr("int(id % 3) k", "id v")
    right = spark.range(3).selectExpr("id k", "id w")
    joined = skew.salted_join(left, right, ["k"], min_rows=10)
    assert joined.count() == 3000 and joined.filter("k <> w").isEmpty()
    with pytest.raises(ValueError, match="one type"):
        skew.salted_join(left, right.selectExpr("string(k) k", "w"), ["k"])


def test_salted_join_null_safe(spark, rows):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    right = spark.createDataFrame([(None, 7), ("a", 8)], "k string, w int")
    assert rows(skew.salted_join(left, right, ["k"], "left", null_safe=True, min_rows=0)) == [("a", 2, 8), (None, 1, 7)]


NOON = dt.datetime(2026, 3, 1, 12)
HOUR = dt.timedelta(hours=1)
SECOND = dt.timedelta(seconds=1)


@pytest.mark.parametrize("limit", [1000, 0])
def test_interval_bounds(spark, rows, limit):
    plan = spark.createDataFrame(
        [("p1", "a", NOON), ("p2", "a", NOON + 30 * HOUR), ("p3", None, NOON), ("p4", "b", None)],
        "plan string, pid string, planned timestamp_ntz",
    )
    obs = spark.createDataFrame(
        [
            (1, "a", NOON - 24 * HOUR),
            (2, "a", NOON - 24 * HOUR - SECOND),
            (3, "a", NOON + 24 * HOUR),
            (4, "a", NOON + 24 * HOUR + SECOND),
            (5, None, NOON),
            (6, "a", None),
            (7, "b", NOON),
        ],
        "n int, oid string, seen timestamp_ntz",
    )
    got = interval_join(plan, obs, ("pid", "oid"), "planned", "seen", max_broadcast_rows=limit)
    assert got.columns == [*plan.columns, *obs.columns]
    assert rows(got, "plan", "n") == [("p1", 1), ("p1", 3), ("p2", 3), ("p2", 4)]


@pytest.mark.parametrize("limit", [100_000, 0])
@pytest.mark.parametrize("before,after", [(3600, 7200), (0, 0), (DAY, DAY), (1, 0)])
def test_interval_equals_its_definition(spark, before, after, limit):
    rnd = random.Random(before + after)
    start = dt.datetime(1969, 12, 30)

    def some(n):
        # Half of all rows belong to one asset.
        return [
            (i, rnd.choice(["hot", "hot", "a", "b"]), start + dt.timedelta(seconds=rnd.randrange(4 * DAY), microseconds=i))
            for i in range(n)
        ]

    shared = [(1000 + i, "hot", start + dt.timedelta(hours=i)) for i in range(20)]
    plan, obs = some(60) + shared, some(200) + shared
    expected = sorted(
        (p[0], o[0])
        for p in plan
        for o in obs
        if p[1] == o[1] and p[2] - dt.timedelta(seconds=before) <= o[2] <= p[2] + dt.timedelta(seconds=after)
    )
    got = interval_join(
        spark.createDataFrame(plan, "p int, pid string, planned timestamp_ntz"),
        spark.createDataFrame(obs, "o int, oid string, seen timestamp_ntz"),
        ("pid", "oid"), "planned", "seen", before, after, max_broadcast_rows=limit, min_rows=3,
    )
    assert sorted((r.p, r.o) for r in got.collect()) == expected


def test_interval_refuses_shared_names(spark):
    df = spark.createDataFrame([(NOON,)], "ts timestamp_ntz")
    with pytest.raises(ValueError, match="ts"):
        interval_join(df, df, ("ts", "ts"), "ts", "ts")


def test_small_plan_leaves_observations_unshuffled(spark, tmp_path):
    spark.range(10).selectExpr("id pid", "timestamp_ntz'2026-03-01' planned").write.parquet(str(tmp_path / "p"))
    spark.range(1000).selectExpr("id % 10 oid", "timestamp_ntz'2026-03-01' seen").write.parquet(str(tmp_path / "o"))
    plan, obs = (spark.read.parquet(str(tmp_path / n)) for n in "po")
    text = plan_text(interval_join(plan, obs, ("pid", "oid"), "planned", "seen"))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text
    large = plan_text(interval_join(plan, obs, ("pid", "oid"), "planned", "seen", max_broadcast_rows=0))
    assert "SortMergeJoin" in large and "CartesianProduct" not in large and "NestedLoop" not in large


def test_calendar_flag(spark, rows):
    days = calendar_table(spark, ["2026-12-25", "2026-12-25"])
    df = spark.sql(
        "SELECT 1 n, timestamp_ntz'2026-12-25 23:59:59' ts UNION ALL SELECT 2, timestamp_ntz'2026-12-26' UNION ALL SELECT 3, null"
    )
    got = enrich.calendar_flag(df, days, "ts", "holiday_date", "is_holiday")
    assert rows(got, "n", "is_holiday") == [(1, 1), (2, 0), (3, 0)]
    assert got.columns == ["n", "ts", "is_holiday"]


def test_averages(spark, rows):
    df = spark.sql("SELECT * FROM VALUES ('a', 1), ('a', 3), ('b', null), ('c', 10), (null, 6) t(k, v)")
    means = enrich.key_average(df, "k", "v", "mean")
    assert rows(means) == [("a", 2.0), ("b", None), ("c", 10.0), (None, 6.0)]
    assert spark.range(1).select(enrich.mean_of_means(means, "mean")).first()[0] == 6.0
    facts = spark.sql("SELECT * FROM VALUES ('a'), ('b'), ('z'), (null) t(k)")
    got = enrich.key_average_join(facts, means, "k", "mean")
    assert rows(got, "k", "mean") == [("a", 2.0), ("b", 6.0), ("z", 6.0), (None, 6.0)]


def test_averages_of_empty_history(spark, rows):
    empty = enrich.key_average(spark.sql("SELECT 'a' k, 1 v WHERE false"), "k", "v", "mean")
    got = enrich.key_average_join(spark.sql("SELECT 'a' k"), empty, "k", "mean")
    assert rows(got) == [("a", None)]


def test_weights_sum_to_one_per_entity(spark):
    df = spark.range(1000).selectExpr("nullif(id % 7 % 4, 3) k", "id")
    got = enrich.inverse_count_weight(df, "k").groupBy("k").agg(F.sum("sample_weight").alias("w")).collect()
    assert len(got) == 4
    assert all(r.w == pytest.approx(1.0) for r in got)


@pytest.mark.parametrize("bounds", [{}, {"max_broadcast_rows": 0}])
@pytest.mark.parametrize("epochs", [False, True])
def test_interval_join_in_the_night_clocks_go_back(spark, rows, bounds, epochs):
    """01:30 comes twice in this zone; the bounds of the read must mean the right one."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        second = 1_793_514_600.25  # 06:30 UTC, 01:30 for the second time
        plan = spark.range(1).select(F.lit("a").alias("p"), F.timestamp_seconds(F.lit(second)).alias("planned"))
        times = [second - 300.5, second + 300, second + 300.25, second + 301, second - 3600 * 2]
        obs = spark.createDataFrame([("a", t) for t in times], "o string, epoch double")
        obs = obs.withColumn("seen", F.timestamp_micros((F.col("epoch") * 1_000_000).cast("bigint")))
        how = {**bounds, "obs_epoch": "epoch"} if epochs else bounds
        found = interval_join(plan, obs, ("p", "o"), "planned", "seen", 600, 300, **how)
        assert rows(found, "epoch") == [(second - 300.5,), (second + 300,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize("kinds", [("timestamp_ntz", "timestamp_ntz"), ("timestamp", "timestamp_ntz"), ("timestamp_ntz", "timestamp")])
def test_interval_join_of_zone_less_times(spark, rows, kinds):
    """In the night clocks go forward, with bounds and bins, each way gives what the plain condition gives."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        night = dt.datetime(2026, 3, 8)
        plans = [("a", night + dt.timedelta(minutes=m)) for m in range(0, 360, 35)]
        seen = [("a", night + dt.timedelta(minutes=m)) for m in range(0, 360, 7)]
        plan = spark.createDataFrame(plans, "p string, planned timestamp_ntz").withColumn("planned", F.col("planned").cast(kinds[0]))
        obs = spark.createDataFrame(seen, "o string, seen timestamp_ntz").withColumn("seen", F.col("seen").cast(kinds[1]))
        within = F.expr("seen BETWEEN planned - INTERVAL 900 SECOND AND planned + INTERVAL 900 SECOND")
        wanted = rows(plan.join(obs, (F.col("p") == F.col("o")) & within), "planned", "seen")
        assert rows(interval_join(plan, obs, ("p", "o"), "planned", "seen", 900, 900), "planned", "seen") == wanted
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_plans_are_repeated_for_two_bins_and_ids_shuffled_once(spark, monkeypatch):
    plan = spark.sql("SELECT concat('a', id) AS craft, timestamp '2024-01-01' + make_interval(0, 0, 0, 0, id) AS due FROM range(50)")
    seen = spark.sql("SELECT concat('a', id) AS code, timestamp '2024-01-01 01:00:00' AS at FROM range(50)")
    sides = []

    def record(left, right, *args, **more):
        sides.extend((left, right))
        return skew.salted_join(left, right, *args, **more)

    monkeypatch.setattr(interval, "salted_join", record)
    found = interval.interval_join(plan, seen, ("craft", "code"), "due", "at", max_broadcast_rows=0)
    assert found.columns == ["craft", "due", "code", "at"] and found.filter("craft = code").count() == 26
    assert sides[1].count() == 100 and set(sides[0].columns) == {"_id", "_bin", "at"}
    assert set(sides[1].columns) == {"_id", "_bin", "due"}
