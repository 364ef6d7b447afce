import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from trackfuse.functions import features as feat
from trackfuse.functions.geo import EARTH_RADIUS_KM, bearing_deg, haversine_km
from trackfuse.operators.project import before_event, drop_derived, key_filter, project_contract, rename_drop

POINTS = [
    ("same", 10.0, 20.0, 10.0, 20.0, 0.0, 0.0),
    ("poles", 90.0, 0.0, -90.0, 0.0, math.pi * EARTH_RADIUS_KM, 180.0),
    ("date line", 0.0, 179.5, 0.0, -179.5, math.radians(1) * EARTH_RADIUS_KM, 90.0),
    ("antipodes", 0.0, 0.0, 0.0, 180.0, math.pi * EARTH_RADIUS_KM, 90.0),
    ("north", 0.0, 0.0, 1.0, 0.0, math.radians(1) * EARTH_RADIUS_KM, 0.0),
    ("west", 0.0, 0.0, 0.0, -1.0, math.radians(1) * EARTH_RADIUS_KM, 270.0),
]


@pytest.fixture(scope="module")
def points(spark):
    return spark.createDataFrame(
        [p[:5] for p in POINTS] + [("null", 1.0, None, 2.0, 3.0)],
        "name string, a double, b double, c double, d double",
    )


def test_distance_and_bearing(points):
    ends = [F.col(c) for c in "abcd"]
    back = [F.col(c) for c in "cdab"]
    got = {
        r.name: r
        for r in points.select(
            "name",
            haversine_km(*ends).alias("km"),
            haversine_km(*back).alias("back"),
            bearing_deg(*ends).alias("to"),
        ).collect()
    }
    assert got["null"].km is None and got["null"].to is None
    for name, *_, km, to in POINTS:
        assert got[name].km == pytest.approx(km, abs=1e-6)
        assert got[name].km == pytest.approx(got[name].back, abs=1e-9)
        assert got[name].to == pytest.approx(to, abs=1e-6)


def test_distance_and_bearing_stay_in_range(spark):
    grid = spark.range(20000).selectExpr(
        "(rand(1) - 0.5) * 180 a", "(rand(2) - 0.5) * 360 b", "(rand(3) - 0.5) * 180 c", "(rand(4) - 0.5) * 360 d"
    )
    ends = [F.col(c) for c in "abcd"]
    got = grid.agg(
        F.min(haversine_km(*ends)), F.max(haversine_km(*ends)), F.min(bearing_deg(*ends)), F.max(bearing_deg(*ends))
    ).first()
    assert got[0] >= 0 and got[1] <= math.pi * EARTH_RADIUS_KM and got[2] >= 0 and got[3] < 360


def test_time_features(spark):
    sunday = dt.datetime(2026, 3, 1, 0, 0)
    df = spark.createDataFrame([(sunday, 0), (None, 5)], "ts timestamp_ntz, epoch long")
    got = df.select(
        feat.hour_of_day(F.col("ts")),
        feat.day_of_week(F.col("ts")),
        feat.month_of_year(F.col("ts")),
        feat.seconds_to_event(F.col("ts"), F.unix_seconds(F.lit("2026-03-01 00:01:00").cast("timestamp"))),
        feat.event_date(F.col("ts")),
        feat.epoch_to_ts(F.col("epoch")).cast("string"),
    ).collect()
    assert tuple(got[0]) == (0, 1, 3, -60, sunday.date(), "1970-01-01 00:00:00")
    assert tuple(got[1])[:5] == (None,) * 5


def test_small_functions(spark):
    df = spark.createDataFrame([(True, "'a'b'", None, 2.0), (None, None, 1.0, 2.0)], "f boolean, q string, x double, y double")
    got = df.select(
        feat.bool_to_int(F.col("f")),
        feat.strip_quotes(F.col("q")),
        feat.null_default(F.col("x"), F.col("y")),
        feat.flag_not_null(F.col("x")),
    ).collect()
    assert [tuple(r) for r in got] == [(1, "ab", 2.0, 0), (None, None, 1.0, 1)]


def test_entity_id_skips_nulls(spark):
    df = spark.sql("SELECT 'T1' a, string(null) b, timestamp'2026-03-01 10:00:00' c UNION ALL SELECT null, null, null")
    got = [r[0] for r in df.select(feat.entity_id(*(F.col(c) for c in "abc"))).collect()]
    assert got == ["T1_2026-03-01 10:00:00", ""]


def test_non_finite(spark):
    df = spark.createDataFrame(
        [(float("nan"), 1), (float("inf"), 2), (float("-inf"), 3), (None, 4), (1.5, 5)], "v double, n int"
    )
    assert [tuple(r) for r in feat.non_finite_to_null(df).orderBy("n").collect()] == [
        (None, 1), (None, 2), (None, 3), (None, 4), (1.5, 5),
    ]


def test_before_event(spark, rows):
    df = spark.sql("SELECT * FROM VALUES (1, 2), (2, 2), (3, 2), (4, null) t(seen, done)")
    assert rows(before_event(df, "seen", "done")) == [(1, 2)]
    assert rows(before_event(df, "seen", "done", keep_open=True)) == [(1, 2), (4, None)]


def test_projections(spark):
    df = spark.sql("SELECT 1 a, 2 b_idx, 3 b_vec, 4 features, 5 prediction, 6 dim_key")
    assert drop_derived(df).columns == ["a", "prediction", "dim_key"]
    assert rename_drop(df, {"a": "x"}, ["dim_key"]).columns == ["x", "b_idx", "b_vec", "features", "prediction"]
    assert project_contract(df, ["prediction", "a"]).columns == ["prediction", "a"]
    with pytest.raises(Exception, match="missing"):
        project_contract(df, ["missing"])


def test_key_filter_is_no_sql(spark):
    df = spark.createDataFrame([("x' OR '1'='1",), ("x",)], "k string")
    assert key_filter(df, "k", "x' OR '1'='1").count() == 1
