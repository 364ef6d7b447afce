import datetime as dt

import pytest
from pyspark.sql import functions as F

from trackfuse.functions.draws import fold_of, uniform_draw
from trackfuse.operators.averages import as_of_average, out_of_fold_join

ROWS = [("a", "e1", 1.0), ("a", "e1", 3.0), ("a", "e2", 10.0), ("a", "e3", None), ("b", "e1", 5.0), (None, "e2", 7.0), (None, "e4", 9.0)]


@pytest.fixture
def folded(spark):
    df = spark.createDataFrame(ROWS, "k string, e string, v double")
    return df.withColumn("f", F.substring("e", 2, 1).cast("int") - 1)


@pytest.mark.parametrize("how", [{}, {"max_rows": 0, "min_rows": 1}])
def test_means_of_the_other_folds(folded, rows, how):
    got = rows(out_of_fold_join(folded, "k", "v", "f", 4, "m", **how), "k", "e", "v", "m")
    # Means that fold 0 is told: a 10, null 8. To others: a 2 (fold 1) or 14/3, b 5, null 9 or 7.
    none = {"e2": (2.0 + 5.0 + 9.0) / 3, "e4": (14 / 3 + 5.0 + 7.0) / 3}
    means = {
        ("a", "e1"): 10.0, ("b", "e1"): (10.0 + 8.0) / 2, ("a", "e2"): 2.0, (None, "e2"): none["e2"], ("a", "e3"): 14 / 3,
        (None, "e4"): none["e4"],
    }
    got = [(k, e, v, pytest.approx(m)) for k, e, v, m in got]
    assert got == sorted(((k, e, v, means[k, e]) for k, e, v in ROWS), key=repr)


def test_no_row_depends_on_its_own_entity(spark, folded):
    """Whatever one entity's labels are, its own rows get the same value, to the last bit."""
    df = spark.range(400).selectExpr("concat('e', id % 40) e", "concat('k', id % 7) k", "rand(3) * 1e9 v").cache()
    df = df.withColumn("f", fold_of("e", 5))

    def means(rows):
        found = out_of_fold_join(rows, "k", "v", "f", 5, "m").filter("e = 'e3'").select("k", "m")
        return sorted(tuple(r) for r in found.collect())

    changed = df.withColumn("v", F.when(F.col("e") == "e3", F.col("v") * -1e6 + 0.1).otherwise(F.col("v")))
    assert means(df) == means(changed)
    with pytest.raises(ValueError, match="folds"):
        out_of_fold_join(df, "k", "v", "f", 1, "m")


def test_no_rows_and_no_labels(spark, rows):
    empty = spark.createDataFrame([], "k string, f int, v double")
    assert rows(out_of_fold_join(empty, "k", "v", "f", 3, "m")) == []
    unlabelled = spark.createDataFrame([("a", 0, None), (None, 1, None)], "k string, f int, v double")
    assert rows(out_of_fold_join(unlabelled, "k", "v", "f", 3, "m"), "k", "m") == [("a", None), (None, None)]


def at(hours):
    return dt.datetime(2026, 3, 1) + dt.timedelta(hours=hours)


HISTORY = [("a", at(0), 1.0), ("a", at(1), 3.0), ("a", at(30), 8.0), ("a", None, 99.0), ("a", at(2), None), (None, at(5), 6.0), ("b", at(90), 4.0)]
ASKED = [("a", at(0)), ("a", at(1)), ("a", at(1.5)), ("a", at(30)), ("a", at(400)), ("a", None), (None, at(6)), ("b", at(1)), ("c", at(9))]
FOUND = [None, 1.0, 2.0, 2.0, 4.0, None, 6.0, None, None]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("how", [{}, {"width": 3600}, {"width": 10**7}, {"max_rows": 0, "min_rows": 1}])
def test_only_what_was_known_before(spark, rows, kind, how):
    history = spark.createDataFrame(HISTORY, f"k string, known {kind}, v double").repartition(3)
    asked = spark.createDataFrame(ASKED, f"k string, ts {kind}").withColumn("n", F.monotonically_increasing_id())
    got = rows(as_of_average(asked, history, "k", "v", "ts", "known", "m", **how), "k", "ts", "m")
    assert got == sorted(((*a, m) for a, m in zip(ASKED, FOUND, strict=True)), key=repr)


def test_zone_less_times_keep_their_order_where_clocks_change(spark, rows):
    """In spring 02:30 does not exist in this zone, yet it lies before 03:10."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        night = dt.datetime(2026, 3, 8)
        history = spark.createDataFrame([("a", night + dt.timedelta(hours=2.5), 5.0)], "k string, known timestamp_ntz, v double")
        asked = [("a", night + dt.timedelta(hours=h)) for h in (2.4, 2.6, 3.1, 3.6)]
        df = spark.createDataFrame(asked, "k string, ts timestamp_ntz")
        got = rows(as_of_average(df, history, "k", "v", "ts", "known", "m", width=600), "ts", "m")
        assert [m for _, m in got] == [None, 5.0, 5.0, 5.0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_times_of_two_kinds_are_refused(spark):
    history = spark.createDataFrame([("a", at(0), 1.0)], "k string, known timestamp, v double")
    asked = spark.createDataFrame([("a", at(0))], "k string, ts timestamp_ntz")
    with pytest.raises(ValueError, match="one kind"):
        as_of_average(asked, history, "k", "v", "ts", "known", "m")


def test_draws_are_even_and_fixed(spark):
    df = spark.range(20_000).select(uniform_draw(["id"], 7).alias("u"), fold_of("id", 4).alias("f"))
    assert df.filter("u < 0 OR u >= 1").count() == 0
    assert abs(df.agg(F.avg("u")).first()[0] - 0.5) < 0.01
    assert all(4700 < r["count"] < 5300 for r in df.groupBy("f").count().collect())
    one = spark.createDataFrame([("x", None), ("x", "-"), (None, "x")], "a string, b string")
    assert one.select(uniform_draw(["a", "b"], 1).alias("u")).distinct().count() == 3
