import pytest
from pyspark.sql import functions as F

from trackfuse.operators.lookup import latest_for_key, latest_n, latest_per_key
from trackfuse.operators.sampling import bootstrap_sample, poisson_bootstrap, random_split

SCORED = [("a", 1, 1, 0.5), ("a", 3, 1, float("nan")), ("a", 3, 2, float("inf")), ("b'", None, 9, 1.0), ("c", 2, 5, 2.0)]


@pytest.fixture
def scored(spark):
    return spark.createDataFrame(SCORED, "k string, ts int, tie int, p double")


def test_latest_for_key(scored, rows):
    assert rows(latest_for_key(scored, "k", "a", "ts", ["tie"])) == [("a", 3, 2, None)]
    assert rows(latest_for_key(scored, "k", "b'", "ts")) == [("b'", None, 9, 1.0)]
    assert rows(latest_for_key(scored, "k", "nobody", "ts")) == []


def test_latest_n(scored):
    keys = [(r.k, r.tie) for r in latest_n(scored, "ts", 3, ["tie"]).collect()]
    assert keys == [("a", 2), ("a", 1), ("c", 5)]
    assert latest_n(scored, "ts", 0).count() == 0
    assert latest_n(scored, "ts", 100).count() == 5
    assert [r.ts for r in latest_n(scored, "ts", 100, ["tie"]).collect()][-1] is None


def test_latest_per_key(scored, rows):
    got = rows(latest_per_key(scored, "k", "ts", ["tie"]))
    assert set(got) == {("a", 3, 2, None), ("b'", None, 9, 1.0), ("c", 2, 5, 2.0)}


def test_without_a_tiebreak_all_columns_decide(spark, rows):
    tied = spark.createDataFrame([("a", 1, i, float(i % 3)) for i in range(9)], "k string, ts int, tie int, p double")
    for df in (tied, tied.orderBy("tie"), tied.orderBy(F.desc("tie"))):
        assert [r.tie for r in latest_n(df.repartition(3), "ts", 2).collect()] == [8, 7]
        assert rows(latest_per_key(df.repartition(3), "k", "ts")) == [("a", 1, 8, 2.0)]
        assert rows(latest_for_key(df, "k", "a", "ts")) == [("a", 1, 8, 2.0)]


def test_bootstrap(spark):
    df = spark.range(0, 5000, 1, 4)
    drawn = [sorted(r.id for r in bootstrap_sample(df, 1.0, 42).collect()) for _ in range(2)]
    assert drawn[0] == drawn[1]
    assert abs(len(drawn[0]) - 5000) < 6 * 5000**0.5 and len(set(drawn[0])) < 4000
    assert bootstrap_sample(df, 0.0).count() == 0


@pytest.mark.parametrize("by", [None, "entity"])
def test_split_is_a_partition(spark, by):
    df = spark.range(4000).withColumn("entity", F.col("id") % 500)
    first, second = random_split(df, 0.2, 45, by), random_split(df, 0.2, 45, by)
    train, test = ({r.id for r in part.collect()} for part in first)
    assert not train & test and len(train | test) == 4000
    assert 500 < len(test) < 1100
    assert {r.id for r in second[1].collect()} == test
    if by:
        assert not {i % 500 for i in train} & {i % 500 for i in test}


def test_split_ends(spark):
    assert random_split(spark.range(100), 0.0)[1].count() == 0
    assert random_split(spark.range(100), 1.0)[0].count() == 0


MANY = [("a", 1.5)] * 700 + [("b", None)] * 5 + [(None, 2.0)] * 4 + [(f"c{i}", float(i)) for i in range(3000)]


def drawn_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_poisson_bootstrap_does_not_depend_on_partitions(spark):
    df = spark.createDataFrame(MANY, "k string, v double")
    first = drawn_rows(poisson_bootstrap(df))
    for other in (df.repartition(7), df.orderBy(F.rand(2)).coalesce(1)):
        assert drawn_rows(poisson_bootstrap(other)) == first
        assert drawn_rows(poisson_bootstrap(other, part_rows=13)) == first
    assert first != drawn_rows(poisson_bootstrap(df, seed=43))
    assert set(first) <= set(MANY) and abs(len(first) - len(MANY)) < 6 * len(MANY) ** 0.5
    assert abs(first.count(("a", 1.5)) - 700) < 6 * 700**0.5
    assert 0.33 < 1 - len({k for k, _ in first if k and k[0] == "c"}) / 3000 < 0.41  # 1 / e are left out


def test_poisson_bootstrap_by_a_key(spark):
    df = spark.range(5000).withColumn("v", F.rand(1))
    drawn = poisson_bootstrap(df, 0.5, by=["id"])
    assert "Exchange" not in drawn._jdf.queryExecution().executedPlan().toString()
    assert abs(drawn.count() - 2500) < 6 * 2500**0.5
    assert drawn_rows(drawn.select("id")) == drawn_rows(poisson_bootstrap(df.select("id"), 0.5, by=["id"]))


def test_poisson_bootstrap_ends(spark):
    df = spark.range(1000)
    assert poisson_bootstrap(df, 0.0).count() == 0 and poisson_bootstrap(df.limit(0)).count() == 0
    assert abs(poisson_bootstrap(df, 30.0).count() - 30_000) < 6 * 30_000**0.5
    with pytest.raises(ValueError, match="draws"):
        poisson_bootstrap(df, -1.0)
