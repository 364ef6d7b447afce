import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import functions as F

from trackfuse.learning.stages import KINDS, mean_impute, one_hot, string_index
from trackfuse.learning.train import evaluate, fit_model, label_counts, prepare, save_model, score
from trackfuse.sources.scans import load_model


@pytest.fixture(scope="module")
def train(spark):
    return spark.range(0, 400, 1, 2).selectExpr(
        "CASE id % 4 WHEN 0 THEN null WHEN 1 THEN 'b' ELSE 'a' END k",
        "nullif(double(id % 10), 3) x",
        "int(id % 3) n",
        "CASE WHEN id % 10 = 3 THEN null ELSE 2.0 * (id % 10) + 1 END y",
        "1.0 / (1 + id % 2) w",
    ).cache()


def test_impute_in_place_and_beside(spark):
    df = spark.createDataFrame([(1.0, 20), (None, 30), (4.0, None), (None, 20)], "x double, n long")
    got = mean_impute(["x", "n"]).fit(df).transform(df).collect()
    assert [tuple(r) for r in got] == [(1.0, 20), (2.5, 30), (4.0, 23), (2.5, 20)]
    beside = mean_impute(["x"], keep_raw=True).fit(df).transform(df)
    assert [r.x for r in beside.collect()] == [1.0, None, 4.0, None]
    assert [r.x_filled for r in beside.collect()] == [1.0, 2.5, 4.0, 2.5]


def test_index_and_encode(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 1), ("c", 2)], "k string, n int")
    indexer = string_index(["k", "n"]).fit(df)
    new = spark.createDataFrame([("a", 1), ("b", 2), ("zz", 3), (None, None)], "k string, n int")
    got = indexer.transform(new)
    assert [(r.k_idx, r.n_idx) for r in got.collect()] == [(1.0, 0.0), (0.0, 1.0), (3.0, 2.0), (3.0, 2.0)]
    encoded = one_hot(["k"]).fit(indexer.transform(df)).transform(got).collect()
    assert [r.k_vec.toArray().tolist() for r in encoded] == [[0, 1, 0], [1, 0, 0], [0, 0, 0], [0, 0, 0]]


@pytest.mark.parametrize("kind", KINDS)
def test_each_kind_fits_scores_and_reloads(spark, train, tmp_path, kind):
    extra = {"boosted_regression": {"maxIter": 2}, "forest_regression": {"numTrees": 3}}.get(kind, {})
    model = fit_model(train, kind, "y", ["k", "n"], ["x"], "w", **extra)
    scored = score(model, train)
    assert scored.columns == [*train.columns, "prediction"]
    assert scored.filter("prediction IS NULL").count() == 0
    path = save_model(model, str(tmp_path), kind, "2026-01-01_00-00-00")
    assert path.endswith(f"{kind}_2026-01-01_00-00-00")
    again = score(load_model(path), train)
    assert again.exceptAll(scored).isEmpty()
    if kind == "linear_regression":
        assert evaluate(scored.filter("y IS NOT NULL"), "y").first().R2 == pytest.approx(1.0)


def test_weights_move_the_line(spark):
    df = spark.createDataFrame([(0.0, 0.0, 1.0), (0.0, 10.0, 3.0)], "x double, y double, w double")
    plain = fit_model(df, "decision_tree_regression", "y", numerical=["x"])
    heavy = fit_model(df, "decision_tree_regression", "y", numerical=["x"], weight="w")
    assert score(plain, df).first().prediction == pytest.approx(5.0)
    assert score(heavy, df).first().prediction == pytest.approx(7.5)


def test_bins_follow_the_categories(spark):
    many = spark.range(900).selectExpr("string(id % 450) k", "double(id % 450) y")
    model = fit_model(many, "decision_tree_regression", "y", ["k"])
    assert model.stages[-1].getOrDefault("maxBins") == 451


def test_constant_label_and_unseen_category(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", 3.0)] * 5, "k string, y double")
    model = fit_model(df, "decision_tree_regression", "y", ["k"])
    new = spark.createDataFrame([("new",), (None,)], "k string")
    assert [r.prediction for r in score(model, new).collect()] == [3.0, 3.0]
    assert evaluate(score(model, df), "y").first().R2 is None


def test_another_estimator_and_shared_preparation(train):
    ready = prepare(train, "y", ["k"], ["x"])
    other = GeneralizedLinearRegression(labelCol="y", featuresCol="features")
    model = fit_model(train, "linear_regression", "y", ["k"], ["x"], estimator=other, prepared=ready)
    assert evaluate(score(model, train), "y").first().R2 == pytest.approx(1.0)


def test_keep_raw_keeps_the_gaps(train):
    model = fit_model(train, "linear_regression", "y", numerical=["x"], keep_raw=True)
    assert score(model, train).filter("x IS NULL").count() == train.filter("x IS NULL").count() > 0


def test_evaluate_equals_the_evaluator(spark):
    df = spark.range(500).select(F.rand(1).alias("y"), F.rand(2).alias("prediction"))
    mine = evaluate(df, "y").first()
    theirs = RegressionEvaluator(labelCol="y")
    assert mine.R2 == pytest.approx(theirs.evaluate(df, {theirs.metricName: "r2"}))
    assert mine.RMSE == pytest.approx(theirs.evaluate(df, {theirs.metricName: "rmse"}))
    assert tuple(evaluate(df.limit(0), "y").first()) == (None, None)


def test_label_counts(train):
    assert tuple(label_counts(train, "y").first()) == (360, 40)
