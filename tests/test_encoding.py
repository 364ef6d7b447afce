import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from trackfuse.learning import train as training
from trackfuse.learning.encoding import hash_encode, target_means
from trackfuse.learning.train import fit_model, save_model, score
from trackfuse.plans.models import training_rows
from trackfuse.sources.scans import table_stream
from trackfuse.streaming.sinks import append_files, finish

ROWS = [("a", 1.0, 1.0), ("a", 3.0, 3.0), ("b", 10.0, 1.0), (None, 6.0, 1.0), ("c", None, 1.0)]


@pytest.fixture
def train(spark):
    return spark.createDataFrame(ROWS, "k string, y double, w double")


@pytest.mark.parametrize("weight", [None, "w"])
def test_target_means(spark, train, rows, weight):
    model = target_means(["k"], "y", weight, smoothing=2.0).fit(train)
    known = [(k, y, w if weight else 1.0) for k, y, w in ROWS if y is not None]
    overall = sum(y * w for _, y, w in known) / sum(w for _, _, w in known)

    def mean(key):
        own = [(y, w) for k, y, w in known if k == key]
        return (sum(y * w for y, w in own) + 2 * overall) / (sum(w for _, w in own) + 2) if own else overall

    unseen = spark.createDataFrame([("a", 1), ("z", 2), (None, 3), ("c", 4)], "k string, n int")
    got = {r.n: r.k_mean_idx for r in model.transform(unseen).collect()}
    assert got == {n: pytest.approx(mean(k)) for k, n in [("a", 1), ("z", 2), (None, 3), ("c", 4)]}


def test_no_rows_to_learn_from(spark, train):
    model = target_means(["k"], "y").fit(train.limit(0))
    assert [r.k_mean_idx for r in model.transform(train.limit(2)).collect()] == [0.0, 0.0]


def test_a_model_on_ids_is_saved_and_scores_a_stream(spark, tmp_path, rows):
    data = spark.range(4000).selectExpr("concat('id', id % 1000) k", "concat('h', id % 700) h", "cast(id % 1000 as double) y", "id % 3 n")
    how = {"averaged": ["k"], "hashed": ["h"], "hash_size": 64, "numerical": ["n"]}
    for kind in ("linear_regression", "decision_tree_regression"):
        model = fit_model(data, kind, "y", **how)
        path = save_model(model, str(tmp_path), kind)
        again = PipelineModel.load(path)
        batch = score(again, data)
        assert batch.columns == [*data.columns, "prediction"]
        assert rows(batch.selectExpr("k", "round(prediction, 6)")) == rows(score(model, data).selectExpr("k", "round(prediction, 6)"))
        assert batch.agg(F.corr("y", "prediction")).first()[0] > 0.99
    data.write.parquet(str(tmp_path / "in"))
    streamed = score(again, table_stream(spark, str(tmp_path / "in"), data.schema))
    finish(append_files(streamed, str(tmp_path / "out"), str(tmp_path / "ck"), trigger={"availableNow": True}))
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(batch)


def test_hashing_has_no_list(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("a", 2)], "k string, n int")
    found = [r.hashed_vec for r in hash_encode(["k", "n"], 128).transform(df).collect()]
    assert [v.size for v in found] == [128] * 3 and [len(v.indices) for v in found] == [2, 1, 2]
    assert set(found[1].indices) <= set(found[2].indices)


@pytest.mark.parametrize("stable", [False, True])
def test_training_rows_know_no_own_label(spark, stable):
    """The label of one flight decides nothing about its own average."""

    def made(delay):
        df = spark.range(60).selectExpr(
            "concat('T', id) ident", "'A' origin_airport_icao", "timestamp'2026-03-01' scheduled_out", "concat('OP', id % 3) operator",
            f"if(id = 7, {delay}, int(id)) departure_delay", "0.5D operator_avg_departure_delay",
        )
        rows = training_rows(
            df, categorical=["operator"], numerical=["operator_avg_departure_delay"], folds=4, stable=stable, fraction=5.0
        )
        return {r.ident: r.operator_avg_departure_delay for r in rows.select("ident", "operator_avg_departure_delay").collect()}

    one, other = made(1), made(10**6)
    assert one["T7"] == other["T7"]
    assert 0.5 not in one.values() and any(one[k] != other[k] for k in one.keys() & other.keys())


def test_means_are_joined_in_once_for_training(spark, monkeypatch):
    """Estimators read their rows several times; a join of many means would be shuffled anew each time."""
    handed = []

    def fitted(ready, *how, fit=training.fit_prepared, **more):
        handed.append(ready)
        return fit(ready, *how, **more)

    monkeypatch.setattr(training, "fit_prepared", fitted)
    rows = spark.createDataFrame([(i % 3, float(i)) for i in range(12)] + [(None, 1.0)], "k long, y double")
    model = training.fit_model(rows, "linear_regression", "y", averaged=["k"])
    assert "Join" not in handed[0]._jdf.queryExecution().optimizedPlan().toString()
    assert training.score(model, rows).filter("prediction IS NOT NULL").count() == 13
