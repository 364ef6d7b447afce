from pathlib import Path

import pytest

from trackfuse.plans import features
from trackfuse.session import new_path, remove_run, run_folder, stage, work_dir


def test_a_finished_run_leaves_nothing(spark):
    shared = work_dir(spark)
    before = set(Path(shared).iterdir())
    with run_folder(spark) as folder:
        assert new_path(spark, "x").startswith(folder) and folder.startswith(shared)
        assert stage(spark.range(5)).count() == 5
        assert Path(folder).exists()
    assert work_dir(spark) == shared and set(Path(shared).iterdir()) == before


def test_a_failed_run_is_cleaned_and_a_lost_one_can_be(spark):
    with pytest.raises(RuntimeError), run_folder(spark, "failing") as folder:
        stage(spark.range(5))
        raise RuntimeError
    assert not Path(folder).exists()
    with run_folder(spark, "lost", keep=True) as folder:
        stage(spark.range(5))
    assert Path(folder).exists()
    assert remove_run(spark, "lost") and not Path(folder).exists()
    assert not remove_run(spark, "lost")


def test_runs_may_nest(spark):
    with run_folder(spark, "outer") as outer, run_folder(spark, "inner") as inner:
        assert inner == f"{outer}/inner"
    assert not Path(outer).exists()


def test_feature_streams_have_no_empty_batches(spark, monkeypatch):
    """A batch without input would go through the whole state of the join and give nothing."""
    seen, setting = [], "spark.sql.streaming.noDataMicroBatches.enabled"

    def start(*_, **__):
        seen.append(spark.conf.get(setting))

    monkeypatch.setattr(features, "append_stream", start)
    monkeypatch.setattr(features, "versioned_join", start)
    monkeypatch.setattr(features, "refresh_averages", lambda *_: spark.range(1))
    monkeypatch.setattr(features, "build_features", lambda *_, **__: spark.range(1))
    features.start_features(spark.range(1), *[None] * 4, "checkpoint")
    features.start_versioned_features(*[None] * 5, "averages", "out", "checkpoint")
    assert seen == ["false"] * 2 and spark.conf.get(setting) == "true"
