"""Fit, evaluate, report, save and score."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackfuse.learning.encoding import HASH_SIZE, hash_encode, target_means
from trackfuse.learning.stages import FILLED, KINDS, assemble, mean_impute, one_hot, string_index
from trackfuse.operators.project import drop_derived
from trackfuse.session import stage


def needed_bins(indexer_model, at_least: int) -> int:
    """Trees need one bin per category, and one more for unseen values."""
    return max(at_least, 1 + max((len(labels) for labels in indexer_model.labelsArray), default=0))


def labelled(df: DataFrame, label: str) -> DataFrame:
    """Rows with a label; the estimators refuse null."""
    return df.filter(F.col(label).isNotNull())


def label_counts(df: DataFrame, label: str) -> DataFrame:
    """How many rows can be learnt from, and how many lack the label and are left out."""
    return df.agg(F.count(label).alias("labelled"), F.count_if(F.col(label).isNull()).alias("unlabelled"))


def prepare(
    train: DataFrame,
    label: str,
    categorical: Sequence[str] = (),
    numerical: Sequence[str] = (),
    keep_raw: bool = False,
    hashed: Sequence[str] = (),
    averaged: Sequence[str] = (),
    weight: str | None = None,
    hash_size: int = HASH_SIZE,
) -> list:
    """Category indexer and imputer fitted on the labelled rows, one pass each, for any number of models.

    ``hashed`` and ``averaged`` are categories of very many values, encoded by hash and by the label's
    mean (``encoding``): neither has a list on the driver.
    """
    rows = labelled(train, label)
    fitted = [string_index(categorical).fit(rows)] if categorical else []
    fitted += [mean_impute(numerical, keep_raw).fit(rows)] if numerical else []
    fitted += [hash_encode(hashed, hash_size)] if hashed else []
    return fitted + ([target_means(averaged, label, weight).fit(rows)] if averaged else [])


def fit_model(
    train: DataFrame,
    kind: str,
    label: str,
    categorical: Sequence[str] = (),
    numerical: Sequence[str] = (),
    weight: str | None = None,
    keep_raw: bool = False,
    estimator: Estimator | None = None,
    prepared: list | None = None,
    hashed: Sequence[str] = (),
    averaged: Sequence[str] = (),
    hash_size: int = HASH_SIZE,
    **params,
) -> PipelineModel:
    """Index, encode (linear model only), impute, assemble and fit.

    ``estimator`` may be any Spark ML regressor in place of the one of ``kind``.
    ``prepared`` hands in what ``prepare`` fitted on the same rows. ``hashed`` and ``averaged`` are further
    categories, of very many values (``prepare``).
    """
    used = [*categorical, *numerical, *hashed, *averaged, label, *([weight] if weight else [])]
    rows = labelled(train, label).select(*dict.fromkeys(used))
    if prepared is None:
        prepared = prepare(rows, label, categorical, numerical, keep_raw, hashed, averaged, weight, hash_size)
    ready = PipelineModel(list(prepared)).transform(rows)
    if averaged:
        # The means are joined in by a shuffle where they are many, and estimators go over their rows several times.
        ready = stage(ready.drop(*(c for c in averaged if c not in numerical)), "ready")
    more = ["hashed_vec"] * bool(hashed) + [f"{c}_mean_idx" for c in averaged]
    return fit_prepared(
        ready, kind, label, categorical, numerical, weight, keep_raw, estimator, prepared=prepared, more=more, **params
    )[0]


def fit_prepared(
    ready: DataFrame,
    kind: str,
    label: str,
    categorical: Sequence[str] = (),
    numerical: Sequence[str] = (),
    weight: str | None = None,
    keep_raw: bool = False,
    estimator: Estimator | None = None,
    *,
    prepared: Sequence,
    more: Sequence[str] = (),
    **params,
) -> tuple[PipelineModel, PipelineModel]:
    """Fit on rows that the ``prepared`` stages have been applied to; ``more`` names further columns of theirs.

    Returns the whole model, for raw rows, and its part for prepared ones.
    """
    _, make, encoded = KINDS[kind]
    estimator = estimator or make(label, weight, **params)
    if categorical and estimator.hasParam("maxBins"):
        estimator.set(estimator.getParam("maxBins"), needed_bins(prepared[0], estimator.getOrDefault("maxBins")))
    filled = [c + FILLED for c in numerical] if keep_raw else list(numerical)
    inputs = [f"{c}_vec" if encoded else f"{c}_idx" for c in categorical] + filled + list(more)
    encoder = [one_hot(categorical)] if categorical and encoded else []
    fitted = Pipeline(stages=[*encoder, assemble(inputs), estimator]).fit(labelled(ready, label))
    return PipelineModel([*prepared, *fitted.stages]), fitted


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``prediction`` to a batch or a stream; helper columns are dropped again."""
    return drop_derived(model.transform(df))


def _losses(label: str, prediction: str, name: str) -> list:
    miss = F.col(label) - F.col(prediction)
    return [F.sum(miss * miss).alias(f"{name}sse"), F.var_pop(label).alias(f"{name}spread"), F.count(label).alias(f"{name}n")]


def _metrics(name: str) -> list:
    sse, spread, n = (F.col(f"{name}{c}") for c in ("sse", "spread", "n"))
    r2 = F.lit(1.0) + F.try_divide(F.lit(-1.0) * sse, spread * n)
    return [r2.alias("R2"), F.sqrt(F.try_divide(sse, n)).alias("RMSE")]


def evaluate(scored: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row with R2 and RMSE, from a single pass."""
    return labelled(scored, label).agg(*_losses(label, prediction, "")).select(*_metrics(""))


def report_of(scored: DataFrame, predictions: Mapping[str, str], label: str, stamp: str) -> DataFrame:
    """``model_report`` of several predictions on the same rows, kind -> column, from one pass."""
    every = [a for kind, column in predictions.items() for a in _losses(label, column, f"{kind}_")]
    lines = F.array(
        *(F.struct(F.lit(KINDS[kind][0]).alias("Model"), *_metrics(f"{kind}_")) for kind in predictions)
    )
    totals = labelled(scored, label).agg(*every)
    return totals.select(F.explode(lines).alias("line")).select("line.*", F.lit(stamp).alias("Timestamp"))


# The form of the time stamp in the names of saved models and reports.
STAMP = "%Y-%m-%d_%H-%M-%S"


def run_stamp() -> str:
    return datetime.now().strftime(STAMP)


def model_report(scored: Mapping[str, DataFrame], label: str, stamp: str) -> DataFrame:
    """One metrics row per model kind: Model, R2, RMSE, Timestamp."""
    rows = [
        evaluate(df, label).select(F.lit(KINDS[kind][0]).alias("Model"), "R2", "RMSE", F.lit(stamp).alias("Timestamp"))
        for kind, df in scored.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def model_path(root: str, kind: str, stamp: str) -> str:
    return f"{root}/{kind}_{stamp}"


def save_model(model: PipelineModel, root: str, kind: str, stamp: str | None = None) -> str:
    """Save under ``<kind>_<yyyy-mm-dd_HH-MM-SS>``; returns the path."""
    path = model_path(root, kind, stamp or run_stamp())
    model.write().overwrite().save(path)
    return path
