"""Pipeline stages: impute, index, encode, assemble, estimate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor

from trackfuse.schemas import BOOST_DEPTH, BOOST_STEP, MAX_BINS

FILLED = "_filled"


def mean_impute(columns: Sequence[str], keep_raw: bool = False) -> Imputer:
    """Nulls to the training mean, in place; with ``keep_raw`` under ``<name>_filled``.

    In an integer column the mean is cut to a whole number.
    """
    filled = [c + FILLED for c in columns] if keep_raw else list(columns)
    return Imputer(inputCols=list(columns), outputCols=filled, strategy="mean")


def string_index(columns: Sequence[str]) -> StringIndexer:
    """Categories to indices, most frequent first, ties by name; unseen and null come last.

    All columns are counted in one pass.
    """
    return StringIndexer(
        inputCols=list(columns),
        outputCols=[f"{c}_idx" for c in columns],
        handleInvalid="keep",
        stringOrderType="frequencyDesc",
    )


def one_hot(columns: Sequence[str]) -> OneHotEncoder:
    """Indices to sparse vectors; the last category is all zeros."""
    return OneHotEncoder(inputCols=[f"{c}_idx" for c in columns], outputCols=[f"{c}_vec" for c in columns])


def assemble(columns: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol="features")


def linear(label: str, weight: str | None = None, **params) -> LinearRegression:
    return _weighted(LinearRegression(featuresCol="features", labelCol=label, **params), weight)


def tree(label: str, weight: str | None = None, **params) -> DecisionTreeRegressor:
    params.setdefault("maxBins", MAX_BINS)
    return _weighted(DecisionTreeRegressor(featuresCol="features", labelCol=label, **params), weight)


def boosted(label: str, weight: str | None = None, **params) -> GBTRegressor:
    """Boosted trees on squared error, with MLlib's own algorithm and default of 20 rounds."""
    for name, value in (("maxBins", MAX_BINS), ("maxDepth", BOOST_DEPTH), ("stepSize", BOOST_STEP), ("seed", 42)):
        params.setdefault(name, value)
    return _weighted(GBTRegressor(featuresCol="features", labelCol=label, **params), weight)


def forest(label: str, weight: str | None = None, **params) -> RandomForestRegressor:
    for name, value in (("maxBins", MAX_BINS), ("seed", 42)):
        params.setdefault(name, value)
    return _weighted(RandomForestRegressor(featuresCol="features", labelCol=label, **params), weight)


def _weighted(estimator: Estimator, weight: str | None) -> Estimator:
    return estimator.setWeightCol(weight) if weight else estimator


# kind -> (name in reports, estimator, whether categories go in as one-hot vectors)
KINDS = {
    "linear_regression": ("LinearRegression", linear, True),
    "decision_tree_regression": ("DecisionTreeRegression", tree, False),
    "boosted_regression": ("BoostedRegression", boosted, False),
    "forest_regression": ("ForestRegression", forest, False),
}


