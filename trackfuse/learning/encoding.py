"""Categories of very many values as numbers, without a list of them on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import FeatureHasher
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasOutputCols, HasWeightCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackfuse.operators.skew import sized_join
from trackfuse.session import new_path

#: Rows of the overall mean that each category's mean is mixed with, and places of a hashed vector.
SMOOTHING = 10.0
HASH_SIZE = 4096


def hash_encode(columns: Sequence[str], size: int = HASH_SIZE) -> FeatureHasher:
    """Categories to a sparse vector of ``size`` places by hash; nothing is fitted, a null has no place."""
    return FeatureHasher(inputCols=list(columns), categoricalCols=list(columns), outputCol="hashed_vec", numFeatures=size)


class _Means(HasInputCols, HasOutputCols, HasLabelCol, HasWeightCol):
    smoothing = Param(Params._dummy(), "smoothing", "rows of the overall mean", TypeConverters.toFloat)
    folder = Param(Params._dummy(), "folder", "where the tables of means are", TypeConverters.toString)
    overall = Param(Params._dummy(), "overall", "mean of the label", TypeConverters.toFloat)


class TargetMeans(Estimator, _Means, DefaultParamsReadable, DefaultParamsWritable):
    """Each category to the mean of its label, mixed with ``smoothing`` rows of the overall mean.

    The means are a table per column below ``folder`` (by default in the session's shared folder), as long as there are categories;
    the driver gets one number, the overall mean. Rows without a label count for nothing.
    """

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, labelCol=None, weightCol=None, smoothing=SMOOTHING, folder=None):
        super().__init__()
        self._setDefault(smoothing=SMOOTHING)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, rows: DataFrame) -> TargetMeansModel:
        label = F.col(self.getLabelCol())
        weight = F.col(self.getWeightCol()) if self.isDefined("weightCol") else F.lit(1.0)
        known = rows.filter(label.isNotNull())
        total, n = F.sum(weight * label), F.sum(weight)
        overall = known.agg(F.try_divide(total, n).alias("m")).first().m or 0.0
        folder = self.getOrDefault("folder") if self.isDefined("folder") else new_path(rows.sparkSession, "target_means")
        mixed = self.getOrDefault("smoothing")
        for column in self.getInputCols():
            sums = known.groupBy(F.col(column).alias("key")).agg(total.alias("total"), n.alias("n"))
            mean = F.try_divide(F.col("total") + F.lit(mixed * overall), F.col("n") + F.lit(mixed))
            sums.select("key", mean.alias("mean")).write.mode("overwrite").parquet(f"{folder}/{column}")
        model = TargetMeansModel()
        model._set(inputCols=self.getInputCols(), outputCols=self.getOutputCols(), folder=folder, overall=float(overall))
        return model


class TargetMeansModel(Model, _Means, DefaultParamsReadable, DefaultParamsWritable):
    """Joins the tables of means: sent to all executors where small, else by a shuffle in which heavy categories are split.

    A null category has its own mean; one that was not seen gets the overall mean. Works on batches and streams.
    """

    def _transform(self, rows: DataFrame) -> DataFrame:
        spark, order = rows.sparkSession, rows.columns
        for column, out in zip(self.getInputCols(), self.getOutputCols(), strict=True):
            means = spark.read.parquet(f"{self.getOrDefault('folder')}/{column}")
            means = means.select(F.col("key").alias(column), F.col("mean").alias(out))
            rows = sized_join(rows, means, [column], "left", null_safe=True, unique_right=True)
            rows = rows.withColumn(out, F.coalesce(out, F.lit(self.getOrDefault("overall"))))
            order = [*order, out]
        return rows.select(*order)


def target_means(columns: Sequence[str], label: str, weight: str | None = None, **params) -> TargetMeans:
    """The encoder for ``columns``; its numbers are named as ``string_index`` names them, with ``_mean`` in between."""
    if weight:
        params["weightCol"] = weight
    return TargetMeans(inputCols=list(columns), outputCols=[f"{c}_mean_idx" for c in columns], labelCol=label, **params)
