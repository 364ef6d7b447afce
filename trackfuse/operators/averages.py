"""Averages per key that tell a row nothing of its own label."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackfuse.functions.features import clock_micros
from trackfuse.operators.enrich import key_average_join
from trackfuse.operators.skew import sized_join
from trackfuse.session import stage

DAY = 24 * 3600


def out_of_fold_averages(df: DataFrame, key: str, value: str, fold: str, folds: int, out: str) -> DataFrame:
    """``(key, fold, out)``: for each fold the key's mean over the rows of all *other* folds.

    One pass, combined map-side, adds up each key's values by fold. The other folds are then
    added to each other, never subtracted from a total, so nothing of the fold's own rows is
    left in the mean, not even a rounding. Null values are ignored; a null key is a group; a key that has
    values in one fold only has no mean there.
    """
    parts = df.groupBy(key).agg(
        *(F.sum(F.when(F.col(fold) == i, F.col(value))).cast("double").alias(f"_s{i}") for i in range(folds)),
        *(F.count(F.when(F.col(fold) == i, F.col(value))).alias(f"_n{i}") for i in range(folds)),
    )

    def others(own: int) -> Column:
        rest = [i for i in range(folds) if i != own]
        total = reduce(add, (F.coalesce(F.col(f"_s{i}"), F.lit(0.0)) for i in rest))
        return F.try_divide(total, reduce(add, (F.col(f"_n{i}") for i in rest)))

    rows = F.array(*(F.struct(F.lit(i).alias(fold), others(i).alias(out)) for i in range(folds)))
    return parts.select(key, F.explode(rows).alias("_row")).select(key, "_row.*").filter(F.col(out).isNotNull())


def out_of_fold_join(df: DataFrame, key: str, value: str, fold: str, folds: int, out: str, **join) -> DataFrame:
    """``df`` with ``out``, the mean of ``value`` over the key's rows of other folds than the row's own.

    Where the other folds know nothing of the key, and where it is null, ``out`` is the mean of their means, as
    in ``key_average_join``. So no value depends on any row of its own fold; with ``fold_of`` an
    entity none depends on its own entity. ``fold`` is a column of whole numbers from 0 to below ``folds``.
    ``join`` holds limits for ``sized_join``.
    """
    if folds < 2:
        raise ValueError("two folds at least")
    means = stage(out_of_fold_averages(df, key, value, fold, folds, out), "fold_means")
    return key_average_join(df, means, key, out, fold, **join)


def as_of_average(
    df: DataFrame,
    history: DataFrame,
    key: str,
    value: str,
    ts: str,
    known: str,
    out: str,
    width: int = DAY,
    **join,
) -> DataFrame:
    """``df`` with ``out``, the mean of the key's ``value`` in ``history`` over the rows known before the row's ``ts``.

    ``known`` is when a value of the history became known: an average of delays may only hold flights that
    had left by then. The history may be ``df`` itself. A row before all knowledge, or
    without a time, has null; rows of the history without a value or a time count for nothing. A null key is a group.

    Time is cut into bins of ``width`` seconds. Sums per key and bin, combined map-side, are added up
    along the bins; within a bin rows and values are put in order. So a key with any share of the rows is
    the work of as many tasks as it has bins.
    """
    kind = df.schema[ts].dataType
    if kind != history.schema[known].dataType or not isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        raise ValueError(f"{ts} and {known} must be timestamps of one kind")
    told = history.filter(F.col(value).isNotNull() & F.col(known).isNotNull())
    told = told.select(key, clock_micros(F.col(known), kind).alias("_at"), F.col(value).cast("double").alias("_v"))
    asked = df.select(key, clock_micros(F.col(ts), kind).alias("_at"), F.struct(*df.columns).alias("_row"))
    both = asked.unionByName(told, allowMissingColumns=True)
    both = both.withColumn("_bin", F.floor(F.col("_at") / F.lit(width * 1_000_000)))
    sums = both.groupBy(key, "_bin").agg(F.sum("_v").alias("_s"), F.count("_v").alias("_n"))
    along = Window.partitionBy(key).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(
        key, "_bin", F.coalesce(F.sum("_s").over(along), F.lit(0.0)).alias("_s"), F.coalesce(F.sum("_n").over(along), F.lit(0)).alias("_n")
    )
    joined = sized_join(both, stage(before, "bins"), [key, "_bin"], "left", null_safe=True, unique_right=True, **join)
    earlier = Window.partitionBy(key, "_bin").orderBy("_at").rangeBetween(Window.unboundedPreceding, -1)
    total = F.col("_s") + F.coalesce(F.sum("_v").over(earlier), F.lit(0.0))
    n = F.col("_n") + F.count("_v").over(earlier)
    mean = F.when(F.col("_at").isNotNull(), F.try_divide(total, n))
    found = joined.withColumn(out, mean).filter(F.col("_row").isNotNull())
    return found.select("_row.*", out)
