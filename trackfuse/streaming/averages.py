"""Averages per key that are kept up with the rows as they come, without reading old rows again."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trackfuse.streaming.batches import append_batches, merge_batches, read_batches


def keep_averages(
    stream: DataFrame, key: str, value: str, path: str, checkpoint: str, trigger: Mapping | None = None
) -> StreamingQuery:
    """Keep sum and count per key of everything the stream brings, one small table per batch.

    A batch writes its own folder (``append_batches``): run again after a failure it replaces what it
    wrote, so no row counts twice. What is written is as large as the batch has keys. Null
    values count for nothing, yet their key is kept, as in ``key_average``.
    """

    def partials(rows: DataFrame) -> DataFrame:
        return rows.groupBy(key).agg(F.sum(F.col(value).cast("double")).alias("total"), F.count(value).alias("n"))

    return append_batches(stream, path, checkpoint, trigger, partials)


def _summed(partials: DataFrame) -> DataFrame:
    key = next(c for c in partials.columns if c not in ("total", "n"))
    return partials.groupBy(key).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def kept_averages(spark: SparkSession, path: str, key: str, out: str) -> DataFrame:
    """``(key, out)`` over all complete batches: the means that ``key_average`` gives on all their rows."""
    return _summed(read_batches(spark, path)).select(key, F.try_divide("total", "n").alias(out))


def merge_averages(spark: SparkSession, path: str, spare: int = 1) -> int | None:
    """Merge the batches' sums, so that reading does not grow with the number of batches (``merge_batches``)."""
    return merge_batches(spark, path, _summed, spare)
