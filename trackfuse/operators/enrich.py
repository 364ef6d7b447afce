"""Left joins to dimensions and per-key averages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackfuse.functions.features import event_date, flag_not_null
from trackfuse.operators.project import rename_drop
from trackfuse.operators.skew import HOT_SHARE, MAX_BROADCAST_ROWS, MIN_PIECE_ROWS, key_hash, sized_join
from trackfuse.session import stage


def lookup_left(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    dim_key: str,
    renames: Mapping[str, str] | None = None,
    **join,
) -> DataFrame:
    """Left join to a dimension under another key name; the dimension's key is dropped.

    ``join`` holds limits for ``sized_join``, here and below.
    """
    keyed = dim.withColumnRenamed(dim_key, key) if key != dim_key else dim
    joined = sized_join(df, keyed, [key], "left", **join)
    return rename_drop(joined, renames or {})


def id_map_left(df: DataFrame, mapping: DataFrame, key: str, **join) -> DataFrame:
    """Left join that maps an id. A repeated id fans out, an unknown one maps to null."""
    return sized_join(df, mapping, [key], "left", **join)


def calendar_flag(df: DataFrame, calendar: DataFrame, ts: str, date_col: str, flag: str, **join) -> DataFrame:
    """1 where the date of ``ts`` is in the calendar, else 0.

    The calendar is made distinct, so a repeated date cannot repeat rows.
    """
    dates = calendar.select(F.col(date_col).alias("_date"), F.lit(True).alias("_hit")).distinct()
    dated = df.withColumn("_date", event_date(F.col(ts)))
    joined = sized_join(dated, dates, ["_date"], **join)
    return joined.withColumn(flag, flag_not_null(F.col("_hit"))).drop("_date", "_hit")


def key_average(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Mean per key. Null values are ignored, a null key is a group; combined map-side."""
    return df.groupBy(key).agg(F.avg(value).alias(out))


def mean_of_means(averages: DataFrame, col: str) -> Column:
    """Unweighted mean of the per-key means, as a scalar subquery; null if there are none."""
    return averages.select(F.avg(col)).scalar()


def key_average_join(
    df: DataFrame, averages: DataFrame, key: str, col: str, fold: str | None = None, **join
) -> DataFrame:
    """Left join to a stored table of per-key means; gaps get the mean of the means.

    With ``fold``, a column of both sides, the means are those of ``out_of_fold_averages``: a row
    gets its key's mean for its own fold, and a gap the mean of the means for that fold.
    """
    if fold is None:
        joined = sized_join(df, averages.select(key, col), [key], "left", **join)
        return joined.withColumn(col, F.coalesce(F.col(col), mean_of_means(averages, col)))
    joined = sized_join(df, averages.select(key, fold, col), [key, fold], "left", unique_right=True, **join)
    gaps = averages.groupBy(fold).agg(F.avg(col).alias("mean"))  # one row per fold
    gaps = gaps.agg(F.map_from_entries(F.collect_list(F.struct(fold, "mean")))).scalar()
    return joined.withColumn(col, F.coalesce(F.col(col), F.try_element_at(gaps, F.col(fold))))


def inverse_count_weight(
    df: DataFrame,
    entity: str,
    out: str = "sample_weight",
    min_rows: int = MIN_PIECE_ROWS,
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """1 / number of rows with the same entity id.

    The counts are combined map-side, written once and joined back; a window over the
    entity would put all its rows into one task. The counts are also the exact list of
    heavy entities, which are split where the counts are too many for a broadcast.
    """
    counts = stage(df.groupBy(entity).agg(F.count("*").alias("_n")), "entity_counts")
    total = counts.agg(F.sum("_n").alias("n")).first().n or 0
    piece = max(total * HOT_SHARE, min_rows)
    heavy = counts.filter(F.col("_n") > piece)
    parts = F.ceil(F.col("_n") / F.lit(float(max(piece, 1)))).cast("int")
    # Fewer than 1 / HOT_SHARE entities are that heavy.
    hot = stage(heavy.select(key_hash(counts, [entity]).alias("_key"), parts.alias("_lp"), F.lit(1).alias("_rp")), "hot")
    joined = sized_join(
        df, counts, [entity], "left", max_rows, min_rows=min_rows, null_safe=True, unique_right=True, hot=hot
    )
    return joined.withColumn(out, F.lit(1.0) / F.col("_n")).drop("_n")
