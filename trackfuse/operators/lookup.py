"""Lookups on scored rows: newest for a key, newest overall."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackfuse.functions.features import non_finite_to_null
from trackfuse.operators.project import key_filter


def _tiebreak(df: DataFrame, ts: str, given: Sequence[str] | None) -> list[str]:
    """What orders rows of equal time: the given columns, or all others that have an order."""
    if given is not None:
        return list(given)
    return [f.name for f in df.schema.fields if f.name != ts and not _unordered(f.dataType)]


def _unordered(kind: T.DataType) -> bool:
    return any(word in kind.simpleString() for word in ("map<", "variant"))


def _newest_first(order: Sequence[str]):
    return [F.col(c).desc_nulls_last() for c in order]


def latest_n(df: DataFrame, ts: str, n: int = 10, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """The newest ``n`` rows; equal times are ordered by ``tiebreak``, newest or highest first.

    Without a tiebreak all other columns that have an order decide, so the answer is the same each time.

    The time of the n-th row is found from the time column alone, and only rows from
    then on are read whole: the filter reaches the scan as a value.
    """
    if n > 0:
        top = df.select(ts).orderBy(*_newest_first([ts])).limit(n)
        edge = top.agg(F.when(F.count(ts) >= n, F.min(ts)).alias("edge")).first().edge
        if edge is not None:
            df = df.filter(F.col(ts) >= F.lit(edge))
    return non_finite_to_null(_first_rows(df, ts, n, tiebreak))


def _first_rows(df: DataFrame, ts: str, n: int, tiebreak: Sequence[str] | None) -> DataFrame:
    return df.orderBy(*_newest_first([ts, *_tiebreak(df, ts, tiebreak)])).limit(n)


def latest_for_key(df: DataFrame, key: str, value, ts: str, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """The newest row of one key; empty if there is none."""
    return non_finite_to_null(_first_rows(key_filter(df, key, value), ts, 1, tiebreak))


def latest_per_key(df: DataFrame, key: str, ts: str, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """The newest row of every key.

    An aggregate rather than a ranking window: each task sends one row per key, so a key
    with very many rows costs no more than another.
    """
    newest = F.max_by(F.struct(*df.columns), F.struct(ts, *_tiebreak(df, ts, tiebreak)))
    return non_finite_to_null(df.groupBy(F.col(key).alias("_key")).agg(newest.alias("row")).select("row.*"))
