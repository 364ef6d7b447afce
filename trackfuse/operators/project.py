"""Projections and filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flatten(df: DataFrame, paths: Mapping[str, str | Column]) -> DataFrame:
    """Pick (nested) fields: output name -> dotted path or column."""
    return df.select(*((F.col(p) if isinstance(p, str) else p).alias(name) for name, p in paths.items()))


def expand(df: DataFrame, col: str = "data") -> DataFrame:
    """All fields of a struct column as columns."""
    return df.select(f"{col}.*")


def rename_drop(df: DataFrame, renames: Mapping[str, str], drop: Sequence[str] = ()) -> DataFrame:
    return df.drop(*drop).withColumnsRenamed(dict(renames))


def project_contract(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly ``columns`` in that order; a missing one is an error when the plan is made."""
    return df.select(*columns)


def drop_derived(df: DataFrame, suffixes: Sequence[str] = ("_idx", "_vec"), names: Sequence[str] = ("features",)):
    """Without the helper columns that a fitted model adds."""
    return df.select(*(c for c in df.columns if not c.endswith(tuple(suffixes)) and c not in names))


def before_event(df: DataFrame, obs_ts: str, event_ts: str, keep_open: bool = False) -> DataFrame:
    """Observations strictly before the event happened.

    A null event time drops the row; with ``keep_open`` it counts as still to come.
    """
    early = F.col(obs_ts) < F.col(event_ts)
    return df.filter(early | F.col(event_ts).isNull() if keep_open else early)


def key_filter(df: DataFrame, key: str, value) -> DataFrame:
    """Equality on one id; a typed literal, so it reaches the scan and cannot be spliced."""
    return df.filter(F.col(key) == F.lit(value))
