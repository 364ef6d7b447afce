"""Where the queries register, and what they share."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackfuse.session import configure, new_path
from trackfuse.sources.scans import as_glob, ordered_stream, table_stream
from trackfuse.streaming.sinks import append_files, finish

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
ONCE = {"availableNow": True}
# Rows of a replay's micro-batch, and the most batches: each goes over the state, and over static tables it joins.
BATCH_ROWS = 4_000_000
MOST_BATCHES = 16
MOST_FILES = 64


def query(name: str, sql: str | None = None):
    """Register a query under ``name``; ``sql`` is what it must equal on the same tables."""

    def register(make):
        @functools.wraps(make)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return make(configure(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a file stream; all its files come as one batch unless told otherwise."""
    path = f"{sf_dir}/{name}.parquet"
    return table_stream(spark, as_glob(path), spark.read.parquet(path).schema)


def streams_in_order(spark: SparkSession, sf_dir: str, times: dict[str, tuple[str, str]]) -> list[DataFrame]:
    """Tables (name -> columns with time and key) as streams in the order of their times, in as many batches each.

    A stream of a table as it lies must take all its rows in one batch, since rows older than the watermark are
    dropped in later ones: then every row is state. In order, state is what the window needs. Few rows are one batch, without a copy.
    """
    tables = {name: table(spark, sf_dir, name) for name in times}
    batches = min(MOST_BATCHES, -(-sum(df.count() for df in tables.values()) // BATCH_ROWS))
    if batches <= 1:
        return [stream(spark, sf_dir, name) for name in times]
    per_batch = min(spark.sparkContext.defaultParallelism, MOST_FILES)
    return [
        ordered_stream(df, time, new_path(spark, f"{name}_in_order"), batches * per_batch, per_batch, key)
        for df, (name, (time, key)) in zip(tables.values(), times.items(), strict=True)
    ]


def replay(df: DataFrame, name: str) -> DataFrame:
    """Run a stream over all there is into files and read them back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    finish(append_files(df, path, new_path(spark, f"{name}_checkpoint"), trigger=ONCE))
    return spark.read.schema(df.schema).parquet(path)


def no_zone(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the test tables hold them."""
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n, kind in df.dtypes if kind == "timestamp"})


def written(df: DataFrame, name: str, fmt: str = "parquet", **options) -> str:
    """Write a batch to a new folder; returns the path."""
    path = new_path(df.sparkSession, name)
    df.write.format(fmt).options(**options).save(path)
    return path
