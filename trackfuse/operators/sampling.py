"""Bootstrap and split of training rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackfuse.functions.draws import uniform_draw
from trackfuse.session import stage

#: Equal rows that are drawn by one task; more of them are drawn in several parts.
PART_ROWS = 100_000


def bootstrap_sample(df: DataFrame, fraction: float = 1.0, seed: int = 42) -> DataFrame:
    """Rows drawn with replacement; ``fraction`` 1.0 draws about as many as there are."""
    return df.sample(withReplacement=True, fraction=fraction, seed=seed)


def poisson_steps(mean: float) -> list[float]:
    """The probabilities of at most 0, 1, 2, ... draws, as long as they can be told from 1."""
    steps, term, total, n = [], math.exp(-mean), 0.0, 0
    while True:
        total += term
        if total >= 1 - 1e-15 or (n > mean and term < 1e-18):
            return steps
        steps.append(total)
        n += 1
        term *= mean / n


def poisson_count(draw: Column, mean: float) -> Column:
    """How often a row is drawn, from an even draw of 0 to 1: a Poisson number."""
    if not 0 <= mean <= 100:
        raise ValueError("0 to 100 draws per row")
    total = F.lit(0)
    for step in poisson_steps(mean):
        total = total + (draw >= F.lit(step)).cast("int")
    return total


def poisson_bootstrap(
    df: DataFrame, fraction: float = 1.0, seed: int = 42, by: Sequence[str] | None = None, part_rows: int = PART_ROWS
) -> DataFrame:
    """Rows drawn with replacement, each ``fraction`` times on average: the same draw however rows are partitioned.

    How often a row comes depends on its values, as text, the seed, and which of the rows equal to it it is. So the draw needs no written copy: it comes out the same when it is computed
    again, read in another order, or run on another cluster. Rows equal in all columns are counted first, combined
    map-side, and a great many of them are drawn in parts by several tasks. ``by`` names columns that no two rows share,
    a key: then nothing is counted or shuffled.
    """
    names = df.columns

    def drawn(rows: DataFrame, values: Sequence[str]) -> DataFrame:
        count = poisson_count(uniform_draw([*values, "_nth"], seed), fraction)
        times = F.explode(F.sequence(F.lit(1), F.when(F.col("_times") > 0, F.col("_times"))))
        return rows.withColumn("_times", count).withColumn("_copy", times).select(*names)

    if by is not None:
        return drawn(df.withColumn("_nth", F.lit(1)), by)
    counts = df.groupBy(*names).agg(F.count("*").alias("_n"))
    nth = F.explode(F.sequence(F.col("_from"), F.least(F.col("_from") + part_rows - 1, F.col("_n"))))
    few = counts.filter(F.col("_n") <= part_rows).withColumn("_from", F.lit(1).cast("bigint"))
    many = counts.filter(F.col("_n") > part_rows)
    many = many.withColumn("_from", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"), F.lit(part_rows).cast("bigint"))))
    many = many.repartition(*names, "_from")
    return drawn(few.unionByName(many).withColumn("_nth", nth), names)


def random_split(
    df: DataFrame, test: float = 0.2, seed: int = 45, split_by: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(train, test)``: disjoint and complete.

    The draw is written with the rows, so both parts rest on one and the same draw even
    if the input would come out in another order when it is computed again. With
    ``split_by`` all rows of an entity fall on the same side.
    """
    if split_by is None:
        draw = F.rand(seed)
    else:
        draw = F.pmod(F.xxhash64(F.lit(seed), F.col(split_by)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = stage(df.withColumn("_draw", draw), "split")
    return drawn.filter(F.col("_draw") >= test).drop("_draw"), drawn.filter(F.col("_draw") < test).drop("_draw")
