"""Places of rows within their group, where one group may hold any share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackfuse.operators.skew import fits_broadcast
from trackfuse.session import stage


def numbered(rows: DataFrame, group: str, order: Sequence[str], name: str = "numbered") -> DataFrame:
    """``rows`` with ``idx``, the place in its group (from 0, by ``order``), and ``total``, the group's size.

    Rows are cut into ranges of group and order, sorted, and written once with their
    place in the range, so that numbers hold whatever runs again later. A group of any size
    spreads over many ranges; what is added up per group is one count for each range it
    touches. Nulls come first, strings go by their UTF-8 bytes, and a null group is a group.
    """
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    local = F.monotonically_increasing_id()
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = stage(
        placed.select("*", F.shiftright(local, 33).alias("_part"), local.bitwiseAND((1 << 33) - 1).alias("_nth")), name
    )
    counts = placed.groupBy(group, "_part").agg(F.count("*").alias("_n"), F.min("_nth").alias("_first"))
    own = Window.partitionBy(group)
    before = own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")
    counts = stage(
        counts.select(
            F.col(group).alias("_group"), F.col("_part").alias("_at"), start.alias("_start"), F.sum("_n").over(own).alias("total")
        ),
        f"{name}_counts",
    )
    # Without a broadcast a key is a group's rows in one range, which one task has already sorted.
    counts = F.broadcast(counts) if fits_broadcast(counts) else counts.hint("merge")
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_at"))
    joined = placed.join(counts, same)
    return joined.select(*rows.columns, (F.col("_start") + F.col("_nth")).alias("idx"), "total")
