"""Sharding along a Hilbert curve over quantised metadata."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackfuse.session import new_path, stage

#: Bits of each dimension on the grid.
BITS = 8


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points on a grid: ``cells`` has a row per point and a column per dimension.

    Skilling's transform ("Programming the Hilbert curve", 2004) on all points at once.
    """
    x = np.array(cells, dtype=np.int64).T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        q = 1 << level
        low = q - 1
        for i in range(n):
            set_ = (x[i] & q) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(set_, low, swap)
            if i:
                x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        q = 1 << level
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
    x ^= t
    index = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            index = (index << 1) | ((x[i] >> level) & 1)
    return index


def _cuts(docs: DataFrame, column: str, bits: int) -> list[float]:
    """Quantiles of a number column: at most ``2 ** bits`` values, from mergeable sketches."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = docs.agg(F.percentile_approx(F.col(column).cast("double"), shares, 2000).alias("q")).first().q
    return sorted(set(found or []))


def _cell(docs: DataFrame, column: str, bits: int) -> Column:
    """Grid place of a value: by quantile where values are numbers, by hash where they are names. Null is 0."""
    if isinstance(docs.schema[column].dataType, T.NumericType):
        cuts = F.array(*(F.lit(c) for c in _cuts(docs, column, bits))).cast("array<double>")
        value = F.col(column).cast("double")
        # Cuts are sorted, so the number of cuts up to a value is where it belongs.
        place = F.array_size(F.filter(cuts, lambda c: c <= value))
    else:
        place = F.pmod(F.xxhash64(F.col(column).cast("string")), F.lit(1 << bits))
    return F.when(F.col(column).isNull(), 0).otherwise(place).cast("int")


def hilbert_shards(
    docs: DataFrame,
    dims: Sequence[str] = ("lang", "source", "size"),
    n_shards: int = 40,
    id_col: str = "doc_id",
    text_col: str = "text",
    bits: int = BITS,
) -> DataFrame:
    """Cut the rows into ``n_shards`` runs along a Hilbert curve; run lengths differ by one row at most.

    Each of ``dims`` (columns of ``docs``, or ``size``: UTF-8 bytes of the text plus 16)
    is quantised to ``2 ** bits`` cells, numbers by quantile and names by hash. Rows are
    sorted by their cell's place on the curve, so a shard covers a compact region and
    its files have narrow value ranges in every dimension. Within a cell rows go by
    content and id: equal texts stand together, and a cell with any share of the rows is
    cut wherever the row count asks for it.

    Returns id, size, text_crc32 (unsigned, UTF-8), law ("rows"), shard, slot (gapless
    from 0 in each shard), grown_shard (null), curve.

    A null text has no bytes and the checksum of an empty one. Null dimensions share one
    cell. Repeated rows each get a place. Other columns are ignored, also if they are
    called like a result. An empty table gives an empty one; with fewer rows than shards
    the first shards have one row each.
    """
    size = F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long") + 16
    measured = docs.select(
        F.col(id_col).alias("_id"),
        size.alias("_size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit(""))).alias("_crc"),
        *(F.col(d).alias(f"_d{i}") if d != "size" else size.alias(f"_d{i}") for i, d in enumerate(dims)),
    )
    names = [f"_d{i}" for i in range(len(dims))]
    cells = measured.select("_id", "_size", "_crc", *(_cell(measured, c, bits).alias(c) for c in names))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grid = np.stack([batch.column(3 + i).to_numpy(zero_copy_only=False) for i in range(len(names))], axis=1)
            curve = pa.array(hilbert_index(grid, bits), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), curve], names=["_id", "_size", "_crc", "curve"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    placed = cells.mapInArrow(place, f"_id {kind}, _size bigint, _crc bigint, curve bigint")
    # Written once in order, so that a row's place holds whatever runs again later.
    order = ["curve", "_crc", "_size", "_id"]
    numbered = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    local = F.monotonically_increasing_id()
    numbered = stage(
        numbered.select("*", F.shiftright(local, 33).alias("_part"), local.bitwiseAND((1 << 33) - 1).alias("_nth")),
        "curve",
    )
    # One row per partition: as short as the shuffle is wide.
    counts = numbered.groupBy("_part").count().orderBy("_part").collect()
    starts, total = [], 0
    for row in counts:
        starts.append((row["_part"], total))
        total += row["count"]
    base, more = divmod(total, n_shards)
    starts = docs.sparkSession.createDataFrame(starts, "_part bigint, _start bigint")

    rank = F.col("_start") + F.col("_nth")
    head = more * (base + 1)
    in_head = F.col("_rank") < head
    shard = F.when(in_head, F.expr(f"_rank div {base + 1}")).otherwise(
        more + F.expr(f"(_rank - {head}) div {max(base, 1)}")
    )
    slot = F.when(in_head, F.col("_rank") % (base + 1)).otherwise((F.col("_rank") - head) % max(base, 1))
    return (
        numbered.join(F.broadcast(starts), "_part")
        .withColumn("_rank", rank)
        .select(
            F.col("_id").alias(id_col),
            F.col("_size").alias("size"),
            F.col("_crc").alias("text_crc32"),
            F.lit("rows").alias("law"),
            shard.cast("int").alias("shard"),
            slot.cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "curve",
        )
    )


def write_shards(docs: DataFrame, shards: DataFrame, path: str | None = None, id_col: str = "doc_id") -> str:
    """Write the rows of ``docs`` into a folder per shard, in slot order within files; ids must be unique.

    Returns the folder. Parquet footers then hold narrow ranges of every sharding dimension.
    """
    path = path or new_path(docs.sparkSession, "shards")
    placed = docs.join(shards.select(id_col, "shard", "slot"), id_col)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)
    return path
