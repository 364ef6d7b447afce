"""Best-fit packing of documents into sequences of a fixed capacity, planned on length counts."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackfuse.llm.pretokens import PieceTable
from trackfuse.llm.token_counts import chunks
from trackfuse.llm.words import trimmed
from trackfuse.session import stage

CAPACITY = 4096


class BinPlan:
    """Which items go to which sequence, in terms of counts per length.

    ``steps`` has rows (length, first rank, sequences, items per sequence, first
    sequence, offset): the items of that length, from that rank on, fill so many
    consecutive sequences from that offset on. Both the work and the number of steps
    depend on the capacity, not on the number of items: a step uses up a length, or
    leaves the gap of its sequences below the length it placed, hence less than half of
    what it was.
    """

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = dict(counts)
        self.rank = dict.fromkeys(counts, 0)
        self.steps: list[tuple[int, int, int, int, int, int]] = []
        self.sequences = 0
        self.gaps: dict[int, list[tuple[int, int]]] = {}
        self.sizes: list[int] = []
        large = sorted(n for n in counts if 3 * n > capacity)
        self._pair(large)
        for length in sorted((n for n in counts if 3 * n <= capacity), reverse=True):
            self._fill(length)

    def _place(self, length: int, sequences: int, each: int, first: int, offset: int) -> None:
        self.steps.append((length, self.rank[length], sequences, each, first, offset))
        self.rank[length] += sequences * each
        self.left[length] -= sequences * each

    def _gap(self, first: int, n: int, gap: int) -> None:
        if n and gap:
            if gap not in self.gaps:
                insort(self.sizes, gap)
            self.gaps.setdefault(gap, []).append((first, n))

    def _open(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def _pair(self, large: list[int]) -> None:
        """Items over a third of the capacity: at most two share a sequence.

        From the longest on, each takes the longest partner that still fits, which gives
        as many pairs as there can be.
        """
        while large:
            length = large[-1]
            n = self.left[length]
            at = bisect_left(large, self.capacity - length + 1) - 1
            if n == 1 and at == len(large) - 1:
                at -= 1  # not with itself
            partner = large[at] if at >= 0 else None
            if partner == length:
                first = self._open(n // 2)
                self._place(length, n // 2, 2, first, 0)
                self._gap(first, n // 2, self.capacity - 2 * length)
            else:
                n = n if partner is None else min(n, self.left[partner])
                first = self._open(n)
                self._place(length, n, 1, first, 0)
                if partner is not None:
                    self._place(partner, n, 1, first, length)
                self._gap(first, n, self.capacity - length - (partner or 0))
            if partner is not None and not self.left[partner]:
                large.remove(partner)
            if partner != length and not self.left[length]:
                large.pop()

    def _fill(self, length: int) -> None:
        """Shorter items, longest first: into the tightest gap that takes one."""
        while n := self.left[length]:
            at = bisect_left(self.sizes, length)
            if at == len(self.sizes):
                each = self.capacity // length
                opened = -(-n // each)
                self._gap(self._open(opened), opened, self.capacity)
                continue
            gap = self.sizes[at]
            first, wide = self.gaps[gap].pop()
            if not self.gaps[gap]:
                del self.gaps[gap], self.sizes[at]
            each = gap // length
            full = min(wide, n // each)
            if full:
                self._place(length, full, each, first, self.capacity - gap)
                self._gap(first, full, gap - each * length)
            else:
                self._place(length, 1, n, first, self.capacity - gap)
                self._gap(first, 1, gap - n * length)
                full = 1
            self._gap(first + full, wide - full, gap)


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = 1,
    with_ids: bool = False,
) -> DataFrame:
    """Each document's ids and the end id, cut into pieces of at most ``capacity``.

    ``part`` and ``nth`` number the pieces of equal length that a task makes.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = PieceTable.of(tokenizer, "ids")
        end = np.array([end_id], "<u4").tobytes()
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        width = 4 * capacity
        for batch in batches:
            column, rows, at = pc.fill_null(batch.column(1), ""), [], 0
            for texts in chunks(column.to_pylist()):
                of = table.renew().__getitem__
                for text in texts:
                    mine = table.words(text)
                    ids = (table.whole(text) if mine is None else b"".join(map(of, mine))) + end
                    for piece, begin in enumerate(range(0, len(ids), width)):
                        own = ids[begin : begin + width]
                        length = len(own) // 4
                        row = (at, piece, begin // 4, length, zlib.crc32(own), seen[length])
                        rows.append((*row, own) if with_ids else row)
                        seen[length] += 1
                    at += 1
            columns = list(zip(*rows, strict=True)) or [()] * (7 if with_ids else 6)
            out = [pc.take(batch.column(0), pa.array(columns[0], pa.int64())), pa.array(columns[1], pa.int32())]
            out += [pa.array(c, pa.int64()) for c in columns[2:6]]
            out.append(pa.array(np.full(len(rows), part), pa.int32()))
            names = [id_col, "piece", "start", "length", "ids_crc32", "nth", "part"]
            if with_ids:
                out.append(pa.array([np.frombuffer(b, "<u4").astype(np.int32) for b in columns[6]], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    fields = f"`{id_col}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, nth bigint, part int"
    return docs.select(id_col, text_col).mapInArrow(trimmed(cut), fields + (", ids array<int>" if with_ids else ""))


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = 1,
    with_ids: bool = False,
) -> DataFrame:
    """Pack all documents into few sequences of at most ``capacity`` ids.

    Returns per piece: id, piece, start, length, ids_crc32, sequence_id, offset, and the
    ids themselves with ``with_ids``. Only documents over ``capacity`` are cut.

    The pieces are written once, each with its number among those of its length. The
    plan is made from the counts per length, ``capacity`` numbers at most, so it sees the
    whole corpus and yet is of bounded size: pieces over a third of the capacity are
    paired, shorter ones go best-fit into the gaps. A piece then finds its place from
    its length and number alone; no group of equal lengths meets in one task.

    A null or empty text is a document of the end id alone. Repeated rows are packed each.
    Other columns are ignored; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    pieces = stage(token_pieces(docs, tokenizer, id_col, text_col, capacity, end_id, with_ids), "pieces")
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    counts = stage(counts, "lengths")
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    # One row per task and length.
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    plan = BinPlan(totals, capacity)
    lengths = sorted(totals)
    starts = dict(zip(lengths, np.cumsum([0] + [totals[n] for n in lengths])[:-1].tolist(), strict=True))
    steps = sorted((starts[s[0]] + s[1], *s) for s in plan.steps)
    shared = spark.sparkContext.broadcast((starts, np.array(steps, np.int64).reshape(-1, 7)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, steps = shared.value
        first_of = np.zeros(capacity + 1, np.int64)
        for length, start in starts.items():
            first_of[length] = start
        for batch in batches:
            length, nth, base = (
                batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "nth", "base")
            )
            rank = base + nth
            step = steps[np.searchsorted(steps[:, 0], first_of[length] + rank, side="right") - 1]
            nth_in_step = rank - step[:, 2]
            sequence = step[:, 5] + nth_in_step // step[:, 4]
            offset = step[:, 6] + nth_in_step % step[:, 4] * length
            kept = [batch.column(i) for i in range(batch.num_columns - 3)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=[*batch.schema.names[:-3], "sequence_id", "offset"],
            )

    own = [c for c in pieces.columns if c not in ("nth", "part")]
    ranked = pieces.join(bases.hint("merge"), ["length", "part"]).select(*own, "nth", "base", "part")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema.fields[:-3])
    return ranked.mapInArrow(trimmed(place), fields + ", sequence_id bigint, offset bigint")
