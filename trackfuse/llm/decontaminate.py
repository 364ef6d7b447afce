"""Benchmark decontamination with a generalised suffix automaton over the test items' words."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackfuse.llm.words import alnum_words, sha256, text_of, trimmed, utf8
from trackfuse.session import stage

WINDOW = 10
#: Words of the items in one automaton; more items are taken in blocks, one pass each.
BLOCK_WORDS = 200_000
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


class SuffixAutomaton:
    """All word runs of the items, of which a state is the set of runs that end at the same places.

    ``runs`` has (name, words). Matching keeps the longest run that ends at the current
    word: ``read`` returns the new state and that length.
    """

    def __init__(self, runs: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary.setdefault
        items = [(name, [number(w, len(self.vocabulary)) for w in words]) for name, words in runs if words]
        self.n_words = max(len(self.vocabulary), 1)
        self.next: dict[int, int] = {}
        self.length, self.link = [0], [-1]
        moves: list[dict[int, int]] = [{}]
        for _, words in items:
            state = 0
            for w in words:
                state = self._extend(moves, state, w)
        self.next = {s * self.n_words + w: t for s, own in enumerate(moves) for w, t in own.items()}
        pairs = {a * self.n_words + b for _, words in items for a, b in pairwise(words)}
        self.pairs = np.array(sorted(pairs), np.int64)
        # Names by the state that holds a window, and by the state that holds a whole short item.
        self.windows: dict[int, set[str]] = {}
        self.short: dict[int, dict[int, set[str]]] = {}
        self.least = min((min(len(words), window) for _, words in items), default=0)
        for name, words in items:
            state, matched = 0, 0
            for w in words:
                state, matched = self.read(state, matched, w)
                if matched >= window:
                    self.windows.setdefault(self.cut(state), set()).add(name)
            if len(words) < window:
                self.short.setdefault(self._holding(state, len(words)), {}).setdefault(len(words), set()).add(name)

    @classmethod
    def of(cls, state: dict) -> SuffixAutomaton:
        """The automaton whose ``vars`` were sent."""
        made = object.__new__(cls)
        made.__dict__.update(state)
        return made

    def _extend(self, moves: list[dict[int, int]], last: int, w: int) -> int:
        length, link = self.length, self.link
        if w in moves[last]:
            known = moves[last][w]
            return known if length[known] == length[last] + 1 else self._split(moves, last, w, known)
        new = len(length)
        length.append(length[last] + 1)
        link.append(0)
        moves.append({})
        while last != -1 and w not in moves[last]:
            moves[last][w] = new
            last = link[last]
        if last != -1:
            known = moves[last][w]
            link[new] = known if length[known] == length[last] + 1 else self._split(moves, last, w, known)
        return new

    def _split(self, moves: list[dict[int, int]], last: int, w: int, known: int) -> int:
        """A copy of ``known`` for the shorter of its runs."""
        copy = len(self.length)
        self.length.append(self.length[last] + 1)
        self.link.append(self.link[known])
        moves.append(dict(moves[known]))
        self.link[known] = copy
        while last != -1 and moves[last].get(w) == known:
            moves[last][w] = copy
            last = self.link[last]
        return copy

    def read(self, state: int, matched: int, w: int) -> tuple[int, int]:
        get, n, link, length = self.next.get, self.n_words, self.link, self.length
        while (to := get(state * n + w)) is None:
            state = link[state]
            if state < 0:
                return 0, 0
            matched = length[state]
        return to, matched + 1

    def cut(self, state: int) -> int:
        """The state of the match's last ``window`` words."""
        return self._holding(state, self.window)

    def _holding(self, state: int, n: int) -> int:
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def scan(self, words: np.ndarray) -> tuple[list[int], set[str]]:
        """Spans of hit words, flat as begin, end, begin, end, and the names of the items met.

        ``words`` has a number per word, -1 for words of no item.
        """
        spans: list[int] = []
        names: set[str] = set()
        if not self.least or len(words) < self.least:
            return spans, names
        for begin, end in self._stretches(words):
            state = matched = 0
            for i, w in enumerate(words[begin:end].tolist(), begin):
                state, matched = self.read(state, matched, w)
                if matched >= self.window:
                    names |= self.windows[self.cut(state)]
                    self._mark(spans, i + 1 - self.window, i + 1)
                if self.short:
                    self._read_short(spans, names, state, matched, i + 1)
        return spans, names

    def _read_short(self, spans: list[int], names: set[str], state: int, matched: int, end: int) -> None:
        while state > 0:
            for n, who in self.short.get(state, {}).items():
                if n <= matched:
                    names |= who
                    self._mark(spans, end - n, end)
            state = self.link[state]
            matched = self.length[state]

    @staticmethod
    def _mark(spans: list[int], begin: int, end: int) -> None:
        # Ends only grow, so a new span swallows the latest ones it touches.
        while spans and spans[-1] >= begin:
            begin = min(begin, spans[-2])
            del spans[-2:]
        spans += (begin, end)

    def _stretches(self, words: np.ndarray) -> list[tuple[int, int]]:
        """Where a match of ``least`` words may lie: no match goes over a pair of words that no item has."""
        known = words >= 0
        if self.least <= 1:
            joined = known[:-1] & known[1:]
        else:
            pairs = words[:-1].astype(np.int64) * self.n_words + words[1:]
            at = np.searchsorted(self.pairs, pairs)
            joined = known[:-1] & known[1:] & (self.pairs[np.minimum(at, len(self.pairs) - 1)] == pairs)
        if self.least <= 1:
            inside = np.flatnonzero(np.diff(np.concatenate(([False], known, [False])).astype(np.int8)))
            return list(zip(inside[::2].tolist(), inside[1::2].tolist(), strict=True))
        edges = np.flatnonzero(np.diff(np.concatenate(([False], joined, [False])).astype(np.int8)))
        begins, ends = edges[::2], edges[1::2] + 1
        long = ends - begins >= self.least
        return list(zip(begins[long].tolist(), ends[long].tolist(), strict=True))


def _blocks(items: DataFrame, id_col: str, text_col: str, window: int, block_words: int) -> Iterator[SuffixAutomaton]:
    """An automaton for each block of items; one block's items are on the driver at a time.

    Items over half a block are cut into parts that overlap by a window less one word.
    """
    part = max(block_words // 2, 2 * window)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, parts, sizes = [], [], []
            for name, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                words = alnum_words(text)
                for at in range(0, max(len(words) - window + 1, 1), part):
                    own = words[at : at + part + window - 1]
                    names.append(name)
                    parts.append(b" ".join(own).decode())
                    sizes.append(len(own))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(parts, pa.string()), pa.array(sizes, pa.int64())],
                names=["name", "words", "n"],
            )

    cutted = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")), text_col)
    parts = cutted.mapInArrow(cut, "name string, words string, n bigint").filter("n > 0")
    total = parts.agg(F.sum("n").alias("n")).first().n or 0
    n_blocks = -(-total // block_words)
    if n_blocks <= 1:
        blocks = [parts]
    else:
        parts = stage(parts.withColumn("_block", F.pmod(F.xxhash64("name", "words"), F.lit(n_blocks))), "items")
        blocks = [parts.filter(F.col("_block") == i) for i in range(n_blocks)]
    for block in blocks:
        rows = block.select("name", "words").collect()
        yield SuffixAutomaton([(r["name"], r["words"].encode().split()) for r in rows], window)


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Words of documents that lie in a run of ``window`` words of a test item.

    Words are A-Z lower-cased runs of ASCII letters, digits and non-ASCII characters. An
    item of fewer than ``window`` words counts as a whole, one without words not at all.
    Returns per row: id, n_words, n_hit, items (sorted item ids as strings), spans (word
    numbers: begin, end, begin, end ...), and the columns of ``carry`` as they are, in a struct ``row``.

    The automaton of the items goes to every task; its size is bounded by ``block_words``.
    More items make more blocks, and the documents pass once by each. A document streams
    through as numbers: stretches of words whose neighbours stand side by side in some
    item are followed in the automaton, which keeps the longest match at each word.

    A null text has no words; a null item id counts as an empty name; rows of items with
    the same id count as one item. Repeated document rows are judged each, other columns
    are ignored, empty tables give no hits or no rows.
    """

    def scan(shared, first: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = SuffixAutomaton.of(shared.value)
            number = automaton.vocabulary.get
            for batch in batches:
                earlier = [None] * batch.num_rows if first else list(
                    zip(batch.column("items").to_pylist(), batch.column("spans").to_pylist(), strict=True)
                )
                sizes, items_of, spans_of = [], [], []
                for text, before in zip(utf8(text_of(batch, text_col)), earlier, strict=True):
                    words = alnum_words(text)
                    spans, names = automaton.scan(
                        np.fromiter((number(w, -1) for w in words), np.int32, len(words))
                    )
                    if before:
                        names |= set(before[0])
                        spans = _union(spans, before[1])
                    sizes.append(len(words))
                    items_of.append(sorted(names))
                    spans_of.append(spans)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        *(batch.column(batch.schema.get_field_index(c)) for c in carried),
                        pa.array(sizes, pa.int64()),
                        pa.array(items_of, pa.list_(pa.string())),
                        pa.array(spans_of, pa.list_(pa.int32())),
                    ],
                    names=["_id", *carried, "n_words", "items", "spans"],
                )

        return run

    row = [F.struct(*carry).alias("row")] if carry else []
    # A text that is carried is not sent a second time.
    text = [] if text_col in carry else [F.col(text_col).cast("string").alias("_text")]
    found = docs.select(F.col(id_col).alias("_id"), *text, *row)
    carried = found.columns[1:]
    schema = T.StructType([*found.schema]).add("n_words", T.LongType())
    schema = schema.add("items", T.ArrayType(T.StringType())).add("spans", T.ArrayType(T.IntegerType()))
    context, first = docs.sparkSession.sparkContext, True
    for automaton in _blocks(items, item_id_col, item_text_col, window, block_words):
        if not first:
            found = stage(found, "leaks")
        found = found.mapInArrow(trimmed(scan(context.broadcast(vars(automaton)), first)), schema)
        first = False
    hit = F.aggregate(
        F.sequence(F.lit(0), F.array_size("spans") - 2, F.lit(2)),
        F.lit(0).cast("long"),
        lambda n, i: n + (F.get("spans", i + 1) - F.get("spans", i)).cast("long"),
    )
    n_hit = F.when(F.array_size("spans") > 0, hit).otherwise(F.lit(0).cast("long"))
    return found.select(F.col("_id").alias(id_col), "n_words", n_hit.alias("n_hit"), "items", "spans", *(["row"] if carry else []))


def _union(a: list[int], b: list[int]) -> list[int]:
    out: list[int] = []
    for begin, end in sorted([*zip(a[::2], a[1::2], strict=True), *zip(b[::2], b[1::2], strict=True)]):
        if out and begin <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += (begin, end)
    return out


def without_spans(text: bytes, spans: list[int]) -> bytes:
    """The text without the words of the spans and what stands between them."""
    places = [m.span() for m in _WORD.finditer(text)]
    out, at = [], 0
    for begin, end in zip(spans[::2], spans[1::2], strict=True):
        out.append(text[at : places[begin][0]])
        at = places[end - 1][1]
    return b"".join([*out, text[at:]])


def remove_leaks(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", coverage: float = 0.5, **options
) -> DataFrame:
    """Documents without the words in leaks: id, text, n_words, n_hit; those hit beyond ``coverage`` go whole."""
    found = find_leaks(docs, items, id_col, text_col, carry=[text_col], **options)

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                t if not s else without_spans(t.encode(), s).decode()
                for t, s in zip(batch.column(1).to_pylist(), batch.column(4).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), batch.column(2), batch.column(3)],
                names=[id_col, text_col, "n_words", "n_hit"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    kept = found.filter((F.col("n_hit") == 0) | (F.col("n_hit") <= F.col("n_words") * coverage))
    text = F.col("row")[text_col].cast("string").alias(text_col)
    return kept.select(id_col, text, "n_words", "n_hit", "spans").mapInArrow(
        strip, f"`{id_col}` {kind}, `{text_col}` string, n_words bigint, n_hit bigint"
    )


def items_digest(names: pa.Array) -> list[str]:
    return [sha256(",".join(n).encode()) for n in names.to_pylist()]
