"""Where long repeats of a corpus may lie: common ground of the operators that remove repeated passages.

A window is a run of W symbols (bytes or words) of one text. The smallest hash among its
q-grams is its anchor; equal windows have the same anchor gram at the same place. Each
window belongs to one anchor, consecutive windows mostly to the same, so a few in a
hundred positions stand for all windows, and only windows whose anchors have equal grams
can be equal. The windows of an anchor cover a *context*:

* a context that occurs twice is settled: all its windows are repeated;
* a context whose gram occurs in other contexts only, or more than once as an anchor in this one, is
  open: the contexts of such a gram are sent together and searched by the operator's own index;
* all others are unique.

Anchors of one gram that follow each other, as in a run of one symbol or a line said over and
over, share a context of less than two windows' length more, so such a text has few anchors, too.

Texts themselves are never compared pairwise, and equal contexts are counted before they
are shuffled, so groups of copies of any size stay cheap.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackfuse.llm.words import CHUNK_BYTES, gram_hashes, trimmed, trimmed_group, utf8
from trackfuse.session import stage

#: Contexts that one task searches at a time.
SHARD_CONTEXTS = 4_000
#: A gram in more different contexts than this is not gathered: its windows are counted by hash, where equal ones
#: are added up before the shuffle.
HOT_CONTEXTS = 2_000
#: Symbols worked on at a time; longer texts are taken in overlapping parts.
MAX_SYMBOLS = 1 << 20
#: Shorter texts are taken together up to so many, whose arrays stay near the processor.
GROUP_SYMBOLS = 1 << 18
#: Parts into which the rows of a gram are dealt that has more than a thousandth of all.
HEAVY_PARTS = 256
_PLACE_BITS = np.uint64((1 << 24) - 1)


@dataclass(frozen=True)
class Passages:
    """What is removed, and how texts are read.

    ``parse`` makes a sequence of symbols of a text, ``symbols`` spread 64-bit numbers of any part of
    it, ``cut`` the bytes of its symbols ``[begin, end)``, and ``search`` finds, among contexts of
    one shard, the windows that occur twice.
    """

    window: int
    gram: int
    parse: Callable[[bytes], Sequence]
    symbols: Callable[[Sequence], np.ndarray]
    cut: Callable[[object, int, int], bytes]
    search: Callable[[list[bytes], int], list[np.ndarray]]


def _sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    span = 1
    while span * 2 <= n:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return x if span == n else np.minimum(x[: -(n - span)], x[n - span :])


def anchored_runs(symbols: np.ndarray, valid: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Each run of windows whose anchors have one gram: first window, number of windows, gram, several anchors or not.

    ``valid`` marks the windows that lie in one text. Ties go to the first gram. A run ends
    with the anchor at which it has as many windows as one anchor can have.
    """
    grams = gram_hashes(symbols, gram)
    keys = (grams & ~_PLACE_BITS) | np.arange(len(grams), dtype=np.uint64)
    anchors = (_sliding_min(keys, window - gram + 1) & _PLACE_BITS).astype(np.int64)
    starts = np.flatnonzero(valid[: len(anchors)])
    if not len(starts):
        return starts, starts, grams[:0], valid[:0]
    own = anchors[starts]
    apart = starts[1:] != starts[:-1] + 1
    at = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | apart)))
    value = grams[own[at]]
    fresh = np.concatenate(([True], (value[1:] != value[:-1]) | apart[at[1:] - 1]))
    chain = at[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]
    piece = (at - chain) // (window - gram + 1)
    head = np.flatnonzero(fresh | np.concatenate(([True], piece[1:] != piece[:-1])))
    several = np.diff(np.append(head, len(at))) > 1
    at = at[head]
    return starts[at], np.diff(np.append(at, len(starts))), value[head], several


def _parts(parsed: list, kind: Passages) -> Iterator[list[tuple[int, int, np.ndarray]]]:
    """Groups of (text, offset, symbols) of bounded size; parts of a text overlap by a window less one."""
    group, size, window = [], 0, kind.window
    for k, text in enumerate(parsed):
        for at in range(0, max(len(text) - window + 1, 0), MAX_SYMBOLS // 2):
            part = kind.symbols(text[at : at + MAX_SYMBOLS // 2 + window - 1])
            if group and size + len(part) > GROUP_SYMBOLS:
                yield group
                group, size = [], 0
            group.append((k, at, part))
            size += len(part)
    if group:
        yield group


def _anchors(base: DataFrame, kind: Passages, counting: bool) -> DataFrame:
    """A row per context: its gram, and unless ``counting`` its 128-bit hash, the text's key and the place.

    When counting, a context in which the gram is the anchor more than once has two rows.
    """
    window, gram = kind.window, kind.gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = utf8(batch.column(1))
            for begin, end in _ranges(raw):
                parsed = [kind.parse(t) if len(t) >= window else b"" for t in raw[begin:end]]
                for group in _parts(parsed, kind):
                    symbols = np.concatenate([part for _, _, part in group])
                    sizes = np.array([len(part) for _, _, part in group])
                    ends = np.cumsum(sizes)
                    valid = np.ones(len(symbols), bool)
                    for e in ends.tolist():
                        valid[max(e - window + 1, 0) : e] = False
                    first, n, grams, several = anchored_runs(symbols, valid, window, gram)
                    grams = grams.view(np.int64)
                    if counting:
                        grams = np.concatenate((grams, grams[several]))
                        yield pa.RecordBatch.from_arrays([pa.array(grams)], names=["gram"])
                        continue
                    part = np.searchsorted(ends, first, side="right")
                    owner = np.array([k for k, _, _ in group])[part] + begin
                    local = first - (ends - sizes)[part] + np.array([at for _, at, _ in group])[part]
                    view, digest = memoryview(symbols.view(np.uint8)), xxhash.xxh3_128_digest
                    bounds = zip((first * 8).tolist(), ((first + n + window - 1) * 8).tolist(), strict=True)
                    hashes = np.frombuffer(b"".join([digest(view[a:b]) for a, b in bounds]), np.int64).reshape(-1, 2)
                    rows = pa.array(owner)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(grams),
                            pa.array(np.ascontiguousarray(hashes[:, 0])),
                            pa.array(np.ascontiguousarray(hashes[:, 1])),
                            pc.take(batch.column(0), rows),
                            pc.take(batch.column(2), rows),
                            pa.array(local << 16 | n),
                            pa.array(several),
                        ],
                        names=["gram", "c1", "c2", "_id", "_hash", "place", "several"],
                    )

    if counting:
        return base.mapInArrow(trimmed(run), "gram bigint")
    id_kind = base.schema["_id"].dataType.simpleString()
    shape = f"gram bigint, c1 bigint, c2 bigint, _id {id_kind}, _hash bigint, place bigint, several boolean"
    return base.mapInArrow(trimmed(run), shape)


def _with_grams(rows: DataFrame, grams: DataFrame, weight: str, *spread: str) -> DataFrame:
    """Join by gram, of which ``grams``, a written table, says how many rows it has.

    Those with more than a thousandth of all rows, so less than a thousand, are dealt by the columns ``spread``, too.
    """
    total = grams.agg(F.sum(weight)).first()[0] or 0
    heavy = F.col("gram").isin([row[0] for row in grams.filter(F.col(weight) * 1000 > total).select("gram").collect()])
    part = F.when(heavy, F.pmod(F.xxhash64(*spread), F.lit(HEAVY_PARTS))).otherwise(F.lit(0).cast("bigint"))
    parts = F.when(heavy, F.sequence(F.lit(0).cast("bigint"), F.lit(HEAVY_PARTS - 1).cast("bigint")))
    parts = F.explode(F.coalesce(parts, F.array(F.lit(0).cast("bigint"))))
    return rows.withColumn("_part", part).join(grams.withColumn("_part", parts), ["gram", "_part"]).drop("_part")


def _ranges(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of the list with about ``CHUNK_BYTES`` in all."""
    begin = size = 0
    for i, t in enumerate(texts):
        if i > begin and size + len(t) > CHUNK_BYTES:
            yield begin, i
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield begin, len(texts)


def merged(spans: np.ndarray) -> np.ndarray:
    """Rows (begin, end) joined where they touch."""
    if len(spans) < 2:
        return spans
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    ends = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate(([True], spans[1:, 0] > ends[:-1]))
    at = np.flatnonzero(new)
    return np.stack([spans[at, 0], ends[np.append(at[1:], len(spans)) - 1]], axis=1)


def _left_join(texts: DataFrame, found: DataFrame) -> DataFrame:
    """Join by row key; ids may be null."""
    found = found.withColumnsRenamed({"_id": "_k_id", "_hash": "_k_hash"})
    same = F.col("_id").eqNullSafe(F.col("_k_id")) & (F.col("_hash") == F.col("_k_hash"))
    return texts.join(found, same, "left").drop("_k_id", "_k_hash")


def remove_repeats(
    docs: DataFrame,
    kind: Passages,
    finish: Callable[[object, bytes, np.ndarray], tuple],
    fields: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: Sequence[str] = (),
    shard_contexts: int = SHARD_CONTEXTS,
    hot_contexts: int = HOT_CONTEXTS,
) -> DataFrame:
    """Apply ``finish(parsed, text, spans)`` to every row: id, and ``fields`` as ``finish`` gives them.

    The columns of ``carry`` come along as they are, in a struct ``row``.

    ``spans`` has a row (begin, end) for each maximal run of symbols that lie in a window
    which starts anywhere else too. Rows are told apart by id and text: those with the same
    of both are copies and share all results, so ids may repeat or be null.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    row = [F.struct(*carry).alias("_row")] if carry else []
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text"), F.xxhash64(text).alias("_hash"), *row)
    base = rows.select("_id", "_text", "_hash")
    id_kind = base.schema["_id"].dataType.simpleString()
    window = kind.window

    repeated = _anchors(base, kind, True).groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1")
    # Written by itself, so that the join reads plain shuffles and can be split.
    repeated = stage(repeated, "grams")
    found = _with_grams(_anchors(base, kind, False), repeated, "n", "_id", "_hash", "place").drop("n")
    found = stage(found, "anchors")
    key = ["gram", "c1", "c2"]
    contexts = found.groupBy(*key).agg(
        F.count("*").alias("copies"),
        F.min(F.struct("_id", "_hash", "place")).alias("one"),
        F.max("several").alias("several"),
    )
    contexts = stage(contexts, "contexts")
    grams = contexts.groupBy("gram").agg(
        F.count("*").alias("different"), F.max(F.expr("several AND copies = 1")).alias("within")
    )
    grams = stage(grams.filter("different > 1 OR within").drop("within"), "open")
    searched = _with_grams(contexts, grams, "different", "c1").select(
        "one._id", "one._hash", "one.place", "gram", "copies", (F.col("different") > hot_contexts).alias("hot")
    )
    settled = found.join(contexts.filter("copies > 1").select(*key), key, "left_semi").select(
        "_id", "_hash", "place", F.lit(None).cast("bigint").alias("gram"), F.lit(0).alias("copies"), F.lit(False).alias("hot")
    )
    notes = (
        settled.unionByName(searched)
        .groupBy("_id", "_hash")
        .agg(F.collect_set(F.struct("place", "gram", "copies", "hot")).alias("notes"))
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = utf8(batch.column(1))
            notes = batch.column(3)
            done, open_text, spans_of, open_of = [], [], [], []
            for i, t in enumerate(raw):
                parsed = kind.parse(t)
                spans, contexts, waits = [], [], False
                for note in notes[i].as_py() or ():
                    first, n = note["place"] >> 16, note["place"] & 0xFFFF
                    end = first + n - 1 + window
                    if note["gram"] is None:
                        spans.append((first, end))
                    else:
                        waits |= note["copies"] == 1
                        contexts.append(
                            (note["gram"], note["copies"] == 1, note["hot"], first, kind.cut(parsed, first, end))
                        )
                spans = merged(np.array(spans, np.int64).reshape(-1, 2))
                done.append(None if waits else finish(parsed, t, spans))
                open_text.append(t.decode() if waits else None)
                spans_of.append(spans.ravel() if waits else None)
                open_of.append(contexts)
            blanks = (None,) * len(names)
            columns = list(zip(*(d or blanks for d in done), strict=True)) if done else [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(open_text, pa.string()),
                    pa.array(spans_of, pa.list_(pa.int64())),
                    pa.array([[dict(zip(_OPEN, c, strict=True)) for c in cs] for cs in open_of], _OPEN_TYPE),
                    *(pa.array(c, t) for c, t in zip(columns, arrow_types, strict=True)),
                    *batch.columns[4:],
                ],
                names=["_id", "_hash", "_text", "_spans", "_open", *names, *carried],
            )

    shape = _shape(spark, fields)
    names = shape.names
    arrow_types = [_ARROW[f.dataType.simpleString()] for f in shape.fields]
    carried = ["_row"] if carry else []
    noted = _left_join(rows, notes).select("_id", "_text", "_hash", "notes", *carried)
    opened_shape = _shape(
        spark,
        f"_id {id_kind}, _hash bigint, _text string, _spans array<bigint>, "
        f"_open array<struct<gram:bigint,own:boolean,hot:boolean,first:bigint,context:binary>>, {fields}",
    )
    own_shape = T.StructType([*([rows.schema["_row"]] if carry else [])])
    first_pass = stage(noted.mapInArrow(trimmed(read), T.StructType([*opened_shape, *own_shape])), "texts")
    out = [F.col("_row").alias("row")] if carry else []
    ready = first_pass.filter(F.col("_text").isNull()).select(F.col("_id").alias(id_col), *names, *out)
    waiting = first_pass.filter(F.col("_text").isNotNull()).select("_id", "_hash", "_text", "_spans", *carried)
    opened = first_pass.select("_id", "_hash", F.explode("_open").alias("c")).select("_id", "_hash", "c.*")
    more = _gathered(opened.filter(~F.col("hot")), kind, id_kind, shard_contexts).unionByName(
        _counted(opened.filter("hot"), kind, id_kind)
    )
    more = more.groupBy("_id", "_hash").agg(F.collect_set(F.struct("begin", "end")).alias("more"))

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t, own, added in zip(
                utf8(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True
            ):
                extra = [(s["begin"], s["end"]) for s in added or ()]
                spans = np.array([*zip(own[::2], own[1::2], strict=True), *extra], np.int64).reshape(-1, 2)
                rows.append(finish(kind.parse(t), t, merged(spans)))
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.array(c, t) for c, t in zip(columns, arrow_types, strict=True)),
                    *batch.columns[4:],
                ],
                names=["_id", *names, *carried],
            )

    joined = _left_join(waiting, more).select("_id", "_text", "_spans", "more", *carried)
    closed = joined.mapInArrow(trimmed(close), T.StructType([*_shape(spark, f"_id {id_kind}, {fields}"), *own_shape]))
    return ready.unionByName(closed.select(F.col("_id").alias(id_col), *names, *out))


def _shape(spark: SparkSession, fields: str) -> T.StructType:
    return spark.createDataFrame([], fields).schema


_OPEN = ("gram", "own", "hot", "first", "context")
_OPEN_TYPE = pa.list_(
    pa.struct(
        [("gram", pa.int64()), ("own", pa.bool_()), ("hot", pa.bool_()), ("first", pa.int64()), ("context", pa.binary())]
    )
)
_ARROW = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}


def _gathered(opened: DataFrame, kind: Passages, id_kind: str, shard_contexts: int) -> DataFrame:
    """Spans of repeated windows in open contexts; contexts of equal grams meet in one shard.

    A gram has at most ``HOT_CONTEXTS`` of them here, so shards stay near their intended size.
    """
    shards = max(1, -(-opened.count() // shard_contexts))
    window = kind.window

    def search(table: pa.Table) -> pa.Table:
        places, begins, ends = [], [], []
        found = kind.search(table.column("context").to_pylist(), window)
        firsts, own = table.column("first").to_pylist(), table.column("own").to_pylist()
        for i, starts in enumerate(found):
            if own[i] and len(starts):
                for a, b in runs_of(starts):
                    places.append(i)
                    begins.append(firsts[i] + a)
                    ends.append(firsts[i] + b + window)
        rows = pa.array(places, pa.int64())
        return pa.Table.from_arrays(
            [
                pc.take(table.column("_id"), rows),
                pc.take(table.column("_hash"), rows),
                pa.array(begins, pa.int64()),
                pa.array(ends, pa.int64()),
            ],
            names=["_id", "_hash", "begin", "end"],
        )

    return (
        opened.withColumn("_shard", F.pmod(F.xxhash64("gram"), F.lit(shards)))
        .groupBy("_shard")
        .applyInArrow(trimmed_group(search), f"_id {id_kind}, _hash bigint, begin bigint, end bigint")
    )


def runs_of(starts: np.ndarray) -> list[tuple[int, int]]:
    """Runs of consecutive numbers as (first, last)."""
    cut = np.flatnonzero(np.diff(starts) != 1)
    return list(zip(starts[np.concatenate(([0], cut + 1))].tolist(), starts[np.append(cut, -1)].tolist(), strict=True))


def _counted(opened: DataFrame, kind: Passages, id_kind: str) -> DataFrame:
    """The same for grams in very many contexts: windows are told apart by a 128-bit hash and counted."""
    window = kind.window

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, begins, hashes = [], [], []
            firsts = batch.column(2).to_pylist()
            for i, context in enumerate(batch.column(4).to_pylist()):
                parsed = kind.parse(context)
                n = len(kind.symbols(parsed)) - window + 1
                for k in range(n):
                    hashes.append(xxhash.xxh3_128_digest(kind.cut(parsed, k, k + window)))
                owners += itertools.repeat(i, n)
                begins += range(firsts[i], firsts[i] + n)
            rows = pa.array(owners, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pc.take(batch.column(0), rows),
                    pc.take(batch.column(1), rows),
                    pc.take(batch.column(3), rows),
                    pa.array(begins, pa.int64()),
                    pa.array(hashes, pa.binary()),
                ],
                names=["_id", "_hash", "own", "begin", "w"],
            )

    each = opened.select("_id", "_hash", "first", "own", "context").mapInArrow(
        windows, f"_id {id_kind}, _hash bigint, own boolean, begin bigint, w binary"
    )
    # Written by itself, so that the join reads plain shuffles and a window of very many texts can be split.
    twice = stage(each.groupBy("w").agg(F.count("*").alias("n")).filter("n > 1").select("w"), "windows")
    return (
        each.filter("own")
        .join(twice, "w")
        .select("_id", "_hash", "begin", (F.col("begin") + window).alias("end"))
    )
