"""Exact Jaccard join of word n-gram sets, by set relations.

The scheme follows Wang et al., "Leveraging set relations in exact set similarity join"
(2017): index lists are skipped in blocks by size and position, and a set's overlaps are
derived from those of a similar set that has been answered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackfuse.llm.components import connected_components
from trackfuse.llm.words import CHUNK_BYTES, SpacedNumbers, gram_hashes, mix, trimmed, trimmed_group, utf8
from trackfuse.session import stage

SHINGLE = 5
PERCENT = 80
#: Tokens that go last in the common order because they are frequent: at most so many.
MAX_FREQUENT = 20_000
#: A set is compared at once with all of its first lists, if so large a share of its first tokens is in lists.
FIRST_LISTS = 3
MOSTLY_SHARED = 0.3
#: Sets that a task compares at once, and rows of one cell of a list.
CELL_SETS = 4_000
HUBS = 16
CELL_ROWS = 3_000
SHARD_ROWS = 20_000
#: Bits of the parity sketch of a set of up to ``SKETCH_SET`` tokens; larger sets have more.
SKETCH_BITS = 512
SKETCH_SET = 400


def shingles(words: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct numbers of the runs of ``n`` words; shorter texts are one run as a whole."""
    if not len(words):
        return words
    found = np.sort(gram_hashes(words, n) if len(words) >= n else mix(gram_hashes(words, len(words)) + np.uint64(n)))
    return found[np.concatenate(([True], found[1:] != found[:-1]))]


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    """So many first tokens, in any common order, that linked sets share one of them."""
    return n - -(-n * percent // 100) + 1


def sketch(tokens: np.ndarray) -> np.ndarray:
    """Parities of the tokens' hash cells: two sets differ in at least as many tokens as their sketches in bits."""
    bits = SKETCH_BITS
    while bits * SKETCH_SET < len(tokens) * SKETCH_BITS:
        bits *= 2
    parity = (np.bincount((tokens >> np.uint64(20)).astype(np.int64) & (bits - 1), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(parity, bitorder="little").view(np.uint64)


def folded(x: np.ndarray, words: int) -> np.ndarray:
    """A sketch of ``words`` words, as a shorter one would have come out."""
    while x.shape[-1] > words:
        half = x.shape[-1] // 2
        x = x[..., :half] ^ x[..., half:]
    return x


def local_links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that join up all linked sets of a list (as few as that takes), by index lists of their tokens.

    Sets are answered one after the other. A set's overlaps with all others are either
    added up from its tokens' index lists, or derived from the overlaps of the set before
    it by the lists of the tokens in which the two differ, whichever reads less.
    """
    k = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    if k == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return [(0, 1)] if 100 * both >= percent * (sizes.sum() - both) else []
    tokens = np.concatenate(sets)
    owners = np.repeat(np.arange(k), sizes)
    order = np.argsort(tokens, kind="stable")
    tokens, owners = tokens[order], owners[order]
    firsts = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
    ends = np.append(firsts[1:], len(tokens))
    row_of = np.empty(len(tokens), np.int64)
    row_of[order] = np.repeat(np.arange(len(firsts)), ends - firsts)
    shared = ends - firsts > 1
    cuts = np.concatenate(([0], np.cumsum(sizes)))
    # Each set as the index rows that it shares with others.
    rows = [r[shared[r]] for r in (row_of[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True))]

    def added(own: np.ndarray) -> np.ndarray:
        if not len(own):
            return np.zeros(k, np.int64)
        return np.bincount(np.concatenate([owners[firsts[r] : ends[r]] for r in own.tolist()]), minlength=k)

    links, parent = [], list(range(k))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    # Similar sets mostly have the same least row, so they come next to each other.
    last, overlap = None, None
    for x in sorted(range(k), key=lambda i: rows[i][:4].tolist()):
        if last is not None:
            more = np.setdiff1d(rows[x], rows[last], assume_unique=True)
            less = np.setdiff1d(rows[last], rows[x], assume_unique=True)
        if last is not None and len(more) + len(less) < len(rows[x]):
            overlap = overlap + added(more) - added(less)
        else:
            overlap = added(rows[x])
        last = x
        for y in np.flatnonzero(100 * overlap >= percent * (sizes[x] + sizes - overlap)).tolist():
            a, b = root(x), root(y)
            if a != b:
                parent[a] = b
                links.append((x, y))
    return links


def skipped_pairs(
    sizes: np.ndarray,
    places: np.ndarray,
    roots: np.ndarray,
    sketches: list[np.ndarray],
    percent: int,
    block: int = 128,
    groups: np.ndarray | None = None,
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of one token's index list that may be linked and are not known to be connected; also their least distance.

    Entries come by size. A block of them meets only the entries whose sizes can go with
    it; of these, pairs go whose places of the token in the two sets leave too few
    tokens to share, and pairs whose sketches differ too much. Pairs that are in one of
    ``groups`` when their part of a block is reached are passed by: the caller may join groups up in between.
    """
    order = np.lexsort((places, sizes))
    sizes, places, roots = sizes[order], places[order], roots[order]
    widths = np.array([len(sketches[k]) for k in order])
    begin = 0
    while begin < len(sizes):
        # A block's sketches are of one length, the others are folded to it.
        end = min(begin + block, int(np.searchsorted(widths, widths[begin], side="right")))
        to = int(np.searchsorted(sizes, sizes[end - 1] * 100 // percent, side="right"))
        width = int(widths[begin])
        base, a, b = begin, slice(begin, end), slice(begin, to)
        begin = end
        n = sizes[a, None] + sizes[None, b]
        before = np.minimum(places[a, None], places[None, b])
        after = np.minimum((sizes - places)[a, None], (sizes - places)[None, b])
        ok = (roots[a, None] != roots[None, b]) & (np.arange(base, end)[:, None] < np.arange(base, to)[None, :])
        ok &= (before + after) * (100 + percent) >= n * percent
        ok &= sizes[a, None] * 100 >= sizes[None, b] * percent
        if groups is not None:
            ok &= groups[order[a], None] != groups[None, order[b]]
        i, j = np.nonzero(ok)
        if not len(i):
            continue
        bits = np.stack([folded(sketches[k], width) for k in order[b].tolist()])
        # Joined up as they come, near copies leave few pairs to look at after the first ones.
        step = max(1, (400_000 if groups is None else 100_000) // width)
        for part in range(0, len(i), step):
            p, q = i[part : part + step], j[part : part + step]
            if groups is not None:
                new = groups[order[base + p]] != groups[order[base + q]]
                p, q = p[new], q[new]
            apart = np.bitwise_count(bits[p] ^ bits[q]).sum(axis=1, dtype=np.int64)
            near = apart * (100 + percent) <= n[p, q] * (100 - percent)
            yield order[base + p[near]], order[base + q[near]], apart[near]


class _Reader:
    """Shingle sets of texts."""

    def __init__(self, n: int):
        self.numbers, self.n = SpacedNumbers(), n

    def sets(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        for words in self.numbers.of(texts):
            yield shingles(words, self.n)


def _set_hash(tokens: np.ndarray) -> tuple[int, int]:
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(tokens.tobytes()), np.int64).tolist())


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def _measure(base: DataFrame, n: int) -> DataFrame:
    """A row per document: n, set hash; and rows of tokens that are frequent within a part of the texts, with counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(n)
        for batch in batches:
            sizes, hashes, part, size = [], [], [], 0
            frequent = []
            raw = utf8(batch.column(1))
            for i, (t, tokens) in enumerate(zip(raw, reader.sets(raw), strict=True)):
                sizes.append(len(tokens))
                hashes.append(_set_hash(tokens))
                part.append(tokens)
                size += len(t)
                if size > CHUNK_BYTES or i + 1 == len(raw):
                    found, counts = np.unique(np.concatenate(part), return_counts=True)
                    least = max(3, len(part) // 400)
                    frequent.append((found[counts >= least], counts[counts >= least]))
                    part, size = [], 0
            hashes = np.array(hashes, np.int64).reshape(-1, 2)
            rows = batch.num_rows
            found = np.concatenate([f for f, _ in frequent] or [np.empty(0, np.uint64)])
            counts = np.concatenate([c for _, c in frequent] or [np.empty(0, np.int64)])
            for cols, length in (
                ([batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), *map(pa.array, hashes.T.copy())], rows),
                ([_signed(found), counts], len(found)),
            ):
                kinds = [batch.column(0).type, *[pa.int64()] * 6]
                nulls = [pa.nulls(length, k) for k in kinds]
                if len(cols) == 2:
                    nulls[5:] = [pa.array(cols[0]), pa.array(cols[1], pa.int64())]
                else:
                    nulls[:5] = cols
                yield pa.RecordBatch.from_arrays(nulls, names=_MEASURED)

    kind = base.schema["_id"].dataType.simpleString()
    return base.mapInArrow(trimmed(run), f"_id {kind}, " + ", ".join(f"{c} bigint" for c in _MEASURED[1:]))


_MEASURED = ["_id", "_hash", "n", "h1", "h2", "token", "times"]


def _prefixes(base: DataFrame, n: int, percent: int, late) -> DataFrame:
    """A row per document: set hash, size, and the first tokens in the common order (frequent ones late, else by number)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, last = _Reader(n), late.value
        for batch in batches:
            sizes, hashes, firsts = [], [], []
            for tokens in reader.sets(utf8(batch.column(0))):
                hashes.append(_set_hash(tokens))
                sizes.append(len(tokens))
                firsts.append(_signed(ordered(tokens, last)[: prefix_length(len(tokens), percent)]) if len(tokens) else [])
            hashes = np.array(hashes, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, hashes.T.copy()), pa.array(sizes, pa.int64()), pa.array(firsts, pa.list_(pa.int64()))],
                names=["h1", "h2", "n", "first"],
            )

    return base.select("_text").mapInArrow(trimmed(run), "h1 bigint, h2 bigint, n bigint, first array<bigint>")


def ordered(tokens: np.ndarray, late: np.ndarray) -> np.ndarray:
    """Tokens in the common order; both arguments are sorted."""
    if not len(late):
        return tokens
    at = np.minimum(np.searchsorted(late, tokens), len(late) - 1)
    is_late = late[at] == tokens
    return np.concatenate([tokens[~is_late], tokens[is_late]])


def _packed_texts(base: DataFrame) -> DataFrame:
    """The texts compressed one by one: shuffled and stored, they take less than their sets or themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            packed = pa.array([pack(t) for t in utf8(batch.column(1))], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), packed], names=["_id", "_hash", "packed"])

    kind = base.schema["_id"].dataType.simpleString()
    return base.mapInArrow(trimmed(run), f"_id {kind}, _hash bigint, packed binary")


def _unpacked(column: pa.Array, reader: _Reader) -> list[np.ndarray]:
    unpack = zstandard.ZstdDecompressor().decompress
    return list(reader.sets([unpack(b) for b in column.to_pylist()]))


def _sketched(chosen: DataFrame, n: int) -> DataFrame:
    """The chosen texts with the size and the sketch of their sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(n)
        for batch in batches:
            sizes, sketches = [], []
            for at in range(0, batch.num_rows, 500):
                sets = _unpacked(batch.column(2).slice(at, 500), reader)
                sizes += [len(s) for s in sets]
                sketches += [sketch(s).tobytes() for s in sets]
            made = [pa.array(sizes, pa.int64()), pa.array(sketches, pa.binary())]
            names = ["h1", "h2", "packed", "mostly", "n", "sketch"]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=names)

    return chosen.mapInArrow(
        trimmed(run), "h1 bigint, h2 bigint, packed binary, mostly boolean, n bigint, sketch binary"
    )


def _compare_lists(rows: DataFrame, shards: int, n: int, percent: int) -> DataFrame:
    """Links found within each list (list, node, packed); several lists make a shard."""

    def run(table: pa.Table) -> pa.Table:
        key = table.column("list").to_numpy()
        nodes = table.column("node").to_numpy()
        texts, reader = table.column("packed"), _Reader(n)
        order = np.lexsort((nodes, key))
        cuts = np.flatnonzero(np.concatenate(([True], key[order][1:] != key[order][:-1], [True])))
        u, v = [], []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            own = order[a:b]
            if len(own) > 1:
                for x, y in local_links(_unpacked(texts.take(pa.array(own)), reader), percent):
                    u.append(nodes[own[x]])
                    v.append(nodes[own[y]])
        return pa.Table.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return (
        rows.withColumn("_shard", F.pmod(F.xxhash64("list"), F.lit(shards)))
        .groupBy("_shard")
        .applyInArrow(trimmed_group(run), "u bigint, v bigint")
    )


def joined(groups: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Join up the groups (each named by one of its members) of all pairs (x, y), in place."""
    while True:
        a, b = groups[x], groups[y]
        apart = a != b
        if not apart.any():
            return
        x, y = x[apart], y[apart]
        low, high = np.minimum(a, b)[apart], np.maximum(a, b)[apart]
        # Every group goes to the least one it meets; names that have moved on are followed to their end.
        to = np.arange(len(groups))
        np.minimum.at(to, high, low)
        while (to[to] != to).any():
            to = to[to]
        groups[:] = to[groups]


def _clusters(rows: DataFrame, shards: int, percent: int) -> DataFrame:
    """Sets that must be compared with each other, of the cells of the lists (cell, node, root, np, sketch, met, shard).

    Returns (list, node): any two sets of a shard that may be linked and are not known to be connected are in
    one list. Where all sets of a group are near each other this is a row per set, not one per pair.
    ``np`` holds the set's size, the token's place in it, and the side of the cell in the lowest two bits.
    """

    def run(table: pa.Table) -> pa.Table:
        cell, nodes, roots, packed = (table.column(c).to_numpy() for c in ("cell", "node", "root", "np"))
        sizes, places, side = packed >> 26, packed >> 2 & 0xFFFFFF, packed & 3
        sketches = table.column("sketch").to_pylist()
        met = np.full((len(cell), FIRST_LISTS), -1, np.int64)
        for i, own in enumerate(table.column("met").to_pylist()):
            met[i, : len(own or ())] = own or ()
        order = np.argsort(cell, kind="stable")
        cuts = np.flatnonzero(np.concatenate(([True], cell[order][1:] != cell[order][:-1], [True])))
        # Lists of a shard have sets in common: groups are of sets, not of rows.
        names, set_of = np.unique(nodes, return_inverse=True)
        groups = np.arange(len(names))
        lists, members = [], []

        def close() -> None:
            size = np.bincount(groups, minlength=len(names))
            some = np.flatnonzero(size[groups] > 1)
            tops = names[groups[some]]
            label = mix(tops.astype(np.uint64) + np.uint64(len(lists)) * np.uint64(0x9E3779B97F4A7C15))
            lists.append(_signed(label ^ mix(cell[order[:1]].astype(np.uint64))))
            members.append(names[some])
            groups[:] = np.arange(len(names))

        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            own = order[a:b]
            if (roots[own] == roots[own[0]]).all():
                continue
            bits = [np.frombuffer(sketches[i], np.uint64) for i in own.tolist()]
            cell_groups = groups[set_of[own]]
            for i, j, _ in skipped_pairs(sizes[own], places[own], roots[own], bits, percent, groups=cell_groups):
                # A cell of two sides is for the pairs across; those within a side have their own cell.
                i, j = own[i], own[j]
                fresh = (side[i] != side[j]) | (side[i] == 0)
                for c in range(FIRST_LISTS):
                    fresh &= ~((met[i, c, None] == met[j]) & (met[i, c, None] != -1)).any(axis=1)
                if fresh.any():
                    joined(groups, set_of[i[fresh]], set_of[j[fresh]])
                    cell_groups[:] = groups[set_of[own]]
            # No list grows beyond this and one more cell; pairs of later cells are in other lists.
            if np.bincount(groups).max() > CELL_SETS:
                close()
        close()
        out = (np.concatenate(lists), np.concatenate(members))
        return pa.Table.from_arrays([pa.array(x, pa.int64()) for x in out], names=["list", "node"])

    return (
        rows.withColumn("_shard", F.pmod("shard", F.lit(shards)))
        .drop("shard")
        .groupBy("_shard")
        .applyInArrow(trimmed_group(run), "list bigint, node bigint")
    )


def _rooted(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Edges between nodes as edges between their roots."""
    for c in "uv":
        own = roots.withColumnsRenamed({"node": c, "root": f"_r{c}"})
        edges = edges.join(own, c, "left").withColumn(c, F.coalesce(f"_r{c}", c)).drop(f"_r{c}")
    return edges


def _grouped(roots: DataFrame, further: DataFrame) -> DataFrame:
    """``roots`` (node, root) after the roots have been joined up by ``further`` (node, root)."""
    again = further.select(F.col("node").alias("root"), F.col("root").alias("top"))
    return roots.join(again, "root", "left").select("node", F.coalesce("top", "root").alias("root"))


def near_duplicate_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    with_keys: bool = False,
) -> DataFrame:
    """Components of documents linked by the Jaccard similarity of their sets of word shingles.

    Words are A-Z lower-cased runs of anything but ASCII white space. Two documents link
    when ``100 * intersection >= percent * union``; texts of fewer words than a shingle
    count as one shingle, and texts without words are linked with nothing. Returns per row: id,
    n_shingles, component_id (the smallest id in its component).

    1. Equal sets make a class, found by a 128-bit hash; the rest is done once per class.
    2. Linked sets share one of their first tokens in any common order. The order puts
       tokens last that are frequent within some part of the texts; this only shortens
       lists. Classes that share no first token with another are done.
    3. The others' texts are stored once more, compressed. A set that shares much is compared in its
       first lists with all sets there, which joins up most groups of near copies.
    4. Lists that still hold several components are gone through in blocks by size and
       place, split into cells where long. Sets that may be linked make clusters, a row per set and not
       one per pair, and the sets of a cluster are compared. So every link between components is found,
       without a limit on partners or list lengths.

    ``with_keys`` adds text_hash (``xxhash64`` of the text, null as empty) and group, which is
    equal for the rows of one component and no others, also without ids; null for texts without words.

    Null texts have no words. Ids may repeat; a null id takes part, and is the component
    only where no id is there. Other columns are ignored; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(F.col(id_col).alias("_id"), text.alias("_text")).withColumn("_hash", F.xxhash64("_text"))
    measured = stage(_measure(base.select("_id", "_text", "_hash"), shingle), "measured")
    rows = measured.filter(F.col("h1").isNotNull()).select("_id", "_hash", "n", "h1", "h2")
    # At most MAX_FREQUENT numbers.
    frequent = (
        measured.filter(F.col("token").isNotNull())
        .groupBy("token")
        .agg(F.sum("times").alias("times"))
        .orderBy(F.desc("times"), "token")
        .limit(MAX_FREQUENT)
    )
    late = np.sort(np.array([r["token"] for r in frequent.collect()], np.int64).view(np.uint64))
    shared = spark.sparkContext.broadcast(late)

    classes = rows.filter("n > 0").groupBy("h1", "h2").agg(
        F.min("_id").alias("least"), F.min(F.struct("_id", "_hash")).alias("one")
    )
    prefixes = _prefixes(base, shingle, percent, shared).filter("n > 0").groupBy("h1", "h2").agg(
        F.first("n").alias("n"), F.first("first").alias("first")
    )
    # Written, as it is read twice: to count the lists, and to fill those of several sets.
    prefixes = stage(prefixes.select(F.shiftrightunsigned("h1", 16).alias("key"), "n", "first"), "prefixes")
    # Six bytes of a token and of a set's hash will do to bring together what may belong together.
    postings = prefixes.select("key", "n", F.posexplode("first").alias("place", "token")).select(
        F.shiftrightunsigned("token", 16).alias("token"),
        "key",
        F.shiftleft("n", 24).bitwiseOR(F.col("place").cast("long")).alias("np"),
    )
    # Added up before the shuffle, so a token of very many sets is no task's burden; the join splits it, too.
    lengths = postings.groupBy("token").agg(F.count("*").alias("long"), F.min("key").alias("leader"))
    lengths = stage(lengths.filter("long > 1"), "lengths")
    lists = stage(postings.join(lengths, "token"), "lists")

    # A set's first lists, and whether most of its first tokens are in lists.
    place = F.col("np").bitwiseAND((1 << 24) - 1)
    size = F.shiftright("np", 24)
    own = lists.groupBy("key").agg(
        F.slice(
            F.sort_array(F.collect_list(F.struct(place.alias("place"), "token", "long"))), 1, FIRST_LISTS + 1
        ).alias("first"),
        F.count("*").alias("shared"),
        F.max(size).alias("n"),
    )
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    own = stage(own.select("key", "first", (F.col("shared") >= prefix * MOSTLY_SHARED).alias("mostly")), "own")

    keyed = classes.select("h1", "h2", "one", F.shiftrightunsigned("h1", 16).alias("key"))
    candidates = own.select("key", "mostly").join(keyed, "key").select(
        "h1", "h2", "mostly", F.col("one._id").alias("_k_id"), F.col("one._hash").alias("_k_hash")
    )
    same = F.col("_id").eqNullSafe(F.col("_k_id")) & (F.col("_hash") == F.col("_k_hash"))
    chosen = _packed_texts(base).join(candidates, same).select("h1", "h2", "packed", "mostly")
    if not rows.groupBy("_id", "_hash").count().filter("count > 1").isEmpty():
        chosen = chosen.dropDuplicates(["h1", "h2"])  # rows repeated with their id
    sets = _sketched(chosen, shingle).withColumn("node", F.monotonically_increasing_id())
    sets = stage(sets.withColumn("key", F.shiftrightunsigned("h1", 16)), "sets")

    # A long list falls into groups that also share their next list, as similar sets do.
    def group(x, i):
        other = F.xxhash64(F.get("first", i + 1)["token"])
        return F.xxhash64(x["token"], F.pmod(other, F.ceil(x["long"] / CELL_SETS)))

    chosen_lists = F.slice("first", 1, FIRST_LISTS)
    picks = own.filter("mostly").select("key", F.explode(F.transform(chosen_lists, group)).alias("list"))
    # Groups that are still long are cut; about HUBS of their sets go to every part, and hold the parts together.
    lengths = picks.groupBy("list").agg(F.count("*").alias("_long"))
    parts = F.ceil(F.col("_long") / (2 * CELL_SETS))
    own_part = F.pmod(F.xxhash64("key"), parts)
    is_hub = F.pmod(F.xxhash64("key", F.lit("hub")), F.col("_long")) < HUBS
    spread = F.when(is_hub, F.sequence(F.lit(0).cast("long"), parts - 1)).otherwise(F.array(own_part))
    picks = picks.join(lengths, "list").select(
        "key", F.xxhash64("list", own_part).alias("met"), "list", spread.alias("parts")
    )
    picks = stage(picks, "picks")
    compared = (
        picks.select("key", "list", F.explode("parts").alias("_part"))
        .select("key", F.xxhash64("list", "_part").alias("list"))
        .join(sets.filter("mostly").select("key", "node", "packed"), "key")
    )
    shards = max(1, sets.filter("mostly").count() // 2_000)
    roots = connected_components(_compare_lists(compared, shards, shingle, percent))

    rooted = sets.select("key", "node", "sketch").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # Sets that have met in a part have been compared: that answer stands.
    met = picks.groupBy("key").agg(F.sort_array(F.collect_set("met")).alias("met"))
    # A list of one component has nothing more to tell. Most are: they end here, before sketches are moved.
    ends = lists.select("key", "token").join(rooted.select("key", "root"), "key").groupBy("token")
    several = ends.agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("token")
    several = stage(several, "several")
    entries = lists.join(several, "token").join(rooted, "key").join(met, "key", "left")
    # A list of several parts becomes a cell for each pair of parts.
    cuts = F.ceil(F.col("long") / CELL_ROWS)
    part = F.pmod(F.xxhash64("node"), cuts)
    cells = F.transform(
        F.sequence(F.lit(0).cast("long"), cuts - 1),
        lambda o: F.struct(
            F.xxhash64("token", F.least(o, part), F.greatest(o, part)).alias("cell"),
            F.when(o == part, 0).when(o < part, 1).otherwise(2).cast("long").alias("side"),
        ),
    )
    # Lists of one group of near copies mostly have one leader: in one shard a pair comes out of them once.
    shard = F.when(cuts > 1, F.xxhash64("_c.cell")).otherwise(F.xxhash64("leader"))
    entries = entries.withColumn("_c", F.explode(cells)).select(
        "_c.cell",
        "node",
        "root",
        F.shiftleft("np", 2).bitwiseOR(F.col("_c.side")).alias("np"),
        "sketch",
        "met",
        shard.alias("shard"),
    )
    shards = max(1, lists.join(several, "token", "left_semi").count() // SHARD_ROWS)
    clusters = stage(_clusters(entries, shards, percent), "clusters")
    compared = clusters.join(sets.select("node", "packed"), "node")
    shards = max(1, clusters.count() // 2_000)
    tops = connected_components(_rooted(_compare_lists(compared, shards, shingle, percent), roots))
    roots = stage(_grouped(rooted.select("node", "root"), tops), "roots")

    grouped = sets.select("h1", "h2", "node").join(roots, "node").join(classes.select("h1", "h2", "least"), ["h1", "h2"])
    least = grouped.groupBy("root").agg(F.min("least").alias("component"), F.min(F.struct("h1", "h2")).alias("group"))
    component = grouped.select("h1", "h2", "root").join(least, "root")
    component = component.groupBy("h1", "h2").agg(F.min("component").alias("component"), F.min("group").alias("group"))
    named = classes.select("h1", "h2", "least").join(component, ["h1", "h2"], "left")
    own = F.coalesce("group", F.struct("h1", "h2"))
    named = named.select("h1", "h2", F.coalesce("component", "least").alias("component_id"), own.alias("group"))
    keys = [F.col("_hash").alias("text_hash"), "group"] if with_keys else []
    return rows.join(named, ["h1", "h2"], "left").select(
        F.col("_id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("_id")).alias("component_id"),
        *keys,
    )
