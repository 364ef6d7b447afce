"""Hard negatives by an STR-packed R-tree: best-first search of inner products within score windows."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackfuse.session import stage

#: Rows of a leaf, and children of an inner node.
LEAF_ROWS = 128
FANOUT = 8
#: Rows of one tree, and anchors that go through it at once. A tile has a box in the directory and
#: one tree or more; there are at most MAX_TILES, so the directory is of bounded size.
TREE_ROWS = 8192
ANCHOR_BLOCK = 1024
MAX_TILES = 16_384
#: Dimensions that rows are tiled by, those of the largest spread.
TILED = 3
#: Sums of products beyond are not exact in double precision, those beyond LARGEST are no 64-bit numbers.
EXACT = 2.0**53
LARGEST = 2.0**62


def str_order(x: np.ndarray, dims: np.ndarray, tile: int) -> np.ndarray:
    """Sort-tile-recursive order: slabs along the first of ``dims``, each cut along the next; tiles of about ``tile`` rows."""
    rows = np.arange(len(x))

    def cut(rows: np.ndarray, level: int) -> list[np.ndarray]:
        rows = rows[np.argsort(x[rows, dims[level]], kind="stable")]
        tiles = -(-len(rows) // tile)
        if level == len(dims) - 1 or tiles < 2:
            return [rows]
        slabs = int(np.ceil(tiles ** (1 / (len(dims) - level))))
        width = -(-tiles // slabs) * tile
        return [p for at in range(0, len(rows), width) for p in cut(rows[at : at + width], level + 1)]

    return np.concatenate(cut(rows, 0)) if len(rows) else rows


class RTree:
    """Leaves of rows that lie together, and boxes over boxes; rows are held in leaf order."""

    def __init__(self, x: np.ndarray, leaf_rows: int = LEAF_ROWS, fanout: int = FANOUT):
        spread = np.argsort(-x.var(axis=0, dtype=np.float64), kind="stable")[:TILED]
        self.order = str_order(x, spread, leaf_rows)
        self.x = x[self.order]
        starts = np.arange(0, len(x), leaf_rows)
        low, high = np.minimum.reduceat(self.x, starts), np.maximum.reduceat(self.x, starts)
        #: Of each level, from the leaves up: lower and upper corners of its boxes.
        self.levels = [(low, high)]
        while len(low) > 1:
            at = np.arange(0, len(low), fanout)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            self.levels.append((low, high))
        self.leaf_rows, self.fanout = leaf_rows, fanout

    def intervals(self, queries: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per level the least and the greatest inner product that each box allows each query, by its coordinates."""
        return [score_bounds(queries, low, high) for low, high in self.levels]

    def best_first(self, q: int, bounds: list[tuple[np.ndarray, np.ndarray]], wanted) -> Iterator[slice]:
        """The rows of the leaves in falling order of their greatest possible score for query ``q``.

        ``wanted(least, greatest)`` says of a box, when its turn comes, whether it is still to be opened.
        """
        top = len(self.levels) - 1
        queue = [(-bounds[top][1][q, i], top, i) for i in range(len(self.levels[top][0]))]
        heapq.heapify(queue)
        while queue:
            greatest, level, i = heapq.heappop(queue)
            if not wanted(bounds[level][0][q, i], -greatest):
                continue
            if level == 0:
                yield slice(i * self.leaf_rows, (i + 1) * self.leaf_rows)
                continue
            for child in range(i * self.fanout, min((i + 1) * self.fanout, len(self.levels[level - 1][0]))):
                heapq.heappush(queue, (-bounds[level - 1][1][q, child], level - 1, child))


def score_bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each query with the points of each box.

    A coordinate's share lies between its products with the box's two sides.
    """
    plus, minus = np.maximum(queries, 0), np.minimum(queries, 0)
    return plus @ low.T + minus @ high.T, plus @ high.T + minus @ low.T


class Best:
    """The ``k`` best of what is added: higher scores first, ties by smaller id."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(scores):
            return
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        if len(scores) > 4 * self.k:
            # Fewer to sort: what is below the k-th score cannot stay, ties with it can.
            few = scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            scores, ids = scores[few], ids[few]
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]

    @property
    def floor(self) -> float:
        """The k-th score: below it, nothing can be added any more."""
        return self.scores[-1] if len(self.scores) == self.k else -np.inf


def search_positives(
    tree: RTree, ids: np.ndarray, labels: np.ndarray, queries: np.ndarray, own_ids: np.ndarray, own_labels: np.ndarray, k: int
) -> Iterator[tuple[int, Best]]:
    """Per query the ``k`` best rows of its label and of another id; ``ids`` and ``labels`` are in leaf order."""
    bounds = tree.intervals(queries)
    for q, y in enumerate(queries):
        best = Best(k)
        for rows in tree.best_first(q, bounds, lambda _, greatest: greatest >= best.floor):  # noqa: B023
            ok = (labels[rows] == own_labels[q]) & (ids[rows] != own_ids[q])
            if ok.any():
                best.add((tree.x[rows][ok] @ y).astype(np.int64), ids[rows][ok])
        yield q, best


def search_negatives(
    tree: RTree, ids: np.ndarray, labels: np.ndarray, queries: np.ndarray, own_labels: np.ndarray, windows: list[np.ndarray], k: int
) -> Iterator[tuple[int, int, Best]]:
    """Per query and score window (lowest, highest) the ``k`` best rows of another label within it.

    A box is opened while for some window it may hold a score inside that is not below the k-th.
    """
    bounds = tree.intervals(queries)
    for q, y in enumerate(queries):
        own = windows[q]
        found = [Best(k) for _ in own]

        def wanted(least: float, greatest: float) -> bool:
            return any(least <= hi and greatest >= max(lo, b.floor) for (lo, hi), b in zip(own, found, strict=True))  # noqa: B023

        for rows in tree.best_first(q, bounds, wanted):
            other = labels[rows] != own_labels[q]
            scores, others = (tree.x[rows][other] @ y).astype(np.int64), ids[rows][other]
            for (lo, hi), best in zip(own, found, strict=True):
                ok = (scores >= lo) & (scores <= hi) & (scores >= best.floor)
                if ok.any():
                    best.add(scores[ok], others[ok])
        for w, best in enumerate(found):
            yield q, w, best


def finite(vector: Column) -> Column:
    """Not null, and no component is null or non-finite."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & ok, F.lit(False))


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = [c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]
    return np.concatenate(flat).reshape(-1, dim) if flat else np.empty((0, dim), np.int64)


def _products(*sides: np.ndarray) -> list[np.ndarray]:
    """The sides as doubles where all sums of products are exact, else as 64-bit numbers."""
    most = 1.0
    for s in sides:
        most *= max(float(np.abs(s).max(initial=0)), 1.0)
    return [s.astype(np.float64) if most * sides[0].shape[1] < EXACT else s for s in sides]


def prepared(
    vectors: DataFrame, label: Column, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256
) -> tuple[DataFrame, int]:
    """The rows that take part (id, label, v, anchor), components as ``floor(scale * x)``, and their dimension."""
    x = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).alias("id"), label.cast("bigint").alias("label"), x.alias("v"), is_anchor.alias("anchor"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & finite(F.col("v")))
    lengths = rows.groupBy(F.array_size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if lengths is None:
        return rows.limit(0), 0
    dim = lengths.dim
    limit = (LARGEST / max(dim, 1)) ** 0.5
    rows = rows.filter((F.array_size("v") == dim) & F.forall("v", lambda x: F.abs(F.floor(x * scale)) < limit))
    numbers = F.transform("v", lambda x: F.floor(x * scale).cast("bigint"))
    return rows.select("id", "label", numbers.alias("v"), F.coalesce("anchor", F.lit(False)).alias("anchor")), dim


def _tiled(rows: DataFrame, dim: int, tree_rows: int) -> DataFrame:
    """``rows`` with ``tile``: by quantiles of the two dimensions of the largest spread; equal values spread by id."""
    tiles = min(max(1, -(-rows.count() // tree_rows)), MAX_TILES)
    if tiles == 1 or not dim:
        return stage(rows.withColumn("tile", F.lit(0).cast("bigint")), "tiles")
    spread = rows.select(F.posexplode("v").alias("d", "x")).groupBy("d").agg(F.var_pop("x").alias("s"))
    dims = [r.d for r in spread.orderBy(F.desc("s"), "d").limit(2).collect()]
    slabs = int(np.ceil(tiles ** (1 / len(dims))))
    shares = [i / slabs for i in range(1, slabs)]
    cuts = rows.agg(*(F.percentile_approx(F.get("v", F.lit(d)), shares, 10_000) for d in dims)).first()
    tile = F.lit(0).cast("bigint")
    for d, own in zip(dims, cuts, strict=True):
        known, value = F.array(*(F.lit(c) for c in own)).cast("array<bigint>"), F.get("v", F.lit(d))
        below = F.array_size(F.filter(known, lambda c: c < value))  # noqa: B023
        upto = F.array_size(F.filter(known, lambda c: c <= value))  # noqa: B023
        # A value that fills several quantiles has its rows spread over them.
        tile = tile * slabs + below + F.pmod(F.xxhash64("id", F.lit(d)), upto - below + 1)
    return stage(rows.withColumn("tile", tile.cast("bigint")), "tiles")


def _directory(rows: DataFrame, dim: int) -> dict[str, np.ndarray]:
    """Number, rows and box of each tile, ``MAX_TILES`` at most; boxes are merged from those of the batches."""

    def boxes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tiles, x = batch.column(0).to_numpy(), _matrix(pa.chunked_array([batch.column(1)]), dim)
            for t in np.unique(tiles):
                own = x[tiles == t]
                corners = [pa.array([c.tolist()], pa.list_(pa.int64())) for c in (own.min(axis=0), own.max(axis=0))]
                yield pa.RecordBatch.from_arrays([pa.array([t]), pa.array([len(own)]), *corners], names=["tile", "n", "low", "high"])

    parts = rows.select("tile", "v").mapInArrow(boxes, "tile bigint, n bigint, low array<bigint>, high array<bigint>")
    sides = F.posexplode(F.arrays_zip("low", "high")).alias("d", "s")
    merged = parts.select("tile", "n", sides).groupBy("tile", "d").agg(
        F.sum("n").alias("n"), F.min("s.low").alias("low"), F.max("s.high").alias("high")
    )
    corner = F.sort_array(F.collect_list(F.struct("d", "low", "high")))  # as many as there are dimensions
    found = merged.groupBy("tile").agg(F.first("n").alias("n"), corner.alias("c")).orderBy("tile").collect()
    return {
        "tile": np.array([r.tile for r in found], np.int64),
        "n": np.array([r.n for r in found], np.int64),
        "low": np.array([[c.low for c in r.c] for r in found], np.int64).reshape(len(found), dim),
        "high": np.array([[c.high for c in r.c] for r in found], np.int64).reshape(len(found), dim),
    }


def _visits(anchors: DataFrame, directory, dim: int, wanted) -> DataFrame:
    """A row per anchor and tile to be searched: ``wanted(rows, least, greatest)`` gives flags by anchor and tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = directory.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                column = pa.chunked_array([rows.column(rows.schema.get_field_index("v"))])
                y, low, high = _products(_matrix(column, dim), known["low"], known["high"])
                who, which = np.nonzero(wanted(rows, *score_bounds(y, low, high), known["tile"]))
                taken = [c.take(pa.array(who)) for c in rows.columns]
                yield pa.RecordBatch.from_arrays([*taken, pa.array(known["tile"][which])], names=[*rows.schema.names, "visited"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in anchors.schema.fields)
    return stage(anchors.mapInArrow(run, f"{fields}, visited bigint"), "visits")


def _met(rows: DataFrame, visits: DataFrame, directory, search, fields: str, tree_rows: int, block: int) -> DataFrame:
    """``search(rows, anchors)`` on each tree and block of the anchors that visit its tile.

    A tile of many rows is several trees, and where many anchors visit it they come in blocks,
    so neither side of a meeting grows with the table.
    """
    held = dict(zip(directory["tile"].tolist(), directory["n"].tolist(), strict=True))
    asked = visits.groupBy("visited").count().collect()  # a row per tile
    cells = [(r.visited, -(-held[r.visited] // tree_rows), -(-r["count"] // block)) for r in asked]
    cells = F.broadcast(rows.sparkSession.createDataFrame(cells, "_tile bigint, parts bigint, blocks bigint"))

    def each(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))

    own = rows.join(cells, F.col("tile") == F.col("_tile")).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    own = own.withColumn("block", each("blocks")).select("tile", "part", "block", "id", "label", "v")
    come = visits.join(cells, F.col("visited") == F.col("_tile")).withColumn("block", F.pmod(F.xxhash64("a"), F.col("blocks")))
    come = come.drop("tile").withColumn("part", each("parts")).withColumn("tile", F.col("visited"))
    come = come.drop("visited", "_tile", "parts", "blocks")
    keys = ["tile", "part", "block"]
    return own.groupBy(*keys).cogroup(come.groupBy(*keys)).applyInArrow(search, fields)


def _planted(found: pa.Table, asked: pa.Table, dim: int) -> tuple[RTree, np.ndarray, np.ndarray, np.ndarray]:
    """The tree over ``found``, its ids and labels in leaf order, and the vectors asked for."""
    x, y = _products(_matrix(found.column("v"), dim), _matrix(asked.column("v"), dim))
    tree = RTree(x)
    return tree, found.column("id").to_numpy()[tree.order], found.column("label").to_numpy()[tree.order], y


def score_window(positive: int, lowest: int, highest: int) -> tuple[int, int]:
    """The least and the greatest score of ``lowest`` to ``highest`` percent of the positive's."""
    return -(-lowest * positive // 100), highest * positive // 100


def hard_negatives(
    vectors: DataFrame,
    label: Column,
    is_anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 256,
    n_positives: int = 5,
    n_negatives: int = 10,
    lowest: int = 30,
    highest: int = 90,
    tree_rows: int = TREE_ROWS,
    block: int = ANCHOR_BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for each anchor row.

    Components count as ``floor(scale * x)``, a score is the inner product of these whole numbers.
    An anchor's positives are the ``n_positives`` best other rows of its label; for each the
    ``n_negatives`` best rows of other labels whose score is ``lowest`` to ``highest`` percent of
    the positive's are returned. Ties go to the smaller id. The result is exact.

    Rows are tiled by quantiles of two dimensions; each tile is searched by R-trees that are
    packed sort-tile-recursively. A box bounds each coordinate's share of the inner
    product, hence the score; a queue opens boxes by their greatest possible score and drops those outside
    the score windows or strictly below the k-th score found. The tiles' own boxes tell beforehand
    which anchors visit which tiles: an anchor's own tile comes first and its k-th positive there
    rules others out. Anchors and trees meet in blocks of bounded size, by an equi-join.

    Rows with a null id, label or vector or with a null or non-finite component take no part, nor do those of
    another length than most or with components so large that scores would not fit a 64-bit number. A row
    of an anchor's own id is no other row. Rows that share an id are rows each, also as anchors. Other columns are
    ignored; an empty table gives an empty one.
    """
    spark = vectors.sparkSession
    id_kind = vectors.schema[id_col].dataType.simpleString()
    rows, dim = prepared(vectors, label, is_anchor, id_col, vector_col, scale)
    rows = _tiled(rows.withColumn("id", F.col("id").cast("bigint")), dim, tree_rows)
    anchors = rows.filter("anchor").select("id", "label", "v", "tile")
    anchors = stage(anchors.select(F.monotonically_increasing_id().alias("a"), "*"), "anchors")
    plan = _directory(rows, dim)
    directory = spark.sparkContext.broadcast(plan)

    def positives(found: pa.Table, asked: pa.Table) -> pa.Table:
        out = []
        if found.num_rows and asked.num_rows:
            tree, ids, labels, y = _planted(found, asked, dim)
            numbers, own = asked.column("a").to_numpy(), (asked.column(c).to_numpy() for c in ("id", "label"))
            for q, best in search_positives(tree, ids, labels, y, *own, n_positives):
                out.append((np.full(len(best.ids), numbers[q]), best.ids, best.scores))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] or [np.empty(0, np.int64)] * 3
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "positive_id", "positive_score"])

    def of_positives(visits: DataFrame) -> DataFrame:
        fields = "a bigint, positive_id bigint, positive_score bigint"
        return stage(_met(rows, visits, plan, positives, fields, tree_rows, block), "positives")

    best = Window.partitionBy("a").orderBy(F.desc("positive_score"), "positive_id")

    def ranked(found: DataFrame) -> DataFrame:
        return found.withColumn("w", F.row_number().over(best)).filter(F.col("w") <= n_positives)

    at_home = of_positives(_visits(anchors, directory, dim, lambda r, _, greatest, tiles: _column(r, "tile")[:, None] == tiles))
    floors = ranked(at_home).filter(F.col("w") == n_positives).select("a", F.col("positive_score").alias("floor"))
    floored = anchors.join(floors, "a", "left")

    def elsewhere(r: pa.RecordBatch, _, greatest: np.ndarray, tiles: np.ndarray) -> np.ndarray:
        least = [-np.inf if f is None else f for f in r.column(r.schema.get_field_index("floor")).to_pylist()]
        return (greatest >= np.array(least)[:, None]) & (_column(r, "tile")[:, None] != tiles)

    away = of_positives(_visits(floored, directory, dim, elsewhere))
    chosen = stage(ranked(at_home.unionByName(away)), "chosen")

    scores = chosen.groupBy("a").agg(F.sort_array(F.collect_list(F.struct("w", "positive_score"))).alias("p"))
    asking = anchors.join(scores, "a").withColumn("scores", F.col("p.positive_score")).drop("p")

    def windows_of(scores: pa.Array | pa.ChunkedArray) -> list[list[tuple[int, int]]]:
        return [[score_window(p, lowest, highest) for p in own] for own in scores.to_pylist()]

    def within(r: pa.RecordBatch, least: np.ndarray, greatest: np.ndarray, tiles: np.ndarray) -> np.ndarray:
        flags = np.zeros(least.shape, bool)
        for q, own in enumerate(windows_of(r.column(r.schema.get_field_index("scores")))):
            for lo, hi in own:
                if lo <= hi:
                    flags[q] |= (least[q] <= hi) & (greatest[q] >= lo)
        return flags

    def negatives(found: pa.Table, asked: pa.Table) -> pa.Table:
        out = []
        if found.num_rows and asked.num_rows:
            tree, ids, labels, y = _planted(found, asked, dim)
            numbers, own_labels = asked.column("a").to_numpy(), asked.column("label").to_numpy()
            windows = windows_of(asked.column("scores"))
            for q, w, b in search_negatives(tree, ids, labels, y, own_labels, windows, n_negatives):
                out.append((np.full(len(b.ids), numbers[q]), np.full(len(b.ids), w + 1), b.ids, b.scores))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] or [np.empty(0, np.int64)] * 4
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "w", "negative_id", "negative_score"])

    visits = _visits(asking, directory, dim, within)
    fields = "a bigint, w bigint, negative_id bigint, negative_score bigint"
    found = _met(rows, visits, plan, negatives, fields, tree_rows, block)
    order = Window.partitionBy("a", "w").orderBy(F.desc("negative_score"), "negative_id")
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n_negatives)
    named = chosen.join(anchors.select("a", F.col("id").alias("anchor_id")), "a")
    return found.join(named, ["a", "w"]).select(
        F.col("anchor_id").cast(id_kind).alias("anchor_id"),
        F.col("positive_id").cast(id_kind).alias("positive_id"),
        "rank",
        F.col("negative_id").cast(id_kind).alias("negative_id"),
        "positive_score",
        "negative_score",
    )


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy()
