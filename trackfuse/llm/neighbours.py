"""Approximate nearest neighbours with balanced posting lists and a graph over their centroids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bounds of the sample that the centroids are fitted on: vectors, and numbers in all of them.
SAMPLE_ROWS = 20_000
SAMPLE_NUMBERS = 4_000_000
#: Rows of a posting list before boundary vectors are added, as planned; with the sample's bound on centroids lists
#: grow with the table.
LIST_ROWS = 200
MAX_CENTROIDS = 4_000
#: Rows of one part of a list: longer lists are searched in parts.
PART_ROWS = 4_000
#: A vector joins further lists whose centroids are at most so many times as far as the nearest one, up to COPIES.
BOUNDARY = 1.15
COPIES = 6
#: A query goes through lists whose centroids are at most so many times as far as the nearest one, up to PROBES. Both
#: are the least; they are widened until they hold MISSED of the true neighbours of TRIALS queries at most, each.
RATIO = 1.5
PROBES = 48
TRIALS = 200
MISSED = 0.02
#: Numbers that a step of the graph search gathers at a time.
STEP_NUMBERS = 2_000_000
_SHARD_ROWS = 20_000


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances between rows, quick and less exact; for the choice of lists only."""
    squares = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2.0 * (x @ y.T)
    return np.sqrt(np.maximum(squares, 0.0))


def balanced_centroids(points: np.ndarray, most: int, seed: int = 7) -> np.ndarray:
    """Centroids of clusters of at most ``most`` points, by splitting larger ones with k-means again and again.

    Points that are all equal stay together.
    """
    rng = np.random.default_rng(seed)
    done, todo = [], [points]
    while todo:
        own = todo.pop()
        ways = min(8, -(-len(own) // most))
        centres = np.unique(own[rng.choice(len(own), min(len(own), 4 * ways), replace=False)], axis=0)
        if ways < 2 or len(centres) < 2:
            done.append(own.mean(axis=0))
            continue
        centres = centres[rng.permutation(len(centres))[:ways]]
        for _ in range(8):
            nearest = _distances(own, centres).argmin(axis=1)
            filled = np.unique(nearest)
            centres = np.stack([own[nearest == c].mean(axis=0) for c in filled])
        nearest = _distances(own, centres).argmin(axis=1)
        parts = [p for p in (own[nearest == c] for c in range(len(centres))) if len(p)]
        if len(parts) < 2:
            done.append(own.mean(axis=0))
        else:
            todo += parts
    return np.stack(done)


class CentroidGraph:
    """Centroids, each with links to its nearest ones, searched greedily from a fixed set of entries."""

    def __init__(self, centroids: np.ndarray, degree: int = 24, entries: int = 64, seed: int = 11):
        self.centroids = centroids
        n = len(centroids)
        degree = min(degree, max(n - 1, 1))
        links = np.empty((n, degree), np.int64)
        for at in range(0, n, 512):
            apart = _distances(centroids[at : at + 512], centroids)
            apart[np.arange(len(apart)), np.arange(at, at + len(apart))] = np.inf if n > 1 else 0
            links[at : at + 512] = np.argsort(apart, axis=1)[:, :degree]
        # The ring of all centroids leaves none out of reach.
        self.links = np.concatenate([links, (np.arange(n)[:, None] + 1) % n], axis=1)
        self.entries = np.sort(np.random.default_rng(seed).choice(n, min(entries, n), replace=False))

    def search(self, x: np.ndarray, wanted: int, step: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """The ``wanted`` nearest centroids of each row of ``x`` as found by the graph, nearest first, and their distances."""
        n, rows = len(self.centroids), np.arange(len(x))[:, None]
        wanted = min(wanted, n)
        width = min(n, max(2 * wanted, 32))
        seen = np.zeros((len(x), n), bool)
        seen[:, self.entries] = True
        best = np.full((len(x), width), -1, np.int64)
        apart = np.full((len(x), width), np.inf)
        opened = np.ones((len(x), width), bool)

        def merge(ids: np.ndarray, d: np.ndarray) -> None:
            nonlocal best, apart, opened
            every = np.concatenate([apart, d], axis=1)
            order = np.argsort(every, axis=1, kind="stable")[:, :width]
            apart = np.take_along_axis(every, order, axis=1)
            best = np.take_along_axis(np.concatenate([best, ids], axis=1), order, axis=1)
            opened = np.take_along_axis(np.concatenate([opened, ~np.isfinite(d)], axis=1), order, axis=1)

        merge(np.broadcast_to(self.entries, (len(x), len(self.entries))), _distances(x, self.centroids[self.entries]))
        norms = (self.centroids * self.centroids).sum(axis=1)
        own = (x * x).sum(axis=1)[:, None]
        while not opened.all():
            # The nearest few that have not been opened yet, of each row.
            next_ = np.argsort(opened, axis=1, kind="stable")[:, :step]
            idle = np.take_along_axis(opened, next_, axis=1)
            opened[rows, next_] = True
            near = self.links[np.take_along_axis(best, next_, axis=1)]
            near = near.reshape(len(x), -1)
            skip = np.repeat(idle, self.links.shape[1], axis=1) | seen[rows, near]
            # Of a centroid met twice in a step the first counts.
            order = np.argsort(near, axis=1, kind="stable")
            sorted_ = np.take_along_axis(near, order, axis=1)
            twice = np.zeros_like(skip)
            np.put_along_axis(twice[:, :], order[:, 1:], sorted_[:, 1:] == sorted_[:, :-1], axis=1)
            skip |= twice
            seen[np.broadcast_to(rows, near.shape)[~skip], near[~skip]] = True
            d = own + norms[near] - 2.0 * np.einsum("rd,rkd->rk", x, self.centroids[near])
            merge(near, np.where(skip, np.inf, np.sqrt(np.maximum(d, 0.0))))
        return best[:, :wanted], apart[:, :wanted]

    def lists_of(self, x: np.ndarray) -> list[np.ndarray]:
        """The posting lists of each vector: the nearest centroid's, and further ones if it lies near a boundary.

        A further centroid counts only if no chosen one is nearer to it than the vector is.
        """
        ids, apart = self.search(x, COPIES)
        near = apart <= apart[:, :1] * BOUNDARY + 1e-12
        out = []
        for row, d, ok in zip(ids, apart, near, strict=True):
            chosen = [row[0]]
            for c, far in zip(row[1:][ok[1:]], d[1:][ok[1:]], strict=True):
                if (_distances(self.centroids[c][None], self.centroids[chosen]) > far).all():
                    chosen.append(c)
            out.append(np.array(chosen, np.int64))
        return out

    def probes_of(
        self, x: np.ndarray, rows: np.ndarray, least: int, probes: int = PROBES, ratio: float = RATIO
    ) -> list[np.ndarray]:
        """The lists a query goes through: by distance ratio, and on until they hold ``least`` rows."""
        # A wide search opens more centroids in a step, for fewer queries at a time.
        step = max(4, min(probes, len(self.centroids)) // 16)
        block = max(1, STEP_NUMBERS // (step * self.links.shape[1] * x.shape[1]))
        parts = [self.search(x[at : at + block], probes, step) for at in range(0, max(len(x), 1), block)]
        ids, apart = (np.concatenate(c) for c in zip(*parts, strict=True))
        enough = np.cumsum(rows[ids], axis=1) - rows[ids] >= least
        keep = (apart <= apart[:, :1] * ratio + 1e-12) | ~enough
        return [row[k] for row, k in zip(ids, keep, strict=True)]

    def reach(self, x: np.ndarray, neighbours: list[np.ndarray], missed: float) -> tuple[int, float]:
        """How many lists, and up to which distance ratio, hold all but a share ``missed`` of each row's neighbours."""
        places, ratios = [], []
        for row, own in zip(x, neighbours, strict=True):
            if not len(own):
                continue
            apart = _distances(row[None], self.centroids)[0]
            order = np.argsort(apart, kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            nearest = np.array([place[lists].min() for lists in self.lists_of(own)])
            places.append(nearest)
            with np.errstate(divide="ignore", invalid="ignore"):
                ratio = apart[order[nearest]] / apart[order[0]]
            ratios.append(np.where(nearest == 0, 1.0, ratio))
        if not places:
            return PROBES, RATIO
        places, ratios = np.sort(np.concatenate(places)), np.sort(np.concatenate(ratios))
        at = min(int(np.ceil(len(places) * (1 - missed))), len(places) - 1)
        return max(PROBES, int(places[at]) + 1), max(RATIO, float(ratios[at]))


def _first_ids(ids: np.ndarray, apart: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` nearest different ids, nearest first; of an id's rows the nearest counts, ties go to the smaller id."""
    few = np.arange(len(ids))
    if len(ids) > 8 * k:
        few = np.flatnonzero(apart <= np.partition(apart, 8 * k)[8 * k])
    for own in (few, np.arange(len(ids))):
        order = own[np.lexsort((ids[own], apart[own]))]
        _, first = np.unique(ids[order], return_index=True)
        if len(first) >= k or len(own) == len(ids):
            break
    return order[np.sort(first)[:k]]


def _true_neighbours(rows: DataFrame, queries: list, k: int, id_kind: str) -> list[np.ndarray]:
    """Vectors of the ``k`` nearest rows of each of a few queries (id, vector), by comparing with all rows."""
    shared = rows.sparkSession.sparkContext.broadcast(
        (np.array([q["query_id"] for q in queries]), np.array([q["vector"] for q in queries], np.float64))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        askers, y = shared.value
        best: list[tuple] = [()] * len(y)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                ids, x = part.column(0).to_numpy(zero_copy_only=False), _vectors(part.column(1))
                every = _distances(y, x)
                for q in range(len(y)):
                    own = np.flatnonzero(ids != askers[q])
                    own = own[_first_ids(ids[own], every[q, own], k)]
                    found = (ids[own], every[q, own], x[own])
                    if best[q]:
                        found = tuple(np.concatenate(c) for c in zip(best[q], found, strict=True))
                        first = _first_ids(found[0], found[1], k)
                        found = tuple(c[first] for c in found)
                    best[q] = found
        for q, found in enumerate(best):
            if found and len(found[0]):
                number = pa.array(np.full(len(found[0]), q))
                yield pa.RecordBatch.from_arrays(
                    [number, pa.array(found[0]), pa.array(found[1]), pa.array(list(found[2]), pa.list_(pa.float64()))],
                    names=["q", "_id", "score", "vector"],
                )

    near = rows.mapInArrow(run, f"q bigint, _id {id_kind}, score double, vector array<double>")
    near = near.groupBy("q", "_id").agg(F.min(F.struct("score", "vector")).alias("n"))
    nearest = Window.partitionBy("q").orderBy("n.score", "_id")
    near = near.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k)
    out: list[list] = [[] for _ in queries]
    for r in near.select("q", "n.vector").collect():  # TRIALS times k
        out[r["q"]].append(r["vector"])
    return [np.array(own, np.float64) for own in out]


def usable(vector: Column, dim: int | None = None) -> Column:
    """Vectors that take part: not null or empty, of finite numbers, not all zero."""

    def is_finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    ok = vector.isNotNull() & F.forall(vector, is_finite) & F.exists(vector, lambda x: x != 0)
    return F.coalesce(ok if dim is None else ok & (F.array_size(vector) == dim), F.lit(False))


def _vectors(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _posted(rows: DataFrame, shared) -> DataFrame:
    """A row per vector and list that it is in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = object.__new__(CentroidGraph)
        graph.__dict__.update(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                lists = graph.lists_of(_vectors(part.column(1)))
                rows_ = pa.array(np.repeat(np.arange(len(lists)), [len(c) for c in lists]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(rows_), part.column(1).take(rows_), pa.array(np.concatenate(lists))],
                    names=["_id", "vector", "list"],
                )

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, vector array<double>, list bigint")


def _asked(rows: DataFrame, shared, counts: dict, least: int, probes: int, ratio: float, shards: int) -> DataFrame:
    """A row per query and shard, with the cells (list, part) there that it goes through; ``counts``: rows of each list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = object.__new__(CentroidGraph)
        graph.__dict__.update(shared.value)
        held = np.zeros(len(graph.centroids), np.int64)
        held[list(counts)] = list(counts.values())
        parts = np.maximum(-(-held // PART_ROWS), 1)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                owners, shard_of, cells = [], [], []
                for i, lists in enumerate(graph.probes_of(_vectors(part.column(1)), held, least, probes, ratio)):
                    own = np.repeat(lists, parts[lists])
                    number = np.arange(len(own)) - np.repeat(np.cumsum(parts[lists]) - parts[lists], parts[lists])
                    shard = (own + number) % shards
                    for s in np.unique(shard):
                        owners.append(i)
                        shard_of.append(s)
                        cells.append(np.stack([own[shard == s], number[shard == s]], axis=1).ravel())
                rows_ = pa.array(owners, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(rows_),
                        part.column(1).take(rows_),
                        pa.array(shard_of, pa.int64()),
                        pa.array(cells, pa.list_(pa.int64())),
                    ],
                    names=["query_id", "vector", "shard", "cells"],
                )

    kind = rows.schema["query_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"query_id {kind}, vector array<double>, shard bigint, cells array<bigint>")


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    seed: int = 7,
) -> DataFrame:
    """The ``k`` nearest rows found for each query row: query_id, rank (from 1), vec_id, score (Euclidean distance).

    Centroids are fitted on a bounded sample (``SAMPLE_ROWS``, ``SAMPLE_NUMBERS``) by
    splitting clusters until they are even, and linked into a graph. Every row goes into
    the posting list of its nearest centroid, rows near a boundary into several. A query
    visits the lists whose centroids are not much farther than the nearest one; how many
    lists and how far is measured, on the true neighbours of ``TRIALS`` of the queries in
    the whole table, so that recall does not fall as the table and its lists grow. Lists of
    more than ``PART_ROWS`` are searched in parts, so one very full list, or a vector
    that fills a third of the table, is spread. Distances are exact, in double precision;
    ties go to the smaller id, and a row is no neighbour of a query of its own id.

    Rows with a null id, a null or zero vector, one with null or non-finite numbers or of
    another length than most take no part. Rows of one id are each searched, but an id
    appears once per query. Other columns are ignored; an empty table gives an empty one.
    """
    spark = vectors.sparkSession
    id_kind = vectors.schema[id_col].dataType.simpleString()
    rows = vectors.select(
        F.col(id_col).alias("_id"), F.col(vector_col).cast("array<double>").alias("vector"), is_query.alias("_query")
    ).filter(F.col("_id").isNotNull() & usable(F.col("vector")))
    lengths = rows.groupBy(F.array_size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    shape = f"query_id {id_kind}, rank int, vec_id {id_kind}, score double"
    if lengths is None:
        return spark.createDataFrame([], shape)
    dim, total = lengths["dim"], lengths["count"]
    rows = rows.filter(F.array_size("vector") == dim)

    wanted = max(1, min(SAMPLE_ROWS, SAMPLE_NUMBERS // dim))
    draw = F.pmod(F.xxhash64("_id", F.lit(seed)), F.lit(1 << 30)) / (1 << 30)
    sample = rows.filter(draw < 1.1 * wanted / total).select("vector").limit(wanted).collect()
    sample = sample or rows.select("vector").limit(1).collect()
    sample = np.array(sorted(r["vector"] for r in sample), np.float64)
    n_lists = max(1, min(MAX_CENTROIDS, len(sample) // 4, total // LIST_ROWS))
    graph = CentroidGraph(balanced_centroids(sample, -(-len(sample) // n_lists), seed))
    shared = spark.sparkContext.broadcast(vars(graph))

    postings = _posted(rows.select("_id", "vector"), shared)
    counts = {r["list"]: r["count"] for r in postings.groupBy("list").count().collect()}  # one row per centroid
    queries = rows.filter(F.coalesce("_query", F.lit(False))).select(F.col("_id").alias("query_id"), "vector")
    probes, ratio = PROBES, RATIO
    if len(graph.centroids) > PROBES:
        trials = queries.orderBy(F.xxhash64("query_id", "vector", F.lit(seed)), "query_id").limit(TRIALS).collect()
        if trials:
            near = _true_neighbours(rows.select("_id", "vector"), trials, k, id_kind)
            probes, ratio = graph.reach(np.array([q["vector"] for q in trials], np.float64), near, MISSED)
    shards = max(1, sum(counts.values()) // _SHARD_ROWS)
    visits = _asked(queries, shared, counts, (k + 1) * COPIES, probes, ratio, shards)

    wide = [(c, -(-n // PART_ROWS)) for c, n in counts.items() if n > PART_ROWS]
    parts = spark.createDataFrame(wide, "list bigint, parts bigint")
    postings = postings.join(F.broadcast(parts), "list", "left")
    part = F.pmod(F.xxhash64("_id", "vector"), F.coalesce("parts", F.lit(1)).cast("long"))
    postings = postings.withColumn("part", part).withColumn("shard", F.pmod(F.col("list") + F.col("part"), F.lit(shards)))
    postings = postings.drop("parts")

    def search(found: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if found.num_rows and asked.num_rows:
            lists, numbers = (found.column(c).to_numpy() for c in ("list", "part"))
            width = numbers.max() + 1
            cells = lists * width + numbers
            by = np.argsort(cells, kind="stable")
            cells = cells[by]
            x, y = _vectors(found.column("vector"))[by], _vectors(asked.column("vector"))
            ids, askers = found.column("_id").to_numpy()[by], asked.column("query_id").to_numpy()
            for q, own in enumerate(asked.column("cells").to_pylist()):
                own = np.array(own, np.int64).reshape(-1, 2)
                own = (own[:, 0] * width + own[:, 1])[own[:, 1] < width]
                first, last = np.searchsorted(cells, own), np.searchsorted(cells, own, side="right")
                own = np.concatenate([np.arange(a, b) for a, b in zip(first, last, strict=True)] or [np.arange(0)])
                own = own[ids[own] != askers[q]]
                apart = x[own] - y[q]
                apart = np.sqrt((apart * apart).sum(axis=1))
                best = _first_ids(ids[own], apart, k)
                out.append((np.full(len(best), q), by[own[best]], apart[best]))
        at, own, apart = (np.concatenate(c) for c in zip(*out, strict=True)) if out else ([], [], [])
        return pa.Table.from_arrays(
            [
                asked.column("query_id").take(pa.array(at, pa.int64())),
                found.column("_id").take(pa.array(own, pa.int64())),
                pa.array(apart, pa.float64()),
            ],
            names=["query_id", "vec_id", "score"],
        )

    best = postings.groupBy("shard").cogroup(visits.groupBy("shard")).applyInArrow(
        search, f"query_id {id_kind}, vec_id {id_kind}, score double"
    )
    best = best.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    nearest = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
