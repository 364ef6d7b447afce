"""A Merkle manifest of a data set: a digest per row, a root per group, one over all, and a proof for every row.

A group's leaves are appended in order to a tree of ``arity``. Blocks of ``arity ** levels``
leaves are aligned, so a block can be appended by one task: a leaf gets its witness level by
level, each time the run that its open subtree belongs to is complete. The blocks' roots are
leaves of the next layer, again in aligned blocks, and their witnesses complete those of
the rows below. So a group of any size is the work of many tasks, and a task holds one block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackfuse.llm.numbering import numbered
from trackfuse.session import stage

ARITY = 3
#: Levels of a block: ``ARITY ** LEVELS`` nodes, 729.
LEVELS = 6
_HEX = 64


def node_digest(parts: bytes) -> bytes:
    """SHA-256 of the children's digests, which are lowercase hex text, as such again."""
    return hashlib.sha256(parts).hexdigest().encode()


def height(leaves: int, arity: int) -> int:
    """Levels above ``leaves`` nodes until one is left."""
    levels, reach = 0, 1
    while reach < leaves:
        levels, reach = levels + 1, reach * arity
    return levels


class WitnessTree:
    """Nodes are appended one by one; every node's witness grows as the runs above it are completed.

    A witness has for each level the node's place in its run and the number of siblings, a
    hexadecimal digit each, and the siblings' digests. ``levels`` says how far the tree goes.
    """

    def __init__(self, arity: int, levels: int):
        if not 2 <= arity <= 16:
            raise ValueError("the arity is 2 to 16")
        self.arity, self.levels = arity, levels
        # At each level the open run: digests, and the first of the appended nodes below each.
        self.open: list[list[tuple[bytes, int]]] = [[] for _ in range(levels + 1)]
        self.witness: list[bytearray] = []

    def append(self, digest: bytes) -> None:
        self.witness.append(bytearray())
        self._add(0, digest, len(self.witness) - 1)

    def _add(self, level: int, digest: bytes, first: int) -> None:
        run = self.open[level]
        run.append((digest, first))
        if len(run) == self.arity and level < self.levels:
            self._complete(level, len(self.witness))

    def _complete(self, level: int, end: int) -> None:
        run, self.open[level] = self.open[level], []
        digests = [d for d, _ in run]
        ends = [first for _, first in run[1:]] + [end]
        for place, ((_, first), last) in enumerate(zip(run, ends, strict=True)):
            step = b"%x%x" % (place, len(run) - 1) + b"".join(digests[:place] + digests[place + 1 :])
            for node in range(first, last):
                self.witness[node] += step
        self._add(level + 1, node_digest(b"".join(digests)), run[0][1])

    def close(self) -> bytes:
        """Complete the last, shorter runs; the root."""
        for level in range(self.levels):
            if self.open[level]:
                self._complete(level, len(self.witness))
        return self.open[self.levels][0][0]


def steps(proof: bytes) -> Iterator[tuple[int, bytes]]:
    """``(place, siblings)`` of each level of a proof."""
    at = 0
    while at < len(proof):
        place, end = int(proof[at : at + 1], 16), at + 2 + int(proof[at + 1 : at + 2], 16) * _HEX
        yield place, proof[at + 2 : end]
        at = end


def fold(leaf: bytes, proof: bytes) -> bytes:
    """The root that a leaf and its proof lead to."""
    for place, siblings in steps(proof):
        leaf = node_digest(siblings[: place * _HEX] + leaf + siblings[place * _HEX :])
    return leaf


def leaf_digest(columns: Sequence[Column]) -> Column:
    """SHA-256 over the columns: ``-`` for null, else UTF-8 byte count, ``:`` and the value as text."""
    texts = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def _blocks(
    batches: Iterator[pa.RecordBatch], arity: int, levels: int
) -> Iterator[tuple[pa.RecordBatch, WitnessTree, bytes, tuple[str, str | None]]]:
    """``(rows, tree, root, above)`` of each block.

    The columns are idx, total, digest, proof, subroot, and more. A row without a digest precedes
    a block's rows: ``above`` is what it has of the block's root. Without such rows
    there is nothing above.
    """
    size, above, tree, parts = arity**levels, ("", None), None, []
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(5)]
        begin = 0
        for at, (idx, total, digest, proof, subroot) in enumerate(zip(*columns, strict=True)):
            if digest is None:
                above, begin = (proof, subroot), at + 1
                continue
            if idx % size == 0:
                begin = at
                tree = WitnessTree(arity, levels if total > size else height(total, arity))
            tree.append(digest.encode())
            if idx % size == size - 1 or idx == total - 1:
                parts.append(batch.slice(begin, at + 1 - begin))
                rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
                yield rows, tree, tree.close(), above
                parts, begin = [], at + 1
        if begin < batch.num_rows:
            parts.append(batch.slice(begin))


def _gathered(nodes: DataFrame, size: int, upper: DataFrame | None = None) -> DataFrame:
    """Nodes (tree, idx, total, digest, ...) with each block's rows together and in order, after its row of ``upper``.

    The shuffle goes by tree and block, so no task needs more than one block at a time.
    """
    rest = [c for c in nodes.columns if c not in ("tree", "idx", "total", "digest")]
    rows = nodes.select("tree", F.expr(f"idx div {size}").alias("block"), "idx", "total", "digest", *rest)
    if upper is None:
        nothing = F.lit(None).cast("string")
        rows = rows.withColumns({"proof": nothing, "subroot": nothing})
    else:
        above = upper.select("tree", F.col("idx").alias("block"), "proof", "subroot")
        rows = rows.unionByName(above, allowMissingColumns=True)
    rows = rows.repartition("tree", "block").sortWithinPartitions("tree", "block", F.col("idx").asc_nulls_first())
    return rows.select("idx", "total", "digest", "proof", "subroot", "tree", *rest)


def _climb(nodes: DataFrame, arity: int, levels: int) -> DataFrame:
    """The next layer: the root of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = arity**levels
        for rows, _, root, _ in _blocks(batches, arity, levels):
            idx, total = rows.column(0)[0].as_py() // size, -(-rows.column(1)[0].as_py() // size)
            columns = [pa.array([idx]), pa.array([total]), pa.array([root.decode()]), rows.column(5).slice(0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=["idx", "total", "digest", "tree"])

    kind = nodes.schema["tree"].dataType.simpleString()
    found = _gathered(nodes, arity**levels).mapInArrow(run, f"idx bigint, total bigint, digest string, tree {kind}")
    return stage(found, "merkle_layer")


def _layers(leaves: DataFrame, arity: int, levels: int) -> list[DataFrame]:
    """The leaves and the layers above them; the last has one node for each tree."""
    layers = [leaves]
    most = leaves.agg(F.max("total").alias("n")).first().n or 0
    while most > 1:
        layers.append(_climb(layers[-1].select("idx", "total", "digest", "tree"), arity, levels))
        most = -(-most // arity**levels)
    return layers


def _witnessed(
    nodes: DataFrame,
    upper: DataFrame | None,
    arity: int,
    levels: int,
    keep: Sequence[str],
    made: str,
    finish: Callable[[pa.RecordBatch, list[bytes], str | None], list[pa.Array]],
) -> DataFrame:
    """The nodes' ``keep`` columns and what ``finish`` makes of them, their proofs and their subroot (the fields ``made``)."""
    fields = ", ".join([*(f"`{c}` {nodes.schema[c].dataType.simpleString()}" for c in keep), made])
    names = [*keep, *(f.split()[0] for f in made.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, tree, _, (above, subroot) in _blocks(batches, arity, levels):
            proofs = [bytes(w) + above.encode() for w in tree.witness]
            kept = [rows.column(rows.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*kept, *finish(rows, proofs, subroot)], names=names)

    return _gathered(nodes, arity**levels, upper).mapInArrow(run, fields)


def _strings(values: Iterator[bytes]) -> pa.Array:
    return pa.array([v.decode() for v in values], pa.string())


def _descend(layers: list[DataFrame], upper: DataFrame | None, arity: int, levels: int) -> DataFrame | None:
    """Proofs of the nodes of the second layer, from those of the last one."""

    def finish(rows: pa.RecordBatch, proofs: list[bytes], subroot: str | None) -> list[pa.Array]:
        return [_strings(proofs), pa.array([subroot] * len(proofs), pa.string())]

    for nodes in layers[-2:0:-1]:
        upper = _witnessed(nodes, upper, arity, levels, ["tree", "idx"], "proof string, subroot string", finish)
    return upper


def merkle_manifest(
    docs: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_col: str = "doc_id",
    group_col: str = "source",
    check: Column | None = None,
    with_proof: bool = True,
    arity: int = ARITY,
    levels: int = LEVELS,
) -> DataFrame:
    """Per row: id, leaf, subroot, root, proof_sha256, proof; with ``check`` also folded_root and verified.

    The leaf is the digest of ``fields`` (``leaf_digest``). Within a group leaves ascend by
    id; every ``arity`` consecutive nodes, the last run of a level being shorter, become
    the digest of theirs until one is left, the group's subroot. Subroots, ordered by
    group, are joined to the root in the same way. ``proof`` holds the siblings on the
    way up (``steps`` reads it, ``fold`` climbs it), ``proof_sha256`` is the digest of the
    siblings alone, from the leaf upwards and left to right. ``check`` is the digest that the
    row is held to now: folded up its proof, it gives ``folded_root``, and the row is
    verified if that is the root.

    Only digests are shuffled, never texts. A null in ``fields`` counts as ``-``; a null
    group is a group, the first one; null ids come first; rows of one id go by their
    digests, and repeated rows are a leaf each. A lone leaf is its group's subroot, a lone
    subroot the root. Extra columns are ignored; an empty table gives an empty one.
    """
    digest = leaf_digest([F.col(c) for c in fields])
    held = F.lit(None).cast("string") if check is None else check
    leaves = docs.select(F.col(id_col).alias("_id"), F.col(group_col).alias("tree"), digest.alias("digest"), held.alias("held"))
    # Most rows are held to what they are; the others alone carry a second digest.
    leaves = leaves.withColumn("held", F.nullif(F.col("held"), F.col("digest")))
    # Ranges are cut from a sample of the rows, so they are read twice; the texts are read once.
    leaves = numbered(stage(leaves, "digests"), "tree", ["_id", "digest"], "leaves")
    layers = _layers(leaves, arity, levels)

    subroots = layers[-1].select(F.lit(0).alias("tree"), F.col("tree").alias("_name"), "digest")
    tops = numbered(subroots, "tree", ["_name"], "subroots")
    top_layers = _layers(tops, arity, levels)
    last = top_layers[-1].select("digest").first()
    root = last.digest if last else ""

    def as_upper(rows: pa.RecordBatch, proofs: list[bytes], _) -> list[pa.Array]:
        return [_strings(proofs), rows.column(2)]

    upper = _descend(top_layers, None, arity, levels)
    upper = _witnessed(tops, upper, arity, levels, ["_name"], "proof string, subroot string", as_upper)
    upper = upper.select(F.col("_name").alias("tree"), F.lit(0).cast("bigint").alias("idx"), "proof", "subroot")
    upper = _descend(layers, upper, arity, levels)

    checked = check is not None
    made = "subroot string, proof_sha256 string" + ", proof string" * with_proof
    made += ", folded_root string, verified boolean" * checked

    def finish(rows: pa.RecordBatch, proofs: list[bytes], subroot: str | None) -> list[pa.Array]:
        out = [pa.array([subroot] * len(proofs), pa.string())]
        out.append(_strings(node_digest(b"".join(siblings for _, siblings in steps(p))) for p in proofs))
        if with_proof:
            out.append(_strings(proofs))
        if checked:
            now = rows.column(rows.schema.get_field_index("held")).to_pylist()
            own = zip(now, rows.column(2).to_pylist(), proofs, strict=True)
            folded = [fold((h or d).encode(), p).decode() for h, d, p in own]
            out += [pa.array(folded, pa.string()), pa.array([f == root for f in folded], pa.bool_())]
        return out

    found = _witnessed(leaves, upper, arity, levels, ["_id", "digest"], made, finish)
    added = [c.split()[0] for c in made.split(", ")]
    return found.select(
        F.col("_id").alias(id_col), F.col("digest").alias("leaf"), added[0], F.lit(root).alias("root"), *added[1:]
    )
