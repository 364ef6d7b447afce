"""The Merkle manifest against one built in plain Python."""

import hashlib
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from trackfuse.llm import merkle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels_of(nodes, arity):
    levels = [nodes]
    while len(levels[-1]) > 1:
        n = levels[-1]
        levels.append([h("".join(n[i : i + arity])) for i in range(0, len(n), arity)])
    return levels


def path(levels, i, arity):
    for nodes in levels[:-1]:
        run = nodes[i // arity * arity :][:arity]
        yield run[: i % arity], run[i % arity + 1 :]
        i //= arity


def tampered(row):
    changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None
    return (*row[:4], row[4].replace("\n", "")) if changed else row


def manifest(rows, arity):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for own in groups.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = [levels_of([leaf(r) for r in groups[g]], arity) for g in names]
    top = levels_of([t[-1][0] for t in trees], arity)
    for g, name in enumerate(names):
        for i, row in enumerate(groups[name]):
            node, siblings = leaf(tampered(row)), []
            for before, after in [*path(trees[g], i, arity), *path(top, g, arity)]:
                node = h("".join([*before, node, *after]))
                siblings += before + after
            yield row[0], leaf(row), trees[g][-1][0], top[-1][0], h("".join(siblings)), node, node == top[-1][0]


def found(docs, **options):
    text = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    now = merkle.leaf_digest([*(F.col(c) for c in FIELDS[:-1]), text])
    made = merkle.merkle_manifest(docs, FIELDS, check=now, **options)
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return Counter(tuple(r) for r in made.select(*names).collect())


def rows_of(seed=1, n=150):
    rng = random.Random(seed)
    # One source holds most rows; there are more sources than a block takes, one of no name and one of an empty one.
    sources = ["big"] * 60 + [None, "", "é", "Z", "a", *(f"s{i}" for i in range(12))]
    texts = [None, "", "a\nb", "line\n", "plain", "x" * 5000 + "\n"]
    rows = [(i, rng.choice(sources), rng.choice([None, "en"]), rng.choice([None, i]), rng.choice(texts)) for i in range(n)]
    return rows + [(None, "big", None, None, None), (3, "big", "en", 1, "of another row's id"), rows[0], rows[0]]


@pytest.mark.parametrize(("arity", "levels"), [(3, 1), (3, 2), (2, 3), (3, 6)])
def test_manifest(spark, arity, levels):
    rows = rows_of()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    docs = docs.withColumns({c: F.lit("x") for c in ("tree", "idx", "digest", "leaf", "root", "_id", "proof")})
    assert found(docs, arity=arity, levels=levels) == Counter(manifest(rows, arity))


@pytest.mark.parametrize("n", [0, 1, 2])
def test_few_leaves(spark, n):
    rows = [(1, None, "en", 3, "a\nb"), (2, None, None, None, None)][:n]
    assert found(spark.createDataFrame(rows, SCHEMA)) == Counter(manifest(rows, 3) if rows else ())


def test_proofs_lead_to_the_root(spark):
    docs = spark.createDataFrame(rows_of(), SCHEMA)
    rows = merkle.merkle_manifest(docs, FIELDS, levels=2).collect()
    assert len({r.root for r in rows}) == 1
    for r in rows:
        assert merkle.fold(r.leaf.encode(), r.proof.encode()).decode() == r.root
        if r.proof:
            assert merkle.fold(merkle.node_digest(r.leaf.encode()), r.proof.encode()).decode() != r.root


def test_witnesses_grow_with_each_completed_run():
    tree = merkle.WitnessTree(3, 2)
    sizes = []
    for i in range(4):
        tree.append(h(str(i)).encode())
        sizes.append([len(w) for w in tree.witness])
    assert sizes == [[0], [0, 0], [130] * 3, [130] * 3 + [0]]
    root = tree.close()
    assert [merkle.fold(h(str(i)).encode(), bytes(w)) for i, w in enumerate(tree.witness)] == [root] * 4
