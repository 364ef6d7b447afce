"""The pipeline's stages against plain versions, each on what the stage before kept."""

from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from trackfuse.llm.queries import QUERIES, TOKENIZER

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """What each stage returns, as rows."""
    folder, out = tmp_path_factory.mktemp("stages"), {}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    extra = [(10_001, None, None, None, None), (10_002, "", "en", "src0", 0), (10_003, "123 456", "en", None, 7)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema)).unionByName(docs.filter("doc_id < 3"))
    out["documents"] = docs.collect()
    columns = docs.columns
    for name, function in corpus_pipeline.STAGES:
        function(spark, docs, SMALL).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        assert name == "packing" or docs.columns == columns
        out[name] = docs.collect()
    return out


def test_languages_stay(kept):
    gone = {r.doc_id for r in kept["documents"]} - {r.doc_id for r in kept["language_id"]}
    wanted = {r.doc_id for r in kept["documents"] if not any(c.isalpha() for c in r.text or "")}
    assert gone == wanted >= {10_001, 10_002, 10_003}


def test_one_of_each_group_stays(kept):
    rows = [(r.doc_id, r.text) for r in kept["language_id"]]
    wanted = {k for k, _, c in brute.components(rows) if k == c}
    assert {r.doc_id for r in kept["near_copies"]} == wanted


def test_one_row_of_each_group_stays(spark):
    """Repeated rows, null ids and different texts of one id: each component keeps a row, also without its passages."""
    def text(name, n=60):
        return " ".join(f"{name}{i}" for i in range(n))

    rows = [(1, text("a")), (1, text("a")), (2, text("b")), (None, text("b")), (None, text("c")), (None, text("c"))]
    rows += [(4, text("d")), (5, text("d")), (5, text("e")), (None, text("f")), (7, text("g", 50)), (7, text("g", 51))]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in rows], docs.schema)
    found = corpus_pipeline.near_copies(spark, docs, SMALL)
    left = sorted((r.text.split()[0], r.doc_id or 0) for r in found.collect())
    assert left == [("a0", 1), ("b0", 2), ("c0", 0), ("d0", 4), ("e0", 5), ("f0", 0), ("g0", 7)]
    after = corpus_pipeline.repeated_passages(spark, found, SMALL).collect()
    assert sorted(r.text for r in after) == sorted(r.text for r in found.collect())


def test_passages_go(kept):
    before = {r.doc_id: r for r in kept["near_copies"]}
    texts = [r.text for r in kept["near_copies"]]
    wanted = {k: w for (k, w) in zip((r.doc_id for r in kept["near_copies"]), brute.repeated_words(texts), strict=True)}
    after = {r.doc_id: r for r in kept["repeated_passages"]}
    assert set(after) == {k for k, (n, removed, _) in wanted.items() if not removed or removed < n}
    for k, r in after.items():
        if wanted[k][1]:
            assert brute.sha(r.text.encode()) == wanted[k][2] and r.n_chars == len(r.text)
        else:
            assert r.text == before[k].text
        assert (r.lang, r.source) == (before[k].lang, before[k].source)


def test_leaks_go(spark, kept):
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    rows = kept["repeated_passages"]
    hits = brute.leaks([r.text for r in rows], items)
    assert {r.doc_id for r in kept["benchmark_leaks"]} == {r.doc_id for r, h in zip(rows, hits, strict=True) if not h[1]}


def test_all_is_packed(kept):
    assert {r.doc_id for r in kept["packing"]} == {r.doc_id for r in kept["benchmark_leaks"]}
    ends = Counter()
    for r in kept["packing"]:
        ends[r.sequence_id] += r["length"]
    assert max(ends.values()) <= 4096


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, function in corpus_pipeline.STAGES:
        assert function(spark, docs, SMALL).count() == 0


def test_nothing_learned_drops_nothing(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(20).withColumn("lang", F.lit(None).cast("string"))
    wanted = sum(any(c.isalpha() for c in r.text or "") for r in docs.collect())
    assert corpus_pipeline.language_id(spark, docs, SMALL).count() == wanted > 0


CLASHES = ("kept", "_id", "_text_hash", "row", "lang_pred", "n_hit", "_text", "group", "removed", "spans", "_hash")


@pytest.mark.parametrize("stage", range(4))
def test_columns_of_any_name_keep_their_values(spark, stage):
    """Columns that are called like what a stage makes come through it as they are."""
    name, function = corpus_pipeline.STAGES[stage]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60)
    plain = sorted((r.doc_id, r.text) for r in function(spark, docs, SMALL).collect())
    docs = docs.withColumns({c: F.concat(F.lit(f"{c} "), F.col("doc_id").cast("string")) for c in CLASHES})
    found = function(spark, docs, SMALL)
    assert found.columns == docs.columns
    rows = found.collect()
    assert sorted((r.doc_id, r.text) for r in rows) == plain
    assert all(r[c] == f"{c} {r.doc_id}" for r in rows for c in CLASHES), name


def test_rows_of_many_megabytes(spark):
    """Batches end at so many bytes, so that rows of any length pass without many of them being held at once."""
    words = " ".join(f"word{i}" for i in range(150_000))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(30)
    long = spark.createDataFrame([(20_000 + i, f"{words} number {i}", "en", "s", 1) for i in range(12)], docs.schema).coalesce(1)
    docs = docs.unionByName(long)
    for number in (0, 3):
        function = corpus_pipeline.STAGES[number][1]
        assert {r.doc_id for r in function(spark, docs, SMALL).select("doc_id").collect()} >= {20_000 + i for i in range(12)}


def test_each_operator_has_a_query():
    assert [int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")] == list(range(1, 14))
    assert TOKENIZER.endswith(".json") and F is not None
