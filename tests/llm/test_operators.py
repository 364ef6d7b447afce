"""The operators on small tables with nulls, empty and long texts, copies, repeated rows, clashing columns."""

import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm import brute
from trackfuse.llm import (
    decontaminate,
    fm_dedup,
    hilbert,
    jaccard_join,
    language,
    neighbours,
    packing,
    pretokens,
    repeats,
    suffix_dedup,
    token_counts,
    url_filter,
    words,
)
from trackfuse.llm.queries import URL_RULES

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD_TEXTS = ["It's <|endoftext|> odd\u00a0Ünï İ ſ ﬁ", "x\u0301 ²³ 12 don't", "日本 \u2028 tab\x0b", "<|startoftext|"]


def bag(df, *columns):
    return Counter(tuple(r) for r in df.select(*(columns or df.columns)).collect())


@pytest.mark.parametrize("hot", [2_000, 1])
def test_repeated_bytes(docs, no_docs, rows_of, hot):
    options = {"hot_contexts": hot, "shard_contexts": 20}
    found = suffix_dedup.repeated_bytes_digest(docs, **options)
    wanted = brute.repeated_bytes([t for _, t in rows_of])
    assert bag(found) == Counter((k, *w) for (k, _), w in zip(rows_of, wanted, strict=True))
    if hot == 1:
        assert suffix_dedup.repeated_bytes_digest(no_docs).count() == 0
        kept = suffix_dedup.remove_repeated_bytes(docs, window=9).filter("doc_id = 504").first()
        assert (kept.n_bytes, kept.spans, kept.kept) == (700, [0, 700], b"")


@pytest.mark.parametrize("hot", [2_000, 1])
def test_repeated_words(docs, no_docs, rows_of, hot):
    options = {"hot_contexts": hot, "shard_contexts": 20}
    found = fm_dedup.repeated_words_digest(docs, **options)
    wanted = brute.repeated_words([t for _, t in rows_of])
    assert bag(found) == Counter((k, *w) for (k, _), w in zip(rows_of, wanted, strict=True))
    if hot == 1:
        assert fm_dedup.repeated_words_digest(no_docs).count() == 0
        kept = fm_dedup.remove_repeated_words(docs, window=9).filter("doc_id = 505").first()
        assert (kept.n_words, kept.spans, kept.kept) == (300, [0, 300], "")


@pytest.mark.parametrize("hot", [2_000, 1])
def test_repeats_within_one_text(spark, hot):
    """Runs of one symbol, lines said over and over, of which each is in one text alone; a run longer than a part."""
    noise = np.random.default_rng(5).integers(97, 123, 600).astype(np.uint8).tobytes().decode()
    line = noise[400:470]
    texts = [noise[:90] + "-" * 230 + noise[90:150], noise[150:350] + "=" * 200 + noise[350:360], "ab" * 300]
    texts += [noise[360:400] + line * 9 + noise[470:500], noise[:50] + line + "." * 150 + line + "." * 151]
    texts += ["é" * 130, "z" * 199, "y" * 200, "x" * 201]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    options = {"hot_contexts": hot, "shard_contexts": 3}
    found = bag(suffix_dedup.repeated_bytes_digest(df, **options))
    assert found == Counter((k, *w) for (k, _), w in zip(rows, brute.repeated_bytes(texts), strict=True))
    spaced = [" ".join(t) for t in texts] + ["a " * 34, "b " * 35, "c " * 36, "u v w " * 20 + "x"]
    rows = list(enumerate(spaced))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = bag(fm_dedup.repeated_words_digest(df, **options))
    assert found == Counter((k, *w) for (k, _), w in zip(rows, brute.repeated_words(spaced), strict=True))


def test_repeats_in_very_long_texts(spark):
    size = 3 * repeats.MAX_SYMBOLS
    df = spark.createDataFrame([(1, "clean " + "q" * size), (2, "also clean")], "doc_id bigint, text string")
    found = {r.doc_id: r for r in suffix_dedup.remove_repeated_bytes(df).collect()}
    assert (found[1].spans, bytes(found[1].kept)) == ([6, size + 6], b"clean ")
    assert (found[2].spans, bytes(found[2].kept)) == ([], b"also clean")


def test_runs_have_few_anchors():
    window, gram = 200, 48
    same = np.full(1 << 16, 7, np.uint64)
    valid = np.arange(len(same)) <= len(same) - window
    first, n, grams, several = repeats.anchored_runs(same, valid, window, gram)
    assert len(first) <= len(same) / (window - gram) + 1 and several.all() and len(set(grams.tolist())) == 1
    assert n.sum() == valid.sum() and (first[1:] == first[:-1] + n[:-1]).all()
    mixed = words.mix(np.arange(1 << 12, dtype=np.uint64))
    first, n, _, several = repeats.anchored_runs(mixed, np.arange(len(mixed)) <= len(mixed) - window, window, gram)
    assert not several.any() and n.max() <= window - gram + 1


@pytest.mark.parametrize("cell", [3_000, 3])
def test_components(docs, no_docs, rows_of, cell, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CELL_ROWS", cell)
    monkeypatch.setattr(jaccard_join, "CELL_SETS", cell)
    found = jaccard_join.near_duplicate_components(docs)
    assert bag(found) == Counter(brute.components(rows_of))
    if cell == 3:
        assert jaccard_join.near_duplicate_components(no_docs).count() == 0


def test_links_found_only_through_later_lists(spark, monkeypatch):
    """With no first lists at all everything is up to the index lists in blocks."""
    monkeypatch.setattr(jaccard_join, "MOSTLY_SHARED", 100.0)
    words = [f"v{i}" for i in range(60)]
    rows = [(i, " ".join(words[: 40 + i])) for i in range(12)] + [(20, "one two"), (21, "One TWO"), (22, "one")]
    found = jaccard_join.near_duplicate_components(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert bag(found) == Counter(brute.components(rows))


@pytest.mark.parametrize("cell", [4_000, 3])
def test_groups_of_near_copies_make_no_row_per_pair(spark, monkeypatch, cell):
    """All sets of a group may be linked with each other: what is handed on grows with the sets, not with the pairs."""
    made, stage = {}, jaccard_join.stage

    def counted(df, name="staged"):
        kept = stage(df, name)
        made[name] = max(made.get(name, 0), kept.count())
        return kept

    monkeypatch.setattr(jaccard_join, "MOSTLY_SHARED", 100.0)
    monkeypatch.setattr(jaccard_join, "CELL_SETS", cell)
    monkeypatch.setattr(jaccard_join, "stage", counted)
    linked, apart = ([f"{kind}{i}" for i in range(100)] for kind in "va")
    rows = [(i, " ".join(linked[:i] + ["other"] + linked[i + 1 :])) for i in range(0, 100, 2)]
    rows += [(100 + i, " ".join(linked[:i] + ["more"] + linked[i + 1 :])) for i in range(1, 100, 2)]
    # These two and two have one word in common where others differ: some pairs link, most just do not.
    rows += [(200 + i, " ".join(apart[:i] + ["x", f"y{i // 2}"] + apart[i + 2 :])) for i in range(98)]
    found = jaccard_join.near_duplicate_components(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert bag(found) == Counter(brute.components(rows))
    assert max(made.get(name, 0) for name in ("pairs", "clusters")) <= made["lists"]


ITEMS = [(1, "w1 w2 w3 w4 w5 w6 w7 w8 w9é w10 w11 w12"), (2, "One two!"), (3, None), (None, "alone"), (1, "again one"), (4, "--")]


@pytest.mark.parametrize("block", [200_000, 5])
def test_leaks(spark, docs, block):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string").withColumn("n_words", F.lit(0))
    more = [(1, "x " + ITEMS[0][1].upper().replace("É", "é") + " y one, TWO"), (2, "again ONE two alone"), (3, None), (4, "")]
    rows = more + [(9, " ".join(ITEMS[0][1].split()[:9])), (9, " ".join(ITEMS[0][1].split()[2:]))]
    own = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("spans", F.lit(1))
    found = decontaminate.find_leaks(own, items, block_words=block)
    got = [(r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in found.collect()]
    wanted = [(k, *w) for (k, _), w in zip(rows, brute.leaks([t for _, t in rows], ITEMS), strict=True)]
    assert sorted(got) == sorted(wanted)
    assert decontaminate.find_leaks(own, items.limit(0)).agg(F.sum("n_hit")).first()[0] == 0
    assert decontaminate.find_leaks(own.limit(0), items).count() == 0
    clean = {r.doc_id: r.text for r in decontaminate.remove_leaks(own, items, block_words=block).collect()}
    assert clean[4] == "" and clean[3] is None and 1 not in clean
    assert decontaminate.remove_leaks(own, items, coverage=1.0).filter("doc_id = 1").first().text == "x  y "


def test_token_counts(spark, docs, no_docs, rows_of):
    rows = [*rows_of, *((900 + i, t) for i, t in enumerate(ODD_TEXTS))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("n_tokens", F.lit("x"))
    encoded = Tokenizer.from_file(PATH).encode_batch([t or "" for _, t in rows], add_special_tokens=False)
    wanted = [(k, len((t or "").encode()), len(e.ids), len(e.ids) > 2048) for (k, t), e in zip(rows, encoded, strict=True)]
    assert bag(token_counts.token_counts(df, PATH)) == Counter(wanted)
    assert token_counts.token_counts(no_docs, PATH).count() == 0


SCRIPTS = [
    "Ταῦτα πάντα ΣΟΦΟΣ σοφός, ὁ ΧΡΌΝΟΣ", "Съешь же ещё этих мягких французских булок", "“Curly” – it’s don't, DON’T…",
    "我能吞下玻璃而不伤身体。日本語のテキスト", "हिन्दी में १२३ और ٤٥٦", "e\u0301 \u0130stanbul ǅ ﬁ ½ Ⅷ", "👩‍👩‍👧 \u200b\ufeff x\u00a0y\u3000z",
    "a <|endoftext|>б<|startoftext|><|endoftext|> ’s <|ENDOFTEXT|> <|endoftext|", "<|endoftext|>", "Ã© é \u0120 \x00 \x85 \x1f",
]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_token_counts_of_every_script(spark, name, monkeypatch):
    """No text of a tokenizer with a rule for pre-tokens goes through it whole."""
    path = public_tokenizers.path(name)
    table = pretokens.PieceTable(path)
    whole = Tokenizer.from_file(path)
    quick = name.startswith("word")
    if quick:
        monkeypatch.setattr(table, "whole", None)
    texts = [*SCRIPTS, *ODD_TEXTS, " ".join(SCRIPTS)]
    assert token_counts.count_tokens(table, texts) == [len(whole.encode(t, add_special_tokens=False).ids) for t in texts]
    for t in texts:
        cut = table.own_split(t)
        if cut is not None:
            ids = b"".join(table.memo[w] for w in cut)
            assert ids == np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
        assert cut is not None or not quick


@pytest.mark.parametrize("name", ["byte_bpe_50k.json"])
def test_token_counts_of_another_kind(spark, rows_of, name):
    path = public_tokenizers.path(name)
    df = spark.createDataFrame(rows_of, "doc_id bigint, text string")
    encoded = Tokenizer.from_file(path).encode_batch([t or "" for _, t in rows_of], add_special_tokens=False)
    got = bag(token_counts.token_counts(df, path), "doc_id", "n_tokens")
    assert got == Counter((k, len(e.ids)) for (k, _), e in zip(rows_of, encoded, strict=True))


def test_packing(spark, no_docs, rows_of):
    rows = [*rows_of, *((900 + i, t) for i, t in enumerate(ODD_TEXTS))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4).withColumn("part", F.lit("x"))
    capacity = 64
    found = packing.pack(df, PATH, capacity=capacity, with_ids=True).collect()
    encoded = Tokenizer.from_file(PATH).encode_batch([t or "" for _, t in rows], add_special_tokens=False)
    wanted = Counter()
    for (k, _), e in zip(rows, encoded, strict=True):
        ids = [*e.ids, 1]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            own = ids[at : at + capacity]
            wanted[k, piece, at, len(own), zlib.crc32(struct.pack(f"<{len(own)}I", *own)), tuple(own)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r["length"], r.ids_crc32, tuple(r.ids)) for r in found) == wanted
    places = {}
    for r in found:
        places.setdefault(r.sequence_id, []).append((r.offset, r["length"]))
    for own in places.values():
        ends = [0]
        for offset, length in sorted(own):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= capacity
    assert len(places) <= -(-sum(r["length"] for r in found) // capacity) * 1.1 + 1
    assert packing.pack(no_docs, PATH).count() == 0


def test_shards(docs, no_docs, rows_of):
    df = docs.drop("size").withColumns({"lang": F.when(F.col("doc_id") % 3 == 0, "a"), "size": F.lit("clash")})
    found = hilbert.hilbert_shards(df, ("lang", "doc_id", "size"), 7).collect()
    got = Counter((r.doc_id, r["size"], r.text_crc32) for r in found)
    assert got == Counter((k, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for k, t in rows_of)
    counts = Counter(r.shard for r in found)
    assert len(counts) == 7 and max(counts.values()) - min(counts.values()) <= 1
    for s, n in counts.items():
        assert sorted(r.slot for r in found if r.shard == s) == list(range(n))
    order = [r.curve for r in sorted(found, key=lambda r: (r.shard, r.slot))]
    assert order == sorted(order)
    few = hilbert.hilbert_shards(df.limit(3), ("lang",), 40).collect()
    assert sorted((r.shard, r.slot) for r in few) == [(0, 0), (1, 0), (2, 0)]
    assert hilbert.hilbert_shards(no_docs, ("doc_id",), 3).count() == 0


def test_shard_files(spark, tmp_path):
    df = spark.range(50).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    placed = hilbert.hilbert_shards(df, ("doc_id",), 5)
    path = hilbert.write_shards(df, placed, str(tmp_path / "shards"))
    back = spark.read.parquet(path)
    assert bag(back, "doc_id", "text") == bag(df) and back.select("shard").distinct().count() == 5


def test_languages(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("score", F.lit("clash"))
    model = language.learn_languages(df)
    tested = df.filter(language.held_out("doc_id"))
    found = language.identify_languages(tested, model).join(df.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in found]) >= 0.97
    assert all(0 <= r.score <= 1 for r in found)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 !"), (3, "12 !"), (None, "the of"), (4, "日本")], "doc_id bigint, text string")
    got = sorted((r.doc_id or 0, r.lang_pred) for r in language.identify_languages(odd, model).collect())
    assert got[1:5] == [(1, "und"), (2, "und"), (3, "und"), (3, "und")] and got[0][1] in model.names
    assert got[5][1] in model.names
    nothing = language.learn_languages(df.limit(0))
    assert {r.lang_pred for r in language.identify_languages(odd, nothing).collect()} == {"und"}
    long = "the quick " * 50_000
    assert language.identify_languages(spark.createDataFrame([(1, long)], "doc_id int, text string"), model).count() == 1


def _labelled(spark, texts):
    """Rows that are learned from and further ones that are not, for {label: text number -> text}."""
    rows = [(i, make(i), lang) for n, (lang, make) in enumerate(texts.items()) for i in range(1000 * n, 1000 * n + 40)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


def _share_right(df, model=None):
    model = model or language.learn_languages(df)
    tested = df.filter(language.held_out("doc_id"))
    found = language.identify_languages(tested, model).join(df.select("doc_id", "lang"), "doc_id").collect()
    return np.mean([r.lang_pred == r.lang for r in found])


def _prose(first, letters, seed, spaced=True):
    """A maker of texts of 300 words drawn from 500 that are made of ``letters`` letters from code point ``first`` on."""
    rng = np.random.default_rng(seed)
    words = ["".join(chr(first + c) for c in rng.integers(0, letters, rng.integers(2, 6))) for _ in range(500)]
    return lambda i: (" " if spaced else "").join(np.random.default_rng(i).choice(words, 300))


def test_languages_of_many_scripts(spark):
    """Two languages in each of several scripts, two scripts of thousands of letters among them."""
    scripts = {"la": (0x61, 26), "cy": (0x430, 32), "gr": (0x3B1, 17), "ar": (0x627, 20), "th": (0xE01, 40), "ka": (0x3041, 80)}
    texts = {f"{s}{k}": _prose(*at, seed=10 * n + k) for n, (s, at) in enumerate(scripts.items()) for k in range(2)}
    texts |= {f"{s}{k}": _prose(*at, seed=90 + k + at[1], spaced=False) for s, at in {"zh": (0x4E00, 6000), "ko": (0xAC00, 3000)}.items() for k in range(2)}
    assert _share_right(_labelled(spark, texts)) >= 0.98


def test_long_and_rare_labels_are_learned(spark, monkeypatch):
    """Labels of long texts only, and more labels than two hundred."""
    short = _prose(0x430, 32, 1)
    long = _prose(0x61, 26, 2)
    df = _labelled(spark, {"short": short, "long": lambda i: " ".join(long(100 * i + k) for k in range(60))})
    assert df.filter("lang = 'long'").agg(F.min(F.octet_length("text"))).first()[0] > 60_000
    assert _share_right(df) == 1
    makers = {f"l{n:03}": _prose(0x61, 26, 1000 + n) for n in range(205)}
    rows = [(4 * n + i, make(i)[:900], lang) for n, (lang, make) in enumerate(makers.items()) for i in range(4)]
    many = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    known = {r.lang for r in many.filter(~language.held_out("doc_id")).select("lang").distinct().collect()}
    assert set(language.learn_languages(many).names) == known and len(known) > 200


def test_copies_do_not_fill_the_sample(spark):
    """A third of a language's rows is one text that sorts first."""
    copy, make = "aaaa " * 600, _prose(0x62, 25, 3)
    df = _labelled(spark, {"a": lambda i: copy if i % 3 else make(i), "b": _prose(0x62, 25, 4)})
    df = df.unionByName(df.filter(F.col("text") == copy).withColumn("doc_id", F.col("doc_id") + 500))
    model = language.learn_languages(df)
    assert model.sizes[0] > 15_000 and _share_right(df, model) == 1


def test_neighbours(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PART_ROWS", 40)
    monkeypatch.setattr(neighbours, "LIST_ROWS", 20)
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(600, 8)).round(1)
    vectors[100:300] = vectors[100]  # a third are the same
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    bad = [(1000, None), (1001, [0.0] * 8), (1002, [float("nan")] * 8), (1003, [1.0] * 7 + [None]), (1004, [1.0, 2.0])]
    bad += [(None, [1.0] * 8), (1005, [float("inf")] + [1.0] * 7), (1006, [])]
    df = spark.createDataFrame(rows + bad + rows[:3], "vec_id bigint, embedding array<double>").withColumn("list", F.lit(1))
    found = neighbours.nearest_neighbours(df, F.col("vec_id") % 50 == 0).collect()
    by = {}
    for r in found:
        by.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(by) == list(range(0, 600, 50))
    hits = 0
    for q, own in by.items():
        apart = np.sqrt(((vectors - vectors[q]) ** 2).sum(axis=1))
        apart[q] = np.inf
        best = np.lexsort((np.arange(600), apart))[:10]
        own.sort()
        assert [r for r, _, _ in own] == list(range(1, 11))
        assert all(apart[v] == s for _, v, s in own)
        hits += len({v for _, v, _ in own} & set(best.tolist()))
    assert hits >= 0.9 * 10 * len(by)
    few = neighbours.nearest_neighbours(df.filter("vec_id < 4"), F.col("vec_id") == 0)
    assert sorted((r["rank"], r.vec_id) for r in few.collect())[-1][0] == 3
    assert neighbours.nearest_neighbours(df.filter("vec_id > 999"), F.lit(True)).count() == 0


def test_neighbours_of_many_lists(spark, monkeypatch):
    """Nearly even vectors: far more lists than PROBES hold the true neighbours."""
    monkeypatch.setattr(neighbours, "LIST_ROWS", 20)
    vectors = np.random.default_rng(5).normal(size=(6000, 32))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
    found = neighbours.nearest_neighbours(df, F.col("vec_id") % 15 == 0).collect()
    hits = 0
    for q in range(0, 6000, 15):
        apart = ((vectors - vectors[q]) ** 2).sum(axis=1)
        apart[q] = np.inf
        hits += len({r.vec_id for r in found if r.query_id == q} & set(np.argsort(apart)[:10].tolist()))
    assert hits >= 0.9 * len(found) and len(found) == 4000


def test_neighbours_of_repeated_rows(spark):
    """An id whose row is there thirty times takes one place only."""
    vectors = np.random.default_rng(6).normal(size=(60, 4))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(1, (vectors[0] + 0.001).tolist())] * 30
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = neighbours.nearest_neighbours(df, F.col("vec_id") == 0).orderBy("rank").collect()
    apart = np.sqrt(((vectors - vectors[0]) ** 2).sum(axis=1))
    apart[0], apart[1] = np.inf, 0.0
    assert [r.vec_id for r in found] == np.argsort(apart)[:10].tolist()


def test_urls(spark):
    urls = ["HTTPS://A.Example.ORG/es/x?q#f", "http://example.org", "no scheme", None, "", "://", "x://h?a/b", "http://poker.com/casino",
            "http://x.net/XXX/1", "http://alphabet.net/betting", "http://y.com/fr/porn", "a://b://c.org/"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate([*urls, urls[0]])], "page_id bigint, url string")
    found = url_filter.url_filter(df.withColumn("host", F.lit(1)), rules=URL_RULES)
    got = [tuple(r)[1:5] for r in found.orderBy("page_id").collect()]
    assert got == [
        ("a.example.org", "/es/x", "example.org/es/", "block"),
        ("example.org", "", None, "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("h", "", None, "allow"),
        ("poker.com", "/casino", None, "block"),
        ("x.net", "/XXX/1", None, "block"),
        ("alphabet.net", "/betting", None, "allow"),
        ("y.com", "/fr/porn", "com/fr/", "allow"),
        ("b:", "//c.org/", None, "allow"),
        ("a.example.org", "/es/x", "example.org/es/", "block"),
    ]
    assert url_filter.url_filter(df.limit(0)).count() == 0
