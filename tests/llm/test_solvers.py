"""The parts that run within a task, against plain versions."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm import brute
from trackfuse.llm import decontaminate, fm_dedup, hilbert, jaccard_join, language, neighbours, packing, suffix_dedup
from trackfuse.llm.url_filter import Rules, Vocabulary


@pytest.mark.parametrize("seed", range(40))
def test_repeated_windows(seed):
    rng = random.Random(seed)
    letters, window = b"abcde"[: rng.choice([1, 2, 3, 5])], rng.choice([1, 3, 8, 9, 13, 20, 40])
    contexts = [bytes(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(rng.randint(1, 8))]
    contexts.append(contexts[0][2:] + b"x")
    counts = Counter(c[i : i + window] for c in contexts for i in range(len(c) - window + 1))
    wanted = [[i for i in range(len(c) - window + 1) if counts[c[i : i + window]] > 1] for c in contexts]
    assert [x.tolist() for x in suffix_dedup.repeated_windows(contexts, window)] == wanted
    spaced = [b" ".join(bytes([b]) for b in c) for c in contexts]
    assert [x.tolist() for x in fm_dedup.repeated_windows(spaced, window)] == wanted


def test_wavelet_ranks():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 37, 500)
    tree = fm_dedup.WaveletTree(values, 37)
    for symbol in range(37):
        begin, end = np.array([0, 3, 64]), np.array([500, 200, 128])
        b, e = tree.rank(np.full(3, symbol), begin, end)
        assert (e - b).tolist() == [(values[x:y] == symbol).sum() for x, y in zip(begin, end, strict=True)]


def _groups(k, links):
    parent = list(range(k))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[root(a)] = root(b)
    return {frozenset(i for i in range(k) if root(i) == root(j)) for j in range(k)}


@pytest.mark.parametrize("seed", range(30))
def test_links_of_a_list(seed):
    rng = random.Random(seed)
    base = [rng.sample(range(900), rng.randint(1, 40)) for _ in range(3)]
    sets = []
    for _ in range(rng.randint(2, 14)):
        own = set(rng.choice(base)) | set(rng.sample(range(900), rng.randint(0, 4)))
        own -= set(rng.sample(sorted(own), min(len(own) - 1, rng.randint(0, 4))))
        sets.append(np.unique(np.array(sorted(own), np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    plain = [set(s.tolist()) for s in sets]
    links = [
        (i, j) for i, a in enumerate(plain) for j, b in enumerate(plain[:i]) if 100 * len(a & b) >= 80 * len(a | b)
    ]
    assert _groups(len(sets), links) == _groups(len(sets), jaccard_join.local_links(sets, 80))
    for token in set.union(*plain):
        own = [i for i, s in enumerate(plain) if token in s]
        found = set()
        for i, j, _ in jaccard_join.skipped_pairs(
            np.array([len(plain[i]) for i in own]),
            np.array([int(np.searchsorted(sets[i], np.uint64(token))) for i in own]),
            np.array(own),
            [jaccard_join.sketch(sets[i]) for i in own],
            80,
            block=3,
        ):
            found |= {frozenset((own[a], own[b])) for a, b in zip(i.tolist(), j.tolist(), strict=True)}
        assert all(frozenset(p) in found for p in links if p[0] in own and p[1] in own)


@pytest.mark.parametrize("seed", range(20))
def test_groups_are_joined_up(seed):
    rng = random.Random(seed)
    k = rng.randint(1, 30)
    groups, links = np.arange(k), []
    for _ in range(rng.randint(1, 5)):
        new = [(rng.randrange(k), rng.randrange(k)) for _ in range(rng.randint(1, 8))]
        links += new
        jaccard_join.joined(groups, *np.array(new).T)
        assert _groups(k, links) == {frozenset(np.flatnonzero(groups == g).tolist()) for g in groups.tolist()}
        assert (groups[groups] == groups).all()


def test_sketches_of_long_sets_fold():
    rng = np.random.default_rng(3)
    tokens = rng.integers(0, 1 << 63, 2_500, dtype=np.uint64)
    long, short = jaccard_join.sketch(tokens), jaccard_join.sketch(tokens[:700])
    assert len(long) == 4 * len(short) and len(jaccard_join.folded(long, len(short))) == len(short)
    apart = np.bitwise_count(jaccard_join.folded(long, len(short)) ^ short).sum()
    assert apart <= 1_800


@pytest.mark.parametrize("seed", range(25))
def test_bin_plan(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 30, 100])
    lengths = [rng.choice([capacity, rng.randint(1, capacity), rng.randint(1, 3)]) for _ in range(rng.randint(1, 400))]
    counts = Counter(lengths)
    plan = packing.BinPlan(counts, capacity)
    used, ranks = {}, {n: set() for n in counts}
    for length, rank, sequences, each, first, offset in plan.steps:
        for k in range(sequences * each):
            assert rank + k not in ranks[length]
            ranks[length].add(rank + k)
            used.setdefault(first + k // each, []).append((offset + k % each * length, length))
    assert {n: set(range(c)) for n, c in counts.items()} == ranks
    assert sorted(used) == list(range(plan.sequences))
    for own in used.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    # Best fit by decreasing length needs at most 11/9 of the optimum plus one.
    large = sum(c for n, c in counts.items() if 2 * n > capacity)
    assert plan.sequences <= max(large, -(-sum(lengths) // capacity)) * 11 / 9 + 1


def test_large_items_pair():
    plan = packing.BinPlan({60: 5, 40: 5, 50: 3, 34: 1}, 100)
    assert plan.sequences == 7


def test_hilbert_neighbours_touch():
    bits = 3
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * 3, indexing="ij"), axis=-1).reshape(-1, 3)
    index = hilbert.hilbert_index(grid, bits)
    assert sorted(index.tolist()) == list(range(len(grid)))
    walk = grid[np.argsort(index)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("seed", range(25))
def test_automaton(seed):
    rng = random.Random(seed)
    letters = "abc"[: rng.randint(1, 3)]

    def text(k):
        return " ".join(rng.choice(letters) for _ in range(k))

    items = [(i, text(rng.randint(0, 25))) for i in range(4)]
    texts = [text(rng.randint(0, 60)) for _ in range(6)]
    window = rng.choice([1, 2, 4, 10])
    automaton = decontaminate.SuffixAutomaton([(str(n), t.encode().split()) for n, t in items], window)
    for t, (_, n_hit, names) in zip(texts, brute.leaks(texts, items, window), strict=True):
        numbers = np.array([automaton.vocabulary.get(w, -1) for w in t.encode().split()], np.int32)
        spans, found = automaton.scan(numbers)
        assert (sum(spans[1::2]) - sum(spans[::2]), sorted(found)) == (n_hit, names)


def test_graph_finds_near_centroids():
    rng = np.random.default_rng(2)
    points = rng.normal(size=(3_000, 16))
    graph = neighbours.CentroidGraph(neighbours.balanced_centroids(points, 15))
    asked = rng.normal(size=(200, 16))
    ids, apart = graph.search(asked, 10)
    true = np.argsort(neighbours._distances(asked, graph.centroids), axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b)) for a, b in zip(ids, true, strict=True)]) >= 9.5
    assert (np.diff(apart, axis=1) >= 0).all()


def test_graph_reaches_every_centroid():
    """Far islands, and wishes of any width: all are found, in the order that a comparison with all gives."""
    rng = np.random.default_rng(3)
    islands = np.concatenate([rng.normal(size=(40, 8)) + 1_000 * k for k in range(8)])
    graph = neighbours.CentroidGraph(islands, degree=6, entries=4)
    asked = np.concatenate([rng.normal(size=(5, 8)), rng.normal(size=(5, 8)) + 3_000])
    true = np.argsort(neighbours._distances(asked, islands), axis=1, kind="stable")
    for wanted in (len(islands), 2 * len(islands)):
        assert np.array_equal(graph.search(asked, wanted, 20)[0], true)
    lists = graph.probes_of(asked, np.ones(len(islands), np.int64), least=250, probes=250, ratio=1.0)
    assert all(len(own) == len(set(own.tolist())) == 250 for own in lists)
    assert np.mean([len(set(own) & set(t[:250])) for own, t in zip(lists, true, strict=True)]) >= 240
    assert graph.probes_of(asked[:0], np.ones(len(islands), np.int64), least=1) == []


@pytest.mark.parametrize("seed", range(12))
def test_cross_parsing(seed):
    """Rates against a parse by plain substring search."""
    rng = random.Random(seed)

    def prose(letters, n):
        return "".join(rng.choice(letters) for _ in range(n))

    samples = {"a": prose("abcde ", 400), "b": prose("cdefgh ", 90), "c": prose("xy", 1 + seed)}
    model = language.LanguageModel.learn({k: [v] for k, v in samples.items()})
    texts = [prose("abcdefghxyzé 1.", rng.choice([0, 1, 5, 255, 256, 257, 700])) for _ in range(8)] + ["", "zz", " a"]
    learned = {k: re.sub("[^a-zé]+", " ", v) for k, v in samples.items()}
    alphabet = set("".join(learned.values())) - {" "}
    wanted = []
    for text in (re.sub("[^a-zé]+", " ", t) for t in texts):
        row = []
        for name in sorted(learned):
            phrases = 0
            for at in range(0, len(text), language.SEGMENT):
                phrases, match = phrases + 1, ""
                for c in text[at : at + language.SEGMENT]:
                    if match + c in learned[name]:
                        match += c
                    else:
                        phrases, match = phrases + 1, c if c in learned[name] else ""
            unknown = sum(c not in learned[name] for c in text)
            bits = phrases * np.log2(max(len(learned[name]), 2)) + unknown * np.log2(len(alphabet) + 2)
            row.append(bits / max(len(text), 1))
        wanted.append(row)
    assert np.allclose(model.rates(texts, language._letter_table()), wanted)


def test_equal_points_make_one_centroid():
    assert len(neighbours.balanced_centroids(np.ones((500, 4)), 10)) == 1


def test_vocabulary_and_rules():
    words = Vocabulary(["bad"], ["soft", "soft-er", "x"])
    assert words.hits("http://bad.com/soft/x") == (1, 2)
    assert words.hits("http://badge.com/softer") == (0, 0)
    assert words.hits("soft soft soft-er") == (0, 2)
    assert Vocabulary([], []).hits("any") == (0, 0)
    rules = Rules([("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block")])
    assert rules.of("a.example.org", "/es/1") == ("example.org/es/", "block")
    assert rules.of("example.org", "/en/12") == ("example.org/en/1", "block")
    assert rules.of("notexample.org", "/es/1") == ("org/", "allow")
    assert rules.of("org", "/") == ("org/", "allow")
    assert rules.of("example.net", "/") is None and rules.of("", "/") is None and rules.of("example.org", "") is None


def test_numbers_of_words():
    """Equal words, lower-cased, have equal numbers wherever they stand; texts of any length and of no words."""
    from trackfuse.llm.words import SpacedNumbers

    numbers = SpacedNumbers()
    long = b"x" * 700_000
    texts = [b"", b" \t\n", b"Ab aB\x0bcd", "é É z".encode(), b"ab " * 300_000, long + b" y", long.upper(), long + b"x z ", b"cd"]
    found = [n.tolist() for n in numbers.of(texts)]
    known = {}
    for text, own in zip(texts, found, strict=True):
        words = text.lower().split()
        assert len(words) == len(own)
        for word, number in zip(words, own, strict=True):
            assert known.setdefault(word, number) == number
    assert len(set(known.values())) == len(known) == 8
    assert [n.tolist() for t in texts for n in numbers.of([t])] == found
