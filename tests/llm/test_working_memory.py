"""What a task works on at a time, and what its process keeps afterwards."""

import tracemalloc

import pyarrow as pa
import pytest

from trackfuse.llm import jaccard_join, language, repeats, suffix_dedup, words


def test_short_texts_are_worked_on_in_small_groups():
    kind = suffix_dedup.passages()
    texts = [bytes([97 + i]) * 60_000 for i in range(20)] + [b"z" * (repeats.GROUP_SYMBOLS + 5)]
    groups = list(repeats._parts(texts, kind))
    assert [k for group in groups for k, _, _ in group] == list(range(21))
    assert [sum(len(part) for _, _, part in group) for group in groups] == [*[240_000] * 5, repeats.GROUP_SYMBOLS + 5]


def test_memory_goes_back_after_each_group(monkeypatch):
    given = []
    monkeypatch.setattr(words, "_give_back", lambda: given.append(1))
    table = pa.table({"a": [1]})
    assert words.trimmed_group(lambda group: group)(table) is table
    with pytest.raises(ZeroDivisionError):
        words.trimmed_group(lambda group: 1 / 0)(table)
    assert len(given) == 2


def test_compared_groups_give_memory_back(spark, monkeypatch):
    wrapped = []

    def record(run):
        wrapped.append(run)
        return run

    monkeypatch.setattr(jaccard_join, "trimmed_group", record)
    jaccard_join._compare_lists(spark.createDataFrame([], "list bigint, node bigint, packed binary"), 1, 5, 80)
    shape = "cell bigint, node bigint, root bigint, np bigint, sketch binary, met array<bigint>, shard bigint"
    jaccard_join._clusters(spark.createDataFrame([], shape), 1, 80)
    assert len(wrapped) == 2


def test_a_text_needs_few_bytes_a_character_to_be_judged():
    learned = {"a": ["the cat sat on the mat " * 40], "b": ["der hund lief im wald " * 40]}
    model, letters = language.LanguageModel.learn(learned), language._letter_table()
    texts = ["the cat ran in the wood and sat on a mat " * 500] * 20
    tracemalloc.start()
    try:
        names, _ = model.predict(texts, letters)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert names == ["a"] * 20
    assert peak < 45 * sum(map(len, texts))


def test_languages_are_learned_without_python_workers_of_another_kind(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "the cat sat", "a"), (3, "der hund lief", "b")], "doc_id bigint, text string, lang string")

    def refused(*_):
        raise AssertionError("rows that are sent through Python workers")

    monkeypatch.setattr(type(spark), "_createFromLocal", refused)
    assert language.learn_languages(docs).names == ["a", "b"]


def test_what_a_worker_kept_goes_back_when_another_stage_begins(monkeypatch):
    given = []
    monkeypatch.setattr(words, "_give_back", lambda: given.append(1))
    assert [words.per_worker(k, lambda: 5) for k in ("one", "one", "two")] == [5, 5, 5]
    before = len(given)
    words.per_worker("three", lambda: 6)
    assert len(given) == before + 1
