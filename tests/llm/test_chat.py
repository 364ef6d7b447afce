"""Chat formatting: what comes back is what went in, windows hold their budget, each target counts once."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trackfuse.llm import chat

PATH = public_tokenizers.path("word_bpe_49k.json")
DIGESTS = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
MARKS = ["<|im_start|>", "<|im_end|>", "\n", "<", "\\", "|", "assistant", "ok ", "<\\|x", "é", "日本", "don't ", " "]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def turns_of(rows):
    own = defaultdict(list)
    for conv, *turn in rows:
        own[conv].append(turn)
    for conv, turns in own.items():
        turns = sorted(turns, key=lambda t: [(v is not None, v or 0) for v in t[:1]] + [(v is not None, v or "") for v in t[1:]])
        yield conv, [(role or "", text or "") for _, role, text in turns]


def brute(rows):
    for conv, turns in turns_of(rows):
        loss = "".join(text for role, text in turns if role == "assistant")
        yield conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss)


def rows_of(seed=3):
    rng = random.Random(seed)

    def odd():
        return "".join(rng.choice(MARKS) for _ in range(rng.randrange(12)))

    roles = ["user", "assistant", "system", None, "a\nb<|", "\\n"]
    rows = [
        (conv, rng.choice([None, *range(30)]), rng.choice(roles), rng.choice([None, odd(), odd(), odd() * 20]))
        for conv, n in ((1, 60), (2, 3), (None, 23), (3, 1))
        for _ in range(n)
    ]
    rows += [(5, 0, "system", "be nice <|im_end|>")]
    rows += [(5, i, ("assistant", "user")[i % 2], f"turn {i} " * (i % 7)) for i in range(1, 90)]
    rows += [(6, 0, "system", "x"), (7, 0, "assistant", "w " * 900), (7, 1, "user", "y"), rows[0], (8, 0, "user", "é" * 70_000)]
    return rows


@pytest.fixture(scope="module")
def conversations(spark):
    df = spark.createDataFrame(rows_of(), "conv_id bigint, turn bigint, role string, text string").repartition(5)
    return df.withColumns({c: F.lit("x") for c in ("conv", "segment", "window", "kind", "place", "loss", "idx")})


@pytest.mark.parametrize(("segment", "budget"), [(1024, 1024), (10, 60), (3, 40), (1, 30)])
def test_windows(conversations, segment, budget):
    history = budget // 3
    windows = chat.format_chats(conversations, PATH, segment=segment, budget=budget, history=history, history_turns=4)
    got = chat.read_back(windows)
    assert Counter(tuple(r) for r in got.select(*DIGESTS).collect()) == Counter(brute(rows_of()))
    tokenizer = Tokenizer.from_file(PATH)
    systems = {c: t[0] for c, t in turns_of(rows_of()) if t[0][0] == "system"}
    chars = Counter()
    for w in windows.collect():
        shown = chat.parse_turns(w.text)
        chars[w.conv_id] += len(w.text)
        assert len(shown) == w.n_turns
        assert w.over_budget == (w.n_tokens > budget)
        first = w.conv_id in systems and (w.segment, w.window) == (0, 0)
        assert not w.over_budget or w.n_turns - w.n_repeated == 1 + first
        assert w.n_repeated <= 4 + 1
        if w.conv_id in systems:
            assert shown[0] == systems[w.conv_id]
        formatted = [chat.format_turn(r, t)[0] for r, t in shown]
        assert w.text == "".join(formatted)
        assert w.n_tokens == sum(len(e.ids) for e in tokenizer.encode_batch(formatted, add_special_tokens=False))
    assert {r.conv_id: r.formatted_chars for r in got.collect()} == chars


def test_no_conversations(conversations):
    assert chat.read_back(chat.format_chats(conversations.limit(0), PATH)).count() == 0


@given(st.lists(st.sampled_from(MARKS)).map("".join), st.lists(st.sampled_from(MARKS)).map("".join))
def test_escapes_come_back(role, text):
    made, begin, end = chat.format_turn(role, text)
    assert chat.parse_turns(made * 2) == [(role, text)] * 2
    assert chat.unescape(made[begin:end]) == text
    assert "<|" not in made[begin:end]


@given(st.lists(st.integers(0, 50), max_size=30), st.integers(0, 40), st.integers(1, 80), st.integers(0, 40))
def test_cuts(tokens, system, budget, history):
    cuts = chat.cut_windows(np.array(tokens, np.int64), 0, system, budget, history, 3)
    assert [i for _, at, end in cuts for i in range(at, end)] == list(range(len(tokens)))
    for begin, at, end in cuts:
        assert sum(tokens[begin:at]) <= history
        assert 0 <= at - begin <= 3
        assert system + sum(tokens[begin:end]) <= budget or end - at == 1
