"""Language identification by cross-parsing with suffix automata of labelled text."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackfuse.llm.words import CHUNK_BYTES, per_worker, text_of, trimmed

#: Bounds of the sample that is learned from: characters per language, documents per language, characters in all (each
#: of very many languages gets fewer).
SAMPLE_CHARS = 60_000
SAMPLE_DOCS = 120
SAMPLE_TOTAL = 3_000_000
#: A parse starts afresh after so many characters, so that texts of any length are parsed side by side.
SEGMENT = 256
UNKNOWN = "und"

_SPACE, _OTHER = 0, 1


def _letter_table() -> np.ndarray:
    """For each code point whether it is a letter."""
    points = range(0x110000)
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in points), bool, 0x110000)


def _codes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of all texts, one after the other, and each text's number of them."""
    lowered = [t.lower().encode("utf-32-le", "surrogatepass") for t in texts]
    sizes = np.fromiter((len(t) // 4 for t in lowered), np.int64, len(lowered))
    return np.frombuffer(b"".join(lowered), "<u4"), sizes


def _suffix_automaton(symbols: Sequence[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton of all substrings, for each state; state 0 is the first."""
    moves, length, link, last = [{}], [0], [-1], 0
    for c in symbols:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and c not in moves[at]:
            moves[at][c] = new
            at = link[at]
        if at >= 0:
            known = moves[at][c]
            if length[known] == length[at] + 1:
                link[new] = known
            else:
                copy = len(moves)
                moves.append(dict(moves[known]))
                length.append(length[at] + 1)
                link.append(link[known])
                while at >= 0 and moves[at].get(c) == known:
                    moves[at][c] = copy
                    at = link[at]
                link[known] = link[new] = copy
        last = new
    return moves


_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Table:
    """An automaton's transitions in a hash table, by ``state * width + symbol``; as large as they are many."""

    def __init__(self, moves: list[dict[int, int]], width: int):
        states = np.repeat(np.arange(len(moves)), [len(m) for m in moves])
        symbols = np.fromiter((c for m in moves for c in m), np.int64, len(states))
        to = np.fromiter((t for m in moves for t in m.values()), np.int32, len(states))
        self.width = width
        self.start = np.zeros(width, np.int32)
        self.start[symbols[states == 0]] = to[states == 0]
        bits = max(4, int(2 * len(states)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.to = np.zeros(1 << bits, np.int32)
        keys = states * width + symbols
        at, left = self._slots(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[at[left]] < 0]
            put = free[np.unique(at[free], return_index=True)[1]]
            self.keys[at[put]], self.to[at[put]] = keys[put], to[put]
            left = left[self.keys[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & (len(self.keys) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _SPREAD) >> self.shift).view(np.int64)

    def next(self, states: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next states, and where a symbol does not go on and begins a new phrase."""
        keys = states * self.width + symbols
        at = self._slots(keys)
        found = self.keys[at]
        fresh = found != keys
        to = self.to[at]
        open_ = np.flatnonzero(fresh & (found >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.keys) - 1)
            found = self.keys[at[open_]]
            hit = open_[found == keys[open_]]
            fresh[hit], to[hit] = False, self.to[at[hit]]
            open_ = open_[(found >= 0) & (found != keys[open_])]
        return np.where(fresh, self.start[symbols], to), fresh


@dataclass
class LanguageModel:
    """A parsing table per language; the alphabet has every letter of all learned texts, whatever their scripts.

    ``tables[l]`` has the transitions that occur only, so it does not grow with the
    alphabet. ``sizes[l]`` is the length of the learned text.
    """

    names: list[str]
    alphabet: np.ndarray
    tables: list[Table]
    sizes: list[int]

    @staticmethod
    def learn(samples: dict[str, list[str]], chars: int = SAMPLE_CHARS) -> LanguageModel:
        names = sorted(samples)
        letters = _letter_table()
        codes = {n: _codes(samples[n])[0] for n in names}
        cut = {n: _squeeze(np.where(letters[c], c.astype(np.int64), -1), -1)[0][:chars] for n, c in codes.items()}
        every = np.unique(np.concatenate([*cut.values(), np.empty(0, np.int64)]))
        alphabet = every[every >= 0]
        tables, sizes = [], []
        for name in names:
            symbols = _symbols(cut[name], alphabet, letters)
            tables.append(Table(_suffix_automaton(symbols.tolist()), len(alphabet) + 2))
            sizes.append(max(len(symbols), 2))
        return LanguageModel(names, alphabet, tables, sizes)

    def rates(self, texts: Sequence[str], letters: np.ndarray) -> np.ndarray:
        """Bits per symbol: a phrase's name a place in the learned text, an unknown letter's also one in the alphabet.

        A phrase is the longest match from where the last one ended; the text is parsed in segments of ``SEGMENT``
        symbols. A symbol that the learned text lacks is one phrase together with the match after it.

        A row per text. Without the latter a language of little text would be cheap for any text.
        """
        return self._rates(*_codes(texts), letters)

    def _rates(self, codes: np.ndarray, sizes: np.ndarray, letters: np.ndarray) -> np.ndarray:
        n_texts, ends = len(sizes), np.concatenate(([0], np.cumsum(sizes)))
        # A text's first space is its own, whatever text goes before it.
        starts = ends[:-1][sizes > 0]
        symbols, kept = _squeeze(_symbols(codes, self.alphabet, letters), starts=starts)
        bounds = np.searchsorted(kept, ends)  # the texts' places among what is left
        del kept
        lengths = np.diff(bounds)
        n_segments = -(-lengths // SEGMENT)
        owner = np.repeat(np.arange(n_texts), n_segments)
        first = np.concatenate(([0], np.cumsum(n_segments)))[:-1]
        begin = bounds[owner] + (np.arange(len(owner)) - first[owner]) * SEGMENT
        size = np.minimum(bounds[owner + 1] - begin, SEGMENT)
        out = np.zeros((n_texts, len(self.names)))
        order = np.argsort(-size, kind="stable")
        begin, size, owner = begin[order], size[order], owner[order]
        alive = len(size) - np.searchsorted(size[::-1], np.arange(SEGMENT), side="right")
        for i, (table, learned) in enumerate(zip(self.tables, self.sizes, strict=True)):
            state, phrases = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for step in range(int(size[0]) if len(size) else 0):
                n = alive[step]
                state[:n], fresh = table.next(state[:n], symbols[begin[:n] + step])
                phrases[:n] += fresh
            at = np.searchsorted(bounds, np.flatnonzero(table.start[symbols] == 0), side="right") - 1
            unknown = np.bincount(at, minlength=n_texts)
            total = np.bincount(owner, phrases + 1, n_texts) * np.log2(learned) + unknown * np.log2(table.width)
            out[:, i] = total / np.maximum(lengths, 1)
        return out

    def predict(self, texts: Sequence[str], letters: np.ndarray) -> tuple[list[str], list[float]]:
        """The language of the lowest rate (ties: first by name) and how far it lies below the next one, 0 to 1."""
        if not self.names:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        codes, sizes = _codes(texts)
        has_letter, some = np.zeros(len(texts), bool), sizes > 0
        if len(codes):
            has_letter[some] = np.logical_or.reduceat(letters[codes], (np.cumsum(sizes) - sizes)[some])
        rates = self._rates(codes, sizes, letters)
        best = rates.argmin(axis=1)
        ordered = np.sort(rates, axis=1)
        second = ordered[:, 1] if len(self.names) > 1 else ordered[:, 0] * 2
        score = np.where(second > 0, 1 - ordered[:, 0] / np.maximum(second, 1e-12), 0.0).clip(0, 1)
        return (
            [self.names[b] if ok else UNKNOWN for b, ok in zip(best, has_letter, strict=True)],
            np.where(has_letter, score, 0.0).tolist(),
        )


def _symbols(codes: np.ndarray, alphabet: np.ndarray, letters: np.ndarray) -> np.ndarray:
    every = np.where(letters, _OTHER, _SPACE).astype(np.int32)
    every[alphabet] = np.arange(2, len(alphabet) + 2)
    return every[codes]


def _squeeze(symbols: np.ndarray, blank: int = _SPACE, starts: Sequence[int] = ()) -> tuple[np.ndarray, np.ndarray]:
    """One space for each run of what is no letter; also the places kept. Runs end at ``starts``."""
    space = symbols == blank
    goes_on = np.concatenate(([False], space[:-1]))[: len(space)]
    goes_on[np.asarray(starts, np.int64)] = False
    keep = np.flatnonzero(~(space & goes_on))
    return symbols[keep], keep


def held_out(id_col: str) -> Column:
    """Rows that are not learned from: a quarter of the ids, by checksum."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def learn_languages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_docs: int = SAMPLE_DOCS,
    sample_chars: int = SAMPLE_CHARS,
) -> LanguageModel:
    """Learn from a sample of the labelled rows that are not held out.

    The sample is bounded: about ``sample_docs`` different texts per label, drawn by hash,
    of which ``sample_chars`` characters are learned in hash order; fewer where
    ``SAMPLE_TOTAL`` does not suffice for all labels, but every label is learned. Of a long
    text its beginning is taken: all that may be learned where a label has two texts or
    one, down to an eighth of it where it has many. Copies count once.
    """
    usable = docs.select(F.col(text_col).cast("string").alias("_text"), F.col(lang_col).alias("_lang")).filter(
        ~held_out(id_col) & F.col("_lang").isNotNull() & F.col("_text").isNotNull()
    )
    different = F.approx_count_distinct(F.xxhash64("_text"), 0.02).alias("n")
    counts = usable.groupBy("_lang").agg(different).collect()  # one row per label
    if not counts:
        return LanguageModel([], np.empty(0, np.int64), [], [])
    chars = max(1, min(sample_chars, SAMPLE_TOTAL // len(counts)))
    # Small languages come whole; the draw of large ones is widened so as not to fall short.
    shares = [
        (r["_lang"], min(1.0, 1.3 * sample_docs / max(r["n"], 1)), max(chars // 8, min(chars, 2 * chars // max(r["n"], 1)), 1))
        for r in counts
    ]
    # From Arrow: a list of rows would go through Python workers of another kind, which stay beside those of the stages.
    shares = docs.sparkSession.createDataFrame(
        pa.table({name: list(values) for name, values in zip(("_lang", "share", "piece"), zip(*shares, strict=True), strict=True)}),
        T.StructType([usable.schema["_lang"]]).add("share", "double").add("piece", "integer"),
    )
    draw = F.pmod(F.xxhash64(F.lit("draw"), "_text"), F.lit(1 << 30)) / (1 << 30)
    drawn = usable.withColumn("draw", draw).join(F.broadcast(shares), "_lang").filter("draw < share")
    drawn = drawn.select("_lang", "draw", F.expr("substring(_text, 1, piece)").alias("_text")).distinct()
    samples: dict[str, list[str]] = {}
    for row in sorted(drawn.collect()):
        samples.setdefault(row["_lang"], []).append(row["_text"] + " ")
    return LanguageModel.learn(samples, chars)


def identify_languages(
    docs: DataFrame,
    model: LanguageModel,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Per row: id, lang_pred, score (0 to 1: how far the winner's rate lies below the next one's).

    Each whole text is cut into the longest phrases that occur in a language's learned
    text (letters only, anything else counts as one space), for every language; the one
    that needs the fewest bits of phrases per character wins. Parsing starts afresh each
    ``SEGMENT`` characters, for all segments of a batch at once.

    The columns of ``carry`` come along as they are, in a struct ``row``.

    Null texts and texts without a letter are ``und`` with score 0. Rows are judged one by
    one, so repeated rows stay; other columns are ignored; an empty table gives an empty one.
    """
    # Plain values only: executors need not be able to import this module.
    plain = vars(model) | {"tables": [vars(t) for t in model.tables]}
    shared = docs.sparkSession.sparkContext.broadcast(plain)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, model = per_worker("letters", _letter_table), LanguageModel(**shared.value)
        model.tables = [object.__new__(Table) for _ in model.tables]
        for table, values in zip(model.tables, shared.value["tables"], strict=True):
            table.__dict__.update(values)
        for batch in batches:
            texts = pc.fill_null(text_of(batch, text_col), "")
            lengths = pc.utf8_length(texts).to_pylist()
            names, scores, at = [], [], 0
            while at < len(texts):
                end, size = at + 1, lengths[at]
                while end < len(texts) and size + lengths[end] <= CHUNK_BYTES // 2:
                    size += lengths[end]
                    end += 1
                n, s = model.predict(texts[at:end].to_pylist(), letters)
                names += n
                scores += s
                at = end
            kept = [batch.column(batch.schema.get_field_index(c)) for c in carried]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), *kept],
                names=[id_col, "lang_pred", "score", *carried],
            )

    carried = ["row"] if carry else []
    # A text that is carried is not sent a second time.
    text = [] if text_col in carry else [F.col(text_col).cast("string").alias("_text")]
    rows = docs.select(F.col(id_col), *text, *([F.struct(*carry).alias("row")] if carry else []))
    shape = T.StructType([rows.schema[0]]).add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(trimmed(judge), T.StructType([*shape, *(rows.schema[c] for c in carried)]))
