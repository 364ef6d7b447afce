"""Removal of repeated word sequences with compressed FM-indexes per shard."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from trackfuse.llm.repeats import Passages, remove_repeats
from trackfuse.llm.words import WordNumbers, per_worker, sha256, spaced_words

WINDOW = 35
GRAM = 5
#: Length, a power of two, of the suffixes whose intervals are looked up; the backward search goes on from there.
JUMP = 8


class WaveletTree:
    """Rank queries on a sequence of small numbers, in one bit per number and level plus a sixteenth for counts.

    The levels stand one below the other as in a wavelet matrix: each sorts the sequence
    stably by its bit.
    """

    def __init__(self, values: np.ndarray, n_symbols: int):
        self.levels = max(1, int(n_symbols - 1).bit_length())
        self.size = len(values)
        self.words, self.counts, self.zeros = [], [], []
        for level in range(self.levels - 1, -1, -1):
            bits = (values >> level) & 1
            padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
            padded[: len(bits)] = bits
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            ones = np.bitwise_count(words).astype(np.int64)
            self.words.append(words)
            self.counts.append(np.concatenate(([0], np.cumsum(ones)[:-1])).astype(np.int32))
            self.zeros.append(int(len(bits) - bits.sum()))
            values = np.concatenate([values[bits == 0], values[bits == 1]])

    def rank(self, symbols: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each symbol how often it occurs before ``begin`` and before ``end``, less where its block starts."""
        for i, level in enumerate(range(self.levels - 1, -1, -1)):
            one = ((symbols >> level) & 1).astype(bool)
            b, e = self._ones(i, begin), self._ones(i, end)
            begin = np.where(one, self.zeros[i] + b, begin - b)
            end = np.where(one, self.zeros[i] + e, end - e)
        return begin, end

    def _ones(self, i: int, place: np.ndarray) -> np.ndarray:
        block = place >> 6
        below = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
        return self.counts[i][block] + np.bitwise_count(self.words[i][block] & below).astype(np.int64)


class FMIndex:
    """Backward search over a sequence, for patterns up to ``depth`` symbols.

    Suffixes are sorted by their first ``depth`` symbols, which is all that such patterns
    can tell. ``low`` and ``high`` hold, for each place, the interval of suffixes that
    share its first ``jump`` symbols.
    """

    def __init__(self, sequence: np.ndarray, depth: int):
        self.sequence = sequence
        n = len(sequence)
        ranks, reached = np.unique(sequence, return_inverse=True)[1].astype(np.int64), 1
        self.jump = min(JUMP, 1 << (depth.bit_length() - 1))
        self.low = self.high = None
        while True:
            if reached == self.jump:
                self.low, self.high = self._intervals(ranks)
            if reached >= depth or (n and ranks.max() == n - 1):
                break
            later = np.concatenate([ranks[reached:] + 1, np.zeros(min(reached, n), np.int64)])
            ranks = np.unique(ranks * (n + 1) + later, return_inverse=True)[1].astype(np.int64)
            reached *= 2
        if self.low is None:
            self.low, self.high = self._intervals(ranks)
        array = np.argsort(ranks, kind="stable")
        self.n_symbols = int(sequence.max()) + 1 if n else 1
        # The sequence begins with a separator, so the symbol before the first one does not matter.
        self.tree = WaveletTree(sequence[array - 1], self.n_symbols)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(sequence, minlength=self.n_symbols))))
        # Where the tree's last level keeps a symbol's block.
        blocks = np.arange(self.n_symbols)
        zero = np.zeros(self.n_symbols, np.int64)
        self.block = self.tree.rank(blocks, zero, zero)[0]

    @staticmethod
    def _intervals(ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts = np.bincount(ranks)
        ends = np.cumsum(counts)
        return (ends - counts)[ranks], ends[ranks]

    def extend(self, symbols: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the patterns with one symbol more in front."""
        b, e = self.tree.rank(symbols, begin, end)
        offset = self.before[symbols] - self.block[symbols]
        return b + offset, e + offset

    def matching_statistics(self, ends: np.ndarray, room: np.ndarray, most: int) -> np.ndarray:
        """For each place of ``ends`` the longest match that ends before it and occurs twice in the index.

        Matches reach back by ``room`` symbols and by ``most`` at the utmost. All places are streamed
        backwards side by side and leave once their interval holds a single suffix.
        """
        jump = self.jump
        matched = np.zeros(len(ends), np.int64)
        at = np.flatnonzero(room >= jump)
        start = ends[at] - jump
        begin, end = self.low[start], self.high[start]
        more = end - begin >= 2
        at, begin, end = at[more], begin[more], end[more]
        matched[at] = jump
        for length in range(jump + 1, most + 1):
            wide = room[at] >= length
            at, begin, end = at[wide], begin[wide], end[wide]
            if not len(at):
                break
            begin, end = self.extend(self.sequence[ends[at] - length], begin, end)
            more = end - begin >= 2
            at, begin, end = at[more], begin[more], end[more]
            matched[at] = length
        return matched


def repeated_windows(contexts: list[bytes], window: int) -> list[np.ndarray]:
    """For each context the starts of the windows that occur at another place of any context of the shard."""
    numbers: dict[bytes, int] = {}
    number = numbers.setdefault
    lists = [[number(w, len(numbers) + 1) for w in c.split()] for c in contexts]
    # A separator before each context, and one at the very end.
    sequence = np.fromiter((w for own in lists for w in (0, *own)), np.int64)
    sizes = np.array([len(own) for own in lists], np.int64)
    firsts = np.cumsum(sizes + 1) - sizes
    index = FMIndex(np.append(sequence, 0), window)
    owner = np.repeat(np.arange(len(sizes)), np.maximum(sizes - window + 1, 0))
    offset = np.arange(len(owner)) - np.repeat(
        np.cumsum(np.maximum(sizes - window + 1, 0)) - np.maximum(sizes - window + 1, 0),
        np.maximum(sizes - window + 1, 0),
    )
    ends = firsts[owner] + offset + window
    matched = index.matching_statistics(ends, offset + window, window)
    hit = matched >= window
    cuts = np.searchsorted(owner[hit], np.arange(1, len(sizes)))
    return np.split(offset[hit], cuts) if len(sizes) else []


def _symbols(words: list[bytes]) -> np.ndarray:
    return per_worker("numbers", WordNumbers).of(words)


def passages(window: int = WINDOW, gram: int = GRAM) -> Passages:
    return Passages(
        window=window,
        gram=min(gram, window),
        parse=spaced_words,
        symbols=_symbols,
        cut=lambda words, begin, end: b" ".join(words[begin:end]),
        search=repeated_windows,
    )


def kept_words(words: list[bytes], spans: np.ndarray) -> bytes:
    edges = [0, *spans.ravel().tolist(), len(words)]
    return b" ".join(w for a, b in zip(edges[::2], edges[1::2], strict=True) for w in words[a:b])


def remove_repeated_words(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, **options
) -> DataFrame:
    """Remove every word covered by a sequence of ``window`` words that starts anywhere else too.

    Words are runs of anything but ASCII white space; matches stay within a row, may
    overlap, and are judged on the input. Returns per row: id, n_words, spans (word numbers:
    begin, end, begin, end ...), kept (the other words joined by one space).

    A null text has no words. Repeated rows count as places of their own, so copies of a
    text of ``window`` words or more lose all of it. Other columns are ignored; an empty
    table gives an empty one.
    """

    def finish(words: list[bytes], text: bytes, spans: np.ndarray) -> tuple:
        return len(words), spans.ravel(), kept_words(words, spans).decode()

    fields = "n_words bigint, spans array<bigint>, kept string"
    return remove_repeats(docs, passages(window), finish, fields, id_col, text_col, **options)


def repeated_words_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Like ``remove_repeated_words`` with counts and a checksum: n_words, n_removed, kept_sha256."""

    def finish(words: list[bytes], text: bytes, spans: np.ndarray) -> tuple:
        return len(words), int((spans[:, 1] - spans[:, 0]).sum()), sha256(kept_words(words, spans))

    fields = "n_words bigint, n_removed bigint, kept_sha256 string"
    return remove_repeats(docs, passages(), finish, fields, id_col, text_col, **options)
