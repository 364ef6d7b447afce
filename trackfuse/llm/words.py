"""Words and numbers of texts, on UTF-8 bytes."""

from __future__ import annotations

import ctypes
import functools
import hashlib
import sys
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text that a step works on at a time.
CHUNK_BYTES = 2_000_000

# ASCII letters (lower-cased), digits and all of a multi-byte character; the rest separates.
_KEEP = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def alnum_words(text: bytes) -> list[bytes]:
    """A-Z lower-cased runs of ASCII letters, digits and non-ASCII characters."""
    return text.translate(_KEEP).split()


def spaced_words(text: bytes) -> list[bytes]:
    """Runs of anything but the six ASCII white-space characters."""
    return text.split()


def utf8(column: pa.Array) -> list[bytes]:
    """The texts as bytes; null as empty."""
    return pc.fill_null(column, "").cast(pa.large_binary()).to_pylist()


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def per_worker(key: Any, make: Callable[[], Any]) -> Any:
    """What ``make`` gave on its first call in this process: Python workers serve many tasks.

    Only the latest key's value is kept: workers also live through the stages that follow, and the tables
    of one stage are of no use to the next.
    """
    kept = vars(sys.modules["pyspark"]).setdefault("_kept_by_trackfuse", {})
    if key not in kept:
        if kept:
            kept.clear()
            _give_back()
        kept[key] = make()
    return kept[key]


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run`` for a task's batches, after which what the allocators hold on to goes back to the system.

    Python workers live on between tasks and stages; without it each keeps the most that any task has taken.
    """

    @functools.wraps(run)
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _give_back()

    return each


def trimmed_group(run: Callable[[pa.Table], pa.Table]) -> Callable:
    """The same for a function of a group, whose working arrays are gone when it returns."""

    @functools.wraps(run)
    def each(table: pa.Table) -> pa.Table:
        try:
            return run(table)
        finally:
            _give_back()

    return each


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's; others need no telling
    if trim is not None:
        trim(0)


def text_of(batch: pa.RecordBatch, text_col: str) -> pa.Array:
    """The texts of a batch that has them as ``_text``, or else in the struct ``row`` under ``text_col``."""
    at = batch.schema.get_field_index("_text")
    if at >= 0:
        return batch.column(at)
    row = batch.column(batch.schema.get_field_index("row"))
    return pc.cast(row.field(text_col), pa.string())


class WordNumbers:
    """64-bit numbers of words, equal in every task; remembers the words of a task up to a limit."""

    def __init__(self, limit: int = 300_000):
        self.known: dict[bytes, int] = {}
        self.limit = limit

    def of(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        try:
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            if len(known) > self.limit:
                known.clear()
            number = xxhash.xxh3_64_intdigest
            for w in set(words).difference(known):
                known[w] = number(w)
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


#: Fixed numbers for the 256 bytes, those of A-Z being those of a-z, and which bytes are ASCII white space.
_BYTE_NUMBERS = np.array(
    [xxhash.xxh3_64_intdigest(bytes([b + 32 if 65 <= b <= 90 else b])) for b in range(256)], np.uint64
)
_SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
#: Bytes that are numbered at once, and the longest word whose number is a polynomial of its bytes.
_NUMBERED_BYTES = 1 << 19
_LONG_WORD = 256


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n, base, np.uint64))))


class SpacedNumbers:
    """64-bit numbers of words, A-Z lower-cased runs of anything but ASCII white space.

    Words are equal if, and but for chance only if, their numbers are. No word is looked up or held: a word's
    number is a polynomial of its bytes, the difference of running sums over the text. To be made once a task.
    """

    def __init__(self):
        self.powers = _powers(_BASE, _NUMBERED_BYTES)
        self.inverse = _powers(pow(_BASE, -1, 1 << 64), _NUMBERED_BYTES)

    def _piece(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Places and numbers of the words of a piece of text."""
        data = np.frombuffer(text, np.uint8)
        space = _SPACE[data]
        edges = np.flatnonzero(np.diff(np.concatenate(([True], space, [True]))))
        begins, ends = edges[::2], edges[1::2]
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE_NUMBERS[data] * self.powers[: len(data)])))
        numbers = (sums[ends] - sums[begins]) * self.inverse[begins] + (ends - begins).astype(np.uint64)
        for i in np.flatnonzero(ends - begins > _LONG_WORD).tolist():
            # Long words can be made to have one polynomial.
            numbers[i] = xxhash.xxh3_64_intdigest(text[begins[i] : ends[i]].lower())
        return begins, mix(numbers)

    def _long(self, text: bytes) -> np.ndarray:
        """The numbers of a text that is too long for one go: it is cut where there is white space."""
        parts, begin = [], 0
        while begin < len(text):
            piece = text[begin : begin + _NUMBERED_BYTES]
            if begin + len(piece) < len(text):
                piece = piece[: len(piece.rstrip(_NOT_SPACE))]
            if piece:
                parts.append(self._piece(piece)[1])
                begin += len(piece)
            else:  # one word that goes on for very long
                word = text[begin:].split(None, 1)[0]
                parts.append(mix(np.array([xxhash.xxh3_64_intdigest(word.lower())], np.uint64)))
                begin += len(word)
        return np.concatenate(parts)

    def of(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """The numbers of each text's words; short texts are worked on together."""
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and size + len(texts[end]) < _NUMBERED_BYTES:
                size += len(texts[end]) + 1
                end += 1
            if end == at:
                yield self._long(texts[at])
                at += 1
                continue
            begins, numbers = self._piece(b" ".join(texts[at:end]))
            starts = np.cumsum([0, *(len(t) + 1 for t in texts[at:end])])
            yield from np.split(numbers, np.searchsorted(begins, starts[1:-1]))
            at = end


_NOT_SPACE = bytes(b for b in range(256) if not (b == 32 or 9 <= b <= 13))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Odd, so that powers of it spread over all 64 bits.
_BASE = 0x9E3779B97F4A7C15


def gram_hashes(x: np.ndarray, n: int) -> np.ndarray:
    """A number for each run of ``n`` symbols, ``len(x) - n + 1`` of them; built by doubling the length.

    ``x`` holds spread 64-bit numbers. The polynomial sum is spread once more at the end.
    """
    have, length, total, done = x, 1, None, 0
    while True:
        if n & length:
            power = np.uint64(pow(_BASE, length, 1 << 64))
            total = have if total is None else total[: max(len(have) - done, 0)] * power + have[done:]
            done += length
        if done == n:
            return mix(total[: max(len(x) - n + 1, 0)])
        if len(have) <= length:
            return np.empty(0, np.uint64)
        have = have[:-length] * np.uint64(pow(_BASE, length, 1 << 64)) + have[length:]
        length *= 2
