"""Removal of repeated byte strings with suffix arrays built by bucket-pointer refinement."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from trackfuse.llm.repeats import Passages, remove_repeats
from trackfuse.llm.words import mix, sha256

WINDOW = 200
GRAM = 48
#: Length of the strings that make the initial buckets.
FIRST_BUCKETS = 8

_SPREAD = mix(np.arange(1, 257, dtype=np.uint64))


def bucket_pointers(text: np.ndarray, depth: int) -> np.ndarray:
    """For each place of ``text`` the bucket of its string of ``depth`` bytes (zeros follow the end).

    Suffixes start in buckets by their first eight bytes, and a place's pointer is its
    bucket's first place in the suffix array. Buckets are refined by sorting on the
    bucket pointers at a later offset, which doubles the depth they stand for; the
    updated pointers are used by the next round. Buckets of one place need no more work.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(depth + FIRST_BUCKETS, text.dtype)]).astype(np.uint64)
    codes = np.zeros(n + depth, np.uint64)
    first = min(FIRST_BUCKETS, depth)
    for k in range(first):
        codes = (codes << np.uint64(8)) | padded[k : k + n + depth]
    array = np.argsort(codes)
    pointer = np.empty(n + depth, np.int64)
    active, groups = _regroup(array, codes[array], np.arange(len(array)), pointer)
    reached = first
    while reached < depth and len(active):
        offset = min(reached, depth - reached)
        inside = active + offset < n + depth
        later = np.where(inside, pointer[np.minimum(active + offset, n + depth - 1)], -1)
        # ``groups`` holds the suffix-array slots of the active places, bucket by bucket.
        # Both pointers in one number sort much faster than as two keys; which of two equal ones comes first is all the same.
        both = pointer[active] * (n + depth + 1) + later + 1
        order = np.argsort(both)
        active, both = active[order], both[order]
        updated = pointer.copy()
        new = np.concatenate(([True], both[1:] != both[:-1]))
        active, groups = _split(active, new, groups, updated)
        pointer = updated
        reached += offset
    return pointer[:n]


def _regroup(places: np.ndarray, codes: np.ndarray, slots: np.ndarray, pointer: np.ndarray):
    new = np.concatenate(([True], codes[1:] != codes[:-1])) if len(codes) else np.empty(0, bool)
    return _split(places, new, slots, pointer)


def _split(places: np.ndarray, new: np.ndarray, slots: np.ndarray, pointer: np.ndarray):
    """Point each place to the first slot of its new bucket; what is left are the buckets of two places or more."""
    if not len(places):
        return places, slots
    at = np.flatnonzero(new)
    sizes = np.diff(np.append(at, len(places)))
    pointer[places] = np.repeat(slots[at], sizes)
    wide = np.repeat(sizes > 1, sizes)
    return places[wide], slots[wide]


def repeated_windows(contexts: list[bytes], window: int) -> list[np.ndarray]:
    """For each context the starts of the windows whose string occurs at another place of any context."""
    sizes = np.array([len(c) for c in contexts], np.int64)
    text = np.frombuffer(b"".join(contexts), np.uint8)
    pointer = bucket_pointers(text, window)
    ends = np.cumsum(sizes)
    whole = np.ones(len(text), bool)
    for e in ends.tolist():
        whole[max(e - window + 1, 0) : e] = False
    starts = np.flatnonzero(whole)
    bucket = pointer[starts]
    repeated = starts[np.bincount(bucket)[bucket] > 1]
    cuts = np.searchsorted(repeated, ends)
    return [part - first for part, first in zip(np.split(repeated, cuts)[:-1], ends - sizes, strict=True)]


def _symbols(text: bytes) -> np.ndarray:
    return _SPREAD[np.frombuffer(text, np.uint8)]


def kept_bytes(text: bytes, spans: np.ndarray) -> bytes:
    edges = [0, *spans.ravel().tolist(), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def passages(window: int = WINDOW, gram: int = GRAM) -> Passages:
    return Passages(
        window=window,
        gram=min(gram, window),
        parse=lambda text: text,
        symbols=_symbols,
        cut=lambda text, begin, end: text[begin:end],
        search=repeated_windows,
    )


def remove_repeated_bytes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, **options
) -> DataFrame:
    """Remove every byte covered by a ``window``-byte string that starts anywhere else too.

    Texts are UTF-8 bytes; matches do not cross rows, may overlap, and are judged on the
    input. Returns per row: id, n_bytes, spans (begin, end, begin, end ...), kept (bytes,
    which may begin or end within a character).

    A null text is empty. Repeated rows count as places of their own, so copies of a text
    of ``window`` bytes or more lose all of it. Other columns are ignored; an empty table
    gives an empty one.
    """

    def finish(parsed, text: bytes, spans: np.ndarray) -> tuple:
        return len(text), spans.ravel(), kept_bytes(text, spans)

    fields = "n_bytes bigint, spans array<bigint>, kept binary"
    return remove_repeats(docs, passages(window), finish, fields, id_col, text_col, **options)


def repeated_bytes_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Like ``remove_repeated_bytes`` with counts and a checksum: n_bytes, n_removed, n_spans, kept_sha256."""

    def finish(parsed, text: bytes, spans: np.ndarray) -> tuple:
        return len(text), int((spans[:, 1] - spans[:, 0]).sum()), len(spans), sha256(kept_bytes(text, spans))

    fields = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return remove_repeats(docs, passages(), finish, fields, id_col, text_col, **options)
