"""Pieces of a tokenizer found once per distinct pre-token."""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Callable, Sequence

import numpy as np

from trackfuse.llm.words import per_worker

#: The splitting rule of the word tokenizer files, for which a quick equivalent is at hand below.
_WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# The same for lower-cased text of the characters that _ODD does not find.
_LETTERS = "a-zªµºß-öø-ÿ"
_DIGITS = "0-9²³¹¼-¾"
_QUICK = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^\\s{_DIGITS}{_LETTERS}]+")
_ODD = re.compile(r"[^\t\n\r\x20-\x7e\xa1-\xac\xae-\xff]")
#: Bytes of words and ids that a worker remembers from the latest use on; as many from before may be there besides.
MEMO_BYTES = 48_000_000
#: What a remembered word takes besides its letters and ids.
_ENTRY = 160
#: Pre-tokens whose pieces a worker has at hand while it encodes words.
PRE_TOKENS = 100_000
# Byte-level models write a byte as the letter of its number, or as one from 256 on where that is no visible letter.
_VISIBLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_LETTERS = {b: chr(b) for b in _VISIBLE} | {
    b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - _VISIBLE))
}


class _Memo(dict):
    """Words to ids. A word that is not there is taken over from the older memo, or else encoded."""

    def __init__(self, encode: Callable[[str | bytes], bytes], older: dict[str | bytes, bytes]):
        super().__init__()
        self.encode, self.older, self.held = encode, older, 0

    def __missing__(self, word: str | bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.encode(word)
        self[word] = ids
        self.held += len(word) + len(ids) + _ENTRY
        return ids


class PieceTable:
    """The ids of each distinct pre-token, as little-endian unsigned 32-bit numbers, found once and remembered.

    Pre-tokens are cut by a quick pattern where the text has only characters for which
    it agrees with the tokenizer's own rule, and by the tokenizer's own normaliser and rule
    (``own_split``) where it has others. So ids are always the tokenizer's. The memo's keys are
    pre-tokens or whole words, or bytes where the tokenizer has cut them.
    """

    def __init__(self, path: str, memo_bytes: int = MEMO_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already take all cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = spec.get("added_tokens") or ()
        self.added = [t["content"] for t in added]
        self._ids = {t["content"].encode(): t["id"] for t in added}
        #: Cuts a raw text at added tokens, the longest first, where these are looked for in raw texts as they are.
        longest = sorted(self.added, key=len, reverse=True)
        self._cut = re.compile(f"({'|'.join(map(re.escape, longest)) or '(?!)'})")
        self._exact = not any(t[k] for t in added for k in ("normalized", "lstrip", "rstrip", "single_word"))
        self.quick = self._is_word_kind(spec)
        self.memo, self._limit = _Memo(self._word, {}), memo_bytes
        self._pieces: dict[str, list[int]] = {}
        self._tokenize = self.tokenizer.model.tokenize

    @staticmethod
    def _is_word_kind(spec: dict) -> bool:
        parts = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        norms = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers") or ()]
        split = (parts[0].get("pattern") or {}).get("Regex") if parts[0].get("type") == "Split" else None
        return split == _WORD_SPLIT and norms == ["NFC", "Replace", "Lowercase"] and len(parts) == 2

    @classmethod
    def of(cls, path: str, use: str) -> PieceTable:
        """This worker's table for that file; ``use`` says what is looked up in it."""
        return per_worker(("pieces", path, use), lambda: cls(path))

    def _plain(self, text: str) -> bool:
        return self.quick and not _ODD.search(text) and not any(a in text for a in self.added)

    def words(self, text: str) -> list[str] | None:
        """What stands between white space, or None if only the tokenizer itself can tell.

        No pre-token goes over white space, so these can be encoded one by one as well.
        """
        return text.lower().split() if self._plain(text) else None

    def split(self, text: str) -> list[str] | None:
        """The text's pre-tokens, or None if only the tokenizer itself can tell."""
        return _QUICK.findall(text.lower()) if self._plain(text) else None

    def own_split(self, text: str) -> list[bytes] | None:
        """The pre-tokens as the tokenizer cuts them, in the letters that its model reads, and the added tokens.

        None if that cannot be had apart from the whole: without a rule to cut by, or where what is
        cut at an added token may not be cut again by itself.
        """
        rule, normalizer = self.tokenizer.pre_tokenizer, self.tokenizer.normalizer
        parts, found = self._cut.split(text), []
        if rule is None or len(parts) > 1 and not (self._exact and self.quick):
            return None
        for i, part in enumerate(parts):
            if i % 2:
                found.append(part.encode())
                continue
            plain = normalizer.normalize_str(part) if normalizer else part
            if not self._exact and self._cut.search(plain):
                return None
            found += [token.encode() for token, _ in rule.pre_tokenize_str(plain)]
        return found

    def _encode(self, texts: Sequence[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _word(self, word: str | bytes) -> bytes:
        """The ids of a word, from the model alone: a call of the whole tokenizer costs more than a word."""
        if isinstance(word, bytes):
            own = self._ids.get(word)
            ids = [p.id for p in self._tokenize(word.decode())] if own is None else [own]
            return struct.pack(f"<{len(ids)}I", *ids)
        known, tokenize, ids = self._pieces, self._tokenize, []
        for token in _QUICK.findall(word):
            own = known.get(token)
            if own is None:
                if len(known) >= PRE_TOKENS:
                    known.clear()
                letters = token if token.isascii() else "".join(map(_BYTE_LETTERS.__getitem__, token.encode()))
                own = known[token] = [p.id for p in tokenize(letters)]
            ids += own
        return struct.pack(f"<{len(ids)}I", *ids)

    def renew(self) -> _Memo:
        """The memo, to look words up in; to be asked for anew for each part of the texts.

        A full memo becomes the older one, from which what is used again is taken over. So frequent
        words stay known, and what goes is what has not been used since the last change.
        """
        if self.memo.held > self._limit:
            older, self.memo.older = self.memo, {}
            self.memo = _Memo(self._word, older)
        return self.memo

    def whole(self, text: str) -> bytes:
        """The ids of a text that goes through the tokenizer as it is."""
        return self._encode([text])[0]
