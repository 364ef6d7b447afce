"""URL filter: path rules first, then a weighted vocabulary found by Aho-Corasick."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Parameters, to be replaced by the caller's own lists. One strict term rejects a url.
STRICT_TERMS = ("porn", "porno", "xxx", "xvideos", "hentai", "camgirls", "pornhub", "redtube")
#: Several distinct soft terms reject it together.
SOFT_TERMS = (
    "adult", "bet", "bingo", "casino", "dating", "escort", "gamble", "hot", "jackpot", "nude", "poker", "sex",
    "sexy", "slots", "warez", "webcam",
)
MIN_SOFT = 2
#: Of the terms and rules, which every task holds.
MAX_ENTRIES = 1_000_000

ALLOW, BLOCK = "allow", "block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWERED = str.maketrans(_UPPER, _LOWER)
_WORD = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"^(?s).*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"^(?s).*?://[^/?#]*([^?#]*)", 1), F.lit(""))


class Vocabulary:
    """Strict and soft terms in one automaton.

    A term counts where neither neighbour is an ASCII letter or digit, so ``bet`` is not
    found in ``alphabet``.
    """

    def __init__(self, strict: Sequence[str], soft: Sequence[str]):
        import ahocorasick

        self.found = ahocorasick.Automaton()
        for kind, terms in (("soft", soft), ("strict", strict)):
            for term in (t.translate(_LOWERED) for t in terms):
                self.found.add_word(term, (kind, term))
        self.empty = not len(self.found)
        if not self.empty:
            self.found.make_automaton()

    def hits(self, text: str) -> tuple[int, int]:
        """The numbers of strict hits and of distinct soft terms in a lower-cased text."""
        strict, soft = 0, set()
        if self.empty:
            return 0, 0
        for end, (kind, term) in self.found.iter(text):
            begin = end - len(term)
            if (begin >= 0 and text[begin] in _WORD) or (end + 1 < len(text) and text[end + 1] in _WORD):
                continue
            if kind == "strict":
                strict += 1
            else:
                soft.add(term)
        return strict, len(soft)


class Rules:
    """``(host, path, verdict)`` looked up by each parent domain of a host; the longest rule wins."""

    def __init__(self, rules: Sequence[tuple[str, str, str]]):
        self.by_host: dict[str, list[tuple[str, str]]] = {}
        for host, path, verdict in rules:
            self.by_host.setdefault(host, []).append((path, verdict))
        for paths in self.by_host.values():
            paths.sort(key=lambda p: -len(p[0]))

    def of(self, host: str, path: str) -> tuple[str, str] | None:
        best = None
        while host:
            for start, verdict in self.by_host.get(host, ()):
                if path.startswith(start):
                    if best is None or len(host) + len(start) > len(best[0]):
                        best = (host + start, verdict)
                    break
            host = host.partition(".")[2]
        return best


def url_filter(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: Sequence[tuple[str, str, str]] = (),
    strict: Sequence[str] = STRICT_TERMS,
    soft: Sequence[str] = SOFT_TERMS,
    min_soft: int = MIN_SOFT,
) -> DataFrame:
    """A verdict on each url: id, host, path, rule, verdict, strict_hits, soft_terms.

    ``rules`` are ``(host, path, "allow" | "block")``; a rule fits its host and all
    subdomains where the url's path begins with the rule's, and the longest one decides.
    Urls without a rule are rejected on one strict hit or ``min_soft`` distinct soft
    terms, looked for in the whole url, A-Z lower-cased.

    Rows are judged one by one: repeated rows each get their verdict, extra columns are
    ignored, an empty table gives an empty one. A null url, and one without ``://``, has
    an empty host and path and no rule; a null url is allowed. Terms are A-Z lower-cased, too.
    """
    if len(strict) + len(soft) + len(rules) > MAX_ENTRIES:
        raise ValueError(f"more than {MAX_ENTRIES} terms and rules")
    strict, soft, rules = list(strict), list(soft), list(rules)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, table = Vocabulary(strict, soft), Rules(rules)
        for batch in batches:
            ids, urls, hosts, paths = (batch.column(i) for i in range(4))
            out = []
            for url, host, path in zip(urls.to_pylist(), hosts.to_pylist(), paths.to_pylist(), strict=True):
                n_strict, n_soft = vocabulary.hits(url or "")
                rule = table.of(host, path)
                own = BLOCK if n_strict or n_soft >= min_soft else ALLOW
                out.append((rule[0] if rule else None, rule[1] if rule else own, n_strict, n_soft))
            named, verdicts, n_stricts, n_softs = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    hosts,
                    paths,
                    pa.array(named, pa.string()),
                    pa.array(verdicts, pa.string()),
                    pa.array(n_stricts, pa.int32()),
                    pa.array(n_softs, pa.int32()),
                ],
                names=[id_col, "host", "path", "rule", "verdict", "strict_hits", "soft_terms"],
            )

    kind = pages.schema[id_col].dataType.simpleString()
    url = F.col(url_col)
    return pages.select(
        F.col(id_col), lower_ascii(url).alias("_url"), host_of(url).alias("_host"), path_of(url).alias("_path")
    ).mapInArrow(
        judge,
        f"`{id_col}` {kind}, host string, path string, rule string, verdict string, strict_hits int, soft_terms int",
    )
