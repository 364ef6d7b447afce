"""Token counts without ids: pieces per distinct pre-token times the frequency in the document."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from trackfuse.llm.pretokens import PieceTable

#: Texts whose pre-tokens are held at once, in characters.
CHUNK = 1_000_000


def chunks(texts: list[str], most: int = CHUNK) -> Iterator[list[str]]:
    """Consecutive parts of the list of about ``most`` characters, one text at least."""
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > most:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def count_tokens(table: PieceTable, texts: list[str]) -> list[int]:
    """Each text's number of tokens."""
    cut = (table.own_split(t) if (words := table.split(t)) is None else words for t in texts)
    frequencies = [None if words is None else Counter(words) for words in cut]
    distinct = set().union(*(f for f in frequencies if f))
    memo = table.renew()
    pieces = {w: len(memo[w]) // 4 for w in distinct}
    return [
        len(table.whole(t)) // 4 if f is None else sum(n * pieces[w] for w, n in f.items())
        for t, f in zip(texts, frequencies, strict=True)
    ]


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 2048,
) -> DataFrame:
    """Per row: id, n_bytes (UTF-8), n_tokens, over_limit (``n_tokens > limit``).

    ``tokenizer`` is the path of a tokenizers file that every node has. A task cuts its
    texts into pre-tokens, encodes each distinct one once, and joins the numbers of pieces
    to the documents' pre-token frequencies; neither ids nor rows per pre-token are made,
    and nothing is shuffled. Special strings in a text count as the library counts them. Only
    a tokenizer without a rule for pre-tokens gets whole texts.

    A null text counts as empty, with no tokens. Rows are counted one by one, so repeated
    rows stay; extra columns are ignored; an empty table gives an empty one.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = PieceTable.of(tokenizer, "counts")
        for batch in batches:
            column = pc.fill_null(batch.column(1), "")
            numbers = [n for part in chunks(column.to_pylist()) for n in count_tokens(table, part)]
            tokens = pa.array(numbers, pa.int64())
            sizes = pc.cast(pc.binary_length(column), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes, tokens, pc.greater(tokens, limit)],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        count, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    )
