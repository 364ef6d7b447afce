import random

import pytest
from pyspark.sql import functions as F

#: Names that operators give to their own columns, put on the inputs as extra columns.
CLASHES = ("n_words", "n_hit", "spans", "row", "gram", "place", "node", "list", "size", "shard", "length", "h1", "_hash2")


def corpus(seed=5, n=40):
    """Rows (id, text) with nulls, empty texts, copies, near copies, shared passages, repeated rows and ids, runs."""
    rng = random.Random(seed)
    words = [f"w{i}é" if i % 9 == 0 else f"w{i}" for i in range(300)]

    def prose(k):
        return [rng.choice(words) for _ in range(k)]

    passage, line = prose(60), prose(12)
    rows = []
    for i in range(n):
        text = prose(rng.choice([1, 3, 5, 20, 80, 200]))
        if i % 3 == 0:
            at = rng.randrange(len(text) + 1)
            text = text[:at] + passage + text[at:]
        if i % 4 == 0:
            text = line + text + line
        rows.append((i, " ".join(text)))
    for i in range(0, n, 5):
        text = rows[i][1].split()
        if len(text) > 40:
            text[rng.randrange(len(text))] = "changed"
        rows.append((n + i, " \n".join(text)))
        rows.append((2 * n + i, rows[i][1]))
    rows += [(500, None), (501, ""), (502, None), (503, "  \t\n "), (None, "null id " + " ".join(passage)), (None, None)]
    rows += [(504, "a" * 700), (505, "ab " * 300), (506, "ab " * 300), (507, "Ab aB " * 5), (rows[0][0], rows[0][1])]
    rows += [(rows[1][0], "other text of the same id"), (508, " ".join(prose(3000) + passage)), rows[2]]
    return rows


@pytest.fixture(scope="session")
def rows_of():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows_of):
    """The rows with extra columns, in several partitions."""
    df = spark.createDataFrame(rows_of, "doc_id bigint, text string").repartition(3)
    return df.withColumns({c: F.lit("x") for c in CLASHES})


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
