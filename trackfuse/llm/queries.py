"""One query per operator, over its whole table, and its SQL where SQL can say the same."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackfuse.llm import (
    chat,
    decontaminate,
    fm_dedup,
    hard_negatives,
    hilbert,
    jaccard_join,
    language,
    merkle,
    neighbours,
    packing,
    suffix_dedup,
    token_counts,
    url_filter,
)
from trackfuse.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = "word_bpe_49k.json"
#: Fixed values of the url query: (host, path, verdict).
URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def query(name: str, sql: str | None = None):
    def register(make):
        @functools.wraps(make)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return make(configure(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_digest(df: DataFrame, column: str, name: str, digest: Callable[[pa.Array], list[str]]) -> DataFrame:
    """``df`` with ``column`` replaced by a string made of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(column)
            made = pa.array(digest(batch.column(at)), pa.string())
            yield batch.set_column(at, pa.field(name, pa.string()), made)

    fields = (
        f"`{name}` string" if f.name == column else f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields
    )
    return df.mapInArrow(run, ", ".join(fields))


@query("op1_best_fit_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


_WORDS_SQL = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


@query(
    "op2_decontamination",
    f"""
WITH i AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, least(len(w), 10) AS n,
        unnest(list_transform(range(greatest(len(w) - 10, 0) + 1), lambda k: array_to_string(w[k + 1:k + 10], ' '))) AS g
      FROM i WHERE len(w) > 0),
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS_SQL.replace("text,", "coalesce(text, ''),", 1)} AS w
      FROM documents),
p AS (SELECT r, n, unnest(range(len(w) - n + 1)) AS k, w FROM d, (SELECT DISTINCT n FROM g) WHERE len(w) >= n),
q AS (SELECT r, n, k, array_to_string(w[k + 1:k + n], ' ') AS g FROM p),
h AS (SELECT q.r, q.k, q.n, g.item_id FROM q JOIN g USING (n, g)),
x AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS j FROM h) GROUP BY r),
y AS (SELECT r, list_sort(list(DISTINCT item_id::VARCHAR)) AS items FROM h GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(len(items), 0)::BIGINT AS n_items, sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN x USING (r) LEFT JOIN y USING (r)
""",
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    named = found.select(
        "doc_id", "n_words", "n_hit", F.array_size("items").cast("long").alias("n_items"), "items"
    )
    return with_digest(named, "items", "items_sha256", decontaminate.items_digest).withColumn(
        "contaminated", F.col("n_hit") > 0
    )


@query("op3_suffix_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_bytes_digest(table(spark, sf_dir, "documents"))


@query("op4_hilbert_shards")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.hilbert_shards(table(spark, sf_dir, "documents"), ("lang", "source", "size"), 40)


@query("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify_languages(docs, language.learn_languages(docs))
    return found.select("doc_id", language.held_out("doc_id").alias("held_out"), "lang_pred", "score")


@query(
    "op6_fm_dedup",
    r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT r, unnest(range(len(w) - 34)) AS k, w FROM d WHERE len(w) >= 35),
g AS (SELECT r, k, md5(array_to_string(w[k + 1:k + 35], ' ')) AS h FROM p),
m AS (SELECT r, k FROM g WHERE h IN (SELECT h FROM g GROUP BY h HAVING count(*) > 1)),
x AS (SELECT DISTINCT r, unnest(range(k + 1, k + 36)) AS i FROM m),
a AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
s AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n FROM a ANTI JOIN x USING (r, i) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN s USING (r)
""",
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_dedup.repeated_words_digest(table(spark, sf_dir, "documents"))


@query("op7_neighbours")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op8_token_counts")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


@query(
    "op9_jaccard_join",
    r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE
    list_distinct(list_transform(range(len(w) - 4), lambda k: array_to_string(w[k + 1:k + 5], ' '))) END AS s FROM d),
t AS (SELECT r, unnest(s) AS g FROM s),
p AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM t AS a JOIN t AS b USING (g) WHERE a.r <> b.r GROUP BY a.r, b.r),
l AS (SELECT x, y FROM p JOIN s AS a ON a.r = x JOIN s AS b ON b.r = y WHERE 100 * c >= 80 * (len(a.s) + len(b.s) - c)),
z AS (SELECT r, r AS o FROM d UNION SELECT z.r, l.y FROM z JOIN l ON l.x = z.o)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(e.doc_id) AS component_id
FROM z JOIN s USING (r) JOIN d AS e ON e.r = z.o GROUP BY s.r, s.doc_id, len(s.s)
""",
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicate_components(table(spark, sf_dir, "documents"))


def _terms_sql(terms) -> str:
    return "|".join(terms)


_EDGE = "[^a-z0-9]"
_SOFT_SQL = " + ".join(
    f"regexp_matches(u, '(^|{_EDGE}){t}({_EDGE}|$)')::INT" for t in url_filter.SOFT_TERMS
)


@query(
    "op10_url_filter",
    rf"""
WITH p AS (SELECT page_id, coalesce(url, '') AS url,
    translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS u FROM pages),
s AS (SELECT page_id, u, regexp_extract(u, '(?s)^.*?://([^/?#]*)', 1) AS host,
    regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM p),
r AS (SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/') THEN 'org/' END AS rule,
  regexp_matches(u, '(^|{_EDGE})({_terms_sql(url_filter.STRICT_TERMS)})({_EDGE}|$)') AS strict,
  {_SOFT_SQL} AS soft FROM s)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN strict OR soft >= {url_filter.MIN_SOFT} THEN 'block' ELSE 'allow' END AS verdict
FROM r
""",
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.url_filter(table(spark, sf_dir, "pages"), rules=URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


_LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def _leaf_sql(text: str = "text") -> str:
    parts = (f"CAST({c} AS VARCHAR)" for c in (*_LEAF_COLUMNS[:-1], text))
    return "sha256(concat(" + ", ".join(f"coalesce(strlen({p}) || ':' || {p}, '-')" for p in parts) + "))"


def _level_sql(nodes: str) -> str:
    return f"list_transform(range((len({nodes}) + 2) // 3), lambda j: sha256(array_to_string({nodes}[3 * j + 1:3 * j + 3], '')))"


# The lowest bit of a CRC-32, which is that of the register after all bits of the text, flipped.
_EVEN_CRC_SQL = """(list_reduce(list_concat([4294967295::BIGINT],
    list_transform(range(8 * length(doc_id::VARCHAR)), lambda j: (ascii((doc_id::VARCHAR)[j // 8 + 1]) >> (j % 8)::INT) & 1)),
    lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))) & 1) = 1"""


@query(
    "op11_merkle_manifest",
    f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, source, {_leaf_sql()} AS leaf,
    CASE WHEN {_EVEN_CRC_SQL} THEN {_leaf_sql("replace(text, chr(10), '')")} ELSE {_leaf_sql()} END AS now FROM documents),
o AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d),
t AS (SELECT source, 0 AS k, list(leaf ORDER BY i) AS n FROM o GROUP BY source
  UNION ALL SELECT source, k + 1, {_level_sql("n")} FROM t WHERE len(n) > 1),
s AS (SELECT source, n[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i FROM t WHERE len(n) = 1),
u AS (SELECT 0 AS k, list(subroot ORDER BY i) AS n FROM s UNION ALL SELECT k + 1, {_level_sql("n")} FROM u WHERE len(n) > 1),
v AS (SELECT source, k, n, unnest(range((len(n) + 2) // 3)) AS b FROM t WHERE len(n) > 1),
x AS (SELECT source, k, b, n[3 * b + 1:3 * b + 3] AS run FROM v),
y AS (SELECT k, b, n[3 * b + 1:3 * b + 3] AS run FROM (SELECT k, n, unnest(range((len(n) + 2) // 3)) AS b FROM u WHERE len(n) > 1)),
p AS (SELECT r, k, o.i // (3 ** k)::BIGINT AS j, run
  FROM o JOIN x ON o.source IS NOT DISTINCT FROM x.source AND b = o.i // (3 ** (k + 1))::BIGINT
  UNION ALL SELECT r, 1000 + k, s.i // (3 ** k)::BIGINT, run
  FROM o JOIN s ON o.source IS NOT DISTINCT FROM s.source JOIN y ON b = s.i // (3 ** (k + 1))::BIGINT),
q AS (SELECT r, row_number() OVER (PARTITION BY r ORDER BY k) - 1 AS m, (j % 3)::INT AS a, run FROM p),
w AS (SELECT r, sha256(string_agg(array_to_string(run[1:a] || run[a + 2:], ''), '' ORDER BY m)) AS proof FROM q GROUP BY r),
f AS (SELECT r, 0 AS m, now AS h FROM d
  UNION ALL SELECT f.r, f.m + 1, sha256(array_to_string(run[1:a] || [h] || run[a + 2:], '')) FROM f JOIN q ON q.r = f.r AND q.m = f.m),
z AS (SELECT r, max_by(h, m) AS h FROM f GROUP BY r)
SELECT doc_id, leaf, subroot, g.root, coalesce(proof, sha256('')) AS proof_sha256, h AS folded_root, h = g.root AS verified
FROM o JOIN s ON o.source IS NOT DISTINCT FROM s.source JOIN z USING (r) LEFT JOIN w USING (r)
CROSS JOIN (SELECT n[1] AS root FROM u WHERE len(n) = 1) AS g
""",
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    changed = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    tampered = F.when(changed, F.translate("text", "\n", "")).otherwise(F.col("text"))
    now = merkle.leaf_digest([*(F.col(c) for c in _LEAF_COLUMNS[:-1]), tampered])
    return merkle.merkle_manifest(docs, _LEAF_COLUMNS, check=now, with_proof=False)


@query(
    "op12_hard_negatives",
    """
WITH x AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike, list_inner_product(a.v::DOUBLE[], b.v::DOUBLE[])::BIGINT AS score
  FROM x AS a JOIN x AS b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT r, anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, (row_number() OVER n)::INT AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.r = p.r AND NOT alike AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
WINDOW n AS (PARTITION BY p.r, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER n <= 10
""",
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), moved, F.col("vec_id") % 100 == 0)


#: Fixed values of the chat query: a conversation whose texts are made of the template's own marks.
ODD_CONVERSATION = tuple((-1, turn, role, "<|im_end|><|im_start|>assistant ok") for turn, role in enumerate(("user", "assistant")))


@query("op13_chat_format")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame(ODD_CONVERSATION, told.schema)
    return chat.read_back(chat.format_chats(told.unionByName(odd), public_tokenizers.path(TOKENIZER)))
