"""The corpus pipeline: language, near copies, repeated passages, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept, which
is written as Parquet in between. All but the last return the columns of ``documents``.
Rows are judged one by one: ids may repeat or be null.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackfuse.llm import decontaminate, jaccard_join, language, packing
from trackfuse.llm.fm_dedup import kept_words, passages
from trackfuse.llm.repeats import remove_repeats
from trackfuse.operators.skew import fits_broadcast
from trackfuse.session import configure, new_path, run_folder, stage

TOKENIZER = "word_bpe_49k.json"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; those of no language (no letter, no text) go.

    Where no language could be learned, all with a letter stay.
    """
    model = language.learn_languages(docs)
    if not model.names:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = language.identify_languages(docs, model, carry=docs.columns)
    return found.filter(F.col("lang_pred") != language.UNKNOWN).select("row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the one of the smallest id (null last), then of the smallest text hash.

    Of rows that repeat with id and text one stays, too. Texts without words are no copies.
    """
    groups = new_path(spark, "groups")
    with run_folder(spark):  # what the join has written besides goes once the groups are known
        found = jaccard_join.near_duplicate_components(docs, with_keys=True)
        found.filter("n_shingles > 0").select("doc_id", "text_hash", "group").write.parquet(groups)
    found = spark.read.parquet(groups)
    # Rows of one id and text are told apart by no more than their number.
    each = found.groupBy("group", "doc_id", "text_hash").agg(F.count("*").alias("times"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    best = each.groupBy("group").agg(F.count("*").alias("several"), F.max("times").alias("most"), F.min(order).alias("best"))
    best = stage(best.filter("several > 1 OR most > 1"), "best")
    if fits_broadcast(best):  # else a large group is split by the join
        best = F.broadcast(best)
    key = {"_id": F.col("doc_id"), "_hash": F.col("text_hash")}
    judged = each.join(best, "group").withColumn("kept", order.eqNullSafe(F.col("best")))
    judged = judged.filter("NOT kept OR times > 1").select(*(v.alias(k) for k, v in key.items()), "kept")
    judged = stage(judged, "copies")
    if fits_broadcast(judged):  # else the texts are shuffled
        judged = F.broadcast(judged)
    # The row travels as a whole, so its columns may have any names.
    text_hash = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("own_id"), text_hash.alias("own_hash"))
    same = F.col("own_id").eqNullSafe(F.col("_id")) & (F.col("own_hash") == F.col("_hash"))
    marked = rows.join(judged, same, "left")
    alone = marked.filter("kept IS NULL").select("row.*")
    once = marked.filter("kept").dropDuplicates(["_id", "_hash"]).select("row.*")
    return alone.unionByName(once)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without word sequences that occur elsewhere too; documents of which nothing is left go."""
    others = [c for c in docs.columns if c != "text"]

    def finish(words: list[bytes], text: bytes, spans) -> tuple:
        removed = int((spans[:, 1] - spans[:, 0]).sum())
        return kept_words(words, spans).decode() if removed else text.decode(), removed

    found = remove_repeats(docs, passages(), finish, "kept string, removed bigint", carry=others)
    kept = found.filter((F.col("removed") == 0) | (F.col("kept") != ""))
    values = {"text": F.col("kept"), **{c: F.col("row")[c] for c in others}}
    length = F.when(F.col("removed") > 0, F.char_length("kept").cast(docs.schema["n_chars"].dataType))
    values["n_chars"] = F.coalesce(length, values["n_chars"])
    return kept.select(*(values[c].alias(c) for c in docs.columns))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.find_leaks(docs, items, carry=docs.columns)
    return found.filter("n_hit = 0").select("row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in sequences."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language_id", language_id),
    ("near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("packing", packed),
]

#: Neither languages nor tokens can be told in SQL; the tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
