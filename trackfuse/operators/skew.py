"""Joins that hold when one key has a large share of all rows.

Two ways, chosen by a measured size:

* the other side is small: broadcast it, nothing is shuffled;
* it is not: split the heavy keys over several sub-keys (salts) before the shuffle.

Which keys are heavy comes from frequent-items sketches of the key columns, so the list is
short whatever the data holds, and may be broadcast. The sketch only steers the split; the
joined rows are exact in any case.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackfuse.session import stage

MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 256 * 1024 * 1024
HOT_SHARE = 1 / 1000
# No key is cut into pieces smaller than this: one task handles that many rows with ease.
MIN_PIECE_ROWS = 100_000
MERGE_GROUPS = 128
STREAM_SALTS = 1


def _stored_bytes(field: T.StructField) -> Column:
    kind = field.dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(field.name), F.lit(0)) + 8
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0)) + 8
    return F.lit(8)


def fits_broadcast(
    df: DataFrame,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> bool:
    """Measure whether ``df`` may be sent whole to every executor.

    The row count of a stored table comes from file footers; bytes are only summed once
    the count has passed. Call it on stored tables, not on expensive queries.
    """
    if df.isStreaming or df.count() > max_rows:
        return False
    return (df.agg(stored_width(df).alias("bytes")).first().bytes or 0) <= max_bytes


def stored_width(df: DataFrame) -> Column:
    """An aggregate: about the bytes of all rows in memory."""
    return F.sum(sum((_stored_bytes(field) for field in df.schema.fields), F.lit(0)))


def row_hash(df: DataFrame) -> Column:
    """A spread over the rows of ``df`` that comes out the same when a task runs again.

    The partition number is part of it, so that exact copies of a row spread as well.
    """
    columns = [
        f.name for f in df.schema.fields if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))
    ]
    return F.xxhash64(*columns, F.spark_partition_id())


def key_hash(df: DataFrame, keys: Sequence[str]) -> Column:
    """The same number for equal keys, also where one side holds them as int and the other as long."""
    whole = {k for k in keys if isinstance(df.schema[k].dataType, T.IntegralType)}
    return F.xxhash64(*(F.col(k).cast("long") if k in whole else F.col(k) for k in keys))


def check_sides(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> None:
    """One rule for every way of joining, whatever the sizes.

    Keys are of one type on both sides (whole numbers may differ in width), and no other
    column is on both.
    """
    for k in keys:
        kinds = [side.schema[k].dataType for side in (left, right)]
        if kinds[0] != kinds[1] and not all(isinstance(kind, T.IntegralType) for kind in kinds):
            raise ValueError(f"cast {k} to one type, not {kinds[0].simpleString()} and {kinds[1].simpleString()}")
    shared = (set(left.columns) & set(right.columns)) - set(keys)
    if shared:
        raise ValueError(f"rename the columns both sides have: {sorted(shared)}")


def _matched(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    condition: Column | None = None,
    null_safe: bool = False,
    further: Sequence[str] = (),
    hint: str | None = None,
) -> DataFrame:
    """Join on ``keys`` and ``further``: the left columns in their order, then what the right adds."""
    on = [*keys, *further]
    out = [c for c in [*left.columns, *(c for c in right.columns if c not in keys)] if c not in further]
    right = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    if hint:
        right = right.hint(hint)
    match = F.lit(True) if condition is None else condition
    for c in on:
        mine, other = F.col(c), F.col(f"_r_{c}")
        match = match & (mine.eqNullSafe(other) if null_safe and c in keys else mine == other)
    return left.join(right, match, how).select(*dict.fromkeys(out))


def hot_keys(
    df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE, min_rows: int = MIN_PIECE_ROWS
) -> DataFrame:
    """``(_key, _parts)`` for the keys with more than ``share`` of all rows, and ``min_rows``, of ``df``.

    ``_parts`` is the number of pieces that brings a piece down to about that size.
    One pass over the key columns: each task keeps a small frequent-items sketch, which
    are merged in ``MERGE_GROUPS`` groups, and the groups' lists are added up. Sketches
    overrate by less than half of all rows in sum, so fewer than ``2 / share`` rows come
    back whatever the data holds.
    """
    most, tracked = int(1 / share), int(4 / share)
    lists = (
        df.select(key_hash(df, keys).alias("_key"), F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)).alias("g"))
        .groupBy("g")
        .agg(F.expr(f"approx_top_k(_key, {most}, {tracked})").alias("top"), F.count("*").alias("n"))
    )
    # An entry without a key carries the number of rows of its group.
    size = F.array(F.struct(F.lit(None).cast("long").alias("item"), F.col("n").alias("count")))
    counts = (
        lists.select(F.explode(F.concat("top", size)).alias("e"))
        .groupBy(F.col("e.item").alias("_key"))
        .agg(F.sum("e.count").alias("n"))
    )
    total = counts.filter(F.col("_key").isNull()).select("n").scalar()
    return (
        counts.filter(F.col("_key").isNotNull())
        .withColumn("piece", F.greatest(total * share, F.lit(float(min_rows))))
        .filter(F.col("n") > F.col("piece"))
        .select("_key", F.ceil(F.col("n") / F.col("piece")).cast("int").alias("_parts"))
    )


def _mark(side: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    # ``hot`` has fewer than 4 / share rows by construction, hence the hint.
    marked = side.withColumn("_key", key_hash(side, keys)).join(F.broadcast(hot), "_key", "left")
    return marked.drop("_key").fillna(1, ["_lp", "_rp"])


def _own_piece(side: DataFrame, parts: str) -> Column:
    return F.when(F.col(parts) > 1, F.pmod(row_hash(side), F.col(parts)).cast("int")).otherwise(0)


def _all_pieces(parts: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(parts) - 1))


def _heavy(left: DataFrame, right: DataFrame, keys: Sequence[str], unique_right: bool, **limits) -> DataFrame:
    """``(_key, _lp, _rp)``: into how many pieces a key is cut on either side.

    Written once, since both sides must go by the same numbers.
    """
    hot = hot_keys(left, keys, **limits).select("_key", F.col("_parts").alias("_lp"), F.lit(1).alias("_rp"))
    if not unique_right:
        other = hot_keys(right, keys, **limits).select("_key", F.lit(1).alias("_lp"), F.col("_parts").alias("_rp"))
        hot = hot.unionByName(other).groupBy("_key").agg(F.max("_lp").alias("_lp"), F.max("_rp").alias("_rp"))
    return stage(hot, "hot")


def heavy_of_history(history: DataFrame, keys: Sequence[str], **limits) -> DataFrame:
    """The heavy keys of stored rows, for a stream that goes on from them; written once."""
    hot = hot_keys(history, keys, **limits)
    return stage(hot.select("_key", F.col("_parts").alias("_lp"), F.lit(1).alias("_rp")), "hot")


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    condition: Column | None = None,
    null_safe: bool = False,
    unique_right: bool = False,
    stream_salts: int = STREAM_SALTS,
    share: float = HOT_SHARE,
    min_rows: int = MIN_PIECE_ROWS,
    measured_large: bool = False,
    hot: DataFrame | None = None,
    hot_on: Sequence[str] | None = None,
) -> DataFrame:
    """Equi-join on ``keys`` (same names on both sides, kept once), inner or left.

    The result has the left columns and then what the right side adds, as in ``sized_join``.
    Rows of a heavy left key get one of its ``_lp`` pieces and the matching right rows
    are repeated once per piece; heavy right keys are split likewise, so a heavy key is
    cut into a grid. Without heavy keys it is a plain join. A left join with heavy right
    keys is made of the inner join and the left rows whose key the right side lacks; a
    further condition is for inner joins only. ``unique_right`` says that no right key occurs twice.

    ``hot`` hands in a known list (``_key``, ``_lp``, ``_rp``) by the columns ``hot_on``.
    A stream cannot be measured first: it goes by such a list of its history, or else
    every left row is salted and every right row repeated ``stream_salts`` times.

    ``measured_large`` says that ``right`` is known not to fit a broadcast: a sort-merge
    join is asked for then, since file sizes let compressed tables look small.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"inner or left, not {how}")
    if how == "left" and condition is not None:
        raise ValueError("a left join takes no further condition")
    check_sides(left, right, keys)
    rule = {"null_safe": null_safe, "hint": "merge" if measured_large else None}
    if hot is None and (left.isStreaming or right.isStreaming):
        if stream_salts <= 1:
            return _matched(left, right, keys, how, condition, **rule)
        left, right = (s.withColumn("_lp", F.lit(stream_salts)).withColumn("_rp", F.lit(1)) for s in (left, right))
        cut_left, cut_right = True, False
    else:
        if hot is None:
            hot = _heavy(left, right, keys, unique_right, share=share, min_rows=min_rows)
        cut_left, cut_right = (not hot.filter(F.col(c) > 1).isEmpty() for c in ("_lp", "_rp"))
        if not cut_left and not cut_right:
            return _matched(left, right, keys, how, condition, **rule)
        if how == "left" and cut_right:
            same = {"null_safe": null_safe, "share": share, "min_rows": min_rows, "measured_large": measured_large}
            known = right.select(*keys).distinct().withColumn("_known", F.lit(True))
            marked = salted_join(left, known, keys, "left", unique_right=True, **same)
            unmatched = marked.filter(F.col("_known").isNull()).drop("_known")
            matched = salted_join(left, right, keys, "inner", **same)
            return matched.unionByName(unmatched, allowMissingColumns=True)
        left, right = _mark(left, hot_on or keys, hot), _mark(right, hot_on or keys, hot)

    # Heavy keys of one side only need salts of that side only.
    salts = []
    if cut_left:
        salts.append("_ls")
        left, right = left.withColumn("_ls", _own_piece(left, "_lp")), right.withColumn("_ls", _all_pieces("_lp"))
    if cut_right:
        salts.append("_rs")
        left, right = left.withColumn("_rs", _all_pieces("_rp")), right.withColumn("_rs", _own_piece(right, "_rp"))
    left, right = left.drop("_lp", "_rp"), right.drop("_lp", "_rp")
    return _matched(left, right, keys, how, condition, further=salts, **rule)


def sized_join(
    facts: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    max_rows: int = MAX_BROADCAST_ROWS,
    stream_salts: int = STREAM_SALTS,
    min_rows: int = MIN_PIECE_ROWS,
    **more,
) -> DataFrame:
    """Join a dimension: broadcast when its measured size allows, salted shuffle join beyond.

    Both ways take the same keys and give the same columns in the same order.
    """
    check_sides(facts, dim, keys)
    if fits_broadcast(dim, max_rows):
        return _matched(facts, dim, keys, how, null_safe=more.get("null_safe", False), hint="broadcast")
    return salted_join(
        facts, dim, keys, how, stream_salts=stream_salts, min_rows=min_rows, measured_large=True, **more
    )
