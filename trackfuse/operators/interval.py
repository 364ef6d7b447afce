"""Interval join of planned events with the observations of their asset."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackfuse.functions.features import clock_micros
from trackfuse.operators.skew import (
    MAX_BROADCAST_BYTES,
    MAX_BROADCAST_ROWS,
    MIN_PIECE_ROWS,
    STREAM_SALTS,
    heavy_of_history,
    salted_join,
    stored_width,
)
from trackfuse.session import stage

DAY = 24 * 3600
EPOCH = datetime.datetime(1970, 1, 1)
# A plan row is shuffled and sorted, or kept in a stream's state, once for each bin it touches: with bins as wide as
# the window these are two.
BINS_PER_WINDOW = 1


def seconds(n: int) -> Column:
    return F.expr(f"INTERVAL '{int(n)}' SECOND")


def watermark(df: DataFrame, ts: str, delay: str = "8 hours") -> DataFrame:
    """Event-time mark on ``ts``. Zone-less times are made timestamps first, as marks need them."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def drop_repeats(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: repeated polls bring the same rows again.

    In a stream a repeat is looked for within the watermark's delay only, which bounds
    the state.
    """
    return df.dropDuplicatesWithinWatermark(keys) if df.isStreaming else df.dropDuplicates(keys)


def _bin(ts: Column, width: int, kind: T.DataType) -> Column:
    # Any bin number that rises with the time will do: both sides use the same one.
    return F.floor(clock_micros(ts.cast(kind), kind) / F.lit(width * 1_000_000)).cast("long")


def _literal(micros: int, kind: T.DataType) -> Column:
    """The time ``clock_micros`` gave, as a constant that reaches the scan."""
    if not isinstance(kind, T.TimestampNTZType):
        return F.timestamp_micros(F.lit(micros))
    return F.lit(str(EPOCH + datetime.timedelta(microseconds=micros))).cast("timestamp_ntz")


def interval_join(
    plan: DataFrame,
    obs: DataFrame,
    on: tuple[str, str],
    plan_ts: str,
    obs_ts: str,
    before: int = DAY,
    after: int = DAY,
    delay: str | None = None,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    stream_salts: int = STREAM_SALTS,
    min_rows: int = MIN_PIECE_ROWS,
    stage_plan: bool = False,
    obs_epoch: str | None = None,
    history: DataFrame | None = None,
) -> DataFrame:
    """Pairs with equal ids and ``plan_ts - before <= obs_ts <= plan_ts + after`` (seconds).

    Time is cut into bins as wide as the window. An observation
    falls into one bin, a plan is repeated for the two bins its window touches,
    and the join runs on id and bin with the exact range checked again. So an asset with
    very many observations is spread over its bins, and few of the compared pairs are
    discarded. A small plan side is broadcast and the observations are not shuffled at
    all; otherwise heavy (id, bin) groups are salted on both sides. Measuring, sketching
    and joining read the plan side several times, so let ``stage_plan`` write it first
    where it is itself a query.

    In a batch the earliest and latest window, measured with the plan's size, bound the
    observations that are read at all. The bounds are instants, whatever the session's zone, or zone-less
    times where both sides have such; where the time is derived from a stored column of epoch
    seconds, name that as ``obs_epoch``.

    With ``delay`` both sides are streams: the watermark sits on the very columns of the
    range condition, so rows leave the state once no partner can come. A plan is kept once
    for each bin it touches; ``history``, stored rows of ``obs``, tells which ids are
    heavy, and only their plans are repeated for each piece. Without it ``stream_salts`` holds for all.
    """
    plan_id, obs_id = on
    kinds = [plan.schema[plan_id].dataType, obs.schema[obs_id].dataType]
    if kinds[0] != kinds[1] and not all(isinstance(k, T.IntegralType) for k in kinds):
        raise ValueError(f"cast {plan_id} and {obs_id} to one type, not {kinds[0]} and {kinds[1]}")
    shared = set(plan.columns) & set(obs.columns)
    if shared:
        raise ValueError(f"rename the columns both sides have: {sorted(shared)}")
    if delay is not None:
        plan, obs = watermark(plan, plan_ts, delay), watermark(obs, obs_ts, delay)

    streaming = plan.isStreaming or obs.isStreaming
    bins = BINS_PER_WINDOW
    width = max((before + after) // bins, 1)
    # Spark compares a zone-less time with a timestamp as timestamps.
    zone_less = all(isinstance(side.schema[c].dataType, T.TimestampNTZType) for side, c in ((plan, plan_ts), (obs, obs_ts)))
    kind = T.TimestampNTZType() if zone_less else T.TimestampType()
    first, last = (F.col(plan_ts) - seconds(before)).cast(kind), (F.col(plan_ts) + seconds(after)).cast(kind)
    in_range = (F.col(obs_ts) >= first) & (F.col(obs_ts) <= last)

    if stage_plan and not streaming:
        plan = stage(plan, "plan")
    broadcast_plan = False
    if not streaming:
        size = plan.agg(
            F.count("*").alias("rows"),
            stored_width(plan).alias("bytes"),
            F.min(clock_micros(first, kind)).alias("first"),
            F.max(clock_micros(last, kind)).alias("last"),
        ).first()
        # Each plan row comes back once per bin it touches.
        broadcast_plan = size.rows <= max_broadcast_rows // (bins + 2) and (size.bytes or 0) <= MAX_BROADCAST_BYTES // (bins + 2)
        if size["first"] is not None:
            seen_at = F.col(obs_ts) if obs.schema[obs_ts].dataType == kind else F.col(obs_ts).cast(kind)
            obs = obs.filter((seen_at >= _literal(size["first"], kind)) & (seen_at <= _literal(size["last"], kind)))
            if obs_epoch and not zone_less:  # whole seconds that hold the bounds, as epochs may have fractions
                from_, to = size["first"] // 1_000_000, -(-size["last"] // 1_000_000)
                obs = obs.filter((F.col(obs_epoch) >= from_) & (F.col(obs_epoch) <= to))
    plans = plan.filter(F.col(plan_id).isNotNull() & F.col(plan_ts).isNotNull()).withColumn(
        "_bin", F.explode(F.sequence(_bin(first, width, kind), _bin(last, width, kind)))
    )
    seen = obs.filter(F.col(obs_id).isNotNull() & F.col(obs_ts).isNotNull()).withColumn(
        "_bin", _bin(F.col(obs_ts), width, kind)
    )
    # Texts and whole numbers are equal only if they are the same, so the id is shuffled once and stands for both sides'.
    # The state of a stream keeps its columns, as checkpoints hold it.
    once = not streaming and all(isinstance(k, T.IntegralType) or k == T.StringType() for k in kinds)
    if once:
        plans, seen = plans.withColumnRenamed(plan_id, "_id"), seen.withColumnRenamed(obs_id, "_id")
    else:
        plans, seen = plans.withColumn("_id", F.col(plan_id)), seen.withColumn("_id", F.col(obs_id))
    keys = ["_id", "_bin"]
    if broadcast_plan:
        small = F.broadcast(plans.withColumnsRenamed({c: f"_r_{c}" for c in keys}))
        same = (F.col("_id") == F.col("_r__id")) & (F.col("_bin") == F.col("_r__bin"))
        joined = seen.join(small, same & in_range, "inner")
    else:
        hot = None
        if streaming and history is not None:
            hot = heavy_of_history(history.select(F.col(obs_id).alias("_id")), ["_id"], min_rows=min_rows)
        joined = salted_join(
            seen,
            plans,
            keys,
            "inner",
            in_range,
            stream_salts=stream_salts,
            min_rows=min_rows,
            measured_large=not streaming,
            hot=hot,
            hot_on=["_id"] if hot is not None else None,
        )
    ids = {c: F.col("_id").cast(k).alias(c) for c, k in zip(on, kinds, strict=True)} if once else {}
    return joined.select(*(ids.get(c, c) for c in [*plan.columns, *obs.columns]))
