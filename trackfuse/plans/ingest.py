"""Messages to the two raw tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from trackfuse.schemas import POSITION_TABLE, POSITIONS, SCHEDULE, SCHEDULE_MESSAGE, SCHEDULE_TABLE, SCHEDULE_TIMES
from trackfuse.sources.decode import (
    SCHEDULE_PICKS,
    bad_rows,
    decode_flat_json,
    decode_schedule,
    lift,
    paged_payload,
    state_vectors,
)
from trackfuse.streaming.sinks import append_stream, ensure_tables

BAD_MESSAGES = T.StructType().add("topic", "string").add("value", "string")


def positions_from_messages(messages: DataFrame) -> DataFrame:
    return decode_flat_json(messages, POSITIONS)


def positions_from_pages(pages: DataFrame) -> DataFrame:
    return state_vectors(pages, POSITIONS)


def schedule_from_messages(messages: DataFrame) -> DataFrame:
    return decode_schedule(messages)


def schedule_from_pages(pages: DataFrame) -> DataFrame:
    return lift(paged_payload(pages, SCHEDULE_MESSAGE), SCHEDULE_PICKS, SCHEDULE_TIMES)


def start_ingest(
    position_messages: DataFrame,
    schedule_messages: DataFrame,
    checkpoints: str,
    fmt: str = "parquet",
    root: str | None = None,
    trigger: Mapping | None = None,
    positions: str = POSITION_TABLE,
    schedule: str = SCHEDULE_TABLE,
    bad_messages: str | None = None,
    partition_by: Mapping[str, Sequence[str]] | None = None,
) -> list[StreamingQuery]:
    """Append both topics to their tables, one query with one checkpoint each.

    ``bad_messages`` names a table for messages that cannot be read in full: topic and
    value; they are stored with nulls in the others as well. ``partition_by`` has the
    partition columns by table. The sources bound their batches (``per_batch`` there).
    """
    spark, parts = position_messages.sparkSession, partition_by or {}
    ensure_tables(spark, {positions: POSITIONS, schedule: SCHEDULE}, fmt, root, parts)
    feeds = {
        positions: (positions, positions_from_messages(position_messages)),
        schedule: (schedule, schedule_from_messages(schedule_messages)),
    }
    if bad_messages:
        ensure_tables(spark, {bad_messages: BAD_MESSAGES}, fmt, root)
        topics = {positions: (position_messages, POSITIONS), schedule: (schedule_messages, SCHEDULE_MESSAGE)}
        rows = [
            bad_rows(messages, shape).select(F.lit(topic).alias("topic"), F.col("value").cast("string").alias("value"))
            for topic, (messages, shape) in topics.items()
        ]
        feeds["bad"] = (bad_messages, rows[0].unionAll(rows[1]))  # a table of files has one writing query
    return [
        append_stream(
            rows,
            table,
            f"{checkpoints}/{feed.rpartition('.')[2]}",
            fmt,
            trigger=trigger,
            partition_by=parts.get(table, ()),
        )
        for feed, (table, rows) in feeds.items()
    ]
