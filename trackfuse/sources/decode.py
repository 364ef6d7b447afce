"""Messages to typed columns. Unreadable fields become null; no row is lost or raises."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackfuse.operators.project import flatten
from trackfuse.schemas import SCHEDULE, SCHEDULE_MESSAGE, SCHEDULE_TIMES


def json_field(col: str, schema: T.DataType) -> Column:
    return F.from_json(F.col(col).cast("string"), schema)


def decode_flat_json(df: DataFrame, schema: T.StructType, col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """One flat JSON object per row (text or bytes) to the columns of ``schema``."""
    return df.select(*keep, json_field(col, schema).alias("data")).select(*keep, "data.*")


def decode_nested_json(
    df: DataFrame,
    schema: T.StructType,
    picks: Mapping[str, str],
    times: Sequence[str] = (),
    col: str = "value",
) -> DataFrame:
    """Nested JSON to flat columns: output name -> path in the message; ``times`` are parsed."""
    data = df.select(json_field(col, schema).alias("data"))
    return lift(data, picks, times)


def lift(df: DataFrame, picks: Mapping[str, str], times: Sequence[str] = (), col: str = "data") -> DataFrame:
    """Pick fields out of a struct column, parsing those named in ``times``."""
    fields = {name: F.col(f"{col}.{path}") for name, path in picks.items()}
    fields |= {name: F.try_to_timestamp(fields[name]) for name in times}
    return flatten(df, fields)


# Where the columns of the schedule table sit in a schedule message.
SCHEDULE_PICKS = {
    name: {"origin_code_icao": "origin.code_icao", "dest_code_icao": "destination.code_icao"}.get(name, name)
    for name in SCHEDULE.names
}


def decode_schedule(df: DataFrame, col: str = "value") -> DataFrame:
    return decode_nested_json(df, SCHEDULE_MESSAGE, SCHEDULE_PICKS, SCHEDULE_TIMES, col)


def bad_rows(df: DataFrame, schema: T.StructType, col: str = "value") -> DataFrame:
    """The messages that are missing, no JSON, or hold a field that does not fit ``schema``, for a side table.

    A filter would be moved below whatever makes the messages, which would then be made anew for each mention of them;
    a generator stays above it.
    """
    marked = T.StructType([*schema.fields, T.StructField("_unread", T.StringType())])
    data = F.from_json(F.col(col).cast("string"), marked, {"columnNameOfCorruptRecord": "_unread"})
    bad = F.col(col).isNull() | data["_unread"].isNotNull()
    return df.select("*", F.explode(F.when(bad, F.array(F.lit(True)))).alias("_bad")).drop("_bad")


def state_vectors(df: DataFrame, schema: T.StructType, col: str = "value", field: str = "states") -> DataFrame:
    """Pages of positional arrays to one row per array with the columns of ``schema``.

    Short arrays are filled up with null, positions beyond the schema are ignored.
    """
    page = T.StructType([T.StructField(field, T.ArrayType(T.ArrayType(T.StringType())))])
    rows = df.select(F.explode(json_field(col, page)[field]).alias("v"))
    return rows.select(
        *(
            F.try_element_at("v", F.lit(i + 1)).try_cast(f.dataType).alias(f.name)
            for i, f in enumerate(schema.fields)
        )
    )


def paged_payload(
    df: DataFrame,
    entry: T.StructType,
    first: str = "departures",
    second: str = "scheduled_departures",
    col: str = "value",
) -> DataFrame:
    """Pages to one row per entry, as a struct column ``data``.

    Entries are under ``first``, or under ``second`` where the first is missing or empty.
    """
    page = T.StructType([T.StructField(name, T.ArrayType(entry)) for name in (first, second)])
    both = df.select(json_field(col, page).alias("page"))
    chosen = F.when(F.size(f"page.{first}") > 0, F.col(f"page.{first}")).otherwise(F.col(f"page.{second}"))
    return both.select(F.explode(chosen).alias("data"))


