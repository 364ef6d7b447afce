"""Small feature expressions. All stay inside generated code; none is a Python function per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def epoch_to_ts(epoch: Column) -> Column:
    """Epoch seconds to a timestamp."""
    return F.timestamp_seconds(epoch)


def seconds_to_event(event_ts: Column, epoch: Column) -> Column:
    """Whole seconds from an observation until the planned event; negative afterwards."""
    return F.unix_seconds(event_ts.cast("timestamp")) - epoch


def bool_to_int(flag: Column) -> Column:
    return flag.cast("int")


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def day_of_week(ts: Column) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(ts)


def month_of_year(ts: Column) -> Column:
    return F.month(ts)


def event_date(ts: Column) -> Column:
    return F.to_date(ts)


def strip_quotes(text: Column, quote: str = "'") -> Column:
    return F.translate(text, quote, "")


def null_default(*options: Column) -> Column:
    return F.coalesce(*options)


def flag_not_null(value: Column) -> Column:
    return F.when(value.isNotNull(), 1).otherwise(0)


def entity_id(*parts: Column, sep: str = "_") -> Column:
    """Parts joined by ``sep``; null parts are left out together with their separator."""
    return F.concat_ws(sep, *(p.cast("string") for p in parts))


def finite_or_null(value: Column) -> Column:
    infinite = F.abs(value) == float("inf")
    return F.when(F.isnan(value) | infinite, None).otherwise(value)


def non_finite_to_null(df: DataFrame) -> DataFrame:
    """NaN and the infinities become null in every float column."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: finite_or_null(F.col(c)) for c in floats})


def parse_date(text: Column) -> Column:
    """Date written in a string; null where there is none."""
    return F.try_to_date(text)


def clock_micros(ts: Column, kind: T.DataType) -> Column:
    """Microseconds that rise with the time, for comparing times of one ``kind`` in any session zone.

    A timestamp counts from the epoch. A zone-less time is read as it stands, as if clocks never
    changed: as an instant of the session's zone it could come out before an earlier one.
    """
    if not isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(ts.cast("timestamp"))
    seconds = F.unix_date(ts.cast("date")).cast("bigint") * 86_400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return seconds * 1_000_000 + F.date_format(ts, "SSSSSS").cast("bigint")
