"""Column contracts. Each table is declared once, here; sinks and projections read it."""

from __future__ import annotations

from pyspark.sql import types as T

_BY_NAME = {
    "string": T.StringType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
}


def schema(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _BY_NAME[kind]) for name, kind in columns.items()])


# Column names, types and order of the stored tables and messages.
POSITIONS = schema(
    icao24="string",
    callsign="string",
    origin_country="string",
    time_position="long",
    last_contact="long",
    longitude="double",
    latitude="double",
    baro_altitude="double",
    on_ground="boolean",
    velocity="double",
    true_track="double",
    vertical_rate="double",
    sensors="string",
    geo_altitude="double",
    squawk="string",
    spi="boolean",
    position_source="long",
)

SCHEDULE_TIMES = (
    "scheduled_out",
    "scheduled_off",
    "estimated_out",
    "estimated_off",
    "actual_out",
    "actual_off",
    "scheduled_on",
    "scheduled_in",
    "estimated_on",
    "estimated_in",
    "actual_on",
    "actual_in",
)
_FLIGHT_STATUS = {"ident": "string", "operator": "string", "diverted": "boolean", "cancelled": "boolean"}
_DELAYS = {"departure_delay": "int", "arrival_delay": "int"}
_TIMES = {name: "timestamp" for name in SCHEDULE_TIMES}
_TIMES_AS_TEXT = {name: "string" for name in SCHEDULE_TIMES}

SCHEDULE = schema(
    origin_code_icao="string",
    dest_code_icao="string",
    **_FLIGHT_STATUS,
    registration="string",
    **_TIMES,
    **_DELAYS,
)

SCHEDULE_MESSAGE = T.StructType(
    [
        T.StructField("origin", schema(code_icao="string")),
        T.StructField("destination", schema(code_icao="string")),
        *schema(**_FLIGHT_STATUS, registration="string", **_TIMES_AS_TEXT, **_DELAYS).fields,
    ]
)

PLACES = schema(ident="string", latitude_deg="double", longitude_deg="double")
ID_MAP = schema(icao24_cln="string", registration="string")
CALENDAR = schema(holiday_date="date")
OPERATOR_AVERAGES = schema(operator="string", operator_avg_departure_delay="double")

FEATURES = schema(
    origin_airport_icao="string",
    dest_airport_icao="string",
    **_FLIGHT_STATUS,
    **_TIMES,
    **_DELAYS,
    airport_lat="double",
    airport_long="double",
    icao24_cln="string",
    registration="string",
    baro_altitude="double",
    callsign="string",
    geo_altitude="double",
    icao24="string",
    last_contact="long",
    latitude="double",
    longitude="double",
    on_ground="boolean",
    origin_country="string",
    position_source="long",
    sensors="string",
    spi="boolean",
    squawk="string",
    time_position="long",
    true_track="double",
    velocity="double",
    vertical_rate="double",
    time_position_iso="timestamp",
    aircraft_airport_distance_km="double",
    seconds_to_scheduled_out="long",
    on_ground_int="int",
    diverted_int="int",
    cancelled_int="int",
    aircraft_to_airport_heading="double",
    scheduled_out_hour_of_day="int",
    scheduled_out_day_of_week="int",
    scheduled_out_month_of_year="int",
    operator_avg_departure_delay="double",
    is_holiday="int",
)

PREDICTIONS = T.StructType([*FEATURES.fields, T.StructField("prediction", T.DoubleType())])

# Names of the stored tables.
POSITION_TABLE = "flights.flight_positions"
SCHEDULE_TABLE = "schedule.schedule_data"
PLACE_TABLE = "airport.longlat"
AVERAGE_TABLE = "ref.operator_avg_delay"
FEATURE_TABLE = "data.combined_data"
PREDICTION_TABLE = "data.prediction_data"

# Model inputs and settings.
CATEGORICAL = (
    "operator",
    "dest_airport_icao",
    "scheduled_out_hour_of_day",
    "scheduled_out_day_of_week",
    "scheduled_out_month_of_year",
    "is_holiday",
)
NUMERICAL = (
    "aircraft_airport_distance_km",
    "seconds_to_scheduled_out",
    "velocity",
    "vertical_rate",
    "on_ground_int",
    "true_track",
    "aircraft_to_airport_heading",
    "operator_avg_departure_delay",
)
LABEL = "departure_delay"
MAX_BINS = 360
BOOST_DEPTH = 6
BOOST_STEP = 0.3
