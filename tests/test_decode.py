import datetime as dt
import json

from pyspark.sql import functions as F

from trackfuse.schemas import FEATURES, POSITIONS, PREDICTIONS, SCHEDULE, SCHEDULE_MESSAGE, SCHEDULE_TIMES, schema
from trackfuse.sources.decode import (
    SCHEDULE_PICKS,
    bad_rows,
    decode_flat_json,
    decode_schedule,
    lift,
    paged_payload,
    state_vectors,
)
from trackfuse.sources.scans import calendar_table, csv_scan, quoted_csv_scan, topic_options

FLAT = schema(icao24="string", time_position="long", velocity="double", on_ground="boolean")


def messages(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_contract_widths():
    assert [len(s) for s in (POSITIONS, SCHEDULE, FEATURES, PREDICTIONS)] == [17, 21, 53, 54]
    assert PREDICTIONS.names[:-1] == FEATURES.names


def test_flat_json_edges(spark):
    raw = messages(
        spark,
        '{"icao24": "a1", "time_position": 5, "velocity": 1.5, "on_ground": true, "unknown": 1}',
        "not json",
        None,
        '{"icao24": "a2", "time_position": "soon", "velocity": 2}',
    )
    got = [tuple(r) for r in decode_flat_json(raw, FLAT).collect()]
    assert got == [("a1", 5, 1.5, True), (None,) * 4, (None,) * 4, ("a2", None, 2.0, None)]


def test_flat_json_from_bytes_and_arrays_as_text(spark):
    raw = messages(spark, '{"icao24": [1, 2]}').selectExpr("cast(value as binary) value")
    assert decode_flat_json(raw, FLAT).first().icao24 == "[1,2]"


def test_bad_rows(spark):
    wrong = '{"icao24": "a2", "time_position": "soon"}'
    raw = messages(spark, '{"icao24": "a"}', "{}", "junk", wrong, None)
    assert {r.value for r in bad_rows(raw, FLAT).collect()} == {"junk", wrong, None}


def test_nested_json_edges(spark):
    full = {
        "origin": {"code_icao": "AAAA"},
        "destination": {"code_icao": "BBBB"},
        "ident": "T1",
        "scheduled_out": "2026-03-01T10:00:00Z",
        "estimated_out": "2026-03-01T10:00:00+02:00",
        "actual_out": "when ready",
        "departure_delay": 60,
        "extra": {},
    }
    raw = messages(spark, json.dumps(full), json.dumps({"ident": "T2"}), "junk", None)
    got = decode_schedule(raw)
    assert got.columns == SCHEDULE.names
    assert [f.dataType for f in got.schema] == [f.dataType for f in SCHEDULE]
    first, second, *none = got.collect()
    assert (first.origin_code_icao, first.dest_code_icao, first.departure_delay) == ("AAAA", "BBBB", 60)
    # Collected timestamps are shown in the local zone; compare instants.
    instants = got.selectExpr("unix_seconds(scheduled_out) s", "unix_seconds(estimated_out) e", "actual_out").first()
    ten = int(dt.datetime(2026, 3, 1, 10, tzinfo=dt.timezone.utc).timestamp())
    assert (instants.s, instants.e, instants.actual_out) == (ten, ten - 7200, None)
    assert (second.ident, second.origin_code_icao) == ("T2", None)
    assert len(none) == 2 and all(v is None for r in none for v in r)


def test_state_vectors_edges(spark):
    full = ["a1", "call", "X", 7, 8, 1.5, 2.5, 3.5, False, 4.5, 5.5, 6.5, [1, 2], 9.5, "77", True, 0, "beyond"]
    raw = messages(spark, json.dumps({"states": [full, ["a2"], []]}), '{"states": []}', '{"states": null}', "junk", None)
    got = state_vectors(raw, POSITIONS).collect()
    assert len(got) == 3
    assert tuple(got[0]) == tuple([*full[:12], "[1,2]", *full[13:17]])
    assert tuple(got[1]) == ("a2", *[None] * 16)
    assert tuple(got[2]) == (None,) * 17


def test_paged_payload_edges(spark):
    one, two = {"ident": "one"}, {"ident": "two"}
    raw = messages(
        spark,
        json.dumps({"departures": [one, two], "scheduled_departures": [two]}),
        json.dumps({"departures": [], "scheduled_departures": [two]}),
        json.dumps({"scheduled_departures": [one]}),
        json.dumps({"links": {}}),
        json.dumps({"departures": None, "scheduled_departures": []}),
    )
    got = lift(paged_payload(raw, SCHEDULE_MESSAGE), SCHEDULE_PICKS, SCHEDULE_TIMES)
    assert got.columns == SCHEDULE.names
    assert [r.ident for r in got.collect()] == ["one", "two", "two", "one"]


def test_csv_scan(spark, tmp_path, rows):
    file = tmp_path / "places.csv"
    file.write_text("ident,latitude_deg,longitude_deg,other\nAAAA,51.5,-0.1,x\nBBBB,n/a,,y\n")
    got = csv_scan(spark, str(file), ["ident", "latitude_deg", "longitude_deg"], ["latitude_deg", "longitude_deg"])
    assert rows(got) == [("AAAA", 51.5, -0.1), ("BBBB", None, None)]


def test_quoted_csv_both_forms(spark, tmp_path, rows):
    for name, line in (("all", "'a1','R-1','m'"), ("id", "'a1',R-1,m")):
        file = tmp_path / f"{name}.csv"
        file.write_text("'icao24','registration','model'\n" + line + "\n")
        got = quoted_csv_scan(spark, str(file), "icao24", "icao24_cln", ["registration"])
        assert rows(got) == [("a1", "R-1")]


def test_calendar_table(spark, rows):
    got = calendar_table(spark, ["2026-12-25", "2026-12-25", "no date"])
    assert rows(got) == [(None,), (dt.date(2026, 12, 25),), (dt.date(2026, 12, 25),)]
    assert calendar_table(spark, []).count() == 0


def test_topic_options():
    options = topic_options("host:1", "t", maxOffsetsPerTrigger="5")
    assert options["startingOffsets"] == "earliest" and options["failOnDataLoss"] == "false"
    assert options["subscribe"] == "t" and options["maxOffsetsPerTrigger"] == "5"


def test_messages_are_made_once_to_find_the_bad_ones(spark):
    rows = spark.range(4).select(F.to_json(F.struct(F.col("id").cast("string").alias("time_position"))).alias("value"))
    found = bad_rows(rows.unionAll(messages(spark, None)), FLAT)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("StructsToJsonEvaluator") == 1
    assert sorted(r.value or "" for r in found.collect()) == ["", *(f'{{"time_position":"{i}"}}' for i in range(4))]
