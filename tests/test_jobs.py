import datetime as dt
import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from trackfuse import session
from trackfuse.learning.stages import KINDS
from trackfuse.learning.train import score
from trackfuse.operators.lookup import latest_for_key, latest_n
from trackfuse.plans.features import build_features, start_features
from trackfuse.plans.ingest import positions_from_pages, schedule_from_pages, start_ingest
from trackfuse.plans.models import start_scoring, train_all, training_rows
from trackfuse.queries import jobs, registry
from trackfuse.schemas import CATEGORICAL, FEATURES, LABEL, NUMERICAL, POSITIONS, SCHEDULE
from trackfuse.sources.scans import calendar_table, table_stream
from trackfuse.streaming.sinks import append_files, finish

ONCE = {"availableNow": True}
OUT = dt.datetime(2026, 12, 25, 10, tzinfo=dt.timezone.utc)


def iso(hours):
    return (OUT + dt.timedelta(hours=hours)).strftime("%Y-%m-%dT%H:%M:%SZ")


def epoch(hours):
    return int((OUT + dt.timedelta(hours=hours)).timestamp())


def flight(ident, registration, operator="OP", off=1.0, shift=0, **more):
    return {
        "origin": {"code_icao": "AAAA"},
        "destination": {"code_icao": "BBBB"},
        "ident": ident,
        "operator": operator,
        "diverted": False,
        "cancelled": True,
        "registration": registration,
        "scheduled_out": iso(shift),
        "actual_off": None if off is None else iso(shift + off),
        "departure_delay": 600,
        **more,
    }


def state(icao24, hours, lat=0.0, lon=1.0):
    return [icao24, "CALL", "X", epoch(hours), epoch(hours), lon, lat, 0.0, True, 5.0, 90.0, 0.0, None, 0.0, "1", False, 0]


FLIGHTS = [
    flight("T1", "R1"),
    flight("T2", "R2", operator="NEW", off=None),
    flight("T3", "unmapped"),
    flight("T4", None),
    flight("T5", "R1", shift=48, off=0),
]
STATES = [
    state("a1", -24), state("a1", -24.01), state("a1", 0.5), state("a1", 1), state("a1", 30), state("a2", 0), state("zz", 0)
]


@pytest.fixture
def dims(spark):
    return {
        "places": spark.createDataFrame([("AAAA", 0.0, 0.0)], "ident string, latitude_deg double, longitude_deg double"),
        "id_map": spark.createDataFrame([("a1", "R1"), ("a2", "R2")], "icao24_cln string, registration string"),
        "calendar": calendar_table(spark, ["2026-12-25"]),
        "operator_averages": spark.createDataFrame(
            [("OP", 100.0), (None, 300.0)], "operator string, operator_avg_departure_delay double"
        ),
    }


@pytest.fixture
def tables(spark):
    pages = [json.dumps({"departures": FLIGHTS[:3]}), json.dumps({"departures": [], "scheduled_departures": FLIGHTS[3:]})]
    plan = schedule_from_pages(spark.createDataFrame([(p,) for p in pages], "value string"))
    seen = positions_from_pages(spark.createDataFrame([(json.dumps({"states": STATES}),)], "value string"))
    return plan, seen


def seen_hours(rows):
    return {(r.ident, round((r.time_position - epoch(0)) / 3600, 2)) for r in rows}


def test_features_by_hand(tables, dims):
    got = build_features(*tables, **dims)
    assert got.columns == FEATURES.names
    assert [f.dataType for f in got.schema] == [f.dataType for f in FEATURES]
    # At the window's start: in; before it, at or after take-off, open flights, unmapped assets: out.
    rows = got.collect()
    assert seen_hours(rows) == {("T1", -24), ("T1", 0.5), ("T5", 30)}
    row = next(r for r in rows if r.ident == "T1" and r.time_position == epoch(0.5))
    assert row.aircraft_airport_distance_km == 111.19 and row.aircraft_to_airport_heading == pytest.approx(270.0)
    assert (row.seconds_to_scheduled_out, row.on_ground_int, row.diverted_int, row.cancelled_int) == (-1800, 1, 0, 1)
    assert (row.scheduled_out_hour_of_day, row.scheduled_out_day_of_week, row.scheduled_out_month_of_year) == (10, 6, 12)
    assert (row.operator_avg_departure_delay, row.is_holiday) == (100.0, 1)
    assert next(r for r in rows if r.ident == "T5").is_holiday == 0


def test_open_flights_can_be_kept(tables, dims):
    got = build_features(*tables, **dims, keep_open=True).collect()
    assert seen_hours(got) == {("T1", -24), ("T1", 0.5), ("T5", 30), ("T2", 0)}
    assert next(r for r in got if r.ident == "T2").operator_avg_departure_delay == 200.0


def test_messages_to_features_as_streams(spark, tables, dims, tmp_path):
    messages = {"flights": FLIGHTS, "states": [dict(zip(POSITIONS.names, s)) for s in STATES]}
    for name, rows in messages.items():
        values = spark.createDataFrame([(json.dumps(r),) for r in rows], "value string")
        values.write.parquet(str(tmp_path / name))
    topics = [
        table_stream(spark, str(tmp_path / n), spark.range(1).selectExpr("'' AS value").schema).selectExpr(
            "cast(value AS binary) AS value"
        )
        for n in ("states", "flights")
    ]
    names = {"positions": "raw_p.positions", "schedule": "raw_s.schedule"}
    for _ in range(2):
        finish(*start_ingest(*topics, str(tmp_path / "ck"), root=str(tmp_path / "raw"), trigger=ONCE, **names))
    assert spark.table("raw_s.schedule").exceptAll(tables[0]).isEmpty()
    assert spark.table("raw_s.schedule").count() == len(FLIGHTS)
    assert spark.table("raw_p.positions").count() == len(STATES)

    plan = table_stream(spark, str(tmp_path / "raw/raw_s/schedule"), SCHEDULE)
    seen = table_stream(spark, str(tmp_path / "raw/raw_p/positions"), POSITIONS)
    finish(append_files(build_features(plan, seen, **dims), str(tmp_path / "f"), str(tmp_path / "ck_f"), trigger=ONCE))
    streamed, batch = spark.read.schema(FEATURES).parquet(str(tmp_path / "f")), build_features(*tables, **dims)
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()


def test_first_start_without_history_then_with(spark, tables, dims, tmp_path):
    root, names = str(tmp_path / "store"), {"features": "fs.features", "averages": "fs.averages"}
    for name, df in zip(("plan", "seen"), tables):
        df.write.parquet(str(tmp_path / name))
    del dims["operator_averages"]

    def run():
        plan = table_stream(spark, str(tmp_path / "plan"), SCHEDULE)
        seen = table_stream(spark, str(tmp_path / "seen"), POSITIONS)
        finish(start_features(plan, seen, **dims, checkpoint=str(tmp_path / "ck"), root=root, trigger=ONCE, **names))
        stored = spark.read.parquet(f"{root}/fs/features")
        return {(r.ident, r.operator_avg_departure_delay) for r in stored.collect()}

    assert run() == {("T1", None), ("T5", None)}
    page = json.dumps({"departures": [flight("T6", "R1", shift=50)]})
    schedule_from_pages(spark.createDataFrame([(page,)], "value string")).write.mode("append").parquet(
        str(tmp_path / "plan")
    )
    assert run() == {("T1", None), ("T5", None), ("T6", 600.0)}


@pytest.fixture
def features(spark):
    """Feature rows with a delay that follows the operator and the distance."""
    made = {
        "ident": "concat('T', id % 40)",
        "origin_airport_icao": "'AAAA'",
        "operator": "concat('OP', id % 4)",
        "dest_airport_icao": "concat('D', id % 3)",
        "scheduled_out": "timestamp_seconds(id % 40 * 3600)",
        "time_position": "id",
        "aircraft_airport_distance_km": "double(id % 50)",
        "velocity": "nullif(double(id % 7), 3)",
        "departure_delay": "nullif(int(id % 4 * 60 + id % 50 * 10), 0)",
        "seconds_to_scheduled_out": "id % 11",
        "scheduled_out_hour_of_day": "int(id % 24)",
        "scheduled_out_day_of_week": "int(id % 7)",
        "scheduled_out_month_of_year": "1",
        "is_holiday": "0",
        "on_ground_int": "int(id % 2)",
    }
    other = {f.name: f"cast(null AS {f.dataType.simpleString()})" for f in FEATURES}
    zero = {n: "0.0D" for n in ("vertical_rate", "true_track", "aircraft_to_airport_heading", "operator_avg_departure_delay")}
    columns = other | zero | made
    return spark.range(0, 2000, 1, 4).selectExpr(*(f"{columns[n]} AS {n}" for n in FEATURES.names))


def test_training_rows_weigh_drawn_copies(features):
    rows = training_rows(features)
    sums = rows.groupBy("flight_id").agg(F.sum("sample_weight").alias("w")).collect()
    assert len(sums) == 40 and all(r.w == pytest.approx(1.0) for r in sums)
    assert abs(rows.count() - 2000) < 300


def test_training_by_the_callers_columns(spark, features, tmp_path):
    named = features.withColumnsRenamed({"operator": "firm", "departure_delay": "late", "ident": "name"})
    models, report = train_all(
        named, str(tmp_path), ["decision_tree_regression"], categorical=["firm"], numerical=[], label="late",
        entity=["name", "scheduled_out"], fraction=0.5, seeds=(1, 2), params={"decision_tree_regression": {"maxDepth": 3}},
    )
    assert report.count() == 1 and 0 < report.first().R2 < 1
    scored = score(models["decision_tree_regression"], named)
    assert scored.columns == [*named.columns, "prediction"]
    assert scored.select("firm", "prediction").distinct().count() == 4


def test_bad_messages_have_their_table(spark, tmp_path):
    good = json.dumps(dict(zip(POSITIONS.names, STATES[0])))
    for name, values in (("p", [good, "{", None]), ("s", [json.dumps(FLIGHTS[0]), "no"])):
        spark.createDataFrame([(v,) for v in values], "value string").write.parquet(str(tmp_path / name))
    feeds = [table_stream(spark, str(tmp_path / n), spark.range(1).selectExpr("'' AS value").schema) for n in "ps"]
    names = {"positions": "odd.positions", "schedule": "odd.schedule", "bad_messages": "odd.bad"}
    finish(*start_ingest(*feeds, str(tmp_path / "ck"), root=str(tmp_path / "raw"), trigger=ONCE, **names))
    bad = {tuple(r) for r in spark.table("odd.bad").collect()}
    assert bad == {("odd.positions", "{"), ("odd.positions", None), ("odd.schedule", "no")}
    assert spark.table("odd.positions").count() == 3


def test_train_score_and_look_up(spark, features, tmp_path):
    extra = {"boosted_regression": {"maxIter": 3}}
    models, report = train_all(features, str(tmp_path), params=extra, by_entity=True)
    lines = {r.Model: r for r in report.collect()}
    assert set(lines) == {"LinearRegression", "DecisionTreeRegression", "BoostedRegression"}
    assert lines["LinearRegression"].R2 == pytest.approx(1.0, abs=1e-3)
    assert all(r.R2 > 0.5 and r.RMSE >= 0 and r.Unlabelled > 0 for r in lines.values())
    names = sorted(p.name.rsplit("_", 2)[0] for p in tmp_path.iterdir())
    assert names == sorted([*models, *(f"metrics_{m}" for m in lines)])
    metrics = next(tmp_path.glob("metrics_LinearRegression_*.json"))
    assert spark.read.json(str(metrics)).columns == ["Model", "R2", "RMSE", "Timestamp"]

    features.write.parquet(str(tmp_path / "features"))
    scored = score(models["decision_tree_regression"], table_stream(spark, str(tmp_path / "features"), FEATURES))
    assert scored.columns == [*FEATURES.names, "prediction"]
    finish(append_files(scored, str(tmp_path / "scored"), str(tmp_path / "ck"), trigger=ONCE))
    stored = spark.read.parquet(str(tmp_path / "scored"))
    batch = score(models["decision_tree_regression"], spark.read.parquet(str(tmp_path / "features")))
    assert stored.exceptAll(batch).isEmpty() and stored.count() == 2000
    sent = start_scoring(
        models["linear_regression"], table_stream(spark, str(tmp_path / "features"), FEATURES), str(tmp_path / "ck_s"),
        {"path": str(tmp_path / "sent")}, "scores.rows", message_fmt="json", root=str(tmp_path / "store"), trigger=ONCE,
    )
    finish(*sent)
    assert spark.table("scores.rows").count() == 2000
    message = spark.read.json(str(tmp_path / "sent")).filter("key = 'T7'").first()
    assert json.loads(message.value)["ident"] == "T7" and "prediction" in json.loads(message.value)
    # Filled values replace the gaps, in the scored rows too.
    assert stored.filter("velocity IS NULL").count() == 0
    newest = latest_for_key(stored, "ident", "T7", "scheduled_out", ["time_position"]).first()
    assert newest.time_position == 1967
    assert [r.time_position for r in latest_n(stored, "scheduled_out", 2, ["time_position"]).collect()] == [1999, 1959]


def test_training_copies_only_the_columns_it_reads(spark, monkeypatch):
    class Seen(Exception):
        pass

    def record(rows, prefix):
        raise Seen(rows.columns)

    monkeypatch.setattr(jobs, "stage", record)
    monkeypatch.setattr(jobs, "table", lambda *_: None)
    monkeypatch.setattr(jobs, "domain", SimpleNamespace(schedule=lambda rows: rows, positions=lambda rows: rows))
    monkeypatch.setattr(jobs, "features", lambda *_: spark.createDataFrame([], FEATURES))
    with pytest.raises(Seen) as found:
        jobs.trained(spark, "")
    columns = found.value.args[0]
    assert set(columns) >= {*CATEGORICAL, *NUMERICAL, LABEL, "ident", "scheduled_out"} and len(columns) < 20


def test_every_kind_is_trained_as_it_is_by_default(spark, features, monkeypatch):
    class Seen(Exception):
        pass

    def record(rows, root, kinds, params=None, **how):
        raise Seen(kinds, params or {})

    monkeypatch.setattr(jobs, "train_all", record)
    monkeypatch.setattr(jobs, "table", lambda *_: None)
    monkeypatch.setattr(jobs, "domain", SimpleNamespace(schedule=lambda rows: rows, positions=lambda rows: rows))
    monkeypatch.setattr(jobs, "features", lambda *_: features)
    with pytest.raises(Seen) as found:
        jobs.trained(spark, "")
    kinds, params = found.value.args
    assert "boosted_regression" in kinds
    for kind in kinds:
        made, plain = (KINDS[kind][1](LABEL, **more) for more in (params.get(kind, {}), {}))
        settings = [{p.name: made_by.getOrDefault(p) for p in made_by.params if made_by.hasDefault(p)} for made_by in (made, plain)]
        assert settings[0] == settings[1]


@pytest.mark.parametrize("name", ["e2_features_stream", "e2_features_versioned"])
def test_features_of_a_replay_in_batches(spark, tmp_path, rows, monkeypatch, name):
    """Much history goes through the join in the order of its times, so its state is not all of it."""
    day = "timestamp_ntz'1993-01-01' + make_dt_interval(int({} % 2000))"
    made = {
        "nation": spark.range(20).selectExpr("int(id) n_nationkey"),
        "orders": spark.range(300).selectExpr(
            "id o_orderkey", "id * 3 o_custkey", "substr('FOP', int(id % 3) + 1, 1) o_orderstatus", "double(id) o_totalprice",
            f"if(id = 7, NULL, {day.format('(id * 811)')}) o_orderdate", "concat(id % 5, '-X') o_orderpriority",
        ),
        "lineitem": spark.range(1500).selectExpr(
            "id % 300 l_orderkey", "id l_partkey", "id % 90 l_suppkey", "int(id % 7) l_linenumber", "double(id % 50) l_quantity",
            "id / 8.0D l_extendedprice", "0.05D l_discount", "0.02D l_tax", "substr('ARN', int(id % 3) + 1, 1) l_returnflag",
            "substr('FO', int(id % 2) + 1, 1) l_linestatus", f"if(id = 11, NULL, {day.format('(id % 300 * 811 + id % 400)')}) l_shipdate",
        ),
    }
    for table_name, df in made.items():
        df.write.parquet(str(tmp_path / f"{table_name}.parquet"))
    shared = tmp_path / "shared"
    monkeypatch.setattr(registry, "BATCH_ROWS", 450, raising=False)
    monkeypatch.setattr(session, "work_dir", lambda _: str(shared))
    found = registry.QUERIES[name](spark, str(tmp_path))
    batch = registry.QUERIES["e2_features"](spark, str(tmp_path))
    columns = sorted(batch.columns)
    assert rows(found, *columns) == rows(batch, *columns) and batch.count() > 100
    commits = [p for p in shared.glob("e2_checkpoint_*/**/commits/*") if p.name.isdigit()]
    assert {p.name for p in commits} >= {"2", "3"}
