import datetime as dt

import pytest
from pyspark.sql import functions as F

from trackfuse.operators.enrich import key_average, key_average_join
from trackfuse.operators.interval import drop_repeats, watermark
from trackfuse.plans.features import refresh_averages, start_average_upkeep
from trackfuse.schemas import FEATURES
from trackfuse.session import file_system
from trackfuse.sources.scans import table_stream
from trackfuse.streaming.averages import keep_averages, kept_averages, merge_averages
from trackfuse.streaming.batches import append_batches, batch_stream, bloom_filter, compact_batches, drop_merged, read_batches
from trackfuse.streaming.progress import batch_progress, late_rows, watch_batches
from trackfuse.streaming.sinks import append_files, ensure_tables, finish
from trackfuse.streaming.versions import (
    drop_versions,
    numbered_folders,
    publish_version,
    read_version,
    versioned_join,
    versions_used,
)

ONCE = {"availableNow": True}
SCHEMA = "k string, v double"


def put(spark, folder, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))


def forget(spark, checkpoint, batch):
    fs, at = file_system(spark, f"{checkpoint}/commits/{batch}")
    assert fs.delete(at, False)


@pytest.fixture
def kept(spark, tmp_path):
    path, checkpoint, folder = (str(tmp_path / n) for n in ("kept", "ck", "in"))

    def bring(*rows):
        if rows:
            put(spark, folder, rows)
        feed = table_stream(spark, folder, spark.read.parquet(folder).schema)
        finish(keep_averages(feed, "k", "v", path, checkpoint, ONCE))

    return path, checkpoint, folder, bring


def test_kept_averages_equal_a_full_refresh(spark, kept, rows):
    path, checkpoint, folder, bring = kept

    def same():
        full = rows(key_average(spark.read.parquet(folder), "k", "v", "m"), "k", "m")
        assert rows(kept_averages(spark, path, "k", "m"), "k", "m") == full
        return full

    with pytest.raises(ValueError, match="no batch"):
        kept_averages(spark, path, "k", "m")
    bring(("a", 1.0), ("a", 2.0), (None, 4.0), ("n", None))
    assert same() == [("a", 1.5), ("n", None), (None, 4.0)]
    bring(("a", 6.0), ("b", None))
    same()
    # The second batch is run again, alone, and together with a new one behind it.
    forget(spark, checkpoint, 1)
    bring()
    same()
    forget(spark, checkpoint, 1)
    bring(("b", 3.0))
    same()
    assert numbered_folders(spark, path, "batch") == [0, 1, 2]


def test_merged_batches_count_once(spark, kept, rows):
    path, checkpoint, folder, bring = kept
    for i in range(4):
        bring(("a", float(i)), (f"k{i}", 1.0))
    assert merge_averages(spark, path) == 2
    full = rows(key_average(spark.read.parquet(folder), "k", "v", "m"))
    assert rows(kept_averages(spark, path, "k", "m")) == full
    # A batch that crashed before its mark is not read, nor is one that the merged folder holds.
    spark.createDataFrame([("a", 9.0, 1)], "k string, total double, n bigint").write.parquet(f"{path}/batch=9")
    fs, mark = file_system(spark, f"{path}/batch=9/_SUCCESS")
    fs.delete(mark, False)
    assert rows(kept_averages(spark, path, "k", "m")) == full
    drop_merged(spark, path)
    assert numbered_folders(spark, path, "batch") == [3]
    # The last batch is run again after the merge; more follow and are merged into the merged.
    forget(spark, checkpoint, 3)
    bring(("a", 50.0))
    assert merge_averages(spark, path) == 3 and merge_averages(spark, path) is None
    drop_merged(spark, path)
    assert numbered_folders(spark, f"{path}/merged", "upto") == [3]
    full = rows(key_average(spark.read.parquet(folder), "k", "v", "m"))
    assert rows(kept_averages(spark, path, "k", "m")) == full


def test_the_refresh_reads_kept_sums_instead_of_the_table(spark, tmp_path, rows):
    names = {"features": "upkeep.features", "averages": "upkeep.averages", "root": str(tmp_path / "store")}
    kept = str(tmp_path / "kept")
    ensure_tables(spark, {names["features"]: FEATURES}, root=names["root"])

    def add(*pairs):
        data = spark.createDataFrame(list(pairs), "operator string, departure_delay int")
        wide = data.select(*(F.col(f.name) if f.name in data.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in FEATURES))
        wide.write.insertInto(names["features"])
        finish(start_average_upkeep(spark, kept, str(tmp_path / "ck"), names["features"], ONCE))

    add(("A", 10), ("A", 20), (None, 7))
    add(("B", 5), ("A", None))
    whole = rows(refresh_averages(spark, **names))
    assert whole == [("A", 15.0), ("B", 5.0), (None, 7.0)]
    assert rows(refresh_averages(spark, **names, kept=kept)) == whole


def test_each_batch_goes_by_one_version(spark, tmp_path, rows):
    versions, out, checkpoint, folder = (str(tmp_path / n) for n in ("v", "out", "ck", "in"))

    def publish(value):
        return publish_version(spark.createDataFrame([("a", value)], "k string, m double"), versions)

    def run(n):
        put(spark, folder, [("a", float(n))])
        feed = table_stream(spark, folder, spark.read.parquet(folder).schema)
        running = versioned_join(feed, {"means": versions}, lambda b, means: key_average_join(b, means, "k", "m"), out, checkpoint, ONCE)
        finish(running)

    with pytest.raises(Exception, match="no version"):
        run(0)
    assert publish(1.0) == 1
    run(1)
    assert publish(2.0) == 2
    run(2)
    assert publish(3.0) == 3
    forget(spark, f"{checkpoint}/stream", 2)
    run(3)  # the batch before is run again, by its own version
    found = spark.read.schema("k string, v double, m double, batch bigint").parquet(out)
    assert rows(found, "v", "m") == [(0.0, 1.0), (1.0, 1.0), (2.0, 2.0), (3.0, 3.0)]
    # The batch that failed for want of a version is the first one.
    assert rows(versions_used(spark, checkpoint), "batch", "version") == [(0, 1), (1, 1), (2, 2), (3, 3)]
    reader = read_version(spark, versions)
    assert drop_versions(spark, versions, keep=1) == [1, 2] and rows(reader) == [("a", 3.0)]
    assert publish(4.0) == 4 and rows(read_version(spark, versions)) == [("a", 4.0)]


def test_an_unfinished_version_is_passed_by(spark, tmp_path, rows):
    path = str(tmp_path / "v")
    publish_version(spark.createDataFrame([("a", 1.0)], SCHEMA), path)
    publish_version(spark.createDataFrame([("a", 2.0)], SCHEMA), path)
    fs, mark = file_system(spark, f"{path}/v=2/_SUCCESS")
    fs.delete(mark, False)
    assert rows(read_version(spark, path)) == [("a", 1.0)]
    assert publish_version(spark.createDataFrame([("a", 3.0)], SCHEMA), path) == 2
    assert rows(read_version(spark, path)) == [("a", 3.0)]


def test_late_rows_are_counted_per_batch(spark, tmp_path, rows):
    told, folder, out, checkpoint = (str(tmp_path / n) for n in ("told", "in", "out", "ck"))
    start, schema = dt.datetime(2026, 3, 1), "k int, at timestamp"

    def run(*days):
        put(spark, folder, [(d, start + dt.timedelta(days=d)) for d in days], schema)
        feed = watermark(table_stream(spark, folder, spark.read.parquet(folder).schema), "at", "1 day")
        running = append_files(drop_repeats(feed, ["k"]), out, checkpoint, trigger=ONCE)
        finish(running)
        assert listener.wait_for(running)
        return running.id

    listener = watch_batches(spark, told)
    try:
        name = run(1, 2, 10)
        assert run(3, 4, 11) == run(5, 12) == name
    finally:
        spark.streams.removeListener(listener)
    progress = batch_progress(spark, told).filter(F.col("query") == name)
    assert rows(progress.filter("rows_in > 0"), "rows_in", "dropped_late") == [(2, 1), (3, 0), (3, 2)]
    total = late_rows(progress).first()
    assert (total.rows_in, total.dropped_late, total.late_share) == (8, 3, 3 / 8)
    assert progress.agg(F.max("watermark")).first()[0] >= start + dt.timedelta(days=10)
