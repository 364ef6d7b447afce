import pytest
from pyspark.sql import functions as F

from trackfuse.operators.lookup import latest_for_key
from trackfuse.session import file_system
from trackfuse.sources.scans import table_stream
from trackfuse.streaming.batches import (
    append_batches,
    batch_folders,
    batch_stream,
    bloom_filter,
    compact_batches,
    drop_merged,
    read_batches,
)
from trackfuse.streaming.sinks import append_files, finish

ONCE = {"availableNow": True}
SCHEMA = "k string, n int"


def put(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.mode("append").parquet(str(folder))


@pytest.fixture
def appended(spark, tmp_path):
    path, checkpoint, folder = (str(tmp_path / n) for n in ("rows", "ck", "in"))

    def bring(*rows, **how):
        put(spark, folder, rows)
        feed = table_stream(spark, folder, spark.read.parquet(folder).schema)
        finish(append_batches(feed, path, checkpoint, ONCE, **how))

    return path, checkpoint, bring


def test_compaction_keeps_rows_readers_and_streams(spark, appended, tmp_path, rows):
    path, checkpoint, bring = appended
    with pytest.raises(ValueError, match="no batch"):
        read_batches(spark, path)
    for i in range(4):
        bring(*((f"k{j}", 10 * i + j) for j in range(10)))
    every = sorted(((f"k{j}", 10 * i + j) for i in range(4) for j in range(10)), key=repr)
    reader = read_batches(spark, path)
    before = len(reader.inputFiles())
    feed = batch_stream(spark, path, reader.schema, per_batch=3)
    running = append_files(feed, str(tmp_path / "out"), str(tmp_path / "ck_out"))
    running.processAllAvailable()

    assert compact_batches(spark, path, ["k"]) == 2
    assert rows(reader) == every and rows(read_batches(spark, path)) == every
    assert len(read_batches(spark, path).inputFiles()) < before / 2
    running.processAllAvailable()
    drop_merged(spark, path)
    bring(("new", 99))
    assert rows(read_batches(spark, path)) == sorted([*every, ("new", 99)], key=repr)
    running.processAllAvailable()
    running.stop()
    # The stream has had each row once, merged or not.
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == sorted([*every, ("new", 99)], key=repr)

    # The last batch is run again after it has been merged, too.
    assert compact_batches(spark, path, spare=0) == 4
    fs, at = file_system(spark, f"{checkpoint}/commits/4")
    fs.delete(at, False)
    bring(("newer", 100))
    assert rows(read_batches(spark, path)) == sorted([*every, ("new", 99), ("newer", 100)], key=repr)
    assert batch_folders(spark, path)[0] == 4 and compact_batches(spark, path) is None


def test_files_are_of_the_size_asked_for(spark, appended):
    path, _, bring = appended
    bring(*((f"k{i}", i) for i in range(20_000)))
    bring(("x", 1))
    assert compact_batches(spark, path, ["k"], file_bytes=40_000) == 0
    files = spark.read.parquet(f"{path}/merged/upto=0").inputFiles()
    assert len(files) > 2
    ranges = [spark.read.parquet(f).agg(F.min("k"), F.max("k")).first() for f in files]
    ranges = sorted(tuple(r) for r in ranges)
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:], strict=False))


def scanned(df):
    """The rows that the scan of the plan gave, by its own count, after filters on row groups."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    leaf = leaves.apply(0)
    if leaf.getClass().getSimpleName() != "FileSourceScanExec":
        leaf = leaf.executedPlan().collectLeaves().apply(0)
    return leaf.metrics().apply("numOutputRows").value()


def test_a_lookup_of_an_absent_key_reads_no_row_group(spark, appended, rows):
    """Even keys are there; odd ones lie between them, so only the filters of the files tell that they are not."""
    path, _, bring = appended
    many = [(f"{2 * i:06d}", i) for i in range(6000)]
    bring(*many, options={})
    plain = read_batches(spark, path)
    bring(*many, options=bloom_filter("k") | {"parquet.enable.dictionary": "false"})
    batch = spark.read.parquet(f"{path}/batch=1")
    absent = "000123"
    assert scanned(batch.filter(F.col("k") == absent)) == 0
    assert rows(latest_for_key(batch, "k", absent, "n")) == []
    assert rows(latest_for_key(batch, "k", "000124", "n")) == [("000124", 62)]
    without = spark.read.option("parquet.filter.bloom.enabled", "false").parquet(f"{path}/batch=1")
    assert scanned(without.filter(F.col("k") == absent)) > 0
    # Sorted files: a key that is there is in one of them.
    compact_batches(spark, path, ["k"], spare=0, file_bytes=20_000, options=bloom_filter("k") | {"parquet.enable.dictionary": "false"})
    merged = spark.read.parquet(f"{path}/merged/upto=1")
    assert len(merged.inputFiles()) > 2
    assert scanned(merged.filter(F.col("k") == "000124")) <= 12_000 / 2
    assert scanned(merged.filter(F.col("k") == absent)) == 0
    assert plain.count() == 6000
