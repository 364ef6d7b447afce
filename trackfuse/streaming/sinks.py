"""Sinks. Each streaming sink has its own checkpoint, so each resumes on its own."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from trackfuse.session import file_system, new_name


def with_trigger(writer: DataStreamWriter, trigger: Mapping | None) -> DataStreamWriter:
    """``{"availableNow": True}``, ``{"processingTime": "1 minute"}``, or None for back-to-back batches."""
    return writer.trigger(**trigger) if trigger else writer


def append_stream(
    df: DataFrame,
    table: str,
    checkpoint: str,
    fmt: str = "parquet",
    path: str | None = None,
    trigger: Mapping | None = None,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append a stream to a catalog table; ``path`` makes it an external one.

    ``partition_by`` must be what the table has, if it exists.
    """
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    with _partitions_by_folder(df.sparkSession):
        return with_trigger(writer, trigger).toTable(table)


def append_files(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    trigger: Mapping | None = None,
    options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Append a stream to a folder of files."""
    writer = df.writeStream.format(fmt).outputMode("append").options(**(options or {}))
    return with_trigger(writer.option("checkpointLocation", checkpoint), trigger).start(path)


_LISTED = "spark.sql.hive.manageFilesourcePartitions"


@contextlib.contextmanager
def _partitions_by_folder(spark: SparkSession) -> Iterator[None]:
    """Tables made here find their partitions in their folder, not in a list of the catalog's.

    So one statement, which points the table to another folder, replaces all partitions at once.
    """
    before = spark.conf.get(_LISTED)
    spark.conf.set(_LISTED, "false")
    try:
        yield
    finally:
        spark.conf.set(_LISTED, before)


def _make_table(
    spark: SparkSession,
    name: str,
    fields: Sequence[T.StructField],
    fmt: str,
    place: str | None,
    partition_by: Sequence[str],
) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    at = f" LOCATION '{place}'" if place else ""
    with _partitions_by_folder(spark):
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt}{parts}{at}")


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    return {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}


def overwrite_table(
    df: DataFrame, table: str, fmt: str = "parquet", path: str | None = None, partition_by: Sequence[str] | None = None
) -> None:
    """Replace a table with a batch result, without touching what others are reading.

    The rows go to a new folder below ``path`` (by default one in the warehouse), and the
    table is pointed to it once they are all there. Readers and streams that have begun
    keep the old files, which stay until ``remove_versions``. A partitioned table stays so, all its partitions
    being replaced in that one step, unless ``partition_by`` says otherwise. If columns or partitioning have
    changed, the table is made anew, and is not there for a moment.

    A table whose partitions the catalog lists, as Spark's own ``saveAsTable`` makes, cannot be pointed
    elsewhere in one step and is refused; those of ``ensure_tables`` and ``append_stream`` are not of that kind.
    """
    spark = df.sparkSession
    there = spark.catalog.tableExists(table)
    old = [c.name for c in spark.catalog.listColumns(table) if c.isPartition] if there else []
    parts = old if partition_by is None else list(partition_by)
    described = _described(spark, table) if there else {}
    if old and described.get("Partition Provider") == "Catalog":
        raise ValueError(f"the catalog lists the partitions of {table}; make it by ensure_tables")
    df = df.select(*(c for c in df.columns if c not in parts), *parts)
    root = path or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table.replace('.', '/')}_versions"
    place = f"{root}/{new_name('version')}"
    writer = df.write.format(fmt)
    (writer.partitionBy(*parts) if parts else writer).save(place)
    if there:
        same = [[(f.name, f.dataType) for f in side.schema.fields] for side in (df, spark.table(table))]
        if same[0] == same[1] and parts == old:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{place}'")
            spark.catalog.refreshTable(table)
            return
        if described.get("Type") == "MANAGED":
            # What is dropped with the table is an empty folder, not what others are reading.
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{root}/{new_name('dropped')}'")
        spark.sql(f"DROP TABLE {table}")
    _make_table(spark, table, df.schema.fields, fmt, place, parts)


def remove_versions(spark: SparkSession, table: str, keep: int = 1) -> list[str]:
    """Remove what ``overwrite_table`` has left behind but for the newest ``keep`` old versions; returns the folders removed.

    Only for versions that nobody reads any more.
    """
    now = _described(spark, table)["Location"].rstrip("/")
    fs, root = file_system(spark, now.rpartition("/")[0])
    found = [f for f in fs.listStatus(root) if f.getPath().getName().startswith("version_")]
    found = [f for f in found if f.getPath().getName() != now.rpartition("/")[2]]
    found.sort(key=lambda f: (f.getModificationTime(), f.getPath().getName()), reverse=True)
    gone = [f.getPath() for f in found[keep:]]
    for folder in gone:
        fs.delete(folder, True)
    return [folder.toString() for folder in gone]


def key_value_json(df: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """``(key, value)`` rows for a message sink; the value is the row as JSON without null fields."""
    return df.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct(*(columns or df.columns))).alias("value")
    )


def message_sink(
    df: DataFrame,
    options: Mapping[str, str],
    checkpoint: str,
    fmt: str = "kafka",
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Send ``(key, value)`` rows to a topic, or to any other streaming format."""
    writer = df.writeStream.format(fmt).outputMode("append").options(**options)
    return with_trigger(writer.option("checkpointLocation", checkpoint), trigger).start()


def multi_sink(df: DataFrame, sinks: Sequence[Callable[[DataFrame], StreamingQuery]]) -> list[StreamingQuery]:
    """One stream to several sinks, each a query with its own checkpoint.

    Sinks fail and resume apart from each other; the price is that each computes the
    stream again (``fan_out`` computes it once).
    """
    return [start(df) for start in sinks]


def await_any(spark: SparkSession, timeout: int | None = None) -> bool | None:
    """Block until any running query ends; the error of a failed one is raised here."""
    return spark.streams.awaitAnyTermination(*([timeout] if timeout else []))


def finish(*queries: StreamingQuery) -> None:
    """Wait until all of these have ended, as ``availableNow`` queries do."""
    for query in queries:
        query.awaitTermination()


def fan_out(
    df: DataFrame,
    paths: Mapping[str, str],
    shapes: Mapping[str, Callable[[DataFrame], DataFrame]],
    checkpoint: str,
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """One stream to several folders, computed once per batch.

    ``shapes`` gives each output its projection. A batch that is run again after a
    failure replaces its own folders (``batch=<id>``), so nothing is written twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, path in paths.items():
                shapes[name](batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        finally:
            batch.unpersist()

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return with_trigger(writer, trigger).start()


def console_sink(
    df: DataFrame,
    checkpoint: str,
    rows: int = 20,
    trigger: Mapping | None = None,
    out: Callable[[str], None] = print,
    counts: str | None = None,
) -> StreamingQuery:
    """Show the first ``rows`` rows of each batch without cutting values, for debugging.

    Only those rows reach the driver; the built-in console format would send it the
    whole batch. ``out`` takes a headline and then a line of JSON for each row shown.
    ``counts`` is a folder to which each batch writes its number of rows (``batch=<id>``).
    """

    def show(batch: DataFrame, batch_id: int) -> None:
        out(f"batch {batch_id}")
        for row in batch.limit(rows).toJSON().collect():
            out(row)
        if counts:
            batch.agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{counts}/batch={batch_id}")

    writer = df.writeStream.foreachBatch(show).option("checkpointLocation", checkpoint)
    return with_trigger(writer, trigger).start()


def metrics_json(metrics: DataFrame, path: str) -> None:
    """One small JSON file; for metrics rows only."""
    metrics.coalesce(1).write.mode("overwrite").json(path)


def ensure_tables(
    spark: SparkSession,
    tables: Mapping[str, T.StructType],
    fmt: str = "parquet",
    root: str | None = None,
    partition_by: Mapping[str, Sequence[str]] | None = None,
) -> None:
    """Create missing databases and tables; names are ``database.table``, existing ones stay as they are.

    ``partition_by`` has the partition columns of the tables that shall have any.
    """
    for name, schema in tables.items():
        database = name.rpartition(".")[0]
        if database:
            place = f" LOCATION '{root}/{database}'" if root else ""
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
        place = f"{root}/{name.replace('.', '/')}" if root else None
        _make_table(spark, name, schema.fields, fmt, place, (partition_by or {}).get(name, ()))
