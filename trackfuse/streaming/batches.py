"""Rows of a stream in a folder per batch, merged from time to time so that files stay few and large."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trackfuse.session import file_system
from trackfuse.streaming.sinks import with_trigger
from trackfuse.streaming.versions import numbered_folders

#: Size of a file that a merge aims at.
FILE_BYTES = 256 * 1024 * 1024


def bloom_filter(*columns: str, distinct: int = 1_000_000) -> dict[str, str]:
    """Parquet options that let a reader pass by row groups without a looked-up value; ``distinct`` values a row group."""
    on = {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}
    return on | {f"parquet.bloom.filter.expected.ndv#{c}": str(distinct) for c in columns}


def append_batches(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Mapping | None = None,
    shape: Callable[[DataFrame], DataFrame] | None = None,
    options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Append a stream to ``path/batch=<id>``; a batch that is run again after a failure replaces its own rows.

    ``shape`` makes what is written of a batch. Unlike a file sink's folder, whose log names every file
    for ever, this one can be merged while the stream goes on (``merge_batches``).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch if shape is None else shape(batch)
        rows.write.mode("overwrite").options(**(options or {})).parquet(f"{path}/batch={batch_id}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return with_trigger(writer, trigger).start()


def batch_folders(spark: SparkSession, path: str) -> tuple[int, list[str]]:
    """The last batch of the newest merged folder (-1 without one), and the folders that hold each complete batch once."""
    merged = max(numbered_folders(spark, f"{path}/merged", "upto"), default=-1)
    later = [f"{path}/batch={b}" for b in numbered_folders(spark, path, "batch") if b > merged]
    return merged, ([f"{path}/merged/upto={merged}"] if merged >= 0 else []) + later


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the complete batches, merged or not.

    The files are chosen here, once: a merge that ends while they are being read changes nothing.
    """
    _, folders = batch_folders(spark, path)
    if not folders:
        raise ValueError(f"no batch has been written to {path} yet")
    # Named folders, not their parent: no half-written one is among them.
    return spark.read.parquet(*folders)


def merge_batches(
    spark: SparkSession,
    path: str,
    combine: Callable[[DataFrame], DataFrame],
    spare: int = 1,
    options: Mapping[str, str] | None = None,
) -> int | None:
    """Write what ``combine`` makes of the merged rows and the batches since as the new merged folder.

    The newest ``spare`` batches stay apart: only the last batch of a stream may ever be run again. Readers go by the
    new folder once it is whole; ``drop_merged`` removes what it replaces. Returns
    the last batch merged, None if there was nothing to merge.
    """
    merged, _ = batch_folders(spark, path)
    batches = [b for b in numbered_folders(spark, path, "batch") if b > merged]
    batches = batches[: max(len(batches) - spare, 0)]
    if not batches:
        return None
    base = [f"{path}/merged/upto={merged}"] if merged >= 0 else []
    rows = combine(spark.read.parquet(*base, *(f"{path}/batch={b}" for b in batches)))
    rows.write.mode("overwrite").options(**(options or {})).parquet(f"{path}/merged/upto={batches[-1]}")
    return batches[-1]


def _bytes(spark: SparkSession, folders: Sequence[str]) -> int:
    places = (file_system(spark, folder) for folder in folders)
    return sum(fs.getContentSummary(at).getLength() for fs, at in places)


def compact_batches(
    spark: SparkSession,
    path: str,
    sort_by: Sequence[str] = (),
    spare: int = 1,
    file_bytes: int = FILE_BYTES,
    options: Mapping[str, str] | None = None,
) -> int | None:
    """Merge batches into files of about ``file_bytes``, the same rows in fewer files.

    With ``sort_by`` files hold ranges of those columns, in order, so that a lookup by them opens few
    files; ``options`` of ``bloom_filter`` let it pass by those files too that lack the value. All rows are
    written anew, so let it run when the batches since are a good part of the whole.
    """
    files = max(1, -(-_bytes(spark, batch_folders(spark, path)[1]) // file_bytes))

    def together(rows: DataFrame) -> DataFrame:
        if not sort_by:
            return rows.repartition(files)
        return rows.repartitionByRange(files, *sort_by).sortWithinPartitions(*sort_by)

    return merge_batches(spark, path, together, spare, options)


def drop_merged(spark: SparkSession, path: str) -> int:
    """Remove batches and older merged folders that the newest merged one holds; no reader of those may be at work."""
    merged, _ = batch_folders(spark, path)
    gone = [f"{path}/batch={b}" for b in numbered_folders(spark, path, "batch") if b <= merged]
    gone += [f"{path}/merged/upto={b}" for b in numbered_folders(spark, f"{path}/merged", "upto") if b < merged]
    for folder in gone:
        fs, at = file_system(spark, folder)
        fs.delete(at, True)
    return len(gone)


def batch_stream(spark: SparkSession, path: str, schema, per_batch: int | None = None) -> DataFrame:
    """The folder as a stream of what is appended to it; merged rows, which it has had as batches, are no part of it.

    Let ``drop_merged`` only remove batches that such streams have read.
    """
    reader = spark.readStream.schema(schema)
    if per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.option("pathGlobFilter", "*.parquet").parquet(f"{path}/batch=*").select(*(F.col(f.name) for f in schema.fields))
