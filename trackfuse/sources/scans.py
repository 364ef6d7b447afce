"""Batch and streaming sources."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackfuse.functions.features import parse_date, strip_quotes
from trackfuse.session import file_system


def topic_options(servers: str, topic: str, per_batch: int | None = None, **more: str) -> dict[str, str]:
    """Kafka options: from the first offset on, going on where old data are gone.

    ``per_batch`` bounds the messages of a micro-batch; the rest follows in the next ones.
    Without it the first batch takes all that the topic holds.
    """
    if per_batch is not None:
        more = {"maxOffsetsPerTrigger": str(per_batch), **more}
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        **more,
    }


def read_stream(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str] | None = None,
    schema: T.StructType | None = None,
    path: str | None = None,
) -> DataFrame:
    """An unbounded source: a topic, or a folder of files (which needs its schema)."""
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def _is_name(source: str) -> bool:
    """Catalog names have no slash, paths have one."""
    return "/" not in source


def table_scan(
    spark: SparkSession, source: str, fmt: str = "parquet", schema: T.StructType | None = None
) -> DataFrame:
    """A stored table by its folder, or by its catalog name, which brings format and schema."""
    if _is_name(source):
        return spark.table(source)
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(source)


def as_glob(path: str) -> str:
    """The path as a pattern that names it alone.

    A file stream takes a folder or a pattern, not one file; a pattern serves both a
    table that is a file and one that is a folder of files.
    """
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/{{{name}}}"


def table_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType | None = None,
    fmt: str = "parquet",
    per_batch: int | None = None,
    **options,
) -> DataFrame:
    """A stored table as a stream of what is appended to it: by catalog name, or by folder and schema.

    ``per_batch`` bounds the files of a micro-batch; the rest follows in the next ones.
    """
    if per_batch is not None:
        options = {"maxFilesPerTrigger": str(per_batch), **options}
    if _is_name(source):
        return spark.readStream.options(**options).table(source)
    return read_stream(spark, fmt, options, schema, source)


def ordered_stream(
    df: DataFrame, time: str, path: str, files: int, per_batch: int, key: str | None = None
) -> DataFrame:
    """Stored rows as a stream in the order of ``time``, ``per_batch`` of ``files`` files to a micro-batch.

    Each file written to ``path`` holds a range of times, and its own time, by which a file stream goes, follows from its
    place. So whatever a batch ends with, no later row is older than a row before it: watermarks drop nothing, and
    state is what the window needs. Within a file rows go by ``key``, so that state of one key after another is looked up.
    In a store that does not let files' times be set all rows come in one batch.
    """
    spark = df.sparkSession
    placed = df.repartitionByRange(files, F.col(time))
    placed = placed.sortWithinPartitions(key) if key else placed
    placed.write.option("compression", "zstd").parquet(path)
    bounds = {"per_batch": per_batch} if _dated_by_place(spark, path) else {}
    return table_stream(spark, path, df.schema, **bounds)


def _dated_by_place(spark: SparkSession, path: str) -> bool:
    """Set the times of a folder's files a second apart, by name; whether the store has kept them."""
    fs, at = file_system(spark, path)

    def listed() -> list:
        found = [s for s in fs.listStatus(at) if s.getPath().getName().startswith("part-")]
        return sorted(found, key=lambda s: s.getPath().getName())

    found = listed()
    if not found:
        return True
    first = min(s.getModificationTime() for s in found) // 1000 - len(found)
    wanted = [(first + i) * 1000 for i in range(len(found))]
    for status, when in zip(found, wanted, strict=True):
        fs.setTimes(status.getPath(), when, -1)
    return [s.getModificationTime() for s in listed()] == wanted


def csv_scan(
    spark: SparkSession, path: str, columns: Sequence[str], doubles: Sequence[str] = (), **options: str
) -> DataFrame:
    """CSV with a header, read as text; some columns as doubles, null where that fails."""
    text = spark.read.options(header=True, **options).csv(path)
    return text.select(*(F.col(c).try_cast("double").alias(c) if c in doubles else F.col(c) for c in columns))


def quoted_csv_scan(
    spark: SparkSession, path: str, id_col: str, clean_id: str, columns: Sequence[str], quote: str = "'"
) -> DataFrame:
    """CSV whose header and values may be wrapped in ``quote``.

    The id comes out clean under ``clean_id``; so do the other ``columns``.
    """
    text = spark.read.csv(path, header=True, quote=quote)
    named = text.toDF(*(c.strip(quote) for c in text.columns))
    return named.select(strip_quotes(F.col(id_col), quote).alias(clean_id), *columns)


def calendar_table(spark: SparkSession, dates: Iterable[str], name: str = "holiday_date") -> DataFrame:
    """A table of dates from a list of ``yyyy-mm-dd`` texts."""
    listed = F.array(*(F.lit(str(d)) for d in dates)).cast("array<string>")
    return spark.range(1).select(F.explode(listed).alias(name)).withColumn(name, parse_date(F.col(name)))


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
