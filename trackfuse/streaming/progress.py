"""What a stream did, batch by batch, as a table: above all how many rows came too late to count."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from trackfuse.session import file_system

PROGRESS = (
    "query string, run string, name string, batch bigint, at timestamp, rows_in bigint, dropped_late bigint, "
    "state_rows bigint, watermark timestamp"
)


class BatchProgress(StreamingQueryListener):
    """Writes a small file for each batch of every query of the session: ``<query>-<batch>.json`` below ``path``.

    ``dropped_late`` are the rows that stateful operators left out because they were older than the watermark. A
    batch that is run again replaces its file. No job is run, so the queries are not held up.
    """

    def __init__(self, spark: SparkSession, path: str):
        super().__init__()
        self.spark, self.path = spark, path.rstrip("/")
        self._ended: dict[str, threading.Event] = {}

    def _end_of(self, run: str) -> threading.Event:
        return self._ended.setdefault(run, threading.Event())

    def wait_for(self, query: StreamingQuery, timeout: float = 60) -> bool:
        """Wait until all batches of a query that has ended are written; events come a little later than the end."""
        return self._end_of(str(query.runId)).wait(timeout)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        told = json.loads(event.progress.json)
        states = told.get("stateOperators") or []
        row = {
            "query": told["id"],
            "run": told["runId"],
            "name": told.get("name"),
            "batch": told["batchId"],
            "at": told["timestamp"],
            "rows_in": sum(s.get("numInputRows") or 0 for s in told.get("sources") or []),
            "dropped_late": sum(s.get("numRowsDroppedByWatermark") or 0 for s in states),
            "state_rows": sum(s.get("numRowsTotal") or 0 for s in states),
            "watermark": (told.get("eventTime") or {}).get("watermark"),
        }
        fs, at = file_system(self.spark, f"{self.path}/{row['query']}-{row['batch']}.json")
        # A trigger without data reports the last batch once more; it must not hide what that one did.
        if not row["rows_in"] and fs.exists(at):
            return
        out = fs.create(at, True)
        try:
            out.write(bytearray(json.dumps(row).encode()))
        finally:
            out.close()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end_of(str(event.runId)).set()


def watch_batches(spark: SparkSession, path: str) -> BatchProgress:
    """Have the progress of all queries of the session written below ``path``; ``spark.streams.removeListener`` ends it."""
    fs, at = file_system(spark, path)
    fs.mkdirs(at)
    listener = BatchProgress(spark, path)
    spark.streams.addListener(listener)
    return listener


def batch_progress(spark: SparkSession, path: str) -> DataFrame:
    """The written progress, a row per batch."""
    return spark.read.schema(PROGRESS).json(path)


def late_rows(progress: DataFrame) -> DataFrame:
    """Per query: batches, rows read, rows dropped as late, and their share of the rows read."""
    sums = progress.groupBy("query").agg(
        F.count("*").alias("batches"), F.sum("rows_in").alias("rows_in"), F.sum("dropped_late").alias("dropped_late")
    )
    return sums.withColumn("late_share", F.try_divide("dropped_late", "rows_in"))
