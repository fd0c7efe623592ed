"""What the engine itself measures of a streaming query, one row per batch."""

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS_SCHEMA = T.StructType(
    [
        T.StructField("query", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("triggered_at", T.StringType()),
        T.StructField("input_rows", T.LongType()),
        T.StructField("input_rows_per_second", T.DoubleType()),
        T.StructField("processed_rows_per_second", T.DoubleType()),
        T.StructField("state_rows", T.LongType()),
        T.StructField("state_bytes", T.LongType()),
        T.StructField("late_rows_dropped", T.LongType()),
        T.StructField("trigger_ms", T.LongType()),
        T.StructField("add_batch_ms", T.LongType()),
        T.StructField("commit_ms", T.LongType()),
        T.StructField("watermark", T.StringType()),
    ]
)


def progress_line(progress) -> tuple:
    """One row out of a progress report; what a report lacks is null, sums over no state are 0."""
    took, state = dict(progress.durationMs or {}), list(progress.stateOperators or [])
    commit = [took[name] for name in ("walCommit", "commitOffsets") if name in took]
    return (
        progress.name,
        str(progress.runId),
        progress.batchId,
        progress.timestamp,
        progress.numInputRows,
        progress.inputRowsPerSecond,
        progress.processedRowsPerSecond,
        sum(s.numRowsTotal for s in state),
        sum(s.memoryUsedBytes for s in state),
        sum(s.numRowsDroppedByWatermark for s in state),
        took.get("triggerExecution"),
        took.get("addBatch"),
        sum(commit) if commit else None,
        dict(progress.eventTime or {}).get("watermark"),
    )


class ProgressTable(StreamingQueryListener):
    """Keeps a row of every batch of the queries named, and writes them to `path` when a query ends or 100 rows are held.

    Rows of one run go to their own partition, numbered by the write; `read` shows a batch once. Register it
    with `spark.streams.addListener`.
    """

    def __init__(self, spark: SparkSession, path: str, queries: list[str] | None = None):
        self.spark, self.path, self.queries = spark, path, queries
        self.held, self.writes, self.running = {}, 0, set()

    def onQueryStarted(self, event):
        if self.queries is None or event.name in self.queries:
            self.running.add(str(event.runId))

    def onQueryIdle(self, event):
        pass

    def onQueryProgress(self, event):
        line = progress_line(event.progress)
        if self.queries is None or line[0] in self.queries:
            self.held.setdefault(line[1], []).append(line)
            if len(self.held[line[1]]) >= 100:
                self.flush(line[1])

    def onQueryTerminated(self, event):
        self.flush(str(event.runId))
        self.running.discard(str(event.runId))

    def flush(self, run: str) -> None:
        """Write what is held of a run."""
        lines = self.held.pop(run, [])
        if lines:
            self.writes += 1
            rows = self.spark.createDataFrame(lines, PROGRESS_SCHEMA)
            rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/_run={run}/_write={self.writes}")

    def read(self, wait: float = 60.0) -> DataFrame:
        """The rows written so far, each batch once; queries that still run are waited for, at most `wait` seconds."""
        end = time.monotonic() + wait
        while self.running and time.monotonic() < end:
            time.sleep(0.05)
        rows = self.spark.read.schema(PROGRESS_SCHEMA).parquet(f"{self.path}/*/*")
        return rows.withColumn("triggered_at", F.col("triggered_at").cast("timestamp")).dropDuplicates(["run_id", "batch_id"])
