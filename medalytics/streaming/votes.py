"""New rows as a stream, their urgency, and a sink with alerts and service-level rows per batch."""

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import fixed_values as V
from ..sources import tables

SLA_SCHEMA = T.StructType(
    [
        T.StructField("batch_timestamp", T.TimestampType()),
        T.StructField("latency_seconds", T.DoubleType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("n_alerts", T.LongType()),
        T.StructField("n_errors", T.LongType()),
        T.StructField("status", T.StringType()),
    ]
)

#: When a row arrived by the clock of the engine; the state of seen ids is kept by it.
ARRIVED = "_arrived"


def file_stream(spark: SparkSession, root: str, table: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream over `root/table.parquet`, whether that is a directory of files or one file."""
    path = f"{root.rstrip('/')}/{table}.parquet"
    static = spark.read.parquet(path)
    reader = spark.readStream.schema(static.schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    one = static.select("_metadata.file_path").first()
    if one and one["file_path"].endswith(f"/{table}.parquet"):
        return reader.option("pathGlobFilter", f"{table}.parquet").parquet(root)
    return reader.parquet(path)


def new_rows(stream: DataFrame, key: str, ts: str, within: str = "1 day") -> DataFrame:
    """Each id once among those that arrive within `within` of each other; the checkpoint is the offset.

    The watermark runs over the time of arrival, not over `ts`, so no row is dropped for its age and the state
    holds the ids of about twice `within` only. What is delivered again later is found by `unseen` in the
    written table. Rows without an id are dropped.
    """
    typed = stream.filter(F.col(key).isNotNull()).withColumn(ts, F.col(ts).cast("timestamp"))
    return typed.withColumn(ARRIVED, F.current_timestamp()).withWatermark(ARRIVED, within).dropDuplicatesWithinWatermark([key])


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at `path`, or None if nothing was written there yet."""
    files, target = tables._files(spark, path)
    if not files.exists(target):
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException:  # the folder is empty
        return None


def unseen(batch: DataFrame, written: str, key: str, number: int) -> DataFrame:
    """Rows of a batch whose id no other batch has written; the batch's own earlier attempt does not count.

    Of the written table only ids between the least and the greatest of the batch are read, which the file
    statistics prune where ids grow with time; the ids found among them are few and taken out of the batch.
    """
    known = read_or_none(batch.sparkSession, written)
    if known is None:
        return batch
    ends = batch.agg(F.min(key).alias("low"), F.max(key).alias("high")).first()
    near = known.filter((F.col("_batch") != number) & F.col(key).between(ends["low"], ends["high"])).select(key)
    again = near.join(batch.select(key), key, "left_semi").distinct()
    return batch.join(again, key, "left_anti").select(*batch.columns)


def _replace(df: DataFrame, folder: str, batch: int) -> tuple[DataFrame, int]:
    """Write one batch to its own partition, counting its rows; a repeated batch replaces itself."""
    path = f"{folder}/_batch={batch}"
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get.get("n", 0)


def write_with_alerts(
    rows: DataFrame, out: str, alerts: str, sla: str, checkpoint: str, level: str = "urgency", alert_levels=V.ALERT_LEVELS,
    every: str | None = None, key: str | None = None, name: str | None = None,
) -> StreamingQuery:
    """Start a query that writes rows, alert rows and one service-level row per batch with rows.

    Without `every` it takes what there is and stops. Every batch owns its partition in the three
    tables, so a batch that is run again after a failure leaves no duplicates. With `key`, ids that an
    earlier batch has written are left out, however long ago that was.
    """

    def sink(batch: DataFrame, number: int) -> None:
        started = datetime.now(timezone.utc)
        spark = batch.sparkSession
        n_rows = n_alerts = 0
        status = "SUCCESS"
        try:
            if key:
                batch = batch.persist()
                fresh = unseen(batch, out, key, number)
            else:
                fresh = batch
            written, n_rows = _replace(fresh.drop(ARRIVED), out, number)
            if n_rows:
                _, n_alerts = _replace(written.filter(F.col(level).isin(alert_levels)), alerts, number)
        except Exception:
            status = "FAILED"
            raise
        finally:
            batch.unpersist()
            seconds = (datetime.now(timezone.utc) - started).total_seconds()
            line = (started, seconds, n_rows, n_alerts, int(status != "SUCCESS"), status)
            if n_rows or status != "SUCCESS":
                _replace(spark.createDataFrame([line], SLA_SCHEMA), sla, number)

    writer = rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    writer = writer.queryName(name) if name else writer
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def sla_breaches(sla: DataFrame, seconds: float = V.SLA_SECONDS) -> DataFrame:
    """Batches that took too long or had errors."""
    return sla.filter((F.col("latency_seconds") > seconds) | (F.col("n_errors") > 0))
