"""Quality layers as running streams: rules and bounded deduplication, a stateful daily aggregate, an upserted gold table.

Two queries. The first checks every batch, keeps what passes in silver and what does not in a quarantine, and marks
rows that come after their day is closed. The second reads silver as a stream and keeps the open days as state. Late
rows have their own small totals per batch, so that no row is lost and the state stays bounded by the delay.
"""

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import keys, quality
from ..sources import tables
from .votes import read_or_none, unseen

LATE = "_late"


@dataclass(frozen=True)
class Folders:
    """Where the layers of one pipeline lie."""

    root: str

    def __getattr__(self, name: str) -> str:
        if name.startswith("__") or name not in ("silver", "quarantine", "late", "gold", "seen", "offsets", "gold_offsets"):
            raise AttributeError(name)
        return f"{self.root}/{name}"


def publish(df: DataFrame, folder: str, batch: int) -> DataFrame:
    """Write the partition of a batch once: it appears whole, by a rename, and a repeated batch leaves it as it is.

    So a stream that reads the folder sees the rows of a batch exactly once.
    """
    spark = df.sparkSession
    files, live = tables._files(spark, f"{folder}/_batch={batch}")
    if not files.exists(live):
        _, staged = tables._files(spark, f"{folder}/.batch-{batch}-{uuid.uuid4().hex}")
        df.write.parquet(staged.toString())
        if not files.rename(staged, live):
            raise OSError(f"{staged.toString()} could not be moved to {live.toString()}")
    return spark.read.schema(df.schema).parquet(live.toString())


def _newest(spark: SparkSession, folders: Folders, batch: int):
    """The greatest time among the rows of earlier batches, from one row per batch."""
    seen = read_or_none(spark, folders.seen)
    return seen.filter(F.col("_batch") < batch).agg(F.max("newest")).first()[0] if seen is not None else None


def day_end(ts: str):
    return F.date_trunc("day", F.col(ts)) + F.expr("INTERVAL 1 DAY")


def to_silver(
    stream: DataFrame,
    rules: list[quality.Expectation],
    shape: Callable[[DataFrame], DataFrame],
    measures: dict[str, Column],
    by: list[str],
    folders: Folders,
    key: str,
    ts: str,
    delay: str = "2 days",
    every: str | None = None,
) -> StreamingQuery:
    """Start the first query over a stream of raw rows.

    Every batch is checked in one pass: a DROP rule sends the row to the quarantine with the names of all rules
    it breaks, a FAIL rule broken by any other row stops the query before anything of the batch is written, and
    the rest is shaped and published in silver. An id is published once: the first by `ts` in a batch, and none
    that an earlier batch has published, which the written table tells, so no state grows. A row is late if its
    day had ended `delay` before the newest row of the earlier batches; late rows have totals of their own.
    """

    def sink(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            checked = quality.split_rejected(batch, rules)
            kept = checked.filter("NOT _rejected").drop("_rejected", "_broken")
            quality.enforce(quality.expectation_report(kept, [r for r in rules if r.action == "FAIL"]))
            publish(checked.filter("_rejected").drop("_rejected"), folders.quarantine, number)
            clean = keys.dedup_keep_first(unseen(kept, folders.silver, key, number), [key], [ts])
            closed = F.lit(_newest(spark, folders, number)).cast("timestamp") - F.expr(f"INTERVAL {delay}")
            late = F.coalesce(day_end(ts) <= closed, F.lit(False))
            silver = publish(shape(clean).withColumn(LATE, late), folders.silver, number)
            day = F.to_date(ts).alias("day")
            publish(silver.filter(LATE).groupBy(day, *by).agg(*[m.alias(n) for n, m in measures.items()]), folders.late, number)
            publish(silver.agg(F.max(ts).alias("newest")), folders.seen, number)
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", folders.offsets)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def to_gold(
    spark: SparkSession, measures: dict[str, Column], by: list[str], folders: Folders, ts: str, delay: str = "2 days",
    every: str | None = None, name: str | None = None, files_per_batch: int | None = None,
) -> StreamingQuery:
    """Start the second query: totals per day and `by` of the silver rows that are not late, held as state until the day is closed.

    Its watermark is never ahead of the one by which rows were marked late, so it drops none. Changed totals
    are upserted; only the days that changed are rewritten.
    """
    schema = spark.read.parquet(folders.silver).drop("_batch").schema
    reader = spark.readStream.schema(schema)
    reader = reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader
    silver = reader.parquet(f"{folders.silver}").filter(~F.col(LATE))
    day = F.window(F.col(ts), "1 day")
    totals = silver.withWatermark(ts, delay).groupBy(day.alias("window"), *by).agg(*[m.alias(n) for n, m in measures.items()])
    totals = totals.select(F.to_date("window.start").alias("day"), *[c for c in totals.columns if c != "window"])

    def sink(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            if not batch.isEmpty():
                tables.upsert_path(batch.sparkSession, folders.gold, batch, ["day", *by], ["day"])
        finally:
            batch.unpersist()

    writer = totals.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", folders.gold_offsets)
    writer = writer.queryName(name) if name else writer
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def gold(spark: SparkSession, folders: Folders, by: list[str], measures: dict[str, Column]) -> DataFrame:
    """Totals per day and `by`, which must be sums or counts: those of the stream and those of the late rows together."""
    parts = [read_or_none(spark, path) for path in (folders.gold, folders.late)]
    found = [p.select(F.col("day").cast("date").alias("day"), *by, *measures) for p in parts if p is not None]
    if not found:
        raise ValueError(f"nothing was written under {folders.root}")
    both = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    return both.groupBy("day", *by).agg(*[F.sum(m).alias(m) for m in measures])


def replay(spark: SparkSession, folders: Folders, fix: Callable[[DataFrame], DataFrame], rules: list[quality.Expectation], into: str) -> int:
    """Deliver the rows of the quarantine again, mended by `fix`, to the folder `into` that a stream reads; their number.

    Rows that still break a DROP rule are not delivered. A repeated replay may deliver a row twice; the second
    time its id is known and it is left out.
    """
    held = read_or_none(spark, folders.quarantine)
    if held is None:
        return 0
    mended = quality.drop_failures(fix(held.drop("_batch", "_broken")), rules)
    return tables.write_table(mended, into, "append")
