"""The run log and its monitoring questions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..functions import fixed_values as V

LOG_SCHEMA = T.StructType(
    [
        T.StructField("log_id", T.StringType(), False),
        T.StructField("ts", T.TimestampType(), False),
        T.StructField("level", T.StringType(), False),
        T.StructField("notebook", T.StringType()),
        T.StructField("step", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("details", T.StringType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("affected", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_type", T.StringType()),
        T.StructField("error_stack", T.StringType()),
    ]
)


def log_rows(df: DataFrame, limit: int = V.LOG_TEXT_LIMIT) -> DataFrame:
    """Log rows with status by level and long texts cut in their middle."""
    out = df.withColumn("status", C.run_status(F.col("level")))
    for name in ("details", "error_stack"):
        if name in df.columns:
            out = out.withColumn(name, C.truncate_middle(F.coalesce(name, F.lit("")), limit))
    return out


def _since(as_of, days: float) -> Column:
    """Start of the window that ends at `as_of`: a literal or a one-row DataFrame; default now."""
    end = F.current_timestamp() if as_of is None else as_of.scalar() if isinstance(as_of, DataFrame) else F.lit(as_of)
    return F.col("ts") >= end - F.expr(f"make_dt_interval(0, {int(days * 24)}, 0, 0)")


def latest(log: DataFrame, n: int = 50) -> DataFrame:
    return log.orderBy(F.col("ts").desc(), F.col("log_id").desc()).limit(n)


def recent(log: DataFrame, levels=V.SEEN_LEVELS, as_of=None, hours: int = 24) -> DataFrame:
    """Rows of the given levels in the last hours, newest first."""
    return log.filter(F.col("level").isin(levels) & _since(as_of, hours / 24)).orderBy(F.col("ts").desc())


def runs(log: DataFrame, as_of=None, days: int = 7) -> DataFrame:
    """Last start and end, longest duration, status and errors per notebook."""
    at_end = F.col("step").contains("END")
    return (
        log.filter(_since(as_of, days))
        .groupBy("notebook")
        .agg(
            F.max(F.when(F.col("step") == "NOTEBOOK_START", F.col("ts"))).alias("last_start"),
            F.max(F.when(F.col("step") == "NOTEBOOK_END", F.col("ts"))).alias("last_end"),
            F.max(F.when(at_end, F.col("duration"))).alias("max_duration"),
            F.max(F.when(at_end, F.col("status"))).alias("last_status"),
            F.count_if(F.col("level") == "ERROR").alias("n_errors"),
        )
        .orderBy(F.col("last_start").desc())
    )


def error_rate(log: DataFrame, prefix: str = "API", as_of=None, days: int = 7) -> DataFrame:
    """Calls, successes, failures and failure percentage per step with the prefix, most failures first."""
    failed = F.count_if(F.col("level").isin("ERROR", "WARN"))
    return (
        log.filter(F.col("step").startswith(prefix) & _since(as_of, days))
        .groupBy("step")
        .agg(
            F.count(F.lit(1)).alias("n_calls"),
            F.count_if(F.col("level").isin("SUCCESS", "INFO")).alias("n_ok"),
            failed.alias("n_failed"),
            F.round(failed * 100.0 / F.count(F.lit(1)), 1).alias("error_pct"),
        )
        .orderBy(F.col("n_failed").desc(), "step")
    )


def daily_volume(log: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """Affected rows, notebooks and errors per day, newest first."""
    return (
        log.filter(F.col("affected").isNotNull() & _since(as_of, days))
        .groupBy(F.to_date("ts").alias("day"))
        .agg(
            F.sum("affected").alias("n_affected"),
            F.countDistinct("notebook").alias("n_notebooks"),
            F.count_if(F.col("level") == "ERROR").alias("n_errors"),
        )
        .orderBy(F.col("day").desc())
    )


def connection_errors(log: DataFrame, steps=V.CONNECTION_STEPS, n: int = 30) -> DataFrame:
    """Newest rows of the given steps."""
    return log.filter(F.col("step").isin(steps)).orderBy(F.col("ts").desc(), F.col("log_id").desc()).limit(n)


def summary(status: DataFrame, by: str = "table_name", rows: str = "n_rows", ts: str = "ts") -> DataFrame:
    """Rows, first and last write and minutes per table of a run, with a total line."""
    line = [
        F.sum(rows).alias("n_rows"),
        F.min(ts).alias("started"),
        F.max(ts).alias("ended"),
    ]
    minutes = (F.unix_timestamp(F.col("ended").cast("timestamp")) - F.unix_timestamp(F.col("started").cast("timestamp"))) / 60
    per_table = status.groupBy(by).agg(*line)
    total = per_table.agg(F.sum("n_rows").alias("n_rows"), F.min("started").alias("started"), F.max("ended").alias("ended"))
    return per_table.unionByName(total.withColumn(by, F.lit("TOTAL"))).withColumn("minutes", minutes)


def severity_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
