"""Watermarks, incremental filters, period plans, missing children."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.skew import join_lookup
from .merge import upsert

CONTROL_SCHEMA = T.StructType(
    [
        T.StructField("endpoint", T.StringType()),
        T.StructField("last_value", T.StringType()),
        T.StructField("updated_at", T.StringType()),
    ]
)


def watermark_row(control: DataFrame, name: str, default: str | None = None) -> DataFrame:
    """One row with the last value of an endpoint, or the default on a first run."""
    last = F.max(F.when(F.col("endpoint") == name, F.nullif(F.col("last_value"), F.lit(""))))
    return control.filter(F.col("endpoint") == name).agg(
        F.lit(name).alias("endpoint"), F.coalesce(last, F.lit(default).cast("string")).alias("last_value")
    )


def watermark_get(control: DataFrame, name: str, default: str | None = None) -> str | None:
    """The last value itself; it is one row, so it may go to the driver."""
    return watermark_row(control, name, default).first()["last_value"]


def watermark_set(control: DataFrame, name: str, value=None, last_date=None, last_id=None, now: str | None = None) -> DataFrame:
    """Control table with a new value for an endpoint: the first given of value, date and id."""
    given = next((str(v) for v in (value, last_date, last_id) if v is not None), None)
    stamp = F.lit(now) if now else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    row = control.sparkSession.range(1).select(
        F.lit(name).alias("endpoint"), F.lit(given).cast("string").alias("last_value"), stamp.alias("updated_at")
    )
    return upsert(control, row, ["endpoint"])


def watermark_merge(control: DataFrame, observed: DataFrame) -> DataFrame:
    """Control table after a run that observed (endpoint, last_value, updated_at) rows."""
    return upsert(control, observed, ["endpoint"])


def watermark_max(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Greatest observed value per endpoint, compared by its type and not as text."""
    return df.groupBy(*by).agg(F.max(value).alias("last_value"))


def newer_than(df: DataFrame, column: str, value) -> DataFrame:
    """Rows after a watermark; everything on a first run. The filter reaches the file scan."""
    if value is None:
        return df
    return df.filter(F.col(column) > F.lit(value).cast(df.schema[column].dataType))


def newer_than_each(df: DataFrame, marks: DataFrame, by: str, column: str, value: str = "last_value") -> DataFrame:
    """Rows after the watermark of their own endpoint; endpoints without one are new and kept."""
    marks = marks.select(by, F.col(value).cast(df.schema[column].dataType).alias("__mark"))
    return (
        join_lookup(df, marks, [by])
        .filter(F.col("__mark").isNull() | (F.col(column) > F.col("__mark")))
        .drop("__mark")
    )


def period_plan(spark: SparkSession, last: str | None, end: str, first: str) -> DataFrame:
    """Months after the watermark `last` (YYYY-MM) up to `end`; from `first` on a first run."""
    start = F.add_months(F.to_date(F.lit(f"{last}-01")), 1) if last else F.to_date(F.lit(f"{first}-01"))
    stop = F.to_date(F.lit(f"{end}-01"))
    months = F.when(start <= stop, F.sequence(start, stop, F.expr("interval 1 month")))
    return spark.range(1).select(F.explode(months).alias("month")).select(
        F.year("month").alias("year"), F.month("month").alias("month")
    )


def period_plan_each(marks: DataFrame, by: str, last: str, end: str) -> DataFrame:
    """Months after the last month (a date) of every entity, up to `end` (YYYY-MM)."""
    start = F.add_months(F.trunc(last, "month"), 1)
    stop = F.to_date(F.lit(f"{end}-01"))
    months = F.when(start <= stop, F.sequence(start, stop, F.expr("interval 1 month")))
    return marks.select(by, F.explode(months).alias("__m")).select(
        by, F.year("__m").alias("year"), F.month("__m").alias("month")
    )


def missing_children(parents: DataFrame, children: DataFrame, on: str) -> DataFrame:
    """Parents that have no child row yet, in key order."""
    return parents.join(children.select(on).distinct(), on, "left_anti").orderBy(on)


def is_full_load(spark: SparkSession, table: str, last_value) -> bool:
    """A run is full when the table is missing or no watermark was kept."""
    return last_value is None or not spark.catalog.tableExists(table)
