"""Loads that continue where they stopped: units of work in steps, and a ledger line for every finished step."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import tables

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("n_units", T.LongType()),
        T.StructField("units_digest", T.LongType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("finished_at", T.TimestampType()),
    ]
)


def planned_steps(units: DataFrame, step: str) -> DataFrame:
    """Steps of a plan with the number and an order-free digest of their units, so that a changed plan is told apart; a null is no step."""
    others = sorted(c for c in units.columns if c != step)
    return units.filter(F.col(step).isNotNull()).groupBy(step).agg(F.count(F.lit(1)).alias("n_units"), F.bit_xor(F.xxhash64(*others)).alias("units_digest"))


def ledger(spark: SparkSession, path: str, step: T.StructField) -> DataFrame:
    """The finished steps of the load at `path`; empty before the first."""
    schema = T.StructType([*LEDGER_SCHEMA.fields, step])
    files, target = tables._files(spark, f"{path}/ledger")
    return spark.read.schema(schema).parquet(f"{path}/ledger") if files.exists(target) else spark.createDataFrame([], schema)


def missing_steps(units: DataFrame, path: str, step: str) -> DataFrame:
    """Planned steps that are not finished, or were finished for other units."""
    done = ledger(units.sparkSession, path, units.schema[step]).select(step, "n_units", "units_digest")
    return planned_steps(units, step).join(done, [step, "n_units", "units_digest"], "left_anti")


def load(
    units: DataFrame, step: str, fetch: Callable[[DataFrame], DataFrame], path: str, at_once: int = 12, stop_after: int | None = None
) -> int:
    """Load the steps of the plan `units` that are not finished yet; the number of steps loaded.

    `fetch` gives the rows of some units, with their step. Up to `at_once` steps go in one job: their
    partitions of rows replace whatever an earlier attempt left, and only then do they get their ledger
    lines, so a run that stops anywhere loses the work of one job at most and leaves no rows twice. A step
    whose units have changed since is loaded again. `stop_after` ends the run after so many jobs.
    """
    spark = units.sparkSession
    todo = missing_steps(units, path, step).orderBy(step)
    # a step is a month, a day or a list of thousands of units: the steps themselves are few
    names = [row[step] for row in todo.select(step).collect()]
    jobs = [names[at : at + at_once] for at in range(0, len(names), at_once)][:stop_after]
    for some in jobs:
        chosen = units.filter(F.col(step).isin(some))
        rows = fetch(chosen)
        _clear(spark, path, step, some)
        tables.write_table(rows, f"{path}/rows", "overwrite", [step])
        finish(chosen, rows.schema, path, step, some)
    return sum(map(len, jobs))


def _clear(spark: SparkSession, path: str, step: str, some: list) -> None:
    """Remove what an unfinished attempt left of steps that may have no rows any more."""
    escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for name in some:
        files, old = tables._files(spark, f"{path}/rows/{step}={escaped(str(name))}")
        files.delete(old, True)


def finish(units: DataFrame, schema: T.StructType, path: str, step: str, some: list) -> None:
    """Write the ledger lines of steps whose rows are written, counted as they lie there."""
    spark = units.sparkSession
    files, target = tables._files(spark, f"{path}/rows")
    rows = spark.read.schema(schema).parquet(f"{path}/rows") if files.exists(target) else spark.createDataFrame([], schema)
    counted = rows.filter(F.col(step).isin(some)).groupBy(step).agg(F.count(F.lit(1)).alias("n_rows"))
    lines = planned_steps(units, step).join(counted, step, "left").fillna(0, ["n_rows"])
    lines = lines.select("n_units", "units_digest", "n_rows", F.current_timestamp().alias("finished_at"), step)
    tables.write_table(lines.coalesce(1), f"{path}/ledger", "overwrite", [step])


def finished_rows(spark: SparkSession, path: str, schema: T.StructType, step: str) -> DataFrame:
    """Rows of the finished steps; what an unfinished attempt has written is not read."""
    done = ledger(spark, path, schema[step]).select(step)
    files, target = tables._files(spark, f"{path}/rows")
    rows = spark.read.schema(schema).parquet(f"{path}/rows") if files.exists(target) else spark.createDataFrame([], schema)
    return rows.join(done, step, "left_semi")
