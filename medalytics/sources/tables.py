"""Tables of the layers: reading with a fallback, writing, upserting, compacting."""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from ..functions.scratch import new_path
from ..operators.incremental import CONTROL_SCHEMA
from ..operators.ingest import with_audit
from ..operators.merge import reject_repeated, upsert
from ..operators.quality import Expectation, split_rejected
from ..operators.runlog import LOG_SCHEMA, log_rows


def first_available(spark: SparkSession, names: list[str]) -> DataFrame:
    """The first of several tables that exists."""
    for name in names:
        if spark.catalog.tableExists(name):
            return spark.table(name)
    raise ValueError(f"none of these tables exists: {', '.join(names)}")


def create_layers(spark: SparkSession, bronze: str = "bronze", silver: str = "silver", gold: str = "gold") -> None:
    """Databases of the three layers, and the control and log tables in bronze."""
    for name in (bronze, silver, gold):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    for table, schema in (("_control", CONTROL_SCHEMA), ("_run_log", LOG_SCHEMA)):
        if not spark.catalog.tableExists(f"{bronze}.{table}"):
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
            spark.sql(f"CREATE TABLE {bronze}.{table} ({columns}) USING parquet")


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None, gather: bool = True) -> int:
    """Write and return the number of rows, counted while they are written.

    With `partition_by`, overwrite replaces only the partitions that occur in `df`. Rows are gathered
    by partition before, with small partitions joined and large ones split again at run time, so there
    are neither many small files nor one task for a large partition. Without `gather` they are written
    from where they lie, which spares rows of a single partition the exchange.
    """
    counted = Observation()
    if partition_by and gather:
        df = df.hint("rebalance", *partition_by)
    writer = df.observe(counted, F.count(F.lit(1)).alias("n")).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return counted.get.get("n", 0)


def _rows(spark: SparkSession, path: str) -> int:
    try:
        return spark.read.parquet(path).count()
    except AnalysisException:
        return 0


def write_bronze(df: DataFrame, path: str, source: str, mode: str = "overwrite", partition_by=None, batch_id=None) -> int:
    """Raw rows with audit columns; an empty batch changes nothing."""
    if mode == "overwrite" and not partition_by and df.isEmpty():
        return 0
    return write_table(with_audit(df, source, batch_id), path, mode, partition_by)


def write_split(df: DataFrame, rules: list[Expectation], path: str, load: str = "first") -> DataFrame:
    """Write kept and rejected rows in one pass, each with the names of all rules it breaks; all rows of the table.

    Every load owns its partition, so a repeated load replaces itself. See `quarantined` and `replay_rejected`.
    """
    checked = split_rejected(df, rules).withColumn("_load", F.lit(load))
    write_table(checked, path, "overwrite", ["_load", "_rejected"])
    return df.sparkSession.read.schema(checked.schema).parquet(path)


def quarantined(spark: SparkSession, path: str, load: str) -> DataFrame:
    """The rejected rows of a load."""
    # a boolean in a path is read as text
    return spark.read.parquet(path).filter((F.col("_load") == load) & F.col("_rejected").cast("boolean"))


def replay_rejected(
    spark: SparkSession, path: str, load: str, fix: Callable[[DataFrame], DataFrame], rules: list[Expectation], into: str
) -> DataFrame:
    """Check the rejected rows of a load again after `fix`, as the load `into`; what is rejected now is the quarantine of `into`.

    The old quarantine stays as it was, so a replay can be repeated.
    """
    held = quarantined(spark, path, load).drop("_load", "_rejected", "_broken")
    return write_split(fix(held), rules, path, into)


def append_log(spark: SparkSession, path: str, lines: list[dict]) -> int:
    """Append the log lines of one run; missing fields are null, status follows from the level."""
    full = [{f.name: line.get(f.name) for f in LOG_SCHEMA.fields} for line in lines]
    return write_table(log_rows(spark.createDataFrame(full, LOG_SCHEMA)), path, "append")


def write_gold(df: DataFrame, path: str) -> int:
    """Full recompute of a gold table with its processing time."""
    return write_table(df.withColumn("_processed_at", F.current_timestamp()), path)


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
        return True
    except AnalysisException:
        return False


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def restore(spark: SparkSession, path: str) -> None:
    """Bring back the table at `path` if a run was lost between the two renames of a switch."""
    files, live = _files(spark, path)
    _, old = _files(spark, f"{path.rstrip('/')}__old")
    if files.exists(old):
        if files.exists(live):
            files.delete(old, True)
        else:
            files.rename(old, live)


def switch(spark: SparkSession, staged: str, path: str) -> None:
    """Put the finished table at `staged` in the place of the one at `path`, by renaming both."""
    restore(spark, path)
    files, live = _files(spark, path)
    _, old = _files(spark, f"{path.rstrip('/')}__old")
    _, new = _files(spark, staged)
    if files.exists(live):
        files.rename(live, old)
    if not files.rename(new, live):
        restore(spark, path)
        raise OSError(f"{staged} could not be moved to {path}")
    files.delete(old, True)


def upsert_path(spark: SparkSession, path: str, source: DataFrame, keys: list[str], partition_by: list[str] | None = None) -> int:
    """Upsert into the table at `path`, creating it if it is missing.

    The result is written beside the table and takes its place by renaming, so a failed run leaves the
    old table (see `restore`). With `partition_by`, which must be part of the key, only the partitions
    that occur in the source are written and replaced. Columns and repeated keys: see `merge.upsert`.
    Returns the number of rows of the table.
    """
    restore(spark, path)
    if not _exists(spark, path):
        reject_repeated(source, keys)
        return write_table(source, path, "overwrite", partition_by)
    target = spark.read.parquet(path)
    if partition_by:
        if not set(partition_by) <= set(keys):
            raise ValueError("partition columns must be part of the key")
        target = target.join(source.select(*partition_by).distinct(), partition_by, "left_semi")
    merged = upsert(target, source, keys)
    if not partition_by:
        staged = f"{path.rstrip('/')}__new-{uuid.uuid4().hex}"
        rows = write_table(merged, staged)
        switch(spark, staged, path)
        return rows
    staged = new_path(spark, "staged")
    merged.write.parquet(staged)
    write_table(spark.read.parquet(staged), path, "overwrite", partition_by)
    return _rows(spark, path)


def compact(spark: SparkSession, path: str, out: str, files: int, cluster_by: list[str]) -> DataFrame:
    """Rewrite a table into fewer files whose rows are ranged and sorted by `cluster_by`."""
    spark.read.parquet(path).repartitionByRange(files, *cluster_by).sortWithinPartitions(*cluster_by).write.mode(
        "overwrite"
    ).parquet(out)
    return spark.read.parquet(out)


def statistics(spark: SparkSession, table: str, columns: list[str] | None = None) -> None:
    """Size and row count of a table, and the spread of some columns for the planner."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
    if columns:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(f'`{c}`' for c in columns)}")


def sql_over(spark: SparkSession, text: str, args: dict | None = None, **frames: DataFrame) -> DataFrame:
    """SQL text over DataFrames named in braces, with values bound as parameters."""
    return spark.sql(text, args=args, **frames)


def run_step(name: str, step: Callable[[], DataFrame], path: str) -> dict:
    """Write the DataFrame of a step and return its line for the run summary."""
    return {"table_name": name, "n_rows": write_gold(step(), path)}
