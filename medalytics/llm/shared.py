"""Helpers of the operators: reading tables, and tables staged in the shared folder."""

from pyspark.sql import DataFrame, SparkSession

from medalytics.functions.scratch import new_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a staged table that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def stage(df: DataFrame, tag: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: cuts lineage and survives lost executors.

    The run's folder goes when the driver ends.
    """
    return stage_at(df, tag)[0]


def stage_at(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """As `stage`, with the path, for tables that are removed before the driver ends."""
    path = new_path(df.sparkSession, f"llm-{tag}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path
