"""Tables written once to the shared folder: they cut lineage and make a size known before it is relied on."""

import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_local_roots = {}
_run_folders = set()


def shared_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only for a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="medalytics-")
    return _local_roots[context.applicationId]


def new_path(spark: SparkSession, tag: str) -> str:
    """A path in the run's own part of the shared folder, which goes when the driver ends."""
    run = f"{shared_root(spark)}/medalytics-{spark.sparkContext.applicationId}"
    if run not in _run_folders:
        target = spark._jvm.org.apache.hadoop.fs.Path(run)
        files = target.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(target)
        files.deleteOnExit(target)
        _run_folders.add(run)
    return f"{run}/{tag}-{uuid.uuid4().hex}"


def row_bytes(schema: T.StructType):
    """Upper estimate of a row's size in memory, as a column."""
    total = F.lit(16)
    for field in schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(field.name), F.lit(0)) + F.lit(16)
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            text = F.to_json(F.struct(F.col(field.name)))
            total = total + F.coalesce(F.length(text), F.lit(0)) * 4
        else:
            total = total + F.lit(16)
    return total.cast("bigint")


@dataclass(frozen=True)
class Stored:
    """Rows whose number and size are known."""

    df: DataFrame
    rows: int
    bytes: int


def store(df: DataFrame, tag: str = "table") -> Stored:
    """Write `df` to the shared folder and read it back with its row count and size.

    Both are counted while writing; work that Spark repeats can only make them larger, so a size
    found small enough is small enough.
    """
    spark = df.sparkSession
    path = new_path(spark, tag)
    seen = Observation()
    size = [F.count(F.lit(1)).alias("n"), F.sum(row_bytes(df.schema)).alias("b")]
    df.observe(seen, *size).write.parquet(path)
    found = seen.get
    return Stored(spark.read.schema(df.schema).parquet(path), found.get("n") or 0, found.get("b") or 0)
