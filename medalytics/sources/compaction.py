"""Small files of a table joined into files of a target size; files that are large enough stay as they are."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ordered import running_total_by
from ..functions.scratch import store
from ..functions.skew import join_lookup
from . import tables

#: Where a compaction is prepared; readers skip folders that begin with an underscore.
JOURNAL = "_compaction"


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, folder, bytes) of the parquet files of a table, listed without reading them."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    found = listed.select(F.col("path").alias("file"), F.regexp_replace("path", "/[^/]*$", "").alias("folder"), F.col("length").alias("bytes"))
    return found.filter(~F.col("file").contains(f"/{JOURNAL}/"))


def packed(files: DataFrame, target_bytes: int, small_share: float = 0.75) -> DataFrame:
    """Files under `small_share` of the target, with the `bin` of their folder they go to; folders with one such file are left out.

    Bins are runs of files in the order of their size. A file goes to the bin where the files before it end, so
    a bin holds at most the target and one small file more, and all but the last of a folder half of the target
    at least. The running sizes are segmented, so a folder with most of the files is no single task.
    """
    small = files.filter(F.col("bytes") < F.lit(int(target_bytes * small_share)))
    run = running_total_by(small, ["folder"], ["bytes", "file"], {"upto": F.col("bytes")})
    binned = run.withColumn("bin", F.floor((F.col("upto") - F.col("bytes")) / F.lit(target_bytes))).drop("upto")
    counts = binned.groupBy("folder", "bin").agg(F.count(F.lit(1)).alias("n_files"))
    return join_lookup(binned, counts, ["folder", "bin"], "inner").filter("n_files > 1").drop("n_files")


def compact(
    spark: SparkSession, path: str, target_bytes: int = 256 << 20, small_share: float = 0.75, sort_by: list[str] | None = None
) -> dict:
    """Join the small files of the table at `path` in place; how many files went and how many came. Files without rows stay.

    Each bin is read and written by one task, sorted by `sort_by` if given. The new files and the list of the old
    ones are prepared aside; then a marker is set, old files go and new ones are moved in. A run that stops
    before the marker has changed nothing, one that stops after it is completed by the next (see `complete`).
    Nothing else may write, and a reader may miss rows, while files are exchanged.
    """
    complete(spark, path)
    journal = f"{path.rstrip('/')}/{JOURNAL}"
    base = spark.read.parquet(path)
    columns = base.columns
    # the files' sizes and paths are known to the scan, so large files are not opened, and files are named as it names them
    rows = base.select(*columns, F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_size").alias("__size"))
    rows = rows.filter(F.col("__size") < int(target_bytes * small_share))
    small = rows.groupBy(F.col("__file").alias("file"), F.col("__size").alias("bytes")).agg(F.count(F.lit(1)).alias("n")).drop("n")
    small = small.withColumn("folder", F.regexp_replace("file", "/[^/]*$", ""))
    bins = store(packed(small, target_bytes, small_share), "bins")
    if not bins.rows:
        return {"removed": 0, "added": 0}
    named = bins.df.select(F.col("file").alias("__file"), F.sha1(F.concat_ws("|", "folder", F.col("bin").cast("string"))).alias("__bin"), "folder")
    met = join_lookup(rows, store(named.select("__file", "__bin"), "named-bins"), ["__file"], "inner").drop("__file", "__size")
    count = bins.df.select("folder", "bin").distinct().count()
    met = met.repartition(count, "__bin").sortWithinPartitions("__bin", *(sort_by or []))
    partitions = [c for c in columns if c in _partition_columns(spark, path)]
    met.drop(*partitions).write.partitionBy("__bin").parquet(f"{journal}/new")
    named.select("__bin", "folder").distinct().write.parquet(f"{journal}/places")
    bins.df.select("file").write.parquet(f"{journal}/old")
    files, marker = tables._files(spark, f"{journal}/READY")
    files.create(marker).close()
    complete(spark, path)
    return {"removed": bins.rows, "added": count}


def _partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Columns that stand in the paths of the files and not in the files."""
    one = data_files(spark, path).first()["file"]
    inside = one.split(path.rstrip("/").rsplit("/", 1)[-1] + "/", 1)[-1]
    return [part.split("=", 1)[0] for part in inside.split("/")[:-1] if "=" in part]


def _named(spark: SparkSession, uri: str):
    """The path that a scan gives as a URI, in which signs of partition values are encoded."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))


def complete(spark: SparkSession, path: str) -> None:
    """Finish a compaction that has its marker, and forget one that has not."""
    journal = f"{path.rstrip('/')}/{JOURNAL}"
    files, marker = tables._files(spark, f"{journal}/READY")
    if files.exists(marker):
        for row in spark.read.parquet(f"{journal}/old").toLocalIterator():
            files.delete(_named(spark, row["file"]), False)
        for row in spark.read.parquet(f"{journal}/places").toLocalIterator():
            staged = tables._files(spark, f"{journal}/new/__bin={row['__bin']}")[1]
            for made in files.listStatus(staged) if files.exists(staged) else []:
                if made.getPath().getName().endswith(".parquet"):
                    files.rename(made.getPath(), _named(spark, f"{row['folder']}/compact-{uuid.uuid4().hex}.parquet"))
    files.delete(tables._files(spark, journal)[1], True)
