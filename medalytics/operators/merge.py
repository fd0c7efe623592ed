"""Upserts and change capture, as joins."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(target: DataFrame | None, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target after source rows replace the rows with their key and add the rest.

    Columns are those of both: a replaced row keeps the target's value in columns that the source lacks,
    and rows without a value for a new column have null there. A null key never matches. A key that
    occurs twice in the source raises a ValueError, as it is not clear which row should win. Without a
    target the source is the result.
    """
    reject_repeated(source, keys)
    if target is None:
        return source
    only_old = [c for c in target.columns if c not in source.columns]
    if only_old:
        source = source.join(target.dropna(subset=keys).select(*keys, *only_old), keys, "left")
    kept = target.join(source.select(*keys), keys, "left_anti")
    merged = kept.unionByName(source, allowMissingColumns=True)
    return merged.select(*target.columns, *[c for c in merged.columns if c not in target.columns])


def reject_repeated(source: DataFrame, keys: list[str]) -> None:
    """Raise a ValueError for a key without nulls that occurs more than once."""
    repeated = source.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").first()
    if repeated:
        raise ValueError(f"the source has {repeated['n']} rows for one key: {repeated.asDict()}")


def cdc_classify(target: DataFrame, source: DataFrame, keys: list[str], hash_col: str) -> DataFrame:
    """INSERT, UPDATE, UNCHANGED or ABSENT for every key of either side, by payload hash."""
    old = target.select(*keys, F.col(hash_col).alias("old_hash"), F.lit(True).alias("__old"))
    new = source.select(*keys, F.col(hash_col).alias("new_hash"), F.lit(True).alias("__new"))
    change = (
        F.when(F.col("__old").isNull(), "INSERT")
        .when(F.col("__new").isNull(), "ABSENT")
        .when(F.col("old_hash").eqNullSafe(F.col("new_hash")), "UNCHANGED")
        .otherwise("UPDATE")
    )
    return old.join(new, keys, "outer").withColumn("change", change).drop("__old", "__new")


def upsert_changed(target: DataFrame, source: DataFrame, keys: list[str], hash_col: str) -> DataFrame:
    """Upsert that leaves rows with an equal payload hash as they are."""
    same = target.select(*keys, F.col(hash_col).alias("__same"))
    on = [source[k] == same[k] for k in keys] + [source[hash_col].eqNullSafe(same["__same"])]
    return upsert(target, source.join(same, reduce(lambda a, b: a & b, on), "left_anti"), keys)


def concat_batches(batches: list[DataFrame]) -> DataFrame:
    """One table out of batches whose columns may differ; missing values are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)
