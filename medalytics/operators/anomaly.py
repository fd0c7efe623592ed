"""Grouped z-scores, entity ranking, reports and top-k."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import fixed_values as V
from ..functions.skew import join_lookup


def zscore(
    df: DataFrame, value: str, by: list[str], tiers=V.SEVERITY_TIERS, two_sided: bool = False
) -> DataFrame:
    """Add the group's mean and deviation, the z-score, the anomaly flag and the severity.

    A group of one row has deviation 1, a group without spread z = 0. The group values are joined
    back instead of taken over a window, so one large group does not end up in one task.
    """
    number = F.col(value).cast("double")
    stats = df.groupBy(*by).agg(
        F.avg(number).alias("group_mean"), F.coalesce(F.stddev_samp(number), F.lit(1.0)).alias("group_stddev")
    )
    return scored_by(df, stats, value, by, tiers, two_sided)


def scored_by(df: DataFrame, stats: DataFrame, value: str, by: list[str], tiers=V.SEVERITY_TIERS, two_sided: bool = False) -> DataFrame:
    """Rows scored by the mean and deviation of their group in `stats`."""
    number = F.col(value).cast("double")
    z = F.when(F.col("group_stddev") > 0, (number - F.col("group_mean")) / F.col("group_stddev")).otherwise(0.0)
    size = F.abs("z_score") if two_sided else F.col("z_score")
    return (
        join_lookup(df, stats, by)
        .withColumn("z_score", z)
        .withColumn("is_anomaly", F.coalesce(size > min(limit for limit, _ in tiers), F.lit(False)))
        .withColumn("severity", C.by_threshold(size, tiers, V.SEVERITY_DEFAULT))
    )


def anomalies(scored: DataFrame) -> DataFrame:
    """Only the anomalies, the most extreme first."""
    return scored.filter("is_anomaly").orderBy(F.col("z_score").desc())


def rank_entities(
    df: DataFrame,
    entity: str,
    value: str,
    member: str,
    name: str | None = None,
    many_members: int = V.SUPPLIER_FLAGS["many_members"],
    high_value: float = V.SUPPLIER_FLAGS["high_value"],
    id_pattern: str = V.SUPPLIER_FLAGS["id_pattern"],
    id_total: float = V.SUPPLIER_FLAGS["id_total"],
    split_by_name: bool = False,
) -> DataFrame:
    """Totals per entity with three warning flags and their number, largest total first.

    Values are summed per entity, member and name first, all of it in hash aggregates; members are then
    counted as rows and the greatest name is taken from few rows.
    """
    keys = [entity, name] if name and split_by_name else [entity]
    text = F.col(entity).cast("string")
    finest = list(dict.fromkeys([*keys, member, *([name] if name else [])]))
    small = (
        df.filter(text.isNotNull() & (text != ""))
        .groupBy(*finest)
        .agg(F.sum(value).alias("__sum"), F.count(F.lit(1)).alias("__rows"), F.count(value).alias("__values"), F.max(value).alias("__max"))
    )
    per_member = small.groupBy(*dict.fromkeys([*keys, member])).agg(
        F.sum("__sum").alias("__sum"), F.sum("__rows").alias("__rows"), F.sum("__values").alias("__values"), F.max("__max").alias("__max")
    )
    totals = per_member.groupBy(*keys).agg(
        F.sum("__sum").alias("total_value"),
        F.sum("__rows").alias("n_documents"),
        (F.sum("__sum").cast("double") / F.sum("__values")).alias("mean_value"),
        F.max("__max").alias("max_value"),
        F.count(member).alias("n_members"),
    )
    if name and not split_by_name:
        totals = totals.join(small.groupBy(entity).agg(F.max(name).alias(name)), entity)
    return flagged(totals, entity, keys, many_members, high_value, id_pattern, id_total)


def flagged(
    totals: DataFrame,
    entity: str,
    keys: list[str],
    many_members: int = V.SUPPLIER_FLAGS["many_members"],
    high_value: float = V.SUPPLIER_FLAGS["high_value"],
    id_pattern: str = V.SUPPLIER_FLAGS["id_pattern"],
    id_total: float = V.SUPPLIER_FLAGS["id_total"],
) -> DataFrame:
    """Totals per entity with the three warning flags and their number, largest total first."""
    flags = {
        "flag_many_members": F.col("n_members") > many_members,
        "flag_high_value": F.col("max_value") > high_value,
        "flag_person_total": F.col(entity).cast("string").rlike(id_pattern) & (F.col("total_value") > id_total),
    }
    return (
        totals.withColumns(flags)
        .withColumn("n_flags", sum((F.col(f).cast("int") for f in flags), F.lit(0)))
        .orderBy(F.col("total_value").desc(), *keys)
    )


def report(df: DataFrame, by: list[str], value: str, member: str) -> DataFrame:
    """Total, rows, mean and distinct members per group."""
    return (
        df.groupBy(*by)
        .agg(
            F.sum(value).alias("total_value"),
            F.count(F.lit(1)).alias("n_rows"),
            (F.sum(value).cast("double") / F.count(value)).alias("mean_value"),
            F.countDistinct(member).alias("n_members"),
        )
        .orderBy(*by[:-1], F.col("total_value").desc(), by[-1])
    )


def top_k(df: DataFrame, order: list, k: int, by: list[str] | None = None) -> DataFrame:
    """First k rows of the whole set, or of every group with their rank.

    Both forms cut to k rows inside each task before anything is moved.
    """
    if not by:
        return df.orderBy(*order).limit(k)
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("rank", place).filter(F.col("rank") <= k)


def counts(df: DataFrame, by: list[str], k: int | None = None) -> DataFrame:
    """Rows per group, most frequent first; only the first k groups if asked."""
    found = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), *by)
    return found.limit(k) if k else found
