"""Gold values kept as mergeable states: an increment adds its own part, and the whole is put together from the parts.

A state is a table of parts, one per increment, each in its own partition. So an increment that is loaded
again replaces its part, and no group is read or written that the increment does not have.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.ordered import running_total_by
from ..functions.skew import join_lookup
from ..sources import tables
from . import anomaly

PART = "_part"


def add(part: DataFrame, path: str, increment: str) -> int:
    """Store the part of an increment; a repeated increment replaces its part. The number of its groups."""
    return tables.write_table(part.withColumn(PART, F.lit(increment)), path, "overwrite", [PART])


def parts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(PART)


def fold(spark: SparkSession, path: str, merged: DataFrame, increment: str = "folded") -> int:
    """Replace all parts by one, the state put together from them, so that reading stays cheap."""
    staged = f"{path.rstrip('/')}__folded"
    rows = add(merged, staged, increment)
    tables.switch(spark, staged, path)
    return rows


# count, mean and squared deviations ---------------------------------------------------------------


def moments(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Per group the number of values, their mean and the sum of squares about it; nulls do not count."""
    number = F.col(value).cast("double")
    found = df.groupBy(*by).agg(F.count(number).alias("n"), F.avg(number).alias("mean"), F.var_pop(number).alias("variance"))
    return found.select(*by, "n", "mean", (F.col("variance") * F.col("n")).alias("squares"))


def merge_moments(states: DataFrame, by: list[str]) -> DataFrame:
    """One state per group out of several, each pair as exact as the sums of its values would be.

    Squares are moved from the mean of a part to that of the whole, not taken as a difference of large sums.
    There are as many parts of a group as increments since the last `fold`.
    """
    part = F.struct("n", "mean", "squares")
    listed = states.filter("n > 0").groupBy(*by).agg(F.array_sort(F.collect_list(part)).alias("parts"))

    def joined(a, b):
        n = a["n"] + b["n"]
        apart = b["mean"] - a["mean"]
        squares = a["squares"] + b["squares"] + apart * apart * a["n"] * b["n"] / n
        return F.struct(n.alias("n"), (a["mean"] + apart * b["n"] / n).alias("mean"), squares.alias("squares"))

    rest = F.slice("parts", 2, F.greatest(F.size("parts") - 1, F.lit(1)))
    whole = F.when(F.size("parts") == 1, F.col("parts")[0]).otherwise(F.aggregate(rest, F.col("parts")[0], joined))
    groups = states.select(*by).distinct()
    merged = listed.select(*by, whole.alias("whole")).select(*by, "whole.*")
    empty = groups.join(listed.select(*by), [groups[c].eqNullSafe(listed[c]) for c in by], "left_anti")
    return merged.unionByName(empty.select(*by, F.lit(0).cast("long").alias("n")), allowMissingColumns=True)


def zscore(df: DataFrame, state: DataFrame, value: str, by: list[str], tiers=V.SEVERITY_TIERS) -> DataFrame:
    """Rows scored by a state of `moments`, as `anomaly.zscore` scores them by their own groups.

    So new rows are scored against all rows there have been, without reading those again.
    """
    deviation = F.when(F.col("n") > 1, F.sqrt(F.col("squares") / (F.col("n") - 1))).otherwise(1.0)
    stats = state.select(*by, F.col("mean").alias("group_mean"), deviation.alias("group_stddev"))
    return anomaly.scored_by(df, stats, value, by, tiers)


# totals with distinct members ---------------------------------------------------------------------


def totals(df: DataFrame, by: list[str], member: str, value: str, name: str | None = None) -> DataFrame:
    """Per group and member the sum, rows, values and greatest value, and the greatest `name`; members stay apart, so they can be counted."""
    found = [F.sum(value).alias("sum"), F.count(F.lit(1)).alias("rows"), F.count(value).alias("values"), F.max(value).alias("greatest")]
    found += [F.max(name).alias(name)] if name else []
    return df.groupBy(*by, member).agg(*found)


def merge_totals(states: DataFrame, by: list[str], member: str, name: str | None = None) -> DataFrame:
    """One line per group and member out of several."""
    found = [F.sum(c).alias(c) for c in ("sum", "rows", "values")] + [F.max("greatest").alias("greatest")]
    found += [F.max(name).alias(name)] if name else []
    return states.groupBy(*by, member).agg(*found)


def ranking(state: DataFrame, entity: str, member: str, name: str, **limits) -> DataFrame:
    """The ranking of `anomaly.rank_entities` out of a state of `totals`."""
    per_entity = state.filter(F.col(entity).isNotNull() & (F.col(entity).cast("string") != "")).groupBy(entity).agg(
        F.sum("sum").alias("total_value"),
        F.sum("rows").alias("n_documents"),
        (F.sum("sum").cast("double") / F.sum("values")).alias("mean_value"),
        F.max("greatest").alias("max_value"),
        F.count(member).alias("n_members"),
        F.max(name).alias(name),
    )
    return anomaly.flagged(per_entity, entity, [entity], **limits)


def report(state: DataFrame, by: list[str], member: str) -> DataFrame:
    """The report of `anomaly.report` out of a state of `totals`."""
    return state.groupBy(*by).agg(
        F.sum("sum").alias("total_value"),
        F.sum("rows").alias("n_rows"),
        (F.sum("sum").cast("double") / F.sum("values")).alias("mean_value"),
        F.count(member).alias("n_members"),
    )


# exact medians ------------------------------------------------------------------------------------


def medians(df: DataFrame, value: str, by: list[str], parts: int | None = None) -> DataFrame:
    """(by, median, n): the exact median per group, the mean of the two middle values of an even number; nulls do not count.

    Equal values of a group are counted first; running counts over ranges of (group, value) then tell which
    values stand in the middle, so a group with most of the rows is spread over as many tasks as it needs.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("__value")).agg(F.count(F.lit(1)).alias("__n"))
    placed = running_total_by(counts, by, ["__value"], {"__upto": F.col("__n")}, parts)
    sizes = placed.groupBy(*by).agg(F.sum("__n").alias("n"))
    met = join_lookup(placed, sizes, by, "inner")
    low, high = F.floor((F.col("n") + 1) / 2), F.floor(F.col("n") / 2) + 1
    before = F.col("__upto") - F.col("__n")

    def at(place):
        return F.max(F.when((before < place) & (F.col("__upto") >= place), F.col("__value").cast("double")))

    return met.groupBy(*by).agg(((at(low) + at(high)) / 2).alias("median"), F.max("n").alias("n"))


def above_median(df: DataFrame, entity: str, category: str, value: str, factor: float = 2.0) -> DataFrame:
    """Entities whose mean in a category is over `factor` times the category's median, per entity and category with both values."""
    means = df.groupBy(entity, category).agg((F.sum(value).cast("double") / F.count(value)).alias("mean_value"), F.count(value).alias("n_documents"))
    middle = medians(df, value, [category]).select(category, F.col("median").alias("category_median"))
    above = F.coalesce(F.col("mean_value") > F.col("category_median") * F.lit(factor), F.lit(False))
    return join_lookup(means, middle, [category]).withColumn("is_above_median", above)

