"""Joins that stay balanced when a key holds a large share of the rows.

What is hot is relative: with P shuffle partitions, a key is hot if more than 1/(4 P) of all rows come
together under it. So there are fewer than 4 P hot keys whatever the size of the data, and each is spread
over as many salts as its own rows need.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Stored, store

BROADCAST_BYTES = 32 << 20
HOT_SHARE = 4


def salt(columns, n) -> Column:
    """A salt in [0, n). The partition number is mixed in so that equal rows spread as well."""
    mixed = F.xxhash64(*columns).bitwiseXOR(F.xxhash64(F.spark_partition_id()))
    return F.pmod(mixed, n if isinstance(n, Column) else F.lit(n)).cast("int")


def join_lookup(
    facts: DataFrame,
    lookup: DataFrame | Stored,
    on: list[str],
    how: str = "left",
    max_broadcast_bytes: int = BROADCAST_BYTES,
    parts: int | None = None,
) -> DataFrame:
    """Join `facts` (left or inner) with the few rows per key of `lookup`; null keys equal each other.

    The lookup is computed once and written, so its size is known: up to the limit it is broadcast
    and the facts are not shuffled, beyond it both sides are shuffled and hot keys are spread.
    """
    stored = lookup if isinstance(lookup, Stored) else store(lookup, "lookup")
    if stored.bytes <= max_broadcast_bytes:
        return _join(facts, stored.df, on, how, null_safe=True, broadcast=True)
    counts = facts.groupBy(*on).agg(F.count(F.lit(1)).alias("__left"))
    hot = hot_keys(counts.select(*on, "__left", F.lit(0).alias("__right"), F.col("__left").alias("__out")), parts)
    return _join_spread(facts, stored.df, on, how, True, hot)


def join_hot(facts: DataFrame, other: DataFrame, on: list[str], parts: int | None = None) -> DataFrame:
    """Inner join of many rows with many rows, with hot keys spread; null keys match nothing.

    A size-based split at run time sees the rows that go into a join; where a key meets many rows on
    both sides it is the rows that come out, the product of both counts, that overload a task. A hot
    key's larger side is salted and its smaller side repeated.
    """
    left = facts.dropna(subset=on).groupBy(*on).agg(F.count(F.lit(1)).alias("__left"))
    right = other.dropna(subset=on).groupBy(*on).agg(F.count(F.lit(1)).alias("__right"))
    counts = left.join(right, on).withColumn("__out", F.col("__left") * F.col("__right"))
    return _join_spread(facts, other, on, "inner", False, hot_keys(counts, parts))


def hot_keys(counts: DataFrame, parts: int | None = None) -> Stored:
    """Hot keys of a table of counts per key, with the number of salts of each and the side to salt."""
    parts = parts or int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = store(counts, "key-counts").df
    total = counts.agg(F.sum("__out")).first()[0] or 0
    salts = F.ceil(F.col("__out") * F.lit(float(2 * parts)) / F.lit(float(max(total, 1)))).cast("int")
    hot = counts.filter(F.col("__out") * F.lit(float(HOT_SHARE * parts)) > F.lit(float(total))).filter(F.greatest("__left", "__right") > 1)
    keys = [c for c in counts.columns if c not in ("__left", "__right", "__out")]
    larger = F.greatest("__left", "__right").cast("int")
    return store(hot.select(*keys, F.least(salts, larger).alias("__salts"), (F.col("__left") >= F.col("__right")).alias("__salt_left")), "hot")


def _join(left, right, on, how, null_safe, broadcast=False):
    right = right.withColumnsRenamed({k: f"__key_{k}" for k in on})
    names = [(F.col(k), F.col(f"__key_{k}")) for k in on]
    same = reduce(lambda a, b: a & b, [a.eqNullSafe(b) if null_safe else a == b for a, b in names])
    return left.join(F.broadcast(right) if broadcast else right, same, how).drop(*[f"__key_{k}" for k in on])


def _join_spread(facts, other, on, how, null_safe, hot):
    """Salt one side of every hot key and repeat only this key's rows of the other."""
    if not hot.rows:
        return _join(facts, other, on, how, null_safe)

    def spread(df, salted):
        # fewer than 4 P rows are broadcast
        marked = _join(df, hot.df, on, "left", null_safe=True, broadcast=True)
        own = F.array(salt(df.columns, F.col("__salts")))
        every = F.sequence(F.lit(0), F.col("__salts") - 1)
        chosen = F.when(F.col("__salts").isNull(), F.array(F.lit(0))).when(salted, own).otherwise(every)
        return marked.withColumn("__salt", F.explode(chosen)).drop("__salts", "__salt_left")

    left, right = spread(facts, F.col("__salt_left")), spread(other, ~F.col("__salt_left"))
    return _join(left, right, [*on, "__salt"], how, null_safe).drop("__salt")
