"""Members and groups: concentration, memberships, overlap, cohesion."""

from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import running_total
from ..functions.scratch import store
from ..functions.skew import join_hot, join_lookup

BLOCK_GROUPS = 1000


def hhi(edges: DataFrame, group: str, part: str) -> DataFrame:
    """Herfindahl index of the parts of every group, number of parts and effective number.

    The sum of squared shares is the sum of squared counts over the squared total, both whole numbers,
    so neither a window nor a join is needed after the counts and the order of rows changes no digit.
    """
    squares, total = F.sum(F.col("n") * F.col("n")).cast("double"), F.sum("n").cast("double") * F.sum("n")
    return (
        edges.groupBy(group, part)
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(group)
        .agg(
            F.sum("n").alias("n_members"),
            (squares / total).alias("hhi"),
            F.count(part).alias("n_parts"),
            (total / squares).alias("effective_parts"),
        )
    )


def memberships(edges: DataFrame, member: str, group: str, label: str, page_size: int = 10_000) -> DataFrame:
    """Number of groups and sorted list of their labels per member.

    Lists are cut into pages by group number so that a member of very many groups never makes one
    huge row; with fewer than `page_size` groups there is one page. All labels are kept.
    """
    paged = (
        edges.select(member, group, label)
        .dropDuplicates([member, group])
        .groupBy(member, F.expr(f"`{group}` div {page_size}").alias("page"))
        .agg(F.array_sort(F.collect_list(label)).alias("labels"), F.count(group).alias("__n"))
    )
    totals = paged.groupBy(member).agg(F.sum("__n").alias("n_groups"))
    return paged.drop("__n").join(totals, member)


def overlap_pairs(edges: DataFrame, group: str, member: str, heavy_degree: int = 512) -> DataFrame:
    """Number of members shared by every pair of groups that shares at least one.

    Members of up to `heavy_degree` groups meet in a self-join, where each edge makes at most that
    many pairs. Members of more groups are numbered and packed 62 to a bit mask per group; a pair of
    masks then counts 62 members at once. The two counts add up to the exact result.
    """
    edges = store(edges.select(group, member).dropna().distinct(), "edges").df
    degrees = edges.groupBy(member).agg(F.count(F.lit(1)).alias("__degree"))
    heavy = store(degrees.filter(F.col("__degree") > heavy_degree).select(member), "heavy")
    if not heavy.rows:
        return _pairs(edges, group, member, F.count(F.lit(1)))
    numbered = running_total(heavy.df, [member], 1, "__no")
    marked = join_lookup(edges, numbered, [member])
    light_pairs = _pairs(marked.filter("__no IS NULL").select(group, member), group, member, F.count(F.lit(1)))
    bit = F.expr("shiftleft(1L, CAST((__no - 1) % 62 AS INT))")
    masks = (
        marked.filter("__no IS NOT NULL")
        .groupBy(group, F.expr("(__no - 1) div 62").alias("__chunk"))
        .agg(F.bit_or(bit).alias("__mask"))
    )
    both = F.bit_count(F.col("__mask").bitwiseAND(F.col("__other_mask"))).cast("bigint")
    # every chunk would hold the pairs of all groups; blocks of groups on both sides spread them
    blocks = F.lit(max(1, ceil(edges.select(group).distinct().count() / BLOCK_GROUPS)))
    own, every = F.pmod(F.xxhash64(group), blocks), F.explode(F.sequence(F.lit(0), blocks - 1))
    left = masks.withColumn("__left", own.cast("int")).withColumn("__right", every)
    right = masks.withColumn("__right", own.cast("int")).withColumn("__left", every)
    heavy_pairs = _pairs(left, group, ["__chunk", "__left", "__right"], F.sum(both), right).filter("shared > 0")
    merged = light_pairs.unionByName(heavy_pairs)
    return merged.groupBy(f"{group}_a", f"{group}_b").agg(F.sum("shared").alias("shared"))


def _pairs(side: DataFrame, group: str, on, shared, other: DataFrame | None = None) -> DataFrame:
    """Ordered pairs of groups that meet in `on`, summed before they are shuffled."""
    a, b = f"{group}_a", f"{group}_b"
    left = side.withColumnRenamed(group, a)
    right = (side if other is None else other).withColumnsRenamed({group: b, "__mask": "__other_mask"})
    return left.join(right, on).filter(F.col(a) < F.col(b)).groupBy(a, b).agg(shared.alias("shared"))


def majority(votes: DataFrame, group: str, session: str, choice: str) -> DataFrame:
    """Votes of the largest choice and of all choices per group and session; ties do not matter."""
    return (
        votes.groupBy(group, session, choice)
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(group, session)
        .agg(F.max("n").alias("majority_votes"), F.sum("n").alias("total_votes"))
    )


def votes_of_groups(votes: DataFrame, edges: DataFrame, member: str, group: str) -> DataFrame:
    """Every vote once per group of its member."""
    return join_hot(votes, edges.select(member, group), [member])


def cohesion(votes: DataFrame, group: str, session: str, choice: str) -> DataFrame:
    """Mean, least and greatest share of the majority over the sessions of every group."""
    share = F.col("majority_votes") / F.col("total_votes")
    return (
        majority(votes, group, session, choice)
        .groupBy(group)
        .agg(
            F.avg(share).alias("mean_cohesion"),
            F.count(F.lit(1)).alias("n_sessions"),
            F.min(share).alias("min_cohesion"),
            F.max(share).alias("max_cohesion"),
        )
    )


def with_label(df: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """Attach one label per key, the greatest if there are several."""
    return df.join(labels.groupBy(key).agg(F.max(label).alias(label)), key)


def compare_cohesion(a: DataFrame, b: DataFrame, names=("a", "b")) -> DataFrame:
    """Mean index of two cohesion tables, their difference and which is greater; no verdict without both."""
    first, second = (f"mean_{n}" for n in names)
    sides = a.select(F.lit(0).alias("side"), "mean_cohesion").unionByName(
        b.select(F.lit(1).alias("side"), "mean_cohesion")
    )
    means = sides.agg(
        F.avg(F.when(F.col("side") == 0, F.col("mean_cohesion"))).alias(first),
        F.avg(F.when(F.col("side") == 1, F.col("mean_cohesion"))).alias(second),
    )
    known = (F.col(first) != 0) & (F.col(second) != 0)
    return means.withColumn("difference", F.col(first) - F.col(second)).withColumn(
        "verdict",
        F.when(known & (F.col(first) > F.col(second)), F.lit(names[0])).when(known, F.lit(names[1])),
    )
