"""Presence rates, engagement score and percentile, absences, monthly series."""

from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ordered
from ..functions.scratch import store
from ..functions.skew import join_lookup


def rate(fact: DataFrame, dim: DataFrame, event: str, member: str, kind: str) -> DataFrame:
    """Presences of a member in events of a kind over all events of that kind."""
    seen = (
        fact.select(event, member)
        .join(dim.select(event, kind), event)
        .groupBy(member, kind)
        .agg(F.count(F.lit(1)).alias("n_present"))
    )
    totals = dim.groupBy(kind).agg(F.count(F.lit(1)).alias("n_events"))
    return join_lookup(seen, totals, [kind], "inner").withColumn(
        "presence_rate", F.col("n_present") / F.col("n_events")
    )


def score(members: DataFrame, key: str, parts: list[tuple[str, DataFrame, DataFrame, float]]) -> DataFrame:
    """Weighted sum of the shares of every part; a part is (name, facts, one-row total, weight).

    Members without facts count 0, and so does a part whose total is 0.
    """
    total = F.lit(0.0)
    for name, facts, whole, weight in parts:
        counted = facts.groupBy(key).agg(F.count(F.lit(1)).alias(f"n_{name}"))
        share = F.try_divide(F.col(f"n_{name}"), whole.scalar())
        members = (
            members.join(counted, key, "left")
            .fillna(0, subset=[f"n_{name}"])
            .withColumn(f"{name}_score", F.coalesce(share, F.lit(0.0)))
        )
        total = total + F.col(f"{name}_score") * weight
    return members.withColumn("engagement_score", total)


def percentile(df: DataFrame, column: str, out: str = "percentile") -> DataFrame:
    """percent_rank over the whole set, computed from ranges of the distinct values."""
    return ordered.percent_rank(df, column, out)


def absences(
    members: DataFrame, votes: DataFrame, key: str, session: str, body: str, attrs: list[str], page_bodies: int = 1000
) -> DataFrame:
    """Sessions of every body in which a member did not vote, where there is at least one.

    Sessions are counted per body and votes per member and body, so members never meet sessions. Bodies
    come in pages of about `page_bodies`: every member gets one row per page with what it attended there,
    and only then, without another shuffle, one row per body, as many as the result itself may have.
    """
    listed = store(votes.select(session, body).distinct(), "sessions")
    held = store(listed.df.groupBy(body).agg(F.count(F.lit(1)).alias("n_held")), "bodies")
    attended = (
        join_lookup(votes.select(key, session).distinct(), listed, [session], "inner")
        .groupBy(key, body)
        .agg(F.count(F.lit(1)).alias("n_voted"))
    )
    count = max(1, ceil(held.rows / page_bodies))
    page = F.pmod(F.xxhash64(body), F.lit(count)).cast("int")
    body_key = F.coalesce(F.concat(F.lit("="), F.col(body).cast("string")), F.lit(""))
    voted = attended.groupBy(key, page.alias("__page")).agg(
        F.map_from_entries(F.collect_list(F.struct(body_key, F.col("n_voted")))).alias("__voted")
    )
    pages = held.df.groupBy(page.alias("__page")).agg(F.collect_list(F.struct(F.col(body), F.col("n_held"))).alias("__bodies"))
    paged = members.select(key, *attrs, F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("__page"))
    grid = join_lookup(paged.join(voted, [key, "__page"], "left"), pages, ["__page"], "inner")
    grid = grid.select(key, *attrs, "__voted", F.inline("__bodies"))
    missed = F.col("n_held") - F.coalesce(F.try_element_at("__voted", body_key), F.lit(0))
    return grid.withColumn("n_missed", missed).filter("n_missed > 0").select(key, *attrs, body, "n_missed")


def monthly_series(a: DataFrame, b: DataFrame, key: str, date: str, names=("presences", "votes")) -> DataFrame:
    """Facts of two kinds per member and month; a month with only one kind has 0 of the other."""

    def monthly(df, name):
        return df.groupBy(key, F.year(date).alias("year"), F.month(date).alias("month")).agg(
            F.count(F.lit(1)).alias(name)
        )

    return (
        monthly(a, names[0])
        .join(monthly(b, names[1]), [key, "year", "month"], "outer")
        .fillna(0, subset=list(names))
        .withColumn("engagement", F.col(names[0]) + F.col(names[1]))
    )
