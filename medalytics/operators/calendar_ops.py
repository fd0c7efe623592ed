"""Calendar parts, event calendar, weekly density, period comparison, upcoming events."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import fixed_values as V


def parts(df: DataFrame, ts: str) -> DataFrame:
    """Add day, year and month of a time."""
    return df.withColumns({"day": F.to_date(ts), "year": F.year(ts), "month": F.month(ts)})


def with_week(df: DataFrame, date: str, base: str = V.WEEK_BASE, out: str = "week") -> DataFrame:
    return df.withColumn(out, C.week_index(F.col(date), base))


def duration_hours(start: str, end: str) -> Column:
    """Hours between two times; null if one is missing."""
    seconds = [F.unix_timestamp(F.col(c).cast("timestamp")) for c in (start, end)]
    return (seconds[1] - seconds[0]) / 3600


def calendar(events: DataFrame, attendance: DataFrame, event: str, start: str, end: str) -> DataFrame:
    """Events with number of attendants (0 if none) and duration in hours."""
    present = attendance.groupBy(event).agg(F.count(F.lit(1)).alias("n_present"))
    return (
        events.join(present, event, "left")
        .fillna(0, subset=["n_present"])
        .withColumn("hours", duration_hours(start, end))
    )


def weekly_density(cal: DataFrame, date: str, kind: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Events, attendants and kinds of every week of the data; weeks without events are kept.

    A week is numbered from `first`, or from the first event. Without events before `first` or after
    `last` the weeks run from the one to the other; events outside stretch the weeks, and events without
    a date have a row of their own without a week, so all events are counted. Kinds are counted before
    their list is made, so a busy week moves one row per kind.
    """
    day = F.col(date).cast("date")
    base = F.lit(first).cast("date") if first else cal.agg(F.min(day)).scalar()
    week = C.week_index(day, base)
    ends = cal.agg(F.min(week).alias("low"), F.max(week).alias("high"))
    low = F.least("low", F.lit(1)) if first else F.col("low")
    high = F.greatest("high", C.week_index(F.lit(last).cast("date"), base)) if last else F.col("high")
    weeks = ends.select(F.explode(F.sequence(low, high)).alias("week"))
    weekly = (
        cal.groupBy(week.alias("week"), kind)
        .agg(F.count(F.lit(1)).alias("n"), F.sum("n_present").alias("p"))
        .groupBy("week")
        .agg(
            F.sum("n").alias("n_events"),
            F.sum("p").alias("n_present"),
            F.array_sort(F.collect_list(kind)).alias("kinds"),
        )
    )
    return (
        weeks.join(weekly, "week", "full")
        .withColumn("n_events", F.coalesce("n_events", F.lit(0)))
        .withColumn("n_present", F.coalesce("n_present", F.lit(0)))
        .withColumn("mean_present", F.coalesce(F.try_divide("n_present", "n_events"), F.lit(0.0)))
        .withColumn("kinds", F.coalesce("kinds", F.array().cast("array<string>")))
        .withColumn("is_empty", F.col("n_events") == 0)
        .orderBy("week")
    )


def period_compare(fact: DataFrame, member: str, period: Column) -> DataFrame:
    """Mean facts per member, and members, of every period."""
    return (
        fact.groupBy(member, period.alias("period"))
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("period")
        .agg(F.avg("n").alias("mean_per_member"), F.count(F.lit(1)).alias("n_members"))
    )


def upcoming(cal: DataFrame, date: str, status: str, as_of: str | None = None, closed: str = V.EVENT_CLOSED) -> DataFrame:
    """Events from `as_of` (default today) on that are not closed; a null status is left out."""
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return cal.filter((F.col(date).cast("date") >= today) & (F.col(status) != closed)).orderBy(date)
