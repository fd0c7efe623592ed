"""Slowly changing history: build, refresh, point-in-time lookup, durations.

Versions are ordered by (key, order) over the whole table, in ranges, so that the history of one very active key is
worked on by many tasks whatever its share of the rows; one line per range crosses from one to the next.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import carry_forward, following


def build(df: DataFrame, key: str, order: str, ts: str, parts: int | None = None) -> DataFrame:
    """Add valid_from, valid_to (the start of the next version, null if none) and is_current.

    Rows without a key or without a time (it did not parse) are no versions; see `unplaced`. The current
    version is the last in the order; ties in it go by time.
    """
    rows = df.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
    found = following(rows, [key], [order, ts], {"valid_to": F.col(ts)}, parts)
    return found.select(*df.columns, F.col(ts).alias("valid_from"), "valid_to", (~F.col("__more")).alias("is_current"))


def unplaced(df: DataFrame, key: str, ts: str) -> DataFrame:
    """The rows that `build` leaves out: without a key or without a time."""
    return df.filter(F.col(key).isNull() | F.col(ts).isNull())


def refresh(history: DataFrame, increment: DataFrame, key: str, order: str, ts: str, parts: int | None = None) -> DataFrame:
    """History after an increment: only the keys that occur in it are rebuilt.

    A (key, order) that is in both keeps the increment's row.
    """
    touched = increment.select(key).distinct()
    old = history.join(touched, key, "left_semi").join(increment.select(key, order), [key, order], "left_anti")
    rebuilt = build(old.select(*increment.columns).unionByName(increment), key, order, ts, parts)
    return history.join(touched, key, "left_anti").select(*rebuilt.columns).unionByName(rebuilt)


def as_of(history: DataFrame, moment) -> DataFrame:
    """Versions valid at one moment."""
    at = F.lit(moment).cast(history.schema["valid_from"].dataType)
    return history.filter((F.col("valid_from") <= at) & ((F.col("valid_to") > at) | F.col("is_current")))


def as_of_join(df: DataFrame, history: DataFrame, key: str, at: str, order: str, cols: list[str], parts: int | None = None) -> DataFrame:
    """Add to every row of `df` the `cols` of the version of its key that is valid at `at`, null if none.

    `history` comes from `build` with times that do not decrease along `order`; a version that ends before
    it begins raises an error, one without a start is never valid. Rows and versions are merged in time
    order and the last version is carried forward over all ranges of that order, so the work is linear and
    neither a busy key nor a busy moment of it is one task.
    """
    kind = history.schema["valid_from"].dataType
    backwards = F.raise_error(F.lit("the times of the history decrease along its order"))
    checked = F.when(F.col("valid_to") < F.col("valid_from"), backwards).otherwise(F.col("valid_from"))
    versions = history.filter(F.col("valid_from").isNotNull()).select(
        F.col(key).alias("__of"),
        checked.alias("__moment"),
        F.lit(0).alias("__side"),
        F.col(order).cast("bigint").alias("__seq"),
        F.struct(*[F.col(c) for c in cols]).alias("__version"),
        F.lit(None).alias("__row"),
    )
    probes = df.select(
        F.col(key).alias("__of"),
        F.col(at).cast(kind).alias("__moment"),
        F.lit(1).alias("__side"),
        # a place among the rows of one moment, so that they too are spread over ranges
        F.monotonically_increasing_id().alias("__seq"),
        F.lit(None).alias("__version"),
        F.struct(*[F.col(c) for c in df.columns]).alias("__row"),
    )
    merged = versions.unionByName(probes)
    scanned = carry_forward(merged, ["__of"], ["__moment", "__side", "__seq"], {"__found": F.col("__version")}, parts).filter("__side = 1")
    valid = F.col("__moment").isNotNull() & F.col("__of").isNotNull()
    found = scanned.withColumn("__found", F.when(valid, F.col("__found")))
    return found.select("__row.*", *[F.col(f"__found.{c}").alias(c) for c in cols])


def current_alerts(history: DataFrame, body: str, state: str, body_is: str, state_has: str) -> DataFrame:
    """Current versions in a given body or whose state contains a text."""
    return history.filter(
        F.col("is_current")
        & (F.coalesce(F.col(body) == body_is, F.lit(False)) | F.coalesce(F.col(state).contains(state_has), F.lit(False)))
    )


def current_in_state(history: DataFrame, state: str, state_has: str) -> DataFrame:
    """Current versions whose state contains a text."""
    return history.filter(F.col("is_current") & F.col(state).contains(state_has))


def durations(history: DataFrame, by: list[str], body: str) -> DataFrame:
    """First and last step, steps, last body and days of every key; only keys that took at least a day."""
    return (
        history.groupBy(*by)
        .agg(
            F.min("valid_from").alias("first_at"),
            F.max("valid_from").alias("last_at"),
            F.count(F.lit(1)).alias("n_steps"),
            F.max(F.when(F.col("is_current"), F.col(body))).alias("last_body"),
        )
        .withColumn("days", F.datediff("last_at", "first_at"))
        .filter("days > 0")
    )


def duration_summary(spans: DataFrame, by: str, min_n: int = 1) -> DataFrame:
    """Mean, number, least and greatest days per group with at least `min_n` keys, slowest first."""
    return (
        spans.filter(F.col(by).isNotNull())
        .groupBy(by)
        .agg(
            F.avg("days").alias("mean_days"),
            F.count(F.lit(1)).alias("n_keys"),
            F.min("days").alias("min_days"),
            F.max("days").alias("max_days"),
        )
        .filter(F.col("n_keys") >= min_n)
        .orderBy(F.col("mean_days").desc(), by)
    )
