"""From landed records to bronze rows: fan-out, validity, audit columns, outcome gates."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..functions import fixed_values as V
from ..functions.ordered import running_total, running_total_by
from ..functions.skew import join_lookup

NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)


def outcome_split(requests: DataFrame, ok: Column) -> tuple[DataFrame, DataFrame]:
    """Requests that succeeded and the others; the request's key stays on its row."""
    good = F.coalesce(ok, F.lit(False))
    return requests.filter(good), requests.filter(~good)


def outcome_rates(requests: DataFrame, by: list[str], ok: Column) -> DataFrame:
    """Requests, successes and failures per endpoint."""
    good = F.coalesce(ok, F.lit(False))
    return requests.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_requests"), F.count_if(good).alias("n_ok"), F.count_if(~good).alias("n_failed")
    )


def success_gate(requests: DataFrame, by: list[str], ok: Column, threshold: float = V.SUCCESS_GATE) -> DataFrame:
    """Success rate per endpoint and whether it passes; no request passes nothing."""
    rate = F.coalesce(F.try_divide("n_ok", "n_requests"), F.lit(0.0))
    return (
        outcome_rates(requests, by, ok)
        .withColumn("success_rate", rate)
        .withColumn("passes", F.col("success_rate") >= threshold)
    )


def error_histogram(requests: DataFrame, kind: Column, ok: Column, alert: float = V.ERROR_ALERT) -> DataFrame:
    """Failures per kind, most frequent first, with their share of all requests.

    `total_rate` is the share of all failures together; the alert is raised on it, not on a single kind.
    """
    good = F.coalesce(ok, F.lit(False))
    failed_kind = F.when(~good, F.coalesce(kind, F.lit("unknown")))
    per_kind = requests.groupBy(failed_kind.alias("kind")).agg(F.count(F.lit(1)).alias("n_errors"))
    return (
        per_kind.filter("kind IS NOT NULL")
        .withColumn("error_rate", F.col("n_errors") / per_kind.agg(F.sum("n_errors")).scalar())
        .withColumn("total_rate", per_kind.agg(F.sum(F.when(F.col("kind").isNotNull(), F.col("n_errors"))) / F.sum("n_errors")).scalar())
        .withColumn("alert", F.col("total_rate") > alert)
        .orderBy(F.col("n_errors").desc(), "kind")
    )


def failure_runs(
    requests: DataFrame, by: list[str], order: str, failed: Column, limit: int = V.FAILURE_LIMIT, parts: int | None = None
) -> DataFrame:
    """Longest run of consecutive failures per endpoint, and where a run first reaches `limit`.

    A run is named by the number of successes before it. Both running counts are segmented over ranges of
    the whole order, so an endpoint with most of the requests is still counted by many tasks.
    """
    bad = F.coalesce(failed, F.lit(False)).cast("int")
    marked = running_total_by(
        requests.select(*by, order, bad.alias("__bad")), by, [order], {"__oks": 1 - F.col("__bad"), "__fails": F.col("__bad")}, parts
    )
    fails = marked.filter("__bad = 1")
    spans = fails.groupBy(*by, "__oks").agg(F.count(F.lit(1)).alias("__len"), F.min("__fails").alias("__first"))
    reached = (
        join_lookup(fails, spans.filter(F.col("__len") >= limit).drop("__len"), [*by, "__oks"], "inner")
        .filter(F.col("__fails") == F.col("__first") + (limit - 1))
        .groupBy(*by)
        .agg(F.min(order).alias("abort_at"))
    )
    longest = requests.select(*by).distinct().join(
        spans.groupBy(*by).agg(F.max("__len").alias("longest_run")), by, "left"
    )
    return longest.fillna(0, subset=["longest_run"]).join(reached, by, "left")


def tag_children(
    parents: DataFrame, children: DataFrame, on: str, attrs: dict[str, str] | None = None, prefix: str = "_", extra: dict | None = None
) -> DataFrame:
    """Children with the key of their parent, chosen parent attributes and constant fields.

    `attrs` maps a parent column to its name on the child; parents without children drop out.
    """
    attrs = attrs or {}
    right = parents.select(F.col(on), *[F.col(a).alias(f"{prefix}{name}") for a, name in attrs.items()])
    tagged = children.join(right, on).withColumnRenamed(on, f"{prefix}{on}")
    return tagged.withColumns({k: F.lit(v) for k, v in (extra or {}).items()})


def first_present(*cols: str, default: str = "") -> Column:
    """First non-empty of several text fields, else the default."""
    return F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in cols], F.lit(default))


def expected_grid(ids: DataFrame, start: str, end: str) -> DataFrame:
    """Every id in every month from `start` to `end` (YYYY-MM)."""
    months = F.expr(f"sequence(DATE'{start}-01', DATE'{end}-01', INTERVAL 1 MONTH)")
    return ids.distinct().withColumn("__m", F.explode(months)).select(
        *ids.columns, F.year("__m").alias("year"), F.month("__m").alias("month")
    )


def grid_gaps(ids: DataFrame, observed: DataFrame, on: str, year: str, month: str, start: str, end: str) -> DataFrame:
    """(id, year, month) of the months from `start` to `end` (YYYY-MM) in which an id has no observed row.

    An id that is null has no rows. The months seen are one bit mask of 62 months per id and span, put together by a bitwise aggregate; only the
    bits that are missing become rows, so the whole grid is never made.
    """
    first_year, first_month = (int(x) for x in start.split("-"))
    last_year, last_month = (int(x) for x in end.split("-"))
    months = max(0, (last_year - first_year) * 12 + last_month - first_month + 1)
    place = (F.col(year) - first_year) * 12 + F.col(month) - first_month
    inside = observed.filter(place.between(0, months - 1) & F.col(month).between(1, 12))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 62).cast("int"))
    masks = inside.groupBy(F.col(on).alias("__id"), F.floor(place / 62).alias("__span")).agg(F.bit_or(bit).alias("__mask"))
    seen = masks.groupBy("__id").agg(F.map_from_entries(F.collect_list(F.struct("__span", "__mask"))).alias("__masks"))
    met = ids.select(on).distinct().join(seen, F.col(on) == F.col("__id"), "left")
    places = F.sequence(F.lit(0), F.lit(months - 1)) if months else F.array().cast("array<int>")

    def missing(p):
        mask = F.coalesce(F.element_at("__masks", F.floor(p / 62)), F.lit(0).cast("long"))
        return F.getbit(mask, (p % 62).cast("int")) == 0

    gaps = met.select(on, F.explode(F.filter(places, missing)).alias("__place"))
    since = F.lit(first_month - 1) + F.col("__place")
    return gaps.select(on, (F.lit(first_year) + F.floor(since / 12)).cast("int").alias("year"), (since % 12 + 1).cast("int").alias("month"))


def stringify_all(df: DataFrame) -> DataFrame:
    """Every column as text; nested values as JSON."""
    return df.select(
        *[
            (F.to_json(F.col(f.name)) if isinstance(f.dataType, NESTED) else F.col(f.name).cast("string")).alias(f.name)
            for f in df.schema.fields
        ]
    )


def split_valid(df: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all required fields present, and the rejected rows with the fields they miss."""
    present = {c: C.truthy(c, df.schema[c].dataType.simpleString()) for c in required}
    checked = df.withColumn(
        "_missing", F.concat_ws(",", *[F.when(~ok, F.lit(c)) for c, ok in present.items()])
    )
    return checked.filter("_missing = ''").drop("_missing"), checked.filter("_missing <> ''")


def rejected_counts(rejected: DataFrame) -> DataFrame:
    """Rejected rows per combination of missing fields."""
    return rejected.groupBy("_missing").agg(F.count(F.lit(1)).alias("n_rejected"))


def with_audit(df: DataFrame, source: str, batch_id: str | None = None) -> DataFrame:
    """Add ingest time, source and batch id (yyyyMMdd_HHmmss of the run by default)."""
    batch = F.lit(batch_id) if batch_id else F.date_format(F.current_timestamp(), "yyyyMMdd_HHmmss")
    return df.withColumns(
        {"_ingested_at": F.current_timestamp(), "_source_endpoint": F.lit(source), "_batch_id": batch}
    )


def payload_hash(df: DataFrame, cols: list[str] | None = None, out: str = "_payload_hash", json: bool = True) -> DataFrame:
    """Stable md5 of the record, over its JSON or over its joined texts, with the keys in order."""
    cols = sorted(cols or df.columns)
    return df.withColumn(out, C.canonical_hash(cols) if json else C.row_digest(cols))


def audit_sample(df: DataFrame, order: list[str], n: int = 10, seed: int = 0) -> DataFrame:
    """Rows at the start, quarters and end of the order, filled up to `n` by the md5 of key and seed.

    A table of up to `n` rows is returned whole. Positions come from range partitions, not from a
    single sorted task.
    """
    numbered = running_total(df, order, 1, "__no").withColumn("position", F.col("__no") - 1).drop("__no")
    rows = numbered.agg(F.count(F.lit(1))).scalar()
    marks = [F.lit(0).cast("bigint"), F.floor(rows / 4), F.floor(rows / 2), F.floor(rows * 3 / 4), rows - 1]
    placed = numbered.withColumn("__mark", (rows <= n) | F.col("position").isin(*marks))
    drawn = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in order], F.lit(str(seed))))
    fill = placed.filter(~F.col("__mark")).orderBy(drawn, *order).limit(max(n - 5, 0))
    return (
        placed.filter("__mark").withColumn("kind", F.lit("position"))
        .unionByName(fill.withColumn("kind", F.lit("fill")))
        .drop("__mark")
    )
