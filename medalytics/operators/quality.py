"""Profiles, expectations, referential integrity and coverage, each in one pass where possible."""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Expectation:
    """A named rule: rows for which `holds` is not true fail it. Action is DROP, WARN or FAIL."""

    name: str
    holds: Column
    action: str = "WARN"


class ExpectationFailed(ValueError):
    pass


def _failed(rule: Expectation) -> Column:
    return ~F.coalesce(rule.holds, F.lit(False))


def profile(df: DataFrame, keys: list[str], critical: list[str]) -> DataFrame:
    """Rows, nulls and null share per critical column, distinct keys, duplicates and issues, in one row.

    Issues are texts with their count and whole percent.

    Keys are compared as a struct, so a null part is a value of its own.
    """
    nulls = [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in critical]
    stats = (
        df.groupBy(F.struct(*keys).alias("__key"))
        .agg(F.count(F.lit(1)).alias("__n"), *nulls)
        .agg(
            F.coalesce(F.sum("__n"), F.lit(0)).alias("total"),
            F.count(F.lit(1)).alias("distinct_keys"),
            *[F.coalesce(F.sum(f"nulls_{c}"), F.lit(0)).alias(f"nulls_{c}") for c in critical],
        )
    )
    total, duplicates = F.col("total"), F.col("total") - F.col("distinct_keys")

    def counted(n, what):
        share = F.floor(n * 100 / total).cast("string")
        return F.concat(n.cast("string"), F.lit(f" {what} ("), share, F.lit("%)"))

    issues = F.concat_ws(
        "; ",
        F.when(total == 0, F.lit("empty table")),
        *[F.when(F.col(f"nulls_{c}") > 0, counted(F.col(f"nulls_{c}"), f"nulls in {c}")) for c in critical],
        F.when(duplicates > 0, counted(duplicates, "duplicate keys")),
    )
    return stats.withColumns(
        {f"pct_{c}": F.coalesce(F.try_divide(F.col(f"nulls_{c}") * 100, total), F.lit(0.0)) for c in critical}
        | {"duplicates": duplicates, "issues": issues}
    )


def expectation_report(df: DataFrame, rules: list[Expectation]) -> DataFrame:
    """One row per rule with rows, failures and failure rate; all rules are counted in one pass."""
    counted = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(_failed(r)).alias(f"__f{i}") for i, r in enumerate(rules)],
    )
    lines = F.array(
        *[
            F.struct(F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"), F.col(f"__f{i}").alias("failed"))
            for i, r in enumerate(rules)
        ]
    )
    rate = F.coalesce(F.try_divide("failed", "total"), F.lit(0.0))
    return counted.select("total", F.inline(lines)).withColumn("failure_rate", rate)


def uniqueness_report(df: DataFrame, rule: str, keys: list[str], action: str = "DROP") -> DataFrame:
    """The report line of a rule that a key occurs once: its failures are the rows beyond the first."""
    counted = df.groupBy(F.struct(*keys)).agg(F.count(F.lit(1)).alias("__n"))
    counted = counted.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("total"), F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("failed"))
    rate = F.coalesce(F.try_divide("failed", "total"), F.lit(0.0))
    return counted.select("total", F.lit(rule).alias("rule"), F.lit(action).alias("action"), "failed", rate.alias("failure_rate"))


def drop_failures(df: DataFrame, rules: list[Expectation]) -> DataFrame:
    """Rows that pass every rule whose action is DROP."""
    keep = [F.coalesce(r.holds, F.lit(False)) for r in rules if r.action == "DROP"]
    return df.filter(reduce(lambda a, b: a & b, keep)) if keep else df


def broken(rules: list[Expectation]) -> Column:
    """Names of all rules that a row breaks, whatever their action, in the order of the rules."""
    return F.array_compact(F.array(*[F.when(_failed(r), F.lit(r.name)) for r in rules]))


def split_rejected(df: DataFrame, rules: list[Expectation], flag: str = "_rejected", names: str = "_broken") -> DataFrame:
    """All rows with the names of the rules they break, and whether one of these drops them."""
    drops = [r.name for r in rules if r.action == "DROP"]
    lost = F.arrays_overlap(F.col(names), F.array(*[F.lit(n) for n in drops])) if drops else F.lit(False)
    return df.withColumn(names, broken(rules)).withColumn(flag, lost)


def expect(df: DataFrame, rules: list[Expectation]) -> tuple[DataFrame, DataFrame]:
    """Clean rows and the report; `enforce` the report before writing the rows."""
    return drop_failures(df, rules), expectation_report(df, rules)


def enforce(report: DataFrame) -> None:
    """Stop if a FAIL rule has failures; the report has one row per rule."""
    broken = report.filter("action = 'FAIL' AND failed > 0").collect()
    if broken:
        raise ExpectationFailed(", ".join(f"{r['rule']}: {r['failed']} rows" for r in broken))


def referential(parents: DataFrame, children: DataFrame, on: str) -> DataFrame:
    """Parents without children, orphan children keys and the share of covered parents, in one row."""
    left = parents.filter(F.col(on).isNotNull()).groupBy(on).agg(F.lit(1).alias("__p"))
    right = children.filter(F.col(on).isNotNull()).groupBy(on).agg(F.count(F.lit(1)).alias("__c"))
    p, c = F.col("__p").isNotNull(), F.col("__c").isNotNull()
    covered = F.count_if(p & c) * 100
    return left.join(right, on, "outer").agg(
        F.count_if(p).alias("n_parents"),
        F.count_if(p & ~c).alias("n_childless"),
        F.count_if(c & ~p).alias("n_orphan_keys"),
        F.coalesce(F.sum(F.when(c & ~p, F.col("__c"))), F.lit(0)).alias("n_orphan_rows"),
        F.coalesce(F.try_divide(covered, F.count_if(p)), F.lit(0.0)).alias("covered_pct"),
    )


def coverage(df: DataFrame, key: str, expected: DataFrame | int) -> DataFrame:
    """Distinct entities with data over the expected number (a number, or a table of entities)."""
    found = df.agg(F.countDistinct(key).alias("n_found"))
    whole = F.lit(expected).cast("bigint") if isinstance(expected, int) else expected.agg(F.countDistinct(key)).scalar()
    return found.withColumn("n_expected", whole).withColumn(
        "coverage", F.coalesce(F.try_divide("n_found", "n_expected"), F.lit(0.0))
    )


def table_profile(df: DataFrame, parent: str, child: str, critical: list[str]) -> DataFrame:
    """Rows, distinct pairs, parents and children, mean children per parent, nulls, duplicate share."""
    nulls = [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in critical]
    pairs = df.groupBy(parent, child).agg(F.count(F.lit(1)).alias("__n"), *nulls)
    base = pairs.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_pairs"),
        *[F.coalesce(F.sum(f"nulls_{c}"), F.lit(0)).alias(f"nulls_{c}") for c in critical],
        F.countDistinct(parent).alias("n_parents"),
        F.countDistinct(child).alias("n_children"),
    )
    return base.withColumns(
        {
            "mean_children": F.coalesce(F.try_divide("n_pairs", "n_parents"), F.lit(0.0)),
            "duplicate_pct": F.coalesce(
                F.try_divide((F.col("n_rows") - F.col("n_pairs")) * 100, F.col("n_rows")), F.lit(0.0)
            ),
        }
    )
