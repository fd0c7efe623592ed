"""Typed projections, standard forms, surrogate keys and deduplication."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C


def project(df: DataFrame, mapping: list[tuple[str, str, str]]) -> DataFrame:
    """Select, rename and type columns; a mapping row is (source, target, type or "same").

    Values that do not parse become null instead of failing the job.
    """
    return df.select(*[C.as_type(F.col(source), kind).alias(target) for source, target, kind in mapping])


def require(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key columns are all present."""
    return df.dropna(subset=keys)


def standardize(df: DataFrame, cols: list[str], upper: bool = True) -> DataFrame:
    """Trim, and by default upper-case, text columns."""
    return df.withColumns({c: F.upper(F.trim(c)) if upper else F.trim(c) for c in cols})


def digits_only(df: DataFrame, cols: list[str]) -> DataFrame:
    """Identifiers without punctuation."""
    return df.withColumns({c: F.regexp_replace(c, r"\D", "") for c in cols})


def recode(df: DataFrame, column: str, rules, out: str, otherwise: Column | None = None) -> DataFrame:
    """Standard category by ordered rules; by default other values are upper-cased."""
    default = F.upper(column) if otherwise is None else otherwise
    return df.withColumn(out, C.first_rule(F.col(column), rules, default))


def surrogate_key(df: DataFrame, cols: list[str], out: str, sep: str = "||") -> DataFrame:
    return df.withColumn(out, C.digest(cols, sep))


def dedup_keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row per key, the first in `order`.

    The filter on row_number lets Spark keep one row per key and task before the shuffle, so a key
    with very many copies does not travel.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(first)).filter(F.col("__rn") == 1).drop("__rn")


def dedup_report(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, distinct keys and duplicates, in one row."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
    ).withColumn("n_duplicates", F.col("n_rows") - F.col("n_keys"))


def dim_from_fact(
    fact: DataFrame, key: str, name: str, rules, default: str, kind: str = "kind", sk: str = "sk"
) -> DataFrame:
    """Dimension of the distinct non-empty keys of a fact, with one name, a key digest and a kind."""
    text = F.col(key).cast("string")
    return (
        fact.filter(text.isNotNull() & (text != ""))
        .groupBy(key)
        .agg(F.max(name).alias(name))
        .withColumn(sk, F.md5(text))
        .withColumn(kind, C.first_rule(text, rules, F.lit(default)))
    )
