"""Lines that many documents share are dropped everywhere but in one document. DataFrame functions only."""

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stage

SPACE = " \t\n\x0b\x0c\r"


def lines_of(text: Column) -> Column:
    """The lines of a text between line feeds; null and empty have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """A line without white space at its ends and with A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(SPACE)), string.ascii_uppercase, string.ascii_lowercase)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """All rows of `docs` as (row, lines, kept): `row` holds every column, `kept` the lines that stay.

    Keys of at least `min_chars` code points in at least `min_docs` different documents lose all
    their lines except those in the largest id that holds the key.

    Lines are exploded and carried as digests of 16 bytes; one aggregate counts the documents of each.
    Only the positions of lost lines meet the text again, and only once. A row is known by its id and
    the digest of its text, so repeated rows get the same result. A null id counts as no document and
    keeps no shared line. Null and empty texts keep their one empty line. Other columns of any name are
    carried inside `row`.
    """
    text, ident = F.col(f"row.{text_col}"), F.col(f"row.{id_col}")
    rows = docs.select(F.struct("*").alias("row"))
    keyed = rows.select(ident.alias("id"), F.unhex(F.md5(F.coalesce(text, F.lit("")))).alias("body"), text.alias("text"))
    keys = F.transform(lines_of(F.col("text")), line_key)
    long_keys = keyed.select("id", "body", F.posexplode(keys).alias("pos", "key")).filter(F.length("key") >= min_chars)
    pairs = stage(long_keys.select("id", "body", "pos", F.unhex(F.md5("key")).alias("line")), "lines")

    counted = pairs.groupBy("line").agg(F.countDistinct("id").alias("n"), F.max("id").alias("keeper"))
    shared = stage(counted.filter(F.col("n") >= min_docs).select("line", "keeper"), "shared-lines")
    lost = pairs.join(shared, "line").filter(~F.col("id").eqNullSafe(F.col("keeper")))
    lost = lost.groupBy(F.col("id").alias("lost_id"), F.col("body").alias("lost_body")).agg(F.collect_set("pos").alias("lost"))

    full = rows.select("row", F.unhex(F.md5(F.coalesce(text, F.lit("")))).alias("body"))
    met = full.join(lost, ident.eqNullSafe(F.col("lost_id")) & (F.col("body") == F.col("lost_body")), "left")
    split = met.select("row", "lost", lines_of(text).alias("lines"))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("lost"))
    kept = F.when(F.col("lost").isNull(), F.col("lines")).otherwise(F.transform(left, lambda i: F.get(F.col("lines"), i)))
    return split.select("row", "lines", kept.alias("kept"))


def report(deduped: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document: lines before, lines dropped, and the digest of what is left."""
    return deduped.select(
        F.col(f"row.{id_col}").alias("doc_id"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
        F.sha2(F.array_join("kept", "\n"), 256).alias("kept_sha256"),
    )
