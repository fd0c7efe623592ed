"""Keys, typed projections, deduplication, profiles, expectations."""

import hashlib

import pytest
from pyspark.sql import functions as F

from medalytics.functions import columns as C
from medalytics.functions import fixed_values as V
from medalytics.operators import keys, quality
from medalytics.operators.quality import Expectation


def test_project_makes_bad_values_null(spark):
    df = spark.createDataFrame([("1", "2.50", "2024-02-30", ""), ("x", "", "2024-02-28", "2024-01-01T10:00")], "a string, b string, c string, d string")
    got = keys.project(df, [("a", "id", "bigint"), ("b", "v", "decimal(15,2)"), ("c", "d", "date"), ("d", "t", "timestamp")]).collect()
    assert got[0]["id"] == 1 and str(got[0]["v"]) == "2.50" and got[0]["d"] is None and got[0]["t"] is None
    assert got[1]["id"] is None and got[1]["v"] is None and str(got[1]["d"]) == "2024-02-28" and got[1]["t"] is not None


def test_project_reads_struct_fields(spark):
    df = spark.sql("SELECT named_struct('id', '7', 'nome', 'Ana') AS deputado_")
    assert keys.project(df, [("deputado_.id", "id", "bigint")]).first()["id"] == 7


def test_surrogate_key_skips_nulls(spark):
    df = keys.surrogate_key(spark.createDataFrame([(1, None, "b")], "a int, n string, b string"), ["a", "n", "b"], "sk")
    assert df.first()["sk"] == hashlib.md5(b"1||b").hexdigest()


def test_dedup_is_deterministic_and_cuts_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("o"))
    got = keys.dedup_keep_first(df, ["k"], [F.col("o").desc()])
    assert sorted(tuple(r) for r in got.collect()) == [(0, 998), (1, 999)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_dedup_report_on_nothing(spark):
    assert tuple(keys.dedup_report(spark.createDataFrame([], "k int"), ["k"]).first()) == (0, 0, 0)


def test_vote_rules(spark):
    df = spark.createDataFrame([("Sim",), ("não",), ("Abstenção",), ("Obstrução",), ("Artigo 17",), (None,)], "v string")
    got = [r["s"] for r in keys.recode(df, "v", V.VOTE_RULES, "s").collect()]
    assert got == ["SIM", "NAO", "ABSTENCAO", "OBSTRUCAO", "ARTIGO 17", None]


def test_dim_from_fact_kinds_and_digits(spark):
    df = spark.createDataFrame([("12345678000199", "A"), ("123.456.789-01", "B"), ("", "C"), (None, "D"), ("12345678000199", "Z")], "t string, n string")
    kinds = {r["t"]: (r["n"], r["kind"]) for r in keys.dim_from_fact(df, "t", "n", V.TAX_ID_RULES, "OUTRO").collect()}
    assert kinds == {"12345678000199": ("Z", "CNPJ"), "123.456.789-01": ("B", "OUTRO")}
    clean = keys.digits_only(df, ["t"])
    kinds = {r["t"]: r["kind"] for r in keys.dim_from_fact(clean, "t", "n", V.TAX_ID_RULES, "OUTRO").collect()}
    assert kinds["12345678901"] == "CPF"


def test_profile_counts_null_keys_as_keys(spark):
    df = spark.createDataFrame([("a", None), ("a", "b"), (None, "a"), ("a", "b")], "x string, y string")
    got = quality.profile(df, ["x", "y"], ["x"]).first()
    assert (got["total"], got["distinct_keys"], got["duplicates"], got["nulls_x"], got["pct_x"]) == (4, 3, 1, 1, 25.0)
    assert got["issues"] == "1 nulls in x (25%); 1 duplicate keys (25%)"


def test_profile_of_an_empty_table(spark):
    got = quality.profile(spark.createDataFrame([], "x string"), ["x"], ["x"]).first()
    assert got["total"] == 0 and got["pct_x"] == 0.0 and got["issues"] == "empty table"


def test_expectations(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (-1, None)], "id int, t string")
    rules = [Expectation("id", F.col("id").isNotNull(), "DROP"), Expectation("text", F.col("t") != "", "WARN"), Expectation("positive", F.coalesce(F.col("id"), F.lit(1)) > 0, "FAIL")]
    clean, report = quality.expect(df, rules)
    assert clean.count() == 2
    assert {r["rule"]: r["failed"] for r in report.collect()} == {"id": 1, "text": 1, "positive": 1}
    with pytest.raises(quality.ExpectationFailed, match="positive: 1 rows"):
        quality.enforce(report)
    quality.enforce(quality.expectation_report(df.filter("id > 0"), rules))


def test_referential(spark):
    parents = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    children = spark.createDataFrame([(1,), (1,), (9,), (9,), (None,)], "k int")
    assert tuple(quality.referential(parents, children, "k").first()) == pytest.approx((3, 2, 1, 2, 100 / 3))


def test_coverage_against_a_number(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert tuple(quality.coverage(df, "k", 640).first()) == (2, 640, 2 / 640)
    assert quality.coverage(df, "k", 0).first()["coverage"] == 0.0


def test_truthy_kinds(spark):
    df = spark.sql("SELECT 0 AS n, '' AS s, false AS b, CAST(NULL AS DATE) AS d, 0.0 AS f")
    got = df.select(*[C.truthy(f.name, f.dataType.simpleString()).alias(f.name) for f in df.schema.fields]).first()
    assert not any(got)
