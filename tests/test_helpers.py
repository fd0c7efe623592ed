"""Joins under skew, global order, stored tables."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from medalytics.functions import ordered, scratch, skew
from medalytics.operators import ingest


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("limit, parts", [(1 << 20, 8), (0, 100), (0, 2)])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_join_lookup_is_the_same_on_all_ways(spark, limit, parts, how):
    """A third of the rows share a key; null keys meet; broadcast, spread and plain ways agree."""
    facts = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 != 0, F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k")
    )
    lookup = facts.filter("k IS NULL OR k <> 'k1'").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    want = {r["k"]: r["n"] for r in lookup.collect()}
    got = skew.join_lookup(facts, lookup, ["k"], how, max_broadcast_bytes=limit, parts=parts).collect()
    expected = {r["id"]: want.get(r["k"]) for r in facts.collect() if how == "left" or r["k"] in want}
    assert {r["id"]: r["n"] for r in got} == expected
    assert len(got) == len(expected)


def test_salt_spreads_equal_rows(spark):
    copies = spark.range(0, 8000, 1, 16).select(F.lit("same").alias("a"))
    assert copies.select(skew.salt(["a"], 8).alias("s")).distinct().count() > 3


def test_only_hot_keys_are_repeated(spark):
    """Beyond the limit the facts meet the lookup by key and salt; only rows of hot keys are repeated."""
    facts = spark.range(100).withColumn("k", F.when(F.col("id") < 40, 0).otherwise(F.col("id")))
    counts = facts.groupBy("k").agg(F.count("k").alias("__left"), F.lit(0).alias("__right"), F.count("k").alias("__out"))
    assert [tuple(r) for r in skew.hot_keys(counts, 3).df.collect()] == [(0, 3, True)]
    plan = skew.join_lookup(facts, facts.groupBy("k").count(), ["k"], max_broadcast_bytes=0, parts=3)._jdf.queryExecution().optimizedPlan().toString()
    assert "__salt" in plan and plan.count("rightHint=(strategy=broadcast)") == 2


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_running_total_equals_the_single_window(spark, parts):
    df = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 7 % 13).alias("v")).orderBy(F.rand(1))
    got = ordered.running_total(df, ["k"], F.col("v"), "total", parts)
    want = df.withColumn("total", F.sum("v").over(Window.orderBy("k")))
    assert rows(got.select("k", "v", "total")) == rows(want.select("k", "v", "total"))


@pytest.mark.parametrize("n", [1, 2, 400])
def test_percent_rank_equals_the_single_window(spark, n):
    rng = random.Random(n)
    df = spark.createDataFrame([(i, rng.choice([0.0, 0.0, rng.random()])) for i in range(n)], "id long, s double")
    got = ordered.percent_rank(df, "s", "p").select("id", F.round("p", 9))
    want = df.select("id", F.round(F.percent_rank().over(Window.orderBy("s")), 9))
    assert rows(got) == rows(want)


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_running_total_by_equals_the_single_window(spark, parts):
    df = spark.range(300).select((F.col("id") % 2).alias("g"), F.col("id").alias("o"), (F.col("id") % 5).alias("v"))
    got = ordered.running_total_by(df, ["g"], ["o"], {"t": F.col("v")}, parts)
    want = df.withColumn("t", F.sum("v").over(Window.partitionBy("g").orderBy("o")))
    assert rows(got.select("g", "o", "t")) == rows(want.select("g", "o", "t"))


def nullable(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def keyed(spark, n=600):
    """A third of the rows have one key; some keys and values are null."""
    rng = random.Random(n)
    data = [(0 if i % 3 == 0 else rng.choice([None, *range(1, 30)]), rng.randrange(50), i, rng.choice([None, None, None, i])) for i in range(n)]
    return spark.createDataFrame(data, "g int, o int, i long, v long")


@pytest.mark.parametrize("parts", [1, 5, 64])
def test_carry_forward_equals_the_single_window(spark, parts):
    df = keyed(spark)
    got = ordered.carry_forward(df, ["g"], ["o", "i"], {"c": F.col("v"), "d": F.col("v") % 7}, parts)
    whole = Window.partitionBy("g").orderBy("o", "i").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("c", F.last("v", True).over(whole)).withColumn("d", F.last(F.col("v") % 7, True).over(whole))
    assert nullable(got) == nullable(want)


@pytest.mark.parametrize("parts", [1, 5, 64])
def test_following_equals_the_single_window(spark, parts):
    df = keyed(spark)
    got = ordered.following(df, ["g"], ["o", "i"], {"n": F.col("v")}, parts)
    whole = Window.partitionBy("g").orderBy("o", "i")
    want = df.withColumn("n", F.lead("v").over(whole)).withColumn("__more", F.lead(F.lit(True)).over(whole).isNotNull())
    assert nullable(got) == nullable(want)


def test_scans_of_nothing_and_of_one_key(spark):
    df = keyed(spark)
    for some in (df.limit(0), df.filter("g = 0")):
        assert ordered.carry_forward(some, ["g"], ["o", "i"], {"c": F.lit(1)}, 9).filter("c = 1").count() == some.count()
        assert ordered.following(some, ["g"], ["o", "i"], {"c": F.lit(1)}, 9).filter("NOT __more").count() == min(1, some.count())
        assert ordered.running_total_by(some, ["g"], ["o", "i"], {"c": F.lit(1)}, 9).agg(F.max("c")).first()[0] == (some.count() or None)


def test_no_scan_has_a_window_per_key(spark):
    df = keyed(spark)
    for got in (ordered.carry_forward(df, ["g"], ["o", "i"], {"c": F.col("v")}, 5), ordered.following(df, ["g"], ["o", "i"], {"c": F.col("v")}, 5)):
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        for line in (x for x in plan.splitlines() if "Window [" in x):
            assert "__part" in line or "__at" in line, line
        most = df.repartitionByRange(5, "g", "o", "i").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert most < 200  # the key with a third of the rows lies in several ranges


def test_store_knows_rows_and_size(spark):
    stored = scratch.store(spark.createDataFrame([("a" * 100, 1), (None, 2)], "s string, n int"))
    assert stored.rows == 2 and 100 < stored.bytes < 400
    assert scratch.store(spark.createDataFrame([], "s string")).bytes == 0


def test_shared_root_follows_the_session(spark):
    assert scratch.shared_root(spark) == spark.conf.get("spark.checkpoint.dir")


@pytest.mark.parametrize("parts", [1, 8, 200])
def test_join_hot_is_a_plain_join(spark, parts):
    """A third of the facts share a key, some keys are null; the spread and the plain way give the same rows."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 5 != 0, F.col("id") % 100)
    facts = spark.range(300).select("id", key.alias("k"))
    other = spark.range(150).select(F.when(F.col("id") % 7 != 0, F.col("id") % 40).alias("k"), F.col("id").alias("o"))
    got = skew.join_hot(facts, other, ["k"], parts)
    assert rows(got.select("k", "id", "o")) == rows(facts.join(other, "k").select("k", "id", "o"))


@pytest.mark.parametrize("turned", [False, True])
def test_rows_that_come_out_are_spread(spark, turned):
    """One key with a third of the rows on one side, or few rows on both that make most of the result."""
    many = spark.range(0, 30_000, 1, 8).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), "id")
    few = spark.range(40).select(F.lit(-1).cast("long").alias("k"), F.col("id").alias("o")).union(spark.range(500).select("id", "id"))
    a, b = (few, many) if turned else (many, few)
    joined = skew.join_hot(a, b, ["k"], 16)
    want = 10_000 * 40 + many.filter("k >= 0 AND k < 500").count()
    sizes = [r[0] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().select("count").collect()]
    assert sum(sizes) == want
    salts = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "__salt" in salts
    hot = many.filter("k = -1").count()
    counts = spark.createDataFrame([(-1, hot, 40, hot * 40)], "k long, __left long, __right long, __out long")
    assert skew.hot_keys(counts, 16).df.first()["__salts"] == 32  # rows per salt: at most a 16th of the result


def test_hot_parent_is_split_at_run_time(spark):
    """Adaptive execution splits a skewed partition of a join between two shuffled sides."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        children = spark.range(0, 90_000, 1, 16).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("k"), "id")
        parents = spark.range(5000).select(F.col("id").alias("k"), F.lit("p").alias("name"))
        joined = ingest.tag_children(parents, children, "k", {"name": "name"})
        assert len(joined.collect()) == 90_000
        assert "SortMergeJoin(skew=true)" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_tables_of_a_run_share_one_folder(spark):
    a, b = scratch.new_path(spark, "x"), scratch.new_path(spark, "x")
    assert a != b and a.rsplit("/", 1)[0] == b.rsplit("/", 1)[0]
    assert spark.sparkContext.applicationId in a and a.startswith(scratch.shared_root(spark))
