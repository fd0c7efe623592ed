"""States put together from parts equal the full recompute; exact medians by brute force."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from medalytics.operators import anomaly, states


def rows(spark, n=400, big=0.0):
    rng = random.Random(n)
    data = [(i, "hot" if i % 3 == 0 else rng.choice(["a", "b", None, "one" if i == 7 else "c"]), big + rng.random() if i % 11 else None, rng.randrange(9)) for i in range(n)]
    return spark.createDataFrame(data, "i int, g string, v double, m int")


def stored(spark, tmp_path, parts, tag="s"):
    path = str(tmp_path / tag)
    for n, part in enumerate(parts):
        states.add(part, path, str(n))
    states.add(parts[-1], path, str(len(parts) - 1))  # the last load comes again
    return path


@pytest.mark.parametrize("big", [0.0, 1e9])
def test_moments_of_parts_equal_the_whole(spark, tmp_path, big):
    df = rows(spark, big=big)
    path = stored(spark, tmp_path, [states.moments(df.filter(F.col("i") % 4 == k), "v", ["g"]) for k in range(4)])
    state = states.merge_moments(states.parts(spark, path), ["g"])
    got = {r.i: (r.z_score, r.severity, r.group_mean, r.group_stddev) for r in states.zscore(df, state, "v", ["g"]).collect()}
    want = {r.i: (r.z_score, r.severity, r.group_mean, r.group_stddev) for r in anomaly.zscore(df, "v", ["g"]).collect()}
    assert got.keys() == want.keys()
    for i in want:
        assert got[i][1] == want[i][1] and got[i][0] == pytest.approx(want[i][0], abs=1e-6)
        assert got[i][2:] == pytest.approx(want[i][2:], rel=1e-6)
    before = sorted(map(repr, state.collect()))
    states.fold(spark, path, state)
    again = states.merge_moments(states.parts(spark, path), ["g"])
    assert sorted(map(repr, again.collect())) == before


def test_groups_without_values_stay(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0)], "g string, v double")
    state = states.merge_moments(states.moments(df, "v", ["g"]).unionByName(states.moments(df, "v", ["g"])), ["g"])
    assert sorted((r.g, r.n) for r in state.collect()) == [("a", 0), ("b", 2)]
    assert states.merge_moments(states.moments(df.limit(0), "v", ["g"]), ["g"]).count() == 0


def test_ranking_and_report_of_parts_equal_the_whole(spark, tmp_path):
    df = rows(spark).withColumn("v", F.col("v").cast("decimal(15,2)")).withColumn("name", F.concat("g", F.col("m") % 2))
    limits = {"many_members": 5, "high_value": 0.9, "id_pattern": "^[ab]$", "id_total": 10}
    parts = [states.totals(df.filter(F.col("i") % 3 == k), ["g"], "m", "v", "name") for k in range(3)]
    merged = states.merge_totals(states.parts(spark, stored(spark, tmp_path, parts)), ["g"], "m", "name")
    got, want = states.ranking(merged, "g", "m", "name", **limits), anomaly.rank_entities(df, "g", "v", "m", "name", **limits)
    assert list(map(tuple, got.select(want.columns).collect())) == list(map(tuple, want.collect()))
    by = ["g", "i2"]
    df = df.withColumn("i2", F.col("i") % 2)
    parts = [states.totals(df.filter(F.col("i") % 3 == k), by, "m", "v") for k in range(3)]
    merged = states.merge_totals(states.parts(spark, stored(spark, tmp_path, parts, "r")), by, "m")
    got, want = states.report(merged, by, "m"), anomaly.report(df, by, "v", "m")
    assert sorted(map(tuple, got.select(want.columns).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


@pytest.mark.parametrize("parts", [1, 4, 60])
def test_medians_by_brute_force(spark, parts):
    rng = random.Random(parts)
    data = [("hot" if i % 3 == 0 else rng.choice(["a", "b", None]), rng.choice([None, float(rng.randrange(40)), rng.random()])) for i in range(500)] + [("one", 3.0), ("two", 1.0), ("two", 2.0), ("none", None)]
    got = {r.g: (r.median, r.n) for r in states.medians(spark.createDataFrame(data, "g string, v double"), "v", ["g"], parts).collect()}
    values = {g: [v for h, v in data if h == g and v is not None] for g in {g for g, _ in data}}
    assert got == {g: (statistics.median(v), len(v)) for g, v in values.items() if v}


def test_above_median(spark):
    data = [("s1", "c", 10.0), ("s1", "c", 12.0), ("s2", "c", 1.0), ("s3", "c", 2.0), ("s4", "d", 5.0), ("s5", "d", None)]
    found = {(r.s, r.k): (r.mean_value, r.category_median, r.is_above_median) for r in states.above_median(spark.createDataFrame(data, "s string, k string, v double"), "s", "k", "v").collect()}
    assert found == {("s1", "c"): (11.0, 6.0, False), ("s2", "c"): (1.0, 6.0, False), ("s3", "c"): (2.0, 6.0, False), ("s4", "d"): (5.0, 5.0, False), ("s5", "d"): (None, 5.0, False)}
    assert states.above_median(spark.createDataFrame(data, "s string, k string, v double"), "s", "k", "v", 1.5).filter("is_above_median").first().s == "s1"
