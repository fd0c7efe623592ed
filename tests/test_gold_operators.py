"""Anomalies, groups, engagement, calendar on small frames and by brute force."""

import itertools
import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from medalytics.functions import columns as C
from medalytics.operators import anomaly, calendar_ops, engagement, groups


def test_zscore_edges(spark):
    data = [("one", 5.0), ("flat", 2.0), ("flat", 2.0)] + [("many", float(v)) for v in [1] * 30 + [100]] + [(None, 1.0), (None, 3.0)]
    got = anomaly.zscore(spark.createDataFrame(data, "g string, v double"), "v", ["g"]).collect()
    by = {}
    for r in got:
        by.setdefault(r["g"], []).append(r)
    assert by["one"][0]["group_stddev"] == 1.0 and by["one"][0]["z_score"] == 0.0
    assert all(r["z_score"] == 0.0 and not r["is_anomaly"] for r in by["flat"])
    top = max(by["many"], key=lambda r: r["v"])
    values = [1.0] * 30 + [100.0]
    assert top["z_score"] == pytest.approx((100 - statistics.mean(values)) / statistics.stdev(values))
    assert top["severity"] == "CRITICA" and top["is_anomaly"]
    assert len(by[None]) == 2 and all(r["group_mean"] == 2.0 for r in by[None])


def test_zscore_two_sided(spark):
    df = spark.createDataFrame([("g", float(v)) for v in [10] * 30 + [-90]], "g string, v double")
    assert anomaly.anomalies(anomaly.zscore(df, "v", ["g"])).count() == 0
    assert anomaly.anomalies(anomaly.zscore(df, "v", ["g"], two_sided=True)).count() == 1


def test_zscore_of_facts_is_not_shuffled(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("v"))
    plan = anomaly.zscore(df, "v", ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "Window" not in plan


def test_rank_entities_counts_distinct_members(spark):
    df = spark.createDataFrame([("12345678901", "B", 1, 60_000), ("12345678901", "A", 1, 60_000), ("", "x", 1, 1), (None, "x", 1, 1)], "s string, n string, m int, v int")
    got = anomaly.rank_entities(df, "s", "v", "m", "n").collect()
    assert len(got) == 1
    assert (got[0]["n"], got[0]["n_members"], got[0]["n_documents"], got[0]["n_flags"], got[0]["mean_value"]) == ("B", 1, 2, 2, 60_000.0)
    assert anomaly.rank_entities(df, "s", "v", "m", "n", split_by_name=True).count() == 2


def edges_of(rng, members, groups_, n):
    return sorted({(rng.randrange(groups_), rng.randrange(members) ** 2 // members) for _ in range(n)})


@pytest.mark.parametrize("heavy", [0, 3, 10_000])
def test_overlap_pairs_by_brute_force(spark, heavy, monkeypatch):
    """All heavy, mixed and all light members give the same exact counts."""
    rng = random.Random(5)
    edges = edges_of(rng, 150, 40, 900) + [(g, 999) for g in range(40)]
    want = {}
    sets = {}
    for g, m in edges:
        sets.setdefault(g, set()).add(m)
    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] & sets[b]:
            want[a, b] = len(sets[a] & sets[b])
    df = spark.createDataFrame(edges + edges[:10] + [(None, 1)], "g int, m int")
    for size in (1000, 3):
        monkeypatch.setattr(groups, "BLOCK_GROUPS", size)
        got = {(r["g_a"], r["g_b"]): r["shared"] for r in groups.overlap_pairs(df, "g", "m", heavy_degree=heavy).collect()}
        assert got == want


def test_hhi(spark):
    df = spark.createDataFrame([(1, "A"), (1, "A"), (1, "B"), (1, "C"), (2, "A")], "g int, p string")
    got = {r["g"]: r for r in groups.hhi(df, "g", "p").collect()}
    assert got[1]["hhi"] == pytest.approx(0.375) and got[1]["n_parts"] == 3 and got[1]["effective_parts"] == pytest.approx(1 / 0.375)
    assert got[2]["hhi"] == 1.0


def test_memberships_pages_keep_everything(spark):
    df = spark.createDataFrame([(m, g, f"t{g:03}") for m in (1, 2) for g in range(m * 25)] + [(1, 0, "t000")], "m int, g int, t string")
    got = groups.memberships(df, "m", "g", "t", page_size=10).collect()
    assert {r["m"]: r["n_groups"] for r in got} == {1: 25, 2: 50}
    assert max(len(r["labels"]) for r in got) == 10
    assert sorted(t for r in got if r["m"] == 2 for t in r["labels"]) == [f"t{g:03}" for g in range(50)]


def test_cohesion_is_tie_proof_and_label_is_one(spark):
    votes = spark.createDataFrame([(1, 1, "S"), (1, 1, "N"), (1, 2, "S"), (1, 2, "S"), (1, 2, "N")], "g int, s int, c string")
    got = groups.cohesion(votes, "g", "s", "c")
    row = got.first()
    assert row["mean_cohesion"] == pytest.approx((1 / 2 + 2 / 3) / 2) and row["n_sessions"] == 2
    labels = spark.createDataFrame([(1, "a"), (1, "b")], "g int, t string")
    assert [r["t"] for r in groups.with_label(got, labels, "g", "t").collect()] == ["b"]


def test_compare_cohesion_needs_both(spark):
    some = spark.createDataFrame([(0.5,), (0.7,)], "mean_cohesion double")
    none = some.limit(0)
    assert groups.compare_cohesion(some, none).first()["verdict"] is None
    assert groups.compare_cohesion(some, some.filter("mean_cohesion < 0.6")).first()["verdict"] == "a"


def test_score_without_events(spark):
    members = spark.createDataFrame([(1,), (2,)], "k int")
    facts = spark.createDataFrame([(1,)], "k int")
    nothing = facts.limit(0).agg(F.count(F.lit(1)))
    got = {r["k"]: r["engagement_score"] for r in engagement.score(members, "k", [("p", facts, nothing, 0.4), ("v", facts, facts.agg(F.count(F.lit(1))), 0.6)]).collect()}
    assert got == {1: pytest.approx(0.6), 2: 0.0}


@pytest.mark.parametrize("page_bodies", [1, 2, 100])
def test_absences_by_brute_force(spark, page_bodies):
    """A session listed under two bodies, a null body, repeated votes; all page sizes agree with the product."""
    rng = random.Random(3)
    votes = [(rng.randrange(6), s, rng.choice(["A", "B", None]) if s == 4 else ("A" if s % 2 else "")) for s in range(12) for _ in range(4)]
    members = list(range(8))
    listed = {(s, b) for _, s, b in votes}
    cast = {(m, s) for m, s, _ in votes}
    want = {}
    for m in members:
        for s, b in listed:
            if (m, s) not in cast:
                want[m, b] = want.get((m, b), 0) + 1
    got = engagement.absences(
        spark.createDataFrame([(m, f"n{m}") for m in members], "m int, name string"),
        spark.createDataFrame(votes, "m int, s int, b string"), "m", "s", "b", ["name"], page_bodies,
    ).collect()
    assert {(r["m"], r["b"]): r["n_missed"] for r in got} == want
    assert len(got) == len(want)


def test_monthly_series_fills_both_sides(spark):
    a = spark.sql("SELECT 1 AS k, DATE'2024-01-05' AS d")
    b = spark.sql("SELECT 1 AS k, DATE'2024-02-05' AS d")
    got = sorted(tuple(r) for r in engagement.monthly_series(a, b, "k", "d").collect())
    assert got == [(1, 2024, 1, 1, 0, 1), (1, 2024, 2, 0, 1, 1)]


def test_week_index_cuts_toward_zero(spark):
    df = spark.sql("SELECT explode(array(DATE'2023-01-01', DATE'2023-01-07', DATE'2023-01-08', DATE'2022-12-20')) AS d")
    assert [r[0] for r in df.select(C.week_index(F.col("d"))).collect()] == [1, 1, 2, 0]


def test_weekly_density_keeps_empty_weeks(spark):
    cal = spark.sql("SELECT * FROM VALUES (DATE'2023-01-01', 'x', 3L), (DATE'2023-01-02', 'y', 1L), (DATE'2023-01-16', 'x', 0L) AS t(d, k, n_present)")
    got = [tuple(r) for r in calendar_ops.weekly_density(cal, "d", "k", "2023-01-01", "2023-01-21").collect()]
    assert got == [(1, 2, 4, ["x", "y"], 2.0, False), (2, 0, 0, [], 0.0, True), (3, 1, 0, ["x"], 0.0, False)]


def test_election_periods(spark):
    df = spark.createDataFrame([(2022, 8), (2022, 4), (2022, 11), (2022, 1), (2023, 8)], "y int, m int")
    got = [r[0] for r in df.select(C.election_period(F.col("y"), F.col("m"))).collect()]
    assert got == ["ELEITORAL", "PRE_ELEITORAL", "POS_ELEITORAL", "REGULAR", "REGULAR"]


def test_upcoming_leaves_out_null_status(spark):
    df = spark.sql("SELECT * FROM VALUES (DATE'2030-01-01', 'Agendada'), (DATE'2030-01-01', 'Encerrada'), (DATE'2030-01-01', NULL), (DATE'2020-01-01', 'Agendada') AS t(d, s)")
    assert calendar_ops.upcoming(df, "d", "s", "2029-01-01").count() == 1


def test_top_k_per_group_cuts_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    got = anomaly.top_k(df, [F.col("v").desc()], 2, ["g"])
    assert sorted((r["g"], r["v"]) for r in got.collect()) == [(0, 996), (0, 999), (1, 994), (1, 997), (2, 995), (2, 998)]
    assert "row_number(), 2, Partial" in got._jdf.queryExecution().executedPlan().toString()


def test_percentile_against_window_on_ties(spark):
    df = spark.range(50).select("id", (F.col("id") % 7).cast("double").alias("s"))
    got = {r["id"]: round(r["percentile"], 9) for r in engagement.percentile(df, "s").collect()}
    want = {r["id"]: round(r["p"], 9) for r in df.withColumn("p", F.percent_rank().over(Window.orderBy("s"))).collect()}
    assert got == want
