"""History: build, refresh, point in time, durations; incremental loading."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from medalytics.operators import calendar_ops, incremental, ingest, merge, scd
from medalytics.sources import tables

SCHEMA = "k int, seq long, ts timestamp, state string"


def steps(spark, data):
    return spark.createDataFrame(data, "k int, seq long, ts string, state string").withColumn("ts", F.to_timestamp("ts"))


def random_history(rng, n=400):
    """One key holds a third of the rows; some steps share a moment."""
    out, seq = [], 0
    for i in range(n):
        seq += rng.choice([1, 1, 40])
        key = 0 if i % 3 == 0 else rng.randrange(1, 9)
        out.append((key, seq, str(date(2024, 1, 1) + timedelta(days=i // 2)), f"s{i}"))
    return out


@pytest.mark.parametrize("parts", [1, 4, 40, 500])
def test_build_is_independent_of_the_ranges(spark, parts):
    data = random_history(random.Random(1))
    got = scd.build(steps(spark, data), "k", "seq", "ts", parts).collect()
    assert len(got) == len(data)
    by = {}
    for r in got:
        by.setdefault(r["k"], []).append(r)
    for versions in by.values():
        versions.sort(key=lambda r: r["seq"])
        assert [r["valid_to"] for r in versions] == [r["valid_from"] for r in versions[1:]] + [None]
        assert [r["is_current"] for r in versions] == [False] * (len(versions) - 1) + [True]


def test_build_keeps_rows_without_order_and_drops_null_keys(spark):
    data = [(1, None, "2024-01-01", "a"), (1, 5, "2024-01-02", "b"), (None, 1, "2024-01-01", "c")]
    got = {r["state"]: str(r["valid_to"]) for r in scd.build(steps(spark, data), "k", "seq", "ts").collect()}
    assert got == {"a": "2024-01-02 00:00:00", "b": "None"}


def test_order_is_by_number_not_text(spark):
    data = [(1, 9, "2024-01-01", "a"), (1, 10, "2024-01-02", "b")]
    assert {r["seq"] for r in scd.build(steps(spark, data), "k", "seq", "ts").filter("is_current").collect()} == {10}


def test_refresh_equals_full_build(spark):
    data = random_history(random.Random(2), 120)
    rng = random.Random(3)
    late = [r for r in data if rng.random() < 0.2]
    first = [r for r in data if r not in late]
    history = scd.build(steps(spark, first), "k", "seq", "ts")
    repeated = late + first[:3]
    got = scd.refresh(history, steps(spark, repeated), "k", "seq", "ts")
    want = scd.build(steps(spark, data), "k", "seq", "ts")
    assert sorted(map(tuple, got.select(want.columns).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


@pytest.mark.parametrize("parts", [1, 50])
def test_as_of_join_by_brute_force(spark, parts):
    data = random_history(random.Random(4))
    history = scd.build(steps(spark, data), "k", "seq", "ts")
    rng = random.Random(5)
    probes = [(i, rng.randrange(0, 11), f"2024-{rng.randrange(1, 13):02}-{rng.randrange(1, 29):02} 0{rng.randrange(0, 2)}:00:00") for i in range(200)]
    probes += [(900, None, "2024-05-05 00:00:00"), (901, 1, None), (902, 1, "2020-01-01 00:00:00")]
    df = spark.createDataFrame(probes, "p int, k int, at string").withColumn("at", F.to_timestamp("at"))
    got = {r["p"]: r["state"] for r in scd.as_of_join(df, history, "k", "at", "seq", ["state"], parts).collect()}
    versions = history.collect()
    want = {}
    for p in df.collect():
        found = [v for v in versions if p["at"] and v["k"] == p["k"] and v["valid_from"] <= p["at"] and (v["is_current"] or v["valid_to"] > p["at"])]
        assert len(found) <= 1
        want[p["p"]] = found[0]["state"] if found else None
    assert got == want


def test_as_of_join_of_a_busy_key_and_day(spark):
    """A third of the rows and versions have one key and one day; they take several ranges."""
    moment = lambda i: f"2024-01-02 {i // 3600:02d}:{i // 60 % 60:02d}:{i % 60:02d}"
    data = [(0, i, moment(10 * i), f"s{i}") for i in range(400)] + [(1 + i % 7, i, f"2024-02-{1 + i // 40:02d}", f"t{i}") for i in range(800)]
    history = scd.build(steps(spark, data), "k", "seq", "ts", 6)
    probes = spark.createDataFrame([(i, 0 if i % 3 == 0 else 1 + i % 7, moment(4 * i)) for i in range(1200)], "p int, k int, at string")
    probes = probes.withColumn("at", F.to_timestamp("at"))
    found = scd.as_of_join(probes, history, "k", "at", "seq", ["state"], 6)
    got = {r.p: r.state for r in found.collect()}
    assert got == {i: (f"s{min(4 * i // 10, 399)}" if i % 3 == 0 else None) for i in range(1200)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert all("__part" in line or "__at" in line for line in plan.splitlines() if "Window [" in line)


def test_as_of_literal(spark):
    history = scd.build(steps(spark, [(1, 1, "2024-01-01", "a"), (1, 2, "2024-06-15", "b")]), "k", "seq", "ts")
    assert [r["state"] for r in scd.as_of(history, "2024-06-14").collect()] == ["a"]
    assert [r["state"] for r in scd.as_of(history, "2024-06-15").collect()] == ["b"]
    assert scd.as_of(history, "2023-01-01").count() == 0


def test_durations_need_a_day(spark):
    data = [(1, 1, "2024-01-01", "a"), (1, 2, "2024-01-11", "b"), (2, 1, "2024-01-01", "a")]
    spans = scd.durations(scd.build(steps(spark, data), "k", "seq", "ts"), ["k"], "state").collect()
    assert [(r["k"], r["days"], r["n_steps"], r["last_body"]) for r in spans] == [(1, 10, 2, "b")]


def control(spark, rows):
    return spark.createDataFrame(rows, incremental.CONTROL_SCHEMA)


def test_watermark_first_run_and_default(spark):
    empty = control(spark, [])
    assert incremental.watermark_get(empty, "votes") is None
    assert incremental.watermark_get(empty, "votes", "2023-02") == "2023-02"
    assert incremental.watermark_get(control(spark, [("votes", "", "t")]), "votes") is None


def test_watermark_set_takes_the_first_given(spark):
    table = incremental.watermark_set(control(spark, [("a", "1", "t")]), "b", last_date="2024-05", now="x")
    table = incremental.watermark_set(table, "a", last_id=10, now="y")
    assert {r["endpoint"]: r["last_value"] for r in table.collect()} == {"a": "10", "b": "2024-05"}


def test_newer_than_is_typed_and_pushed(spark, tmp_path):
    path = str(tmp_path / "ids")
    spark.createDataFrame([(9,), (10,), (11,)], "id long").write.parquet(path)
    got = incremental.newer_than(spark.read.parquet(path), "id", "9")
    assert sorted(r[0] for r in got.collect()) == [10, 11]
    assert "GreaterThan(id,9)" in got._jdf.queryExecution().executedPlan().toString()
    assert incremental.newer_than(got, "id", None).count() == 2


def test_period_plan_rolls_over_december(spark):
    months = [tuple(r) for r in incremental.period_plan(spark, "2023-11", "2024-02", "2023-01").collect()]
    assert months == [(2023, 12), (2024, 1), (2024, 2)]
    assert incremental.period_plan(spark, "2024-02", "2024-02", "2023-01").count() == 0
    assert incremental.period_plan(spark, None, "2023-03", "2023-01").count() == 3


def test_missing_children(spark):
    parents = spark.createDataFrame([(3,), (1,), (2,)], "k int")
    assert [r[0] for r in incremental.missing_children(parents, parents.filter("k = 2"), "k").collect()] == [1, 3]


def test_full_load_decision(spark):
    assert incremental.is_full_load(spark, "no_such_table", "5")
    assert incremental.is_full_load(spark, "no_such_table", None)


def test_upsert_null_keys_never_match(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    source = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], "k int, v string")
    got = sorted((tuple(r) for r in merge.upsert(target, source, ["k"]).collect()), key=repr)
    assert got == sorted([(1, "a"), (2, "B"), (3, "C"), (None, "n"), (None, "N")], key=repr)
    assert merge.upsert(None, source, ["k"]).count() == 3


def test_cdc_and_conditional_upsert(spark):
    old = spark.createDataFrame([(1, "x", "h1"), (2, "y", "h2"), (3, "z", None)], "k int, v string, h string")
    new = spark.createDataFrame([(1, "X", "h1"), (2, "Y", "h9"), (3, "Z", None), (4, "W", "h4")], "k int, v string, h string")
    got = {r["k"]: r["change"] for r in merge.cdc_classify(old, new, ["k"], "h").collect()}
    assert got == {1: "UNCHANGED", 2: "UPDATE", 3: "UNCHANGED", 4: "INSERT"}
    kept = {r["k"]: r["v"] for r in merge.upsert_changed(old, new, ["k"], "h").collect()}
    assert kept == {1: "x", 2: "Y", 3: "z", 4: "W"}


def test_concat_batches_with_different_columns(spark):
    a, b = spark.sql("SELECT 1 AS x"), spark.sql("SELECT 2 AS x, 'y' AS y")
    assert sorted((tuple(r) for r in merge.concat_batches([a, b]).collect()), key=repr) == [(1, None), (2, "y")]


def test_unparsed_times_are_no_versions(spark):
    data = [(1, 1, "2024-01-01", "a"), (1, 2, "nonsense", "b"), (1, 3, "2024-01-05", "c"), (2, 1, None, "d"), (2, 2, "2024-01-02", "e"), (2, 3, "bad", "f")]
    rows = spark.createDataFrame(data, "k int, seq long, ts string, state string").withColumn("ts", F.expr("try_cast(ts AS timestamp)"))
    built = scd.build(rows, "k", "seq", "ts")
    assert {(r["state"], r["is_current"]) for r in built.collect()} == {("a", False), ("c", True), ("e", True)}
    assert {r["state"] for r in scd.unplaced(rows, "k", "ts").collect()} == {"b", "d", "f"}


@pytest.mark.parametrize("seed", range(3))
def test_as_of_join_equals_the_predicate_join_with_nulls(spark, seed):
    rng = random.Random(seed)
    data = [(k, s, t if rng.random() > 0.2 else None, st) for k, s, t, st in random_history(rng, 150)]
    history = scd.build(steps(spark, data), "k", "seq", "ts")
    probes = spark.createDataFrame([(i, rng.randrange(0, 10), str(date(2023, 12, 20) + timedelta(days=rng.randrange(120))) if i % 9 else None) for i in range(200)], "i int, k int, at string").withColumn("at", F.to_timestamp("at"))
    got = scd.as_of_join(probes, history, "k", "at", "seq", ["state"])
    h = history.select(F.col("k").alias("hk"), "valid_from", "valid_to", "is_current", "state")
    same = (F.col("k") == F.col("hk")) & (F.col("valid_from") <= F.col("at")) & ((F.col("valid_to") > F.col("at")) | F.col("is_current"))
    want = probes.join(h, same, "left")
    assert sorted((r["i"], str(r["state"])) for r in got.collect()) == sorted((r["i"], str(r["state"])) for r in want.collect())


def test_as_of_join_wants_times_in_order(spark):
    history = scd.build(steps(spark, [(1, 1, "2024-02-01", "a"), (1, 2, "2024-01-01", "b")]), "k", "seq", "ts")
    probes = spark.createDataFrame([(1, "2024-03-01")], "k int, at string").withColumn("at", F.to_timestamp("at"))
    with pytest.raises(Exception, match="decrease"):
        scd.as_of_join(probes, history, "k", "at", "seq", ["state"]).collect()


def test_upsert_keeps_columns_and_rejects_repeats(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (None, "n", "z")], "id int, a string, extra string")
    source = spark.createDataFrame([(2, "B", 1), (3, "C", 2), (None, "N", 3)], "id int, a string, new int")
    got = merge.upsert(target, source, ["id"])
    assert got.columns == ["id", "a", "extra", "new"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [(1, "a", "x", None), (None, "n", "z", None), (2, "B", "y", 1), (3, "C", None, 2), (None, "N", None, 3)]))
    with pytest.raises(ValueError, match="2 rows"):
        merge.upsert(target, source.union(source), ["id"])


def test_upsert_path_switches_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    assert tables.upsert_path(spark, path, frame([(1, "a", "x"), (2, "b", "y")], "id int, a string, extra string"), ["id"]) == 2
    assert tables.upsert_path(spark, path, frame([(2, "B", 7), (3, "C", 8)], "id int, a string, new int"), ["id"]) == 3
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "a", "x", None), (2, "B", "y", 7), (3, "C", None, 8)]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]
    (tmp_path / "t").rename(tmp_path / "t__old")  # lost between the two renames
    assert tables.upsert_path(spark, path, frame([(1, "A")], "id int, a string"), ["id"]) == 3
    with pytest.raises(ValueError):
        tables.upsert_path(spark, path, frame([(9, "A"), (9, "B")], "id int, a string"), ["id"])
    assert spark.read.parquet(path).count() == 3


def test_changes_between_null_fields_are_seen(spark):
    old = spark.createDataFrame([(1, None, "x"), (2, "ab", "c"), (3, None, None)], "id int, a string, b string")
    new = spark.createDataFrame([(1, "x", None), (2, "a", "bc"), (3, None, None)], "id int, a string, b string")
    for json in (True, False):
        found = merge.cdc_classify(*[ingest.payload_hash(f, ["a", "b"], "h", json) for f in (old, new)], ["id"], "h")
        assert [r["change"] for r in found.orderBy("id").collect()] == ["UPDATE", "UPDATE", "UNCHANGED"]


def test_weeks_hold_every_event(spark):
    days = ["2024-01-01", "2024-01-20", "2023-12-01", None, "2024-03-01"]
    cal = spark.createDataFrame([(d, "k", 1) for d in days], "d string, kind string, n_present long").withColumn("d", F.to_date("d"))
    for span in ({}, {"first": "2024-01-01", "last": "2024-01-31"}, {"first": "2024-01-01"}):
        weeks = calendar_ops.weekly_density(cal, "d", "kind", **span).collect()
        assert sum(r["n_events"] for r in weeks) == 5 and sum(r["week"] is None for r in weeks) == 1
        numbers = [r["week"] for r in weeks if r["week"] is not None]
        assert numbers == list(range(min(numbers), max(numbers) + 1))


def test_the_alert_is_on_all_errors_together(spark):
    rows = [("ok", True)] * 94 + [(k, False) for k in "aabbcc"]
    got = ingest.error_histogram(spark.createDataFrame(rows, "kind string, ok boolean"), F.col("kind"), F.col("ok")).collect()
    assert [(r["n_errors"], round(r["total_rate"], 6), r["alert"]) for r in got] == [(2, 0.06, True)] * 3
