"""Loads that resume, compaction by bins, quarantine loads, schemas merged from records, gaps by masks."""

import itertools
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from medalytics.operators import ingest
from medalytics.operators.quality import Expectation
from medalytics.sources import compaction, pages, resume, tables


def units(spark, months=6, members=4):
    return spark.createDataFrame([(f"2024-{m:02d}", k) for m in range(1, months + 1) for k in range(members)], "month string, member int")


class Source:
    """Rows of units: `member` rows each; counts what is fetched and can break."""

    def __init__(self):
        self.fetched, self.broken = [], None

    def __call__(self, some):
        months = sorted(r.month for r in some.dropna().select("month").distinct().collect())
        self.fetched += months
        if self.broken in months:
            raise OSError("lost")
        rows = some.withColumn("n", F.explode(F.sequence(F.lit(0), F.col("member")))).filter("n > 0")
        return rows.select("member", "n", "month")


def loaded(spark, path, plan):
    rows = resume.finished_rows(spark, path, Source()(plan).schema, "month")
    return sorted((r.month, r.member, r.n) for r in rows.collect())


def expected(months, members=4):
    return sorted((f"2024-{m:02d}", k, n) for m in range(1, months + 1) for k in range(members) for n in range(1, k + 1))


def test_a_stopped_load_goes_on(spark, tmp_path):
    plan, path, source = units(spark), str(tmp_path / "load"), Source()
    assert loaded(spark, path, plan) == []
    assert resume.load(plan, "month", source, path, at_once=2, stop_after=1) == 2
    assert loaded(spark, path, plan) == expected(2)
    source.broken = "2024-05"
    with pytest.raises(OSError):
        resume.load(plan, "month", source, path, at_once=2)
    assert loaded(spark, path, plan) == expected(4)
    source.broken, source.fetched = None, []
    assert resume.load(plan, "month", source, path, at_once=2) == 2 and source.fetched == ["2024-05", "2024-06"]
    assert loaded(spark, path, plan) == expected(6)
    assert resume.load(plan, "month", source, path) == 0


def test_rows_without_a_ledger_line_are_not_read_and_are_replaced(spark, tmp_path, monkeypatch):
    plan, path = units(spark, 3), str(tmp_path / "load")

    def lost(*_):
        raise OSError("lost")

    whole = resume.finish
    monkeypatch.setattr(resume, "finish", lost)
    with pytest.raises(OSError):
        resume.load(plan, "month", Source(), path, at_once=3)
    monkeypatch.setattr(resume, "finish", whole)
    assert spark.read.parquet(f"{path}/rows").count() > 0 and loaded(spark, path, plan) == []
    assert resume.load(plan, "month", Source(), path) == 3 and loaded(spark, path, plan) == expected(3)


def test_a_changed_plan_loads_its_changed_steps(spark, tmp_path):
    path, source = str(tmp_path / "load"), Source()
    resume.load(units(spark, 3), "month", source, path)
    more = units(spark, 4).union(spark.createDataFrame([("2024-02", 9)], "month string, member int"))
    source.fetched = []
    assert resume.load(more, "month", source, path) == 2 and source.fetched == ["2024-02", "2024-04"]
    assert len(loaded(spark, path, more)) == len(expected(4)) + 9
    lines = resume.ledger(spark, path, more.schema["month"]).orderBy("month").collect()
    assert [(r.month, r.n_units, r.n_rows) for r in lines] == [("2024-01", 4, 6), ("2024-02", 5, 15), ("2024-03", 4, 6), ("2024-04", 4, 6)]


def test_steps_of_any_text(spark, tmp_path, monkeypatch):
    plan, path = spark.createDataFrame([("a:b/c", 2), ("x=y %", 1), (None, 3)], "month string, member int"), str(tmp_path / "load")
    whole = resume.finish
    monkeypatch.setattr(resume, "finish", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        resume.load(plan, "month", Source(), path)
    monkeypatch.setattr(resume, "finish", whole)
    none = lambda some: Source()(some).filter("false")
    assert resume.load(plan, "month", none, path) == 2 and loaded(spark, path, plan) == []
    assert spark.read.schema(Source()(plan).schema).parquet(f"{path}/rows").count() == 0  # what the first attempt left is gone


def test_a_step_without_rows_is_finished(spark, tmp_path):
    plan, path = units(spark, 2, 1), str(tmp_path / "load")
    assert resume.load(plan, "month", Source(), path) == 2 and resume.load(plan, "month", Source(), path) == 0
    assert loaded(spark, path, plan) == []


# compaction --------------------------------------------------------------------------------------


def table_of_small_files(spark, path):
    rows = spark.range(4000).select("id", F.sha1(F.col("id").cast("string")).alias("text"), (F.col("id") % 3).alias("p"))
    rows.filter("p < 2").repartition(30).write.partitionBy("p").parquet(path)
    rows.filter("p = 2").coalesce(1).write.mode("append").partitionBy("p").parquet(path)
    return sorted(map(tuple, rows.collect()))


def files(path):
    return {str(f): f.stat().st_size for f in Path(path).rglob("*.parquet")}


def test_small_files_are_joined_and_large_ones_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = table_of_small_files(spark, path)
    before = files(path)
    large = {f for f in before if "p=2" in f}
    target = 40_000
    done = compaction.compact(spark, path, target, sort_by=["id"])
    after = files(path)
    assert sorted(map(tuple, spark.read.parquet(path).select("id", "text", "p").collect())) == rows
    assert large <= set(after) and done == {"removed": len(before) - 1, "added": len(after) - 1}
    smallest = max(s for f, s in before.items() if f not in large)
    assert len(after) < len(before) / 4 and all(s <= target + smallest + 4000 for f, s in after.items() if f not in large)
    assert not (Path(path) / compaction.JOURNAL).exists()
    assert compaction.compact(spark, path, 1000) == {"removed": 0, "added": 0}


@pytest.mark.parametrize("where", ["before", "after"])
def test_a_stopped_compaction_is_completed_or_forgotten(spark, tmp_path, monkeypatch, where):
    path = str(tmp_path / "t")
    rows = table_of_small_files(spark, path)
    before = files(path)
    whole, calls = compaction.complete, itertools.count()

    def lost(spark, path):
        if next(calls):
            raise OSError("lost")  # the call after the marker was set

    monkeypatch.setattr(compaction, "complete", lost)
    with pytest.raises(OSError):
        compaction.compact(spark, path, 40_000)
    if where == "before":
        (Path(path) / compaction.JOURNAL / "READY").unlink()
    whole(spark, path)
    assert (files(path) == before) == (where == "before") and not (Path(path) / compaction.JOURNAL).exists()
    assert sorted(map(tuple, spark.read.parquet(path).select("id", "text", "p").collect())) == rows


def test_partitions_of_any_name_are_compacted(spark, tmp_path):
    path = str(tmp_path / "a b=c")
    names = F.array(*[F.lit(x) for x in ("x y", "a:b%c", "d/e=f", "ü")])
    rows = spark.range(400).select("id", F.element_at(names, (F.col("id") % 4 + 1).cast("int")).alias("p"))
    rows.repartition(12).write.partitionBy("p").parquet(path)
    before = files(path)
    done = compaction.compact(spark, path, 1 << 20)
    assert done == {"removed": len(before), "added": 4} and len(files(path)) == 4
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == sorted(map(tuple, rows.collect()))


def test_bins_hold_the_target(spark):
    rng = random.Random(2)
    listed = [(f"/d{f}/{i}", f"/d{f}", rng.randrange(1, 120)) for f in range(3) for i in range(40)] + [("/e/1", "/e", 5), ("/d0/big", "/d0", 100_000)]
    df = spark.createDataFrame(listed, "file string, folder string, bytes long")
    found = {}
    for r in compaction.packed(df, 200, 0.5).collect():
        found.setdefault((r.folder, r.bin), []).append(r.bytes)
    assert all(len(b) > 1 and sum(b) < 300 for b in found.values()) and all(f != "/e" for f, _ in found)
    assert max(max(b) for b in found.values()) < 100


def test_column_statistics(spark):
    spark.range(10).write.mode("overwrite").saveAsTable("stats_of_columns")
    tables.statistics(spark, "stats_of_columns", ["id"])
    found = {r.info_name: r.info_value for r in spark.sql("DESCRIBE EXTENDED stats_of_columns id").collect()}
    assert (found["min"], found["max"]) == ("0", "9")


# quarantine --------------------------------------------------------------------------------------


def rules():
    return [Expectation("id", F.col("i").isNotNull(), "DROP"), Expectation("low", F.col("v") < 5, "DROP"), Expectation("even", F.col("v") % 2 == 0)]


def test_kept_and_rejected_rows_are_all_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(i if i % 4 else None, i if i % 5 else None) for i in range(20)], "i int, v int")
    for _ in range(2):  # a load that is repeated replaces itself
        tables.write_split(df, rules(), path)
    found = spark.read.parquet(path).withColumn("_rejected", F.col("_rejected").cast("boolean"))
    assert sorted(map(tuple, found.select("i", "v").collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    for r in found.collect():
        broken = [n for n, ok in (("id", r.i is not None), ("low", r.v is not None and r.v < 5), ("even", r.v is not None and r.v % 2 == 0)) if not ok]
        assert r._broken == broken and r._rejected == bool({"id", "low"} & set(broken))


def test_a_replay_takes_rows_out_of_quarantine(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 1), (2, 9), (None, 3), (None, 9)], "i int, v int")
    tables.write_split(df, rules(), path)
    mended = lambda rows: rows.withColumn("v", F.least("v", F.lit(4)))
    for _ in range(2):
        tables.replay_rejected(spark, path, "first", mended, rules(), "second")
    kept = sorted((r.i, r.v, r._load) for r in spark.read.parquet(path).filter("NOT _rejected").collect())
    assert kept == [(1, 1, "first"), (2, 4, "second")]
    assert sorted((r.v, tuple(r._broken)) for r in tables.quarantined(spark, path, "second").collect()) == [(3, ("id", "even")), (4, ("id",))]


# schemas and gaps --------------------------------------------------------------------------------


def test_late_keys_become_columns(spark):
    texts = ['{"a": 1}', '{"b": "x", "a": 2.5}', '{"c": {"d": [1, 2]}, "odd key": true}', '{"a": null, "b": 7}', "[1]", "no json", None, "{}"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, record string")
    found = pages.with_merged_schema(df)
    assert found.columns == ["i", "a", "b", "c", "odd key"]
    rows = {r.i: r for r in found.collect()}
    assert len(rows) == len(texts)
    assert [float(rows[i].a) if rows[i].a is not None else None for i in (0, 1, 3)] == [1.0, 2.5, None]
    assert rows[1].b == "x" and rows[3].b == "7" and rows[2]["odd key"] is True and list(rows[2].c.d) == [1, 2]
    assert all(rows[i][c] is None for i in (4, 5, 6, 7) for c in found.columns[1:])
    odd = spark.createDataFrame([('{"VOID": 1, "it\'s": "OBJECT<", "VARIANT x": [1], "n": null, "mix": 1}',), ('{"mix": "a"}',)], "record string")
    rows = sorted((r.VOID or 0, r["it's"], r["VARIANT x"], r.n, r.mix) for r in pages.with_merged_schema(odd).collect())
    assert rows == [(0, None, None, None, "a"), (1, "OBJECT<", [1], None, "1")]
    assert pages.with_merged_schema(df.limit(0)).columns == ["i"] and pages.with_merged_schema(df.filter("i > 3")).columns == ["i"]


@pytest.mark.parametrize("start,end", [("2020-11", "2021-02"), ("1990-01", "2003-07"), ("2020-05", "2020-04")])
def test_gaps_equal_the_grid_less_what_is_seen(spark, start, end):
    rng = random.Random(start)
    seen = [(rng.choice([None, 1, 2, 3, 9]), rng.randrange(1989, 2022), rng.randrange(1, 14)) for _ in range(700)]
    ids = spark.createDataFrame([(1,), (2,), (3,), (4,), (4,), (None,)], "m int")
    observed = spark.createDataFrame(seen, "m int, y int, mo int")
    got = ingest.grid_gaps(ids, observed, "m", "y", "mo", start, end)
    if start > end:
        assert got.count() == 0
        return
    grid = ingest.expected_grid(ids, start, end)
    want = grid.join(observed.selectExpr("m", "y AS year", "mo AS month"), ["m", "year", "month"], "left_anti")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert "BroadcastNestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
