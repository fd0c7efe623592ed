"""Landed pages, tables of the layers, outcomes, audit, run log."""

import itertools
import json
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalytics.functions import columns as C
from medalytics.operators import ingest, runlog
from medalytics.sources import pages, tables

RECORD = T.StructType([T.StructField("id", T.LongType()), T.StructField("nome", T.StringType())])


@pytest.fixture
def landed(spark, tmp_path):
    found = {
        "1": {"dados": [{"id": 1, "nome": "Ana"}, {"id": 2}], "links": [{"rel": "self"}, {"rel": "next"}]},
        "2": {"dados": {"id": 3, "nome": "Rui"}, "links": [{"rel": "next"}]},
        "3": {"dados": [], "links": [{"rel": "next"}]},
        "4": {"dados": [{"id": 4}], "links": []},
        "5": {"dados": "text"},
        "6": {"links": []},
    }
    for name, page in found.items():
        (tmp_path / f"page{name}.json").write_text(json.dumps(page))
    return pages.read_pages(spark, str(tmp_path)).withColumn("no", F.regexp_extract("page", r"page(\d)", 1).cast("int"))


def test_envelope(landed):
    got = sorted(tuple(r) for r in pages.explode_envelope(landed.drop("page"), RECORD).fillna("").collect())
    assert got == [(1, 1, "Ana"), (1, 2, ""), (2, 3, "Rui"), (4, 4, "")]
    kinds = {r["kind"]: r["n_pages"] for r in pages.page_report(landed).collect()}
    assert kinds == {"list": 2, "object": 1, "missing": 2, "other": 1}


def test_pages_are_written_one_to_a_file(spark, tmp_path):
    made = spark.range(0, 500, 1, 7).selectExpr("concat('{\"dados\": [', id, ',\n', id + 1, ']}') AS value", "id")
    folder = tmp_path / "landing"
    pages.write_pages(made, str(folder))
    assert sorted(p.read_text().rstrip("\n") for p in folder.glob("part-*")) == sorted(r["value"] for r in made.collect())
    assert len(list(folder.glob("part-*"))) == pages.read_pages(spark, str(folder)).count() == 500 and not list(folder.glob("_temporary*"))


def test_a_page_without_payload_ends_the_set(landed):
    got = pages.until_end(landed.withColumn("e", F.lit("x")), ["e"], "no")
    assert sorted(r["no"] for r in got.collect()) == [1, 2]


def test_flatten_and_rescue(spark):
    raw = spark.createDataFrame([('{"id": 1, "nome": "Ana", "novo": {"a": 1}}',), ('{"id": 2}',)], "value string")
    got = {r["id"]: r["_rescued"] for r in pages.rescue(raw, "value", RECORD).collect()}
    assert json.loads(got[1]) == {"novo": '{"a":1}'} and got[2] is None
    nested = spark.sql("SELECT 1 AS id, array(1) AS l, named_struct('p', 'X', 'g', named_struct('n', 'Z')) AS s")
    assert pages.flatten_struct(nested, {"s": "status_", "s.g": "gab_"}).columns == ["id", "status_p", "gab_n"]


def test_categories_become_a_column(spark, tmp_path):
    for kind in ("PL", "PEC"):
        (tmp_path / f"tipo={kind}").mkdir()
        (tmp_path / f"tipo={kind}" / "p.json").write_text('{"dados": [{"id": 1}]}')
    got = pages.explode_envelope(pages.read_categories(spark, str(tmp_path)), RECORD)
    assert sorted((r["tipo"], r["id"]) for r in got.collect()) == [("PEC", 1), ("PL", 1)]


def test_append_log(spark, tmp_path):
    now = datetime(2024, 1, 1)
    lines = [{"log_id": "1", "ts": now, "level": "ERROR", "error_stack": "s"}, {"log_id": "2", "ts": now, "level": "INFO", "affected": 5}]
    for _ in range(2):
        assert tables.append_log(spark, str(tmp_path / "log"), lines) == 2
    log = spark.read.parquet(str(tmp_path / "log"))
    assert {r["status"] for r in log.filter("level = 'ERROR'").collect()} == {"FALHA"} and log.count() == 4
    assert runlog.recent(log, as_of=now).count() == 2 and runlog.runs(log).count() == 0


def test_split_valid(spark):
    df = spark.createDataFrame([(1, "a"), (0, "a"), (2, ""), (None, None)], "id int, t string")
    valid, rejected = ingest.split_valid(df, ["id", "t"])
    assert valid.count() == 1
    assert {r["_missing"]: r["n_rejected"] for r in ingest.rejected_counts(rejected).collect()} == {"id": 1, "t": 1, "id,t": 1}


def test_stringify_keeps_nested_as_json(spark):
    got = ingest.stringify_all(spark.sql("SELECT 1 AS a, named_struct('x', 1) AS s, CAST(NULL AS INT) AS n")).first()
    assert tuple(got) == ("1", '{"x":1}', None)


def test_audit_columns(spark):
    got = ingest.with_audit(spark.range(1), "/votos").first()
    assert got["_source_endpoint"] == "/votos" and len(got["_batch_id"]) == 15 and got["_ingested_at"] is not None


def test_payload_hash_ignores_column_order_and_is_stable(spark):
    a = ingest.payload_hash(spark.sql("SELECT 1 AS x, 'y' AS y")).first()["_payload_hash"]
    b = ingest.payload_hash(spark.sql("SELECT 'y' AS y, 1 AS x")).first()["_payload_hash"]
    assert a == b


@pytest.mark.parametrize("n", [3, 10, 11, 101])
def test_audit_sample(spark, n):
    got = ingest.audit_sample(spark.range(100, 100 + n), ["id"]).collect()
    assert len(got) == min(n, 10) and len({r["id"] for r in got}) == len(got)
    marked = {r["id"] - 100 for r in got if r["kind"] == "position"}
    assert marked == (set(range(n)) if n <= 10 else {0, n // 4, n // 2, 3 * n // 4, n - 1})


@pytest.mark.parametrize("parts", [1, 7, 100])
def test_failure_runs_by_brute_force(spark, parts):
    rng = random.Random(parts)
    data = [(rng.choice("aab"), i, rng.random() < 0.7) for i in range(200)] + [("ok", 500, False)]
    got = {r["e"]: (r["longest_run"], r["abort_at"]) for r in ingest.failure_runs(
        spark.createDataFrame(data, "e string, i long, bad boolean"), ["e"], "i", F.col("bad"), 4, parts).collect()}
    want = {}
    for e in {d[0] for d in data}:
        longest, abort = 0, None
        for bad, run in itertools.groupby([d for d in data if d[0] == e], key=lambda d: d[2]):
            run = list(run)
            if bad:
                longest = max(longest, len(run))
                if len(run) >= 4 and abort is None:
                    abort = run[3][1]
        want[e] = (longest, abort)
    assert got == want


def test_success_gate_and_histogram(spark):
    df = spark.createDataFrame([(200,)] * 8 + [(429,)] * 2, "status int").withColumn("e", F.lit("x"))
    ok = F.col("status") == 200
    row = ingest.success_gate(df, ["e"], ok).first()
    assert row["success_rate"] == 0.8 and row["passes"]
    hist = ingest.error_histogram(df, C.error_kind(F.col("status")), ok).collect()
    assert [(r["kind"], r["n_errors"], r["error_rate"], r["alert"]) for r in hist] == [("HTTP 429 (Rate Limit)", 2, 0.2, True)]


def test_tag_children(spark):
    parents = spark.createDataFrame([(1, "t1"), (2, "t2")], "id int, titulo string")
    children = spark.createDataFrame([(1, "c"), (3, "orphan")], "id int, n string")
    got = ingest.tag_children(parents, children, "id", {"titulo": "titulo"}, extra={"fonte": "f"}).first()
    assert got.asDict() == {"_id": 1, "n": "c", "_titulo": "t1", "fonte": "f"}
    assert spark.range(1).select(F.lit("").alias("a"), F.lit("b").alias("b")).select(ingest.first_present("a", "b")).first()[0] == "b"


def test_write_table_counts_and_replaces_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(300).withColumn("p", F.col("id") % 3)
    assert tables.write_table(df, path, partition_by=["p"]) == 300
    assert tables.write_table(df.filter("p = 1").limit(5), path, partition_by=["p"]) == 5
    assert tables.write_table(df.filter("p = 2"), path, "append", ["p"]) == 100
    assert {r["p"]: r["count"] for r in spark.read.parquet(path).groupBy("p").count().collect()} == {0: 100, 1: 5, 2: 200}


def test_write_bronze_of_nothing(spark, tmp_path):
    assert tables.write_bronze(spark.range(0), str(tmp_path / "b"), "/x") == 0
    assert not (tmp_path / "b").exists()


@pytest.mark.parametrize("parts", [None, ["p"]])
def test_upsert_path(spark, tmp_path, parts):
    path, keys = str(tmp_path / "u"), ["id", "p"]
    df = spark.range(6).select("id", (F.col("id") % 2).cast("int").alias("p"), F.lit("old").alias("v"))
    assert tables.upsert_path(spark, path, df, keys, parts) == 6
    new = df.filter("id IN (0, 2)").withColumn("v", F.lit("new")).unionByName(spark.sql("SELECT 8L AS id, 0 AS p, 'new' AS v"))
    for _ in range(2):  # repeating a load changes nothing
        assert tables.upsert_path(spark, path, new, keys, parts) == 7
    got = {r["id"]: r["v"] for r in spark.read.parquet(path).collect()}
    assert got == {0: "new", 1: "old", 2: "new", 3: "old", 4: "old", 5: "old", 8: "new"}


def test_upsert_path_needs_partitions_in_the_key(spark, tmp_path):
    df = spark.range(2).withColumn("p", F.lit(1))
    tables.upsert_path(spark, str(tmp_path / "v"), df, ["id"], ["p"])
    with pytest.raises(ValueError):
        tables.upsert_path(spark, str(tmp_path / "v"), df, ["id"], ["p"])


def test_compact(spark, tmp_path):
    path, out = str(tmp_path / "many"), str(tmp_path / "few")
    spark.range(1000).repartition(20).write.parquet(path)
    assert tables.compact(spark, path, out, 2, ["id"]).count() == 1000
    assert len(list((tmp_path / "few").glob("*.parquet"))) == 2


def test_layers_and_fallback(spark):
    for _ in range(2):
        tables.create_layers(spark, "lb", "ls", "lg")
    assert spark.table("lb._control").columns == ["endpoint", "last_value", "updated_at"]
    assert tables.first_available(spark, ["lb.absent", "lb._run_log"]).columns[0] == "log_id"
    tables.statistics(spark, "lb._control")
    with pytest.raises(ValueError):
        tables.first_available(spark, ["lb.absent"])


def test_sql_over_binds_values(spark):
    got = tables.sql_over(spark, "SELECT count(*) AS n FROM {df} WHERE id > :low", {"low": 7}, df=spark.range(10))
    assert got.first()["n"] == 2


def test_gold_write_and_summary(spark, tmp_path):
    lines = [tables.run_step("a", lambda: spark.range(3), str(tmp_path / "a")), tables.run_step("b", lambda: spark.range(4), str(tmp_path / "b"))]
    assert "_processed_at" in spark.read.parquet(str(tmp_path / "a")).columns
    status = spark.createDataFrame([(x["table_name"], x["n_rows"]) for x in lines], "table_name string, n_rows long").withColumn("ts", F.current_timestamp())
    assert {r["table_name"]: r["n_rows"] for r in runlog.summary(status).collect()} == {"a": 3, "b": 4, "TOTAL": 7}


def test_log_rows(spark):
    df = spark.createDataFrame([("ERROR", "x" * 6000), ("INFO", None)], "level string, details string")
    bad, good = runlog.log_rows(df).collect()
    assert bad["status"] == "FALHA" and bad["details"].startswith("x" * 3000 + "\n\n... [TRUNCADO 1000 chars] ...\n\n") and bad["details"].endswith("x" * 2000)
    assert good["status"] == "OK" and good["details"] == ""


def test_status_levels(spark):
    df = spark.createDataFrame([(200,), (400,), (404,), (429,), (503,), (302,)], "s int")
    assert [r[0] for r in df.select(C.status_level(F.col("s"))).collect()] == ["INFO", None, "WARN", "WARN", "ERROR", "WARN"]
