"""The stream gives the batch's rows; restarts and repeated batches add nothing."""

import time

import pytest
from pyspark.sql import functions as F

from medalytics.operators import textmatch
from medalytics.streaming import votes as stream

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def folders(tmp_path):
    return {name: str(tmp_path / name) for name in ("out", "alerts", "sla", "checkpoint")}


def land(spark, path, ids):
    rows = spark.createDataFrame([(i, f"2024-01-01 0{i % 10}:00:00", "PEC" if i % 2 else "x") for i in ids], "id long, ts string, t string")
    rows.withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.mode("append").parquet(path)


def run(spark, root, folders, within="1 day"):
    rows = stream.new_rows(stream.file_stream(spark, root, "votes"), "id", "ts", within)
    query = stream.write_with_alerts(textmatch.urgency(rows, "t"), **folders, key="id")
    query.awaitTermination()
    return query


def ids(spark, path):
    return sorted(r["id"] for r in spark.read.parquet(path).collect())



def test_new_rows_alerts_and_restart(spark, tmp_path, folders):
    root = str(tmp_path / "landing")
    land(spark, f"{root}/votes.parquet", [1, 2, 3, 3])
    run(spark, root, folders)
    assert ids(spark, folders["out"]) == [1, 2, 3] and ids(spark, folders["alerts"]) == [1, 3]
    run(spark, root, folders)  # nothing new
    assert ids(spark, folders["out"]) == [1, 2, 3]
    land(spark, f"{root}/votes.parquet", [3, 4])  # 3 is delivered again
    run(spark, root, folders)
    assert ids(spark, folders["out"]) == [1, 2, 3, 4]
    sla = spark.read.parquet(folders["sla"]).orderBy("batch_timestamp").collect()
    assert [(r["n_rows"], r["n_alerts"], r["n_errors"], r["status"]) for r in sla] == [(3, 2, 0, "SUCCESS"), (1, 0, 0, "SUCCESS")]
    assert stream.sla_breaches(spark.read.parquet(folders["sla"])).count() == 0


def test_a_row_that_comes_very_late_is_kept(spark, tmp_path, folders):
    root = str(tmp_path / "landing")
    for days in (range(1, 11), [11], [2]):
        rows = spark.createDataFrame([(100 * len(list(days)) + i, f"2024-03-{i:02d} 00:00:00", "x") for i in days], "id long, ts string, t string")
        rows.withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.mode("append").parquet(f"{root}/votes.parquet")
        run(spark, root, folders)
    assert ids(spark, folders["out"]) == [102, 111, *range(1001, 1011)]


def test_the_state_is_bounded_and_old_ids_are_looked_up(spark, tmp_path, folders):
    root = str(tmp_path / "landing")
    state = []
    for n in range(8):
        land(spark, f"{root}/votes.parquet", [*range(10 * n, 10 * n + 10), 0, 10 * n // 2])  # old ids again and again
        state.append(run(spark, root, folders, "1 second").lastProgress["stateOperators"][0]["numRowsTotal"])
        time.sleep(1)
    assert ids(spark, folders["out"]) == list(range(80))
    assert max(state[3:]) <= 36, state  # three batches of up to 12 ids, however many there have been


def test_rows_without_an_id_are_left_out(spark, tmp_path, folders):
    root = str(tmp_path / "landing")
    land(spark, f"{root}/votes.parquet", [1])
    spark.createDataFrame([(None, None, "x")], "id long, ts timestamp, t string").write.mode("append").parquet(f"{root}/votes.parquet")
    run(spark, root, folders)
    assert ids(spark, folders["out"]) == [1]


def test_a_batch_run_again_does_not_see_itself(spark, tmp_path):
    folder = str(tmp_path / "t")
    rows = spark.range(5).withColumnRenamed("id", "k")
    assert stream.unseen(rows, folder, "k", 0).count() == 5
    stream._replace(rows, folder, 0)
    assert stream.unseen(rows, folder, "k", 0).count() == 5 and stream.unseen(rows, folder, "k", 1).count() == 0


def test_a_batch_run_again_replaces_itself(spark, tmp_path):
    folder = str(tmp_path / "t")
    for _ in range(2):
        stream._replace(spark.range(5), folder, 0)
    assert spark.read.parquet(folder).count() == 5


def test_a_failed_batch_is_counted(spark, tmp_path, folders):
    root = str(tmp_path / "landing")
    land(spark, f"{root}/votes.parquet", [1])
    rows = stream.new_rows(stream.file_stream(spark, root, "votes"), "id", "ts").withColumn("urgency", F.raise_error(F.lit("broken")))
    with pytest.raises(Exception):
        stream.write_with_alerts(rows, **folders).awaitTermination()
    assert stream.sla_breaches(spark.read.parquet(folders["sla"])).first()["status"] == "FAILED"


def test_breaches(spark):
    df = spark.createDataFrame([(61.0, 0), (1.0, 1), (60.0, 0)], "latency_seconds double, n_errors long")
    assert stream.sla_breaches(df).count() == 2
