"""The quality layers as streams: batch totals, restarts, late rows, repeated rows, quarantine and progress."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from medalytics.operators.quality import Expectation, ExpectationFailed
from medalytics.streaming import layers, progress
from medalytics.streaming import votes as stream


def rules():
    return [
        Expectation("has_id", F.col("id").isNotNull(), "DROP"),
        Expectation("has_body", F.col("body") != "", "DROP"),
        Expectation("short", F.length("body") < 5, "WARN"),
        Expectation("positive", F.col("id") > 0, "FAIL"),
    ]


def totals():
    return {"n": F.count(F.lit(1)), "n_plenary": F.count_if(F.col("body") == "PLEN")}


class Pipeline:
    def __init__(self, spark, root):
        self.spark, self.landing, self.folders = spark, f"{root}/landing", layers.Folders(f"{root}/layers")

    def land(self, rows):
        """Rows of (id, day of March, body) as one file."""
        data = [(i, f"2024-03-{day:02d} 10:00:00", body) for i, day, body in rows]
        df = self.spark.createDataFrame(data, "id long, ts string, body string").withColumn("ts", F.to_timestamp("ts"))
        df.coalesce(1).write.mode("append").parquet(f"{self.landing}/s.parquet")

    def silver(self):
        rows = stream.file_stream(self.spark, self.landing, "s")
        shape = lambda df: df.withColumn("body", F.upper("body"))
        layers.to_silver(rows, rules(), shape, totals(), ["body"], self.folders, "id", "ts").awaitTermination()

    def gold_query(self):
        query = layers.to_gold(self.spark, totals(), ["body"], self.folders, "ts", name="gold")
        query.awaitTermination()
        return query

    def run(self):
        self.silver()
        return self.gold_query()

    def gold(self):
        return {(r.day.day, r.body): (r.n, r.n_plenary) for r in layers.gold(self.spark, self.folders, ["body"], totals()).collect()}

    def ids(self, layer):
        return sorted((r.id for r in self.spark.read.parquet(getattr(self.folders, layer)).collect()), key=str)


@pytest.fixture
def made(spark, tmp_path):
    return Pipeline(spark, str(tmp_path))


def test_totals_restart_and_repeated_rows(made):
    made.land([(1, 1, "plen"), (2, 1, "ccj"), (3, 2, "plen"), (3, 2, "plen")])
    made.run()
    first = {(1, "PLEN"): (1, 1), (1, "CCJ"): (1, 0), (2, "PLEN"): (1, 1)}
    assert made.gold() == first
    made.run()  # nothing new
    assert made.gold() == first
    made.land([(3, 2, "plen"), (4, 2, "plen"), (5, 3, "ccj")])  # 3 again
    made.run()
    assert made.gold() == first | {(2, "PLEN"): (2, 2), (3, "CCJ"): (1, 0)}
    assert made.ids("silver") == [1, 2, 3, 4, 5]


def test_late_rows_are_added_and_the_state_closes_days(made):
    state = []
    for day in range(1, 13):
        made.land([(day, day, "plen"), (100 + day, day, "ccj")])
        state.append(made.run().lastProgress["stateOperators"][0]["numRowsTotal"])
    assert max(state) <= 10, state  # open days only, not all
    made.land([(200, 1, "plen"), (201, 12, "plen"), (202, 1, "new"), (1, 1, "plen")])
    query = made.run()
    expected = {(d, b): (1, int(b == "PLEN")) for d in range(1, 13) for b in ("PLEN", "CCJ")}
    expected |= {(1, "PLEN"): (2, 2), (12, "PLEN"): (2, 2), (1, "NEW"): (1, 0)}
    assert made.gold() == expected
    assert made.spark.read.parquet(made.folders.silver).filter("_late").count() == 2
    assert sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"]) == 0


def test_a_lost_run_is_taken_up_again(made, monkeypatch):
    made.land([(1, 1, "plen"), (2, 1, "ccj")])
    made.run()
    made.land([(3, 1, "plen"), (None, 1, "x")])
    whole = layers.publish

    def lost(df, folder, batch):
        if folder.endswith("/late"):
            raise OSError("lost")
        return whole(df, folder, batch)

    monkeypatch.setattr(layers, "publish", lost)
    with pytest.raises(StreamingQueryException):
        made.silver()
    assert made.ids("silver") == [1, 2, 3]  # published, but the batch is not done
    made.gold_query()
    monkeypatch.setattr(layers, "publish", whole)
    made.run()
    assert made.gold() == {(1, "PLEN"): (2, 2), (1, "CCJ"): (1, 0)}
    assert made.ids("silver") == [1, 2, 3] and made.ids("quarantine") == [None]


def test_quarantine_and_replay(made):
    made.land([(1, 1, "plen"), (2, 1, ""), (None, 1, "toolong"), (3, 2, "toolong")])
    made.run()
    held = {r.id: r._broken for r in made.spark.read.parquet(made.folders.quarantine).collect()}
    assert held == {2: ["has_body"], None: ["has_id", "short", "positive"]}
    assert made.ids("silver") == [1, 3]
    mended = lambda df: df.withColumn("body", F.when(F.col("body") == "", "ccj").otherwise(F.col("body")))
    for _ in range(2):  # the second replay delivers an id that is known
        assert layers.replay(made.spark, made.folders, mended, rules(), f"{made.landing}/s.parquet") == 1
        made.run()
        assert made.ids("silver") == [1, 2, 3]
    assert made.gold()[1, "CCJ"] == (1, 0)


def test_a_failing_rule_stops_before_anything_is_written(made):
    made.land([(1, 1, "plen")])
    made.run()
    made.land([(-1, 1, "plen"), (2, 1, "plen"), (3, 1, "")])
    with pytest.raises(StreamingQueryException, match="positive: 1 rows"):
        made.silver()
    assert made.ids("silver") == [1] and made.spark.read.parquet(made.folders.quarantine).count() == 0
    assert issubclass(ExpectationFailed, ValueError)


def test_progress_rows(made, tmp_path):
    listener = progress.ProgressTable(made.spark, str(tmp_path / "progress"), ["gold"])
    made.spark.streams.addListener(listener)
    try:
        made.land([(1, 1, "plen"), (2, 1, "ccj")])
        made.run()
        rows = listener.read().collect()
    finally:
        made.spark.streams.removeListener(listener)
    assert {r.query for r in rows} == {"gold"} and len({r.batch_id for r in rows}) == len(rows)
    assert sum(r.input_rows for r in rows) == 2 and max(r.state_rows for r in rows) == 2
    assert all(r.trigger_ms >= r.add_batch_ms >= 0 and r.triggered_at is not None for r in rows)


def test_nothing_written_yet(made):
    with pytest.raises(ValueError):
        layers.gold(made.spark, made.folders, ["body"], totals())
    assert layers.replay(made.spark, made.folders, lambda df: df, rules(), made.landing) == 0
    with pytest.raises(AttributeError):
        made.folders.bronze
