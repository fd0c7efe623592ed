"""Run-log queries and the session stream."""

from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.scratch import new_path
from ..operators import anomaly, keys, quality, runlog, textmatch
from ..sources import tables
from ..streaming import layers, progress
from ..streaming import votes as stream
from . import fixtures as X
from .registry import query, r6
from .silver import session_rules


def log(spark, d):
    return runlog.log_rows(X.run_log(spark, d))


def as_of(spark, d):
    """The end of the log stands for now; one row."""
    return X.table(spark, d, "events").agg(F.max("ts"))


STATUS_SQL = "CASE WHEN level IN ('ERROR', 'CRITICAL') THEN 'FALHA' ELSE 'OK' END"
SINCE = "ts >= (SELECT max(ts) FROM run_log) - INTERVAL {}"


@query("log_status", f"SELECT log_id, level, notebook, step, {STATUS_SQL} AS status FROM run_log", "run_log")
def log_status(spark, d):
    return log(spark, d).select("log_id", "level", "notebook", "step", "status")


@query(
    "truncate_middle",
    r"""SELECT doc_id, CASE WHEN length(text) > 5000 THEN concat(left(text, 3000), chr(10), chr(10), '... [TRUNCADO ', length(text) - 5000, ' chars] ...',
  chr(10), chr(10), right(text, 2000)) ELSE text END AS details FROM documents""",
)
def truncate_middle(spark, d):
    return X.table(spark, d, "documents").select("doc_id", C.truncate_middle(F.col("text")).alias("details"))


@query(
    "status_level",
    """SELECT request_id, status, CASE WHEN status = 200 THEN 'INFO' WHEN status IN (404, 429) THEN 'WARN' WHEN status >= 500 THEN 'ERROR' ELSE 'WARN' END AS level
FROM requests WHERE status <> 400""",
    "requests",
)
def status_level(spark, d):
    levels = X.requests(spark, d).withColumn("level", C.status_level(F.col("status")))
    return levels.filter("level IS NOT NULL").select("request_id", "status", "level")


@query("log_latest", "SELECT log_id, ts, level, notebook, step FROM run_log ORDER BY ts DESC, log_id DESC LIMIT 50", "run_log")
def log_latest(spark, d):
    return runlog.latest(log(spark, d)).select("log_id", "ts", "level", "notebook", "step")


@query("latest_k", "SELECT log_id, ts, step FROM run_log ORDER BY log_id DESC LIMIT 50", "run_log")
def latest_k(spark, d):
    return anomaly.top_k(X.run_log(spark, d), [F.col("log_id").desc()], 50).select("log_id", "ts", "step")


@query(
    "log_recent_errors",
    f"SELECT log_id, ts, level, notebook, step FROM run_log WHERE level IN ('ERROR', 'CRITICAL', 'WARN') AND {SINCE.format('24 HOUR')}",
    "run_log",
)
def log_recent_errors(spark, d):
    return runlog.recent(log(spark, d), as_of=as_of(spark, d)).select("log_id", "ts", "level", "notebook", "step")


@query(
    "log_runs",
    f"""SELECT notebook, max(CASE WHEN step = 'NOTEBOOK_START' THEN ts END) AS last_start, max(CASE WHEN step = 'NOTEBOOK_END' THEN ts END) AS last_end,
  max(CASE WHEN step LIKE '%END%' THEN duration END) AS max_duration, max(CASE WHEN step LIKE '%END%' THEN {STATUS_SQL} END) AS last_status,
  count(*) FILTER (level = 'ERROR') AS n_errors FROM run_log WHERE {SINCE.format('7 DAY')} GROUP BY notebook""",
    "run_log",
)
def log_runs(spark, d):
    return runlog.runs(log(spark, d), as_of(spark, d))


@query(
    "log_error_rate",
    f"""SELECT step, count(*) AS n_calls, count(*) FILTER (level IN ('SUCCESS', 'INFO')) AS n_ok, count(*) FILTER (level IN ('ERROR', 'WARN')) AS n_failed,
  round(CAST(count(*) FILTER (level IN ('ERROR', 'WARN')) AS DOUBLE) * 100.0 / count(*), 1) AS error_pct
FROM run_log WHERE step LIKE 'API%' AND {SINCE.format('7 DAY')} GROUP BY step""",
    "run_log",
)
def log_error_rate(spark, d):
    return runlog.error_rate(log(spark, d), as_of=as_of(spark, d)).withColumn("error_pct", F.col("error_pct").cast("double"))


@query(
    "log_daily_volume",
    f"""SELECT CAST(ts AS DATE) AS day, CAST(sum(affected) AS BIGINT) AS n_affected, count(DISTINCT notebook) AS n_notebooks, count(*) FILTER (level = 'ERROR') AS n_errors
FROM run_log WHERE affected IS NOT NULL AND {SINCE.format('30 DAY')} GROUP BY 1""",
    "run_log",
)
def log_daily_volume(spark, d):
    return runlog.daily_volume(log(spark, d), as_of(spark, d))


@query(
    "log_connection_errors",
    "SELECT log_id, ts, notebook, step FROM run_log WHERE step IN ('API_ERROR', 'API_CLICK') ORDER BY ts DESC, log_id DESC LIMIT 30",
    "run_log",
)
def log_connection_errors(spark, d):
    return runlog.connection_errors(log(spark, d), ["API_ERROR", "API_CLICK"]).select("log_id", "ts", "notebook", "step")


@query(
    "run_summary",
    """WITH t AS (SELECT notebook AS table_name, sum(affected) AS n_rows, min(ts) AS started, max(ts) AS ended FROM run_log GROUP BY 1),
u AS (SELECT * FROM t UNION ALL SELECT 'TOTAL', sum(n_rows), min(started), max(ended) FROM t)
SELECT table_name, CAST(n_rows AS BIGINT) AS n_rows, started, ended, round((floor(epoch(ended)) - floor(epoch(started))) / 60, 6) AS minutes FROM u""",
    "run_log",
)
def run_summary(spark, d):
    lines = X.run_log(spark, d).select(F.col("notebook").alias("table_name"), F.col("affected").alias("n_rows"), "ts")
    return runlog.summary(lines).select("table_name", "n_rows", "started", "ended", r6("minutes"))


@query(
    "daily_metrics",
    """SELECT CAST(ts AS DATE) AS day, notebook, count(*) AS n_sessions, count(CASE WHEN step NOT LIKE 'NOTEBOOK%' THEN step END) AS with_subject FROM run_log GROUP BY ALL""",
    "run_log",
)
def daily_metrics(spark, d):
    return session_metrics(sessions(X.run_log(spark, d)))


# the session layers ------------------------------------------------------------------------------


def sessions(rows):
    """Vote sessions out of log rows; the steps that are no calls have no subject."""
    return rows.withColumn("subject", F.when(~F.col("step").startswith("NOTEBOOK"), F.col("step")))


def session_metrics(clean):
    return clean.groupBy(F.to_date("ts").alias("day"), "notebook").agg(
        F.count(F.lit(1)).alias("n_sessions"), F.count("subject").alias("with_subject")
    )


LAYERS_SQL = """WITH c AS (SELECT *, upper(trim(notebook)) AS body, CASE WHEN step NOT LIKE 'NOTEBOOK%' THEN step END AS subject
  FROM run_log WHERE log_id IS NOT NULL AND duration < 100 AND duration > 0)
SELECT CAST(ts AS DATE) AS day, body, count(*) AS n_sessions, count(subject) AS with_subject,
  count(*) FILTER (subject IS NOT NULL AND body = 'NB0') AS n_critical, count(*) FILTER (subject IS NOT NULL AND body <> 'NB0') AS n_high FROM c GROUP BY ALL"""


def layer_totals():
    return {
        "n_sessions": F.count(F.lit(1)),
        "with_subject": F.count("subject"),
        "n_critical": F.count_if(F.col("urgency") == "CRITICA"),
        "n_high": F.count_if(F.col("urgency") == "ALTA"),
    }


def silver_sessions(clean):
    """Typed sessions with a standard body, their key and their urgency."""
    silver = keys.standardize(sessions(clean).withColumnRenamed("notebook", "body"), ["body"])
    urgency = F.when(F.col("subject").isNotNull(), C.by_body(F.col("body"), "NB0"))
    return keys.surrogate_key(silver, ["log_id"], "sk").withColumn("urgency", urgency)


@query("votes_quality_layers", LAYERS_SQL, "run_log")
def votes_quality_layers(spark, d):
    """Bronze rules, enforced before anything is built on them, silver keys and standard codes, gold metrics with alerts."""
    clean, report = quality.expect(X.run_log(spark, d), session_rules())
    quality.enforce(report)
    silver = silver_sessions(keys.dedup_keep_first(clean, ["log_id"], ["ts"]))
    return silver.groupBy(F.to_date("ts").alias("day"), "body").agg(*[m.alias(n) for n, m in layer_totals().items()])


@query("votes_quality_stream", LAYERS_SQL, "run_log")
def votes_quality_stream(spark, d):
    """The same layers as two running queries over files that land in any order of time."""
    landed, folders = new_path(spark, "landed"), layers.Folders(new_path(spark, "layers"))
    X.run_log(spark, d).withColumn("ts", F.col("ts").cast("timestamp")).repartition(4).write.parquet(f"{landed}/sessions.parquet")
    rows = stream.file_stream(spark, landed, "sessions", 2)
    layers.to_silver(rows, session_rules(), silver_sessions, layer_totals(), ["body"], folders, "log_id", "ts").awaitTermination()
    layers.to_gold(spark, layer_totals(), ["body"], folders, "ts").awaitTermination()
    return layers.gold(spark, folders, ["body"], layer_totals())


@query(
    "quarantine_rules",
    """SELECT log_id, concat_ws(',', CASE WHEN NOT coalesce(duration < 100, false) THEN 'short' END, CASE WHEN ts < TIMESTAMP '2024-01-10' THEN 'in_range' END,
  CASE WHEN NOT coalesce(duration > 0, false) THEN 'positive_duration' END, CASE WHEN affected IS NULL THEN 'has_subject' END,
  CASE WHEN level = 'ERROR' THEN 'not_failed' END) AS broken, NOT coalesce(duration < 100 AND duration > 0, false) AS rejected FROM run_log""",
    "run_log",
)
def quarantine_rules(spark, d):
    """Kept and rejected rows as one pass writes them, each with all rules that it breaks."""
    found = tables.write_split(X.run_log(spark, d), session_rules(), new_path(spark, "checked"))
    return found.select("log_id", F.array_join("_broken", ",").alias("broken"), F.col("_rejected").alias("rejected"))


# streams -----------------------------------------------------------------------------------------

STREAM_TIERS = [(["ERROR"], "CRITICA"), (["CLICK"], "ALTA")]


def run_stream(spark, d, name=None):
    """All event files through the stream until nothing is left; the folders of rows, alerts and batches."""
    out, alerts, sla, checkpoint = (new_path(spark, t) for t in ("rows", "alerts", "sla", "offsets"))
    rows = stream.new_rows(stream.file_stream(spark, d, "events", 1000), "event_id", "ts")
    rows = textmatch.urgency(rows, "event_type", STREAM_TIERS)
    running = stream.write_with_alerts(rows, out, alerts, sla, checkpoint, key="event_id", name=name)
    running.awaitTermination()
    return out, alerts, sla


@query("stream_new_rows", "SELECT event_id, user_id, event_type, value FROM events")
def stream_new_rows(spark, d):
    return spark.read.parquet(run_stream(spark, d)[0]).select("event_id", "user_id", "event_type", "value")


@query("stream_restart", "SELECT event_id, user_id, event_type, value FROM events")
def stream_restart(spark, d):
    """The stream in three runs: what had landed, the rest with old rows again, and nothing new."""
    landed, out, alerts, sla, checkpoint = (new_path(spark, t) for t in ("landed", "rows", "alerts", "sla", "offsets"))
    events = X.table(spark, d, "events")
    early = F.col("ts") < F.expr("TIMESTAMP_NTZ'2024-01-15 00:00:00'")
    for part in (events.filter(early), events.filter(~early | (F.col("event_type") == "error")), None):
        if part is not None:
            part.write.mode("append").parquet(f"{landed}/events.parquet")
        rows = stream.new_rows(stream.file_stream(spark, landed, "events", 8), "event_id", "ts")
        rows = textmatch.urgency(rows, "event_type", STREAM_TIERS)
        stream.write_with_alerts(rows, out, alerts, sla, checkpoint, key="event_id").awaitTermination()
    return spark.read.parquet(out).select("event_id", "user_id", "event_type", "value")


@query(
    "stream_alerts",
    "SELECT event_id, event_type, CASE event_type WHEN 'error' THEN 'CRITICA' ELSE 'ALTA' END AS urgency FROM events WHERE event_type IN ('error', 'click')",
)
def stream_alerts(spark, d):
    return spark.read.parquet(run_stream(spark, d)[1]).select("event_id", "event_type", "urgency")


@query(
    "stream_sla",
    """SELECT count(*) AS n_rows, count(*) FILTER (event_type IN ('error', 'click')) AS n_alerts, CAST(0 AS BIGINT) AS n_errors, 'SUCCESS' AS status,
  true AS is_timed FROM events""",
)
def stream_sla(spark, d):
    """Volumes, alerts, errors and status summed over the batches, and whether every batch has its time."""
    timed = F.every(F.col("latency_seconds").isNotNull() & F.col("batch_timestamp").isNotNull())
    sums = [F.sum(c).alias(c) for c in ("n_rows", "n_alerts", "n_errors")]
    return spark.read.parquet(run_stream(spark, d)[2]).agg(*sums, F.array_join(F.collect_set("status"), ",").alias("status"), timed.alias("is_timed"))


@query(
    "stream_progress",
    """SELECT 'events' AS query, count(*) AS input_rows, CAST(0 AS BIGINT) AS late_rows_dropped, count(DISTINCT event_id) AS most_state_rows, true AS is_timed
FROM events""",
)
def stream_progress(spark, d):
    """What the engine reports of the stream, summed over its batches."""
    listener = progress.ProgressTable(spark, new_path(spark, "progress"), ["events"])
    spark.streams.addListener(listener)
    try:
        run_stream(spark, d, "events")
        found = listener.read()
    finally:
        spark.streams.removeListener(listener)
    timed = F.every(F.col("trigger_ms").isNotNull() & F.col("triggered_at").isNotNull())
    sums = [F.sum(c).alias(c) for c in ("input_rows", "late_rows_dropped")]
    return found.groupBy("query").agg(*sums, F.max("state_rows").alias("most_state_rows"), timed.alias("is_timed"))


@query(
    "sla_breaches",
    "SELECT log_id, duration AS latency_seconds, CASE WHEN level = 'ERROR' THEN 1 ELSE 0 END AS n_errors FROM run_log WHERE duration > 60 OR level = 'ERROR'",
    "run_log",
)
def sla_breaches(spark, d):
    rows = X.run_log(spark, d).select(
        "log_id", F.col("duration").alias("latency_seconds"), F.when(F.col("level") == "ERROR", 1).otherwise(0).alias("n_errors")
    )
    return stream.sla_breaches(rows)
