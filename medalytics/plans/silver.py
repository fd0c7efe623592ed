"""Silver queries: typed dimensions and facts, keys, deduplication, history, quality."""

from pyspark.sql import functions as F

from ..operators import calendar_ops, ingest, keys, quality, scd
from ..operators.quality import Expectation
from . import fixtures as X
from .gold import fact_expenses, votes
from .registry import query, r6

MEMBER_MAPPING = [
    ("member_id", "id", "bigint"),
    ("name", "name", "string"),
    ("party", "party", "string"),
    ("region_name", "region", "string"),
    ("balance", "balance", "decimal(15,2)"),
]


@query(
    "dim_member",
    """SELECT member_id AS id, name, upper(trim(party)) AS party, upper(trim(region_name)) AS region,
  CAST(balance AS DOUBLE) AS balance, md5(CAST(member_id AS VARCHAR)) AS sk FROM all_members""",
    "all_members",
)
def dim_member(spark, d):
    raw = ingest.stringify_all(X.members(spark, d))
    typed = keys.require(keys.project(raw, MEMBER_MAPPING), ["id"])
    typed = keys.surrogate_key(keys.standardize(typed, ["party", "region"]), ["id"], "sk")
    return keys.dedup_keep_first(typed, ["id"], ["name"]).select("id", "name", "party", "region", r6("balance"), "sk")


@query(
    "fact_expense",
    """SELECT member_id, doc_code, doc_number, party, category, doc_date, CAST(amount AS DOUBLE) AS amount, supplier_id,
  md5(concat_ws('||', member_id, doc_code, doc_number)) AS sk FROM fact_expenses WHERE amount > 0""",
    "fact_expenses",
)
def fact_expense(spark, d):
    facts = keys.surrogate_key(fact_expenses(spark, d), ["member_id", "doc_code", "doc_number"], "sk")
    return facts.select("member_id", "doc_code", "doc_number", "party", "category", "doc_date", r6("amount"), "supplier_id", "sk")


@query(
    "standardize_codes",
    "SELECT member_id, upper(trim('  ' || party || ' ')) AS party, trim(' ' || region_name || '  ') AS region_name FROM all_members",
    "all_members",
)
def standardize_codes(spark, d):
    padded = X.members(spark, d).select(
        "member_id",
        F.concat(F.lit("  "), "party", F.lit(" ")).alias("party"),
        F.concat(F.lit(" "), "region_name", F.lit("  ")).alias("region_name"),
    )
    return keys.standardize(keys.standardize(padded, ["party"]), ["region_name"], upper=False)


@query(
    "surrogate_key",
    "SELECT member_id, doc_code, doc_number, tie_part, supplier_id, md5(concat_ws('||', member_id, doc_code, doc_number, doc_date)) AS sk FROM expenses",
    "expenses",
)
def surrogate_key(spark, d):
    keyed = keys.surrogate_key(X.expenses(spark, d), ["member_id", "doc_code", "doc_number", "doc_date"], "sk")
    return keyed.select("member_id", "doc_code", "doc_number", "tie_part", "supplier_id", "sk")


@query("dedup_keep_first", "SELECT member_id, session_id, choice, arrival FROM votes", "votes")
def dedup_keep_first(spark, d):
    return votes(spark, d).select("member_id", "session_id", "choice", "arrival")


@query(
    "dedup_count",
    """SELECT count(*) AS n_rows, count(DISTINCT (member_id, session_id)) AS n_keys,
  count(*) - count(DISTINCT (member_id, session_id)) AS n_duplicates FROM votes_raw""",
    "votes_raw",
)
def dedup_count(spark, d):
    return keys.dedup_report(X.votes_raw(spark, d), ["member_id", "session_id"])


@query(
    "dim_from_fact",
    """SELECT tie_part AS supplier, max(supplier_name) AS supplier_name, md5(CAST(tie_part AS VARCHAR)) AS sk,
  CASE WHEN regexp_matches(CAST(tie_part AS VARCHAR), '^[0-9]{3}$') THEN 'CNPJ' WHEN regexp_matches(CAST(tie_part AS VARCHAR), '^[0-9]{2}$') THEN 'CPF'
  ELSE 'OUTRO' END AS kind FROM expenses GROUP BY tie_part""",
    "expenses",
)
def dim_from_fact(spark, d):
    facts = X.expenses(spark, d).select(F.col("tie_part").alias("supplier"), "supplier_name")
    rules = [("rlike", "^[0-9]{3}$", "CNPJ"), ("rlike", "^[0-9]{2}$", "CPF")]
    return keys.dim_from_fact(facts, "supplier", "supplier_name", rules, "OUTRO")


@query(
    "standardize_vote",
    """SELECT arrival, CASE WHEN choice IN ('view', 'View') THEN 'SIM' WHEN contains(choice, 'err') THEN 'NAO' ELSE upper(choice) END AS choice_std FROM votes_raw""",
    "votes_raw",
)
def standardize_vote(spark, d):
    rules = [("isin", ["view", "View"], "SIM"), ("contains", "err", "NAO")]
    return keys.recode(X.votes_raw(spark, d), "choice", rules, "choice_std").select("arrival", "choice_std")


@query(
    "dim_event",
    """SELECT event_id, start_ts, end_ts, status, event_type, CAST(start_ts AS DATE) AS day, CAST(year(start_ts) AS INT) AS year,
  CAST(month(start_ts) AS INT) AS month, CAST(trunc((CAST(start_ts AS DATE) - DATE '1995-01-01') / 7.0 + 1) AS INT) AS week,
  md5(CAST(event_id AS VARCHAR)) AS sk FROM meetings""",
    "meetings",
)
def dim_event(spark, d):
    mapping = [
        ("event_id", "event_id", "bigint"),
        ("start_ts", "start_ts", "timestamp_ntz"),
        ("end_ts", "end_ts", "timestamp_ntz"),
        ("status", "status", "string"),
        ("event_type", "event_type", "string"),
    ]
    typed = keys.require(keys.project(ingest.stringify_all(X.meetings(spark, d)), mapping), ["event_id"])
    dated = calendar_ops.with_week(calendar_ops.parts(typed, "start_ts"), "day", "1995-01-01")
    return keys.dedup_keep_first(keys.surrogate_key(dated, ["event_id"], "sk"), ["event_id"], ["start_ts"])


@query(
    "fact_attendance",
    """SELECT member_id, event_id, event_type, CAST(start_ts AS DATE) AS day, md5(concat_ws('||', member_id, event_id)) AS sk
FROM attendance JOIN meetings USING (event_id)""",
    "attendance meetings",
)
def fact_attendance(spark, d):
    landed = X.table(spark, d, "lineitem").select(F.col("l_suppkey").alias("member_id"), F.col("l_orderkey").alias("event_id"))
    events = X.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("event_id"), F.col("o_orderpriority").alias("event_type"), F.to_date("o_orderdate").alias("day")
    )
    unique = keys.require(landed, ["member_id", "event_id"]).distinct()
    return keys.surrogate_key(unique.join(events, "event_id"), ["member_id", "event_id"], "sk")


@query(
    "fact_votes",
    """SELECT member_id, session_id, party, body, choice, upper(choice) AS choice_std, md5(concat_ws('||', member_id, session_id)) AS sk FROM votes""",
    "votes",
)
def fact_votes(spark, d):
    recoded = keys.recode(votes(spark, d), "choice", [("isin", ["Sim", "sim"], "SIM")], "choice_std")
    return keys.surrogate_key(recoded, ["member_id", "session_id"], "sk").drop("arrival")


@query("membership_edges", "SELECT group_id, member_id, member_name, party, region FROM membership", "membership")
def membership_edges(spark, d):
    raw = ingest.stringify_all(X.membership(spark, d))
    mapping = [("group_id", "group_id", "bigint"), ("member_id", "member_id", "bigint"), ("member_name", "member_name", "string"),
               ("party", "party", "string"), ("region", "region", "int")]
    return keys.dedup_keep_first(keys.require(keys.project(raw, mapping), ["group_id", "member_id"]), ["group_id", "member_id"], ["party"])


# history -----------------------------------------------------------------------------------------


def history(spark, d):
    return scd.build(X.history_raw(spark, d), "key_id", "seq", "changed_at")


@query("scd2_build", "SELECT key_id, kind, seq, state, body, valid_from, valid_to, is_current FROM history", "history")
def scd2_build(spark, d):
    return history(spark, d).select("key_id", "kind", "seq", "state", "body", "valid_from", "valid_to", "is_current")


@query(
    "scd2_refresh",
    "SELECT key_id, seq, state, valid_from, valid_to, is_current FROM history",
    "history",
)
def scd2_refresh(spark, d):
    """History of the first half of the month, then the rest as an increment."""
    raw = X.history_raw(spark, d)
    cut = F.col("changed_at") < F.expr("TIMESTAMP_NTZ'2024-01-15 00:00:00'")
    before = scd.build(raw.filter(cut), "key_id", "seq", "changed_at")
    found = scd.refresh(before, raw.filter(~cut), "key_id", "seq", "changed_at")
    return found.select("key_id", "seq", "state", "valid_from", "valid_to", "is_current")


@query(
    "scd2_as_of",
    """SELECT key_id, seq, state, body FROM history
WHERE valid_from <= TIMESTAMP '2024-01-15' AND (valid_to > TIMESTAMP '2024-01-15' OR is_current)""",
    "history",
)
def scd2_as_of(spark, d):
    return scd.as_of(history(spark, d), "2024-01-15 00:00:00").select("key_id", "seq", "state", "body")


@query(
    "scd2_as_of_join",
    """SELECT r.seq AS probe, r.key_id, h.state, h.body FROM history_raw r LEFT JOIN history h ON h.key_id = r.key_id
 AND h.valid_from <= r.changed_at - INTERVAL 1 HOUR AND (h.valid_to > r.changed_at - INTERVAL 1 HOUR OR h.is_current)""",
    "history",
)
def scd2_as_of_join(spark, d):
    probes = X.history_raw(spark, d).select(
        F.col("seq").alias("probe"), "key_id", (F.col("changed_at") - F.expr("INTERVAL 1 HOUR")).alias("at")
    )
    found = scd.as_of_join(probes, history(spark, d), "key_id", "at", "seq", ["state", "body"])
    return found.select("probe", "key_id", "state", "body")


@query(
    "current_state_alerts",
    """SELECT key_id, seq, body, state, 'plenary' AS alert FROM history WHERE is_current AND (body = 'BODY1' OR contains(state, 'purch'))
UNION ALL SELECT key_id, seq, body, state, 'archived' FROM history WHERE is_current AND contains(state, 'err')""",
    "history",
)
def current_state_alerts(spark, d):
    built = history(spark, d)
    cols = ["key_id", "seq", "body", "state"]
    plenary = scd.current_alerts(built, "body", "state", "BODY1", "purch").select(*cols, F.lit("plenary").alias("alert"))
    archived = scd.current_in_state(built, "state", "err").select(*cols, F.lit("archived").alias("alert"))
    return plenary.unionByName(archived)


SPANS_SQL = """
SELECT key_id, kind, min(valid_from) AS first_at, max(valid_from) AS last_at, count(*) AS n_steps, max(CASE WHEN is_current THEN body END) AS last_body,
  CAST(CAST(max(valid_from) AS DATE) - CAST(min(valid_from) AS DATE) AS INT) AS days
FROM history GROUP BY key_id, kind HAVING CAST(max(valid_from) AS DATE) - CAST(min(valid_from) AS DATE) > 0"""


def spans(spark, d):
    return scd.durations(history(spark, d), ["key_id", "kind"], "body")


@query("duration_per_key", SPANS_SQL, "history")
def duration_per_key(spark, d):
    return spans(spark, d)


def summary_sql(by, having="", source=SPANS_SQL):
    return f"""SELECT {by}, round(avg(days), 6) AS mean_days, count(*) AS n_keys, min(days) AS min_days, max(days) AS max_days
FROM ({source}) WHERE {by} IS NOT NULL GROUP BY {by} {having}"""


def rounded_summary(df, by):
    return df.select(by, r6("mean_days"), "n_keys", "min_days", "max_days")


@query("duration_by_type", summary_sql("kind"), "history")
def duration_by_type(spark, d):
    return rounded_summary(scd.duration_summary(spans(spark, d), "kind"), "kind")


@query("duration_by_body", summary_sql("last_body", "HAVING count(*) >= 2"), "history")
def duration_by_body(spark, d):
    return rounded_summary(scd.duration_summary(spans(spark, d), "last_body", 2), "last_body")


@query(
    "duration_by_party",
    summary_sql("region_name", source=f"SELECT s.*, m.region_name FROM ({SPANS_SQL}) s JOIN all_members m ON m.member_id = s.key_id"),
    "history all_members",
)
def duration_by_party(spark, d):
    authors = X.members(spark, d).select(F.col("member_id").alias("key_id"), "region_name")
    return rounded_summary(scd.duration_summary(spans(spark, d).join(authors, "key_id"), "region_name"), "region_name")


# quality -----------------------------------------------------------------------------------------


@query(
    "quality_profile",
    """SELECT count(*) AS total, count(DISTINCT (member_id, kind)) AS distinct_keys, count(*) FILTER (member_id IS NULL) AS nulls_member_id,
  count(*) FILTER (kind IS NULL) AS nulls_kind, round(count(*) FILTER (member_id IS NULL) * 100.0 / count(*), 6) AS pct_member_id,
  0.0::DOUBLE AS pct_kind, count(*) - count(DISTINCT (member_id, kind)) AS duplicates, count(*) FILTER (member_id IS NULL) || ' nulls in member_id (' || count(*) FILTER (member_id IS NULL) * 100 // count(*) || '%); ' ||
  (count(*) - count(DISTINCT (member_id, kind))) || ' duplicate keys (' || (count(*) - count(DISTINCT (member_id, kind))) * 100 // count(*) || '%)' AS issues FROM rough""",
    "rough",
)
def quality_profile(spark, d):
    found = quality.profile(X.rough(spark, d), ["member_id", "kind"], ["member_id", "kind"])
    return found.withColumn("pct_member_id", F.round("pct_member_id", 6))


def session_rules():
    """Ten rules over the session stream; a row drops, warns or stops the run."""
    return [
        Expectation("valid_id", F.col("log_id").isNotNull(), "DROP"),
        Expectation("has_date", F.col("ts").isNotNull(), "WARN"),
        Expectation("short", F.col("duration") < 100, "DROP"),
        Expectation("body_present", F.col("notebook") != "", "WARN"),
        Expectation("in_range", F.col("ts") >= F.expr("TIMESTAMP_NTZ'2024-01-10 00:00:00'"), "WARN"),
        Expectation("non_negative_id", F.col("log_id") >= 0, "FAIL"),
        Expectation("positive_duration", F.col("duration") > 0, "DROP"),
        Expectation("has_subject", F.col("affected").isNotNull(), "WARN"),
        Expectation("known_level", F.col("level").isin("ERROR", "WARN", "SUCCESS", "INFO"), "WARN"),
        Expectation("not_failed", F.col("level") != "ERROR", "WARN"),
    ]


RULE_SQL = {
    "valid_id": ("DROP", "log_id IS NOT NULL"),
    "has_date": ("WARN", "ts IS NOT NULL"),
    "short": ("DROP", "duration < 100"),
    "body_present": ("WARN", "notebook <> ''"),
    "in_range": ("WARN", "ts >= TIMESTAMP '2024-01-10'"),
    "non_negative_id": ("FAIL", "log_id >= 0"),
    "positive_duration": ("DROP", "duration > 0"),
    "has_subject": ("WARN", "affected IS NOT NULL"),
    "known_level": ("WARN", "level IN ('ERROR', 'WARN', 'SUCCESS', 'INFO')"),
    "not_failed": ("WARN", "level <> 'ERROR'"),
}


@query(
    "expectations_report",
    " UNION ALL ".join(
        f"SELECT '{name}' AS rule, '{action}' AS action, count(*) AS total, count(*) FILTER (NOT coalesce({holds}, FALSE)) AS failed, "
        f"round(count(*) FILTER (NOT coalesce({holds}, FALSE)) / count(*), 6) AS failure_rate FROM run_log"
        for name, (action, holds) in RULE_SQL.items()
    ),
    "run_log",
)
def expectations_report(spark, d):
    found = quality.expectation_report(X.run_log(spark, d), session_rules())
    return found.select("rule", "action", "total", "failed", r6("failure_rate"))


@query(
    "expectations_clean",
    "SELECT log_id, level, notebook, step, duration, affected FROM run_log WHERE log_id IS NOT NULL AND duration < 100 AND duration > 0",
    "run_log",
)
def expectations_clean(spark, d):
    return quality.drop_failures(X.run_log(spark, d), session_rules()).select("log_id", "level", "notebook", "step", "duration", "affected")


@query(
    "ref_integrity",
    """WITH p AS (SELECT DISTINCT member_id AS k FROM stored_members), c AS (SELECT member_id AS k, count(*) AS n FROM votes_raw GROUP BY 1),
j AS (SELECT p.k AS pk, c.k AS ck, c.n FROM p FULL JOIN c ON p.k = c.k)
SELECT count(pk) AS n_parents, count(*) FILTER (ck IS NULL) AS n_childless, count(*) FILTER (pk IS NULL) AS n_orphan_keys,
  CAST(coalesce(sum(n) FILTER (pk IS NULL), 0) AS BIGINT) AS n_orphan_rows, round(count(*) FILTER (pk IS NOT NULL AND ck IS NOT NULL) * 100.0 / count(pk), 6) AS covered_pct
FROM j""",
    "stored_members votes_raw",
)
def ref_integrity(spark, d):
    found = quality.referential(X.stored_members(spark, d), X.votes_raw(spark, d), "member_id")
    return found.withColumn("covered_pct", F.round("covered_pct", 6))


@query(
    "coverage",
    """SELECT (SELECT count(DISTINCT member_id) FROM votes_raw) AS n_found, count(DISTINCT member_id) AS n_expected,
  round((SELECT count(DISTINCT member_id) FROM votes_raw) / count(DISTINCT member_id), 6) AS coverage FROM all_members""",
    "votes_raw all_members",
)
def coverage(spark, d):
    found = quality.coverage(X.votes_raw(spark, d), "member_id", X.members(spark, d).select("member_id"))
    return found.select("n_found", "n_expected", r6("coverage"))


GRID_SQL = "SELECT member_id, CAST(1996 AS INT) AS year, CAST(m.mon AS INT) AS month FROM all_members CROSS JOIN generate_series(1, 12) AS m(mon)"


@query("expected_grid", GRID_SQL, "all_members")
def expected_grid(spark, d):
    return ingest.expected_grid(X.members(spark, d).select("member_id"), "1996-01", "1996-12")


@query(
    "grid_gaps",
    f"SELECT g.* FROM ({GRID_SQL}) g WHERE NOT EXISTS (SELECT 1 FROM expenses e WHERE e.member_id = g.member_id AND e.yr = g.year AND e.mon = g.month)",
    "expenses all_members",
)
def grid_gaps(spark, d):
    ids = X.members(spark, d).select("member_id")
    return ingest.grid_gaps(ids, X.expenses(spark, d), "member_id", "yr", "mon", "1996-01", "1996-12")


@query(
    "table_profile",
    """SELECT count(*) AS n_rows, count(DISTINCT (session_id, member_id)) AS n_pairs, count(*) FILTER (choice IS NULL) AS nulls_choice,
  count(DISTINCT session_id) AS n_parents, count(DISTINCT member_id) AS n_children,
  round(count(DISTINCT (session_id, member_id)) / count(DISTINCT session_id), 6) AS mean_children,
  round((count(*) - count(DISTINCT (session_id, member_id))) * 100.0 / count(*), 6) AS duplicate_pct FROM votes_raw""",
    "votes_raw",
)
def table_profile(spark, d):
    found = quality.table_profile(X.votes_raw(spark, d), "session_id", "member_id", ["choice"])
    return found.withColumns({c: F.round(c, 6) for c in ("mean_children", "duplicate_pct")})


@query(
    "period_profile",
    """SELECT count(*) AS n_rows, min(yr) AS first_year, max(yr) AS last_year, count(DISTINCT concat(yr, '-', lpad(CAST(mon AS VARCHAR), 2, '0'))) AS n_periods FROM expenses""",
    "expenses",
)
def period_profile(spark, d):
    line = X.table(spark, d, "lineitem").select(F.year("l_shipdate").alias("yr"), F.month("l_shipdate").alias("mon"))
    label = F.concat(F.col("yr").cast("string"), F.lit("-"), F.lpad(F.col("mon").cast("string"), 2, "0"))
    return line.agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("yr").alias("first_year"), F.max("yr").alias("last_year"), F.countDistinct(label).alias("n_periods")
    )
