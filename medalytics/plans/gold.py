"""Gold queries: anomalies, ranking, reports, groups, engagement, calendar, text mentions."""

from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.scratch import new_path, store
from ..operators import anomaly, calendar_ops, engagement, groups, keys, states, textindex, textmatch
from . import fixtures as X
from .registry import query, r6


def votes(spark, d):
    """Vote fact: the first vote of a member in a session."""
    return keys.dedup_keep_first(X.votes_raw(spark, d), ["member_id", "session_id"], ["arrival"])


def fact_expenses(spark, d):
    positive = X.expenses(spark, d).filter(F.col("amount") > 0)
    return keys.dedup_keep_first(
        positive, ["member_id", "doc_code", "doc_number"], ["tie_part", "supplier_id", "doc_date", "amount"]
    )


ZSCORE_SQL = """
WITH s AS (SELECT category, region, avg(amount) AS m, coalesce(stddev_samp(amount), 1.0) AS sd FROM amounts GROUP BY ALL),
z AS (SELECT a.*, m, sd, CASE WHEN sd > 0 THEN (amount - m) / sd ELSE 0.0 END AS z FROM amounts a JOIN s USING (category, region))
SELECT id, category, region, amount, round(m, 6) AS group_mean, round(sd, 6) AS group_stddev, round(z, 6) AS z_score,
       z > 2.0 AS is_anomaly,
       CASE WHEN z > 3.0 THEN 'CRITICA' WHEN z > 2.5 THEN 'ALTA' WHEN z > 2.0 THEN 'MEDIA' ELSE 'NORMAL' END AS severity
FROM z"""


def scored(spark, d):
    return anomaly.zscore(X.amounts(spark, d), "amount", ["category", "region"])


def rounded_scores(df):
    return df.select("id", "category", "region", "amount", r6("group_mean"), r6("group_stddev"), r6("z_score"), "is_anomaly", "severity")


@query("zscore_anomaly", ZSCORE_SQL, "amounts")
def zscore_anomaly(spark, d):
    return rounded_scores(scored(spark, d))


@query("zscore_incremental", ZSCORE_SQL, "amounts")
def zscore_incremental(spark, d):
    """A state of the groups from three loads, the last of which came twice, and all rows scored by it."""
    rows, by, path = X.amounts(spark, d), ["category", "region"], new_path(spark, "moments")
    loads = F.pmod(F.xxhash64("id"), F.lit(3))
    for load in (0, 1, 2, 2):
        states.add(states.moments(rows.filter(loads == load), "amount", by), path, str(load))
    state = states.merge_moments(states.parts(spark, path), by)
    return rounded_scores(states.zscore(rows, state, "amount", by))


@query("anomaly_report", f"SELECT * FROM ({ZSCORE_SQL}) WHERE is_anomaly", "amounts")
def anomaly_report(spark, d):
    return rounded_scores(anomaly.anomalies(scored(spark, d)))


@query("severity_histogram", f"SELECT severity, count(*) AS n FROM ({ZSCORE_SQL}) WHERE is_anomaly GROUP BY severity", "amounts")
def severity_histogram(spark, d):
    return anomaly.counts(scored(spark, d).filter("is_anomaly"), ["severity"])


RANKING_SQL = """
WITH g AS (SELECT tie_part AS supplier, max(category) AS supplier_name, sum(amount) AS total_value, count(*) AS n_documents,
  CAST(sum(amount) AS DOUBLE) / count(*) AS mean_value, max(amount) AS max_value, count(DISTINCT member_id) AS n_members
  FROM fact_expenses WHERE amount > 0 GROUP BY tie_part)
SELECT supplier, supplier_name, round(CAST(total_value AS DOUBLE), 6) AS total_value, n_documents, mean_value,
  round(CAST(max_value AS DOUBLE), 6) AS max_value, n_members, n_members > 30 AS flag_many_members, max_value > 103000 AS flag_high_value,
  regexp_matches(CAST(supplier AS VARCHAR), '^[0-9]{3}$') AND total_value > 1700000 AS flag_person_total,
  CAST(n_members > 30 AS INT) + CAST(max_value > 103000 AS INT)
   + CAST(regexp_matches(CAST(supplier AS VARCHAR), '^[0-9]{3}$') AND total_value > 1700000 AS INT) AS n_flags
FROM g"""

RANKING_LIMITS = {"many_members": 30, "high_value": 103_000, "id_pattern": "^[0-9]{3}$", "id_total": 1_700_000}


def rounded_ranking(ranked):
    return ranked.select(
        "supplier", "supplier_name", r6("total_value"), "n_documents", "mean_value",
        r6("max_value"), "n_members", "flag_many_members", "flag_high_value", "flag_person_total", "n_flags",
    )


@query("supplier_ranking", RANKING_SQL, "fact_expenses")
def supplier_ranking(spark, d):
    facts = supplier_facts(fact_expenses(spark, d))
    return rounded_ranking(anomaly.rank_entities(facts, "supplier", "amount", "member_id", "supplier_name", **RANKING_LIMITS))


def supplier_facts(facts):
    return facts.select(F.col("tie_part").alias("supplier"), F.col("category").alias("supplier_name"), "amount", "member_id", "yr", "mon", "party", "category")


def loaded_totals(spark, facts, by, name=None):
    """A state of totals from the loads of two spans of years, folded, and a third."""
    path, years = new_path(spark, "totals"), F.col("yr")
    spans = {"to-1993": years <= 1993, "to-1996": years.between(1994, 1996), "rest": years > 1996}
    for n, (load, span) in enumerate(spans.items()):
        if n == 2:
            states.fold(spark, path, states.merge_totals(states.parts(spark, path), by, "member_id", name))
        states.add(states.totals(facts.filter(span), by, "member_id", "amount", name), path, load)
    return states.merge_totals(states.parts(spark, path), by, "member_id", name)


@query("supplier_ranking_incremental", RANKING_SQL, "fact_expenses")
def supplier_ranking_incremental(spark, d):
    """The ranking out of stored parts, one per load."""
    facts = store(supplier_facts(fact_expenses(spark, d)), "facts").df
    state = loaded_totals(spark, facts, ["supplier"], "supplier_name")
    return rounded_ranking(states.ranking(state, "supplier", "member_id", "supplier_name", **RANKING_LIMITS))


@query(
    "category_median_flag",
    """WITH m AS (SELECT category, median(CAST(amount AS DOUBLE)) AS category_median FROM fact_expenses WHERE amount > 0 GROUP BY 1),
g AS (SELECT supplier_id, category, CAST(sum(amount) AS DOUBLE) / count(*) AS mean_value, count(*) AS n_documents FROM fact_expenses WHERE amount > 0 GROUP BY 1, 2)
SELECT supplier_id, category, round(mean_value, 6) AS mean_value, n_documents, round(category_median, 6) AS category_median,
  mean_value > category_median * 1.5 AS is_above_median FROM g JOIN m USING (category)""",
    "fact_expenses",
)
def category_median_flag(spark, d):
    found = states.above_median(fact_expenses(spark, d), "supplier_id", "category", "amount", 1.5)
    return found.select("supplier_id", "category", r6("mean_value"), "n_documents", r6("category_median"), "is_above_median")


MONTHLY_SQL = """SELECT party, yr, mon, category, round(CAST(sum(amount) AS DOUBLE), 6) AS total_value, count(*) AS n_rows,
  CAST(sum(amount) AS DOUBLE) / count(*) AS mean_value, count(DISTINCT member_id) AS n_members
FROM fact_expenses WHERE amount > 0 GROUP BY party, yr, mon, category"""


@query("monthly_report", MONTHLY_SQL, "fact_expenses")
def monthly_report(spark, d):
    found = anomaly.report(fact_expenses(spark, d), ["party", "yr", "mon", "category"], "amount", "member_id")
    return found.select("party", "yr", "mon", "category", r6("total_value"), "n_rows", "mean_value", "n_members")


@query("monthly_report_incremental", MONTHLY_SQL, "fact_expenses")
def monthly_report_incremental(spark, d):
    """The report out of stored parts, one per load."""
    facts, by = store(supplier_facts(fact_expenses(spark, d)), "facts").df, ["party", "yr", "mon", "category"]
    found = states.report(loaded_totals(spark, facts, by), by, "member_id")
    return found.select(*by, r6("total_value"), "n_rows", "mean_value", "n_members")


@query(
    "top_expenses",
    """SELECT member_id, doc_code, doc_number, category, supplier_name, doc_date, CAST(amount AS DOUBLE) AS amount
FROM fact_expenses WHERE amount > 0 ORDER BY amount DESC, member_id, doc_code, doc_number LIMIT 100""",
    "fact_expenses",
)
def top_expenses(spark, d):
    order = [F.col("amount").desc(), "member_id", "doc_code", "doc_number"]
    return anomaly.top_k(fact_expenses(spark, d), order, 100).select(
        "member_id", "doc_code", "doc_number", "category", "supplier_name", "doc_date", r6("amount")
    )


@query(
    "topk_per_group",
    """SELECT party, member_id, doc_code, doc_number, CAST(amount AS DOUBLE) AS amount,
  CAST(row_number() OVER w AS INT) AS rank FROM fact_expenses WHERE amount > 0
WINDOW w AS (PARTITION BY party ORDER BY amount DESC, member_id, doc_code, doc_number) QUALIFY rank <= 10""",
    "fact_expenses",
)
def topk_per_group(spark, d):
    order = [F.col("amount").desc(), "member_id", "doc_code", "doc_number"]
    found = anomaly.top_k(fact_expenses(spark, d), order, 10, ["party"])
    return found.select("party", "member_id", "doc_code", "doc_number", r6("amount"), "rank")


@query("topk_groups", "SELECT category, count(*) AS n FROM expenses GROUP BY category ORDER BY n DESC, category LIMIT 5", "expenses")
def topk_groups(spark, d):
    return anomaly.counts(X.expenses(spark, d), ["category"], 5)


@query(
    "enrich_left",
    """SELECT e.member_id, e.doc_code, e.doc_number, e.tie_part, e.supplier_id, e.doc_date, CAST(e.amount AS DOUBLE) AS amount, m.name, m.region_name
FROM expenses e LEFT JOIN stored_members m USING (member_id)""",
    "expenses stored_members",
)
def enrich_left(spark, d):
    known = X.stored_members(spark, d).select("member_id", "name", "region_name")
    return X.expenses(spark, d).join(known, "member_id", "left").select(
        "member_id", "doc_code", "doc_number", "tie_part", "supplier_id", "doc_date", r6("amount"), "name", "region_name"
    )


# groups ------------------------------------------------------------------------------------------


@query(
    "hhi_diversity",
    """WITH p AS (SELECT group_id, party, count(*) AS n FROM membership GROUP BY ALL)
SELECT group_id, CAST(sum(n) AS BIGINT) AS n_members, CAST(sum(n * n) AS DOUBLE) / (CAST(sum(n) AS DOUBLE) * sum(n)) AS hhi,
  count(party) AS n_parts, CAST(sum(n) AS DOUBLE) * sum(n) / CAST(sum(n * n) AS DOUBLE) AS effective_parts FROM p GROUP BY group_id""",
    "membership",
)
def hhi_diversity(spark, d):
    return groups.hhi(X.membership(spark, d), "group_id", "party")


def titled_membership(spark, d):
    return X.membership(spark, d).withColumn("title", F.concat(F.lit("group "), F.col("group_id").cast("string")))


@query(
    "multi_membership",
    """SELECT member_id, CAST(floor(group_id / 40) AS BIGINT) AS page, CAST(max(total) AS BIGINT) AS n_groups,
  string_agg('group ' || group_id, ',' ORDER BY 'group ' || group_id) AS labels
FROM (SELECT *, count(*) OVER (PARTITION BY member_id) AS total FROM membership) GROUP BY ALL""",
    "membership",
)
def multi_membership(spark, d):
    found = groups.memberships(titled_membership(spark, d), "member_id", "group_id", "title", page_size=40)
    return found.select("member_id", "page", "n_groups", F.array_join("labels", ",").alias("labels"))


@query(
    "overlap_pairs",
    """SELECT a.group_id AS group_id_a, b.group_id AS group_id_b, count(*) AS shared
FROM membership a JOIN membership b ON a.member_id = b.member_id AND a.group_id < b.group_id GROUP BY ALL""",
    "membership",
)
def overlap_pairs(spark, d):
    return groups.overlap_pairs(X.membership(spark, d), "group_id", "member_id", heavy_degree=64)


COHESION_SQL = """
SELECT {g}, round(avg(c), 6) AS mean_cohesion, count(*) AS n_sessions, round(min(c), 6) AS min_cohesion, round(max(c), 6) AS max_cohesion
FROM (SELECT {g}, session_id, max(n) / sum(n) AS c FROM (SELECT {g}, session_id, choice, count(*) AS n FROM {src} GROUP BY ALL) GROUP BY ALL)
GROUP BY {g}"""
GROUP_VOTES_SQL = "(SELECT m.group_id, v.session_id, v.choice FROM votes v JOIN membership m USING (member_id))"


def rounded_cohesion(df, group):
    return df.select(group, r6("mean_cohesion"), "n_sessions", r6("min_cohesion"), r6("max_cohesion"))


def group_cohesion(spark, d):
    cast = votes(spark, d).select("member_id", "session_id", "choice")
    joined = groups.votes_of_groups(cast, X.membership(spark, d), "member_id", "group_id")
    return groups.cohesion(joined, "group_id", "session_id", "choice")


def party_cohesion(spark, d):
    return groups.cohesion(votes(spark, d), "party", "session_id", "choice")


@query(
    "cohesion_group",
    f"SELECT c.*, 'group ' || group_id AS title FROM ({COHESION_SQL.format(g='group_id', src=GROUP_VOTES_SQL)}) c",
    "votes membership",
)
def cohesion_group(spark, d):
    labelled = groups.with_label(
        rounded_cohesion(group_cohesion(spark, d), "group_id"), titled_membership(spark, d), "group_id", "title"
    )
    return labelled


@query("cohesion_party", COHESION_SQL.format(g="party", src="votes"), "votes")
def cohesion_party(spark, d):
    return rounded_cohesion(party_cohesion(spark, d), "party")


@query(
    "cohesion_compare",
    f"""WITH a AS (SELECT avg(mean_cohesion) AS x FROM ({COHESION_SQL.format(g='group_id', src=GROUP_VOTES_SQL)})),
b AS (SELECT avg(mean_cohesion) AS y FROM ({COHESION_SQL.format(g='party', src='votes')}))
SELECT round(x, 5) AS mean_groups, round(y, 5) AS mean_parties, round(x - y, 5) AS difference,
  CASE WHEN x <> 0 AND y <> 0 AND x > y THEN 'groups' WHEN x <> 0 AND y <> 0 THEN 'parties' END AS verdict
FROM a CROSS JOIN b""",
    "votes membership",
)
def cohesion_compare(spark, d):
    found = groups.compare_cohesion(group_cohesion(spark, d), party_cohesion(spark, d), ("groups", "parties"))
    return found.select(
        *[F.round(c, 5).alias(c) for c in ("mean_groups", "mean_parties", "difference")], "verdict"
    )


@query(
    "majority_vote",
    """SELECT party, session_id, max(n) AS majority_votes, CAST(sum(n) AS BIGINT) AS total_votes
FROM (SELECT party, session_id, choice, count(*) AS n FROM votes GROUP BY ALL) GROUP BY ALL""",
    "votes",
)
def majority_vote(spark, d):
    return groups.majority(votes(spark, d), "party", "session_id", "choice")


# engagement --------------------------------------------------------------------------------------


@query(
    "presence_rate",
    """WITH t AS (SELECT event_type, count(*) AS n_events FROM meetings GROUP BY 1),
s AS (SELECT a.member_id, m.event_type, count(*) AS n_present FROM attendance a JOIN meetings m USING (event_id) GROUP BY ALL)
SELECT member_id, s.event_type, n_present, n_events, round(n_present / n_events, 6) AS presence_rate FROM s JOIN t USING (event_type)""",
    "meetings attendance",
)
def presence_rate(spark, d):
    found = engagement.rate(X.attendance(spark, d), X.meetings(spark, d), "event_id", "member_id", "event_type")
    return found.select("member_id", "event_type", "n_present", "n_events", r6("presence_rate"))


SCORE_SQL = """
WITH p AS (SELECT member_id, count(*) AS n FROM attendance GROUP BY 1),
v AS (SELECT member_id, count(*) AS n FROM votes GROUP BY 1),
s AS (SELECT m.member_id, m.name, m.party, coalesce(p.n, 0) AS n_presence, coalesce(v.n, 0) AS n_votes,
  coalesce(p.n, 0) / (SELECT count(*) FROM meetings) AS presence_score,
  coalesce(v.n, 0) / (SELECT count(DISTINCT session_id) FROM votes) AS votes_score
  FROM all_members m LEFT JOIN p USING (member_id) LEFT JOIN v USING (member_id)),
e AS (SELECT *, round(presence_score * 0.4 + votes_score * 0.6, 9) AS engagement_score FROM s)"""


def engagement_scores(spark, d):
    found = votes(spark, d)
    parts = [
        ("presence", X.attendance(spark, d), X.table(spark, d, "orders").agg(F.count(F.lit(1))), 0.4),
        ("votes", found, found.agg(F.countDistinct("session_id")), 0.6),
    ]
    scores = engagement.score(X.members(spark, d).select("member_id", "name", "party"), "member_id", parts)
    return scores.withColumn("engagement_score", F.round("engagement_score", 9))


@query(
    "engagement_score",
    SCORE_SQL + """ SELECT member_id, name, party, n_presence, n_votes, round(presence_score, 6) AS presence_score,
  round(votes_score, 6) AS votes_score, round(engagement_score, 6) AS engagement_score FROM e""",
    "all_members attendance votes meetings",
)
def engagement_score(spark, d):
    return engagement_scores(spark, d).select(
        "member_id", "name", "party", "n_presence", "n_votes", r6("presence_score"), r6("votes_score"), r6("engagement_score")
    )


@query(
    "engagement_percentile",
    SCORE_SQL + """ SELECT member_id, round(engagement_score, 6) AS engagement_score,
  round(percent_rank() OVER (ORDER BY engagement_score), 6) AS percentile FROM e""",
    "all_members attendance votes meetings",
)
def engagement_percentile(spark, d):
    scores = store(engagement_scores(spark, d).select("member_id", "engagement_score"), "scores").df
    found = engagement.percentile(scores, "engagement_score")
    return found.select("member_id", r6("engagement_score"), r6("percentile"))


@query(
    "engagement_series",
    """WITH a AS (SELECT member_id, year(start_ts) AS year, month(start_ts) AS month, count(*) AS n FROM attendance JOIN meetings USING (event_id) GROUP BY ALL),
b AS (SELECT member_id, year(session_id) AS year, month(session_id) AS month, count(*) AS n FROM votes GROUP BY ALL)
SELECT member_id, CAST(year AS INT) AS year, CAST(month AS INT) AS month, coalesce(a.n, 0) AS presences, coalesce(b.n, 0) AS votes,
  coalesce(a.n, 0) + coalesce(b.n, 0) AS engagement, m.name, m.party
FROM a FULL JOIN b USING (member_id, year, month) JOIN all_members m USING (member_id)""",
    "attendance meetings votes all_members",
)
def engagement_series(spark, d):
    starts = X.table(spark, d, "orders").select(F.col("o_orderkey").alias("event_id"), F.to_date("o_orderdate").alias("day"))
    present = X.attendance(spark, d).join(starts, "event_id")
    cast = votes(spark, d).withColumnRenamed("session_id", "day")
    series = engagement.monthly_series(present, cast, "member_id", "day")
    return series.join(X.members(spark, d).select("member_id", "name", "party"), "member_id")


@query(
    "absence_pattern",
    """WITH s AS (SELECT DISTINCT session_id, body FROM votes)
SELECT m.member_id, m.name, m.party, s.body, count(*) AS n_missed FROM all_members m CROSS JOIN s
LEFT JOIN votes v ON v.member_id = m.member_id AND v.session_id = s.session_id
WHERE v.member_id IS NULL GROUP BY ALL""",
    "all_members votes",
)
def absence_pattern(spark, d):
    return engagement.absences(
        X.members(spark, d), votes(spark, d), "member_id", "session_id", "body", ["name", "party"]
    )


# calendar ----------------------------------------------------------------------------------------


@query("calendar_parts", "SELECT event_id, CAST(start_ts AS DATE) AS day, CAST(year(start_ts) AS INT) AS year, CAST(month(start_ts) AS INT) AS month FROM meetings", "meetings")
def calendar_parts(spark, d):
    return calendar_ops.parts(X.meetings(spark, d), "start_ts").select("event_id", "day", "year", "month")


@query(
    "week_index",
    "SELECT event_id, CAST(trunc((CAST(start_ts AS DATE) - DATE '1995-01-01') / 7.0 + 1) AS INT) AS week FROM meetings",
    "meetings",
)
def week_index(spark, d):
    days = calendar_ops.parts(X.meetings(spark, d), "start_ts")
    return calendar_ops.with_week(days, "day", "1995-01-01").select("event_id", "week")


@query(
    "event_duration",
    "SELECT event_id, round((epoch(end_ts) - epoch(start_ts)) / 3600, 6) AS hours FROM meetings",
    "meetings",
)
def event_duration(spark, d):
    return X.meetings(spark, d).withColumn("hours", calendar_ops.duration_hours("start_ts", "end_ts")).select("event_id", r6("hours"))


CALENDAR_SQL = """
SELECT m.event_id, start_ts, end_ts, event_type, status, coalesce(n, 0) AS n_present, round((epoch(end_ts) - epoch(start_ts)) / 3600, 6) AS hours
FROM meetings m LEFT JOIN (SELECT event_id, count(*) AS n FROM attendance GROUP BY 1) USING (event_id)"""


def event_calendar(spark, d):
    return calendar_ops.calendar(X.meetings(spark, d), X.attendance(spark, d), "event_id", "start_ts", "end_ts")


@query("calendar_fact", CALENDAR_SQL, "meetings attendance")
def calendar_fact(spark, d):
    return event_calendar(spark, d).select("event_id", "start_ts", "end_ts", "event_type", "status", "n_present", r6("hours"))


@query(
    "weekly_density",
    f"""WITH c AS (SELECT *, CAST(trunc((CAST(start_ts AS DATE) - DATE '1991-12-01') / 7.0 + 1) AS INT) AS week FROM ({CALENDAR_SQL})
),
w AS (SELECT week, count(*) AS n, sum(n_present) AS p, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS k FROM c GROUP BY week)
SELECT CAST(s.week AS INT) AS week, coalesce(n, 0) AS n_events, CAST(coalesce(p, 0) AS BIGINT) AS n_present, coalesce(round(p / n, 6), 0.0) AS mean_present,
  coalesce(k, '') AS kinds, n IS NULL AS is_empty
FROM generate_series(1, (SELECT max(week) FROM w)) AS s(week) LEFT JOIN w ON w.week = s.week""",
    "meetings attendance",
)
def weekly_density(spark, d):
    cal = event_calendar(spark, d).withColumn("day", F.to_date("start_ts"))
    found = calendar_ops.weekly_density(cal, "day", "event_type", "1991-12-01")
    return found.select("week", "n_events", "n_present", r6("mean_present"), F.array_join("kinds", ",").alias("kinds"), "is_empty")


@query(
    "period_comparison",
    """WITH f AS (SELECT a.member_id, year(start_ts) AS y, month(start_ts) AS m FROM attendance a JOIN meetings USING (event_id)),
p AS (SELECT member_id, CASE WHEN y % 2 = 0 AND m BETWEEN 7 AND 10 THEN 'ELEITORAL' WHEN y % 2 = 0 AND m BETWEEN 3 AND 6 THEN 'PRE_ELEITORAL'
  WHEN y % 2 = 0 AND m > 10 THEN 'POS_ELEITORAL' ELSE 'REGULAR' END AS period, count(*) AS n FROM f GROUP BY ALL)
SELECT period, round(avg(n), 6) AS mean_per_member, count(*) AS n_members FROM p GROUP BY period""",
    "attendance meetings",
)
def period_comparison(spark, d):
    starts = X.table(spark, d, "orders").select(F.col("o_orderkey").alias("event_id"), "o_orderdate")
    facts = X.attendance(spark, d).join(starts, "event_id")
    period = C.election_period(F.year("o_orderdate"), F.month("o_orderdate"))
    return calendar_ops.period_compare(facts, "member_id", period).select("period", r6("mean_per_member"), "n_members")


@query(
    "future_events",
    "SELECT event_id, start_ts, event_type, status FROM meetings WHERE CAST(start_ts AS DATE) >= DATE '2000-01-01' AND status <> 'F'",
    "meetings",
)
def future_events(spark, d):
    found = calendar_ops.upcoming(X.meetings(spark, d), "start_ts", "status", "2000-01-01", "F")
    return found.select("event_id", "start_ts", "event_type", "status")


# text --------------------------------------------------------------------------------------------

NOUN_RULES = [(noun, noun.upper()) for noun in ("anvil", "widget", "bolt", "ring", "rod", "gizmo", "gear")]
NOUN_SQL = "CASE " + " ".join(f"WHEN regexp_matches(title, '(?i){n}') THEN '{l}'" for n, l in NOUN_RULES) + " ELSE 'OTHER' END"


@query("theme_rules", f"SELECT id, title, {NOUN_SQL} AS theme FROM titles", "titles")
def theme_rules(spark, d):
    return textmatch.classify(X.titles(spark, d), "title", NOUN_RULES, "OTHER").select("id", "title", "theme")


@query("theme_evolution", f"SELECT term, {NOUN_SQL} AS theme, count(*) AS n FROM titles GROUP BY ALL", "titles")
def theme_evolution(spark, d):
    return textmatch.evolution(X.titles(spark, d), "term", "title", NOUN_RULES, "OTHER")


@query(
    "contains_any",
    "SELECT id, term, title FROM titles WHERE contains(term, 'PROMO') OR contains(title, 'ring') OR contains(title, 'cold')",
    "titles",
)
def contains_any(spark, d):
    return textmatch.contains_any(X.titles(spark, d), [("term", "PROMO"), ("title", "ring"), ("title", "cold")])


WORD_TIERS = [(["GEAR", "BOLT"], "CRITICA"), (["RING"], "ALTA")]


@query(
    "urgency_text",
    """SELECT id, title, CASE WHEN contains(upper(title), 'GEAR') OR contains(upper(title), 'BOLT') THEN 'CRITICA'
  WHEN contains(upper(title), 'RING') THEN 'ALTA' ELSE 'NORMAL' END AS urgency FROM titles""",
    "titles",
)
def urgency_text(spark, d):
    return textmatch.urgency(X.titles(spark, d), "title", WORD_TIERS).select("id", "title", "urgency")


@query(
    "urgency_body",
    """SELECT log_id, notebook, CASE WHEN notebook = 'nb0' THEN 'CRITICA' WHEN notebook IS NOT NULL THEN 'ALTA' ELSE 'NORMAL' END AS urgency
FROM run_log WHERE affected IS NOT NULL""",
    "run_log",
)
def urgency_body(spark, d):
    return textmatch.urgency_by_body(X.run_log(spark, d), "affected", "notebook", "nb0").select("log_id", "notebook", "urgency")


def mentioned(spark, d):
    return X.table(spark, d, "documents"), X.table(spark, d, "benchmark").withColumnRenamed("text", "name")


@query("mention_join", "SELECT d.doc_id, d.source, b.item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)")
def mention_join(spark, d):
    docs, items = mentioned(spark, d)
    return textmatch.mentions(docs, items, "text", "item_id", ["name"], ["doc_id", "source"])


DOC_DAY_SQL = "CAST(DATE '2024-01-01' + CAST(doc_id % 365 AS INT) AS DATE)"


def doc_day():
    return F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 365).cast("int"))


@query(
    "mention_index",
    f"""WITH m AS (SELECT d.doc_id, b.item_id, {DOC_DAY_SQL} AS day FROM documents d JOIN benchmark b ON contains(d.text, b.text))
SELECT b.item_id, count(day) AS n_mentions, count(DISTINCT doc_id) AS n_docs, min(day) AS first_at, max(day) AS last_at, CAST(max(day) - min(day) AS INT) AS days
FROM benchmark b LEFT JOIN m USING (item_id) GROUP BY b.item_id""",
)
def mention_index(spark, d):
    """Pairs and their timeline from one stored index, which two increments have filled, the second one twice."""
    docs, items = mentioned(spark, d)
    path, rows = new_path(spark, "text-index"), docs.withColumn("day", doc_day())
    late = F.col("source") > "src3"
    for name, part in (("first", rows.filter(~late)), ("second", rows.filter(late)), ("second", rows.filter(late))):
        textindex.add(part, "text", ["doc_id", "day"], path, name)
    pairs = store(textindex.mentions(spark, path, items, "item_id", ["name"], ["doc_id", "day"]), "pairs").df
    spans = textmatch.timeline(pairs, "day", items, "item_id")
    counts = pairs.groupBy("item_id").agg(F.countDistinct("doc_id").alias("n_docs"))
    return spans.join(counts, "item_id", "left").fillna(0, ["n_docs"]).select("item_id", "n_mentions", "n_docs", "first_at", "last_at", "days")


@query(
    "mention_timeline",
    f"""WITH m AS (SELECT b.item_id, {DOC_DAY_SQL} AS day FROM documents d JOIN benchmark b ON contains(d.text, b.text))
SELECT b.item_id, min(day) AS first_at, max(day) AS last_at, count(day) AS n_mentions, CAST(max(day) - min(day) AS INT) AS days,
  CASE WHEN contains(any_value(b.text), 'then') THEN 'ENCERRADA' ELSE 'ATIVA' END AS status
FROM benchmark b LEFT JOIN m USING (item_id) GROUP BY b.item_id""",
)
def mention_timeline(spark, d):
    docs, items = mentioned(spark, d)
    found = textmatch.mention_timeline(docs.withColumn("day", doc_day()), "doc_id", "day", "text", items, "item_id", ["name"])
    return textmatch.with_status(found, "name", "then").select("item_id", "first_at", "last_at", "n_mentions", "days", "status")


@query(
    "exists_flag",
    "SELECT b.item_id, EXISTS (SELECT 1 FROM documents d WHERE contains(d.text, b.text)) AS mentioned FROM benchmark b",
)
def exists_flag(spark, d):
    docs, items = mentioned(spark, d)
    pairs = textmatch.mentions(docs, items, "text", "item_id", ["name"], ["doc_id"])
    return textmatch.flag_exists(items, pairs, "item_id", "mentioned").select("item_id", "mentioned")
