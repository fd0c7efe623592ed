"""Stand-in views of the domain tables over the standard tables, as DataFrames and as SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def props_number():
    return F.regexp_extract("props", "([0-9]+)", 1).cast("bigint")


def expenses(spark, d):
    """Document lines with member, party, region, category, supplier; document keys repeat."""
    line, orders = table(spark, d, "lineitem"), table(spark, d, "orders")
    joined = (
        line.join(orders, line.l_orderkey == orders.o_orderkey)
        .join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    return joined.select(
        F.col("o_custkey").alias("member_id"),
        F.col("c_mktsegment").alias("party"),
        F.col("c_nationkey").alias("region"),
        F.col("p_type").alias("category"),
        F.col("l_orderkey").alias("doc_code"),
        F.col("l_linenumber").alias("doc_number"),
        F.to_date("l_shipdate").alias("doc_date"),
        F.year("l_shipdate").alias("yr"),
        F.month("l_shipdate").alias("mon"),
        F.col("l_extendedprice").cast("decimal(15,2)").alias("amount"),
        F.col("l_partkey").alias("tie_part"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("s_name").alias("supplier_name"),
    )


def members(spark, d):
    joined = table(spark, d, "customer").join(
        table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.select(
        F.col("c_custkey").alias("member_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("party"),
        F.col("n_name").alias("region_name"),
        F.col("n_regionkey").alias("continent"),
        F.col("c_acctbal").cast("decimal(15,2)").alias("balance"),
    )


def stored_members(spark, d):
    """Members as loaded before: the feed of continent 2 had not arrived yet."""
    return members(spark, d).filter("continent <> 2").drop("continent")


def landed_members(spark, d):
    """Members of a later load: without continent 0, balances of one party changed."""
    changed = F.when(F.col("party") == "BUILDING", F.col("balance") + 1).otherwise(F.col("balance"))
    return (
        members(spark, d).filter("continent <> 0").drop("continent").withColumn("balance", changed.cast("decimal(15,2)"))
    )


def _events_of_members(spark, d):
    return table(spark, d, "events").join(
        table(spark, d, "customer"), F.col("user_id") == F.col("c_custkey")
    )


def votes_raw(spark, d):
    """Votes in arrival order; a member may vote several times in a session."""
    return _events_of_members(spark, d).select(
        F.col("user_id").alias("member_id"),
        F.to_date("ts").alias("session_id"),
        F.col("event_type").alias("choice"),
        F.col("event_id").alias("arrival"),
        F.col("c_mktsegment").alias("party"),
        F.concat(F.lit("BODY"), (F.dayofmonth("ts") % 4).cast("string")).alias("body"),
    )


def membership(spark, d):
    return (
        _events_of_members(spark, d)
        .select(
            props_number().alias("group_id"),
            F.col("user_id").alias("member_id"),
            F.col("c_name").alias("member_name"),
            F.col("c_mktsegment").alias("party"),
            F.col("c_nationkey").alias("region"),
        )
        .distinct()
    )


def history_raw(spark, d):
    return _events_of_members(spark, d).select(
        F.col("user_id").alias("key_id"),
        F.col("c_mktsegment").alias("kind"),
        F.col("event_id").alias("seq"),
        F.col("ts").alias("changed_at"),
        F.col("event_type").alias("state"),
        F.concat(F.lit("BODY"), (F.col("event_id") % 7).cast("string")).alias("body"),
    )


def meetings(spark, d):
    """Events with start, end (may be missing or early), type and status."""
    ends = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("end_ts"))
    orders = table(spark, d, "orders")
    return orders.join(ends, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").alias("event_id"),
        F.col("o_orderdate").alias("start_ts"),
        "end_ts",
        F.col("o_orderpriority").alias("event_type"),
        F.col("o_orderstatus").alias("status"),
    )


def attendance(spark, d):
    return (
        table(spark, d, "lineitem")
        .select(F.col("l_suppkey").alias("member_id"), F.col("l_orderkey").alias("event_id"))
        .distinct()
    )


def rough(spark, d):
    """Rows of which some lack a member, a kind or a reference."""
    e = table(spark, d, "events")
    n = F.col("event_id")
    return e.select(
        n,
        F.when(n % 17 != 0, F.col("user_id")).alias("member_id"),
        F.when(n % 23 == 0, F.lit("")).otherwise(F.col("event_type")).alias("kind"),
        F.when(n % 29 == 0, F.lit(0)).otherwise(n).cast("bigint").alias("ref_id"),
    )


def run_log(spark, d):
    """Run log, request outcomes and session stream: one row per event."""
    n, kind = F.col("event_id"), F.col("event_type")
    return table(spark, d, "events").select(
        n.alias("log_id"),
        "ts",
        F.when(kind == "error", "ERROR").when(kind == "click", "WARN").when(kind == "purchase", "SUCCESS").otherwise("INFO").alias("level"),
        F.concat(F.lit("nb"), (F.col("user_id") % 10).cast("string")).alias("notebook"),
        F.when(n % 10 == 0, F.lit("NOTEBOOK_START"))
        .when(n % 10 == 1, F.lit("NOTEBOOK_END"))
        .otherwise(F.concat(F.lit("API_"), F.upper(kind)))
        .alias("step"),
        F.col("value").alias("duration"),
        props_number().alias("affected"),
    )


def control(spark, d):
    """Watermarks of four endpoints as of the middle of the month."""
    e = table(spark, d, "events").filter("ts < TIMESTAMP_NTZ'2024-01-15 00:00:00' AND event_type <> 'signup'")
    return e.groupBy(F.col("event_type").alias("endpoint")).agg(
        F.max("event_id").cast("string").alias("last_value"), F.lit("2024-01-15").alias("updated_at")
    )


def requests(spark, d):
    """Request outcomes with an HTTP status."""
    kind = F.col("event_type")
    return table(spark, d, "events").select(
        F.col("event_id").alias("request_id"),
        F.concat(F.lit("/nb"), (F.col("user_id") % 10).cast("string"), F.lit("/"), kind).alias("endpoint"),
        F.when(kind == "error", 500).when(kind == "click", 429).when(kind == "signup", 404).otherwise(200).alias("status"),
    )


def titles(spark, d):
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_type").alias("term"), F.col("p_name").alias("title")
    )


def amounts(spark, d):
    return _events_of_members(spark, d).select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("category"),
        F.col("c_mktsegment").alias("region"),
        F.col("value").alias("amount"),
    )


SQL = {
    "expenses": """
SELECT o.o_custkey AS member_id, c.c_mktsegment AS party, c.c_nationkey AS region, p.p_type AS category,
       l.l_orderkey AS doc_code, l.l_linenumber AS doc_number, CAST(l.l_shipdate AS DATE) AS doc_date,
       CAST(year(l.l_shipdate) AS INT) AS yr, CAST(month(l.l_shipdate) AS INT) AS mon,
       CAST(l.l_extendedprice AS DECIMAL(15,2)) AS amount, l.l_partkey AS tie_part,
       l.l_suppkey AS supplier_id, s.s_name AS supplier_name
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey""",
    "fact_expenses": """
SELECT * FROM expenses QUALIFY row_number() OVER (PARTITION BY member_id, doc_code, doc_number
  ORDER BY tie_part, supplier_id, doc_date, amount) = 1""",
    "all_members": """
SELECT c.c_custkey AS member_id, c.c_name AS name, c.c_mktsegment AS party, n.n_name AS region_name,
       n.n_regionkey AS continent, CAST(c.c_acctbal AS DECIMAL(15,2)) AS balance
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "stored_members": "SELECT * EXCLUDE (continent) FROM all_members WHERE continent <> 2",
    "landed_members": """
SELECT member_id, name, party, region_name,
       CAST(CASE WHEN party = 'BUILDING' THEN balance + 1 ELSE balance END AS DECIMAL(15,2)) AS balance
FROM all_members WHERE continent <> 0""",
    "votes_raw": """
SELECT e.user_id AS member_id, CAST(e.ts AS DATE) AS session_id, e.event_type AS choice, e.event_id AS arrival,
       c.c_mktsegment AS party, concat('BODY', CAST(day(e.ts) % 4 AS VARCHAR)) AS body
FROM events e JOIN customer c ON e.user_id = c.c_custkey""",
    "votes": """
SELECT * FROM votes_raw QUALIFY row_number() OVER (PARTITION BY member_id, session_id ORDER BY arrival) = 1""",
    "membership": """
SELECT DISTINCT CAST(regexp_extract(e.props, '([0-9]+)', 1) AS BIGINT) AS group_id, e.user_id AS member_id,
       c.c_name AS member_name, c.c_mktsegment AS party, c.c_nationkey AS region
FROM events e JOIN customer c ON e.user_id = c.c_custkey""",
    "history_raw": """
SELECT e.user_id AS key_id, c.c_mktsegment AS kind, e.event_id AS seq, e.ts AS changed_at, e.event_type AS state,
       concat('BODY', CAST(e.event_id % 7 AS VARCHAR)) AS body
FROM events e JOIN customer c ON e.user_id = c.c_custkey""",
    "history": """
SELECT *, changed_at AS valid_from, lead(changed_at) OVER w AS valid_to, lead(changed_at) OVER w IS NULL AS is_current
FROM history_raw WINDOW w AS (PARTITION BY key_id ORDER BY seq)""",
    "meetings": """
SELECT o.o_orderkey AS event_id, o.o_orderdate AS start_ts, x.end_ts AS end_ts, o.o_orderpriority AS event_type,
       o.o_orderstatus AS status
FROM orders o LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS end_ts FROM lineitem GROUP BY l_orderkey) x
  ON o.o_orderkey = x.l_orderkey""",
    "attendance": "SELECT DISTINCT l.l_suppkey AS member_id, l.l_orderkey AS event_id FROM lineitem l",
    "rough": """
SELECT event_id, CASE WHEN event_id % 17 = 0 THEN NULL ELSE user_id END AS member_id,
       CASE WHEN event_id % 23 = 0 THEN '' ELSE event_type END AS kind,
       CASE WHEN event_id % 29 = 0 THEN 0 ELSE event_id END AS ref_id
FROM events""",
    "run_log": """
SELECT event_id AS log_id, ts, CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'click' THEN 'WARN'
         WHEN 'purchase' THEN 'SUCCESS' ELSE 'INFO' END AS level,
       concat('nb', CAST(user_id % 10 AS VARCHAR)) AS notebook,
       CASE WHEN event_id % 10 = 0 THEN 'NOTEBOOK_START' WHEN event_id % 10 = 1 THEN 'NOTEBOOK_END'
            ELSE concat('API_', upper(event_type)) END AS step,
       value AS duration, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS affected
FROM events""",
    "control": """
SELECT event_type AS endpoint, CAST(max(event_id) AS VARCHAR) AS last_value, '2024-01-15' AS updated_at
FROM events WHERE ts < TIMESTAMP '2024-01-15' AND event_type <> 'signup' GROUP BY 1""",
    "requests": """
SELECT event_id AS request_id, concat('/nb', CAST(user_id % 10 AS VARCHAR), '/', event_type) AS endpoint,
       CASE event_type WHEN 'error' THEN 500 WHEN 'click' THEN 429 WHEN 'signup' THEN 404 ELSE 200 END AS status
FROM events""",
    "titles": "SELECT p.p_partkey AS id, p.p_type AS term, p.p_name AS title FROM part p",
    "amounts": """
SELECT e.event_id AS id, e.event_type AS category, c.c_mktsegment AS region, e.value AS amount
FROM events e JOIN customer c ON e.user_id = c.c_custkey""",
}

NEEDS = {
    "fact_expenses": ["expenses"],
    "stored_members": ["all_members"],
    "landed_members": ["all_members"],
    "votes": ["votes_raw"],
    "history": ["history_raw"],
}


def with_views(names: list[str], sql: str) -> str:
    """`sql` with the views it reads as common table expressions."""
    ordered = []

    def add(name):
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    if not ordered:
        return sql.strip()
    views = ",\n".join(f"{name} AS ({SQL[name].strip()})" for name in ordered)
    joiner = ",\n" if sql.lstrip().startswith("WITH ") else "\n"
    body = sql.strip().removeprefix("WITH ") if joiner.startswith(",") else sql.strip()
    return f"WITH {views}{joiner}{body}"
