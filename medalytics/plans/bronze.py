"""Bronze queries: landed pages, fan-out, validity, outcomes, incremental loading, upserts."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..functions.scratch import new_path, store
from ..operators import incremental, ingest, merge
from ..sources import compaction as packing
from ..sources import pages, resume, tables
from . import fixtures as X
from .registry import query, r6

PAGE_SIZE = 50
TURN = T.StructType([T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])


def landed_pages(spark, d):
    """Pages of the conversations: lists of up to PAGE_SIZE turns, and the last turn as an object page."""
    talk = X.table(spark, d, "conversations")
    ends = talk.groupBy("conv_id").agg(F.max("turn").alias("last"))
    talk = talk.join(ends, "conv_id")
    record = F.struct("turn", "role", "text")
    links = F.array(F.struct(F.lit("next").alias("rel")))
    listed = (
        talk.filter("turn < last")
        .groupBy("conv_id", F.floor(F.col("turn") / PAGE_SIZE).alias("page"))
        .agg(F.collect_list(record).alias("dados"))
        .select("conv_id", F.to_json(F.struct("dados", links.alias("links"))).alias("value"))
    )
    single = talk.filter("turn = last").select("conv_id", F.to_json(F.struct(record.alias("dados"))).alias("value"))
    return listed.unionByName(single)


@query("envelope_explode", "SELECT conv_id, turn, role, text FROM conversations")
def envelope_explode(spark, d):
    return pages.explode_envelope(landed_pages(spark, d), TURN)


@query(
    "landed_files",
    """SELECT conv_id, turn, role, text, '{"size":"' || length(text) || '"}' AS _rescued, '/conversations' AS _source_endpoint FROM conversations""",
)
def landed_files(spark, d):
    """One file per page, read back whole; fields that the schema does not know are rescued, audit columns added."""
    folder = new_path(spark, "landing")
    talk = X.table(spark, d, "conversations").withColumn("size", F.length("text"))
    record = F.struct("conv_id", "turn", "role", "text", "size")
    paged = talk.groupBy("conv_id", F.floor(F.col("turn") / PAGE_SIZE)).agg(F.collect_list(record).alias("dados"))
    pages.write_pages(paged.select(F.to_json(F.struct("dados")).alias("value")), folder)
    records = pages.explode_records(pages.read_pages(spark, folder).select("value"))
    schema = T.StructType([T.StructField("conv_id", T.LongType()), *TURN.fields])
    rows = ingest.with_audit(pages.rescue(records, "record", schema), "/conversations", "20240131_000000")
    return rows.drop("_ingested_at", "_batch_id")


PROFILE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("nomeCivil", T.StringType()),
        T.StructField("redes", T.ArrayType(T.StringType())),
        T.StructField(
            "ultimoStatus",
            T.StructType(
                [
                    T.StructField("siglaPartido", T.StringType()),
                    T.StructField("gabinete", T.StructType([T.StructField("nome", T.StringType()), T.StructField("sala", T.StringType())])),
                ]
            ),
        ),
    ]
)


@query(
    "flatten_nested",
    "SELECT c_custkey AS id, c_name AS \"nomeCivil\", c_mktsegment AS \"status_siglaPartido\", c_name AS gabinete_nome, CAST(c_nationkey AS VARCHAR) AS gabinete_sala FROM customer",
)
def flatten_nested(spark, d):
    office = F.struct(F.col("c_name").alias("nome"), F.col("c_nationkey").cast("string").alias("sala"))
    record = F.struct(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("nomeCivil"),
        F.array("c_name", "c_mktsegment").alias("redes"),
        F.struct(F.col("c_mktsegment").alias("siglaPartido"), office.alias("gabinete")).alias("ultimoStatus"),
    )
    landed = X.table(spark, d, "customer").select(F.to_json(record).alias("value"))
    parsed = landed.select(F.from_json("value", PROFILE).alias("r")).select("r.*")
    return pages.flatten_struct(parsed, {"ultimoStatus": "status_", "ultimoStatus.gabinete": "gabinete_"})


def succeeded():
    return F.col("status") == 200


@query(
    "outcome_split",
    "SELECT request_id, endpoint, status, CASE WHEN status = 200 THEN 'data' ELSE 'error' END AS outcome FROM requests",
    "requests",
)
def outcome_split(spark, d):
    good, bad = ingest.outcome_split(X.requests(spark, d), succeeded())
    return good.withColumn("outcome", F.lit("data")).unionByName(bad.withColumn("outcome", F.lit("error")))


@query(
    "child_tagging",
    """SELECT e.member_id AS _member_id, e.doc_code, e.doc_number, e.tie_part, e.supplier_id, 'expenses' AS kind
FROM expenses e JOIN all_members m USING (member_id)""",
    "expenses all_members",
)
def child_tagging(spark, d):
    children = X.expenses(spark, d).select("member_id", "doc_code", "doc_number", "tie_part", "supplier_id")
    return ingest.tag_children(X.members(spark, d), children, "member_id", extra={"kind": "expenses"})


@query(
    "child_enrich",
    """SELECT e.member_id AS _member_id, e.doc_code, e.doc_number, e.tie_part, e.supplier_id, m.name AS _name, m.region_name AS _region
FROM expenses e JOIN all_members m USING (member_id)""",
    "expenses all_members",
)
def child_enrich(spark, d):
    children = X.expenses(spark, d).select("member_id", "doc_code", "doc_number", "tie_part", "supplier_id")
    return ingest.tag_children(X.members(spark, d), children, "member_id", {"name": "name", "region_name": "region"})


@query("path_key_extract", "SELECT page_id, split_part(url, '/', 3) AS host, split_part(url, '/', 4) AS section FROM pages")
def path_key_extract(spark, d):
    return X.table(spark, d, "pages").select(
        "page_id", C.path_key(F.col("url")).alias("host"), C.path_key(F.col("url"), 4).alias("section")
    )


@query(
    "stringify_all",
    "SELECT " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in "member_id party region category doc_code doc_number doc_date yr mon amount tie_part supplier_id supplier_name".split()) + " FROM expenses",
    "expenses",
)
def stringify_all(spark, d):
    return ingest.stringify_all(X.expenses(spark, d))


@query(
    "valid_split",
    """SELECT event_id, member_id, kind, ref_id, concat_ws(',', CASE WHEN member_id IS NULL OR member_id = 0 THEN 'member_id' END,
  CASE WHEN kind IS NULL OR kind = '' THEN 'kind' END, CASE WHEN ref_id IS NULL OR ref_id = 0 THEN 'ref_id' END) AS missing FROM rough""",
    "rough",
)
def valid_split(spark, d):
    valid, rejected = ingest.split_valid(X.rough(spark, d), ["member_id", "kind", "ref_id"])
    return valid.withColumn("missing", F.lit("")).unionByName(rejected.withColumnRenamed("_missing", "missing"))


@query(
    "audit_columns",
    """SELECT member_id, doc_code, doc_number, tie_part, supplier_id, '/deputados/despesas' AS _source_endpoint, '20240131_000000' AS _batch_id,
  true AS has_time FROM expenses""",
    "expenses",
)
def audit_columns(spark, d):
    marked = ingest.with_audit(X.expenses(spark, d), "/deputados/despesas", "20240131_000000")
    has_time = F.col("_ingested_at").isNotNull().alias("has_time")
    return marked.select("member_id", "doc_code", "doc_number", "tie_part", "supplier_id", "_source_endpoint", "_batch_id", has_time)


def joined(cols):
    """SQL of the text that a row's digest is taken over."""
    return " || ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in cols.split())


@query(
    "payload_hash",
    f"SELECT key_id, seq, md5({joined('body key_id kind seq state')}) AS payload_hash FROM history_raw",
    "history_raw",
)
def payload_hash(spark, d):
    cols = ["key_id", "kind", "seq", "state", "body"]
    hashed = ingest.payload_hash(X.history_raw(spark, d), cols, "payload_hash", json=False)
    return hashed.select("key_id", "seq", "payload_hash")


@query(
    "audit_sample",
    """WITH n AS (SELECT member_id, row_number() OVER (ORDER BY member_id) - 1 AS position, count(*) OVER () AS c FROM all_members),
m AS (SELECT *, position IN (0, c // 4, c // 2, 3 * c // 4, c - 1) AS mark FROM n),
f AS (SELECT * FROM m WHERE NOT mark ORDER BY md5(member_id || '|0'), member_id LIMIT 5)
SELECT member_id, position, 'position' AS kind FROM m WHERE mark UNION ALL SELECT member_id, position, 'fill' FROM f""",
    "all_members",
)
def audit_sample(spark, d):
    return ingest.audit_sample(X.members(spark, d).select("member_id"), ["member_id"]).select("member_id", "position", "kind")


@query(
    "success_gate",
    """SELECT endpoint, count(*) AS n_requests, count(*) FILTER (status = 200) AS n_ok, count(*) FILTER (status <> 200) AS n_failed,
  round(count(*) FILTER (status = 200) / count(*), 6) AS success_rate, count(*) FILTER (status = 200) / count(*) >= 0.8 AS passes
FROM requests GROUP BY endpoint""",
    "requests",
)
def success_gate(spark, d):
    return ingest.success_gate(X.requests(spark, d), ["endpoint"], succeeded()).withColumn("success_rate", F.round("success_rate", 6))


@query(
    "error_histogram",
    """SELECT CASE status WHEN 429 THEN 'HTTP 429 (Rate Limit)' WHEN 400 THEN 'HTTP 400 (Bad Request)' WHEN 404 THEN 'HTTP 404 (Not Found)'
  WHEN 500 THEN 'HTTP 500 (Server Error)' ELSE 'Connection/Timeout Error' END AS kind, count(*) AS n_errors,
  round(count(*) / (SELECT count(*) FROM requests), 6) AS error_rate,
  (SELECT round(count(*) FILTER (status <> 200) / count(*), 6) FROM requests) AS total_rate,
  (SELECT count(*) FILTER (status <> 200) / count(*) FROM requests) > 0.05 AS alert
FROM requests WHERE status <> 200 GROUP BY 1""",
    "requests",
)
def error_histogram(spark, d):
    found = ingest.error_histogram(X.requests(spark, d), C.error_kind(F.col("status")), succeeded())
    return found.select("kind", "n_errors", r6("error_rate"), r6("total_rate"), "alert")


@query(
    "failure_run",
    """WITH o AS (SELECT notebook, log_id, level = 'ERROR' OR level = 'WARN' AS bad,
  sum(CASE WHEN level IN ('ERROR', 'WARN') THEN 0 ELSE 1 END) OVER (PARTITION BY notebook ORDER BY log_id) AS island FROM run_log),
p AS (SELECT *, row_number() OVER (PARTITION BY notebook, island ORDER BY log_id) AS pos FROM o WHERE bad)
SELECT n.notebook, coalesce(max(pos), 0) AS longest_run, min(log_id) FILTER (pos = 5) AS abort_at
FROM (SELECT DISTINCT notebook FROM run_log) n LEFT JOIN p USING (notebook) GROUP BY n.notebook""",
    "run_log",
)
def failure_run(spark, d):
    return ingest.failure_runs(X.run_log(spark, d), ["notebook"], "log_id", F.col("level").isin("ERROR", "WARN"), limit=5)


@query("category_union", "SELECT arrival, member_id, session_id, choice FROM votes_raw", "votes_raw")
def category_union(spark, d):
    """One directory per category, read back at once with the category as a column."""
    path = new_path(spark, "categories")
    votes = X.votes_raw(spark, d).select("arrival", "member_id", "session_id", "choice")
    votes.write.partitionBy("choice").parquet(path)
    return spark.read.schema(votes.schema).parquet(path)


# incremental -------------------------------------------------------------------------------------


@query("watermark_get", "SELECT endpoint, last_value FROM control WHERE endpoint = 'click'", "control")
def watermark_get(spark, d):
    return incremental.watermark_row(X.control(spark, d), "click")


def observed_marks(spark, d):
    seen = incremental.watermark_max(X.table(spark, d, "events").withColumnRenamed("event_type", "endpoint"), ["endpoint"], "event_id")
    return seen.select("endpoint", F.col("last_value").cast("string").alias("last_value"), F.lit("2024-01-31").alias("updated_at"))


@query(
    "watermark_upsert",
    """WITH s AS (SELECT event_type AS endpoint, CAST(max(event_id) AS VARCHAR) AS last_value, '2024-01-31' AS updated_at FROM events WHERE event_type <> 'view' GROUP BY 1)
SELECT * FROM s UNION ALL SELECT * FROM control WHERE endpoint NOT IN (SELECT endpoint FROM s)""",
    "control",
)
def watermark_upsert(spark, d):
    ran = observed_marks(spark, d).filter("endpoint <> 'view'")
    return incremental.watermark_merge(X.control(spark, d), ran)


@query("watermark_max", "SELECT event_type, max(event_id) AS last_value FROM events GROUP BY event_type")
def watermark_max(spark, d):
    return incremental.watermark_max(X.table(spark, d, "events"), ["event_type"], "event_id")


@query(
    "incremental_filter",
    """SELECT e.event_id, e.event_type FROM events e LEFT JOIN control c ON c.endpoint = e.event_type
WHERE c.last_value IS NULL OR e.event_id > CAST(c.last_value AS BIGINT)""",
    "control",
)
def incremental_filter(spark, d):
    marks = X.control(spark, d).withColumnRenamed("endpoint", "event_type")
    return incremental.newer_than_each(X.table(spark, d, "events"), marks, "event_type", "event_id").select("event_id", "event_type")


@query(
    "period_plan",
    """WITH l AS (SELECT party, max(doc_date) AS last FROM expenses GROUP BY party)
SELECT party, CAST(year(m) AS INT) AS year, CAST(month(m) AS INT) AS month
FROM (SELECT party, unnest(generate_series(date_trunc('month', last) + INTERVAL 1 MONTH, TIMESTAMP '2003-12-01', INTERVAL 1 MONTH)) AS m FROM l)""",
    "expenses",
)
def period_plan(spark, d):
    last = X.expenses(spark, d).groupBy("party").agg(F.max("doc_date").alias("last"))
    return incremental.period_plan_each(last, "party", "last", "2003-12")


@query("resume_missing", "SELECT member_id FROM all_members WHERE member_id NOT IN (SELECT member_id FROM membership)", "all_members membership")
def resume_missing(spark, d):
    children = X.table(spark, d, "events").select(F.col("user_id").alias("member_id"))
    return incremental.missing_children(X.members(spark, d).select("member_id"), children, "member_id")


# sinks -------------------------------------------------------------------------------------------

EXPENSE_COLS = ["member_id", "doc_code", "doc_number", "tie_part", "supplier_id", "yr", "amount"]


@query(
    "bronze_roundtrip",
    "SELECT member_id, doc_code, doc_number, tie_part, supplier_id, yr, CAST(amount AS DOUBLE) AS amount, '/expenses' AS source FROM expenses",
    "expenses",
)
def bronze_roundtrip(spark, d):
    path = new_path(spark, "bronze")
    tables.write_bronze(X.expenses(spark, d).select(*EXPENSE_COLS), path, "/expenses", partition_by=["yr"])
    back = spark.read.parquet(path)
    return back.select(*EXPENSE_COLS[:-1], r6("amount"), F.col("_source_endpoint").alias("source"))


@query(
    "partition_overwrite",
    "SELECT member_id, doc_code, doc_number, tie_part, supplier_id, yr, round(CAST(CASE WHEN yr = 1996 THEN amount * 2 ELSE amount END AS DOUBLE), 6) AS amount FROM expenses",
    "expenses",
)
def partition_overwrite(spark, d):
    path = new_path(spark, "partitions")
    rows = X.expenses(spark, d).select(*EXPENSE_COLS).withColumn("amount", F.col("amount").cast("double"))
    tables.write_table(rows, path, partition_by=["yr"])
    tables.write_table(rows.filter("yr = 1996").withColumn("amount", F.col("amount") * 2), path, partition_by=["yr"])
    return spark.read.parquet(path).select(*EXPENSE_COLS[:-1], r6("amount"))


MERGED_SQL = """SELECT member_id, name, party, region_name, CAST(balance AS DOUBLE) AS balance FROM landed_members
UNION ALL SELECT member_id, name, party, region_name, CAST(balance AS DOUBLE) FROM stored_members WHERE member_id NOT IN (SELECT member_id FROM landed_members)"""
MEMBER_COLS = ["member_id", "name", "party", "region_name"]
HASHED = "balance member_id name party region_name"


@query("upsert_merge", MERGED_SQL, "stored_members landed_members")
def upsert_merge(spark, d):
    path = new_path(spark, "members")
    tables.upsert_path(spark, path, X.stored_members(spark, d), ["member_id"])
    tables.upsert_path(spark, path, X.landed_members(spark, d), ["member_id"])
    return spark.read.parquet(path).select(*MEMBER_COLS, r6("balance"))


@query("replay_idempotent", MERGED_SQL, "stored_members landed_members")
def replay_idempotent(spark, d):
    landed = X.landed_members(spark, d)
    once = merge.upsert(X.stored_members(spark, d), landed, ["member_id"])
    return merge.upsert(once, landed, ["member_id"]).select(*MEMBER_COLS, r6("balance"))


def hashed(df):
    return ingest.payload_hash(df, MEMBER_COLS + ["balance"], "payload_hash", json=False)


@query(
    "cdc_classify",
    f"""WITH o AS (SELECT member_id, md5({joined(HASHED)}) AS h FROM stored_members),
n AS (SELECT member_id, md5({joined(HASHED)}) AS h FROM landed_members)
SELECT member_id, o.h AS old_hash, n.h AS new_hash,
  CASE WHEN o.h IS NULL THEN 'INSERT' WHEN n.h IS NULL THEN 'ABSENT' WHEN o.h = n.h THEN 'UNCHANGED' ELSE 'UPDATE' END AS change
FROM o FULL JOIN n USING (member_id)""",
    "stored_members landed_members",
)
def cdc_classify(spark, d):
    return merge.cdc_classify(hashed(X.stored_members(spark, d)), hashed(X.landed_members(spark, d)), ["member_id"], "payload_hash")


@query("upsert_changed", MERGED_SQL, "stored_members landed_members")
def upsert_changed(spark, d):
    found = merge.upsert_changed(hashed(X.stored_members(spark, d)), hashed(X.landed_members(spark, d)), ["member_id"], "payload_hash")
    return found.select(*MEMBER_COLS, r6("balance"))


@query("full_refresh", "SELECT member_id, name, party, region_name, CAST(balance AS DOUBLE) AS balance FROM landed_members", "landed_members")
def full_refresh(spark, d):
    path = new_path(spark, "refresh")
    tables.write_table(X.stored_members(spark, d), path)
    tables.write_table(X.landed_members(spark, d), path)
    return spark.read.parquet(path).select(*MEMBER_COLS, r6("balance"))


@query("compaction", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def compaction(spark, d):
    raw, out = new_path(spark, "small-files"), new_path(spark, "compacted")
    X.table(spark, d, "events").repartition(32).write.parquet(raw)
    return tables.compact(spark, raw, out, 4, ["event_type", "event_id"])


@query("compaction_bins", "SELECT event_id, ts, user_id, event_type, value, props, true AS is_packed FROM events")
def compaction_bins(spark, d):
    """Many small files per partition and one large one: the small ones are joined, the large one keeps its name."""
    path, events = new_path(spark, "many-files"), X.table(spark, d, "events")
    events.filter("event_type <> 'view'").repartition(24).write.partitionBy("event_type").parquet(path)
    events.filter("event_type = 'view'").coalesce(1).write.mode("append").partitionBy("event_type").parquet(path)
    before = packing.data_files(spark, path).agg(F.count("*").alias("n"), F.max("bytes").alias("most"), F.max_by("file", "bytes").alias("large")).first()
    packing.compact(spark, path, before["most"], sort_by=["event_id"])
    after = packing.data_files(spark, path).agg(F.count("*").alias("n"), F.max(F.col("file") == before["large"]).alias("kept")).first()
    packed = after["n"] < before["n"] / 2 and after["kept"]
    return spark.read.parquet(path).select(*events.columns, F.lit(packed).alias("is_packed"))


def monthly_units(spark, d):
    """What is to be loaded: every region in every month that has documents."""
    orders = X.table(spark, d, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM").alias("month")).distinct()
    return orders.join(X.table(spark, d, "nation").select(F.col("n_nationkey").alias("region")))


def lines_of(spark, d, units):
    """The document lines of some units, with their month."""
    line, order, customer = (X.table(spark, d, t) for t in ("lineitem", "orders", "customer"))
    lines = line.join(order, line.l_orderkey == order.o_orderkey).join(customer, F.col("o_custkey") == F.col("c_custkey"))
    lines = lines.withColumn("month", F.date_format("l_shipdate", "yyyy-MM")).withColumn("region", F.col("c_nationkey"))
    months = units.select("month").distinct()
    rows = lines.join(months, "month", "left_semi").join(units, ["month", "region"], "left_semi")
    return rows.select("month", "region", F.col("l_orderkey").alias("doc_code"), F.col("l_linenumber").alias("doc_number"), F.col("l_extendedprice").alias("amount"))


@query(
    "resumable_load",
    """SELECT strftime(l_shipdate, '%Y-%m') AS month, c_nationkey AS region, count(*) AS n_rows, round(sum(CAST(l_extendedprice AS DECIMAL(15,2))), 2)::DOUBLE AS amount
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
)
def resumable_load(spark, d):
    """A load by months that stops after two jobs, and a second run that does the rest."""
    units, path = store(monthly_units(spark, d), "units").df, new_path(spark, "load")
    fetch = lambda some: lines_of(spark, d, some)
    resume.load(units, "month", fetch, path, at_once=24, stop_after=2)
    resume.load(units, "month", fetch, path, at_once=60)
    rows = resume.finished_rows(spark, path, lines_of(spark, d, units).schema, "month")
    amount = F.sum(F.col("amount").cast("decimal(15,2)")).cast("double")
    return rows.groupBy("month", "region").agg(F.count(F.lit(1)).alias("n_rows"), F.round(amount, 2).alias("amount"))


@query(
    "schema_union",
    "SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN role END AS role, CASE WHEN turn % 3 = 1 THEN length(text) END AS size, text FROM conversations",
)
def schema_union(spark, d):
    """Records whose keys differ from page to page; no schema is given, every key becomes a column."""
    talk = X.table(spark, d, "conversations")
    size = F.when(F.col("turn") % 3 == 1, F.length("text"))
    role = F.when(F.col("turn") % 2 == 0, F.col("role"))
    record = F.to_json(F.struct("conv_id", "turn", role.alias("role"), size.alias("size"), "text"))
    found = pages.with_merged_schema(talk.select(record.alias("record")))
    return found.select("conv_id", F.col("turn").cast(talk.schema["turn"].dataType), "role", "size", "text")


@query("sql_scan", "SELECT event_type, count(*) AS n, max(event_id) AS last_id FROM events WHERE value > 50 AND event_type <> 'view' GROUP BY event_type")
def sql_scan(spark, d):
    """SQL text over a DataFrame, with bound values."""
    text = "SELECT event_type, count(*) AS n, max(event_id) AS last_id FROM {rows} WHERE value > :low AND event_type <> :skip GROUP BY event_type"
    return tables.sql_over(spark, text, {"low": 50, "skip": "view"}, rows=X.table(spark, d, "events"))


@query(
    "load_modes",
    """SELECT mode, e.event_id, e.event_type FROM events e LEFT JOIN control c ON e.event_type = c.endpoint, (VALUES ('full'), ('incremental')) m(mode)
WHERE mode = 'full' OR c.last_value IS NULL OR e.event_id > CAST(c.last_value AS BIGINT)""",
    "control",
)
def load_modes(spark, d):
    """Every endpoint loaded in full, as its table is missing, and after its watermark, as the table is there."""
    events, marks = X.table(spark, d, "events"), X.control(spark, d)
    events.createOrReplaceTempView("medalytics_landed_events")
    found = []
    for table, mode in (("medalytics_missing_events", "full"), ("medalytics_landed_events", "incremental")):
        rows = tables.first_available(spark, [table, "medalytics_landed_events"])
        full = incremental.is_full_load(spark, table, incremental.watermark_get(marks, "click"))
        rows = rows if full else incremental.newer_than_each(rows.withColumnRenamed("event_type", "endpoint"), marks, "endpoint", "event_id").withColumnRenamed("endpoint", "event_type")
        found.append(rows.select(F.lit(mode).alias("mode"), "event_id", "event_type"))
    return merge.concat_batches(found)


@query("gold_table", "SELECT event_type, count(*) AS n_events, count(DISTINCT user_id) AS n_users, true AS is_stamped FROM events GROUP BY event_type")
def gold_table(spark, d):
    """A gold table written with its processing time and read back."""
    path, events = new_path(spark, "gold"), X.table(spark, d, "events")
    totals = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_events"), F.countDistinct("user_id").alias("n_users"))
    tables.run_step("events_by_type", lambda: totals, path)
    return spark.read.parquet(path).select("event_type", "n_events", "n_users", F.col("_processed_at").isNotNull().alias("is_stamped"))
