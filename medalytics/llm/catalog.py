"""The registered queries of the operators, with SQL where SQL can express them."""

import os
import string

from pyspark.sql import functions as F

from . import ann, audit, hnsw, langid, linededup, merkle, mixing, pieces, secretscan, simhash, suffixdedup, toxicity, warc
from .shared import table

#: A file of pieces with byte fallback; any other may be given to `pieces.vocabulary`.
VOCABULARY = os.environ.get("PIECES_MODEL", "/opt/tokenizers/piece_bpe_32k.model")

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    def keep(plan):
        QUERIES[name] = plan
        if sql:
            ORACLES[name] = sql
        return plan

    return keep


@query("op1_suffix_dedup")
def op1_suffix_dedup(spark, folder):
    return suffixdedup.report(suffixdedup.remove_repeats(table(spark, folder, "documents")))


OP2_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
f AS (SELECT body, min(page_id) AS owner FROM p GROUP BY body),
d AS (SELECT p.page_id, octet_length(encode(p.body)) AS n, sha1(encode(p.body)) AS h, f.owner FROM p JOIN f USING (body))
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((CAST('0x' || substr(h, 1 + 5 * (i // 4), 5) AS INTEGER) >> (15 - 5 * (i % 4))) & 31), 1)), '') AS payload_digest,
       CASE WHEN page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> owner THEN owner END AS refers_to
FROM d
"""


@query("op2_warc", OP2_SQL)
def op2_warc(spark, folder):
    return warc.read_back(warc.write_archive(table(spark, folder, "pages")))


@query("op3_simhash")
def op3_simhash(spark, folder):
    groups = simhash.near_groups(table(spark, folder, "documents"))
    return groups.select(F.col("id").alias("doc_id"), simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


@query("op4_sentencepiece")
def op4_sentencepiece(spark, folder):
    return pieces.sampled(table(spark, folder, "documents"), pieces.vocabulary(VOCABULARY))


OP5_SQL = """
WITH v AS (SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM r WHERE place <= 20
"""


@query("op5_ann", OP5_SQL)
def op5_ann(spark, folder):
    return ann.search(table(spark, folder, "embeddings"), lambda i: i % 20 == 0)


@query("op6_mixing")
def op6_mixing(spark, folder):
    mixed = mixing.mix(table(spark, folder, "documents"), keep=["doc_id", "source"])
    return mixed.select("row.doc_id", "row.source", "n_tokens", "epoch", "block", "place")


OP7_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id
    AND list_inner_product(a.e, b.e) / (sqrt(list_inner_product(a.e, a.e)) * sqrt(list_inner_product(b.e, b.e))) >= 0.93),
reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
part AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN part ON v.vec_id = part.a LEFT JOIN n ON v.vec_id = n.a
"""


@query("op7_embedding_dedup", OP7_SQL)
def op7_embedding_dedup(spark, folder):
    return hnsw.near_vectors(table(spark, folder, "embeddings"))


OP8_SQL = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
l AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS line_key FROM l),
o AS (SELECT line_key, max(doc_id) AS keeper FROM k WHERE length(line_key) >= 20 GROUP BY line_key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, o.keeper IS NOT NULL AND k.doc_id <> o.keeper AS lost FROM k LEFT JOIN o USING (line_key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@query("op8_line_dedup", OP8_SQL)
def op8_line_dedup(spark, folder):
    return linededup.report(linededup.dedup_lines(table(spark, folder, "documents")))


@query("op9_secrets")
def op9_secrets(spark, folder):
    docs = table(spark, folder, "documents")
    return secretscan.report(secretscan.find_secrets(docs, words=secretscan.learned_words(docs)))


@query("op10_language")
def op10_language(spark, folder):
    docs = table(spark, folder, "documents")
    found = langid.identify(docs, langid.learned_from(docs), keep=["doc_id"])
    held_out = F.coalesce(langid.remainder(F.col("row.doc_id")) == 1, F.lit(False))
    return found.select("row.doc_id", held_out.alias("held_out"), "lang_pred", "score")


OP11_SQL = """
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
        doc_id > min(doc_id) OVER (PARTITION BY text) AS later FROM d),
m AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
f AS (SELECT part, len(words) < 200 AS a, 100 * len(list_distinct(words)) < 50 * len(words) AS b,
        100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) AS c, regexp_matches(text, '[#$%&*|]') AS d,
        coalesce(later, false) AS e, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM w LEFT JOIN m USING (doc_id)),
cells AS (SELECT part, map {'A': a, 'B': b, 'C': c, 'D': d, 'E': e} AS fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM l p, l q, l r, l s, l t
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
steps AS (SELECT filter_order, CAST(k AS INTEGER) AS step, substr(filter_order, k, 1) AS filter,
    string_split(substr(filter_order, 1, k - 1), '') AS before, list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: x <> substr(filter_order, k, 1)) AS others
  FROM o, generate_series(1, 5) g(k)),
met AS (SELECT part, filter_order, step, filter, n, good, toxic, fails[filter] AS failing,
    len(list_filter(before, lambda x: x <> '' AND fails[x])) = 0 AS arrived, len(list_filter(others, lambda x: fails[x])) = 0 AS alone
  FROM steps, cells),
r AS (SELECT part, filter_order, step, filter,
    CAST(coalesce(sum(n) FILTER (WHERE arrived AND NOT failing), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER (WHERE arrived AND failing), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (WHERE NOT arrived AND failing), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (WHERE failing AND alone), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(good) FILTER (WHERE arrived AND failing), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(toxic) FILTER (WHERE arrived AND failing), 0) AS BIGINT) AS toxic_lost
  FROM met GROUP BY part, filter_order, step, filter)
SELECT *, CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley FROM r
"""


@query("op11_filter_audit", OP11_SQL)
def op11_filter_audit(spark, folder):
    return audit.interaction(audit.contingency(table(spark, folder, "documents"), table(spark, folder, "labels")))


@query("op12_toxicity")
def op12_toxicity(spark, folder):
    docs = table(spark, folder, "documents")
    scored = toxicity.score(docs, toxicity.learn(docs, table(spark, folder, "labels")), keep=["doc_id"])
    held_out = F.coalesce(toxicity.remainder(F.col("row.doc_id")) == 0, F.lit(False))
    return scored.select("row.doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _merkle_sql(levels=12):
    """The tree in SQL, a fixed number of levels up; a tree that is down to its root stays as it is."""

    def tree(name, source, tops):
        parts = [f"{name}0 AS (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {source})"]
        for k in range(tops):
            whole = f"SELECT tree, idx // 8 AS run, list(digest ORDER BY idx) AS nodes, max(n) AS n FROM {name}{k} GROUP BY tree, idx // 8"
            digest = "CASE WHEN n = 1 THEN nodes[1] ELSE sha256(array_to_string(nodes, '')) END"
            parts.append(f"{name}_run{k} AS ({whole})")
            parts.append(f"{name}{k + 1} AS (SELECT tree, run AS idx, {digest} AS digest, CAST(ceil(n / 8) AS BIGINT) AS n FROM {name}_run{k})")
        return parts

    def up(into, source, name, tops):
        """Fold `own` (untampered and tampered) up the runs, adding the siblings to `proof`."""
        parts, before = [], source
        for k in range(tops):
            place = "CAST(s.idx % 8 AS INTEGER) + 1"
            others = f"array_to_string(list_concat(r.nodes[1:s.idx % 8], r.nodes[s.idx % 8 + 2:]), '')"
            changed = f"array_to_string(list_concat(list_concat(r.nodes[1:s.idx % 8], [s.own]), r.nodes[s.idx % 8 + 2:]), '')"
            step = (
                f"SELECT s.* REPLACE (s.idx // 8 AS idx, CASE WHEN r.n = 1 THEN s.proof ELSE s.proof || {others} END AS proof, "
                f"CASE WHEN r.n = 1 THEN s.own ELSE sha256({changed}) END AS own) "
                f"FROM {before} s JOIN {name}_run{k} r ON s.tree = r.tree AND s.idx // 8 = r.run"
            )
            before = f"{into}{k + 1}"
            parts.append(f"{before} AS ({step})")
        return parts, before

    def code(column):
        text = f"CAST({column} AS VARCHAR)"
        return f"coalesce(octet_length(encode({text})) || ':' || {text}, '-')"

    def leaf(text):
        return "sha256(" + " || ".join(code(c) for c in ("doc_id", "source", "lang", "n_chars")) + f" || {code(text)})"

    # crc32 of a short text, bit by bit
    flip = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    crc = (
        "list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))), "
        "lambda s, b: list_reduce(list_prepend(xor(s, b), [0, 0, 0, 0, 0, 0, 0, 0]), "
        "lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))"
    )
    parts = [
        f"d AS (SELECT *, coalesce(xor(CAST({crc} AS BIGINT), 4294967295) % 3 = 0, false) AS tampered FROM documents)",
        f"h AS (SELECT doc_id, lang, {leaf('text')} AS digest, CASE WHEN tampered THEN {leaf(flip)} END AS changed FROM d)",
        "g AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT lang FROM documents))",
        "leaves AS (SELECT h.*, g.tree, row_number() OVER (PARTITION BY g.tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS idx "
        "FROM h JOIN g ON h.lang IS NOT DISTINCT FROM g.lang)",
        "low AS (SELECT tree, idx, digest FROM leaves)",
        *tree("t", "low", levels),
        f"subs AS (SELECT CAST(0 AS BIGINT) AS tree, tree AS idx, digest FROM t{levels})",
        *tree("u", "subs", levels),
        "way0 AS (SELECT doc_id, digest AS leaf, tree AS grp, tree, idx, coalesce(changed, digest) AS own, '' AS proof FROM leaves)",
    ]
    folds, last = up("way", "way0", "t", levels)
    parts += [*folds, f"over0 AS (SELECT * REPLACE (CAST(0 AS BIGINT) AS tree, grp AS idx) FROM {last})"]
    folds, last = up("over", "over0", "u", levels)
    parts += folds
    return (
        "WITH " + ",\n".join(parts) + f"\nSELECT w.doc_id, w.leaf, s.digest AS subroot, r.digest AS root, sha256(w.proof) AS proof_sha256, "
        f"w.own AS folded_root, w.own = r.digest AS verified FROM {last} w JOIN subs s ON w.grp = s.idx JOIN u{levels} r ON true"
    )


OP13_SQL = _merkle_sql()


@query("op13_merkle", OP13_SQL)
def op13_merkle(spark, folder):
    docs = table(spark, folder, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    made = merkle.verify(docs, tampered, {"text": lowered}, ["doc_id", "source", "lang", "n_chars", "text"], "lang", ["doc_id"])
    return made.select("row.doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
