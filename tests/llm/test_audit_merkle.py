"""Filter audit and manifest against brute force, with awkward, repeated and missing rows."""

import hashlib
import re
import zlib
from itertools import permutations

import pytest
from pyspark.sql import functions as F

import cases
from medalytics.llm import audit, merkle

LABELS = "doc_id long, quality int, toxic int, part string"


def labels(spark):
    rows = [(i, i % 2, int(i % 3 == 0), "x") for i in range(16)] + [(3, 1, 0, "x"), (3, None, None, "x"), (None, 1, 1, "x"), (99, 1, 1, "x")]
    return spark.createDataFrame(rows, LABELS)


def failures(row, rows):
    text = row.text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    earlier = row.doc_id is not None and any(o.doc_id is not None and o.doc_id < row.doc_id and (o.text or "") == text for o in rows)
    return {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
        "D": bool(re.search("[#$%&*|]", text)),
        "E": earlier,
    }


def brute_audit(docs, marks):
    rows, result = docs.collect(), {}
    good = {m.doc_id for m in marks.collect() if m.quality == 1} - {None}
    toxic = {m.doc_id for m in marks.collect() if m.toxic == 1} - {None}
    failed = [(r, failures(r, rows)) for r in rows]
    for part in {r.lang or "" for r in rows}:
        own = [(r, f) for r, f in failed if (r.lang or "") == part]
        removed_by = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, name in enumerate(order):
                gone = [x for x in left if x[1][name]]
                left = [x for x in left if not x[1][name]]
                failing = [f for _, f in own if f[name]]
                unique = sum(sum(f.values()) == 1 for f in failing)
                lost = [sum(r.doc_id in some for r, _ in gone) for some in (good, toxic)]
                removed_by[name] += len(gone)
                result[part, "".join(order), step + 1] = [name, len(left), len(gone), len(failing) - len(gone), unique, *lost]
    totals = {}
    for (part, order, step), line in result.items():
        totals[part, line[0]] = totals.get((part, line[0]), 0) + line[2]
    return {key: (*line, totals[key[0], line[0]]) for key, line in result.items()}


def test_audit_of_awkward_rows(spark):
    docs = cases.awkward(spark)
    texts = ["word " * 250, "x y " * 120, "A$ b " * 110, " ".join(f"w{i}" for i in range(300)), " ".join(f"w{i}" for i in range(300)), "WORD " * 250]
    more = spark.createDataFrame([(100 + i, t, ["en", None][i % 2], "s", 1, *["z"] * 6) for i, t in enumerate(texts)], docs.schema)
    docs = docs.union(more)
    found = audit.interaction(audit.contingency(docs, labels(spark))).collect()
    expected = brute_audit(docs, labels(spark))
    got = {(r.part, r.filter_order, r.step): (r.filter, *[r[m] for m in audit.MEASURES]) for r in found}
    assert len(found) == len(expected) and got == expected
    assert sum(v[1] for k, v in got.items() if k[2] == 5 and k[1] == "ABCDE") + sum(
        v[2] for k, v in got.items() if k[1] == "ABCDE") == docs.count()


def test_audit_of_nothing(spark):
    counts = audit.contingency(cases.empty(spark), labels(spark).limit(0))
    assert audit.interaction(counts).count() == 0
    alone = cases.empty(spark).union(cases.awkward(spark).filter("doc_id = 1"))
    assert audit.interaction(audit.contingency(alone, labels(spark).limit(0))).count() == 600


def test_a_shared_text_is_counted_without_its_rows(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"), F.lit("en").alias("lang"))
    found = audit.interaction(audit.contingency(docs, labels(spark))).filter("filter_order = 'ECDBA' AND step = 1").first()
    assert (found.kept, found.removed, found.unique_fails) == (1, 2999, 0)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def climb(nodes, arity):
    """The root, and for every leaf its (position, others) per level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, i in enumerate(at):
            first = i - i % arity
            run = nodes[first : first + arity]
            paths[leaf].append((i % arity, run[: i % arity] + run[i % arity + 1 :]))
            at[leaf] = i // arity
        nodes = [sha("".join(nodes[i : i + arity])) for i in range(0, len(nodes), arity)]
    return nodes[0], paths


def brute_manifest(rows, arity):
    def code(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r, text):
        return sha("".join(code(v) for v in (r.doc_id, r.source, r.lang, r.n_chars, text)))

    def low(text):
        return None if text is None else re.sub("[A-Z]", lambda m: m[0].lower(), text)

    groups = {}
    for r in rows:
        groups.setdefault(r.lang, []).append((r.doc_id is not None, r.doc_id or 0, leaf(r, r.text), leaf(r, low(r.text))))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort()
        trees[name] = climb([x[2] for x in groups[name]], arity)
    root, over = climb([trees[n][0] for n in names], arity)
    result = []
    for place, name in enumerate(names):
        subroot, paths = trees[name]
        for (known, ident, own, changed), path in zip(groups[name], paths):
            tampered = known and zlib.crc32(str(ident).encode()) % 3 == 0
            node = changed if tampered else own
            whole = path + over[place]
            for at, others in whole:
                node = sha("".join(others[:at] + [node] + others[at:]))
            proof = sha("".join("".join(others) for _, others in whole))
            result.append((ident if known else None, own, subroot, root, proof, node, node == root))
    return sorted(result, key=repr)


@pytest.mark.parametrize("arity", [2, 3, 8])
def test_manifest_of_awkward_rows(spark, arity):
    docs = cases.awkward(spark)
    many = spark.range(150).select(
        (F.col("id") + 1000).alias("doc_id"), F.concat(F.lit("Text "), F.col("id") % 140).alias("text"), F.element_at(F.array(F.lit("en"), F.lit("ü"), F.lit("z")), (F.col("id") % 3 + 1).cast("int")).alias("lang"),
        F.lit("s").alias("source"), F.lit(5).cast("long").alias("n_chars"), *[F.lit("t").alias(c) for c in docs.columns[5:]])
    docs = docs.union(many).union(many.limit(1).withColumn("lang", F.lit("one")))
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    made = merkle.verify(docs, tampered, {"text": lowered}, ["doc_id", "source", "lang", "n_chars", "text"], "lang", ["doc_id"], arity)
    got = [(r["row"].doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in made.collect()]
    assert sorted(got, key=repr) == brute_manifest(docs.collect(), arity)
    assert {True, False} == {r[-1] for r in got}


def test_manifest_of_one_row_and_of_none(spark):
    for docs in (cases.empty(spark), cases.empty(spark).union(cases.awkward(spark).filter("doc_id = 3"))):
        made = merkle.verify(docs, F.lit(None).cast("boolean"), {}, ["doc_id", "text"], "lang", ["doc_id"]).collect()
        assert [(r.leaf == r.subroot == r.root == r.folded_root, r.proof_sha256, r.verified) for r in made] == [(True, sha(""), True)] * docs.count()


def test_numbers_over_many_ranges(spark):
    rows = spark.range(1000).select((F.col("id") * 37 % 1000).alias("v"), F.when(F.col("id") % 10 > 0, F.lit("a")).alias("by"))
    numbered, most = merkle.numbered(rows, "by", ["v"], range_rows=90)
    found = {}
    for r in numbered.collect():
        found.setdefault((r["by"], r.n), []).append((r.idx, r.v))
    assert most == 900 and sorted(found, key=repr) == [("a", 900), (None, 100)]
    for (_, n), places in found.items():
        assert [i for i, _ in sorted(places)] == list(range(n)) and [v for _, v in sorted(places)] == sorted(v for _, v in places)
