"""Line dedup and the archive by brute force."""

import base64
import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import cases
from medalytics.llm import linededup, warc

SPACE = " \t\n\x0b\x0c\r"


def brute_lines(rows, min_chars=20, min_docs=3):
    key = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s.strip(SPACE))
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        ids = lambda k: {x for x in holders[k] if x is not None}
        kept = [x for x in lines if not (len(key(x)) >= min_chars and len(ids(key(x))) >= min_docs and i != max(ids(key(x))))]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_lines_of_awkward_documents(spark):
    docs = cases.awkward(spark)
    got = sorted(map(tuple, linededup.report(linededup.dedup_lines(docs)).collect()), key=repr)
    assert got == brute_lines([(r.doc_id, r.text) for r in docs.collect()])
    assert sum(r[2] for r in got) >= 3
    assert linededup.dedup_lines(docs).select("row.*").columns == docs.columns


def test_no_documents_no_lines(spark):
    assert linededup.report(linededup.dedup_lines(cases.empty(spark))).count() == 0


def test_a_line_held_by_many_documents(spark):
    line = "this line is part of every document here"
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit(line + "\n"), F.col("id").cast("string"), F.lit("\n " + line.upper())).alias("text"))
    got = sorted(map(tuple, linededup.report(linededup.dedup_lines(docs)).collect()), key=repr)
    assert got == brute_lines([(r.doc_id, r.text) for r in docs.collect()])


PAGES = [(3, "u3", "<p>é</p>"), (1, "u1", "<p>é</p>"), (2, None, ""), (5, "u5", None), (None, "u0", ""), (7, "a\r\nb", "\r\n\r\nWARC/1.1\r\n"), (1, "u1", "<p>é</p>"), (None, "n", "only null"), (8, "u8", "x" * 200000)]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string")


def test_archive_by_brute_force(spark):
    first = {}
    for i, _, html in PAGES:
        body = (html or "").encode()
        first[body] = min(first.get(body, float("inf")), float("inf") if i is None else i)
    want = []
    for i, _, html in PAGES:
        body = (html or "").encode()
        owner = None if first[body] == float("inf") else first[body]
        response = i == owner
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        want.append((i, len(body), digest, "response" if response else "revisit", None if response else owner))
    archive = warc.write_archive(pages(spark))
    assert sorted(map(tuple, warc.read_back(archive).collect()), key=repr) == sorted(want, key=repr)
    assert archive.payloads.count() == len(first)


def test_records_are_complete(spark):
    for r in warc.records(warc.write_archive(pages(spark))).collect():
        record = bytes(r.record)
        head, block = record.split(b"\r\n\r\n", 1)
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        size = int(fields[b"Content-Length"])
        assert block[size:] == b"\r\n\r\n" and head.startswith(b"WARC/1.1\r\n")
        if fields[b"WARC-Type"] == b"response":
            assert block[:size] == bytes(r.payload)
        else:
            assert size == 0 and b"WARC-Profile" in fields
        assert fields[b"WARC-Payload-Digest"] == b"sha1:" + base64.b32encode(hashlib.sha1(bytes(r.payload)).digest())


def test_empty_archive(spark):
    assert warc.read_back(warc.write_archive(pages(spark, []))).count() == 0


def test_changed_bytes_are_noticed(spark):
    archive = warc.write_archive(pages(spark))
    broken = warc.Archive(archive.headers, archive.payloads.withColumn("payload", F.lit("other").cast("binary")))
    with pytest.raises(Exception, match="does not have its digest"):
        warc.read_back(broken).collect()
