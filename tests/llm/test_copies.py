"""SimHash groups, components and long repeats by brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import cases
from medalytics.llm import components, simhash, suffixdedup


def brute_fingerprint(text, n=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    shingles = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    for text in ("", " \n", "one", "one two", "a b c", "A b C d a b c", "é É x\x0by z " * 40, "w " * 70000):
        assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)


@pytest.mark.parametrize("same", [True, False])
def test_trie_join(same):
    draw = np.random.default_rng(1)
    base = draw.integers(0, 1 << 64, 900, np.uint64)
    flips = [int(x) ^ 1 << int(draw.integers(64)) ^ 1 << int(draw.integers(64)) for x in base[:300]]
    every = np.unique(np.r_[base, np.array(flips, np.uint64), np.arange(40, dtype=np.uint64)])
    a, b = (every, every) if same else (every[::2].copy(), every[1::2].copy())
    left, right = simhash.trie_join(a, b, same, 0, 0, 2)
    near = np.bitwise_count(a[:, None] ^ b[None, :]) <= 2
    i, j = np.nonzero(np.triu(near, 1) if same else near)
    assert sorted(zip(left.tolist(), right.tolist())) == sorted(zip(a[i].tolist(), b[j].tolist()))


@pytest.mark.parametrize("per_subtree", [4096, 30])
def test_links_over_many_subtrees(spark, per_subtree):
    random.seed(3)
    base = [random.getrandbits(64) for _ in range(150)] + [random.getrandbits(56) for _ in range(150)]  # one prefix is hot
    values = sorted({x ^ 1 << random.randrange(64) for x in base for _ in range(2)} | set(base))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    edges = simhash.near_links(spark.createDataFrame([(v,) for v in signed], "fp long"), 2, per_subtree)
    parts = {r.node: r.component for r in components.components(edges).collect()}
    want = cases.groups(signed, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 2)
    assert {v: parts.get(v, v) for v in signed} == want


def test_components_of_chains_stars_and_noise(spark):
    random.seed(2)
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(random.randrange(300, 400), random.randrange(300, 400)) for _ in range(60)]
    edges += [(5, 5), (None, 3), edges[0]]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    pairs = {(a, b) for a, b in edges if a is not None}
    ids = sorted({x for p in pairs for x in p})
    assert {i: got.get(i, i) for i in ids} == cases.groups(ids, lambda a, b: (a, b) in pairs or (b, a) in pairs)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_groups_of_awkward_documents(spark):
    docs = cases.awkward(spark)
    rows = docs.collect()
    prints = [brute_fingerprint(r.text) for r in rows]
    part = cases.groups(range(len(rows)), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    least = {}
    for k, r in enumerate(rows):
        if r.doc_id is not None:
            least[part[k]] = min(least.get(part[k], r.doc_id), r.doc_id)
    want = sorted([(r.doc_id, format(prints[k], "016x"), least.get(part[k])) for k, r in enumerate(rows)], key=repr)
    found = simhash.near_groups(docs).select("id", simhash.hex16(F.col("fp")), "component_id")
    assert sorted(map(tuple, found.collect()), key=repr) == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(least.values()))
    assert simhash.near_groups(cases.empty(spark)).count() == 0 and simhash.keep_one(cases.empty(spark)).count() == 0


def test_suffix_arrays():
    draw = np.random.default_rng(3)
    for _ in range(60):
        n, depth = int(draw.integers(1, 250)), int(draw.integers(1, 40))
        text = draw.integers(97, 97 + int(draw.integers(1, 4)), n).astype(np.uint8)
        text[draw.integers(0, n, 3)] = suffixdedup.SEPARATOR
        order, data = suffixdedup.suffix_array(text, depth), text.tobytes()
        assert sorted(order.tolist()) == list(range(n))
        keys = [data[i : i + depth] for i in order]
        assert keys == sorted(keys)
        for k, shared in enumerate(suffixdedup.common_prefixes(text, order, depth)):
            i, j = order[k], order[k + 1]
            end = min(n - max(i, j), depth)
            same = next((c for c in range(end) if data[i + c] != data[j + c]), end)
            assert shared == same or same == n - max(i, j)


def brute_repeats(rows, length):
    seen = {}
    for _, t in rows:
        for p in range(len(t) - length + 1):
            seen[t[p : p + length]] = seen.get(t[p : p + length], 0) + 1
    out = []
    for i, t in rows:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = True
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")))
    return sorted(out, key=repr)


@pytest.mark.parametrize("max_kinds", [512, 2, 1])
def test_repeats(spark, max_kinds):
    """Few kinds allowed per gram force the narrower bands, down to single starts."""
    random.seed(1)
    base = "".join(random.choice("ab c") for _ in range(400))
    texts = []
    for _ in range(50):
        s = "".join(random.choice("abé\n") for _ in range(random.randint(0, 150)))
        p = random.randint(0, 350)
        texts.append(s + base[p : p + random.randint(0, 60)] + s[::-1] + "a" * random.randint(0, 50))
    texts += ["", None, texts[3], texts[3]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = suffixdedup.report(suffixdedup.remove_repeats(docs, length=20, gram=7, max_kinds=max_kinds))
    assert sorted(map(tuple, got.collect()), key=repr) == brute_repeats([(i, (t or "").encode()) for i, t in enumerate(texts)], 20)


def test_a_passage_in_very_many_contexts(spark):
    random.seed(9)
    word = lambda n: "".join(random.choice("abcdefgh ") for _ in range(n))
    passage = word(45)
    texts = [word(60) + passage + word(60) for _ in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = suffixdedup.report(suffixdedup.remove_repeats(docs, length=40, gram=13, max_kinds=8))
    assert sorted(map(tuple, got.collect()), key=repr) == brute_repeats([(i, t.encode()) for i, t in enumerate(texts)], 40)


def test_passages_of_over_50_words(spark):
    """A passage that several documents hold goes from 400 bytes on, whatever its words; clean documents stay whole."""
    random.seed(6)
    words = lambda n: " ".join("".join(random.choice("abcdefgh") for _ in range(4)) for _ in range(n))
    short = words(80)
    long = words(80) + "."
    assert (len(short), len(long)) == (399, 400)
    texts = [f"{words(60)} {chr(65 + i)}{p}{chr(65 + i)} {words(60)}" for i, p in enumerate([long] * 5 + [short] * 5 + ["é"] * 5)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_text) for r in suffixdedup.report(suffixdedup.remove_repeats(docs)).collect())
    assert got == [(i, len(t.encode()), 400 * (i < 5), int(i < 5), t.replace(long, "")) for i, t in enumerate(texts)]


def test_a_text_longer_than_a_block(spark, monkeypatch):
    random.seed(4)
    anchors = suffixdedup.Anchors(40, 13, block=300)
    data = np.frombuffer("".join(random.choice("abcd") for _ in range(2000)).encode(), np.uint8)
    text, lo, n, gram, at = anchors.cut(data, np.array([0, 1500]), np.array([1500, 2000]))
    starts = sorted((t, s) for t, a, k in zip(text.tolist(), lo.tolist(), n.tolist()) for s in range(a, a + k))
    assert starts == [(0, s) for s in range(1461)] + [(1, s) for s in range(461)]
    assert ((at >= lo + n - 1) & (at <= lo + 40 - 13)).all()


def test_repeats_of_awkward_documents(spark):
    docs = cases.awkward(spark)
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    got = suffixdedup.report(suffixdedup.remove_repeats(docs))
    assert sorted(map(tuple, got.collect()), key=repr) == brute_repeats(rows, 400)
    assert suffixdedup.remove_repeats(cases.empty(spark)).count() == 0
