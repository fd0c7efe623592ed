"""Near copies by several SimHashes: the tries find what brute force over all pairs finds."""

import math

import numpy as np
import pytest

import corpus_pipeline
from cases import alike, brute_set
from medalytics.llm import shingles, simhash
from test_shingles import FOLDER, edited_copies


def test_near_copies_come_from_the_tries(spark, monkeypatch):
    calls, real = [], simhash.similar_candidates
    monkeypatch.setattr(simhash, "similar_candidates", lambda *a: calls.append(1) or real(*a))
    monkeypatch.setattr(shingles, "candidates", None)
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(base), " ".join(base[:70] + ["x"] + base[71:]), " ".join(reversed(base))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_copies(spark, docs, FOLDER).collect()) == [0, 2] and calls


@pytest.mark.parametrize("most", [1 << 18, 100, 8])
def test_similar_sets_meet_in_whole_tries_subtrees_and_parts(spark, most):
    base = [f"w{i}" for i in range(100)]
    texts = [" ".join(base[:at] + [f"x{at}"] + base[at + 1 :]) for at in range(100)] + edited_copies()[:140]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = simhash.wide_fingerprints(docs, "doc_id", "text", 5, 0.8).cache()
    node = {r.id: r.fp for r in rows.collect()}
    found = {r.fp: r.component for r in simhash.similar_candidates(rows, 0.8, most).collect()}
    sets = [brute_set(t) for t in texts]
    near = [(i, j) for i in range(len(texts)) for j in range(i) if node[i] != node[j] and alike(sets[i], sets[j])]
    assert len(near) > 4000 and all(found[node[i]] == found[node[j]] for i, j in near)
    rows.unpersist()


def test_bits_differ_as_often_as_the_angle_says():
    draw, flips = np.random.default_rng(3), np.random.default_rng(4).integers(0, 1 << 64, 83, np.uint64)
    for shared, own, most in ((8, 1, 0.01), (80, 10, 0.005), (800, 100, 0.005)):
        new = draw.integers(0, 1 << 64, (300, shared + 2 * own), np.uint64)
        differ = [(simhash.wide_bits(h[: shared + own], flips) != simhash.wide_bits(np.r_[h[:shared], h[shared + own :]], flips)).mean() for h in new]
        assert abs(np.mean(differ) - math.acos(2 * 0.8 / 1.8) / math.pi) < most


@pytest.mark.parametrize("crowd", [1 << 22, 500])
def test_links_of_a_trie_by_all_pairs(crowd):
    draw = np.random.default_rng(6)
    middle = draw.integers(0, 2, 276)
    bits = np.r_[middle ^ (draw.random((500, 276)) < 0.1), draw.integers(0, 2, (500, 276))]
    top, check = (bits[:, :6] @ (1 << np.arange(19, 13, -1))).astype(np.int32), np.packbits(bits[:, 20:].astype(bool), axis=1).view(np.uint64)
    n = draw.integers(300, 500, 1000)
    for limit in (60, 77, 105):
        near = (np.bitwise_count(top[:, None] ^ top) <= 2) & (np.bitwise_count(check[:, None] ^ check).sum(2) <= limit)
        near &= np.minimum(n[:, None], n) >= 0.8 * np.maximum(n[:, None], n)
        want, got = np.arange(1000), np.arange(1000)
        for root, (a, b) in ((want, np.nonzero(np.triu(near, 1))), (got, simhash.wide_links(top, n, check, 0.8, limit, crowd, 16))):
            x, y = simhash.local_stars(a, b)
            root[x] = y
        assert (want == got).all() and 1 < len(set(want)) < 1000
