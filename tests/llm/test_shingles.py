"""Near copies by Jaccard similarity against brute force over all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import cases
import corpus_pipeline
from cases import alike, brute_set
from medalytics.llm import components, shingles, simhash

FOLDER = "/root/testdata/sf0.001"


def edited_copies():
    """Texts of 20 to 400 words, and copies with up to 3 % of the words replaced, so that similarities lie on both sides of 0.8."""
    random.seed(11)
    word = lambda: "".join(random.choice("abcdefghij") for _ in range(5))
    texts = []
    for _ in range(60):
        base = [word() for _ in range(random.randint(20, 400))]
        texts.append(" ".join(base))
        for _ in range(6):
            copy = list(base)
            for at in random.sample(range(len(copy)), max(1, int(len(copy) * random.uniform(0.002, 0.03)))):
                copy[at] = word()
            texts.append(" ".join(copy))
    return texts + ["", None, "one", "ONE", "a b c", "a b c d"]


def test_edited_copies_go(spark):
    texts = edited_copies()
    sets = [brute_set(t) for t in texts]
    part = cases.groups(range(len(texts)), lambda a, b: alike(sets[a], sets[b]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = dict(corpus_pipeline.STAGES)["near-dedup"](spark, docs, FOLDER)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(part.values()))
    assert len(set(part.values())) < simhash.keep_one(docs).count() / 1.5  # the rule of 2 bits leaves most copies


@pytest.mark.parametrize("most_sets", [2048, 40, 2])
def test_large_components_in_parts(spark, most_sets):
    base = [f"w{i}" for i in range(100)]
    texts = [" ".join(base[:at] + [f"x{at}"] + base[at + 1 :]) for at in range(100)] + edited_copies()[:70]  # one hot group
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = shingles.sketches(docs).cache()
    node = {r.id: r.fp for r in rows.collect()}
    links = shingles.similar_links(docs, rows, "doc_id", "text", 5, 0.8, most_sets)
    found = {r.node: r.component for r in components.components(links).collect()}
    sets = [brute_set(t) for t in texts]
    part = cases.groups(range(len(texts)), lambda a, b: alike(sets[a], sets[b]))
    got = [found.get(node[i], node[i]) for i in range(len(texts))]
    assert len(set(zip(got, part.values()))) == len(set(got)) == len(set(part.values()))


def test_similar_by_all_pairs():
    draw = np.random.default_rng(7)
    sets = [np.unique(draw.integers(0, 14, int(draw.integers(1, 30))).astype(np.uint64)) for _ in range(200)]
    a, b = shingles.similar(sets, 0.8)
    every = [frozenset(s.tolist()) for s in sets]
    assert all(alike(every[i], every[j]) for i, j in zip(a, b))
    pairs = {(min(i, j), max(i, j)) for i, j in zip(a.tolist(), b.tolist())}
    assert cases.groups(range(200), lambda i, j: (i, j) in pairs) == cases.groups(range(200), lambda i, j: alike(every[i], every[j]))


def test_bands_agree_as_often_as_sets_do():
    draw = np.random.default_rng(8)
    sets = []
    for _ in range(400):  # 80 shared of 100
        new = draw.integers(0, 1 << 63, 100).astype(np.uint64)
        sets += [np.sort(new[:90]), np.sort(np.r_[new[:80], new[90:]])]
    sets += [draw.integers(0, 1 << 63, shingles.AT_ONCE * 2 + 5).astype(np.uint64)]
    found = shingles.bands(sets)
    equal = (found[0:800:2] == found[1:800:2]).mean()
    assert abs(equal - 0.8**shingles.WIDTH) < 0.02
    assert (found[-1] == shingles.bands(sets[-1:])[0]).all()


def test_awkward_documents_by_similarity(spark):
    docs = cases.awkward(spark)
    rows = docs.collect()
    sets = [brute_set(r.text) for r in rows]
    part = cases.groups(range(len(rows)), lambda a, b: alike(sets[a], sets[b]))
    least = {}
    for k, r in enumerate(rows):
        if r.doc_id is not None:
            least[part[k]] = min(least.get(part[k], r.doc_id), r.doc_id)
    found = simhash.near_groups(docs, words=5, similarity=0.8).select("id", "component_id")
    assert sorted(map(tuple, found.collect()), key=repr) == sorted([(r.doc_id, least.get(part[k])) for k, r in enumerate(rows)], key=repr)
    kept = simhash.keep_one(docs, words=5, similarity=0.8)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(least.values()))
    assert simhash.keep_one(cases.empty(spark), words=5, similarity=0.8).count() == 0
    assert kept.filter(F.col("doc_id").isNull()).count() == 0


def test_a_band_in_several_ranges_is_one_chain(spark):
    """Every set has the same bands, so one band's rows lie in many ranges and the chain must cross them."""
    rows = spark.range(500).select(
        F.col("id").alias("fp"), (F.lit(1000) + F.col("id") % 50).alias("n"), F.array(F.lit(7).cast("long"), F.lit(8).cast("long")).alias("bands")
    )
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = shingles.candidates(rows, 0.8).collect()
        apart = shingles.candidates(rows.withColumn("n", F.when(F.col("fp") < 250, 10).otherwise(1000).cast("long")), 0.8).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert sorted(r.fp for r in found) == list(range(500)) and {r.component for r in found} == {0}
    assert {r.component for r in apart} == {0, 250} and len(apart) == 500
