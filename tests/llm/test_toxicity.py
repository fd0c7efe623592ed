"""Toxicity: the risk and its slopes, held-out accuracy on planted words, and awkward rows."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import cases
from medalytics.llm import toxicity

WORDS = ["gloopish", "vexnar", "drubble", "skornic"]


@pytest.fixture(scope="module")
def planted(spark):
    random.seed(3)
    syllables = "ba ce di fo gu ha li mo nu pe ra so ti vu".split()

    def word():
        return "".join(random.choice(syllables) for _ in range(random.randint(1, 4)))

    rows, marks = [], []
    for i in range(3000):
        words = [word() for _ in range(random.randint(10, 200))]
        toxic = i % 8 == 0
        if toxic:
            for _ in range(1 + len(words) // 50):
                words.insert(random.randrange(len(words)), random.choice(WORDS))
        rows.append((i, " ".join(words), "en", "s", 1, *["x"] * 6))
        if i % 2 == 0:
            marks.append((i, int(toxic)))
    return spark.createDataFrame(rows, cases.SCHEMA), spark.createDataFrame(marks, "doc_id long, toxic int")


def held_out(ident):
    return zlib.crc32(str(ident).encode()) % 5 == 0


def test_held_out_rows_are_told_apart(spark, planted):
    docs, marks = planted
    found = {r["row"].doc_id: r.score for r in toxicity.score(docs, toxicity.learn(docs, marks), keep=["doc_id"]).collect()}
    assert len(found) == 3000 and all(0 <= s <= 1 for s in found.values())
    some = [i for i in found if held_out(i)]
    assert np.mean([found[i] >= 0.5 for i in some if i % 8 == 0]) > 0.9
    assert np.mean([found[i] < 0.5 for i in some if i % 8]) > 0.99


def test_held_out_labels_are_not_read(spark, planted):
    docs, marks = planted
    other = marks.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = toxicity.learn(docs, marks), toxicity.learn(docs, other)
    assert (one.weight == two.weight).all() and one.bias == two.bias


def test_a_long_text_is_read_to_its_end(spark, planted):
    docs, marks = planted
    model = toxicity.learn(docs, marks)
    clean = ("la mo nu " * 200000).encode()
    low, high = toxicity.scores([clean, clean + b"gloopish vexnar"], model)
    assert low < 0.5 < high


def test_slopes_go_down_the_risk():
    draw = np.random.default_rng(1)
    p, u = draw.normal(size=40), draw.normal(size=90) + 2
    for shift in (0.0, -6.0):  # the second has a negative part below zero
        here = u + shift
        parts = toxicity.risk(p, here, 0.4)
        down = toxicity.slopes(p, here, 0.4)
        for which, at in ((0, 3), (1, 7)):
            moved = [p.copy(), here.copy()]
            moved[which][at] += 1e-6
            after = toxicity.risk(*moved, 0.4)
            change = sum(after) - sum(parts) if parts[1] >= 0 else parts[1] - after[1]
            assert abs(change / 1e-6 - down[which][at]) < 1e-4
    assert toxicity.risk(p, u - 6.0, 0.4)[1] < 0


def test_grams_are_those_of_each_text_alone():
    texts = [b"one two", None, b"", b"two one", b"one two three", b"a" * 50]
    of, bucket = toxicity.grams(texts)
    for i, text in enumerate(texts):
        alone = toxicity.grams([text])[1]
        assert sorted(bucket[of == i].tolist()) == sorted(set(alone.tolist()))
    assert not len(toxicity.grams([None])[0]) and len(toxicity.grams([b"a" * 50])[0]) == 5


def test_awkward_rows_and_nothing_to_learn(spark):
    docs = cases.awkward(spark)
    marks = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(12)] + [(3, None), (None, 1), (3, 0)], "doc_id long, toxic int")
    for made in (toxicity.learn(docs, marks), toxicity.learn(docs, marks.limit(0)), toxicity.learn(cases.empty(spark), marks)):
        found = toxicity.score(docs, made).collect()
        assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
        assert toxicity.score(cases.empty(spark), made).count() == 0
        if made is None:
            assert {r.score for r in found} == {0.0}
        else:
            assert len({r.score for r in found if not (r["row"].text or "").strip()}) == 1
