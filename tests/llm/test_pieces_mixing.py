"""Sampled pieces and mixed sources by brute force."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import cases
from medalytics.llm import catalog, mixing, pieces


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.vocabulary(catalog.VOCABULARY)


@pytest.fixture(scope="module")
def sampler(vocabulary):
    return pieces.Sampler(vocabulary)


def one(sampler, text, seed=1, first=0):
    return sampler.encode([text], np.array([seed]), np.array([first]))[0]


def test_round_trip(sampler):
    random.seed(1)
    texts = [b"", b" ", b"\n", b" a", b"a ", b"  a  b \n c\n\n d ", "▁ näïve ▁▁ 漢字 \x00\x7f 😀".encode(), b"z" * 5000]
    texts += ["".join(random.choice("ab c\n é漢▁") for _ in range(random.randint(0, 80))).encode() for _ in range(200)]
    ids, counts, _ = sampler.encode(texts, np.arange(len(texts)), np.zeros(len(texts), np.int64))
    for text, part in zip(texts, np.split(ids, np.cumsum(counts)[:-1])):
        assert sampler.decode(part) == text


def test_a_row_does_not_depend_on_its_block(vocabulary):
    sampler = pieces.Sampler(vocabulary, 0.25)
    texts = [b"the weather in the north is cold", b"another sentence about the weather", b"the the the"]
    ids, counts, _ = sampler.encode(texts, np.array([7, 8, 9]), np.zeros(3, np.int64))
    parts = np.split(ids, np.cumsum(counts)[:-1])
    assert all((one(sampler, t, s) == p).all() for t, s, p in zip(texts, (7, 8, 9), parts))
    assert any((one(sampler, texts[0], s).tolist() != parts[0].tolist()) for s in range(20))


@pytest.mark.parametrize("alpha", [1.0, 0.25])
def test_shares_of_all_segmentations(vocabulary, alpha):
    """Sampled frequencies against the exact shares of all segmentations of a word."""
    sampler = pieces.Sampler(vocabulary, alpha)
    word = b" there"
    weight = {}
    for i, p in enumerate(vocabulary.pieces):
        if p and p in word:
            weight.setdefault(p, (i, alpha * vocabulary.log_p[i]))
    every = {}

    def walk(at, ids, total):
        if at == len(word):
            every[tuple(ids)] = every.get(tuple(ids), 0) + math.exp(total)
            return
        for p, (i, w) in weight.items():
            if word.startswith(p, at):
                walk(at + len(p), [*ids, i], total + w)

    walk(0, [], 0.0)
    whole = sum(every.values())
    n = 20000
    seen = Counter()
    ids, counts, _ = sampler.encode([word] * n, np.arange(n), np.zeros(n, np.int64))
    for part in np.split(ids, np.cumsum(counts)[:-1]):
        seen[tuple(part.tolist())] += 1
    for ids, share in sorted(every.items(), key=lambda x: -x[1])[:8]:
        p = share / whole
        assert abs(seen[ids] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-3


def test_long_texts_are_cut_between_units(sampler):
    random.seed(3)
    text = "".join(random.choice(["word ", "other\n", "  ", "x"]) for _ in range(500)).encode()
    ids, first = [], 0
    for part in pieces._parts(text, 64):
        got, _, units = sampler.encode([part], np.array([3]), np.array([first]))
        ids += got.tolist()
        first += int(units[0])
    assert ids == one(sampler, text, 3).tolist()


def test_awkward_documents(spark, vocabulary):
    docs = cases.awkward(spark)
    rows = pieces.sampled(docs, vocabulary).collect()
    assert all(r.lossless and r.n_pieces == len(r.ids) for r in rows)
    assert sorted(r.n_bytes for r in rows) == sorted(len((r.text or "").encode()) for r in docs.collect())
    again = pieces.sampled(docs.repartition(5), vocabulary).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert pieces.sampled(cases.empty(spark), vocabulary).count() == 0


def sourced(spark, n=600):
    random.seed(6)
    rows = [(i, " ".join(["w"] * random.randint(0, 30)), random.choice(["big"] * 12 + ["mid"] * 4 + ["small", None])) for i in range(n)]
    rows += [(9000, "", "hollow"), (9001, None, "hollow"), rows[0], rows[0]]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def brute_mix(docs, budget, ratio, repeats, seed=17):
    """The exponent by halving, then whole rows in the order of their places."""
    rows = docs.select("doc_id", "text", "source", mixing.order_key(F.col("doc_id"), F.col("text"), seed).alias("u")).collect()
    tokens, by = Counter(), defaultdict(list)
    for r in rows:
        n = len((r.text or "").split())
        tokens[r.source] += n
        by[r.source].append((r.u, n, r.doc_id))
    whole = sum(tokens.values())
    budget = whole if budget is None else budget
    p = {s: n / whole for s, n in tokens.items() if n}

    def weights(t):
        z = sum(v**t for v in p.values())
        return {s: v**t / z for s, v in p.items()}

    entropy = lambda t: -sum(w * math.log(w) for w in weights(t).values())
    most = lambda t: max(w * budget / tokens[s] for s, w in weights(t).items())
    low, high = 0.0, 1.0
    if entropy(1.0) >= ratio * math.log(len(p)):
        low = 1.0
    else:
        for _ in range(30):
            t = (low + high) / 2
            low, high = (t, high) if entropy(t) >= ratio * math.log(len(p)) else (low, t)
    t = low
    if most(t) > repeats:
        high = 1.0
        for _ in range(30):
            m = (t + high) / 2
            t, high = (m, high) if most(m) > repeats else (t, m)
        t = high
    copies = Counter()
    for s, w in weights(t).items():
        quota = math.floor(round(w * budget, 6))
        epochs, rest = divmod(quota, tokens[s])
        places = defaultdict(list)
        for u, n, i in by[s]:
            copies[i] += epochs
            places[u].append((n, i))
        for u in sorted(places):
            rest -= sum(n for n, _ in places[u])
            if rest < 0:
                break
            for _, i in places[u]:
                copies[i] += 1
    for s, n in tokens.items():
        if not n:
            for _, _, i in by[s]:
                copies[i] += 1
    return {i: n for i, n in copies.items() if n}, weights(t)


@pytest.mark.parametrize("budget,ratio,repeats", [(None, 0.95, 4.0), (None, 0.5, 4.0), (4000, 0.99, 9.0), (20000, 0.999, 2.5), (None, 1.0, 1.2)])
def test_mix(spark, budget, ratio, repeats):
    docs = sourced(spark)
    got = mixing.mix(docs, budget=budget, entropy_ratio=ratio, max_repeats=repeats)
    rows = got.select("row.doc_id", "n_tokens", "epoch", "block", "place").collect()
    want, _ = brute_mix(docs, budget, ratio, repeats)
    assert Counter(r.doc_id for r in rows) == Counter(want)
    assert sum(r.n_tokens for r in rows) <= (budget or sum(len((r.text or "").split()) for r in docs.collect()))
    assert all(0 <= r.block < 4096 and r.place >> 48 == r.block for r in rows)


def test_mix_of_awkward_documents(spark):
    docs = cases.awkward(spark)
    got = mixing.mix(docs)
    assert got.select("row.*").columns == docs.columns
    want, _ = brute_mix(docs, None, 0.95, 4.0)
    assert Counter(r.doc_id for r in got.select("row.doc_id").collect()) == Counter(want)
    assert mixing.mix(cases.empty(spark)).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(docs, budget=10**9)
