"""Guess costs against an independent dynamic program, values without a break, and learned words."""

import math
import random
import re
import time

import pytest

import cases
from medalytics.llm import secretscan


def plain_cost(value, words):
    """All segmentations from the left: every word, date, repeat and walk that begins at a place, to each of its ends."""
    n, low = len(value), value.lower()
    date = re.compile(
        r"(?:19|20)\d\d(?:([-/.]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01]))?|(?:0[1-9]|[12]\d|3[01])([-/.]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d"
    )

    def char(c):
        return math.log2(10 if c.isdigit() else 26 if c.isascii() and c.isalpha() else 33 if c.isascii() else 1000)

    cost = [0.0] + [math.inf] * n
    for i in range(n):
        ends = {i + 1: char(value[i])}

        def offer(end, bits):
            ends[end] = min(ends.get(end, math.inf), bits)

        for j in range(i + 3, n + 1):
            if low[i:j] in words:
                offer(j, 2 + math.log2(words.index(low[i:j]) + 1) + (low[i:j] != value[i:j]))
            if all(low[k + 1] in secretscan.STEPS.get(low[k], ()) for k in range(i, j - 1)):
                offer(j, 1 + math.log2(40) + j - i - 1)
            for unit in range(1, (j - i) // 2 + 1):
                if (j - i) % unit == 0 and value[i:j] == value[i : i + unit] * ((j - i) // unit):
                    offer(j, 1 + sum(map(char, value[i : i + unit])) + math.log2((j - i) // unit))
        m = date.match(value, i)
        if m:
            offer(m.end(), 1 + (math.log2(365 * 120) if m.end() - i > 4 else math.log2(120)))
        for end, bits in ends.items():
            cost[end] = min(cost[end], cost[i] + bits)
    return cost[n]


@pytest.mark.parametrize("seed", range(4))
def test_costs_equal_the_plain_program(seed):
    rng = random.Random(seed)
    words = ["pass", "word", "abc", "love", "admin"]
    parts = [*words, "Pass", "LOVE", "qwe", "asdf", "1987", "2001-05-17", "31122020", "aaaa", "abab", "xyzxyz", "a", "Z", "7", "#", "é", "1234", "longerunit"]
    for _ in range(150):
        value = "".join(rng.choice(parts) * rng.choice([1, 1, 1, 2, 3]) for _ in range(rng.randint(0, 7)))[:48]
        assert secretscan.guess_bits(value, secretscan.Words(words), 1e9) == pytest.approx(plain_cost(value, words)), value
        assert secretscan.guess_bits(value, secretscan.Words(words), 30) == pytest.approx(min(30, plain_cost(value, words)))


@pytest.mark.parametrize("value, low, high", [("a1" * 150, 15, 18), ("abcde" * 30, 25, 31), ("qwertyuiop" * 12, 40, 56), ("xK#9" * 5000, 20, 35), ("a" * 10**6, 20, 27)])
def test_long_repeats_are_one_segment(value, low, high):
    assert low < secretscan.guess_bits(value) < high


def test_walks_of_any_length():
    walk = "qwertyuiop" + "oiuytrewq" * 30
    assert secretscan.guess_bits(walk, enough=1000) < 1 + math.log2(40) + len(walk)


@pytest.mark.parametrize("text", ["token=" * 170_000, "password=a1a1" + "a1" * 500_000, "login=" + "pwd:1 " * 200_000, "secret:" * 150_000 + " end"])
def test_a_megabyte_without_a_break_takes_linear_time(text):
    started = time.process_time()
    spans = secretscan.scan_text(text.encode())
    assert time.process_time() - started < 4
    assert all(text[a:b] for _, a, b, _ in spans)


def test_nested_contexts_of_a_cheap_run_are_all_refused():
    text = "pwd=1" * 3000 + " " + "auth:aa" * 3000
    assert [s for s in secretscan.scan_text(text.encode(), 60.0) if s[0] == "guess"] == []


def test_a_value_of_eight_characters_is_looked_at_and_one_of_seven_is_not():
    assert [s[0] for s in secretscan.scan_text(b"pwd: x#9Qz!7%", 30.0)] == ["guess"]
    assert secretscan.scan_text(b"pwd: x#9Qz!7", 30.0) == []


def test_words_are_learned_from_the_table(spark):
    texts = ["zorble wibbly zorble", "Zorble WIBBLY quux1 ab", None, "", "zorble " * 3]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    words = secretscan.learned_words(docs, max_words=2)
    after = len(secretscan.SEED_WORDS.rank)
    assert words.rank["zorble"] == after + 1 and words.rank["wibbly"] == after + 2 and "quux" not in words.rank
    text = b"login: zorblewibbly7"
    assert [s[0] for s in secretscan.scan_text(text)] == ["guess"] and secretscan.scan_text(text, 40.0, words) == []
    assert secretscan.learned_words(cases.empty(spark)).rank == secretscan.SEED_WORDS.rank


def test_awkward_documents_by_value(spark):
    docs = cases.awkward(spark)
    found = [(r.id, [tuple(s) for s in r.spans]) for r in secretscan.find_secrets(docs).collect()]
    want = [(r.doc_id, secretscan.scan_text((r.text or "").encode())) for r in docs.collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, want))
    extra = spark.createDataFrame([(1, "the bearer aB3dE6gH9jK2mN5pQ8 was", "x")], "doc_id long, text string, spans string")
    assert [(s.kind, s.start, s.end) for s in secretscan.find_secrets(extra).first().spans] == [("guess", 11, 29)]
