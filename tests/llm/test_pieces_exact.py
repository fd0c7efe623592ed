"""Units and pieces are told apart by their bytes: strings that have one polynomial hash modulo 2^64."""

import numpy as np
import pytest

from medalytics.llm import catalog, pieces


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.vocabulary(catalog.VOCABULARY)


def thue_morse(n):
    word = bytearray(b"a")
    while len(word) < n:
        word += bytes(97 + 98 - c for c in word)
    return bytes(word), bytes(97 + 98 - c for c in word)


@pytest.mark.parametrize("size", [512, 1024, 2048, 4096])
def test_units_of_one_hash(spark, vocabulary, size):
    one, two = thue_morse(size)
    sampler = pieces.Sampler(vocabulary)
    data = np.frombuffer(one + two, np.uint8)
    sums, _ = sampler._sums(data)
    begin, end = np.array([0, size]), np.array([size, 2 * size])
    hashed = sampler._hash(sums, begin, end)
    assert hashed[0] == hashed[1]  # so the test is one
    kinds, of = sampler._kinds(data, hashed, begin, end)
    assert of.tolist() == [0, 1] and kinds.tolist() == [0, 1]
    docs = spark.createDataFrame([(1, one.decode()), (2, two.decode()), (3, one.decode()), (4, two.decode() + " " + one.decode())], "doc_id long, text string").coalesce(1)
    assert [r.lossless for r in pieces.sampled(docs, vocabulary).collect()] == [True] * 4


def test_kinds_are_the_different_units():
    draw = np.random.default_rng(3)
    units = [draw.integers(97, 99, int(draw.integers(1, 5))).astype(np.uint8) for _ in range(300)]
    size = np.array([len(u) for u in units])
    end = np.cumsum(size)
    for hashed in (np.zeros(300, np.uint64), (end - size).astype(np.uint64) % 7, np.arange(300).astype(np.uint64) // 2):  # hashes that tell nothing
        one, of = pieces.Sampler._kinds(np.concatenate(units), hashed, end - size, end)
        assert all(units[one[k]].tobytes() == u.tobytes() for u, k in zip(units, of))
        assert not (hashed == 0).all() or len(one) == len({u.tobytes() for u in units})


def test_short_strings_have_keys_of_their_own():
    strings = [bytes(x) for x in {tuple(s) for n in range(1, 9) for s in np.random.default_rng(n).integers(0, 3, (200, n)).tolist()}]
    keys = set()
    for s in strings:
        keys.add((len(s), int(pieces._short_keys(pieces._numbers(np.frombuffer(s, np.uint8))[:1], len(s))[0])))
    assert len(keys) == len(strings)


def test_pieces_found_are_the_bytes_of_the_text(vocabulary):
    sampler = pieces.Sampler(vocabulary)
    text = "  international characteristics 12345 ▁▁ überraschungen ".encode()
    data = np.frombuffer(text, np.uint8)
    first, nodes, head, begin, piece, _ = sampler._lattice(data, np.array([len(data)]))
    end = np.repeat(nodes, np.diff(np.r_[head, len(piece)]))
    found = sorted((int(a), int(b), int(p)) for a, b, p in zip(begin, end, piece))
    fits = [(i, p) for i, p in enumerate(vocabulary.pieces) if p and b"\n" not in p and b" " not in p.lstrip(b" ")]
    want = [(a, a + len(p), i) for i, p in fits for a in range(len(text)) if text.startswith(p, a)]
    assert found == sorted(want + [(a, a + 1, int(vocabulary.fallback[b])) for a, b in enumerate(text)])
