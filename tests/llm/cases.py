"""Documents with every awkward case, and brute-force helpers shared by the tests."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, id string, body string, u string, lines string, gram string"


def awkward(spark):
    """Null in every column, empty and very long texts, ties, repeated rows, extra columns with inner names."""
    random.seed(5)
    long = " ".join("".join(random.choice("abcdefgh") for _ in range(5)) for _ in range(30000))
    texts = [None, "", " \n\t", "one", "The same sentence of some length.\nand a tail", "The same sentence of some length.\nand another", long, long]
    texts += ["THE SAME sentence of some length. \nx", "päßwörd 漢字 ▁   \x00", "a" * 3000, None, "", "12345 !!"]
    rows = [(i, t, ["en", "de", None][i % 3], ["s", None, "t"][i % 3], len(t or ""), "r", "x", "b", "u", "l", "g") for i, t in enumerate(texts)]
    rows += [rows[4], (None, texts[4], "en", "s", 1, *[None] * 6), (None, None, None, None, None, *[None] * 6), (None, texts[4], "en", "s", 1, *[None] * 6)]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def groups(ids, linked):
    """Smallest id reachable from each id."""
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def brute_set(text, n=5):
    """The different shingles of n words, A-Z lower-cased; fewer words are one shingle."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def alike(a, b):
    """Equal, or of Jaccard similarity 0.8 or more."""
    return a == b or bool(a and b) and len(a & b) / len(a | b) >= 0.8
