"""Secrets in texts: fixed patterns, and values beside credential words that would be hard to guess."""

import heapq
import math
import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import stage

#: The patterns asked for and the shortest match of each.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run of 24 or more; shorter runs fail and hide nothing
KINDS = ("assign", "access", "hex", "guess")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24

#: Words beside which a value may be a credential, up to the first sign of the value. Only that sign is looked at, so that
#: a value which is refused hides no context within it and unbroken runs are not read again for every context.
CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|auth(?:orization)?|bearer|credentials?|login|secret|token|(?:private|access|api|signing)[_-]?key)"""
    r"""(?=(["']?\x20*(?::=|=>|[:=]|\x20)\x20*["']?)[!-&(-~])""",
    re.I | re.A,
)
RUN = re.compile("[!-&(-~]+")
MIN_GUESS = 8
HINTS = (b"pass", b"pwd", b"auth", b"bearer", b"credential", b"login", b"secret", b"token", b"key")

#: Words that people put into passwords, the most common first; the words of the texts follow them, see `learned_words`.
WORDS = (
    "password qwerty admin welcome letmein monkey dragon master login abc iloveyou sunshine princess football shadow "
    "michael jennifer superman batman trustno hello freedom whatever secret test guest root changeme default pass user "
    "love summer winter spring autumn monday friday january february march april june july august october november "
    "december house apple orange banana cookie pepper ginger charlie george thomas daniel maggie buster soccer hockey "
    "baseball killer hunter ranger tiger eagle falcon phoenix silver golden purple yellow computer internet server "
    "database example sample token key demo public private temp hidden access"
).split()
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
IS_HEX = bytes(1 if chr(b) in "0123456789abcdef" else 0 for b in range(256))
DATE = re.compile(r"(?:19|20)\d\d(?:([-/.]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01]))?|(?:0[1-9]|[12]\d|3[01])([-/.]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d")
DATE_BITS = math.log2(365 * 120)


def _neighbours():
    steps = {}
    for row in ROWS:
        for a, b in zip(row, row[1:]):
            steps.setdefault(a, set()).add(b)
            steps.setdefault(b, set()).add(a)
    for upper, lower in zip(ROWS, ROWS[1:]):
        for i, c in enumerate(lower):
            for d in upper[i : i + 2]:
                steps.setdefault(c, set()).add(d)
                steps.setdefault(d, set()).add(c)
    return steps


STEPS = _neighbours()


def _char_bits(c):
    if c.isdigit():
        return math.log2(10)
    if c.isalpha() and c.isascii():
        return math.log2(26)
    return math.log2(33 if c.isascii() else 1000)


class Words:
    """Ranks of words, and how long the longest is."""

    def __init__(self, words=WORDS):
        self.rank = {}
        for word in words:
            self.rank.setdefault(word, len(self.rank) + 1)
        self.longest = max(map(len, self.rank), default=0)


SEED_WORDS = Words()


def common_extension(value: str, a: int, b: int) -> int:
    """How many characters from `a` on equal those from `b` on (a < b), by comparing ever longer pieces."""
    n, size, done = len(value), 16, 0
    while b + done < n:
        size = min(size, n - b - done)
        if value[a + done : a + done + size] == value[b + done : b + done + size]:
            done += size
            size *= 2
        elif size == 1:
            break
        else:
            size //= 2
    return done


def repeats_from(value: str, i: int, longest: int):
    """(unit, end) of the repetitions that begin at `i`: units of up to `longest`, as far as they go on, cut to whole units.

    A unit that is a smaller one several times is not given. Units of eight or more are found where the eight
    characters at `i` come again.
    """
    n, covered = len(value), i
    for unit in range(1, 8):
        if covered < i + 2 * unit <= n and value.startswith(value[i : i + unit], i + unit):
            end = i + unit + common_extension(value, i, i + unit)
            covered = max(covered, end)
            yield unit, end - (end - i) % unit
    head, at = value[i : i + 8], i + 8
    while len(head) == 8 and (at := value.find(head, max(at, (i + covered + 1) // 2), i + longest + 8)) >= 0 and 2 * at - i <= n:
        alike = common_extension(value, i, at)
        if alike >= at - i:
            covered = max(covered, at + alike)
            yield at - i, at + alike - (at + alike - i) % (at - i)
        at += 1


def guess_bits(value: str, words: Words = SEED_WORDS, enough: float = 128.0) -> float:
    """Bits of the cheapest way to guess a value: a segmentation of least cost, or `enough` if it costs that or more.

    Segments are words (the log of the rank, and a bit for capitals), dates, repeats (one unit of any length and
    how often), keyboard walks of three keys or more of any length (a start and a bit per step), and single
    characters by brute force. Each segment that is not brute force costs one bit more. A repeat or walk goes to
    its end, or to one of the places before it from which a word could reach beyond it.

    Places are settled in the order of their cost, so a value without structure is given up after some forty
    characters, whatever its length, and a long one with structure takes few steps.
    """
    n, low = len(value), value.lower()
    if len(low) != n:
        low = value
    back = max(words.longest, 10)  # dates have ten characters at most
    best, heap, settled, walk = {0: 0.0}, [(0.0, 0)], set(), (0, 0)
    while heap:
        here, i = heapq.heappop(heap)
        if here >= enough:
            return enough
        if i == n:
            return here
        if i in settled:
            continue
        settled.add(i)

        def reach(end, bits):
            if here + bits < best.get(end, math.inf):
                best[end] = here + bits
                heapq.heappush(heap, (here + bits, end))

        reach(i + 1, _char_bits(value[i]))
        for end in range(i + 3, min(n, i + words.longest) + 1):
            if low[i:end] in words.rank:
                reach(end, 2 + math.log2(words.rank[low[i:end]]) + (value[i:end] != low[i:end]))
        found = DATE.match(value, i)
        if found:
            reach(found.end(), 1 + (DATE_BITS if found.end() - i > 4 else math.log2(120)))
        for unit, end in repeats_from(value, i, int(enough / 3)):  # a longer unit costs enough by itself
            own = 1 + sum(map(_char_bits, value[i : i + unit]))
            for stop in range(end, max(i + max(3, 2 * unit) - 1, end - back - unit), -unit):
                reach(stop, own + math.log2((stop - i) // unit))
        if not walk[0] <= i < walk[1]:
            end = i + 1
            while end < n and low[end] in STEPS.get(low[end - 1], ()):
                end += 1
            walk = (i, end)
        for end in range(walk[1], max(i + 2, walk[1] - back - 1), -1):
            reach(end, 1 + math.log2(40) + (end - i - 1))
    return 0.0


def base_spans(text: str):
    """(kind, start, end) of the fixed patterns, in code points."""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    return found + [("hex", m.start(), m.end()) for m in HEX.finditer(text)]


def guess_spans(text: str, taken, min_bits: float, words: Words = SEED_WORDS):
    """Values beside credential words that cost at least `min_bits` to guess and do not lie within one span of `taken`.

    A value is the unbroken run from the first sign after the word to its end, without closing marks, of MIN_GUESS
    characters or more. One of letters alone is prose, not a credential; digits or other signs must be mixed in. A
    value that reaches beyond a span of `taken` is given whole. Values that end alike are given once, from the
    first context on. Runs are found once per text, and a value that is one refused before less some of its
    repeated units is refused without being read again, so a text without a break takes linear time.
    """
    runs, last, refused = None, 0, {}
    for m in CONTEXT.finditer(text):
        start = m.end(1)
        if runs is None:
            runs = [(r.start(), r.end(), r.start() + len(r[0].rstrip(".,;:!?)]}>\"'"))) for r in RUN.finditer(text)]
        _, end, kept = runs[bisect_right(runs, (start, len(text) + 1, 0)) - 1]
        if end <= last or kept - start < MIN_GUESS or any(a <= start and kept <= b for _, a, b in taken):
            continue
        if any(start % unit == rest and start + 2 * unit <= upto for (unit, rest), upto in refused.items()):
            continue
        value = text[start:kept]
        if any(c.isalpha() for c in value) and not value.isalpha():
            bits = guess_bits(value, words)
            if bits >= min_bits:
                last = end
                yield "guess", start, kept, bits
            elif len(value) > 64:
                unit, upto = max(repeats_from(value, 0, 64), key=lambda r: r[1], default=(1, 0))
                if upto == len(value):
                    refused[unit, start % unit] = kept


def scan_text(data: bytes, min_bits: float = 40.0, words: Words = SEED_WORDS):
    """All spans of a text given in UTF-8 as (kind, start, end, bits), by start, then kind as listed.

    `bits` is the guess cost of what an assignment or a credential context holds, null for the others.
    """
    low = data.translate(LOWER)
    hexes = b"\x01" * MIN_HEX in data.translate(IS_HEX)
    if not hexes and b"AKIA" not in data and not any(h in low for h in HINTS):
        return []
    text = data.decode("utf-8", "replace")
    base = base_spans(text)
    found = [(kind, a, b, guess_bits(ASSIGN.match(text, a)[2], words) if kind == "assign" else None) for kind, a, b in base]
    found += guess_spans(text, base, min_bits, words)
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def learned_words(docs: DataFrame, text_col: str = "text", max_words: int = 20_000) -> Words:
    """The seed words, and after them the most frequent words of all texts (3 to 24 letters a-z, in either case), `max_words` at most.

    Words are counted over all rows by partial aggregates; a count is chosen that no more than `max_words` words
    reach, so those alone come to the driver, and words of one count are taken or left together.
    """
    found = docs.select(F.explode(F.regexp_extract_all(F.lower(text_col), F.lit("(?<![a-z])[a-z]{3,24}(?![a-z])"), F.lit(0))).alias("word"))
    counts = stage(found.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "word-counts")
    # one line per count that occurs, and these are few, as large counts are rare
    steps = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words"))
    upto = steps.withColumn("upto", F.sum("words").over(Window.orderBy(F.col("n").desc())))
    least = upto.filter(F.col("upto") <= max_words).agg(F.min("n")).first()[0]
    most = counts.filter(F.col("n") >= F.lit(least)).collect()
    return Words([*WORDS, *[r["word"] for r in sorted(most, key=lambda r: (-r["n"], r["word"]))]])


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bits: float = 40.0, words: Words = SEED_WORDS) -> DataFrame:
    """(id, spans) per row, spans of (kind, start, end, bits) in code points, end exclusive.

    A null text counts as empty; a null id is carried through. Texts are read whole, however long, in time in
    proportion to their length; other columns are not read. `bits` of 128 stand for that or more. `words` are the
    ranked words of the guess cost, such as those of `learned_words`.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    span = T.StructType().add("kind", "string").add("start", "long").add("end", "long").add("bits", "double")
    schema = rows.select("id").schema.add("spans", T.ArrayType(span))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("bits", pa.float64())]))

    def scan(batches):
        for batch in batches:
            found = [[dict(zip(("kind", "start", "end", "bits"), s)) for s in scan_text(t, min_bits, words)] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, kind)], ["id", "spans"])

    return rows.mapInArrow(scan, schema)


def report(found: DataFrame) -> DataFrame:
    """Per document: the number of matches of each fixed pattern, the digest of their list, and the list of all spans."""

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "guess")
    return found.select(
        F.col("id").alias("doc_id"), *[count(k) for k in KINDS[:3]], F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )
