"""Long byte strings that occur twice: anchored pieces, two-stage suffix sorting, adjacent common prefixes.

Every string of `length` bytes is filed under one of its own grams (the least hash among its grams, the
leftmost of equals), so equal strings are always filed alike. Consecutive starts filed under one place
of one gram form a piece. Equal pieces are counted by digest; different pieces of one gram are sorted as
suffixes, in blocks that hold whole grams. Nothing is sampled: the anchors only decide where strings meet.
"""

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import stage

POSITION_BITS = 24
SEPARATOR = 0xFF  # never occurs in UTF-8
BLOCK = 1 << 20
SORT_BLOCK = 1 << 18


class Anchors:
    """Cuts texts into pieces; holds the powers of the rolling hash up to a block's size."""

    def __init__(self, length: int, gram: int, block: int = BLOCK, seed: int = 7):
        self.length, self.gram, self.block = length, gram, block
        draw = np.random.default_rng(seed)
        self.codes = draw.integers(0, 1 << 64, 256, np.uint64)
        base = int(draw.integers(0, 1 << 64, dtype=np.uint64)) | 1
        inverse = pow(base, -1, 1 << 64)
        n = 2 * block + length
        self.powers = self._powers(base, n)
        self.inverses = self._powers(inverse, n)

    @staticmethod
    def _powers(base, n):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)

    def cut(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Pieces of the texts data[starts:ends] as (text, first start, number of starts, gram hash, place of the gram)."""
        long = ends - starts >= self.length
        which, starts, ends = np.flatnonzero(long), starts[long], ends[long]
        parts, i = [], 0
        while i < len(which):
            j = i + 1
            while j < len(which) and ends[j] - starts[i] <= self.block:
                j += 1
            for at in range(starts[i], ends[j - 1] if j == i + 1 else starts[i] + 1, self.block):
                # a text longer than a block is cut at block starts; pieces of one gram still meet
                stop = min(ends[j - 1], at + self.block + self.length - 1) if j == i + 1 else ends[j - 1]
                if stop - at >= self.length:
                    first = np.maximum(starts[i:j], at) - at
                    text, lo, n, gram, place = self._block(data[at:stop], first, np.minimum(ends[i:j], stop) - at)
                    move = at - starts[i + text]
                    parts.append((which[i + text], lo + move, n, gram, place + move))
            i = j
        return [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 5

    def _block(self, data, starts, ends):
        gram, wide = self.gram, self.length - self.gram + 1
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.codes[data] * self.powers[: len(data)], out=sums[1:])
        hashed = (sums[gram:] - sums[:-gram]) * self.inverses[: len(data) - gram + 1]
        hashed ^= hashed >> np.uint64(32)
        hashed *= np.uint64(0x9E3779B97F4A7C15)
        hashed ^= hashed >> np.uint64(29)
        mask = np.uint64((1 << POSITION_BITS) - 1)
        keys = (hashed & ~mask) | np.arange(len(hashed), dtype=np.uint64)
        padded = np.full(-(-len(keys) // wide) * wide, ~np.uint64(0))
        padded[: len(keys)] = keys
        rows = padded.reshape(-1, wide)
        before = np.minimum.accumulate(rows, axis=1).ravel()
        after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        last = len(keys) - wide + 1
        anchor = (np.minimum(after[:last], before[wide - 1 : wide - 1 + last]) & mask).astype(np.int64)
        inside = np.zeros(len(data) + 1, np.int32)
        inside[starts[ends - starts >= self.length]] += 1
        inside[(ends - self.length + 1)[ends - starts >= self.length]] -= 1
        valid = np.flatnonzero(np.cumsum(inside)[:last])
        at = anchor[valid]
        begins = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (valid[1:] != valid[:-1] + 1)])
        lo = valid[begins]
        counts = np.diff(np.r_[begins, len(valid)])
        return np.searchsorted(starts, lo, "right") - 1, lo, counts, hashed[at[begins]].view(np.int64), at[begins]


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes in the order of their first `depth` bytes (beyond, in any order).

    Stage one sorts only the suffixes that are smaller than their successors. Stage two scans the buckets
    of first bytes upwards: a suffix seen puts the one before it, if that is larger than its successor, at
    the front of its bucket. Each scan step handles a whole bucket.
    """
    n = len(text)
    data = text.tobytes()
    differs = np.flatnonzero(text[:-1] != text[1:])
    following = np.searchsorted(differs, np.arange(n))
    known = following < len(differs)
    smaller = np.zeros(n, bool)
    at = differs[following[known]]
    smaller[known] = text[at] < text[at + 1]

    direct = np.array(sorted(np.flatnonzero(smaller).tolist(), key=lambda i: data[i : i + depth]), np.int64)
    sizes = np.bincount(text, minlength=256)
    begin = np.r_[0, np.cumsum(sizes)]
    direct_sizes = np.bincount(text[direct], minlength=256) if len(direct) else np.zeros(256, np.int64)
    order, used = np.empty(n, np.int64), 0
    for c in np.flatnonzero(direct_sizes):
        order[begin[c + 1] - direct_sizes[c] : begin[c + 1]] = direct[used : used + direct_sizes[c]]
        used += direct_sizes[c]

    front = begin[:-1].copy()
    order[front[text[-1]]] = n - 1  # larger than the empty suffix, its successor
    front[text[-1]] += 1
    for c in np.flatnonzero(sizes):
        seen = begin[c]
        while seen < front[c]:  # runs of one byte
            before = order[seen : front[c]] - 1
            seen = front[c]
            before = before[before >= 0]
            before = before[text[before] == c]
            order[seen : seen + len(before)] = before
            front[c] += len(before)
        before = order[begin[c] : begin[c + 1]] - 1
        before = before[before >= 0]
        byte = text[before]
        before, byte = before[byte > c], byte[byte > c]
        by_byte = np.argsort(byte, kind="stable")
        before, byte = before[by_byte], byte[by_byte]
        added = np.bincount(byte, minlength=256)
        rank = np.arange(len(byte)) - np.repeat(np.r_[0, np.cumsum(added)[:-1]], added)
        order[front[byte] + rank] = before
        front += added
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Bytes, at most `depth`, that each suffix shares with the next one of the order."""
    padded = np.r_[text, np.zeros(depth + 8, np.uint8)]
    words = np.ndarray(len(padded) - 7, "<u8", padded.tobytes(), strides=(1,))
    i, j = order[:-1], order[1:]
    shared = np.zeros(len(i), np.int64)
    active = np.arange(len(i))
    for at in range(0, depth, 8):
        equal = words[i[active] + at] == words[j[active] + at]
        shared[active[equal]] = at + 8
        stopped = active[~equal]
        differ = words[i[stopped] + at] ^ words[j[stopped] + at]
        lowest = differ & (~differ + np.uint64(1))
        shared[stopped] = at + (np.bitwise_count(lowest - np.uint64(1)).astype(np.int64) >> 3)
        active = active[equal]
        if not len(active):
            break
    return np.minimum(shared, depth)


def repeated_starts(pieces: list[bytes], length: int) -> list[np.ndarray]:
    """For each piece the starts of strings of `length` bytes that occur at another start of these pieces."""
    sizes = np.array([len(p) for p in pieces], np.int64)
    text = np.frombuffer(b"".join(p + bytes([SEPARATOR]) for p in pieces), np.uint8)
    begins = np.r_[0, np.cumsum(sizes + 1)[:-1]]
    owner = np.repeat(np.arange(len(pieces)), sizes + 1)
    order = suffix_array(text, length)
    fits = begins[owner[order]] + sizes[owner[order]] - order >= length
    equal = (common_prefixes(text, order, length) >= length) & fits[:-1] & fits[1:]
    hit = np.zeros(len(text), bool)
    hit[order[:-1][equal]] = True
    hit[order[1:][equal]] = True
    return [np.flatnonzero(hit[b : b + n]) for b, n in zip(begins, sizes)]


def _runs(starts):
    breaks = np.flatnonzero(np.diff(starts) != 1)
    return starts[np.r_[0, breaks + 1]], starts[np.r_[breaks, len(starts) - 1]]


def _bytes_of(column):
    """Data and offsets of an Arrow binary column without copying."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), offsets


RANGE = "body binary, lo long, hi long"
PIECE = "body binary, lo long, n long, at long, gram long, digest binary"
BANDS = (64, 16, 4, 1)


def _digest(data, size=16):
    return hashlib.blake2b(data, digest_size=size).digest()


def _bands(rows, length, width):
    """Cut pieces into bands of starts by their distance to the gram, filed under what all strings of a band hold.

    The strings of starts within `width` of each other share all but width - 1 bytes, so equal strings
    meet under the same shared bytes. At width 1 that is the whole string.
    """
    for row in rows:
        first, last = row["at"] - (row["lo"] + row["n"] - 1), row["at"] - row["lo"]
        for band in range(first // width, last // width + 1):
            near, far = max(first, band * width), min(last, band * width + width - 1)
            lo = row["at"] - far
            piece = row["piece"][lo - row["lo"] : row["at"] - near - row["lo"] + length]
            held = row["at"] - band * width - row["lo"]
            core = row["piece"][held : held + max(0, length - width + 1)]
            gram = int.from_bytes(_digest(b"%d:" % band + core, 8), "big", signed=True)
            yield row["body"], lo, far - near + 1, row["at"], gram, _digest(b"%d:" % (far % width) + piece), row["single"], piece


def _rivals(pieces: DataFrame, length: int):
    """Split the pieces of common grams: (kinds, whole ranges, rivals).

    Equal pieces of one gram are repeated whole. `rivals` has one piece of each kind of a gram that
    several different kinds share, and whether it is the only one.
    """
    kinds = pieces.groupBy("gram", "digest").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("body", "lo", "n", "at")).alias("one"))
    kinds = stage(kinds.select("gram", "digest", "copies", "one.*"), "kinds")
    twice = kinds.filter("copies > 1").select("gram", "digest")
    whole = pieces.join(twice, ["gram", "digest"]).select("body", "lo", (F.col("lo") + F.col("n") + length - 1).alias("hi"), *[c for c in pieces.columns if c == "single"])
    several = stage(kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1"), "several")
    rivals = kinds.join(several, "gram").select("gram", "kinds", "digest", "body", "lo", "n", "at", (F.col("copies") == 1).alias("single"))
    return whole, stage(rivals, "rivals")


def repeated_ranges(docs: DataFrame, text_col: str, length: int = 400, gram: int = 128, max_kinds: int = 512) -> DataFrame:
    """(body, lo, hi): byte ranges covered by strings of `length` bytes that start elsewhere too.

    `body` is the MD5 of a text; a range holds for every row of that text. Pieces that occur twice are
    repeated as a whole. Grams with up to `max_kinds` different pieces are suffix-sorted. A more common gram
    (a short line in millions of contexts) would be one huge group: its pieces are cut into ever narrower
    bands of starts, filed under the longer strings that all of a band hold, until few kinds are left of each.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    bodies = docs.select(F.unhex(F.md5(text)).alias("body"), text.alias("text"))
    bodies = bodies.filter(F.octet_length("text") >= length)

    def cut(batches):
        anchors = Anchors(length, gram)
        for batch in batches:
            data, offsets = _bytes_of(batch.column("text"))
            view = memoryview(data)
            which, lo, n, hashed, place = anchors.cut(data, offsets[:-1], offsets[1:])
            for at in range(0, len(which), 1 << 16):
                part = slice(at, at + (1 << 16))
                begins = (offsets[which[part]] + lo[part]).tolist()
                digests = [_digest(view[b : b + k]) for b, k in zip(begins, (n[part] + length - 1).tolist())]
                columns = [batch.column("body").take(pa.array(which[part])), *[pa.array(x[part]) for x in (lo, n, place, hashed)], pa.array(digests, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["body", "lo", "n", "at", "gram", "digest"])

    every = stage(bodies.mapInArrow(cut, PIECE), "pieces")
    common = stage(every.groupBy("gram").count().filter("count > 1").select("gram"), "common-grams")
    whole, rivals = _rivals(stage(every.join(common, "gram"), "common-pieces"), length)
    # one copy of each text: partial aggregates leave at most one for every task before the shuffle
    texts = bodies.groupBy("body").agg(F.first("text").alias("text"))
    piece = F.substr(F.col("text"), (F.col("lo") + 1).cast("int"), (F.col("n") + length - 1).cast("int"))
    rivals = stage(rivals.join(texts, "body").select("gram", "kinds", "body", "lo", "n", "at", "single", piece.alias("piece")), "rival-pieces")

    found = [whole, _sorted_ranges(rivals.filter(F.col("kinds") <= max_kinds), length)]
    for width in BANDS:
        hot = rivals.filter(F.col("kinds") > max_kinds)
        if hot.isEmpty():
            break

        def split(batches, width=width):
            for batch in batches:
                for at in range(0, batch.num_rows, 500):
                    columns = list(zip(*_bands(batch.slice(at, 500).to_pylist(), length, width)))
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, banded)], schema=banded)

        banded = pa.schema(
            [("body", pa.binary()), ("lo", pa.int64()), ("n", pa.int64()), ("at", pa.int64()), ("gram", pa.int64()), ("digest", pa.binary()), ("single", pa.bool_()), ("piece", pa.binary())]
        )
        bands = stage(hot.select("body", "lo", "n", "at", "single", "piece").mapInArrow(split, PIECE + ", single boolean, piece binary"), "bands")
        whole, kept = _rivals(bands.drop("piece"), length)
        found.append(whole.filter("single").drop("single"))
        kept = kept.withColumnRenamed("single", "alone")
        rivals = bands.join(kept.select("gram", "digest", "body", "lo", "kinds", "alone"), ["gram", "digest", "body", "lo"])
        rivals = stage(rivals.select("gram", "kinds", "body", "lo", "n", "at", (F.col("single") & F.col("alone")).alias("single"), "piece"), "rival-pieces")
        found.append(_sorted_ranges(rivals.filter(F.col("kinds") <= max_kinds), length))
    return reduce(DataFrame.union, found)


def _sorted_ranges(rivals: DataFrame, length: int) -> DataFrame:
    """Ranges that suffix sorting finds in the pieces marked `single`, in blocks of whole grams."""

    def ranges(rows):
        hits = repeated_starts([r["piece"] for r in rows], length)
        spans = [(row["body"], row["lo"] + a, row["lo"] + b + length) for row, hit in zip(rows, hits) if row["single"] and len(hit) for a, b in zip(*_runs(hit))]
        body, lo, hi = zip(*spans) if spans else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(body, pa.binary()), pa.array(lo, pa.int64()), pa.array(hi, pa.int64())], ["body", "lo", "hi"])

    def sort(batches):
        rows, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if size >= SORT_BLOCK and row["gram"] != rows[-1]["gram"]:
                    yield ranges(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row["piece"])
        if rows:
            yield ranges(rows)

    rows = rivals.select("gram", "body", "lo", "single", "piece")
    return rows.repartition("gram").sortWithinPartitions("gram").mapInArrow(sort, RANGE)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, **options) -> DataFrame:
    """(id, n_bytes, spans, kept) per row: the maximal removed byte ranges and the bytes that stay.

    A byte goes if a string of `length` bytes over it also starts anywhere else in the texts, whether in
    the same text, overlapping, or in a repeated row. Null and short texts keep all their bytes; a null id
    is carried through. Cuts may fall within a character, so `kept` is binary. Other columns are not read.
    """
    ranges = repeated_ranges(docs, text_col, length, **options)
    gathered = ranges.groupBy("body").agg(F.collect_set(F.struct("lo", "hi")).alias("ranges"))
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("id"), F.unhex(F.md5(text)).alias("body"), text.alias("text"))
    rows = rows.join(gathered, "body", "left").select("id", "text", F.col("ranges.lo").alias("lo"), F.col("ranges.hi").alias("hi"))
    span = T.ArrayType(T.StructType().add("start", "long").add("end", "long"))
    schema = rows.select("id").schema.add("n_bytes", "long").add("spans", span).add("kept", "binary")

    def remove(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = part.column("text").to_pylist()
                spans, kept = [], []
                for text, lo, hi in zip(texts, part.column("lo").to_pylist(), part.column("hi").to_pylist()):
                    spans.append(_merged(lo or [], hi or []))
                    edges = [0, *[x for s in spans[-1] for x in (s["start"], s["end"])], len(text)]
                    kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
                lengths = pa.array(list(map(len, texts)), pa.int64())
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays([part.column("id"), lengths, pa.array(spans, kind), pa.array(kept, pa.binary())], ["id", "n_bytes", "spans", "kept"])

    return rows.mapInArrow(remove, schema)


def _merged(lo, hi):
    spans = []
    for a, b in sorted(zip(lo, hi)):
        if spans and a <= spans[-1]["end"]:
            spans[-1]["end"] = max(b, spans[-1]["end"])
        else:
            spans.append({"start": a, "end": b})
    return spans


def report(removed: DataFrame) -> DataFrame:
    """Per document: bytes, removed bytes, spans, the digest of the kept bytes, and these as text.

    `kept_text` shows the bytes that stay; where a cut falls within a character, U+FFFD stands for what is left of it.
    """
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return removed.select(
        F.col("id").alias("doc_id"), "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
        F.make_valid_utf8(F.col("kept").cast("string")).alias("kept_text"),
    )
