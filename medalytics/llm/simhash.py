"""Near copies by SimHash: a binary trie of the fingerprints is joined with itself.

Two rules link texts: fingerprints of 64 bits that differ in few bits, or a Jaccard similarity of the shingle sets.
For the latter a set has several independent fingerprints of 20 bits, enough of them that one of any pair's lies
within the trie's budget; exact sets confirm what the tries find.
"""

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components, local_stars
from .shared import stage
from .shingles import SEED, bounds, shingle_set, similar_links

MAX_PREFIX_BITS = 16
#: Tries of a similarity: bits of a fingerprint, bits that may differ, bits of the check, and chances that a pair is missed by all tries, by the check.
BITS, BUDGET, CHECK, MISSED, REFUSED = 20, 2, 256, 7e-8, 1e-9
#: Runs of bits that cut a trie into subtrees: two errors leave one of three runs whole.
RUNS = ((0, 7), (7, 7), (14, 6))
STEPS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9))
BYTES = np.uint64(0x00FF00FF00FF00FF)


def fingerprint(text: bytes, words: int = 3) -> int:
    """SimHash over the word shingles of a text, repeats counted, as an unsigned number of 64 bits."""
    joined, starts, ends = bounds(text, words)
    if not starts:
        return 0
    digest, ones = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for at in range(0, len(starts), 1 << 16):
        span = slice(at, at + (1 << 16))
        hashed = b"".join([digest(joined[i:j], SEED) for i, j in zip(starts[span], ends[span])])
        bits = np.unpackbits(np.frombuffer(hashed, np.uint8)).reshape(-1, 64)
        ones += bits.sum(0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(id, body, fp) per row: the id, the digest of the text, and the fingerprint as a signed long."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("id"), F.unhex(F.md5(text)).alias("body"), text.alias("text"))
    schema = rows.select("id", "body").schema.add("fp", "long")

    def hashed(batches):
        for batch in batches:
            found = np.array([fingerprint(t, words) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("body"), pa.array(found.view(np.int64))], ["id", "body", "fp"])

    return rows.mapInArrow(hashed, schema)


def trie_join(a: np.ndarray, b: np.ndarray, same: bool, depth: int, used: int, budget: int, leaf: int = 64):
    """Links between two sorted arrays of different fingerprints that agree in all but `used` of their first `depth` bits.

    Pairs of trie nodes go down together, all of one depth at once. A pair whose children differ in the
    next bit has one error more, and pairs with more than `budget` are given up. Where few leaves are
    left below a pair, they are compared. With `same` both arrays are one, and each link comes once.
    """
    al, ah = np.zeros(1, np.int64), np.full(1, len(a), np.int64)
    bl, bh, errors = np.zeros(1, np.int64), np.full(1, len(b), np.int64), np.full(1, used, np.int64)
    links = []
    while len(al):
        small = (ah - al) * (bh - bl) <= leaf
        links += _compare(a, b, al[small], ah[small], bl[small], bh[small], same, budget)
        al, ah, bl, bh, errors = (x[~small] for x in (al, ah, bl, bh, errors))
        if not len(al):
            break
        bit = np.uint64(1) << np.uint64(63 - depth)
        clear = ~(bit | (bit - np.uint64(1)))
        am = np.searchsorted(a, (a[al] & clear) | bit)
        bm = am if same and (al == bl).all() else np.searchsorted(b, (b[bl] & clear) | bit)
        mirrored = same & (al == bl)
        children = [(al, am, bl, bm, errors), (am, ah, bm, bh, errors), (al, am, bm, bh, errors + 1)]
        other = ~mirrored
        children.append(tuple(x[other] for x in (am, ah, bl, bm, errors + 1)))
        al, ah, bl, bh, errors = (np.concatenate(x) for x in zip(*children))
        alive = (ah > al) & (bh > bl) & (errors <= budget)
        al, ah, bl, bh, errors = (x[alive] for x in (al, ah, bl, bh, errors))
        depth += 1
    return [np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (list(zip(*links)) or [(), ()])]


def _compare(a, b, al, ah, bl, bh, same, budget):
    found = []
    for i, j in _products(al, ah, bl, bh):
        near = np.bitwise_count(a[i] ^ b[j]) <= budget
        if same:
            near &= i < j
        found.append((a[i[near]], b[j[near]]))
    return found


def _products(al, ah, bl, bh, at_once=1 << 21):
    """All pairs (i, j) of the ranges [al, ah) and [bl, bh), in blocks of about `at_once` pairs."""
    wide = bh - bl
    sizes = (ah - al) * wide
    totals, start = np.cumsum(sizes), 0
    while start < len(sizes):
        done = totals[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(totals, done + at_once, "right")))
        part = slice(start, stop)
        of = np.repeat(np.arange(start, stop), sizes[part])
        within = np.arange(len(of)) - np.repeat(totals[part] - sizes[part] - done, sizes[part])
        row, of_row = within // wide[of], wide[of]
        yield al[of] + row, bl[of] + (within - row * of_row)
        start = stop


def prefix_bits(count: int, per_subtree: int) -> int:
    """Depth at which the trie is cut into subtrees of about `per_subtree` fingerprints."""
    return min(MAX_PREFIX_BITS, max(0, (max(count, 1) - 1) // per_subtree).bit_length())


def near_links(values: DataFrame, budget: int = 2, per_subtree: int = 4096) -> DataFrame:
    """Links (a, b) between different fingerprints of at most `budget` differing bits, as stars per task.

    `values` has one long column `fp` without repeats. The trie's top is cut at a depth that follows the
    count, and every fingerprint goes to the pairs of its subtree with each that differs in at most
    `budget` bits. Subtrees with many more fingerprints than planned are cut into parts by a hash, and
    all pairs of parts are joined. The broadcast table has a row per subtree, at most 2^16.
    """
    bits = prefix_bits(values.count(), per_subtree)
    prefix = F.shiftrightunsigned("fp", 64 - bits) if bits else F.lit(0).cast("long")
    tops = values.select("fp", prefix.alias("p"))
    counts = tops.groupBy("p").agg(F.ceil(F.count(F.lit(1)) / (2 * per_subtree)).cast("int").alias("parts"))
    counts = stage(counts, "subtrees")
    own = tops.join(F.broadcast(counts), "p").withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))

    flips = [0] + [1 << i for i in range(bits)] if budget else [0]
    for _ in range(2, budget + 1):
        flips = sorted(set(flips) | {x | 1 << i for x in flips for i in range(bits)})
    every = own.select("fp", "p", "part", F.explode(F.array(*[F.lit(x).cast("long") for x in flips])).alias("flip"))
    every = every.withColumn("q", F.col("p").bitwiseXOR(F.col("flip")))
    other = counts.select(F.col("p").alias("q"), F.col("parts").alias("q_parts"))
    every = every.join(F.broadcast(other), "q").withColumn("q_part", F.explode(F.sequence(F.lit(0), F.col("q_parts") - 1)))
    self_pair, first = F.col("flip") == 0, F.col("p") < F.col("q")
    low, high = F.least("part", "q_part"), F.greatest("part", "q_part")
    blocks = every.select(
        "fp",
        F.least("p", "q").alias("lo"),
        F.greatest("p", "q").alias("hi"),
        F.when(self_pair, low).when(first, F.col("part")).otherwise(F.col("q_part")).alias("i"),
        F.when(self_pair, high).when(first, F.col("q_part")).otherwise(F.col("part")).alias("j"),
        F.when(self_pair, F.col("part") > F.col("q_part")).otherwise(~first).alias("second"),
    )

    def joined(key, rows):
        lo, hi, i, j = (k.as_py() for k in key)
        fp = rows.column("fp").to_numpy().view(np.uint64)
        second = rows.column("second").to_numpy(zero_copy_only=False).astype(bool)
        a, b = np.sort(fp[~second]), np.sort(fp[second])
        same = lo == hi and i == j
        left, right = trie_join(a, a if same else b, same, bits, (lo ^ hi).bit_count(), budget)
        node, root = local_stars(left.view(np.int64), right.view(np.int64))
        return pa.table({"a": node, "b": root})

    return blocks.groupBy("lo", "hi", "i", "j").applyInArrow(joined, "a long, b long")


def tries(similarity: float) -> tuple[int, int]:
    """(number of tries, bits of the check that may differ) for sets of at least this Jaccard similarity.

    A bit of sets of one size differs with probability acos(2 s / (1 + s)) / pi, and less often if their sizes differ.
    """
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    chance = lambda bits, k: math.comb(bits, k) * p**k * (1 - p) ** (bits - k)
    met = sum(chance(BITS, k) for k in range(BUDGET + 1))
    limit, left = 0, 1 - chance(CHECK, 0)
    while left > REFUSED:
        limit += 1
        left -= chance(CHECK, limit)
    return math.ceil(math.log(MISSED) / math.log1p(-met)) if met < 1 else 1, limit


def wide_bits(hashes: np.ndarray, flips: np.ndarray) -> np.ndarray:
    """SimHash of eight bits per number of `flips` over a set of hashes that is not empty: the signs of sums of random bytes.

    Bytes in place of signs make ties rare, so the bits of small sets differ as often as the angle says.
    """
    sums = np.zeros((2, 4 * len(flips)), np.int64)
    for at in range(0, len(hashes), 256):  # 256 bytes fit 16 bits, so four sums share a word
        x = (hashes[at : at + 256, None] ^ flips) * STEPS[0]
        x ^= x >> np.uint64(32)
        x *= STEPS[1]
        x ^= x >> np.uint64(29)
        sums[0] += (x & BYTES).sum(0).view(np.uint16)
        x >>= np.uint64(8)
        sums[1] += (x & BYTES).sum(0).view(np.uint16)
    return (2 * sums > 255 * len(hashes)).ravel()


def wide_fingerprints(docs: DataFrame, id_col: str, text_col: str, words: int, similarity: float) -> DataFrame:
    """(id, body, fp, n, tops, check) per row: the id, the digest of the text, that of its shingle set (0 if empty), the set's size, the fingerprint of each trie, the bits of the check."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("id"), F.unhex(F.md5(text)).alias("body"), text.alias("text"))
    schema = rows.select("id", "body").schema.add("fp", "long").add("n", "long").add("tops", T.ArrayType(T.IntegerType())).add("check", "binary")
    count = tries(similarity)[0]
    flips = np.random.default_rng(SEED).integers(0, 1 << 64, -(-max(BITS * count, CHECK) // 8), np.uint64)

    def hashed(batches):
        for batch in batches:
            sets = [shingle_set(t, words) for t in batch.column("text").to_pylist()]
            sizes = np.fromiter(map(len, sets), np.int64, len(sets))
            fp = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) if len(s) else 0 for s in sets], np.uint64)
            bits = np.array([wide_bits(s, flips) for s in sets if len(s)], bool).reshape(-1, 8 * len(flips))
            tops = bits[:, : BITS * count].reshape(-1, BITS) @ (1 << np.arange(BITS)[::-1])
            listed = pa.ListArray.from_arrays(np.r_[0, np.cumsum(np.where(sizes > 0, count, 0))].astype(np.int32), tops.astype(np.int32))
            checks = iter(np.packbits(bits[:, :CHECK], axis=1))
            check = pa.array([next(checks).tobytes() if n else None for n in sizes], pa.binary())
            found = [batch.column("id"), batch.column("body"), pa.array(fp.view(np.int64)), pa.array(sizes), listed, check]
            yield pa.RecordBatch.from_arrays(found, schema.names)

    return rows.mapInArrow(hashed, schema)


def wide_links(top: np.ndarray, n: np.ndarray, check: np.ndarray, similarity: float, limit: int, crowd: int = 1 << 22, chunk: int = 4096):
    """Stars (i, j) over rows of one trie that chains of pairs join whose fingerprints `top` differ in at most BUDGET bits, whose
    checks differ in at most `limit` and whose sizes `n` allow the similarity.

    Fingerprints meet once whatever the rows that have them: their first rows are compared, and all rows only where these leave
    open what belongs together. Past `crowd` pairs, fingerprints whose rows are already in one part are left out.
    """
    order = np.argsort(top, kind="stable")
    n, check = n[order], check[order]
    values, first, count = np.unique(top[order], return_index=True, return_counts=True)
    fps = values.astype(np.uint64) << np.uint64(64 - BITS)
    left, right = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def near(i, j):
        keep = np.minimum(n[i], n[j]) >= similarity * np.maximum(n[i], n[j])
        keep[keep] = np.bitwise_count(check[i[keep]] ^ check[j[keep]]).sum(1, dtype=np.int64) <= limit
        return keep

    def joined(pairs):
        nonlocal left, right
        for i, j in pairs:
            keep = near(i, j)
            left, right = np.r_[left, i[keep]], np.r_[right, j[keep]]
            if len(left) > crowd:
                left, right = local_stars(left, right)

    own, rows = np.repeat(np.arange(len(values)), count), np.arange(len(order))
    later = rows != first[own]
    hit = near(first[own[later]], rows[later])
    left, right = first[own[later]][hit], rows[later][hit]
    mixed = np.zeros(len(values), bool)  # not all rows are near the first
    mixed[own[later][~hit]] = True
    for at in range(0, len(values), chunk):
        a, b = fps[at : at + chunk], fps[at + chunk :]
        met = [np.r_[x, y] for x, y in zip(trie_join(a, a, True, 0, 0, BUDGET), trie_join(a, b, False, 0, 0, BUDGET))]
        u, v = (np.searchsorted(fps, x) for x in met)
        joined((first[u[k : k + crowd]], first[v[k : k + crowd]]) for k in range(0, len(u), crowd))
        itself = at + np.flatnonzero(mixed[at : at + chunk])
        several = count[u] * count[v] > 1
        u, v = np.r_[u[several], itself], np.r_[v[several], itself]
        if (count[u] * count[v]).sum() > crowd:
            left, right = local_stars(left, right)
            root = rows.copy()
            root[left] = right
            open_ = mixed[u] | mixed[v] | (root[first[u]] != root[first[v]])
            u, v = u[open_], v[open_]
        joined(_products(first[u], first[u] + count[u], first[v], first[v] + count[v]))
    left, right = local_stars(left, right)
    return order[left], order[right]


def similar_candidates(rows: DataFrame, similarity: float, most: int = 1 << 18) -> DataFrame:
    """(fp, component): different sets whose fingerprints a trie brings together, and whose checks and sizes allow the similarity, are in one component.

    `rows` are wide fingerprints. Every trie of up to `most` sets is joined with itself in one task. Larger ones are cut into
    subtrees by each of three runs of bits, one of which two errors leave whole, so a set goes to three subtrees of every
    trie; subtrees of over `most` sets are cut into parts by a hash, and all pairs of parts are joined.
    """
    limit = tries(similarity)[1]
    nodes = stage(rows.filter("n > 0").select("fp", "n", "tops", "check").dropDuplicates(["fp"]), "sets")
    runs = RUNS if nodes.count() > most else ((0, 0),)
    filed = nodes.select("fp", "n", "check", F.posexplode("tops").alias("trie", "top"))
    under = [F.struct(F.lit(k).alias("run"), F.shiftright("top", BITS - at - size).bitwiseAND((1 << size) - 1).alias("bits")) for k, (at, size) in enumerate(runs)]
    filed = filed.select("*", F.inline(F.array(*under)))
    sizes = filed.groupBy("trie", "run", "bits").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("cut")).filter("cut > 1")
    large = stage(sizes, "large-subtrees")
    # rows in proportion to the sets over `most`
    filed = filed.join(F.broadcast(large), ["trie", "run", "bits"], "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("fp"), F.col("cut")).cast("int"), F.lit(0)))
    others = F.filter(F.sequence(F.lit(0), F.coalesce("cut", F.lit(1)) - 1), lambda q: F.col("cut").isNull() | (q != F.col("part")))
    filed = filed.withColumn("q", F.explode(others))
    blocks = filed.select("trie", "run", "bits", F.least("part", "q").alias("i"), F.greatest("part", "q").alias("j"), "top", "fp", "n", "check")

    def joined(table):
        top, fp, n = (table.column(c).to_numpy() for c in ("top", "fp", "n"))
        check = np.frombuffer(b"".join(table.column("check").to_pylist()), np.uint64).reshape(-1, CHECK // 64)
        a, b = wide_links(top, n, check, similarity, limit)
        return pa.table({"a": fp[a], "b": fp[b]})

    links = stage(blocks.groupBy("trie", "run", "bits", "i", "j").applyInArrow(joined, "a long, b long"), "links")
    parts = stage(components(links), "candidates")
    return parts.select(F.col("node").alias("fp"), "component").union(parts.select(F.col("component").alias("fp"), "component").distinct())


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, budget: int = 2, similarity: float | None = None) -> DataFrame:
    """(id, body, fp, component_id) per row: the group is named by the smallest id that links lead to.

    Links join fingerprints of at most `budget` differing bits. With a `similarity` they join texts whose
    sets of shingles have at least that Jaccard similarity instead; `fp` is then the digest of the set. One
    SimHash of 64 bits of texts of similarity 0.8 differs in about 10 bits, too many for a trie, so several
    shorter ones find the candidates (`similar_candidates`; their budget is fixed) and exact sets confirm them.

    Rows of one fingerprint, texts without words included (fingerprint zero), are one node of the trie
    whatever their number. A null text counts as empty. Null ids are grouped like others but name no
    group; a group of null ids only has a null name. Other columns are not read.
    """
    if similarity is None:
        rows = stage(fingerprints(docs, id_col, text_col, words), "fingerprints")
    else:
        rows = stage(wide_fingerprints(docs, id_col, text_col, words, similarity), "fingerprints")
    values = stage(rows.groupBy("fp").agg(F.min("id").alias("least")), "values")
    if similarity is None:
        links = near_links(values.select("fp"), budget)
    else:
        links = similar_links(docs, rows, id_col, text_col, words, similarity, found=similar_candidates(rows, similarity))
    parts = components(links)
    named = values.join(parts.select(F.col("node").alias("fp"), "component"), "fp", "left")
    named = stage(named.select("fp", "least", F.coalesce("component", "fp").alias("part")), "parts")
    least = stage(named.groupBy("part").agg(F.min("least").alias("component_id")), "part-names")
    return rows.join(stage(named.join(least, "part").select("fp", "component_id"), "names"), "fp").select("id", "body", "fp", "component_id")


def hex16(value: Column) -> Column:
    """A signed long as 16 hexadecimal digits."""
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, budget: int = 2, similarity: float | None = None) -> DataFrame:
    """`docs` with one row of each group of `near_groups`: that of the smallest id (null last), then of the least text digest."""
    groups = stage(near_groups(docs, id_col, text_col, words, budget, similarity), "groups")
    # null names stand for several groups only if all ids are null: the fingerprint's part then decides
    order = F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col("body"))
    kept = groups.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("own")).agg(F.min(order).alias("first"))
    kept = stage(kept.select(F.col("first.id").alias("kept_id"), F.col("first.body").alias("kept_body")), "kept")
    body = F.unhex(F.md5(F.coalesce(F.col(f"row.{text_col}"), F.lit("")).cast("binary")))
    rows = docs.select(F.struct("*").alias("row")).select("row", F.col(f"row.{id_col}").alias("id"), body.alias("body"))
    same = rows.id.eqNullSafe(kept.kept_id) & (rows.body == kept.kept_body)
    return rows.join(kept, same, "left_semi").dropDuplicates(["id", "body"]).select("row.*")
