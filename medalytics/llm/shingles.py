"""Near copies by the Jaccard similarity of word shingles: bands of least hashes find candidates, the sets confirm them."""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components, local_stars
from .shared import stage

SEED = 42
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Pairs of similarity s meet in no band with probability (1 - s^6)^54: 7e-8 at 0.8, 3e-18 at 0.9.
BANDS, WIDTH = 54, 6
AT_ONCE = 1 << 16

_draw = np.random.default_rng(SEED)
FLIP = _draw.integers(0, 1 << 32, BANDS * WIDTH, np.uint32)
TIMES = _draw.integers(0, 1 << 31, BANDS * WIDTH, np.uint32) * np.uint32(2) + np.uint32(1)
MIX = np.uint64(0x9E3779B97F4A7C15)


def bounds(text: bytes, words: int):
    """(joined, starts, ends): the words of a text with single spaces, and where its shingles lie; fewer words are one shingle."""
    parts = text.translate(LOWER).split()
    if not parts:
        return b"", [], []
    size = min(words, len(parts))
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths) + np.arange(len(parts))
    starts = ends - lengths
    return b" ".join(parts), starts[: len(parts) - size + 1].tolist(), ends[size - 1 :].tolist()


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """The different shingles of a text as sorted hashes of 64 bits."""
    joined, starts, ends = bounds(text, words)
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[i:j], SEED) for i, j in zip(starts, ends)), np.uint64, len(starts)))


def bands(sets: list[np.ndarray]) -> np.ndarray:
    """A row of BANDS hashes for each set that is not empty: each of the least of WIDTH random orders of the shingles."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    low = np.concatenate(sets).astype(np.uint32) if sets else np.zeros(0, np.uint32)
    ends = np.cumsum(sizes)
    found, at = np.full((BANDS * WIDTH, len(sets)), 0xFFFFFFFF, np.uint32), 0
    while at < len(low):  # pieces of at most AT_ONCE hashes, so that they stay in the cache
        stop = min(len(low), at + AT_ONCE)
        a, b = np.searchsorted(ends, at, "right"), np.searchsorted(ends, stop - 1, "right")
        first = np.maximum(ends[a : b + 1] - sizes[a : b + 1] - at, 0)
        piece = low[at:stop]
        for k in range(BANDS * WIDTH):
            np.minimum(found[k, a : b + 1], np.minimum.reduceat((piece ^ FLIP[k]) * TIMES[k], first), out=found[k, a : b + 1])
        at = stop
    mixed = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[:, None] * MIX, len(sets), axis=1)
    for k in range(WIDTH):
        mixed = (mixed ^ found[k::WIDTH]) * MIX
        mixed ^= mixed >> np.uint64(29)
    return mixed.T.copy()


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5) -> DataFrame:
    """(id, body, fp, n, bands) per row: the id, the digest of the text, that of its shingle set (0 if empty), the set's size, its bands."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("id"), F.unhex(F.md5(text)).alias("body"), text.alias("text"))
    schema = rows.select("id", "body").schema.add("fp", "long").add("n", "long").add("bands", T.ArrayType(T.LongType()))

    def sketched(batches):
        for batch in batches:
            sets = [shingle_set(t, words) for t in batch.column("text").to_pylist()]
            sizes = np.fromiter(map(len, sets), np.int64, len(sets))
            fp = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) if len(s) else 0 for s in sets], np.uint64)
            values = bands([s for s in sets if len(s)]).view(np.int64).ravel()
            listed = pa.ListArray.from_arrays(np.r_[0, np.cumsum(np.where(sizes > 0, BANDS, 0))].astype(np.int32), values)
            found = [batch.column("id"), batch.column("body"), pa.array(fp.view(np.int64)), pa.array(sizes), listed]
            yield pa.RecordBatch.from_arrays(found, ["id", "body", "fp", "n", "bands"])

    return rows.mapInArrow(sketched, schema)


def similar(sets: list[np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Links that join exactly the sets that chains of pairs of at least that Jaccard similarity join.

    A set is held against all that nothing has reached yet, and those it reaches follow; what is reached
    is not compared again, so a group whose members resemble one another costs about one comparison each.
    """
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    words, codes = np.unique(np.concatenate(sets), return_inverse=True)
    begins = np.cumsum(sizes) - sizes
    left, left_codes, mark = np.arange(len(sets)), codes, np.zeros(len(words), np.int8)
    a, b, queue = [], [], []
    while len(left):
        if not queue:
            queue.append(int(left[0]))
            keep = np.arange(len(left)) > 0
        else:
            x = queue.pop()
            own = codes[begins[x] : begins[x] + sizes[x]]
            mark[own] = 1
            n = sizes[left]
            hit = np.add.reduceat(mark[left_codes], np.cumsum(n) - n, dtype=np.int64)
            mark[own] = 0
            keep = hit / (sizes[x] + n - hit) < similarity
            reached = left[~keep].tolist()
            a += [x] * len(reached)
            b += reached
            queue += reached
        if not keep.all():
            left_codes, left = left_codes[np.repeat(keep, sizes[left])], left[keep]
    return np.array(a, np.int64), np.array(b, np.int64)


def candidates(rows: DataFrame, similarity: float) -> DataFrame:
    """(fp, component): different sets that share a band, and whose sizes allow the similarity, are in one component.

    Rows are ranged by band, size and set, so a band that very many sets have lies in several tasks. In a band
    they follow one another as a chain, also from the last row of a range to the first of the next, which one line
    per end of a range tells; no list of a band's sets is made.
    """
    nodes = rows.filter("n > 0").select("fp", "n", "bands").dropDuplicates(["fp"])
    filed = nodes.select(F.explode("bands").alias("band"), "fp", "n")
    filed = filed.repartitionByRange("band", "n", "fp").sortWithinPartitions("band", "n", "fp")

    def chains(batches):
        before, place, first = [np.zeros(0, np.int64)] * 3, TaskContext.get().partitionId(), None

        def end(row, side):
            columns = [pa.array([x], pa.int64()) for x in (row[1], row[1], row[0], row[2], 2 * place + side)]
            return pa.RecordBatch.from_arrays(columns, ["a", "b", "band", "n", "place"])

        for batch in batches:
            band, fp, n = (np.r_[x, c.to_numpy()] for x, c in zip(before, batch.columns))
            near = (band[1:] == band[:-1]) & (fp[1:] != fp[:-1]) & (n[:-1] / n[1:] >= similarity)
            node, root = local_stars(fp[:-1][near], fp[1:][near])
            nothing = pa.nulls(len(node), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root), nothing, nothing, nothing], ["a", "b", "band", "n", "place"])
            if first is None and len(band):
                first = [band[0], fp[0], n[0]]
                yield end(first, 0)
            before = [x[-1:] for x in (band, fp, n)]
        if first is not None:
            yield end([x[0] for x in before], 1)

    linked = stage(filed.mapInArrow(chains, "a long, b long, band long, n long, place long"), "chains")
    # two lines per range, so this window sees few
    ends = linked.filter("place IS NOT NULL").select("*", F.lead(F.struct("a", "band", "n", "place")).over(Window.orderBy("place")).alias("next"))
    crossing = ends.filter((F.col("place") % 2 == 1) & (F.col("next.band") == F.col("band")) & (F.col("n") / F.col("next.n") >= similarity))
    links = linked.filter("place IS NULL").select("a", "b").union(crossing.select("a", F.col("next.a").alias("b")))
    parts = stage(components(links), "candidates")
    return parts.select(F.col("node").alias("fp"), "component").union(parts.select(F.col("component").alias("fp"), "component").distinct())


def similar_links(
    docs: DataFrame, rows: DataFrame, id_col: str, text_col: str, words: int, similarity: float, most_sets: int = 2048, most_shingles: int = 1 << 18, found: DataFrame | None = None
) -> DataFrame:
    """Links (a, b) between different shingle sets, as stars per task, from the exact Jaccard similarity of candidates.

    `rows` has the (id, body, fp, n) of `docs`, and `found` the (fp, component) of the candidates; without it `rows` are
    sketches, whose bands find them. Small components of candidates are dealt into units; larger ones
    are cut into parts, and all pairs of parts are held against each other. Only candidates' texts are
    read again, one of each set.
    """
    owners = rows.groupBy("fp").agg(F.min(F.struct("id", "body", "n")).alias("o")).select("fp", "o.*")
    found = candidates(rows, similarity) if found is None else found
    members = stage(found.join(owners, "fp"), "members")
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("shingles"))
    cut = F.ceil(F.greatest(F.col("sets") / most_sets, F.col("shingles") / most_shingles)).cast("int")
    large = stage(sizes.select("component", cut.alias("cut")).filter("cut > 1"), "large-candidates")
    total = members.agg(F.sum("n")).first()[0] or 0
    units = max(256, -(-total // most_shingles))
    placed = members.join(large, "component", "left").withColumn("part", F.pmod(F.xxhash64("fp"), F.col("cut")).cast("int"))
    whole = F.col("cut").isNull()
    placed = placed.select(
        "id", "body", "fp", "component", "part", F.coalesce("cut", F.lit(0)).alias("cut"),
        F.when(whole, F.pmod(F.xxhash64("component"), F.lit(units))).otherwise(F.col("component")).alias("unit"),
    )
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    texts = docs.select(F.col(id_col).alias("its_id"), F.unhex(F.md5(text)).alias("its_body"), text.alias("text"))
    texts = texts.join(placed, F.col("its_id").eqNullSafe(F.col("id")) & (F.col("its_body") == F.col("body")))
    texts = texts.select("unit", "component", "cut", "part", "fp", "text")
    schema = texts.drop("text").schema.add("shingles", "binary")

    def hashed(batches):
        for batch in batches:
            sets = [shingle_set(t, words).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sets, pa.binary())], [*batch.schema.names[:-1], "shingles"])

    others = F.filter(F.sequence(F.lit(0), F.greatest(F.col("cut"), F.lit(1)) - 1), lambda q: (F.col("cut") == 0) | (q != F.col("part")))
    blocks = texts.mapInArrow(hashed, schema).withColumn("q", F.explode(others))
    cutting = F.col("cut") > 0
    blocks = blocks.select(
        "unit", F.when(cutting, F.least("part", "q")).otherwise(-1).alias("i"), F.when(cutting, F.greatest("part", "q")).otherwise(-1).alias("j"), "component", "fp", "shingles"
    )

    def confirmed(table):
        component, fp = table.column("component").to_numpy(), table.column("fp").to_numpy()
        order = np.lexsort((fp, component))
        order = order[np.r_[True, fp[order][1:] != fp[order][:-1]]] if len(order) else order  # a repeated row comes once
        shingles, a, b = table.column("shingles").to_pylist(), [], []
        for some in np.split(order, np.flatnonzero(np.diff(component[order])) + 1):
            x, y = similar([np.frombuffer(shingles[k], np.uint64) for k in some], similarity)
            a.append(fp[some[x]])
            b.append(fp[some[y]])
        node, root = local_stars(np.concatenate(a), np.concatenate(b))
        return pa.table({"a": node, "b": root})

    return blocks.groupBy("unit", "i", "j").applyInArrow(confirmed, "a long, b long")
