"""Merkle manifest of a table: a tree per group and one over their roots, built level by level with sibling self-joins."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medalytics.functions.scratch import store
from medalytics.functions.skew import join_lookup

from .shared import stage

DIGEST_BYTES = 32


@dataclass(frozen=True)
class Forest:
    """`levels` from the leaves up, each (tree, idx, n, digest, siblings), the lowest with `row` too; `roots` (tree, digest)."""

    levels: list
    roots: DataFrame
    arity: int


@dataclass(frozen=True)
class Manifest:
    """The trees of the groups, and the tree over their roots, whose `idx` is the groups' `tree`."""

    groups: Forest
    top: Forest


def encoded(value: Column) -> Column:
    """A value after its UTF-8 byte count and a colon, or `-` for a null, so that no two rows read alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    """SHA-256 (32 bytes) over the encoded values of a row."""
    return F.unhex(F.sha2(F.concat(*[encoded(v) for v in values]), 256))


def hexed(digests: Column) -> Column:
    """Digests, one after another, as lower-case hexadecimal text."""
    return F.lower(F.hex(digests))


def parent_digest(own: Column, slot: Column, siblings: Column) -> Column:
    """The digest over the hex texts of the siblings before the slot, the node itself and the siblings after it."""
    before = F.substring(siblings, F.lit(1), slot * DIGEST_BYTES)
    after = F.substring(siblings, slot * DIGEST_BYTES + 1, F.octet_length(siblings))
    return F.unhex(F.sha2(F.concat(hexed(before), hexed(own), hexed(after)), 256))


def numbered(rows: DataFrame, by: str, order: list[str], range_rows: int = 1_000_000) -> tuple[DataFrame, int]:
    """Add `idx`, the place from 0 of a row among those with its value of `by` (null is one), and `n`, their number; and the largest n.

    Rows are ranged and written with their place in the range, of about `range_rows` rows; one line per range
    and value says where it begins. So a value that most rows have is numbered by many tasks.
    """
    stored = store(rows, "unnumbered")
    parts = max(1, -(-stored.rows // range_rows))
    ranged = stored.df.repartitionByRange(parts, by, *order).sortWithinPartitions(by, *order)
    ranged = stage(ranged.select("*", F.monotonically_increasing_id().alias("at"), F.spark_partition_id().alias("part")), "ranged")
    counts = ranged.groupBy(by, "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("count"))
    whole = Window.partitionBy(by)
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select(by, "part", (F.coalesce(F.sum("count").over(before), F.lit(0)) - F.col("first")).alias("shift"), F.sum("count").over(whole).alias("n"))
    begins = store(begins, "begins")
    most = begins.df.agg(F.max("n")).first()[0] or 0
    placed = join_lookup(ranged, begins, [by, "part"], "inner")
    return placed.withColumn("idx", F.col("at") + F.col("shift")).drop("at", "part", "shift"), most


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Nodes (tree, idx, n, digest and others) with `siblings`, the digests of the rest of their run, left to right.

    Every node is sent to the computed indices of its siblings (idx XOR 1 in a binary tree, the other slots of
    the run otherwise) and an equijoin meets it there, so a node's siblings arrive in the partition it lies in.
    """
    idx, step = F.col("idx"), F.lit(arity).cast("long")
    if arity == 2:
        targets = F.array(idx.bitwiseXOR(F.lit(1).cast("long")))
    else:
        offsets = F.sequence(F.lit(1).cast("long"), step - 1)
        targets = F.transform(offsets, lambda k: idx - idx % step + (idx + k) % step)
    sent = nodes.select(F.col("tree").alias("to_tree"), "n", (idx % step).alias("slot"), "digest", F.explode(targets).alias("to_idx"))
    sent = sent.filter(F.col("to_idx") < F.col("n")).select("to_tree", "to_idx", F.struct("slot", "digest").alias("sent"))
    met = nodes.join(sent, (F.col("tree") == F.col("to_tree")) & (idx == F.col("to_idx")), "left").drop("to_tree", "to_idx")
    others = [c for c in nodes.columns if c not in ("tree", "idx")]
    runs = met.groupBy("tree", "idx").agg(*[F.first(c).alias(c) for c in others], F.array_sort(F.collect_list("sent")).alias("sent"))
    nothing = F.lit("").cast("binary")
    siblings = F.aggregate("sent", nothing, lambda done, one: F.concat(done, one["digest"]))
    return runs.select("tree", "idx", *others, siblings.alias("siblings"))


def grow(leaves: DataFrame, most: int, arity: int) -> Forest:
    """Trees over `leaves` (tree, idx, n, digest, row), the largest of which has `most`; every level is written.

    A tree of one node is done and that node its root. Otherwise the nodes in slot zero, which know their
    run, emit the parents.
    """
    if arity < 2:
        raise ValueError("a run has two nodes or more")
    level, levels, roots = stage(with_siblings(leaves, arity), "merkle-leaves"), [], None
    while True:
        levels.append(level)
        done = level.filter("n = 1").select("tree", "digest")
        roots = done if roots is None else roots.union(done)
        if most <= 1:
            return Forest(levels, stage(roots, "merkle-roots"), arity)
        first = level.filter((F.col("n") > 1) & (F.col("idx") % arity == 0))
        up = first.select(
            "tree",
            F.floor(F.col("idx") / arity).alias("idx"),
            F.ceil(F.col("n") / arity).alias("n"),
            parent_digest(F.col("digest"), F.lit(0), F.col("siblings")).alias("digest"),
        )
        most = -(-most // arity)
        level = stage(with_siblings(up, arity), "merkle-level")


def manifest(rows: DataFrame, group: str, order: list[str], arity: int = 8) -> Manifest:
    """One tree per value of `group` over `rows`, which have a 32-byte `digest`, and one tree over the trees' roots.

    Leaves go by `order` (nulls first), ties by the digest, so equal rows are interchangeable; repeated rows
    are leaves of their own. While a tree has more than one node, every `arity` consecutive ones become the
    digest of their hex texts together, the last run being shorter, even one node. Roots go by their group,
    null first, then bytewise. All columns of `rows` but the digest are carried in `row`. An empty table has no
    leaves and no root. Nothing but the number of leaves comes to the driver.
    """
    names, count = numbered(rows.select(group).distinct().withColumn("all", F.lit(0)), "all", [group])
    names = store(names.select(F.col(group).alias("name"), F.col("idx").alias("tree")), "groups")
    carried = rows.select(F.col(group).alias("name"), "digest", F.struct(*[F.col(c) for c in rows.columns if c != "digest"]).alias("row"))
    placed, most = numbered(carried, "name", [*[f"row.{c}" for c in order], "digest"])
    leaves = join_lookup(placed, names, ["name"], "inner").select("tree", "idx", "n", "digest", "row")
    trees = grow(leaves, most, arity)
    tops = trees.roots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(count).cast("long").alias("n"), "digest")
    return Manifest(trees, grow(tops, count, arity))


def _path(forest: Forest) -> DataFrame:
    """The nodes of the lowest level with `path`: (slot, siblings) per level from there to the root of their tree."""
    step = F.array(F.struct((F.col("idx") % forest.arity).cast("int").alias("slot"), "siblings"))
    nowhere = F.slice(step, 1, 0)
    above = None
    for level in reversed(forest.levels):
        own = F.when(F.col("n") > 1, step).otherwise(nowhere)
        here = level.withColumn("path", own)
        if above is not None:
            over = above.select(F.col("tree").alias("up_tree"), F.col("idx").alias("up_idx"), F.col("path").alias("up_path"))
            to_it = (F.col("tree") == F.col("up_tree")) & (F.floor(F.col("idx") / forest.arity) == F.col("up_idx"))
            here = here.join(over, to_it, "left").withColumn("path", F.concat("path", F.coalesce("up_path", nowhere))).drop("up_tree", "up_idx", "up_path")
        above = here
    return above.drop("n", "siblings")


def proofs(made: Manifest) -> DataFrame:
    """(row, digest, subroot, root, path) per leaf: the root of its group, that of the table, and (slot, siblings) per level to the latter.

    Paths come down the levels: a node's is its own step before its parent's. What the groups share (subroot
    and the way from there) is looked up per group.
    """
    tops = _path(made.top).select(F.col("idx").alias("tree"), F.col("digest").alias("subroot"), F.col("path").alias("on"))
    root = made.top.roots.select("digest").scalar()
    shared = store(tops.withColumn("root", root), "merkle-shared")
    leaves = join_lookup(_path(made.groups), shared, ["tree"], "inner")
    return leaves.select("row", "digest", "subroot", "root", F.concat("path", "on").alias("path"))


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path give."""
    return F.aggregate(path, start, lambda own, step: parent_digest(own, step["slot"], step["siblings"]))


def path_text(path: Column) -> Column:
    """The siblings of all steps of a path as hex text, left to right and upwards."""
    return hexed(F.aggregate(path, F.lit("").cast("binary"), lambda done, step: F.concat(done, step["siblings"])))


def verify(docs: DataFrame, tampered: Column, changed: dict, columns: list[str], group: str, order: list[str], arity: int = 8) -> DataFrame:
    """(row, leaf, subroot, root, proof_sha256, folded_root, verified) per row of `docs`, digests as hex text.

    The leaf is the digest of `columns`. Where `tampered` is true, the fold starts from the leaf that the row
    has with the columns `changed`; `verified` says whether it still ends in the root. `row` holds `order`
    and `group`; other columns of `docs` are not read.
    """
    own = leaf_digest(*[F.col(c) for c in columns])
    other = leaf_digest(*[changed.get(c, F.col(c)) for c in columns])
    start = F.when(F.coalesce(tampered, F.lit(False)), other)
    rows = docs.select(*dict.fromkeys([group, *order]), own.alias("digest"), start.alias("start"))
    found = proofs(manifest(rows, group, order, arity))
    ends = hexed(folded(F.coalesce("row.start", "digest"), F.col("path")))
    found = found.select("row", *[hexed(F.col(c)).alias(n) for c, n in (("digest", "leaf"), ("subroot", "subroot"), ("root", "root"))],
                         F.sha2(path_text(F.col("path")), 256).alias("proof_sha256"), ends.alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
