"""How filters interact: per part, what each step of every order of five filters keeps, removes and takes from the others."""

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stage

FILTERS = "ABCDE"
SPACES = r"[\x20\x09-\x0D]+"
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def text_failures(text: Column) -> dict[str, Column]:
    """Which of the filters A to D a text (not null) fails.

    A: under 200 words; B: distinct words under half of the words; C: over 3 % capitals A-Z; D: one of #$%&*|.
    """
    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    return {
        "A": F.size(words) < 200,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 50,
        "C": F.regexp_count(text, F.lit("[A-Z]")) * 100 > F.length(text) * 3,
        "D": text.rlike("[#$%&*|]"),
    }


def contingency(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(part, pattern, n, good, toxic): documents by part and pattern of failures, bit i of `pattern` for the i-th filter.

    A null text is empty, a null part is the empty one. Filter E fails a row whose text a smaller id has
    anywhere; a null id is smaller than none and has none smaller, rows of one id and text are both kept by E.
    A label counts if any row of `labels` for the id has it; null ids have no labels. Other columns are not read.

    Only digests are shuffled, after equal rows are counted. Texts held by a large share of the rows are
    counted by partial aggregates, with the smallest id of each part along.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    bits = sum((F.when(failed, F.lit(1 << i)).otherwise(F.lit(0)) for i, failed in enumerate(text_failures(text).values())), F.lit(0))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), bits.alias("bits"))
    rows = stage(rows.groupBy("id", "part", "digest", "bits").agg(F.count(F.lit(1)).alias("n")), "audit-rows")

    marks = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("label_id"))
    marks = marks.agg(*[F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))])
    known = rows.filter(F.col("id").isNotNull()).join(marks, F.col("id") == F.col("label_id"), "left")
    known = known.select("id", "part", "digest", "bits", "n", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("good", "toxic")])

    sums = [F.sum("n").alias("n"), *[F.sum(F.col(c) * F.col("n")).alias(c) for c in ("good", "toxic")]]
    least = F.min(F.struct("id", "n", "good", "toxic")).alias("least")
    texts = stage(known.groupBy("digest", "part", "bits").agg(*sums, least), "audit-texts")
    owners = texts.groupBy(F.col("digest").alias("owned")).agg(F.min("least.id").alias("owner"))
    met = texts.join(owners, F.col("digest") == F.col("owned"))
    first = {c: F.when(F.col("least.id") == F.col("owner"), F.col("least.n") * (F.col(f"least.{c}") if c != "n" else 1)).otherwise(0) for c in ("n", "good", "toxic")}
    kinds = F.array(
        F.struct(F.col("bits").alias("pattern"), *[first[c].alias(c) for c in first]),
        F.struct((F.col("bits") + 16).alias("pattern"), *[(F.col(c) - first[c]).alias(c) for c in first]),
    )
    named = met.select("part", F.inline(kinds))
    unnamed = rows.filter(F.col("id").isNull()).select("part", F.col("bits").alias("pattern"), "n", F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("toxic"))
    return named.union(unnamed).groupBy("part", "pattern").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def steps() -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
    """All (order, step, filter), and per one the selections (axis, pass and fail) of the rows before it, at it and unique to it."""
    lines, before, here, unique = [], [], [], []
    for order in permutations(range(len(FILTERS))):
        for step, chosen in enumerate(order):
            ahead, own = np.ones((len(FILTERS), 2), np.int64), np.ones((len(FILTERS), 2), np.int64)
            ahead[list(order[:step]), 1] = 0  # passed so far
            own[:, 1] = 0  # passes all the others
            own[chosen] = 0, 1
            lines.append(("".join(FILTERS[i] for i in order), step + 1, chosen))
            before.append(ahead)
            here.append(np.where(np.arange(len(FILTERS))[:, None] == chosen, [0, 1], ahead))
            unique.append(own)
    return lines, np.stack(before), np.stack(here), np.stack(unique)


def contracted(counts: np.ndarray, selected: np.ndarray) -> np.ndarray:
    """Sums of a tensor of 2x2x2x2x2 counts with some measures, for every selection of pass, fail or all along the axes."""
    return np.einsum("abcdem,ra,rb,rc,rd,re->rm", counts, *[selected[:, axis] for axis in range(len(FILTERS))], optimize="greedy")


def interaction(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from the counts of `contingency`.

    The patterns of a part, 32 at most, become a tensor in one task; parts are spread over the tasks. Patterns
    that do not occur count as zero.
    """
    lines, before, here, unique = steps()
    chosen = np.array([f for _, _, f in lines])
    orders, places = [o for o, _, _ in lines], [s for _, s, _ in lines]
    fails = np.ones((len(lines), len(FILTERS), 2), np.int64)
    fails[np.arange(len(lines)), chosen] = 0, 1

    def audit(key, table):
        cells = np.zeros((32, 3), np.int64)
        cells[table.column("pattern").to_numpy()] = np.stack([table.column(c).to_numpy() for c in ("n", "good", "toxic")], 1)
        # bit i of a pattern is axis i, so the last axis of the reshaped tensor is the first filter
        tensor = cells.reshape((2,) * len(FILTERS) + (3,)).transpose(*reversed(range(len(FILTERS))), len(FILTERS))
        removed = contracted(tensor, here)
        all_failing = contracted(tensor, fails)[:, 0]
        shapley = np.array([removed[chosen == f, 0].sum() for f in range(len(FILTERS))])[chosen]
        columns = {
            "part": pa.array([key[0].as_py()] * len(lines), pa.string()),
            "filter_order": orders,
            "step": pa.array(places, pa.int32()),
            "filter": [FILTERS[f] for f in chosen],
            "kept": contracted(tensor, before)[:, 0] - removed[:, 0],
            "removed": removed[:, 0],
            "redundant": all_failing - removed[:, 0],
            "unique_fails": contracted(tensor, unique)[:, 0],
            "good_lost": removed[:, 1],
            "toxic_lost": removed[:, 2],
            "shapley": shapley,
        }
        return pa.table(columns)

    schema = "part string, filter_order string, step int, filter string, " + ", ".join(f"{m} long" for m in MEASURES)
    return counts.groupBy("part").applyInArrow(audit, schema)
