"""Sources mixed to tempered weights under a token budget, in permuted blocks."""

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stage

ORDER_BITS, LEVEL_BITS = 60, 12
HALVINGS, PASSES = 5, 6


def tokens(text: Column) -> Column:
    """Number of words between white space; null has none."""
    parts = F.split(F.coalesce(text, F.lit("")), "[ \t-\r]+", -1)
    return F.size(F.filter(parts, lambda w: w != "")).cast("long")


def order_key(ident: Column, text: Column, seed: int) -> Column:
    """60 bits that place a row in its source's permutation; equal rows share one place."""
    body = F.md5(F.coalesce(text, F.lit("")))
    name = F.concat_ws("|", F.lit(str(seed)), F.coalesce(ident.cast("string"), F.lit("")), body)
    return F.conv(F.substring(F.md5(name), 1, ORDER_BITS // 4), 16, 10).cast("long")


@dataclass(frozen=True)
class Curve:
    """Entropy of the tempered weights and the most often any source repeats, at one exponent."""

    entropy: float
    repeats: float


def _curves(shares: DataFrame, exponents, demand: float) -> list[Curve]:
    """One aggregate over the sources for all exponents; `demand` is the budget over all tokens."""
    p, asked = F.col("p"), []
    for i, t in enumerate(exponents):
        tempered = F.exp(F.lit(float(t)) * F.log(p))
        asked += [F.sum(tempered).alias(f"z{i}"), F.sum(tempered * F.log(p)).alias(f"a{i}"), F.max(tempered / p).alias(f"m{i}")]
    row = shares.agg(*asked).first()
    return [
        Curve(math.log(row[f"z{i}"]) - float(t) * row[f"a{i}"] / row[f"z{i}"], demand * row[f"m{i}"] / row[f"z{i}"])
        for i, t in enumerate(exponents)
    ]


def _bisect(holds, low=0.0, high=1.0) -> tuple[float, float]:
    """Narrow [low, high], where `holds` is true at low and false at high.

    `holds` takes a list: the midpoints that the next five halvings can ask for are evaluated together.
    """
    for _ in range(PASSES):
        n = 1 << HALVINGS
        points = [low + (high - low) * i / n for i in range(1, n)]
        answers = holds(points)
        a, b = 0, n
        for _ in range(HALVINGS):
            middle = (a + b) // 2
            a, b = (middle, b) if answers[middle - 1] else (a, middle)
        low, high = low + (high - low) * a / n, low + (high - low) * b / n
    return low, high


def exponent(shares: DataFrame, demand: float, entropy_ratio: float, max_repeats: float) -> float:
    """The exponent in [0, 1] for source shares `p`.

    The largest whose entropy is at least `entropy_ratio` of the most possible; if a source would then be
    repeated more than `max_repeats` times, the smallest exponent at which none is. One means the shares
    as they are, zero equal weights.
    """
    n = shares.count()
    if n < 2:
        return 1.0
    target = entropy_ratio * math.log(n)
    flat, plain = _curves(shares, [0.0, 1.0], demand)
    if plain.repeats > max_repeats * (1 + 1e-9):
        raise ValueError("the budget needs more repeats of the sources than are allowed")
    chosen = 1.0
    if plain.entropy < target:
        chosen = _bisect(lambda t: [c.entropy >= target for c in _curves(shares, t, demand)])[0]
    if _curves(shares, [chosen], demand)[0].repeats > max_repeats:
        chosen = _bisect(lambda t: [c.repeats > max_repeats for c in _curves(shares, t, demand)], chosen, 1.0)[1]
    return chosen


def quotas(rows: DataFrame, budget: int | None, entropy_ratio: float, max_repeats: float) -> DataFrame:
    """(source, total, weight, quota) from rows of (source, n): whole tokens of the budget for each source."""
    totals = stage(rows.groupBy("source").agg(F.sum("n").alias("total")), "source-tokens")
    everything = totals.agg(F.sum("total")).first()[0] or 0
    wanted = everything if budget is None else budget
    if not everything:
        return totals.select("source", "total", F.lit(0.0).alias("weight"), F.lit(0).cast("long").alias("quota"))
    shares = totals.filter("total > 0").select((F.col("total") / F.lit(float(everything))).alias("p"))
    t = exponent(shares, wanted / everything, entropy_ratio, max_repeats)
    tempered = F.when(F.col("total") > 0, F.exp(F.lit(t) * F.log(F.col("total") / F.lit(float(everything))))).otherwise(0.0)
    whole = totals.agg(F.sum(tempered)).first()[0]
    weight = tempered / F.lit(float(whole))
    return stage(totals.select("source", "total", weight.alias("weight"), F.floor(F.round(weight * float(wanted), 6)).cast("long").alias("quota")), "quotas")


def cuts(rows: DataFrame, shares: DataFrame) -> DataFrame:
    """(source, epochs, cut): full passes over a source, and the place below which one more pass takes rows.

    The cut is found digit by digit, 12 bits of the order at a time: tokens are summed per digit, and
    the first digit whose sum passes the rest of the quota holds the cut. Windows span 4,096 digits of a
    source, never its rows. A pass takes whole rows and stays within the quota.
    """
    passes = shares.select(
        F.col("source").alias("s"),
        F.when(F.col("total") > 0, F.floor(F.col("quota") / F.col("total"))).otherwise(1).cast("int").alias("epochs"),
        F.when(F.col("total") > 0, F.col("quota") % F.col("total")).cast("long").alias("rest"),
    )
    found = stage(passes.select("s", "epochs", "rest", F.lit(0).cast("long").alias("cut")), "cuts")
    for level in range(ORDER_BITS // LEVEL_BITS):
        shift = ORDER_BITS - LEVEL_BITS * (level + 1)
        if level:
            # the digits so far are part of the key, so a large source is spread over its places
            same = F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("u", shift + LEVEL_BITS) == F.col("cut"))
            rows = stage(rows.join(found.select("s", "cut"), same).select("source", "u", "n"), "near-cut")
        digit = F.shiftright("u", shift).bitwiseAND((1 << LEVEL_BITS) - 1).alias("digit")
        sums = rows.groupBy("source", digit).agg(F.sum("n").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("source").orderBy("digit"))
        placed = sums.select("source", "digit", upto.alias("upto"), (upto - F.col("n")).alias("before")).withColumnRenamed("source", "ds")
        first = placed.join(found.select("s", "rest"), F.col("ds").eqNullSafe(F.col("s"))).filter("upto > rest")
        first = first.groupBy(F.col("ds")).agg(F.min(F.struct("digit", "before")).alias("d"))
        following = found.join(first, F.col("s").eqNullSafe(F.col("ds")), "left").select(
            "s", "epochs", (F.col("rest") - F.coalesce("d.before", F.lit(0))).alias("rest"),
            (F.shiftleft("cut", LEVEL_BITS) + F.coalesce("d.digit", F.lit(0))).alias("cut"),
        )
        found = stage(following, "cuts")
    return found.select(F.col("s").alias("source"), "epochs", "cut")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", budget: int | None = None, entropy_ratio: float = 0.95, max_repeats: float = 4.0, seed: int = 17, keep: list[str] | None = None) -> DataFrame:
    """(row, n_tokens, epoch, block, place): every selected copy of a row, with its place in the stream.

    Source shares of the tokens are tempered to weights (see `exponent`) and the budget (all tokens of the
    input, if not given) is dealt by weight. A source is passed over as often as its quota holds it; the
    last pass takes its permutation's blocks in order until the quota is full. Sorting a source by epoch,
    block and place gives its permuted blocks. `row` holds the columns `keep` (all, if not given).

    A null source is a source of its own. Sources without a token cost nothing and stay once. Equal rows of
    one id and text share a place and are taken together; if they don't fit, none is. Null texts have no
    tokens. More tokens wanted than `max_repeats` passes over everything raise a ValueError.
    """
    source, text = F.col(source_col), F.col(text_col)
    key = order_key(F.col(id_col), text, seed)
    rows = stage(docs.select(source.alias("source"), key.alias("u"), tokens(text).alias("n")), "mix-rows")
    limits = stage(cuts(rows, quotas(rows, budget, entropy_ratio, max_repeats)).withColumnRenamed("source", "limit_source"), "limits")
    kept = F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns])
    full = docs.select(kept.alias("row"), source.alias("source"), key.alias("u"), tokens(text).alias("n_tokens"))
    met = full.join(limits, F.col("source").eqNullSafe(F.col("limit_source")))
    copies = F.col("epochs") + (F.col("u") < F.col("cut")).cast("int")
    passes = met.filter(copies > 0).withColumn("epoch", F.explode(F.sequence(F.lit(0), copies - 1)))
    other = F.shiftrightunsigned(F.xxhash64("u", "epoch"), 64 - ORDER_BITS)
    place = F.when(F.col("epoch") < F.col("epochs"), other).otherwise(F.col("u"))
    block = F.shiftright(place, ORDER_BITS - LEVEL_BITS).cast("int")
    return passes.select("row", "n_tokens", "epoch", block.alias("block"), place.alias("place"))
