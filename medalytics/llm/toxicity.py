"""Toxicity learned from confirmed toxic documents and unlabelled text, by non-negative positive-unlabelled risk."""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .langid import cleaned
from .shared import stage

BITS = 18
WIDTH = 5
#: A block of texts: their number fits beside a bucket in 32 bits.
BLOCK_TEXTS, BLOCK_BYTES = 1 << 13, 1 << 20
#: Vectors shorter than this keep their length, so that one weak gram alone decides nothing.
FLOOR = 4.0


@dataclass(frozen=True)
class Model:
    """`ratio` of each bucket (zero for those that tell nothing), its learned weight, and the bias; None before anything is learned."""

    ratio: np.ndarray
    weight: np.ndarray
    bias: float


def remainder(ident: Column) -> Column:
    """crc32 of the id as text, modulo 5; the remainder 0 is held out from learning."""
    return F.crc32(ident.cast("string").cast("binary")) % 5


def grams(texts: list[bytes], chosen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of the different hashed 5-byte grams of each lower-cased text, whole; only of `chosen` buckets, if given.

    Letters count, what lies between them is one space, two at the ends. A null is an empty text, without grams.
    """
    parts = [cleaned(t or b"") for t in texts]
    sizes = np.array([len(p) for p in parts])
    data = np.frombuffer(b"".join(parts), np.uint8)
    count = len(data) - WIDTH + 1
    if count < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    mixed = np.zeros(count, np.uint64)
    for i in range(WIDTH):
        mixed = mixed * np.uint64(0x100000001B3) + data[i : i + count]
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    bucket = (mixed >> np.uint64(64 - BITS)).astype(np.uint32)
    text = np.repeat(np.arange(len(texts), dtype=np.uint32), sizes)
    inside = text[:count] == text[WIDTH - 1 :]
    if chosen is not None:
        inside &= chosen[bucket]
    keys = np.sort((text[:count][inside] << np.uint32(BITS)) | bucket[inside])
    keys = keys[np.r_[True, keys[1:] != keys[:-1]]] if len(keys) else keys
    return (keys >> np.uint32(BITS)).astype(np.int64), (keys & np.uint32((1 << BITS) - 1)).astype(np.int64)


def blocks(texts: list[bytes]):
    """(first, stop) of blocks of texts of about a megabyte; a long text is a block of its own."""
    first = size = 0
    for i, text in enumerate(texts):
        if i > first and (size + len(text or b"") > BLOCK_BYTES or i - first == BLOCK_TEXTS):
            yield first, i
            first, size = i, 0
        size += len(text or b"")
    if texts:
        yield first, len(texts)


def vectors(text: np.ndarray, bucket: np.ndarray, count: int, ratio: np.ndarray) -> np.ndarray:
    """Value of every (text, bucket): the bucket's ratio over the length of the text's vector."""
    value = ratio[bucket]
    length = np.sqrt(np.bincount(text, value * value, count))
    return value / np.maximum(length, FLOOR)[text]


def risk(z_positive: np.ndarray, z_unlabelled: np.ndarray, prior: float) -> tuple[float, float]:
    """The two parts of the risk: positives taken for positives, and unlabelled less its share of positives taken for negatives."""
    return prior * np.logaddexp(0, -z_positive).mean(), np.logaddexp(0, z_unlabelled).mean() - prior * np.logaddexp(0, z_positive).mean()


def slopes(z_positive: np.ndarray, z_unlabelled: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """What a step goes down along, per score: the whole risk, or away from a negative part that has fallen below zero."""
    p, u = 1 / (1 + np.exp(-z_positive)), 1 / (1 + np.exp(-z_unlabelled))
    if risk(z_positive, z_unlabelled, prior)[1] >= 0:
        return np.full(len(p), -prior / len(p)), u / len(u)
    return prior * p / len(p), -u / len(u)


class Rows:
    """Sparse vectors of some texts, from which batches are drawn."""

    def __init__(self, lists: list, ratio: np.ndarray):
        sizes = np.array([len(x) for x in lists], np.int64)
        self.first = np.r_[0, np.cumsum(sizes)]
        self.bucket = np.concatenate(lists).astype(np.int64) if len(lists) else np.zeros(0, np.int64)
        self.value = vectors(np.repeat(np.arange(len(lists)), sizes), self.bucket, len(lists), ratio)

    def __len__(self):
        return len(self.first) - 1

    def take(self, some):
        sizes = self.first[some + 1] - self.first[some]
        of = np.repeat(np.arange(len(some)), sizes)
        at = np.repeat(self.first[some] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        return of, self.bucket[at], self.value[at]


def train(positive: Rows, unlabelled: Rows, prior: float, seed: int, steps: int = 320, batch: int = 500, rate: float = 0.15) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic classifier: adaptive steps down the non-negative risk of drawn batches."""
    draw = np.random.default_rng(seed)
    size = 1 << BITS
    weight, bias, seen, seen_bias = np.zeros(size), 0.0, np.full(size, 1e-8), 1e-8
    for _ in range(steps):
        p = positive.take(draw.integers(0, len(positive), max(1, batch // 4)))
        u = unlabelled.take(draw.integers(0, len(unlabelled), batch))
        score = [np.bincount(of, weight[bucket] * value, n) + bias for (of, bucket, value), n in ((p, max(1, batch // 4)), (u, batch))]
        slope = slopes(*score, prior)
        step = sum(np.bincount(bucket, down[of] * value, size) for (of, bucket, value), down in zip((p, u), slope))
        step_bias = sum(down.sum() for down in slope)
        seen += step * step
        seen_bias += step_bias * step_bias
        weight -= rate * step / np.sqrt(seen)
        bias -= rate / 3 * step_bias / np.sqrt(seen_bias)
    return weight, bias


def ratios(positive: np.ndarray, unlabelled: np.ndarray, n_positive: int, n_unlabelled: int, pull: float = 5.0, least: float = 1.0) -> np.ndarray:
    """Log of how much more often toxic texts hold a bucket than all texts do, drawn to zero as by `pull` texts; zero below `least`."""
    ease = pull / max(1, min(n_positive, n_unlabelled))
    found = np.log((positive / max(1, n_positive) + ease) / (unlabelled / max(1, n_unlabelled) + ease))
    return np.where(np.abs(found) > least, found, 0.0)


def _counts(rows):
    """(toxic, bucket, n): texts that hold the bucket, for all rows and for the toxic ones; bucket -1 counts the texts."""

    def count(batches):
        held = np.zeros((2, (1 << BITS) + 1), np.int64)
        for batch in batches:
            texts, toxic = batch.column("text").to_pylist(), batch.column("toxic").to_numpy(zero_copy_only=False).astype(bool)
            for a, b in blocks(texts):
                of, bucket = grams(texts[a:b])
                held[0, 1:] += np.bincount(bucket, minlength=1 << BITS)
                held[1, 1:] += np.bincount(bucket[toxic[a:b][of]], minlength=1 << BITS)
                held[:, 0] += b - a, toxic[a:b].sum()
        toxic, bucket = np.nonzero(held)
        for at in range(0, len(bucket), 1 << 16):
            t, b = toxic[at : at + (1 << 16)], bucket[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(b - 1), pa.array(held[t, b])], ["toxic", "bucket", "n"])

    return rows.mapInArrow(count, "toxic long, bucket long, n long").groupBy("toxic", "bucket").agg(F.sum("n").alias("n"))


def _sampled(rows, ratio, models):
    """(id, toxic, model, grams) of the sample: the informative buckets of each text; toxic ones go to every model. Repeated rows count once."""
    chosen = ratio != 0
    schema = T.StructType([rows.schema["id"]]).add("toxic", "boolean").add("grams", T.ArrayType(T.IntegerType()))

    def hold(batches):
        for batch in batches:
            texts, lists = batch.column("text").to_pylist(), []
            for a, b in blocks(texts):
                of, bucket = grams(texts[a:b], chosen)
                lists += [x.tolist() for x in np.split(bucket, np.searchsorted(of, np.arange(1, b - a)))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("toxic"), pa.array(lists, pa.list_(pa.int32()))], ["id", "toxic", "grams"])

    every = F.sequence(F.lit(0), F.lit(models - 1))
    own = F.array(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(models)).cast("int"))
    found = rows.mapInArrow(hold, schema).dropDuplicates()
    return found.withColumn("model", F.explode(F.when(F.col("toxic"), every).otherwise(own)))


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    max_positive: int = 16_000, max_unlabelled: int = 32_000, models: int = 4,
) -> Model | None:
    """A model of the texts whose id is not held out; None if no toxic one is among them.

    Of labels only the confirmed toxic ids serve, and the share of toxic among all labels as the class prior.
    Unlabelled text is every text that is not held out, whatever its label. How many texts hold each gram is
    counted over all of them. Classifiers are fitted, one in each of `models` tasks and averaged, on a sample
    by the hash of the id: about `max_positive` toxic and `max_unlabelled` of all texts, as vectors of
    informative grams only; these bounds are all that tasks and driver hold of it. Null ids teach nothing.
    """
    taught = labels.filter(remainder(F.col("doc_id")) != 0).groupBy(F.col("doc_id").alias("label_id")).agg(F.max(label_col).alias("mark"))
    taught = stage(taught, "toxic-labels")
    totals = taught.agg(F.count_if(F.col("mark") == 1).alias("toxic"), F.count("mark").alias("all")).first()
    if not totals["toxic"]:
        return None
    prior = totals["toxic"] / totals["all"]

    def within(ident, bound, count, seed):
        return F.pmod(F.xxhash64(ident, F.lit(seed)), F.lit(1 << 30)) < int(min(1.0, bound / max(1, count)) * (1 << 30))

    # at most about max_positive ids of 8 bytes, whatever the number of labels
    known = taught.filter((F.col("mark") == 1) & within("label_id", max_positive, totals["toxic"], 1)).select("label_id")
    rows = docs.select(F.col(id_col).alias("id"), F.lower(text_col).cast("binary").alias("text")).filter(remainder(F.col("id")) != 0)
    rows = rows.join(F.broadcast(known), F.col("id") == F.col("label_id"), "left")
    rows = rows.select("id", F.col("label_id").isNotNull().alias("toxic"), "text")

    found = stage(_counts(rows.select("toxic", "text")), "gram-counts").toArrow()
    held = np.zeros((2, (1 << BITS) + 1), np.int64)
    held[found.column("toxic").to_numpy(), found.column("bucket").to_numpy() + 1] = found.column("n").to_numpy()
    if not held[1, 0]:
        return None
    ratio = ratios(held[1, 1:], held[0, 1:], int(held[1, 0]), int(held[0, 0]))

    some = within("id", max_unlabelled, int(held[0, 0]), 2)
    unlabelled = rows.filter(some).select("id", F.lit(False).alias("toxic"), "text")
    sample = stage(_sampled(rows.filter("toxic").union(unlabelled), ratio, models), "toxic-sample")

    def fit(key, table):
        lists, toxic = table.column("grams").to_pylist(), table.column("toxic").to_pylist()
        order = np.argsort(table.column("id").to_numpy(), kind="stable")
        sets = [Rows([np.array(lists[i], np.int64) for i in order if toxic[i] is kind], ratio) for kind in (True, False)]
        if not all(map(len, sets)):
            return pa.table({"bucket": pa.array([], pa.int64()), "weight": pa.array([], pa.float64())})
        weight, bias = train(*sets, prior, seed=int(key[0].as_py()))
        used = np.flatnonzero(weight)
        return pa.table({"bucket": np.r_[-1, used], "weight": np.r_[bias, weight[used]]})

    fitted = stage(sample.groupBy("model").applyInArrow(fit, "bucket long, weight double"), "toxic-models").toArrow()
    bucket, value = fitted.column("bucket").to_numpy(), fitted.column("weight").to_numpy()
    made = max(1, (bucket < 0).sum())
    weight = np.bincount(bucket[bucket >= 0], value[bucket >= 0], 1 << BITS) / made
    return Model(ratio.astype(np.float32), weight.astype(np.float32), float(value[bucket < 0].sum() / made))


def scores(texts: list[bytes], model: Model) -> np.ndarray:
    """Chance of label 1 for each text, by its informative grams; a text without any has that of the bias."""
    chosen, result = model.ratio != 0, np.zeros(len(texts))
    for a, b in blocks(texts):
        of, bucket = grams(texts[a:b], chosen)
        value = vectors(of, bucket, b - a, model.ratio)
        result[a:b] = 1 / (1 + np.exp(-(np.bincount(of, model.weight[bucket] * value, b - a) + model.bias)))
    return result


def score(docs: DataFrame, model: Model | None, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(row, score) per row: `row` holds the columns `keep` (all, if not given), whatever their names.

    Only the whole text is read. A null text counts as empty, and empty texts have a score too. Without a
    model every score is 0.
    """
    kept = F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns])
    rows = docs.select(kept.alias("row"), F.lower(text_col).cast("binary").alias("text"))
    if model is None:
        return rows.select("row", F.lit(0.0).alias("score"))

    def rate(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(scores(batch.column("text").to_pylist(), model))], ["row", "score"])

    return rows.mapInArrow(rate, T.StructType([rows.schema["row"]]).add("score", "double"))
