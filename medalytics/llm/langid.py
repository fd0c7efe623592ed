"""Language of documents: mixture proportions by expectation-maximisation over n-gram likelihoods."""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import stage

UNKNOWN = "und"
BITS = 16
SEGMENT = 48
#: ASCII bytes that are no letters become spaces; bytes of other characters stay.
LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


@dataclass(frozen=True)
class Model:
    """Languages in order, and the log-probability of each hashed trigram in each of them."""

    languages: list
    log_p: np.ndarray


def cleaned(text: bytes) -> bytes:
    """Lower-cased text with one space between runs of letters and two at the ends."""
    return b"  " + b" ".join(text.translate(LETTERS).split()) + b"  "


def trigrams(data: np.ndarray) -> np.ndarray:
    """The hash of three bytes from every position."""
    x = data.astype(np.uint32)
    mixed = x[:-2] * np.uint32(0x9E3779B1) + x[1:-1] * np.uint32(0x85EBCA77) + x[2:] * np.uint32(0xC2B2AE3D)
    return ((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - BITS)


def remainder(ident: Column) -> Column:
    """crc32 of the id as text, modulo 3; the remainder 1 is held out from learning."""
    return F.crc32(ident.cast("string").cast("binary")) % 3


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", smoothing: float = 0.5) -> Model:
    """Trigram counts of every language over all rows given, as smoothed log-probabilities.

    Rows with a null text or language teach nothing. Tasks send on one row per language and trigram they
    met; the driver gets the model itself, at most 2^16 numbers per language.
    """
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.lower(text_col).cast("binary").alias("text")).dropna()

    def count(batches):
        counts = {}

        def held():
            for lang, n in counts.items():
                gram = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram), pa.array(n[gram])], ["lang", "gram", "n"])
            counts.clear()

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = {}
                for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                    texts.setdefault(lang, []).append(cleaned(text))
                for lang, some in texts.items():
                    found = np.bincount(trigrams(np.frombuffer(b"".join(some), np.uint8)), minlength=1 << BITS)
                    counts[lang] = counts[lang] + found if lang in counts else found
                if len(counts) > 64:
                    yield from held()
        yield from held()

    counted = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    found = stage(counted, "trigrams").toArrow()
    languages = sorted(set(found.column("lang").to_pylist()))
    table = np.zeros((len(languages), 1 << BITS))
    place = {lang: i for i, lang in enumerate(languages)}
    table[[place[x] for x in found.column("lang").to_pylist()], found.column("gram").to_numpy()] = found.column("n").to_numpy()
    table += smoothing
    return Model(languages, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32))


def mixtures(texts: list[bytes], log_p: np.ndarray, rounds: int = 20) -> np.ndarray:
    """Language proportions of each text, zero for languages that its penalised likelihood leaves out.

    A text is a sequence of segments of about 48 letters, each from one language; its likelihood there is
    that of its trigrams. All languages start equal. Then the weakest one is dropped again and again while
    the loss of log-likelihood is less than the penalty of half the log of the number of segments.
    """
    parts = [cleaned(t) for t in texts]
    sizes = np.array([len(p) - 2 for p in parts])
    data = np.frombuffer(b"".join(parts), np.uint8)
    begins = np.r_[0, np.cumsum(sizes + 2)[:-1]]
    grams = trigrams(data)
    segments = -(-sizes // SEGMENT)
    doc = np.repeat(np.arange(len(texts)), segments)
    within = np.arange(len(doc)) - np.repeat(np.cumsum(segments) - segments, segments)
    start = begins[doc] + within * SEGMENT
    stop = np.minimum(start + SEGMENT, begins[doc] + sizes[doc])
    edges = np.minimum(np.stack([start, stop], 1).ravel(), len(grams) - 1)
    likely = np.stack([np.add.reduceat(p[grams], edges)[::2] for p in log_p], 1).astype(np.float64)
    top = likely.max(axis=1)
    likely = np.exp(np.maximum(likely - top[:, None], -600))
    first = np.r_[0, np.cumsum(segments)[:-1]]
    base = np.add.reduceat(top, first)

    def fit(share, rounds):
        for _ in range(rounds):
            weight = likely * share[doc]
            weight /= weight.sum(axis=1, keepdims=True)
            following = np.add.reduceat(weight, first) / segments[:, None]
            change = np.abs(following - share).max()
            share = following
            if change < 1e-4:
                break
        total = np.add.reduceat(np.log((likely * share[doc]).sum(axis=1)), first) + base
        return share, total

    share, total = fit(np.full((len(texts), len(log_p)), 1 / len(log_p)), rounds)
    active = np.ones(share.shape, bool)
    penalty = 0.5 * np.log(segments + 1)
    going = np.ones(len(texts), bool)
    for _ in range(len(log_p) - 1):
        weakest = np.where(active, share, np.inf).argmin(axis=1)
        less = active.copy()
        less[np.arange(len(texts)), weakest] = False
        trial = np.where(less, share + 1e-6, 0)
        trial, trial_total = fit(trial / trial.sum(axis=1, keepdims=True), rounds // 2)
        going &= trial_total >= total - penalty
        if not going.any():
            break
        share[going], total[going], active[going] = trial[going], trial_total[going], less[going]
    return share


def identify(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(row, lang_pred, score) per row: `row` holds the columns `keep` (all, if not given), whatever their names.

    `lang_pred` is the language of the largest share and `score` that share, between 0 and 1. A null text,
    one without a letter, and any text if nothing was learned are `und` with score 0. Only the text is read.
    """
    text = F.col(text_col)
    known = F.coalesce(text.rlike(r"\p{L}"), F.lit(False)) & F.lit(bool(model.languages))
    kept = F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns])
    rows = docs.select(kept.alias("row"), F.when(known, F.lower(text)).cast("binary").alias("text"))
    schema = T.StructType([rows.schema["row"]]).add("lang_pred", "string").add("score", "double")
    languages, log_p = np.array(model.languages, object), model.log_p

    def predict(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            some, size = [], 0
            for i, text in enumerate([*texts, None]):
                if text is not None:
                    some.append(i)
                    size += len(text)
                if some and (size > 1 << 20 or i == len(texts)):
                    share = mixtures([texts[j] for j in some], log_p)
                    for j, name, score in zip(some, languages[share.argmax(axis=1)], share.max(axis=1)):
                        names[j], scores[j] = name, min(1.0, float(score))
                    some, size = [], 0
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(names, pa.string()), pa.array(scores)], ["row", "lang_pred", "score"])

    return rows.mapInArrow(predict, schema)


def learned_from(docs: DataFrame, id_col: str = "doc_id", **columns) -> Model:
    """The model of the documents that are not held out; a null id is not learned from."""
    return learn(docs.filter(remainder(F.col(id_col)) != 1), **columns)
