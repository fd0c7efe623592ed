"""From raw documents to sampled token ids: language, shared lines, near copies, source mix, pieces."""

from pyspark.sql import functions as F

from medalytics.llm import catalog, langid, linededup, mixing, pieces, simhash
from medalytics.llm.shared import stage, table


def _with(rows, columns, **new):
    """The columns of the nested `row`, some of them replaced."""
    return rows.select(*[new[c].alias(c) if c in new else F.col(f"row.`{c}`") for c in columns])


def language(spark, docs, sf_dir):
    """Language ID: null texts and texts without a letter go, and `lang` becomes the learned language that is likeliest."""
    found = langid.identify(docs, langid.learned_from(docs))
    return _with(found.filter(F.col("lang_pred") != langid.UNKNOWN), docs.columns, lang=F.col("lang_pred"))


def shared_lines(spark, docs, sf_dir):
    """Line dedup: texts lose the lines that many documents share; no row goes."""
    kept = linededup.dedup_lines(docs)
    text = F.when(F.size("kept") == F.size("lines"), F.col("row.text")).otherwise(F.array_join("kept", "\n"))
    return _with(kept, docs.columns, text=text, n_chars=F.length(text).cast(docs.schema["n_chars"].dataType))


def near_copies(spark, docs, sf_dir):
    """SimHash near-dedup: one document of each group stays; texts of Jaccard similarity 0.8 or more over five-word shingles are linked.

    Tries of several independent SimHashes find the candidates, as one SimHash of such texts differs in about ten of 64 bits;
    exact shingle sets confirm them.
    """
    return simhash.keep_one(docs, words=5, similarity=0.8)


def source_mix(spark, docs, sf_dir):
    """Mixing: sources are dealt to tempered weights; a document comes once for each pass that takes it."""
    return mixing.mix(docs).select("row.*")


def token_ids(spark, docs, sf_dir):
    """SentencePiece encoding: one sampled segmentation of each text, with the check that it decodes to the text."""
    return pieces.sampled(docs, pieces.vocabulary(catalog.VOCABULARY))


STAGES = [
    ("language ID", language),
    ("line dedup", shared_lines),
    ("near-dedup", near_copies),
    ("mixing sources", source_mix),
    ("SentencePiece", token_ids),
]

#: The first stage is a learned model, which SQL can't express.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents; what each keeps is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
