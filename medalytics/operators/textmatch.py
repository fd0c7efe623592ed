"""Rules over text, and which texts mention which names."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import fixed_values as V
from ..functions.scratch import store
from ..functions.skew import join_lookup


def classify(df: DataFrame, text: str, rules, default: str, out: str = "theme") -> DataFrame:
    """Label of the first matching pattern."""
    return df.withColumn(out, C.by_pattern(F.col(text), rules, default))


def evolution(df: DataFrame, by: str, text: str, rules=V.THEME_RULES, default: str = V.THEME_DEFAULT) -> DataFrame:
    """Rows per term and label, largest first within a term."""
    found = classify(df, text, rules, default).groupBy(by, "theme").agg(F.count(F.lit(1)).alias("n"))
    return found.orderBy(by, F.col("n").desc(), "theme")


def urgency(df: DataFrame, text: str, tiers=V.URGENCY_WORDS, whole_words: bool = False, out: str = "urgency") -> DataFrame:
    return df.withColumn(out, C.by_words(F.col(text), tiers, V.URGENCY_DEFAULT, whole_words))


def urgency_by_body(df: DataFrame, subject: str, body: str, critical: str = V.PLENARY_BODY) -> DataFrame:
    """Rows that have a subject, with their urgency by body."""
    return df.filter(F.col(subject).isNotNull()).withColumn("urgency", C.by_body(F.col(body), critical))


def contains_any(df: DataFrame, checks: list[tuple[str, str]]) -> DataFrame:
    """Rows where any (column, text) check holds; a null column does not hold."""
    tests = [F.coalesce(F.col(c).contains(t), F.lit(False)) for c, t in checks]
    return df.filter(reduce(lambda a, b: a | b, tests))


def with_status(df: DataFrame, column: str, mark: str = V.CLOSED_MARK) -> DataFrame:
    closed = F.coalesce(F.col(column).contains(mark), F.lit(False))
    return df.withColumn("status", F.when(closed, V.CLOSED_STATUS).otherwise(V.OPEN_STATUS))


def mentions(hay: DataFrame, needles: DataFrame, text: str, needle_id: str, names: list[str], keep: list[str]) -> DataFrame:
    """Pairs of a text row (its `keep` columns) and a needle that has one of its `names` in the text.

    Substring match on whole texts; blank names are ignored. A name is looked for only in texts that hold
    one of its words, its anchor: the rarest of the words with a space on either side in the name, which
    must be whole words of the text too. A name without such a word has for anchors all words of the texts
    that contain its longest part; they are found by grams of up to three letters over the distinct words.
    So rows meet by equal words, and `contains` only confirms them. Names, anchors and the pairs to confirm are
    written and broadcast where they are small, so texts are then not shuffled.
    """
    rows = text_rows(hay, text, keep)
    words = row_words(rows)
    by_word = lambda wanted: join_lookup(words, wanted.select("__word").distinct(), ["__word"], "inner")
    by_gram = lambda wanted: word_grams(words.select("__word").distinct())
    return confirmed(rows, by_word, by_gram, needles, needle_id, names, keep)


def text_rows(hay: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """`keep`, the text and the digest of both as the row's name; null texts go."""
    own = F.unhex(F.md5(F.concat(F.to_json(F.struct(*keep), {"ignoreNullFields": "false"}), F.col(text))))
    return hay.filter(F.col(text).isNotNull()).select(*keep, F.col(text).alias("__text"), own.alias("__row"))


def row_words(rows: DataFrame) -> DataFrame:
    """The different words of every row, cut at single spaces."""
    return rows.select("__row", F.explode(F.array_distinct(F.split("__text", " "))).alias("__word"))


def grams_of(word: str):
    """The different grams of one to three letters of a word that is not empty."""
    cut = lambda n: F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.substr(word, i, F.lit(n)))
    return F.array_distinct(F.flatten(F.array(*[cut(n) for n in (1, 2, 3)])))


def word_grams(spelled: DataFrame) -> DataFrame:
    """The different grams of one to three letters of every word."""
    return spelled.filter("__word <> ''").select("__word", F.explode(grams_of("__word")).alias("__gram"))


def confirmed(rows: DataFrame, by_word, by_gram, needles: DataFrame, needle_id: str, names: list[str], keep: list[str]) -> DataFrame:
    """The pairs of `mentions`, given the rows and ways to the (row, word) of wanted words and the (word, gram) of wanted grams."""
    listed = needles.select(F.col(needle_id), F.explode(F.array(*names)).alias("__name")).filter(F.trim("__name") != "").distinct()
    parts = F.split("__name", " ")
    inner = F.filter(F.slice(parts, 2, F.greatest(F.size(parts) - 2, F.lit(0))), lambda w: w != "")
    cut = listed.select("__name").distinct().select("__name", parts.alias("__parts"), inner.alias("__inner"))
    exact = cut.select("__name", F.explode("__inner").alias("__word"))
    met = store(by_word(exact), "name-words").df
    common = met.groupBy("__word").agg(F.count(F.lit(1)).alias("__n"))
    anchors = exact.join(common, "__word").groupBy("__name").agg(F.min_by("__word", "__n").alias("__word"))
    held = join_lookup(met, anchors, ["__word"], "inner")
    loose = cut.filter(F.size("__inner") == 0)
    if not loose.isEmpty():
        parts_found = _loose_anchors(loose, by_gram)
        held = held.unionByName(join_lookup(by_word(parts_found), parts_found, ["__word"], "inner"))
    held = held.select("__row", "__name").distinct()
    found = join_lookup(rows, held, ["__row"], "inner").filter(F.contains("__text", "__name"))
    pairs = join_lookup(found, listed, ["__name"], "inner").select(*keep, needle_id)
    return pairs.distinct() if len(names) > 1 else pairs


def _loose_anchors(names: DataFrame, by_gram) -> DataFrame:
    """For names without an inner word all words that contain their longest part, found by its first three letters."""
    longest = F.array_max(F.transform("__parts", lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    wanted = names.select("__name", longest.alias("__part")).withColumn("__gram", F.substring("__part", 1, 3))
    return wanted.join(by_gram(wanted), "__gram").filter(F.contains("__word", "__part")).select("__name", "__word")


def mention_timeline(
    hay: DataFrame, row_id: str, ts: str, text: str, needles: DataFrame, needle_id: str, names: list[str]
) -> DataFrame:
    """First and last mention, mentions and days between, for every needle; needles without one are kept."""
    return timeline(mentions(hay, needles, text, needle_id, names, [row_id, ts]), ts, needles, needle_id)


def timeline(found: DataFrame, ts: str, needles: DataFrame, needle_id: str) -> DataFrame:
    """First and last time, number and days between of the pairs found, for every needle."""
    spans = found.groupBy(needle_id).agg(
        F.min(ts).alias("first_at"), F.max(ts).alias("last_at"), F.count(F.lit(1)).alias("n_mentions")
    )
    return (
        needles.join(spans, needle_id, "left")
        .fillna(0, subset=["n_mentions"])
        .withColumn("days", F.datediff("last_at", "first_at"))
    )


def flag_exists(df: DataFrame, other: DataFrame, on: str, out: str) -> DataFrame:
    """Whether the key occurs in another table."""
    there = other.select(on).distinct().withColumn("__there", F.lit(True))
    return df.join(there, on, "left").withColumn(out, F.col("__there").isNotNull()).drop("__there")
