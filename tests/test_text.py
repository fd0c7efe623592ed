"""Rules over text and mentions."""

import random

from medalytics.functions import fixed_values as V
from medalytics.operators import textindex, textmatch


def test_themes_fold_accented_capitals(spark):
    df = spark.createDataFrame([("FRENTE DA POLÍCIA",), ("Frente da SAÚDE e da escola",), ("Agronegócio",), ("Cinema",), (None,)], "t string")
    got = [r["theme"] for r in textmatch.classify(df, "t", V.THEME_RULES, V.THEME_DEFAULT).collect()]
    assert got == ["Segurança", "Saúde", "Agropecuária", "Outros", "Outros"]


def test_urgency_by_substring_and_by_word(spark):
    df = spark.createDataFrame([("PEC 1/2024",), ("Comissão Especial",), ("medida provisória 5",), ("PLP 9",), ("MP 3",), (None,)], "t string")
    assert [r[1] for r in textmatch.urgency(df, "t").collect()] == ["CRITICA", "CRITICA", "CRITICA", "ALTA", "CRITICA", "NORMAL"]
    assert [r[1] for r in textmatch.urgency(df, "t", whole_words=True).collect()] == ["CRITICA", "NORMAL", "CRITICA", "ALTA", "CRITICA", "NORMAL"]


def test_urgency_by_body(spark):
    df = spark.createDataFrame([("PLEN", "x"), ("CCJ", "x"), (None, "x"), ("PLEN", None)], "b string, s string")
    assert [r["urgency"] for r in textmatch.urgency_by_body(df, "s", "b").collect()] == ["CRITICA", "ALTA", "NORMAL"]


def test_contains_any_is_null_safe(spark):
    df = spark.createDataFrame([(None, "CPI x"), ("CPI", None), ("a", None)], "a string, b string")
    assert textmatch.contains_any(df, [("a", "CPI"), ("b", "CPI")]).count() == 2


def test_mentions_by_brute_force(spark):
    """Overlapping, nested, accented, blank and missing names, with and without inner words, repeated rows."""
    rng = random.Random(9)
    texts = [(i, "".join(rng.choice("abç ") for _ in range(rng.randrange(0, 60)))) for i in range(120)] + [(500, None), (501, "")]
    names = [(j, "".join(rng.choice("abç") for _ in range(rng.randrange(1, 4))), rng.choice(["", None, "a b", " ", "a b ç", " a  b", "b a ", "ab ç a b"])) for j in range(40)]
    want = {(i, j) for i, t in texts if t for j, a, b in names if a in t or (b and b.strip() and b in t)}
    got = textmatch.mentions(
        spark.createDataFrame(texts, "i int, t string"), spark.createDataFrame(names, "j int, a string, b string"), "t", "j", ["a", "b"], ["i"]
    ).collect()
    assert {(r["i"], r["j"]) for r in got} == want and len(got) == len(want)


def test_an_index_of_increments_finds_what_a_scan_finds(spark, tmp_path):
    rng = random.Random(10)
    texts = [(i, "".join(rng.choice("abç ") for _ in range(rng.randrange(0, 60)))) for i in range(150)] + [(500, None), (501, ""), (502, "plain words here")]
    names = [(j, "".join(rng.choice("abç") for _ in range(rng.randrange(1, 5))), rng.choice(["", None, "a b", "a b ç", "b a ", "ab ç a b"])) for j in range(40)]
    hay = spark.createDataFrame(texts, "i int, t string")
    needles, path = spark.createDataFrame(names, "j int, a string, b string"), str(tmp_path / "index")
    for n, part in enumerate((hay.filter("i < 60"), hay.filter("i >= 60"), hay.filter("i >= 60"))):
        textindex.add(part, "t", ["i"], path, str(min(n, 1)))
        upto = hay.filter("i < 60") if n == 0 else hay
        got = sorted(map(tuple, textindex.mentions(spark, path, needles, "j", ["a", "b"], ["i"]).collect()))
        assert got == sorted(map(tuple, textmatch.mentions(upto, needles, "t", "j", ["a", "b"], ["i"]).collect())) and got
    none = textindex.mentions(spark, path, needles.filter("j < 0"), "j", ["a", "b"], ["i"])
    assert none.columns == ["i", "j"] and none.count() == 0


def test_a_search_reads_the_buckets_of_its_words(spark, tmp_path):
    path = str(tmp_path / "index")
    hay = spark.range(300).selectExpr("id AS i", "concat('x word', id, ' y') AS t")
    assert textindex.add(hay, "t", ["i"], path, "one") == 300
    found = textindex._in_buckets(spark, f"{path}/words", spark.createDataFrame([("word7",)], "__word string"), "__word")
    assert found.count() == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_an_index_has_each_different_word_once_an_increment(spark, tmp_path):
    path = str(tmp_path / "index")
    hay = spark.range(300).selectExpr("id AS i", "concat('x word', id % 100, ' yéçàñ  y') AS t")
    for _ in range(2):
        textindex.add(hay, "t", ["i"], path, "one")
    stored = {p.name: spark.read.parquet(str(p)).count() for p in (tmp_path / "index").iterdir()}
    assert stored.pop("rows") == 300 and stored.pop("words") == 1500 and list(stored.values()) == [103]
    wanted = spark.createDataFrame([("éç",), ("ord",), ("q",), ("7",)], "__gram string")
    got = {(r["__word"], r["__gram"]) for r in textindex._by_gram(spark, f"{path}/spelled", wanted).collect()}
    words = ["x", "y", "yéçàñ"] + [f"word{i}" for i in range(100)]
    assert got == {(w, g) for w in words for g in ("éç", "ord", "q", "7") if g in w}


def test_mentions_without_names(spark):
    hay = spark.createDataFrame([(1, "x")], "i int, t string")
    none = spark.createDataFrame([(1, None)], "j int, a string")
    got = textmatch.mentions(hay, none, "t", "j", ["a"], ["i"])
    assert got.columns == ["i", "j"] and got.count() == 0


def test_timeline_keeps_unmentioned(spark):
    hay = spark.sql("SELECT * FROM VALUES (1, DATE'2024-01-01', 'CPI A'), (2, DATE'2024-01-11', 'a CPI A b') AS t(i, d, t)")
    needles = spark.createDataFrame([(1, "CPI A"), (2, "CPI B")], "j int, n string")
    got = {r["j"]: (r["n_mentions"], r["days"]) for r in textmatch.mention_timeline(hay, "i", "d", "t", needles, "j", ["n"]).collect()}
    assert got == {1: (2, 10), 2: (0, None)}


def test_flag_exists(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    other = spark.createDataFrame([(1,), (1,)], "k int")
    assert {r["k"]: r["f"] for r in textmatch.flag_exists(df, other, "k", "f").collect()} == {1: True, 2: False}


def test_status(spark):
    df = spark.createDataFrame([("CPI Encerrada",), ("CPI",), (None,)], "t string")
    assert [r["status"] for r in textmatch.with_status(df, "t").collect()] == ["ENCERRADA", "ATIVA", "ATIVA"]
