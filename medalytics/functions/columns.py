"""Column builders used by the operators; each one stays inside whole-stage code generation."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as V


def as_type(source: Column, kind: str) -> Column:
    """Typed value, or null where the text does not parse."""
    return source if kind == "same" else source.try_cast(kind)


def truthy(name: str, kind: str) -> Column:
    """Present: not null, not the empty text, not zero."""
    column = F.col(name)
    if kind == "string":
        return F.coalesce(column != "", F.lit(False))
    if kind == "boolean":
        return F.coalesce(column, F.lit(False))
    if kind in ("date", "timestamp", "timestamp_ntz") or kind.startswith(("array", "struct", "map")):
        return column.isNotNull()
    return F.coalesce(column != 0, F.lit(False))


def digest(cols, sep: str = "||") -> Column:
    """md5 over the joined texts of `cols`; nulls are left out."""
    return F.md5(F.concat_ws(sep, *[F.col(c).cast("string") for c in cols]))


def row_digest(cols) -> Column:
    """md5 over the texts of `cols`, each with its length before it and `-` for a null, so no two rows read alike."""
    texts = [F.col(c).cast("string") for c in cols]
    return F.md5(F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def first_rule(source: Column, rules, default) -> Column:
    """Label of the first rule that holds; a rule is (isin | contains | rlike, argument, label)."""
    tests = {"isin": source.isin, "contains": source.contains, "rlike": source.rlike}
    chain = F
    for kind, argument, label in rules:
        chain = chain.when(tests[kind](argument), F.lit(label))
    return chain.otherwise(default)


def by_pattern(source: Column, rules, default: str) -> Column:
    """Label of the first (pattern, label) found; case is folded for accented letters as well."""
    return first_rule(source, [("rlike", f"(?iu){p}", label) for p, label in rules], F.lit(default))


def by_words(source: Column, tiers, default: str, whole_words: bool = False) -> Column:
    """Label of the first (words, label) with a word in the upper-cased text; null text gets the default."""
    text = F.upper(F.coalesce(source, F.lit("")))
    chain = F
    for words, label in tiers:
        if whole_words:
            tests = [text.rlike(rf"(?U)\b{word.strip()}\b") for word in words]
        else:
            tests = [text.contains(word) for word in words]
        chain = chain.when(reduce(lambda a, b: a | b, tests), F.lit(label))
    return chain.otherwise(F.lit(default))


def by_threshold(source: Column, tiers, default: str) -> Column:
    """Label of the first (limit, label) that the value exceeds."""
    chain = F
    for limit, label in tiers:
        chain = chain.when(source > limit, F.lit(label))
    return chain.otherwise(F.lit(default))


def by_body(body: Column, critical: str = V.PLENARY_BODY) -> Column:
    """Urgency of a vote by the body that holds it."""
    critical_label, high_label = V.ALERT_LEVELS
    return (
        F.when(body == critical, F.lit(critical_label))
        .when(body.isNotNull(), F.lit(high_label))
        .otherwise(F.lit(V.URGENCY_DEFAULT))
    )


def week_index(day: Column, base: str | Column = V.WEEK_BASE) -> Column:
    """Number of the week since `base`; the quotient is cut toward zero, as an integer cast does."""
    start = base if isinstance(base, Column) else F.lit(base).cast("date")
    return (F.datediff(day, start) / 7 + 1).cast("int")


def election_period(year: Column, month: Column) -> Column:
    chain = F
    for (first, last), label in V.ELECTION_PERIODS:
        chain = chain.when((year % 2 == 0) & month.between(first, last), F.lit(label))
    return chain.otherwise(F.lit(V.ELECTION_DEFAULT))


def truncate_middle(text: Column, limit: int = V.LOG_TEXT_LIMIT) -> Column:
    """Text over `limit` keeps its first 60 % and last 40 % around a mark with the cut length."""
    head, tail = int(limit * 0.6), int(limit * 0.4)
    mark = F.concat(
        F.lit("\n\n... [TRUNCADO "), (F.length(text) - limit).cast("string"), F.lit(" chars] ...\n\n")
    )
    return F.when(
        F.length(text) > limit, F.concat(F.substring(text, 1, head), mark, F.right(text, F.lit(tail)))
    ).otherwise(text)


def status_level(status: Column) -> Column:
    """Log level of a request; null for the silent status."""
    chain = F.when(status == V.STATUS_SILENT, F.lit(None).cast("string"))
    for code, level in V.STATUS_LEVELS.items():
        chain = chain.when(status == code, F.lit(level))
    return chain.when(status >= 500, F.lit("ERROR")).otherwise(F.lit("WARN"))


def error_kind(status: Column) -> Column:
    chain = F
    for code, label in V.ERROR_KINDS.items():
        chain = chain.when(status == code, F.lit(label))
    return chain.otherwise(F.lit(V.ERROR_DEFAULT))


def run_status(level: Column) -> Column:
    return F.when(level.isin(V.FAILED_LEVELS), F.lit("FALHA")).otherwise(F.lit("OK"))


def path_key(endpoint: Column, part: int = 3) -> Column:
    """One part of a path, counted from 1; the text before a leading slash is part 1."""
    return F.split_part(endpoint, F.lit("/"), F.lit(part))


def canonical_hash(cols) -> Column:
    """md5 of the record's JSON with its keys in order; absent values stay as nulls."""
    return F.md5(F.to_json(F.struct(*[F.col(c) for c in sorted(cols)]), {"ignoreNullFields": "false"}))
