"""Compare a query with its SQL: same columns, same rows whatever their order."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return value + 0.0
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    found = [tuple(plain(r[i]) for i in order) for r in data]
    return sorted(names), sorted(found, key=repr)


def compare(df, con, sql):
    got_names, got = rows(df.columns, [tuple(r) for r in df.collect()])
    relation = con.sql(sql)
    want_names, want = rows(relation.columns, relation.fetchall())
    assert got_names == want_names
    assert len(got) == len(want), f"{len(got)} rows, expected {len(want)}"
    assert got, "no rows"
    for mine, theirs in zip(got, want):
        assert mine == theirs, f"{dict(zip(got_names, mine))} expected {dict(zip(got_names, theirs))}"
    return len(got)
