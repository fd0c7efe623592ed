"""Nearest neighbours and near vectors by brute force."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import cases
from medalytics.llm import ann, hnsw
from medalytics.llm.vectors import usable


def vectors(spark, seed=0, n=400, dim=12):
    draw = np.random.default_rng(seed)
    base = draw.normal(size=(n, dim))
    base[n // 2 :] = base[draw.integers(0, 8, n - n // 2)] + 0.05 * draw.normal(size=(n - n // 2, dim))
    base[-20:] = base[0]
    rows = [(i, [float(np.float32(x)) for x in v], i % 3, "clash") for i, v in enumerate(base)]
    rows += [(1000, None, 1, None), (1020, [0.0] * dim, 1, "x"), (1040, [None] + [1.0] * (dim - 1), 1, "x"), (1060, [float("nan")] * dim, 1, "x")]
    rows += [(1080, [float("inf")] + [1.0] * (dim - 1), 1, "x"), (1100, [], 1, "x"), (1120, [1.0, 2.0], 1, "x"), (None, rows[0][1], 0, "x"), (1140, rows[0][1], None, "x")]
    rows += [rows[5], rows[20]]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, id string")


def product(x, y):
    total = 0.0
    for a, b in zip(x.tolist(), y.tolist()):
        total += a * b
    return total


def good(rows):
    keep = {}
    for r in rows:
        v = r.embedding
        if r.vec_id is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            keep[r.vec_id] = (np.array(v, np.float64), r.label)
    return keep


@pytest.mark.parametrize("sizes", [(4096, 8192), (5, 60)])
def test_search(spark, sizes):
    df = vectors(spark)
    keep = good(df.collect())
    want = []
    for q, (x, _) in keep.items():
        if q % 20 == 0:
            scored = sorted((-product(x, y), v) for v, (y, _) in keep.items() if v != q and len(y) == len(x))
            want += [(q, r + 1, v, -s) for r, (s, v) in enumerate(scored[:20])]
    got = ann.search(df, lambda i: i % 20 == 0, query_rows=sizes[0], candidate_rows=sizes[1])
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_search_few_and_none(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.1])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r.rank, r.vec_id) for r in ann.search(few, lambda i: i % 20 == 0).orderBy("rank").collect()] == [(0, 1, 1), (0, 2, 2)]
    assert ann.search(few.filter("false"), lambda i: i % 20 == 0).count() == 0


def test_bounds_hold():
    draw = np.random.default_rng(4)
    a, b = draw.normal(size=(50, 30)) * draw.lognormal(size=(50, 1)) * 3, draw.normal(size=(60, 30))
    (qa, sa, na, ra), (qb, sb, nb, rb) = ann.quantised(a), ann.quantised(b)
    near = (qa.astype(float) @ qb.astype(float).T) * sa[:, None] * sb
    assert (np.abs(near - a @ b.T) <= na[:, None] * rb + ra[:, None] * nb + ra[:, None] * rb + 1e-12).all()


@pytest.mark.parametrize("sizes", [(16384, 2048), (60, 30)])
def test_near_vectors(spark, sizes):
    df = vectors(spark, seed=1)
    rows = df.collect()
    keep = good(rows)
    labelled = {i: (v / np.linalg.norm(v), lab) for i, (v, lab) in keep.items() if lab is not None}

    def linked(a, b):
        if a not in labelled or b not in labelled or labelled[a][1] != labelled[b][1] or len(labelled[a][0]) != len(labelled[b][0]):
            return False
        return float(labelled[a][0] @ labelled[b][0]) >= 0.93

    ids = sorted({r.vec_id for r in rows if r.vec_id is not None})
    part = cases.groups(ids, linked)
    count = {a: sum(linked(a, b) for b in ids if b != a) for a in ids}
    want = sorted([(r.vec_id, count.get(r.vec_id, 0), part.get(r.vec_id), r.vec_id is not None and part[r.vec_id] == r.vec_id) for r in rows], key=repr)
    got = hnsw.near_vectors(df, shard_rows=sizes[0], block_rows=sizes[1])
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert sum(count.values()) > 1000
    assert hnsw.near_vectors(df.filter("false")).count() == 0


def test_graph_recall_and_exact_way():
    draw = np.random.default_rng(2)
    unit = hnsw.unit_rows(draw.normal(size=(3000, 32)))
    graph = hnsw.Graph(np.arange(3000), unit)
    query, node, score = graph.search(unit[:200].astype(np.float32), 64)
    truth = np.argsort(-(unit[:200] @ unit.T), axis=1)[:, :10]
    hits = sum(len(set(graph.ids[node[query == i]]) & set(truth[i])) for i in range(200))
    assert hits >= 0.9 * 2000
    for layer in range(len(graph.layers)):  # no links: every audit fails
        graph.layers[layer] = (np.zeros(3001, np.int64), np.zeros(0, np.int64))
    i, j, exact = hnsw.audited_links(graph, unit[:50], 0.3)
    assert len(i) == (unit[:50].astype(np.float32) @ graph.unit.T >= 0.3).sum() and exact.all()


def pairs_and_a_cluster(n_cluster, n_pairs, dim=32):
    """Nearly equal vectors, and lone pairs at a cosine of 0.945; no other two are near."""
    draw = np.random.default_rng(6)
    unit = hnsw.unit_rows(draw.normal(size=(n_pairs + 1, dim)))
    other = hnsw.unit_rows(draw.normal(size=(n_pairs, dim)))
    other = hnsw.unit_rows(other - (other * unit[1:]).sum(axis=1)[:, None] * unit[1:])
    mates = 0.945 * unit[1:] + np.sqrt(1 - 0.945**2) * other
    cluster = unit[:1] + draw.normal(size=(n_cluster, dim)) * 1e-4
    return np.concatenate([cluster, unit[1:], mates])


@pytest.mark.parametrize("shard_rows, block_rows", [(16384, 131072), (900, 700)])
def test_links_of_lone_pairs_beside_a_cluster(spark, shard_rows, block_rows):
    rows = pairs_and_a_cluster(3000, 1500)
    ids = np.random.default_rng(1).permutation(len(rows))
    data = [(int(i), r.tolist(), 1) for i, r in zip(ids, rows)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int").repartition(8)
    got = {r.vec_id: r for r in hnsw.near_vectors(df, shard_rows=shard_rows, block_rows=block_rows).collect()}
    unit = hnsw.unit_rows(rows)
    score = unit @ unit.T >= 0.93
    np.fill_diagonal(score, False)
    assert [got[int(i)].n_links for i in ids] == score.sum(axis=1).tolist()
    for a, b in ((3000 + k, 4500 + k) for k in range(1500)):
        assert got[int(ids[a])].component_id == got[int(ids[b])].component_id == min(ids[a], ids[b])
    assert {got[int(i)].component_id for i in ids[:3000]} == {int(ids[:3000].min())}


def test_a_crowd_counts_for_those_it_reaches():
    """A query that is compared exactly marks its neighbours for the shard it lies in."""
    rows = pairs_and_a_cluster(400, 10)
    graph = hnsw.Graph(np.arange(len(rows)), hnsw.unit_rows(rows))
    i, j, exact = graph.links(hnsw.unit_rows(rows).astype(np.float32), 0.93, 64)
    assert exact[:400].all() and not exact[400:].any()
    assert len(i) == (graph.unit @ graph.unit.T >= 0.93).sum()
    asked = pa.RecordBatch.from_pydict({"node": list(range(400, 402)), "vec": rows[[0, 400]].tolist(), "n": [1, 1], "home": [7, 8]})
    found = [b for b in hnsw._linked(graph, hnsw.unit_rows(rows)[graph.ids], np.ones(len(rows), np.int64), 3, asked, 0.93)]
    kinds = {b.column("kind")[0].as_py(): b for b in found if b.num_rows}
    assert set(kinds) == {"count", "mark", "pair", "star"}
    assert set(kinds["mark"].column("shard").to_pylist()) == {7} and kinds["mark"].num_rows == 400
    assert kinds["pair"].to_pylist()[0] | {"kind": "", "links": 1} == {"kind": "", "node": 401, "shard": 3, "home": 8, "copies": 1, "other": kinds["pair"].to_pylist()[0]["other"], "links": 1}


def test_usable(spark):
    rows = [([1.0, 2.0],), (None,), ([],), ([0.0, 0.0],), ([None, 1.0],), ([float("nan")],), ([float("-inf")],)]
    assert [r[0] for r in spark.createDataFrame(rows, "v array<double>").select(usable(F.col("v"))).collect()] == [True] + [False] * 6
