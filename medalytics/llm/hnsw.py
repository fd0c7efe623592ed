"""Near copies among vectors: small-world graphs per shard, queried by beams that audits widen."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components, local_stars
from .shared import stage
from .vectors import block, matrix, spread, usable

LINKS = 16
CANDIDATES = 48
#: A query with so many links in a shard lies in a crowd, where its links are counted by exact comparison.
CROWD = 256
SLACK = 1e-4  # float32 scores within this of the threshold are decided in double


class Graph:
    """A hierarchical navigable small-world graph over unit vectors, built in rounds of doubling size.

    The order and the levels of the nodes come from their ids. In every round the new nodes are linked to
    diverse near ones among all nodes so far, so early nodes keep long links and late ones short links.
    """

    def __init__(self, ids: np.ndarray, unit: np.ndarray):
        mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        order = np.argsort(mixed, kind="stable")
        self.ids, self.unit = ids[order], np.ascontiguousarray(unit[order], np.float32)
        draw = (((mixed[order] * np.uint64(0x94D049BB133111EB)) >> np.uint64(11)).astype(np.float64) + 1) / (1 << 53)
        levels = (-np.log(draw) / np.log(LINKS)).astype(int)
        self.layers, level = [], 0
        while True:
            members = np.flatnonzero(levels >= level)
            self.layers.append(self._link(members))
            if len(members) <= LINKS or not (levels > level).any():
                self.entry = members[0]
                break
            level += 1

    def _link(self, members):
        """Neighbours in both directions as (first index, neighbours) over all nodes."""
        done, sources, targets = 1, [], []
        while done < len(members):
            stop = min(len(members), 2 * done)
            pool = members[:stop]
            for at in range(done, stop, 512):
                fresh = members[at : min(at + 512, stop)]
                score = self.unit[fresh] @ self.unit[pool].T
                score[np.arange(len(fresh)), np.arange(at, at + len(fresh))] = -np.inf
                k = min(CANDIDATES, stop - 1)
                near = np.argpartition(-score, k - 1, axis=1)[:, :k]
                near = np.take_along_axis(near, np.argsort(-np.take_along_axis(score, near, 1), axis=1), 1)
                chosen = self._diverse(pool[near], np.take_along_axis(score, near, 1))
                i, j = np.nonzero(chosen)
                sources.append(fresh[i])
                targets.append(pool[near[i, j]])
            done = stop
        if not sources:
            return np.zeros(len(self.ids) + 1, np.int64), np.zeros(0, np.int64)
        a, b = np.concatenate(sources), np.concatenate(targets)
        n = len(self.ids)
        both = np.unique(np.r_[a * n + b, b * n + a])
        return np.searchsorted(both // n, np.arange(n + 1)), both % n

    def _diverse(self, near, score):
        """Mark candidates that are nearer to the node than to any marked before, then fill up with the nearest."""
        among = self.unit[near]
        chosen = np.zeros(near.shape, bool)
        closest = np.full(near.shape, -np.inf, np.float32)  # to a marked one
        count = np.zeros(len(near), int)
        for c in range(near.shape[1]):
            take = (score[:, c] > closest[:, c]) & (count < LINKS)
            chosen[:, c] = take
            count += take
            to_it = np.einsum("ikd,id->ik", among, among[:, c])
            closest = np.where(take[:, None], np.maximum(closest, to_it), closest)
        for c in range(near.shape[1]):
            fill = ~chosen[:, c] & (count < LINKS // 2)
            chosen[:, c] |= fill
            count += fill
        return chosen

    def _around(self, layer, nodes):
        first, neighbours = self.layers[layer]
        degree = first[nodes + 1] - first[nodes]
        of = np.repeat(np.arange(len(nodes)), degree)
        within = np.arange(len(of)) - np.repeat(np.cumsum(degree) - degree, degree)
        return of, neighbours[np.repeat(first[nodes], degree) + within]

    def search(self, queries: np.ndarray, beam: int):
        """Of each query the up to `beam` best nodes found, as (query, node, score) by query and falling score."""
        n, count = len(self.ids), len(queries)
        at = np.full(count, self.entry)
        best = queries @ self.unit[self.entry]
        for layer in range(len(self.layers) - 1, 0, -1):
            moving = np.arange(count)
            while len(moving):
                of, node = self._around(layer, at[moving])
                score = np.einsum("id,id->i", queries[moving[of]], self.unit[node])
                top = np.lexsort((-score, of))
                first = top[np.r_[True, of[top][1:] != of[top][:-1]]] if len(top) else top
                who, better = moving[of[first]], score[first] > best[moving[of[first]]]
                who, first = who[better], first[better]
                at[who], best[who] = node[first], score[first]
                moving = who
        query, node, score = np.arange(count), at, best
        open_ = np.ones(count, bool)
        seen = np.zeros(count * n, bool)
        seen[query * n + node] = True
        wide = max(4, beam // 8)
        while True:
            waiting = np.flatnonzero(open_)
            if not len(waiting):
                return query, node, score
            rank = np.arange(len(waiting)) - np.searchsorted(query[waiting], query[waiting])
            expand = waiting[rank < wide]
            open_[expand] = False
            of, around = self._around(0, node[expand])
            key = query[expand][of] * n + around
            key = np.unique(key[~seen[key]])
            seen[key] = True
            q, v = key // n, key % n
            query, node = np.r_[query, q], np.r_[node, v]
            score = np.r_[score, np.einsum("id,id->i", queries[q], self.unit[v])]
            open_ = np.r_[open_, np.ones(len(q), bool)]
            order = np.lexsort((-score, query))
            query, node, score, open_ = query[order], node[order], score[order], open_[order]
            keep = np.arange(len(query)) - np.searchsorted(query, query) < beam
            query, node, score, open_ = query[keep], node[keep], score[keep], open_[keep]

    def links(self, queries: np.ndarray, threshold: float, beam: int, at_once: int = 256):
        """(query, node, exact) of all found at or over the threshold; `exact` says which queries were compared with every node.

        Beams full of such nodes are doubled, up to CROWD; a query with more of them lies in a crowd and is
        compared with every node in matrix products.
        """
        found, todo, exact = [], np.arange(len(queries)), np.zeros(len(queries), bool)
        while len(todo) and beam <= CROWD:
            again = []
            for at in range(0, len(todo), at_once):
                some = todo[at : at + at_once]
                query, node, score = self.search(queries[some], beam)
                near = score >= threshold
                full = np.bincount(query[near], minlength=len(some)) >= beam
                near &= ~full[query]
                found.append((some[query[near]], node[near]))
                again.append(some[full])
            todo, beam = np.concatenate(again), beam * 2
        exact[todo] = True
        found.append(self.scan(queries, todo, threshold))
        return *(np.concatenate(x) for x in zip(*found)), exact

    def scan(self, queries: np.ndarray, some: np.ndarray, threshold: float, at_once: int = 512):
        """(query, node) at or over the threshold of some queries, each compared with every node."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for at in range(0, len(some), at_once):
            i, j = np.nonzero(queries[some[at : at + at_once]] @ self.unit.T >= threshold)
            found.append((some[at : at + at_once][i], j))
        return tuple(np.concatenate(x) for x in zip(*found))


def audited_links(graph: Graph, queries: np.ndarray, threshold: float, beam: int = 64, audit: int = 256, recall: float = 0.999):
    """Links of all queries and which were compared exactly, with a beam wide enough for an audit by brute force.

    The audit takes evenly spaced queries and looks at each by itself, so that the many links of a crowd cannot
    cover those that others miss: every one must find all its links, and on average `recall` of its ten nearest.
    A graph that fails with a beam of CROWD is compared exactly.
    """
    queries = queries.astype(np.float32)
    some = queries[np.linspace(0, len(queries) - 1, min(audit, len(queries))).astype(int)]
    truth = some @ graph.unit.T
    k = min(10, truth.shape[1])
    tenth = np.partition(truth, -k, axis=1)[:, -k]
    wanted = (truth >= threshold + 1e-6).sum(axis=1)
    while beam <= CROWD:
        query, _, score = graph.search(some, beam)
        nearest = np.minimum(np.bincount(query[score >= tenth[query] - 1e-6], minlength=len(some)), k) / k
        i, j, _ = graph.links(some, threshold, beam)
        linked = np.bincount(i[truth[i, j] >= threshold + 1e-6], minlength=len(some))
        if nearest.mean() >= recall and (linked >= wanted).all():
            return graph.links(queries, threshold, beam)
        beam *= 2
    every = np.arange(len(queries))
    return *graph.scan(queries, every, threshold), np.ones(len(queries), bool)


def unit_rows(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1)[:, None]
    return rows / np.linalg.norm(rows, axis=1)[:, None]


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", threshold: float = 0.93, shard_rows: int = 16384, block_rows: int = 131072) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of `vectors`.

    Two vectors of one label are linked if they are found with a cosine of at least `threshold` in double
    precision. Rows with a null label or id, and vectors that are null, empty, zero or hold null or
    non-finite numbers, link with nothing (component: their own id; a null id: null and not kept). Vectors
    of another length are not compared. Repeated rows of one id and vector count once. Equal vectors are one
    node of the graphs whatever their number, and link with each other. Other columns are not read.

    Every label is dealt into shards of about `shard_rows`; each has one graph, stored once, past which all
    vectors of the label stream in blocks of about `block_rows`. A link that is found from either end counts
    for both: outside crowds the pairs themselves are written and told apart, at most CROWD for a vector and
    shard; in a crowd a vector is compared with the whole shard and only counted, and so are those it is
    linked to. Components get a star per group, not the links.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"), F.col(label_col).alias("label"))
    takes_part = usable(F.col("vec")) & F.col("label").isNotNull() & F.col("id").isNotNull()
    live = rows.filter(takes_part)
    nodes = live.groupBy("label", "vec").agg(F.min("id").alias("least"), F.countDistinct("id").alias("copies"))
    nodes = stage(nodes.select("*", F.size("vec").alias("dim"), F.monotonically_increasing_id().alias("node")), "nodes")
    sizes = nodes.groupBy("label", "dim").agg(
        F.ceil(F.count(F.lit(1)) / shard_rows).cast("int").alias("shards"), F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks")
    )
    sizes = stage(sizes, "sizes")
    placed = nodes.join(sizes, ["label", "dim"]).select(
        "label", "dim", "shards", "blocks", "node", "vec", "copies", block("node", F.col("shards"), 1).alias("home"), block("node", F.col("blocks"), 2).alias("block")
    )
    placed = stage(placed, "placed")

    graph_schema = placed.select("label", "dim", F.col("home").alias("shard")).schema
    for name in ("ids", "exact", "copies"):
        graph_schema = graph_schema.add(name, "binary")
    graph_schema = graph_schema.add("layers", T.ArrayType(T.BinaryType())).add("entry", "long")
    graphs = stage(placed.withColumnRenamed("home", "shard").groupBy("label", "dim", "shard").applyInArrow(_built, graph_schema), "graphs")

    asks = spread(placed.drop("blocks"), "shard", F.col("shards")).drop("shards")
    found = stage(_past_graphs(asks, graphs, sizes, lambda *a: _linked(*a, threshold), FOUND), "found")

    # vectors that a crowd has reached from another shard are compared with the whole of that shard as well
    marks = found.filter("kind = 'mark'").select(F.col("node").alias("marked"), F.col("shard").alias("at"))
    sure = found.filter("kind = 'count'").select("node", "shard", "links")
    marks = marks.distinct().join(sure, (F.col("marked") == F.col("node")) & (F.col("at") == F.col("shard")), "left_anti")
    marks = stage(marks, "marks")
    again = placed.drop("blocks", "shards").join(marks, F.col("node") == F.col("marked")).withColumnRenamed("at", "shard").drop("marked")
    more = stage(_past_graphs(again, graphs, sizes, lambda *a: _counted(*a, threshold), FOUND), "found-again")
    sure = sure.union(more.filter("kind = 'count'").select("node", "shard", "links"))

    pairs = found.filter("kind = 'pair'")
    one = pairs.select("node", "shard", "other", F.col("links").alias("copies"))
    two = pairs.select(F.col("other").alias("node"), F.col("home").alias("shard"), F.col("node").alias("other"), F.col("copies"))
    either = one.union(two).dropDuplicates(["node", "other"]).join(sure.select("node", "shard"), ["node", "shard"], "left_anti")
    counts = either.select("node", F.col("copies").alias("links")).union(sure.select("node", "links")).groupBy("node").agg(F.sum("links").alias("links"))
    stars = found.filter("kind = 'star'").union(more.filter("kind = 'star'")).select(F.col("node").alias("a"), F.col("other").alias("b"))
    parts = components(stars).select("node", "component")
    whole = nodes.join(counts, "node", "left").join(parts, "node", "left")
    whole = whole.select("label", "vec", "least", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "node").alias("part"))
    whole = stage(whole, "vector-parts")
    names = stage(whole.groupBy("part").agg(F.min("least").alias("name")), "vector-names")
    named = stage(whole.join(names, "part").select("label", "vec", (F.col("links") + F.col("copies") - 1).alias("links"), "name"), "named-vectors")
    linked = live.join(named, ["label", "vec"]).select("id", "links", "name")
    alone = rows.filter(~takes_part).select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("name"))
    return linked.union(alone).select(
        F.col("id").alias("vec_id"), F.col("links").alias("n_links"), F.col("name").alias("component_id"), F.coalesce(F.col("id") == F.col("name"), F.lit(False)).alias("kept")
    )


#: What a block finds in a shard. pair: node and other are linked, with the homes and copies of both (`links` of other).
#: count: all links of node in the shard. mark: node must be compared with all of the shard. star: both are of one component.
FOUND = "kind string, node long, shard int, home int, copies long, other long, links long"


def _rows(kind, node, shard, home=0, copies=0, other=0, links=0):
    n = len(node)

    def full(x, t):
        return pa.array(np.broadcast_to(np.asarray(x), n).astype(t))

    arrays = [pa.array([kind] * n, pa.string()), full(node, np.int64), full(shard, np.int32), full(home, np.int32)]
    arrays += [full(copies, np.int64), full(other, np.int64), full(links, np.int64)]
    return pa.RecordBatch.from_arrays(arrays, ["kind", "node", "shard", "home", "copies", "other", "links"])


def _built(key, table):
    """The graph of a shard as one row."""
    ids = table.column("node").to_numpy()
    rows = unit_rows(matrix(table.column("vec")))
    graph = Graph(ids, rows)
    place = np.argsort(ids)[np.searchsorted(np.sort(ids), graph.ids)]
    layers = [part for first, near in graph.layers for part in (first.tobytes(), near.astype(np.int32).tobytes())]
    found = {
        "label": pa.array([key[0].as_py()], key[0].type),
        "dim": pa.array([key[1].as_py()], pa.int32()),
        "shard": pa.array([key[2].as_py()], pa.int32()),
        "ids": pa.array([graph.ids.tobytes()], pa.binary()),
        "exact": pa.array([rows[place].tobytes()], pa.binary()),
        "copies": pa.array([table.column("copies").to_numpy()[place].tobytes()], pa.binary()),
        "layers": pa.array([layers], pa.list_(pa.binary())),
        "entry": pa.array([int(graph.entry)], pa.int64()),
    }
    return pa.table(found)


def _past_graphs(asks, graphs, sizes, answer, schema):
    """`answer(graph, exact, copies, shard, batch)` for every batch of `asks` and the graph of its shard, which comes before the batch."""
    keys = ["label", "dim", "shard", "block"]
    parts = ["ids", "exact", "copies", "layers", "entry"]
    wanted = asks.select(*keys).distinct()
    meets = graphs.join(wanted, ["label", "dim", "shard"]).select(*keys, F.struct(*parts).alias("graph"))
    queries = asks.select(*keys, F.struct("node", "vec", F.col("copies").alias("n"), "home").alias("ask"))
    both = meets.unionByName(queries, allowMissingColumns=True).repartition(*keys).sortWithinPartitions(*keys, F.col("graph").isNull())

    def stream(batches):
        loaded = None
        for batch in batches:
            graph_column, asked = batch.column("graph"), batch.column("ask")
            heads = np.flatnonzero(np.array(graph_column.is_valid()))
            edges = [0, *heads.tolist(), batch.num_rows] if not len(heads) or heads[0] else [*heads.tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:]):
                if graph_column[a].is_valid:
                    loaded = (*_loaded(graph_column[a].as_py()), batch.column("shard")[a].as_py())
                    a += 1
                for at in range(a, b, 8192):
                    yield from answer(*loaded, pa.RecordBatch.from_struct_array(asked.slice(at, min(8192, b - at))))

    return both.mapInArrow(stream, schema)


def _linked(graph, exact, copies, shard, asked, threshold):
    """What a batch of vectors finds in a shard: pairs outside crowds, counts and marks in them, stars."""
    ids, rows = asked.column("node").to_numpy(), unit_rows(matrix(asked.column("vec")))
    home, own = asked.column("home").to_numpy(), asked.column("n").to_numpy()
    i, j, crowded = audited_links(graph, rows, threshold - SLACK)
    same = (np.einsum("id,id->i", rows[i], exact[j]) >= threshold) & (ids[i] != graph.ids[j])
    i, j = i[same], j[same]
    links = np.bincount(i, weights=copies[j], minlength=len(ids)).astype(np.int64)
    crowd = np.flatnonzero(crowded)
    yield _rows("count", ids[crowd], shard, links=links[crowd])
    reached = np.unique(np.stack([graph.ids[j[crowded[i]]], home[i[crowded[i]]].astype(np.int64)], 1), axis=0)
    yield _rows("mark", reached[:, 0], reached[:, 1])
    p, q = i[~crowded[i]], j[~crowded[i]]
    yield _rows("pair", ids[p], shard, home[p], own[p], graph.ids[q], copies[q])
    a, b = local_stars(ids[i], graph.ids[j])
    yield _rows("star", a, shard, other=b)


def _counted(graph, exact, copies, shard, asked, threshold):
    """All links of a batch of vectors in a shard, by comparison with every node."""
    ids, rows = asked.column("node").to_numpy(), unit_rows(matrix(asked.column("vec")))
    i, j = graph.scan(rows.astype(np.float32), np.arange(len(ids)), threshold - SLACK)
    same = (np.einsum("id,id->i", rows[i], exact[j]) >= threshold) & (ids[i] != graph.ids[j])
    i, j = i[same], j[same]
    yield _rows("count", ids, shard, links=np.bincount(i, weights=copies[j], minlength=len(ids)).astype(np.int64))
    a, b = local_stars(ids[i], graph.ids[j])
    yield _rows("star", a, shard, other=b)


def _loaded(row):
    graph = Graph.__new__(Graph)
    graph.ids = np.frombuffer(row["ids"], np.int64)
    exact = np.frombuffer(row["exact"], np.float64).reshape(len(graph.ids), -1)
    graph.unit, graph.entry = exact.astype(np.float32), row["entry"]
    parts = iter(row["layers"])
    graph.layers = [(np.frombuffer(first, np.int64), np.frombuffer(near, np.int32).astype(np.int64)) for first, near in zip(parts, parts)]
    return graph, exact, np.frombuffer(row["copies"], np.int64)
