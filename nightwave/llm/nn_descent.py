"""Approximate nearest neighbours: a neighbour graph by NN-descent, and greedy search in it.

Rows with equal vectors are one node. A first graph comes from random hyperplanes: nodes with equal signs in one of
`TREES` draws form leaves, cut into blocks of about `LEAF` nodes, and each node takes its nearest in its block. Then
NN-descent: every node's neighbours and (at most `DEGREE` of, by hash) those that it is a neighbour of meet in one row;
distances are taken where at least one of a pair is new to its list, as all others met before, and those nearer than a
node's worst neighbour enter its list. Rounds end when few lists change; nodes around which nothing is new move nothing.
A query starts from the leaves of its own signs and expands the nearest nodes of its pool, `BREADTH` at a time, until
every node of its pool of `POOL` is expanded and nothing nearer turns up.

Graph and search use single-precision vectors around the median of a sample, and double-precision products, so neither
an outlier nor an offset of the cloud costs digits; the pool is ranked by exact distances on the original vectors in the
end. Each stage moves O(nodes * DEGREE) short rows, and no group is larger than a block or four times DEGREE.
Hyperplane offsets are medians over `SAMPLE` nodes with the smallest hash; all rows are indexed. `exact=True` holds every
query against every row instead, in blocks: the exact way beside the bounds on lists and pools.

Defined cases: vectors that are null, zero or hold null or non-finite components, and rows without vec_id take no part,
neither as queries nor as candidates; vectors are held against those of their own length alone, by a graph for the
commonest length and for each of at least `LEAF` rows, else exactly; rows that share a vec_id and a vector are one row,
those that share a vec_id alone are rows of their own, each a query and a candidate (of its namesakes' results an id keeps
its nearest); equal distances go by vec_id; with fewer than k candidates all are returned; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nightwave.llm.common import map_batches, written

DEGREE, TREES, LEAF, ROUNDS, POOL, BREADTH, SAMPLE = 24, 6, 256, 5, 320, 96, 4096
EDGE = "a long, b long, d float"
FAR = 1e18  # components beyond this are cut in the graph, so that squares stay finite


def usable(rows: DataFrame) -> DataFrame:
    """vec_id, v (array<double>) and its length n, of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    fine = rows.select("vec_id", v.alias("v")).filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).filter(
        ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0))
    return fine.distinct().withColumn("n", F.size("v"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Packed vectors as a matrix."""
    packed = column.to_pylist()
    return np.frombuffer(b"".join(packed), np.float32).astype(np.float64).reshape(len(packed), -1)


def _squares(x: np.ndarray) -> np.ndarray:
    n = (x * x).sum(axis=1)
    d = np.maximum(n[:, None] + n[None] - 2 * (x @ x.T), 0)
    np.fill_diagonal(d, np.inf)
    return d


def _best(a: np.ndarray, b: np.ndarray, d: np.ndarray, k: int) -> list[pa.Array]:
    """Of the edges (a, b, d) the k nearest distinct ones of each a."""
    order = np.lexsort((b, d, a))
    a, b, d = a[order], b[order], d[order]
    first = np.ones(len(a), bool)
    first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    a, b, d = a[first], b[first], d[first]
    start = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else np.zeros(0, np.int64)
    place = np.arange(len(a)) - np.repeat(start, np.diff(np.append(start, len(a))))
    keep = place < k
    return [pa.array(a[keep]), pa.array(b[keep]), pa.array(d[keep].astype(np.float32))]


def _edges_within(groups: DataFrame, k: int) -> DataFrame:
    """Edges among the members of each row of which one is new: ids, packed, fresh, and worst (the distance from which a member needs no more)."""
    def run(batches):
        for batch in batches:
            out = [[], [], []]
            stop = np.cumsum([len(x) for x in batch["ids"]])
            ids, worst, x = batch["ids"].flatten().to_numpy(), batch["worst"].flatten().to_numpy(), _matrix(batch["packed"].flatten())
            fresh = batch["fresh"].flatten().to_numpy(zero_copy_only=False)
            for s, e in zip((0, *stop), stop):
                own, new = ids[s:e], fresh[s:e]
                d = _squares(x[s:e])
                d[~(new[:, None] | new[None])] = np.inf
                if len(own) > k:
                    near = np.argpartition(d, k - 1, axis=1)[:, :k]
                    i, j = np.repeat(np.arange(len(own)), k), near.reshape(-1)
                else:
                    i, j = np.nonzero(np.isfinite(d))
                near_enough = np.isfinite(d[i, j]) & (own[i] != own[j])
                i, j = i[near_enough], j[near_enough]
                # by differences, so that an edge has the same distance wherever it is found
                dist = ((x[s:e][i] - x[s:e][j]) ** 2).sum(axis=1).astype(np.float32)
                good = dist < worst[s:e][i]
                for to, v in zip(out, (own[i][good], own[j][good], dist[good])):
                    to.append(v)
            if out[0]:
                yield pa.RecordBatch.from_arrays(_best(*map(np.concatenate, out), k), names=["a", "b", "d"])

    return groups.select("ids", "packed", "worst", "fresh").mapInArrow(run, EDGE)


def _gathered(rows: DataFrame, *keys: str) -> DataFrame:
    x = F.collect_list(F.struct("node", "packed", "worst", "fresh"))
    return rows.groupBy(*keys).agg(x.alias("x")).select(*(F.col(f"x.{of}").alias(to) for of, to in (("node", "ids"), ("packed", "packed"), ("worst", "worst"), ("fresh", "fresh"))))


def _few(rows: DataFrame, degree: int, *by: str) -> DataFrame:
    """Of the rows (node, of) at most `degree` of each node, by hash."""
    w = Window.partitionBy("node", *by).orderBy(F.xxhash64("of", "node"), "of")
    return rows.withColumn("i", F.row_number().over(w)).filter(F.col("i") <= degree).drop("i")


class Graph:
    """points: node, packed, signs (a sign code a tree). near: node, packed, near (sorted (d, b, fresh)). members: vec_id, v, node. All are written tables."""

    def __init__(self, fine: DataFrame, degree: int = DEGREE, rounds: int = ROUNDS, seed: int = 0):
        """fine: vec_id, v of rows that take part, all of one length."""
        self.degree = degree
        unique = written(fine.groupBy("v").agg(F.lit(1)).select("v", F.monotonically_increasing_id().alias("node")), "unique")
        self.members = written(unique.join(fine.select("vec_id", "v"), "v").select("vec_id", "node", "v"), "members")
        n = unique.count()
        sample = np.array([r.v for r in unique.orderBy(F.xxhash64("v"), "node").limit(SAMPLE).select("v").collect()])  # SAMPLE rows at most
        bits = max(0, math.ceil(math.log2(max(n, 1) / LEAF)))
        self.centre = np.median(sample, axis=0) if sample.size else np.zeros(1)
        self.planes = np.random.default_rng(seed).normal(size=(TREES * bits, len(self.centre)))
        self.offsets = np.median(np.clip(sample - self.centre, -FAR, FAR) @ self.planes.T, axis=0) if sample.size else np.zeros(TREES * bits)
        self.points = written(self.coded(unique, "node"), "points")
        leaf = self.points.select("node", "packed", F.posexplode("signs").alias("tree", "code")).withColumns({"worst": F.lit(float("inf")).cast("float"), "fresh": F.lit(True)})
        sizes = leaf.groupBy("tree", "code").agg(F.ceil(F.count(F.lit(1)) / LEAF).alias("blocks"))
        blocks = leaf.join(sizes, ["tree", "code"]).withColumn("block", F.pmod(F.xxhash64("node", "tree"), "blocks"))
        self.entries = written(leaf.groupBy("tree", "code", F.pmod(F.xxhash64("node", F.lit(1)), F.lit(8)).alias("k")).agg(F.min(F.struct(F.xxhash64("node", F.lit(2)), "node")).alias("x")).select("tree", "code", F.col("x.node").alias("node")), "entries")
        found = _edges_within(_gathered(blocks, "tree", "code", "block"), degree)
        self.near = written(self._merged(found, self.points.select("node", F.array().cast("array<struct<d:float,b:bigint,fresh:boolean>>").alias("near"), "packed")), "near")
        for _ in range(rounds):
            if not self._round():
                break

    def coded(self, rows: DataFrame, key: str) -> DataFrame:
        """key, packed, signs of rows with v."""
        centre, planes, offsets = self.centre, self.planes, self.offsets

        def pack(b: pa.RecordBatch) -> list:
            v = b["v"].to_pylist()
            if not v:
                return [[], []]
            x = np.clip(np.array(v) - centre, -FAR, FAR)
            signs = (x @ planes.T > offsets).reshape(len(x), TREES, -1) if len(planes) else np.zeros((len(x), TREES, 0), bool)
            return [[row.tobytes() for row in x.astype(np.float32)], (signs @ (1 << np.arange(signs.shape[2]))).astype(np.int64).tolist()]

        return map_batches(rows.select(key, "v"), [key], {"packed": pa.binary(), "signs": pa.list_(pa.int64())}, pack)

    def _merged(self, found: DataFrame, known: DataFrame) -> DataFrame:
        """node, near, packed: the nearest of the lists known (node, near, packed) and the edges found (a, b, d); those not known before are fresh."""
        kind = "array<struct<d:float,b:bigint,fresh:boolean>>"
        edge = F.struct("d", "b", F.lit(True).alias("fresh"))
        old = F.transform("near", lambda x: F.struct(x["d"].alias("d"), x["b"].alias("b"), F.lit(False).alias("fresh")))
        rows = known.select("node", old.cast(kind).alias("old"), "packed", F.lit(None).cast("struct<d:float,b:bigint,fresh:boolean>").alias("e")).unionByName(
            found.select(F.col("a").alias("node"), F.lit(None).cast(kind).alias("old"), F.lit(None).cast("binary").alias("packed"), edge.alias("e")))
        all_ = rows.groupBy("node").agg(F.max("old").alias("old"), F.max("packed").alias("packed"), F.collect_set("e").alias("new"))
        whole = all_.select("node", "packed", F.array_sort(F.concat("old", "new")).alias("x"))  # an edge that was there comes before itself as a fresh one
        first = F.filter("x", lambda e, i: (i == 0) | (e["b"] != F.get("x", i - 1)["b"]))
        return whole.select("node", "packed", F.slice(first, 1, self.degree).alias("near"))

    def _round(self) -> bool:
        """One round of NN-descent; whether lists still change much."""
        forward = self.near.select(F.col("node").alias("centre"), F.explode("near").alias("x")).select("centre", F.col("x.b").alias("node"), F.col("x.fresh").alias("fresh"))
        backward = _few(forward.select("node", F.col("centre").alias("of"), "fresh"), self.degree, "fresh").select(F.col("node").alias("centre"), F.col("of").alias("node"), "fresh")
        own = self.near.select(F.col("node").alias("centre"), "node", F.lit(False).alias("fresh"))
        met = forward.union(backward).union(own).groupBy("centre").agg(F.collect_set(F.struct("node", "fresh")).alias("m")).filter(F.exists("m", lambda x: x["fresh"]))
        lists = met.select("centre", F.explode("m").alias("x")).select("centre", "x.node", "x.fresh")
        worst = F.when(F.size("near") < self.degree, float("inf")).otherwise(F.element_at("near", -1)["d"]).cast("float")
        found = _edges_within(_gathered(lists.join(self.near.select("node", "packed", worst.alias("worst")), "node"), "centre"), self.degree)
        self.near = written(self._merged(found, self.near), "near")
        changed = self.near.agg(F.sum(F.size(F.filter("near", lambda x: x["fresh"]))).alias("new"), F.sum(F.size("near")).alias("all")).first()
        return bool(changed.all) and changed.new > 0.005 * changed.all

    def search(self, queries: DataFrame, k: int = 10, pool: int = POOL, exclude_self: bool = True) -> DataFrame:
        """query_id, rank, vec_id, score of the k nearest found of each query (query_id, v).

        A query is one row with its pool: nodes with distances, and whether each is expanded. A step takes the links of
        the next nodes, brings their vectors to the query and merges; queries with nothing to expand stay as they are.
        """
        pool = max(pool, 2 * k)
        numbered = written(queries.select("query_id", F.col("v").alias("qv")).withColumn("q", F.monotonically_increasing_id()), "asked")
        asked = written(self.coded(numbered.select("q", F.col("qv").alias("v")), "q").withColumnRenamed("packed", "q_packed"), "queries")
        both = self.near.select("node", F.explode("near.b").alias("to"))
        back = _few(both.select(F.col("to").alias("node"), F.col("node").alias("of")), self.degree).select("node", F.col("of").alias("to"))
        links = written(both.union(back).groupBy("node").agg(F.collect_set("to").alias("to")), "links")  # twice DEGREE at most

        starts = asked.select("q", F.posexplode("signs").alias("tree", "code")).join(self.entries, ["tree", "code"]).select("q", "node")
        anywhere = self.points.orderBy(F.xxhash64("node"), "node").limit(8).select("node")  # eight rows
        fresh = starts.union(asked.select("q").crossJoin(F.broadcast(anywhere)))
        empty = F.array().cast("array<bigint>")
        state = asked.select("q", "q_packed", empty.alias("nodes"), empty.cast("array<double>").alias("d"), empty.cast("array<boolean>").alias("done"), empty.alias("now"))
        while True:
            pairs = fresh.repartition("node").groupBy("node", "q").agg(F.lit(1)).join(self.points.select("node", "packed"), "node").select("q", F.struct("node", "packed").alias("x"))
            rows = state.select("q", F.struct("q_packed", "nodes", "d", "done", "now").alias("s"), F.lit(None).cast("struct<node:bigint,packed:binary>").alias("x")).unionByName(
                pairs.select("q", F.lit(None).cast("struct<q_packed:binary,nodes:array<bigint>,d:array<double>,done:array<boolean>,now:array<bigint>>").alias("s"), "x"))
            met = rows.groupBy("q").agg(F.max_by("s", F.col("s").isNotNull()).alias("s"), F.collect_list("x").alias("x"))
            state = written(_expanded(met, pool), "pool")
            todo = state.select("q", F.explode("now").alias("node"))
            if todo.isEmpty():
                break
            fresh = todo.join(links, "node").select("q", F.explode("to").alias("node"))
        own = Window.partitionBy("node").orderBy("vec_id")
        firsts = self.members.withColumn("i", F.row_number().over(own)).filter(F.col("i") <= k + 1).drop("i")  # equal vectors beyond these lose every tie
        found = state.select("q", F.explode("nodes").alias("node"))
        return ranked(found.join(firsts, "node").join(numbered, "q").select("query_id", "qv", "vec_id", "v"), k, exclude_self)


def _expanded(met: DataFrame, pool: int) -> DataFrame:
    """The pools of queries after the vectors x (node, packed) that came to each: the nearest `pool` nodes, and in now the next `BREADTH` to expand."""
    kind = "q long, q_packed binary, nodes array<long>, d array<double>, done array<boolean>, now array<long>"

    def run(batches):
        for batch in batches:
            out = []
            for q, s, x in zip(batch["q"].to_pylist(), batch["s"].to_pylist(), batch["x"].to_pylist()):
                nodes, d, done = (np.array(s[n], t) for n, t in (("nodes", np.int64), ("d", np.float64), ("done", bool)))
                done |= np.isin(nodes, np.array(s["now"], np.int64))
                if x:
                    own = np.frombuffer(s["q_packed"], np.float32).astype(np.float64)
                    ids = np.array([r["node"] for r in x], np.int64)
                    new = ~np.isin(ids, nodes)
                    v = np.frombuffer(b"".join(r["packed"] for r in x), np.float32).astype(np.float64).reshape(len(x), -1)[new]
                    nodes, d, done = np.concatenate([nodes, ids[new]]), np.concatenate([d, ((v - own) ** 2).sum(axis=1)]), np.concatenate([done, np.zeros(int(new.sum()), bool)])
                order = np.lexsort((nodes, d))[:pool]
                nodes, d, done = nodes[order], d[order], done[order]
                out.append((q, s["q_packed"], nodes.tolist(), d.tolist(), done.tolist(), nodes[~done][:BREADTH].tolist()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.bool_()), pa.list_(pa.int64())))], names=["q", "q_packed", "nodes", "d", "done", "now"])

    return met.select("q", "s", "x").mapInArrow(run, kind)


def ranked(pairs: DataFrame, k: int, exclude_self: bool = True) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest of each query's candidates (query_id, qv, vec_id, v), by exact distances."""
    if exclude_self:
        pairs = pairs.filter("vec_id != query_id")
    score = F.sqrt(F.aggregate(F.zip_with("v", "qv", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    near = pairs.select("query_id", "vec_id", score.alias("score")).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def exact_neighbours(fine: DataFrame, queries: DataFrame, k: int = 10, exclude_self: bool = True, block: int = 4096) -> DataFrame:
    """What `Graph.search` looks for, by brute force: queries (query_id, v, n) against all rows (vec_id, v, n) of their length.

    Rows are in blocks of about `block`, queries in blocks of 64; each pair of blocks gives the k nearest of its queries, with room for ties.
    """
    blocks = max(1, math.ceil(fine.count() / block))
    at = lambda c, m: F.pmod(F.xxhash64(c, F.lit(3)), F.lit(m))
    left = fine.groupBy("n", at("vec_id", blocks).alias("block")).agg(F.collect_list(F.struct("vec_id", "v")).alias("x"))
    parts = max(1, math.ceil(queries.count() / 64))
    right = (queries.groupBy("n", at("query_id", parts).alias("part")).agg(F.collect_list(F.struct("query_id", "v")).alias("y"))
             .withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint")))))
    more = k + 11

    def run(batches):
        for b in batches:
            for x, y in zip(b["x"].to_pylist(), b["y"].to_pylist()):
                ids, v = np.array([r["vec_id"] for r in x]), np.array([r["v"] for r in x])
                for q in y:
                    with np.errstate(over="ignore"):
                        d = ((v - np.array(q["v"])) ** 2).sum(axis=1)
                    near = np.lexsort((ids, d))[:more]
                    yield pa.RecordBatch.from_pydict({"query_id": [q["query_id"]] * len(near), "qv": [q["v"]] * len(near), "vec_id": ids[near], "v": v[near].tolist()})

    kinds = {f.name: f.dataType.simpleString() for f in (*fine.schema.fields, *queries.schema.fields)}
    pairs = left.hint("merge").join(right, ["n", "block"]).select("x", "y").mapInArrow(run, f"query_id {kinds['query_id']}, qv array<double>, vec_id {kinds['vec_id']}, v array<double>")
    return ranked(pairs, k, exclude_self)


def nearest_neighbours(rows: DataFrame, k: int = 10, every: int = 100, exact: bool = False, **settings) -> DataFrame:
    """The k nearest other rows of each row whose vec_id is divisible by `every`, among all rows of (vec_id, embedding) of its length."""
    fine = written(usable(rows), "vectors")
    asked = fine.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "v", "n")
    if exact:
        return exact_neighbours(fine, asked, k)
    sizes = [(r["count"], r.n) for r in fine.groupBy("n").count().orderBy(F.desc("count"), "n").collect()]  # a row a length
    by_graph = [n for i, (count, n) in enumerate(sizes) if i == 0 or count >= LEAF]
    out = None
    for n in by_graph:
        found = Graph(fine.filter(F.col("n") == n).select("vec_id", "v"), **settings).search(asked.filter(F.col("n") == n).select("query_id", "v"), k)
        out = found if out is None else out.unionByName(found)
    if len(by_graph) < len(sizes):
        few = lambda df: df.filter(~F.col("n").isin(by_graph))
        out = out.unionByName(exact_neighbours(few(fine), few(asked), k))
    return out if out is not None else exact_neighbours(fine, asked, k)
