"""Merkle manifest of a dataset: a tree of documents per source, a tree of the sources' roots, and a proof of each document.

Leaves are numbered by a range sort and dealt out in aligned blocks of `fanout ** depth`. A block hashes its own subtree;
then blocks swap subtree roots in a butterfly: in round t each block sends the root it has reached to one block of each
other subtree of its group, so that all of them hash the same ancestor, each for itself, and hold their upper proof when
the last round ends. Nothing goes back down. A round is one exchange of a row a block and partner. Where a subtree is short,
its blocks send to several partners.

Defined cases: null fields are `-`, and a null source is a tree of its own, the first; null doc_ids come first in their
source and are not tampered with; rows with one doc_id are ordered by leaf, whole repeated rows stay rows of their own; an
empty table gives an empty result; other columns play no part, whatever their names.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nightwave.llm.common import written

FANOUT, DEPTH = 3, 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_ALL = "_all"
_PATH = "array<struct<left:string,right:string>>"


def H(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(**changed: Column) -> Column:
    """The digest of a row's fields, some of them in another form."""
    field = lambda x: F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-"))
    return F.sha2(F.concat(*[field(changed.get(c, F.col(c)).cast("string")) for c in FIELDS]), 256)


def tampered_text() -> Column:
    """The text without line feeds where two divides the checksum of the doc_id."""
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def numbered(rows: DataFrame, by: str, order: list[str]) -> DataFrame:
    """rows, a written table, with tree (a number of each value of `by`, in its order), idx (place in the tree, from 0) and n (rows of the tree).

    Rows are range-sorted by all of the order, so that no value of `by` is one task; only a row a task and value is counted up.
    """
    key = [by, *order]
    rows = written(rows.repartitionByRange(*key).sortWithinPartitions(*key).withColumn("_seq", F.monotonically_increasing_id()), "sorted")
    part, place = F.shiftright("_seq", 33), F.col("_seq").bitwiseAND((1 << 33) - 1)
    w = Window.partitionBy(by).orderBy("_part")
    held = rows.groupBy(by, part.alias("_part")).agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_c"))
    held = held.select(by, "_part", "_first", (F.sum("_c").over(w) - F.col("_c")).alias("_before"), F.sum("_c").over(Window.partitionBy(by)).alias("n"))
    if by == _ALL:
        held = held.withColumn("tree", F.lit(0).cast("long"))
    else:
        names = held.select(by).distinct().withColumn(_ALL, F.lit(0))
        trees = numbered(written(names, "names"), _ALL, [by]).select(F.col(by).alias("_name"), F.col("idx").alias("tree"))
        held = held.join(trees, F.col(by).eqNullSafe(F.col("_name")))
    held = held.select(F.col(by).alias("_by"), F.col("_part").alias("_p"), "_first", "_before", "n", "tree")
    joined = rows.join(held, rows[by].eqNullSafe(held["_by"]) & (part == F.col("_p")))
    return joined.withColumn("idx", place - F.col("_first") + F.col("_before")).drop("_seq", "_by", "_p", "_first", "_before")


def _levels(digests: list[str], n: int, depth: int, fanout: int):
    """Of each level of a block's subtree, the (left, right) siblings of its nodes; and the subtree's root."""
    out = []
    while n > 1 and len(out) < depth:
        runs = [digests[k:k + fanout] for k in range(0, len(digests), fanout)]
        out.append([("".join(r[:k]), "".join(r[k + 1:])) for r in runs for k in range(len(r))])
        digests, n = [H(*r) for r in runs], -(-n // fanout)
    return out, digests[0]


def block_roots(nodes: DataFrame, depth: int, fanout: int) -> DataFrame:
    """tree, block, last (number of the tree's last block), digest of each block of nodes (tree, block, idx, n, digest)."""
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("idx")
        n = t["n"][0].as_py()
        return pa.table({"tree": t["tree"][:1], "block": t["block"][:1], "last": pa.array([(n - 1) // fanout ** depth]), "digest": [_levels(t["digest"].to_pylist(), n, depth, fanout)[1]]})

    return nodes.select("tree", "block", "idx", "n", "digest").groupBy("tree", "block").applyInArrow(run, "tree long, block long, last long, digest string")


def _round(state: DataFrame, unit: int, fanout: int) -> DataFrame:
    """One exchange: subtrees of `unit` blocks become subtrees of fanout times as many."""
    block, last = F.col("block"), F.col("last")
    own, nodes = F.floor(block / unit), F.floor(last / unit) + 1
    length = lambda u: F.least(F.lit(unit).cast("long"), last + 1 - u * unit)
    mine = F.lit(0).cast("long")
    group = F.sequence(F.floor(own / fanout) * fanout, F.least(F.floor(own / fanout) * fanout + fanout, nodes) - 1)
    # to each other subtree v: its blocks whose place, counted round by the length of this one, is the place here
    to = F.flatten(F.transform(F.filter(group, lambda v: v != own), lambda v: F.when(block % unit < length(v), F.transform(
        F.sequence(block % unit, length(v) - 1, length(own)), lambda k: v * unit + k)).otherwise(F.array().cast("array<long>"))))
    sent = state.withColumn("node", own).select("tree", F.explode(F.concat(F.array(block), to)).alias("to"), "node", "digest", F.when(nodes > 1, True).otherwise(False).alias("open"), "block", "last", "path")
    at_home = F.col("to") == F.col("block")
    met = sent.groupBy("tree", "to").agg(F.sort_array(F.collect_list(F.struct("node", "digest"))).alias("run"), F.max("last").alias("last"), F.max("open").alias("open"),
                                         F.max(F.when(at_home, F.col("node"))).alias("node"), F.first(F.when(at_home, F.col("path")), ignorenulls=True).alias("path"))
    joined = lambda keep: F.array_join(F.transform(F.filter("run", keep), lambda x: x["digest"]), "")
    step = F.struct(joined(lambda x: x["node"] < F.col("node")).alias("left"), joined(lambda x: x["node"] > F.col("node")).alias("right"))
    return met.select("tree", F.col("to").alias("block"), "last", F.when(F.col("open"), F.sha2(joined(lambda x: F.lit(True)), 256)).otherwise(F.col("run")[0]["digest"]).alias("digest"),
                      F.when(F.col("open"), F.concat("path", F.array(step))).otherwise(F.col("path")).alias("path"))


def butterfly(roots: DataFrame, fanout: int) -> DataFrame:
    """tree, block, last, digest (the tree's root), path (left and right siblings, level by level) of every block."""
    state = written(roots.withColumn("path", F.array().cast(_PATH)), "round")
    last, unit = state.agg(F.max("last")).first()[0] or 0, 1
    while unit <= last:
        state, unit = written(_round(state, unit, fanout), "round"), unit * fanout
    return state


def _fold(digest: str, path) -> str:
    for left, right in path:
        digest = H(left, digest, right)
    return digest


def _paths(t: pa.Table, depth: int, fanout: int):
    """(place, path within the block) of each node of a sorted block."""
    levels, _ = _levels(t["digest"].to_pylist(), t["n"][0].as_py(), depth, fanout)
    for k in range(len(t)):
        yield k, [level[k // fanout ** d] for d, level in enumerate(levels)]


def _upper(path) -> list[tuple[str, str]]:
    return [(p["left"], p["right"]) for p in path]


def proofs(nodes: DataFrame, depth: int = DEPTH, fanout: int = FANOUT) -> DataFrame:
    """tree, idx, path, root of each of the nodes (tree, idx, n, digest)."""
    blocks = nodes.select("tree", F.floor(F.col("idx") / fanout ** depth).alias("block"), "idx", "n", "digest")
    tops = butterfly(block_roots(blocks, depth, fanout), fanout)

    def run(t: pa.Table, top: pa.Table) -> pa.Table:
        t, upper = t.sort_by("idx"), _upper(top["path"][0].as_py())
        found = [[{"left": a, "right": b} for a, b in path + upper] for _, path in _paths(t, depth, fanout)]
        return pa.table({"tree": t["tree"], "idx": t["idx"], "path": pa.array(found, pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))), "root": [top["digest"][0].as_py()] * len(t)})

    return blocks.groupBy("tree", "block").cogroup(tops.groupBy("tree", "block")).applyInArrow(run, f"tree long, idx long, path {_PATH}, root string")


def manifest(docs: DataFrame, depth: int = DEPTH, fanout: int = FANOUT, tampered: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row of docs (doc_id, source, lang, n_chars, text).

    The proof is of what docs hold; it is tried on what docs become when their text is `tampered` (by default, `tampered_text`).
    """
    altered = leaf_of(text=tampered if tampered is not None else tampered_text())
    leaves = written(docs.select("doc_id", "source", leaf_of().alias("digest"), altered.alias("altered"), F.monotonically_increasing_id().alias("tie")), "leaves")
    placed = numbered(leaves, "source", ["doc_id", "digest", "tie"])
    blocks = written(placed.select("tree", F.floor(F.col("idx") / fanout ** depth).alias("block"), "idx", "n", "doc_id", "digest", "altered"), "blocks")
    tops = butterfly(block_roots(blocks, depth, fanout), fanout)
    trees = tops.filter("block = 0").select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), "digest")
    above = proofs(trees.withColumn("n", F.lit(trees.count()).cast("long")), depth, fanout).select(F.col("idx").alias("tree"), F.col("path").alias("above"), "root")
    known = tops.join(above, "tree").select("tree", "block", F.col("digest").alias("subroot"), F.concat("path", "above").alias("path"), "root")

    def run(t: pa.Table, top: pa.Table) -> pa.Table:
        t, upper = t.sort_by("idx"), _upper(top["path"][0].as_py())
        rest, root = "".join(a + b for a, b in upper), top["root"][0].as_py()
        proof, folded = [], []
        for (_, path), altered in zip(_paths(t, depth, fanout), t["altered"].to_pylist(), strict=True):
            proof.append(H(*[a + b for a, b in path], rest))
            folded.append(_fold(altered, path + upper))
        return pa.table({"doc_id": t["doc_id"], "leaf": t["digest"], "subroot": [top["subroot"][0].as_py()] * len(t), "root": [root] * len(t), "proof_sha256": proof, "folded_root": folded, "verified": [f == root for f in folded]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return blocks.groupBy("tree", "block").cogroup(known.groupBy("tree", "block")).applyInArrow(
        run, f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
