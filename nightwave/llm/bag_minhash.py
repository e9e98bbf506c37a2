"""Near duplicates by BagMinHash over the multiset of five-word shingles, then banding and exact multiset overlap.

Signature. Every shingle owns Poisson processes on (time, component, weight). The weight axis is cut into the dyadic
intervals (0, 1], (1, 2], (2, 4], ...; an interval's process has a rate in proportion to its length, and a point falls
to a component and to a place in the interval by hashed coin flips, which is the hierarchical splitting of the process
down to unit weights. A shingle that occurs w times sees the points with weight below w; a component's value is the
time of its first point, so two signatures agree in a component with probability of their weighted Jaccard similarity.
Points come in order of time and are made only up to a limit that depends on the document's total weight; a document
with a component still empty is done again with twice the limit, so the result is that of the unbounded process.

Candidates share a band of `ROWS` components in one of `BANDS` bands (a pair at 0.8 is missed with probability 5e-5).
Documents with equal multisets are one node from the start. First each node of a bucket is held against one pivot, the
member that meets the most others over all its bands, which is the typical text of a group of copies; nodes linked to it
share a label. Then pairs of a bucket with different labels are compared, but for those that cannot be similar: an
element that no other open node has cannot be shared, so a pair's overlap is at most the least, summed over `BINS` hashed
bins, of what both have in a bin beside such elements. That is an exact bound, so no link is lost, and it is held in the
join, so that ruled out pairs are never rows. A bucket of many open nodes is dealt out in blocks of `BLOCK`.
The similarity of compared nodes is exact: shingles with their occurrence numbers, intersected.

Defined cases: words are runs of letters, digits and _ in lower case; a text of one to four words has one shingle, of
all its words; texts without a word (null, empty, punctuation) and rows without doc_id take no part and are their own
class; rows that share a doc_id are one document, whose text is the one with the least multiset digest among those with
words; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightwave.llm.common import map_batches, scratch, text_of, written

WORDS, BANDS, ROWS, BINS, BLOCK, PIECE = 5, 25, 5, 32, 512, 8
#: Similarity as a fraction of whole numbers, so that a tie at 0.8 is decided exactly.
LEAST = (4, 5)
#: Words handled at once in a task, but for a single longer text.
CHUNK = 150_000
CACHE = 300_000
_G = np.uint64(0x9E3779B97F4A7C15)


def _salt(k: int) -> np.uint64:
    return np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1)


_FIND = re.compile(r"\w+").findall


class _Words(dict):
    """Hash of a word; forgets all when full."""

    def __missing__(self, word):
        if len(self) >= CACHE:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


_HASH = _Words()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(words: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted shingle hashes of each document after another, and their number a document."""
    padded = [w if len(w) >= WORDS or not w else w + [""] * (WORDS - len(w)) for w in words]
    n = np.array([len(w) for w in padded], np.int64)
    h = np.fromiter((_HASH[x] for w in padded for x in w), np.uint64, int(n.sum()))
    counts = np.maximum(n - (WORDS - 1), 0)
    at = np.repeat(np.cumsum(n) - n - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    x = h[at]
    for k in range(1, WORDS):
        x = _mix(x * _G + h[at + k])
    for stop, k in zip(np.cumsum(counts), counts):
        x[stop - k:stop].sort()
    return x, counts


def _elements(x: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles, their document and how often they occur there."""
    doc = np.repeat(np.arange(len(counts)), counts)
    first = np.ones(len(x), bool)
    first[1:] = (x[1:] != x[:-1]) | (doc[1:] != doc[:-1])
    start = np.flatnonzero(first)
    return x[start], doc[start], np.diff(np.append(start, len(x)))


def signatures(h: np.ndarray, doc: np.ndarray, weight: np.ndarray, n_docs: int, size: int = BANDS * ROWS) -> np.ndarray:
    """Times of the first points, (n_docs, size); infinite for documents without elements. h must be ordered by doc."""
    total = np.bincount(doc, weights=weight, minlength=n_docs)
    out = np.full(n_docs * size, np.inf)
    limit = (np.log(size) + 3) / np.maximum(total, 1)
    todo = total > 0
    while todo.any():
        keep = todo[doc]
        eh, ed, ew = h[keep], doc[keep], weight[keep]
        level = 0
        while len(eh):
            low, high = (0, 1) if level == 0 else (1 << (level - 1), 1 << level)
            rate, seed = size * (high - low), _mix(eh + _salt(level + 1))
            d, w, t, step = ed, ew, np.zeros(len(eh)), 0
            bound = limit[d]
            while len(d):
                a = _mix(seed + _salt(2 * step))
                t = t - np.log(((a >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53) / rate
                on = t <= bound
                seed, d, w, t, bound = seed[on], d[on], w[on], t[on], bound[on]
                b = _mix(seed + _salt(2 * step + 1))
                slot = d * size + ((b >> np.uint64(40)) % np.uint64(size)).astype(np.int64)
                if level:
                    seen = low + (b & np.uint64((1 << 40) - 1)).astype(np.float64) * (2.0**-40 * (high - low)) < w
                    np.minimum.at(out, slot[seen], t[seen])
                else:
                    np.minimum.at(out, slot, t)
                step += 1
            more = ew > high
            eh, ed, ew = eh[more], ed[more], ew[more]
            level += 1
        todo &= np.isinf(out.reshape(n_docs, size)).any(axis=1)
        limit = limit * 2
    return out.reshape(n_docs, size)


def _chunks(texts: list[str]):
    """Lists of words of some documents at a time."""
    part, n = [], 0
    for t in texts:
        part.append(_FIND(t.lower()))
        n += len(part[-1])
        if n >= CHUNK:
            yield part
            part, n = [], 0
    if part:
        yield part


def _digests(h: np.ndarray, doc: np.ndarray, weight: np.ndarray, n: int) -> list[np.ndarray]:
    """128 bits of each multiset, as two sums of hashed (element, weight)."""
    out = []
    for salt in (1, 2):
        total = np.zeros(n, np.uint64)
        np.add.at(total, doc, _mix(_mix(h + _salt(salt)) + weight.astype(np.uint64)))
        out.append(total.view(np.int64))
    return out


def _sketch(b: pa.RecordBatch) -> list:
    size, bag_a, bag_b, bands = [], [], [], []
    for words in _chunks(b["text"].to_pylist()):
        h, doc, weight = _elements(*shingles(words))
        n = len(words)
        size.append(np.bincount(doc, weights=weight, minlength=n).astype(np.int64))
        for to, x in zip((bag_a, bag_b), _digests(h, doc, weight, n)):
            to.append(x)
        times = signatures(h, doc, weight, n).view(np.uint64).reshape(n, BANDS, ROWS)
        band = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (n, BANDS))
        for r in range(ROWS):
            band = _mix(band * _G + times[:, :, r])
        bands.append(band.view(np.int64).reshape(-1))
    if not size:
        return [[], [], [], []]
    flat = np.concatenate(bands)
    return [pa.array(np.concatenate(x)) for x in (size, bag_a, bag_b)] + [pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, BANDS, dtype=np.int32)), pa.array(flat))]


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, n (shingles), bag_a and bag_b (128 bits of the multiset), bands (array) of every row."""
    return map_batches(docs.select("doc_id", text_of().alias("text")), ["doc_id"], {"n": pa.int64(), "bag_a": pa.int64(), "bag_b": pa.int64(), "bands": pa.list_(pa.int64())}, _sketch)


def _bags(b: pa.RecordBatch) -> list:
    bag, bins = [], []
    for words in _chunks(b["text"].to_pylist()):
        x, counts = shingles(words)
        k = len(bag)
        right = [(a == u) & (c == v) for a, c, u, v in zip(*_digests(*_elements(x, counts), len(words)), b["bag_a"][k:k + len(words)].to_pylist(), b["bag_b"][k:k + len(words)].to_pylist())]
        start = np.maximum.accumulate(np.where(np.append(True, x[1:] != x[:-1]), np.arange(len(x)), 0)) if len(x) else np.zeros(0, np.int64)
        first = np.repeat(np.cumsum(counts) - counts, counts)
        nth = np.arange(len(x)) - np.maximum(start, first)  # the how-manieth of equal shingles of the document
        own = np.split(_mix(x + nth.astype(np.uint64) * _G).view(np.int64), np.cumsum(counts)[:-1])
        bag += [v if ok else None for v, ok in zip(own, right)]
        bins += [np.bincount(v >> 32 & (BINS - 1), minlength=BINS) if ok else None for v, ok in zip(own, right)]
    return [bag, bins]


def bags(docs: DataFrame) -> DataFrame:
    """node, bag (the hashes of (shingle, occurrence number), so that a multiset is a set), bins (how many of them fall to each of BINS).

    docs: node, text, and the digest (bag_a, bag_b) of the text that counts as the node's; rows with other texts are left out.
    """
    made = map_batches(docs.select("node", "bag_a", "bag_b", text_of().alias("text")), ["node"], {"bag": pa.list_(pa.int64()), "bins": pa.list_(pa.int32())}, _bags)
    return made.filter(F.col("bag").isNotNull())


def _shared(open_nodes: DataFrame, bag: DataFrame) -> DataFrame:
    """node, common, bins: how many elements of its multiset another open node may have too, in all and by bin.

    Elements go by half of their hash: two that fall together count as shared, which only loosens the bound.
    """
    held = bag.join(open_nodes.select("node").distinct(), "node").select("node", "bag", "bins")
    lone = (held.select("node", F.explode(F.transform("bag", lambda e: F.shiftright(e, 32).cast("int"))).alias("element"))
            .groupBy("element").agg(F.min("node").alias("node"), F.max("node").alias("last")).filter("node = last")
            .groupBy("node").agg(F.array(*[F.count_if(F.col("element").bitwiseAND(BINS - 1) == k).cast("int") for k in range(BINS)]).alias("lone")))
    whole = held.groupBy("node").agg(F.first("bins").alias("bins")).join(lone, "node", "left")
    bins = F.when(F.col("lone").isNull(), F.col("bins")).otherwise(F.zip_with("bins", "lone", lambda x, y: x - y))
    return whole.select("node", bins.alias("bins")).withColumn("common", F.aggregate("bins", F.lit(0), lambda s, x: s + x))


def _in_pieces(pairs: DataFrame) -> DataFrame:
    """The written pairs (a, b) with `piece` and `pieces`: those of one b are dealt out to pieces of about `PIECE` pairs."""
    pieces = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / PIECE).cast("int").alias("pieces"))
    return pairs.join(pieces, "b").withColumn("piece", F.pmod(F.xxhash64("a"), F.col("pieces")).cast("int"))


def _linked(pairs: DataFrame, bag: DataFrame) -> DataFrame:
    """The pairs (a, b) whose multisets are similar enough, with the other columns of pairs.

    A pivot is the b of all its group, so the multisets of the group meet a copy of its own in pieces: they are even shares
    of the tasks as they are, and need not be cut out of one task's share of them.
    """
    dealt = _in_pieces(written(pairs, "pairs"))
    x = bag.select(F.col("node").alias("a"), F.col("bag").alias("x"))
    y = (dealt.select("b", "pieces").distinct().join(bag.select(F.col("node").alias("b"), F.col("bag").alias("y")), "b")
         .select("b", "y", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece")))
    both = F.size(F.array_intersect("x", "y"))
    return dealt.join(x, "a").join(y, ["b", "piece"]).filter(_enough(both, F.size("x"), F.size("y"))).select("a", *[c for c in pairs.columns if c != "a"])


def _enough(overlap, n, m):
    """Whether multisets of n and m elements with that overlap are similar enough: overlap / (n + m - overlap) >= LEAST, the overlap evaluated once."""
    return overlap * (LEAST[0] + LEAST[1]) >= (n + m) * LEAST[0]


def components(edges: DataFrame) -> DataFrame:
    """id and label (the least id of its component) of every end of the edges (a, b), by minimum labels and pointer jumping."""
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("label")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("label").alias("near"))
        hop = labels.join(near, labels["id"] == near["a"]).select("id", F.col("label").alias("old"), F.least("label", "near").alias("to"))
        jump = labels.select(F.col("id").alias("to"), F.col("label").alias("far"))
        new = written(hop.join(jump, "to", "left").select("id", "old", F.least("to", F.coalesce("far", "to")).alias("label")), "labels")
        labels = new.select("id", "label")
        if new.filter(F.col("label") < F.col("old")).isEmpty():
            return labels


def near_groups(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (least doc_id of the class), kept (the document is the one that stays) of every row of docs."""
    with scratch(docs.sparkSession):
        return written(_near_groups(docs), "classes", lasting=True)


def _near_groups(docs: DataFrame) -> DataFrame:
    sig = sketch(docs).filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
    one = written(sig.groupBy("doc_id").agg(F.min(F.struct("bag_a", "bag_b", "n", "bands")).alias("x")).select("doc_id", "x.*"), "sketch")
    nodes = written(one.groupBy("bag_a", "bag_b").agg(F.min(F.struct("doc_id", "n", "bands")).alias("x"))
                    .select("bag_a", "bag_b", F.col("x.doc_id").alias("node"), F.col("x.n").alias("n"), F.col("x.bands").alias("bands")), "nodes")
    buckets = nodes.select("node", "n", F.explode("bands").alias("bucket"))
    sizes = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = written(buckets.join(sizes, "bucket"), "members")
    meets = members.groupBy("node").agg(F.sum("size").alias("meets"))
    wanted = nodes.join(meets, "node").select("node", "bag_a", "bag_b")
    bag = written(bags(docs.select("doc_id", "text").join(wanted, F.col("doc_id") == F.col("node"))), "bags")

    ranked = members.join(meets, "node").select("bucket", "node", "n", F.struct("meets", "node", "n").alias("rank"))
    pivots = ranked.groupBy("bucket").agg(F.max("rank").alias("pivot"))
    near_pivot = F.col("node").alias("a"), F.col("pivot.node").alias("b"), F.col("pivot.meets").alias("meets")
    size = F.col("n"), F.col("pivot.n")
    pairs = ranked.join(pivots, "bucket").filter((F.col("node") != F.col("pivot.node")) & _enough(F.least(*size), *size)).select(*near_pivot).distinct()
    first = written(_linked(pairs, bag), "first")
    # any label is right that only linked nodes share: the foremost pivot that a node is linked to, and that one's own
    up = first.groupBy("a").agg(F.max(F.struct("meets", "b")).alias("to")).select(F.col("a").alias("node"), F.col("to.b").alias("label"))
    comp = up.join(up.select(F.col("node").alias("label"), F.col("label").alias("further")), "label", "left").select("node", F.coalesce("further", "label").alias("comp"))

    now = written(members.join(comp, "node", "left").select("node", "n", "bucket", F.coalesce("comp", "node").alias("comp")), "labelled")
    mixed = now.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")).filter("lo < hi").select("bucket", "blocks")
    now = written(now.join(mixed, "bucket"), "open")
    held = written(now.join(_shared(now, bag), "node").filter(F.col("common") * LEAST[1] >= F.col("n") * LEAST[0]), "held")
    left = held.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    right = held.select("bucket", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), *[F.col(c).alias(f"p_{c}") for c in ("node", "n", "comp", "common", "bins")])
    least = F.aggregate(F.zip_with("bins", "p_bins", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    fits = (left["bucket"] == right["bucket"]) & (left["block"] == right["block"]) & (F.col("node") < F.col("p_node")) & (F.col("comp") != F.col("p_comp"))
    fits = fits & _enough(F.least("common", "p_common"), F.col("n"), F.col("p_n")) & _enough(least, F.col("n"), F.col("p_n"))
    pairs = left.join(right.hint("merge"), fits).select(F.col("node").alias("a"), F.col("p_node").alias("b")).distinct()
    second = written(_linked(pairs, bag), "second")

    label = components(first.select("a", "b").union(second.select("a", "b")))
    to = nodes.join(label, F.col("node") == F.col("id"), "left").select("bag_a", "bag_b", F.coalesce("label", "node").alias("class_id"))
    classes = one.select(F.col("doc_id").alias("of"), "bag_a", "bag_b").hint("merge").join(to, ["bag_a", "bag_b"]).select("of", "class_id")
    rows = docs.select("doc_id").hint("merge").join(classes, F.col("doc_id") == F.col("of"), "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))
    return rows.select("doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def without_near_copies(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, one document of each class, with the columns of docs."""
    gone = f"gone_{uuid.uuid4().hex}"
    drop = near_groups(docs).filter(~F.col("kept")).select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(drop, docs["doc_id"] == drop[gone], "left_anti")
