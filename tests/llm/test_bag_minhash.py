import random
from collections import Counter

import numpy as np

from nightwave.llm.bag_minhash import _FIND, _linked, bags, near_groups, signatures, sketch, without_near_copies

SCHEMA = "doc_id long, text string, class_id string, n int"


def bag(text):
    w = _FIND((text or "").lower())
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def brute(rows):
    """Least id of each connected component of pairs at 0.8 or more."""
    b = {i: bag(t) for i, t, *_ in rows}
    label = {i: i for i in b}
    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in b:
        for j in b:
            if i < j and b[i] and b[j]:
                inter = sum((b[i] & b[j]).values())
                if inter * 5 >= 4 * (sum(b[i].values()) + sum(b[j].values()) - inter):
                    label[max(root(i), root(j))] = min(root(i), root(j))
    return {i: root(i) for i in b}


def test_components_agree_as_often_as_weighted_jaccard():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 2**63, 40).astype(np.uint64)
    wa, wb = rng.integers(0, 9, 40), rng.integers(0, 9, 40)
    want = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
    size, doc = 20_000, np.zeros(40, np.int64)
    a = signatures(h[wa > 0], doc[wa > 0], wa[wa > 0], 1, size)
    b = signatures(h[wb > 0], doc[wb > 0], wb[wb > 0], 1, size)
    assert np.isfinite(a).all() and abs((a == b).mean() - want) < 4 * (want * (1 - want) / size) ** 0.5


def corpus(seed=3, base=25):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows, k = [], 0
    for g in range(base):
        text = rng.choices(words, k=rng.choice([3, 5, 9, 60, 200]))
        for _ in range(rng.choice([1, 2, 6, 30])):
            copy = list(text)
            for _ in range(rng.choice([0, 0, 1, 2, 5]) if len(copy) > 50 else 0):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((k, " ".join(copy), "x", k))
            k += 1
    line = "one line that is said again and again "
    rows += [(k, line * 40, "x", 1), (k + 1, line * 41, "x", 1), (k + 2, line * 80, "x", 1)]
    return rows


def test_equals_brute_force(spark):
    rows = corpus()
    got = {r.doc_id: r.class_id for r in near_groups(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute(rows)


def test_a_large_group_of_near_copies_is_one_class(spark):
    rng = random.Random(5)
    text = [f"t{i}" for i in range(150)]
    rows = []
    for k in range(300):
        copy = list(text)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(150)] = f"new{rng.random()}"
        rows.append((k, " ".join(copy), None, None))
    assert {r.doc_id: r.class_id for r in near_groups(spark.createDataFrame(rows, SCHEMA)).collect()} == brute(rows)


def test_nulls_empty_texts_repeats(spark):
    rows = [(1, None, None, None), (2, "", None, None), (3, "...", "a", 1), (None, "one two", "a", 1), (4, "one two", "b", 2), (5, "One, two!", "c", 3), (6, "x " * 90_000, "d", 4), (6, "x " * 90_000, "d", 4)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.doc_id or 0, r.class_id or 0, r.kept) for r in near_groups(docs).collect())
    assert got == [(0, 0, True), (1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 4, False), (6, 6, True), (6, 6, True)]
    kept = without_near_copies(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 6]
    assert near_groups(docs.limit(0)).count() == 0


def test_rows_that_share_a_doc_id_are_one_document(spark):
    one, two = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(1, one, None, None), (1, two, None, None), (1, "", None, None), (2, one, None, None), (3, two + " c", None, None), (4, two, None, None)]
    got = near_groups(spark.createDataFrame(rows, SCHEMA)).collect()
    classes = {r.doc_id: r.class_id for r in got}
    assert len(got) == 6 and classes[4] == classes[3] != classes[2] and classes[1] == 1
    assert {classes[2], classes[3]} in ({1, 3}, {2, 1})  # document 1 counts with one of its texts


def test_bags_are_multisets(spark):
    texts = {1: "a b c d e a b c d e", 2: "a b c d e", 3: "z"}
    docs = spark.createDataFrame([(k, t, "", 0) for k, t in texts.items()], SCHEMA)
    keyed = sketch(docs).withColumnRenamed("doc_id", "node").join(docs.withColumnRenamed("doc_id", "node"), "node")
    got = {r.node: set(r.bag) for r in bags(keyed.select("node", "text", "bag_a", "bag_b")).collect()}
    assert len(got[1]) == 6 and len(got[1] & got[2]) == 1 and len(got[3]) == 1
    assert bags(keyed.select("node", "text", "bag_a", (keyed.bag_b + 1).alias("bag_b"))).count() == 0


def test_the_group_of_a_pivot_is_dealt_out_evenly(spark):
    """Pairs of one pivot: all that are similar are found, by about as many tasks as there are partitions though small partitions are split."""
    rng = np.random.default_rng(0)
    base = rng.integers(-2**62, 2**62, 400)
    rows = [(0, base.tolist())] + [(i, np.concatenate([base[i % 60:], rng.integers(-2**62, 2**62, i % 60)]).tolist()) for i in range(1, 601)]
    bag = spark.createDataFrame(rows, "node long, bag array<long>")
    pairs = spark.createDataFrame([(i, 0, 9) for i in range(1, 601)] + [(1, 2, 3)], "a long, b long, meets long")
    conf = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "64k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        spark.sparkContext.setJobGroup("linked", "linked")
        got = {(r.a, r.b, r.meets) for r in _linked(pairs, bag).collect()}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    sets = {i: set(b) for i, b in rows}
    similar = lambda a, b: len(sets[a] & sets[b]) * 9 >= (len(sets[a]) + len(sets[b])) * 4
    assert got == {(i, 0, 9) for i in range(1, 601) if similar(i, 0)} | ({(1, 2, 3)} if similar(1, 2) else set())
    seen = spark.sparkContext.statusTracker()
    most = max(seen.getStageInfo(s).numTasks for j in seen.getJobIdsForGroup("linked") for s in seen.getJobInfo(j).stageIds if seen.getStageInfo(s))
    assert most <= 40, most
