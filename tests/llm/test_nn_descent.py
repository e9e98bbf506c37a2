import math
import os

import numpy as np
import pytest

from nightwave.llm.nn_descent import nearest_neighbours

SCHEMA = "vec_id long, embedding array<float>, query_id string, rank int"


def brute(rows, k, every):
    fine = {i: np.array(v, np.float32).astype(float) for i, v, *_ in rows if i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)}
    out = {}
    for q in fine:
        if q % every == 0:
            out[q] = sorted((float(np.sqrt(((fine[q] - fine[i]) ** 2).sum())), i) for i in fine if i != q and len(fine[i]) == len(fine[q]))[:k]
    return out


def recall(got, want):
    """Share of the true neighbours that were found; both are lists of rows."""
    pairs = lambda rows: {(r.query_id, r.vec_id) for r in rows}
    return len(pairs(got) & pairs(want)) / len(want)


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(20, 8))
    rows = [(i, [float(x) for x in (centres[i % 20] + rng.normal(size=8) * 0.4).astype(np.float32)], "clash", 1) for i in range(1500)]
    rows += [(i, rows[7][1], "clash", 1) for i in range(1500, 1600)]
    rows += [(2000, None, None, None), (2100, [], None, None), (2200, [0.0] * 8, None, None), (2300, [1.0, None, *[0.0] * 6], None, None), (2400, [float("nan")] * 8, None, None), (2500, [float("inf")] * 8, None, None), (2600, [1.0], None, None), (None, rows[3][1], None, None), rows[0]]
    got = {}
    for r in nearest_neighbours(spark.createDataFrame(rows, SCHEMA), 10, 50, rounds=3).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = brute(rows, 10, 50)
    assert got.pop(2600, []) == want.pop(2600) == []  # the only vector of its length
    assert got.keys() == want.keys()
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [x[0] for x in found] == list(range(1, 11)) and q not in {x[1] for x in found}
        assert found == sorted(found, key=lambda x: (x[2], x[1]))
        hits += len({x[1] for x in found} & {i for _, i in want[q]})
        for _, i, score in found:
            a, b = (np.array(next(v for j, v, *_ in rows if j == x), np.float32).astype(float) for x in (q, i))
            assert score == pytest.approx(np.sqrt(((a - b) ** 2).sum()), rel=1e-12, abs=1e-12)
    assert hits >= 0.95 * 10 * len(want)
    assert [i for _, i, _ in got[1500]] == [7, *range(1501, 1510)]


def test_fewer_candidates_than_k_and_none(spark):
    rows = [(0, [1.0, 0.0], "", 0), (1, [0.0, 1.0], "", 0), (2, [1.0, 0.0], "", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in nearest_neighbours(df, 10, 1).collect())
    assert got == [(0, 1, 2), (0, 2, 1), (1, 1, 0), (1, 2, 2), (2, 1, 0), (2, 2, 1)]
    assert nearest_neighbours(df.limit(0)).count() == 0


@pytest.mark.parametrize("case", ["outlier", "offset", "lengths"])
def test_recall_of_hard_clouds(spark, case):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 16))
    if case == "offset":
        x = 100 + 0.01 * x
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    if case == "outlier":
        rows += [(5000, [1e9] * 16), (5001, [-1e300] + [0.0] * 15)]
    if case == "lengths":
        rows = [(i, v[:(16, 7, 3)[min(2, i % 10 // 6)]]) for i, v in rows] + [(6000 + i, [float(i + 1)] * 40) for i in range(9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got, want = nearest_neighbours(df, 10, 20, rounds=3).collect(), nearest_neighbours(df, 10, 20, exact=True).collect()
    assert recall(got, want) >= 0.9
    if case == "lengths":  # a query without another vector of its length has no result
        assert {r.query_id for r in got} == {r.query_id for r in want} == {i for i, v in rows if i % 20 == 0}


def test_exact_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=5).astype(np.float32).tolist()) for i in range(300)] + [(400 + i, [1.0, 2.0]) for i in range(30)]
    got = nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), 10, 10, exact=True).collect()
    want = brute(rows, 10, 10)
    for q in want:
        own = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == q)
        assert [i for _, i, _ in own] == [i for _, i in want[q]] and [s for *_, s in own] == pytest.approx([s for s, _ in want[q]])


def test_rows_that_share_an_id(spark):
    rng = np.random.default_rng(3)
    rows = [(i % 150, rng.normal(size=4).tolist()) for i in range(300)]
    got = nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 5, 50).collect()
    assert sorted((r.query_id, r["rank"]) for r in got) == [(q, k) for q in (0, 50, 100) for k in range(1, 6)]
    for r in got:
        near = [math.dist(a, b) for i, a in rows if i == r.query_id for j, b in rows if j == r.vec_id]
        assert r.score == pytest.approx(min(near))
    assert len({(r.query_id, r.vec_id) for r in got}) == 15


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.1/embeddings.parquet"), reason="no test table")
def test_recall_over_the_given_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = nearest_neighbours(rows).collect()
    want = nearest_neighbours(rows, exact=True).collect()
    assert len(got) == len(want) and recall(got, want) >= 0.9
