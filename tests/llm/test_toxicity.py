import itertools
import zlib

import numpy as np

from nightwave.llm.toxicity import FactorizationMachine, Slots, fit, fit_machine, score, slot_values, terms, with_score

DOCS = "doc_id long, text string, score double, toxic string"


def test_raw_is_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    m = FactorizationMachine(0.3, rng.normal(size=6), rng.normal(size=(6, 3)))
    rows = [[0, 2, 5], [], [1], [0, 1, 2, 3, 4, 5]]
    want = [0.3 + sum(m.weight[i] for i in r) + sum(m.factor[i] @ m.factor[j] for i, j in itertools.combinations(r, 2)) for r in rows]
    assert np.allclose(m.raw(rows), want)


def test_learns_a_pair_that_no_single_weight_explains():
    """Toxic only where terms 0 and 1 meet; alone each is clean."""
    rows = [[0, 1, 2], [0, 2], [1, 2], [2]] * 200
    y = np.array([1.0, 0, 0, 0] * 200)
    rows2, y2 = rows + [[3, 4], [3], [4], [3, 4]] * 200, np.concatenate([y, np.array([0.0, 1, 1, 0] * 200)])
    m = fit_machine(np.ones(5, np.float32), rows2, y2, rank=4, epochs=60)
    s = m.raw([[0, 1, 2], [0, 2], [1, 2], [3, 4], [3], [4]]) > 0
    assert s.tolist() == [True, False, False, False, True, True]


def corpus(n=600):
    rng = np.random.default_rng(2)
    words = [f"word{i}" for i in range(80)]
    rows = []
    for i in range(n):
        bad = i % 4 == 0
        rows.append((i, " ".join([*rng.choice(words, 20), *(["Insultful" if i % 8 else "insultery"] if bad else [])]), 0.0, "clash", int(bad)))
    return rows


def test_held_out_accuracy_and_columns(spark):
    rows = corpus()
    docs = spark.createDataFrame([r[:4] for r in rows], DOCS)
    labels = spark.createDataFrame([(r[0], r[4], 1) for r in rows], "doc_id long, toxic int, quality int")
    machine = fit(docs, labels)
    got = {r.doc_id: r for r in score(docs, machine).collect()}
    assert len(got) == len(rows)
    for i, _, _, _, bad in rows:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert got[i].predicted == bad and 0 <= got[i].score <= 1
    out = with_score(docs, machine, "mine")
    assert out.columns == [*docs.columns, "mine"] and out.filter("score != 0 or toxic != 'clash'").count() == 0


def test_held_out_labels_do_not_matter(spark):
    rows = corpus(200)
    docs = spark.createDataFrame([r[:4] for r in rows], DOCS)
    flip = lambda r: 1 - r[4] if zlib.crc32(str(r[0]).encode()) % 5 == 0 else r[4]
    a, b = (fit(docs, spark.createDataFrame([(r[0], f(r)) for r in rows], "doc_id long, toxic int"), bits=12) for f in (lambda r: r[4], flip))
    assert a.weight.any() and np.array_equal(a.weight, b.weight) and np.array_equal(a.factor, b.factor)


def test_nulls_no_labels_long_texts(spark):
    docs = spark.createDataFrame([(1, None, None, None), (None, "", None, None), (2, "a " * 200_000, None, None), (2, "a " * 200_000, None, None)], DOCS)
    labels = spark.createDataFrame([(None, 1), (1, None), (2, 0), (2, 0)], "doc_id long, toxic int")
    got = score(docs, fit(docs, labels)).collect()
    assert len(got) == 4 and len({r.score for r in got}) == 1 and all(r.predicted == 0 for r in got)
    assert score(docs.limit(0), fit(docs, labels.limit(0))).count() == 0


def test_terms_are_words_and_beginnings():
    assert terms("abcdefgh") == ["abcdefgh", "abcd*", "abcde*", "abcdef*"]
    assert len(Slots().of("Abcdefgh abcdefgh")) == 4 and len(Slots().of("")) == 0


def test_every_slot_has_a_value_and_steady_ones_count_more():
    values = slot_values(np.array([400, 400, 400, 1]), np.array([200, 48, 40, 1]), 0.1)
    assert values[0] > 0.9 > 0.1 > values[1] > values[2] == 0 and values[3] > 0  # n = 400 with 40 toxic is what is expected
