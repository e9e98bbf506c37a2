import re
import zlib
from collections import Counter

import numpy as np
import pytest
from nightwave.llm import spelling
from nightwave.llm.spelling import candidates, shards, variants

SCHEMA = "doc_id long, text string, word string, n string"


def counted(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % 97 == 0:
                at = h % len(w)
                w = w[:at] + w[at + 1:]
            counts[w] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(rows):
    words = counted(rows)
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, of in near.items():
        best = min(of, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return {(w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


def got(spark, rows, **more):
    out = variants(spark.createDataFrame(rows, SCHEMA), **more)
    assert out.dtypes == [("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form_n", "bigint")]
    rows = [tuple(r) for r in out.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def corpus(seed=3, n=400):
    rng = np.random.default_rng(seed)
    stems = ["garten", "gartens", "straße", "strasse", "coffee", "café", "cafés", "cafés", "naïve", "naive", "naives", "letter", "better", "butter", "aaaaa", "aaaaaa", "aaaab", "Ångström", "ångström"]
    rows = []
    for k in range(n):
        words = []
        for _ in range(40):
            w = stems[min(int(rng.exponential(4)), len(stems) - 1)]
            if rng.random() < 0.15:
                at = int(rng.integers(len(w)))
                w = w[:at] + ["", "e", "ß", w[at] * 2][rng.integers(4)] + w[at + 1:]
            words.append(w.upper() if w.isascii() and rng.random() < 0.1 else w)
        rows.append((k, " ".join(words), "x", "y"))
    chain = [("kette", 4), ("ketten", 10), ("kettens", 30), ("kettense", 90), ("kettensee", 200)]
    return rows + [(n + k, " ".join(w for w, m in chain for _ in range(m // 2)), "", None) for k in range(2)]


def test_against_brute_force(spark):
    rows = corpus()
    want = brute(rows)
    assert len(want) > 150 and any(w[1] and w[2] != w[1] for w in want)
    assert got(spark, rows) == want


def test_a_filter_that_is_too_small_changes_nothing(spark):
    rows = corpus(4, 150)
    assert got(spark, rows, max_filter_bytes=8) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, "lonely lonely lonely", None, None), (1, None, "a", None), (2, "", None, None), (3, "word" * 200_000 + " " + "words " * 3, None, None), (3, "x1y ÀÿÀÿÀ×÷ " * 3, None, None),
            (5, "repeat " * 2, None, None), (5, "repeat " * 2, None, None), (6, "repea", None, None)] + [(7, "long" * 100 + " ", "", "")] * 3
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == set()
    assert got(spark, [(1, "no such words as 123", None, None)]) == set()


def test_every_edit_in_the_vocabulary_passes_the_filter(spark):
    words = ["abcde", "abcdf", "abcdé", "abcdef", "bcde", "zzzzz"]
    filters = shards(spark.createDataFrame([(w, 3) for w in words], "word string, n long"))
    found = {(w, e) for w in words for _, e in candidates([w], len(w), filters) if e in words}
    assert {frozenset(p) for p in found} == {frozenset((a, b)) for a in words for b in words if one_edit(a, b)} and len(found) == len({frozenset(p) for p in found})


@pytest.mark.parametrize("length", [5, 70])
def test_hashes_of_edits_are_those_of_words(length):
    word = ("abcde" * length)[:length]
    for edit in (word[:2] + word[3:], word[:2] + "ÿ" + word[3:]):
        blocks = np.zeros(1 << 20, np.uint64)
        at, mask = spelling._slots(spelling._hashes(spelling._points([edit], len(edit))), len(blocks))
        blocks[at] |= mask
        assert [e for _, e in candidates([word], length, {len(edit): blocks}) if e == edit] == [edit]
