import hashlib

import numpy as np
import pytest
from nightwave.llm import suffix_dedup
from nightwave.llm.suffix_dedup import Prefixes, repeated_windows, without_repeats

SCHEMA = "doc_id long, text string, row string, bundle string"


def brute(rows, length):
    order = sorted({(r[0] is None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).hexdigest(), r[1] or "") for r in rows})
    seen, found = set(), {}
    for none, doc_id, _, text in order:
        b = text.encode()
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            w = b[s:s + length]
            if w in seen:
                gone[s:s + length] = b"\1" * length
            seen.add(w)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        found[None if none else doc_id, text] = (len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest())
    return sorted(((r[0], *found[r[0], r[1] or ""]) for r in rows), key=repr)


def got(spark, rows, **more):
    out = without_repeats(spark.createDataFrame(rows, SCHEMA), **more)
    assert out.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_removed", "bigint"), ("n_spans", "bigint"), ("kept_sha256", "string")]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def corpus(seed=1, n=300):
    rng = np.random.default_rng(seed)
    words = ["der", "Wald", "schön", "and", "the", "river", "ß", "long", "nächste", "of"]
    say = lambda k: " ".join(words[i] for i in rng.integers(0, len(words), k))
    passages = [say(40) for _ in range(4)]
    rows = []
    for k in range(n):
        parts = [say(int(rng.integers(0, 60)))]
        for _ in range(int(rng.integers(0, 3))):
            p = passages[min(int(rng.exponential(0.8)), 3)]
            a = int(rng.integers(0, 40)) if rng.random() < 0.5 else 0
            parts += [p[a:], say(int(rng.integers(0, 20)))]
        text = rng.choice(["", " "]).join(parts)
        rows.append((int(k * 37 % n), rows[-1][1] if k and rng.random() < 0.1 else text, "", None))
    return rows


@pytest.mark.parametrize("more", [{}, {"hot": 3}, {"hot": 20, "bundle_bytes": 900, "shard_bytes": 700}])
def test_against_brute_force(spark, more):
    rows = corpus()
    want = brute(rows, 100)
    assert sum(r[3] > 1 for r in want) > 10 and sum(0 < r[2] < r[1] for r in want) > 100
    assert got(spark, rows, **more) == want


def test_given_documents_and_other_lengths(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text, None, None) for r in docs.collect()]
    for length, k in ((100, 36), (32, 12)):
        assert got(spark, rows, length=length, k=k) == brute(rows, length)


def test_odd_rows(spark):
    base = "abcdefghij" * 30
    rows = [(None, base, None, None), (1, None, "x", "y"), (2, "", None, None), (3, base, None, None), (3, base, None, None), (3, base + "!", None, None), (4, "ü" * 400, None, None), (5, "a" * 99, None, None), (6, "a" * 99, None, None),
            (7, "b" * 100, None, None), (8, "b" * 100, None, None), (None, "z" + base, None, None), (None, None, None, None)]
    assert got(spark, rows) == brute(rows, 100)
    assert got(spark, []) == []
    assert got(spark, [(1, None, None, None)]) == brute([(1, None)], 100)


def test_very_long_texts_and_one_character(spark):
    rng = np.random.default_rng(5)
    noise = "".join(map(chr, rng.integers(97, 123, 300_000)))
    rows = [(1, noise, None, None), (2, noise[131_000:131_300] + "-" + noise[50:149] + "-" + noise[290_000:], None, None), (3, "x" * 200_000, None, None), (4, "y" + "x" * 150, None, None)]
    assert got(spark, rows) == brute(rows, 100)


def test_bytes_decide_where_hashes_collide(monkeypatch):
    data = np.frombuffer((("ab" * 10 + "c" * 20) + ("ab" * 10 + "d" * 20) + ("ab" * 10 + "c" * 20)).encode(), np.uint8)
    at, zero = np.array([0, 40, 80]), np.zeros(3, np.int64)
    assert repeated_windows(data, at, zero, np.arange(3), 40).tolist() == [False, False, True]
    monkeypatch.setattr(Prefixes, "of", lambda self, at, length: np.zeros(len(at), np.uint64))
    assert repeated_windows(data, at, zero, np.arange(3), 40).tolist() == [False, False, True]


def test_order_is_that_of_suffixes():
    data = np.random.default_rng(2).integers(97, 99, 5000).astype(np.uint8)
    data[:8] = data[2000:2008] = data[3000:3008]
    at = np.flatnonzero((np.lib.stride_tricks.sliding_window_view(data, 4)[:4900] == data[:4]).all(1))
    word = np.zeros(len(at), np.int64)
    order = suffix_dedup._merged(Prefixes(data), at, np.arange(len(at)), np.array([0]), np.array([len(at)]), 100)
    firsts = [bytes(data[a + 8:a + 16]) for a in at[order]]
    assert len(at) > 200 and firsts == sorted(firsts) and len(set(order.tolist())) == len(word)
