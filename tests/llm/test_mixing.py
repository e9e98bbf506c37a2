import math
from collections import Counter, defaultdict

import pytest

from nightwave.llm.mixing import mix_sources, mixed

SCHEMA = "doc_id long, source string, text string, slot string, h int"


def docs(spark, sizes):
    rows = [(i * 1000 + j, name, f"t{j}", "clash", j) for i, (name, n) in enumerate(sizes.items()) for j in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def brute(sizes, shares, block):
    """Slot by slot: earliest deadline among released blocks of the round, ties to the earlier source name."""
    blocks = {s: -(-n // block) for s, n in sizes.items()}
    names, out, start = sorted(sizes, key=lambda s: (s is not None, s)), [], 0
    while any(blocks.values()):
        quota = {s: min(shares[s], blocks[s]) for s in names}
        n, had = sum(quota.values()), Counter()
        for t in range(n):
            ready = [(-(-(had[s] + 1) * n // quota[s]), i, s) for i, s in enumerate(names) if had[s] < quota[s] and had[s] * n // quota[s] <= t]
            due, _, s = min(ready)
            out.append((s, start + had[s] * n // quota[s], start + due, start + t))
            had[s] += 1
        for s in names:
            blocks[s] -= quota[s]
        start += n
    return out


@pytest.mark.parametrize("sizes,shares,block", [({"a": 50, "b": 20, None: 7}, {"a": 3, "b": 2, None: 2}, 2), ({"a": 9, "b": 9, "c": 1}, {"a": 1, "b": 5, "c": 3}, 1), ({"only": 5}, {"only": 7}, 3)])
def test_equals_a_slot_by_slot_scheduler(spark, sizes, shares, block):
    got = mix_sources(docs(spark, sizes), shares, block_docs=block, range_bits=2).collect()
    assert len(got) == sum(sizes.values())
    assert sorted({(r.source or "", r.released, r.due, r.slot) for r in got}) == sorted((s or "", *x) for s, *x in brute(sizes, shares, block))
    assert all(r.released <= r.slot < r.due for r in got)
    assert len({(r.slot, r.in_block) for r in got}) == len(got)


def test_less_than_one_block_from_the_target_at_every_slot(spark):
    sizes, shares = {"a": 400, "b": 300, "c": 300}, {"a": 4, "b": 3, "c": 3}
    slots = defaultdict(set)
    for r in mix_sources(docs(spark, sizes), shares, block_docs=10).collect():
        slots[r.slot].add(r.source)
    had = Counter()
    for t in range(100):
        (source,) = slots[t]
        had[source] += 1
        assert all(abs(had[s] - shares[s] / 10 * (t + 1)) < 1 for s in sizes)


def test_mixed_keeps_rows_columns_and_order(spark):
    frame = docs(spark, {"a": 100, "b": 40})
    out = mixed(frame, block_docs=4)
    assert out.columns == frame.columns and sorted(out.collect()) == sorted(frame.collect())
    order = {r.doc_id: (r.slot, r.in_block) for r in mix_sources(frame, block_docs=4).collect()}
    assert [order[r.doc_id] for r in out.collect()] == sorted(order.values())


def test_nulls_repeats_and_no_rows(spark):
    rows = [(None, None, None, None, None), (None, None, None, None, None), (1, "", "x", None, None), (1, "", "x", None, None)]
    assert mix_sources(spark.createDataFrame(rows, SCHEMA)).count() == 4
    assert mixed(spark.createDataFrame(rows, SCHEMA)).count() == 4
    assert mix_sources(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        mix_sources(spark.createDataFrame(rows, SCHEMA), {"a": 0})


def test_default_shares_temper_the_sizes(spark):
    got = mix_sources(docs(spark, {"a": 900, "b": 100}), slots=40, block_docs=1).filter("slot < 40").collect()
    assert math.isclose(sum(r.source == "a" for r in got), 30, abs_tol=1)
