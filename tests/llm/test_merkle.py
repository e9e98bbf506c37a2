import zlib
from hashlib import sha256

import pytest
from nightwave.llm.merkle import manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, idx string, n string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def grown(digests):
    """The root, and the (siblings before, after) of each digest level by level."""
    paths, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for k, i in enumerate(at):
            run = digests[i // 3 * 3:i // 3 * 3 + 3]
            paths[k].append(("".join(run[:i % 3]), "".join(run[i % 3 + 1:])))
        digests, at = [h(*digests[k:k + 3]) for k in range(0, len(digests), 3)], [i // 3 for i in at]
    return digests[0], paths


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    grouped = [sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r[:5]))) for s in names]
    trees = [grown([leaf(r[:5]) for r in g]) for g in grouped]
    root, tops = grown([t[0] for t in trees])
    out = []
    for g, (subroot, paths), top in zip(grouped, trees, tops, strict=True):
        for r, path in zip(g, paths, strict=True):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
            d = leaf((*r[:4], r[4].replace("\n", "") if tampered else r[4]))
            for a, b in path + top:
                d = h(a, d, b)
            out.append((r[0], leaf(r[:5]), subroot, root, h(*[a + b for a, b in path + top]), d, d == root))
    return sorted(out, key=repr)


def rows(n, sources):
    return [((k * 7919) % 100_003, sources[k * k % 11 % len(sources)], "de" if k % 3 else None, k, f"line {k}\nand ü{k % 5}" if k % 4 else "one line", "", None, "x") for k in range(n)]


@pytest.mark.parametrize(("n", "depth", "sources"), [(1, 1, ["a"]), (2, 1, ["a", None]), (3, 2, ["a"]), (4, 1, ["a"]), (28, 1, ["a"]), (31, 1, ["b", "a"]), (250, 1, ["a", "b", None, "", "ü", "z"]), (300, 2, ["a"]), (244, 1, ["a"]), (100, 7, ["b", "a", "c"])])
def test_against_brute_force(spark, n, depth, sources):
    data = rows(n, sources)
    out = manifest(spark.createDataFrame(data, SCHEMA), depth)
    assert out.dtypes == [("doc_id", "bigint"), *[(c, "string") for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")], ("verified", "boolean")]
    assert sorted((tuple(r) for r in out.collect()), key=repr) == brute(data)


def test_many_sources_are_blocks_too(spark):
    data = [(k, f"s{k % 40}", None, None, f"t{k}\n", None, None, None) for k in range(120)]
    assert sorted((tuple(r) for r in manifest(spark.createDataFrame(data, SCHEMA), 1).collect()), key=repr) == brute(data)


def test_odd_rows(spark):
    data = [(None, None, None, None, None, None, None, None), (None, None, None, None, "a\nb", None, None, None), (4, None, None, None, "", "x", "y", "z"), (4, None, None, None, "", "x", "y", "z"), (4, None, None, None, "other\n", "x", "y", "z"),
            (5, "", "", 0, "long \n" * 300_000, None, None, None), (6, "s", None, -3, "\n\n", None, None, None), (8, "s", None, 2, None, None, None, None)]
    out = manifest(spark.createDataFrame(data, SCHEMA), 1).collect()
    assert sorted((tuple(r) for r in out), key=repr) == brute(data)
    assert {r.verified for r in out} == {True, False}
    assert manifest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_one_round_is_one_exchange_without_joins(spark):
    from nightwave.llm.merkle import _round
    state = spark.createDataFrame([(0, b, 8, f"d{b}", []) for b in range(9)], "tree long, block long, last long, digest string, path array<struct<left:string,right:string>>")
    plan = _round(state, 3, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1 and "Join" not in plan
