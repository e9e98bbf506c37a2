import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from nightwave.config import Config
from nightwave.operators import events, scoring, smoothing
from nightwave.plans import queries


def trace(spark, values, rid="r"):
    return spark.createDataFrame([(rid, i, float(v)) for i, v in enumerate(values)], "recording_id string, frame_idx long, prob double")


def values(df):
    return [r.prob for r in df.orderBy("frame_idx").collect()]


def test_median_of_even_width_is_the_upper_one(spark):
    assert values(smoothing.median_filter(trace(spark, range(10)), 10)) == [2, 2, 2, 3, 4, 5, 6, 7, 7, 7]
    assert values(smoothing.median_filter(trace(spark, [0] * 3 + [1] + [0] * 8), 10)) == [0] * 12
    assert values(smoothing.median_filter(trace(spark, [0] * 5 + [1] * 5 + [0] * 5), 10)) == [0] * 5 + [1] * 6 + [0] * 4


def test_uniform_filter_mirrors_the_edges(spark):
    got = values(smoothing.uniform_filter(trace(spark, range(20)), 20))
    assert got[0] == 4.5 and got[10] == 9.5 and got[19] == pytest.approx(14.45)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 40])
def test_padding_equals_numpy(spark, n):
    got = [r.prob for r in smoothing.reflect_pad(trace(spark, range(n)), 10, 9).orderBy("frame_idx").collect()]
    assert got == np.pad(np.arange(n), (10, 9), mode="symmetric").tolist()


def test_widths():
    assert (smoothing.filter_width(100, 0.01), smoothing.filter_width(200, 0.01), smoothing.filter_width(200, 1.0)) == (10, 20, 1)


def plain_events(p, hop, cfg):
    """The sequential algorithm."""
    on, runs, k = p >= cfg.threshold, [], 0
    while k < len(p):
        if on[k]:
            e = k
            while e + 1 < len(p) and on[e + 1]:
                e += 1
            runs.append((k, e, [p[k:e + 1].mean()]))
            k = e
        k += 1
    merged = runs[:1]
    for s, e, c in runs[1:]:
        if round((s - merged[-1][1]) * hop, 6) <= cfg.merge_gap_s:
            merged[-1] = (merged[-1][0], e, merged[-1][2] + c)
        else:
            merged.append((s, e, c))
    out = []
    for s, e, c in merged:
        a, b = max(0.0, round(s * hop - cfg.padding_s, 6)), min(round((len(p) - 1) * hop, 6), round(e * hop + cfg.padding_s, 6))
        if round(b - a, 6) >= cfg.min_duration_s:
            out.append((round(a, 4), round(b, 4), round(float(np.mean(c)), 4)))
    return out


def found(df):
    return [(r.start, r.end, r.confidence) for r in df.orderBy("event_id").collect()]


def test_hand_worked_events(spark):
    cfg = Config(hop_ms=100)
    p = np.zeros(20)
    p[2:6], p[7:10], p[14] = (0.8, 0.6, 0.6, 0.8), 0.4, 0.9
    assert found(events.group_frames(trace(spark, p), cfg)) == [(0.1, 1.0, 0.55)]
    p = np.zeros(20)
    p[0:5], p[15:20] = 0.5, 0.5
    assert found(events.group_frames(trace(spark, p), cfg)) == [(0.0, 0.5, 0.5), (1.4, 1.9, 0.5)]


def test_ties_at_gap_duration_and_threshold(spark):
    p = np.zeros(200)
    p[20:41], p[70:80] = 0.3, 0.3  # a gap of exactly 30 frames
    assert found(events.group_frames(trace(spark, p))) == [(0.1, 0.89, 0.3)]
    p = np.zeros(100)
    p[30:51] = 0.3  # 0.2 s and twice 0.1 s of padding
    assert found(events.group_frames(trace(spark, p))) == [(0.2, 0.6, 0.3)]


@pytest.mark.parametrize("seed", range(4))
def test_equals_the_sequential_algorithm(spark, seed):
    rng = np.random.default_rng(seed)
    p = np.round(np.repeat(rng.random(60), rng.integers(1, 40, 60)) * rng.choice([0.5, 1], 1), 3)
    df = trace(spark, p).orderBy(F.rand(seed))
    got, want = found(events.group_frames(df)), plain_events(p, 0.01, Config())
    assert [x[:2] for x in got] == [x[:2] for x in want] and np.allclose([x[2] for x in got], [x[2] for x in want], atol=1.01e-4)


def test_nothing_on_and_counts(spark):
    df = trace(spark, [0.1] * 50).unionByName(trace(spark, [0.9] * 60, "s"))
    recs = spark.createDataFrame([("r", 0.5), ("s", 0.6), ("t", 0.0)], "recording_id string, duration_s double")
    own = events.group_frames(df)
    assert {r.recording_id: (r.n_events, r.total_s, r.percent) for r in events.event_summary(own, recs).collect()} == {"r": (0, 0.0, 0.0), "s": (1, 0.59, 98.3333), "t": (0, 0.0, 0.0)}
    assert {r.recording_id: (r.n_raw, r.n_merged, r.n_kept) for r in events.event_counts(df).collect()} == {"r": (0, 0, 0), "s": (1, 1, 1)}
    assert events.group_frames(df.limit(0)).count() == 0
    assert [(r.event_id, r.n_more) for r in events.top_events(own, 0).collect()] == []


def test_labels_targets_and_score(spark):
    labels = spark.createDataFrame(list(enumerate(["Snoring", "Snort", "Breathing", "Wheeze", "Speech"])), "class_id int, label string")
    targets = scoring.resolve_targets(labels)
    groups = {g: sorted(r.class_id for r in targets.filter(F.col("grp") == g).collect()) for g in ("snore", "breath")}
    assert groups == {"snore": [0, 1], "breath": [1, 2, 3]}
    probs = spark.createDataFrame([("r", 0, 1.0, [0.2, 0.5, 0.1, 0.1, 0.1])], "recording_id string, window_id long, center_s double, probs array<double>")
    assert scoring.aggregate_score(probs, targets).first().score == 0.5
    only = scoring.resolve_targets(spark.createDataFrame([(0, "Breathing"), (1, "Speech")], "class_id int, label string"))
    assert [(r.class_id, r.grp) for r in only.collect()] == [(0, "snore")]
    assert scoring.aggregate_score(probs.withColumn("probs", F.array(F.lit(0.4), F.lit(0.6))), only).first().score == pytest.approx(0.4)
    with pytest.raises(ValueError):
        scoring.resolve_targets(spark.createDataFrame([(1, "Speech")], "class_id int, label string"))


def test_interpolation(spark):
    scores = spark.createDataFrame([("r", 0, 1.0, 0.2), ("r", 1, 1.5, 0.7), ("r", 2, 2.0, 0.4)], "recording_id string, window_id long, center_s double, score double")
    recs = spark.createDataFrame([("r", 16_000, 41_600)], "recording_id string, sample_rate int, n_samples long")
    got = {r.frame_idx: r.prob for r in scoring.interpolate_frames(scores, recs).collect()}
    assert sorted(got) == list(range(260))
    assert [got[i] for i in (0, 50, 100, 110, 119, 250)] == pytest.approx([0.2, 0.2, 0.2, 0.3, 0.39, 0.4])
    short = recs.withColumn("n_samples", F.lit(19_200))
    assert scoring.interpolate_frames(scores, short).count() == 120


def test_strict_and_non_strict_counts(spark):
    scores = spark.createDataFrame([("r", 0.3), ("r", 0.31)], "recording_id string, score double")
    assert scoring.window_stats(scores).first().n_over == 1
    assert scoring.trace_stats(trace(spark, [0.3, 0.2]), 0.3).first().n_on == 1


def test_label_queries_over_all_parts(spark, tmp_path):
    spark.createDataFrame([(i, "a ring" if i % 2 else "a bolt") for i in range(200)], "p_partkey long, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    run = lambda name: queries.QUERIES[name](spark, str(tmp_path)).collect()
    assert [r.class_id for r in run("w4_label_lookup_all")] == list(range(1, 200, 2))
    assert len(run("w5_targets_all")) == 100 + 200 and len(run("w4_label_lookup")) == 100 and len(run("w5_targets")) == 200


def test_default_keywords(spark):
    labels = ["Snoring", "SNORT", "Wheezing", "Breathing", "out of breath", "Sneeze", "Wheel"]
    targets = scoring.resolve_targets(spark.createDataFrame(list(enumerate(labels)), "class_id int, label string")).collect()
    assert sorted((r.grp, labels[r.class_id]) for r in targets) == [("breath", "Breathing"), ("breath", "SNORT"), ("breath", "Wheezing"), ("breath", "out of breath"), ("snore", "SNORT"), ("snore", "Snoring")]


@pytest.mark.parametrize("block", [30, 47, 64])
def test_smoothing_and_runs_do_not_depend_on_blocks(spark, block):
    rng = np.random.default_rng(block)
    p = np.round(np.repeat(rng.random(30), rng.integers(1, 40, 30)), 3)
    df = trace(spark, p).unionByName(trace(spark, p[:7], "short")).unionByName(trace(spark, p[:block], "one")).unionByName(trace(spark, p[:block + 1], "more"))
    rows = lambda d: sorted(tuple(r) for r in d.collect())
    assert rows(smoothing.smooth_probabilities(df, block=block)) == rows(smoothing.smooth_probabilities(df))
    mask = events.threshold_mask(df)
    assert rows(events.find_runs(mask, block=block)) == rows(events.find_runs(mask))
    with pytest.raises(ValueError):
        smoothing.smooth_probabilities(df, block=29)


def test_confidences_are_exact_at_ties(spark):
    df = trace(spark, [0.3, 0.300001, 0.1, 0.9])
    assert [r.confidence for r in events.find_runs(events.threshold_mask(df)).orderBy("first_frame").collect()] == [0.3000005, 0.9]
    assert spark.createDataFrame([(0.3000005,)], "confidence double").select(events.to_digits("confidence", 6)).first()[0] == 0.300001


@pytest.mark.parametrize("size", [1, 2, 9, 10, 333])
def test_running_order_statistic_and_mean(size):
    x = np.round(np.random.default_rng(size).random(700), 2)  # many ties
    w = np.lib.stride_tricks.sliding_window_view(x, size)
    assert np.array_equal(smoothing.running_rank(x, size, size // 2), np.sort(w, axis=1)[:, size // 2])
    assert np.allclose(smoothing.running_mean(x, size), w.mean(axis=1), atol=1e-15, rtol=0)
    assert np.allclose(smoothing.running_mean(x * 1e6 - 5e5, size), (w * 1e6 - 5e5).mean(axis=1), atol=1e-6, rtol=0)


def test_wide_filters_cost_what_narrow_ones_do():
    x, took = np.random.default_rng(0).random(60_000), {}
    for size in (20, 2000):
        for run in (lambda n: smoothing.running_rank(x, n, n // 2), lambda n: smoothing.running_mean(x, n)):
            start = time.perf_counter()
            for _ in range(5):
                run(size)
            took[size] = took.get(size, 0) + time.perf_counter() - start
    assert took[2000] < 2 * took[20]


def test_wide_filters_over_short_and_long_traces(spark):
    x = np.round(np.random.default_rng(1).random(5000), 3)
    df = trace(spark, x).unionByName(trace(spark, x[:50], "short"))
    got = smoothing.smooth_probabilities(df, median_ms=10_000, uniform_ms=20_000, block=3001)
    for rid, own in (("r", x), ("short", x[:50])):
        mid = np.sort(np.lib.stride_tricks.sliding_window_view(np.pad(own, (500, 499), mode="symmetric"), 1000), axis=1)[:, 500]
        mean = np.lib.stride_tricks.sliding_window_view(np.pad(mid, (1000, 999), mode="symmetric"), 2000).mean(axis=1)
        assert np.allclose(values(got.filter(F.col("recording_id") == rid)), mean, atol=1e-6)


def test_scores_are_linear_in_the_classes(spark):
    groups, rng, took = scoring.Groups((3, 5), (5, 7, 900)), np.random.default_rng(0), {}
    for classes in (64, 527, 2048):
        x = rng.normal(size=(2000, classes))
        p = np.exp(x) / np.exp(x).sum(axis=1, keepdims=True)
        breath = p[:, [5, 7] + [900] * (classes > 900)].max(axis=1)
        start = time.perf_counter()
        got = groups.scores(x)
        took[classes] = time.perf_counter() - start
        assert np.allclose(got, (2 * p[:, [3, 5]].max(axis=1) + breath) / 3)
    assert took[527] < 1 and took[2048] < 100 * took[64]  # 2,000 windows of 527 classes in a second, and no square of the classes
    rows = [("r", k, float(k), [float(v) for v in rng.normal(size=2048)]) for k in range(200)]
    df = spark.createDataFrame(rows, "recording_id string, window_id long, center_s double, logits array<double>").repartition(1).cache()
    df.count()
    start = time.perf_counter()
    probs = df.select(scoring.softmax_probs("logits").alias("p")).select(F.aggregate("p", F.lit(0.0), lambda s, v: s + v).alias("s")).collect()
    assert time.perf_counter() - start < 20 and all(abs(r.s - 1) < 1e-9 for r in probs)  # a square would be 800 million steps
    got = {r.window_id: r.score for r in scoring.score_logits(df, groups).collect()}
    assert np.allclose([got[k] for k in range(200)], groups.scores(np.array([r[3] for r in rows])))


def test_groups_without_classes():
    assert scoring.Groups((), ()).scores(np.ones((2, 3))).tolist() == [0, 0]
    assert scoring.Groups((9,), (1,)).scores(np.zeros((1, 2))).tolist() == [0.5]
    assert np.isfinite(scoring.Groups((0,), ()).scores(np.array([[1000.0, -1000.0]]))).all()


@pytest.mark.parametrize("block", [30, 64, smoothing.BLOCK])
def test_frames_made_by_blocks_are_those_of_windows(spark, block):
    rng = np.random.default_rng(block)
    rows = [(rid, k, 1.0 + 0.5 * k, float(np.round(rng.random(), 3))) for rid, n in (("long", 40), ("one", 1), ("two", 2)) for k in range(n)]
    scores = spark.createDataFrame(rows, "recording_id string, window_id long, center_s double, score double")
    recs = spark.createDataFrame([("long", 16_000, 320_000), ("one", 16_000, 500), ("two", 8000, 9001), ("none", 8000, 10)], "recording_id string, sample_rate int, n_samples long")
    got = lambda d: sorted(tuple(r) for r in d.collect())
    want = got(smoothing.smooth_probabilities(scoring.interpolate_frames(scores, recs)))
    assert len(want) == 2000 + 4 + 113 and got(smoothing.smooth_windows(scores, recs, block=block)) == want
