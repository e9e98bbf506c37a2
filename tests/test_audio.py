import glob
import os
import struct
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from nightwave.config import Config
from nightwave.functions import kernels
from nightwave.operators import chunks as ch
from nightwave.operators import clips, denoise, features, windows
from nightwave.plans import pipeline, queries
from nightwave.sources import catalogue, files, tables, wav

CHUNKS = "recording_id string, channel int, chunk_id long, start_sample long, sample_rate int, samples array<float>"


def chunked(spark, signals, rate, size):
    rows = [(rid, c, k // size, k, rate, [float(v) for v in x[c][k:k + size]]) for rid, x in signals.items() for c in range(len(x)) for k in range(0, len(x[c]), size)]
    return spark.createDataFrame(rows, CHUNKS)


def joined(df):
    out = {}
    for r in df.collect():
        out.setdefault((r.recording_id, r.channel), []).append((r.start_sample, r.samples))
    return {k: np.concatenate([np.array(x) for _, x in sorted(v, key=lambda p: p[0])]) for k, v in out.items()}


RNG = np.random.default_rng(0)
SIGNAL = (np.sin(np.arange(9000) * 0.05) * 0.4 + RNG.normal(size=9000) * 0.1).astype(np.float32)


def test_channels_and_catalogue(spark):
    df = chunked(spark, {"one": [SIGNAL[:700]], "three": [SIGNAL[:500], SIGNAL[500:1000], SIGNAL[1000:1500]]}, 1000, 300)
    assert {r.recording_id: (r.n_channels, r.n_samples, r.duration_s) for r in ch.recordings(df).collect()} == {"one": (1, 700, 0.7), "three": (3, 500, 0.5)}
    assert np.allclose(joined(ch.to_mono(df))["three", 0], (SIGNAL[:500] + SIGNAL[500:1000] + SIGNAL[1000:1500]) / 3, atol=1e-6)
    two = joined(ch.to_stereo(df))
    assert sorted(two) == [("one", 0), ("one", 1), ("three", 0), ("three", 1)] and np.array_equal(two["one", 0], two["one", 1])
    back = joined(ch.match_channels(ch.to_stereo(df), ch.recordings(df)))
    assert sorted(back) == [("one", 0), ("three", 0), ("three", 1)] and np.allclose(back["one", 0], SIGNAL[:700])


@pytest.mark.parametrize("size", [512, 1000, 9000])
def test_windows_do_not_depend_on_chunks(spark, size):
    df = windows.make_windows(chunked(spark, {"r": [SIGNAL[:2300]]}, 1000, size), 0.4, 0.15)
    rows = df.orderBy("window_id").collect()
    padded = np.concatenate([SIGNAL[:2300], np.zeros(400, np.float32)])
    assert [r.window_id for r in rows] == list(range(-(-2300 // 150)))
    assert all(np.array_equal(np.array(r.samples, np.float32), padded[r.window_id * 150:r.window_id * 150 + 400]) and r.center_s == pytest.approx((r.window_id * 150 + 200) / 1000) for r in rows)


def test_windows_of_short_and_no_recordings(spark):
    df = chunked(spark, {"r": [np.ones(19_200, np.float32)]}, 16_000, 480_000)
    rows = windows.make_windows(df).orderBy("window_id").collect()
    assert [(r.center_s, len(r.samples), sum(r.samples)) for r in rows] == [(1.0, 32_000, 19_200), (1.5, 32_000, 11_200), (2.0, 32_000, 3200)]
    assert windows.make_windows(df.limit(0)).count() == 0
    got = windows.score_windows(windows.make_windows(df), lambda x: np.stack([x.sum(axis=1), np.full(len(x), len(x))], axis=1), 2).collect()
    assert len(got) == 3 and max(r.logits[1] for r in got) <= 2


def test_stitching_and_overlap_identity(spark):
    df = chunked(spark, {"r": [SIGNAL]}, 1000, 3000)
    assert np.array_equal(joined(ch.stitch(ch.with_halo(df, 500, 300)))["r", 0], SIGNAL)
    assert np.allclose(joined(ch.overlap_apply(df, lambda x, r: x, 1.0, 0.25))["r", 0], SIGNAL, atol=1e-6)
    assert np.allclose(joined(ch.overlap_apply(df, lambda x, r: x * 2, 1.0, 0.25))["r", 0], SIGNAL * 2, atol=1e-6)


def test_resampling_does_not_depend_on_chunks(spark):
    tone = np.sin(2 * np.pi * 40 * np.arange(6000) / 1000).astype(np.float32)
    a = joined(ch.resample(chunked(spark, {"r": [tone]}, 1000, 6000), 441))["r", 0]
    b = joined(ch.resample(chunked(spark, {"r": [tone]}, 1000, 700), 441))["r", 0]
    assert len(a) == -(-6000 * 441 // 1000) and np.allclose(a, b, atol=1e-6)
    want = np.sin(2 * np.pi * 40 * np.arange(len(a)) / 441)
    assert np.abs(a - want)[100:-100].max() < 5e-3
    same = chunked(spark, {"r": [tone]}, 1000, 700)
    assert np.array_equal(joined(ch.resample(same, 1000))["r", 0], tone)


@pytest.mark.parametrize(("rate", "target"), [(44_100, 16_000), (8000, 16_000), (11_025, 16_000)])
def test_the_filter_bank_equals_a_sinc_for_each_output(rate, target):
    x = np.concatenate([SIGNAL, SIGNAL])[:3 * rate // 10]
    reach, cut, place = kernels.sinc_reach(rate, target, 16), min(1, target / rate), np.arange(-(-len(x) * target // rate)) * rate / target
    d = np.arange(len(x))[None] - place[:, None]
    full = np.arange(-reach, len(x) + reach)[None] - place[:, None]  # of a tap sum, also beyond the ends
    taps = lambda d: np.sinc(cut * d) * np.where(np.abs(d) < 16 / cut, 0.5 + 0.5 * np.cos(np.pi * d * cut / 16), 0)
    want = (taps(d) * x).sum(axis=1) / taps(full).sum(axis=1)
    assert np.allclose(kernels.resample(x, 0, 0, 0, rate, target, 16), want, atol=1e-6)


def test_a_long_chunk_is_resampled_in_little_memory():
    x = np.sin(2 * np.pi * 440 * np.arange(30 * 44_100) / 44_100).astype(np.float32)
    tracemalloc.start()
    y = kernels.resample(x, 0, 0, 0, 44_100, 16_000, 16)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6 and len(y) == 480_000
    assert np.abs(y - np.sin(2 * np.pi * 440 * np.arange(480_000) / 16_000))[100:-100].max() < 5e-3


def test_gate_and_fallback(spark):
    df = chunked(spark, {"r1": [SIGNAL], "r2": [SIGNAL[::-1].copy()]}, 1000, 3000)
    assert np.allclose(joined(denoise.spectral_gate(df, 0.0))["r1", 0], SIGNAL, atol=1e-5)
    gated = joined(denoise.spectral_gate(df, 0.8))
    assert len(gated["r1", 0]) == len(SIGNAL) and (gated["r1", 0] ** 2).sum() < (SIGNAL**2).sum()
    noise = np.concatenate([SIGNAL[:2000] * 0 + RNG.normal(size=2000).astype(np.float32) * 0.05, SIGNAL[2000:]])
    quiet = joined(denoise.spectral_gate(chunked(spark, {"r": [noise]}, 1000, 3000), 1.0, stationary=True))["r", 0]
    assert (quiet[300:1700] ** 2).mean() < 0.3 * (noise[300:1700] ** 2).mean()

    def fails(x, row):
        if row["recording_id"] == "r2":
            raise RuntimeError
        return x * 0

    done = joined(denoise.denoise(df, "model", fails))
    assert not done["r1", 0].any() and np.allclose(done["r2", 0], gated["r2", 0], atol=1e-6)
    with pytest.raises(ValueError):
        denoise.denoise(df, "x")


@pytest.mark.parametrize("stationary", [False, True])
def test_the_gate_does_not_depend_on_chunks(spark, stationary):
    x = np.tile(SIGNAL, 5)[:40_000]
    a, b, c = (joined(denoise.spectral_gate(chunked(spark, {"r": [x]}, 1000, size), 0.9, stationary))["r", 0] for size in (40_000, 10_007, 3000))
    assert len(a) == len(x) and np.allclose(a, b, atol=1e-5) and np.allclose(a, c, atol=1e-5)
    sizes = denoise.spectral_gate(chunked(spark, {"r": [x]}, 1000, 3000)).select(F.size("samples").alias("n")).distinct().collect()
    assert {r.n for r in sizes} == {3000, 1000}


def test_overlap_keeps_chunks_and_halos_are_checked(spark):
    df = chunked(spark, {"r": [SIGNAL, SIGNAL], "s": [SIGNAL[:10], SIGNAL[:10]]}, 1000, 1024)
    out = ch.overlap_apply(df, lambda x, r: x, 0.7, 0.5)
    key = lambda d: sorted((r.recording_id, r.channel, r.chunk_id, r.start_sample, len(r.samples)) for r in d.collect())
    assert key(out) == key(df) and np.allclose(joined(out)["r", 1], SIGNAL, atol=1e-6)
    for wrong in (-0.1, 0.6):
        with pytest.raises(ValueError):
            ch.overlap_apply(df, lambda x, r: x, 0.7, wrong)
    for left, right in ((1500, 0), (0, 1500)):
        with pytest.raises(Exception, match="longer than a chunk"):
            ch.with_halo(df, left, right).collect()
    assert ch.with_halo(df.filter("recording_id = 's'"), 1500, 1500).count() == 2


def test_a_kernel_at_its_own_rate_and_channels(spark):
    t = np.arange(12_000) / 1000
    tone = [np.sin(2 * np.pi * f * t).astype(np.float32) * 0.5 for f in (30, 50, 70)]
    df = chunked(spark, {"one": tone[:1], "two": tone[:2], "three": tone, "bad": [tone[2]]}, 1000, 10_000)
    seen = spark.sparkContext.accumulator(0)

    def kernel(x, row):
        assert x.shape[0] == 2 and row["sample_rate"] == 1600
        if row["recording_id"] == "bad":
            raise RuntimeError
        seen.add(x.shape[1])
        return x[::-1] * 0.5

    out = joined(denoise.denoise(df, "model", kernel, kernel_rate=1600, kernel_channels=2, segment_s=3.0))
    assert sorted(out) == [("bad", 0), ("one", 0), ("three", 0), ("three", 1), ("two", 0), ("two", 1)]
    middle = slice(200, -200)
    assert all(len(v) == 12_000 for v in out.values())
    assert np.allclose(out["one", 0][middle], tone[0][middle] / 2, atol=0.01)
    assert np.allclose(out["two", 0][middle], tone[1][middle] / 2, atol=0.01) and np.allclose(out["three", 1][middle], tone[0][middle] / 2, atol=0.01)
    assert np.allclose(out["bad", 0], joined(denoise.spectral_gate(df))["bad", 0], atol=1e-6)
    segments = -(-12_000 * 1600 // 1000 // 3600)
    assert seen.value <= 3 * (19_200 + segments * 1200)  # each segment once


def test_clip_rounding_silence_and_names(spark):
    recs = spark.createDataFrame([("r", 10, 100)], "recording_id string, sample_rate int, n_samples long")
    x = np.ones(100, np.float32)
    x[50:60] = 0
    df = chunked(spark, {"r": [x]}, 10, 7)
    segs = spark.createDataFrame([("r", 1, 0.25, 0.35, 0.5), ("r", 2, 5.0, 6.0, 0.5), ("r", 3, 20.0, 21.0, 0.5)], "recording_id string, event_id int, start double, end double, confidence double")
    ranges = clips.event_samples(segs, recs)
    assert [(r.start_sample, r.end_sample) for r in ranges.orderBy("event_id").collect()] == [(2, 4), (50, 60), (99, 100)]
    cut = clips.cut_clips(ranges.drop("n_samples"), df, 7)
    got = clips.manifest(clips.name_clips(clips.drop_silent(cut))).orderBy("clip_file").collect()
    assert [(r.clip_file, r.start_time, r.end_time, r.duration) for r in got] == [("snore_0001.wav", 0.25, 0.35, 0.2), ("snore_0002.wav", 20.0, 21.0, 0.1)]
    assert clips.cut_stats(cut).first().asDict() == {"recording_id": "r", "n_saved": 2, "n_silent": 1, "saved_s": 0.3}
    edge = cut.withColumn("sum_squares", F.col("n_values") * 1e-10)
    assert clips.drop_silent(edge, 1e-5).count() == 3


def test_long_clips_stay_pieces(spark, tmp_path):
    x = RNG.uniform(-0.9, 0.9, (2, 10_000)).astype(np.float32)
    df = chunked(spark, {"r": list(x)}, 1000, 64)
    segs = spark.createDataFrame([("r", 1, 0.0, 10.0, 0.5), ("r", 2, 0.05, 9.999, 0.5), ("r", 3, 3.0, 3.01, 0.5)], "recording_id string, event_id int, start double, end double, confidence double")
    ranges = clips.event_samples(segs, spark.createDataFrame([("r", 1000, 10_000)], "recording_id string, sample_rate int, n_samples long")).drop("n_samples")
    pieces = clips.cut_pieces(ranges, df, 64)
    assert pieces.select(F.max(F.size(F.col("samples")[0]))).first()[0] == 64  # a row is a chunk at most
    named = clips.name_clips(clips.clips_of(pieces))
    assert "samples" not in named.columns
    a, b = str(tmp_path / "pieces"), str(tmp_path / "clips")
    wav.write_pieces(named, pieces, a)
    wav.write_clips(clips.name_clips(clips.cut_clips(ranges, df, 64)), b)
    for k in (1, 2, 3):
        one, two = (open(f"{d}/r/snore_clips/snore_{k:04d}.wav", "rb").read() for d in (a, b))
        assert one == two
    assert len(open(f"{a}/r/snore_clips/snore_0001.wav", "rb").read()) == 44 + 4 * 10_000
    none = clips.cut_pieces(ranges.limit(0), df, 64)
    wav.write_pieces(clips.name_clips(clips.clips_of(none)), none, str(tmp_path / "none"))
    assert clips.clips_of(none).count() == 0


@pytest.mark.parametrize("order", [1, 2])
def test_slopes_do_not_depend_on_blocks(spark, order):
    lengths = {"a": 9, "b": 10, "c": 16, "d": 17, "e": 35, "f": 64, "g": 201}
    x = {k: RNG.normal(size=(n, 3)) for k, n in lengths.items()}
    df = spark.createDataFrame([(k, i, v.tolist(), i * 2) for k, m in x.items() for i, v in enumerate(m)], "recording_id string, frame_idx long, x array<double>, other int").repartition(5)
    weights = (features.SLOPE, features.CURVE)[order - 1]
    for block in (8, 9, 16, 1024):
        rows = features.slopes(df, "x", {"d": order}, block=block).collect()
        assert len(rows) == sum(lengths.values()) and all(r.other == 2 * r.frame_idx for r in rows)
        for r in rows:
            at = min(max(r.frame_idx, 4), lengths[r.recording_id] - 5)
            want = sum(w * x[r.recording_id][at + k] for k, w in zip(range(-4, 5), weights))
            assert np.allclose(r.d, want, atol=1e-12), (block, r.recording_id, r.frame_idx)


def test_slopes_of_odd_rows(spark):
    schema = "recording_id string, frame_idx long, x array<double>"
    for bad in ([0, 1, 2, 3, 5, 6, 7, 8, 9], [0, 1, 2, 3, 4, 4, 5, 6, 7, 8]):
        with pytest.raises(Exception, match="gaps"):
            features.slopes(spark.createDataFrame([("r", i, [1.0]) for i in bad], schema), "x", {"d": 1}).collect()
    assert features.slopes(spark.createDataFrame([], schema), "x", {"d": 1, "e": 2}).count() == 0
    short = features.slopes(spark.createDataFrame([("r", i, [1.0, 2.0]) for i in range(8)], schema), "x", {"d": 1}, "null", block=8).collect()
    assert len(short) == 8 and all(r.d == [None, None] for r in short)
    with pytest.raises(ValueError):
        features.slopes(spark.createDataFrame([], schema), "x", {"d": 1}, block=7)


def test_moments_equal_two_passes(spark):
    x = RNG.normal(size=(5000, 4)) * [1, 1e-3, 1e6, 0] + [0, 1e6, -1e9, 7]
    ids = np.where(RNG.random(5000) < 0.6, "hot", RNG.integers(0, 400, 5000).astype(str))
    df = spark.createDataFrame([(str(i), k, v.tolist()) for k, (i, v) in enumerate(zip(ids, x))] + [("none", 0, None)], "recording_id string, frame_idx long, features array<double>").repartition(7)
    got = {r.recording_id: r for r in features.moments(df, "features").collect()}
    assert set(got) == set(map(str, ids))  # more recordings than a task keeps states of
    for k, r in got.items():
        own = x[ids == k]
        assert r.n == len(own) and np.array_equal(r.top, own.max(axis=0))
        assert np.allclose(r.mean, own.mean(axis=0), rtol=1e-12) and np.allclose(np.array(r.m2) / r.n, own.var(axis=0), rtol=1e-6, atol=1e-18)
    z = features.normalize_features(df.filter("recording_id = 'hot'")).select("normalized").toPandas()["normalized"]
    z = np.stack(z)
    assert np.allclose(z.mean(axis=0), 0, atol=1e-4) and np.allclose(z[:, :3].std(axis=0), [1, 1 / (1 + 1e-5), 1], atol=1e-3) and not z[:, 3].any()


def test_frame_parameters(spark):
    want = {8000: (200, 80, 512), 11_025: (275, 110, 1024), 16_000: (400, 160, 1024), 22_050: (551, 220, 2048), 44_100: (1102, 441, 4096), 48_000: (1200, 480, 4096)}
    df = spark.createDataFrame([(r,) for r in want], "sample_rate int").select("sample_rate", *features.frame_params())
    assert {r[0]: tuple(r)[1:] for r in df.collect()} == want == {r: features.params_of(r) for r in want}


def test_levels_slopes_and_scores(spark):
    mel = spark.createDataFrame([("r", 0, [1.0, 1e-3, 1e-12])], "recording_id string, frame_idx long, mel array<double>")
    assert features.power_to_db(mel).first().mel_db == pytest.approx([0, -30, -80])
    line = spark.createDataFrame([("r", i, [float(i), float(i * i)]) for i in range(12)], "recording_id string, frame_idx long, x array<double>")
    d = features.delta(features.delta(line, "x", "d1"), "x", "d2", 2).orderBy("frame_idx").collect()
    assert [r.d1[0] for r in d] == pytest.approx([1] * 12) and [r.d2[1] for r in d] == pytest.approx([2] * 12)
    assert len({round(r.d1[1], 9) for r in d[:5]}) == 1 == len({round(r.d1[1], 9) for r in d[-5:]})
    with pytest.raises(Exception, match="nine frames"):
        features.delta(line.filter("frame_idx < 8"), "x", "d").collect()
    two = spark.createDataFrame([("r", 0, [1.0, 7.0]), ("r", 1, [3.0, 7.0])], "recording_id string, frame_idx long, features array<double>")
    assert [r.normalized for r in features.normalize_features(two).orderBy("frame_idx").collect()] == [pytest.approx([-1, 0]), pytest.approx([1, 0])]
    silent = spark.createDataFrame([([0.0] * 33,)], "m array<double>")
    assert silent.select(features.spectral_centroid("m", F.lit(1.0)), features.spectral_rolloff("m", F.lit(1.0))).first() == (0, 0)


def test_features_do_not_depend_on_chunks(spark):
    x = (np.sin(np.arange(40_000) * 0.3) * 0.3 + RNG.normal(size=40_000) * 0.05).astype(np.float32)
    a, b = (features.frame_table(chunked(spark, {"r": [x]}, 16_000, size)).orderBy("frame_idx").toPandas() for size in (40_000, 13_000))
    assert len(a) == len(b) == 1 + 40_000 // 160
    for c in ("spectral_centroid", "spectral_rolloff", "zcr", "hnr"):
        assert np.allclose(a[c], b[c], atol=1e-3), c
    assert np.allclose(np.stack(a["mel"]), np.stack(b["mel"]), rtol=1e-6, atol=1e-9)
    with pytest.raises(ValueError):
        features.frame_table(chunked(spark, {"r": [x[:100], x[:100]]}, 16_000, 100))


def test_odd_frames_are_one_fewer(spark):
    df = features.frame_table(chunked(spark, {"r": [np.ones(1100, np.float32)]}, 11_025, 1100), compute_hnr=False)
    assert df.count() == 10


def test_short_recordings_keep_their_frames_without_slopes(spark):
    signals = {f"n{n}": [SIGNAL[:n]] for n in (1, 9, 80, 81, 99, 100)}
    rows = {}
    for r in features.extract_features(chunked(spark, signals, 1000, 16_384)).collect():
        rows.setdefault(r.recording_id, []).append(r)
    assert {k: len(v) for k, v in rows.items()} == {"n1": 1, "n9": 1, "n80": 8, "n81": 9, "n99": 10, "n100": 10}
    for k, v in rows.items():
        for r in v:
            assert len(r.features) == 252 and None not in r.features[:40] and None not in r.features[120:]
            assert (None in r.features[40:120]) == (k in ("n1", "n9", "n80")) == all(x is None for x in r.features[40:120])


def test_short_documents_have_feature_rows(spark, tmp_path):
    docs = [(1, "a" * 30), (2, "abc " * 60), (3, "")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["f11_f16_features"](spark, str(tmp_path)).groupBy("recording_id").count().collect()
    assert {r.recording_id: r["count"] for r in got} == {"1": 3, "2": 24}


def test_harmonic_part_of_a_tone():
    x = np.sin(2 * np.pi * 440 * np.arange(16_000) / 16_000).astype(np.float32)
    h = kernels.harmonic(x)
    assert ((x - h)[2000:-2000] ** 2).mean() < 0.05 * (x**2).mean()


def plain_filter(x, n, hop, share):
    """x through transforms written out, each bin of each frame times share(magnitudes)."""
    window = np.array([0.5 - 0.5 * np.cos(2 * np.pi * i / n) for i in range(n)])
    wave = np.exp(-2j * np.pi * np.outer(np.arange(n // 2 + 1), np.arange(n)) / n)
    twice = np.array([1] + [2] * (n // 2 - 1) + [1])
    held = np.concatenate([np.zeros(n // 2), x.astype(float), np.zeros(n // 2)])
    starts = range(0, len(x) + 1, hop)
    spec = np.stack([wave @ (held[a:a + n] * window) for a in starts])
    spec = spec * share(np.abs(spec))
    total, weight = np.zeros(len(held)), np.zeros(len(held))
    for a, f in zip(starts, spec):
        total[a:a + n] += (np.conj(wave).T @ (f * twice)).real / n * window
        weight[a:a + n] += window**2
    return np.where(weight > 1e-8, total / np.maximum(weight, 1e-8), 0)[n // 2:n // 2 + len(x)]


def test_hnr_equals_a_plain_computation(spark):
    def share(m):
        def medians(axis):
            held = np.pad(m, [(15, 15) if a == axis else (0, 0) for a in (0, 1)], mode="symmetric")
            return np.stack([np.median(held.take(range(i, i + 31), axis), axis) for i in range(m.shape[axis])], axis)

        return medians(0) ** 2 / (medians(0) ** 2 + (3 * medians(1)) ** 2)

    h = plain_filter(SIGNAL, 2048, 512, share)
    got = {r.frame_idx: r.hnr for r in features.frame_table(chunked(spark, {"a": SIGNAL[None]}, 8000, 2500)).collect()}
    assert len(got) == 113
    for k, hnr in got.items():
        near = [i for i in range(k * 80 - 100, k * 80 + 100) if 0 <= i < len(SIGNAL)]  # frames of 200 samples, zeros beyond
        kept, rest = (h[near] ** 2).sum() / 200, ((SIGNAL[near] - h[near]) ** 2).sum() / 200
        assert hnr == pytest.approx(10 * np.log10((kept + 1e-10) / (rest + 1e-10)), abs=1e-3)


def test_the_gate_equals_a_plain_computation(spark):
    def share(m):
        level = np.stack([m[max(0, i - 32):i + 33].mean(axis=0) for i in range(len(m))])
        return 1 - 0.8 * (1 - 1 / (1 + np.exp(-np.clip(((m - level) / np.maximum(level, 1e-10) - 2) * 10, -50, 50))))

    want = plain_filter(SIGNAL, 1024, 256, share)
    got = joined(denoise.denoise(chunked(spark, {"a": SIGNAL[None]}, 8000, 2500), "spectral", prop_decrease=0.8))
    assert np.allclose(got["a", 0], want, atol=1e-5) and np.abs(want - SIGNAL).max() > 0.05


def test_feature_tables_are_joined_where_they_lie(spark, tmp_path):
    recs = spark.createDataFrame([("a", 8000, 80 * 3000), ("b", 16_000, 160 * 500), ("none", 8000, 0)], "recording_id string, sample_rate int, n_samples long")
    frames = spark.createDataFrame([("a", k, float(k)) for k in range(3000)] + [("b", k, -float(k)) for k in range(500)] + [(None, 0, 0.0), ("a", None, 0.0)], "recording_id string, frame_idx long, x double").repartition(5)
    one = tables.write_features(frames, f"{tmp_path}/one", recs)
    two = tables.write_features(frames.withColumnRenamed("x", "y"), f"{tmp_path}/two", recs)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        both = features.align_frames(one, two.select("recording_id", "frame_idx", "y"))
        rows = both.collect()
        plan = both._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert len(rows) == 3500 and all(r.x == r.y and (r.sample_rate, r.hop_length) == ((8000, 80) if r.recording_id == "a" else (16_000, 160)) for r in rows)
    # a long recording is in all buckets
    assert len({f for f in one.filter("recording_id = 'a'").select(F.input_file_name()).distinct().collect()}) == 8
    # without its catalog entry, as in another application, and written anew with other buckets
    for t in spark.catalog.listTables():
        if t.name.startswith("frame_features_"):
            spark.sql(f"DROP TABLE {t.name}")
    assert sorted(tables.read_features(spark, f"{tmp_path}/one").collect()) == sorted(one.collect())
    again = tables.write_features(frames.filter("recording_id = 'b'"), f"{tmp_path}/one", recs, buckets=3)
    assert again.count() == 500 == tables.read_features(spark, f"file:{tmp_path}/one").count()
    assert tables.write_features(frames.limit(0), f"{tmp_path}/empty", recs.limit(0)).count() == 0


def test_running_medians_in_little_memory(monkeypatch):
    for shape in ((1, 1), (5, 40), (40, 5), (70, 33)):
        x = RNG.integers(0, 9, shape).astype(float)
        for axis in (0, 1):
            pad = [(0, 0), (0, 0)]
            pad[axis] = (15, 15)
            held = np.pad(x, pad, mode="symmetric")
            want = np.stack([np.median(held.take(range(i, i + 31), axis), axis) for i in range(shape[axis])], axis)
            for size in (1, 31 * 8 * 7, 16 << 20):
                monkeypatch.setattr(kernels, "MEDIAN_BYTES", size)
                assert np.array_equal(kernels.running_median(x, 31, axis), want)
    x = RNG.normal(size=(2000, 1025))
    tracemalloc.start()
    kernels.running_median(x, 31, 0)
    assert tracemalloc.get_traced_memory()[1] < 6 * x.nbytes  # all neighbours at once are 31 times as much
    tracemalloc.stop()


def write(path, x, rate, kind="pcm16", extra=b""):
    body = {"pcm16": lambda: (np.clip(np.rint(x * 32768), -32768, 32767)).astype("<i2").tobytes(), "float": lambda: x.astype("<f4").tobytes()}[kind]()
    width = 2 if kind == "pcm16" else 4
    fmt = struct.pack("<4sIHHIIHH", b"fmt ", 16, 1 if kind == "pcm16" else 3, x.shape[1], rate, rate * x.shape[1] * width, x.shape[1] * width, width * 8)
    path.write_bytes(struct.pack("<4sI4s", b"RIFF", 36 + len(body), b"WAVE") + fmt + extra + struct.pack("<4sI", b"data", len(body)) + body)


def test_wav_round_trip(spark, tmp_path):
    two = np.stack([SIGNAL[:5000], SIGNAL[4000:9000]], axis=1)
    write(tmp_path / "a.wav", two, 8000, extra=struct.pack("<4sI", b"LIST", 3) + b"abc\0")
    write(tmp_path / "b.wav", SIGNAL[:900, None], 11_025, "float")
    write(tmp_path / "c.wav", np.zeros((0, 1), np.float32), 8000)
    df = wav.read_wav(spark, str(tmp_path), 0.1)
    got = joined(df)
    assert {r.recording_id: r.n_samples for r in ch.recordings(df).collect()} == {"a": 5000, "b": 900, "c": 0}
    assert windows.make_windows(df.filter("recording_id = 'c'")).count() == 0 == features.frame_table(df.filter("recording_id = 'c'")).count()
    assert np.array_equal(got["a", 1], (np.rint(two[:, 1] * 32768) / 32768).astype(np.float32)) and np.array_equal(got["b", 0], SIGNAL[:900])
    wav.write_wav(df.filter("recording_id = 'a'"), str(tmp_path / "out"), "")
    assert (tmp_path / "out/a.wav").read_bytes()[-20_000:] == (tmp_path / "a.wav").read_bytes()[-20_000:]
    with pytest.raises(Exception, match="no recording"):
        wav.read_wav(spark, str(tmp_path / "missing.wav")).count()


def test_recordings_of_equal_names_in_several_folders(spark, tmp_path):
    for k, folder in enumerate(("x", "y/z")):
        (tmp_path / folder).mkdir(parents=True)
        write(tmp_path / folder / "night.wav", SIGNAL[:100 + k, None], 8000)
    assert {r.recording_id: r.n_samples for r in ch.recordings(wav.read_wav(spark, str(tmp_path))).collect()} == {"x_night": 100, "y_z_night": 101}
    with pytest.raises(Exception, match="one recording_id"):
        wav.read_wav(spark, [str(tmp_path / "x/night.wav"), str(tmp_path / "y/z/night.wav")]).count()


def test_manifests_have_headers_and_order(spark, tmp_path):
    kind = "recording_id string, clip_file string, start_time double, end_time double, duration double, confidence double"
    rows = [(f"r{i % 3}", f"snore_{i:04d}.wav", 0.5, 1.0, 0.5, 0.9) for i in range(50)]
    for name, own in (("some", rows), ("none", [])):
        tables.write_manifest(spark.createDataFrame(own, kind), str(tmp_path / name))
        files = sorted(glob.glob(f"{tmp_path}/{name}/*.csv"))
        lines = [open(f).read().splitlines() for f in files]
        assert files and all(x[0] == "recording_id,clip_file,start_time,end_time,duration,confidence" for x in lines)
        assert [x.split(",")[:2] for f in lines for x in f[1:]] == sorted([r[0], r[1]] for r in own)


def test_feature_parameters(spark):
    x = chunked(spark, {"r": [SIGNAL]}, 8000, 9000)
    got = features.extract_features(x, False, frame_ms=40, hop_ms=20, n_mfcc=13, n_mels=40).collect()
    assert len(got) == 1 + 9000 // 160 and {(len(r.mfcc), len(r.log_mel), len(r.features)) for r in got} == {(39, 40, 83)}


def test_each_window_is_scored_and_each_frame_computed_once(spark):
    scored = spark.sparkContext.accumulator(0)

    def scorer(w):
        scored.add(len(w))
        return np.stack([w.sum(axis=1), -w.sum(axis=1)], axis=1)

    labels = spark.createDataFrame([(0, "Snoring"), (1, "Silence")], "class_id int, label string")
    pipeline.detect_segments(chunked(spark, {"r": [SIGNAL]}, 1000, 3000), scorer, labels, Config(window_s=0.4, stride_s=0.1, model_rate=1000)).collect()
    assert scored.value == 90


def test_large_headers():
    head = files.wav_header(5 << 30, 44_100, 2)
    assert head[:4] == b"RF64" and struct.unpack("<Q", head[28:36])[0] == 5 << 30


def test_pipeline_end_to_end(spark, tmp_path):
    rate, rng = 16_000, np.random.default_rng(1)
    x = rng.normal(size=rate * 8) * 0.002
    x[rate * 3:rate * 5] += np.sin(2 * np.pi * 200 * np.arange(rate * 2) / rate) * 0.5
    write(tmp_path / "night.wav", x[:, None].astype(np.float32), rate)
    write(tmp_path / "still.wav", np.zeros((rate * 3, 1), np.float32), rate)
    labels = spark.createDataFrame([(0, "Snoring"), (1, "Silence")], "class_id int, label string")

    def scorer(w):
        level = np.log10((w.astype(np.float64) ** 2).mean(axis=1) + 1e-9)
        return np.stack([level + 3, -level - 3], axis=1)

    out = str(tmp_path / "out")
    got = pipeline.run(spark, [str(tmp_path / "night.wav"), str(tmp_path / "still.wav")], out, scorer, labels, Config(threshold=0.6, compute_hnr=False), chunk_seconds=4)
    rows = got.events.collect()
    assert len(rows) == 1 and rows[0].recording_id == "night" and 1.5 < rows[0].start < 3.2 and 4.8 < rows[0].end < 6.5
    assert {r.recording_id: r.n_events for r in got.summary.collect()} == {"night": 1, "still": 0}
    assert got.features.filter(F.size("features") == 252).count() == 801 + 301
    assert glob.glob(f"{out}/wav/night/snore_clips/*.wav") == [f"{out}/wav/night/snore_clips/snore_0001.wav"]
    assert open(f"{out}/wav/still/manifest.csv").read().strip() == "clip_file,start_time,end_time,duration,confidence"
    assert os.path.getsize(f"{out}/wav/night_denoised.wav") == 44 + 2 * rate * 8
    with pytest.raises(FileNotFoundError):
        tables.load_denoised(spark, f"{out}/nothing")


def test_catalogue_and_chunks_of_files(spark, tmp_path):
    (tmp_path / "x/y").mkdir(parents=True)
    write(tmp_path / "a.wav", np.stack([SIGNAL[:5000], SIGNAL[4000:9000]], axis=1), 8000, extra=struct.pack("<4sI", b"LIST", 3) + b"abc\0")
    write(tmp_path / "x/y/b.wav", SIGNAL[:900, None], 11_025, "float")
    write(tmp_path / "x/c.wav", np.zeros((0, 1), np.float32), 8000)
    found = catalogue.catalogue(spark, str(tmp_path))
    assert {r.recording_id: (r.n_channels, r.n_samples, r.sample_rate) for r in found.collect()} == {"a": (2, 5000, 8000), "x_y_b": (1, 900, 11_025), "x_c": (1, 0, 8000)}
    old, new = wav.read_wav(spark, str(tmp_path), 0.1).drop("path"), catalogue.read_chunks(found, 0.1)
    rows = lambda d: sorted((r.recording_id, r.channel, r.chunk_id, r.start_sample, r.sample_rate, tuple(r.samples)) for r in d.collect())
    assert rows(new) == rows(old)
    assert np.allclose(joined(catalogue.read_chunks(found, 0.1, mono=True))["a", 0], joined(ch.to_mono(old))["a", 0], atol=1e-6)
    assert joined(catalogue.read_chunks(found.filter("recording_id = 'a'"), 0.1)).keys() == {("a", 0), ("a", 1)}
    with pytest.raises(FileNotFoundError):
        catalogue.catalogue(spark, str(tmp_path / "missing"))
    with pytest.raises(ValueError, match="one recording_id"):
        catalogue.catalogue(spark, [str(tmp_path / "a.wav"), str(tmp_path)])
    (tmp_path / "none").mkdir()
    assert catalogue.catalogue(spark, str(tmp_path / "none")).count() == 0


def _scorer():
    def scorer(w):
        level = np.log10((w.astype(np.float64) ** 2).mean(axis=1) + 1e-9)
        return np.stack([level + 3, -level - 3], axis=1)

    return scorer


levels = _scorer()


def night(path, rate, seconds=8, channels=1):
    rng = np.random.default_rng(1)
    x = rng.normal(size=rate * seconds) * 0.002
    x[rate * 3:rate * 5] += np.sin(2 * np.pi * 200 * np.arange(rate * 2) / rate) * 0.5
    write(path, np.stack([x] * channels, axis=1).astype(np.float32), rate)


def test_detection_over_files_moves_no_samples(spark, tmp_path):
    for name, rate, channels in (("one", 16_000, 1), ("two", 8000, 2), ("three", 11_025, 1)):
        night(tmp_path / f"{name}.wav", rate, channels=channels)
    write(tmp_path / "empty.wav", np.zeros((0, 1), np.float32), 8000)
    labels, cfg = spark.createDataFrame([(0, "Snoring"), (1, "Silence")], "class_id int, label string"), Config(threshold=0.6)
    found = pipeline.detect_files(catalogue.catalogue(spark, str(tmp_path)), levels, labels, cfg, chunk_seconds=2.5)
    rows = lambda d: sorted(tuple(r) for r in d.collect())
    want = pipeline.detect(wav.read_wav(spark, str(tmp_path), 2.5).drop("path"), levels, labels, cfg)
    a, b = ({(r.recording_id, r.window_id): r.score for r in d.scores.collect()} for d in (found, want))
    assert a.keys() == b.keys() and len(a) == 48 and np.allclose([a[k] for k in a], [b[k] for k in a], atol=1e-6)
    assert len(rows(found.events)) == 3 and [(r[0], r[1]) for r in rows(found.events)] == [(r[0], r[1]) for r in rows(want.events)]
    plan = found.events._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("MapInArrow"):]  # the scorer, and what it reads
    assert "samples" in below and not any("samples" in line for line in plan.split("\n") if "Exchange" in line and "samples" in line.split("Exchange")[1] and "n_samples" not in line)


def test_failed_and_doubled_tasks_leave_whole_files_only(spark, tmp_path):
    rows = [(f"f{k}.wav", 8000, 1000, [SIGNAL[:1000].tolist()]) for k in range(6)]
    df = spark.createDataFrame(rows, files.SCHEMA).repartition(3)
    marks = str(tmp_path / "marks")
    os.makedirs(marks)

    def once(batches, always=False):
        from pyspark import TaskContext
        for b in batches:
            yield b
            mark = f"{marks}/{TaskContext.get().partitionId()}"
            if always or not os.path.exists(mark):
                open(mark, "w").close()
                raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        files.write_files(df.mapInArrow(lambda b: once(b, True), files.SCHEMA), str(tmp_path / "out"))
    assert os.listdir(tmp_path / "out") == []
    # two attempts of the same task, as speculation makes them: one of them is told to the commit
    writer = files.WavWriter(str(tmp_path / "out"))
    batch = pa.RecordBatch.from_pylist([dict(zip(("file", "sample_rate", "n_samples", "samples"), r)) for r in rows], schema=pa.schema([("file", pa.string()), ("sample_rate", pa.int32()), ("n_samples", pa.int64()), ("samples", pa.list_(pa.list_(pa.float32())))]))
    first, second = writer.write(iter([batch])), writer.write(iter([batch]))

    def torn():
        yield batch.slice(0, 3)
        raise RuntimeError

    with pytest.raises(RuntimeError):
        writer.write(torn())
    assert sorted(n for n in os.listdir(tmp_path / "out") if not n.startswith(".")) == [] and len(first.files) == 6
    writer.commit([second, None])
    assert sorted(os.listdir(tmp_path / "out")) == [f"f{k}.wav" for k in range(6)]
    assert all(os.path.getsize(tmp_path / f"out/f{k}.wav") == 44 + 2000 and wav.read_header(str(tmp_path / f"out/f{k}.wav")).n_samples == 1000 for k in range(6))


def test_pipeline_with_a_denoiser_of_its_own_and_statistics(spark, tmp_path):
    (tmp_path / "in").mkdir()
    night(tmp_path / "in/night.wav", 8000, channels=2)
    labels = spark.createDataFrame([(0, "Snoring"), (1, "Silence")], "class_id int, label string")

    def kernel(x, row):
        assert x.shape[0] == 2 and row["sample_rate"] == 4000
        return x

    cfg = Config(threshold=0.6, compute_hnr=False)
    got = pipeline.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), levels, labels, Config(threshold=0.6, compute_hnr=False, denoise_method="model"), kernel, chunk_seconds=4, kernel_rate=4000, kernel_channels=2, frames={"n_mels": 40, "n_mfcc": 13})
    assert got.events.count() == 1 and got.stats["windows"].first().n_windows == 16 and got.stats["trace"].first().n_frames == 800
    assert got.stats["stages"].first().n_kept == 1 and got.stats["cuts"].first().n_saved == 1
    row = got.features.first()
    assert (row.sample_rate, row.hop_length, len(row.log_mel)) == (8000, 80, 40)
    assert tables.read_features(spark, str(tmp_path / "out/frame_features")).filter("recording_id = 'night'").count() == got.features.count()
    (tmp_path / "none").mkdir()
    empty = pipeline.run(spark, str(tmp_path / "none"), str(tmp_path / "nothing"), levels, labels, cfg)
    assert empty.events.count() == 0 and empty.recordings.count() == 0 and empty.features.count() == 0 and all(v.count() == 0 for v in empty.stats.values())
    heads = [open(f).read().strip() for f in glob.glob(str(tmp_path / "nothing/manifest/*.csv"))]
    assert heads and all(h == "recording_id,clip_file,start_time,end_time,duration,confidence" for h in heads)
