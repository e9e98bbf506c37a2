"""From recordings to events, clips, a manifest and frame features."""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from nightwave.config import BREATH_KEYWORDS, TARGET_KEYWORDS, Config
from nightwave.operators import chunks as ch
from nightwave.operators import clips, denoise, events, features, scoring, smoothing, windows
from nightwave.sources import catalogue, tables, wav
from nightwave.sources.shared import written


@dataclass
class Detection:
    """Events with what led to them: window scores, the smoothed trace, and the number of its frames a recording."""

    scores: DataFrame
    trace: DataFrame
    lengths: DataFrame
    events: DataFrame
    cfg: Config

    def stats(self) -> dict[str, DataFrame]:
        """Per recording: windows (largest and mean score, number over the threshold), trace (the same of frames), stages (runs, merged and kept events)."""
        return {"windows": scoring.window_stats(self.scores, self.cfg.threshold), "trace": scoring.trace_stats(self.trace, self.cfg.threshold), "stages": events.event_counts(self.trace, self.cfg, self.lengths)}


def _detected(cut: DataFrame, recs: DataFrame, scorer: windows.Scorer, labels: DataFrame, cfg: Config, target, breath, keep: bool = False) -> Detection:
    groups = scoring.groups_of(scoring.resolve_targets(labels, target, breath))
    scores = windows.window_scores(cut, scorer, groups, cfg.batch_size)
    scores = written(scores, "scores") if keep else scores
    trace = smoothing.smooth_windows(scores, recs, cfg.hop_ms, cfg.median_ms, cfg.uniform_ms)
    lengths = scoring.frame_lengths(recs, cfg.hop_ms)
    return Detection(scores, trace, lengths, events.group_frames(trace, cfg, lengths), cfg)


def detect(chunks: DataFrame, scorer: windows.Scorer, labels: DataFrame, cfg: Config = Config(), target=TARGET_KEYWORDS, breath=BREATH_KEYWORDS, keep: bool = True) -> Detection:
    """Detection in recordings: mono, the model's rate, windows, class scores, frame trace, smoothing, grouping. With keep, scores are written, so that windows are scored once whatever is asked."""
    mono = ch.mono_at(chunks, cfg.model_rate)
    return _detected(windows.make_windows(mono, cfg.window_s, cfg.stride_s, [cfg.model_rate]), ch.recordings(chunks), scorer, labels, cfg, target, breath, keep)


def detect_segments(chunks: DataFrame, scorer: windows.Scorer, labels: DataFrame, cfg: Config = Config(), target=TARGET_KEYWORDS, breath=BREATH_KEYWORDS) -> DataFrame:
    """The events of `detect`."""
    return detect(chunks, scorer, labels, cfg, target, breath, False).events


def detect_files(files: DataFrame, scorer: windows.Scorer, labels: DataFrame, cfg: Config = Config(), target=TARGET_KEYWORDS, breath=BREATH_KEYWORDS, chunk_seconds: float = 30, keep: bool = False) -> Detection:
    """`detect` over the files of a catalogue: windows are made from what is read, so that only scores are exchanged."""
    held = catalogue.read_for_windows(files, cfg.model_rate, cfg.window_s, chunk_seconds)
    return _detected(windows.held_windows(held, cfg.model_rate, cfg.window_s, cfg.stride_s), files, scorer, labels, cfg, target, breath, keep)


@dataclass
class Result:
    recordings: DataFrame
    events: DataFrame
    manifest: DataFrame
    summary: DataFrame
    features: DataFrame | None
    stats: dict[str, DataFrame]


def run(spark: SparkSession, paths: str | list[str], out: str, scorer: windows.Scorer, labels: DataFrame, cfg: Config = Config(), kernel: Callable[[np.ndarray, dict], np.ndarray] | None = None, skip_denoise: bool = False, chunk_seconds: float = 30,
        kernel_rate: int | None = None, kernel_channels: int | None = None, gate: dict | None = None, frames: dict | None = None) -> Result:
    """Everything for a set of files, written under `out`. The denoised table is written once and read by features and detection; clips come from the original.

    kernel_rate, kernel_channels: what the denoiser asks for, as in `denoise.denoise`; gate: parameters of the spectral gate;
    frames: parameters of `features.extract_features`. stats has the tables of `Detection.stats` and cuts, also under out/stats.
    A folder without recordings gives empty tables and a manifest with its header alone.
    """
    files = catalogue.catalogue(spark, paths)
    recs = files.select("recording_id", "sample_rate", "n_channels", "n_samples", "duration_s")
    original = catalogue.read_chunks(files, chunk_seconds)
    table = os.path.join(out, "denoised")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(os.path.join(out, name))
        return spark.read.schema(df.schema).parquet(os.path.join(out, name))

    clean = tables.load_denoised(spark, table) if skip_denoise else stored(denoise.denoise(original, cfg.denoise_method, kernel, kernel_rate, kernel_channels, **(gate or {})), "denoised")
    made = None
    if not cfg.skip_features:
        own = {"compute_hnr": cfg.compute_hnr, "hop_ms": cfg.hop_ms} | (frames or {})
        made = tables.write_features(features.extract_features(ch.to_mono(clean), **own), os.path.join(out, "frame_features"), recs, own.get("frame_ms", 25), own["hop_ms"])
    found = detect(clean, scorer, labels, cfg)
    happened = stored(found.events, "events")
    ranges = clips.event_samples(happened, recs).drop("n_samples")
    rates = {r.sample_rate for r in recs.select("sample_rate").distinct().collect()} or {cfg.model_rate}  # a few rates
    kept = None
    for rate in sorted(rates):
        cut = clips.packed_pieces(ranges.filter(ranges.sample_rate == rate), original.filter(original.sample_rate == rate), max(1, int(chunk_seconds * rate)))
        kept = cut if kept is None else kept.unionByName(cut)
    kept = written(kept, "cut")
    measured = written(clips.clips_of(kept), "measured")
    named = stored(clips.name_clips(clips.drop_silent(measured, cfg.min_rms)), "clips")
    manifest = clips.manifest(named)
    wav.write_pieces(named, kept, os.path.join(out, "wav"))
    wav.write_wav(clean, os.path.join(out, "wav"))
    tables.write_manifest(manifest, os.path.join(out, "manifest"))
    tables.write_recording_manifests(manifest, recs, os.path.join(out, "wav"))
    stats = {k: stored(v, f"stats/{k}") for k, v in (found.stats() | {"cuts": clips.cut_stats(measured, cfg.min_rms)}).items()}
    return Result(recs, happened, manifest, events.event_summary(happened, recs), made, stats)
