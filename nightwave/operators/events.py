"""A frame trace to events: threshold, runs, merging over short gaps, padding, least duration.

Frames are compared by their whole-number index, so ties at a gap or a duration do not depend on rounding. Confidences
are means of whole hundred-millionths: sums are exact in any order, and one division is left to rounding.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nightwave.config import Config
from nightwave.operators.smoothing import BLOCK
from nightwave.sources.shared import written

_CFG = Config()
_UNITS = 100_000_000


def _units(column: str | Column) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.round(c * _UNITS).cast("long")


def _mean(column: str) -> Column:
    """The mean of a column of up to eight digits, to eight digits, half up, the same in whatever order rows come."""
    return F.floor((F.sum(_units(column)) + F.floor(F.count(column) / 2)) / F.count(column)) / _UNITS


def to_digits(column: str, digits: int) -> Column:
    """A confidence to fewer digits, half up in whole numbers."""
    step = 10 ** (8 - digits)
    return F.floor((_units(column) + step // 2) / step) / 10**digits


def threshold_mask(trace: DataFrame, threshold: float = _CFG.threshold) -> DataFrame:
    """The trace with `is_on`: prob at or above the threshold."""
    return trace.withColumn("is_on", F.col("prob") >= threshold)


def find_runs(mask: DataFrame, hop_ms: int = 10, block: int = BLOCK) -> DataFrame:
    """recording_id, first_frame, last_frame, start, end (time of the last frame itself), confidence of each longest stretch of frames that are on.

    Stretches are found within blocks of frames, then those that touch at a border are joined, sums and counts with them.
    """
    on = mask.filter("is_on").select("recording_id", "frame_idx", F.floor(F.col("frame_idx") / block).alias("block"), _units("prob").alias("units"))
    island = F.col("frame_idx") - F.row_number().over(Window.partitionBy("recording_id", "block").orderBy("frame_idx"))
    pieces = on.withColumn("island", island).groupBy("recording_id", "block", "island").agg(F.min("frame_idx").alias("a"), F.max("frame_idx").alias("b"), F.sum("units").alias("units"), F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("recording_id").orderBy("a")
    fresh = F.when(F.col("a") == F.lag("b").over(w) + 1, 0).otherwise(1)
    runs = (pieces.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(w)).groupBy("recording_id", "run")
            .agg(F.min("a").alias("first_frame"), F.max("b").alias("last_frame"), (F.floor((F.sum("units") + F.floor(F.sum("n") / 2)) / F.sum("n")) / _UNITS).alias("confidence")))
    seconds = lambda c: F.round(F.col(c) * hop_ms / 1000.0, 6)
    return runs.select("recording_id", "first_frame", "last_frame", seconds("first_frame").alias("start"), seconds("last_frame").alias("end"), "confidence")


def merge_runs(runs: DataFrame, gap_s: float = _CFG.merge_gap_s, hop_ms: int = 10) -> DataFrame:
    """Runs whose gap is at most gap_s become one; its confidence is the plain mean of theirs."""
    w = Window.partitionBy("recording_id").orderBy("first_frame")
    gap = F.col("first_frame") - F.lag("last_frame").over(w)
    fresh = F.when(gap.isNull() | (F.round(gap * hop_ms / 1000.0, 6) > gap_s), 1).otherwise(0)
    grouped = runs.withColumn("fresh", fresh).withColumn("grp", F.sum("fresh").over(w))
    return grouped.groupBy("recording_id", "grp").agg(F.min("first_frame").alias("first_frame"), F.max("last_frame").alias("last_frame"), F.min("start").alias("start"), F.max("end").alias("end"), _mean("confidence").alias("confidence")).drop("grp")


def pad_events(events: DataFrame, lengths: DataFrame, padding_s: float = _CFG.padding_s, hop_ms: int = 10) -> DataFrame:
    """Events longer by padding_s at both ends, within 0 and the time of the recording's last frame. lengths: recording_id, n_frames."""
    last = (F.col("n_frames") - 1) * hop_ms / 1000.0
    out = events.join(lengths.select("recording_id", "n_frames"), "recording_id")
    return out.withColumn("start", F.round(F.greatest(F.lit(0.0), F.col("start") - padding_s), 6)).withColumn("end", F.round(F.least(last, F.col("end") + padding_s), 6)).drop("n_frames")


def filter_events(events: DataFrame, min_duration_s: float = _CFG.min_duration_s) -> DataFrame:
    """Events of at least min_duration_s, times and confidence to four digits."""
    kept = events.filter(F.round(F.col("end") - F.col("start"), 6) >= min_duration_s)
    return kept.withColumns({c: F.round(F.round(c, 8), 4) for c in ("start", "end")} | {"confidence": to_digits("confidence", 4)})


def _frames_of(trace: DataFrame) -> DataFrame:
    return trace.groupBy("recording_id").agg((F.max("frame_idx") + 1).alias("n_frames"))


def group_frames(trace: DataFrame, cfg: Config = _CFG, lengths: DataFrame | None = None) -> DataFrame:
    """recording_id, event_id (from 1, by start), start, end, confidence.

    lengths: recording_id, n_frames, where it is known beforehand (`scoring.frame_lengths`), so that the trace is read once.
    """
    merged = merge_runs(find_runs(threshold_mask(trace, cfg.threshold), cfg.hop_ms), cfg.merge_gap_s, cfg.hop_ms)
    return _kept(merged, _frames_of(trace) if lengths is None else lengths, cfg)


def _kept(merged: DataFrame, lengths: DataFrame, cfg: Config) -> DataFrame:
    kept = filter_events(pad_events(merged, lengths, cfg.padding_s, cfg.hop_ms), cfg.min_duration_s)
    w = Window.partitionBy("recording_id").orderBy("first_frame")
    return kept.select("recording_id", F.row_number().over(w).cast("int").alias("event_id"), "start", "end", "confidence")


def event_counts(trace: DataFrame, cfg: Config = _CFG, lengths: DataFrame | None = None) -> DataFrame:
    """Per recording: n_raw, n_merged, n_kept (0 where there are none). The small table of runs is written once."""
    lengths = _frames_of(trace) if lengths is None else lengths
    runs = written(find_runs(threshold_mask(trace, cfg.threshold), cfg.hop_ms), "runs")
    merged = merge_runs(runs, cfg.merge_gap_s, cfg.hop_ms)
    stages = [df.select("recording_id", F.lit(k).alias("stage")) for k, df in enumerate((runs, merged, _kept(merged, lengths, cfg)))]
    counts = stages[0].union(stages[1]).union(stages[2]).groupBy("recording_id").agg(*[F.count_if(F.col("stage") == k).alias(n) for k, n in enumerate(("n_raw", "n_merged", "n_kept"))])
    return lengths.select("recording_id").distinct().join(counts, "recording_id", "left").na.fill(0)


def event_summary(events: DataFrame, recordings: DataFrame) -> DataFrame:
    """Per recording: n_events, total_s, percent of its duration; recordings without events have zeros."""
    total = F.coalesce(F.round(F.sum(F.col("end") - F.col("start")), 4), F.lit(0.0))
    out = recordings.select("recording_id", "duration_s").join(events, "recording_id", "left").groupBy("recording_id", "duration_s").agg(F.count("event_id").alias("n_events"), total.alias("total_s"))
    return out.select("recording_id", "n_events", "total_s", F.coalesce(F.round(100 * F.col("total_s") / F.nullif("duration_s", F.lit(0.0)), 4), F.lit(0.0)).alias("percent"))


def top_events(events: DataFrame, n: int = 20) -> DataFrame:
    """The first n events of each recording with their length, and how many more there are."""
    w = Window.partitionBy("recording_id")
    ranked = events.withColumn("place", F.row_number().over(w.orderBy("start"))).withColumn("n_all", F.count(F.lit(1)).over(w))
    return ranked.filter(F.col("place") <= n).select("recording_id", "event_id", "start", "end", "confidence", F.round(F.col("end") - F.col("start"), 4).alias("length_s"), F.greatest(F.lit(0), F.col("n_all") - n).alias("n_more"))
