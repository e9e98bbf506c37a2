"""Class probabilities to window scores, and window scores to a frame trace."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nightwave.config import BREATH_KEYWORDS, BREATH_WEIGHT, TARGET_KEYWORDS, TARGET_WEIGHT


def _with(value: Column, then) -> Column:
    """then(value), where the value is worked out once and not in each place, or for each element, that names it."""
    return F.transform(F.array(value), then)[0]


def softmax_probs(logits: str | Column) -> Column:
    """Probabilities of an array of logits; the largest is taken off first. The largest and the sum are bound once, so the work is linear in the classes."""
    x = F.transform(F.col(logits) if isinstance(logits, str) else logits, lambda v: v.cast("double"))
    shifted = _with(F.struct(x.alias("x"), F.array_max(x).alias("top")), lambda s: F.transform(s["x"], lambda v: F.exp(v - s["top"])))
    return _with(shifted, lambda e: _with(F.struct(e.alias("e"), F.aggregate(e, F.lit(0.0), lambda t, v: t + v).alias("total")), lambda s: F.transform(s["e"], lambda v: v / s["total"])))


def find_label_indices(labels: DataFrame, keywords: Iterable[str]) -> DataFrame:
    """class_id, label of the classes whose label has one of the keywords in it, in any case."""
    words = F.array(*[F.lit(k.lower()) for k in keywords])
    return labels.filter(F.exists(words, lambda k: F.contains(F.lower("label"), k))).orderBy("class_id")


def resolve_targets(labels: DataFrame, target: Iterable[str] = TARGET_KEYWORDS, breath: Iterable[str] = BREATH_KEYWORDS) -> DataFrame:
    """class_id, grp: the target classes, and the breathing classes, which stand in where there is no target class."""
    a = find_label_indices(labels, target).select("class_id", F.lit("snore").alias("grp"))
    b = find_label_indices(labels, breath).select("class_id", F.lit("breath").alias("grp"))
    if not a.isEmpty():
        return a.unionByName(b)
    if b.isEmpty():
        raise ValueError("no class label has a target or a breathing keyword")
    return b.withColumn("grp", F.lit("snore"))


@dataclass(frozen=True)
class Groups:
    """Class ids of the two groups of one model, and what they weigh."""

    target: tuple[int, ...]
    breath: tuple[int, ...]
    weights: tuple[float, float] = (TARGET_WEIGHT, BREATH_WEIGHT)

    def scores(self, logits: np.ndarray) -> np.ndarray:
        """The score of each row of logits[B, C]: softmax, the groups' largest probabilities and their weighted mean in one pass over the classes.

        Ids beyond C have no probability; rows without any are 0.
        """
        x = np.asarray(logits, np.float64)
        total, weight = np.zeros(len(x)), 0.0
        if x.shape[1]:
            e = np.exp(x - x.max(axis=1, keepdims=True))
            for ids, w in zip((self.target, self.breath), self.weights, strict=True):
                known = [i for i in ids if 0 <= i < x.shape[1]]
                if known:
                    total, weight = total + w * e[:, known].max(axis=1), weight + w
            total /= e.sum(axis=1)
        return np.minimum(total / weight, 1.0) if weight else total


def groups_of(targets: DataFrame) -> Groups:
    """The groups as `Groups`: ids of one model's classes, as many as its labels."""
    found: dict[str, list[int]] = {"snore": [], "breath": []}
    for r in targets.select("grp", "class_id").collect():
        found[r.grp].append(r.class_id)
    return Groups(tuple(sorted(found["snore"])), tuple(sorted(found["breath"])))


def matrix(column: pa.Array, dtype=np.float32) -> np.ndarray:
    """A list column of one length, without nulls, as rows of an array: no value passes through Python."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(column) and len(flat) % len(column) == 0 and len(pc.unique(pc.list_value_length(column))) == 1:
        return flat.reshape(len(column), -1).astype(dtype, copy=False)
    raise ValueError("arrays of one length are needed")


def score_logits(logits: DataFrame, groups: Groups) -> DataFrame:
    """recording_id, window_id, center_s, score of class logits (recording_id, window_id, center_s, logits), all of one length."""
    def run(batches):
        for b in batches:
            if len(b):
                yield pa.RecordBatch.from_arrays([b["recording_id"], b["window_id"], b["center_s"], pa.array(groups.scores(matrix(b["logits"], np.float64)))], names=["recording_id", "window_id", "center_s", "score"])

    return logits.select("recording_id", "window_id", "center_s", "logits").mapInArrow(run, "recording_id string, window_id long, center_s double, score double")


def aggregate_score(class_probs: DataFrame, targets: DataFrame) -> DataFrame:
    """recording_id, window_id, center_s, score: weighted mean of the groups' largest probabilities, at most 1.

    The class ids of the groups (a few of one model's classes) travel as one broadcast row, so windows are not shuffled.
    """
    ids = lambda g: F.coalesce(F.collect_list(F.when(F.col("grp") == g, F.col("class_id"))), F.array().cast("array<int>"))
    groups = targets.agg(ids("snore").alias("s_ids"), ids("breath").alias("b_ids"))
    top = lambda name: F.array_max(F.transform(name, lambda i: F.get("probs", i)))
    parts = [(top("s_ids"), TARGET_WEIGHT), (top("b_ids"), BREATH_WEIGHT)]
    total = sum(F.coalesce(v, F.lit(0.0)) * w for v, w in parts)
    weight = sum(F.when(v.isNotNull(), F.lit(w)).otherwise(0.0) for v, w in parts)
    score = F.when(weight > 0, F.least(total / weight, F.lit(1.0))).otherwise(0.0)
    return class_probs.crossJoin(F.broadcast(groups)).select("recording_id", "window_id", "center_s", score.alias("score"))


def window_stats(window_scores: DataFrame, over: float = 0.3) -> DataFrame:
    """Per recording: max_score, mean_score, n_over (strictly above), n_windows."""
    return window_scores.groupBy("recording_id").agg(F.max("score").alias("max_score"), F.avg("score").alias("mean_score"), F.count_if(F.col("score") > over).alias("n_over"), F.count(F.lit(1)).alias("n_windows"))


def frame_count(n_samples: Column, sample_rate: Column, hop_ms: int) -> Column:
    """Frames 0, hop, ... strictly before the end, in whole numbers."""
    step = sample_rate.cast("long") * hop_ms
    return F.floor((n_samples.cast("long") * 1000 + step - 1) / step).cast("long")


def frame_lengths(recordings: DataFrame, hop_ms: int = 10) -> DataFrame:
    """recording_id, n_frames of the recordings that have frames."""
    return recordings.select("recording_id", frame_count(F.col("n_samples"), F.col("sample_rate"), hop_ms).alias("n_frames")).filter("n_frames > 0")


def window_spans(window_scores: DataFrame, recordings: DataFrame, hop_ms: int = 10) -> DataFrame:
    """recording_id, center_s, score, next_c, next_s (null at the last window), n_frames, i0, i1: the frames that each window's line gives, where it gives any."""
    w = Window.partitionBy("recording_id").orderBy("window_id")
    rows = window_scores.join(recordings.select("recording_id", frame_count(F.col("n_samples"), F.col("sample_rate"), hop_ms).alias("n_frames")), "recording_id")
    grid = lambda c: F.ceil(F.round(c * 1000 / hop_ms, 6)).cast("long")
    rows = rows.select("recording_id", "center_s", "score", "n_frames", F.lead("center_s").over(w).alias("next_c"), F.lead("score").over(w).alias("next_s"), F.row_number().over(w).alias("k"))
    first = F.when(F.col("k") == 1, F.lit(0).cast("long")).otherwise(F.greatest(grid(F.col("center_s")), F.lit(0)))
    last = F.least(F.col("n_frames") - 1, F.coalesce(grid(F.col("next_c")) - 1, F.col("n_frames") - 1))
    return rows.withColumn("i0", first).withColumn("i1", last).filter("i1 >= i0").drop("k")


def interpolate_frames(window_scores: DataFrame, recordings: DataFrame, hop_ms: int = 10) -> DataFrame:
    """recording_id, frame_idx, t, prob, n_frames (of the recording) on the hop grid: linear between window centres, clamped beyond the first and the last.

    A window's row makes the frames up to the next window's centre, so nothing is joined to the frame grid.
    """
    frames = window_spans(window_scores, recordings, hop_ms).withColumn("frame_idx", F.explode(F.sequence("i0", "i1")))
    t = F.col("frame_idx") * hop_ms / 1000.0
    line = F.col("score") + (F.col("next_s") - F.col("score")) * (t - F.col("center_s")) / (F.col("next_c") - F.col("center_s"))
    prob = F.when(F.col("next_c").isNull() | (t <= F.col("center_s")), F.col("score")).otherwise(line)
    return frames.select("recording_id", "frame_idx", t.alias("t"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), prob)).alias("prob"), "n_frames")


def trace_stats(frame_probs: DataFrame, threshold: float | None = None) -> DataFrame:
    """Per recording: n_frames, max_prob, mean_prob and, with a threshold, n_on (at or above)."""
    aggs = [F.count(F.lit(1)).alias("n_frames"), F.max("prob").alias("max_prob"), F.avg("prob").alias("mean_prob")]
    if threshold is not None:
        aggs.append(F.count_if(F.col("prob") >= threshold).alias("n_on"))
    return frame_probs.groupBy("recording_id").agg(*aggs)
