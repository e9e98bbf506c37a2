"""Smoothing of a frame trace over mirrored edges.

A filter of even width reaches one frame further back than ahead; the median of an even width is the upper one. A trace
is dealt out by recording and block of `BLOCK` frames, each block with copies of the frames that its filters reach, so
that one long recording is many tasks and a two-stage smoothing moves each frame once. A block is one array: edges are
mirrored in it, running medians descend a wavelet matrix of the frames' ranks and running means are differences of prefix
sums in whole units, so that neither costs more for a wider filter and both are the same whatever the blocks are.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightwave.operators.scoring import window_spans

BLOCK = 16_384
#: Widths up to which a running median lays out each frame's neighbours.
NARROW = 16


def running_rank(x: np.ndarray, size: int, rank: int) -> np.ndarray:
    """The element of that rank, from 0, of each `size` neighbours of x: log2(n) steps for all of them, whatever the size."""
    n = len(x)
    if size <= NARROW:  # the neighbours laid out take little room
        return np.partition(np.lib.stride_tricks.sliding_window_view(x, size), rank, axis=1)[:, rank]
    by_value = np.argsort(x, kind="stable")
    ranks = np.empty(n, np.int64)
    ranks[by_value] = np.arange(n)
    low = np.arange(n - size + 1)
    high, k, found = low + size, np.full(len(low), rank), np.zeros(len(low), np.int64)
    for bit in reversed(range(max(1, int(n - 1).bit_length()))):
        one = (ranks >> bit) & 1
        zeros = np.concatenate([[0], np.cumsum(1 - one)])
        a, b = zeros[low], zeros[high]
        up = k >= b - a
        k, found = np.where(up, k - (b - a), k), found | (up.astype(np.int64) << bit)
        low, high = np.where(up, zeros[n] + low - a, a), np.where(up, zeros[n] + high - b, b)
        ranks = np.concatenate([ranks[one == 0], ranks[one == 1]])
    return x[by_value[found]]


def running_mean(x: np.ndarray, size: int) -> np.ndarray:
    """The mean of each `size` neighbours of x: sums in units of 2 ** -k, k the largest that leaves room for a window, and the same for all traces in -1 .. 1."""
    largest = max(1.0, float(np.abs(x).max(initial=0.0)))
    unit = 2.0 ** (61 - np.frexp(largest * size)[1])
    sums = np.zeros(len(x) + 1, np.int64)
    np.cumsum(np.rint(x * unit).astype(np.int64), out=sums[1:])  # may pass the largest number: differences are right all the same
    return (sums[size:] - sums[:-size]) / unit / size


def _median(x: np.ndarray, size: int) -> np.ndarray:
    return running_rank(x, size, size // 2)


def _counted(series: DataFrame) -> DataFrame:
    """recording_id, frame_idx, prob, n: the frames of the recording, from the column n_frames where the trace has it."""
    if "n_frames" in series.columns:
        return series.select("recording_id", "frame_idx", "prob", F.col("n_frames").alias("n"))
    return series.select("recording_id", "frame_idx", "prob").join(series.groupBy("recording_id").agg(F.count(F.lit(1)).alias("n")), "recording_id")


def _places(at: str, left: int, right: int) -> Column:
    """The frame itself and its mirror images up to `left` before and `right` behind the recording's n frames."""
    i, n, span = F.col(at), F.col("n"), max(left, right)
    turns = F.sequence(-(F.floor(span / (2 * n)) + 1), F.floor(span / (2 * n)) + 1)
    images = F.concat(F.transform(turns, lambda m: i + 2 * m * n), F.transform(turns, lambda m: 2 * m * n - 1 - i))
    outside = F.filter(images, lambda j: ((j < 0) & (j >= -left)) | ((j >= n) & (j < n + right)))
    near_edge = (i < span) | (i >= n - span)
    return F.when(near_edge, F.concat(F.array(i), outside)).otherwise(F.array(i))


def reflect_pad(series: DataFrame, left: int, right: int) -> DataFrame:
    """series (recording_id, frame_idx, prob) with `left` and `right` mirrored frames before and after; the edge frame is repeated.

    Frame -1 is frame 0, frame T is frame T - 1; short recordings are mirrored again and again (period 2 T).
    """
    return _counted(series).withColumn("frame_idx", F.explode(_places("frame_idx", left, right)))


def _reached(x: np.ndarray, at: int, n: int, first: int, stop: int, size: int) -> np.ndarray:
    """What filters of that size reach from the frames first .. stop - 1, of x, the frames from `at` on of a recording of n: mirrored beyond its ends."""
    low, high = first - size // 2, stop + size - 1 - size // 2
    held = x[max(low, 0) - at:min(high, n) - at]
    return np.pad(held, (max(0, -low), max(0, high - n)), mode="symmetric") if low < 0 or high > n else held


Stages = list[tuple[int, Callable[[np.ndarray, int], np.ndarray]]]


def _reach(stages: Stages) -> tuple[int, int]:
    return sum(size // 2 for size, _ in stages), sum(size - 1 - size // 2 for size, _ in stages)


def _filtered(x: np.ndarray, at: int, n: int, stages: Stages, b: int, block: int) -> tuple[int, np.ndarray]:
    """The first frame of block b and its values after the stages; x has the frames from `at` on that they reach."""
    back, ahead = _reach(stages)
    for size, value in stages:
        back, ahead = back - size // 2, ahead - (size - 1 - size // 2)
        first, stop = max(0, b * block - back), min(n, (b + 1) * block + ahead)
        x, at = value(_reached(x, at, n, first, stop, size), size), first
    return at, x


def _filters(series: DataFrame, stages: Stages, block: int = BLOCK) -> DataFrame:
    """series after filters (size, function of an array and the size), each over what the one before gave, mirrored anew."""
    left, right = _reach(stages)
    block = max(block, left + right)
    i, own = F.col("frame_idx"), F.floor(F.col("frame_idx") / block)
    to = F.array_compact(F.array(own, F.when((own > 0) & (i - own * block < right), own - 1), F.when(((own + 1) * block - i <= left) & ((own + 1) * block < F.col("n")), own + 1)))
    rows = _counted(series).select("recording_id", F.explode(to).alias("block"), "frame_idx", F.col("prob").cast("double").alias("prob"), F.col("n").cast("long").alias("n"))

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        idx = t["frame_idx"].to_numpy()
        at = int(idx.min())
        x = np.empty(len(idx))
        x[idx - at] = t["prob"].to_numpy()
        at, x = _filtered(x, at, t["n"][0].as_py(), stages, key[1].as_py(), block)
        return pa.table({"recording_id": pa.array([key[0].as_py()] * len(x), pa.string()), "frame_idx": pa.array(np.arange(at, at + len(x))), "prob": pa.array(x)})

    return rows.groupBy("recording_id", "block").applyInArrow(run, "recording_id string, frame_idx long, prob double")


def median_filter(series: DataFrame, size: int) -> DataFrame:
    """The element of rank size // 2 (from 0) of each window of `size` frames."""
    return _filters(series, [(size, _median)])


def uniform_filter(series: DataFrame, size: int) -> DataFrame:
    """The mean of each window of `size` frames."""
    return _filters(series, [(size, running_mean)])


def filter_width(ms: float, hop_s: float) -> int:
    return max(1, round(ms / 1000 / hop_s))


def _stages(hop_s: float, median_ms: float, uniform_ms: float, block: int) -> Stages:
    m, u = filter_width(median_ms, hop_s), filter_width(uniform_ms, hop_s)
    if block < m + u:
        raise ValueError("a block must be at least as long as the filters reach")
    return [(m, _median), (u, running_mean)]


def _trace(filtered: DataFrame, hop_s: float) -> DataFrame:
    prob = F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("prob"))), 6)
    return filtered.select("recording_id", "frame_idx", F.round(F.col("frame_idx") * hop_s, 6).alias("t"), prob.alias("prob"))


def smooth_probabilities(frame_probs: DataFrame, hop_s: float = 0.01, median_ms: float = 100.0, uniform_ms: float = 200.0, block: int = BLOCK) -> DataFrame:
    """recording_id, frame_idx, t, prob: median, then mean (mirrored anew), then cut to 0 .. 1, to six digits.

    block must be at least the filters' reach.
    """
    return _trace(_filters(frame_probs, _stages(hop_s, median_ms, uniform_ms, block), block), hop_s)


def smooth_windows(window_scores: DataFrame, recordings: DataFrame, hop_ms: int = 10, median_ms: float = 100.0, uniform_ms: float = 200.0, block: int = BLOCK) -> DataFrame:
    """`smooth_probabilities` of the frames that lie on the lines between window scores.

    Windows move, not their frames: a block gets the windows whose lines its filters reach, and makes its frames itself.
    """
    stages = _stages(hop_ms / 1000, median_ms, uniform_ms, block)
    left, right = _reach(stages)
    last = F.floor((F.col("n_frames") - 1) / block)
    to = F.sequence(F.greatest(F.lit(0), F.floor((F.col("i0") - right) / block)), F.least(last, F.floor((F.col("i1") + left) / block)))
    rows = window_spans(window_scores, recordings, hop_ms).withColumn("block", F.explode(to))

    columns = ("center_s", "score", "next_c", "next_s", "n_frames", "i0", "i1")

    def smoothed(b: int, center, score, next_center, next_score, n_frames, i0, i1) -> tuple[int, np.ndarray]:
        n = int(n_frames[0])
        first, stop = max(0, b * block - left), min(n, (b + 1) * block + right)
        i0, i1 = np.maximum(i0, first), np.minimum(i1, stop - 1)
        c, s, next_c, next_s = (np.repeat(v.astype(np.float64), i1 - i0 + 1) for v in (center, score, next_center, next_score))
        at = np.arange(first, stop) * hop_ms / 1000.0
        with np.errstate(invalid="ignore"):
            line = np.where(np.isnan(next_c) | (at <= c), s, s + (next_s - s) * (at - c) / (next_c - c))
        return _filtered(np.clip(line, 0.0, 1.0), first, n, stages, b, block)

    def run(batches):
        """Blocks follow each other in the batches; the last of a batch may go on in the next one."""
        key, held = None, []
        done, size = [], 0

        def made():
            at, x = smoothed(key[1], *(np.concatenate(v) for v in zip(*held)))
            done.append((key[0], at, x))
            return len(x)

        def batch():
            return pa.RecordBatch.from_arrays([pa.array([r for r, _, x in done for _ in range(len(x))], pa.string()), pa.array(np.concatenate([np.arange(at, at + len(x)) for _, at, x in done])), pa.array(np.concatenate([x for *_, x in done]))], names=["recording_id", "frame_idx", "prob"])

        for b in batches:
            ids, blocks = b["recording_id"].to_pylist(), b["block"].to_numpy()
            values = [b[c].to_numpy(zero_copy_only=False) for c in columns]
            starts = [i for i in range(len(ids)) if i == 0 or ids[i] != ids[i - 1] or blocks[i] != blocks[i - 1]]
            for i, stop in zip(starts, [*starts[1:], len(ids)]):
                if (ids[i], int(blocks[i])) != key:
                    if held:
                        size += made()
                        if size >= 4 * BLOCK:
                            yield batch()
                            done, size = [], 0
                    key, held = (ids[i], int(blocks[i])), []
                held.append([v[i:stop] for v in values])
        if held:
            made()
        if done:
            yield batch()

    rows = rows.select("recording_id", "block", F.col("center_s").cast("double").alias("center_s"), F.col("score").cast("double").alias("score"), F.col("next_c").cast("double").alias("next_c"), F.col("next_s").cast("double").alias("next_s"), "n_frames", "i0", "i1")
    dealt = rows.repartition("recording_id", "block").sortWithinPartitions("recording_id", "block", "i0")
    return _trace(dealt.mapInArrow(run, "recording_id string, frame_idx long, prob double"), hop_ms / 1000)
