"""Sliding analysis windows and batched scoring by a model that the user brings."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightwave.operators.chunks import rates_of, with_halo
from nightwave.operators.scoring import Groups, matrix

Scorer = Callable[[np.ndarray], np.ndarray]


def make_windows(chunks: DataFrame, window_s: float = 2.0, stride_s: float = 0.5, rates: list[int] | None = None) -> DataFrame:
    """recording_id, window_id, center_s, samples of every window that starts before the end, padded with zeros to full length.

    Mono chunks of one rate a call site; a window is made by the chunk that it starts in, from a halo of one window, so only
    borders are exchanged. Chunks must not be shorter than a window, but for the last one. rates: those of the chunks, where they are known.
    """
    out = None
    for rate in rates_of(chunks) if rates is None else rates:
        own = chunks.filter((F.col("sample_rate") == rate) & (F.col("channel") == 0) & (F.size("samples") > 0))
        made = held_windows(with_halo(own, 0, int(window_s * rate)), rate, window_s, stride_s)
        out = made if out is None else out.unionByName(made)
    return out if out is not None else chunks.select("recording_id", F.lit(0).cast("bigint").alias("window_id"), F.lit(0.0).alias("center_s"), "samples").limit(0)


def held_windows(held: DataFrame, rate: int, window_s: float = 2.0, stride_s: float = 0.5) -> DataFrame:
    """The windows of chunks that have the window behind them (right_n samples of it) already."""
    size, step = int(window_s * rate), int(stride_s * rate)
    first, last = F.expr(f"(start_sample + {step} - 1) div {step}"), F.expr(f"(start_sample + size(samples) - right_n - 1) div {step}")
    rows = held.withColumn("a", first).withColumn("b", last).filter("b >= a").withColumn("window_id", F.explode(F.sequence("a", "b")))
    x = F.slice("samples", (F.col("window_id") * step - F.col("start_sample") + 1).cast("int"), F.lit(size))
    padded = F.concat(x, F.array_repeat(F.lit(0.0).cast("float"), F.lit(size) - F.size(x)))
    return rows.select("recording_id", "window_id", ((F.col("window_id") * step + size / 2) / rate).alias("center_s"), padded.alias("samples"))


def _scored(windows: DataFrame, scorer: Scorer, batch_size: int, name: str, kind: str, result) -> DataFrame:
    """The windows without samples, and result(logits[B, C]) of each batch: samples are dropped in this pass, before anything is exchanged."""
    def run(batches):
        for b in batches:
            if len(b):
                x = matrix(b["samples"])
                made = [result(np.asarray(scorer(x[k:k + batch_size]), np.float64)) for k in range(0, len(b), batch_size)]
                yield pa.RecordBatch.from_arrays([b["recording_id"], b["window_id"], b["center_s"], pa.concat_arrays(made)], names=["recording_id", "window_id", "center_s", name])

    return windows.select("recording_id", "window_id", "center_s", "samples").mapInArrow(run, f"recording_id string, window_id long, center_s double, {name} {kind}")


def score_windows(windows: DataFrame, scorer: Scorer, batch_size: int = 8) -> DataFrame:
    """recording_id, window_id, center_s, logits: any function of float32[B, n] to logits[B, C], B at most batch_size."""
    def lists(x: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))

    return _scored(windows, scorer, batch_size, "logits", "array<double>", lists)


def window_scores(windows: DataFrame, scorer: Scorer, groups: Groups, batch_size: int = 8) -> DataFrame:
    """recording_id, window_id, center_s, score: the groups' score in the scorer's own pass, so that logits are never a column."""
    return _scored(windows, scorer, batch_size, "score", "double", lambda x: pa.array(groups.scores(x)))
