"""Noise floors, spectral gates, and the choice of a denoiser with a fall-back, chunk by chunk with a halo."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nightwave.functions import kernels
from nightwave.operators.chunks import CHUNK, _sample_lists, match_channels, overlap_apply, packed, rechunk, recordings, resample, sizes_by_rate, to_stereo, unpacked, with_halo
from nightwave.sources.shared import written

N_FFT, HOP, NOISE_S = 1024, 256, 2.0
METHODS = ("spectral", "model")


def level_db(spectra: DataFrame, column: str = "magnitude") -> DataFrame:
    """spectra with `db`: 20 log10 of the magnitudes, from -200 up."""
    return spectra.withColumn("db", F.transform(column, lambda m: 20 * F.log10(F.greatest(m, F.lit(1e-10)))))


def floor_of(spectra: DataFrame, keys: tuple[str, ...], n_std: float = 1.5) -> DataFrame:
    """keys, bin, floor_db: mean and n_std deviations of each bin's level over the given frames."""
    rows = level_db(spectra).select(*keys, F.posexplode("db").alias("bin", "db"))
    return rows.groupBy(*keys, "bin").agg((F.avg("db") + n_std * F.stddev_pop("db")).alias("floor_db"))


def noise_profile(chunks: DataFrame, seconds: float = NOISE_S, n_std: float = 1.5) -> DataFrame:
    """recording_id, channel, bin, floor_db of the first seconds of each channel. Only the first chunks are read on."""
    head = chunks.filter(F.col("start_sample") < F.floor(F.lit(seconds) * F.col("sample_rate")))

    def run(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                stop = int(seconds * r["sample_rate"]) - r["start_sample"]
                mag = np.abs(kernels.spectra(kernels.centred_frames(np.asarray(r["samples"][:stop], np.float64), N_FFT, HOP), kernels.hann(N_FFT)))
                out += [{"recording_id": r["recording_id"], "channel": r["channel"], "magnitude": m} for m in mag.tolist()]
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("recording_id", pa.string()), ("channel", pa.int32()), ("magnitude", pa.list_(pa.float64()))]))

    return floor_of(head.select(*CHUNK).mapInArrow(run, "recording_id string, channel int, magnitude array<double>"), ("recording_id", "channel"), n_std)


def spectral_gate(chunks: DataFrame, prop_decrease: float = 0.8, stationary: bool = False, n_std: float = 1.5, seconds: float = NOISE_S) -> DataFrame:
    """Chunks with noise lowered; shape and rate stay. The floor follows the sound itself, or is the recording's noise profile.

    A chunk gets as much of its neighbours as its values depend on, so these do not depend on how a recording is cut;
    chunks shorter than that are joined for the gate and cut again.
    """
    return _gated(chunks, {"samples": prop_decrease}, stationary, n_std, seconds)


def compare_gates(chunks: DataFrame, shares: dict[str, float], stationary: bool = False, n_std: float = 1.5, seconds: float = NOISE_S) -> DataFrame:
    """Chunks with, beside their samples, a column of gated samples for each prop_decrease, all from one exchange. Chunks shorter than the gate reaches are joined and stay so."""
    return _gated(chunks, {"samples": 0.0} | shares, stationary, n_std, seconds, False)


def _gated(chunks: DataFrame, shares: dict[str, float], stationary: bool, n_std: float, seconds: float, cut_again: bool = True) -> DataFrame:
    if not all(0 <= p <= 1 for p in shares.values()):
        raise ValueError("prop_decrease is a share from 0 to 1")
    reach = kernels.gate_reach(N_FFT, HOP)
    out = None
    for rate, size in sizes_by_rate(chunks):
        own = chunks.filter(F.col("sample_rate") == rate)
        own = rechunk(own, reach) if size < reach else own
        held = with_halo(own, reach, reach)
        if stationary:
            floors = noise_profile(own, seconds, n_std).groupBy("recording_id", "channel").agg(F.array_sort(F.collect_list(F.struct("bin", "floor_db"))).alias("f")).select("recording_id", "channel", F.col("f.floor_db").alias("floor"))
            held = held.join(floors, ["recording_id", "channel"], "left")
        else:
            held = held.withColumn("floor", F.lit(None).cast("array<double>"))

        def run(batches):
            keys = [*CHUNK[:-1]]
            for b in batches:
                for k in range(0, len(b), 16):
                    part = b.slice(k, 16)
                    made: dict[str, list[np.ndarray]] = {n: [] for n in shares}
                    for r, v in zip(part.select([*keys, "left_n", "right_n", "floor"]).to_pylist(), part["samples"]):
                        x, floor = v.values.to_numpy(zero_copy_only=False), None if r["floor"] is None else np.array(r["floor"])
                        for name, share in shares.items():
                            made[name].append(kernels.gate(x, share, floor, r["start_sample"] - r["left_n"], N_FFT, HOP)[r["left_n"]:len(x) - r["right_n"]])
                    yield pa.RecordBatch.from_arrays([*(part[c] for c in keys), *map(_sample_lists, made.values())], names=[*keys, *made])

        done = held.mapInArrow(run, "recording_id string, channel int, chunk_id long, start_sample long, sample_rate int, " + ", ".join(f"{n} array<float>" for n in shares))
        done = rechunk(done, size) if cut_again and size < reach else done
        out = done if out is None else out.unionByName(done)
    return out if out is not None else chunks.withColumns({n: F.col("samples") for n in shares})


def denoise(chunks: DataFrame, method: str = "spectral", kernel: Callable[[np.ndarray, dict], np.ndarray] | None = None, kernel_rate: int | None = None, kernel_channels: int | None = None,
            segment_s: float = 10.0, overlap: float = 0.25, **gate) -> DataFrame:
    """chunks denoised by the gate, or by the user's kernel on overlapping segments; recordings on which that fails go through the gate.

    A kernel with kernel_rate gets its segments at that rate, the result is brought back to the recording's; one with
    kernel_channels=2 gets (2, samples): the only channel twice, or the first two, and recordings with one channel get the
    mean of the two back, others both. The kernel's results are written once, so it is run once a segment.
    """
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}: one of {METHODS}")
    if kernel_channels not in (None, 2):
        raise ValueError("a kernel is for one channel at a time (None) or for 2")
    if method == "spectral" or kernel is None:
        return spectral_gate(chunks, **gate)

    def guarded(x: np.ndarray, row: dict) -> np.ndarray:
        try:
            return kernel(x, row)
        except Exception:  # a user's kernel may fail in any way; the recording is marked and done again by the gate
            return np.full(x.shape, np.nan, np.float32)

    fed = to_stereo(chunks) if kernel_channels == 2 else chunks
    fed = fed if kernel_rate is None else resample(fed, kernel_rate)
    marked = overlap_apply(fed.select(*CHUNK), guarded, segment_s, overlap, kernel_channels == 2).withColumn("failed", F.exists("samples", lambda v: F.isnan(v)))
    done = written(packed(marked), "kernel")  # joined as they are packed
    failed = written(done.filter("failed").select("recording_id").distinct(), "failed")
    good = unpacked(done.join(failed, "recording_id", "left_anti").select(*CHUNK))
    recs = recordings(chunks)
    if kernel_channels == 2:
        good = match_channels(good, recs)
    if kernel_rate is not None:
        good = _at_own_rate(good, recs, chunks)
    again = unpacked(packed(chunks.select(*CHUNK)).join(failed, "recording_id", "left_semi").select(*CHUNK))
    return good.select(*CHUNK).unionByName(spectral_gate(again, **gate))


def _at_own_rate(good: DataFrame, recs: DataFrame, chunks: DataFrame) -> DataFrame:
    """Results brought back to each recording's rate, its length and chunks as long as before."""
    out = None
    for rate, size in sizes_by_rate(chunks):
        own = recs.filter(F.col("sample_rate") == rate).select("recording_id", "n_samples")
        back = rechunk(resample(good.join(own.select("recording_id"), "recording_id", "left_semi").select(*CHUNK), rate), size)
        room = (F.col("n_samples") - F.col("start_sample")).cast("int")
        back = back.join(own, "recording_id").filter("start_sample < n_samples").withColumn("samples", F.slice("samples", F.lit(1), F.least(F.size("samples"), room))).select(*CHUNK)
        out = back if out is None else out.unionByName(back)
    return out


def first_frames(frames: DataFrame, n: int) -> DataFrame:
    """The first n frames of each recording, as a noise reference."""
    w = Window.partitionBy("recording_id").orderBy("frame_idx")
    return frames.withColumn("_i", F.row_number().over(w)).filter(F.col("_i") <= n).drop("_i")
