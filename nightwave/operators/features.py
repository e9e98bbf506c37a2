"""Frame features of mono recordings: spectra, mel bands, cepstra and their slopes, zero crossings, levels, z-scores.

Kernels run on chunks with a halo and give one row a frame, never a row a sample; maxima and moments over a recording are
separate aggregates, so no result depends on how a recording is cut into chunks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from nightwave.functions import kernels
from nightwave.operators.chunks import PIECE, bordered, cut_up, groups, held_chunk, meeting, rechunk, sizes_by_rate, unpack, with_halo

N_MELS, N_MFCC, FLOOR, TOP_DB = 128, 40, 1e-10, 80.0
#: Least-squares weights over nine frames, of the slope (divided by 60) and of the curvature (divided by 462).
SLOPE = tuple(k / 60 for k in range(-4, 5))
CURVE = tuple(k / 462 for k in (28, 7, -8, -17, -20, -17, -8, 7, 28))


def frame_params(rate: str | Column = "sample_rate") -> tuple[Column, Column, Column]:
    """Samples a frame (25 ms), a hop (10 ms), and the FFT length (the power of two from 50 ms, not below the frame)."""
    r = F.col(rate) if isinstance(rate, str) else rate
    frame, hop = F.floor(r * 25 / 1000).cast("int"), F.floor(r * 10 / 1000).cast("int")
    fft = F.pow(F.lit(2), F.ceil(F.round(F.log2(F.floor(r * 50 / 1000)), 9))).cast("int")
    return frame, hop, F.greatest(fft, frame)


def params_of(rate: int, frame_ms: int = 25, hop_ms: int = 10) -> tuple[int, int, int]:
    frame, hop = rate * frame_ms // 1000, rate * hop_ms // 1000
    return frame, hop, max(1 << (rate * 50 // 1000 - 1).bit_length(), frame)


# --- columns of one frame ---------------------------------------------------------------------------------------

def frame_rms(samples: str = "samples") -> Column:
    return F.sqrt(F.aggregate(samples, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")) / F.size(samples))


def zero_crossing_rate(samples: str = "samples") -> Column:
    """Changes of sign inside a frame over its length; values up to 1e-10 count as positive zero."""
    sign = F.transform(samples, lambda x: x.cast("double") < -1e-10)
    return F.aggregate(F.zip_with(F.slice(sign, 2, F.size(samples) - 1), F.slice(sign, 1, F.size(samples) - 1), lambda a, b: (a != b).cast("int")), F.lit(0), lambda s, x: s + x) / F.size(samples)


def _total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda s, v: s + v)


def spectral_centroid(magnitude: str, bin_hz: Column) -> Column:
    """Mean frequency by magnitude; 0 for silence."""
    m = F.col(magnitude)
    total = _total(m)
    return F.when(total > 0, _total(F.transform(m, lambda v, k: v * k * bin_hz)) / total).otherwise(0.0)


def spectral_rolloff(magnitude: str, bin_hz: Column, share: float = 0.85) -> Column:
    """The least bin frequency at which the running sum of magnitudes reaches a share of the whole; 0 for silence."""
    m = F.col(magnitude)
    total = _total(m) * share
    seen = F.aggregate(m, F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("below")), lambda s, v: F.struct((s["sum"] + v).alias("sum"), (s["below"] + F.when(s["sum"] + v < total, 1).otherwise(0)).alias("below")))
    return F.when(total > 0, F.least(seen["below"], F.size(m) - 1) * bin_hz).otherwise(0.0)


# --- kernels on frames ------------------------------------------------------------------------------------------

def _lists(x: np.ndarray) -> pa.Array:
    """Rows of a matrix as an array column."""
    return pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(np.ascontiguousarray(x).reshape(-1)))


def _mapped(df: DataFrame, column: str, name: str, function) -> DataFrame:
    """df with an array<double> column made from an array column, whole batches of equal length at once."""
    def run(batches):
        for b in batches:
            flat = b[column].flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            out = _lists(function(flat.reshape(len(b), -1))) if len(b) else pa.array([], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*b.columns, out], names=[*b.schema.names, name])

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField(name, ArrayType(DoubleType()))]))


def magnitude_spectrum(frames: DataFrame, name: str = "magnitude") -> DataFrame:
    """Magnitudes of the Hann-windowed spectrum of frames of one even length (array column `samples`)."""
    return _mapped(frames, "samples", name, lambda x: np.abs(kernels.spectra(x, kernels.hann(x.shape[1]))))


def mel_power(spectra: DataFrame, rate: int, n_fft: int, n_mels: int = N_MELS, name: str = "mel") -> DataFrame:
    """Mel bands of the squared magnitudes."""
    bank = kernels.mel_filters(rate, n_fft, n_mels)
    return _mapped(spectra, "magnitude", name, lambda m: m**2 @ bank.T)


def mfcc(frames: DataFrame, column: str = "mel_db", n: int = N_MFCC, name: str = "mfcc") -> DataFrame:
    """The first n coefficients of the orthonormal cosine transform of the dB bands."""
    return _mapped(frames, column, name, lambda x: x @ kernels.dct_matrix(x.shape[1], n).T)


def power_to_db(frames: DataFrame, column: str = "mel", name: str = "mel_db", ref: float | str = "max") -> DataFrame:
    """10 log10 of power over ref (a number, or "max": the recording's), not below the recording's maximum less 80 dB."""
    top = frames.groupBy("recording_id").agg(F.greatest(F.max(F.array_max(column)), F.lit(FLOOR)).alias("_top"))
    base = F.col("_top") if ref == "max" else F.lit(float(ref))
    db = lambda x: 10 * F.log10(F.greatest(x, F.lit(FLOOR)) / F.greatest(base, F.lit(FLOOR)))
    return frames.join(top, "recording_id").withColumn(name, F.transform(column, lambda x: F.greatest(db(x), db(F.col("_top")) - TOP_DB))).drop("_top")


# --- along a recording ------------------------------------------------------------------------------------------

#: Frames on either side of a block that its slopes depend on: nine frames from the recording's ends, wherever a block is cut.
REACH = 8


def slopes_of(x: np.ndarray, order: int) -> np.ndarray:
    """Slopes (order 1) or curvatures (order 2) of rows over nine neighbours; the first and last four rows take the nearest full value."""
    full = np.zeros((len(x) - 8, x.shape[1]))
    for k, c in enumerate(SLOPE if order == 1 else CURVE):
        full += c * x[k:k + len(full)]
    return full[np.clip(np.arange(len(x)) - 4, 0, len(full) - 1)]


def slopes(series: DataFrame, column: str, orders: dict[str, int], short: str = "error", block: int = 1024) -> DataFrame:
    """series with a slope or curvature of an array column for each name of `orders`, all in one exchange.

    A recording is dealt out by blocks of frames with copies of the eight frames before and after, which tell a block
    also whether it holds an end of the recording, so results do not depend on the blocks and no recording is one task.
    frame_idx has no gaps within a recording. Recordings of fewer than nine frames are an error or, with short="null",
    have null for every value of the array.
    """
    if short not in ("error", "null"):
        raise ValueError("short is error or null")
    if block < REACH:
        raise ValueError(f"a block has at least {REACH} frames")
    at, columns = F.floor(F.col("frame_idx") / block), series.columns
    reached = F.array_distinct(F.array(at, F.floor(F.greatest(F.col("frame_idx") - REACH, F.lit(0)) / block), F.floor((F.col("frame_idx") + REACH) / block)))

    def run(key, table):
        table = table.sort_by("frame_idx")
        idx = table["frame_idx"].to_numpy()
        own = np.flatnonzero(idx // block == key[1].as_py())
        if not len(own):  # copies alone: the block is beyond an end of the recording
            return pa.Table.from_arrays([*table.select(columns).slice(0, 0).columns, *(pa.array([], pa.list_(pa.float64())) for _ in orders)], names=[*columns, *orders])
        if (np.diff(idx) != 1).any() or table[column].null_count:
            raise ValueError("slopes need frames without gaps, repeats and nulls")
        held = table.select(columns).slice(own[0], len(own))
        x = table[column].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(table), -1)
        if len(x) > REACH:
            made = [_lists(slopes_of(x, order)[own[0]:own[0] + len(own)]) for order in orders.values()]
        elif short == "error":
            raise ValueError("slopes need recordings of at least nine frames")
        else:
            made = [pa.array([[None] * x.shape[1]] * len(own), pa.list_(pa.float64())) for _ in orders]
        return pa.Table.from_arrays([*held.columns, *made], names=[*columns, *orders])

    schema = StructType([*series.schema.fields, *(StructField(n, ArrayType(DoubleType())) for n in orders)])
    return series.withColumn("_block", F.explode(reached)).groupBy("recording_id", "_block").applyInArrow(run, schema)


def delta(series: DataFrame, column: str, name: str, order: int = 1, short: str = "error") -> DataFrame:
    """`slopes` of one order: the slope (1) or curvature (2) over nine frames."""
    return slopes(series, column, {name: order}, short)


def align_frames(*tables: DataFrame) -> DataFrame:
    """The frames that all tables have, by (recording_id, frame_idx)."""
    out = tables[0]
    for t in tables[1:]:
        out = out.join(t, ["recording_id", "frame_idx"])
    return out


def stack_features(frames: DataFrame) -> DataFrame:
    """features: mfcc with slopes and curvatures (120), centroid, roll-off, zero crossings, harmonic ratio, log mel (128)."""
    one = lambda c: F.array(F.col(c).cast("float"))
    many = lambda c: F.col(c).cast("array<float>")
    return frames.withColumn("features", F.concat(many("mfcc"), *map(one, ("spectral_centroid", "spectral_rolloff", "zcr", "hnr")), many("log_mel")))


#: States that one task keeps before it passes them on, and the groups that a recording's states are merged in first.
_STATES, _FANS = 256, 64
_MOMENTS = "recording_id string, n long, mean array<double>, m2 array<double>, top array<double>"


def merge_moments(n: np.ndarray, mean: np.ndarray, m2: np.ndarray, top: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """One state of several (rows): counts, means, sums of squares about the mean, maxima; merged two by two, so errors grow with the logarithm of their number."""
    while len(n) > 1:
        k = len(n) // 2 * 2
        a, b, odd = slice(0, k, 2), slice(1, k, 2), slice(k, None)
        total, gap = n[a] + n[b], mean[b] - mean[a]
        share = (n[b] / total)[:, None]
        m2 = np.concatenate([m2[a] + m2[b] + gap**2 * share * n[a][:, None], m2[odd]])
        mean = np.concatenate([mean[a] + gap * share, mean[odd]])
        top = np.concatenate([np.maximum(top[a], top[b]), top[odd]])
        n = np.concatenate([total, n[odd]])
    return int(n[0]), mean[0], m2[0], top[0]


def moments(frames: DataFrame, column: str) -> DataFrame:
    """Per recording, of an array column: n, and per dimension mean, m2 (sum of squares about the mean) and top (maximum), in one scan.

    A task keeps one state a recording, `_STATES` at most; what is exchanged are states, merged in groups by task first,
    so that neither one recording nor its states pass through one task. Null arrays do not count.
    """
    def matrix(table, name: str) -> np.ndarray:
        flat = table[name].combine_chunks() if isinstance(table[name], pa.ChunkedArray) else table[name]
        return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(table), -1)

    def rows(states: dict) -> pa.RecordBatch:
        n, mean, m2, top = zip(*states.values())
        return pa.RecordBatch.from_arrays([pa.array(list(states), pa.string()), pa.array(n, pa.int64()), *(_lists(np.stack(x)) for x in (mean, m2, top))], names=["recording_id", "n", "mean", "m2", "top"])

    def partial(batches):
        states: dict = {}
        for b in batches:
            if not len(b):
                continue
            ids = b["recording_id"].dictionary_encode()
            names, at, x = ids.dictionary.to_pylist(), ids.indices.to_numpy(), matrix(b, column)
            order = np.argsort(at, kind="stable")
            starts = np.flatnonzero(np.diff(at[order], prepend=-1))
            for first, stop in zip(starts, [*starts[1:], len(order)]):
                name, own = names[at[order[first]]], x[order[first:stop]]
                mean = own.mean(axis=0)
                new = (len(own), mean, ((own - mean) ** 2).sum(axis=0), own.max(axis=0))
                states[name] = merge_moments(*(np.stack(p) for p in zip(states[name], new))) if name in states else new
                if len(states) >= _STATES:
                    yield rows(states)
                    states = {}
        if states:
            yield rows(states)

    def merged(key, table):
        state = merge_moments(table["n"].to_numpy(), *(matrix(table, c) for c in ("mean", "m2", "top")))
        return pa.Table.from_batches([rows({key[0].as_py(): state})])

    parts = frames.filter(F.col(column).isNotNull() & F.col("recording_id").isNotNull()).select("recording_id", F.col(column).cast("array<double>").alias(column)).mapInArrow(partial, _MOMENTS)
    fans = parts.withColumn("_fan", F.spark_partition_id() % _FANS).groupBy("recording_id", "_fan").applyInArrow(merged, _MOMENTS)
    return fans.groupBy("recording_id").applyInArrow(merged, _MOMENTS)


def normalize_features(frames: DataFrame, column: str = "features", name: str = "normalized", eps: float = 1e-8) -> DataFrame:
    """Z-scores of each dimension within a recording, by the deviation of the population; constant dimensions give 0."""
    of = moments(frames, column).select("recording_id", F.col("mean").alias("_mean"), F.transform("m2", lambda v: F.sqrt(v / F.col("n"))).alias("_std"))
    z = F.zip_with(F.zip_with(column, "_mean", lambda x, m: x - m), "_std", lambda x, s: (x / (s + eps)).cast("float"))
    return frames.join(of, "recording_id").withColumn(name, z).drop("_mean", "_std")


# --- chunks to frames -------------------------------------------------------------------------------------------

def _frame_kernel(x: np.ndarray, left: int, own: int, start: int, rate: int, last: bool, hnr: bool, frame_ms: int = 25, hop_ms: int = 10, n_mels: int = N_MELS) -> dict[str, np.ndarray]:
    """Features of the frames whose centre lies in a chunk's own samples (and of the end, in the last chunk)."""
    frame, hop, n_fft = params_of(rate, frame_ms, hop_ms)
    first = -(-start // hop)
    # frames of odd length are one fewer where the end is on the hop grid; all features keep to the shorter count
    stop = (start + own - frame % 2) // hop + 1 if last else -(-(start + own) // hop)
    centres = np.arange(first, stop) * hop - start + left
    out = {"frame_idx": np.arange(first, stop)}
    if not len(centres):
        return out | {k: np.zeros((0, 1)) for k in ("mel", "spectral_centroid", "spectral_rolloff", "zcr", "hnr")}
    def at(y, n, mode="constant"):
        padded = np.pad(y.astype(np.float64), (n, n), mode=mode)
        return padded[centres[:, None] - n // 2 + n + np.arange(n)[None]]
    mag = np.abs(kernels.spectra(at(x, n_fft), kernels.padded_window(frame, n_fft)))
    hz = np.arange(mag.shape[1]) * rate / n_fft
    total = mag.sum(axis=1)
    out["mel"] = mag**2 @ kernels.mel_filters(rate, n_fft, n_mels).T
    out["spectral_centroid"] = np.where(total > 0, mag @ hz / np.where(total > 0, total, 1), 0)
    out["spectral_rolloff"] = np.where(total > 0, hz[np.argmax(np.cumsum(mag, axis=1) >= 0.85 * total[:, None], axis=1)], 0)
    sign = at(x, frame, "edge") < -1e-10
    out["zcr"] = (sign[:, 1:] != sign[:, :-1]).sum(axis=1) / frame
    if hnr:
        skip = -(start - left) % 512  # the transform's hops fall on the recording's grid, however it is cut
        h = np.concatenate([np.zeros(min(skip, len(x)), np.float32), kernels.harmonic(x[skip:])])
        level = lambda y: (at(y, frame) ** 2).mean(axis=1)
        out["hnr"] = 10 * np.log10((level(h) + 1e-10) / (level(x - h) + 1e-10))
    else:
        out["hnr"] = np.zeros(len(centres))
    return out


def _of_mono(chunks: DataFrame) -> DataFrame:
    chunks = chunks.filter(F.size("samples") > 0)
    if chunks.filter("channel > 0").limit(1).count():
        raise ValueError("features are of mono recordings: take to_mono() first")
    return chunks


def frame_table(chunks: DataFrame, compute_hnr: bool = True, frame_ms: int = 25, hop_ms: int = 10, n_mels: int = N_MELS) -> DataFrame:
    """recording_id, frame_idx, time, mel, spectral_centroid, spectral_rolloff, zcr, hnr of mono chunks.

    Chunks shorter than the kernels reach are joined first; a recording without samples has no frames.
    """
    chunks = _of_mono(chunks)
    names = ["mel", "spectral_centroid", "spectral_rolloff", "zcr", "hnr"]
    schema = "recording_id string, frame_idx long, time double, mel array<double>, spectral_centroid double, spectral_rolloff double, zcr double, hnr double"
    out = None
    for rate, size in sizes_by_rate(chunks):
        own = chunks.filter(F.col("sample_rate") == rate)
        halo = max(params_of(rate, frame_ms, hop_ms)[2], 2048 + 512 * 16 if compute_hnr else 0)
        own = rechunk(own, halo) if size < halo else own
        ends = own.groupBy("recording_id").agg(F.max("chunk_id").alias("end_id"))
        held = with_halo(own, halo, halo).join(ends, "recording_id").select("recording_id", "start_sample", "samples", "left_n", "right_n", (F.col("chunk_id") == F.col("end_id")).alias("is_last"))

        def run(batches, rate=rate):
            _, hop, _ = params_of(rate, frame_ms, hop_ms)
            for b in batches:
                for r in b.to_pylist():
                    x = np.asarray(r["samples"], np.float32)
                    f = _frame_kernel(x, r["left_n"], len(x) - r["left_n"] - r["right_n"], r["start_sample"], rate, r["is_last"], compute_hnr, frame_ms, hop_ms, n_mels)
                    n = len(f["frame_idx"])
                    if n:
                        yield pa.RecordBatch.from_arrays([pa.array([r["recording_id"]] * n), pa.array(f["frame_idx"], pa.int64()), pa.array(f["frame_idx"] * hop / rate), _lists(f["mel"]), *(pa.array(f[k]) for k in names[1:])], names=["recording_id", "frame_idx", "time", *names])

        made = held.mapInArrow(run, schema)
        out = made if out is None else out.unionByName(made)
    return out if out is not None else chunks.sparkSession.createDataFrame([], schema)


def _mel_at(x: np.ndarray, centres: np.ndarray, rate: int, frame_ms: int, hop_ms: int, n_mels: int) -> np.ndarray:
    """Mel bands of the frames at these places of x, with zeros beyond it."""
    frame, _, n_fft = params_of(rate, frame_ms, hop_ms)
    held = np.pad(x.astype(np.float64), n_fft)
    mag = np.abs(kernels.spectra(held[centres[:, None] + (n_fft - n_fft // 2) + np.arange(n_fft)[None]], kernels.padded_window(frame, n_fft)))
    return mag**2 @ kernels.mel_filters(rate, n_fft, n_mels).T


def _border_frames(at: int, ahead: np.ndarray, behind: np.ndarray, frame: int, hop: int, n: int) -> np.ndarray:
    """Places of the frames whose n samples lie across a chunk's border at `at`, by up to n samples on either side; behind a last chunk or into a shorter one, all up to the recording's end."""
    stop = at + n // 2
    if len(behind) < n:
        stop = min((at + len(behind) - frame % 2) // hop * hop + 1, at + len(behind) + 1)
    places = np.arange(-(-max(0, at - (n - n // 2) + 1) // hop) * hop, stop, hop)
    begin = at - len(ahead)
    return places if begin == 0 else places[places - n // 2 >= begin]


def _tops(chunks: DataFrame, rate: int, frame_ms: int, hop_ms: int, n_mels: int) -> DataFrame:
    """recording_id, top (largest value of a mel band, `FLOOR` at least), last (chunk_id). Chunks stay where they are: what is exchanged are their largest values and the samples at their borders."""
    frame, hop, n = params_of(rate, frame_ms, hop_ms)

    def largest(x: np.ndarray, start: int, places: np.ndarray) -> float:
        return float(_mel_at(x, places - start, rate, frame_ms, hop_ms, n_mels).max()) if len(places) else FLOOR

    def cut(k, start, x):
        inside = np.arange(-(-(start + n // 2 if start else 0) // hop) * hop, start + len(x) - (n - n // 2) + 1, hop)
        yield k, 2, start, np.array([largest(x, start, inside)]).view(np.float32)
        yield k + 1, 0, start + len(x) - len(x[-n:]), x[-n:]
        if k > 0:
            yield k, 1, start, x[:n]

    def run(batches):
        for (recording, _, to), held in groups(batches, ("recording_id", "channel", "to"), ("part", "at", "samples")):
            by, none = {part: (at, unpack(raw)) for part, at, raw in held}, np.zeros(0, np.float32)
            top = float(by[2][1].view(np.float64)[0]) if 2 in by else FLOOR
            if 0 in by:
                (begin, ahead), behind = by[0], by.get(1, (0, none))[1]
                top = max(top, largest(np.concatenate([ahead, behind]), begin, _border_frames(begin + len(ahead), ahead, behind, frame, hop, n)))
            yield pa.RecordBatch.from_arrays([pa.array([recording]), pa.array([top]), pa.array([to if 2 in by else None], pa.int64())], names=["recording_id", "top", "last"])

    found = meeting(cut_up(chunks, cut)).mapInArrow(run, "recording_id string, top double, last long")
    return found.groupBy("recording_id").agg(F.max("top").alias("top"), F.max("last").alias("last"))


def _decibels(mel: np.ndarray, top: float, base: float) -> np.ndarray:
    """As `power_to_db`."""
    db = lambda v: 10 * np.log10(np.maximum(v, FLOOR) / max(base, FLOOR))
    return np.maximum(db(mel), db(np.float64(top)) - TOP_DB)


def _optional(x: np.ndarray, absent: np.ndarray | None) -> pa.Array:
    """Rows of a float matrix as an array column, null where absent."""
    flat = pa.array(np.ascontiguousarray(x, np.float32).reshape(-1), mask=None if absent is None else absent.reshape(-1))
    return pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), flat)


#: Frames that leave a task together.
_FRAMES = 2048


def extract_features(chunks: DataFrame, compute_hnr: bool = True, frame_ms: int = 25, hop_ms: int = 10, n_mfcc: int = N_MFCC, n_mels: int = N_MELS) -> DataFrame:
    """frame_features of mono chunks: mfcc (3 * n_mfcc), spectral_centroid, spectral_rolloff, zcr, hnr, log_mel (n_mels), features (all of them, 252 by default).

    A chunk makes all features of its frames from its samples, its neighbours' borders and the recording's largest mel value, so frames
    are not moved or written, which are a hundred times what the samples are. Mel bands are computed twice, first for that value; harmonic parts once.
    Recordings of fewer than nine frames have all their frames, with null for slopes and curvatures.
    """
    chunks = _of_mono(chunks)
    scalars = ["spectral_centroid", "spectral_rolloff", "zcr", "hnr"]
    schema = "recording_id string, frame_idx long, mfcc array<float>, time double, spectral_centroid double, spectral_rolloff double, zcr double, hnr double, log_mel array<float>, features array<float>"
    out = None
    for rate, size in sizes_by_rate(chunks):
        own = chunks.filter(F.col("sample_rate") == rate)
        frame, hop, n_fft = params_of(rate, frame_ms, hop_ms)
        halo = max(n_fft + REACH * hop, 2048 + 512 * 16 if compute_hnr else 0)
        own = rechunk(own, halo) if size < halo else own

        def told(batches, rate=rate):
            """A recording's largest value and its last chunk for each of its chunks."""
            for b in batches:
                for r in b.to_pylist():
                    n = r["last"] + 1
                    yield pa.RecordBatch.from_arrays([pa.array([r["recording_id"]] * n), pa.array([0] * n, pa.int32()), pa.array(range(n), pa.int64()), pa.array([2] * n, pa.int32()), pa.array([r["last"]] * n, pa.int64()), pa.array([rate] * n, pa.int32()),
                                                      pa.array([np.float64(r["top"]).tobytes()] * n, pa.binary())], names=["recording_id", "channel", "to", "part", "at", "sample_rate", "samples"])

        def run(batches, rate=rate, halo=halo, frame=frame, hop=hop):
            done, size = [], 0
            for (recording, _, to), held in groups(batches, ("recording_id", "channel", "to"), ("part", "at", "samples")):
                told_of = [(at, np.frombuffer(raw)[0]) for part, at, raw in held if part == 2]
                if not told_of:  # a border behind the recording's end
                    continue
                last, top = told_of[0]
                made = held_chunk(to, [(part, at, unpack(raw)) for part, at, raw in held if part != 2], halo, halo)
                start, x, left, right = made
                f = _frame_kernel(x, left, len(x) - left - right, start, rate, to == last, compute_hnr, frame_ms, hop_ms, n_mels)
                idx = f["frame_idx"]
                if not len(idx):
                    continue
                # eight frames more on either side, or all up to the recording's ends, for slopes
                first, stop = max(0, idx[0] - REACH), idx[-1] + 1
                if to != last:
                    end = start + len(x) - left
                    stop = min(stop + REACH, (end - frame % 2) // hop + 1) if right < halo else stop + REACH
                near = lambda a, b: _mel_at(x, np.arange(a, b) * hop - start + left, rate, frame_ms, hop_ms, n_mels)
                mel = np.concatenate([near(first, idx[0]), f["mel"], near(idx[-1] + 1, stop)])
                at = slice(idx[0] - first, idx[-1] + 1 - first)
                base = _decibels(mel, top, 1.0) @ kernels.dct_matrix(n_mels, n_mfcc).T
                sloped = [slopes_of(base, order)[at] if len(base) > REACH else np.full((len(idx), n_mfcc), np.nan) for order in (1, 2)]
                done.append((recording, idx, len(base) <= REACH, np.concatenate([base[at], *sloped], axis=1).astype(np.float32), [f[c] for c in scalars], _decibels(f["mel"], top, top).astype(np.float32)))
                size += len(idx)
                if size >= _FRAMES:
                    yield batch(done, hop, rate)
                    done, size = [], 0
            if done:
                yield batch(done, hop, rate)

        def batch(done, hop, rate):
            counts = [len(d[1]) for d in done]
            idx, mfcc, log_mel = (np.concatenate([d[k] for d in done]) for k in (1, 3, 5))
            values = [np.concatenate([d[4][k] for d in done]).astype(np.float64) for k in range(len(scalars))]
            features = np.concatenate([mfcc, np.stack(values, axis=1).astype(np.float32), log_mel], axis=1)
            absent = None
            if any(d[2] for d in done):
                short = np.repeat([d[2] for d in done], counts)
                absent = short[:, None] & ((np.arange(features.shape[1]) >= n_mfcc) & (np.arange(features.shape[1]) < 3 * n_mfcc))[None]
            names = [r for d, n in zip(done, counts) for r in [d[0]] * n]
            columns = [pa.array(names, pa.string()), pa.array(idx, pa.int64()), _optional(mfcc, None if absent is None else absent[:, :mfcc.shape[1]]), pa.array(idx * hop / rate), *map(pa.array, values), _optional(log_mel, None), _optional(features, absent)]
            return pa.RecordBatch.from_arrays(columns, names=["recording_id", "frame_idx", "mfcc", "time", *scalars, "log_mel", "features"])

        tops = _tops(own, rate, frame_ms, hop_ms, n_mels).mapInArrow(told, PIECE)
        made = meeting(cut_up(own, lambda k, start, x, halo=halo: bordered(k, start, x, halo, halo)).unionByName(tops)).mapInArrow(run, schema)
        out = made if out is None else out.unionByName(made)
    return out if out is not None else chunks.sparkSession.createDataFrame([], schema)
