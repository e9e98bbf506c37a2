"""Recordings as tables of sample chunks: (recording_id, channel, chunk_id, start_sample, sample_rate, samples).

No recording is ever gathered: work is keyed by (recording_id, channel, chunk_id). What is exchanged are packed pieces of
chunks: samples as whole numbers of as few bytes as hold them exactly, so 16-bit audio moves in two bytes a sample or less.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, FloatType, StructField, StructType

from nightwave.functions import kernels
from nightwave.sources.shared import released

HELD = 1 << 20
CHUNK = ["recording_id", "channel", "chunk_id", "start_sample", "sample_rate", "samples"]


def recordings(chunks: DataFrame) -> DataFrame:
    """recording_id, sample_rate, n_channels, n_samples, duration_s."""
    out = chunks.groupBy("recording_id", "sample_rate").agg(F.countDistinct("channel").cast("int").alias("n_channels"), F.max(F.col("start_sample") + F.size("samples")).alias("n_samples"))
    return out.withColumn("duration_s", F.col("n_samples") / F.col("sample_rate"))


def to_mono(chunks: DataFrame) -> DataFrame:
    """The mean of the channels, as channel 0. Channels of a chunk meet; partial sums are not needed, a chunk has few."""
    def meet(to, rate, held):
        xs = [x for *_, x in held]
        return held[0][1], xs[0] if len(xs) == 1 else (sum(x.astype(np.float64) for x in xs) / len(xs)).astype(np.float32), 0, 0

    return joined(pieces_of(chunks, lambda k, start, x: [(k, 0, start, x)], across=True), meet).withColumn("channel", F.lit(0)).select(*CHUNK)


def to_stereo(chunks: DataFrame) -> DataFrame:
    """Two channels: the only one twice, or the first two."""
    n = chunks.groupBy("recording_id").agg(F.max("channel").alias("top"))
    rows = chunks.join(n, "recording_id").filter("channel < 2")
    copies = F.when(F.col("top") == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array("channel"))
    return rows.select("recording_id", F.explode(copies).alias("channel"), "chunk_id", "start_sample", "sample_rate", "samples")


def match_channels(out: DataFrame, recs: DataFrame) -> DataFrame:
    """Two-channel results as the recordings had them: the mean for those with one channel, else both."""
    known = out.join(recs.select("recording_id", "n_channels"), "recording_id")
    one = to_mono(known.filter("n_channels = 1").select(*CHUNK))
    return known.filter("n_channels > 1").select(*CHUNK).unionByName(one)


#: Whole numbers that samples are packed as are counted in units of 2 ** -23, shifted by the zeros that all of them end in.
_UNIT, _KINDS = 23, {1: np.int8, 2: np.int16, 4: np.int32}


def pack(x: np.ndarray) -> bytes:
    """float32 samples, bit by bit the same after `unpack`: whole numbers of 1, 2 or 4 bytes where that is exact (PCM of 16 or 24 bits), else as they are."""
    x = np.ascontiguousarray(x, np.float32)
    if not len(x):
        return b""
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = x.astype(np.float64) * (1 << _UNIT)
        whole = bool((np.abs(scaled) < 1 << 31).all()) and bool((scaled == np.rint(scaled)).all())
    if not whole or (np.signbit(x) & (x == 0)).any():
        return b"\0\0" + x.tobytes()
    k = scaled.astype(np.int64)
    union = int(np.bitwise_or.reduce(k))
    shift = (union & -union).bit_length() - 1 if union else 0
    k >>= shift
    low, high = int(k.min()), int(k.max())
    width = next(w for w in _KINDS if -(1 << 8 * w - 1) <= low and high < 1 << 8 * w - 1)
    return bytes((width, shift)) + k.astype(_KINDS[width]).tobytes()


def unpack(raw: bytes) -> np.ndarray:
    """The samples of `pack`."""
    if not len(raw):
        return np.zeros(0, np.float32)
    if not raw[0]:
        return np.frombuffer(raw, np.float32, offset=2)
    return np.ldexp(np.frombuffer(raw, _KINDS[raw[0]], offset=2).astype(np.float64), raw[1] - _UNIT).astype(np.float32)


def packed(chunks: DataFrame) -> DataFrame:
    """chunks with packed samples (binary), for tables and joins that move whole chunks."""
    def run(batches):
        for b in batches:
            at = b.schema.get_field_index("samples")
            yield b.set_column(at, "samples", pa.array([pack(v.values.to_numpy(zero_copy_only=False)) for v in b.column(at)], pa.binary()))

    return chunks.mapInArrow(run, _with_type(chunks.schema, "samples", BinaryType()))


def unpacked(chunks: DataFrame) -> DataFrame:
    """chunks whose samples are those that `packed` packed."""
    def run(batches):
        for b in batches:
            at, first, held, size = b.schema.get_field_index("samples"), 0, [], 0
            for k, v in enumerate(b.column(at)):
                held.append(unpack(v.as_py()))
                size += len(held[-1])
                if size > HELD or k == len(b) - 1:
                    yield b.slice(first, k + 1 - first).set_column(at, "samples", _sample_lists(held))
                    first, held, size = k + 1, [], 0

    return chunks.mapInArrow(run, _with_type(chunks.schema, "samples", ArrayType(FloatType())))


def _with_type(schema: StructType, name: str, kind) -> StructType:
    return StructType([StructField(f.name, kind) if f.name == name else f for f in schema.fields])


PIECE = "recording_id string, channel int, to long, part int, at long, sample_rate int, samples binary"
Piece = tuple[int, int, np.ndarray]


def groups(batches, keys: tuple[str, ...], columns: tuple[str, ...]) -> Iterator[tuple[tuple, list[tuple]]]:
    """(values of the keys, rows of the other columns) of rows that are sorted by the keys, one group at a time."""
    at, held = None, []
    for b in batches:
        for row in zip(*(b[c].to_pylist() for c in (*keys, *columns))):
            key = row[:len(keys)]
            if key != at:
                if held:
                    yield at, held
                at, held = key, []
            held.append(row[len(keys):])
    if held:
        yield at, held


def pieces_of(chunks: DataFrame, cut: Callable[[int, int, np.ndarray], Iterable[tuple[int, int, int, np.ndarray]]], across: bool = False) -> DataFrame:
    """The pieces (to, part, at, samples) that cut(chunk_id, start_sample, samples) makes of every chunk, packed and sorted where those of one (recording_id, channel, to) meet: the one exchange of samples.

    With across, those of all channels meet as channel 0, and a piece's part is its channel.
    """
    return meeting(cut_up(chunks, cut, across))


def meeting(pieces: DataFrame) -> DataFrame:
    key = ["recording_id", "channel", "to"]
    return pieces.repartition(*key).sortWithinPartitions(*key, "part", "at")


def cut_up(chunks: DataFrame, cut: Callable[[int, int, np.ndarray], Iterable[tuple[int, int, int, np.ndarray]]], across: bool = False) -> DataFrame:
    """The pieces of `pieces_of` where they are cut."""
    def run(batches):
        for b in batches:
            own, rows, size = b.select(["recording_id", "channel", "chunk_id", "start_sample", "sample_rate"]).to_pylist(), [], 0
            for r, v in zip(own, b["samples"]):
                for to, part, at, x in cut(r["chunk_id"], r["start_sample"], v.values.to_numpy(zero_copy_only=False)):
                    channel, part = (0, r["channel"]) if across else (r["channel"], part)
                    rows.append((r["recording_id"], channel, to, part, at, r["sample_rate"], pack(x)))
                    size += len(x)
                    if size > HELD:
                        yield _piece_batch(rows)
                        rows, size = [], 0
            if rows:
                yield _piece_batch(rows)

    return chunks.select(*CHUNK).mapInArrow(run, PIECE)


def _piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"recording_id": pa.string(), "channel": pa.int32(), "to": pa.int64(), "part": pa.int32(), "at": pa.int64(), "sample_rate": pa.int32(), "samples": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds.values())], names=list(kinds))


_HELD_CHUNK = "recording_id string, channel int, chunk_id long, start_sample long, sample_rate int, samples array<float>, left_n int, right_n int"


def joined(pieces: DataFrame, meet: Callable[[int, int, list[Piece]], tuple[int, np.ndarray, int, int] | None]) -> DataFrame:
    """Chunks with a halo from `pieces_of`: meet(to, sample_rate, [(part, at, samples)]) gives start_sample, samples, left_n and right_n of the chunk `to`, or None where there is none."""
    def batch(rows: list[tuple], xs: list[np.ndarray]) -> pa.RecordBatch:
        recording, channel, to, start, rate, left, right = zip(*rows)
        columns = [pa.array(recording, pa.string()), pa.array(channel, pa.int32()), pa.array(to, pa.int64()), pa.array(start, pa.int64()), pa.array(rate, pa.int32()), _sample_lists(xs), pa.array(left, pa.int32()), pa.array(right, pa.int32())]
        return pa.RecordBatch.from_arrays(columns, names=[*CHUNK, "left_n", "right_n"])

    def run(batches):
        rows, xs, size = [], [], 0
        for (recording, channel, to), held in groups(batches, ("recording_id", "channel", "to"), ("part", "at", "sample_rate", "samples")):
            made = meet(to, held[0][2], [(part, at, unpack(raw)) for part, at, _, raw in held])
            if made is not None:
                start, x, left, right = made
                rows.append((recording, channel, to, start, held[0][2], left, right))
                xs.append(x)
                size += len(x)
                if size > HELD:
                    yield batch(rows, xs)
                    rows, xs, size = [], [], 0
        if rows:
            yield batch(rows, xs)

    return pieces.mapInArrow(run, _HELD_CHUNK)


def with_halo(chunks: DataFrame, left: int, right: int) -> DataFrame:
    """Chunks with up to `left` samples of the one before and `right` of the one after, and how many: left_n, right_n.

    Chunks and copies of their borders meet in one exchange. A halo must not be longer than a chunk
    (the last one of a recording may be shorter): where it is, and further chunks would be needed, that is an error.
    """
    return joined(pieces_of(chunks, lambda k, start, x: bordered(k, start, x, left, right)), lambda to, rate, held: held_chunk(to, held, left, right))


def bordered(k: int, start: int, x: np.ndarray, left: int, right: int) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """A chunk, and its borders for its neighbours."""
    yield k, 0, start, x
    if left:
        yield k + 1, -1, start, x[-left:]
    if right and k > 0:
        yield k - 1, 1, start, x[:right]


def held_chunk(to: int, held: list[Piece], left: int, right: int) -> tuple[int, np.ndarray, int, int] | None:
    """start_sample, samples, left_n and right_n of what `bordered` sent to a chunk; None for a border behind the recording's end."""
    none = np.zeros(0, np.float32)
    by = {part: (at, x) for part, at, x in held}
    if 0 not in by:
        return None
    (start, own), before, after = by[0], by.get(-1, (0, none))[1], by.get(1, (0, none))[1]
    if len(before) < left and to > 1 or len(after) < right and len(after) >= len(own) > 0:
        raise ValueError(f"a halo of {left} and {right} samples is longer than a chunk")
    return start, np.concatenate([before, own, after]), len(before), len(after)


def stitch(chunks: DataFrame) -> DataFrame:
    """Chunks without their halo."""
    return chunks.select("recording_id", "channel", "chunk_id", "start_sample", "sample_rate", F.slice("samples", F.col("left_n") + 1, F.size("samples") - F.col("left_n") - F.col("right_n")).alias("samples"))


def _sample_lists(results: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0] + [len(y) for y in results])
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.concatenate([*results, np.zeros(0, np.float32)]).astype(np.float32, copy=False)))


def map_samples(chunks: DataFrame, function: Callable[[np.ndarray, dict], np.ndarray], schema: StructType | None = None) -> DataFrame:
    """chunks with `function(samples, row)` as samples; row has the other columns. Results leave when they have `HELD` samples."""
    def run(batches):
        for b in batches:
            at = b.schema.get_field_index("samples")
            rest = b.select([n for n in b.schema.names if n != "samples"]).to_pylist()
            done, size, first = [], 0, 0
            for k, row in enumerate(rest):
                done.append(np.asarray(function(b.column(at)[k].values.to_numpy(zero_copy_only=False), row), np.float32))
                size += len(done[-1])
                if size > HELD or k == len(rest) - 1:
                    yield b.slice(first, k + 1 - first).set_column(at, "samples", _sample_lists(done))
                    done, size, first = [], 0, k + 1

    return chunks.mapInArrow(run, schema or chunks.schema)


def rates_of(chunks: DataFrame) -> list[int]:
    """Sample rates, a few. Best asked of chunks as they are read: what is made of samples on the way is then not made for it."""
    with released(chunks.sparkSession):
        return sorted(r.sample_rate for r in chunks.select("sample_rate").distinct().collect())


def mono_at(chunks: DataFrame, target_rate: int) -> DataFrame:
    """The mean of the channels at another rate: `resample` of `to_mono`."""
    out = None
    for rate in rates_of(chunks):
        own = to_mono(chunks.filter(F.col("sample_rate") == rate))
        own = own if rate == target_rate else _resampled(own, rate, target_rate)
        out = own if out is None else out.unionByName(own)
    return chunks.select(*CHUNK).limit(0) if out is None else out


def resample(chunks: DataFrame, target_rate: int, zeros: int = 16) -> DataFrame:
    """Chunks at another rate by a bank of windowed sincs, one a phase, over each chunk with its halo; chunks at that rate stay as they are.

    An output sample n lies at input place n * rate / target; a chunk makes the outputs whose place lies in it, so outputs tile.
    """
    out = chunks.filter(F.col("sample_rate") == target_rate).select(*CHUNK)
    for rate in rates_of(chunks.filter(F.col("sample_rate") != target_rate)):
        out = out.unionByName(_resampled(chunks.filter(F.col("sample_rate") == rate), rate, target_rate, zeros))
    return out


def _resampled(chunks: DataFrame, rate: int, target_rate: int, zeros: int = 16) -> DataFrame:
    reach = kernels.sinc_reach(rate, target_rate, zeros)
    done = map_samples(with_halo(chunks, reach, reach), lambda x, r: kernels.resample(x, int(r["start_sample"]) - r["left_n"], r["left_n"], r["right_n"], rate, target_rate, zeros))
    first = F.expr(f"(start_sample * {target_rate} + {rate} - 1) div {rate}")
    return done.select("recording_id", "channel", "chunk_id", first.alias("start_sample"), F.lit(target_rate).alias("sample_rate"), "samples")


def _grid(start: int, x: np.ndarray, size: int, part: int = 0, more: int = 0) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """The pieces of x, which begins at start, for chunks of `size` that reach `more` samples into the next ones."""
    for to in range(max(0, (start - size - more) // size + 1), (start + len(x) - 1) // size + 1) if len(x) else ():
        a, b = max(start, to * size), min(start + len(x), (to + 1) * size + more)
        if b > a:
            yield to, part, a, x[a - start:b - start]


def rechunk(chunks: DataFrame, size: int) -> DataFrame:
    """The same samples in chunks of `size`; pieces are cut and joined, samples are not exploded."""
    whole = pieces_of(chunks, lambda k, start, x: _grid(start, x, size))
    return joined(whole, lambda to, rate, held: (to * size, np.concatenate([x for *_, x in held]), 0, 0)).select(*CHUNK)


def sizes_by_rate(chunks: DataFrame) -> list[tuple[int, int]]:
    """(sample_rate, samples of its longest chunk, at least 1), a few rates."""
    with released(chunks.sparkSession):
        found = chunks.groupBy("sample_rate").agg(F.max(F.size("samples")).alias("size")).collect()
    return sorted((r.sample_rate, max(1, r["size"])) for r in found)


def overlap_apply(chunks: DataFrame, kernel: Callable[[np.ndarray, dict], np.ndarray], segment_s: float = 10.0, overlap: float = 0.25, joint: bool = False) -> DataFrame:
    """Segments of segment_s that overlap by a share (at most a half), through a kernel, cross-faded in a line; chunks as long as before.

    A segment starts each segment_s * (1 - overlap). Only what a segment reaches into the next one moves on, so a recording
    is never in one task, and the kernel is run once a segment. A kernel takes the samples of a channel or, if joint,
    the (channels, samples) of all channels.
    """
    if not 0 <= overlap <= 0.5:
        raise ValueError("segments may overlap by 0 to a half")
    out = None
    for rate, size in sizes_by_rate(chunks):
        fade = int(int(segment_s * rate) * overlap)
        step = int(segment_s * rate) - fade
        cut = pieces_of(chunks.filter(F.col("sample_rate") == rate), lambda k, start, x, step=step, fade=fade: _grid(start, x, step, 0, fade))
        held = joined(cut, lambda to, rate, held, step=step: _segment(to * step, step, held))
        done = _jointly(held, kernel) if joint else map_samples(held, kernel)
        rows = joined(pieces_of(done, lambda k, start, x, step=step, fade=fade, size=size: (*_grid(start, x[:step], size), *_grid(start + step, x[step:step + fade], size, 1))),
                      lambda to, rate, held, step=step, fade=fade, size=size: _faded(to * size, step, fade, held)).select(*CHUNK)
        out = rows if out is None else out.unionByName(rows)
    return chunks if out is None else out


def _segment(start: int, step: int, held: list[Piece]) -> tuple[int, np.ndarray, int, int]:
    x = np.concatenate([x for *_, x in held])
    return start, x, 0, max(0, len(x) - step)


def _faded(start: int, step: int, fade: int, held: list[Piece]) -> tuple[int, np.ndarray, int, int] | None:
    """A chunk of segments' own samples (part 0), the first of each faded in over the end of the one before (part 1)."""
    own = [x for part, _, x in held if part == 0]
    if not own:  # an end without a segment behind it
        return None
    out = np.concatenate(own)
    for part, at, x in held:
        if part == 1:
            t, a = x[:max(0, start + len(out) - at)].astype(np.float64), at - start
            w = ((at + np.arange(len(t))) % step + 1) / float(fade + 1)
            out[a:a + len(t)] = out[a:a + len(t)] * w + t * (1 - w)
    return start, out, 0, 0


def _jointly(held: DataFrame, kernel: Callable[[np.ndarray, dict], np.ndarray]) -> DataFrame:
    """Chunks with a halo through a kernel of all channels of a chunk at once."""
    key = ["recording_id", "chunk_id", "start_sample", "sample_rate", "left_n", "right_n"]
    whole = held.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("channel", "samples"))).alias("c")).select(*key, F.col("c.channel").alias("channels"), F.col("c.samples").alias("samples"))

    def run(batches):
        for b in batches:
            rest = b.select([*key, "channels"]).to_pylist()
            for k, row in enumerate(rest):
                x = np.stack([c.values.to_numpy(zero_copy_only=False) for c in b["samples"][k]])
                lists = _sample_lists([np.asarray(y, np.float32) for y in kernel(x, row)])
                yield b.slice(k, 1).set_column(b.schema.get_field_index("samples"), "samples", pa.ListArray.from_arrays(pa.array([0, len(lists)], pa.int32()), lists))

    done = whole.mapInArrow(run, whole.schema)
    return done.select(*key, F.explode(F.arrays_zip("channels", "samples")).alias("c")).select("recording_id", F.col("c.channels").alias("channel"), "chunk_id", "start_sample", "sample_rate", F.col("c.samples").alias("samples"), "left_n", "right_n")
