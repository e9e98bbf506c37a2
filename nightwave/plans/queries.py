"""Registered queries over the driver's tables, with the SQL they must equal."""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightwave.config import TARGET_KEYWORDS
from nightwave.operators import chunks, clips, denoise, events, features, scoring, smoothing, windows
from nightwave.plans import pipeline, views
from nightwave.sources import catalogue, tables, wav
from nightwave.sources.shared import released, shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: Keywords that overlap on purpose, so that a class is in both groups.
TARGET, BREATH = ("ring",), ("bolt", "ring")


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f
    return add


def _frames(spark, sf_dir):
    return scoring.interpolate_frames(views.scores(spark, sf_dir), views.score_recordings(spark, sf_dir))


def _smooth(spark, sf_dir):
    return smoothing.smooth_windows(views.scores(spark, sf_dir), views.score_recordings(spark, sf_dir))


def _runs(spark, sf_dir):
    return events.find_runs(events.threshold_mask(_smooth(spark, sf_dir)))


def _events(spark, sf_dir):
    return events.group_frames(_smooth(spark, sf_dir), lengths=scoring.frame_lengths(views.score_recordings(spark, sf_dir)))


def _six_digits(runs: DataFrame) -> DataFrame:
    return runs.withColumn("confidence", events.to_digits("confidence", 6))


def _six(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query(f"""WITH {views.V_EVENTS}
  SELECT r.recording_id, count(event_id) AS n_events, coalesce(round(sum("end" - start), 4), 0) AS total_s, round(100 * coalesce(round(sum("end" - start), 4), 0) / duration_s, 4) AS percent
  FROM v_recordings r LEFT JOIN found USING (recording_id) GROUP BY r.recording_id, duration_s""")
def flagship_event_summary(spark, sf_dir):
    recs = views.score_recordings(spark, sf_dir)
    return events.event_summary(events.group_frames(_smooth(spark, sf_dir), lengths=scoring.frame_lengths(recs)), recs)


_PROBS = """
  probs AS (SELECT CAST(label AS VARCHAR) AS recording_id, vec_id AS window_id, 1.0::DOUBLE + 0.5::DOUBLE * vec_id AS center_s,
                   list_transform(embedding, lambda x: exp(x::DOUBLE - list_max(embedding)::DOUBLE)) AS e FROM embeddings),
  class_probs AS (SELECT recording_id, window_id, center_s, list_transform(e, lambda x: x / list_sum(e)) AS probs FROM probs)"""


def _probs(spark, sf_dir):
    return views.logits(spark, sf_dir).select("recording_id", "window_id", "center_s", scoring.softmax_probs("logits").alias("probs"))


@query(f"WITH {_PROBS} SELECT recording_id, window_id, unnest(range(64)) AS class_id, round(unnest(probs), 6) AS prob FROM class_probs")
def w3_softmax(spark, sf_dir):
    return _probs(spark, sf_dir).select("recording_id", "window_id", F.posexplode("probs").alias("class_id", "p")).select("recording_id", "window_id", F.col("class_id").cast("long").alias("class_id"), F.round("p", 6).alias("prob"))


_NAMED = "replace(replace(replace(p_name, 'ring', 'Snoring'), 'bolt', 'Wheezing'), 'gear', 'SNORT')"


def _named(spark, sf_dir):
    """Every part as a class, some of them with labels that the default keywords mark."""
    label = F.col("label")
    for a, b in (("ring", "Snoring"), ("bolt", "Wheezing"), ("gear", "SNORT")):
        label = F.replace(label, F.lit(a), F.lit(b))
    return views.labels(spark, sf_dir).withColumn("label", label)


@query(f"SELECT CAST(p_partkey AS INTEGER) AS class_id, {_NAMED} AS label FROM part WHERE contains(lower({_NAMED}), 'snor')")
def w4_label_lookup(spark, sf_dir):
    return scoring.find_label_indices(_named(spark, sf_dir), TARGET_KEYWORDS)


@query(f"""SELECT CAST(p_partkey AS INTEGER) AS class_id, 'snore' AS grp FROM part WHERE contains(lower({_NAMED}), 'snor')
  UNION ALL SELECT CAST(p_partkey AS INTEGER), 'breath' FROM part WHERE regexp_matches(lower({_NAMED}), 'breath|wheez|snort')""")
def w5_targets(spark, sf_dir):
    return scoring.resolve_targets(_named(spark, sf_dir))


@query("SELECT CAST(p_partkey AS INTEGER) AS class_id, p_name AS label FROM part WHERE contains(lower(p_name), 'ring')")
def w4_label_lookup_all(spark, sf_dir):
    return scoring.find_label_indices(views.labels(spark, sf_dir), TARGET)


@query("""SELECT CAST(p_partkey AS INTEGER) AS class_id, 'snore' AS grp FROM part WHERE contains(lower(p_name), 'ring')
  UNION ALL SELECT CAST(p_partkey AS INTEGER), 'breath' FROM part WHERE contains(lower(p_name), 'ring') OR contains(lower(p_name), 'bolt')""")
def w5_targets_all(spark, sf_dir):
    return scoring.resolve_targets(views.labels(spark, sf_dir), TARGET, BREATH)


@query(f"""WITH {_PROBS},
  s AS (SELECT list(p_partkey + 1) AS ids FROM part WHERE p_partkey < 64 AND contains(lower(p_name), 'ring')),
  b AS (SELECT list(p_partkey + 1) AS ids FROM part WHERE p_partkey < 64 AND (contains(lower(p_name), 'ring') OR contains(lower(p_name), 'bolt')))
  SELECT recording_id, window_id, center_s, round(least((2 * list_max(list_transform(s.ids, lambda i: probs[i])) + list_max(list_transform(b.ids, lambda i: probs[i]))) / 3, 1), 6) AS score FROM class_probs, s, b""")
def w6_window_score(spark, sf_dir):
    return _six(scoring.aggregate_score(_probs(spark, sf_dir), scoring.resolve_targets(views.class_labels(spark, sf_dir), TARGET, BREATH)), "score")


@query(ORACLES["w6_window_score"])
def w6_fused_score(spark, sf_dir):
    """The same by the pass that detection takes."""
    return _six(scoring.score_logits(views.logits(spark, sf_dir), scoring.groups_of(scoring.resolve_targets(views.class_labels(spark, sf_dir), TARGET, BREATH))), "score")


@query(f"WITH {views.V_SCORES} SELECT recording_id, round(max(score), 6) AS max_score, round(avg(score), 6) AS mean_score, count(*) FILTER (score > 0.3) AS n_over, count(*) AS n_windows FROM v_scores GROUP BY ALL")
def w7_window_stats(spark, sf_dir):
    return _six(scoring.window_stats(views.scores(spark, sf_dir)), "max_score", "mean_score")


@query(f"WITH {views.V_FRAMES} SELECT recording_id, frame_idx, t, round(prob, 6) AS prob FROM frames")
def w8_frames(spark, sf_dir):
    return _six(_frames(spark, sf_dir).drop("n_frames"), "prob")


@query(f"WITH {views.V_SMOOTH} SELECT recording_id, count(*) AS n_frames, round(max(prob), 6) AS max_prob, round(avg(prob), 6) AS mean_prob, count(*) FILTER (prob >= 0.3) AS n_on FROM smooth GROUP BY ALL")
def w9_trace_stats(spark, sf_dir):
    return _six(scoring.trace_stats(_smooth(spark, sf_dir), 0.3), "max_prob", "mean_prob")


@query(f"WITH {views.V_FRAMES}, {views._padded('frames', 'pad', 5, 4).strip()} SELECT recording_id, frame_idx, round(prob, 6) AS prob FROM pad")
def m2_reflect_pad(spark, sf_dir):
    return _six(smoothing.reflect_pad(_frames(spark, sf_dir), 5, 4).select("recording_id", "frame_idx", "prob"), "prob")


@query(f"WITH {views.V_FRAMES}, {views.median_sql('frames', 'med').strip()} SELECT recording_id, frame_idx, round(prob, 6) AS prob FROM med")
def m3_median_filter(spark, sf_dir):
    return _six(smoothing.median_filter(_frames(spark, sf_dir), 10), "prob")


@query(f"WITH {views.V_FRAMES}, {views.uniform_sql('frames', 'uni').strip()} SELECT recording_id, frame_idx, round(prob, 9) AS prob FROM uni")
def m4_uniform_filter(spark, sf_dir):
    return smoothing.uniform_filter(_frames(spark, sf_dir), 20).withColumn("prob", F.round("prob", 9))


@query(f"WITH {views.V_SMOOTH} SELECT * FROM smooth")
def m5_smooth(spark, sf_dir):
    return _smooth(spark, sf_dir)


@query(f"WITH {views.V_SMOOTH} SELECT recording_id, frame_idx, prob >= 0.30 AS is_on FROM smooth")
def e1_threshold_mask(spark, sf_dir):
    return events.threshold_mask(_smooth(spark, sf_dir)).select("recording_id", "frame_idx", "is_on")


@query(f'WITH {views.V_RUNS} SELECT recording_id, first_frame, last_frame, start, "end", {views.digits_sql("confidence", 6)} AS confidence FROM runs')
def e2_e3_runs(spark, sf_dir):
    return _six_digits(_runs(spark, sf_dir))


@query(f'WITH {views.V_MERGED} SELECT recording_id, first_frame, last_frame, start, "end", {views.digits_sql("confidence", 6)} AS confidence FROM merged')
def e4_merge_runs(spark, sf_dir):
    return _six_digits(events.merge_runs(_runs(spark, sf_dir)))


@query(f'WITH {views.V_EVENTS} SELECT recording_id, first_frame, last_frame, start, "end", {views.digits_sql("confidence", 6)} AS confidence FROM padded')
def e5_pad_events(spark, sf_dir):
    lengths = scoring.frame_lengths(views.score_recordings(spark, sf_dir))
    return _six_digits(events.pad_events(events.merge_runs(_runs(spark, sf_dir)), lengths))


@query(f"WITH {views.V_EVENTS} SELECT * FROM found")
def e6_e7_events(spark, sf_dir):
    return _events(spark, sf_dir)


@query(f"""WITH {views.V_EVENTS}
  SELECT recording_id, count(DISTINCT first_frame) FILTER (stage = 1) AS n_raw, count(DISTINCT first_frame) FILTER (stage = 2) AS n_merged, count(DISTINCT first_frame) FILTER (stage = 3) AS n_kept
  FROM v_recordings LEFT JOIN (SELECT 1 AS stage, recording_id, first_frame FROM runs UNION ALL SELECT 2, recording_id, first_frame FROM merged UNION ALL SELECT 3, recording_id, first_frame FROM kept) USING (recording_id) GROUP BY recording_id""")
def e8_event_counts(spark, sf_dir):
    return events.event_counts(_smooth(spark, sf_dir), lengths=scoring.frame_lengths(views.score_recordings(spark, sf_dir)))


@query(f"""WITH {views.V_EVENTS}
  SELECT recording_id, event_id, start, "end", confidence, round("end" - start, 4) AS length_s, greatest(0, n_all - 20) AS n_more
  FROM (SELECT *, row_number() OVER (PARTITION BY recording_id ORDER BY start) AS place, count(*) OVER (PARTITION BY recording_id) AS n_all FROM found) WHERE place <= 20""")
def e10_top_events(spark, sf_dir):
    return events.top_events(_events(spark, sf_dir))


def _summed(df: DataFrame) -> DataFrame:
    """Samples by their number, sum, first and last."""
    total = F.aggregate("samples", F.lit(0.0), lambda a, b: a + b.cast("double"))
    return df.withColumns({"n": F.size("samples"), "total": F.round(total, 6), "first": F.col("samples")[0].cast("double"), "last": F.element_at("samples", -1).cast("double")})


_SUMS = "CAST(count(*) AS INTEGER) AS n, round(sum(x), 6) AS total, arg_min(x, i)::DOUBLE AS first, arg_max(x, i)::DOUBLE AS last"
_KEYS = ("recording_id", "channel", "chunk_id", "n", "total", "first", "last")


@query(f"WITH {views.V_SIGNAL} SELECT recording_id, 1000 AS sample_rate, 2 AS n_channels, n_samples, duration_s FROM v_signal_recordings")
def s2_recordings(spark, sf_dir):
    return chunks.recordings(views.signal(spark, sf_dir, 2))


@query(f"WITH {views.V_SIGNAL}, m AS (SELECT recording_id, 0 AS channel, i // 512 AS chunk_id, i, (amp + CASE WHEN i % 2 = 1 THEN -amp / 2 ELSE amp / 2 END) / 2 AS x FROM v_samples) SELECT recording_id, channel, chunk_id, {_SUMS} FROM m GROUP BY ALL")
def c1_to_mono(spark, sf_dir):
    return _summed(chunks.to_mono(views.signal(spark, sf_dir, 2))).select(*_KEYS)


@query(f"WITH {views.V_SIGNAL}, m AS (SELECT recording_id, unnest([0, 1]) AS channel, i // 512 AS chunk_id, i, amp AS x FROM v_samples) SELECT recording_id, channel, chunk_id, {_SUMS} FROM m GROUP BY ALL")
def c2_to_stereo(spark, sf_dir):
    return _summed(chunks.to_stereo(views.signal(spark, sf_dir))).select(*_KEYS)


@query(f"""WITH {views.V_SIGNAL}, m AS (
    SELECT recording_id, 0 AS channel, c AS chunk_id, i, amp AS x FROM v_samples, LATERAL (SELECT unnest(range((i - 59) // 512 - 2, i // 512 + 2)) AS c)
    WHERE c >= 0 AND c <= (n_samples - 1) // 512 AND i >= c * 512 - 100 AND i < (c + 1) * 512 + 60)
  SELECT recording_id, channel, chunk_id, {_SUMS} FROM m GROUP BY ALL""")
def c4_halo(spark, sf_dir):
    return _summed(chunks.with_halo(views.signal(spark, sf_dir), 100, 60)).select(*_KEYS)


@query(f"WITH {views.V_SIGNAL}, m AS (SELECT recording_id, 0 AS channel, i // 512 AS chunk_id, i, amp AS x FROM v_samples) SELECT recording_id, channel, chunk_id, {_SUMS} FROM m GROUP BY ALL")
def c4_stitch(spark, sf_dir):
    return _summed(chunks.stitch(chunks.with_halo(views.signal(spark, sf_dir), 100, 60))).select(*_KEYS)


@query(f"""WITH {views.V_SIGNAL}, m AS (
    SELECT recording_id, k AS window_id, i, amp AS x FROM v_samples, LATERAL (SELECT unnest(range(i // 100 - 4, i // 100 + 1)) AS k) WHERE k >= 0 AND i >= k * 100 AND i < k * 100 + 400)
  SELECT recording_id, window_id, (window_id * 100 + 200) / 1000.0::DOUBLE AS center_s, 400 AS n, round(sum(x), 6) AS total, arg_min(x, i)::DOUBLE AS first,
         coalesce(max(x) FILTER (i = window_id * 100 + 399), 0)::DOUBLE AS last FROM m GROUP BY ALL""")
def w1_windows(spark, sf_dir):
    return _summed(windows.make_windows(views.signal(spark, sf_dir), 0.4, 0.1)).drop("samples")


def _ranges(spark, sf_dir):
    recs = chunks.recordings(views.signal(spark, sf_dir))
    return clips.event_samples(views.segments(recs), recs)


def _clips(spark, sf_dir):
    return clips.cut_clips(_ranges(spark, sf_dir).drop("n_samples"), views.signal(spark, sf_dir, 2), views.CHUNK_SAMPLES)


def _measured(spark, sf_dir):
    """Clips without their samples: what is exchanged are sums of squares."""
    return clips.measured_clips(_ranges(spark, sf_dir).drop("n_samples"), views.signal(spark, sf_dir, 2), views.CHUNK_SAMPLES)


_CUT = views.V_SEGMENTS + """,
  cut AS (
    SELECT r.recording_id, event_id, start, "end", confidence, s, e, round(sum(amp), 6) AS total, sum(amp * amp * 1.25::DOUBLE) AS squares, 2 * count(*) AS n_values, sqrt(sum(amp * amp * 1.25::DOUBLE) / (2 * count(*))) AS rms
    FROM v_ranges r JOIN v_samples v ON v.recording_id = r.recording_id AND v.i >= s AND v.i < e GROUP BY ALL)"""
#: A level that some clips of the view are below.
_QUIET = 0.2


@query(f'WITH {views.V_SEGMENTS} SELECT recording_id, CAST(event_id AS INTEGER) AS event_id, s AS start_sample, e AS end_sample FROM v_ranges')
def k1_event_samples(spark, sf_dir):
    return _ranges(spark, sf_dir).select("recording_id", "event_id", "start_sample", "end_sample")


@query(f"WITH {_CUT} SELECT recording_id, CAST(event_id AS INTEGER) AS event_id, s AS start_sample, e AS end_sample, total, n_values, 2 AS channels FROM cut")
def k2_cut_clips(spark, sf_dir):
    first = F.aggregate(F.col("samples")[0], F.lit(0.0), lambda a, b: a + b.cast("double"))
    return _clips(spark, sf_dir).select("recording_id", "event_id", "start_sample", "end_sample", F.round(first, 6).alias("total"), "n_values", F.size("samples").alias("channels"))


@query(f"WITH {_CUT} SELECT recording_id, CAST(event_id AS INTEGER) AS event_id, round(rms, 6) AS rms FROM cut WHERE rms >= {_QUIET}")
def k3_drop_silent(spark, sf_dir):
    return _six(clips.drop_silent(_measured(spark, sf_dir), _QUIET), "rms").select("recording_id", "event_id", "rms")


@query(f"""WITH {_CUT}
  SELECT recording_id, format('snore_{{:04d}}.wav', row_number() OVER (PARTITION BY recording_id ORDER BY event_id)) AS clip_file, round(start, 4) AS start_time, round("end", 4) AS end_time, round((e - s) / 1000.0::DOUBLE, 4) AS duration, confidence
  FROM cut WHERE rms >= {_QUIET}""")
def k4_k5_manifest(spark, sf_dir):
    return clips.manifest(clips.name_clips(clips.drop_silent(_measured(spark, sf_dir), _QUIET)))


#: Two seconds a chunk; the file's 16 bits end below one.
_READ_S, _TOP = 2, "32767 / 32768.0::DOUBLE"


def _folder(spark: SparkSession) -> str:
    return os.path.join(shared_dir(spark).removeprefix("file:"), f"wav-{uuid.uuid4().hex}")


#: Bytes of a file system's block; of files and folders that a query has on disk at a time, where they are more in all, and the most shares that they are dealt into.
_BLOCK, _SHARE, _SHARES = 4096, 512 << 20, 32


def _filed(spark: SparkSession, n_bytes: int, write: Callable[[str, Callable[[DataFrame], DataFrame]], None], read: Callable[[str], DataFrame]) -> DataFrame:
    """The rows of read(folder) for all files of write(folder, own), own taking its share of a table by recording: all are written and read back, those of a share are deleted when they are read."""
    shares = min(_SHARES, n_bytes // _SHARE + 1)
    rows = f"{shared_dir(spark)}/read-{uuid.uuid4().hex}"
    for k in range(shares):
        folder = _folder(spark)
        write(folder, lambda df, k=k: df.filter(F.pmod(F.xxhash64("recording_id"), F.lit(shares)) == k))
        part = read(folder)
        with released(spark):
            part.write.mode("append").parquet(rows)
        for path in (folder, _beside(folder)):
            shutil.rmtree(path, ignore_errors=True)
    return spark.read.schema(part.schema).parquet(rows)


def _beside(folder: str) -> str:
    return f"{folder}-pieces"


def _kept(pieces: DataFrame, folder: str) -> DataFrame:
    """The pieces stored beside the folder that their files go to, as long as these."""
    with released(pieces.sparkSession):
        pieces.write.parquet(_beside(folder))
    return pieces.sparkSession.read.schema(pieces.schema).parquet(_beside(folder))


def _bytes_of(spark, sf_dir, channels: int, folders: int, seconds: float | None = None) -> int:
    """What files of every recording, or of each `seconds` of it, take on disk in as many folders."""
    n = F.length("text")
    blocks = F.ceil((44 + 2 * channels * n) / _BLOCK) if seconds is None else F.ceil(n / (seconds * views.RATE))
    return (views.table(spark, sf_dir, "documents").filter(n > 0).agg(F.sum(blocks + folders)).first()[0] or 0) * _BLOCK


@query(f"WITH {views.V_SIGNAL} SELECT recording_id, i // {views.RATE * _READ_S} AS chunk_id, CAST(count(*) AS INTEGER) AS n, round(sum(least(amp, {_TOP})), 6) AS total FROM v_samples GROUP BY ALL")
def s1_s3_wav_files(spark, sf_dir):
    """Every recording as a file, and the files read back through their catalogue."""
    def write(folder, own):
        wav.write_wav(own(views.signal(spark, sf_dir)), folder, "")

    return _filed(spark, _bytes_of(spark, sf_dir, 1, 0), write, lambda folder: _summed(catalogue.read_chunks(catalogue.catalogue(spark, folder), _READ_S)).select("recording_id", "chunk_id", "n", "total"))


@query(f"""WITH {_CUT},
  named AS (SELECT recording_id, event_id, s, e, format('{{}}_snore_clips_snore_{{:04d}}', recording_id, row_number() OVER (PARTITION BY recording_id ORDER BY event_id)) AS clip FROM cut WHERE rms >= {_QUIET})
  SELECT clip, CAST(count(*) AS INTEGER) AS n, round(sum(least(amp, {_TOP})), 6) AS total, 2 AS channels FROM named c JOIN v_samples v ON v.recording_id = c.recording_id AND v.i >= s AND v.i < e GROUP BY ALL""")
def s4_clip_files(spark, sf_dir):
    """Every kept clip as a file, and the files read back."""
    ranges = _ranges(spark, sf_dir).drop("n_samples")

    def write(folder, own):
        pieces = _kept(clips.packed_pieces(own(ranges), own(views.signal(spark, sf_dir, 2)), views.CHUNK_SAMPLES), folder)
        wav.write_pieces(clips.name_clips(clips.drop_silent(clips.clips_of(pieces), _QUIET)), pieces, folder)

    def read(folder):
        found = catalogue.catalogue(spark, folder)
        first = _summed(catalogue.read_chunks(found, _READ_S).filter("channel = 0")).select("recording_id", "n", "total")
        return first.join(found.select("recording_id", F.col("n_channels").alias("channels")), "recording_id").withColumnRenamed("recording_id", "clip")

    return _filed(spark, _bytes_of(spark, sf_dir, 2, 2, 0.3), write, read)


def _nights(spark, sf_dir, cut=clips.cut_pieces, own=lambda df: df):
    """One event over every whole recording, in pieces of a chunk."""
    recs = own(chunks.recordings(views.signal(spark, sf_dir)))
    whole = recs.select("recording_id", F.lit(1).alias("event_id"), F.lit(0.0).alias("start"), F.col("duration_s").alias("end"), F.lit(0.5).alias("confidence"))
    return cut(clips.event_samples(whole, recs).drop("n_samples"), own(views.signal(spark, sf_dir, 2)), views.CHUNK_SAMPLES)


@query(f"WITH {views.V_SIGNAL} SELECT recording_id, i // {views.CHUNK_SAMPLES} * {views.CHUNK_SAMPLES} AS at, 2 AS channels, CAST(count(*) AS INTEGER) AS n, round(sum(amp), 6) AS total, round(sum(amp * amp * 1.25::DOUBLE), 6) AS squares FROM v_samples GROUP BY recording_id, i // {views.CHUNK_SAMPLES}")
def k2_long_pieces(spark, sf_dir):
    """Events as long as their recordings, a row a chunk."""
    first = F.aggregate(F.col("samples")[0], F.lit(0.0), lambda a, b: a + b.cast("double"))
    return _nights(spark, sf_dir).select("recording_id", "at", F.size("samples").alias("channels"), F.size(F.col("samples")[0]).alias("n"), F.round(first, 6).alias("total"), F.round("sum_squares", 6).alias("squares"))


@query(f"""WITH {views.V_SIGNAL}, named AS (SELECT recording_id, format('{{}}_snore_clips_snore_0001', recording_id) AS clip, i // {views.RATE * _READ_S} AS chunk_id, amp FROM v_samples)
  SELECT clip, chunk_id, CAST(count(*) AS INTEGER) AS n, round(sum(least(amp, {_TOP})), 6) AS total FROM named GROUP BY ALL""")
def s4_long_clip_files(spark, sf_dir):
    """Those events as files, streamed piece by piece, and the files read back."""
    def write(folder, own):
        pieces = _kept(_nights(spark, sf_dir, clips.packed_pieces, own), folder)
        wav.write_pieces(clips.name_clips(clips.clips_of(pieces)), pieces, folder)

    def read(folder):
        found = catalogue.read_chunks(catalogue.catalogue(spark, folder), _READ_S).filter("channel = 0")
        return _summed(found).select(F.col("recording_id").alias("clip"), "chunk_id", "n", "total")

    return _filed(spark, _bytes_of(spark, sf_dir, 2, 2), write, read)


@query(ORACLES["k4_k5_manifest"])
def s5_manifest_csv(spark, sf_dir):
    """The manifest written as CSV and read back."""
    made = k4_k5_manifest(spark, sf_dir)
    path = f"{shared_dir(spark)}/manifest-{uuid.uuid4().hex}"
    tables.write_manifest(made, path)
    return spark.read.schema(made.select("recording_id", *tables.COLUMNS).schema).option("header", True).csv(path)


@query(f"WITH {_CUT} SELECT recording_id, count(*) FILTER (rms >= {_QUIET}) AS n_saved, count(*) FILTER (rms < {_QUIET}) AS n_silent, round(coalesce(sum((e - s) / 1000.0::DOUBLE) FILTER (rms >= {_QUIET}), 0), 4) AS saved_s FROM cut GROUP BY ALL")
def k6_cut_stats(spark, sf_dir):
    return clips.cut_stats(_measured(spark, sf_dir), _QUIET)


# --- features of frames of 64 samples at 1000 Hz -------------------------------------------------------------------

_BANDS, _KEEP, _HZ = 12, 6, views.RATE / 64
_MAGS = views.V_EMBEDDED + """,
  points AS (SELECT recording_id, frame_idx, unnest(x)::DOUBLE AS x, unnest(range(64)) AS i FROM v_frames),
  mags AS (
    SELECT recording_id, frame_idx, k, sqrt(pow(sum(x * (0.5 - 0.5 * cos(2 * pi() * i / 64)) * cos(2 * pi() * i * k / 64)), 2) + pow(sum(x * (0.5 - 0.5 * cos(2 * pi() * i / 64)) * sin(2 * pi() * i * k / 64)), 2)) AS m
    FROM points, (SELECT unnest(range(33)) AS k) GROUP BY ALL)"""
#: Below 1000 Hz the mel scale is linear, so the edges of the bands from 20 to 500 Hz are evenly spaced.
_MEL = _MAGS + f""",
  bank AS (SELECT b, k, greatest(0, least((k * {_HZ} - lo) / w, (lo + 2 * w - k * {_HZ}) / w)) / w AS f
           FROM (SELECT unnest(range({_BANDS})) AS b), (SELECT unnest(range(33)) AS k), LATERAL (SELECT 480.0::DOUBLE / {_BANDS + 1} AS w, 20 + 480.0::DOUBLE / {_BANDS + 1} * b AS lo)),
  mel AS (SELECT recording_id, frame_idx, b, sum(m * m * f) AS p FROM mags JOIN bank USING (k) GROUP BY ALL)"""
_DB = _MEL + """,
  tops AS (SELECT recording_id, max(p) AS top FROM mel GROUP BY ALL),
  dbs AS (SELECT recording_id, frame_idx, b, greatest(10 * log10(greatest(p, 1e-10)), 10 * log10(top) - 80) AS db1, greatest(10 * log10(greatest(p, 1e-10) / top), -80) AS dbm FROM mel JOIN tops USING (recording_id))"""
_MFCC = _DB + f""",
  mfcc AS (
    SELECT recording_id, frame_idx, c, sum(db1 * cos(pi() * c * (2 * b + 1) / {2 * _BANDS}) * sqrt(2.0::DOUBLE / {_BANDS}) * CASE WHEN c = 0 THEN 1 / sqrt(2.0::DOUBLE) ELSE 1 END) AS v
    FROM dbs, (SELECT unnest(range({_KEEP})) AS c) GROUP BY ALL)"""


def _mags(spark, sf_dir):
    return features.magnitude_spectrum(views.frames(spark, sf_dir)).select("recording_id", "frame_idx", "magnitude")


def _mel(spark, sf_dir):
    return features.mel_power(_mags(spark, sf_dir), views.RATE, 64, _BANDS)


def _mfcc(spark, sf_dir):
    return features.mfcc(features.power_to_db(_mel(spark, sf_dir), "mel", "mel_db", 1.0), "mel_db", _KEEP).select("recording_id", "frame_idx", "mfcc")


def _rows(df: DataFrame, column: str, at: str, value: str, digits: int = 5) -> DataFrame:
    return df.select("recording_id", "frame_idx", F.posexplode(column).alias(at, value)).withColumns({at: F.col(at).cast("long"), value: F.round(value, digits)})


@query("""SELECT DISTINCT r AS sample_rate, r * 25 // 1000 AS frame, r * 10 // 1000 AS hop, greatest(CAST(pow(2, ceil(round(log2(r * 50 // 1000), 9))) AS INTEGER), r * 25 // 1000) AS n_fft
  FROM (SELECT CAST(8000 + 441 * p_size AS INTEGER) AS r FROM part)""")
def f1_frame_params(spark, sf_dir):
    rates = views.table(spark, sf_dir, "part").select((8000 + 441 * F.col("p_size")).cast("int").alias("sample_rate")).distinct()
    return rates.select("sample_rate", *(c.alias(n) for c, n in zip(features.frame_params(), ("frame", "hop", "n_fft"))))


@query(f"WITH {_MAGS} SELECT recording_id, frame_idx, k, round(m, 5) AS m FROM mags")
def f2_spectrum(spark, sf_dir):
    return _rows(_mags(spark, sf_dir), "magnitude", "k", "m")


@query(f"WITH {_MEL} SELECT recording_id, frame_idx, b, round(p, 6) AS p FROM mel")
def f3_mel_power(spark, sf_dir):
    return _rows(_mel(spark, sf_dir), "mel", "b", "p", 6)


@query(f"WITH {_DB} SELECT recording_id, frame_idx, b, round(dbm, 5) AS db FROM dbs")
def f4_power_to_db(spark, sf_dir):
    return _rows(features.power_to_db(_mel(spark, sf_dir), "mel", "log_mel", "max"), "log_mel", "b", "db")


@query(f"WITH {_MFCC} SELECT recording_id, frame_idx, c, round(v, 5) AS v FROM mfcc")
def f5_mfcc(spark, sf_dir):
    return _rows(_mfcc(spark, sf_dir), "mfcc", "c", "v")


_SLOPES = _MFCC + """,
  sized AS (SELECT *, max(frame_idx) OVER (PARTITION BY recording_id) AS top FROM mfcc),
  slopes AS (
    SELECT s.recording_id, s.frame_idx, s.c, sum((n.frame_idx - least(greatest(s.frame_idx, 4), s.top - 4)) / 60.0::DOUBLE * n.v) AS d1,
           sum(([28, 7, -8, -17, -20, -17, -8, 7, 28])[n.frame_idx - least(greatest(s.frame_idx, 4), s.top - 4) + 5] / 462.0::DOUBLE * n.v) AS d2
    FROM sized s JOIN mfcc n ON n.recording_id = s.recording_id AND n.c = s.c AND abs(n.frame_idx - least(greatest(s.frame_idx, 4), s.top - 4)) <= 4 GROUP BY ALL)"""


@query(f"WITH {_SLOPES} SELECT recording_id, frame_idx, c, round(d1, 5) AS d1, round(d2, 5) AS d2 FROM slopes")
def f6_deltas(spark, sf_dir):
    both = features.slopes(_mfcc(spark, sf_dir), "mfcc", {"d1": 1, "d2": 2})
    rows = both.select("recording_id", "frame_idx", F.posexplode(F.arrays_zip("d1", "d2")).alias("c", "x"))
    return rows.select("recording_id", "frame_idx", F.col("c").cast("long").alias("c"), F.round("x.d1", 5).alias("d1"), F.round("x.d2", 5).alias("d2"))


@query(f"WITH {_MAGS} SELECT recording_id, frame_idx, round(coalesce(sum(m * k * {_HZ}) / nullif(sum(m), 0), 0), 5) AS centroid FROM mags GROUP BY ALL")
def f7_centroid(spark, sf_dir):
    return _mags(spark, sf_dir).select("recording_id", "frame_idx", F.round(features.spectral_centroid("magnitude", F.lit(_HZ)), 5).alias("centroid"))


@query(f"""WITH {_MAGS}, sums AS (SELECT *, sum(m) OVER (PARTITION BY recording_id, frame_idx ORDER BY k) AS run, sum(m) OVER (PARTITION BY recording_id, frame_idx) AS total FROM mags)
  SELECT recording_id, frame_idx, coalesce(min(k * {_HZ}) FILTER (run >= 0.85 * total AND total > 0), 0)::DOUBLE AS rolloff FROM sums GROUP BY ALL""")
def f8_rolloff(spark, sf_dir):
    return _mags(spark, sf_dir).select("recording_id", "frame_idx", features.spectral_rolloff("magnitude", F.lit(_HZ)).alias("rolloff"))


@query(f"WITH {views.V_EMBEDDED} SELECT recording_id, frame_idx, list_sum(list_transform(range(2, 65), lambda i: CAST((x[i] < -1e-10) <> (x[i - 1] < -1e-10) AS INTEGER))) / 64.0::DOUBLE AS zcr FROM v_frames")
def f9_zero_crossings(spark, sf_dir):
    return views.frames(spark, sf_dir).select("recording_id", "frame_idx", features.zero_crossing_rate().alias("zcr"))


@query(f"WITH {views.V_EMBEDDED} SELECT recording_id, frame_idx, round(sqrt(list_sum(list_transform(x, lambda v: v::DOUBLE * v::DOUBLE)) / 64), 6) AS rms FROM v_frames")
def f10_frame_rms(spark, sf_dir):
    return views.frames(spark, sf_dir).select("recording_id", "frame_idx", F.round(features.frame_rms(), 6).alias("rms"))


@query(f"WITH {_MFCC}, m AS (SELECT recording_id, frame_idx, v FROM mfcc WHERE c = 0 QUALIFY frame_idx < max(frame_idx) OVER (PARTITION BY recording_id)) SELECT recording_id, frame_idx, round(v, 5) AS c0, frame_idx * 10 / 1000.0::DOUBLE AS time FROM m JOIN v_frames USING (recording_id, frame_idx)")
def f13_align(spark, sf_dir):
    """A feature of odd frames has one frame fewer than another: a recording's last frame has no partner."""
    cepstra = _mfcc(spark, sf_dir)
    fewer = cepstra.join(cepstra.groupBy("recording_id").agg(F.max("frame_idx").alias("last")), "recording_id").filter("frame_idx < last").drop("last")
    both = features.align_frames(fewer, views.frames(spark, sf_dir))
    return both.select("recording_id", "frame_idx", F.round(F.col("mfcc")[0], 5).alias("c0"), (F.col("frame_idx") * 10 / 1000.0).alias("time"))


def _stacked(spark, sf_dir):
    base = _mfcc(spark, sf_dir)
    mags = _mags(spark, sf_dir).select("recording_id", "frame_idx", features.spectral_centroid("magnitude", F.lit(_HZ)).alias("spectral_centroid"), features.spectral_rolloff("magnitude", F.lit(_HZ)).alias("spectral_rolloff"))
    rest = views.frames(spark, sf_dir).select("recording_id", "frame_idx", features.zero_crossing_rate().alias("zcr"), F.lit(0.0).alias("hnr"))
    log_mel = features.power_to_db(_mel(spark, sf_dir), "mel", "log_mel", "max").select("recording_id", "frame_idx", "log_mel")
    return features.stack_features(features.align_frames(base, mags, rest, log_mel)).select("recording_id", "frame_idx", "features")


_STACK = _MFCC + f""",
  stacked AS (
    SELECT recording_id, frame_idx, c AS d, v FROM mfcc
    UNION ALL SELECT recording_id, frame_idx, {_KEEP}, coalesce(sum(m * k * {_HZ}) / nullif(sum(m), 0), 0) FROM mags GROUP BY ALL
    UNION ALL SELECT recording_id, frame_idx, {_KEEP + 1}, coalesce(min(k * {_HZ}) FILTER (run >= 0.85 * total AND total > 0), 0) FROM (SELECT *, sum(m) OVER (PARTITION BY recording_id, frame_idx ORDER BY k) AS run, sum(m) OVER (PARTITION BY recording_id, frame_idx) AS total FROM mags) GROUP BY ALL
    UNION ALL SELECT recording_id, frame_idx, {_KEEP + 2}, list_sum(list_transform(range(2, 65), lambda i: CAST((x[i] < -1e-10) <> (x[i - 1] < -1e-10) AS INTEGER))) / 64.0::DOUBLE FROM v_frames
    UNION ALL SELECT recording_id, frame_idx, {_KEEP + 3}, 0 FROM v_frames
    UNION ALL SELECT recording_id, frame_idx, {_KEEP + 4} + b, dbm FROM dbs)"""


@query(f"WITH {_STACK} SELECT recording_id, frame_idx, d, round(CAST(v AS FLOAT)::DOUBLE, 3) AS v FROM stacked")
def f14_stack(spark, sf_dir):
    rows = _stacked(spark, sf_dir).select("recording_id", "frame_idx", F.posexplode("features").alias("d", "v"))
    return rows.select("recording_id", "frame_idx", F.col("d").cast("long").alias("d"), F.round(F.col("v").cast("double"), 3).alias("v"))


@query(f"""WITH {_MFCC}, moments AS (SELECT recording_id, c, avg(v) AS mean, stddev_pop(v) AS std FROM mfcc GROUP BY ALL)
  SELECT recording_id, frame_idx, c, round(CAST((v - mean) / (std + 1e-8) AS FLOAT)::DOUBLE, 4) AS z FROM mfcc JOIN moments USING (recording_id, c)""")
def f15_normalize(spark, sf_dir):
    return _rows(features.normalize_features(_mfcc(spark, sf_dir), "mfcc", "z").withColumn("z", F.col("z").cast("array<double>")), "z", "c", "z", 4)


# --- kernels: resampling, gates, overlap-add, scoring ---------------------------------------------------------------

_LONG = 16_384  # samples a chunk where a kernel's halo needs long ones


def _whole(spark, sf_dir):
    return views.signal(spark, sf_dir, size=_LONG)


def _bank_sql(rate: int, target: int, zeros: int = 16) -> str:
    """The taps of each phase: sincs of the lower rate under a raised cosine, of sum one."""
    cut, reach = min(1.0, target / rate), int(np.ceil(zeros * max(1.0, rate / target))) + 1
    return f"""
  offsets AS (SELECT p, o, o - (p * {rate} % {target}) / {target}.0::DOUBLE AS d FROM (SELECT unnest(range({target})) AS p), (SELECT unnest(range(-{reach}, {reach} + 1)) AS o)),
  raw AS (SELECT p, o, CASE WHEN d = 0 THEN 1.0::DOUBLE ELSE sin(pi() * {cut!r}::DOUBLE * d) / (pi() * {cut!r}::DOUBLE * d) END * CASE WHEN abs(d) < {zeros / cut!r}::DOUBLE THEN 0.5::DOUBLE + 0.5::DOUBLE * cos(pi() * d / {zeros / cut!r}::DOUBLE) ELSE 0 END AS tap FROM offsets),
  bank AS (SELECT p, list(tap / total ORDER BY o) AS taps FROM raw JOIN (SELECT p, sum(tap) AS total FROM raw GROUP BY p) USING (p) GROUP BY p),
  held AS (SELECT recording_id, n_samples, list_concat(list_concat(list_transform(range({reach}), lambda z: 0.0::DOUBLE), list(amp ORDER BY i)), list_transform(range({reach + 1}), lambda z: 0.0::DOUBLE)) AS x FROM v_samples GROUP BY ALL),
  outputs AS (
    SELECT recording_id, n * {rate} // {target} // {_LONG} AS chunk_id, n, list_dot_product(x[n * {rate} // {target} + 1:n * {rate} // {target} + {2 * reach + 1}], taps) AS y
    FROM (SELECT recording_id, x, unnest(range((n_samples * {target} + {rate - 1}) // {rate})) AS n FROM held) JOIN bank ON p = n % {target})"""


@query(f"WITH {views.V_SIGNAL}, {_bank_sql(1000, 441).strip()} SELECT recording_id, chunk_id, CAST(count(*) AS INTEGER) AS n, round(sum(y), 2) + 0.0::DOUBLE AS total, round(sum(y * (n % 5 - 2)), 2) + 0.0::DOUBLE AS turned FROM outputs GROUP BY ALL")
def c3_resample(spark, sf_dir):
    """Sums of the outputs of each chunk, plain and with alternating weights, beside their number."""
    y = F.transform("samples", lambda v: v.cast("double"))
    turned = F.aggregate(F.transform(y, lambda v, i: v * ((F.col("start_sample") + i) % 5 - 2)), F.lit(0.0), lambda a, v: a + v)
    out = chunks.resample(_whole(spark, sf_dir), 441)
    return out.select("recording_id", "chunk_id", F.size("samples").alias("n"), (F.round(F.aggregate(y, F.lit(0.0), lambda a, v: a + v), 2) + 0.0).alias("total"), (F.round(turned, 2) + 0.0).alias("turned"))


_FLOOR = _MAGS + """,
  floors AS (SELECT recording_id, k AS bin, avg(20 * log10(greatest(m, 1e-10))) + 1.5 * stddev_pop(20 * log10(greatest(m, 1e-10))) AS floor_db FROM mags WHERE frame_idx < 10 GROUP BY ALL)"""


@query(f"WITH {_FLOOR} SELECT recording_id, bin, round(floor_db, 5) AS floor_db FROM floors")
def c5_noise_floor(spark, sf_dir):
    return denoise.floor_of(denoise.first_frames(_mags(spark, sf_dir), 10), ("recording_id",)).withColumns({"bin": F.col("bin").cast("long"), "floor_db": F.round("floor_db", 5)})


_SIZES = f"WITH {views.V_SIGNAL}, c AS (SELECT recording_id, unnest(range((n_samples - 1) // {_LONG} + 1)) AS chunk_id, n_samples FROM v_signal_recordings) SELECT recording_id, 0 AS channel, chunk_id, CAST(least({_LONG}, n_samples - chunk_id * {_LONG}) AS INTEGER) AS n FROM c"


def _sizes(df):
    return df.select("recording_id", "channel", "chunk_id", F.size("samples").alias("n"))


@query(_SIZES.replace(" AS n FROM c", " AS n, true AS between FROM c"))
def c6_spectral_gate(spark, sf_dir):
    """Every chunk with its length, and whether what a gate takes away grows in proportion to prop_decrease, as it must: gated = x - 0.8 * (x - fully gated)."""
    both = denoise.compare_gates(_whole(spark, sf_dir), {"part": 0.8, "full": 1.0})
    far = F.transform(F.arrays_zip("samples", "part", "full"), lambda v: F.abs(v["part"] - (v["samples"] - 0.8 * (v["samples"] - v["full"]))) > 1e-4)
    return both.select("recording_id", "channel", "chunk_id", F.size("part").alias("n"), (~F.exists(far, lambda v: F.coalesce(v, F.lit(True)))).alias("between"))


@query(f"WITH {views.V_SIGNAL} SELECT recording_id, i // {views.CHUNK_SAMPLES} AS chunk_id, CAST(count(*) AS INTEGER) AS n, round(sum(amp), 3) AS total FROM v_samples GROUP BY ALL")
def c7_overlap_identity(spark, sf_dir):
    out = _summed(chunks.overlap_apply(views.signal(spark, sf_dir), lambda x, r: x, 0.4, 0.25))
    return out.select("recording_id", "chunk_id", "n", F.round("total", 3).alias("total"))


def _halved_or_fails(x: np.ndarray, row: dict) -> np.ndarray:
    """A stand-in for a user's model: it fails on recordings whose number ends in 7."""
    if row["recording_id"].endswith("7"):
        raise RuntimeError("no result")
    return x / 2


@query(f"WITH {views.V_SIGNAL} SELECT recording_id, 0 AS channel, i // {_LONG} AS chunk_id, CAST(count(*) AS INTEGER) AS n, CASE WHEN recording_id NOT LIKE '%7' THEN round(sum(amp) / 2, 3) END AS total FROM v_samples GROUP BY recording_id, i // {_LONG}")
def c8_denoise_fallback(spark, sf_dir):
    """Chunks and their sums as the kernel gives them; what the gate gives where it failed has no sum in SQL."""
    out = _summed(denoise.denoise(_whole(spark, sf_dir), "model", _halved_or_fails))
    return out.select("recording_id", "channel", "chunk_id", "n", F.when(~F.col("recording_id").endswith("7"), F.round("total", 3)).alias("total"))


def _sum_and_power(x: np.ndarray) -> np.ndarray:
    """Logits of two classes: the sum of a window and the sum of its squares."""
    x = x.astype(np.float64)
    return np.stack([x.sum(axis=1), (x**2).sum(axis=1)], axis=1)


@query(f"""WITH {views.V_SIGNAL}, m AS (
    SELECT recording_id, k AS window_id, amp AS x FROM v_samples, LATERAL (SELECT unnest(range(i // 100 - 4, i // 100 + 1)) AS k) WHERE k >= 0 AND i >= k * 100 AND i < k * 100 + 400)
  SELECT recording_id, window_id, (window_id * 100 + 200) / 1000.0::DOUBLE AS center_s, round(sum(x), 5) AS total, round(sum(x * x), 5) AS power FROM m GROUP BY ALL""")
def w2_score_windows(spark, sf_dir):
    out = windows.score_windows(windows.make_windows(views.signal(spark, sf_dir), 0.4, 0.1), _sum_and_power)
    return out.select("recording_id", "window_id", "center_s", F.round(F.col("logits")[0], 5).alias("total"), F.round(F.col("logits")[1], 5).alias("power"))


def _stretch_levels(x: np.ndarray) -> np.ndarray:
    """A stand-in for a model with 64 classes: the mean magnitude in as many stretches of a window of 400 samples."""
    sizes = np.array([len(p) for p in np.array_split(np.arange(x.shape[1]), 64)])
    return 20 * np.add.reduceat(np.abs(x.astype(np.float64)), np.cumsum(sizes) - sizes, axis=1) / sizes


#: Windows of 0.4 s each 0.1 s; the first 16 stretches have seven samples, the others six. Recordings may be shorter than a filter, so mirrors are folded.
_DETECT = views.V_SIGNAL + f""",
  levels AS (
    SELECT recording_id, k AS window_id, CASE WHEN j < 112 THEN j // 7 ELSE 16 + (j - 112) // 6 END AS class_id, 20 * sum(abs(amp)) / CASE WHEN j < 112 THEN 7 ELSE 6 END AS logit
    FROM (SELECT recording_id, k, i - k * 100 AS j, amp FROM v_samples, LATERAL (SELECT unnest(range(greatest(0, i // 100 - 3), i // 100 + 1)) AS k)) GROUP BY recording_id, k, class_id, j < 112),
  every AS (
    SELECT recording_id, k AS window_id, c AS class_id FROM v_signal_recordings, LATERAL (SELECT unnest(range((n_samples + 99) // 100)) AS k), (SELECT unnest(range(64)) AS c)),
  weights AS (SELECT recording_id, window_id, class_id, exp(coalesce(logit, 0) - max(coalesce(logit, 0)) OVER (PARTITION BY recording_id, window_id)) AS e FROM every LEFT JOIN levels USING (recording_id, window_id, class_id)),
  class_probs AS (SELECT recording_id, window_id, class_id, e / sum(e) OVER (PARTITION BY recording_id, window_id) AS p FROM weights),
  v_scores AS (
    SELECT recording_id, window_id, (window_id * 100 + 200) / 1000.0::DOUBLE AS center_s,
           least((2 * max(p) FILTER (contains(lower(p_name), 'ring')) + max(p) FILTER (contains(lower(p_name), 'ring') OR contains(lower(p_name), 'bolt'))) / 3, 1) AS score
    FROM class_probs JOIN part ON p_partkey = class_id GROUP BY ALL),
  v_recordings AS (SELECT recording_id, n_samples, duration_s FROM v_signal_recordings)""" + (
    views.V_FRAMES.removeprefix(views.V_SCORES).replace("(n_samples * 1000 + 159999) // 160000", "(n_samples * 1000 + 9999) // 10000")
    + "," + views.median_sql("frames", "med", views.folded) + "," + views.uniform_sql("med", "uni", views.folded)
    + views.V_EVENTS.removeprefix(views.V_SMOOTH.split(",\n  smooth AS", 1)[0]).replace("prob >= 0.30", "prob >= 0.02"))


@query(f"WITH {_DETECT} SELECT * FROM found")
def e11_detect_segments(spark, sf_dir):
    from nightwave.config import Config

    cfg = Config(window_s=0.4, stride_s=0.1, model_rate=views.RATE, threshold=0.02)
    return pipeline.detect_segments(views.signal(spark, sf_dir), _stretch_levels, views.class_labels(spark, sf_dir), cfg, TARGET, BREATH)


#: Frames of 25 samples each 10, windowed in the middle of 64; bands of 128 between 20 and 500 Hz, evenly spaced below 1000 Hz.
_WIDE = 480.0 / 129
_WHOLE_FRAMES = views.V_SIGNAL + f""",
  waves AS (
    SELECT k, list_transform(range(25), lambda i: (0.5 - 0.5 * cos(2 * pi() * i / 25)) * cos(2 * pi() * i * k / 64)) AS re, list_transform(range(25), lambda i: (0.5 - 0.5 * cos(2 * pi() * i / 25)) * sin(2 * pi() * i * k / 64)) AS im FROM range(33) r(k)),
  shapes AS (SELECT list_transform(range(128), lambda b: list_transform(range(33), lambda k: greatest(0, least((k * {_HZ} - 20) / {_WIDE} - b, b + 2 - (k * {_HZ} - 20) / {_WIDE})) / {_WIDE})) AS bank, list(re ORDER BY k) AS res, list(im ORDER BY k) AS ims FROM waves),
  cut_frames AS (
    SELECT CAST(doc_id AS VARCHAR) AS recording_id, f AS frame_idx, f * 10 AS c, length(text) AS n,
           list_transform(string_split(substring(text, greatest(0, f * 10 - 13) + 1, least(length(text), f * 10 + 12) - greatest(0, f * 10 - 13)), ''), lambda ch: (unicode(ch) - 96) / 128.0::DOUBLE) AS own,
           list_transform(string_split(substring(text, greatest(0, f * 10 - 12) + 1, least(length(text), f * 10 + 13) - greatest(0, f * 10 - 12)), ''), lambda ch: (unicode(ch) - 96) / 128.0::DOUBLE < -1e-10) AS below
    FROM documents, LATERAL (SELECT unnest(range((length(text) - 1) // 10 + 1)) AS f) WHERE length(text) > 0),
  framed AS (SELECT *, list_concat(list_transform(range(greatest(0, 13 - c)), lambda i: 0.0::DOUBLE), own, list_transform(range(greatest(0, c + 12 - n)), lambda i: 0.0::DOUBLE)) AS x FROM cut_frames),
  whole_mags AS (
    SELECT f.*, list_transform(range(1, 34), lambda k: sqrt(pow(list_dot_product(x, res[k]), 2) + pow(list_dot_product(x, ims[k]), 2))) AS m, bank FROM framed f, shapes),
  whole AS (
    SELECT recording_id, frame_idx, m, list_sum(m) AS total, list_dot_product(m, list_transform(range(33), lambda k: k * {_HZ}::DOUBLE)) AS weighted,
           list_transform(range(1, 129), lambda b: list_dot_product(list_transform(m, lambda v: v * v), bank[b])) AS mel,
           coalesce(list_sum(list_transform(range(2, len(below) + 1), lambda i: CAST(below[i] <> below[i - 1] AS INTEGER))), 0) / 25.0::DOUBLE AS zcr FROM whole_mags)"""


@query(f"""WITH {_WHOLE_FRAMES},
  tops AS (SELECT recording_id, greatest(max(list_max(mel)), 1e-10) AS top, max(frame_idx) AS last FROM whole GROUP BY ALL),
  levels AS (
    SELECT w.*, last, list_sum(list_transform(mel, lambda p: greatest(10 * log10(greatest(p, 1e-10)), 10 * log10(top) - 80))) / sqrt(128.0::DOUBLE) AS c0, greatest(10 * log10(greatest(list_max(mel), 1e-10) / top), -80) AS loud,
           greatest(10 * log10(greatest(list_min(mel), 1e-10) / top), -80) AS soft FROM whole w JOIN tops USING (recording_id)),
  ramps AS (SELECT s.recording_id, s.frame_idx, sum((o.frame_idx - s.frame_idx) / 60.0::DOUBLE * o.c0) AS d1 FROM levels s JOIN levels o ON o.recording_id = s.recording_id AND o.frame_idx BETWEEN s.frame_idx - 4 AND s.frame_idx + 4 WHERE s.frame_idx BETWEEN 4 AND s.last - 4 GROUP BY ALL)
  SELECT l.recording_id, l.frame_idx, l.frame_idx * 10 / 1000.0::DOUBLE AS time, round(coalesce(weighted / nullif(total, 0), 0), 5) AS centroid, zcr, round(CAST(c0 AS FLOAT)::DOUBLE, 2) AS c0, round(CAST(d1 AS FLOAT)::DOUBLE, 2) AS d1, round(CAST(loud AS FLOAT)::DOUBLE, 2) AS loud, round(CAST(soft AS FLOAT)::DOUBLE, 2) AS soft
  FROM levels l LEFT JOIN ramps r ON r.recording_id = l.recording_id AND r.frame_idx = least(greatest(l.frame_idx, 4), l.last - 4)""")
def f16_features(spark, sf_dir):
    """Every recording through the whole of feature extraction, without the harmonic part: a value of each kind."""
    out = features.extract_features(_whole(spark, sf_dir), compute_hnr=False)
    two = lambda c: F.round(c.cast("double"), 2)
    return out.select("recording_id", "frame_idx", "time", F.round("spectral_centroid", 5).alias("centroid"), "zcr",
                      two(F.col("features")[0]).alias("c0"), two(F.col("features")[40]).alias("d1"), two(F.array_max("log_mel")).alias("loud"), two(F.array_min("log_mel")).alias("soft"))


@query(f"""WITH {_MAGS}, levels AS (SELECT recording_id, frame_idx, round(sqrt(list_sum(list_transform(x, lambda v: v::DOUBLE * v::DOUBLE)) / 64), 6) AS rms FROM v_frames)
  SELECT recording_id, frame_idx, {views.RATE} AS sample_rate, 10 AS hop_length, round(coalesce(sum(m * k * {_HZ}) / nullif(sum(m), 0), 0), 5) AS centroid, rms FROM mags JOIN levels USING (recording_id, frame_idx) GROUP BY ALL""")
def s6_feature_tables(spark, sf_dir):
    """Two features as tables of as many buckets, read back and joined where they lie."""
    recs = views.frames(spark, sf_dir).select("recording_id", F.lit(views.RATE).alias("sample_rate")).distinct()
    made = {"centroid": f7_centroid(spark, sf_dir), "rms": f10_frame_rms(spark, sf_dir)}
    base, other = (tables.write_features(df, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", recs, buckets=8) for name, df in made.items())
    return features.align_frames(base, other.select("recording_id", "frame_idx", "rms"))


#: What detection finds in the view's files: 16 bits end below one, and the classes of both groups have labels that the default keywords mark.
_FILED = _DETECT.replace("(unicode(ch) - 96) / 128.0::DOUBLE AS amp", f"least((unicode(ch) - 96) / 128.0::DOUBLE, {_TOP}) AS amp", 1)


@query(f"""WITH {_FILED},
  ranged AS (SELECT *, greatest(s + 1, least(CAST(round_even("end" * 1000, 0) AS BIGINT), n_samples)) AS e FROM (
    SELECT *, greatest(0, least(CAST(round_even(start * 1000, 0) AS BIGINT), n_samples - 1)) AS s FROM found JOIN v_signal_recordings USING (recording_id))),
  loud AS (SELECT r.recording_id, event_id, start, "end", confidence, s, e FROM ranged r JOIN v_samples v ON v.recording_id = r.recording_id AND v.i >= s AND v.i < e GROUP BY ALL HAVING sqrt(avg(amp * amp)) >= 1e-5)
  SELECT recording_id, format('snore_{{:04d}}.wav', row_number() OVER (PARTITION BY recording_id ORDER BY event_id)) AS clip_file, round(start, 4) AS start_time, round("end", 4) AS end_time, round((e - s) / 1000.0::DOUBLE, 4) AS duration, confidence FROM loud""")
def p1_manifest(spark, sf_dir):
    """Every recording as a file, and the whole pipeline over the files: the manifest of the clips that it wrote."""
    from nightwave.config import Config

    folder = _folder(spark)
    wav.write_wav(views.signal(spark, sf_dir), f"{folder}/in", "")
    label = F.replace(F.replace("label", F.lit("ring"), F.lit("snor-breath")), F.lit("bolt"), F.lit("wheez"))
    cfg = Config(window_s=0.4, stride_s=0.1, model_rate=views.RATE, threshold=0.02, denoise_method="model", skip_features=True)
    made = pipeline.run(spark, f"{folder}/in", f"{folder}/out", _stretch_levels, views.class_labels(spark, sf_dir).withColumn("label", label), cfg, _unchanged, chunk_seconds=_READ_S)
    return made.manifest


def _unchanged(x: np.ndarray, row: dict) -> np.ndarray:
    """A stand-in for a denoiser that takes nothing away."""
    return x


@query()
def f11_f16_features(spark, sf_dir):
    """Every recording, the harmonic part included; those of fewer than nine frames have null slopes."""
    out = features.extract_features(_whole(spark, sf_dir))
    return out.select("recording_id", "frame_idx", "time", "spectral_centroid", "spectral_rolloff", "zcr", "hnr", F.size("features").alias("n_features"))
