"""Manifests, frame features and denoised tables on disk."""

from __future__ import annotations

import csv
import hashlib
import json
import math
import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightwave.operators import features

COLUMNS = ("clip_file", "start_time", "end_time", "duration", "confidence")


def write_manifest(manifest: DataFrame, path: str) -> None:
    """One CSV dataset in order of recording_id, which leads, and clip_file; every file has a header, and there is one also when there are no rows."""
    manifest.select("recording_id", *COLUMNS).repartitionByRange("recording_id", "clip_file").sortWithinPartitions("recording_id", "clip_file").write.mode("overwrite").option("header", True).csv(path)


def write_recording_manifests(manifest: DataFrame, recordings: DataFrame, folder: str) -> None:
    """<folder>/<recording_id>/manifest.csv for every recording, with the header alone where there are no clips."""
    rows = recordings.select("recording_id").join(manifest.select("recording_id", F.struct(*COLUMNS).alias("clip")), "recording_id", "left")
    rows = rows.repartition("recording_id").sortWithinPartitions("recording_id", "clip.clip_file")

    def save(part):
        at, f, out = None, None, None
        for r in part:
            if r.recording_id != at:
                if f:
                    f.close()
                at = r.recording_id
                os.makedirs(os.path.join(folder, at), exist_ok=True)
                f = open(os.path.join(folder, at, "manifest.csv"), "w", newline="")
                out = csv.writer(f)
                out.writerow(COLUMNS)
            if r.clip is not None:
                out.writerow([r.clip[c] for c in COLUMNS])
        if f:
            f.close()

    rows.foreachPartition(save)


#: A frame's place in its recording, by which feature tables are bucketed and sorted; frames that a bucket has at most by default.
PLACE, BUCKET_FRAMES = ("recording_id", "frame_idx"), 250_000
_ABOUT = "_table.json"


def _about(spark: SparkSession, path: str):
    """The folder as its file system names it, the file system, and the file that tells the table's schema and buckets."""
    fs = spark._jvm.org.apache.hadoop.fs
    folder = fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    folder = files.makeQualified(folder)
    return folder.toString(), files, fs.Path(folder, _ABOUT)


def _named(folder: str) -> str:
    """One catalog entry a folder, however often it is written and read."""
    return f"frame_features_{hashlib.sha256(folder.encode()).hexdigest()[:24]}"


def write_features(frames: DataFrame, path: str, recordings: DataFrame, frame_ms: int = 25, hop_ms: int = 10, buckets: int | None = None) -> DataFrame:
    """The frames with the sample_rate and hop_length that they were made with, as one table; returns what was written.

    The table is bucketed and sorted by (recording_id, frame_idx): a long recording is in all buckets, and tables of as many
    buckets are joined frame by frame without an exchange. Recordings share files, whatever their number, and a filter on
    recording_id reads the row groups that hold it. By default the number of buckets is the power of two, 8 or more, that
    keeps them at 250,000 frames, by the n_samples of the recordings. A null recording_id or frame_idx has no place and is left out.
    """
    spark = frames.sparkSession
    rates = [r.sample_rate for r in recordings.select("sample_rate").distinct().collect()]  # a few rates
    hop = F.coalesce(*[F.when(F.col("sample_rate") == r, features.params_of(r, frame_ms, hop_ms)[1]) for r in rates], F.lit(None)).cast("int") if rates else F.lit(None).cast("int")
    if buckets is None:
        n = recordings.agg(F.sum(F.col("n_samples") / F.col("sample_rate")).alias("s")).first().s or 0
        buckets = max(8, 1 << math.ceil(math.log2(max(1, n * 1000 / hop_ms / BUCKET_FRAMES))))
    rows = frames.filter(F.col("frame_idx").isNotNull()).join(recordings.select("recording_id", "sample_rate"), "recording_id").withColumn("hop_length", hop)
    folder, files, about = _about(spark, path)
    spark.sql(f"DROP TABLE IF EXISTS {_named(folder)}")
    rows.repartition(buckets, *PLACE).write.mode("overwrite").format("parquet").bucketBy(buckets, *PLACE).sortBy(*PLACE).option("path", folder).saveAsTable(_named(folder))
    out = files.create(about, True)
    out.write(json.dumps({"buckets": buckets, "columns": [[f.name, f.dataType.simpleString()] for f in rows.schema.fields]}).encode())
    out.close()
    return read_features(spark, path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """A table of `write_features`, with its buckets in any session; other Parquet folders are read as they are."""
    folder, files, about = _about(spark, path)
    if not files.exists(about):
        return spark.read.parquet(path)
    name = _named(folder)
    if not spark.catalog.tableExists(name):
        stream = files.open(about)
        told = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        stream.close()
        columns, place = ", ".join(f"`{n}` {t}" for n, t in told["columns"]), ", ".join(PLACE)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({place}) SORTED BY ({place}) INTO {told['buckets']} BUCKETS LOCATION '{folder}'")
    return spark.table(name)


def load_denoised(spark: SparkSession, path: str) -> DataFrame:
    """An existing denoised table; an error where there is none, rather than a silent recomputation."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        raise FileNotFoundError(f"no denoised table at {path}") from e
