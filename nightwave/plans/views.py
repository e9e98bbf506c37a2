"""Audio-like views over the driver's tables, in Spark, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RATE = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window scores, a recording a user: the user's events in order of time."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("recording_id"), (F.row_number().over(w) - 1).cast("long").alias("window_id"), F.least(F.col("value") / 150.0, F.lit(1.0)).alias("score"))
    return rows.withColumn("center_s", 1.0 + 0.5 * F.col("window_id"))


def score_recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "events").groupBy(F.col("user_id").cast("string").alias("recording_id")).agg((8000 * F.count(F.lit(1))).alias("n_samples"))
    return n.select("recording_id", F.lit(16_000).alias("sample_rate"), "n_samples", (F.col("n_samples") / 16_000).alias("duration_s"))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as a class with a label."""
    return table(spark, sf_dir, "part").select(F.col("p_partkey").cast("int").alias("class_id"), F.col("p_name").alias("label"))


def class_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The classes of a vector of 64 logits."""
    return labels(spark, sf_dir).filter("class_id < 64")


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class logits, a recording a label, a window a vector."""
    return table(spark, sf_dir, "embeddings").select(F.col("label").cast("string").alias("recording_id"), F.col("vec_id").alias("window_id"), (1.0 + 0.5 * F.col("vec_id")).alias("center_s"), F.col("embedding").alias("logits"))


V_SCORES = """
  v_scores AS (
    SELECT CAST(user_id AS VARCHAR) AS recording_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS window_id,
           1.0::DOUBLE + 0.5::DOUBLE * (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) AS center_s, least(value / 150.0, 1.0::DOUBLE) AS score FROM events),
  v_recordings AS (SELECT recording_id, 8000 * count(*) AS n_samples, 16000 AS sample_rate, 8000 * count(*) / 16000.0::DOUBLE AS duration_s FROM v_scores GROUP BY ALL)"""
V_FRAMES = V_SCORES + """,
  segments AS (
    SELECT s.recording_id, center_s, score, lead(center_s) OVER o AS next_c, lead(score) OVER o AS next_s, row_number() OVER o AS k, (n_samples * 1000 + 159999) // 160000 AS n_frames
    FROM v_scores s JOIN v_recordings USING (recording_id) WINDOW o AS (PARTITION BY s.recording_id ORDER BY window_id)),
  spans AS (
    SELECT *, CASE WHEN k = 1 THEN 0 ELSE CAST(ceil(round(center_s * 100, 6)) AS BIGINT) END AS i0, least(n_frames - 1, coalesce(CAST(ceil(round(next_c * 100, 6)) AS BIGINT) - 1, n_frames - 1)) AS i1 FROM segments),
  grid AS (SELECT *, unnest(range(i0, i1 + 1)) AS frame_idx FROM spans WHERE i1 >= i0),
  frames AS (
    SELECT recording_id, frame_idx, frame_idx * 10 / 1000.0::DOUBLE AS t,
           greatest(0.0::DOUBLE, least(1.0::DOUBLE, CASE WHEN next_c IS NULL OR frame_idx * 10 / 1000.0::DOUBLE <= center_s THEN score ELSE score + (next_s - score) * (frame_idx * 10 / 1000.0::DOUBLE - center_s) / (next_c - center_s) END)) AS prob FROM grid)"""


def _padded(source: str, name: str, left: int, right: int) -> str:
    return f"""
  {name}_n AS (SELECT recording_id, frame_idx, prob, count(*) OVER (PARTITION BY recording_id) AS n FROM {source}),
  {name} AS (
    SELECT recording_id, frame_idx, prob, n FROM {name}_n UNION ALL
    SELECT recording_id, -1 - frame_idx, prob, n FROM {name}_n WHERE frame_idx < {left} UNION ALL
    SELECT recording_id, 2 * n - 1 - frame_idx, prob, n FROM {name}_n WHERE frame_idx >= n - {right})"""


def folded(source: str, name: str, left: int, right: int) -> str:
    """As `_padded`, for recordings of any length: places before and after are folded back as often as it takes."""
    fold = "((p % (2 * n)) + 2 * n) % (2 * n)"
    return f"""
  {name}_n AS (SELECT recording_id, count(*) AS n FROM {source} GROUP BY ALL),
  {name}_p AS (SELECT recording_id, n, unnest(range(-{left}, n + {right})) AS p FROM {name}_n),
  {name} AS (SELECT s.recording_id, p AS frame_idx, prob, n FROM {name}_p q JOIN {source} s ON s.recording_id = q.recording_id AND s.frame_idx = CASE WHEN {fold} < n THEN {fold} ELSE 2 * n - 1 - {fold} END)"""


def median_sql(source: str, name: str, padded=_padded) -> str:
    return padded(source, f"{name}_pad", 5, 4) + f""",
  {name} AS (SELECT recording_id, frame_idx, prob FROM (
    SELECT recording_id, frame_idx, n, list_sort(list(prob) OVER (PARTITION BY recording_id ORDER BY frame_idx ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING))[6] AS prob FROM {name}_pad) WHERE frame_idx BETWEEN 0 AND n - 1)"""


def uniform_sql(source: str, name: str, padded=_padded) -> str:
    return padded(source, f"{name}_pad", 10, 9) + f""",
  {name} AS (SELECT recording_id, frame_idx, prob FROM (
    SELECT recording_id, frame_idx, n, avg(prob) OVER (PARTITION BY recording_id ORDER BY frame_idx ROWS BETWEEN 10 PRECEDING AND 9 FOLLOWING) AS prob FROM {name}_pad) WHERE frame_idx BETWEEN 0 AND n - 1)"""


def mean_sql(column: str) -> str:
    return f"(CAST(sum(CAST(round({column} * 100000000) AS BIGINT)) AS BIGINT) + count(*) // 2) // count(*) / 100000000.0::DOUBLE"


def digits_sql(column: str, digits: int) -> str:
    step = 10 ** (8 - digits)
    return f"(CAST(round({column} * 100000000) AS BIGINT) + {step // 2}) // {step} / {10**digits}.0::DOUBLE"


#: Every view's recordings have at least 50 frames, so one mirror image at each end is enough here.
V_SMOOTH = V_FRAMES + "," + median_sql("frames", "med") + "," + uniform_sql("med", "uni") + """,
  smooth AS (SELECT recording_id, frame_idx, round(frame_idx * 0.01::DOUBLE, 6) AS t, round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, prob)), 6) AS prob FROM uni)"""
V_RUNS = V_SMOOTH + f""",
  islands AS (SELECT *, frame_idx - row_number() OVER (PARTITION BY recording_id ORDER BY frame_idx) AS island FROM smooth WHERE prob >= 0.30),
  runs AS (
    SELECT recording_id, min(frame_idx) AS first_frame, max(frame_idx) AS last_frame, round(min(frame_idx) * 10 / 1000.0::DOUBLE, 6) AS start, round(max(frame_idx) * 10 / 1000.0::DOUBLE, 6) AS "end", {mean_sql("prob")} AS confidence
    FROM islands GROUP BY recording_id, island)"""
V_MERGED = V_RUNS + f""",
  marked AS (SELECT *, CASE WHEN first_frame - lag(last_frame) OVER o <= 30 THEN 0 ELSE 1 END AS fresh FROM runs WINDOW o AS (PARTITION BY recording_id ORDER BY first_frame)),
  grouped AS (SELECT *, sum(fresh) OVER (PARTITION BY recording_id ORDER BY first_frame) AS grp FROM marked),
  merged AS (SELECT recording_id, min(first_frame) AS first_frame, max(last_frame) AS last_frame, min(start) AS start, max("end") AS "end", {mean_sql("confidence")} AS confidence FROM grouped GROUP BY recording_id, grp)"""
V_EVENTS = V_MERGED + f""",
  lengths AS (SELECT recording_id, max(frame_idx) + 1 AS n_frames FROM smooth GROUP BY ALL),
  padded AS (
    SELECT recording_id, first_frame, last_frame, round(greatest(0.0::DOUBLE, start - 0.10::DOUBLE), 6) AS start, round(least((n_frames - 1) * 10 / 1000.0::DOUBLE, "end" + 0.10::DOUBLE), 6) AS "end", confidence
    FROM merged JOIN lengths USING (recording_id)),
  kept AS (
    SELECT recording_id, first_frame, round(round(start, 8), 4) AS start, round(round("end", 8), 4) AS "end", {digits_sql("confidence", 4)} AS confidence
    FROM padded WHERE round("end" - start, 6) >= 0.40::DOUBLE),
  found AS (SELECT recording_id, CAST(row_number() OVER (PARTITION BY recording_id ORDER BY first_frame) AS INTEGER) AS event_id, start, "end", confidence FROM kept)"""


CHUNK_SAMPLES = 512


def signal(spark: SparkSession, sf_dir: str, channels: int = 1, size: int = CHUNK_SAMPLES) -> DataFrame:
    """Sample chunks at 1000 Hz, a recording a document: (code point - 96) / 128; a second channel is halved, with odd samples turned."""
    docs = table(spark, sf_dir, "documents").filter(F.length("text") > 0).select(F.col("doc_id").cast("string").alias("recording_id"), "text", F.length("text").alias("n"))
    rows = docs.withColumn("chunk_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(n - 1) div {size}"))))
    x = F.transform(F.split(F.substring("text", F.col("chunk_id").cast("int") * size + 1, F.lit(size)), ""), lambda c: ((F.ascii(c) - 96) / 128.0).cast("float"))
    rows = rows.select("recording_id", F.lit(0).alias("channel"), "chunk_id", (F.col("chunk_id") * size).alias("start_sample"), F.lit(RATE).alias("sample_rate"), F.filter(x, lambda v: v.isNotNull()).alias("samples"))
    if channels == 1:
        return rows
    half = F.transform("samples", lambda v, i: F.when(i % 2 == 1, -v / 2).otherwise(v / 2).cast("float"))
    return rows.unionByName(rows.withColumn("channel", F.lit(1)).withColumn("samples", half))


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of 64 samples, a recording a label."""
    w = Window.partitionBy("label").orderBy("vec_id")
    return table(spark, sf_dir, "embeddings").select(F.col("label").cast("string").alias("recording_id"), (F.row_number().over(w) - 1).cast("bigint").alias("frame_idx"), F.col("embedding").alias("samples"))


def segments(recs: DataFrame) -> DataFrame:
    """Stretches of a quarter second each 0.3 s, from 0 to the end of each recording."""
    k = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("duration_s") / 0.3 - 1e-9).cast("int") - 1))
    rows = recs.select("recording_id", F.posexplode(k).alias("i", "k"))
    start = F.round(F.col("k") * 3 * 0.1, 6)
    return rows.select("recording_id", (F.col("i") + 1).alias("event_id"), start.alias("start"), F.round(start + 0.25, 6).alias("end"), F.lit(0.5).alias("confidence"))


V_SIGNAL = """
  v_samples AS (SELECT CAST(doc_id AS VARCHAR) AS recording_id, i, (unicode(ch) - 96) / 128.0::DOUBLE AS amp, n_samples
                FROM (SELECT doc_id, length(text) AS n_samples, unnest(string_split(text, '')) AS ch, unnest(range(length(text))) AS i FROM documents WHERE length(text) > 0)),
  v_signal_recordings AS (SELECT CAST(doc_id AS VARCHAR) AS recording_id, length(text) AS n_samples, length(text) / 1000.0::DOUBLE AS duration_s FROM documents WHERE length(text) > 0)"""
V_SEGMENTS = V_SIGNAL + """,
  v_segments AS (
    SELECT recording_id, n_samples, k + 1 AS event_id, round(k * 3 * 0.1::DOUBLE, 6) AS start, round(round(k * 3 * 0.1::DOUBLE, 6) + 0.25::DOUBLE, 6) AS "end", 0.5::DOUBLE AS confidence
    FROM v_signal_recordings, LATERAL (SELECT unnest(range(greatest(1, CAST(ceil(duration_s / 0.3::DOUBLE - 1e-9) AS BIGINT)))) AS k)),
  v_ranges AS (
    SELECT *, greatest(s + 1, least(CAST(round_even("end" * 1000, 0) AS BIGINT), n_samples)) AS e FROM (
      SELECT *, greatest(0, least(CAST(round_even(start * 1000, 0) AS BIGINT), n_samples - 1)) AS s FROM v_segments))"""
V_EMBEDDED = """
  v_frames AS (SELECT CAST(label AS VARCHAR) AS recording_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS frame_idx, embedding AS x FROM embeddings)"""
