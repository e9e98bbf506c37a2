"""What queries exchange and leave in the shared folder, in bytes a sample."""
import os
import pickle

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from nightwave.operators import chunks as ch
from nightwave.plans import queries
from nightwave.sources import catalogue, files
from nightwave.sources.shared import shared_dir


def exchanged(spark):
    return sum(e.totalShuffleWrite() for e in (lambda x: [x.apply(k) for k in range(x.size())])(spark.sparkContext._jsc.sc().statusStore().executorList(True)))


def stored(spark):
    top = shared_dir(spark).removeprefix("file:")
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(top) for f in names)


@pytest.fixture(scope="module")
def letters(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("letters"))
    rng = np.random.default_rng(5)
    docs = [(k, "".join(map(chr, rng.integers(97, 123, 3000 + k) + 64 * (k % 2)))) for k in range(60)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(k, f"bolt ring {k}") for k in range(64)], "p_partkey long, p_name string").write.parquet(f"{path}/part.parquet")
    return path, sum(len(t) for _, t in docs)


def test_packed_samples_are_the_same_bit_by_bit():
    odd = [np.array(x, np.float32) for x in ([], [0.0], [-0.0, 0.0], [1.5, -2.0], [np.nan, 1], [np.inf], [1e-30], [3e30], [255.99, -156.4], np.arange(-32768, 32768) / 32768, np.arange(1 << 23, (1 << 23) + 99) / (1 << 23))]
    for x in odd:
        assert ch.unpack(ch.pack(x)).tobytes() == x.tobytes()
    assert len(ch.pack(np.arange(100, dtype=np.float32) / 128)) == 102 and len(ch.pack(np.arange(-300, 300, dtype=np.float32) / 32768)) == 1202


#: Bytes a sample of what is exchanged and stored by a query.
LIMITS = {"f16_features": 2.5, "f11_f16_features": 4.0, "c7_overlap_identity": 4.0, "c6_spectral_gate": 4.0, "c8_denoise_fallback": 6.0, "s4_clip_files": 7.0, "s4_long_clip_files": 7.0, "s1_s3_wav_files": 2.5, "k2_cut_clips": 6.5, "k2_long_pieces": 4.0, "e11_detect_segments": 6.0}


@pytest.mark.parametrize("name", LIMITS)
def test_samples_move_in_few_bytes(spark, letters, name):
    path, n = letters
    before = exchanged(spark) + stored(spark)
    queries.QUERIES[name](spark, path).write.format("noop").mode("overwrite").save()
    spent = (exchanged(spark) + stored(spark) - before) / n
    print(name, spent)
    assert spent < LIMITS[name]


@pytest.mark.parametrize("name", ["s1_s3_wav_files", "s4_clip_files", "s4_long_clip_files"])
def test_files_of_a_query_are_on_disk_a_share_at_a_time(spark, letters, monkeypatch, name):
    path, _ = letters
    files = []
    monkeypatch.setattr(queries, "_SHARE", 1 << 18)
    found = queries.catalogue.catalogue
    monkeypatch.setattr(queries.catalogue, "catalogue", lambda s, folder: files.append(sum(len(f) for *_, f in os.walk(folder))) or found(s, folder))
    got = sorted(map(tuple, queries.QUERIES[name](spark, path).collect()))
    db = duckdb.connect()
    for t in ("documents", "part"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}/{t}.parquet/*.parquet')")
    cols = queries.QUERIES[name](spark, path).columns
    assert got == sorted(db.execute(f"SELECT {', '.join(cols)} FROM ({queries.ORACLES[name]})").fetchall())
    assert len(files) > 2 and max(files) < 0.8 * sum(files[:len(files) // 2])
    assert not [d for d in os.listdir(shared_dir(spark).removeprefix("file:")) if d.startswith("wav-")]


def test_the_driver_gets_no_list_of_files(spark, tmp_path):
    rows = pa.RecordBatch.from_pylist([{"file": f"f{k}.wav", "sample_rate": 1000, "n_samples": 4, "samples": [ch.pack(np.zeros(4, np.float32))]} for k in range(300)],
                                      schema=pa.schema([("file", pa.string()), ("sample_rate", pa.int32()), ("n_samples", pa.int64()), ("samples", pa.list_(pa.binary()))]))
    folder = str(tmp_path / "out")
    writer = files.WavWriter(folder)
    told = writer.write(iter([rows]))
    assert len(pickle.dumps(told)) < 1000 and len(told.files) == 300
    writer.commit([told])
    assert catalogue._named(folder) == [("", folder, folder, True)]
    assert catalogue.catalogue(spark, folder).count() == 300
