import hashlib
import random
import struct

import corpus_pipeline
import public_tokenizers
import tiktoken
from nightwave.llm import mixing, toxicity
from nightwave.llm.byte_bpe import load_ranks
from nightwave.llm.queries import RANK_FILE
from test_bag_minhash import brute


def test_run_equals_brute_force(spark, tmp_path):
    rng = random.Random(0)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(240):
        text = rng.choices(words, k=60)
        if i % 6 == 0:
            text.insert(9, "insultful")
        rows.append((i, " ".join(text), "en", f"s{i % 3}", 0))
    rows += [(300 + i, rows[i][1], "en", "s9", 0) for i in range(1, 40, 2)]  # exact copies
    rows += [(400 + i, rows[i][1] + " end", "en", None, 0) for i in range(1, 60, 3)]  # near copies
    rows += [(500, None, None, None, None), (501, "", "en", "s1", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, 1, int(i % 6 == 0)) for i in range(240)], "doc_id long, quality int, toxic int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}

    bad = {r.doc_id for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect() if r.predicted}
    left = {r[0]: r[1] or "" for r in rows if r[0] not in bad}
    last = {t: max(i for i, x in left.items() if x == t) for t in left.values()}
    left = {i: t for i, t in left.items() if last[t] == i}
    classes = brute(list(left.items()))
    left = {i: t for i, t in left.items() if classes[i] == i}
    assert got.keys() == left.keys()
    assert len(set(range(0, 240, 6)) - bad) <= 4 and all(i % 6 == 0 for i in bad if i < 240)
    tik = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(public_tokenizers.path(RANK_FILE)), special_tokens={})
    for i, text in left.items():
        ids = tik.encode_ordinary(text)
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())


def test_stages_keep_the_columns_of_documents(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text number {i} of many texts", "en", "s", 5) for i in range(20)], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.count() == 20
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_the_mixture_outlives_a_write_to_several_files(spark, tmp_path):
    rows = [(i, f"text number {i} of many", "en", (None, "a", "b")[i % 7 % 3], 5) for i in range(700)] + [(None, "no id", "en", "a", 5), (3, "id twice", "en", "a", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    path = f"{tmp_path}/mixed"
    stages["mixing"](spark, docs, str(tmp_path)).repartition(5).write.parquet(path)
    back = spark.read.parquet(path)
    assert len(back.inputFiles()) == 5
    got = stages["encoding"](spark, back, str(tmp_path)).collect()
    want = {(r.doc_id, r.source): (r.slot, r.in_block) for r in mixing.placed(docs).collect()}
    source = {(r[0], hashlib.sha256(r[1].encode()).hexdigest()): r[3] for r in rows}
    assert len(got) == len(rows)
    assert all((r.slot, r.in_block) == want[r.doc_id, source[r.doc_id, r.decoded_sha256]] for r in got)
    assert len({(r.slot, r.in_block) for r in got}) >= len(rows) - 1


def test_odd_rows_pass_all_stages(spark, tmp_path):
    """Repeated ids, nulls in every column, an empty and a very long text, and columns named as those that stages make."""
    rows = [(i, f"words of text {i} " * 3, "en", f"s{i % 2}", 1, 0.5, 7, True) for i in range(30)]
    rows += [(3, "another text of document three", None, "s1", 1, None, None, None), (None, None, None, None, None, None, None, None), (None, "a text without id", "en", "s0", 1, 0.1, 1, False), (40, "", "", "", 0, 0.0, 0, False), (41, "long " * 100_000, "en", "s0", 1, 0.2, 2, True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, slot long, kept boolean")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "encoding":
            assert out.columns == docs.columns
            known = lambda found: sorted((r[0], r[1], r[5] or -1, r[6] or -1) for r in found if r[0] not in (None, 40))
            assert known(out.collect()) == known(rows)
        assert out.count() == (len(rows) - 1 if name == "exact dedup" else len(rows)), name  # a null text equals the empty one


def test_tables_of_stages_go_as_the_next_is_written(spark, tmp_path):
    import os

    from nightwave.sources.shared import shared_dir

    docs = [(i, f"text number {i} of many texts", "en", "s", 5) for i in range(20)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    folder = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    got = corpus_pipeline.run(spark, str(tmp_path))
    left = {n.split("-")[0] for n in set(os.listdir(folder)) - before}
    assert got.count() == 20 and "mixing" in left and not left & {"toxicity", "exact_dedup", "near_dedup"}
