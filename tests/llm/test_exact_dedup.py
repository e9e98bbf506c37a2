import hashlib
import os
import subprocess
import sys

import pytest
from nightwave.llm.exact_dedup import DigestIndex, deduplicate, digest_of, exact_groups

SCHEMA = "doc_id long, text string, kept string, text_sha256 int"
ROWS = [(1, "a", "x", 1), (2, "a", "y", 2), (3, None, None, None), (4, "", "z", 4), (None, "a", None, None), (None, "solo", None, 1), (5, "b " * 50_000, "w", 5), (5, "b " * 50_000, "w", 5)]


def test_largest_id_stays_and_nulls_are_empty_texts(spark):
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_groups(spark.createDataFrame(ROWS, SCHEMA)).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == {(1, 2, 3, False, sha("a")), (2, 2, 3, True, sha("a")), (None, 2, 3, False, sha("a")), (3, 4, 2, False, sha("")), (4, 4, 2, True, sha("")),
                   (None, None, 1, True, sha("solo")), (5, 5, 2, True, sha("b " * 50_000))}


def test_deduplicate_keeps_one_row_and_all_columns(spark):
    got = deduplicate(spark.createDataFrame(ROWS, SCHEMA))
    assert got.columns == ["doc_id", "text", "kept", "text_sha256"]
    assert sorted((r.doc_id or 0, r.kept or "", r.text_sha256) for r in got.collect()) == [(0, "", 1), (2, "y", 2), (4, "z", 4), (5, "w", 5)]


def test_later_batches_are_held_against_the_index(spark):
    index = DigestIndex(spark, buckets=4)
    first, second = spark.createDataFrame(ROWS[:2], SCHEMA), spark.createDataFrame([(9, "a", "", 0), (10, "new", "", 0), (11, "new", "", 0)], SCHEMA)
    deduplicate(first, index).collect()
    assert [r.doc_id for r in deduplicate(second, index).collect()] == [11]
    assert index.rows().count() == 2
    assert deduplicate(second, index).count() == 1 and index.rows().count() == 2


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_groups(empty).count() == 0 and deduplicate(empty).count() == 0


def digests(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA).select("doc_id", digest_of().alias("digest"))


def test_anti_join_reads_the_index_without_an_exchange(spark):
    index = DigestIndex(spark, buckets=4)
    index.add(digests(spark))
    plan = digests(spark).hint("merge").join(index.rows(), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("hashpartitioning") <= 1


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_batches_give_the_same_result(spark, batches):
    rows = [(i, f"text {i % 37 * (i % 3)}", None, None) for i in range(200)] + ROWS
    got = sorted((r.doc_id or 0, r.text_sha256, r.keep_id or 0, r.group_size, r.kept) for r in exact_groups(spark.createDataFrame(rows, SCHEMA), batches=batches).collect())
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(t or "", []).append(i)
    want = []
    for t, ids in groups.items():
        top = max((i for i in ids if i is not None), default=None)
        want += [(i or 0, hashlib.sha256(t.encode()).hexdigest(), top or 0, len(ids), i == top) for i in ids]
    assert got == sorted(want)


def test_ids_that_are_no_numbers(spark):
    docs = spark.createDataFrame([("a", "x"), ("b", "x"), (None, "y")], "doc_id string, text string")
    assert sorted((r.doc_id or "", r.kept) for r in exact_groups(docs).collect()) == [("", True), ("a", False), ("b", True)]


def test_another_application_goes_on_with_the_index(spark, tmp_path):
    path = f"{tmp_path}/index"
    code = f"""
from pyspark.sql import SparkSession
from nightwave.llm.exact_dedup import DigestIndex, deduplicate
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", "{tmp_path}/shared").config("spark.sql.warehouse.dir", "{tmp_path}/warehouse").getOrCreate()
docs = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "doc_id long, text string")
assert deduplicate(docs, DigestIndex(spark, "seen", 4, "{path}")).count() == 2
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path, env=os.environ | {"PYTHONPATH": root}, timeout=120)
    docs = spark.createDataFrame([(7, "a"), (8, "c")], "doc_id long, text string")
    index = DigestIndex(spark, "seen", path=path)
    assert [r.doc_id for r in deduplicate(docs, index).collect()] == [8]
    assert {r.keep_id for r in index.rows().collect()} == {2, 3, 8}


def test_an_unknown_folder_is_refused(spark, tmp_path):
    (tmp_path / "other.txt").write_text("not an index")
    with pytest.raises(ValueError):
        exact_groups(spark.createDataFrame(ROWS, SCHEMA), DigestIndex(spark, path=str(tmp_path)))


def test_an_index_is_reopened_by_its_path(spark, tmp_path):
    path = f"{tmp_path}/index"
    first, second = spark.createDataFrame(ROWS[:2], SCHEMA), spark.createDataFrame([(9, "a", "", 0), (10, "new", "", 0)], SCHEMA)
    index = DigestIndex(spark, "reopened", 4, path)
    deduplicate(first, index).collect()
    spark.sql("DROP TABLE reopened")  # an external table: the folder stays, as for a new session without a lasting catalog
    again = DigestIndex(spark, "reopened", 7, path)
    assert [r.doc_id for r in deduplicate(second, again).collect()] == [10]
    assert again.buckets == 4 and {r.keep_id for r in DigestIndex(spark, "other_name", path=path).rows().collect()} == {2, 10}


def test_results_are_read_from_the_index(spark):
    index = DigestIndex(spark, buckets=4)
    index.add(digests(spark))
    folder = index.path.rsplit("/", 1)[1]
    assert any(f"/{folder}/" in f for f in index.groups(digests(spark)).inputFiles())


def test_a_text_of_a_third_of_all_rows_is_split(spark):
    docs = spark.range(60_000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'hot', concat('text ', id)) AS text")
    small = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        out = exact_groups(docs)
        assert out.filter("group_size = 20000 and keep_id = 59997").count() == 20_000
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in small:
            spark.conf.unset(k)
    final = plan.split("Initial Plan")[0]
    assert "SortMergeJoin(skew=true)" in final and "hashpartitioning(digest#" in final and ", 32)" not in final


def test_own_indexes_leave_no_catalog_entry(spark):
    exact_groups(spark.createDataFrame(ROWS, SCHEMA)).collect()
    before = {t.name for t in spark.catalog.listTables()}
    exact_groups(spark.createDataFrame(ROWS, SCHEMA)).collect()
    deduplicate(spark.createDataFrame(ROWS, SCHEMA)).collect()
    assert {t.name for t in spark.catalog.listTables()} == before


def test_repeated_rows_and_null_ids_are_reduced_before_they_move(spark):
    docs = spark.range(30_000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN id + 100 END AS doc_id", "CASE WHEN id % 3 = 1 THEN concat('text ', id) WHEN id % 3 = 0 THEN 'hot' ELSE 'null' END AS text", "id AS extra")
    got = deduplicate(docs)
    rows = got.collect()
    assert len(rows) == 10_002 and sorted(r.text for r in rows if r.doc_id in (7, None)) == ["hot", "null"]
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "partial_first" in plan and "Window" not in plan


def test_a_batch_adds_a_file_a_bucket_however_many_partitions_there_are(spark, monkeypatch, tmp_path):
    from pyspark.sql import DataFrame

    dealt = DataFrame.repartition
    monkeypatch.setattr(type(spark.range(0)), "repartition", lambda self, n, *by: dealt(self, max(n, 40), *by))
    index = DigestIndex(spark, buckets=4, path=f"{tmp_path}/index")
    for low in (0, 500):
        index.add(spark.range(low, low + 600).selectExpr("id doc_id", "cast(id as string) text").select("doc_id", digest_of().alias("digest")))
    assert sum(n.startswith("part-") for n in os.listdir(f"{tmp_path}/index")) == 8
    assert index.rows().count() == 1100 == index.rows().select("digest").distinct().count()
    index.forget()
