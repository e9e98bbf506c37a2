"""The corpus pipeline: documents without toxic ones, exact and near copies, mixed by source, encoded."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightwave.llm import bag_minhash, byte_bpe, exact_dedup, mixing, toxicity
from nightwave.llm.common import delete, new_path, scratch, table
from nightwave.llm.queries import RANK_FILE


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that score below one half."""
    score = f"score_{uuid.uuid4().hex}"
    machine = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.with_score(docs, machine, score).filter(F.col(score) < 0.5).select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text, that of the largest doc_id; null counts as the empty text, a null doc_id stays only where its text has no other."""
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows of one document of each class of near copies, that of the least doc_id; texts without words and rows without doc_id stay."""
    return bag_minhash.without_near_copies(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, dealt out and sorted by their place in the mixture of sources; a null source is one of its own."""
    return mixing.mixed(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token digests of every row with its slot and in_block: reading by these is the mixture, however the rows are laid out in files."""
    coded = byte_bpe.round_trip(docs, public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN, ("doc_id", "source"))
    order = mixing.placed(docs).toDF("mix_id", "mix_source", "slot", "in_block")
    both = coded.join(order, coded["doc_id"].eqNullSafe(order["mix_id"]) & coded["source"].eqNullSafe(order["mix_source"]))
    return both.drop("source", "mix_id", "mix_source")


STAGES = [("toxicity", toxic), ("exact dedup", exact), ("near dedup", near), ("mixing", mixture), ("encoding", encoding)]

#: No SQL expresses the learned scores, the signatures and the merges; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. A stage's tables are deleted when its result is written, and that when the next one's is."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name.replace(" ", "_"), lasting=True)
        with scratch(spark):
            made = stage(spark, docs, sf_dir)
            made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
        if before:
            delete(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
