"""Exact duplicates by a persistent digest index, in DataFrame functions only.

The index is a table of (digest, keep_id), bucketed and sorted by digest, a binary SHA-256. A batch is reduced to one row
a digest before anything meets, so that a text which is a third of all rows is one row in every join. New digests are
found by a sort-merge anti-join, for which the index side needs no exchange, and appended; every batch, the first one
too, goes this way and reads its result from the index. A table is taken in `batches` parts, those of larger doc_id
first, so that what an index gives to the documents that came before it holds here too: of equal texts the largest stays.

Defined cases: a null text counts as the empty text; a null doc_id stays only if its whole group has no other; rows
that repeat both doc_id and text share one result in `exact_groups`, and `deduplicate` keeps one of them; ids that are
no numbers are taken in one batch; an empty table gives an empty result; other columns pass through `deduplicate`
untouched, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from nightwave.llm.common import new_path, text_of, written

BUCKETS, BUCKET_ROWS, BATCHES, MARKER = 32, 5_000_000, 2, "_buckets_"


def digest_of() -> Column:
    return F.unhex(F.sha2(text_of(), 256))


class DigestIndex:
    """A bucketed table of the digests seen so far; `add` takes a batch of digests into it.

    The folder is the index: it is registered under `name` where the catalog does not have it, with the number of buckets
    that a marker file in it tells, so that a session or an application without the catalog entry goes on with what is
    there. A folder with files and without the marker is refused. `buckets` counts for a new index: a bucket of some ten
    million digests takes about 0.5 GB.
    """

    def __init__(self, spark: SparkSession, name: str | None = None, buckets: int = BUCKETS, path: str | None = None):
        self.spark, self.buckets = spark, buckets
        self.name = name or f"digests_{uuid.uuid4().hex}"
        self.path = path or new_path(spark, self.name)

    def _open(self, kind: str | None = None) -> None:
        """Registers the table of the folder, an empty one with ids of that kind where there is none."""
        if self.spark.catalog.tableExists(self.name):
            return
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.path)
        files = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [x.getPath().getName() for x in files.listStatus(folder)] if files.exists(folder) else []
        told = [int(n.removeprefix(MARKER)) for n in names if n.startswith(MARKER)]
        if names and not told:
            raise ValueError(f"{self.path} has files but not the marker of an index")
        if any(n.startswith("part-") for n in names):
            kind = self.spark.read.parquet(self.path).schema["keep_id"].dataType.simpleString()
        if kind is None:
            raise ValueError(f"no index at {self.path} yet")
        if told:
            self.buckets = told[0]
        else:
            files.mkdirs(folder)
            files.create(jvm.org.apache.hadoop.fs.Path(folder, f"{MARKER}{self.buckets}")).close()
        self.spark.sql(f"CREATE TABLE {self.name} (digest BINARY, keep_id {kind}) USING parquet "
                       f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")

    def forget(self) -> None:
        """Takes the table out of the catalog; the folder stays."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def rows(self) -> DataFrame:
        self._open()
        return self.spark.table(self.name)

    def add(self, batch: DataFrame) -> None:
        """Append the digests of the batch (doc_id, digest) that are not yet indexed, each with its largest doc_id."""
        self._open(batch.schema["doc_id"].dataType.simpleString())
        seen = batch.groupBy("digest").agg(F.max("doc_id").alias("keep_id"))
        fresh = seen.hint("merge").join(self.rows(), "digest", "left_anti")
        bucket = F.pmod(F.hash("digest"), F.lit(self.buckets))  # as Spark has it: a task writes the file of one bucket
        fresh.repartitionById(self.buckets, bucket).select("digest", "keep_id").write.insertInto(self.name)

    def groups(self, digests: DataFrame) -> DataFrame:
        """digest, keep_id (the document that stays for it, from these or earlier rows), group_size (rows here) of each digest."""
        sizes = digests.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
        return sizes.hint("merge").join(self.rows(), "digest").select("digest", "keep_id", "group_size")


def indexed(digests: DataFrame, index: DigestIndex, batches: int = BATCHES) -> DataFrame:
    """`DigestIndex.groups` of digests (doc_id, digest), a written table, after all its batches are in the index."""
    numbers = isinstance(digests.schema["doc_id"].dataType, NumericType)
    shares = [1 - k / batches for k in range(1, batches)] if numbers else []
    cuts = digests.agg(F.percentile_approx("doc_id", shares).alias("c")).first().c if shares else None  # a number a batch
    parts, above = [], F.lit(True)
    for c in cuts or []:
        parts.append(above & F.coalesce(F.col("doc_id") >= c, F.lit(False)))
        above = above & F.coalesce(F.col("doc_id") < c, F.lit(True))
    for part in [*parts, above]:
        index.add(digests.filter(part))
    return index.groups(digests)


def _written_groups(docs: DataFrame, index: DigestIndex | None, batches: int) -> tuple[DataFrame, DataFrame]:
    """doc_id and digest of every row, and `DigestIndex.groups` of them, both written; an index of its own has buckets by the number of rows and leaves the catalog."""
    digests = written(docs.select("doc_id", digest_of().alias("digest")), "digests")
    own = index is None
    index = index or DigestIndex(docs.sparkSession, buckets=max(BUCKETS, digests.count() // BUCKET_ROWS + 1))
    groups = written(indexed(digests, index, batches), "groups")
    if own:
        index.forget()
    return digests, groups


def exact_groups(docs: DataFrame, index: DigestIndex | None = None, batches: int = BATCHES) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of docs; of equal texts the largest doc_id stays."""
    digests, groups = _written_groups(docs, index, batches)
    # the groups were written without buckets: both sides are exchanged by the session's number of partitions, and
    # adaptive execution can split a digest that is a third of all rows
    return digests.hint("merge").join(groups, "digest").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def deduplicate(docs: DataFrame, index: DigestIndex | None = None, batches: int = BATCHES) -> DataFrame:
    """The rows of docs that stay, with the columns of docs.

    Whole rows move once, by (digest, doc_id); as the key has the doc_id no digest is hot. Rows that repeat both, or that have
    one text and no doc_id, are reduced to one in the task that reads them, so that they are no hot key either.
    """
    _, groups = _written_groups(docs, index, batches)
    sha, of = (f"{n}_{uuid.uuid4().hex}" for n in ("sha", "of"))
    one = docs.withColumns({sha: digest_of(), of: F.struct("doc_id")}).dropDuplicates([sha, of])  # a struct of a null equals another
    stay = groups.select(F.col("digest").alias(sha), F.struct(F.col("keep_id").alias("doc_id")).alias(of))
    return one.join(stay, [sha, of], "left_semi").select(*docs.columns)
