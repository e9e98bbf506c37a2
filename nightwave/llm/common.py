"""What the corpus operators share: reading tables and cutting lineage in the shared folder."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructField, StructType

from nightwave.sources.shared import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SCRATCH: list[list[str]] = []


def delete(spark: SparkSession, path: str, now: bool = True) -> None:
    """Delete a folder now or when the application ends."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(hadoop, True) if now else files.deleteOnExit(hadoop)


@contextmanager
def scratch(spark: SparkSession):
    """Tables written inside are deleted at the end, but for those written as lasting."""
    _SCRATCH.append([])
    try:
        yield
    finally:
        for path in _SCRATCH.pop():
            delete(spark, path, True)


def new_path(spark: SparkSession, name: str, lasting: bool = False) -> str:
    """A path in the shared folder that Spark deletes when the application ends, or the enclosing scratch does."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _SCRATCH and not lasting:
        _SCRATCH[-1].append(path)
    delete(spark, path, False)
    return path


def written(df: DataFrame, name: str, lasting: bool = False) -> DataFrame:
    """The rows of df from Parquet in the shared folder: lineage ends here and lost executors cost no recomputation."""
    spark = df.sparkSession
    path = new_path(spark, name, lasting)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(column: str = "text"):
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def map_batches(df: DataFrame, keep: list[str], columns: dict, function) -> DataFrame:
    """The columns `keep` of df unchanged, then those that `function` makes of each Arrow batch.

    columns: name to Arrow type. function: takes a record batch, returns a list of values a column, in their order.
    """
    fields = [df.schema[k] for k in keep] + from_arrow_schema(pa.schema(list(columns.items()))).fields

    def run(batches):
        for b in batches:
            new = function(b)
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(k)) for k in keep] + [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(new, columns.values(), strict=True)], names=keep + list(columns))

    return df.mapInArrow(run, StructType([StructField(f.name, f.dataType, True) for f in fields]))
