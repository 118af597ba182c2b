"""Small helpers that several operators of this subpackage use: shared storage, tables, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Arrow batches to Python hold about this many bytes, so that very long texts don't pile up in one batch.
BATCH_BYTES = 8 << 20
#: Inside a task, texts are worked on in pieces of about this many bytes.
PIECE_BYTES = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it in spark.checkpoint.dir.

    Where it is unset, a local session, which is one process on one machine, gets a temporary one; a cluster's raises an error.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        where = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Cuts the lineage: the rows as a Parquet table in the shared folder, which outlives lost executors."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """The tables that one run writes to the shared folder, by label; those that nothing reads any more are removed."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, {}

    def write(self, df: DataFrame, label: str) -> DataFrame:
        path = new_path(self.spark, label)
        df.write.parquet(path)
        self.paths.setdefault(label, []).append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *labels: str, keep_last: bool = False) -> None:
        """Removes all tables of the labels, or all but the last of each."""
        for label in labels:
            paths = self.paths.pop(label, [])
            if keep_last:
                self.paths[label] = paths[-1:]
                paths = paths[:-1]
            for path in paths:
                where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def bounded_batches(spark: SparkSession) -> None:
    """Bounds the bytes of an Arrow batch, whatever the lengths of the rows in it."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def repeated(df: DataFrame, count: str, by: list[str], block: int = 1 << 16, parts: int = 64) -> DataFrame:
    """Each row as often as `count` says, `copy` numbering its copies from 0; rows with a count of 0 or null go.

    Rows that stand for more than `block` copies are cut into blocks, which are dealt by the columns `by` and their number to
    `parts` partitions before any copy is made. So copies of one row don't come from one task, nor from one long array.
    """
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("copy")
    few = df.where(F.col(count).between(1, block)).select("*", upto(F.col(count).cast("long")))
    blocks = df.where(F.col(count) > block).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(count) - 1) / block))).alias("block")).repartition(parts, *by, "block")
    many = blocks.select("*", upto(F.least(F.lit(block), F.col(count) - block * F.col("block")).cast("long")))
    return few.union(many.withColumn("copy", F.col("copy") + block * F.col("block")).drop("block"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column_or_null(df: DataFrame, name: str, kind: str):
    """The column cast to a type, or nulls where the table lacks it."""
    return (F.col(f"`{name}`") if name in df.columns else F.lit(None)).cast(kind).alias(name)


def pieces(values: list, size=len, limit: int = PIECE_BYTES) -> Iterator[slice]:
    """Slices of a list whose items add up to about `limit`; an item above it stands alone."""
    start, total = 0, 0
    for i, v in enumerate(values):
        n = size(v)
        if i > start and total + n > limit:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(values):
        yield slice(start, len(values))


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow string column as UTF-8; null becomes empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def sampled(df: DataFrame, key: str, n: int) -> DataFrame:
    """The rows of the n different values of a column with the smallest hashes; only hashes meet in one place. Copies don't use up the bound."""
    rank = F.xxhash64(key)
    last = df.select(rank.alias("h")).distinct().orderBy("h").limit(n).agg(F.max("h")).first()[0]
    return df.where(F.lit(last is not None) & (rank <= F.lit(last)))
