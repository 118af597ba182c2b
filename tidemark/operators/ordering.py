"""Global order without a single task: numbers of rows in sorted order, and the order of files that were written sorted.

Rows are dealt to ranges and sorted in each; a row's number is its place in its range plus the sizes of the ranges before.
Only the ranges' sizes meet in one place, and there are no more of them than partitions (or blocks of files).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows of a run: two to the power of this.
_RUN = 18
_UNORDERED = ("map", "variant", "interval")


def _shifted(stored: DataFrame, by: list[str], group: list[str], columns: list[str], name: str) -> DataFrame:
    """Turns `_place`, which counts up inside each group, into numbers from 1 over all groups, within each value of `by`."""
    sizes = stored.groupBy(*by, *group).agg(F.min("_place").alias("_first"), F.count("*").alias("_k"))
    earlier = Window.partitionBy(*by).orderBy(*group).rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_k").over(earlier), F.lit(0)) - F.col("_first") + 1
    shifts = sizes.select(*(F.col(c).alias(f"_of_{c}") for c in [*by, *group]), shift.alias("_shift"))
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in [*by, *group]))
    return stored.join(shifts, same).select(*columns, (F.col("_place") + F.col("_shift")).alias(name))


def numbered(df: DataFrame, order: list[str], path: str, by: list[str] | None = None, name: str = "position") -> DataFrame:
    """Adds the number of each row, from 1, in ascending order (nulls first) of some columns and then of all others, within each value of `by`.

    The sorted rows are stored below `path`, which cuts the lineage, so that numbers don't change when a task is repeated. Repeated
    rows are told apart by where they came from, so a hot key and even a hot row is dealt to several tasks. Bounds of ranges reach the
    driver: don't order by very long texts.
    """
    by, spark = by or [], df.sparkSession
    rest = [c for c, kind in df.dtypes if c not in (*by, *order) and not kind.startswith(_UNORDERED)]
    keys = [*by, *order, *rest, "_tie"]
    ranged = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = ranged.select(*df.columns, F.monotonically_increasing_id().alias("_place"))
    placed.write.parquet(path)
    stored = spark.read.schema(placed.schema).parquet(path).withColumn("_part", F.shiftright("_place", 33))
    return _shifted(stored, by, ["_part"], df.columns, name)


def _placed_files(spark: SparkSession, files: DataFrame, path: str) -> DataFrame:
    """Rows of a file source with their file, block and place, stored."""
    rows = files.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_place"))
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def restored(files: DataFrame, path: str, name: str = "position") -> DataFrame:
    """Adds to the rows of a file source (CSV, JSON lines or text, as read) their number in the order of the files' names and of the lines in each.

    Large files are read in blocks by many tasks; the blocks' sizes say where each begins.
    """
    return _shifted(_placed_files(files.sparkSession, files, path), [], ["_file", "_block"], files.columns, name)


def order_problems(files: DataFrame, keys: list[str], path: str) -> DataFrame:
    """`position`, `previous` and `current` keys where the files' rows aren't in ascending order of the keys: inside a run of rows or at the border of two.

    A block is cut into runs of at most 2 ** _RUN rows, so a task holds one run of it, however large blocks are; of each run, one row meets the others.
    """
    stored = _placed_files(files.sparkSession, files, path).withColumn("_run", F.shiftright("_place", _RUN))
    key = F.struct(*keys)
    inside = Window.partitionBy("_file", "_block", "_run").orderBy("_place")
    falls = stored.select("_file", "_block", "_place", F.lag(key).over(inside).alias("previous"), key.alias("current")).where(F.col("previous") > F.col("current"))
    runs = stored.groupBy("_file", "_block", "_run").agg(F.min("_place").alias("_place"), F.min_by(key, "_place").alias("current"), F.max_by(key, "_place").alias("last"))
    across = runs.select("_file", "_block", "_place", F.lag("last").over(Window.orderBy("_file", "_block", "_run")).alias("previous"), "current").where(F.col("previous") > F.col("current"))
    numbers = _shifted(stored.select("_file", "_block", "_place"), [], ["_file", "_block"], ["_file", "_block", "_place"], "position")
    return falls.unionByName(across).join(numbers, ["_file", "_block", "_place"]).select("position", "previous", "current")
