"""Data-quality checks. Each returns the rows, groups or values that violate it; an empty result passes."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Keys that occur more than once; keys with nulls don't count."""
    known = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns))
    return df.where(known).groupBy(*columns).agg(F.count("*").alias("occurrences")).where("occurrences > 1")


def unique_grain(df: DataFrame, *columns: str) -> DataFrame:
    """As `unique`, but nulls are values like others."""
    return df.groupBy(*columns).agg(F.count("*").alias("occurrences")).where("occurrences > 1")


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(~F.col(column).isin(values)).groupBy(column).agg(F.count("*").alias("occurrences"))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows of the child whose key, if it has one, the parent lacks."""
    return child.where(F.col(column).isNotNull()).join(parent.select(F.col(parent_column).alias(column)).distinct(), column, "left_anti")


def non_negative(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.where(reduce(or_, (F.col(c) < 0 for c in columns)))


def same_count(joined: DataFrame, facts: DataFrame) -> DataFrame:
    """One row with both counts if a join has lost or multiplied rows."""
    a = joined.agg(F.count("*").alias("joined_rows"))
    b = facts.agg(F.count("*").alias("fact_rows"))
    return a.join(b, F.lit(True)).where("joined_rows <> fact_rows")


def overlaps(dim: DataFrame, key: str = "nk", start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Versions that begin before an earlier one of their entity has ended. One window instead of a self-join: no pairs are made."""
    w = Window.partitionBy(key).orderBy(start, end).rowsBetween(Window.unboundedPreceding, -1)
    return dim.withColumn("held_until", F.max(end).over(w)).where(F.col(start) <= F.col("held_until")).select(key, start, end, "held_until")


def one_current(dim: DataFrame, key: str = "nk", flag: str = "is_current") -> DataFrame:
    """Entities without exactly one current version."""
    return dim.groupBy(key).agg(F.count_if(F.col(flag)).alias("n_current")).where("n_current <> 1")


def one_parent(df: DataFrame, child: str, parent: str) -> DataFrame:
    """Children with more than one parent. The smallest and the largest tell, so no set of parents is kept."""
    return df.groupBy(child).agg(F.min(parent).alias("least_parent"), F.max(parent).alias("greatest_parent")).where("least_parent <> greatest_parent")


def same_contract(a: DataFrame, b: DataFrame) -> DataFrame:
    """Columns that two tables don't have by the same name at the same position; works on schemas alone."""
    spark = a.sparkSession
    rows = lambda df: spark.createDataFrame([(c, i) for i, c in enumerate(df.columns)], "column_name string, position int")
    x, y = rows(a).withColumnRenamed("position", "position_a"), rows(b).withColumnRenamed("position", "position_b")
    return x.join(y, "column_name", "full_outer").where(~F.col("position_a").eqNullSafe(F.col("position_b")))


def unconsumed_keys(df: DataFrame, payload: str, group: str, known: dict[str, set[str]]) -> DataFrame:
    """Keys of the payloads (VARIANT objects) that nothing reads, by group, with their number of rows."""
    spark = df.sparkSession
    read = spark.createDataFrame([(g, k) for g, keys in known.items() for k in sorted(keys)], f"{group} string, key string")
    keys = df.select(group, F.explode(F.map_keys(F.variant_get(payload, "$", "map<string,variant>"))).alias("key"))
    return keys.groupBy(group, "key").agg(F.count("*").alias("occurrences")).join(F.broadcast(read), [group, "key"], "left_anti")


@dataclass(frozen=True)
class Check:
    name: str
    violations: DataFrame
    severity: str = "error"


def report(spark: SparkSession, checks: list[Check]) -> DataFrame:
    """Check, severity, number of violations and outcome of each check."""
    rows = [c.violations.agg(F.count("*").alias("violations")).select(F.lit(c.name).alias("check"), F.lit(c.severity).alias("severity"), "violations") for c in checks]
    status = F.when(F.col("violations") == 0, "pass").otherwise(F.when(F.col("severity") == "warn", "warn").otherwise("fail"))
    return reduce(DataFrame.unionByName, rows).withColumn("outcome", status)


def labelled_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table by label."""
    return reduce(DataFrame.unionByName, (df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("object"), "rows") for name, df in tables.items()))
