"""Operators on append-only snapshots: each load of a day is a whole snapshot and supersedes the earlier ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def ranked_snapshots(df: DataFrame, keys: list[str], loaded_at: str) -> DataFrame:
    """Adds `recency`: 1 for all rows of the newest load of a group, 2 for those of the one before, and so on.

    The rank is formed on the distinct loads, of which there are few, and joined back: payloads aren't sorted.
    """
    loads = df.select(*keys, loaded_at).distinct()
    loads = loads.withColumn("recency", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(loaded_at))))
    return df.join(loads, [*keys, loaded_at])


def latest_snapshot(df: DataFrame, keys: list[str], loaded_at: str) -> DataFrame:
    """All rows of each group's newest load; what that load lacks is gone."""
    newest = df.groupBy(*keys).agg(F.max(loaded_at).alias(loaded_at))
    return df.join(newest, [*keys, loaded_at], "left_semi").select(df.columns)


def nth_snapshot(df: DataFrame, keys: list[str], loaded_at: str, n: int) -> DataFrame:
    return ranked_snapshots(df, keys, loaded_at).where(F.col("recency") == n).select(df.columns)


def snapshot_drift(df: DataFrame, keys: list[str], loaded_at: str, amount: Column) -> DataFrame:
    """For groups with two loads or more: the amount in the newest and in the one before, and the difference."""
    two = ranked_snapshots(df, keys, loaded_at).where("recency <= 2")
    of = lambda n: F.sum(F.when(F.col("recency") == n, amount))
    sums = two.groupBy(*keys).agg(of(2).alias("before"), of(1).alias("now"), F.count_if(F.col("recency") == 2).alias("n_before")).where("n_before > 0")
    return sums.select(*keys, F.round("before", 2).alias("previous_amount"), F.round("now", 2).alias("current_amount"), F.round(F.col("now") - F.col("before"), 2).alias("drift"))


def lost_rows(df: DataFrame, keys: list[str], loaded_at: str, identity: str, amount: Column) -> DataFrame:
    """Entities with an amount in the load before the newest that the newest lacks; null identities are always lost."""
    ranked = ranked_snapshots(df, keys, loaded_at).withColumn("_amount", amount)
    before = ranked.where((F.col("recency") == 2) & (F.col("_amount") > 0)).groupBy(*keys, identity).agg(F.sum("_amount").alias("lost_amount"))
    now = ranked.where("recency = 1").select(*keys, identity).distinct()
    return before.join(now, [*keys, identity], "left_anti")


def latest_batch(df: DataFrame, key: str, batch: str, loaded_at: str) -> DataFrame:
    """The rows of each key's newest batch."""
    newest = df.groupBy(key).agg(F.max_by(batch, F.struct(loaded_at, batch)).alias(batch))
    return df.join(newest, [key, batch], "left_semi").select(df.columns)
