"""Slowly changing dimensions of type 2, point-in-time joins, calendars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.columns import OPEN_END, date_key, iso_weekday, version_key


def scd2(df: DataFrame, key: str, parent: str, external: str, name: str, day: str) -> DataFrame:
    """Versions of each entity's name over the days it was seen on.

    One name a day (the least), a new version whenever it differs from the day before, null-safe; a version holds until the
    eve of the next one, the last one until an open end. Rows are first reduced to one an entity and day, so the windows
    hold no more than days; they share one exchange by key.
    """
    daily = df.groupBy(F.col(key).alias("nk"), F.col(parent).alias("parent"), F.col(external).alias("external_id"), F.col(day).alias("day")).agg(F.min(name).alias("name"))
    by_day = Window.partitionBy("nk").orderBy("day")
    changed = daily.withColumn("changed", F.when(F.col("name").eqNullSafe(F.lag("name").over(by_day)), 0).otherwise(1))
    numbered = changed.withColumn("version", F.sum("changed").over(by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    versions = numbered.groupBy("nk", "version").agg(F.min("parent").alias("parent"), F.min("external_id").alias("external_id"), F.min("name").alias("name"), F.min("day").alias("valid_from"))
    following = F.lead("valid_from").over(Window.partitionBy("nk").orderBy("version"))
    return versions.select(version_key("nk", "version").alias("sk"), "nk", "parent", "external_id", "name", F.col("version").cast("bigint").alias("version"), "valid_from", F.coalesce(F.date_sub(following, 1), F.to_date(F.lit(OPEN_END))).alias("valid_to"), following.isNull().alias("is_current"))


def point_in_time_join(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, day: str, start: str = "valid_from", end: str = "valid_to", how: str = "inner") -> DataFrame:
    """Each fact with the version that held on its day; both bounds belong to the interval. The equal key drives the join."""
    return facts.join(dim, (facts[fact_key] == dim[dim_key]) & facts[day].between(dim[start], dim[end]), how)


def calendar(df: DataFrame, day: str) -> DataFrame:
    """The days that occur, with their parts."""
    days = df.select(F.col(day).alias("data")).where(F.col("data").isNotNull()).distinct()
    part = lambda f: f("data").cast("smallint")
    return days.select(date_key("data").alias("tempo_sk"), "data", part(F.day).alias("dia"), part(F.month).alias("mes"), part(F.year).alias("ano"), part(F.quarter).alias("trimestre"), iso_weekday("data").alias("dia_semana"), F.date_format("data", "yyyy-MM").alias("ano_mes"))


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int, *aggs: Column) -> DataFrame:
    """The k first groups; the keys break ties."""
    return df.groupBy(*keys).agg(*aggs).orderBy(*order, *keys).limit(k)
