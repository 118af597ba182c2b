"""Approximate numbers of distinct values by sketches that are stored by day and merged for any range of days.

A sketch has a fixed size (about 2 ** lg_k bytes), whatever the number of values, and a range needs the sketches of its days alone, not
the rows. The relative standard error is 1.04 / sqrt(2 ** lg_k), and merging adds none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 12


def standard_error(lg_k: int = LG_K) -> float:
    return 1.04 / (1 << lg_k) ** 0.5


def daily(df: DataFrame, day: str, groups: list[str], value: str, lg_k: int = LG_K) -> DataFrame:
    """day, groups, `sketch` of the distinct values, and `rows`. Store it by day; a day that is revised is sketched anew."""
    return df.groupBy(day, *groups).agg(F.hll_sketch_agg(value, lg_k).alias("sketch"), F.count("*").alias("rows"))


def merged(sketches: DataFrame, day: str, first, last, groups: list[str]) -> DataFrame:
    """groups and `distinct`, the estimated number of distinct values over the days from first to last."""
    inside = sketches.where(F.col(day).between(F.lit(first), F.lit(last)))
    return inside.groupBy(*groups).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct"), F.sum("rows").alias("rows"))
