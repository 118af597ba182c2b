"""The star as stored layers that follow their source day by day: a late snapshot rewrites what it touches and nothing else.

Layout: silver and fact by day; for each level, the names observed on each day and the versions derived from them, by bucket of the
natural key. A refresh compares the old and the new rows of its days, takes the entities whose observations changed, derives their
versions anew from all their stored observations, and replaces only partitions whose contents differ (dynamic partition overwrite).
Facts of other days are replaced where an ad's versions changed, since a version's key holds its number.

The result equals a full rebuild. Every step writes what later steps compare with after that, so a refresh that died is simply
repeated: facts before versions, versions before observations, silver last.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.dimensional import calendar, scd2
from tidemark.plans.star import PARENTS, dim_platform, fact
from tidemark.sources.raw import scratch_path
from tidemark.sources.registry import LEVELS

_OBSERVED = ["nk", "parent", "external_id", "day", "name"]


def _observations(silver: DataFrame, level: str, buckets: int) -> DataFrame:
    """One row for each entity and day, with the name seen on it, and the entity's bucket."""
    keys = [F.col(f"{level}_nk").alias("nk"), F.col(PARENTS[level]).alias("parent"), F.col(f"{level}_external_id").alias("external_id"), F.col("data").alias("day")]
    return silver.groupBy(*keys).agg(F.min(f"{level}_nome").alias("name")).withColumn("bucket", F.pmod(F.xxhash64("nk"), F.lit(buckets)).cast("int"))


def _versions(observed: DataFrame, level: str, buckets: int) -> DataFrame:
    """The dimension's rows as in plans.star, with the bucket."""
    out = scd2(observed, "nk", "parent", "external_id", "name", "day")
    named = out.select(F.col("sk").alias(f"{level}_sk"), F.col("nk").alias(f"{level}_nk"), F.col("parent").alias(PARENTS[level]), "external_id", F.col("name").alias("nome"), F.col("version").alias("versao"), F.col("valid_from").alias("valido_de"), F.col("valid_to").alias("valido_ate"), F.col("is_current").alias("is_atual"))
    return named.withColumn("bucket", F.pmod(F.xxhash64(f"{level}_nk"), F.lit(buckets)).cast("int"))


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that only one side has, or has more often."""
    sided = lambda df, n: df.select(*a.columns, F.lit(n).alias("_n"))
    return sided(a, 1).unionByName(sided(b, -1)).groupBy(*a.columns).agg(F.sum("_n").alias("_n")).where("_n <> 0").drop("_n")


def _store(df: DataFrame, path: str, column: str) -> None:
    df.hint("rebalance", column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def _replace(df: DataFrame, path: str, column: str, values: list) -> None:
    """Puts rows, which don't depend on the table itself, in the place of some partitions; those without rows go."""
    spark = df.sparkSession
    left = {r[0] for r in df.select(column).distinct().collect()}  # days or buckets
    if left:
        _store(df, path, column)
    for value in set(values) - left:
        gone = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={value}")
        gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)


def aside(df: DataFrame, label: str) -> DataFrame:
    """The rows as stored, for what is read more than once."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Layers:
    """The stored layers below a folder. `buckets` is fixed for its life."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 64) -> None:
        self.spark, self.folder, self.buckets = spark, folder.rstrip("/"), buckets

    def _path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self._path(name))

    def build(self, silver: DataFrame) -> None:
        """Everything from all of silver."""
        _store(silver, self._path("silver"), "data")
        stored = self._read("silver")
        for level in LEVELS:
            _store(_observations(stored, level, self.buckets), self._path(f"seen_{level}"), "bucket")
            _store(_versions(self._read(f"seen_{level}"), level, self.buckets), self._path(f"dim_{level}"), "bucket")
        self._store_facts(stored, self._read("dim_anuncio"), None)
        self._store_small(stored.select("data"), dim_platform(stored))

    def _store_facts(self, silver: DataFrame, ads: DataFrame, days: list[dt.date] | None) -> None:
        rows = fact(silver.withColumn("_day", F.col("data")), ads, carried=["_day"])
        if days is None:
            _store(rows, self._path("fato_metricas"), "_day")
        else:
            _replace(aside(rows, "facts"), self._path("fato_metricas"), "_day", days)

    def _store_small(self, days: DataFrame, platforms: DataFrame) -> None:
        """Calendar and platforms, one file each, if they differ from what is stored."""
        for name, df in (("dim_tempo", calendar(days, "data")), ("dim_plataforma", platforms)):
            new = aside(df.coalesce(1), name)
            try:
                stored = self._read(name)
            except Exception as missing:  # noqa: BLE001
                if "PATH_NOT_FOUND" not in str(missing):
                    raise
                stored = new.where("false")
            if not _differing(new, stored).isEmpty():
                new.coalesce(1).write.mode("overwrite").parquet(self._path(name))

    def tables(self) -> dict[str, DataFrame]:
        """The star's tables, as in plans.star."""
        dims = {f"dim_{level}": self._read(f"dim_{level}").drop("bucket") for level in LEVELS}
        silver = self._read("silver")
        return {"stg_ads_unified": silver, "dim_plataforma": self._read("dim_plataforma"), **dims, "dim_tempo": self._read("dim_tempo"), "fato_metricas": self._read("fato_metricas").drop("_day")}

    def refresh(self, silver_of_days: DataFrame, days: list[dt.date]) -> dict[str, list]:
        """Takes over all of silver's rows of some days, and tells which partitions of each table were replaced."""
        replaced: dict[str, list] = {}
        old_silver = self._read("silver")
        new = aside(silver_of_days.where(F.col("data").isin(days)).select(*old_silver.columns), "days")
        old = old_silver.where(F.col("data").isin(days))
        changed_days = {r[0] for r in _differing(new, old).select("data").distinct().collect()}
        ads, fact_days = self._read("dim_anuncio"), set(changed_days)
        later = []
        for level in LEVELS:
            seen, dim = self._read(f"seen_{level}"), self._read(f"dim_{level}")
            mine = aside(_observations(new, level, self.buckets), "seen")
            stored_days = seen.where(F.col("day").isin(days))
            touched = aside(_differing(mine.select(*_OBSERVED, "bucket"), stored_days.select(*_OBSERVED, "bucket")).select("nk", "bucket").distinct(), "touched")
            buckets = sorted(r[0] for r in touched.select("bucket").distinct().collect())
            if not buckets:
                continue
            seen_now = aside(seen.where(F.col("bucket").isin(buckets) & ~F.col("day").isin(days)).unionByName(mine.where(F.col("bucket").isin(buckets))), "seen")
            of = lambda df, key, t=touched: df.join(t.select(F.col("nk").alias("_nk")), F.col(key).eqNullSafe(F.col("_nk")), "left_semi")
            without = lambda df, key, t=touched: df.join(t.select(F.col("nk").alias("_nk")), F.col(key).eqNullSafe(F.col("_nk")), "left_anti")
            there = dim.where(F.col("bucket").isin(buckets))
            versions = aside(_versions(of(seen_now, "nk"), level, self.buckets).select(*dim.columns), "versions")
            moved = aside(_differing(versions, of(there, f"{level}_nk")).select(F.col(f"{level}_nk").alias("nk"), "bucket").distinct(), "moved")
            dim_buckets = sorted(r[0] for r in moved.select("bucket").distinct().collect())
            later.append((f"seen_{level}", seen_now, buckets))
            if dim_buckets:
                here = F.col("bucket").isin(dim_buckets)
                dim_now = aside(without(there.where(here), f"{level}_nk").unionByName(versions.where(here)), "dim")
                later.insert(0, (f"dim_{level}", dim_now, dim_buckets))
                if level == LEVELS[-1]:
                    fact_days |= {r[0] for r in seen_now.join(moved.select(F.col("nk").alias("_nk")), F.col("nk").eqNullSafe(F.col("_nk")), "left_semi").select("day").distinct().collect()}
                    ads = ads.where(~here).unionByName(dim_now)
        if fact_days:
            where = sorted(fact_days - {None})
            silver = old_silver.where(F.col("data").isin(where) & ~F.col("data").isin(days)).unionByName(new)
            self._store_facts(silver.where(F.col("data").isin(where)), ads, where)
            replaced["fato_metricas"] = where
        for name, rows, buckets in sorted(later, key=lambda x: x[0].startswith("seen")):
            _replace(rows, self._path(name), "bucket", buckets)
            replaced[name] = buckets
        if changed_days:
            all_days = old_silver.select("data").where(~F.col("data").isin(days)).unionByName(new.select("data"))
            known = self._read("dim_plataforma").unionByName(dim_platform(new)).distinct()
            self._store_small(all_days, known.join(self._read("dim_conta").select("plataforma_sk").distinct(), "plataforma_sk", "left_semi").select("plataforma_sk", "nome"))
            _replace(new.where(F.col("data").isin(sorted(changed_days))), self._path("silver"), "data", sorted(changed_days))
            replaced["silver"] = sorted(changed_days)
        return replaced


def unioned_levels(tables: dict[str, DataFrame]) -> DataFrame:
    """All versions of all levels under each other."""
    return reduce(DataFrame.unionByName, (tables[f"dim_{x}"].select(F.lit(x).alias("level"), F.col(f"{x}_sk").alias("sk"), F.col(PARENTS[x]).alias("parent"), "external_id", "nome", "versao", "valido_de", "valido_ate", "is_atual") for x in LEVELS))
