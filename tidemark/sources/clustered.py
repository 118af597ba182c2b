"""A flat fact clustered by month and by ranges of its key, with a small table of what each file holds.

The table of statistics (file, rows, least and greatest key and day) is what a query asks first: the last days, or one key's history, are
then read from the files that can hold them, and no other file is opened.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class ClusteredFact:
    """The fact below a folder."""

    def __init__(self, spark: SparkSession, folder: str, key: str = "anuncio_id", day: str = "data") -> None:
        self.spark, self.key, self.day, self._schema = spark, key, day, None
        self.path, self.statistics_path = f"{folder.rstrip('/')}/fact", f"{folder.rstrip('/')}/statistics"

    def write(self, df: DataFrame, files: int = 32) -> None:
        """Writes the fact and its statistics. `files`: ranges of (month, key); a month or a key of many rows spans several."""
        month = F.trunc(self.day, "month")
        ranged = df.withColumn("_month", month).repartitionByRange(files, "_month", self.key, self.day).sortWithinPartitions("_month", self.key, self.day)
        self._schema = None
        ranged.drop("_month").write.mode("overwrite").option("compression", "snappy").parquet(self.path)
        rows = self.spark.read.parquet(self.path).select(F.col("_metadata.file_path").alias("file"), self.key, self.day)
        least, most = (lambda c: F.min(c).alias(f"least_{c}")), (lambda c: F.max(c).alias(f"most_{c}"))
        stats = rows.groupBy("file").agg(F.count("*").alias("rows"), least(self.key), most(self.key), least(self.day), most(self.day))
        stats.coalesce(1).write.mode("overwrite").parquet(self.statistics_path)

    def rows(self) -> DataFrame:
        """All rows. The schema is read once."""
        if self._schema is None:
            self._schema = self.spark.read.parquet(self.path).schema
        return self.spark.read.schema(self._schema).parquet(self.path)

    def statistics(self) -> DataFrame:
        fields = {f.name: f.dataType.simpleString() for f in self.rows().schema.fields}
        bounds = ", ".join(f"{b}_{c} {fields[c]}" for c in (self.key, self.day) for b in ("least", "most"))
        return self.spark.read.schema(f"file string, rows bigint, {bounds}").parquet(self.statistics_path)

    def _of(self, files: list) -> DataFrame:
        """The rows of some files; their names are collected, as a file listing is."""
        return self.spark.read.schema(self.rows().schema).parquet(*(r["file"] for r in files)) if files else self.rows().where("false")

    def last_days(self, days: int = 7) -> DataFrame:
        """The rows of the last days that the fact holds."""
        stats, most = self.statistics(), f"most_{self.day}"
        newest = stats.agg(F.max(most)).scalar()
        files = stats.where(F.col(most) >= F.date_sub(newest, days - 1)).select("file", most).collect()
        first = max((r[most] for r in files), default=None)
        return self._of(files).where(F.col(self.day) > F.date_sub(F.lit(first), days))

    def history(self, key) -> DataFrame:
        """The rows of one key."""
        held = F.lit(key).between(F.col(f"least_{self.key}"), F.col(f"most_{self.key}"))
        return self._of(self.statistics().where(held).select("file").collect()).where(F.col(self.key) == key)
