"""Atomic loads into an append-only raw table, by many loaders at once and with retries.

Each attempt to load a batch writes a folder of its own. What commits it is a marker file for the batch, which is created only if it is
absent and names the attempt: of several attempts at a batch one wins, a repeated load of a committed batch does nothing, and readers see
all of a batch or none of it. Attempts that no marker names are orphans of loads that died; a sweep removes them once they are old
enough that no load can still be writing them.

The marker relies on the file system's exclusive creation, as HDFS, local disks and most object stores offer it.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import raw

_ROWS = "extracted_at timestamp, payload variant, batch_id string, attempt string, source string, reference_date date"


class CommittedBatches:
    """The raw table below a folder, with its markers."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.data, self.markers = f"{folder.rstrip('/')}/batches", f"{folder.rstrip('/')}/commits"

    def _at(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _delete(self, path: str) -> None:
        fs, where = self._at(path)
        fs.delete(where, True)

    def winner(self, batch_id: str) -> str | None:
        """The attempt that the batch's marker names; none if there is no marker or its writer died before it had named any."""
        fs, where = self._at(f"{self.markers}/{batch_id}")
        if not fs.exists(where):
            return None
        stream = fs.open(where)
        try:
            return bytes(stream.readAllBytes()).decode() or None
        finally:
            stream.close()

    def _put_if_absent(self, batch_id: str, attempt: str) -> bool:
        fs, where = self._at(f"{self.markers}/{batch_id}")
        try:
            stream = fs.create(where, False)
        except Exception as failure:  # noqa: BLE001
            if fs.exists(where):
                return False
            raise OSError(f"the marker of {batch_id} can't be written") from failure
        try:
            stream.write(bytearray(attempt.encode()))
        finally:
            stream.close()
        return True

    def write_attempt(self, rows: DataFrame, batch_id: str) -> str:
        """Writes rows of (source, reference_date, extracted_at, payload) where no reader sees them yet; returns the attempt's name."""
        attempt = uuid.uuid4().hex
        kept = rows.select("extracted_at", "payload", "source", "reference_date").hint("rebalance", "source", "reference_date")
        kept.write.partitionBy("source", "reference_date").parquet(f"{self.data}/batch_id={batch_id}/attempt={attempt}")
        return attempt

    def commit(self, batch_id: str, attempt: str) -> bool:
        """Whether this attempt became the batch's; the rows of one that lost are removed."""
        if self._put_if_absent(batch_id, attempt) or self.winner(batch_id) == attempt:
            return True
        self._delete(f"{self.data}/batch_id={batch_id}/attempt={attempt}")
        return False

    def load(self, parts: list[DataFrame], batch_id: str) -> bool:
        """Loads the rows of several sources as one batch. False: the batch had been committed before, or another attempt was faster."""
        if not re.fullmatch(r"[A-Za-z0-9_-][A-Za-z0-9._-]*", batch_id) or batch_id.startswith("_"):
            raise ValueError(f"{batch_id!r} can't name a file")
        if self.winner(batch_id):
            return False
        rows = reduce(DataFrame.unionByName, parts).withColumn("batch_id", F.lit(batch_id))
        if broken := raw.constraint_violations(rows).select("problem").distinct().collect():
            raise ValueError("; ".join(sorted(r["problem"] for r in broken)))
        return self.commit(batch_id, self.write_attempt(rows, batch_id))

    def commits(self) -> DataFrame:
        """(batch_id, attempt) of all markers."""
        fs, where = self._at(self.markers)
        if not fs.exists(where):
            return self.spark.createDataFrame([], "batch_id string, attempt string")
        return self.spark.read.text(self.markers).select(F.col("_metadata.file_name").alias("batch_id"), F.col("value").alias("attempt")).where("attempt <> ''")

    def rows(self) -> DataFrame:
        """The rows of all committed batches. Folders of others are pruned where the markers are few enough to be broadcast."""
        fs, where = self._at(self.data)
        if not fs.exists(where):
            return self.spark.createDataFrame([], _ROWS).drop("attempt")
        return self.spark.read.schema(_ROWS).parquet(self.data).join(self.commits(), ["batch_id", "attempt"], "left_semi").drop("attempt")

    def sweep(self, older_than: dt.timedelta = dt.timedelta(days=1)) -> list[str]:
        """Removes attempts, and markers without any, that are older than any load takes; returns what went."""
        before = (dt.datetime.now(dt.UTC) - older_than).timestamp() * 1000
        gone = []
        fs, pattern = self._at(f"{self.data}/batch_id=*/attempt=*")
        for status in fs.globStatus(pattern) or []:
            path = status.getPath()
            batch_id, attempt = path.getParent().getName().split("=", 1)[1], path.getName().split("=", 1)[1]
            if status.getModificationTime() <= before and self.winner(batch_id) != attempt:
                fs.delete(path, True)
                gone.append(f"{batch_id}/{attempt}")
        fs, pattern = self._at(f"{self.markers}/*")
        for status in fs.globStatus(pattern) or []:
            if status.getLen() == 0 and status.getModificationTime() <= before:
                fs.delete(status.getPath(), False)
                gone.append(status.getPath().getName())
        return sorted(gone)
