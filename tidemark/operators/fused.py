"""Checks of many tables in few scans: each table is read once, whatever the number of its checks.

Conditions on single rows can be counted while a table is written (`stored`). All other checks are about keys: a scan turns each row into
one small record for each check, (check, 128-bit hash of the key, what the row says about it), and one aggregate with partial sums judges
the keys of all checks together. Only checks of intervals need an order within their key, and their tables alone pass a window.

Two different keys of a check share a hash with a probability of about (keys squared) / 7e38.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: What each kind of check counts of a key, from the key's rows, flags, overlaps and whether a parent has it.
_VIOLATIONS = {
    "rows": "n",
    "unique": "if(n > 1, 1L, 0L)",
    "accepted": "1L",
    "current": "if(flags <> 1, 1L, 0L)",
    "relation": "if(is_parent, 0L, n)",
    "intervals": "overlaps",
}


@dataclass(frozen=True)
class Keyed:
    """A check on a table. `kind`: see the functions below; `parent` is (table, column) of a relation."""

    name: str
    table: str
    kind: str
    columns: tuple[str, ...]
    condition: Column | None = None
    flag: str | None = None
    bounds: tuple[str, str] | None = None
    parent: tuple[str, str] | None = None
    severity: str = "error"


def rows_where(name: str, table: str, violated: Column) -> Keyed:
    """Rows for which a condition holds."""
    return Keyed(name, table, "rows", (), violated)


def unique(name: str, table: str, *columns: str, nulls: bool = False) -> Keyed:
    """Keys that occur more than once; keys with nulls count only if asked."""
    known = F.lit(True) if nulls else reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns))
    return Keyed(name, table, "unique", columns, known)


def accepted_values(name: str, table: str, column: str, values: list) -> Keyed:
    """Different values outside a list."""
    return Keyed(name, table, "accepted", (column,), ~F.col(column).isin(values))


def one_current(name: str, table: str, key: str, flag: str) -> Keyed:
    """Keys without exactly one flagged row."""
    return Keyed(name, table, "current", (key,), F.lit(True), flag=flag)


def relation(name: str, table: str, column: str, parent: str, parent_column: str) -> Keyed:
    """Rows whose value, if there is one, the parent table lacks."""
    return Keyed(name, table, "relation", (column,), F.col(column).isNotNull(), parent=(parent, parent_column))


def apart(name: str, table: str, key: str, start: str, end: str) -> Keyed:
    """Intervals that begin before an earlier one of their key has ended."""
    return Keyed(name, table, "intervals", (key,), F.lit(True), bounds=(start, end))


def _record(number: int, columns: tuple[str, ...], when: Column, flag: Column | None = None, is_parent: bool = False, bounds: tuple[str, str] | None = None) -> Column:
    values = [F.col(c) for c in columns] or [F.lit(0)]
    nulls = [v.isNull() for v in values]  # the hash passes over nulls
    day = lambda c: F.col(c).cast("date") if c else F.lit(None).cast("date")
    start, end = bounds or (None, None)
    fields = F.struct(
        F.lit(number).alias("check"), F.xxhash64(*values, *nulls).alias("h1"), F.xxhash64(F.lit("second"), *nulls, *values).alias("h2"), F.lit(0 if is_parent else 1).cast("long").alias("n"),
        (flag if flag is not None else F.lit(False)).alias("flag"), F.lit(is_parent).alias("is_parent"), day(start).alias("start"), day(end).alias("end"),
    )
    return F.when(F.coalesce(when, F.lit(False)), fields)


def violations(tables: Mapping[str, DataFrame], checks: list[Keyed], known: Mapping[str, int] | None = None) -> DataFrame:
    """check, severity, violations and outcome of each check; `known` has those that were counted before."""
    known = known or {}
    spark = next(iter(tables.values())).sparkSession
    records: dict[str, list[Column]] = {}
    ordered = set()
    for i, c in enumerate(checks):
        if c.name in known:
            continue
        records.setdefault(c.table, []).append(_record(i, c.columns, c.condition, F.coalesce(F.col(c.flag), F.lit(False)) if c.flag else None, bounds=c.bounds))
        if c.parent:
            records.setdefault(c.parent[0], []).append(_record(i, (c.parent[1],), F.lit(True), is_parent=True))
        if c.bounds:
            ordered.add(c.table)
    parts = []
    for name, columns in records.items():
        rows = tables[name].select(F.explode(F.array_compact(F.array(*columns))).alias("x")).select("x.*")
        if name in ordered:
            before = Window.partitionBy("check", "h1", "h2").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
            overlap = F.coalesce(F.col("start") <= F.max("end").over(before), F.lit(False)).cast("long")
        else:
            overlap = F.lit(0).cast("long")
        parts.append(rows.withColumn("overlap", overlap).drop("start", "end"))
    listed = spark.createDataFrame([(i, c.name, c.severity, c.kind, int(known.get(c.name, 0))) for i, c in enumerate(checks)], "check int, name string, severity string, kind string, counted long")
    if parts:
        keys = reduce(DataFrame.unionByName, parts).groupBy("check", "h1", "h2").agg(F.sum("n").alias("n"), F.sum(F.col("flag").cast("long")).alias("flags"), F.max("is_parent").alias("is_parent"), F.sum("overlap").alias("overlaps"))
        kinds = {i: c.kind for i, c in enumerate(checks)}
        judged = reduce(lambda col, kind: col.when(F.col("check").isin([i for i, k in kinds.items() if k == kind]), F.expr(_VIOLATIONS[kind])), [k for k in _VIOLATIONS if k in kinds.values()], F)
        counts = keys.select("check", judged.alias("v")).groupBy("check").agg(F.sum("v").alias("v"))
        listed = listed.join(counts, "check", "left").withColumn("counted", F.coalesce("v", "counted"))
    outcome = F.when(F.col("counted") == 0, "pass").otherwise(F.when(F.col("severity") == "warn", "warn").otherwise("fail"))
    return listed.select(F.col("name").alias("check"), "severity", F.col("counted").alias("violations"), outcome.alias("outcome"))


def stored(df: DataFrame, path: str, checks: list[Keyed]) -> tuple[DataFrame, dict[str, int], int]:
    """Writes a table and counts, on the way, the rows that violate its row checks: (table as stored, violations by check, rows).

    The counts come from the tasks that write, so each row counts once even where lost tasks are repeated.
    """
    own = [c for c in checks if c.kind == "rows"]
    seen = Observation()
    counts = [F.count_if(F.coalesce(c.condition, F.lit(False))).alias(f"c{i}") for i, c in enumerate(own)]
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), {c.name: seen.get[f"c{i}"] for i, c in enumerate(own)}, seen.get["rows"]
