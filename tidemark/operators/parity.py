"""Keyed comparison of two tables: what is new, removed, changed or identical, and by how much fields differ."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import percent_change
from tidemark.operators.ordering import numbered


def keyed_diff(before: DataFrame, after: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """keys, status (NEW, REMOVED, CHANGED, IDENTICAL, or DUPLICATE where a side has the key more than once). Order plays no part."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*(F.col(k).alias(f"{name}_key_{k}") for k in keys)).agg(F.count("*").alias(f"{name}_n"), *(F.min(f).alias(f"{name}_{f}") for f in fields))

    match = reduce(lambda x, y: x & y, (F.col(f"before_key_{k}").eqNullSafe(F.col(f"after_key_{k}")) for k in keys))
    both = side(before, "before").join(side(after, "after"), match, "full_outer")
    same = reduce(lambda x, y: x & y, (F.col(f"before_{f}").eqNullSafe(F.col(f"after_{f}")) for f in fields))
    status = F.when((F.col("before_n") > 1) | (F.col("after_n") > 1), "DUPLICATE").when(F.col("before_n").isNull(), "NEW").when(F.col("after_n").isNull(), "REMOVED").when(same, "IDENTICAL").otherwise("CHANGED")
    return both.select(*(F.coalesce(f"before_key_{k}", f"after_key_{k}").alias(k) for k in keys), status.alias("status"), *(F.col(f"{s}_{f}") for f in fields for s in ("before", "after")))


def field_deltas(diff: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """One row for each field that changed: before, after, delta and percent change (null without a base)."""
    long = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"before_{f}").cast("decimal(20,6)").alias("before"), F.col(f"after_{f}").cast("decimal(20,6)").alias("after")) for f in fields))).alias("x")
    rows = diff.where("status = 'CHANGED'").select(*keys, long).select(*keys, "x.*").where(~F.col("before").eqNullSafe(F.col("after")))
    return rows.withColumn("delta", F.col("after") - F.col("before")).withColumn("percent", percent_change("before", "after"))


def row_multiplicities(before: DataFrame, after: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Each distinct row with how often either side has it. One aggregate over both sides, with partial sums before the shuffle; nulls are values."""
    side = lambda df, n: df.select(*keys, *fields, F.lit(n).alias("_side"))
    both = side(before, 0).unionByName(side(after, 1))
    return both.groupBy(*keys, *fields).agg(F.count_if(F.col("_side") == 0).alias("n_before"), F.count_if(F.col("_side") == 1).alias("n_after"))


def multiset_diff(before: DataFrame, after: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """keys, and how many of the key's rows are identical, changed, new and removed. A key may have many rows, or be null.

    Rows of one key are matched as multisets: equal rows are identical, as often as both sides have them. Of what is left over, as many
    as possible are changed, and the rest of the larger side is new or removed.
    """
    same = F.least("n_before", "n_after")
    sums = row_multiplicities(before, after, keys, fields).groupBy(*keys).agg(F.sum(same).alias("identical"), F.sum(F.col("n_before") - same).alias("b"), F.sum(F.col("n_after") - same).alias("a"))
    changed = F.least("b", "a")
    return sums.select(*keys, "identical", changed.alias("changed"), (F.col("a") - changed).alias("new"), (F.col("b") - changed).alias("removed"))


def multiset_pairs(before: DataFrame, after: DataFrame, keys: list[str], fields: list[str], path: str) -> DataFrame:
    """The rows that multiset_diff leaves over, one before and one after in each: keys, position within the key, status, before_* and after_* fields.

    Leftover rows of a key are paired by their rank in the order of the fields. Ranks come from ranges, so a key with very many rows
    isn't one task's work. `path`: a folder for the ranked rows.
    """
    counts = row_multiplicities(before, after, keys, fields)
    surplus = F.col("n_before") - F.col("n_after")
    over = counts.where(surplus != 0).select(*keys, *fields, (surplus < 0).cast("int").alias("_side"), F.explode(F.sequence(F.lit(1).cast("long"), F.abs(surplus))).alias("_copy")).drop("_copy")
    ranked = numbered(over, fields, path, by=[*keys, "_side"])
    of = lambda n: F.max(F.when(F.col("_side") == n, F.struct(*fields)))
    pairs = ranked.groupBy(*keys, "position").agg(of(0).alias("b"), of(1).alias("a"))
    status = F.when(F.col("b").isNull(), "NEW").when(F.col("a").isNull(), "REMOVED").otherwise("CHANGED")
    return pairs.select(*keys, "position", status.alias("status"), *(F.col(f"{x[0]}.{f}").alias(f"{x}_{f}") for f in fields for x in ("before", "after")))


def _shown(column: Column, kind: str) -> Column:
    """A value as text: exact, without trailing zeros of decimals; an absent one is told from an empty one."""
    text = column.cast("string")
    if kind.startswith("decimal") and not kind.endswith(",0)"):
        text = F.regexp_replace(text, r"\.?0+$", "")
    return F.coalesce(text, F.lit("(none)"))


def ordered_report(blocks: dict[str, tuple[DataFrame, list[str], list[str]]], path: str) -> DataFrame:
    """The report on several comparisons, name -> (keyed diff or pairs, keys, fields), as numbered lines.

    A block begins with the number of rows of each status; then come new keys, removed keys, and each changed field with both values,
    delta and percent change. The order depends on contents alone: block, section, key, field, values. Each comparison is stored below
    `path`, as its rows and their totals are read more than once.
    """
    lines = []
    for i, (name, (compared, keys, fields)) in enumerate(blocks.items()):
        compared.write.parquet(f"{path}/block-{i}")
        diff = compared.sparkSession.read.schema(compared.schema).parquet(f"{path}/block-{i}")
        kinds = dict(diff.dtypes)
        key = F.concat_ws(" | ", *(_shown(F.col(k), kinds[k]) for k in keys))
        none, number_of_none = F.lit(None).cast("string"), F.lit(None).cast("decimal(38,6)")
        number = lambda c, k=kinds: F.col(c).cast("decimal(38,6)") if k[c].startswith(("decimal", "int", "bigint", "smallint", "tinyint", "double", "float")) else F.lit(None).cast("decimal(38,6)")

        def line(section, field=none, before=none, after=none, x=number_of_none, y=number_of_none) -> Column:
            return F.struct(F.lit(section).alias("section"), field.alias("field"), before.alias("before"), after.alias("after"), x.alias("x"), y.alias("y"))

        changed = F.array_compact(F.array(*(F.when(~F.col(f"before_{f}").eqNullSafe(F.col(f"after_{f}")), line(3, F.lit(f), _shown(F.col(f"before_{f}"), kinds[f"before_{f}"]), _shown(F.col(f"after_{f}"), kinds[f"after_{f}"]), number(f"before_{f}"), number(f"after_{f}"))) for f in fields)))
        of_row = F.when(F.col("status") == "NEW", F.array(line(1))).when(F.col("status") == "REMOVED", F.array(line(2))).when(F.col("status") == "CHANGED", changed)
        block = F.lit(name).alias("block")
        totals = diff.groupBy("status").agg(F.count("*").alias("n")).select(block, F.lit(0).alias("section"), "status", none.alias("key"), none.alias("field"), none.alias("before"), F.col("n").cast("string").alias("after"), number_of_none.alias("x"), number_of_none.alias("y"))
        lines += [totals, diff.select(block, "status", key.alias("key"), F.explode(of_row).alias("e")).select("block", "e.section", "status", "key", "e.field", "e.before", "e.after", "e.x", "e.y")]
    delta = F.col("y") - F.col("x")
    rows = reduce(DataFrame.unionByName, lines).select("block", "section", "status", "key", "field", "before", "after", delta.alias("delta"), percent_change("x", "y").alias("percent"))
    return numbered(rows, ["block", "section", "key", "field", "before", "after", "status"], f"{path}/lines")


def diff_report(diff: DataFrame) -> DataFrame:
    """Rows of each status."""
    return diff.groupBy("status").agg(F.count("*").alias("rows"))


def key_difference(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Keys on one side alone, and which."""
    a, b = before.select(*keys).distinct(), after.select(*keys).distinct()
    return b.join(a, keys, "left_anti").withColumn("side", F.lit("NEW")).unionByName(a.join(b, keys, "left_anti").withColumn("side", F.lit("REMOVED")))


def drift_by_group(before: DataFrame, after: DataFrame, keys: list[str], day: str, metrics: list[str], window: tuple[str, str], by: str) -> DataFrame:
    """Sums of each metric before and after, for days the window re-extracts, new days and the rest as control."""
    tagged = lambda df, s: df.select(*keys, F.col(day), F.col(by), F.lit(s).alias("_side"), *metrics)
    known = before.select(F.col(day)).distinct().withColumn("_known", F.lit(True))
    rows = tagged(before, 0).unionByName(tagged(after, 1)).join(known, day, "left")
    group = F.when(F.col("_known").isNull(), "new").when(F.col(day).between(*(F.lit(w).cast("date") for w in window)), "reextracted").otherwise("control")
    of = lambda m, s: F.coalesce(F.sum(F.when(F.col("_side") == s, F.col(m))), F.lit(0))
    return rows.groupBy(F.col(by), group.alias("date_group")).agg(*((of(m, 1) - of(m, 0)).alias(f"delta_{m}") for m in metrics))
