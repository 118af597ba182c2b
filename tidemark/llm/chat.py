"""Chat formatting after cumulative-snapshot collapse, in DataFrame functions alone.

Logs often hold a conversation once for every turn: each snapshot is a prefix of the next. Turns are put in order, and
every prefix of a conversation gets a rolling hash: two running sums of a hash of (position, role, text). A conversation
whose whole hash is that of a shorter prefix of another one is dropped by an anti-join; of equal conversations the smallest
id stays. The maximal ones are rendered in parts of a bounded number of turns.

Turns are dealt to ranges of (conversation, turn, role, text) and sorted there; running positions and sums are formed within a
range and then carried over the ranges before, so a conversation with very many turns, also under one turn number, isn't one
task's work; its rendered parts aren't either. Prefixes that many conversations share are made distinct, partly before the
shuffle, so common first turns don't multiply. Everything but the sorting and the rendering works on hashes and places alone.

Defined cases: null roles and texts are empty; exact repetitions of a turn's row count once; turns with equal numbers are
ordered by role and text, null numbers come first; rows with a null conv_id are one conversation, apart from any whose id is a
text like "none"; an empty table gives an empty result; other columns are ignored. Texts are rendered as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.shared import Scratch


@dataclass(frozen=True)
class Format:
    before_role: str = "<|im_start|>"
    after_role: str = "\n"
    after_text: str = "<|im_end|>\n"
    #: Turns in one rendered part.
    part_turns: int = 64


def sorted_turns(df: DataFrame, scratch: Scratch) -> DataFrame:
    """The distinct turns with their place in the order of all: conv (the id as a key that tells null apart), conv_id, place, range, role, text."""
    turns = df.select(F.col("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    turns = turns.withColumn("conv", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")))
    # bounds of ranges reach the driver, so they hold the beginnings of roles and texts only
    ranged = turns.withColumns({"r": F.substring("role", 1, 32), "x": F.substring("text", 1, 128)}).repartitionByRange("conv", F.asc_nulls_first("turn"), "r", "x")
    placed = ranged.sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "text").select("conv", "conv_id", F.monotonically_increasing_id().alias("place"), "role", "text")
    return scratch.write(placed, "turns").withColumn("range", F.shiftright("place", 33))


def _carried(totals: DataFrame, columns: list[str]) -> DataFrame:
    """Adds what earlier ranges of the conversation sum up to, as <column>_before."""
    earlier = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("*", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in columns))


def prefixes(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """Every turn's place, conv, conv_id, position from 1, n (turns in all), lo and hi (rolling hash)."""
    keys, hashed = ["conv", "range"], turns.select("conv", "conv_id", "range", "place", F.xxhash64("role", "text").alias("t"))
    sizes = _carried(turns.groupBy(*keys).agg(F.min("place").alias("first"), F.count("*").alias("k")), ["k"])
    sizes = sizes.withColumn("n", F.sum("k").over(Window.partitionBy("conv")))
    placed = hashed.join(sizes.select(*keys, (F.col("k_before") - F.col("first") + 1).alias("shift"), "n"), keys).withColumn("position", F.col("place") + F.col("shift"))
    mark = F.xxhash64("position", "t")
    placed = scratch.write(placed.select(*keys, "conv_id", "place", "position", "n", mark.bitwiseAND(0xFFFFFFFF).alias("lo"), F.shiftrightunsigned(mark, 32).alias("hi")), "positions")
    sums = _carried(placed.groupBy(*keys).agg(F.sum("lo").alias("lo"), F.sum("hi").alias("hi")), ["lo", "hi"]).drop("lo", "hi")
    upto = Window.partitionBy(*keys).orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rolled = placed.select("*", F.sum("lo").over(upto).alias("lo_in"), F.sum("hi").over(upto).alias("hi_in")).drop("lo", "hi").join(sums, keys)
    return scratch.write(rolled.select("place", "conv", "conv_id", "position", "n", (F.col("lo_before") + F.col("lo_in")).alias("lo"), (F.col("hi_before") + F.col("hi_in")).alias("hi")), "prefixes")


def maximal(placed: DataFrame) -> DataFrame:
    """conv of the conversations that aren't prefixes of longer ones, and the smallest id of equal ones."""
    whole = placed.where("position = n").select("conv", "conv_id", "n", "lo", "hi")
    shorter = placed.where("position < n").select(F.col("position").alias("n"), "lo", "hi").distinct()
    place = F.struct(F.col("conv_id").isNull().alias("last"), "conv_id", "conv")
    one = whole.groupBy("n", "lo", "hi").agg(F.min(place).alias("x"))
    return one.join(shorter, ["n", "lo", "hi"], "left_anti").select(F.col("x.conv").alias("conv"))


def render(df: DataFrame, how: Format = Format()) -> DataFrame:
    """conv_id, part from 0, n_turns of the conversation, and the part's text, for the maximal conversations of (conv_id, turn, role, text)."""
    scratch = Scratch(df.sparkSession)
    turns = sorted_turns(df, scratch)
    placed = prefixes(turns, scratch)
    kept = placed.join(maximal(placed), "conv", "left_semi").select("place", "conv", "conv_id", "n", "position")
    shown = F.concat(F.lit(how.before_role), "role", F.lit(how.after_role), "text", F.lit(how.after_text))
    # texts meet their positions by place, which no two turns share
    rows = turns.select("place", shown.alias("shown")).join(kept, "place").select("conv", "conv_id", "n", "position", F.floor((F.col("position") - 1) / how.part_turns).alias("part"), "shown")
    parts = rows.groupBy("conv", "part").agg(F.first("conv_id").alias("conv_id"), F.first("n").alias("n_turns"), F.array_sort(F.collect_list(F.struct("position", "shown"))).alias("turns"))
    return parts.select("conv_id", "part", "n_turns", F.array_join(F.transform("turns", lambda t: t["shown"]), "").alias("text"))


ORACLE_SQL = """
WITH t AS (SELECT DISTINCT conv_id, CAST(turn AS BIGINT) turn, coalesce(role, '') r, coalesce(text, '') x FROM conversations),
c AS (SELECT conv_id, list({'r': r, 'x': x} ORDER BY turn NULLS FIRST, r, x) l FROM t GROUP BY conv_id),
kept AS (
  SELECT * FROM c a WHERE NOT EXISTS (SELECT 1 FROM c b WHERE len(b.l) > len(a.l) AND b.l[1:len(a.l)] = a.l)
  AND NOT EXISTS (SELECT 1 FROM c b WHERE b.l = a.l AND (b.conv_id < a.conv_id OR a.conv_id IS NULL AND b.conv_id IS NOT NULL))),
p AS (SELECT conv_id, l, unnest(range(0, (len(l) - 1) // 64 + 1)) AS part FROM kept)
SELECT conv_id, CAST(part AS BIGINT) part, CAST(len(l) AS BIGINT) n_turns,
  array_to_string(['<|im_start|>' || y.r || chr(10) || y.x || '<|im_end|>' || chr(10) for y in l[part * 64 + 1:part * 64 + 64]], '') AS text
FROM p
"""
