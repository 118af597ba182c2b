"""Matches of patterns in a text whose lines are rows, also where a match reaches from one row into the next; each counts once.

A border between two rows is clean if no match reaches over it: the matches at every start near the border are the same in both rows
alone as in the two together. Between clean borders, stretches of the text are searched each for itself, and almost always a stretch is a
single row. Rows around unclean borders are joined, as many as hang together, and searched as one text.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordering import numbered


def _starts(text: Column, pattern: str) -> Column:
    """What matches at every start, whether or not these matches overlap."""
    return F.regexp_extract_all(text, F.lit(f"(?=({pattern}))"), F.lit(1))


def _inline(pattern: str) -> str:
    """A pattern with its leading flags kept to itself."""
    flags = re.match(r"\(\?[A-Za-z]+\)", pattern)
    return f"{flags[0][:-1]}:{pattern[flags.end() :]})" if flags else f"(?:{pattern})"


def pattern_counts(rows: DataFrame, patterns: Mapping[str, str], path: str, reach: int = 64, position: str = "position", text: str = "text") -> DataFrame:
    """pattern and its matches in the text that rows of (position from 1 without gaps, text) form, joined by line feeds.

    `reach`: more characters than any match can have on either side of a border. Null texts are empty rows. `path`: a folder for work.
    """
    lines = rows.select(F.col(position).cast("long").alias("p"), F.coalesce(text, F.lit("")).alias("t"))
    ends = lines.select("p", F.right("t", F.lit(reach)).alias("tail"), F.substring("t", 1, reach).alias("head"))
    following = ends.select((F.col("p") - 1).alias("p"), F.col("head").alias("next"))
    both = ends.join(following, "p")
    # the line feed belongs to the row before it; an empty row lets a match reach further, so its border isn't clean
    differ = [_starts(F.concat("tail", F.lit("\n"), "next"), _inline(x)) != F.concat(_starts(F.concat("tail", F.lit("\n")), _inline(x)), _starts(F.col("next"), _inline(x))) for x in patterns.values()]
    short = (F.col("next") == "") | (F.col("tail") == "")
    unclean = both.where(reduce(lambda a, b: a | b, differ, short)).select("p")
    # consecutive unclean borders have one difference between place and rank
    runs = numbered(unclean, ["p"], path).groupBy((F.col("p") - F.col("position")).alias("g")).agg(F.min("p").alias("first"), F.max("p").alias("last"))
    members = runs.select("first", F.explode(F.sequence("first", F.col("last") + 1)).alias("p"))
    met = lines.join(members, "p", "left")
    joined = met.where(F.col("first").isNotNull()).groupBy("first").agg(F.array_sort(F.collect_list(F.struct("p", "t"))).alias("x")).select(F.array_join(F.transform("x", lambda r: r["t"]), "\n").alias("t"), F.element_at("x", -1)["p"].alias("p"))
    stretches = met.where(F.col("first").isNull()).select("t", "p").unionByName(joined)
    # each stretch but the text's last ends with its line feed
    last = lines.agg(F.max("p")).scalar()
    whole = stretches.select(F.when(F.col("p") < last, F.concat("t", F.lit("\n"))).otherwise(F.col("t")).alias("t"))
    names = list(patterns)
    counts = whole.agg(*(F.coalesce(F.sum(F.regexp_count("t", F.lit(x))), F.lit(0)).cast("long").alias(f"c{i}") for i, x in enumerate(patterns.values())))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(n).alias("pattern"), F.col(f"c{i}").alias("matches")) for i, n in enumerate(names)))).alias("x")).select("x.*")
