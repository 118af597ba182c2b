"""A prefix trie over conversations, built by burst tries.

Turns become ids (two 64-bit hashes of role and text), in order. A container holds the suffixes of the conversations under one
trie head, which is a prefix of turns; at first there is one under the root. A container of more turns than a task should hold
bursts: its conversations go to a container for each next turn id, and its head becomes a node of the trie's upper part. One
round bursts all oversized containers, over 1, 2, 4, ... levels at once. Containers that are left are dealt to tasks, their
suffixes sorted, and one sweep along the sorted suffixes closes the nodes. A conversation alone under its head is a chain of
nodes, written without being gathered.

A path is the XOR of hashes of (depth, turn id), in 128 bits, so heads meet by a plain aggregate with map-side sums, and a
parent's path is one XOR away. Within a depth, a node's smallest member names it. Sums over subtrees of the upper part run
along conversations: what a node or a swept container contributes is laid on its smallest member at its depth, summed from
below along that conversation, and added up for each node.

Defined cases: rows with a null conv_id take no part; null roles and texts are empty; turns go by number, null first, and
equal numbers by role and text; repeated rows are turns of their own; a conversation without turns is a member of the root;
an empty table gives an empty result; other columns are ignored. Conversations and groups of copies may be of any size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.shared import Scratch, bounded_batches


@dataclass(frozen=True)
class Trie:
    #: A container of more turns bursts, unless it holds a single conversation.
    container_turns: int = 512
    #: Most levels that one round bursts.
    most_levels: int = 1024
    #: Ids of a node's ends that are joined at a time.
    ids_at_once: int = 4096
    #: Turns of a conversation that are summed up at a time.
    summed_turns: int = 1024


NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_NOTHING = hashlib.sha256(b"").hexdigest()


def ordered(df: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, position from 1, t1, t2, chars) of (conv_id, turn, role, text). Ranges deal out long conversations; texts are shuffled once."""
    rows = df.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    # bounds of ranges reach the driver, so they hold the beginnings of roles and texts only
    ranged = rows.withColumns({"r": F.substring("role", 1, 32), "x": F.substring("text", 1, 128)}).repartitionByRange("conv_id", F.asc_nulls_first("turn"), "r", "x")
    placed = ranged.sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text").withColumn("place", F.monotonically_increasing_id())
    ids = {"t1": F.xxhash64("role", "text"), "t2": F.xxhash64(F.lit("turn"), "text", "role")}
    table = scratch.write(placed.select("conv_id", "place", *(v.alias(k) for k, v in ids.items()), F.char_length("text").cast("long").alias("chars")), "places")
    part = F.shiftright("place", 33)
    parts = table.groupBy("conv_id", part.alias("part")).agg(F.min("place").alias("first"), F.count("*").alias("k"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("conv_id", "part", (F.coalesce(F.sum("k").over(earlier), F.lit(0)) - F.col("first") + 1).alias("shift"))
    numbered = table.withColumn("part", part).join(starts, ["conv_id", "part"])
    return scratch.write(numbered.select("conv_id", (F.col("place") + F.col("shift")).alias("position"), "t1", "t2", "chars"), "own")


def _marked(turns: DataFrame) -> DataFrame:
    """Turns with the hashes of (depth, turn id) that paths consist of."""
    return turns.select("conv_id", "depth", "n", F.xxhash64("depth", "t1", "t2").alias("m1"), F.xxhash64(F.lit("path"), "t2", "depth", "t1").alias("m2"), "chars")


def plain(own: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Conversations as they are: their turns (conv_id, depth, n, m1, m2, chars), and (conv_id, n) of all."""
    sizes = scratch.write(own.groupBy("conv_id").agg(F.max("position").alias("n")), "sizes")
    return scratch.write(_marked(own.withColumnRenamed("position", "depth").join(sizes, "conv_id")), "turns"), sizes


def spliced(own: DataFrame, source: Column, shared: Column, most: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Every conversation with its first `shared` turns taken from another one, `source`; both depend on conv_id, shared is at most `most`.

    Where the source has fewer turns or isn't there, those that it has are taken.
    """
    first = own.where(F.col("position") <= most).groupBy(F.col("conv_id").alias("source")).agg(F.array_sort(F.collect_list(F.struct("position", "t1", "t2", "chars"))).alias("head"))
    all_ids = own.groupBy("conv_id").agg(F.max("position").alias("own_n")).withColumns({"source": source, "h": shared.cast("long")})
    taken = F.slice("head", 1, F.col("h").cast("int"))
    met = all_ids.join(first, "source", "left").withColumn("head", F.coalesce(taken, F.slice(F.array(F.struct(*(F.lit(0).cast("long").alias(c) for c in ("position", "t1", "t2", "chars")))), 1, 0)))
    k = F.size("head").cast("long")
    known = scratch.write(met.select("conv_id", "h", "head", k.alias("k"), (k + F.greatest(F.col("own_n") - F.col("h"), F.lit(0))).alias("n")), "sizes")
    heads = known.select("conv_id", "n", F.explode("head").alias("x")).select("conv_id", F.col("x.position").alias("depth"), "n", "x.t1", "x.t2", "x.chars")
    rest = own.where(F.col("position") > shared).join(known.select("conv_id", "h", "k", "n"), "conv_id").select("conv_id", (F.col("position") - F.col("h") + F.col("k")).alias("depth"), "n", "t1", "t2", "chars")
    return scratch.write(_marked(heads.unionByName(rest)), "turns"), known.select("conv_id", "n")


def _burst(turns: DataFrame, root: int, how: Trie, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Nodes that stand below a burst head, `big` if they burst themselves; and where conversations pass such nodes.

    Nodes: depth, c (smallest member), k (members), chars, parent_c, big. Passages: conv_id, depth, n, c, k, parent_c, big, p1, p2.
    """
    spark = turns.sparkSession
    key = ["depth", "p1", "p2"]
    parents = spark.createDataFrame([(0, 0, 0, root)], "depth long, p1 long, p2 long, c long")
    nodes, passages, active, done, levels = [], [], None, 0, 1
    while True:
        near = turns.where((F.col("depth") > done) & (F.col("depth") <= done + levels))
        if active is None:
            rows = near.withColumns({"p1": F.col("m1"), "p2": F.col("m2")})
        else:
            upto = Window.partitionBy("conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
            along = lambda m, h: F.bit_xor(m).over(upto).bitwiseXOR(F.col(h))
            rows = near.join(active, "conv_id").withColumns({"p1": along("m1", "h1"), "p2": along("m2", "h2")})
        rows = rows.select("conv_id", *key, "n", "chars", F.col("p1").bitwiseXOR(F.col("m1")).alias("q1"), F.col("p2").bitwiseXOR(F.col("m2")).alias("q2"))
        size = F.sum(F.col("n") - F.col("depth") + 1)
        found = rows.groupBy(*key, "q1", "q2").agg(F.min("conv_id").alias("c"), F.count("*").alias("k"), size.alias("size"), F.min("chars").alias("chars"))
        found = scratch.write(found.withColumn("big", (F.col("size") > how.container_turns) & (F.col("k") > 1)), "found")
        # below a container's head there are no nodes yet: its sizes fall along every path, so a big parent has big ancestors only
        above = parents.unionByName(found.where("big").select(*key, "c")).select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("c").alias("parent_c"))
        real = scratch.write(found.join(above, ["depth", "q1", "q2"]).select(*key, "c", "k", "chars", "parent_c", "big"), "nodes")
        met = scratch.write(rows.select("conv_id", *key, "n").join(real.drop("chars"), key), "passages")
        nodes.append(real.drop("p1", "p2"))
        passages.append(met)
        done, levels = done + levels, min(2 * levels, how.most_levels)
        onward = met.where(F.col("big") & (F.col("depth") == done) & (F.col("n") > done))
        active = onward.select("conv_id", F.col("p1").alias("h1"), F.col("p2").alias("h2"))
        parents = real.where(F.col("big") & (F.col("depth") == done)).select(*key, "c")
        if onward.isEmpty():
            break
    return reduce(DataFrame.unionByName, nodes), reduce(DataFrame.unionByName, passages)


class _Sweep:
    """Closes the nodes of one container along its sorted suffixes."""

    def __init__(self, top: int, parent: int) -> None:
        self.top, self.parent = top, parent
        self.open: list[dict] = []
        self.closed: list[dict] = []
        self.before: list = []

    def _close(self, upto: int) -> None:
        while len(self.open) > upto:
            node = self.open.pop()
            node["leaves"] = node["leaves"] or 1
            node["saved"] += (node["n"] - 1) * node["chars"]
            self.closed.append(node)
            if self.open:
                above = self.open[-1]
                above["c"] = min(above["c"], node["c"])
                above["n"] += node["n"]
                above["children"] += 1
                above["leaves"] += node["leaves"]
                above["saved"] += node["saved"]

    def add(self, conv: int, suffix: list, chars: list[int]) -> None:
        same = next((i for i, (a, b) in enumerate(zip(self.before, suffix, strict=False)) if a != b), min(len(self.before), len(suffix)))
        self._close(same)
        for size in chars[same:]:
            self.open.append({"depth": self.top + len(self.open), "above": self.open[-1] if self.open else None, "c": conv, "n": 0, "children": 0, "leaves": 0, "saved": 0, "chars": size, "ends": []})
        last = self.open[-1]
        last["ends"].append(str(conv))
        last["n"] += 1
        last["c"] = min(last["c"], conv)
        self.before = suffix

    def rows(self) -> Iterator[tuple]:
        self._close(0)
        for x in self.closed:
            ends = hashlib.sha256(",".join(x["ends"]).encode()).hexdigest()
            yield x["c"], x["depth"], x["above"]["c"] if x["above"] else self.parent, x["n"], x["children"], x["leaves"], x["saved"], ends, x["above"] is None


def _swept(turns: DataFrame, passages: DataFrame) -> DataFrame:
    """The nodes of containers of several conversations, `top` for their heads."""
    held = passages.where(~F.col("big") & (F.col("k") > 1)).select("conv_id", F.col("depth").alias("head"), "p1", "p2", "parent_c")
    # each container's rows go to one task, whatever their number of conversations: it has a bounded number of turns
    dealt = turns.join(held, "conv_id").where("depth >= head").select("head", "p1", "p2", "parent_c", "conv_id", "depth", "m1", "m2", "chars").repartition("head", "p1", "p2")
    suffixes = dealt.groupBy("head", "p1", "p2", "conv_id").agg(F.first("parent_c").alias("parent_c"), F.array_sort(F.collect_list(F.struct("depth", "m1", "m2", "chars"))).alias("t"))
    laid = suffixes.select("head", "p1", "p2", "parent_c", "conv_id", F.transform("t", lambda x: F.struct(x["m1"].alias("m1"), x["m2"].alias("m2"))).alias("suffix"), F.transform("t", lambda x: x["chars"]).alias("chars"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sweep = None, None
        names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "top"]
        for batch in _ended(batches):
            out: list[tuple] = []
            for x in batch.to_pylist() if batch is not None else [None]:
                key = x and (x["head"], x["p1"], x["p2"])
                if key != now or x is None:
                    if sweep:
                        out += sweep.rows()
                    now, sweep = key, x and _Sweep(x["head"], x["parent_c"])
                if x:
                    sweep.add(x["conv_id"], x["suffix"], x["chars"])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), [pa.int64()] * 7 + [pa.string(), pa.bool_()], strict=True)], names=names)

    bounded_batches(turns.sparkSession)
    return laid.sortWithinPartitions("head", "p1", "p2", "suffix", "conv_id").mapInArrow(run, f"{NODE}, top boolean")


def _ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    """The batches and then None."""
    yield from batches
    yield None


def _chains(turns: DataFrame, passages: DataFrame) -> DataFrame:
    """The nodes of conversations that are alone under their head."""
    alone = passages.where(~F.col("big") & (F.col("k") == 1)).select("conv_id", F.col("depth").alias("head"), "parent_c")
    last = F.col("depth") == F.col("n")
    one = F.lit(1).cast("long")
    return turns.join(alone, "conv_id").where("depth >= head").select(
        "conv_id", "depth", F.when(F.col("depth") == F.col("head"), F.col("parent_c")).otherwise(F.col("conv_id")).alias("parent_conv_id"), one.alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("long").alias("n_children"), one.alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.when(last, F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(_NOTHING).alias("ends_sha256"), (F.col("depth") == F.col("head")).alias("top"))


def _hashed_ends(ends: DataFrame, how: Trie) -> DataFrame:
    """(depth, c, ends_sha256) of (depth, c, conv_id): ranges of ids are joined to texts first, and one pass over those hashes them."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []
        for batch in _ended(batches):
            out: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True) if batch is not None else [(None,) * 3]:
                if row[:2] != key or len(ids) >= how.ids_at_once:
                    if ids:
                        out.append((*key, ids[0], ",".join(map(str, ids))))
                    key, ids = row[:2], []
                ids.append(row[2])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["depth", "c", "least", "shown"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in _ended(batches):
            out: list[tuple] = []
            for depth, c, shown in zip(*(batch.column(n).to_pylist() for n in ("depth", "c", "shown")), strict=True) if batch is not None else [(None,) * 3]:
                if (depth, c) != key:
                    if state:
                        out.append((*key, state.hexdigest()))
                    key, state = (depth, c), hashlib.sha256(shown.encode()) if shown is not None else None
                else:
                    state.update(b"," + shown.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["depth", "c", "ends_sha256"])

    keys = ["depth", "c", "conv_id"]
    joined = ends.select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(join, "depth long, c long, least long, shown string")
    return joined.repartition("depth", "c").sortWithinPartitions("depth", "c", "least").select("depth", "c", "shown").mapInArrow(digest, "depth long, c long, ends_sha256 string")


def _from_below(rows: DataFrame, columns: list[str], how: Trie) -> DataFrame:
    """Sums from each depth downwards along a conversation, in buckets of depths so that none is one task's work."""
    bucketed = rows.withColumn("bucket", F.floor(F.col("depth") / how.summed_turns))
    deeper = Window.partitionBy("conv_id").orderBy("bucket").rowsBetween(1, Window.unboundedFollowing)
    totals = bucketed.groupBy("conv_id", "bucket").agg(*(F.sum(c).alias(c) for c in columns))
    totals = totals.select("conv_id", "bucket", *(F.coalesce(F.sum(c).over(deeper), F.lit(0)).alias(f"{c}_deeper") for c in columns))
    inside = Window.partitionBy("conv_id", "bucket").orderBy("depth").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    summed = bucketed.select("conv_id", "bucket", "depth", "c", *(F.sum(c).over(inside).alias(c) for c in columns)).join(totals, ["conv_id", "bucket"])
    return summed.select("depth", "c", *((F.col(c) + F.col(f"{c}_deeper")).alias(c) for c in columns))


def build(turns: DataFrame, sizes: DataFrame, scratch: Scratch, how: Trie = Trie()) -> DataFrame:
    """A row for each node, as in NODE, of turns (conv_id, depth, n, m1, m2, chars) and all conversations (conv_id, n)."""
    spark = turns.sparkSession
    root, members = sizes.agg(F.min("conv_id"), F.count("*")).first()
    if not members:
        return spark.createDataFrame([], NODE)
    nodes, passages = _burst(turns, root, how, scratch)
    low = scratch.write(_swept(turns, passages).unionByName(_chains(turns, passages)), "low")
    heads, crossed = nodes.where("big"), passages.where("big")
    children = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("parent_c").alias("c")).agg(F.count("*").alias("n_children"))
    upper = scratch.write(heads.join(children, ["depth", "c"], "left").select("depth", "c", "k", "parent_c", "chars", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children")), "upper")
    given = upper.select(F.col("c").alias("conv_id"), "depth", (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("k") - 1) * F.col("chars")).alias("saved"))
    given = given.unionByName(low.where("top and depth > 1").select("conv_id", (F.col("depth") - 1).alias("depth"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved")))
    given = given.groupBy("conv_id", "depth").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    along = crossed.select("conv_id", "depth", "c").join(given, ["conv_id", "depth"], "left").fillna(0, ["leaves", "saved"])
    sums = _from_below(along, ["leaves", "saved"], how).groupBy("depth", "c").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    ends = crossed.where("n = depth").select("depth", "c", "conv_id").unionByName(sizes.where("n = 0").select(F.lit(0).cast("long").alias("depth"), F.lit(root).cast("long").alias("c"), "conv_id"))
    ends = scratch.write(_hashed_ends(ends, how), "ends")
    high = upper.join(sums, ["depth", "c"]).join(ends, ["depth", "c"], "left")
    named = high.select(F.col("c").alias("conv_id"), "depth", F.col("parent_c").alias("parent_conv_id"), F.col("k").alias("n_convs"), "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(_NOTHING)).alias("ends_sha256"))
    below = scratch.write(low.drop("top").unionByName(named), "trie")
    as_long = lambda x: F.lit(x).cast("long")
    first = below.where("depth = 1").agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    facts = first.withColumn("e", F.lit(None).cast("string")).unionByName(ends.where("depth = 0").select(*(as_long(None).alias(c) for c in first.columns), F.col("ends_sha256").alias("e")))
    top = facts.agg(F.max("n_children").alias("n_children"), F.coalesce(F.max("n_leaves"), as_long(1)).alias("n_leaves"), F.coalesce(F.max("saved_tokens"), as_long(0)).alias("saved_tokens"), F.coalesce(F.max("e"), F.lit(_NOTHING)).alias("ends_sha256"))
    top = top.select(as_long(root).alias("conv_id"), as_long(0).alias("depth"), as_long(None).alias("parent_conv_id"), as_long(members).alias("n_convs"), "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    result = scratch.write(below.unionByName(top), "result")
    scratch.drop("places", "own", "sizes", "turns", "found", "nodes", "passages", "low", "upper", "ends", "trie")
    return result


def trie(df: DataFrame, how: Trie = Trie()) -> DataFrame:
    """The nodes of the conversations in (conv_id, turn, role, text)."""
    scratch = Scratch(df.sparkSession)
    return build(*plain(ordered(df, scratch), scratch), scratch, how)


def spliced_trie(df: DataFrame, every: int = 100, most: int = 5, how: Trie = Trie()) -> DataFrame:
    """The same after each conversation c took its first crc32(c) % (most + 1) turns from conversation c - c % every."""
    scratch, c = Scratch(df.sparkSession), F.col("conv_id")
    shared = F.crc32(c.cast("string").cast("binary")) % (most + 1)
    return build(*spliced(ordered(df, scratch), c - c % every, shared, most, scratch), scratch, how)


ORACLE_SQL = """
WITH o AS (SELECT conv_id AS c, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS l FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1),
h AS (SELECT c, l, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(ord(x) AS BIGINT) for x in string_split(CAST(c AS VARCHAR), '')]),
    lambda s, b: list_reduce([xor(s, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)), 4294967295) % 6 AS h FROM o),
r AS (SELECT h.c, coalesce(o.l[1:h.h], []) || h.l[h.h + 1:] AS l FROM h LEFT JOIN o ON o.c = h.c - h.c % 100),
p AS (SELECT c, l, unnest(range(0, len(l) + 1)) AS d FROM r),
g AS (SELECT l[1:d] AS k, d, min(c) AS c, count(*) AS n, coalesce(any_value(length(l[d].t)), 0) AS chars, coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (d = len(l)), '') AS ends FROM p GROUP BY 1, 2),
ch AS (SELECT k[1:d - 1] AS k, count(*) AS n FROM g WHERE d > 0 GROUP BY 1),
w AS (SELECT g.*, coalesce(ch.n, 0) AS children FROM g LEFT JOIN ch ON ch.k = g.k),
u AS (SELECT k, d, children, (n - 1) * chars AS own, unnest(range(0, d + 1)) AS i FROM w),
s AS (SELECT k[1:i] AS k, sum(CASE WHEN children = 0 THEN 1 ELSE 0 END) AS leaves, sum(own) AS saved FROM u GROUP BY 1)
SELECT w.c AS conv_id, w.d AS depth, b.c AS parent_conv_id, w.n AS n_convs, w.children AS n_children, CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(w.ends) AS ends_sha256
FROM w JOIN s ON s.k = w.k LEFT JOIN g b ON w.d > 0 AND b.k = w.k[1:w.d - 1]
"""
