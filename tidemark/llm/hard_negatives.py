"""Hard-negative mining by threshold joins over an inverted index with suffix-norm bounds.

Vectors become whole numbers and are packed into blocks of rows; the anchors, a stated set, are packed too and every anchor
block meets every row block. In such a tile, dimensions are ordered by weight and a row's posting lists end where its
remaining norm cannot lift any score to the threshold any more (a score is at most the product of two norms, by Cauchy and
Schwarz). Partial scores accumulate list by list; a pair is dropped once its partial score and the product of the remaining
norms stay below the anchor's threshold, and pairs that are left get their exact score. Anchors whose windows are not full
search again under a lower threshold, at last under the lowest score that counts. Each tile gives at most the wanted number
of rows for each window, and a ranking over all tiles keeps the first ones.

A first pass finds each anchor's positives; a second one, for each positive, the negatives in the window that its score sets.
Positives of negative score have an empty window and aren't searched for.

Defined cases: rows with a null id take no part, nor do those with a null label, a null vector or a null or non-finite
component; of rows with one id the smallest (label, vector) stays, so repetitions count once; an empty vector scores 0 with
all others, and a shorter vector has zeros at its end; ties go by the smaller id; an empty table gives an empty result; other
columns are ignored. Components or scores beyond 64-bit integers raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.shared import Scratch, bounded_batches

#: Dimensions of one step of accumulation.
_STEP = 8
#: A dense step ends when fewer than this share of its pairs is left.
_SPARSE = 0.05
#: Room for rounding in norms.
_SLACK = 1 + 1e-9


@dataclass(frozen=True)
class Mining:
    positives: int = 5
    negatives: int = 3
    #: Percent of the positive's score that a negative has at least and at most.
    low: int = 50
    high: int = 95
    #: Components are multiplied by this and rounded down.
    scale: int = 256
    block_rows: int = 16384
    block_anchors: int = 1024
    #: Anchors whose partial scores are held at once.
    held_anchors: int = 256
    #: Thresholds as shares of the largest possible score, and of the smallest window's upper end.
    positive_levels: tuple[float, ...] = (0.8, 0.6, 0.45, 0.3, 0.15)
    negative_levels: tuple[float, ...] = (0.95, 0.85, 0.75, 0.65)


_BLOCK = "stripe int, n int, n_anchors long, d int, width int, ids binary, labels binary, vectors binary"


def _packed(ids: np.ndarray, labels: np.ndarray, vectors: list, width: int = 0) -> dict:
    """One block: vectors of one length, in the fewest bytes."""
    d = max(map(len, vectors), default=0)
    full = np.zeros((len(vectors), d), np.int64)
    for i, v in enumerate(vectors):
        full[i, : len(v)] = v
    most = max(int(full.max(initial=0)), -int(full.min(initial=0)))
    kind = np.dtype(np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64)
    return {"n": len(ids), "d": d, "width": kind.itemsize, "ids": ids.astype("<i8").tobytes(), "labels": labels.astype("<i8").tobytes(), "vectors": full.astype(kind.newbyteorder("<")).tobytes()}


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8"), np.frombuffer(row["vectors"], f"<i{row['width']}").reshape(row["n"], row["d"])


def _vectors(column: pa.Array) -> list[np.ndarray]:
    offsets, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    return [values[i:j] for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def whole_numbers(df: DataFrame, how: Mining, vector: str = "embedding") -> DataFrame:
    """(vec_id, label, x): the rows that take part, one for each id."""
    x = F.col(f"`{vector}`")
    scaled = lambda v: v.cast("double") * how.scale
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")))
    fits = lambda v: F.when(F.abs(scaled(v)) < 2.0**62, F.floor(scaled(v))).otherwise(F.raise_error(F.lit("a component is beyond 64-bit integers")).cast("long"))
    rows = df.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & sound).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.transform(x, fits).alias("x"))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("m")).select("vec_id", "m.label", "m.x")


def blocks(rows: DataFrame, anchor: Column, how: Mining) -> DataFrame:
    """(vec_id, label, x) packed where they lie; a stripe is what one task has packed."""
    limit = how.block_rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stripe = TaskContext.get().partitionId()
        ids, labels, chosen, vectors = [], [], [], []

        def emit() -> pa.RecordBatch:
            block = _packed(np.array(ids), np.array(labels), vectors) | {"stripe": stripe, "n_anchors": sum(chosen)}
            for x in (ids, labels, chosen, vectors):
                x.clear()
            return pa.RecordBatch.from_pylist([block], schema)

        for batch in batches:
            new = [batch.column(i).to_pylist() for i in (0, 1, 3)] + [_vectors(batch.column(2))]
            at = 0
            while at < batch.num_rows:
                upto = at + limit - len(ids)
                for mine, theirs in zip((ids, labels, chosen, vectors), new, strict=True):
                    mine += theirs[at:upto]
                at = upto
                if len(ids) >= limit:
                    yield emit()
        if ids:
            yield emit()

    schema = pa.schema([("stripe", pa.int32()), ("n", pa.int32()), ("n_anchors", pa.int64()), ("d", pa.int32()), ("width", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()), ("vectors", pa.binary())])
    bounded_batches(rows.sparkSession)
    return rows.select("vec_id", "label", "x", anchor.cast("int").alias("chosen")).mapInArrow(run, _BLOCK)


def _rows_of(packed: DataFrame) -> DataFrame:
    """(vec_id, label, x) of packed rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, labels, x = _unpacked(row)
                offsets = np.arange(0, x.size + 1, x.shape[1]) if x.shape[1] else np.zeros(len(ids) + 1, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(labels), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(x.ravel().astype(np.int64)))], names=["vec_id", "label", "x"])

    return packed.mapInArrow(run, "vec_id long, label long, x array<long>")


def _anchor_blocks(anchors: DataFrame, count: int, how: Mining) -> DataFrame:
    """(vec_id, label, x, ids and scores of positives) packed: block (that of rows) and the positives' arrays, -1 for none."""
    k = how.positives

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def emit(part: list[dict]) -> pa.RecordBatch:
            block = _packed(np.array([r["vec_id"] for r in part]), np.array([r["label"] for r in part]), [r["x"] for r in part])
            for name, fill in (("positive_ids", -1), ("positive_scores", -1)):
                block[name] = np.array([((r[name] or []) + [fill] * k)[:k] for r in part], "<i8").tobytes()
            return pa.RecordBatch.from_pylist([block], schema)

        for batch in batches:
            held += batch.to_pylist()
            while len(held) >= how.block_anchors:
                yield emit(held[: how.block_anchors])
                held = held[how.block_anchors :]
        if held:
            yield emit(held)

    schema = pa.schema([("n", pa.int32()), ("d", pa.int32()), ("width", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()), ("vectors", pa.binary()), ("positive_ids", pa.binary()), ("positive_scores", pa.binary())])
    spread = anchors.repartition(max(1, -(-count // how.block_anchors)))
    return spread.mapInArrow(run, "n int, d int, width int, ids binary, labels binary, vectors binary, positive_ids binary, positive_scores binary")


class Index:
    """Posting lists of a block's rows over dimensions in the given order."""

    def __init__(self, x: np.ndarray) -> None:
        self.x = x
        squares = np.square(x.astype(np.float64))
        #: Norm of what is left of each row from a dimension on.
        self.rest = np.zeros((len(x), x.shape[1] + 1))
        self.rest[:, :-1] = np.sqrt(np.cumsum(squares[:, ::-1], axis=1)[:, ::-1]) * _SLACK
        self.norm = float(self.rest[:, 0].max(initial=0))

    def search(self, q: np.ndarray, q_rest: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, row, score) of all pairs that score `least` or more; q in the same order of dimensions."""
        n, d = self.x.shape
        norms = q_rest[:, 0]
        ratio = float(np.min(least / np.maximum(norms, 1e-300))) if len(q) else 0.0
        # a row's lists end before the first dimension from which on it can't reach the threshold; posting lists hold the rows by falling ends
        ends = (self.rest[:, :d] >= ratio).sum(axis=1)
        order = np.argsort(-ends, kind="stable")
        x, rest, ends = self.x[order], self.rest[order], ends[order]
        partial = np.zeros((len(q), n), self.x.dtype)
        found, done, alive_rows = [], n, n

        def left(first: int, last: int, at: int) -> None:
            """Pairs with the rows [first, last), of whose dimensions those before `at` are summed up."""
            bound = partial[:, first:last] + q_rest[:, at : at + 1] * rest[first:last, at]
            a, i = np.nonzero(bound >= least[:, None])
            found.append((a, i + first, np.full(len(a), at)))

        for j in range(0, d, _STEP):
            listed = int(np.searchsorted(-ends, -j, side="left"))  # rows whose lists reach beyond j
            if listed < alive_rows:
                left(listed, alive_rows, j)
                alive_rows = listed
            if not listed:
                break
            stop = min(j + _STEP, d)
            partial[:, :listed] += q[:, j:stop] @ x[:listed, j:stop].T
            if stop < d and np.mean(partial[:, :listed] + q_rest[:, stop : stop + 1] * rest[:listed, stop] >= least[:, None]) < _SPARSE:
                left(0, listed, stop)
                alive_rows = 0
                break
            done = stop
        if alive_rows:
            left(0, alive_rows, done if d else 0)
        a, i, at = (np.concatenate(z) for z in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
        score = partial[a, i]
        for j in range(0, d, _STEP):  # what their lists have left out, for pairs that can still reach the threshold
            todo = np.flatnonzero(at <= j)
            if not len(todo):
                continue
            stop = min(j + _STEP, d)
            score[todo] += np.einsum("ij,ij->i", q[a[todo], j:stop], x[i[todo], j:stop])
            at[todo] = stop
            keep = score + q_rest[a, at] * rest[i, at] >= least[a]
            a, i, at, score = a[keep], i[keep], at[keep], score[keep]
        score = score.astype(np.int64)
        keep = score >= least[a]
        return a[keep], order[i[keep]], score[keep]


def _first(a: np.ndarray, ids: np.ndarray, score: np.ndarray, most: int) -> np.ndarray:
    """Places of each anchor's first pairs, by falling score and then id."""
    order = np.lexsort((ids, -score, a))
    starts = np.flatnonzero(np.concatenate([[True], a[order][1:] != a[order][:-1]])) if len(a) else np.zeros(0, np.int64)
    rank = np.arange(len(a)) - np.repeat(starts, np.diff(np.append(starts, len(a))))
    return order[rank < most]


def _percent(scores: np.ndarray, share: int) -> np.ndarray:
    """The share in percent, rounded down, without leaving 64 bits."""
    return scores // 100 * share + scores % 100 * share // 100


def _exact_kind(x: np.ndarray, q: np.ndarray) -> type:
    """The fastest number that holds every partial score exactly."""
    most = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(x.shape[1], 1)
    if most >= 2.0**62:
        raise OverflowError("scores are beyond 64-bit integers")
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64


class Tile:
    """A row block, ready to be searched by anchor blocks; it is kept while the next tile has the same one."""

    def __init__(self, row: dict) -> None:
        self.raw = row["ids"], row["vectors"]
        ids, labels, x = _unpacked(row)
        order = np.lexsort((ids, labels))
        self.ids, self.labels, self.x = ids[order], labels[order], x[order]
        self.by_weight = np.argsort(-np.square(x.astype(np.float64)).sum(axis=0), kind="stable")
        self.indexes: dict = {}

    def same(self, row: dict) -> bool:
        return self.raw == (row["ids"], row["vectors"])

    def index(self, kind: type, width: int, first: int, last: int) -> Index:
        """Of the rows [first, last), widened with zeros to the anchors' length."""
        if (key := (kind, width, first, last)) not in self.indexes:
            x = np.zeros((last - first, width), kind)
            x[:, : len(self.by_weight)] = self.x[first:last, self.by_weight]
            self.indexes[key] = Index(x)
        return self.indexes[key]

    def prepared(self, anchors: np.ndarray) -> tuple[type, np.ndarray, np.ndarray]:
        """Anchors in the block's order of dimensions, and their remaining norms."""
        kind, d = _exact_kind(self.x, anchors), len(self.by_weight)
        wide = np.zeros((len(anchors), max(d, anchors.shape[1])), kind)
        wide[:, : anchors.shape[1]] = anchors
        q = np.concatenate([wide[:, self.by_weight], wide[:, d:]], axis=1)
        return kind, q, Index(q).rest

    def positives(self, ids: np.ndarray, labels: np.ndarray, anchors: np.ndarray, how: Mining) -> Iterator[tuple]:
        """(anchor id, row id, score) of the first rows of the same label, of scores from 0 on."""
        kind, q, rest = self.prepared(anchors)
        for label in np.unique(labels).tolist():
            first, last = np.searchsorted(self.labels, label), np.searchsorted(self.labels, label, side="right")
            if first == last:
                continue
            index = self.index(kind, q.shape[1], int(first), int(last))
            mine = np.flatnonzero(labels == label)
            for part in np.array_split(mine, -(-len(mine) // how.held_anchors)):
                for level in (*how.positive_levels, 0.0):
                    least = np.maximum(np.ceil(level * rest[part, 0] * index.norm), 0)
                    a, i, score = index.search(q[part], rest[part], least)
                    other = self.ids[first + i] != ids[part[a]]
                    a, i, score = a[other], first + i[other], score[other]
                    full = np.bincount(a, minlength=len(part)) >= how.positives if level else np.ones(len(part), bool)
                    at = _first(a, self.ids[i], score, how.positives)
                    at = at[full[a[at]]]
                    yield ids[part[a[at]]], self.ids[i[at]], score[at]
                    part = part[~full]
                    if not len(part):
                        break

    def negatives(self, ids: np.ndarray, labels: np.ndarray, anchors: np.ndarray, positive_ids: np.ndarray, positive_scores: np.ndarray, how: Mining) -> Iterator[tuple]:
        """(anchor id, positive id, row id, positive's score, score) of the first rows of other labels in each positive's window."""
        kind, q, rest = self.prepared(anchors)
        index = self.index(kind, q.shape[1], 0, len(self.ids))
        there = positive_scores >= 0
        low, high = -_percent(-positive_scores, how.low), _percent(positive_scores, how.high)
        smallest = np.where(there, positive_scores, np.iinfo(np.int64).max).min(axis=1)
        for part in np.array_split(np.arange(len(ids)), -(-len(ids) // how.held_anchors)):
            for level in (*how.negative_levels, 0.0):
                floor = -_percent(-smallest[part], how.low)
                least = np.maximum(floor, np.ceil(level * _percent(smallest[part], how.high)).astype(np.int64))
                a, i, score = index.search(q[part], rest[part], least)
                other = self.labels[i] != labels[part[a]]
                a, i, score = a[other], i[other], score[other]
                slots, full = [], least <= floor
                missing = np.zeros(len(part), bool)
                for k in range(positive_ids.shape[1]):
                    inside = np.flatnonzero((score >= low[part[a], k]) & (score <= high[part[a], k]) & there[part[a], k])
                    missing |= there[part, k] & (np.bincount(a[inside], minlength=len(part)) < how.negatives)
                    slots.append(inside[_first(a[inside], self.ids[i[inside]], score[inside], how.negatives)])
                full |= ~missing
                for k, at in enumerate(slots):
                    at = at[full[a[at]]]
                    who = part[a[at]]
                    yield ids[who], positive_ids[who, k], self.ids[i[at]], positive_scores[who, k], score[at]
                part = part[~full]
                if not len(part):
                    break


def _tiles(packed: DataFrame, anchor_blocks: DataFrame, stripes: int, how: Mining, second: bool) -> DataFrame:
    """Every anchor block with every row block, by stripes."""
    names = ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"] if second else ["anchor_id", "positive_id", "positive_score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile = None
        for batch in batches:
            for row in batch.to_pylist():
                if tile is None or not tile.same(row["rows"]):
                    tile = Tile(row["rows"])
                ids, labels, x = _unpacked(row["anchors"])
                if second:
                    shape = len(ids), how.positives
                    positives = (np.frombuffer(row["anchors"][c], "<i8").reshape(shape) for c in ("positive_ids", "positive_scores"))
                    found = tile.negatives(ids, labels, x, *positives, how)
                else:
                    found = tile.positives(ids, labels, x, how)
                for columns in found:
                    if len(columns[0]):
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    bounded_batches(packed.sparkSession)
    spread = anchor_blocks.select(F.struct("*").alias("anchors"), F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))).alias("stripe"))
    met = packed.select("stripe", F.struct("n", "d", "width", "ids", "labels", "vectors").alias("rows")).join(spread, "stripe")
    return met.select("rows", "anchors").mapInArrow(run, ", ".join(f"{c} long" for c in names))


def mine(df: DataFrame, anchor: Column, how: Mining = Mining(), vector: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows of (vec_id, label, vector); anchors are those where the condition on vec_id holds."""
    spark = df.sparkSession
    scratch = Scratch(spark)
    packed = scratch.write(blocks(whole_numbers(df, how, vector), anchor, how), "rows")
    last, count = packed.agg(F.max("stripe"), F.sum("n_anchors")).first()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not count:
        return spark.createDataFrame([], schema)
    anchors = _rows_of(packed.where("n_anchors > 0")).where(anchor)
    none = F.lit(None).cast("array<long>")
    bare = _anchor_blocks(anchors.withColumns({"positive_ids": none, "positive_scores": none}), count, how)
    near = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    positives = scratch.write(_tiles(packed, bare, last + 1, how, False).withColumn("k", F.row_number().over(near)).where(F.col("k") <= how.positives), "positives")
    each = positives.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.array_sort(F.collect_list(F.struct("k", "positive_id", "positive_score"))).alias("p"))
    full = anchors.join(each, "vec_id").select("vec_id", "label", "x", F.col("p.positive_id").alias("positive_ids"), F.col("p.positive_score").alias("positive_scores"))
    hard = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    found = _tiles(packed, _anchor_blocks(full, count, how), last + 1, how, True).withColumn("rank", F.row_number().over(hard))
    return found.where(F.col("rank") <= how.negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5)
SELECT p.a AS anchor_id, p.b AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.b AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
WINDOW w AS (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b)
QUALIFY row_number() OVER w <= 3
"""
