"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence with itself.

Which documents have shingle sets whose Jaccard similarity reaches a bound, without comparing all of them:

1. `profile`: one scan gives each document's set size and class (a 64-bit hash of its set; documents of one class have
   equal sets), one text of each class a task sees, and a table of fixed size with estimated n-gram counts.
2. `incidence`: each class's set is ordered by estimated count and then hash, rarest first, and only as many entries are
   emitted as two linked sets must share one of: n - ceil(similarity * n) + 1. Entries are dealt to blocks of n-grams
   (columns) as packed arrays. N-grams of one set that fall on one 32-bit column are told apart by their number in it.
3. `product`: each block multiplies its columns: overlap counts of pairs of classes that share a column, unless their
   sizes alone rule them out. A column with many classes is set aside whole.
4. Counts of a pair are added over blocks; a pair whose count leaves it below the overlap that its sizes need is
   discarded. What is left is checked exactly on the texts, and components of the links are formed.
5. `stars`: columns set aside can hide links only between different components. In those that touch more than one, each
   class is compared with the hub that it meets most, and the components are formed again; this is done in rounds.
6. `across`: what still touches more than one component is multiplied in tiles, block of classes by block of classes: counts
   and bounds stay in the worker, and only pairs that reach their bound leave it, each from one tile. They are checked like
   the other pairs, and the components are formed a last time.

So groups of thousands of near copies cost work in proportion to their entries and not to their pairs, and no link
between components is lost. The estimated counts steer the cost only. Columns estimated to be very common never meet in
one block: they are set aside at once. Only texts of classes in candidate pairs are shuffled; tables are removed when
nothing reads them any more.

Defined cases: a null text or one without words has an empty set, no links and itself as component; rows with equal sets
are linked, repeated rows and repeated ids included; null ids take part and count last in minima; a document of fewer
than n words has one shingle, all its words; other columns are ignored. Two different sets share a 64-bit class with a
probability of about (classes squared) / 3.7e19.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import wordhash
from tidemark.llm.components import connected
from tidemark.llm.shared import Scratch, bounded_batches, pieces, utf8

_SLOT_BITS, _CHUNKS = 20, 64
_FILTER_BITS = 24


@dataclass(frozen=True)
class Join:
    words: int = 5
    #: Similarity at least percent / 100, in whole numbers so that ties are exact.
    percent: int = 75
    #: A block of columns holds about this many entries.
    block_entries: int = 2_000_000
    #: A column with more classes than this is set aside and its classes are first compared with hubs, in so many rounds.
    small_column: int = 8
    star_rounds: int = 1
    #: A column estimated to have more classes than this never enters a block.
    hot_column: int = 1_000_000
    #: Classes on either side of a tile, and columns that a tile multiplies at once.
    tile: int = 1_024
    slab: int = 4_096

    def prefix(self, n: np.ndarray) -> np.ndarray:
        return n - (self.percent * n + 99) // 100 + 1

    def needed(self, a, b):
        """Least overlap of linked sets of sizes a and b, as a Column or number."""
        return F.ceil(self.percent * (a + b) / F.lit(100 + self.percent))

    def fits(self, a, b):
        """Whether sets of sizes a and b can be linked at all, as a Column."""
        return 100 * F.least(a, b).cast("long") >= self.percent * F.greatest(a, b).cast("long")


def class_of(shingles: np.ndarray) -> int:
    """The 64-bit class of a sorted set."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[pa.RecordBatch, slice, list[bytes], list[np.ndarray]]]:
    for batch in batches:
        texts = utf8(batch.column(batch.schema.get_field_index("text")))
        for part in pieces(texts):
            with np.errstate(over="ignore"):
                yield batch, part, texts[part], wordhash.shingle_sets(texts[part], n)


def _slots(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)


def profile(docs: DataFrame, how: Join) -> DataFrame:
    """Documents (kind 0): doc_id, row hash, n_shingles, class, and the text where the task sees the class first. Parts of the table of n-gram counts (kind 1): chunk, counts."""
    names = ["kind", "doc_id", "row", "n_shingles", "cid", "text", "chunk", "counts"]

    def run(batches):
        counts, seen = np.zeros(1 << _SLOT_BITS, np.uint32), set()
        for batch, part, texts, sets in _sets(batches, how.words):
            classes = [class_of(s) if len(s) else None for s in sets]
            first = [c is not None and not (c in seen or seen.add(c)) for c in classes]
            if any(first):
                counts += np.bincount(_slots(np.concatenate([s for s, f in zip(sets, first, strict=True) if f])), minlength=len(counts)).astype(np.uint32)
            k = len(sets)
            ids, rows = (batch.column(batch.schema.get_field_index(c)).slice(part.start, k) for c in ("doc_id", "row"))
            kept = pa.array([t if f else None for t, f in zip(texts, first, strict=True)], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([0] * k, pa.int32()), ids, rows, pa.array([len(s) for s in sets], pa.int64()), pa.array(classes, pa.int64()), kept, pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], names=names)
        if seen:
            parts = [(i, zlib.compress(c.tobytes(), 1)) for i, c in enumerate(np.split(counts, _CHUNKS)) if c.any()]
            k = len(parts)
            yield pa.RecordBatch.from_arrays([pa.array([1] * k, pa.int32()), *(pa.nulls(k, pa.int64()) for _ in range(4)), pa.nulls(k, pa.string()), pa.array([i for i, _ in parts], pa.int32()), pa.array([c for _, c in parts], pa.binary())], names=names)

    return docs.mapInArrow(run, "kind int, doc_id long, row long, n_shingles long, cid long, text string, chunk int, counts binary")


def rarity(parts: DataFrame) -> np.ndarray:
    """The summed table as one byte a slot: eight steps for each doubling of the count. Its size is fixed."""

    def add(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(zlib.decompress(c), np.uint32).astype(np.int64) for c in rows.column("counts").to_pylist())
        steps = np.minimum(np.round(8 * np.log2(1 + total)), 255).astype(np.uint8)
        return pa.table({"chunk": pa.array([rows.column("chunk")[0].as_py()], pa.int32()), "steps": pa.array([steps.tobytes()], pa.binary())})

    out = np.zeros(1 << _SLOT_BITS, np.uint8)
    size = len(out) // _CHUNKS
    for r in parts.select("chunk", "counts").groupBy("chunk").applyInArrow(add, "chunk int, steps binary").collect():
        out[r["chunk"] * size : (r["chunk"] + 1) * size] = np.frombuffer(r["steps"], np.uint8)
    return out


_ENTRIES = "block int, hashes binary, owners binary, cids binary, sizes binary"
_LOW = np.uint64(0xFFFFFFFF)


def apart(columns: np.ndarray) -> np.ndarray:
    """Columns (block << 32 | hash) of one set, all different: the j-th n-gram on a column goes to a j-th column of its own.

    Sets that share k n-grams on one column then share k columns at least, so counts never fall below the true overlap.
    """
    columns = np.sort(columns)
    while len(columns) > 1 and (same := columns[1:] == columns[:-1]).any():
        start = np.maximum.accumulate(np.where(np.concatenate([[True], ~same]), np.arange(len(columns)), 0))
        number = (np.arange(len(columns)) - start).astype(np.uint64)
        columns = np.sort((columns & ~_LOW) | (columns + number * np.uint64(0x9E3779B1) & _LOW))
    return columns


def incidence(texts: DataFrame, table: np.ndarray, blocks: int, how: Join) -> DataFrame:
    """Packed entries of (cid, text) by block: hash and place of the class in the arrays of classes and set sizes. Block -1: hot columns."""
    shared = texts.sparkSession.sparkContext.broadcast(table)
    hot_step = min(255, round(8 * np.log2(1 + how.hot_column)))

    def flush(rows):
        columns, owners = np.concatenate([c for c, _, _ in rows]), np.repeat(np.arange(len(rows)), [len(c) for c, _, _ in rows])
        cids, sizes = np.array([c for _, c, _ in rows], np.int64), np.array([n for _, _, n in rows], np.int32)
        block = (columns >> np.uint64(32)).astype(np.int64)
        order = np.argsort(block, kind="stable")
        columns, owners, block = columns[order], owners[order], block[order]
        edges = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1], [True]]))
        out = {k: [] for k in ("block", "hashes", "owners", "cids", "sizes")}
        for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            used, local = np.unique(owners[i:j], return_inverse=True)
            for k, v in zip(out, (int(block[i]) if block[i] < blocks else -1, (columns[i:j] & _LOW).astype(np.uint32).tobytes(), local.astype(np.uint32).tobytes(), cids[used].tobytes(), sizes[used].tobytes()), strict=True):
                out[k].append(v)
        return pa.RecordBatch.from_arrays([pa.array(out["block"], pa.int32()), *(pa.array(out[k], pa.binary()) for k in list(out)[1:])], names=list(out))

    def run(batches):
        steps, rows, held = shared.value, [], 0
        for batch, part, _, sets in _sets(batches, how.words):
            for s, c in zip(sets, batch.column(batch.schema.get_field_index("cid"))[part].to_pylist(), strict=True):
                keys = (steps[_slots(s)].astype(np.uint64) << np.uint64(56)) | (s & np.uint64((1 << 56) - 1))
                p = int(how.prefix(len(s)))
                keys = np.partition(keys, p - 1)[:p]
                block = np.where(keys >> np.uint64(56) >= hot_step, np.uint64(blocks), keys % np.uint64(blocks))
                rows.append((apart(block << np.uint64(32) | keys >> np.uint64(20) & _LOW), c, len(s)))
                held += p
                if held > 1_000_000:
                    yield flush(rows)
                    rows, held = [], 0
        if rows:
            yield flush(rows)

    return texts.mapInArrow(run, _ENTRIES)


_PRODUCT = "kind int, a long, b long, na int, nb int, shared int, bucket long, cids array<long>, sizes array<int>"


def _product_rows(pairs: tuple, columns: list[tuple]) -> Iterator[pa.RecordBatch]:
    names = ["kind", "a", "b", "na", "nb", "shared", "bucket", "cids", "sizes"]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32())]
    k = len(pairs[0])
    yield pa.RecordBatch.from_arrays([pa.array(np.zeros(k, np.int32)), *(pa.array(x, t) for x, t in zip(pairs, kinds[1:6], strict=True)), *(pa.nulls(k, t) for t in kinds[6:])], names=names)
    k = len(columns)
    yield pa.RecordBatch.from_arrays([pa.array(np.ones(k, np.int32)), *(pa.nulls(k, t) for t in kinds[1:6]), *(pa.array([c[i] for c in columns], t) for i, t in enumerate(kinds[6:]))], names=names)


def product(entries: DataFrame, how: Join) -> DataFrame:
    """Pairs of classes (kind 0) with the columns they were counted in, and columns set aside (kind 1)."""

    def run(key: tuple[pa.Scalar, ...], rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, hashes, cids, sizes = key[0].as_py(), [], [], []
        for batch in rows:
            for h, o, c, n in zip(*(batch.column(batch.schema.get_field_index(x)).to_pylist() for x in ("hashes", "owners", "cids", "sizes")), strict=True):
                o = np.frombuffer(o, np.uint32)
                hashes.append(np.frombuffer(h, np.uint32))
                cids.append(np.frombuffer(c, np.int64)[o])
                sizes.append(np.frombuffer(n, np.int32)[o])
        hashes, cids, sizes = np.concatenate(hashes).astype(np.uint64), np.concatenate(cids), np.concatenate(sizes)
        known, first, place = np.unique(cids, return_index=True, return_inverse=True)
        size = sizes[first]
        cells = np.unique(hashes << np.uint64(32) | place.astype(np.uint64))
        column, row = cells >> np.uint64(32), (cells & np.uint64(0xFFFFFFFF)).astype(np.int64)
        edges = np.flatnonzero(np.concatenate([[True], column[1:] != column[:-1], [True]]))
        length = np.diff(edges)
        of = np.repeat(length, length)
        a, b = [], []
        for d in range(1, how.small_column):
            i = np.flatnonzero((column[:-d] == column[d:]) & (of[:-d] <= how.small_column)) if d < len(column) else np.zeros(0, np.int64)
            a.append(row[i])
            b.append(row[i + d])
        large = np.flatnonzero(length > how.small_column)
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
        fits = 100 * np.minimum(size[a], size[b]).astype(np.int64) >= how.percent * np.maximum(size[a], size[b]).astype(np.int64)
        pair, times = np.unique(a[fits] * len(known) + b[fits], return_counts=True)
        a, b = pair // len(known), pair % len(known)
        columns = [(block << 32 | int(column[edges[i]]), known[r], size[r]) for i in large.tolist() for r in np.array_split(row[edges[i] : edges[i + 1]], -(-int(length[i]) // 4096))]
        yield from _product_rows((known[a], known[b], size[a], size[b], times), columns)

    return entries.where("block >= 0").groupBy("block").applyInArrow(run, _PRODUCT)


def hot_columns(entries: DataFrame) -> DataFrame:
    """Columns that never entered a block, in the form of those set aside."""

    def run(batches):
        for batch in batches:
            columns = []
            for h, o, c, n in zip(*(batch.column(batch.schema.get_field_index(x)).to_pylist() for x in ("hashes", "owners", "cids", "sizes")), strict=True):
                h, o, c, n = np.frombuffer(h, np.uint32), np.frombuffer(o, np.uint32), np.frombuffer(c, np.int64), np.frombuffer(n, np.int32)
                order = np.argsort(h, kind="stable")
                for part in np.split(order, np.flatnonzero(np.diff(h[order])) + 1):
                    columns.append((-1 << 32 | int(h[part[0]]), c[o[part]], n[o[part]]))
            yield from _product_rows(tuple(np.zeros(0, np.int64) for _ in range(5)), columns)

    return entries.where("block < 0").mapInArrow(run, _PRODUCT)


def texts_of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cid, text) of the wanted classes, one text each.

    A table of bits keeps most other texts from the shuffle. It has 2^18 rows of two longs at most, whatever the input, so it is broadcast.
    """
    place = F.col("cid").bitwiseAND((1 << _FILTER_BITS) - 1)
    word, bit = F.shiftright(place, 6).alias("word"), place.bitwiseAND(63).cast("int").alias("bit")
    bits = wanted.select(word, bit).groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    likely = texts.select("cid", "text", word, bit).join(F.broadcast(bits), "word").where("shiftrightunsigned(bits, bit) & 1 = 1")
    return likely.groupBy("cid").agg(F.first("text").alias("text")).join(wanted.hint("merge"), "cid", "left_semi")


def verified(pairs: DataFrame, texts: DataFrame, how: Join) -> DataFrame:
    """The pairs (a, b) that are linked by their whole sets. `texts`: (cid, text), with each class once or more."""
    texts = texts_of(texts, pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct())

    def run(batches):
        last, last_set = None, None
        for batch in batches:
            a, b = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("a", "b"))
            ta, tb = (utf8(batch.column(batch.schema.get_field_index(c))) for c in ("text_a", "text_b"))
            keep = []
            with np.errstate(over="ignore"):
                for part in pieces(ta):
                    for k, s in enumerate(wordhash.shingle_sets(ta[part], how.words), part.start):
                        if b[k] != last:
                            last, last_set = b[k], wordhash.shingle_sets([tb[k]], how.words)[0]
                        both = len(s) + len(last_set)
                        overlap = both - len(np.unique(np.concatenate([s, last_set])))
                        if 100 * overlap >= how.percent * (both - overlap):
                            keep.append(k)
            yield pa.RecordBatch.from_arrays([pa.array([a[k] for k in keep], pa.int64()), pa.array([b[k] for k in keep], pa.int64())], names=["a", "b"])

    # sorted joins at every size: a broadcast of few pairs would hide what many cost
    first = pairs.join(texts.select(F.col("cid").alias("a"), F.col("text").alias("text_a")).hint("merge"), "a")
    both = first.join(texts.select(F.col("cid").alias("b"), F.col("text").alias("text_b")).hint("merge"), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _added(counts: DataFrame) -> DataFrame:
    return counts.groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.max("na").alias("na"), F.max("nb").alias("nb"))


def _bounded(counts: DataFrame, how: Join) -> DataFrame:
    """Pairs whose shared prefix entries and whatever lies behind the prefixes can still reach the overlap needed."""
    return counts.where(F.col("shared") >= _least_shared(F.col("na"), F.col("nb"), how)).select("a", "b")


def _least_shared(a, b, how: Join):
    """Fewest shared prefix entries of linked sets of sizes a and b."""
    rest = lambda n: F.ceil(how.percent * n / F.lit(100)) - 1
    return how.needed(a, b) - F.greatest(rest(a), rest(b))


def _fewest_shared(size, lower, upper, how: Join):
    """No more than what a set of this size shares in prefix entries with a linked one of any size from lower to upper.

    The ceilings of _least_shared make it go up and down by one. Without them it is a concave function of the partner's size,
    with its least value at an end, and _least_shared is above that value at each size.
    """
    size, p = size.cast("long"), how.percent
    plain = lambda b: 100 * p * (size + b) - p * (100 + p) * F.greatest(size, b)
    return F.floor(F.least(plain(lower), plain(upper)) / F.lit(100 * (100 + p))) + 1


def _several(cells: DataFrame) -> DataFrame:
    """Cells of columns that touch more than one root, with the column's number of cells and range of sizes."""
    spans = cells.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("n"), F.min("size").alias("least"), F.max("size").alias("most")).where("lo < hi").drop("lo", "hi")
    return cells.join(spans, "bucket")


def mixed(cells: DataFrame, roots: DataFrame, alone: DataFrame, how: Join) -> DataFrame:
    """The cells (bucket, cid, size) of columns that touch more than one component, with their root and the column's n.

    A class whose columns are too few for a link to any size that it meets in them is left out: it can share no more than
    all of them, and what it shares with one other in small columns (`alone`: cid, most). Near misses end here.
    """
    rooted = cells.join(roots, cells["cid"] == roots["node"], "left").select("bucket", "cid", "size", F.coalesce("root", "cid").alias("root"))
    rooted = _several(rooted)
    per = rooted.groupBy("cid", "size").agg(F.count("*").alias("k"), F.min("least").alias("least"), F.max("most").alias("most_size")).join(alone, "cid", "left")
    lower = F.greatest(F.col("least"), F.ceil(how.percent * F.col("size") / F.lit(100)))
    upper = F.least(F.col("most_size"), F.floor(100 * F.col("size") / F.lit(how.percent)))
    able = per.withColumn("need", (_fewest_shared(F.col("size"), lower, upper, how) - F.coalesce("most", F.lit(0))).cast("int")).where("k >= need").select("cid", "need")
    return _several(rooted.select("bucket", "cid", "size", "root").join(able, "cid")).select("bucket", "cid", "size", "root", "need", "n")


def stars(cells: DataFrame, counted: DataFrame, how: Join) -> DataFrame:
    """For each class in mixed columns one pair with the hub that it meets most often outside of its component, if both can be linked.

    The hub of a column is the class that meets most others over all columns: among near copies, what they are copies of.
    The entries that a pair shares are those in small columns (`counted`) and in mixed ones, which each class carries in one array.
    """
    degree = cells.groupBy("cid").agg(F.sum("n").alias("degree"))
    hubs = cells.join(degree, "cid").groupBy("bucket").agg(F.max(F.struct("degree", "cid", "root")).alias("hub"))
    met = cells.join(hubs, "bucket").where("root <> hub.root").groupBy("cid", F.col("hub.cid").alias("hub")).agg(F.count("*").alias("k"))
    best = met.groupBy("cid").agg(F.max(F.struct("k", "hub")).alias("x"))
    pairs = best.select(F.least("cid", "x.hub").alias("a"), F.greatest("cid", "x.hub").alias("b")).distinct()
    each = cells.groupBy("cid", "size").agg(F.collect_set("bucket").alias("columns"))
    side = lambda s: each.select(F.col("cid").alias(s), F.col("size").alias(f"n{s}"), F.col("columns").alias(f"columns_{s}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").join(counted.select("a", "b", "shared"), ["a", "b"], "left")
    fits = how.fits(F.col("na"), F.col("nb"))
    shared = F.coalesce("shared", F.lit(0)) + F.size(F.array_intersect("columns_a", "columns_b"))
    return both.where(fits & (shared >= _least_shared(F.col("na"), F.col("nb"), how))).select("a", "b")


def _overlaps(left: list[np.ndarray], right: list[np.ndarray], slab: int) -> np.ndarray:
    """How many columns each on the left shares with each on the right; dense slabs of columns that stand on both sides."""
    out = np.zeros((len(left), len(right)), np.float32)
    rows = [np.repeat(np.arange(len(x)), list(map(len, x))) for x in (left, right)]
    flat = [np.concatenate([*x, np.zeros(0, np.int64)]) for x in (left, right)]
    both = np.intersect1d(*flat)
    for k in range(0, len(both), slab):
        some, sides = both[k : k + slab], []
        for r, c, n in zip(rows, flat, (len(left), len(right)), strict=True):
            at = np.minimum(np.searchsorted(some, c), len(some) - 1)
            found = some[at] == c
            dense = np.zeros((n, len(some)), np.float32)
            dense[r[found], at[found]] = 1
            sides.append(dense)
        out += sides[0] @ sides[1].T
    return out


def tile_pairs(bucket: int, sides: list[dict], how: Join, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (places on either side) of a tile that may be linked, lie in different components and meet in this column first of all that they meet in; what they lack of their bound."""
    x, y = sides
    low, high = (f(x["size"][:, None], y["size"][None, :]) for f in (np.minimum, np.maximum))
    needed = -(-how.percent * (low + high) // (100 + how.percent)) - (-(-how.percent * high // 100) - 1)
    able = (x["root"][:, None] != y["root"][None, :]) & (100 * low >= how.percent * high)
    if same:
        able &= np.arange(len(x["size"]))[:, None] < np.arange(len(y["size"]))[None, :]
    lack = needed - _overlaps(x["columns"], y["columns"], how.slab).astype(np.int64)
    able &= lack <= np.minimum(x["most"][:, None], y["most"][None, :])
    if able.any():
        earlier = [[(h := c[:f])[h < bucket] for c, f in zip(s["columns"], s["first"].tolist(), strict=True)] for s in sides]
        able &= _overlaps(*earlier, how.slab) == 0
    return *np.nonzero(able), lack[able]


def across(cells: DataFrame, counted: DataFrame, alone: DataFrame, how: Join, scratch: Scratch) -> DataFrame:
    """Candidates between components from mixed columns, counted in tiles.

    A linked pair shares at least `need` of a class's k mixed columns, so it meets in the k - need + 1 rarest of both, its
    heads. In each head column the classes outside of its most frequent component meet each other and those inside, in
    tiles of bounded size. What a pair shares in small columns is bounded there by the most that either shares with anyone
    (`alone`: cid, most), and looked up in `counted` for the pairs that are left.
    """
    rows = cells.groupBy("cid", "size", "root").agg(F.max("need").alias("need"), F.array_sort(F.collect_set(F.struct("n", "bucket"))).alias("cells")).join(alone, "cid", "left")
    first = F.greatest(F.lit(1), F.size("cells") - F.greatest("need", F.lit(1)) + 1).alias("first")
    rows = scratch.write(rows.select("cid", "size", "root", F.coalesce("most", F.lit(0)).cast("long").alias("most"), F.transform("cells", lambda c: c["bucket"]).alias("columns"), first), "classes")
    heads = rows.select("*", F.explode(F.slice("columns", F.lit(1), F.col("first"))).alias("bucket"))
    tops = heads.groupBy("bucket", "root").agg(F.count("*").alias("k")).groupBy("bucket").agg(F.max(F.struct("k", "root")).alias("top"), F.sum("k").alias("n")).where("n > top.k")
    parts = lambda n: F.ceil(n / F.lit(how.tile)).cast("int")
    met = heads.join(tops.select("bucket", F.col("top.root").alias("top"), parts(F.col("n") - F.col("top.k")).alias("outer"), parts(F.col("top.k")).alias("inner")), "bucket")
    mine = lambda n: F.pmod(F.xxhash64("cid"), n).cast("int")
    is_top = F.col("root") == F.col("top")
    dealt = met.withColumn("part", F.when(is_top, F.col("outer") + mine(F.col("inner"))).otherwise(mine(F.col("outer"))))
    others = F.sequence(F.lit(0), F.when(is_top, F.col("outer")).otherwise(F.col("outer") + F.col("inner")) - 1)
    tiles = dealt.select("*", F.explode(others).alias("other")).select("bucket", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), "part", "cid", "size", "root", "most", "first", "columns")

    def run(key: tuple[pa.Scalar, ...], group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, lo, hi = (k.as_py() for k in key)
        table = pa.Table.from_batches(list(group))
        part, sides = table.column("part").to_numpy(), []
        columns = table.column("columns").to_pylist()
        for p in (lo, hi):
            at = np.flatnonzero(part == p)
            sides.append({c: table.column(c).to_numpy()[at].astype(np.int64) for c in ("cid", "size", "root", "most", "first")} | {"columns": [np.array(columns[i], np.int64) for i in at.tolist()]})
        i, j, lack = tile_pairs(bucket, sides, how, lo == hi)
        a, b = sides[0]["cid"][i], sides[1]["cid"][j]
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(lack)], names=["a", "b", "lack"])

    found = tiles.groupBy("bucket", "lo", "hi").applyInArrow(run, "a long, b long, lack long")
    return found.join(counted.select("a", "b", "shared"), ["a", "b"], "left").where(F.coalesce("shared", F.lit(0)) >= F.col("lack")).select("a", "b")


def classes(df: DataFrame, how: Join = Join()) -> tuple[DataFrame, DataFrame]:
    """(doc_id, row, n_shingles, cid) of each row of (doc_id, text), `row` being a hash of its text; (node, root) of the classes linked to others."""
    spark = df.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark)
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("row"))
    profiled = scratch.write(profile(docs, how), "profile")
    rows = scratch.write(profiled.where("kind = 0").select("doc_id", "row", "n_shingles", "cid"), "rows")
    texts = profiled.where("text is not null").select("cid", "text")
    table = rarity(profiled.where("kind = 1"))
    total = rows.agg(F.sum(F.floor(F.col("n_shingles") * (100 - how.percent) / 100) + 1)).first()[0] or 0
    blocks = max(spark.sparkContext.defaultParallelism, -(-total // how.block_entries))
    entries = scratch.write(incidence(texts, table, int(blocks), how), "incidence")
    worked = scratch.write(product(entries, how).union(hot_columns(entries)), "product")
    scratch.drop("incidence")
    counted = worked.where("kind = 0").select("a", "b", "na", "nb", "shared")
    columns = worked.where("kind = 1").select("bucket", F.explode(F.arrays_zip("cids", "sizes")).alias("x"))
    cells = scratch.write(columns.select("bucket", F.col("x.cids").alias("cid"), F.col("x.sizes").alias("size")), "cells")
    counted = scratch.write(_added(counted), "counted")
    scratch.drop("product")
    done = scratch.write(_bounded(counted, how), "pairs")
    links = scratch.write(verified(done, texts, how), "linked")
    roots = connected(links)
    alone = scratch.write(counted.select(F.explode(F.array("a", "b")).alias("cid"), "shared").groupBy("cid").agg(F.max("shared").alias("most")), "alone")

    def checked(pairs: DataFrame) -> None:
        nonlocal done, roots
        new = scratch.write(pairs.join(done, ["a", "b"], "left_anti"), "pairs")
        found = scratch.write(verified(new, texts, how), "linked")
        done = done.union(new)
        if found.limit(1).count():
            roots = connected(found.union(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))

    # components only grow, so what isn't mixed in one round isn't in a later one
    for _ in range(how.star_rounds):
        cells = scratch.write(mixed(cells.select("bucket", "cid", "size"), roots, alone, how), "mixed")
        checked(stars(cells, counted, how))
    cells = scratch.write(mixed(cells.select("bucket", "cid", "size"), roots, alone, how), "mixed")
    checked(across(cells, counted, alone, how, scratch))
    scratch.drop("profile", "counted", "cells", "mixed", "alone", "classes", "pairs", "linked")
    return rows, roots


def components(df: DataFrame, how: Join = Join()) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest doc_id reachable by links, for each row of (doc_id, text)."""
    rows, roots = classes(df, how)
    least = rows.where("n_shingles > 0").groupBy("cid").agg(F.min("doc_id").alias("least"))
    rooted = least.join(roots, least["cid"] == roots["node"], "left").select("cid", "least", F.coalesce("root", "cid").alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("cid", "component_id")
    return rows.join(named, "cid", "left").select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def _sieved(df: DataFrame, keys: DataFrame, place, name: str) -> DataFrame:
    """Adds whether the hash of a row's key is that of one of the keys, or shares its bit. The table of bits has 2^18 rows of two longs at most, whatever the input, so it is broadcast."""
    bit = place.bitwiseAND((1 << _FILTER_BITS) - 1)
    word, bit = F.shiftright(bit, 6), bit.bitwiseAND(63).cast("int")
    bits = keys.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits"))
    met = df.withColumns({"_word": word, "_bit": bit}).join(F.broadcast(bits), "_word", "left")
    return met.withColumn(name, F.coalesce(F.expr("shiftrightunsigned(_bits, _bit) & 1 = 1"), F.lit(False))).drop("_word", "_bit", "_bits")


def _row_hash(df: DataFrame):
    """A hash of all columns; nulls count, and maps and variants as their contents."""
    contents = [F.array_sort(F.map_entries(f"`{c}`")) if kind.startswith("map") else F.to_json(f"`{c}`") if kind == "variant" else F.col(f"`{c}`") for c, kind in df.dtypes]
    return F.xxhash64(*contents, *(F.col(f"`{c}`").isNull() for c in df.columns))


def deduplicated(df: DataFrame, how: Join = Join()) -> DataFrame:
    """The rows of df without those that others of their component stand for: of each component the row with the smallest doc_id (nulls last), then text hash, then hash of the whole row, stays.

    Rows without words all stay, but for repetitions of one id and text, of which the row of the smallest hash stays. All columns of df
    are returned as they are. Who stays is settled on keys and hashes alone. A table of bits keeps most other rows from the shuffle, and
    rows that are repeated exactly are merged before they meet, so whole rows are shuffled once and no task gets all copies of one.
    """
    rows, roots = classes(df, how)
    scratch = Scratch(df.sparkSession)
    rooted = rows.join(roots, rows["cid"] == roots["node"], "left").select("doc_id", "row", F.coalesce("root", "cid").alias("root"))
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")
    best = rooted.where(F.col("root").isNotNull()).groupBy("root").agg(F.min(place).alias("x")).select(F.col("x.doc_id").alias("id"), F.col("x.row").alias("row"))
    stay = best.union(rooted.where(F.col("root").isNull()).select(F.col("doc_id").alias("id"), "row").distinct()).distinct()
    keys = lambda c: [F.coalesce(c, F.lit(0).cast("long")).alias("known"), c.isNull().alias("none")]
    marked = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("all"), F.xxhash64("text").alias("row"), *keys(F.col("doc_id").cast("long")), _row_hash(df).alias("mark"))
    key = ["row", "known", "none"]
    counted = marked.groupBy(*key, "mark").agg(F.count("*").alias("n"))
    chosen = counted.groupBy(*key).agg(F.min(F.struct("mark", "n")).alias("x")).select(*key, "x.mark", "x.n")
    stay = scratch.write(stay.select("row", *keys(F.col("id").cast("long"))).join(chosen, key), "stay")
    key = [*key, "mark"]
    hashed = F.xxhash64(*key)
    sieved = _sieved(_sieved(marked, stay, hashed, "stays").where("stays"), stay.where("n > 1"), hashed, "several")
    merged = sieved.where("several").groupBy(*key).agg(F.first("all").alias("all"))
    return sieved.where("not several").select("all", *key).unionByName(merged).join(stay.select(*key), key).select("all.*")
