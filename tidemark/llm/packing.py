"""Packing of tokenised documents into sequences by cutting-stock column generation.

1. Each document is encoded once; only its length and checksums are kept. A document gives full sequences of its own,
   and a remainder shorter than the capacity.
2. The remainders' length histogram (in `classes` lengths) is a cutting-stock problem. Its linear program is solved over
   patterns, one pattern being what one sequence holds; an unbounded knapsack by dynamic programming prices new ones.
   Patterns rounded down, and first-fit ones for what is left, say how many of each length every sequence takes.
3. Documents of one length class are ranked and dealt to the patterns' places in order of rank.
4. Rounding lengths up leaves gaps. Some documents, chosen by hash so that their tokens just outweigh all gaps, are cut
   into them: gaps and fillers are laid along one line of tokens, and overlapping intervals are joined by line cell.
   What the fillers have beyond the gaps becomes sequences of its own, the last ones as powers of two. So nothing is padded.

The driver sees tables of fixed size alone: counts by hash bucket and length class, patterns, bucket sums.

Defined cases: a null text is an empty one, which has the end id alone; repeated rows are packed each for itself; null
ids stay null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from tidemark.llm.bpe import Merges, byte_letters
from tidemark.llm.shared import bounded_batches, repeated, written


@dataclass(frozen=True)
class Packing:
    tokenizer: str
    end_id: int = 2
    capacity: int = 4096
    classes: int = 64
    #: Hash buckets for ranks and fillers, and ranges of sequences for running sums.
    buckets: int = 512
    #: More repetitions of a row than this are made in several tasks.
    repeat_block: int = 1 << 16
    #: A worker remembers the ids of twice as many words.
    cached_words: int = 120_000


class WordEncoder:
    """Ids of whole texts from ids of their words, for tokenizers that drop white space between words; words are remembered.

    The words of a batch get numbers next to the remembered ones, so only different words are worked on, and the batch's ids are
    theirs, taken by number. New words of plain Western letters, digits and marks are cut into the tokenizer's own pre-tokens,
    and the different ones among these are merged all at once; other words go through the tokenizer itself. When there are too
    many, the words that occurred most stay; their counts are halved then, so that those of long ago make room. A batch of few
    words meets only some four times as many remembered ones, and adds none where there are more.
    """

    #: What isn't printing ASCII or a letter of Latin-1, which normalisation leaves as they are, and the start of added tokens; fixed values.
    _odd = re.compile("[^ -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]|<\\|")
    #: Pre-tokens of what is left, in UTF-8: all bytes beyond ASCII are letters there.
    _parts = re.compile(rb"'(?:s|t|re|ve|m|ll|d)|[a-z\x80-\xff]+|[0-9]| |[^ a-z0-9\x80-\xff]+")
    #: Words of more bytes aren't remembered.
    long_word = 256

    def __init__(self, path: str, most: int) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, letters, end = model["vocab"], byte_letters(), model["end_of_word_suffix"]
        self.merges = Merges(vocab, model["merges"])
        self.inner, self.last = (np.array([vocab[c + suffix] for c in letters], np.int64) for suffix in ("", end))
        self.most = 2 * most + 1
        # the empty word, which stands where a text begins or ends with white space, is always known
        self.words, self.known, self.counts = pa.array([""], pa.large_string()), pa.array([b""], pa.large_binary()), np.array([np.inf])

    def _learn(self, words: list[bytes], text: str) -> pa.Array:
        """Ids of new plain words, which `text` has in the same order with a space between them."""
        parts = pa.array(self._parts.findall(text.lower().encode()), pa.large_binary()).dictionary_encode()
        found, at = parts.dictionary, parts.indices.to_numpy()
        sizes = pc.binary_length(found).to_numpy().astype(np.int64)
        letters, ends = np.frombuffer(found.buffers()[2], np.uint8, sizes.sum()), np.cumsum(sizes) - 1
        ids = self.inner[letters]
        ids[ends] = self.last[letters[ends]]
        gaps, space = np.zeros(0, np.int64), 0
        if len(words) > 1:  # a space, which is never the first, has no ids
            space = pc.index(found, b" ").as_py()
            gaps = np.flatnonzero(at == space)
            ids, sizes = np.delete(ids, ends[space]), np.delete(sizes, space)
        packed, stops = self.merges.packed(ids, sizes)
        if space:
            stops = np.insert(stops, space, stops[space - 1])
        return _joined(_binary(packed, np.append(0, stops)), at, np.concatenate([[0], gaps, [len(at)]]))

    def _formed(self, fresh: pa.Array) -> pa.Array:
        """Ids of words that aren't known."""
        words = fresh.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        text = b" ".join(words).decode()
        odd, at, k = set(), 0, 0
        for m in self._odd.finditer(text):
            k += text.count(" ", at, m.start())
            at = m.start()
            odd.add(k)
        if not odd:
            return self._learn(words, text)
        plain = [w for k, w in enumerate(words) if k not in odd]
        others = pa.array([array("I", self.tokenizer.encode(words[k].decode(), add_special_tokens=False).ids).tobytes() for k in sorted(odd)], pa.large_binary())
        if not plain:
            return others
        is_odd = np.zeros(len(words), bool)
        is_odd[list(odd)] = True
        order = np.where(is_odd, len(plain) + np.cumsum(is_odd), np.cumsum(~is_odd)) - 1
        return pa.concat_arrays([self._learn(plain, b" ".join(plain).decode()), others]).take(pa.array(order))

    def _remember(self, words: pa.Array, ids: pa.Array, counts: np.ndarray) -> None:
        """All words, or those that occurred most, by their counts; the empty one stays first."""
        keep = np.flatnonzero(pc.binary_length(words).to_numpy() <= self.long_word)
        if len(keep) > self.most:
            keep, counts = keep[np.argsort(-counts[keep], kind="stable")[: self.most]], counts / 2
        if len(keep) < len(words):
            words, ids, counts = words.take(pa.array(keep)), ids.take(pa.array(keep)), counts[keep]
        self.words, self.known, self.counts = words, ids, counts

    def ids(self, texts: pa.Array, end: bytes = b"") -> pa.Array:
        """Little-endian unsigned 32-bit ids of each text of a string column, with `end` behind them; null is an empty text."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        found = split.flatten()
        k = min(len(self.words), 4 * len(found) + 1)
        coded = pa.concat_arrays([self.words[:k], found]).dictionary_encode()
        words, at = coded.dictionary, coded.indices.to_numpy()[k:]
        ids = pa.concat_arrays([self.known[:k], self._formed(words[k:])]) if len(words) > k else self.known[:k]
        # the end's number stands behind those of each text's words
        bounds = np.append(0, np.cumsum(split.value_lengths().to_numpy().astype(np.int64) + 1))
        order = np.full(bounds[-1], len(words), np.int64)
        inner = np.ones(len(order), bool)
        inner[bounds[1:] - 1] = False
        order[inner] = at
        out = _joined(pa.concat_arrays([ids, pa.array([end], pa.large_binary())]), order, bounds)
        if k == len(self.words):
            counts = np.bincount(at, minlength=len(words)).astype(float)
            counts[:k] += self.counts
            self._remember(words, ids, counts)
        return out

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        return self.ids(pa.array(texts, pa.large_binary()).cast(pa.large_string())).to_pylist()


def _binary(data: bytes | pa.Buffer | None, offsets: np.ndarray) -> pa.Array:
    """Values that lie one after the other in `data`."""
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(b"" if data is None else data)])


def _joined(values: pa.Array, order: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The values of the numbers `order`, joined from each of the bounds to the next."""
    _, offsets, data = (laid := values.take(pa.array(order))).buffers()
    return _binary(data, np.frombuffer(offsets, np.int64)[laid.offset : laid.offset + len(laid) + 1][bounds]) if len(order) else _binary(None, np.zeros(len(bounds)))


_encoders: dict[tuple, WordEncoder] = {}


def encoder(how: Packing) -> WordEncoder:
    """One for each worker, whose words outlast a task."""
    key = (how.tokenizer, how.cached_words)
    if key not in _encoders:
        _encoders[key] = WordEncoder(*key)
    return _encoders[key]


def _encoded(batches: Iterator[pa.RecordBatch], how: Packing) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    end = np.array([how.end_id], "<u4").tobytes()
    for batch in batches:
        yield batch, encoder(how).ids(batch.column(batch.schema.get_field_index("text")), end)


def measured(docs: DataFrame, how: Packing) -> DataFrame:
    """doc_id, h, n tokens and the checksums of each stretch of `capacity` ids, the last one maybe shorter."""

    def run(batches):
        step = 4 * how.capacity
        for batch, ids in _encoded(batches, how):
            _, offsets, data = ids.buffers()
            raw, ends = memoryview(data), np.frombuffer(offsets, np.int64).tolist()
            crcs = [[zlib.crc32(raw[i : min(i + step, stop)]) for i in range(start, stop, step)] for start, stop in pairwise(ends)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pc.divide(pc.binary_length(ids), 4), pa.array(crcs, pa.list_(pa.int64()))], names=["doc_id", "h", "n", "crcs"])

    return docs.mapInArrow(run, "doc_id long, h long, n long, crcs array<long>")


def _knapsack(value: np.ndarray, width: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Most value of items, each as often as wanted, in the room; by dynamic programming."""
    best, last = np.zeros(room + 1), np.full(room + 1, -1)
    for r in range(1, room + 1):
        best[r] = best[r - 1]
        fits = np.flatnonzero(width <= r)
        if len(fits):
            worth = best[r - width[fits]] + value[fits]
            k = int(worth.argmax())
            if worth[k] > best[r] + 1e-12:
                best[r], last[r] = worth[k], fits[k]
    pattern, r = np.zeros(len(width), np.int64), room
    while r > 0:
        if last[r] < 0:
            r -= 1
        else:
            pattern[last[r]] += 1
            r -= width[last[r]]
    return float(best[room]), pattern


def patterns(demand: dict[int, int], room: int, most_columns: int = 5_000) -> list[tuple[dict[int, int], int]]:
    """[(width -> how many in one sequence, number of such sequences)] that hold all items of the demand (width -> count)."""
    width = np.array(sorted((w for w, d in demand.items() if d > 0), reverse=True), np.int64)
    if not len(width):
        return []
    left = np.array([demand[w] for w in width.tolist()], np.int64)
    basis = np.diag(room // width).astype(float)
    for _ in range(most_columns):
        inverse = np.linalg.inv(basis)
        x = inverse @ left
        value, column = _knapsack(np.ones(len(width)) @ inverse, width, room)
        if value <= 1 + 1e-9:
            break
        direction = inverse @ column
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(direction > 1e-9, np.maximum(x, 0) / direction, np.inf)
        basis[:, int(ratio.argmin())] = column
    out, times = [], np.floor(np.linalg.solve(basis, left.astype(float)) + 1e-6).astype(np.int64)
    for j in np.argsort(-times, kind="stable"):
        p = basis[:, j].round().astype(np.int64)
        with np.errstate(divide="ignore"):
            k = int(max(0, min(times[j], *(left[p > 0] // p[p > 0]))))
        if k:
            out.append((p, k))
            left -= k * p
    while left.any():
        p, r = np.zeros_like(left), room
        for i, w in enumerate(width):
            p[i] = min(left[i], r // w)
            r -= p[i] * w
        k = int(min(left[p > 0] // p[p > 0]))
        out.append((p, k))
        left -= k * p
    return [({int(w): int(n) for w, n in zip(width, p, strict=True) if n}, k) for p, k in out]


def _places(found: list[tuple[dict[int, int], int]], base: int) -> dict[int, np.ndarray]:
    """Class -> rows (first rank, first sequence, items of the class in one sequence)."""
    out: dict[int, list] = {}
    ranks: dict[int, int] = {}
    for pattern, times in found:
        for w, n in pattern.items():
            out.setdefault(w, []).append((ranks.get(w, 0), base, n))
            ranks[w] = ranks.get(w, 0) + n * times
        base += times
    return {w: np.array(rows, np.int64) for w, rows in out.items()}


def pack(df: DataFrame, how: Packing) -> DataFrame:
    """Pieces of all rows of (doc_id, text): doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = df.sparkSession
    bounded_batches(spark)
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", text).alias("h"), text.alias("text"))
    unit, cap, buckets = how.capacity // how.classes, how.capacity, how.buckets
    bucket = F.pmod(F.shiftright("h", 20), F.lit(buckets)).cast("int")
    rows = written(measured(docs, how), "measured").withColumn("rest", F.col("n") % cap).withColumn("full", F.floor(F.col("n") / cap)).withColumn("class", F.ceil(F.col("rest") / unit).cast("int")).withColumn("bucket", bucket)

    cells = rows.groupBy("class", "bucket").agg(F.count("*").alias("k"), F.sum("rest").alias("tokens"), F.sum("full").alias("full")).collect()
    count, tokens, full = (np.zeros((buckets, how.classes + 1), np.int64) for _ in range(3))
    for c in cells:
        count[c["bucket"], c["class"]], tokens[c["bucket"], c["class"]], full[c["bucket"], c["class"]] = c["k"], c["tokens"], c["full"]
    count[:, 0] = 0

    def plan(fillers: int) -> tuple[list, int]:
        found = patterns({w: int(count[fillers:, w].sum()) for w in range(1, how.classes + 1)}, how.classes)
        return found, cap * sum(k for _, k in found) - int(tokens[fillers:].sum())

    fillers = 0
    while True:
        found, gap = plan(fillers)
        have = int(tokens[:fillers].sum())
        if have >= gap:
            break
        short, fillers = gap - have, fillers + 1
        while fillers < buckets and tokens[:fillers].sum() - have < short:
            fillers += 1
    n_full, n_patterns = int(full.sum()), sum(k for _, k in found)
    beyond = int(tokens[:fillers].sum()) - gap

    before = lambda a, key: dict(zip(key, np.concatenate([[0], np.cumsum(a)[:-1]]).tolist(), strict=True))
    cell = [(b, c) for b in range(buckets) for c in range(how.classes + 1)]
    full_at, filler_at = before(full.reshape(-1), cell), before(np.where(np.arange(buckets)[:, None] < fillers, tokens, 0).reshape(-1), cell)
    kept = np.where(np.arange(buckets)[:, None] >= fillers, count, 0)
    rank_at = np.cumsum(kept, axis=0) - kept
    bases = spark.createDataFrame([(b, c, full_at[b, c], filler_at[b, c], int(rank_at[b, c])) for b, c in cell if count[b, c] or full[b, c]], "bucket int, class int, full_at long, filler_at long, rank_at long")
    # repeated rows are one row with a count while the others are ranked; their copies are numbered from its place on
    kept_columns = ["doc_id", "h", "n", "crcs", "rest", "full", "class", "bucket"]
    rows = rows.groupBy(*kept_columns).agg(F.count("*").alias("copies"))
    earlier = Window.partitionBy("bucket", "class").orderBy("h", "doc_id", "n", "crcs").rowsBetween(Window.unboundedPreceding, -1)
    before_it = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    ranked = rows.withColumns({"rank_before": before_it(F.col("copies")), "full_before": before_it(F.col("full") * F.col("copies")), "rest_before": before_it(F.col("rest") * F.col("copies"))})
    ranked = repeated(ranked.join(F.broadcast(bases), ["bucket", "class"]), "copies", ["h"], how.repeat_block)
    place = lambda at, before, each: (F.col(at) + F.col(before) + F.col("copy") * each)
    ranked = written(ranked.select(*kept_columns, place("full_at", "full_before", F.col("full")).alias("first_full"), place("filler_at", "rest_before", F.col("rest")).alias("line"), place("rank_at", "rank_before", 1).alias("rank")), "ranked")

    doc = ["doc_id", "n"]
    result = lambda d: d.select("doc_id", F.col("start").cast("long"), F.col("length").cast("long"), F.col("crc").alias("ids_crc32"), F.col("n").alias("doc_tokens"), F.col("sequence_id").cast("long"), F.col("offset").cast("long"))
    whole = ranked.where("full > 0").select(*doc, "first_full", F.posexplode(F.slice("crcs", F.lit(1), F.col("full").cast("int"))).alias("i", "crc"))
    whole = whole.withColumn("start", F.col("i") * cap).withColumn("length", F.lit(cap)).withColumn("sequence_id", F.col("first_full") + F.col("i")).withColumn("offset", F.lit(0))

    places = spark.sparkContext.broadcast(_places(found, n_full))

    def deal(batches):
        for batch in batches:
            kind, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("class", "rank"))
            sequence = np.zeros(len(kind), np.int64)
            for c in np.unique(kind).tolist():
                table, mine = places.value[c], kind == c
                row = table[np.searchsorted(table[:, 0], rank[mine], "right") - 1]
                sequence[mine] = row[:, 1] + (rank[mine] - row[:, 0]) // row[:, 2]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequence)], names=[*batch.schema.names, "sequence_id"])

    rests = ranked.where((F.col("rest") > 0) & (F.col("bucket") >= fillers)).select(*doc, "h", "full", "rest", "class", "rank", F.get("crcs", F.col("full").cast("int")).alias("crc"))
    dealt = rests.mapInArrow(deal, "doc_id long, n long, h long, full long, rest long, class int, rank long, crc long, sequence_id long")
    order = Window.partitionBy("sequence_id").orderBy(F.desc("class"), "rank")
    dealt = written(dealt.withColumn("offset", F.coalesce(F.sum("rest").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))), "dealt")
    packed = dealt.withColumn("start", F.col("full") * cap).withColumn("length", F.col("rest"))

    share = F.floor((F.col("sequence_id") - n_full) * buckets / max(1, n_patterns)).cast("int")
    gaps = dealt.groupBy("sequence_id").agg((cap - F.sum("rest")).alias("gap")).withColumn("share", share)
    sums = dict(gaps.groupBy("share").agg(F.sum("gap")).collect()) if n_patterns else {}
    starts = np.concatenate([[0], np.cumsum([sums.get(i, 0) for i in range(buckets + 1)])])
    shares = spark.createDataFrame([(i, int(starts[i])) for i in range(buckets + 1)], "share int, share_at long")
    running = F.coalesce(F.sum("gap").over(Window.partitionBy("share").orderBy("sequence_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    holes = gaps.withColumn("before", running).join(F.broadcast(shares), "share").select("sequence_id", (F.col("before") + F.col("share_at")).alias("g0"), "gap", (cap - F.col("gap")).alias("filled"))
    extra, tail = divmod(beyond, cap)
    base = n_full + n_patterns
    ends, at = [], gap + extra * cap
    for bit in range(cap.bit_length() - 1, -1, -1):
        if tail >> bit & 1:
            ends.append((base + extra + len(ends), at, 1 << bit, 0))
            at += 1 << bit
    more = spark.range(extra).select((F.col("id") + base).alias("sequence_id"), (F.col("id") * cap + gap).alias("g0"), F.lit(cap).cast("long").alias("gap"), F.lit(0).cast("long").alias("filled"))
    holes = holes.union(more).union(spark.createDataFrame(ends, "sequence_id long, g0 long, gap long, filled long")).where("gap > 0")

    cells_of = lambda a, n: F.explode(F.sequence(F.floor(F.col(a) / cap), F.floor((F.col(a) + F.col(n) - 1) / cap))).alias("cell")
    cut = ranked.where((F.col("rest") > 0) & (F.col("bucket") < fillers)).select(*doc, "h", "full", "rest", "line", cells_of("line", "rest"))
    lo, hi = F.greatest("line", "g0"), F.least(F.col("line") + F.col("rest"), F.col("g0") + F.col("gap"))
    fills = cut.join(holes.select("*", cells_of("g0", "gap")), "cell").where((lo < hi) & (F.col("cell") == F.floor(lo / cap)))
    fills = fills.select(*doc, "h", (F.col("full") * cap + lo - F.col("line")).alias("start"), (hi - lo).alias("length"), "sequence_id", (F.col("filled") + lo - F.col("g0")).alias("offset"))

    def ids_of(batches):
        for batch, ids in _encoded(batches, how):
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), ids.cast(pa.binary())], names=["doc_id", "h", "ids"])

    chosen = docs.where(bucket < fillers).mapInArrow(ids_of, "doc_id long, h long, ids binary").groupBy("h", F.coalesce("doc_id", F.lit(-1)).alias("key")).agg(F.first("ids").alias("ids"))

    def checksums(batches):
        for batch in batches:
            ids, start, length = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("ids", "start", "length"))
            crc = [zlib.crc32(x[4 * a : 4 * (a + n)]) for x, a, n in zip(ids, start, length, strict=True)]
            keep = [i for i, c in enumerate(batch.schema.names) if c != "ids"]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(crc, pa.int64())], names=[*(batch.schema.names[i] for i in keep), "crc"])

    # copies that are cut alike need one checksum, so a document of many copies doesn't meet its ids once a copy
    fills, cut_of = fills.withColumn("key", F.coalesce("doc_id", F.lit(-1))), ["h", "key", "start", "length"]
    sums_of = fills.select(*cut_of).distinct().join(chosen, ["h", "key"]).select(*cut_of, "ids").mapInArrow(checksums, "h long, key long, start long, length long, crc long")
    fills = fills.join(sums_of, cut_of)
    return result(whole).union(result(packed)).union(result(fills))
