"""Secret scans in DataFrame functions alone: fixed patterns, and character Markov models for the rest.

Base kinds are found by patterns, leftmost and non-overlapping for each kind; a match that fails its length rule is dropped.
The method then looks at the remaining long mixed strings: a Markov model of random strings and one of ordinary
identifiers, both over pairs of characters and trained from labelled samples (values of base matches; words of letters),
give each string a log-likelihood ratio. Strings that the random model explains better are added as kind `markov`.
Starts and ends count code points, the end exclusive, and are those of the whole match.

Defined cases: a null or empty text has no spans; repeated rows are scanned alike; tied starts order by kind as in
KINDS; an empty table trains models of their priors and gives an empty result; without labelled strings the random model
is uniform; columns pass through, whatever their names, but `_spans`, which is replaced; very long texts and many
secrets in one text cost time near their length: texts are cut in blocks, and spans are compared in one sorted pass.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import sampled

KINDS = ["assign", "access", "hex", "markov"]
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A whole run fails or passes by its length alone, so the least length stands in the pattern.
ACCESS, HEX = "AKIA[A-Z0-9]{12,}", "[0-9a-f]{32,}"
LEAST_VALUE = 8
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_RUN = r"[A-Za-z0-9+/_=\-]"
_SPAN = "array<struct<start:long,kind:int,stop:long>>"
MARK = "[SECRET]"


@dataclass(frozen=True)
class Training:
    #: Bound of the sample of documents that the models are fitted on.
    max_documents: int = 5_000
    random_prior: float = 1.0
    identifier_prior: float = 0.05
    #: Strings this long, with letters and digits, are scored; nats in all, and a pair of characters, that make a secret.
    least_length: int = 16
    least_nats: float = 12.0
    least_nats_a_pair: float = 0.5


def _bound(value: Column, use) -> Column:
    """use(value), with the value evaluated once."""
    return F.get(F.transform(F.array(value), use), 0)


def running(values: Column, combine, start: int, block: int = 256) -> Column:
    """What an associative function of longs gives of all items before each item. Work in blocks keeps the copying of growing arrays small."""
    zero = F.lit(start).cast("long")
    grow = lambda acc, x: F.concat(acc, F.array(combine(F.element_at(acc, -1), x)))

    def each(v: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / block).cast("int"))
        part = lambda b: F.slice(v, b * block + 1, F.lit(block))
        whole = F.aggregate(F.transform(blocks, lambda b: F.aggregate(part(b), zero, combine)), F.array(zero), grow)
        return _bound(whole, lambda w: F.flatten(F.transform(blocks, lambda b: F.slice(F.aggregate(part(b), F.array(F.get(w, b)), grow), 1, F.size(part(b))))))

    return F.when(F.size(values) > 0, _bound(values, each)).otherwise(F.array().cast("array<bigint>"))


def running_totals(values: Column, block: int = 256) -> Column:
    """The sum before each item of an array of longs."""
    return running(values, lambda a, x: a + x, 0, block)


_FAR = 1 << 40


def _free(spans: Column) -> Column:
    """Of sorted spans the base ones, and those of the method that overlap none of them."""
    base = lambda s, value, other: F.when(s["kind"] < 3, s[value]).otherwise(F.lit(other).cast("long"))

    def each(v: Column) -> Column:
        before = running(F.transform(v, lambda s: base(s, "stop", 0)), lambda a, x: F.greatest(a, x), 0)
        after = F.reverse(running(F.transform(F.reverse(v), lambda s: base(s, "start", _FAR)), lambda a, x: F.least(a, x), _FAR))
        marked = F.arrays_zip(v.alias("s"), before.alias("before"), after.alias("after"))
        fits = lambda x: (x["s"]["kind"] < 3) | (x["before"] <= x["s"]["start"]) & (x["after"] >= x["s"]["stop"])
        return F.transform(F.filter(marked, fits), lambda x: x["s"])

    return _bound(spans, each)


def _matches(df: DataFrame, name: str, pattern: str) -> DataFrame:
    """Adds arrays: the strings a pattern matches, and their starts."""
    p = F.lit(pattern)
    df = df.withColumn(f"{name}_is", F.regexp_extract_all("_text", p, F.lit(0)))
    found = F.size(f"{name}_is") > 0
    lengths = lambda c: F.transform(c, lambda x: F.char_length(x).cast("long"))
    df = df.withColumn(f"{name}_gap", F.when(found, lengths(F.split("_text", pattern, -1)))).withColumn(f"{name}_len", F.when(found, lengths(F.col(f"{name}_is"))))
    step = F.zip_with(F.slice(f"{name}_gap", 1, F.size(f"{name}_len")), f"{name}_len", lambda g, n: g + n)
    df = df.withColumn(f"{name}_step", F.when(found, step)).withColumn(f"{name}_at", F.when(found, running_totals(F.col(f"{name}_step"))))
    return df.withColumn(f"{name}_at", F.zip_with(f"{name}_at", F.slice(f"{name}_gap", 1, F.size(f"{name}_len")), lambda a, g: a + g))


def _spans(name: str, kind: int, keep: Column | None = None) -> Column:
    """The matches as spans; `keep`: an array of booleans beside them."""
    spans = F.zip_with(f"{name}_at", f"{name}_len", lambda a, n: F.struct(a.alias("start"), F.lit(kind).alias("kind"), (a + n).alias("stop")))
    if keep is not None:
        both = F.zip_with(spans, keep, lambda s, k: F.struct(s.alias("s"), k.alias("k")))
        spans = F.transform(F.filter(both, lambda x: x["k"]), lambda x: x["s"])
    return F.coalesce(spans, F.array().cast(_SPAN))


def _ratio(word: Column, table: Column) -> Column:
    """The summed log-likelihood ratio of a string's pairs of characters."""
    codes = F.transform(F.split(word, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    pairs = F.sequence(F.lit(1), F.char_length(word) - 1)
    pair = lambda c, i: F.get(c, i - 1) * (len(ALPHABET) + 1) + F.get(c, i)
    return _bound(codes, lambda c: F.aggregate(pairs, F.lit(0.0), lambda acc, i: acc + F.get(table, pair(c, i))))


def train(df: DataFrame, text: str = "text", options: Training = Training()) -> list[float]:
    """The table of log-likelihood ratios of pairs of characters, fixed in size: (len(ALPHABET) + 1) squared."""
    some = sampled(df.select(F.coalesce(F.col(text), F.lit("")).alias("_text")), "_text", options.max_documents).distinct()
    values = F.filter(F.regexp_extract_all("_text", F.lit(ASSIGN), F.lit(2)), lambda v: F.char_length(v) >= LEAST_VALUE)
    hexes, accesses = (F.regexp_extract_all("_text", F.lit(p), F.lit(0)) for p in (HEX, ACCESS))
    words = F.regexp_extract_all("_text", F.lit(r"(?<![A-Za-z0-9+/_=\-])[A-Za-z_\-]{8,}[0-9]{0,4}(?![A-Za-z0-9+/_=\-])"), F.lit(0))
    tagged = lambda a, random: F.transform(F.array_distinct(a), lambda x: F.struct(x.alias("s"), F.lit(random).alias("random")))
    labelled = F.concat(tagged(values, True), tagged(hexes, True), tagged(accesses, True), tagged(words, False))
    strings = some.select(F.explode(labelled).alias("x")).select("x.s", "x.random").where(F.char_length("s") > 1)
    pairs = strings.select("random", F.explode(F.transform(F.sequence(F.lit(1), F.char_length("s") - 1), lambda i: F.substring(F.col("s"), i, F.lit(2)))).alias("pair"))
    size = len(ALPHABET) + 1
    counts = {True: [[0] * size for _ in range(size)], False: [[0] * size for _ in range(size)]}
    code = lambda c: ALPHABET.find(c) + 1
    for r in pairs.groupBy("random", "pair").count().collect():
        if len(r["pair"]) == 2:
            counts[r["random"]][code(r["pair"][0])][code(r["pair"][1])] += r["count"]

    def log(random: bool, a: int, b: int) -> float:
        prior = options.random_prior if random else options.identifier_prior
        return math.log((counts[random][a][b] + prior) / (sum(counts[random][a]) + prior * size))

    return [round(log(True, a, b) - log(False, a, b), 3) for a in range(size) for b in range(size)]


def scan(df: DataFrame, text: str = "text", model: list[float] | None = None, options: Training = Training(), spans: str = "_spans") -> DataFrame:
    """Adds the spans, in place of a column of their name: array of (start, kind as index into KINDS, stop), ordered. A model that isn't given is trained on df."""
    model = train(df, text, options) if model is None else model
    # the row stands apart, so that no name of the work clashes with one of its columns
    names = [F.col("_row").getField(c).alias(c) for c in df.columns if c != spans]
    out = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_row"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    for name, pattern in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("other", f"{_RUN}{{{options.least_length},}}")):
        out = _matches(out, name, pattern)
    long_enough = F.when(F.size("assign_is") > 0, F.transform(F.regexp_extract_all("_text", F.lit(ASSIGN), F.lit(2)), lambda v: F.char_length(v) >= LEAST_VALUE))
    out = out.withColumn("_base", F.array_sort(F.concat(_spans("assign", 0, long_enough), _spans("access", 1), _spans("hex", 2))))
    table = F.split(F.lit(",".join(map(str, model))), ",").cast("array<double>")
    least = options.least_nats
    secret = lambda w: w.rlike("[0-9]") & w.rlike("[A-Za-z]") & (_ratio(w, table) >= F.greatest(F.lit(least), options.least_nats_a_pair * (F.char_length(w) - 1)))
    out = out.withColumn("_other", _spans("other", 3, F.when(F.size("other_is") > 0, F.transform("other_is", secret))))
    both = _free(F.array_sort(F.concat("_base", "_other")))
    return out.select(*names, F.when(F.size("_other") > 0, both).otherwise(F.col("_base")).alias(spans))


def described(spans: Column) -> Column:
    """kind:start:end of spans, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def digest(df: DataFrame, text: str = "text", **options) -> DataFrame:
    """Counts of base kinds, the hash of the base spans and all spans as text, for each row."""
    base = F.filter("_spans", lambda s: s["kind"] < 3)
    count = lambda k: F.size(F.filter("_spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return scan(df, text, **options).select("doc_id", *map(count, range(4)), F.sha2(described(base).cast("binary"), 256).alias("base_sha256"), described(F.col("_spans")).alias("spans"))


def redact(df: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows with each secret, or run of overlapping secrets, replaced by MARK; null texts stay null."""
    spans = next(n for n in ("_" * k + "spans" for k in range(1, len(df.columns) + 2)) if n not in df.columns)
    scanned = scan(df, text, **options, spans=spans)
    width = 4_096
    body = F.col(f"`{text}`")

    def cut(blocks: Column, start: Column, stop: Column) -> Column:
        """The code points from start to stop, from the blocks that hold them."""
        first = F.floor(start / width).cast("int")
        held = F.slice(blocks, first + 1, F.greatest(F.ceil(stop / width).cast("int") - first, F.lit(0)))
        return F.substring(F.array_join(held, ""), (start - first * width + 1).cast("int"), (stop - start).cast("int"))

    def marked(blocks: Column) -> Column:
        def each(v: Column) -> Column:
            before = running(F.transform(v, lambda s: s["stop"]), lambda a, x: F.greatest(a, x), 0)
            heads = F.filter(F.arrays_zip(F.transform(v, lambda s: s["start"]).alias("start"), before.alias("before")), lambda x: x["start"] >= x["before"])
            kept = F.transform(heads, lambda x: cut(blocks, x["before"], x["start"]))
            end = F.array_max(F.transform(v, lambda s: s["stop"]))
            return F.array_join(F.concat(kept, F.array(cut(blocks, end, F.char_length(body).cast("long")))), MARK)

        return _bound(F.col(spans), each)

    new = _bound(F.regexp_extract_all(body, F.lit(f"(?s).{{1,{width}}}"), F.lit(0)), marked)
    return scanned.withColumn(text, F.when(F.size(spans) > 0, new).otherwise(body)).drop(spans)
