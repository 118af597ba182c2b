"""Quality rules by repetition coverage.

Rolling hashes of the words' n-grams, for several n, in numpy: which share of a text's word characters lies
inside n-grams that occur more than once in it, inside its most frequent short n-gram, and in repeated lines. A text
whose shares stay at or below the limits is kept. Texts are judged whole and one by one, so no rows meet in a shuffle.

Defined cases: a null or blank text has no words, fails the base rule and isn't kept; repeated rows are judged
alike; other columns pass through `judge` untouched; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import wordhash
from tidemark.llm.shared import bounded_batches, pieces, utf8

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Limits:
    """Most a kept text may have. Shares are of the characters in words."""

    min_words: int = 50
    max_repeat_words: float = 0.5
    line_share: float = 0.30
    #: n -> largest share that one n-gram has, if it occurs top_times or more
    top_times: int = 3
    top_share: dict[int, float] = field(default_factory=lambda: {2: 0.20, 3: 0.18, 4: 0.16})
    #: n -> share of characters inside n-grams found twice or more
    repeat_share: dict[int, float] = field(default_factory=lambda: {5: 0.45, 6: 0.43, 7: 0.41, 8: 0.39, 9: 0.37, 10: 0.35})


FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SCHEMA = T.StructType([*(T.StructField(c, T.LongType()) for c in FIELDS), T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()), T.StructField("worst_rule", T.StringType())])


def _times(grams: np.ndarray) -> np.ndarray:
    """How often each value occurs."""
    order = np.argsort(grams)
    ordered = grams[order]
    edges = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1], [True]])) if len(grams) else np.zeros(1, np.int64)
    out = np.empty(len(grams), np.int64)
    out[order] = np.repeat(np.diff(edges), np.diff(edges))
    return out


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the values from each start to each end."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[ends] - total[starts]


def _most(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """The largest value of each owner, 0 if none."""
    out = np.zeros(n, np.int64)
    np.maximum.at(out, owner, values)
    return out


def measure(texts: list[bytes], limits: Limits = Limits()) -> list[tuple]:
    """The values of SCHEMA for each text. An n-gram can recur only where its first n - 1 words do: longer ones are looked up there alone."""
    n_texts = len(texts)
    buf, at = wordhash.join(texts)
    starts, ends = wordhash.word_spans(buf)
    hashes = wordhash.hash_spans(buf, starts, ends)
    letters = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
    sizes = letters[ends] - letters[starts]
    first_word = np.searchsorted(starts, at)
    begin, end = first_word[:-1], first_word[1:]
    owner = np.repeat(np.arange(n_texts), end - begin)
    n_words, total = end - begin, _sums(sizes, begin, end)
    n_symbols = _sums(_SYMBOL[buf], at[:-1], at[1:])

    breaks = np.flatnonzero(buf == 10)
    line_starts = np.concatenate([[0], breaks[:-1] + 1])
    first, last = np.searchsorted(starts, line_starts), np.searchsorted(starts, breaks)
    worded = last > first
    line_starts, breaks, first, last = (x[worded] for x in (line_starts, breaks, first, last))
    line_owner = owner[first]
    lines = wordhash.mix(wordhash.hash_spans(buf, line_starts, breaks) + line_owner.astype(np.uint64))
    later = np.ones(len(lines), bool)
    later[np.unique(lines, return_index=True)[1]] = False
    n_dup_lines = np.bincount(line_owner[later], minlength=n_texts)
    floor = np.maximum(total, 1)
    dup_chars = np.zeros(n_texts, np.int64)
    np.add.at(dup_chars, line_owner[later], _sums(sizes, first[later], last[later]))
    shares = {"lines": (dup_chars / floor, limits.line_share)}

    n_repeat_words = np.zeros(n_texts, np.int64)
    where, rolled = np.arange(len(hashes)), wordhash.mix(hashes + owner.astype(np.uint64))
    for n in range(2, max(3, *limits.top_share, *limits.repeat_share) + 1):
        fits = where + n <= end[owner[where]]
        where = where[fits]
        rolled = wordhash.mix(rolled[fits] * np.uint64(0x9E3779B97F4A7C15) + hashes[where + n - 1])
        times = _times(rolled)
        where, rolled, times = where[times > 1], rolled[times > 1], times[times > 1]
        if n in limits.top_share:
            often = times >= limits.top_times
            at_often = where[often]
            shares[f"top_{n}"] = (_most(times[often] * _sums(sizes, at_often, at_often + n), owner[at_often], n_texts) / floor, limits.top_share[n])
        if n == 3 or n in limits.repeat_share:
            edge = np.zeros(len(hashes) + 1, np.int64)
            edge[where] += 1
            edge[where + n] -= 1
            covered = np.cumsum(edge[:-1]) > 0
            if n == 3:
                n_repeat_words = _sums(covered, begin, end)
            if n in limits.repeat_share:
                shares[f"repeat_{n}"] = (_sums(sizes * covered, begin, end) / floor, limits.repeat_share[n])

    failed = (n_words < limits.min_words) | (n_repeat_words > limits.max_repeat_words * n_words)
    names = [*shares]
    excess = np.array([share / most for share, most in shares.values()])
    worst, over = excess.argmax(axis=0), (excess > 1).any(axis=0)
    rules = ["base" if f else names[w] if o else None for f, w, o in zip(failed, worst, over, strict=True)]
    return list(zip(*(x.tolist() for x in (n_words, total, n_symbols, n_dup_lines, n_repeat_words, failed, ~failed & ~over)), rules, strict=True))


def judge(df: DataFrame, text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """Adds the columns of SCHEMA to each row; columns of df with those names are replaced."""
    bounded_batches(df.sparkSession)
    keep = [f for f in df.schema.fields if f.name not in SCHEMA.names]
    names = [f.name for f in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                texts = utf8(batch.column(len(names)))
                measured = [row for part in pieces(texts) for row in measure(texts[part], limits)]
                rows = list(zip(*measured, strict=True)) or [[] for _ in SCHEMA]
                kinds = [*(pa.int64() for _ in FIELDS), pa.bool_(), pa.bool_(), pa.string()]
                yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in names), *(pa.array(v, k) for v, k in zip(rows, kinds, strict=True))], names=[*names, *SCHEMA.names])

    # the text goes last and is found by its place, whatever its name
    source = df.select(*(F.col(f"`{c}`") for c in names), F.col(text).alias("".join(["text", *names])))
    return source.mapInArrow(run, T.StructType([*keep, *SCHEMA.fields]))
