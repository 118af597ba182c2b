"""Byte-level BPE encoding and decoding by forced-boundary splitting.

A pair of neighbouring bytes that stands inside no token of the vocabulary is a certain cut: no merge can reach over it.
Texts are cut at added tokens, at white space where pre-tokens always end, by the pre-token pattern and at forced
boundaries; each fragment is encoded on its own by its merges, and the fragments' ids are concatenated. Fragments and
words recur, so a worker remembers their ids, within a bound. Decoding joins the tokens' bytes; bytes that are not UTF-8
become the replacement character.

Defined cases: a null or empty text has no ids and decodes to the empty text; an added token's string in a text is that
token; repeated rows are encoded alike; other columns are passed through by `encode` and `decode`.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.shared import bounded_batches, pieces, utf8

#: White space as the public byte-level pattern counts it; fixed values.
_WS = "\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_PRETOKEN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a vocabulary file: itself where it prints, else the next from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class Merges:
    """The merges of a BPE model, by pairs of ids."""

    def __init__(self, vocab: dict[str, int], merges: list) -> None:
        pairs = [p.split(" ") if isinstance(p, str) else p for p in merges]
        self.none = len(pairs)
        self.keys = np.array([*(vocab[a] << 20 | vocab[b] for a, b in pairs), -1], np.int64)
        self.into = np.array([vocab[a + b] for a, b in pairs], np.int64)
        # two hash tables of ranks: what shares a slot in the first has one of its own in the second
        self.tables, left = [], np.arange(self.none)
        rng = np.random.default_rng(1)
        while len(left) or not self.tables:
            factor = np.uint64(rng.integers(1 << 62) * 2 + 1)
            slots = np.full(1 << 20, self.none, np.int32)
            at = self._slot(self.keys[left], factor)
            slots[at[::-1]] = left[::-1]
            beyond = left[slots[at] != left]
            if self.tables and len(beyond):
                continue
            self.tables.append((factor, slots))
            left = beyond

    @staticmethod
    def _slot(key: np.ndarray, factor: np.uint64) -> np.ndarray:
        return (key.astype(np.uint64) * factor >> np.uint64(44)).astype(np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair's merge, or the number of merges if there is none."""
        key = left << 20 | right
        rank = np.full(len(key), self.none)
        for factor, slots in self.tables:
            found = slots[self._slot(key, factor)]
            hit = self.keys[found] == key
            rank[hit] = found[hit]
        return rank

    #: Fragments above this length are merged one by one with a heap, in time near the length; shorter ones side by side.
    long_fragment = 256

    def merged(self, ids: np.ndarray, lengths: np.ndarray) -> list[bytes]:
        """Little-endian ids of fragments that lie one after the other."""
        raw, ends = self.packed(ids, lengths)
        ends = ends.tolist()
        return [raw[i:j] for i, j in zip([0, *ends], ends, strict=False)]

    def packed(self, ids: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The same in one piece, and where each fragment's bytes end."""
        long = lengths > self.long_fragment
        if not long.any():
            return self._side_by_side(ids, lengths)
        raw, stops = self._side_by_side(ids[np.repeat(~long, lengths)], lengths[~long]) if not long.all() else (b"", np.zeros(0, np.int64))
        stops, short, at = stops.tolist(), 0, 0
        parts = []
        for end, n, alone in zip(np.cumsum(lengths).tolist(), lengths.tolist(), long.tolist(), strict=True):
            if alone:
                parts.append(self._alone(ids[end - n : end]))
            else:
                parts.append(raw[at : stops[short]])
                at, short = stops[short], short + 1
        return b"".join(parts), np.cumsum(list(map(len, parts)))

    def _alone(self, ids: np.ndarray) -> bytes:
        """One long fragment: a heap has all pairs that merge, by rank and place; neighbours are linked both ways."""
        none, n = self.none, len(ids)
        rank = self._ranks(ids[:-1], ids[1:])
        at = np.flatnonzero(rank < none)
        heap = list(zip(rank[at].tolist(), at.tolist(), strict=True))
        heapq.heapify(heap)
        if not hasattr(self, "pairs"):
            self.pairs = dict(zip(self.keys.tolist(), range(none), strict=False))
        pairs, into = self.pairs, self.into
        token, now = ids.tolist(), rank.tolist() + [none]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        push, pop = heapq.heappush, heapq.heappop
        while heap:
            r, i = pop(heap)
            if now[i] != r:
                continue
            j = after[i]
            token[i], now[j] = int(into[r]), none
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                now[i] = q = pairs.get(token[i] << 20 | token[k], none)
                if q < none:
                    push(heap, (q, i))
            else:
                now[i] = none
            token[j] = -1
            if (h := before[i]) >= 0:
                now[h] = q = pairs.get(token[h] << 20 | token[i], none)
                if q < none:
                    push(heap, (q, h))
        return np.array([t for t in token if t >= 0], "<u4").tobytes()

    def _side_by_side(self, ids: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
        """In every round each unfinished fragment merges its pair of least rank, the leftmost first."""
        none = self.none
        owner = np.repeat(np.arange(len(lengths)), lengths)
        rank = np.full(len(ids), none)
        inner = np.flatnonzero(owner[:-1] == owner[1:])
        rank[inner] = self._ranks(ids[inner], ids[inner + 1])
        done = []
        while len(ids):
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            size = np.diff(np.append(starts, len(ids)))
            least = np.repeat(np.minimum.reduceat(rank, starts), size)
            rest = least < none
            done.append((owner[~rest], ids[~rest]))
            ids, owner, rank, least = ids[rest], owner[rest], rank[rest], least[rest]
            if not len(ids):
                break
            at = np.flatnonzero(rank == least)
            at = at[np.concatenate([[True], owner[at[1:]] != owner[at[:-1]]])]
            ids[at] = self.into[rank[at]]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids, owner, rank = ids[keep], owner[keep], rank[keep]
            at -= np.arange(len(at))
            for i in (at, at[at > 0] - 1):
                rank[i] = none
                i = i[i + 1 < len(ids)]
                i = i[owner[i] == owner[i + 1]]
                rank[i] = self._ranks(ids[i], ids[i + 1])
        owner, ids = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(owner, kind="stable")
        return ids[order].astype("<u4").tobytes(), 4 * np.cumsum(np.bincount(owner, minlength=len(lengths)))


class Codec:
    """A byte-level vocabulary with its merges, and what has been encoded with it."""

    def __init__(self, path: str, most: int) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte = {c: i for i, c in enumerate(byte_letters())}
        vocab, self.most = spec["model"]["vocab"], most
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [b""] * (max([*vocab.values(), *self.added.values()]) + 1)
        inside = np.zeros((256, 256), bool)
        for token, i in vocab.items():
            if token not in self.added:
                self.tokens[i] = raw = bytes(byte[c] for c in token)
                letters = np.frombuffer(raw, np.uint8)
                inside[letters[:-1], letters[1:]] = True
        for token, i in self.added.items():
            self.tokens[i] = token.encode()
        self.forced = ~inside
        ids = {t: i for i, t in enumerate(self.tokens)}
        self.single = np.array([ids[bytes([b])] for b in range(256)], np.int64)
        self.merges = Merges(vocab, spec["model"]["merges"])
        self.pretokens = regex.compile(_PRETOKEN)
        self.chunks = regex.compile(f"[{_WS}]*[^{_WS}]+|[{_WS}]+")
        self.uneven = regex.compile(f"[^\\P{{White_Space}} \\n]| [ \\n]|\\n |^ | $")
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.words: dict[str, bytes] = {}
        self.fragments: dict[bytes, bytes] = {}

    def _learn(self, chunks: list[str]) -> None:
        """Ids of new chunks: pre-tokens, forced cuts inside them, and their fragments' merges."""
        pre = [[p.encode() for p in self.pretokens.findall(c)] for c in chunks]
        sizes = np.array([len(p) for x in pre for p in x])
        raw = b"".join(p for x in pre for p in x)
        letters = np.frombuffer(raw, np.uint8)
        cut = np.concatenate([[True], self.forced[letters[:-1], letters[1:]]])
        cut[np.cumsum(sizes)[:-1]] = True
        at = np.flatnonzero(cut).tolist()
        parts = [raw[i:j] for i, j in zip(at, [*at[1:], len(raw)], strict=True)]
        known = self.fragments
        if new := list({p for p in parts if p not in known}):
            ids = self.single[np.frombuffer(b"".join(new), np.uint8)]
            known.update(zip(new, self.merges.merged(ids, np.array(list(map(len, new)))), strict=True))
        ends = np.searchsorted(at, np.cumsum([sum(map(len, x)) for x in pre])).tolist()
        for c, i, j in zip(chunks, [0, *ends], ends, strict=False):
            self.words[c] = known[parts[i]] if j == i + 1 else b"".join(known[p] for p in parts[i:j])

    def _chunks(self, text: str) -> list[str]:
        """Pieces that start where a pre-token surely does: before white space that follows other characters."""
        if "\0" in text or self.uneven.search(text):
            return self.chunks.findall(text)
        return text.replace(" ", "\0 ").split("\0")

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        for memory in (self.words, self.fragments):
            if len(memory) > self.most:
                memory.clear()
        words = self.words
        split = [self.specials.split(t) if self.specials else [t] for t in texts]
        chunks = [[self._chunks(p) if p and i % 2 == 0 else [] for i, p in enumerate(x)] for x in split]
        if new := [c for c in {c for x in chunks for y in x for c in y} if c not in words]:
            self._learn(new)
        added = lambda p: np.array([self.added[p]], "<u4").tobytes()
        return [b"".join(added(p) if i % 2 else b"".join(map(words.__getitem__, c)) for i, (p, c) in enumerate(zip(x, y, strict=True))) for x, y in zip(split, chunks, strict=True)]

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the text; what isn't valid is replaced."""
        raw = b"".join(map(self.tokens.__getitem__, ids.tolist()))
        return raw.decode("utf-8", "replace").encode()


@dataclass(frozen=True)
class Coding:
    tokenizer: str
    #: Words and fragments that a worker remembers.
    remembered: int = 500_000


_codecs: dict[Coding, Codec] = {}


def codec(how: Coding) -> Codec:
    if how not in _codecs:
        _codecs[how] = Codec(how.tokenizer, how.remembered)
    return _codecs[how]


def _with(df: DataFrame, fields: list[tuple[str, T.DataType, pa.DataType]], source: str, work) -> DataFrame:
    """Adds columns computed from one column, replacing any of the same names; work(list) gives rows."""
    bounded_batches(df.sparkSession)
    new = [f[0] for f in fields]
    keep = [f for f in df.schema.fields if f.name not in new]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(source))
            rows = list(zip(*work(column), strict=True)) or [[] for _ in new]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(f.name)) for f in keep), *(pa.array(r, f[2]) for r, f in zip(rows, fields, strict=True))], names=[*(f.name for f in keep), *new])

    return df.mapInArrow(run, T.StructType([*keep, *(T.StructField(n, t) for n, t, _ in fields)]))


def _coded(column: pa.Array, how: Coding) -> Iterator[bytes]:
    texts = utf8(column)
    for part in pieces(texts):
        yield from codec(how).encode([t.decode() for t in texts[part]])


def encode(df: DataFrame, how: Coding, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds the ids of each text as an array."""
    return _with(df, [(ids, T.ArrayType(T.IntegerType()), pa.list_(pa.int32()))], text, lambda c: ((np.frombuffer(x, "<i4"),) for x in _coded(c, how)))


def decode(df: DataFrame, how: Coding, ids: str = "ids", text: str = "text") -> DataFrame:
    """Adds the text of each array of ids; null ids give the empty text."""
    return _with(df, [(text, T.StringType(), pa.string())], ids, lambda c: ((codec(how).decode(np.array(x or [], np.int64)).decode(),) for x in c.to_pylist()))


def digest(df: DataFrame, how: Coding) -> DataFrame:
    """doc_id, the number of ids, their hash, and the hash of the text that they decode to."""

    def row(raw: bytes) -> tuple:
        decoded = codec(how).decode(np.frombuffer(raw, "<u4"))
        return len(raw) // 4, hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded).hexdigest()

    fields = [("n_tokens", T.LongType(), pa.int64()), ("ids_sha256", T.StringType(), pa.string()), ("decoded_sha256", T.StringType(), pa.string())]
    return _with(df.select("doc_id", "text"), fields, "text", lambda c: map(row, _coded(c, how))).drop("text")
