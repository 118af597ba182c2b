"""SentencePiece encoding and decoding of merge-type vocabularies by a score-ordered agenda of adjacent symbol pairs.

A text gets a leading space mark and its spaces become marks; every character is a symbol. The agenda has each pair of
neighbours whose concatenation is a piece, by score (the higher first) and then by place (the leftmost first); the first
pair merges, and its new neighbours enter the agenda. Symbols left over that are no pieces become their UTF-8 bytes' pieces.

Where no piece holds a space mark behind another character, no merge reaches over such a place, and characters inside no
longer piece never merge: texts fall into fragments there, each with an agenda of its own. The agendas of short fragments
are worked side by side in arrays; a long fragment has a heap. Fragments recur, so a worker remembers their ids, within a
bound. In `digest` every Arrow batch's new fragments also go to the sentencepiece library, and each row tells whether the
library agrees on all of its fragments; `differences` compares whole texts.

Defined cases: a null or empty text has the end id only and decodes to the empty text; a literal space mark is a space, as
in the library; texts of any length are worked on whole; repeated rows are encoded alike; `encode` and `decode` pass other
columns through and replace one of the result's name. Vocabularies with user-defined or unused pieces, a normalisation table
or without byte pieces raise an error.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.bpe import Merges
from tidemark.llm.bpe import _with as with_columns
from tidemark.llm.shared import pieces, utf8

MARK = "▁"
#: Kinds of pieces, fields and model types in the public model format; fixed values.
_NORMAL, _UNKNOWN, _CONTROL, _USER_DEFINED, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
_MERGE_TYPE = 2
_UNKNOWN_SURFACE = b" \xe2\x81\x87 "

codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a serialized message."""

    def varint(i: int) -> tuple[int, int]:
        value = shift = 0
        while message[i] > 127:
            value, shift, i = value | (message[i] & 127) << shift, shift + 7, i + 1
        return value | message[i] << shift, i + 1

    i = 0
    while i < len(message):
        key, i = varint(i)
        if key & 7 == 0:
            value, i = varint(i)
        else:
            n, i = varint(i) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], i)
            value, i = message[i : i + n], i + n
        yield key >> 3, value


class Model:
    """Pieces with scores and kinds, and the flags that matter, of a model file."""

    def __init__(self, path: str) -> None:
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        flags = {1: {}, 2: {}, 3: {}}
        with open(path, "rb") as f:
            for number, value in _fields(f.read()):
                if number == 1:
                    piece = dict(_fields(value))
                    self.pieces.append(piece[1].decode())
                    self.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                    self.kinds.append(piece.get(3, _NORMAL))
                elif number in flags:
                    flags[number] = dict(_fields(value))
        trainer, normalizer = flags[2], flags[3]
        self.prefixed = bool(normalizer.get(3, 1))
        if trainer.get(3, 1) != _MERGE_TYPE or normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1) or {_USER_DEFINED, _UNUSED} & {*self.kinds} or self.kinds.count(_BYTE) != 256 or trainer.get(24):
            raise ValueError(f"{path} isn't a merge-type vocabulary with byte pieces and plain normalisation")


class Agenda(Merges):
    """Pairs of symbols by the score of what they merge into; pairs of equal scores go by place."""

    def __init__(self, ids: dict[str, int], scores: dict[str, float]) -> None:
        pairs = sorted(((p[:i], p[i:]) for p in scores for i in range(1, len(p)) if p[:i] in ids and p[i:] in ids), key=lambda x: -scores[x[0] + x[1]])
        super().__init__(ids, pairs)
        levels = {s: k for k, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.order = np.array([*(levels[scores[a + b]] for a, b in pairs), len(levels)], np.int64)

    def _alone(self, ids: np.ndarray) -> bytes:
        """One long fragment by a heap of (score level, place, symbols after merging); entries that no longer hold are passed over."""
        if not hasattr(self, "known"):
            self.known = dict(zip(self.keys.tolist(), zip(self.order.tolist(), self.into.tolist(), strict=False), strict=False))
        known, n, token = self.known, len(ids), ids.tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        found = self._ranks(ids[:-1], ids[1:])
        at = np.flatnonzero(found < self.none)
        heap = list(zip(self.order[found[at]].tolist(), at.tolist(), ids[at].tolist(), ids[at + 1].tolist(), strict=True))
        heapq.heapify(heap)
        push, pop = heapq.heappush, heapq.heappop
        while heap:
            _, i, left, right = pop(heap)
            j = after[i]
            if token[i] != left or j >= n or token[j] != right:
                continue
            token[i], token[j] = known[left << 20 | right][1], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (entry := known.get(token[i] << 20 | token[k])) is not None:
                    push(heap, (entry[0], i, token[i], token[k]))
            if (h := before[i]) >= 0 and (entry := known.get(token[h] << 20 | token[i])) is not None:
                push(heap, (entry[0], h, token[h], token[i]))
        return np.array([t for t in token if t >= 0], "<u4").tobytes()

    def _side_by_side(self, ids: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
        """In every round the first entry of each fragment's agenda merges."""
        none, last = self.none, self.order[-1]
        owner = np.repeat(np.arange(len(lengths)), lengths)
        pair = np.full(len(ids), none)
        inner = np.flatnonzero(owner[:-1] == owner[1:])
        pair[inner] = self._ranks(ids[inner], ids[inner + 1])
        done = [(owner[:0], ids[:0])]
        while len(ids):
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            level = self.order[pair]
            first = np.repeat(np.minimum.reduceat(level, starts), np.diff(np.append(starts, len(ids))))
            rest = first < last
            done.append((owner[~rest], ids[~rest]))
            ids, owner, pair = ids[rest], owner[rest], pair[rest]
            at = np.flatnonzero(level[rest] == first[rest])
            if not len(at):
                break
            at = at[np.concatenate([[True], owner[at[1:]] != owner[at[:-1]]])]
            ids[at] = self.into[pair[at]]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids, owner, pair = ids[keep], owner[keep], pair[keep]
            at -= np.arange(len(at))
            for i in (at, at[at > 0] - 1):
                pair[i] = none
                i = i[i + 1 < len(ids)]
                i = i[owner[i] == owner[i + 1]]
                pair[i] = self._ranks(ids[i], ids[i + 1])
        owner, ids = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(owner, kind="stable")
        return ids[order].astype("<u4").tobytes(), 4 * np.cumsum(np.bincount(owner, minlength=len(lengths)))


class Codec:
    """A vocabulary with its agenda, and the fragments encoded so far."""

    def __init__(self, path: str, most: int) -> None:
        model, self.path, self.most = Model(path), path, most
        kinds = model.kinds
        scores = {p: s for p, s, k in zip(model.pieces, model.scores, kinds, strict=True) if k == _NORMAL}
        ids = {p: i for i, (p, k) in enumerate(zip(model.pieces, kinds, strict=True)) if k == _NORMAL}
        self.size, self.prefixed = len(model.pieces), model.prefixed
        # letters of pieces that are none themselves are symbols, too, and those that no piece has are one symbol
        for c in sorted({c for p in scores for c in p} - ids.keys()):
            ids[c] = len(ids) + self.size
        self.stranger = (1 << 20) - 1
        self.agenda = Agenda(ids, scores)
        self.letters = np.full(0x110000, self.stranger, np.int64)
        for c, i in ids.items():
            if len(c) == 1:
                self.letters[ord(c)] = i
        self.byte = [model.pieces.index(f"<0x{b:02X}>") for b in range(256)]
        surface = {_UNKNOWN: lambda p: _UNKNOWN_SURFACE, _CONTROL: lambda p: b"", _BYTE: lambda p: bytes([int(p[1:-1], 16)])}
        self.surfaces = [surface.get(k, lambda p: p.replace(MARK, " ").encode())(p) for p, k in zip(model.pieces, kinds, strict=True)]
        self.control = {i for i, k in enumerate(kinds) if k == _CONTROL}
        self.marked = {i for p, i in ids.items() if p[0] == MARK}
        self.end = model.pieces.index("</s>")
        self.decimals = [b"%d" % i for i in range(self.size)]
        long = [p for p in scores if len(p) > 1]
        self.cut_at_marks = not any(a != MARK and b == MARK for p in long for a, b in zip(p, p[1:], strict=False))
        #: A line's end stands in no longer piece of common vocabularies.
        self.cut_at_lines = not any("\n" in p for p in long)
        self.parts = regex.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
        self.known: dict[str, bytes] = {"": b""}
        #: Fragments for which the library gives other ids.
        self.doubtful: set[str] = set()

    def _fragments(self, text: str) -> list[str]:
        """Stretches of the marked text that no merge leaves."""
        marked = (MARK if self.prefixed else "") + text.replace(" ", MARK)
        if not (self.cut_at_marks and self.cut_at_lines):
            return [marked]
        if MARK + MARK in marked or "\0" in marked:
            return self.parts.findall(marked)
        return marked.replace(MARK, "\0" + MARK).replace("\n", "\0\n\0").split("\0")

    def _learn(self, new: list[str]) -> None:
        symbols = self.letters[np.frombuffer("".join(new).encode("utf-32-le"), "<u4")]
        raw, ends = self.agenda.packed(symbols, np.fromiter(map(len, new), np.int64, len(new)))
        ends = ends.tolist()
        self.known.update(zip(new, map(raw.__getitem__, map(slice, [0, *ends], ends)), strict=False))
        odd = np.searchsorted(ends, 4 * np.flatnonzero(np.frombuffer(raw, "<u4") >= self.size), side="right")
        for fragment in map(new.__getitem__, set(odd.tolist())):
            self.known[fragment] = self._with_bytes(fragment, np.frombuffer(self.known[fragment], "<u4").tolist())

    def _compare(self, new: list[str]) -> None:
        """New fragments as the library encodes them behind a line's end, or whole texts where no cut is certain."""
        theirs, cut = library(self.path), self.cut_at_marks and self.cut_at_lines
        skipped = len(theirs.encode("\n")) if cut else 0
        shown = ["\n" + f for f in new] if cut else [f[self.prefixed :] for f in new]
        known = self.known
        for f, ids in zip(new, theirs.encode(shown, num_threads=1), strict=True):
            if np.array(ids[skipped:], "<u4").tobytes() != known[f]:
                self.doubtful.add(f)

    def _with_bytes(self, fragment: str, ids: list[int]) -> bytes:
        """Ids with the bytes of characters that are no pieces."""
        out, at = [], 0
        for i in ids:
            if i < self.size:
                out.append(i)
                at += len(self.surfaces[i].decode())
            else:
                out += (self.byte[b] for b in fragment[at].encode())
                at += 1
        return np.array(out, "<u4").tobytes()

    def encode(self, texts: list[str], compare: bool = False) -> tuple[list[bytes], list[bool]]:
        """Little-endian unsigned 32-bit ids of each text, without an end id; and whether the library agrees on its fragments, if asked."""
        if len(self.known) > self.most:
            self.known, self.doubtful = {"": b""}, set()
        split = [self._fragments(t) if t else [] for t in texts]
        known = self.known
        if new := list({f for x in split for f in x if f not in known}):
            self._learn(new)
            if compare:
                self._compare(new)
        return [b"".join(map(known.__getitem__, x)) for x in split], [self.doubtful.isdisjoint(x) if self.doubtful else True for x in split]

    def decode(self, ids: list[int]) -> str:
        """The text; the first mark of the first piece is dropped, bytes that aren't UTF-8 become a replacement character each."""
        first = next((i for i in ids if i not in self.control), None)
        runs, control = [[]], self.control
        for i in ids if control.intersection(ids[:-1]) else ():
            runs.append([]) if i in control else runs[-1].append(i)
        texts = [b"".join(map(self.surfaces.__getitem__, x)).decode("utf-8", "each_byte") for x in (runs if len(runs) > 1 else [ids])]
        return "".join(texts)[self.prefixed and first in self.marked :]


@dataclass(frozen=True)
class Coding:
    model: str
    #: Fragments that a worker remembers.
    remembered: int = 500_000


_codecs: dict[Coding, Codec] = {}


def codec(how: Coding) -> Codec:
    if how not in _codecs:
        _codecs[how] = Codec(how.model, how.remembered)
    return _codecs[how]


_libraries: dict[str, object] = {}


def library(path: str):
    """The sentencepiece library's processor of a model file, once for a worker."""
    if path not in _libraries:
        import sentencepiece

        _libraries[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _libraries[path]


def _coded(column: pa.Array, how: Coding, compare: bool = False) -> Iterator[tuple[bytes, bool]]:
    raw = utf8(column)
    for part in pieces(raw):
        yield from zip(*codec(how).encode([t.decode("utf-8", "replace") for t in raw[part]], compare), strict=True)


def encode(df: DataFrame, how: Coding, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds the ids of each text as an array, the end id last."""

    return with_columns(df, [(ids, T.ArrayType(T.IntegerType()), pa.list_(pa.int32()))], text, lambda c: ((np.append(np.frombuffer(x, "<i4"), np.int32(codec(how).end)),) for x, _ in _coded(c, how)))


def decode(df: DataFrame, how: Coding, ids: str = "ids", text: str = "text") -> DataFrame:
    """Adds the text of each array of ids; null ids give the empty text."""
    return with_columns(df, [(text, T.StringType(), pa.string())], ids, lambda c: ((codec(how).decode(x or []),) for x in c.to_pylist()))


def digest(df: DataFrame, how: Coding) -> DataFrame:
    """doc_id, the number of ids with the end id, hashes of their decimals and of the text that they decode to, and whether the library agrees."""

    def row(coded: tuple[bytes, bool]) -> tuple:
        mine = codec(how)
        ids = [*np.frombuffer(coded[0], "<u4").tolist(), mine.end]
        shown = b" ".join(map(mine.decimals.__getitem__, ids))
        return len(ids), hashlib.sha256(shown).hexdigest(), hashlib.sha256(mine.decode(ids).encode()).hexdigest(), coded[1]

    fields = [("n_tokens", T.LongType(), pa.int64()), ("ids_sha256", T.StringType(), pa.string()), ("decoded_sha256", T.StringType(), pa.string()), ("library_agrees", T.BooleanType(), pa.bool_())]
    return with_columns(df.select("doc_id", "text"), fields, "text", lambda c: map(row, _coded(c, how, compare=True))).drop("text")


def differences(df: DataFrame, how: Coding, text: str = "text") -> DataFrame:
    """The rows whose whole text the library encodes or decodes otherwise, with both lists of ids."""

    def rows(column: pa.Array) -> Iterator[tuple]:
        theirs, mine = library(how.model), codec(how)
        texts = [t.decode("utf-8", "replace") for t in utf8(column)]
        for coded, other in zip((x for x, _ in _coded(column, how)), theirs.encode(texts, num_threads=1), strict=True):
            ids = np.frombuffer(coded, "<u4").tolist()
            yield ids, other, ids == other and mine.decode(ids) == theirs.decode(ids)

    ids = T.ArrayType(T.IntegerType()), pa.list_(pa.int32())
    return with_columns(df, [("ids", *ids), ("library_ids", *ids), ("agrees", T.BooleanType(), pa.bool_())], text, rows).where("not agrees").drop("agrees")
