"""Lossless WebP in numpy: a general decoder that works on many images side by side, and a literal-and-run encoder.

Decoding takes one pixel of every image at a time: prefix codes, back-references, colour cache and entropy groups are looked
up for all images at once. Then the transforms are undone: predictor, cross-colour, subtract-green and palette. The
encoder writes literals, back-references for runs and, where that makes an image smaller, a colour cache, with one of two fixed
sets of prefix codes. Large images and those of few colours are also tried with prefix codes of their own and a transform: palette
with packed indices, subtract-green, or one predictor for the whole image. The smallest form is kept.
"""

from __future__ import annotations

import heapq
import struct
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np

#: Fixed values of the format: order of code length codes, and the near positions that distance codes 1 to 120 name.
_LENGTH_ORDER = [17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15]
_NEAR = [
    (0, 1), (1, 0), (1, 1), (-1, 1), (0, 2), (2, 0), (1, 2), (-1, 2), (2, 1), (-2, 1), (2, 2), (-2, 2), (0, 3), (3, 0), (1, 3), (-1, 3), (3, 1), (-3, 1), (2, 3), (-2, 3),
    (3, 2), (-3, 2), (0, 4), (4, 0), (1, 4), (-1, 4), (4, 1), (-4, 1), (3, 3), (-3, 3), (2, 4), (-2, 4), (4, 2), (-4, 2), (0, 5), (3, 4), (-3, 4), (4, 3), (-4, 3), (5, 0),
    (1, 5), (-1, 5), (5, 1), (-5, 1), (2, 5), (-2, 5), (5, 2), (-5, 2), (4, 4), (-4, 4), (3, 5), (-3, 5), (5, 3), (-5, 3), (0, 6), (6, 0), (1, 6), (-1, 6), (6, 1), (-6, 1),
    (2, 6), (-2, 6), (6, 2), (-6, 2), (4, 5), (-4, 5), (5, 4), (-5, 4), (3, 6), (-3, 6), (6, 3), (-6, 3), (0, 7), (7, 0), (1, 7), (-1, 7), (5, 5), (-5, 5), (7, 1), (-7, 1),
    (4, 6), (-4, 6), (6, 4), (-6, 4), (2, 7), (-2, 7), (7, 2), (-7, 2), (3, 7), (-3, 7), (7, 3), (-7, 3), (5, 6), (-5, 6), (6, 5), (-6, 5), (8, 0), (4, 7), (-4, 7), (7, 4),
    (-7, 4), (8, 1), (8, 2), (6, 6), (-6, 6), (8, 3), (5, 7), (-5, 7), (7, 5), (-7, 5), (8, 4), (6, 7), (-6, 7), (7, 6), (-7, 6), (8, 5), (7, 7), (-7, 7), (8, 6), (8, 7),
]
_PREDICTOR, _CROSS, _SUBTRACT, _PALETTE = range(4)
#: Predictor modes that take the pixel to the left, and the one above.
_LEFT, _TOP = 1, 2
_GREEN = 256 + 24


class Bits:
    """A reader of bits, least significant first."""

    def __init__(self, data: bytes, at: int = 0) -> None:
        self.data, self.at = data, at

    def read(self, n: int) -> int:
        i = self.at >> 3
        value = int.from_bytes(self.data[i : i + 6], "little") >> (self.at & 7) & ((1 << n) - 1)
        self.at += n
        return value


def _codes(lengths) -> np.ndarray:
    """Canonical codes of the lengths, bits reversed for reading from the least significant."""
    out, code = np.zeros(len(lengths), np.uint64), 0
    lengths = np.asarray(lengths)
    for n in range(1, 16):
        for s in np.flatnonzero(lengths == n).tolist():
            out[s] = int(f"{code:0{n}b}"[::-1], 2)
            code += 1
        code <<= 1
    return out


@lru_cache(1 << 10)
def _table(lengths: bytes) -> tuple[int, np.ndarray]:
    """Bits to look at, and for each value of them symbol << 4 | length."""
    sizes = np.frombuffer(lengths, np.uint8)
    used = np.flatnonzero(sizes)
    if len(used) <= 1:
        return 0, np.array([int(used[0]) << 4 if len(used) else 0], np.uint32)
    top = int(sizes.max())
    out = np.zeros(1 << top, np.uint32)
    for s, c in zip(used.tolist(), _codes(sizes)[used].tolist(), strict=True):
        out[c :: 1 << int(sizes[s])] = s << 4 | int(sizes[s])
    return top, out


def _read_lengths(bits: Bits, size: int) -> bytes:
    out = bytearray(size)
    if bits.read(1):
        two, wide = bits.read(1), bits.read(1)
        symbols = [bits.read(8 if wide else 1)] + ([bits.read(8)] if two else [])
        for s in symbols:
            out[s] = 1
        return bytes(out)
    first = [0] * 19
    for k in range(4 + bits.read(4)):
        first[_LENGTH_ORDER[k]] = bits.read(3)
    top, table = _table(bytes(first))
    left = 2 + bits.read(2 + 2 * bits.read(3)) if bits.read(1) else size
    i, before = 0, 8
    while i < size and left > 0:
        left -= 1
        peek, was = bits.read(top), bits.at
        entry = int(table[peek])
        bits.at = was - top + (entry & 15)
        s = entry >> 4
        if s < 16:
            out[i] = s
            i, before = i + 1, s or before
        else:
            n = 3 + bits.read(2) if s == 16 else 3 + bits.read(3) if s == 17 else 11 + bits.read(7)
            out[i : i + n] = bytes([before if s == 16 else 0]) * n
            i += n
    if len(out) != size:
        raise ValueError("code lengths run over")
    return bytes(out)


@dataclass
class Coded:
    """An entropy-coded image: where its pixels start, its codes by group and the groups of its blocks."""

    data: bytes
    at: int
    width: int
    height: int
    groups: list[list[bytes]]
    cache_bits: int = 0
    block_bits: int = 0
    block_groups: np.ndarray | None = None
    transforms: list[tuple] = field(default_factory=list)
    full_width: int = 0


def _up(n: int, bits: int) -> int:
    return (n + (1 << bits) - 1) >> bits


def _coded(bits: Bits, width: int, height: int, main: bool) -> Coded:
    cache = bits.read(4) if bits.read(1) else 0
    block_bits, block_groups, n = 0, None, 1
    if main and bits.read(1):
        block_bits = bits.read(3) + 2
        block_groups = (_inner(bits, _up(width, block_bits), _up(height, block_bits)) >> np.uint32(8) & np.uint32(0xFFFF)).astype(np.int64)
        n = int(block_groups.max()) + 1
    sizes = [_GREEN + (1 << cache if cache else 0), 256, 256, 256, 40]
    groups = [[_read_lengths(bits, s) for s in sizes] for _ in range(n)]
    return Coded(bits.data, bits.at, width, height, groups, cache, block_bits, block_groups)


def _inner(bits: Bits, width: int, height: int) -> np.ndarray:
    image = _coded(bits, width, height, False)
    pixels, ends = _pixels([image])
    bits.at = ends[0]
    return pixels[0]


_seen: dict[bytes, tuple[int, Coded]] = {}


def parse(data: bytes) -> Coded:
    """Header, transforms and codes of a WebP file with one lossless chunk."""
    if data[:4] != b"RIFF" or data[8:16] != b"WEBPVP8L" or data[20] != 0x2F:
        raise ValueError("not a lossless WebP file")
    stream = data[20 : 20 + struct.unpack("<I", data[16:20])[0]]
    size = int.from_bytes(stream[1:5], "little")
    width, height = (size & 0x3FFF) + 1, (size >> 14 & 0x3FFF) + 1
    if size >> 29:
        raise ValueError("unknown version")
    # codes that many images share are read once
    for start, (ends, like) in list(_seen.items())[::-1]:
        n = len(start)
        if stream[5 : 5 + n] == start and (stream + b"\0")[5 + n] & ((1 << (ends & 7)) - 1) == like.data[5 + n] & ((1 << (ends & 7)) - 1):
            _seen[start] = _seen.pop(start)
            return Coded(stream, ends, width, height, like.groups, like.cache_bits, full_width=width)
    bits, transforms, inner_width = Bits(stream, 40), [], width
    while bits.read(1):
        kind = bits.read(2)
        if kind in (_PREDICTOR, _CROSS):
            b = bits.read(3) + 2
            transforms.append((kind, b, inner_width, _inner(bits, _up(inner_width, b), _up(height, b))))
        elif kind == _PALETTE:
            n = bits.read(8) + 1
            colours = np.cumsum(_inner(bits, n, 1).view(np.uint8).reshape(-1, 4), axis=0, dtype=np.uint8).view(np.uint32).reshape(-1)
            b = 3 if n <= 2 else 2 if n <= 4 else 1 if n <= 16 else 0
            transforms.append((kind, b, inner_width, colours))
            inner_width = _up(inner_width, b)
        else:
            transforms.append((kind, 0, inner_width, None))
    image = _coded(bits, inner_width, height, True)
    image.transforms, image.full_width = transforms, width
    if not transforms and image.block_groups is None:
        if len(_seen) >= 8:  # those that came up last stay
            del _seen[next(iter(_seen))]
        _seen[stream[5 : image.at >> 3]] = (image.at, image)
    return image


def _extra(prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Extra bits and base of length and distance prefixes; the value is base + bits + 1."""
    n = np.maximum(prefix - 2, 0) >> 1
    return n, np.where(prefix < 4, prefix, (2 + (prefix & 1)) << n)


def _pixels(images: list[Coded]) -> tuple[list[np.ndarray], list[int]]:
    """Pixels of each coded image as stored, before transforms are undone, and the bits where they end."""
    order = sorted(range(len(images)), key=lambda i: -images[i].width * images[i].height)
    lanes = [images[i] for i in order]
    sizes = np.array([c.width * c.height for c in lanes])
    starts = np.concatenate([[0], np.cumsum([len(c.data) for c in lanes])])
    buf = np.frombuffer(b"".join(c.data for c in lanes) + bytes(16), np.uint8)
    words = np.ndarray((len(buf) - 8,), "<u8", buf, strides=(1,))
    at = 8 * starts[:-1] + np.array([c.at for c in lanes])
    tables: dict[bytes, tuple[int, int]] = {}
    flat, total = [], 0
    for lengths in dict.fromkeys(x for c in lanes for g in c.groups for x in g):
        top, table = _table(lengths)
        tables[lengths] = (total, (1 << top) - 1)
        flat.append(table)
        total += len(table)
    lookup = np.concatenate(flat)
    first = np.concatenate([[0], np.cumsum([len(c.groups) for c in lanes])])[:-1]
    group_at = np.array([[tables[x][0] for x in g] for c in lanes for g in c.groups])
    group_mask = np.array([[tables[x][1] for x in g] for c in lanes for g in c.groups], np.uint64)
    grouped = any(c.block_groups is not None for c in lanes)
    widths = np.array([c.width for c in lanes])
    cache_bits = np.array([c.cache_bits for c in lanes], np.uint64)
    cached = bool(cache_bits.any())
    cache = np.zeros((len(lanes), 1 << int(cache_bits.max()) if cached else 1), np.uint32)
    out = np.zeros((int(sizes[0]), len(lanes)), np.uint32)
    left, back = np.zeros(len(lanes), np.int64), np.zeros(len(lanes), np.int64)
    near = np.array(_NEAR)
    ends = np.searchsorted(-sizes, -np.arange(int(sizes[0])), "left").tolist()
    copying = 0

    def peek(p: np.ndarray) -> np.ndarray:
        return words[p >> 3] >> (p & 7).astype(np.uint64)

    for t in range(int(sizes[0])):
        n = ends[t]
        every = slice(0, n)
        who = np.flatnonzero(left[every] == 0) if copying else every
        if copying == 0 or len(who):
            group = first[who]
            if grouped:
                index = np.arange(n)[who] if copying == 0 else who
                group = group + np.array([0 if (c := lanes[i]).block_groups is None else c.block_groups[(t // c.width >> c.block_bits) * _up(c.width, c.block_bits) + (t % c.width >> c.block_bits)] for i in index.tolist()], np.int64)
            where, mask, p = group_at[group], group_mask[group], at[who]

            def symbol(k: int, p: np.ndarray, rows=None) -> tuple[np.ndarray, np.ndarray]:
                a, m = (where[:, k], mask[:, k]) if rows is None else (where[rows, k], mask[rows, k])
                entry = lookup[a + (peek(p) & m).astype(np.int64)]
                return entry >> np.uint32(4), p + (entry & np.uint32(15))

            green, p = symbol(0, p)
            literal = green < 256
            if literal.all():
                red, p = symbol(1, p)
                blue, p = symbol(2, p)
                alpha, p = symbol(3, p)
                out[t, who] = alpha << np.uint32(24) | red << np.uint32(16) | green << np.uint32(8) | blue
            else:
                lane = np.arange(n)[who] if copying == 0 else who
                i = np.flatnonzero(literal)
                red, q = symbol(1, p[i], i)
                blue, q = symbol(2, q, i)
                alpha, q = symbol(3, q, i)
                p[i] = q
                out[t, lane[i]] = alpha << np.uint32(24) | red << np.uint32(16) | green[i] << np.uint32(8) | blue
                i = np.flatnonzero(green >= _GREEN)
                out[t, lane[i]] = cache[lane[i], green[i] - _GREEN]
                i = np.flatnonzero(~literal & (green < _GREEN))
                bits, base = _extra(green[i].astype(np.int64) - 256)
                length = base + (peek(p[i]) & ((np.uint64(1) << bits.astype(np.uint64)) - np.uint64(1))).astype(np.int64) + 1
                far, q = symbol(4, p[i] + bits, i)
                bits, base = _extra(far.astype(np.int64))
                code = base + (peek(q) & ((np.uint64(1) << bits.astype(np.uint64)) - np.uint64(1))).astype(np.int64) + 1
                p[i] = q + bits
                xy = near[np.minimum(code, 120) - 1]
                back[lane[i]] = np.where(code > 120, code - 120, np.maximum(1, xy[:, 0] + xy[:, 1] * widths[lane[i]]))
                left[lane[i]] = length
                copying += len(i)
            at[who] = p
        if copying:
            i = np.flatnonzero(left[every])
            out[t, i] = out[t - back[i], i]
            left[i] -= 1
            copying = int(np.count_nonzero(left[: ends[t + 1] if t + 1 < len(ends) else 0]))
        if cached:
            i = np.flatnonzero(cache_bits[every])
            colour = out[t, i]
            cache[i, (colour * np.uint32(0x1E35A7BD) >> (np.uint32(32) - cache_bits[i].astype(np.uint32))).astype(np.int64)] = colour
    pixels, stops = [None] * len(images), [0] * len(images)
    for lane, i in enumerate(order):
        pixels[i], stops[i] = out[: sizes[lane], lane].copy(), int(at[lane] - 8 * starts[lane])
    return pixels, stops


def _average(a, b):
    return (a + b) >> 1


def _predicted(mode: np.ndarray, left, top, top_right, top_left) -> np.ndarray:
    """Predictions of channels (rows of 4) for each mode."""
    clamp = lambda x: np.clip(x, 0, 255)
    select = np.where((np.abs(top - top_left).sum(1) < np.abs(left - top_left).sum(1))[:, None], left, top)
    half = _average(left, top)
    full = half + np.trunc((half - top_left) / 2).astype(np.int64)
    black = np.broadcast_to(np.array([0, 0, 0, 255]), left.shape)
    options = [black, left, top, top_right, top_left, _average(_average(left, top_right), top), _average(left, top_left), half, _average(top_left, top), _average(top, top_right), _average(_average(left, top_left), _average(top, top_right)), select, clamp(left + top - top_left), clamp(full), black, black]
    return np.choose(mode[:, None], options)


def _unpredicted(pixels: np.ndarray, width: int, bits: int, modes: np.ndarray) -> np.ndarray:
    """Adds predictions, along waves of pixels whose neighbours are all known."""
    height = len(pixels) // width
    px = pixels.view(np.uint8).reshape(-1, 4).astype(np.int64)
    mode = (modes >> np.uint32(8) & np.uint32(15)).astype(np.int64)
    if (mode == mode[0]).all() and mode[0] in (_LEFT, _TOP):  # then sums along rows and columns
        sums = pixels.view(np.uint8).reshape(height, width, 4).copy()
        sums[:1, :1, 3] += np.uint8(255)
        first, rest = (sums[:, :1], (0, 1)) if mode[0] == _LEFT else (sums[:1], (1, 0))
        first[:] = np.cumsum(first, axis=rest[0], dtype=np.uint8)
        return np.cumsum(sums, axis=rest[1], dtype=np.uint8).reshape(-1).view(np.uint32)
    for wave in range(width + 2 * (height - 1)):
        y = np.arange(max(0, -(-(wave - width + 1) // 2)), min(height - 1, wave // 2) + 1)
        x = wave - 2 * y
        i = y * width + x
        m = np.where(y == 0, np.where(x == 0, 0, 1), np.where(x == 0, 2, mode[(y >> bits) * _up(width, bits) + (x >> bits)]))
        above = i - width
        px[i] = px[i] + _predicted(m, px[i - 1], px[above], px[above + 1], px[above - 1]) & 255
    return px.astype(np.uint8).reshape(-1).view(np.uint32)


def _uncrossed(pixels: np.ndarray, width: int, bits: int, elements: np.ndarray) -> np.ndarray:
    px = pixels.view(np.uint8).reshape(-1, 4).astype(np.int64)
    i = np.arange(len(px))
    e = elements.view(np.int8).reshape(-1, 4).astype(np.int64)[(i // width >> bits) * _up(width, bits) + (i % width >> bits)]
    signed = lambda x: (x + 128 & 255) - 128
    px[:, 2] = px[:, 2] + (e[:, 0] * signed(px[:, 1]) >> 5) & 255
    px[:, 0] = px[:, 0] + (e[:, 1] * signed(px[:, 1]) >> 5) + (e[:, 2] * signed(px[:, 2]) >> 5) & 255
    return px.astype(np.uint8).reshape(-1).view(np.uint32)


def _unindexed(pixels: np.ndarray, width: int, bits: int, colours: np.ndarray) -> np.ndarray:
    index = (pixels >> np.uint32(8) & np.uint32(255)).astype(np.int64)
    if bits:
        each = 8 >> bits
        rows = index.reshape(-1, _up(width, bits))
        index = (rows[:, :, None] >> each * np.arange(1 << bits) & (1 << each) - 1).reshape(len(rows), -1)[:, :width].reshape(-1)
    return np.concatenate([colours, np.zeros(256, np.uint32)])[index]


def restored(image: Coded, pixels: np.ndarray) -> np.ndarray:
    """Undoes the transforms, the last one first."""
    for kind, bits, width, data in reversed(image.transforms):
        if kind == _PREDICTOR:
            pixels = _unpredicted(pixels, width, bits, data)
        elif kind == _CROSS:
            pixels = _uncrossed(pixels, width, bits, data)
        elif kind == _PALETTE:
            pixels = _unindexed(pixels, width, bits, data)
        else:
            px = pixels.view(np.uint8).reshape(-1, 4).copy()
            px[:, 0] += px[:, 1]
            px[:, 2] += px[:, 1]
            pixels = px.reshape(-1).view(np.uint32)
    return pixels


def decode(files: list[bytes]) -> list[np.ndarray]:
    """Samples (height, width, 4) of red, green, blue and alpha."""
    if not files:
        return []
    images = [parse(f) for f in files]
    pixels, _ = _pixels(images)
    return [restored(c, p).view(np.uint8).reshape(c.height, c.full_width, 4)[:, :, [2, 1, 0, 3]] for c, p in zip(images, pixels, strict=True)]


def limited_lengths(weights: list[float]) -> list[int]:
    """Huffman code lengths; the weights must be even enough for 15 bits."""
    heap = [(w, i, [i]) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    lengths, k = [0] * len(weights), len(weights)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        for s in (*a[2], *b[2]):
            lengths[s] += 1
        heapq.heappush(heap, (a[0] + b[0], k, a[2] + b[2]))
        k += 1
    if max(lengths) > 15:
        raise ValueError("a code is longer than 15 bits")
    return lengths


class Writer:
    """Bits into a number, least significant first."""

    def __init__(self) -> None:
        self.value, self.size = 0, 0

    def write(self, value: int, n: int) -> None:
        self.value |= value << self.size
        self.size += n

    def lengths(self, lengths: list[int]) -> None:
        """A code's lengths, with repetitions, under a code of their own."""
        used = [i for i, n in enumerate(lengths) if n]
        if len(used) == 1 and used[0] < 256:
            self.write(1, 1)
            self.write(0, 1)
            self.write(1, 1)
            self.write(used[0], 8)
            return
        if len(used) == 2 and used[1] < 256:
            self.write(0b111, 3)
            self.write(used[0], 8)
            self.write(used[1], 8)
            return
        tokens, i = [], 0
        while i < len(lengths):
            zero, n = lengths[i] == 0, 1
            while i + n < len(lengths) and lengths[i + n] == lengths[i] and n < (138 if zero else 7):
                n += 1
            if zero and n >= 3:
                tokens.append((18, n - 11, 7) if n >= 11 else (17, n - 3, 3))
            elif not zero and n > 3:
                tokens += [(lengths[i], 0, 0), (16, n - 4, 2)]
            else:
                n = 1
                tokens.append((lengths[i], 0, 0))
            i += n
        counts = [sum(t[0] == s for t in tokens) for s in range(19)]
        some = [s for s in range(19) if counts[s]]
        first = [0] * 19
        for s, n in zip(some, limited_lengths([max(counts[s], len(tokens) / 24) for s in some]), strict=True):
            first[s] = max(n, 1)
        if max(first) > 7:
            raise ValueError("a code of code lengths is longer than 7 bits")
        self.write(0, 1)
        self.write(15, 4)
        for s in _LENGTH_ORDER:
            self.write(first[s], 3)
        self.write(0, 1)
        codes = _codes(first)
        for s, extra, bits in tokens:
            if len(some) > 1:
                self.write(int(codes[s]), first[s])
            self.write(extra, bits)


def _text_weights() -> list[float]:
    """Rough weights of bytes of text: spaces, small letters, other printing characters, parts of longer ones, the rest."""
    out = [0.2] * 256
    for b in range(256):
        out[b] = 150 if b == 32 else 35 if 97 <= b <= 122 else 2.5 if 33 <= b <= 126 or b == 10 else 4 if b in (0, 195) else 1.0 if b >= 128 else 0.2
    return out


#: Bits of the colour cache, and the fixed factor of its hash.
_CACHE_BITS, _CACHE_FACTOR = 9, np.uint32(0x1E35A7BD)


@lru_cache(2)
def _fixed(cached: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int, int]:
    """Codes and lengths for green, runs and the cache, and for the other channels, and the bits that say so in a file."""
    green, other = limited_lengths(_text_weights() + [0.2] * 24 + [0.6] * (cached << _CACHE_BITS)), limited_lengths(_text_weights())
    w = Writer()
    w.write(0, 1)  # no transform
    w.write(int(cached), 1)
    if cached:
        w.write(_CACHE_BITS, 4)
    w.write(0, 1)  # one group
    w.lengths(green)
    for _ in range(3):
        w.lengths(other)
    w.lengths([0, 1] + [0] * 38)  # distance code 2: the pixel before
    return _codes(green), np.array(green, np.int64), _codes(other), np.array(other, np.int64), w.value, w.size


def _with_runs(pixel: np.ndarray, is_first: np.ndarray, longest: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs of 3 or more pixels that equal the one before them, inside one image, cut to the longest length a code has."""
    same = np.concatenate([[False], pixel[1:] == pixel[:-1]]) & ~is_first
    edge = np.flatnonzero(np.diff(np.concatenate([[0], same.astype(np.int8), [0]])))
    start, size = edge[::2], edge[1::2] - edge[::2]
    start, size = start[size >= 3], size[size >= 3]
    parts = -(-size // longest)
    number = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
    return np.repeat(start, parts) + number * longest, np.minimum(np.repeat(size, parts) - number * longest, longest)


def _cached(argb: np.ndarray, image: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each pixel's slot in the colour cache, and whether its colour stands there: the last pixel of the image with this slot had it."""
    slot = (argb * _CACHE_FACTOR >> np.uint32(32 - _CACHE_BITS)).astype(np.int64)
    key = image << _CACHE_BITS | slot
    order = np.argsort(key, kind="stable")
    hit = np.zeros(len(argb), bool)
    hit[order[1:]] = (key[order[1:]] == key[order[:-1]]) & (argb[order[1:]] == argb[order[:-1]])
    return slot, hit


def _laid(out: np.ndarray, place: np.ndarray, code: np.ndarray) -> None:
    """Sets codes, in order, at their bits of an array of words."""
    word, shift = place >> 6, (place & 63).astype(np.uint64)
    at = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    out[word[at]] |= np.bitwise_or.reduceat(code << shift, at)
    out[word[at] + 1] |= np.bitwise_or.reduceat(np.where(shift > 0, code >> (np.uint64(64) - np.maximum(shift, np.uint64(1))), np.uint64(0)), at)


def _prefix(run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefixes of lengths, and their numbers of extra bits."""
    extra = np.where(run > 4, np.maximum(np.log2(np.maximum(run - 1, 1)).astype(np.int64) - 1, 0), 0)
    return np.where(run <= 4, run - 1, 2 * extra + 2 + ((run - 1) >> extra & 1)), extra


def _own_lengths(counts: np.ndarray) -> list[int]:
    """Code lengths for counts. Rare symbols count for a 1,024th at least, which keeps codes below 16 bits."""
    used = np.flatnonzero(counts)
    lengths = [0] * len(counts)
    floor = counts.sum() / 1024
    for s, n in zip(used.tolist(), limited_lengths([max(float(counts[s]), floor) for s in used]), strict=True):
        lengths[s] = max(n, 1)
    if not len(used):
        lengths[0] = 1
    return lengths


def _write_own(w: Writer, argb: np.ndarray, main: bool) -> None:
    """An entropy-coded image of literals and runs under codes from its own counts."""
    channels = argb.view(np.uint8).reshape(-1, 4)
    start, run = _with_runs(argb, np.arange(len(argb)) == 0)
    prefix, extra = _prefix(run)
    inside = np.zeros(len(argb) + 1, np.int64)
    np.add.at(inside, start, 1)
    np.add.at(inside, start + run, -1)
    literal = np.cumsum(inside[:-1]) == 0
    lengths = [_own_lengths(np.bincount(channels[literal, c], minlength=256)) for c in range(4)]
    lengths[1] = _own_lengths(np.bincount(np.concatenate([channels[literal, 1], 256 + prefix]), minlength=_GREEN))
    w.write(0, 2 if main else 1)  # no cache; one group
    for c in (1, 2, 0, 3):
        w.lengths(lengths[c])
    w.lengths([0, 1] + [0] * 38)
    codes, sizes = [_codes(x) for x in lengths], [np.array(x, np.int64) * (np.count_nonzero(x) > 1) for x in lengths]
    code, size = np.zeros(len(argb), np.uint64), np.zeros(len(argb), np.int64)
    for c in (1, 2, 0, 3):
        bits = sizes[c][channels[:, c]] * literal
        code |= np.where(bits > 0, codes[c][channels[:, c]], np.uint64(0)) << size.astype(np.uint64)
        size += bits
    bits = sizes[1][256 + prefix]
    code[start] = codes[1][256 + prefix] | ((run - 1) & ((1 << extra) - 1)).astype(np.uint64) << bits.astype(np.uint64)
    size[start] = bits + extra
    token = np.flatnonzero(size)
    if len(token):
        total = int(size.sum())
        out = np.zeros(total // 64 + 2, np.uint64)
        _laid(out, (np.cumsum(size) - size)[token], code[token])
        w.write(int.from_bytes(out.tobytes(), "little"), total)


def _residuals(argb: np.ndarray, width: int, mode: int) -> np.ndarray:
    """What is left of pixels after the pixel to the left, or the one above, has been taken off."""
    px = argb.view(np.uint8).reshape(-1, width, 4)
    out = px.copy()
    if mode == _TOP:
        out[1:] -= px[:-1]
        out[0, 1:] -= px[0, :-1]
    else:
        out[:, 1:] -= px[:, :-1]
        out[1:, 0] -= px[:-1, 0]
    out[:1, :1, 3] -= np.uint8(255)
    return out.reshape(-1).view(np.uint32)


def _less_green(argb: np.ndarray) -> np.ndarray:
    px = argb.view(np.uint8).reshape(-1, 4).copy()
    px[:, 0] -= px[:, 1]
    px[:, 2] -= px[:, 1]
    return px.reshape(-1).view(np.uint32)


def _indexed(index: np.ndarray, width: int, bits: int) -> np.ndarray:
    """Indices in green, several in one pixel where there are few colours."""
    rows = index.reshape(-1, width)
    rows = np.pad(rows, ((0, 0), (0, -width % (1 << bits)))).reshape(len(rows), -1, 1 << bits)
    return np.bitwise_or.reduce(rows << (8 >> bits) * np.arange(1 << bits), axis=2).reshape(-1).astype(np.uint32) << np.uint32(8)


def _estimate(argb: np.ndarray) -> float:
    """About how many bits an image takes under codes of its own."""
    new = np.concatenate([[True], argb[1:] != argb[:-1]])
    total = 12.0 * np.count_nonzero(new[:-1] & ~new[1:])
    for c in argb[new].view(np.uint8).reshape(-1, 4).T:
        counts = np.bincount(c)
        counts = counts[counts > 0]
        total += 5 * len(counts) - float((counts * np.log2(counts / counts.sum())).sum())
    return total


def _own_form(argb: np.ndarray, width: int) -> tuple[int, int]:
    """The image's bits and their number, under codes of its own and the transform that seems to make it smallest."""
    height = len(argb) // width
    forms = {"plain": argb, "green": _less_green(argb), _LEFT: _residuals(argb, width, _LEFT), _TOP: _residuals(argb, width, _TOP)}
    cost = {k: _estimate(x) for k, x in forms.items()}
    colours, index = np.unique(argb, return_inverse=True)
    if len(colours) <= 256:
        bits = 3 if len(colours) <= 2 else 2 if len(colours) <= 4 else 1 if len(colours) <= 16 else 0
        deltas = np.diff(colours.view(np.uint8).reshape(-1, 4), axis=0, prepend=np.zeros((1, 4), np.uint8)).reshape(-1).view(np.uint32)
        forms["palette"] = _indexed(index, width, bits)
        cost["palette"] = _estimate(forms["palette"]) + _estimate(deltas)
    best = min(cost, key=cost.get)
    w = Writer()
    if best != "plain":
        w.write(1, 1)
        w.write({"green": _SUBTRACT, "palette": _PALETTE}.get(best, _PREDICTOR), 2)
    if best == "palette":
        w.write(len(colours) - 1, 8)
        _write_own(w, deltas, False)
    elif best in (_LEFT, _TOP):
        w.write(7, 3)  # one mode for blocks of 512 by 512
        _write_own(w, np.full(_up(width, 9) * _up(height, 9), best << 8, np.uint32), False)
    w.write(0, 1)
    _write_own(w, forms[best], True)
    return w.value, w.size


#: Images of so many pixels, or where the colour cache finds so large a share of them, are tried with codes of their own. Others
#: gain less than the codes' own size, or too little for the time that codes take.
_OWN_PIXELS, _OWN_SHARE = 8192, 0.5


def encode(payloads: list[bytes], widths: list[int]) -> list[bytes]:
    """A WebP file for each payload of samples, red, green, blue and alpha in turn; each is a whole number of rows of its width."""
    if not payloads:
        return []
    count = np.array([len(p) // 4 for p in payloads])
    samples = np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, 4)
    first = np.concatenate([[0], np.cumsum(count)])
    is_first = np.zeros(len(samples), bool)
    is_first[first[:-1]] = True
    image_of = np.repeat(np.arange(len(payloads)), count)
    argb = np.ascontiguousarray(samples[:, [2, 1, 0, 3]]).view(np.uint32).reshape(-1)
    start, run = _with_runs(argb, is_first)
    slot, hit = _cached(argb, image_of)
    inside = np.zeros(len(samples) + 1, np.int64)
    np.add.at(inside, start, 1)
    np.add.at(inside, start + run, -1)
    in_run = np.cumsum(inside[:-1]) > 0
    prefix, extra = _prefix(run)

    def coded(cached: bool) -> tuple[np.ndarray, np.ndarray]:
        """Code and number of bits of each pixel; 0 bits inside runs."""
        green, green_n, other, other_n, _, _ = _fixed(cached)
        code, size = green[samples[:, 1]], green_n[samples[:, 1]].copy()
        for c in (0, 2, 3):
            code |= other[samples[:, c]] << size.astype(np.uint64)
            size += other_n[samples[:, c]]
        if cached:
            code[hit], size[hit] = green[_GREEN + slot[hit]], green_n[_GREEN + slot[hit]]
        size[in_run] = 0
        code[start] = green[256 + prefix] | ((run - 1) & ((1 << extra) - 1)).astype(np.uint64) << green_n[256 + prefix].astype(np.uint64)
        size[start] = green_n[256 + prefix] + extra
        return code, size

    (code, size), (code_c, size_c) = coded(False), coded(True)
    heads = [_fixed(k)[4:] for k in (False, True)]
    totals = [np.add.reduceat(x, first[:-1]) + n for x, (_, n) in zip((size, size_c), heads, strict=True)]
    smaller = totals[1] < totals[0]
    code, size = np.where(smaller[image_of], code_c, code), np.where(smaller[image_of], size_c, size)
    head_n = np.where(smaller, heads[1][1], heads[0][1])
    bits = np.concatenate([[0], np.cumsum(size)])
    room = (head_n + np.diff(bits[first]) + 63) // 64 + 1
    base = np.concatenate([[0], np.cumsum(room)])
    token = np.flatnonzero(size)
    image = image_of[token]
    place = 64 * base[image] + head_n[image] + bits[token] - bits[first[image]]
    out = np.zeros(int(base[-1]) + 1, np.uint64)
    _laid(out, place, code[token])
    for k, (value, n) in enumerate(heads):
        where = base[:-1][smaller == bool(k)]
        for i, w in enumerate(np.frombuffer(value.to_bytes((n + 63) // 64 * 8, "little"), np.uint64)):
            out[where + i] |= w
    raw, files = out.tobytes(), []
    length = ((head_n + np.diff(bits[first]) + 7) // 8).tolist()
    found = np.add.reduceat(hit.astype(np.int64), first[:-1])
    tried = ((count >= _OWN_PIXELS) | (found >= _OWN_SHARE * count)).tolist()
    for i, (b, n, pixels, width) in enumerate(zip((8 * base[:-1]).tolist(), length, count.tolist(), widths, strict=True)):
        body = raw[b : b + n]
        if tried[i]:
            value, size = _own_form(argb[first[i] : first[i + 1]], width)
            body = min(body, value.to_bytes((size + 7) // 8, "little"), key=len)
        stream = b"\x2f" + ((width - 1) | (pixels // width - 1) << 14 | 1 << 28).to_bytes(4, "little") + body
        padded = stream + b"\0" * (len(stream) & 1)
        files.append(b"RIFF" + struct.pack("<I", 12 + len(padded)) + b"WEBPVP8L" + struct.pack("<I", len(stream)) + padded)
    return files
