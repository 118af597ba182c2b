"""Words of many texts at once in numpy: spans between ASCII white space, 64-bit hashes and windows of them."""

from __future__ import annotations

import numpy as np

_SEED = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _SEED.integers(1, 2**64, 256, dtype=np.uint64)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 2**64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


class Powers:
    """Powers of the hash base and of its inverse, grown on demand."""

    up = _powers(_P, 1)
    down = _powers(_P_INVERSE, 1)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up, cls.down = _powers(_P, n), _powers(_P_INVERSE, n)
        return cls.up, cls.down


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False, block: int = 1 << 20) -> np.ndarray:
    """64-bit hashes of ordered byte spans; equal bytes, equal hashes. With `fold`, A-Z hash as a-z. Memory follows `block` and the longest span."""
    out = np.zeros(len(starts), np.uint64)
    values, i = _FOLDED if fold else _BYTE, 0
    while i < len(starts):
        first = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, first + block, "right")))
        part = buf[first : ends[j - 1]]
        up, down = Powers.upto(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(values[part] * up[: len(part)], out=sums[1:])
        a, b = starts[i:j] - first, ends[i:j] - first
        out[i:j] = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))
        i = j
    return out


def join(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts in one byte array, each followed by a newline, and the start of each, with the end."""
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=at[1:])
    return np.frombuffer(b"".join(x for t in texts for x in (t, b"\n")), np.uint8), at


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs without ASCII white space. The array ends with white space."""
    change = np.flatnonzero(np.diff(_SPACE[buf].astype(np.int8), prepend=np.int8(1)))
    return change[::2], change[1::2]


def words(texts: list[bytes], fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and where each text's words start, with the end."""
    buf, at = join(texts)
    starts, ends = word_spans(buf)
    return hash_spans(buf, starts, ends, fold), np.searchsorted(starts, at)


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash of each n consecutive values; empty if there are fewer."""
    m = len(hashes) - n + 1
    if m <= 0:
        return hashes[:0]
    out = np.zeros(m, np.uint64)
    for k in range(n):
        out = out * np.uint64(_P) + hashes[k : k + m]
    return mix(out + np.uint64(n))


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Each text's distinct n-word shingles as sorted hashes, ASCII letters folded. With fewer words all of them are one shingle; none, none."""
    hashes, at = words(texts, fold=True)
    every = windows(hashes, n)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(every[a : b - n + 1]))
        else:
            out.append(windows(hashes[a:b], b - a) if b > a else hashes[:0])
    return out
