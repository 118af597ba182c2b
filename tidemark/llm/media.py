"""Media columns of lossless WebP images: payloads are stored as 8-bit samples and read back as pixel arrays.

A payload is a text's UTF-8, filled up with zero bytes to a positive multiple of 64: rows of 16 pixels. It is stored as one
image. An image has 16384 rows at most, so only what is longer than 1 MiB gets wider rows, of the least multiple of 16 pixels
that holds it; the last row is filled up with zeros, which reading cuts off. An image's form (prefix codes, palette, predictor,
subtract-green) is chosen by its payload alone. Reading decodes many images side by side, in
bounded groups.

Defined cases: a null or empty text is one row of zeros; equal texts have equal media; repeated rows are stored each for
itself; a text beyond 1 GiB raises an error; an empty table gives an empty result; other columns are ignored.
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

from tidemark.llm import webp
from tidemark.llm.shared import bounded_batches, pieces, utf8, written


@dataclass(frozen=True)
class Store:
    width: int = 16
    #: Most rows of an image, and most pixels of a row, in the format.
    most: int = 16_384
    #: Bytes of payload that are worked on at once.
    group_bytes: int = 8 << 20

    def payload_bytes(self, n_bytes: int) -> int:
        return max(4 * self.width, n_bytes + -n_bytes % (4 * self.width))

    def image_width(self, n_bytes: int) -> int:
        width = self.width * -(-self.payload_bytes(n_bytes) // (4 * self.width * self.most))
        if width > self.most:
            raise ValueError("a text is too long for an image")
        return width


def stored(texts: list[bytes], how: Store) -> list[bytes]:
    """The media of each text: one WebP file."""
    widths = [how.image_width(len(t)) for t in texts]
    return webp.encode([t + bytes(max(4 * w - len(t), -len(t) % (4 * w))) for t, w in zip(texts, widths, strict=True)], widths)


def store(df: DataFrame, how: Store = Store()) -> DataFrame:
    """doc_id, n_bytes and media of each row of (doc_id, text)."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(1))
            for part in pieces(texts, limit=how.group_bytes):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.start, part.stop - part.start), pa.array([len(t) for t in texts[part]], pa.int64()), pa.array(stored(texts[part], how), pa.binary())], names=["doc_id", "n_bytes", "media"])

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_bytes long, media binary")


_DIGEST = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def feature(samples: np.ndarray) -> str:
    """Height and the samples' sums by channel."""
    return ":".join(map(str, [samples.shape[0], *samples.sum(axis=(0, 1), dtype=np.int64).tolist()]))


def read(df: DataFrame, how: Store = Store()) -> DataFrame:
    """Decodes the media of (doc_id, n_bytes, media) and describes the payloads."""
    bounded_batches(df.sparkSession)
    names = [x.split()[0] for x in _DIGEST.split(", ")]

    def run(batches):
        for batch in batches:
            media, sizes = utf8(batch.column(2)), batch.column(1).to_pylist()
            for part in pieces(media, limit=how.group_bytes):
                rows = []
                for m, n, samples in zip(media[part], sizes[part], webp.decode(media[part]), strict=True):
                    p = samples.tobytes()[: how.payload_bytes(n)]
                    rows.append((len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), len(m), hashlib.sha256(m).hexdigest(), feature(samples)))
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(part.start, part.stop - part.start) for i in (0, 1)), *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True))], names=names)

    return df.select("doc_id", "n_bytes", "media").mapInArrow(run, _DIGEST)


def round_trip(df: DataFrame, how: Store = Store()) -> DataFrame:
    """Stores all rows as a table in the shared folder, reads it back and describes the payloads."""
    return read(written(store(df, how), "media"), how)
