"""WARC archives: writing of segmented, chunked records with revisits, and reassembly on reading.

Writing: every row is a capture. Captures with equal payloads of enough bytes share one response, that of the smallest
id; the others are revisits that name it. A response's block (HTTP head and body in chunked transfer framing) is cut into
segments, each a record of its own: the first carries the head, continuations name the origin record and their segment
number, the last the total length. Files are written by Spark's text writer, whose line separator is the record end.

Reading: files are read whole, they are bounded by the number of records and the segment length; records are parsed by
their lengths, continuations are grouped by origin identifier, put in order of segment number, checked against the
total length, and the chunked framing is decoded.

Defined cases: a null payload is empty; a null url is written as urn:none; repeated ids are captures of their own; of
equal payloads the first is the smallest id, nulls last, then the smallest hash of the url; an empty table gives an archive
without records. Missing segments, wrong lengths or bad framing raise an error.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.shared import PIECE_BYTES, bounded_batches, new_path, repeated, utf8, written

_END = "\r\n\r\n"


@dataclass(frozen=True)
class Archive:
    #: Bytes of a block in one record, of a chunk of a body, and records in one file.
    segment_bytes: int = 16_384
    chunk_bytes: int = 4_096
    file_records: int = 256
    #: Equal payloads below this length are all kept as responses.
    least_revisit: int = 100
    #: The captures of one payload are dealt to so many groups.
    salts: int = 32
    #: More exact repetitions than this are made in several tasks.
    repeat_block: int = 1 << 16
    compression: str = "gzip"


def _lines(*parts) -> Column:
    return F.concat(*(p if isinstance(p, Column) else F.lit(p) for p in parts))


def captures(df: DataFrame, how: Archive = Archive()) -> DataFrame:
    """id, url, payload (binary), its digest, record key, and the key of the response that it revisits, if any (then without payload).

    The response of equal payloads is a grouped minimum, revisits meet it without their payloads and dealt by digest and salt,
    and equal rows are one row with a count until they are numbered. So no group of copies meets in a task with its payloads.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = df.select(F.col("page_id").alias("id"), F.coalesce("url", F.lit("urn:none")).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("bytes", F.octet_length("payload").cast("long"))
    rows = rows.withColumn("key", F.concat_ws("-", F.coalesce(F.col("id").cast("string"), F.lit("none")), F.substring("digest", 1, 16), F.lower(F.hex(F.xxhash64("url")))))
    place = F.struct(F.col("id").isNull().alias("last"), "id", "key")
    numbered = lambda c: repeated(c, "n", ["key", "url"], how.repeat_block).withColumn("key", F.concat_ws("-", "key", (F.col("copy") + F.col("start")).cast("string")))
    names = ["id", "url", "payload", "digest", "key"]
    # equal rows are told apart by a number within their key; of a long payload one capture is the response
    small = F.col("bytes") < how.least_revisit
    one = rows.withColumn("own", F.when(small, F.struct("key", "url"))).groupBy("digest", "own").agg(F.min_by(F.struct("id", "url", "payload", "key"), place).alias("x"), F.count("*").alias("n"))
    one = one.select("x.id", "x.url", "x.payload", "digest", "x.key", F.lit(0).alias("start"), F.when(F.col("own").isNull(), 1).otherwise(F.col("n")).cast("long").alias("n"))
    one = numbered(one).select(*names, F.lit(None).cast("string").alias("revisits"))
    groups = rows.where(~small).groupBy("digest", "key", "id", "url").agg(F.count("*").alias("n"))
    first = groups.groupBy("digest").agg(F.sum("n").alias("n"), F.min(place).alias("first")).where("n > 1").select("digest", F.col("first.key").alias("first_key"), F.explode(F.sequence(F.lit(0), F.lit(how.salts - 1))).alias("salt"))
    groups = groups.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(how.salts)).cast("int"))
    is_first = F.col("key") == F.col("first_key")
    others = groups.join(first.drop("n"), ["digest", "salt"]).withColumns({"revisits": F.concat("first_key", F.lit("-0")), "start": F.when(is_first, 1).otherwise(0)})
    others = numbered(others.withColumn("n", F.col("n") - F.col("start"))).select("id", "url", F.lit(None).cast("binary").alias("payload"), "digest", "key", "revisits")
    return one.union(others)


_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def cut(common: bytes, key: bytes, payload: bytes, how: Archive) -> Iterator[bytes]:
    """The records of one response without their ends: the payload in chunks behind the HTTP head, cut into segments. `common` are the fields that all its records bear."""
    framed = [_HEAD]
    for at in range(0, len(payload), how.chunk_bytes):
        piece = payload[at : at + how.chunk_bytes]
        framed += (b"%x\r\n" % len(piece), piece, b"\r\n")
    framed.append(b"0\r\n\r\n")
    block = b"".join(framed)
    last = (len(block) - 1) // how.segment_bytes
    for i in range(last + 1):
        part = block[i * how.segment_bytes : (i + 1) * how.segment_bytes]
        if i == 0:
            fields = [b"WARC/1.1\r\nWARC-Type: response", common, b"Content-Type: application/http;msgtype=response\r\nWARC-Record-ID: <urn:capture:%b>\r\n" % key]
        else:
            fields = [b"WARC/1.1\r\nWARC-Type: continuation", common, b"WARC-Record-ID: <urn:capture:%b:%d>\r\nWARC-Segment-Origin-ID: <urn:capture:%b>\r\n" % (key, i + 1, key)]
        if last:
            fields.append(b"WARC-Segment-Number: %d\r\n" % (i + 1))
            if i == last:
                fields.append(b"WARC-Segment-Total-Length: %d\r\n" % len(block))
        yield b"".join([*fields, b"Content-Length: %d" % len(part), _END.encode(), part])


def _records(c: DataFrame, how: Archive) -> DataFrame:
    """One row a record: its text without the record end. Bytes pass through strings unchanged."""
    bounded_batches(c.sparkSession)
    common = _lines("\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nWARC-Target-URI: ", F.regexp_replace("url", "[\r\n]", " "), "\r\nWARC-Payload-Digest: sha256:", F.col("digest"), "\r\nX-Page-Id: ", F.coalesce(F.col("id").cast("string"), F.lit("")), "\r\n")

    def run(batches):
        for batch in batches:
            out, held = [], 0
            for row in zip(*(utf8(batch.column(i)) for i in range(3)), strict=True):
                for record in cut(*row, how):
                    out.append(record)
                    held += len(record)
                    if held > PIECE_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
                        out, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    responses = c.where("revisits is null").select(common.alias("common"), "key", "payload").mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    revisit = _lines("WARC/1.1\r\nWARC-Type: revisit", common, "WARC-Record-ID: <urn:capture:", F.col("key"), ">\r\nWARC-Refers-To: <urn:capture:", F.col("revisits"), ">\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nContent-Length: 0", _END)
    return responses.union(c.where("revisits is not null").select(revisit.alias("value")))


def write(df: DataFrame, path: str, how: Archive = Archive()) -> None:
    """Writes the rows of (page_id, url, html) as WARC files under the path."""
    _records(captures(df, how), how).write.option("lineSep", _END).option("maxRecordsPerFile", how.file_records).option("compression", how.compression).text(path)


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields, names in lower case, and block of each record of a file."""
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        version, *lines = content[at:end].decode("utf-8", "replace").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        start = end + 4
        stop = start + int(fields["content-length"])
        if content[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} has a wrong length")
        yield fields, content[start:stop]
        at = stop + 4


def unchunked(body: bytes) -> bytes:
    """The payload of a body in chunked transfer framing; extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        n = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if n == 0:
            return b"".join(out)
        if body[at + n : at + n + 2] != b"\r\n":
            raise ValueError("a chunk has a wrong length")
        out.append(body[at : at + n])
        at += n + 2


_PARSED = "record_id string, origin string, type string, segment int, segmented boolean, total long, page string, refers string, digest string, block binary"


def records(spark: SparkSession, path: str) -> DataFrame:
    """The records of all files under the path."""
    bounded_batches(spark)
    names = [x.split()[0] for x in _PARSED.split(", ")]

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows = []
                raw = content.as_py()
                for f, block in parse(gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw):
                    own = f["warc-record-id"].strip("<>")
                    total = f.get("warc-segment-total-length")
                    rows.append((own, f.get("warc-segment-origin-id", own).strip("<>"), f["warc-type"], int(f.get("warc-segment-number", 1)), "warc-segment-number" in f, int(total) if total else None, f.get("x-page-id", ""), f.get("warc-refers-to", "").strip("<>") or None, f.get("warc-payload-digest", "").removeprefix("sha256:"), block))
                kinds = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * len(kinds), kinds, strict=True)], names=names)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, _PARSED)


_DECODED = "record_id string, page string, refers string, digest string, payload binary"


def reassembled(parsed: DataFrame) -> DataFrame:
    """All captures: record id, page, and the payload of a response, or what a revisit refers to and its digest. Only records in several segments are grouped; a group is one capture."""
    whole, part = (F.col("type") == "response") & (F.col("segment") == 1) & ~F.col("segmented"), F.struct("segment", "block")
    one = parsed.where(whole | (F.col("type") == "revisit")).select("origin", F.when(whole, F.array(part)).alias("parts"), "total", "page", "refers", "digest")
    more = parsed.where(F.col("type").isin("response", "continuation") & ~whole).groupBy("origin").agg(F.sort_array(F.collect_list(part)).alias("parts"), F.max("total").alias("total"), F.max(F.when(F.col("type") == "response", F.col("page"))).alias("page"))
    more = more.select("*", F.lit(None).cast("string").alias("refers"), F.lit(None).cast("string").alias("digest"))
    kinds_out = [pa.string(), pa.string(), pa.string(), pa.string(), pa.binary()]
    names = [x.split()[0] for x in _DECODED.split(", ")]

    def payload(origin: str, parts: list[dict], total: int | None) -> bytes:
        if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)):
            raise ValueError(f"{origin} lacks segments or has some twice")
        block = b"".join(p["block"] for p in parts)
        if (total is None) != (len(parts) == 1) or total is not None and total != len(block):
            raise ValueError(f"{origin} has {len(block)} bytes in segments of {total}")
        head, _, body = block.partition(b"\r\n\r\n")
        return unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body

    def run(batches):
        for batch in batches:
            out = []
            for origin, parts, total, page, refers, digest in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                out.append((origin, page, refers, digest, None if parts is None else payload(origin, parts, total)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds_out)], names=names)

    return one.union(more).mapInArrow(run, _DECODED)


def read(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every capture; a revisit has its response's payload.

    What describes a capture is written to the shared folder, without payloads, so that archives aren't parsed again for the responses that revisits name.
    """
    decoded = reassembled(records(spark, path))
    described = decoded.select("record_id", "refers", "digest", F.expr("try_cast(page as long)").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"))
    described = written(described, "warc-captures")
    response = F.col("payload_bytes").isNotNull()
    own = described.where(response).select("page_id", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    target = described.where(response).select(F.col("record_id").alias("refers"), F.col("page_id").alias("refers_to"), "payload_bytes", "payload_digest")
    revisits = described.where(~response).select("refers", "digest", "page_id")
    found = revisits.join(target, "refers", "left").select("page_id", "payload_bytes", F.when(F.col("payload_digest") == F.col("digest"), F.col("payload_digest")).otherwise(F.raise_error(F.concat(F.lit("a revisit has no response of its digest: "), "refers"))).alias("payload_digest"), F.lit("revisit").alias("record_type"), "refers_to")
    return own.union(found)


def round_trip(df: DataFrame, how: Archive = Archive()) -> DataFrame:
    """Writes the rows to the shared folder and reads them back."""
    path = new_path(df.sparkSession, "warc")
    write(df, path, how)
    return read(df.sparkSession, path)
