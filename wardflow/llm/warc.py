"""WARC archives of Zstandard frames, one frame per record.

An archive is a valid Zstandard stream. Its leading skippable frame (magic
0x184D2A5D) holds the dictionary, itself compressed; then every record is one
frame made with that dictionary. Spark's own text writer puts the frames down, so
any store Spark writes to will do and its commit protocol handles tasks that run
again: a frame is one "line", and the line separator is an empty skippable frame,
which Zstandard readers pass over.

Each archive's dictionary is trained by the task that writes it, from the first
``SAMPLE_BYTES`` of its payloads. It affects sizes only, never contents. A task
holds that sample and one record; a reader holds one archive, as large as a
partition of the table written, and one record.

Defined results: a null payload is empty; null or odd URLs are percent-encoded; a
null id is written as ``null`` and read back as null. Of records with equal
payloads (SHA-256) of at least ``min_bytes`` bytes, those with the largest id are
responses and the others revisit it; repeated rows with that id are each written as
a response. Null ids are smaller than all others. An empty table gives no archive
and an empty result. Extra columns are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import struct
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from wardflow.llm.common import ship, stored

DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
# An empty skippable frame, all of its bytes ASCII.
SEPARATOR = "\x50\x2a\x4d\x18\x00\x00\x00\x00"
SAMPLE_BYTES = 4 << 20
DICTIONARY_BYTES = 64 << 10
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")

RECORD_SCHEMA = (
    "id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, "
    "payload_digest string, payload binary, problem string"
)
RECORD_ARROW = pa.schema([
    ("id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
    ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("payload", pa.binary()), ("problem", pa.string()),
])


class BadRecord(ValueError):
    """A record or frame that breaks the format."""


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def urn(number: int | None) -> str:
    return f"<urn:page:{'null' if number is None else number}>"


def from_urn(text: str) -> int | None:
    if not (text.startswith("<urn:page:") and text.endswith(">")):
        raise BadRecord(f"record id {text!r}")
    inner = text[10:-1]
    return None if inner == "null" else int(inner)


def record_bytes(number: int | None, url: str | None, payload: bytes, refers_to: int | None,
                 revisit: bool) -> bytes:
    """One WARC record. A revisit has the HTTP headers of its payload, not the payload."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", urn(number)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", quote(url or "", safe=":/?#[]@!$&'()*+,;=%~")),
        ("WARC-Payload-Digest", "sha1:" + sha1_base32(payload)),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", urn(refers_to))]
    fields.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def train(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    """A trained dictionary; raw content where there is too little to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:
        raw = b"".join(samples)[:DICTIONARY_BYTES].ljust(8, b"\0")
        return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def dictionary_frame(dictionary: zstandard.ZstdCompressionDict) -> bytes:
    packed = zstandard.ZstdCompressor().compress(dictionary.as_bytes())
    return struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed


def _frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def records() -> Iterator[bytes]:
        for batch in batches:
            for i in range(batch.num_rows):
                number, url, payload, refers_to, revisit = (c[i].as_py() for c in batch.columns)
                yield record_bytes(number, url, payload, refers_to, revisit)

    rows = records()
    samples: list[bytes] = []
    size = 0
    for record in rows:
        samples.append(record)
        size += len(record)
        if size >= SAMPLE_BYTES:
            break
    if not samples:
        return
    dictionary = train(samples)
    packer = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_content_size=True)
    out, size = [dictionary_frame(dictionary)], 0
    for record in itertools.chain(samples, rows):
        out.append(packer.compress(record))
        size += len(out[-1])
        if size >= 4 << 20:
            yield pa.record_batch([pa.array(out, pa.binary())], names=["frame"])
            out, size = [], 0
    if out:
        yield pa.record_batch([pa.array(out, pa.binary())], names=["frame"])


def write_archives(
    df: DataFrame, path: str, id_col: str, url_col: str, payload_col: str, min_bytes: int = 0
) -> None:
    """Write a record per row of ``df``, one archive per partition.

    Winners of equal payloads come from a combined count, written first; with that
    table as the other side, AQE splits a payload that many rows share.
    """
    ship(df.sparkSession)
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary"))
    rows = df.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(url_col).alias("url"),
        payload.alias("payload"), F.sha2(payload, 256).alias("digest"),
    )
    winners = stored(
        rows.where(F.length("payload") >= min_bytes)
        .groupBy("digest")
        .agg(F.max("id").alias("winner"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", "winner"),
        "payloads",
    )
    revisit = F.col("winner").isNotNull() & ~F.col("id").eqNullSafe(F.col("winner"))
    records = rows.join(winners, "digest", "left").select(
        "id", "url", "payload",
        F.when(revisit, F.col("winner")).alias("refers_to"), revisit.alias("revisit"),
    )
    frames = records.mapInArrow(_frames, "frame binary")
    (
        frames.select(F.col("frame").cast("string").alias("value"))
        .write.option("lineSep", SEPARATOR).option("maxRecordsPerFile", 0).text(path)
    )


def next_frame(data: memoryview, at: int, unpacker: zstandard.ZstdDecompressor,
               step: int = 16 << 10) -> tuple[bytes, int]:
    """Content of the frame at ``at`` and the place behind it."""
    one, parts = unpacker.decompressobj(), []
    while not one.eof:
        if at >= len(data):
            raise BadRecord("the archive ends within a frame")
        chunk = data[at:at + step]
        try:
            parts.append(one.decompress(chunk))
        except zstandard.ZstdError as error:
            raise BadRecord(str(error)) from error
        at += len(chunk) - len(one.unused_data)
    return b"".join(parts), at


def archive_records(content: bytes) -> Iterator[bytes]:
    """Decode an archive, one frame at a time."""
    data, at = memoryview(content), 0
    unpacker = zstandard.ZstdDecompressor()
    while at < len(data):
        if len(data) - at < 8:
            raise BadRecord("the archive ends within a frame")
        magic, size = struct.unpack_from("<II", data, at)
        if magic in SKIPPABLE:
            body = bytes(data[at + 8:at + 8 + size])
            if len(body) != size:
                raise BadRecord("the archive ends within a skippable frame")
            if magic == DICTIONARY_MAGIC and at == 0:
                if body[:4] == FRAME_MAGIC:
                    body = zstandard.ZstdDecompressor().decompress(body)
                unpacker = zstandard.ZstdDecompressor(
                    dict_data=zstandard.ZstdCompressionDict(body))
            at += 8 + size
        else:
            record, at = next_frame(data, at, unpacker)
            yield record


def headers(head: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = head.decode("utf-8").split("\r\n")
    found = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon:
            raise BadRecord(f"header line {line!r}")
        found[name.strip().lower()] = value.strip()
    return first, found


def length_of(found: dict[str, str]) -> int:
    text = found.get("content-length", "")
    if not (text.isascii() and text.isdigit()):
        raise BadRecord(f"content length {text!r}")
    return int(text)


def parse(record: bytes) -> tuple:
    """Fields of a record in the order of ``RECORD_SCHEMA``, checked."""
    end = record.find(b"\r\n\r\n")
    if end < 0:
        raise BadRecord("no end of headers")
    version, found = headers(record[:end])
    if version not in ("WARC/1.0", "WARC/1.1"):
        raise BadRecord(f"version {version!r}")
    for name in REQUIRED:
        if name.lower() not in found:
            raise BadRecord(f"no {name}")
    block, tail = record[end + 4:-4], record[-4:]
    if tail != b"\r\n\r\n" or length_of(found) != len(block):
        raise BadRecord(f"{len(block)} bytes where {found['content-length']} are stated")
    kind = found["warc-type"]
    if kind not in ("response", "revisit"):
        raise BadRecord(f"type {kind!r}")
    http_end = block.find(b"\r\n\r\n")
    if http_end < 0:
        raise BadRecord("no end of HTTP headers")
    size = length_of(headers(block[:http_end])[1])
    payload = block[http_end + 4:]
    digest = found.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or sha1_base32(payload) != digest):
        raise BadRecord("the payload differs from its length or digest")
    if kind == "revisit" and (payload or "warc-refers-to" not in found):
        raise BadRecord("a revisit with a payload or without what it refers to")
    refers_to = from_urn(found["warc-refers-to"]) if kind == "revisit" else None
    return (
        from_urn(found["warc-record-id"]), unquote(found.get("warc-target-uri", "")), kind,
        refers_to, size, digest, payload if kind == "response" else None, None,
    )


def _reader(keep_bad: bool, payloads: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows, size = [], 0
                for row in _rows(batch.column(0)[i].as_py(), keep_bad):
                    rows.append(row if payloads else (*row[:6], None, row[7]))
                    size += 200 + len(rows[-1][6] or b"")
                    if size >= 4 << 20:
                        yield _batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows)

    return read


def _rows(content: bytes, keep_bad: bool) -> Iterator[tuple]:
    records = archive_records(content)
    while True:
        try:
            record = next(records, None)
            if record is None:
                return
            yield parse(record)
        except BadRecord as error:
            if not keep_bad:
                raise
            yield (None,) * 7 + (str(error),)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array(c, f.type) for c, f in zip(zip(*rows), RECORD_ARROW)], schema=RECORD_ARROW)


def read_archives(
    spark: SparkSession, path: str, keep_bad: bool = False, payloads: bool = True
) -> DataFrame:
    """Records of all archives in a folder.

    A bad record raises, or with ``keep_bad`` becomes a row that has only
    ``problem``; behind a damaged frame nothing more can be read of its archive.
    """
    ship(spark)
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_reader(keep_bad, payloads), RECORD_SCHEMA)
