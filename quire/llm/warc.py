"""WARC archives compressed with Zstandard: writer and reader.

An archive is a leading skippable frame with the compression dictionary,
then one frame per record.  Archives are written by Spark's own file writer
(the only one that reaches every store the cluster names): a partition is an
archive, a row a frame, and the line separator an empty skippable frame, which
readers of the format pass over.  The reader takes whole archives (bounded by
the writer's partition size), loads the dictionary, finds the ends of frames
from their block headers, decodes one frame per record and checks header lines,
lengths and digests.

Records with equal payloads of at least ``revisit_bytes`` bytes: that with the
largest id is ``response``, the others ``revisit`` it (they carry the HTTP
header, but no payload).  Rows that share the largest id are all responses.  A
null payload is empty, a null id sorts lowest, a null url leaves its header
out, and repeated rows give repeated records.  An empty table gives no records.
"""

from __future__ import annotations

import base64
import hashlib
import os
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import bounded_batches, bounded_sample
from quire.session import checkpoint_dir

# fixed values of the format
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = 0xFD2FB528
EMPTY_FRAME = struct.pack("<II", SKIPPABLE[0], 0)
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# the dictionary is fitted on so many pages at most, the first bytes of each
SAMPLE_PAGES, SAMPLE_BYTES, DICTIONARY_BYTES = 200, 8192, 16384
ARCHIVE_DATE = "1970-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def train_dictionary(pages: DataFrame, id_col: str, payload: str) -> bytes:
    """A dictionary fitted on a bounded sample; empty where there is too little."""
    head = {"head": F.substring(payload, 1, SAMPLE_BYTES)}
    sample = bounded_sample(pages.where(F.length(payload) > 0), id_col, head, SAMPLE_PAGES)
    heads = [r["head"].encode() for r in sample]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, heads).as_bytes() if len(heads) > 7 else b""
    except zstandard.ZstdError:  # too few different samples
        return b""


def _codec(kind, dictionary: bytes, **options):
    if dictionary:
        options["dict_data"] = zstandard.ZstdCompressionDict(dictionary)
    return kind(**options)


def _line(value: str) -> str:
    """A header value on one line."""
    return "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record(page_id, url: str | None, payload: bytes, refers_to) -> bytes:
    """One record; a revisit where ``refers_to`` is given."""
    revisit = refers_to is not None
    digest = payload_digest(payload)
    block = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        + b"Content-Length: %d\r\n\r\n" % len(payload)
        + (b"" if revisit else payload)
    )
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{page_id}>"),
        ("WARC-Date", ARCHIVE_DATE),
        *([("WARC-Target-URI", _line(url))] if url is not None else []),
        *([("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)] if revisit else []),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{payload_digest(block)}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head).encode()
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def originals(pages: DataFrame, id_col: str, payload: str, revisit_bytes: int = 0) -> DataFrame:
    """(_id, _digest, _refers_to) for the rows that revisit another: digests are
    counted on narrow rows, map-side first; payloads stay where they are."""
    keys = pages.select(
        F.col(id_col).alias("_id"),
        F.sha1(F.coalesce(F.col(payload), F.lit("")).cast("binary")).alias("_digest"),
        F.coalesce(F.octet_length(payload), F.lit(0)).alias("_bytes"),
    ).where(F.col("_bytes") >= revisit_bytes)
    shared = (
        keys.groupBy("_digest")
        .agg(F.max("_id").alias("_refers_to"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .drop("_n")
    )
    return (
        keys.join(shared, "_digest")
        .where(~F.col("_id").eqNullSafe(F.col("_refers_to")))
        .select("_id", "_digest", "_refers_to")
        .distinct()
    )


def write_archives(
    pages: DataFrame,
    path: str | None = None,
    id_col: str = "page_id",
    url: str = "url",
    payload: str = "html",
    revisit_bytes: int = 0,
) -> str:
    """Write one record per row below ``path`` (a new folder beside the
    checkpoints when not given) and return the path."""
    spark = pages.sparkSession
    bounded_batches(spark)
    path = path or os.path.join(checkpoint_dir(spark), "warc", uuid.uuid4().hex)
    dictionary = train_dictionary(pages, id_col, payload)
    rows = pages.select(
        F.col(id_col).alias("_page"),
        F.col(url).cast("string").alias("_url"),
        F.coalesce(F.col(payload), F.lit("")).cast("binary").alias("_payload"),
        F.sha1(F.coalesce(F.col(payload), F.lit("")).cast("binary")).alias("_sha"),
    )
    links = originals(pages, id_col, payload, revisit_bytes)
    rows = rows.join(
        links, F.col("_page").eqNullSafe(F.col("_id")) & (F.col("_sha") == F.col("_digest")), "left"
    ).select("_page", "_url", "_payload", "_refers_to")

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(zstandard.ZstdCompressor, dictionary, level=3, write_checksum=True)
        head = [struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary]
        for b in batches:
            found = [codec.compress(record(*r)) for r in zip(*(c.to_pylist() for c in b.columns))]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(head + found, pa.binary())], names=["frame"])
                head = []

    (
        rows.mapInArrow(frames, "frame binary")
        .select(F.col("frame").cast("string").alias("value"))
        .write.option("lineSep", EMPTY_FRAME.decode())
        .text(path)
    )
    return path


def frame_end(data: memoryview, at: int) -> int:
    """End of the frame that starts at ``at``, from its block headers."""
    params = zstandard.get_frame_parameters(data[at : at + 18])
    end = at + zstandard.frame_header_size(data[at : at + 18])
    last = False
    while not last:
        if end + 3 > len(data):
            raise ValueError(f"frame at {at} is cut off")
        word = int.from_bytes(data[end : end + 3], "little")
        last, kind, size = word & 1, word >> 1 & 3, word >> 3
        end += 3 + (1 if kind == 1 else size)
    end += 4 * params.has_checksum
    if end > len(data):
        raise ValueError(f"frame at {at} is cut off")
    return end


def frames_of(archive: bytes) -> Iterator[tuple[int, bytes]]:
    """(offset, record bytes) of each record frame."""
    data, at, codec = memoryview(archive), 0, None
    while at < len(data):
        if at + 8 > len(data):
            raise ValueError(f"bytes after the last frame at {at}")
        magic, size = struct.unpack_from("<II", data, at)
        if magic in SKIPPABLE:
            if at + 8 + size > len(data):
                raise ValueError(f"skippable frame at {at} is cut off")
            if magic == DICTIONARY_MAGIC and at == 0:
                body = bytes(data[8 : 8 + size])
                if body[:4] == struct.pack("<I", FRAME_MAGIC):  # may itself be compressed
                    body = zstandard.ZstdDecompressor().decompress(body)
                codec = _codec(zstandard.ZstdDecompressor, body)
            at += 8 + size
            continue
        if magic != FRAME_MAGIC:
            raise ValueError(f"no frame at {at}")
        end = frame_end(data, at)
        codec = codec or zstandard.ZstdDecompressor()
        yield at, codec.decompress(bytes(data[at:end]))
        at = end


def _headers(lines: bytes, first: bytes) -> dict[str, str]:
    top, *rest = lines.split(b"\r\n")
    if not top.startswith(first):
        raise ValueError(f"a record starts with {top[:40]!r}")
    found = {}
    for line in rest:
        name, colon, value = line.decode().partition(":")
        if not colon or name.lower() in found:
            raise ValueError(f"bad header line {line[:80]!r}")
        found[name.lower()] = value.strip()
    return found


def parse_record(data: bytes) -> dict:
    """Checked fields of a record; ValueError where header, length or digest is wrong."""
    lines, gap, rest = data.partition(b"\r\n\r\n")
    head = _headers(lines, VERSION)
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest"):
        if name not in head:
            raise ValueError(f"{name} is missing")
    size = int(head["content-length"])
    if not gap or len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"content-length {size}, {len(rest) - 4} bytes")
    block, digest = rest[:size], head["warc-payload-digest"].removeprefix("sha1:")
    if head.get("warc-block-digest", "sha1:" + payload_digest(block)) != "sha1:" + payload_digest(block):
        raise ValueError("the block digest differs")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(_headers(http, b"HTTP/")["content-length"])
    kind = head["warc-type"]
    if kind == "revisit":
        if payload or "warc-refers-to" not in head:
            raise ValueError("a revisit has a payload or refers to nothing")
    elif kind != "response":
        raise ValueError(f"record type {kind!r}")
    elif len(payload) != length or payload_digest(payload) != digest:
        raise ValueError("payload length or digest differs")
    return {
        "record_id": head["warc-record-id"].strip("<>"),
        "record_type": kind,
        "target_uri": head.get("warc-target-uri"),
        "refers_to": head["warc-refers-to"].strip("<>") if kind == "revisit" else None,
        "payload_digest": digest,
        "payload_bytes": length,
        "payload": payload if kind == "response" else None,
    }


READ_SCHEMA = (
    "archive string, offset long, record_id string, record_type string, target_uri string, "
    "refers_to string, payload_digest string, payload_bytes long, payload binary"
)


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives below ``path``; a damaged archive
    raises and names itself.  ``payload`` is null where not asked for and for
    revisits."""
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")
    kinds = [pa.string(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.binary()]
    names = [f.strip().split(" ")[0] for f in READ_SCHEMA.split(",")]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names
            )

        for b in batches:
            for file, content in zip(b.column(0).to_pylist(), b.column(1)):
                rows = []
                try:
                    for offset, data in frames_of(content.as_py()):
                        r = parse_record(data)
                        r["payload"] = r["payload"] if with_payload else None
                        rows.append((file, offset, *(r[n] for n in names[2:])))
                        if len(rows) >= 512:
                            yield out(rows)
                            rows = []
                except (ValueError, zstandard.ZstdError) as wrong:
                    raise ValueError(f"{file}: {wrong}") from wrong
                if rows:
                    yield out(rows)

    return files.mapInArrow(parse, READ_SCHEMA)
