"""Zstandard web archives: one frame per record, with a dictionary in a leading skippable frame.

Records are written to files of a bounded size in the shared folder. A file begins with a skippable
frame that holds its dictionary, trained on the first payloads of the file; every record is a frame of its
own. Files of lost or repeated tasks do no harm: only those in the manifest, which Spark commits, are read.

The reader takes each file from Spark, loads the dictionary (packed or not), decodes frame after frame, and
checks the header lines, the declared and the real block length, and the digests. A file that does
not hold raises an error that names the file and the offset.
"""

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote, unquote

import pandas as pd
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from casewise.sources.storage import fresh_path, staged

# Fixed values of the formats.
SKIPPABLE = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

ARCHIVE_BYTES = 16 << 20  # a file is closed once it has as many
DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 4 << 20  # payloads the dictionary of a file is trained on, at most
_STEP = 1 << 16


class ArchiveError(ValueError):
    """A file that is not a valid archive."""


class Record(NamedTuple):
    fields: dict[str, str]
    block: bytes


def digest(data: bytes) -> str:
    """Bare base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(record: Record) -> bytes:
    lines = [VERSION, *(f"{name}: {value}".encode() for name, value in record.fields.items()), b"", record.block, b"", b""]
    return b"\r\n".join(lines)


def parse_record(data: bytes) -> Record:
    head, mark, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not mark or lines[0] != VERSION:
        raise ArchiveError("no record header")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.decode("utf-8").partition(":")
        if not colon or not name or name in fields:
            raise ArchiveError(f"bad header line {name!r}")
        fields[name] = value.strip()
    for name in ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"):
        if name not in fields:
            raise ArchiveError(f"no {name}")
    length = fields["Content-Length"]
    if not length.isdecimal() or len(rest) != int(length) + 4 or rest[-4:] != b"\r\n\r\n":
        raise ArchiveError("the block is not as long as declared")
    block = rest[:-4]
    if fields.get("WARC-Block-Digest", f"sha1:{digest(block)}") != f"sha1:{digest(block)}":
        raise ArchiveError("the block does not have its digest")
    return Record(fields, block)


def page_record(name: str, url: str | None, payload: bytes, refers_to: str | None) -> Record:
    """A response with the payload, or a revisit that refers to the record of the same payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": _uri(name),
        "WARC-Date": DATE,
        "WARC-Target-URI": quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else _uri(name)[1:-1],
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
        "WARC-Block-Digest": f"sha1:{digest(block)}",
        "Content-Type": "application/http; msgtype=response",
    }
    if refers_to is not None:
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": _uri(refers_to)}
    return Record(fields | {"Content-Length": str(len(block))}, block)


def read_page(record: Record) -> dict:
    """What a page record says, after a check of its payload."""
    kind, fields = record.fields["WARC-Type"], record.fields
    if kind not in ("response", "revisit"):
        raise ArchiveError(f"unexpected record type {kind!r}")
    head, mark, payload = record.block.partition(b"\r\n\r\n")
    lengths = [int(v) for n, _, v in (x.partition(b":") for x in head.split(b"\r\n")) if n.lower() == b"content-length"]
    if not mark or len(lengths) != 1:
        raise ArchiveError("no http header")
    declared = fields.get("WARC-Payload-Digest", "")
    if kind == "response" and (len(payload) != lengths[0] or f"sha1:{digest(payload)}" != declared):
        raise ArchiveError("the payload does not have its length and digest")
    if kind == "revisit" and payload:
        raise ArchiveError("a revisit has a payload")
    return {
        "page": _page(fields["WARC-Record-ID"]),
        "payload_bytes": lengths[0],
        "payload_digest": declared.removeprefix("sha1:"),
        "record_type": kind,
        "refers_to": _page(fields["WARC-Refers-To"]) if kind == "revisit" else None,
        "payload": payload if kind == "response" else None,
    }


def _uri(page: str) -> str:
    return f"<urn:x-page:{quote(page, safe='')}>"


def _page(uri: str) -> str:
    if not uri.startswith("<urn:x-page:") or not uri.endswith(">"):
        raise ArchiveError(f"bad record id {uri!r}")
    return unquote(uri[len("<urn:x-page:") : -1])


def train_dictionary(payloads: list[bytes]) -> bytes:
    """A dictionary from sample payloads; the first payloads themselves where there are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, payloads).as_bytes()
    except zstandard.ZstdError:
        return b"".join(payloads)[:DICTIONARY_BYTES]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


class ArchiveWriter:
    """Writes the bytes of one archive."""

    def __init__(self, out: io.RawIOBase, samples: list[bytes]):
        self.out = out
        data = train_dictionary(samples)
        packed = zstandard.ZstdCompressor().compress(data)
        head = struct.pack("<II", SKIPPABLE, len(packed)) + packed
        self.compressor = zstandard.ZstdCompressor(dict_data=_dictionary(data), write_checksum=True)
        self.size = out.write(head)
        self.records = 0

    def add(self, record: Record) -> None:
        self.size += self.out.write(self.compressor.compress(record_bytes(record)))
        self.records += 1


def read_archive(data: bytes) -> Iterator[Record]:
    """The records of an archive, one per frame."""
    view = memoryview(data)
    if len(view) < 8 or struct.unpack_from("<I", view)[0] != SKIPPABLE:
        raise ArchiveError("no dictionary frame at offset 0")
    at = 8 + struct.unpack_from("<I", view, 4)[0]
    if at > len(view):
        raise ArchiveError("the dictionary frame is cut off")
    dictionary = bytes(view[8:at])
    if dictionary[:4] == ZSTD_MAGIC:
        dictionary = zstandard.ZstdDecompressor().decompress(dictionary)
    decompressor = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))
    while at < len(view):
        begun, frame, out = at, decompressor.decompressobj(), io.BytesIO()
        try:
            while not frame.eof and at < len(view):
                part = view[at : at + _STEP]
                out.write(frame.decompress(part))
                at += len(part) - len(frame.unused_data)
            if not frame.eof:
                raise ArchiveError("the frame is cut off")
            yield parse_record(out.getvalue())
        except (ArchiveError, zstandard.ZstdError, UnicodeDecodeError) as error:
            raise ArchiveError(f"offset {begun}: {error}") from error


def write_archives(pages: DataFrame, key: str, url: str, payload: str, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write a record per row to archives in ``folder``, which all executors reach; gives the manifest.

    ``payload`` is text, written as UTF-8; null is empty. Of rows with equal payloads of at least
    ``least_bytes``, those with the smallest key are responses and the others revisit it; null keys
    come last; all rows that repeat the smallest key are responses. Only digests and keys are grouped. Rows join the smallest key of
    digests that occur twice by an equi-join, which adaptive execution splits where one payload fills a third of the rows.
    An empty table gives no archives. Other columns do not count.
    """
    body = F.encode(F.coalesce(F.col(f"`{payload}`"), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").alias("url"), body.alias("body"), F.sha1(body).alias("sha1")
    )
    firsts = rows.groupBy("sha1").agg(F.min("key").alias("first"), F.count("*").alias("copies")).where("copies > 1")
    firsts = staged(firsts, "repeated")  # written, so Spark sees their size, and moves no body where it can broadcast them
    long_enough = F.octet_length("body") >= least_bytes
    revisits = long_enough & F.col("copies").isNotNull() & ~F.col("key").eqNullSafe(F.col("first"))
    ready = rows.join(firsts, "sha1", "left").select(
        F.col("key").cast("string").alias("key"),
        "url",
        "body",
        F.when(revisits, F.coalesce(F.col("first").cast("string"), F.lit("null"))).alias("refers_to"),
    )

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        rows = (row for batch in batches for row in batch.itertuples(index=False))
        waiting: list = []
        more = True
        while more or waiting:
            size = sum(len(row.body) for row in waiting)
            while more and size < SAMPLE_BYTES:
                row = next(rows, None)
                more = row is not None
                if more:
                    waiting.append(row)
                    size += len(row.body)
            if not waiting:
                break
            name = f"pages-{uuid.uuid4().hex}.warc.zst"
            with system.open_output_stream(f"{root}/{name}", compression=None) as out:
                writer = ArchiveWriter(out, [bytes(row.body) for row in waiting])
                while waiting and writer.size < ARCHIVE_BYTES:
                    for row in waiting:
                        refers_to = None if pd.isna(row.refers_to) else row.refers_to
                        page = "null" if pd.isna(row.key) else row.key
                        writer.add(page_record(page, row.url, bytes(row.body), refers_to))
                    row = next(rows, None) if writer.size < ARCHIVE_BYTES else None
                    more = more and (row is not None or writer.size >= ARCHIVE_BYTES)
                    waiting = [] if row is None else [row]
            yield pd.DataFrame({"name": [name], "records": [writer.records], "bytes": [writer.size]})

    return staged(ready.mapInPandas(write, "name string, records long, bytes long"), "manifest")


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """(page, payload_bytes, payload_digest, record_type, refers_to, payload) of all records of the listed files."""
    spark = manifest.sparkSession
    if manifest.isEmpty():
        return spark.createDataFrame([], PAGE_SCHEMA)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    listed = named.join(manifest.select("name", "records"), "name")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                found, size, records = [], 0, 0
                try:
                    for record in read_archive(row.content):
                        found.append(read_page(record))
                        size += len(record.block)
                        records += 1
                        if size > SAMPLE_BYTES:
                            yield pd.DataFrame(found)
                            found, size = [], 0
                    if records != row.records:
                        raise ArchiveError(f"{records} records instead of {row.records}")
                except ArchiveError as error:
                    raise ArchiveError(f"{row.name}: {error}") from error
                if found:
                    yield pd.DataFrame(found)

    return listed.mapInPandas(read, PAGE_SCHEMA)


PAGE_SCHEMA = (
    "page string, payload_bytes long, payload_digest string, record_type string, refers_to string, payload binary"
)


def archive_and_read(pages: DataFrame, key: str, url: str, payload: str, least_bytes: int = 0) -> DataFrame:
    """Write the pages to fresh archives in the shared folder and read all of them back."""
    folder = fresh_path(pages.sparkSession, "archives")
    return read_archives(write_archives(pages, key, url, payload, folder, least_bytes), folder)
