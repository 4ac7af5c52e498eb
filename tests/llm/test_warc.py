"""Archives: exact round trips, and files that must be refused."""

import base64
import hashlib
import io
import struct

import pytest
import zstandard
from hypothesis import given, settings, strategies as st

from casewise.llm import warc
from casewise.llm.warc import ArchiveError, ArchiveWriter, Record, archive_and_read, page_record, parse_record, read_archive, read_page, record_bytes


def archive(payloads):
    out = io.BytesIO()
    writer = ArchiveWriter(out, payloads)
    for i, payload in enumerate(payloads):
        writer.add(page_record(str(i), f"http://x/{i}\r\né", payload, None))
    return out.getvalue()


@settings(max_examples=40, deadline=None)
@given(st.lists(st.binary(max_size=300), max_size=12))
def test_round_trip(payloads):
    found = [read_page(r) for r in read_archive(archive(payloads))]
    assert [f["payload"] for f in found] == payloads
    assert [f["payload_digest"] for f in found] == [base64.b32encode(hashlib.sha1(p).digest()).decode() for p in payloads]


def test_one_frame_per_record_and_large_records():
    data = archive([b"x" * 3_000_000, b"\r\n\r\n" * 50, b""])
    assert len(list(read_archive(data))) == 3
    assert data[:4] == struct.pack("<I", warc.SKIPPABLE)


def test_plain_and_trained_dictionaries():
    pages = [f"<html><p>page {i} has some shared words and number {i * i}</p></html>".encode() * 5 for i in range(300)]
    data = archive(pages)
    assert [read_page(r)["payload"] for r in read_archive(data)] == pages
    size = struct.unpack_from("<I", data, 4)[0]
    plain = zstandard.ZstdDecompressor().decompress(data[8 : 8 + size])
    unpacked = data[:4] + struct.pack("<I", len(plain)) + plain + data[8 + size :]
    assert len(list(read_archive(unpacked))) == 300


@pytest.mark.parametrize("cut", [1, 9, 40])
def test_broken_archives_are_refused(cut):
    data = archive([b"hello" * 50, b"world" * 50])
    for bad in (data[:-cut], data[cut:], b"", data[:4] + b"\xff\xff\xff\x7f" + data[8:]):
        with pytest.raises(ArchiveError):
            list(read_archive(bad))


def test_broken_records_are_refused():
    good = page_record("1", None, b"body", None)
    whole = record_bytes(good)
    assert parse_record(whole) == good
    for bad in (whole[:-1], whole + b"x", whole.replace(b"WARC/1.1", b"WARC/0.9"), whole.replace(b"body", b"b0dy"), whole.replace(b"WARC-Type", b"WARC-Tipe")):
        with pytest.raises(ArchiveError):
            parse_record(bad)
    wrong = Record(good.fields | {"WARC-Payload-Digest": "sha1:" + "A" * 32}, good.block)
    with pytest.raises(ArchiveError):
        read_page(wrong)


def test_pages_and_revisits(spark):
    rows = [(5, "u", "same"), (3, "u", "same"), (9, None, "same"), (4, "u", None), (6, "u", ""), (None, "u", "same"), (7, "u", "é" * 100_000)]
    rows += [(i, "u", "hot") for i in range(100, 200)] + [(100, "u", "hot")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    found = sorted(((r.page, r.record_type, r.refers_to, r.payload_bytes) for r in archive_and_read(df, "page_id", "url", "html").collect()), key=str)
    want = [("5", "revisit", "3", 4), ("3", "response", None, 4), ("9", "revisit", "3", 4), ("4", "response", None, 0), ("6", "revisit", "4", 0)]
    want += [("null", "revisit", "3", 4), ("7", "response", None, 200_000), ("100", "response", None, 3), ("100", "response", None, 3)]
    want += [(str(i), "revisit", "100", 3) for i in range(101, 200)]
    assert found == sorted(want, key=str)


def test_small_payloads_and_empty_table(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    kinds = {r.page: r.record_type for r in archive_and_read(df, "page_id", "url", "html", least_bytes=3).collect()}
    assert kinds == {"1": "response", "2": "response", "3": "response", "4": "revisit"}
    assert archive_and_read(df.limit(0), "page_id", "url", "html").collect() == []
