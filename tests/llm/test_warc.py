"""Archives: an exact round trip, revisits, and damage that must not pass."""

import struct

import duckdb
import pytest
import zstandard

from salesmart.llm import queries, warc
from salesmart.llm.common import Scratch


@pytest.fixture(scope="module")
def pages(sf_dir):
    return duckdb.sql(f"select page_id, url, html from '{sf_dir}/pages.parquet' order by 1").fetchall()


def test_registered_query(spark, sf_dir, pages):
    got = {r["page_id"]: r for r in queries.QUERIES["op10_warc"](spark, sf_dir).collect()}
    kept = {}
    for page_id, _, html in pages:
        kept[html] = max(page_id, kept.get(html, page_id))
    assert len(got) == len(pages)
    for page_id, _, html in pages:
        row, first = got[page_id], kept[html] == page_id
        assert row["payload_bytes"] == len(html.encode()) and row["payload_digest"] == warc.base32_sha1(html.encode())
        assert (row["record_type"], row["refers_to"]) == (("response", None) if first else ("revisit", kept[html]))


def test_payloads_come_back_whole(spark, pages):
    rows = [*pages, (10**6, "u", pages[0][2]), (10**6 + 1, None, None), (10**6 + 2, "a b\n", ""), (None, "u", pages[0][2])]
    frame = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, digest int").repartition(3)
    scratch = Scratch(spark, "warc-test")
    folder = scratch.path("files")
    listed = warc.write_archives(frame.select("page_id", "url", "html"), folder, scratch)
    read = warc.read_archives(spark, folder, listed).collect()
    assert len(read) == len(rows)
    by_id = {r["page_id"]: r for r in read}
    for page_id, _, html in pages[1:]:
        assert bytes(by_id[page_id]["payload"]).decode() == html
    assert (by_id[pages[0][0]]["record_type"], by_id[pages[0][0]]["refers_to"]) == ("revisit", 10**6)
    assert (by_id[None]["record_type"], by_id[None]["refers_to"]) == ("revisit", 10**6)
    assert by_id[10**6 + 2]["record_type"] == "response" and by_id[10**6 + 2]["url"] == "a%20b%0A"
    assert by_id[10**6 + 1]["refers_to"] == 10**6 + 2
    assert warc.round_trip(frame.limit(0)).count() == 0


def archive(records, words=b""):
    coder = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(words)) if words else zstandard.ZstdCompressor()
    lead = struct.pack("<II", warc.SKIPPABLE_MAGIC, len(words)) + words if words else b""
    return lead + b"".join(coder.compress(r) for r in records)


@pytest.fixture(scope="module")
def records(pages):
    return [warc.page_record(*p[:2], p[2].encode(), None) for p in pages]


def test_frames_with_plain_and_compressed_dictionaries(records):
    words = zstandard.train_dictionary(8192, records).as_bytes()
    data = archive(records, words)
    assert list(warc.frames(data)) == records
    packed = zstandard.compress(words)
    swapped = struct.pack("<II", warc.SKIPPABLE_MAGIC, len(packed)) + packed + data[8 + len(words):]
    assert list(warc.frames(swapped)) == records
    assert list(warc.frames(archive(records))) == records
    assert len(data) < len(archive(records))


def test_damage_raises(records):
    data = archive(records[:2])
    with pytest.raises(ValueError):
        list(warc.frames(data[:-5]))
    good = records[0]
    for bad in (good[:-1], good.replace(b"WARC/1.1", b"WARK/1.1"), good.replace(b"WARC-Date", b"WARC-Dote"),
                good.replace(b"Content-Length: ", b"Content-Length: 1", 1), good.replace(b"<html", b"<hTml", 1)):
        with pytest.raises(ValueError):
            warc.parse_page(*warc.parse_record(bad))
    fields, block = warc.parse_record(good)
    with pytest.raises(ValueError):
        warc.parse_page(fields, block + b"x")
