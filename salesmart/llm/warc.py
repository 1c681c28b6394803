"""WARC archives in Zstandard: a dictionary in the leading skippable frame, then one frame for each record."""

from __future__ import annotations

import base64
import binascii
import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from salesmart.llm.common import Scratch, arrow_rows, arrow_schema

# Magic numbers of the format.
SKIPPABLE_MAGIC, FRAME_MAGIC = 0x184D2A5D, 0xFD2FB528
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# An archive is closed once it has so many bytes; the dictionary is trained on so many pages, at most so long each.
ARCHIVE_BYTES = 8 << 20
DICTIONARY_BYTES, DICTIONARY_PAGES, DICTIONARY_PAGE_CHARS = 64 << 10, 512, 16_384
CHUNK = 32 << 10
# Pages read from archives are handed on once they have so many bytes or are so many.
READ_BYTES, READ_PAGES = 4 << 20, 256
DIGESTS = ("md5", "sha1", "sha256", "sha512")
CRAWL_DATE = "2026-01-01T00:00:00Z"
PAGE_SCHEMA = ("page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
               "record_type string, refers_to long, archive string")
FAULT_SCHEMA = "record int, error string"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = b"".join(f"{name}: {value}\r\n".encode() for name, value in fields)
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response record, or a revisit of the page ``refers_to`` without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    digest = base32_sha1(payload)
    revisit = refers_to is not None
    block = http if revisit else http + payload
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "urn:page:unknown"
    fields = [("WARC-Type", "revisit" if revisit else "response"),
              ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {target} {digest}')}>"),
              ("WARC-Date", CRAWL_DATE), ("WARC-Target-URI", target)]
    if page_id is not None:
        fields.append(("WARC-Page-ID", str(page_id)))
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
               ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return _record(fields, block)


def info_record() -> bytes:
    block = b"format: WARC File Format 1.1\r\n"
    return _record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                    ("WARC-Date", CRAWL_DATE), ("Content-Type", "application/warc-fields"),
                    ("Content-Length", str(len(block)))], block)


def digest_bytes(said: str) -> tuple[str, bytes | None]:
    """Algorithm and value of a digest field, written in base32 or hexadecimal; None where it can't be told."""
    name, _, value = said.partition(":")
    name = name.strip().lower().replace("-", "")
    if name not in DIGESTS:
        return name, None
    value, size = value.strip(), hashlib.new(name).digest_size
    try:
        if len(value) == 2 * size:
            return name, binascii.unhexlify(value)
        value = value.rstrip("=").upper()
        found = base64.b32decode(value + "=" * (-len(value) % 8))
    except (binascii.Error, ValueError):
        return name, b""
    return name, found if len(found) == size else b""


def agrees(said: str | None, *contents: bytes) -> bool:
    """True when the digest is that of one of ``contents``, is missing, or is of an unknown algorithm."""
    name, value = digest_bytes(said or "")
    return value is None or any(hashlib.new(name, data).digest() == value for data in contents)


def unchunked(body: bytes) -> bytes:
    """The content of a body in chunks; raises ValueError where a chunk is not well formed or cut off."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = re.fullmatch(rb"([0-9A-Fa-f]{1,15})[\x20\t]*(?:;.*)?", body[at:end]) if end >= 0 else None
        if not size:
            raise ValueError("a chunk has no size")
        many, at = int(size[1], 16), end + 2
        if not many:  # trailers may follow
            return b"".join(out)
        if body[at + many:at + many + 2] != b"\r\n":
            raise ValueError("a chunk is cut off")
        out.append(body[at:at + many])
        at += many + 2


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of one record; raises ValueError where it is not well formed."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not found or not lines[0].startswith("WARC/1."):
        raise ValueError("no WARC version line or end of headers")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise ValueError(f"bad header line {line!r}")
        fields[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise ValueError(f"no {name}")
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"Content-Length is {length}, the block has {len(rest) - 4} bytes")
    block = rest[:length]
    if not agrees(fields.get("warc-block-digest"), block):
        raise ValueError("block digest does not match")
    return fields, block


def parse_page(fields: dict[str, str], block: bytes) -> dict:
    """A page's columns from its record, with the payload's length and digest checked where they are there.

    The payload is what follows the HTTP header: as long as its Content-Length
    says, or in chunks, which are put together (the digest may be of either
    form), or else to the end. The whole block is the payload where it is not
    HTTP. A revisit's length is null where its header has none; its digest is
    written in base32 if it is a SHA-1, else as it stands.
    """
    kind, said = fields["warc-type"], fields.get("warc-payload-digest")
    http, found, payload = b"", True, block
    if fields.get("content-type", "application/http").lower().startswith("application/http"):
        http, found, payload = block.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("the HTTP header has no end")
    length = re.search(rb"(?mi)^content-length:[\x20\t]*(\d+)[\x20\t]*\r?$", http)
    size = int(length[1]) if length else None
    if kind == "response":
        sent = payload
        if re.search(rb"(?mi)^transfer-encoding:[^\r\n]*\bchunked\b", http):
            payload, size = unchunked(sent), None
        if size not in (None, len(payload)) or not agrees(said, payload, sent):
            raise ValueError("payload does not match its length and digest")
        size, digest = len(payload), base32_sha1(payload)
    else:
        if http and payload:
            raise ValueError("a revisit has a payload")
        name, value = digest_bytes(said or "")
        digest = base64.b32encode(value).decode() if name == "sha1" and value else said
    refers = re.search(r"<urn:page:(-?\d+)>", fields.get("warc-refers-to", ""))
    return {"page_id": int(fields["warc-page-id"]) if "warc-page-id" in fields else None,
            "url": fields.get("warc-target-uri"), "payload": payload if kind == "response" else None,
            "payload_bytes": size, "payload_digest": digest, "record_type": kind,
            "refers_to": int(refers[1]) if refers else None}


def frames(data: bytes | BinaryIO) -> Iterator[bytes]:
    """The content of each frame of an archive, read and decoded one at a time with the dictionary at its start."""
    source, words = io.BytesIO(data) if isinstance(data, bytes) else data, None
    rest = source.read(8)
    if len(rest) == 8 and struct.unpack_from("<I", rest)[0] == SKIPPABLE_MAGIC:
        size = struct.unpack_from("<I", rest, 4)[0]
        raw, rest = source.read(size), b""
        if len(raw) < size:
            raise ValueError("the dictionary is cut off")
        if raw[:4] == struct.pack("<I", FRAME_MAGIC):  # the dictionary may itself be compressed
            raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
        words = zstandard.ZstdCompressionDict(raw) if raw else None
    decoder = zstandard.ZstdDecompressor(dict_data=words) if words else zstandard.ZstdDecompressor()
    while rest := rest or source.read(CHUNK):
        frame, parts = decoder.decompressobj(), []
        while not frame.eof:
            rest = rest or source.read(CHUNK)
            if not rest:
                raise ValueError("the last frame is cut off")
            parts.append(frame.decompress(rest))
            rest = frame.unused_data if frame.eof else b""
        if content := b"".join(parts):  # other skippable frames have none
            yield content


def pages_of(source: bytes | BinaryIO, archive: str, strict: bool = True) -> Iterator[dict]:
    """The page records of an archive; a fault raises, or unless ``strict`` is a row with its record and error.

    A wrong record costs itself only, a damaged frame all that follows in its archive.
    """
    records, number = frames(source), -1
    while True:
        number += 1
        readable = False
        try:
            data = next(records, None)
            if data is None:
                return
            readable = True
            fields, block = parse_record(data)
            if fields["warc-type"] in ("response", "revisit"):
                yield parse_page(fields, block) | {"archive": archive}
        except (ValueError, KeyError, zstandard.ZstdError) as error:
            if strict:
                raise ValueError(f"{archive}, record {number}: {error}") from error
            yield {"archive": archive, "record": number, "error": str(error)}
            if not readable:
                return


def train_dictionary(pages: DataFrame) -> bytes:
    """A dictionary from about ``DICTIONARY_PAGES`` pages chosen by a hash of page_id; empty where they are too few."""
    share = DICTIONARY_PAGES / max(1, pages.count())
    chosen = pages.where(F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    rows = chosen.select("page_id", "url", F.substring("html", 1, DICTIONARY_PAGE_CHARS)).collect()
    samples = [page_record(*r[:2], (r[2] or "").encode(), None) for r in sorted(rows, key=str)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too little to learn from
        return b""


def with_records(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """page_id, url, html and refers_to: of equal payloads the largest page_id is kept, the others refer to it.

    Only payloads that occur more than once meet the pages in a join; digests
    travel, not pages, to find them. Rows that repeat the largest page_id are
    all kept; so are equal payloads that all lack a page_id.
    """
    digest = F.unhex(F.sha1(F.coalesce(F.col("html"), F.lit("")).cast("binary")))
    groups = pages.select("page_id", digest.alias("digest")).groupBy("digest").agg(
        F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("many"))
    shared = scratch.keep(groups.where("many > 1").select("digest", "kept"), "shared-payloads")
    joined = pages.select("page_id", "url", "html", digest.alias("_digest")).join(
        shared, F.col("_digest") == F.col("digest"), "left")
    return joined.select("page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("kept")), F.col("kept"))
                         .alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, scratch: Scratch) -> DataFrame:
    """Write ``pages`` as archives below ``folder``; returns the list of them: archive, records, bytes.

    Each task writes files under names of its own and lists them once closed.
    A task that is lost or runs twice leaves files that no list names.
    """
    words = train_dictionary(pages)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        coder = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(words)) if words else zstandard.ZstdCompressor()
        lead = struct.pack("<II", SKIPPABLE_MAGIC, len(words)) + words if words else b""
        out, name, records, size = None, "", 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"archive": [name], "records": [records], "bytes": [size]})

        for batch in batches:
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    name, records, size = f"{uuid.uuid4().hex}.warc.zst", 0, len(lead)
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                    out.write(lead)
                    size += out.write(coder.compress(info_record()))
                size += out.write(coder.compress(page_record(page_id, url, (html or "").encode(), refers_to)))
                records += 1
                if size >= ARCHIVE_BYTES:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    rows = with_records(pages, scratch)
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    with arrow_rows(pages.sparkSession, 256):
        return scratch.keep(rows.mapInArrow(write, "archive string, records long, bytes long"), "archives")


def read_archives(spark: SparkSession, folder: str, listed: DataFrame | None = None, payload: bool = True,
                  strict: bool = True) -> DataFrame:
    """A row for each page record of the archives below ``folder`` (only those ``listed``, if given).

    Columns as in ``PAGE_SCHEMA``, without the payload unless asked for.
    Raises where a frame is cut off or a header, length or digest is wrong;
    with ``strict=False`` such records are rows too, with their number in the
    archive and the error in two more columns. Archives are read from a stream,
    a record at a time, so their size doesn't matter.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("archive"))
    if listed is not None:
        files = files.join(listed.select("archive"), "archive", "left_semi")
    schema = PAGE_SCHEMA if payload else PAGE_SCHEMA.replace(" payload binary,", "")
    schema = schema if strict else f"{schema}, {FAULT_SCHEMA}"
    arrow = arrow_schema(schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        rows, size = [], 0
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                with store.open_input_stream(f"{root}/{archive}", compression=None) as source:
                    for page in pages_of(source, archive, strict):
                        rows.append(page if payload else page | {"payload": None})
                        size += len(rows[-1].get("payload") or b"")
                        if size >= READ_BYTES or len(rows) >= READ_PAGES:
                            yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                            rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return files.mapInArrow(read, schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """``pages`` written to archives in the shared folder and read back.

    One row per page. A null html is an empty payload, a null url becomes a
    placeholder, a null page_id stays null, and an empty table gives none.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc")
    folder = scratch.path("files")
    listed = write_archives(pages.select("page_id", "url", "html"), folder, scratch)
    if listed.isEmpty():
        return spark.createDataFrame([], PAGE_SCHEMA).drop("payload")
    return read_archives(spark, folder, listed, payload=False)
