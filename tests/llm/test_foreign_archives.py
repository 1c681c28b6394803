"""Archives of other writers: chunked answers, other digests, missing lengths, and records that are wrong."""

import base64
import hashlib

import pytest
import zstandard

from salesmart.llm import warc
from salesmart.llm.common import Scratch

BODY = b"<html>caf\xc3\xa9</html>"
CHUNKED = b"5\r\n<html\r\n0b;x=y\r\n>caf\xc3\xa9</htm\r\n2\r\nl>\r\n0\r\nTrailer: x\r\n\r\n"
ANSWER = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n"
PLAIN = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"


def base32(name, data):
    return f"{name}:{base64.b32encode(hashlib.new(name, data).digest()).decode()}"


def record(block, kind="response", **more):
    fields = [("WARC-Type", kind), ("WARC-Record-ID", "<urn:uuid:1>"), ("WARC-Date", "2026-01-01T00:00:00Z"),
              *((k.replace("_", "-"), v) for k, v in more.items()), ("Content-Length", str(len(block)))]
    return warc._record(fields, block)


def page(data):
    return warc.parse_page(*warc.parse_record(data))


@pytest.mark.parametrize("digest", [
    base32("sha1", BODY), base32("sha1", CHUNKED), base32("sha256", BODY), base32("sha512", BODY).lower().replace("=", ""),
    f"sha256:{hashlib.sha256(BODY).hexdigest()}", f"SHA-1:{hashlib.sha1(BODY).hexdigest().upper()}", "blake9:xyz"])
def test_chunked_answers_and_digests(digest):
    got = page(record(ANSWER + CHUNKED, WARC_Payload_Digest=digest))
    assert (got["payload"], got["payload_bytes"], got["payload_digest"]) == (BODY, len(BODY), warc.base32_sha1(BODY))
    assert page(record(PLAIN + BODY, WARC_Payload_Digest=digest.replace(base32("sha1", CHUNKED), base32("sha1", BODY))))["payload"] == BODY


def test_no_digest_no_length_no_http():
    assert page(record(PLAIN + BODY))["payload"] == BODY
    assert page(record(b"dns 1.2.3.4", Content_Type="text/dns"))["payload"] == b"dns 1.2.3.4"


def test_revisits_of_other_writers():
    got = page(record(b"HTTP/1.1 304 Not Modified\r\n\r\n", "revisit", WARC_Payload_Digest=f"sha1:{hashlib.sha1(BODY).hexdigest()}"))
    assert (got["payload_bytes"], got["payload_digest"]) == (None, warc.base32_sha1(BODY))
    got = page(record(b"", "revisit", WARC_Payload_Digest=base32("sha256", BODY), Content_Type="text/plain"))
    assert got["payload_digest"] == base32("sha256", BODY)


@pytest.mark.parametrize("bad", [
    record(PLAIN + BODY, WARC_Payload_Digest=base32("sha256", b"other")), record(PLAIN + BODY, WARC_Payload_Digest="sha1:short"),
    record(PLAIN + BODY, WARC_Block_Digest=f"md5:{'0' * 32}"), record(ANSWER + CHUNKED[:-30]), record(ANSWER + b"zz\r\n"),
    record(b"HTTP/1.1 200 OK\r\nContent-Length: 7\r\n\r\n" + BODY), record(b"no end of the header")])
def test_wrong_records_raise(bad):
    with pytest.raises(ValueError):
        page(bad)


def test_faults_become_rows(spark):
    folder = Scratch(spark, "warc-test").path("files")
    good, bad = record(PLAIN + BODY, WARC_Page_ID="7"), record(PLAIN + BODY, WARC_Block_Digest=f"md5:{'0' * 32}")
    store, root = warc.fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    packed = [zstandard.compress(r) for r in (good, bad, good, good)]
    for name, data in (("a", b"".join(packed)), ("b", b"".join(packed)[:-9]), ("c", b"not an archive")):
        with store.open_output_stream(f"{root}/{name}.warc.zst", compression=None) as out:
            out.write(data)
    rows = sorted(warc.read_archives(spark, folder, strict=False).collect(), key=lambda r: (r["archive"], r["record"] or -1))
    assert [(r["archive"][0], r["record"]) for r in rows if r["error"]] == [("a", 1), ("b", 1), ("b", 3), ("c", 0)]
    assert [(r["archive"][0], bytes(r["payload"])) for r in rows if not r["error"]] == [("a", BODY)] * 3 + [("b", BODY)] * 2
    with pytest.raises(Exception, match="a.warc.zst, record 1|record"):
        warc.read_archives(spark, folder).collect()
