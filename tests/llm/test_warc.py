import base64
import gzip
import hashlib
import os

import pytest

from meetmart.llm import warc
from meetmart.sources.scratch import shared_dir

SCHEMA = "page_id bigint, url string, html string"
PAGES = [
    (1, "http://a/", "<p>same</p>"), (2, "http://b/", "<p>same</p>"), (7, None, "<p>same</p>"),
    (3, "http://c/\r\nWARC-Type: x", "héllo\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"), (4, "u", None), (5, "u", ""),
    (6, "u", "x" * 300_000), (8, "u", "\r\n\r\n"), (9, "u", " lead and trail \n"), (9, "u", " lead and trail \n"),
    (None, "u", "<p>same</p>"), (None, "u", "only without id"), (10, "u", "\u0000\x85  "),
]


def brute(pages, least=0):
    largest = {}
    for i, _, html in pages:
        raw = (html or "").encode()
        largest[raw] = max(largest.get(raw, -1), -1 if i is None else i)
    out, seen = [], set()
    for i, _, html in pages:
        raw = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        first = len(raw) < least or ((-1 if i is None else i) == largest[raw] and raw not in seen)
        if first and len(raw) >= least:
            seen.add(raw)
        top = None if largest[raw] < 0 else largest[raw]
        out.append((i, len(raw), digest, "response" if first else "revisit", None if first else top))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, 5])
def test_digest_agrees_with_brute_force(spark, least):
    pages = spark.createDataFrame([(*p, "x", "y") for p in PAGES], f"{SCHEMA}, record_type string, payload string")
    got = warc.archive_digest(pages, least).collect()
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[c] for c in columns) for r in got), key=repr) == brute(PAGES, least)


def test_archive_is_plain_warc(spark):
    """A reader that only knows Content-Length finds the same records, and revisits without payload."""
    raw, out = shared_dir(spark, "w"), shared_dir(spark, "w2")
    mark = warc.write_archive(warc.page_records(spark.createDataFrame(PAGES, SCHEMA)), raw)
    warc.deduplicate_archive(spark, raw, mark, out)
    kinds, payloads, ids, refers = [], [], set(), set()
    for name in os.listdir(out):
        if not name.endswith(".gz"):
            continue
        data = gzip.open(os.path.join(out, name)).read()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            lines = head.split(b"\r\n")
            assert lines[0] == b"WARC/1.1"
            fields = dict(x.split(b": ", 1) for x in lines[1:])
            size = int(fields[b"Content-Length"])
            block, data = rest[:size], rest[size:]
            assert data[:4] == b"\r\n\r\n"
            data = data[4:]
            kinds.append(fields[b"WARC-Type"])
            ids.add(fields[b"WARC-Record-ID"])
            if fields[b"WARC-Type"] == b"revisit":
                refers.add(fields[b"WARC-Refers-To"])
                assert block.endswith(b"\r\n\r\n") and block.count(b"\r\n\r\n") == 1
            else:
                payload = block.partition(b"\r\n\r\n")[2]
                payloads.append(payload)
                digest = base64.b32encode(hashlib.sha1(payload).digest())
                assert fields[b"WARC-Payload-Digest"] == b"sha1:" + digest
    assert len(kinds) == len(PAGES) and refers <= ids
    assert sorted(payloads) == sorted({(h or "").encode() for _, _, h in PAGES})


def test_a_wrong_length_is_an_error(spark):
    path = shared_dir(spark, "broken")
    text = "WARC/1.1\r\nWARC-Archive-Mark: m\r\nWARC-Type: response\r\nContent-Length: 9\r\n\r\nhttp\r\n\r\nbody"
    spark.createDataFrame([(text,)], "value string").write.option("lineSep", "\r\n\r\n").text(path)
    with pytest.raises(Exception, match="length"):
        warc.read_archive(spark, path, "m").collect()


def test_empty_table(spark):
    assert warc.archive_digest(spark.createDataFrame([], SCHEMA)).collect() == []
