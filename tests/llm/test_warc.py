import gzip
import hashlib

import pytest

from palimpsest.llm.warc import archive_records, read_archives, write_archives
from palimpsest.session import scratch_path
from tests.llm.helpers import with_clashes

PAGES = "page_id long, url string, html string"
LONG = "<p>é some payload</p>" * 100

ROWS = [
    (1, "http://a.org/", LONG),
    (2, "http://b.org/\r\nx é", LONG),
    (3, None, LONG),
    (4, "http://c.org/", "short"),
    (5, "http://d.org/", "short"),
    (6, "http://e.org/", None),
    (7, "http://f.org/", ""),
    (None, "http://g.org/", LONG),
    (9, "http://h.org/", "WARC/1.1\r\nContent-Length: 9\r\n\r\n" * 5000),
    (10, "http://i.org/", "y" * 999),
    (11, "http://j.org/", "y" * 999),
    (12, "http://k.org/", "z" * 1000),
    (13, "http://l.org/", "z" * 1000),
]


def brute(rows):
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        same = [j for j, _, h in rows if (h or "").encode() == data and j is not None]
        of = max(same) if same and len(data) >= 1000 and max(same) != i else None
        out.append((None if i is None else str(i), len(data), hashlib.sha1(data).hexdigest(), "revisit" if of else "response", of and str(of)))
    return sorted(out, key=repr)


def round_trip(spark, pages, **options):
    folder = scratch_path(spark, "archives")
    manifest = write_archives(pages, folder, **options)
    return manifest, folder


@pytest.mark.parametrize("chunk, file_bytes", [(1 << 20, 1 << 30), (7, 200), (1000, 1 << 30)])
def test_round_trip(spark, chunk, file_bytes):
    pages = spark.createDataFrame(ROWS, PAGES)
    manifest, folder = round_trip(spark, pages, chunk=chunk, file_bytes=file_bytes)
    assert sorted((tuple(r) for r in archive_records(manifest, folder, chunk=max(chunk, 64)).collect()), key=repr) == brute(ROWS)
    assert manifest.agg({"records": "sum"}).first()[0] == len(ROWS)


def test_chunks_carry_the_payload_and_its_running_digest(spark):
    manifest, folder = round_trip(spark, spark.createDataFrame(ROWS, PAGES), chunk=100)
    payloads = {}
    for r in sorted(read_archives(manifest, folder, chunk=128).collect(), key=lambda r: (r.record_id, r.chunk_no)):
        if r.record_type == "response":
            sofar = payloads.get(r.page_id, b"") + bytes(r.data)
            payloads[r.page_id] = sofar
            assert len(r.data) <= 128
            assert (r.payload_bytes, r.payload_digest) == (len(sofar), hashlib.sha1(sofar).hexdigest())
    texts = {None if i is None else str(i): (h or "").encode() for i, _, h in ROWS}
    assert payloads == {i: texts[i] for i in payloads} and len(payloads) == 9


def test_files_are_gzip_members_with_standard_headers(spark):
    manifest, _ = round_trip(spark, spark.createDataFrame(ROWS[:3], PAGES))
    data = b"".join(gzip.open(r.path).read() for r in manifest.collect())
    assert data.count(b"WARC-Type: revisit") == 2 and data.count(b"WARC-Type: response") == 1
    assert b"WARC-Target-URI: http://b.org/%0D%0Ax%20%C3%A9\r\n" in data
    assert data.count(b"WARC-Refers-To: <urn:uuid:") == 2


def test_edges(spark):
    manifest, folder = round_trip(spark, spark.createDataFrame([], PAGES))
    assert archive_records(manifest, folder).count() == 0
    repeated = with_clashes(spark.createDataFrame([(1, "u", LONG)] * 3 + [(0, "v", LONG)] + [(None, None, "q" * 2000)] * 2, PAGES))
    manifest, folder = round_trip(spark, repeated)
    rows = sorted(((r.page_id, r.record_type, r.refers_to) for r in archive_records(manifest, folder).collect()), key=repr)
    assert rows == sorted([("1", "response", None)] * 3 + [("0", "revisit", "1")] + [(None, "response", None)] * 2, key=repr)


def test_a_broken_payload_is_reported(spark):
    manifest, folder = round_trip(spark, spark.createDataFrame(ROWS[:1], PAGES))
    path = manifest.first().path
    data = gzip.open(path).read().replace(b"some payload", b"sane payload", 1)
    with gzip.open(path, "wb") as out:
        out.write(data)
    with pytest.raises(Exception, match="does not have the payload"):
        read_archives(manifest, folder).collect()
