"""WARC archives written from, and read back as, a table of record chunks.

A payload travels as rows of (record, chunk number, bytes) of at most ``CHUNK`` bytes; neither writer nor reader
holds a whole record. Both carry the record's SHA-1 from chunk to chunk: the writer checks it against the digest in
the header, the reader reports it. A task writes files of its own name and returns them; only files of tasks that
ended well are in the manifest, so what a lost executor left behind is never read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from datetime import datetime, timezone
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from palimpsest.llm.common import query, table
from palimpsest.session import scratch_path, stored

CHUNK = 1 << 20
FILE_BYTES = 1 << 30
REVISIT_BYTES = 1000
BATCH_BYTES = 16 << 20

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMES = uuid.uuid5(uuid.NAMESPACE_URL, "page-archive")
GAP = b"\r\n\r\n"

CHUNKS = (
    "record_id string, record_type string, page_id string, url string, refers_to string, chunk_no int, data binary, "
    "last boolean, payload_bytes long, payload_digest string"
)


def record_chunks(pages: DataFrame, id_col: str, url_col: str, html_col: str, chunk: int, least: int) -> DataFrame:
    """Chunk rows of every page, with the page whose payload a revisit refers to; a record's rows are adjacent."""
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).select("*", F.octet_length("payload").cast("long").alias("size"), F.sha1("payload").alias("digest"))
    shared = (
        rows.where(F.col("size") >= least)
        .groupBy("digest")
        .agg(F.max("page_id").alias("response_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and response_id is not null")
        .select("digest", "response_id")
    )
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("response_id")), F.col("response_id"))
    parts = F.when(refers.isNotNull() | (F.col("size") == 0), F.array(F.lit(b""))).otherwise(
        F.transform(
            F.sequence(F.lit(0), ((F.col("size") - 1) / chunk).cast("int")),
            lambda i: F.substring("payload", i * chunk + 1, F.lit(chunk)),
        )
    )
    return rows.join(shared, "digest", "left").select(
        F.col("page_id").cast("string"),
        "url",
        "size",
        "digest",
        refers.cast("string").alias("refers_to"),
        F.posexplode(parts).alias("chunk_no", "data"),
    )


def record_name(page_id: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMES, f'{page_id}/{digest}')}>"


def header(fields) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields if v is not None)]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + GAP


class ArchiveWriter:
    """Files of one task, each record a gzip member of its own."""

    def __init__(self, folder: str, date: str, file_bytes: int):
        self.fs, self.folder = arrow_fs.FileSystem.from_uri(folder)
        self.fs.create_dir(self.folder, recursive=True)
        context = TaskContext.get()
        self.name = f"{context.partitionId():06d}-{context.taskAttemptId()}"
        self.date, self.file_bytes = date, file_bytes
        self.files, self.out, self.packer = [], None, None
        self.records = 0

    def begin(self, fields) -> None:
        if self.out is not None and self.out.tell() >= self.file_bytes:
            self.close_file()
        if self.out is None:
            self.path = f"{self.folder}/{self.name}-{len(self.files):04d}.warc.gz"
            self.out = self.fs.open_output_stream(self.path, compression=None)
            about = b"software: palimpsest\r\nformat: WARC File Format 1.1\r\n"
            self.begin(
                [
                    ("WARC-Type", "warcinfo"),
                    ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                    ("WARC-Date", self.date),
                    ("Content-Type", "application/warc-fields"),
                    ("Content-Length", len(about)),
                ]
            )
            self.write(about)
            self.end()
            self.records = 0
        self.packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        self.write(header(fields))

    def write(self, data: bytes) -> None:
        self.out.write(self.packer.compress(data))

    def end(self) -> None:
        self.write(GAP)
        self.out.write(self.packer.flush())
        self.records += 1

    def close_file(self) -> None:
        if self.out is not None:
            size = self.out.tell()
            self.out.close()
            self.files.append((self.path, self.records, size))
            self.out = None


def write_task(batches, folder: str, date: str, file_bytes: int):
    archive, digest, wanted = ArchiveWriter(folder, date, file_bytes), None, None

    def finish():
        if wanted is not None:
            if digest.hexdigest() != wanted:
                raise ValueError("the chunks of a record do not add up to its payload")
            archive.end()

    for batch in batches:
        for page_id, url, size, sha1, refers_to, chunk_no, data in zip(*batch.columns):
            if chunk_no.as_py() == 0:
                finish()
                page, sum_hex, of = page_id.as_py(), sha1.as_py(), refers_to.as_py()
                payload = size.as_py()
                http = (
                    "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                    f"Content-Length: {payload}\r\n\r\n"
                ).encode()
                own = record_name(page, sum_hex) if of is None else f"<urn:uuid:{uuid.uuid4()}>"
                archive.begin(
                    [
                        ("WARC-Type", "response" if of is None else "revisit"),
                        ("WARC-Record-ID", own),
                        ("WARC-Date", date),
                        ("WARC-Target-URI", None if url.as_py() is None else quote(url.as_py(), safe="!#$%&'()*+,/:;=?@[]~")),
                        ("WARC-Page-ID", None if page is None else quote(page)),
                        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(sum_hex)).decode()),
                        ("WARC-Profile", None if of is None else PROFILE),
                        ("WARC-Refers-To", None if of is None else record_name(of, sum_hex)),
                        ("Content-Type", "application/http; msgtype=response"),
                        ("Content-Length", len(http) + (payload if of is None else 0)),
                    ]
                )
                archive.write(http)
                digest = hashlib.sha1()
                wanted = sum_hex if of is None else digest.hexdigest()
            chunk = data.as_buffer()
            if chunk.size:
                digest.update(chunk)
                archive.write(chunk)
    finish()
    archive.close_file()
    yield pa.RecordBatch.from_arrays(
        [pa.array([f[i] for f in archive.files], k) for i, k in enumerate((pa.string(), pa.int64(), pa.int64()))],
        ["path", "records", "bytes"],
    )


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    chunk: int = CHUNK,
    least: int = REVISIT_BYTES,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write a record for every page below ``folder``; the manifest (path, records, bytes) of the files to read.

    Of records with equal payloads of at least ``least`` bytes that with the largest id is a response and the others
    revisit it; all other records are responses. A null payload counts as empty. Null is the smallest id: a group
    without any id has responses only, and rows that repeat the response's id and payload are responses too. A null
    url or id has no header. An empty table writes no file. ``folder`` must be reachable by all executors.
    """
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    chunks = record_chunks(pages, id_col, url_col, html_col, chunk, least)
    written = chunks.mapInArrow(
        lambda batches: write_task(batches, folder, date, file_bytes), "path string, records long, bytes long"
    )
    return stored(written, "manifest")


class ArchiveReader:
    """The unpacked bytes of an archive, a block at a time."""

    def __init__(self, path: str, fs, block: int):
        self.source = fs.open_input_stream(path, compression=None)
        self.block, self.held, self.packed = block, b"", b""
        self.unpacker = zlib.decompressobj(31)

    def more(self) -> bool:
        while True:
            if self.unpacker.eof:
                self.packed = self.unpacker.unused_data or self.packed
                self.unpacker = zlib.decompressobj(31)
            if not self.packed:
                self.packed = self.source.read(self.block)
                if not self.packed:
                    self.held += (rest := self.unpacker.decompress(b"", self.block))
                    return bool(rest)
            data = self.unpacker.decompress(self.packed, self.block)
            self.packed = b"" if self.unpacker.eof else self.unpacker.unconsumed_tail
            if data:
                self.held += data
                return True

    def head(self) -> bytes | None:
        """Everything up to the next empty line."""
        at = self.held.find(GAP)
        while at < 0:
            if not self.more():
                if self.held.strip():
                    raise ValueError("an archive ends within a record")
                return None
            at = self.held.find(GAP)
        found, self.held = self.held[:at], self.held[at + 4 :]
        return found

    def take(self, most: int) -> bytes:
        while not self.held:
            if not self.more():
                raise ValueError("an archive ends within a record")
        found, self.held = self.held[:most], self.held[most:]
        return found


def records_of(path: str, fs, chunk: int, with_data: bool):
    """Chunk tuples of an archive's response and revisit records, in order."""
    reader = ArchiveReader(path, fs, chunk)
    while (head := reader.head()) is not None:
        fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
        left, kind = int(fields["Content-Length"]), fields["WARC-Type"]
        if kind in ("response", "revisit"):
            left -= len(reader.head()) + 4
            sum_hex = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
            known = (fields["WARC-Record-ID"], kind, fields.get("WARC-Page-ID"), fields.get("WARC-Target-URI"))
            of = fields.get("WARC-Refers-To")
            if kind == "revisit":
                yield (*known, of, 0, None, True, None, sum_hex)
            else:
                digest, size, number = hashlib.sha1(), 0, 0
                while True:
                    data = reader.take(min(left, chunk)) if left else b""
                    left -= len(data)
                    size += len(data)
                    digest.update(data)
                    if not left or with_data:
                        yield (*known, of, number, data if with_data else None, not left, size, digest.hexdigest())
                    number += 1
                    if not left:
                        break
                if digest.hexdigest() != sum_hex:
                    raise ValueError(f"{known[0]} does not have the payload its header names")
        while left:
            left -= len(reader.take(min(left, chunk)))
        if reader.head() != b"":
            raise ValueError("a record is longer than its header says")


def read_task(batches, folder: str, chunk: int, with_data: bool):
    fs, _ = arrow_fs.FileSystem.from_uri(folder)
    names = [f.split()[0] for f in CHUNKS.split(", ")]
    kinds = {"chunk_no": pa.int32(), "data": pa.binary(), "last": pa.bool_(), "payload_bytes": pa.int64()}

    def pack(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], kinds.get(n, pa.string())) for i, n in enumerate(names)], names
        )

    rows, held = [], 0
    for batch in batches:
        for path in batch.column(0).to_pylist():
            for row in records_of(path, fs, chunk, with_data):
                rows.append(row)
                held += 500 + len(row[6] or b"")
                if held > BATCH_BYTES:
                    yield pack(rows)
                    rows, held = [], 0
    yield pack(rows)


def read_archives(manifest: DataFrame, folder: str, chunk: int = CHUNK, with_data: bool = True) -> DataFrame:
    """Chunk rows of all records of the manifest's files, one file a task.

    ``payload_bytes`` and ``payload_digest`` run from chunk to chunk and are the whole payload's on the ``last``
    one. Without data only last chunks are returned. A revisit has one row, its digest from the header.
    """
    files = manifest.select("path")
    return files.repartition(max(1, files.count())).mapInArrow(
        lambda batches: read_task(batches, folder, chunk, with_data), CHUNKS
    )


def archive_records(manifest: DataFrame, folder: str, chunk: int = CHUNK) -> DataFrame:
    """One row per record: page_id (text), payload_bytes, payload_digest, record_type, refers_to."""
    records = stored(
        read_archives(manifest, folder, chunk, with_data=False).where("last").drop("data", "chunk_no", "last"), "records"
    )
    responses = (
        records.where("record_type = 'response'")
        .groupBy(F.col("record_id").alias("refers_to"))
        .agg(F.first("page_id").alias("response_id"), F.first("payload_bytes").alias("response_bytes"))
    )
    # Responses refer to nothing: kept out of the join, they do not meet under the null key.
    revisits = records.where("record_type = 'revisit'").drop("payload_bytes").join(responses, "refers_to", "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return (
        records.where("record_type = 'response'")
        .select(columns)
        .union(
            revisits.withColumn("refers_to", F.col("response_id"))
            .withColumnRenamed("response_bytes", "payload_bytes")
            .select(columns)
        )
    )


@query(
    """
WITH d AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS response_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> response_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> response_id THEN response_id END AS refers_to
FROM g
"""
)
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    folder = scratch_path(spark, "archives")
    kind = pages.schema["page_id"].dataType
    records = archive_records(write_archives(pages, folder), folder)
    return records.withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})
