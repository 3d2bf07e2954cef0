"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash of the last ``HASHED`` bytes cuts texts where their content says so: copies and shared passages fall
into equal chunks wherever they stand. A first pass counts chunk digests. A text none of whose chunks occurs twice is
encoded where it is read. The chunks of the other texts meet by digest; of each group one is encoded and the others
take its ids, then the chunks go back to their texts.

What a chunk has before its first blank and after its last one depends on its neighbours. At each join these bytes are
put together and encoded anew, over as many chunks as it takes to reach a blank on both sides: there the vocabulary's
word rule ends a word whatever stands around it, so both sides agree with an encoding of the whole text.

The tasks learn which digests occur twice from a bitmap of ``BUCKETS`` bits; digests that share a bit with one are
taken for shared, which moves more but changes nothing. Digests with more than ``HOT`` of the chunks are dealt out
over ``SALTS`` tasks, each of which encodes them once.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from palimpsest.llm.common import query, table
from palimpsest.session import stored

MODEL = "word_bpe_49k.json"
HASHED = 16
MASK = 0x7FF
LEAST, MOST = 512, 1 << 16
BUCKETS = 1 << 24
HOT = 0.001
SALTS = 256
PIECE = 1 << 22
HELD_WORDS = 500_000
HELD_DIGESTS = 100_000
OUT_BYTES = 8 << 20

#: ASCII white space; the vocabulary's word rule never looks across it.
BLANK = re.compile(rb"[\t-\r ]")
SPREAD = (np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
STEP = np.array([0x100000001B3], np.uint64)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def whole_end(data: bytes, place: int) -> int:
    """``place``, or the end of the character that it cuts."""
    while place < len(data) and data[place] & 0xC0 == 0x80:
        place += 1
    return place


def places(data: bytes):
    """Where the rolling hash would cut, in order; the text is hashed in pieces."""
    for at in range(0, len(data) - HASHED + 1, PIECE):
        rolling = SPREAD[np.frombuffer(data, np.uint8, min(PIECE + HASHED - 1, len(data) - at), at)]
        width, step = 1, STEP
        while width < HASHED:
            # Two neighbouring windows make one of twice the width.
            rolling = rolling[:-width] * step + rolling[width:]
            width, step = 2 * width, step * step
        yield from (np.flatnonzero((rolling >> np.uint64(40)) & np.uint64(MASK) == 0) + at + HASHED).tolist()


def chunks(data: bytes):
    """The chunks of a text, of ``LEAST`` to ``MOST`` bytes but for the last."""
    start = 0
    for place in [*places(data), len(data)]:
        while place - start > MOST:
            end = whole_end(data, start + MOST)
            yield data[start:end]
            start = end
        end = whole_end(data, place)
        if LEAST <= end - start and end < len(data):
            yield data[start:end]
            start = end
    yield data[start:]


def parts(chunk: bytes) -> tuple[bytes, bytes | None, bytes]:
    """A chunk's bytes before its first blank, from there to its last blank, and after that."""
    first = BLANK.search(chunk)
    if first is None:
        return chunk, None, b""
    ragged = not chunk[-1:].isspace()
    end = len(chunk) - len(chunk.rsplit(None, 1)[-1]) if ragged else len(chunk)
    return chunk[: first.start()], chunk[first.start() : end], chunk[end:]


def digest_of(body: bytes) -> bytes:
    return hashlib.blake2b(body, digest_size=16).digest()


def short(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


class Coder:
    """Encodes texts word by word; a join at ASCII white space is exact. The first ``HELD_WORDS`` words are remembered."""

    def __init__(self, path: str):
        # A task has one core.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.known: dict[bytes, bytes] = {}
        #: Without a decoder of its own the vocabulary decodes to its tokens with one space between.
        self.tokens = None if self.tokenizer.decoder else [self.tokenizer.id_to_token(i) for i in range(size)]
        self.numbers = [str(i) for i in range(size)]

    def encode_words(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of each word, from one encoding of them all with line ends between."""
        coded = self.tokenizer.encode(b"\n".join(words).decode("utf-8"), add_special_tokens=False)
        ids = np.array(coded.ids, self.kind)
        starts = np.fromiter((start for start, _ in coded.offsets), np.int64, len(ids))
        ends = np.cumsum([len(w.decode("utf-8")) + 1 for w in words])
        cuts = [0, *np.searchsorted(starts, ends).tolist()]
        return {w: ids[a:b].tobytes() for w, a, b in zip(words, cuts, cuts[1:])}

    def encode(self, data: bytes) -> bytes:
        """Ids of a text."""
        words, known = data.split(), self.known
        new = list({w for w in words if w not in known})
        if not new:
            return b"".join([known[w] for w in words])
        found = {}
        for at in range(0, len(new), 512):
            found |= self.encode_words(new[at : at + 512])
        if len(known) < HELD_WORDS:
            known.update(found)
        else:
            found |= {w: known[w] for w in words if w in known}
            known = found
        return b"".join([known[w] for w in words])


@functools.lru_cache(1)
def coder_of(path: str) -> Coder:
    """One coder for all tasks of a Python worker."""
    return Coder(path)


class Assembly:
    """A text's ids put together chunk by chunk, with running digests of the ids and of what they decode to."""

    def __init__(self, coder: Coder, outputs: bool):
        self.coder, self.outputs = coder, outputs
        self.edge, self.n = b"", 0
        self.ids_hash, self.text_hash = hashlib.sha256(), hashlib.sha256()
        self.ids: list[int] = []
        self.decoded: list[str] = []

    def add_ids(self, packed: bytes) -> None:
        ids = np.frombuffer(packed, self.coder.kind).tolist()
        if not ids:
            return
        gap = " " if self.n else ""
        self.n += len(ids)
        self.ids_hash.update((gap + " ".join([self.coder.numbers[i] for i in ids])).encode())
        if self.coder.tokens:
            text = gap + " ".join([self.coder.tokens[i] for i in ids])
            self.text_hash.update(text.encode("utf-8"))
            if self.outputs:
                self.decoded.append(text)
        if self.outputs or not self.coder.tokens:
            self.ids.extend(ids)

    def add(self, head: bytes, body: bytes | None, tail: bytes) -> None:
        """A chunk; ``body`` are its ids, or None if it has no blank."""
        self.edge += head
        if body is not None:
            self.add_ids(self.coder.encode(self.edge))
            self.add_ids(body)
            self.edge = tail

    def done(self) -> tuple:
        self.add_ids(self.coder.encode(self.edge))
        decoded = "".join(self.decoded)
        if not self.coder.tokens:
            decoded = self.coder.tokenizer.decode(self.ids, skip_special_tokens=False)
            self.text_hash.update(decoded.encode("utf-8"))
        row = (self.n, self.ids_hash.hexdigest(), self.text_hash.hexdigest())
        return (*row, self.ids, decoded) if self.outputs else row


OUTPUTS = {"ids": pa.list_(pa.int32()), "decoded": pa.string()}
RESULT = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
MOVED = {
    "row": pa.int64(),
    "number": pa.int32(),
    "short": pa.int64(),
    "salt": pa.int32(),
    "digest": pa.binary(),
    "body": pa.binary(),
    "ids": pa.binary(),
    "head": pa.binary(),
    "tail": pa.binary(),
    "last": pa.bool_(),
}


class Table:
    """Rows gathered into record batches of bounded size; the first column is copied from the input by place."""

    def __init__(self, columns: dict, first: pa.DataType | None = None):
        self.columns = columns if first is None else {"doc_id": first} | columns
        self.rows, self.held = [], 0

    def add(self, row: tuple) -> bool:
        self.rows.append(row)
        self.held += 100 + sum(len(x) for x in row if isinstance(x, (bytes, str))) + sum(
            4 * len(x) for x in row if isinstance(x, list)
        )
        return self.held > OUT_BYTES

    def batch(self) -> pa.RecordBatch:
        arrays = [pa.array([r[i] for r in self.rows], kind) for i, kind in enumerate(self.columns.values())]
        self.rows, self.held = [], 0
        return pa.RecordBatch.from_arrays(arrays, list(self.columns))


def bytes_of(text) -> bytes:
    return (text.as_py() or "").encode("utf-8")


def digest_task(batches):
    for batch in batches:
        found = [
            short(digest_of(body))
            for text in batch.column(0)
            for _, body, _ in map(parts, chunks(bytes_of(text)))
            if body is not None
        ]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], ["short"])


class Shared:
    """Which digests may occur more than once, and which are frequent."""

    def __init__(self, buckets: np.ndarray, hot: list[int]):
        marks = np.zeros(BUCKETS, bool)
        marks[buckets] = True
        self.bits, self.hot = np.packbits(marks, bitorder="little"), frozenset(hot)

    def has(self, number: int) -> bool:
        bucket = number % BUCKETS
        return bool(self.bits[bucket >> 3] >> (bucket & 7) & 1)


def shared_digests(texts: DataFrame) -> Shared:
    """Count all chunk digests; at most ``BUCKETS`` numbers and 1/``HOT`` digests reach the driver."""
    digests = stored(texts.mapInArrow(digest_task, "short long"), "chunk-digests")
    twice = digests.groupBy("short").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = twice.select(F.pmod("short", F.lit(BUCKETS)).cast("int").alias("bucket")).distinct().toArrow()
    hot = digests.freqItems(["short"], HOT).first()[0] or []
    return Shared(buckets.column("bucket").to_numpy(), hot)


def in_place_task(batches, path: str, shared, outputs: bool):
    """Results of the texts that share no chunk."""
    coder, out = coder_of(path), None
    for batch in batches:
        out = out or Table(RESULT | (OUTPUTS if outputs else {}), batch.column(0).type)
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            found = [parts(c) for c in chunks(bytes_of(text))]
            if any(body is not None and shared.value.has(short(digest_of(body))) for _, body, _ in found):
                continue
            assembly = Assembly(coder, outputs)
            for head, body, tail in found:
                assembly.add(head, None if body is None else coder.encode(body), tail)
            if out.add((doc_id, *assembly.done())):
                yield out.batch()
    if out:
        yield out.batch()


def moved_task(batches, path: str, shared):
    """Chunks of the texts that share some: shared ones with their packed text, the others with their ids.

    Of a digest's chunks in a task only the first has its text; the task's number is the salt of a frequent digest,
    so that text and digests without text go the same way.
    """
    coder, packer, seen = coder_of(path), zstandard.ZstdCompressor(level=3), set()
    salt, out = TaskContext.get().partitionId() % SALTS, None
    for batch in batches:
        out = out or Table(MOVED, batch.column(0).type)
        for doc_id, row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            found = [(*parts(c),) for c in chunks(bytes_of(text))]
            digests = [None if body is None else digest_of(body) for _, body, _ in found]
            if not any(d is not None and shared.value.has(short(d)) for d in digests):
                continue
            for number, ((head, body, tail), digest) in enumerate(zip(found, digests)):
                packed = ids = key = None
                if digest is not None and shared.value.has(short(digest)):
                    key = short(digest)
                    if digest not in seen:
                        packed = packer.compress(body)
                        if len(seen) < HELD_DIGESTS:
                            seen.add(digest)
                elif digest is not None:
                    digest, ids = None, packer.compress(coder.encode(body))
                here = salt if key in shared.value.hot else 0
                if out.add((doc_id, row, number, key, here, digest, packed, ids, head, tail, number + 1 == len(found))):
                    yield out.batch()
    if out:
        yield out.batch()


def encode_task(batches, path: str):
    """Ids for the shared chunks; the rows of a digest come together, one with text first."""
    coder, packer, unpacker = coder_of(path), zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()
    current, ids = None, None
    for batch in batches:
        columns = {name: batch.column(name) for name in ("digest", "body", "ids")}
        every = []
        for digest, body, own in zip(*columns.values()):
            digest = digest.as_py()
            if digest is None:
                every.append(own.as_py())
                continue
            if digest != current:
                current, ids = digest, packer.compress(coder.encode(unpacker.decompress(body.as_py())))
            every.append(ids)
        names = ["doc_id", "row", "number", "ids", "head", "tail", "last"]
        kept = [pa.array(every, pa.binary()) if n == "ids" else batch.column(n) for n in names]
        yield pa.RecordBatch.from_arrays(kept, names)


def join_task(batches, path: str, outputs: bool):
    """Results of the moved texts, whose chunks come in order."""
    coder, unpacker, out, assembly = coder_of(path), zstandard.ZstdDecompressor(), None, None
    for batch in batches:
        out = out or Table(RESULT | (OUTPUTS if outputs else {}), batch.column(0).type)
        for doc_id, ids, head, tail, last in zip(*[batch.column(n) for n in ("doc_id", "ids", "head", "tail", "last")]):
            assembly = assembly or Assembly(coder, outputs)
            packed = ids.as_py()
            assembly.add(head.as_py(), None if packed is None else unpacker.decompress(packed), tail.as_py())
            if last.as_py():
                full = out.add((doc_id.as_py(), *assembly.done()))
                assembly = None
                if full:
                    yield out.batch()
    if out:
        yield out.batch()


SPARK = {
    pa.int64(): T.LongType(),
    pa.int32(): T.IntegerType(),
    pa.binary(): T.BinaryType(),
    pa.string(): T.StringType(),
    pa.bool_(): T.BooleanType(),
    pa.list_(pa.int32()): T.ArrayType(T.IntegerType()),
}


def schema_of(columns: dict, id_type: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("doc_id", id_type), *[T.StructField(c, SPARK[k]) for c, k in columns.items()]])


def encode_decode(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    model_path: str | None = None,
    outputs: bool = True,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256, and with ``outputs`` ids, decoded.

    The ids are those of the vocabulary for the whole text, without added special tokens, truncation or padding;
    ``decoded`` is its decoding of them. The digests are SHA-256 of the decimal ids joined by one space, and of the
    decoded text. A null text counts as empty: no ids, an empty decoding. Rows that repeat an id are encoded each
    by its own text; an empty table gives an empty result.
    """
    path = model_path or default_model()
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = texts.schema["doc_id"].dataType
    shared = docs.sparkSession.sparkContext.broadcast(shared_digests(texts.select("text")))
    result = schema_of(RESULT | (OUTPUTS if outputs else {}), id_type)
    in_place = texts.mapInArrow(lambda b: in_place_task(b, path, shared, outputs), result)
    rows = texts.select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    moved = rows.mapInArrow(lambda b: moved_task(b, path, shared), schema_of(MOVED, id_type))
    kept = {n: k for n, k in MOVED.items() if n not in ("short", "salt", "digest", "body")}
    encoded = (
        moved.repartition(F.coalesce("short", F.xxhash64("row", "number")), F.col("salt"))
        .sortWithinPartitions("short", "salt", "digest", F.col("body").isNull())
        .mapInArrow(lambda b: encode_task(b, path), schema_of(kept, id_type))
    )
    joined = (
        encoded.repartition("row")
        .sortWithinPartitions("row", "number")
        .mapInArrow(lambda b: join_task(b, path, outputs), result)
    )
    return in_place.unionByName(joined)


@query()
def op2_bpe_encoding_decoding(spark, sf_dir):
    return encode_decode(table(spark, sf_dir, "documents"), outputs=False)
