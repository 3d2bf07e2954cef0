"""SimHash near-duplicates by multi-index hashing.

A 64-bit fingerprint is cut into two segments of 32 bits. Fingerprints that differ in at most three bits agree in
one segment but for one bit, so each fingerprint is filed in a table under both segment values and looked up under
every value in the ball of radius one around them; whole distances are then verified. Of two values one bit apart
one has that bit clear, so only the clear bits are flipped.

Only distinct fingerprints take part. A key with many of them is dealt out in blocks of ``BLOCK``, and every row of
the key meets every block; a block reports a spanning forest of its links, never all pairs. The forests' components
are those of all links.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from palimpsest.llm.common import query, table
from palimpsest.llm.components import connected_components
from palimpsest.session import stored

SHINGLE = 3
MAX_BITS = 3
SEED = 42
BLOCK = 4096
PIECE = 1 << 20
PIECE_ROWS = 1 << 16

SPACE = re.compile(rb"[\x20\x09-\x0D]")
BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def word_blocks(data: bytes, piece: int = PIECE):
    """The words of a text in lists of bounded size."""
    at = 0
    while at < len(data):
        end = at + piece
        if end < len(data):
            found = SPACE.search(data, end)
            end = found.start() if found else len(data)
        yield data[at:end].split()
        at = end


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits, lowest first."""
    octets = hashes.view(np.uint8).reshape(-1, 8)
    if len(octets) < 2048:
        return np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.concatenate([np.bincount(octets[:, i], minlength=256) @ BITS for i in range(8)])


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash as a signed long; zero for a text without words.

    Words are runs of anything but ASCII white space, A-Z lower-cased; shingles count as often as they occur, and a
    text with fewer words than one is one shingle. A text is worked off in blocks of about a megabyte.
    """
    hashed = xxhash.xxh64_intdigest
    held: list[bytes] = []
    counts, total = np.zeros(64, np.int64), 0
    for words in word_blocks((text or "").encode("utf-8", "surrogatepass").lower()):
        words = held + words
        n = len(words) - shingle + 1
        if n > 0:
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1).tolist()
            starts = [0] + ends[:-1]
            hashes = [hashed(joined[a : b - 1], SEED) for a, b in zip(starts, ends[shingle - 1 :])]
            counts += bit_counts(np.array(hashes, dtype="<u8"))
            total += n
        held = words[max(n, 0) :] if n > 0 else words
    if not total and held:
        counts, total = bit_counts(np.array([hashed(b" ".join(held), SEED)], dtype="<u8")), 1
    set_bits = np.packbits(counts * 2 > total, bitorder="little")
    return int(set_bits.view("<i8")[0])


def text_hash(text):
    return F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """doc_id, text_hash, fp."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("doc_id"), text_hash(text), text.alias("text"))

    def run(batches):
        for batch in batches:
            prints = [fingerprint(t.as_py(), shingle) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(prints, pa.int64())], ["doc_id", "text_hash", "fp"]
            )

    return rows.mapInArrow(run, rows.drop("text").schema.add("fp", "long"))


def forest(owners: np.ndarray, others: np.ndarray, max_bits: int):
    """Links of a spanning forest over the owners' links among themselves and to the others."""
    nodes = np.concatenate([owners, others])
    parent = np.arange(len(nodes))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = []
    for i in range(len(owners)):
        near = np.flatnonzero(np.bitwise_count(nodes[i + 1 :] ^ nodes[i]) <= max_bits) + i + 1
        if not len(near):
            continue
        # Of the near nodes that are already in this one's tree nothing is new.
        for j in near[parent[near] != parent[i]].tolist():
            a, b = root(i), root(j)
            if a != b:
                parent[b] = a
                links.append((int(nodes[i].astype(np.int64)), int(nodes[j].astype(np.int64))))
            parent[j] = a
        parent[i] = root(i)
    return links


def forests(batches, max_bits: int):
    """Forests of each (key, block); rows come sorted by both, owners first, and the others go by in pieces."""
    group, owners, others, out = None, [], [], []

    def close():
        if owners and len(owners) + len(others) > 1:
            sides = [np.array(side, np.int64).view(np.uint64) for side in (owners, others)]
            out.extend(forest(*sides, max_bits))

    def flush():
        done = pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], ["u", "v"]
        )
        out.clear()
        return done

    for batch in batches:
        for key, block, owner, fp in zip(*[c.to_pylist() for c in batch.columns]):
            if (key, block) != group:
                close()
                group, owners, others = (key, block), [], []
            if len(others) == PIECE_ROWS:
                close()
                others = []
            if len(out) > 10_000:
                yield flush()
            (owners if owner else others).append(fp)
    close()
    yield flush()


def near_links(prints: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """(u, v) links whose components are those of all pairs of ``fp`` that differ in ``max_bits`` bits or fewer."""
    if max_bits > 3:
        raise ValueError("two segments with balls of radius one find up to three differing bits")
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned("fp", 32).bitwiseOR(F.lit(1 << 32))
    segments = prints.select("fp", F.explode(F.array(low, high)).alias("key"))
    owned = segments.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("blocks"))
    flips = F.expr("filter(transform(sequence(0, 31), i -> shiftleft(1L, i)), m -> (key & m) = 0)")
    probes = segments.select("fp", F.explode(F.transform(flips, lambda m: F.col("key").bitwiseOR(m))).alias("key"))
    looked_up = probes.withColumn("owner", F.lit(False)).unionByName(segments.withColumn("owner", F.lit(True)))
    home = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    # Spark sizes the probes as if the explode made one row of each, and would broadcast all of them.
    met = (
        looked_up.join(owned.hint("merge"), "key")
        .select("key", "fp", "owner", home.alias("home"), F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"))
        .select("key", "block", (F.col("owner") & (F.col("home") == F.col("block"))).alias("owner"), "fp")
    )
    return (
        met.repartition("key", "block")
        .sortWithinPartitions("key", "block", F.desc("owner"))
        .mapInArrow(lambda batches: forests(batches, max_bits), "u long, v long")
    )


def simhash_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    block: int = BLOCK,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, fp (a long), component (a fingerprint) and component_id.

    Fingerprints that differ in ``max_bits`` bits or fewer are linked; component_id is the smallest id that can be
    reached, null only if no row reached has an id. Null and empty texts have fingerprint zero, which links like any
    other. Rows that repeat an id are rows like others. An empty table gives an empty result; other columns of
    ``docs`` are ignored, whatever their names.
    """
    prints = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    groups = connected_components(near_links(distinct.select("fp"), max_bits, block))
    member = stored(
        distinct.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", "first_id", F.coalesce("component", "fp").alias("component")
        ),
        "fingerprint-groups",
    )
    smallest = member.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = member.join(smallest, "component").select("fp", "component", "component_id")
    return prints.join(named, "fp").select("doc_id", "text_hash", "fp", "component", "component_id")


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each group the one with the smallest id.

    Rows without an id stay only where their group has none with one. Of rows that repeat the staying id, the one
    with the smallest text hash stays, and of those that repeat the text as well, one.
    """
    groups = simhash_groups(docs, id_col, text_col, **options)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")).alias("first")
    kept = groups.groupBy("component").agg(first).select(row_key(F.col("first.doc_id"), F.col("first.text_hash")))
    own = [F.col(f"doc.`{c}`") for c in docs.columns]
    keyed = row_key(F.col(id_col), text_hash(F.col(text_col).cast("string")))
    return (
        docs.select(F.struct("*").alias("doc"), keyed)
        .join(kept, "row_key", "left_semi")
        .dropDuplicates(["row_key"])
        .select(*own)
    )


def row_key(doc_id, hashed):
    """One string for id and text hash, never null."""
    return F.concat_ws("/", F.coalesce(doc_id.cast("string"), F.lit("")), hashed.cast("string")).alias("row_key")


@query()
def op7_simhash_near_dedup(spark, sf_dir):
    groups = simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
