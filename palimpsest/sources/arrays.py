"""JSON array files of any layout, split over tasks.

An array cannot be cut without knowing whether a place stands inside a string, and how deep. So a file is read twice
by ranges of bytes. The first pass finds what each range does to that state, once for a beginning outside of strings
and once inside; one row a range, composed in file order, gives the state that each range begins with. The second
pass cuts the ranges into records where the depth comes back to one. Only records that a range breaks off in are put
together from their parts.

Ranges are those of the text source, read with ``}`` as the line separator: every record ends with one, and after one
no escape is pending.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from palimpsest.session import stored
from palimpsest.sources.landing import ORDINAL, SOURCE_FILE

ESCAPED = re.compile(rb"\\.", re.DOTALL)
LAST = 1 << 40
#: Ranges whose beginnings are sent to the tasks at once, and the bytes that are sure to make fewer.
GROUP_BYTES = 4 << 40
PARSED = 10_000


def _pieces(spark: SparkSession, paths: list[str]) -> DataFrame:
    """What stands between closing braces, in file order within each range."""
    return (
        spark.read.option("lineSep", "}")
        .text(paths)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.col("value").cast("binary").alias("value"),
        )
    )


def _runs(batches):
    """(file, block, values) of each stretch of a batch's rows that are of one range, with the rows' other columns."""
    for batch in batches:
        files, blocks = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
        if not len(blocks):
            continue
        names = files.dictionary_encode().indices.to_numpy()
        cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(names) != 0)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(blocks)]):
            yield files[int(a)].as_py(), int(blocks[a]), batch.slice(a, b - a)


def _effects(batches):
    """(file, block, part, quotes, delta and least depth after a brace, for a start outside and inside a string)."""
    rows, part = [], 0
    for file, block, run in _runs(batches):
        text = np.frombuffer(ESCAPED.sub(b"", b"}".join(run.column(2).to_pylist()) + b"}"), np.uint8)
        inside = np.cumsum(text == 34) & 1
        step = np.isin(text, (123, 91)).astype(np.int64) - np.isin(text, (125, 93))
        braces = text == 125
        found = []
        for outside in (1 - inside, inside):
            depth = np.cumsum(step * outside)
            found += [int(depth[-1]), int(np.where(braces & (outside == 1), depth, LAST).min())]
        rows.append((file, block, part, int(inside[-1]), *found))
        part += 1
        if len(rows) >= PARSED:
            yield _batch(rows, EFFECTS)
            rows = []
    yield _batch(rows, EFFECTS)


EFFECTS = "file string, block long, part long, odd long, delta0 long, least0 long, delta1 long, least1 long"
STARTS = "file string, block long, inside boolean, depth long, since long, last boolean"
TEXTS = "file string, block long, row long, part long, text string, fault boolean"


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in ddl.split(", "))])


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    schema = _arrow(ddl)
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema.names)


def _begun(effects: pd.DataFrame) -> pd.DataFrame:
    """The state that each range of a file begins with, and the range in which the record open there began."""
    effects = effects.sort_values(["block", "part"])
    rows, inside, depth, since, block = [], 0, 0, None, None
    opened = False
    for e in effects.itertuples():
        if e.block != block:
            if block is not None and depth >= 2 and (since is None or opened):
                since = block
            elif depth < 2 and not inside:
                since = None
            block, opened = e.block, False
            rows.append([e.file, block, bool(inside), depth, since, False])
        delta, least = (e.delta1, e.least1) if inside else (e.delta0, e.least0)
        opened = opened or depth + least <= 1 or depth < 2
        depth, inside = depth + delta, inside ^ e.odd
    rows[-1][-1] = True
    out = pd.DataFrame(rows, columns=_arrow(STARTS).names)
    return out.astype({"since": "Int64", "depth": "int64", "block": "int64"})


class _Cutter:
    """Cuts the pieces of one range into records."""

    def __init__(self, file, block, inside, depth, since, last):
        self.at, self.inside, self.depth = (file, block), int(inside), depth
        self.since, self.last = since, last
        self.first = depth == 0 and not inside
        self.held, self.row, self.waiting = [], 0, None

    def feed(self, value: bytes):
        """Take one piece; the one before it was followed by a brace."""
        before, self.waiting = self.waiting, value
        if before is not None:
            yield from self.step(before, True)

    def step(self, value: bytes, closed: bool):
        self.held.append(value)
        clean = ESCAPED.sub(b"", value) if b"\\" in value else value
        parts = clean.split(b'"')
        for outside in parts[self.inside :: 2]:
            self.depth += outside.count(b"{") + outside.count(b"[") - outside.count(b"}") - outside.count(b"]")
        self.inside ^= (len(parts) - 1) & 1
        if closed and not self.inside:
            self.depth -= 1
            if self.depth <= 1:
                yield self.record(b"}".join(self.held) + b"}")
                self.held = []

    def record(self, text: bytes):
        file, block = self.at
        if self.since is not None:
            since, self.since = self.since, None
            return file, since, LAST, block, text.decode("utf-8", "replace"), False
        begun = re.match(rb"\s*\[\s*(?=\{)" if self.first else rb"\s*,\s*(?=\{)", text)
        self.first = False
        self.row += 1
        wrong = begun is None or self.depth != 1
        return file, block, self.row, 0, text[begun.end() if begun else 0 :].decode("utf-8", "replace"), wrong

    def end(self):
        """What is left when the range ends: a part of a record, or the end of the file."""
        file, block = self.at
        if self.waiting is not None:
            yield from self.step(self.waiting, not self.last)
        left = b"}".join(self.held)
        if not self.last:
            if self.held and self.since is not None:
                yield file, self.since, LAST, block, (left + b"}").decode("utf-8", "replace"), False
            elif self.held:
                begun = re.match(rb"\s*\[\s*(?=\{)" if self.first else rb"\s*,\s*(?=\{)", left)
                text = left[begun.end() if begun else 0 :] + b"}"
                yield file, block, LAST, block, text.decode("utf-8", "replace"), begun is None
            return
        closing = rb"\s*(\[\s*\]\s*)?" if self.first else rb"\s*\]\s*"
        if self.since is not None or self.inside or self.depth or not re.fullmatch(closing, left):
            yield file, block, LAST + 1, 0, None, True


def _cut(batches):
    """Records and parts of records (file, block, row, part, text, fault) of rows with their range's beginning."""
    cutter, out = None, []

    for file, block, run in _runs(batches):
        if cutter is None or cutter.at != (file, block):
            if cutter:
                out.extend(cutter.end())
            begun = [run.column(k)[0].as_py() for k in range(3, 7)]
            cutter = _Cutter(file, block, *begun)
        for value in run.column(2):
            out.extend(cutter.feed(value.as_py()))
        if len(out) >= PARSED:
            yield _batch(out, TEXTS)
            out = []
    if cutter:
        out.extend(cutter.end())
    yield _batch(out, TEXTS)


def record_texts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, block, row, text, fault) of each record of the array files; ``fault`` marks what is no record, and files
    that do not end as arrays do. The table is stored: checks and reads start from it."""
    pieces = _pieces(spark, paths)
    effects = pieces.mapInArrow(_effects, EFFECTS)
    starts = stored(effects.groupBy("file").applyInPandas(_begun, STARTS), "range-starts")
    told = pieces.join(F.broadcast(starts), ["file", "block"]).select(
        "file", "block", "value", "inside", "depth", "since", "last"
    )
    texts = stored(told.mapInArrow(_cut, TEXTS), "record-texts")
    whole = texts.where(F.col("row") != LAST).drop("part")
    ordered = F.sort_array(F.collect_list(F.struct("part", "text")))
    broken = texts.where(F.col("row") == LAST).groupBy("file", "block", "row")
    joined = broken.agg(F.array_join(F.transform(ordered, lambda p: p["text"]), "").alias("text"), F.max("fault").alias("fault"))
    return whole.unionByName(joined).withColumn("file", F.element_at(F.split("file", "/"), -1))


def split_files(spark: SparkSession, files: list[tuple[str, int]]) -> DataFrame:
    """``record_texts`` of (path, bytes), in groups of files whose ranges are few enough to be told to every task."""
    groups, room = [[]], 0
    for path, size in files:
        if groups[-1] and room + size > GROUP_BYTES:
            groups, room = [*groups, []], 0
        groups[-1].append(path)
        room += size
    texts = [record_texts(spark, group) for group in groups]
    out = texts[0]
    for more in texts[1:]:
        out = out.unionByName(more)
    return out


def malformed(texts: DataFrame, schema: T.StructType) -> set[str]:
    """Names of the files with a record that does not parse."""
    corrupt = "_malformed"
    kind = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    record = F.from_json("text", kind, options)
    wrong = F.col("fault") | record.getField(corrupt).isNotNull()
    bad = texts.select("file", wrong.alias("wrong")).groupBy("file").agg(F.max("wrong").alias("bad"))
    return {r["file"] for r in bad.where("bad").collect()}


def read_texts(texts: DataFrame, schema: T.StructType) -> DataFrame:
    """The records, with their file name and position, as ``landing.read_json_batches`` gives them."""
    record = F.from_json("text", schema, {"mode": "FAILFAST"})
    position = F.struct("block", "row")
    return texts.where(~F.col("fault")).select(
        record.alias("_record"), F.col("file").alias(SOURCE_FILE), position.alias(ORDINAL)
    ).select("_record.*", SOURCE_FILE, ORDINAL)
