"""Mixing sources to target weights by the cube method of balanced sampling.

A source that is to give p times its words gives every document floor(p) times and a sample of its documents once
more, each with probability p - floor(p). The sample is balanced on two totals, words and documents: the flight takes
three documents with open probabilities at a time and moves these along the one direction that leaves both totals as
they are, until one of them is 0 or 1; of the two ends of the way the draw takes either with the chance that keeps
each document's probability. What is open in the end is the landing, a few documents a source, most of them held back
for it so that their sizes differ: of all ways to settle them the one whose words come closest is taken, of ties the
one whose documents do.

The flight of a large source runs in blocks, dealt out by the rows' content; the few documents that a block leaves
open meet those of other blocks in the next round, with the probabilities they have reached. Draws come from the
block's name and order from the rows' content, so a rerun gives the same sample whatever the partitions.
"""

from __future__ import annotations

import functools
import itertools
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from palimpsest.llm.common import query, table
from palimpsest.operators.joins import fits_broadcast
from palimpsest.session import stored

MOST = 3
WEIGHTS = 3
BLOCK = 8192
LANDING = 14
SEED = 13
TINY = 1e-9


def word_count(text: Column) -> Column:
    """How many runs of anything but ASCII white space; null has none."""
    blank = r"\x20\x09-\x0D"
    marked = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), f"[^{blank}]+", "x")
    return F.char_length(F.translate(marked, " \t\n\x0b\f\r", "")).cast("long")


def ranked_sources(rows: DataFrame) -> DataFrame:
    """(source, source_id, source_size, weight) of each source: ranks by code point, null last, weights 1, 2, 3, 1, ...

    The ranks come from a range-partitioned sort and the counts of its partitions, so no task sees all sources.
    """
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = stored(
        sources.orderBy(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), "sources"
    )
    parts = in_order.groupBy("part").agg(F.count(F.lit(1)).alias("in_part"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition of the sort
    offsets = parts.select("part", F.coalesce(F.sum("in_part").over(before), F.lit(0)).alias("offset"))
    own = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    rank = F.col("offset") + F.row_number().over(own) - 1
    return in_order.join(F.broadcast(offsets), "part").select(
        "source", rank.alias("source_id"), "source_size", (F.pmod(rank, F.lit(WEIGHTS)) + 1).alias("weight")
    )


def exact(number: int) -> Column:
    return F.lit(number).cast("decimal(38,0)")


def with_targets(sources: DataFrame, most: int) -> DataFrame:
    """``sources`` with ``target``: all words shared by weight, at most ``most`` times a source's own words.

    What is above goes to the others by weight until none is above: each turn finds the share of one unit of weight
    among the sources below their limit. The driver sees sums alone.
    """
    limit = F.col("source_size") * most
    whole = sources.agg(F.sum("source_size").alias("s"), F.sum("weight").alias("w")).first()
    total, left, weight = whole.s or 0, whole.s or 0, whole.w or 0
    while True:
        below = F.col("weight") * exact(left) <= limit.cast("decimal(38,0)") * exact(weight) if weight else F.lit(False)
        sums = sources.agg(
            F.sum(F.when(below, F.col("weight"))).alias("w"), F.sum(F.when(~below, limit)).alias("capped")
        ).first()
        now = (total - (sums.capped or 0), sums.w or 0)
        if now == (left, weight) or not now[1]:
            break
        left, weight = now
    share = (F.col("weight") * exact(left)).cast("double") / F.lit(weight) if weight else F.lit(0.0)
    return sources.withColumn("target", F.least(share, limit.cast("double")))


def flight(units: list[list], rng: random.Random, stop: int) -> None:
    """Move the probabilities (place 1) of units (size first) until at most ``stop`` are open, or two.

    Three open units at a time: the direction (c - b, a - c, b - a) for sizes a, b, c changes neither the sum of the
    probabilities nor the sum weighed by size; of three equal sizes two move against each other.
    """
    waiting = iter(units)
    held: list[list] = []
    left = len(units)
    while left > max(stop, 2):
        while len(held) < 3:
            held.append(next(waiting))
        (a, p, *_), (b, q, *_), (c, r, *_) = held
        way = (c - b, a - c, b - a) if not a == b == c else (1, -1, 0)
        longest = max(abs(u) for u in way)
        way = [u / longest for u in way]
        ends = []
        for sign in (1, -1):
            room = [((1 - x) / (sign * u) if sign * u > 0 else x / -(sign * u)) for x, u in zip((p, q, r), way) if u]
            ends.append(min(room))
        forth = rng.random() * (ends[0] + ends[1]) < ends[1]
        step = ends[0] if forth else -ends[1]
        for unit, u in zip(held, way):
            unit[1] += step * u
            unit[1] = 0.0 if unit[1] < TINY else 1.0 if unit[1] > 1 - TINY else unit[1]
        settled = [unit for unit in held if unit[1] in (0.0, 1.0)]
        left -= len(settled)
        held = [unit for unit in held if unit[1] not in (0.0, 1.0)]


def with_reserve(units: list[list], reserve: int) -> list[list]:
    """The units by falling size, but last, for the landing, up to ``reserve`` of them.

    Half of these are the largest after the first, which together make up for one large unit that stays open; the
    sizes of the others halve from there, to come close.
    """
    coarse = min(reserve // 2, len(units) - 1)
    kept, most = list(range(1, coarse + 1)), units[coarse][0] / 2
    for i in range(coarse + 1, len(units)):
        if len(kept) < reserve and units[i][0] <= most:
            kept.append(i)
            most = units[i][0] / 2
    held = set(kept)
    return [u for i, u in enumerate(units) if i not in held] + [units[i] for i in kept]


def land(units: list[list]) -> None:
    """Settle the open units so that the words come closest to what is expected, then the documents."""
    still = [u for u in units if 0 < u[1] < 1]
    ways = (np.arange(1 << len(still))[:, None] >> np.arange(len(still))) & 1
    sizes, odds = (np.array([u[k] for u in still], float) for k in (0, 1))
    words, documents = np.abs(ways @ sizes - sizes @ odds), np.abs(ways.sum(axis=1) - odds.sum())
    best = ways[np.lexsort([documents, words])[0]]
    for unit, x in zip(still, best.tolist()):
        unit[1] = float(x)


def flown(batches, landing: int, seed: int):
    """(source_id, name, copy, size, p) with moved probabilities, of rows sorted by source and block."""
    group, units, out = None, [], []

    def close():
        if units:
            source_id, turn, block, last = group
            rng = random.Random(f"{seed}/{source_id}/{turn}/{block}")
            if last:
                flight(with_reserve(units, landing - 2), rng, landing)
                land(units)
            else:
                flight(units, rng, 2)
            out.extend((source_id, name, copy, size, p) for size, p, name, copy in units)

    def flush():
        columns = list(zip(*out)) if out else [()] * 5
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64()]
        done = [pa.array(c, k) for c, k in zip(columns, kinds)]
        out.clear()
        return pa.RecordBatch.from_arrays(done, ["source_id", "name", "copy", "size", "p"])

    for batch in batches:
        for *at, size, p, name, copy in zip(*[c.to_pylist() for c in batch.columns]):
            if at != group:
                close()
                group, units = at, []
                if len(out) > BLOCK:
                    yield flush()
            units.append([size, p, name, copy])
    close()
    yield flush()


def balanced(units: DataFrame, block: int = BLOCK, landing: int = LANDING, seed: int = SEED) -> DataFrame:
    """``units`` (source_id, name, copy, size, p) with p moved to 0 or 1, both totals of each source kept.

    ``name`` and ``copy`` tell the units of a source apart. Sources with more open units than ``block`` take several
    rounds; each leaves two units a block.
    """
    done = []
    for turn in itertools.count():
        blocks = F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("blocks")
        sizes = stored(units.groupBy("source_id").agg(blocks), "mix-blocks")
        dealt = units.join(sizes, "source_id").select(
            "source_id",
            F.lit(turn).alias("turn"),
            F.pmod(F.xxhash64(F.lit(turn), "name", "copy"), F.col("blocks")).alias("block"),
            (F.col("blocks") == 1).alias("last"),
            "size",
            "p",
            "name",
            "copy",
        )
        moved = stored(
            dealt.repartition("source_id", "block")
            .sortWithinPartitions("source_id", "block", F.desc("size"), F.xxhash64(F.lit(seed), "name", "copy"), "name", "copy")
            .mapInArrow(lambda batches: flown(batches, landing, seed), units.schema),
            "mix-flight",
        )
        still_open = (F.col("p") > 0) & (F.col("p") < 1)
        done.append(moved.where(~still_open))
        if sizes.where("blocks > 1").isEmpty():
            return functools.reduce(DataFrame.unionByName, done)
        units = moved.where(still_open)


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(doc_id, source, size, hash) of each row; rows that agree in all four are interchangeable."""
    text = F.col(text_col).cast("string")
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        word_count(text).alias("size"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("hash"),
    )


def row_name() -> Column:
    return F.to_json(F.struct("doc_id", "source", "size", "hash"))


def planned(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    source_col: str,
    most: int = MOST,
    block: int = BLOCK,
    landing: int = LANDING,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, source, size, hash, rows, source_size, target, whole, extra): each of the ``rows`` interchangeable
    rows goes ``whole`` times and ``extra`` of them once more."""
    rows = sized(docs, id_col, text_col, source_col)
    alike = stored(rows.groupBy(rows.columns).agg(F.count(F.lit(1)).alias("rows")), "mix-classes")
    words = alike.select("source", (F.col("size") * F.col("rows")).alias("size"))
    sources = stored(with_targets(ranked_sources(words), most), "mix-sources")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate + F.lit(TINY))
    shares = sources.select(
        F.col("source").alias("of"), "source_id", "source_size", "target", whole.alias("whole"), (rate - whole).alias("p")
    )
    if fits_broadcast(shares):
        shares = F.broadcast(shares)
    met = alike.join(shares, F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumn("name", row_name())
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))
    units = met.where(F.col("p") > TINY).select("source_id", "name", copies.alias("copy"), "size", "p")
    chosen = balanced(stored(units, "mix-units"), block, landing, seed).where("p = 1")
    extra = chosen.groupBy("source_id", "name").agg(F.count(F.lit(1)).alias("extra"))
    return met.join(extra, ["source_id", "name"], "left").select(
        *alike.columns, "source_size", "target", "whole", F.coalesce("extra", F.lit(0)).alias("extra")
    )


def mix_plan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies), one row per row of ``docs``.

    ``size`` counts words, runs of anything but ASCII white space. Sources, by code point with null last, weigh
    1, 2, 3, 1, ... and share all words by weight; a target stops at ``most`` times its source's words and the rest
    goes to the others. ``copies`` is how often the mix takes the document, at most ``most`` times. ``block``,
    ``landing`` and ``seed`` are those of ``balanced``.

    Null and empty texts have size 0; a source without words has target 0. Of rows that repeat id, source and text as
    many are taken as planned, whichever; a rerun gives the same rows. Null ids are ids like others. Very long texts
    weigh what they weigh: where one outweighs its source's target, the mix comes as near as whole documents allow.
    An empty table gives an empty result; other columns of ``docs`` are ignored, whatever their names.
    """
    plan = planned(docs, id_col, text_col, source_col, **options)
    rows = plan.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    copies = F.col("whole") + (F.col("copy") <= F.col("extra")).cast("long")
    return rows.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix: each row of ``docs``, with its own columns alone, as often as ``mix_plan`` takes it.

    Interchangeable rows are counted off by input partition and within it, so a row repeated without end meets in no
    one task.
    """
    plan = planned(docs, id_col, text_col, source_col, **options).select(row_name().alias("key"), "whole", "extra")
    text = F.col(text_col).cast("string")
    own = F.struct(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), text.alias("text")
    ).alias("own")
    whole_rows = docs.select(F.struct("*").alias("doc"), own)
    named = whole_rows.select(
        "doc",
        "own.doc_id",
        "own.source",
        word_count(F.col("own.text")).alias("size"),
        F.xxhash64(F.coalesce("own.text", F.lit(""))).alias("hash"),
    )
    part = F.spark_partition_id().alias("part")
    keyed = stored(named.select("doc", row_name().alias("key"), part, F.monotonically_increasing_id().alias("row")), "mix-rows")
    counts = keyed.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("key", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    ranked = keyed.select("key", "part", "row").join(offsets, ["key", "part"]).select(
        "key", "row", (F.col("offset") + F.row_number().over(Window.partitionBy("key", "part").orderBy("row"))).alias("rank")
    )
    copies = F.col("whole") + (F.col("rank") <= F.col("extra")).cast("long")
    wanted = ranked.join(plan, "key").select("row", copies.alias("copies")).where("copies > 0")
    taken = keyed.join(wanted, "row").withColumn("turn", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return taken.select(*[F.col(f"doc.`{c}`") for c in docs.columns])


@query()
def op13_mixing_sources(spark, sf_dir):
    plan = mix_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
