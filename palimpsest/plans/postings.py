"""Keyword search over an index of letter triples, so that a search reads the rows that can match and not all.

The index holds, for every triple of characters, the keys of the rows that contain it, sorted by triple; and the rows
themselves, partitioned by a hash of the key. A term's rarest triples name its candidates; their partitions are read,
and the candidates are verified by the same predicate as a search without an index. Triples that a large share of the
rows contain would name most rows and fill most of the index: they are counted, but have no entries. Terms too short
for a triple, or with common ones alone, are searched without the index.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from palimpsest.operators.joins import fits_broadcast
from palimpsest.plans import adhoc
from palimpsest.session import stored
from palimpsest.sources import generations

TRIPLE = r"(?s)(?=(.{3}))"
# Folders that the triples are dealt out to, triples of a term that name its candidates, and folders of rows.
TRIPLE_PARTS = 64
PER_TERM = 4
ROW_PARTS = 256
# Share of the rows above which a triple is common.
COMMON = 1 / 16

ROWS, POSTINGS, TRIPLES = "rows", "postings", "triples"


def triples(text: Column) -> Column:
    """The distinct triples of neighbouring characters, in lower case."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TRIPLE), F.lit(1)))


def part_of(column: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(parts)).cast("int")


def index(
    rows: DataFrame, key: str, columns: list[str], root: str, parts: int = ROW_PARTS, common: float = COMMON
) -> None:
    """Build the index of ``columns`` as a new generation under ``root``; a search under way keeps the one it opened."""
    spark = rows.sparkSession
    seen, generation = generations.published(spark, root), generations.new_generation()
    place = lambda relation: generations.folder(root, generation, relation)
    dealt = rows.withColumn("_part", part_of(F.col(key), parts))
    dealt.hint("rebalance", "_part").write.partitionBy("_part").parquet(place(ROWS))
    none = F.array().cast("array<string>")
    found = F.array_distinct(F.flatten(F.array(*[F.coalesce(triples(F.col(c)), none) for c in columns])))
    entries = dealt.select(F.col(key).alias("key"), F.col("_part").alias("row_part"), F.explode(found).alias("triple"))
    folder = part_of(F.col("triple"), TRIPLE_PARTS).alias("_triples")
    sizes = entries.groupBy("triple").agg(F.count(F.lit(1)).alias("rows"))
    counted = sizes.select("triple", "rows", (F.col("rows") > common * rows.count()).alias("common"), folder)
    counted.hint("rebalance", "_triples").sortWithinPartitions("_triples", "triple").write.partitionBy("_triples").parquet(place(TRIPLES))
    # Common triples are few: no more than 1 / common times those that a row has on average.
    dropped = spark.read.schema(counted.schema).parquet(place(TRIPLES)).where("common").select("triple")
    rare = entries.join(F.broadcast(dropped), "triple", "left_anti")
    # Within a task entries are sorted, so that a search skips row groups.
    folders = rare.select("key", "row_part", "triple", folder).hint("rebalance", "_triples")
    folders.sortWithinPartitions("_triples", "triple", "key").write.partitionBy("_triples").parquet(place(POSTINGS))
    # The schemas stand beside the tables, which may have no row.
    for relation, made in ((ROWS, dealt), (POSTINGS, folders), (TRIPLES, counted)):
        made.limit(0).write.parquet(place(f"{relation}-schema"))
    generations.swap(spark, root, generation, seen)


def _open(spark: SparkSession, root: str, relation: str) -> DataFrame:
    return generations.read(spark, root, relation, generations.read(spark, root, f"{relation}-schema").schema)


def _pieces(term: str) -> list[str]:
    """The parts of a pattern that stand in a match as they are."""
    return [p for p in re.split(r"[%_\\]", term) if p]


def _chosen(spark: SparkSession, root: str, terms: list[str]) -> list[list[str]] | None:
    """The rarest triples of each term, none if one of its triples is in no row; None if a term has no rare one."""
    asked = spark.createDataFrame([(i, p) for i, t in enumerate(terms) for p in _pieces(t)], "term int, piece string")
    wanted = asked.select("term", F.explode(triples(F.col("piece"))).alias("triple")).distinct().collect()
    by_term = {i: {r.triple for r in wanted if r.term == i} for i in range(len(terms))}
    if not all(by_term.values()):
        return None
    known = _among(_open(spark, root, TRIPLES), sorted(set().union(*by_term.values())))
    sizes = {r.triple: (r.common, r.rows) for r in known.collect()}  # as many as the terms have triples
    chosen = []
    for own in by_term.values():
        rare = sorted((sizes[t][1], t) for t in own if t in sizes and not sizes[t][0])
        if own <= sizes.keys() and not rare:
            return None
        chosen.append([t for _, t in rare[:PER_TERM]] if own <= sizes.keys() else [])
    return chosen


def _among(entries: DataFrame, wanted: list[str]) -> DataFrame:
    """Entries of the triples, of which only the folders and row groups are read."""
    spark = entries.sparkSession
    parts = spark.createDataFrame([(t,) for t in wanted], "t string").select(part_of(F.col("t"), TRIPLE_PARTS)).distinct()
    return entries.where(F.col("_triples").isin([r[0] for r in parts.collect()]) & F.col("triple").isin(wanted))


def candidates(spark: SparkSession, root: str, terms: list[str]) -> DataFrame | None:
    """(key, row_part) of the rows that have all the chosen triples of a term; None if the index cannot tell."""
    chosen = _chosen(spark, root, terms)
    if chosen is None:
        return None
    entries = _open(spark, root, POSTINGS)
    found = []
    for own in chosen:
        if own:
            having = _among(entries, own).groupBy("key", "row_part").agg(F.count(F.lit(1)).alias("n"))
            found.append(having.where(F.col("n") == len(own)).select("key", "row_part"))
    if not found:
        return entries.select("key", "row_part").limit(0)
    return reduce(DataFrame.unionByName, found).distinct()


def search(spark: SparkSession, root: str, key: str, columns: list[str], terms: list[str]) -> DataFrame:
    """Rows where a column contains one of the terms, ignoring case: ``adhoc.keyword_search`` over an index.

    The candidates are stored. Few enough they are sent to the scan, which then reads their folders alone.
    """
    rows = _open(spark, root, ROWS)
    if not terms:
        return rows.drop("_part").limit(0)
    named = candidates(spark, root, terms)
    if named is not None:
        named = stored(named, "candidates").where("row_part >= 0")
        named = F.broadcast(named) if fits_broadcast(named) else named
        rows = rows.join(named, (rows["_part"] == named["row_part"]) & rows[key].eqNullSafe(named["key"]), "left_semi")
    return adhoc.keyword_search(rows, columns, terms).drop("_part")
