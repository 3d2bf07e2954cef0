"""Exact de-duplication: frequent digests are decided map-side, the rest by an ordinary shuffle.

A Misra-Gries sketch (``freqItems``: at most 1/support counters a task, merged) names every digest that holds
more than ``support`` of the rows, and maybe some that do not. The named digests are counted exactly with partial
sums; what that verifies, at most 1/support rows, is broadcast, and the copies' rows meet it where they are read.
A digest that was not named has at most ``support`` of the rows, so its group fits one task's sorted window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from palimpsest.llm.common import fold_ascii, query, table
from palimpsest.session import stored

SUPPORT = 0.001


def text_digest(text: Column) -> Column:
    """SHA-256 of the text with A-Z lower-cased; null counts as empty."""
    return F.unhex(F.sha2(fold_ascii(F.coalesce(text, F.lit(""))), 256))


def heavy_groups(rows: DataFrame, support: float) -> DataFrame:
    """Exact size and staying row of every group above ``support`` of the rows: at most 1/support groups."""
    named = rows.select(F.xxhash64("digest").alias("hash")).freqItems(["hash"], support).first()[0] or []
    hashes = rows.sparkSession.createDataFrame([(h,) for h in named], "hash bigint")
    return (
        rows.join(F.broadcast(hashes), F.xxhash64("digest") == F.col("hash"), "left_semi")
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "row_id")).alias("keep"))
        .filter("group_size > 1")
    )


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT
) -> DataFrame:
    """One row per row of ``docs``: doc_id, digest, keep_id, group_size and whether the row is kept.

    Texts are equal when they are identical after lower-casing A-Z; a null text equals the empty one. Of equal texts
    the row with the largest id stays; null is the smallest id, and of rows that also repeat the id one stays.
    An empty table gives an empty result. Other columns of ``docs`` are ignored, whatever their names.
    """
    rows = stored(
        docs.select(
            F.col(id_col).alias("doc_id"),
            text_digest(F.col(text_col)).alias("digest"),
            F.monotonically_increasing_id().alias("row_id"),
        ),
        "digests",
    )
    heavy = stored(heavy_groups(rows, support), "heavy-groups")
    frequent = rows.join(F.broadcast(heavy), "digest").select(
        "doc_id",
        "digest",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row_id") == F.col("keep.row_id")).alias("kept"),
    )
    group = Window.partitionBy("digest")
    last = group.orderBy(F.col("doc_id").desc_nulls_last(), F.col("row_id").desc())
    rare = rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti").select(
        "doc_id",
        "digest",
        F.max("doc_id").over(group).alias("keep_id"),
        F.count(F.lit(1)).over(group).alias("group_size"),
        (F.row_number().over(last) == 1).alias("kept"),
    )
    return frequent.unionByName(rare)


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; see ``exact_groups``.

    Of rows that repeat both id and text one stays, whichever columns they have besides.
    """
    kept = exact_groups(docs, id_col, text_col, support).filter("kept").select(
        F.struct("doc_id", "digest").alias("kept_row")
    )
    row = F.struct(F.col(id_col).alias("doc_id"), text_digest(F.col(text_col)).alias("digest"))
    own = [F.col(f"doc.`{c}`") for c in docs.columns]
    return (
        docs.select(F.struct("*").alias("doc"), row.alias("key"))
        .join(kept, F.col("key").eqNullSafe(F.col("kept_row")), "left_semi")
        .dropDuplicates(["key"])
        .select(*own)
    )


@query(
    """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))
         AS text_sha256
  FROM documents
)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""
)
def op3_exact_dedup(spark, sf_dir):
    groups = exact_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )
