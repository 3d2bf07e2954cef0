"""Type-2 history without updates.

A history table is an append-only log of versions: payload, batch and load time. Which version is current is
derived from the log, so a reload is idempotent, many batches load in one job, and a point-in-time query is
the same derivation on a shorter log.

* snapshot: the rows of the last batch are current;
* delta: the rows of a key's own last batch are current, and rows without a key never expire;
* overwrite: only the last batch is kept.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from palimpsest.operators.joins import dimension_join, join_spreading_nulls, salted_join, spread_columns

LOADED_AT = "loaded_at"


def stamp(records: DataFrame, source_file: str | Column, loaded_at: datetime | Column) -> DataFrame:
    """Load metadata: one instant and one file name per batch. Currency is derived, not stored."""
    instant = loaded_at if isinstance(loaded_at, Column) else F.lit(loaded_at)
    name = source_file if isinstance(source_file, Column) else F.lit(source_file)
    return records.withColumns({LOADED_AT: instant.cast("timestamp"), "source_file": name})


def current_snapshot(versions: DataFrame, batch: str) -> DataFrame:
    """Rows of the last batch. The batch is a scalar subquery, so a log partitioned by it is pruned."""
    return versions.filter(F.col(batch) == versions.agg(F.max(batch)).scalar())


def current_delta(versions: DataFrame, pk: str, batch: str, ordinal: str | None = None) -> DataFrame:
    """Rows of each key's last batch; with ``ordinal`` only the first of them, which folds the de-duplication in.

    One shuffle. Both rankings are cut to their first rank before it, so superseded versions of a hot key are
    dropped where they are read. Rows without a key never expire and are spread instead of sharing one group.
    Without ``ordinal`` a key should occur once per batch, as it does after the transforms: all its rows of the
    last batch are kept, and meet in one task.
    """
    keyless = F.col(pk).isNull()
    groups = [F.col(pk), F.when(keyless, F.col(batch))]
    if ordinal:
        order = Window.partitionBy(*groups).orderBy(F.desc(batch), F.asc(ordinal))
        return versions.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")
    groups.append(F.when(keyless, F.xxhash64(*spread_columns(versions))))
    order = Window.partitionBy(*groups).orderBy(F.desc(batch))
    return versions.withColumn("_rank", F.rank().over(order)).filter("_rank = 1").drop("_rank")


def flag_current(versions: DataFrame, pk: str, batch: str, strategy: str) -> DataFrame:
    """All versions with ``is_current``, as the updated table would show it."""
    if strategy == "snapshot":
        return versions.withColumn("is_current", F.col(batch) == versions.agg(F.max(batch)).scalar())
    if strategy != "delta":
        raise ValueError(f"no history under strategy {strategy}")
    keyed = versions.filter(F.col(pk).isNotNull())
    heads = keyed.groupBy(pk).agg(F.max(batch).alias(batch)).withColumn("_head", F.lit(True))
    # Joining on key and batch, not on the key alone, spreads a hot key over its batches. A key repeated within
    # one batch, which transformed rows do not have, is salted.
    flagged = salted_join(versions, heads, [pk, batch])
    return flagged.withColumn("is_current", F.col("_head").isNotNull() | F.col(pk).isNull()).drop("_head")


def with_validity(versions: DataFrame, pk: str, batch: str, strategy: str) -> DataFrame:
    """All versions with ``valid_from``, ``valid_to`` (NULL while current) and ``is_current``.

    The next load is looked up on (key, batch) pairs, at most one per key and load run, and joined back on
    both columns, so no group grows with the rows of a key.
    """
    opened = versions.withColumn("valid_from", F.col(LOADED_AT))
    if strategy == "snapshot":
        # One row per load run, so the window over all of them stays small.
        loads = versions.groupBy(batch).agg(F.min(LOADED_AT).alias("_loaded"))
        following = loads.select(batch, F.lead("_loaded").over(Window.orderBy(batch)).alias("valid_to"))
        closed = dimension_join(opened, following, batch, "left")
        return closed.withColumn("is_current", F.col("valid_to").isNull())
    if strategy != "delta":
        raise ValueError(f"no history under strategy {strategy}")
    keyed = versions.filter(F.col(pk).isNotNull())
    loads = keyed.groupBy(pk, batch).agg(F.min(LOADED_AT).alias("_loaded"))
    following = loads.select(
        pk, batch, F.lead("_loaded").over(Window.partitionBy(pk).orderBy(batch)).alias("valid_to")
    )
    closed = salted_join(opened, following, [pk, batch])
    return closed.withColumn("is_current", F.col("valid_to").isNull())


def as_of(versions: DataFrame, pk: str, batch: str, strategy: str, instant: Column) -> DataFrame:
    """The rows that were current at ``instant``."""
    known = versions.filter(F.col(LOADED_AT) <= instant)
    return current_snapshot(known, batch) if strategy == "snapshot" else current_delta(known, pk, batch)


def advance_current(current: DataFrame, batch: DataFrame, pk: str) -> DataFrame:
    """Current rows after a delta batch, from those before it: the merge form, for a compacted current table.

    Cost follows the current table and the batch, not the log. NULL keys match nothing and stay.
    """
    touched = batch.filter(F.col(pk).isNotNull()).select(pk).distinct()
    untouched = join_spreading_nulls(current, touched, [pk], "left_anti")
    return untouched.unionByName(batch, allowMissingColumns=True)


def extend_schema(older: DataFrame, newer: DataFrame) -> DataFrame:
    """Both logs under one schema; columns that one of them lacks are NULL there."""
    return older.unionByName(newer, allowMissingColumns=True)


def keyless_count(versions: DataFrame, pk: str) -> DataFrame:
    """Quality measure: versions without a key, which no delta load can expire."""
    return versions.agg(F.count(F.lit(1)).alias("versions"), F.count_if(F.col(pk).isNull()).alias("without_key"))
