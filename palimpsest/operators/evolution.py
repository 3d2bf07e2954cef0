"""A log whose columns come, go and change their type from batch to batch, read under one schema.

Batches of one schema share a folder, ``<root>/schema=<id>/batch=<name>``, and a ledger beside the log lists the columns
of each schema. A read takes every folder under the schema it was written with and casts to the widest type a column
has had: whole numbers before longer ones, these before floating point, and text, which takes all, last. Schemas are
few however many batches there are.
"""

from __future__ import annotations

import functools
import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from palimpsest.sources import generations
from palimpsest.sources.landing import BATCH, read_or_empty

# The widening order.
WIDENING = ["int", "bigint", "double", "string"]
COLUMNS = "schema_id string, position int, column string, kind string"


def schema_id(schema: T.StructType) -> str:
    return hashlib.sha256(schema.simpleString().encode()).hexdigest()[:16]


def columns_path(root: str) -> str:
    return f"{root.rstrip('/')}_columns"


def widest(kinds: list[str]) -> str:
    """The type that takes values of all these: the last in the widening order, text where types have nothing in common."""
    if len(set(kinds)) == 1:
        return kinds[0]
    return max(kinds, key=WIDENING.index) if set(kinds) <= set(WIDENING) else "string"


def append_batches(records: DataFrame, root: str, batch: str = BATCH) -> None:
    """Write all batches of ``records``; one written before is replaced, whatever its columns were."""
    spark = records.sparkSession
    payload = T.StructType([f for f in records.schema.fields if f.name != batch])
    own = schema_id(payload)
    listed = [(own, i, f.name, f.dataType.simpleString()) for i, f in enumerate(payload.fields)]
    ledger = spark.createDataFrame(listed, COLUMNS).coalesce(1).drop("schema_id")
    ledger.write.mode("overwrite").parquet(f"{columns_path(root)}/schema_id={own}")
    named = records.withColumn(BATCH, F.col(batch).cast("string"))
    if batch != BATCH:
        named = named.drop(batch)
    named.hint("rebalance", F.col(BATCH)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        BATCH
    ).parquet(f"{root}/schema={own}")
    # Earlier deliveries of these batches under other schemas go: a file operation for each.
    others = [s for s in schemas(spark, root) if s != own]
    if others:
        for (name,) in named.select(BATCH).distinct().toLocalIterator():
            for other in others:
                folder, files = generations.file_system(spark, f"{root}/schema={other}/{BATCH}={name}")
                files.delete(folder, True)


def schemas(spark: SparkSession, root: str) -> dict[str, list[tuple[str, str]]]:
    """(column, type) lists of the schemas that the log has been written with."""
    ledger = read_or_empty(spark, columns_path(root), T.StructType.fromDDL(COLUMNS))
    found: dict[str, list] = {}
    for r in ledger.orderBy("schema_id", "position").collect():
        found.setdefault(r["schema_id"], []).append((r["column"], r["kind"]))
    return found


def unified(found: dict[str, list[tuple[str, str]]]) -> dict[str, str]:
    """Every column with its widest type."""
    kinds: dict[str, list[str]] = {}
    for columns in found.values():
        for column, kind in columns:
            kinds.setdefault(column, []).append(kind)
    return {column: widest(every) for column, every in sorted(kinds.items())}


def as_kind(column, before: str, kind: str):
    """A value under its widest type; what is no plain value becomes JSON text."""
    nested = before.startswith(("array", "struct", "map"))
    return F.to_json(column) if nested and kind == "string" else column.cast(kind)


def read_log(spark: SparkSession, root: str) -> DataFrame:
    """All batches under one schema; columns that a batch lacks are NULL there."""
    found = schemas(spark, root)
    kinds = unified(found)
    if not found:
        raise LookupError(f"nothing was written to {root}")
    parts = []
    for own, columns in found.items():
        schema = T.StructType([T.StructField(c, T.DataType.fromDDL(k)) for c, k in columns] + [T.StructField(BATCH, T.StringType())])
        had, rows = dict(columns), read_or_empty(spark, f"{root}/schema={own}", schema)
        chosen = [
            (as_kind(F.col(f"`{c}`"), had[c], k) if c in had else F.lit(None).cast(k)).alias(c) for c, k in kinds.items()
        ]
        parts.append(rows.select(*chosen, BATCH))
    return functools.reduce(DataFrame.unionByName, parts)
