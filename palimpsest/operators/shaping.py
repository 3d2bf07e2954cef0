"""Nested records to flat, typed columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

from palimpsest.operators.dedup import keep_first
from palimpsest.operators.joins import salted_join
from palimpsest.sources.landing import ORDINAL


def flatten(records: DataFrame, column: str, prefix: str = "", separator: str = ".") -> DataFrame:
    """Replace a struct column by its leaves, named by their path. Arrays stay whole, rows stay one to one."""

    def leaves(kind: T.DataType, path: list[str]) -> list[Column]:
        if isinstance(kind, T.StructType):
            return [leaf for field in kind.fields for leaf in leaves(field.dataType, path + [field.name])]
        source = F.col(".".join(f"`{part}`" for part in [column] + path))
        return [source.alias(prefix + separator.join(path))]

    others = [F.col(f"`{c}`") for c in records.columns if c != column]
    return records.select(*others, *leaves(records.schema[column].dataType, []))


def found_schema(records: DataFrame, text: str) -> T.DataType:
    """The schema of JSON texts as they are: one pass, of which each task returns the fields it has seen.

    Fields of several types are read as text. The driver sees field names alone.
    """
    seen = records.agg(F.schema_of_variant_agg(F.try_parse_json(text))).first()[0]
    if not seen or not seen.startswith("OBJECT"):
        return T.StructType()
    plain = re.sub(r"\bOBJECT<", "STRUCT<", re.sub(r"\b(VARIANT|VOID)\b(?=[,>]|$)", "STRING", seen))
    return T.DataType.fromDDL(plain)


def flatten_found(records: DataFrame, text: str, prefix: str = "", separator: str = ".") -> DataFrame:
    """Replace JSON text by one column for every leaf that any record has, named by its path.

    The fields need not be known. Arrays stay whole, records without a field have NULL; text that is no JSON object
    has no fields.
    """
    schema = found_schema(records, text)
    if not schema.fields:
        return records.drop(text)
    return flatten(records.withColumn(text, F.from_json(text, schema)), text, prefix, separator)


def typed(source: Column, kind: str, lenient: bool = False) -> Column:
    """Cast to ``kind``; a lenient one turns values that do not parse into NULL instead of stopping."""
    return source.try_cast(kind) if lenient else source.cast(kind)


def project(records: DataFrame, columns: list[tuple[str, str, str, bool]], keep: tuple[str, ...] = ()) -> DataFrame:
    """Select (path, name, type, lenient) entries; structs are read by path, so Parquet reads only those leaves."""
    chosen = [typed(F.col(path), kind, lenient).alias(name) for path, name, kind, lenient in columns]
    return records.select(*chosen, *keep)


def json_text(records: DataFrame) -> DataFrame:
    """Arrays, structs and maps as JSON text; other columns as they are. Non-ASCII characters stay readable."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    return records.select(
        *[
            F.to_json(F.col(f.name), {"ignoreNullFields": "false"}).alias(f.name)
            if isinstance(f.dataType, nested)
            else F.col(f.name)
            for f in records.schema.fields
        ]
    )


def merge_detail(
    summaries: DataFrame,
    details: DataFrame,
    key: str = "uri",
    identity: str = "id",
    order: list[str] | None = None,
    hot: dict | None = None,
) -> DataFrame:
    """One record ``id, summary, detail`` per summary; a summary without a detail payload keeps its row.

    The two payloads stay apart, so equal field names do not collide. ``details`` holds ``key`` and a struct
    ``detail``; only the first payload of a key counts, by ``order``, by place in its file or by its own text.
    """
    place = [ORDINAL] if ORDINAL in details.columns else [F.to_json("detail")]
    details = keep_first(details, [key], order or place)
    extra = [c for c in (ORDINAL,) if c in summaries.columns]
    payload = F.struct(*[c for c in summaries.columns if c not in extra])
    left = summaries.select(F.col(identity), F.col(key).alias("_key"), payload.alias("summary"), *extra)
    right = details.select(F.col(key).alias("_key"), "detail")
    return salted_join(left, right, "_key", "left", hot, [identity]).drop("_key")
