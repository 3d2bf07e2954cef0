"""JSON arrays to rows, and rows to one column per pattern."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Case-insensitive patterns per social network column.
SOCIAL = {
    "twitter": ["%twitter.com%", "%x.com%"],
    "facebook": ["%facebook.com%"],
    "instagram": ["%instagram.com%"],
}


def any_ilike(value: Column, patterns: list[str]) -> Column:
    """Whether the text matches one of the patterns, ignoring case."""
    return reduce(lambda a, b: a | b, [value.ilike(p) for p in patterns])


def json_strings(text: str) -> Column:
    """Array in a JSON text; NULL, ``null``, ``[]`` and empty text give none, and so does a JSON object."""
    return F.from_json(F.col(text), "array<string>")


def unnest_outer(rows: DataFrame, array: Column, name: str = "url") -> DataFrame:
    """One row per element. A row without elements stays, with NULL."""
    return rows.select("*", F.explode_outer(array).alias(name))


def pivot_max(rows: DataFrame, key: str, value: str, patterns: dict[str, list[str]]) -> DataFrame:
    """Largest matching value per key and pattern. Partial maxima are formed before the shuffle."""
    return rows.groupBy(key).agg(
        *[F.max(F.when(any_ilike(F.col(value), p), F.col(value))).alias(name) for name, p in patterns.items()]
    )


def fold_max(array: Column, patterns: dict[str, list[str]]) -> list[Column]:
    """The same per row of an array column, with no explode and no shuffle."""

    def largest(p: list[str]) -> Column:
        return F.array_max(F.filter(array, lambda url: any_ilike(url, p)))

    return [largest(p).alias(name) for name, p in patterns.items()]


def pivot_arrays(rows: DataFrame, key: str, array: Column, patterns: dict[str, list[str]]) -> DataFrame:
    """Largest match per key over all its rows' arrays: folded per row first, so the shuffle carries no arrays."""
    folded = rows.select(key, *fold_max(array, patterns))
    found = reduce(lambda a, b: a | b, [F.col(name).isNotNull() for name in patterns])
    return (
        folded.filter(F.col(key).isNotNull() & found)
        .groupBy(key)
        .agg(*[F.max(name).alias(name) for name in patterns])
    )
