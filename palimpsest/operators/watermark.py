"""High-water marks, ingest windows and date chunks."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from palimpsest.operators.joins import spread_columns
from palimpsest.operators.known import unknown

# First-run window in 30-day months per feed, and the days after its start that a chunk spans.
FIRST_RUN_MONTHS = {"votings": 3, "propositions": 12}
DAYS_PER_MONTH = 30
CHUNK_DAYS = 90


def newer_than(records: DataFrame, stamp: str, mark: str | Column | None, inclusive: bool = False) -> DataFrame:
    """Records whose ISO text stamp is greater than the mark; no mark keeps all of them.

    A missing stamp counts as empty text and so is never newer. The bare comparison says the same and reaches
    the Parquet scan.
    """
    if mark is None:
        return records
    if isinstance(mark, Column):
        newer = F.col(stamp) >= mark if inclusive else F.col(stamp) > mark
        return records.filter(mark.isNull() | newer)
    return records.filter(F.col(stamp) >= mark if inclusive else F.col(stamp) > mark)


def newer_or_unknown(records: DataFrame, stamp: str, mark: str | None, known: DataFrame, key: str) -> DataFrame:
    """Keeps the mark's own instant as well and drops the ids already known, so no record of it is missed."""
    return unknown(newer_than(records, stamp, mark, inclusive=True), known, key)


def candidate_mark(stamp: str) -> Column:
    """Largest non-empty stamp; NULL if there is none. Use inside an aggregate."""
    return F.max(F.nullif(F.col(stamp), F.lit("")))


def advance_mark(previous: Column, candidate: Column) -> Column:
    """The later of the two marks; a mark never goes back and NULL never replaces one."""
    return F.greatest(previous, candidate)


def ingest_window(mark: str | None, months: int, today: date) -> tuple[date, date]:
    """First and last day to ask for: the mark's day, or ``months`` 30-day months back on a first run."""
    start = date.fromisoformat(mark[:10]) if mark else today - timedelta(days=months * DAYS_PER_MONTH)
    return start, today


def window_start(mark: Column, months: int, today: Column) -> Column:
    """``ingest_window`` on columns."""
    return F.coalesce(F.to_date(F.substring(mark, 1, 10)), F.date_sub(today, months * DAYS_PER_MONTH))


def in_window(records: DataFrame, stamp: str, start: date, end: date) -> DataFrame:
    """Records of the days ``start`` to ``end``, both included.

    A half-open range on the stored column, not a cast of it, so the scan can skip row groups. It suits
    timestamps as well as ISO text.
    """
    after = end + timedelta(days=1)
    if dict(records.dtypes)[stamp] == "string":
        return records.filter((F.col(stamp) >= start.isoformat()) & (F.col(stamp) < after.isoformat()))
    return records.filter((F.col(stamp) >= F.lit(start)) & (F.col(stamp) < F.lit(after)))


def in_days(records: DataFrame, day: str, first: date | Column, last: date | Column) -> DataFrame:
    """Records of the days ``first`` to ``last`` by a partition column, both included: other days are not read.

    A bound may be a scalar subquery, as ``window_start`` of a ledger's mark: the scan then prunes when it runs.
    """
    bounds = [b if isinstance(b, Column) else F.lit(b) for b in (first, last)]
    kind = records.schema[day].dataType
    return records.filter((F.col(day) >= bounds[0].cast(kind)) & (F.col(day) <= bounds[1].cast(kind)))


def date_chunks(ranges: DataFrame, start: str, end: str, days: int = CHUNK_DAYS) -> DataFrame:
    """Adjacent windows of ``days`` + 1 days that tile [start, end]; an inverted range gives none."""
    first = F.expr(f"sequence({start}, {end}, interval {days + 1} days)")
    return (
        ranges.filter(F.col(start) <= F.col(end))
        .withColumn("chunk_start", F.explode(first))
        .withColumn("chunk_end", F.least(F.date_add("chunk_start", days), F.col(end)))
    )


def with_chunk(records: DataFrame, day: Column, start: date, end: date, days: int = CHUNK_DAYS) -> DataFrame:
    """Records of [start, end] with the window they fall in: arithmetic per row instead of a range join."""
    elapsed = F.floor(F.date_diff(day, F.lit(start)) / F.lit(days + 1)).cast("int") * (days + 1)
    return (
        records.filter(day.between(F.lit(start), F.lit(end)))
        .withColumn("chunk_start", F.date_add(F.lit(start), elapsed))
        .withColumn("chunk_end", F.least(F.date_add("chunk_start", days), F.lit(end)))
    )


def oldest(records: DataFrame, stamp: str, rows: int, tie_breaker: str) -> DataFrame:
    """Capped trial run. Oldest first, so that the mark covers exactly what was taken."""
    return records.orderBy(F.asc(stamp), F.asc(tie_breaker)).limit(rows)


def listing(records: DataFrame, *order: str) -> DataFrame:
    """Ordered source list, ascending. A last key without meaning lets rows of one frequent value be split."""
    return records.orderBy(*[F.asc(c) for c in order], F.xxhash64(*spread_columns(records)))
