"""Labels carried over from history, work queues and the enrichment table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from palimpsest.operators.dedup import keep_first
from palimpsest.operators.history import LOADED_AT
from palimpsest.operators.joins import join_spreading_nulls


def latest_labelled(versions: DataFrame, pk: str, labels: list[str], batch: str) -> DataFrame:
    """Per key its latest superseded version that carries a label; load order breaks ties."""
    labelled = versions.filter(~F.col("is_current") & F.col(labels[0]).isNotNull())
    return keep_first(labelled, [pk], [F.desc(LOADED_AT), F.desc(batch)])


def inherit(versions: DataFrame, pk: str, text: str, labels: list[str], batch: str) -> DataFrame:
    """Current rows, with the labels of ``latest_labelled`` where they have none and the text is unchanged.

    ``inherited`` marks the rows that were filled. Only the latest labelled version counts, and a NULL text
    equals nothing. The join is on the key alone; the long text is compared on the joined row.
    """
    renamed = [F.col(c).alias(f"_old_{c}") for c in (text, *labels)]
    known = latest_labelled(versions, pk, labels, batch).filter(F.col(pk).isNotNull()).select(pk, *renamed)
    joined = join_spreading_nulls(versions.filter("is_current"), known, [pk])
    fill = F.col(labels[0]).isNull() & F.coalesce(F.col(text) == F.col(f"_old_{text}"), F.lit(False))
    fill = fill & F.col(f"_old_{labels[0]}").isNotNull()
    filled = {c: F.when(F.col("inherited"), F.col(f"_old_{c}")).otherwise(F.col(c)) for c in labels}
    return (
        joined.withColumn("inherited", fill).withColumns(filled).drop(*[f"_old_{c}" for c in (text, *labels)])
    )


def pending_classification(current: DataFrame, text: str, label: str) -> DataFrame:
    """Rows without a label whose text is neither NULL nor empty."""
    return current.filter(F.col(label).isNull() & (F.col(text) != ""))


def pending_summary(current: DataFrame, summary: str) -> DataFrame:
    """Rows without a summary; a row without any text is included."""
    return current.filter(F.col(summary).isNull())


def summary_input(short: str, long: str):
    """The detailed text if it is not empty, else the short one, else empty text."""
    return F.coalesce(F.nullif(F.col(long), F.lit("")), F.col(short), F.lit(""))


def with_enrichment(versions: DataFrame, enrichment: DataFrame, pk: str, batch: str) -> DataFrame:
    """Versions with their enrichment, NULL where there is none yet.

    The table is keyed by (key, batch): a newly loaded version starts without labels. Of a pair recorded
    twice the later record counts.
    """
    latest = keep_first(enrichment, [pk, batch], [F.desc("enriched_at")]).drop("enriched_at")
    return join_spreading_nulls(versions, latest, [pk, batch])
