"""First record per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def keep_first(records: DataFrame, keys: list[str | Column], order: list[str | Column]) -> DataFrame:
    """The first record of each key in ``order``; NULL keys form one group.

    Catalyst limits each group to one row before the shuffle as well (``WindowGroupLimit``), so a key that
    holds a large share of the rows sends one row per input task.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return records.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")
