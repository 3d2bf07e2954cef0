"""Nearest topic by cosine similarity.

The topics are a small dimension; the vectors are the large side and are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from palimpsest.functions.vectors import NORM_FLOOR, cosine
from palimpsest.session import stored

# Topics per scalar subquery or matrix product; a longer list is taken in several blocks.
BLOCK = 1024


def similarities(rows: DataFrame, vector: str, topics: DataFrame, name: str = "scores") -> DataFrame:
    """Cosine similarity of each row to each topic, as one array per row in topic order."""
    listed = topics.agg(F.sort_array(F.collect_list(F.struct("ord", "vector")))).scalar()
    with_list = rows.withColumn("_topics", listed)
    return with_list.withColumn(
        name, F.transform("_topics", lambda t: cosine(F.col(vector), t["vector"]))
    ).drop("_topics")


def nearest_topic(
    rows: DataFrame,
    vector: str,
    topics: DataFrame,
    label: str = "topic",
    score: str = "score",
    method: str = "matrix",
    block: int = BLOCK,
) -> DataFrame:
    """Best topic and its score per row; of equal scores the topic with the lower ``ord`` wins.

    ``topics`` has ``ord``, ``topic`` and ``vector`` and is computed once. ``matrix`` multiplies Arrow batches
    with the normalised topics; ``columns`` stays in the JVM, row by row.
    """
    if method not in ("matrix", "columns"):
        raise ValueError(f"unknown method: {method}")
    if method == "matrix":
        listed = topics.orderBy("ord").collect()
        parts = [listed[at : at + block] for at in range(0, len(listed), block)]
        best = [_best_by_matrix(vector, part) for part in parts]
    else:
        kept = stored(topics.select("ord", "topic", "vector"), "topics")
        span = kept.agg(F.min("ord"), F.max("ord")).first()
        starts = range(span[0], span[1] + 1, block) if span[0] is not None else []
        lists = {f"_topics{i}": _listed(kept.filter(F.col("ord").between(at, at + block - 1))) for i, at in enumerate(starts)}
        rows = rows.withColumns(lists)
        best = [_best_by_columns(vector, name) for name in lists]
    if not best:
        raise ValueError("no topics")
    winner = F.greatest(*best) if len(best) > 1 else best[0]
    return (
        rows.withColumn("_best", F.when(F.col(vector).isNotNull(), winner))
        .withColumns({label: F.col("_best.topic"), score: F.col("_best.score")})
        .drop("_best", *[c for c in rows.columns if c.startswith("_topics")])
    )


def _ranked(score: Column, order: Column, topic: Column) -> Column:
    """Struct whose natural order is the ranking: score, then earlier topic."""
    return F.struct(score.alias("score"), (-order).alias("earlier"), topic.alias("topic"))


def _listed(topics: DataFrame) -> Column:
    """The topics of a block as one array: a scalar subquery, evaluated once."""
    return topics.agg(F.collect_list(F.struct("ord", "topic", "vector"))).scalar()


def _best_by_columns(vector: str, listed: str) -> Column:
    return F.array_max(
        F.transform(listed, lambda t: _ranked(cosine(F.col(vector), t["vector"]), t["ord"], t["topic"]))
    )


def _best_by_matrix(vector: str, listed: list) -> Column:
    distinct: dict[tuple, int] = {}
    for position, row in enumerate(listed):
        # An equal vector further down the list can never win.
        distinct.setdefault(tuple(row["vector"]), position)
    winners = [listed[position] for position in distinct.values()]
    targets = [list(v) for v in distinct]
    orders, names = [-row["ord"] for row in winners], [row["topic"] for row in winners]
    floor = NORM_FLOOR

    def search(vectors):
        import numpy as np
        import pyarrow as pa

        kinds = {"score": pa.float64(), "earlier": pa.int32(), "topic": pa.string()}
        known = vectors.drop_null()
        wanted = np.asarray(targets, dtype=np.float64)
        if len(known) == 0:
            return pa.nulls(len(vectors), pa.struct(list(kinds.items())))
        values = known.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        matrix = values.reshape(len(known), wanted.shape[1])
        matrix = matrix / (np.linalg.norm(matrix, axis=1, keepdims=True) + floor)
        wanted = wanted / (np.linalg.norm(wanted, axis=1, keepdims=True) + floor)
        scores = matrix @ wanted.T
        winner = scores.argmax(axis=1)
        present = vectors.is_valid().to_numpy(zero_copy_only=False)
        place = np.zeros(len(vectors), dtype=np.int64)
        score = np.zeros(len(vectors), dtype=np.float64)
        place[present] = winner
        score[present] = scores[np.arange(len(known)), winner]
        found = [pa.array(score), pa.array(orders, pa.int32()).take(place), pa.array(names, pa.string()).take(place)]
        return pa.StructArray.from_arrays(found, names=list(kinds), mask=pa.array(~present))

    return F.arrow_udf(search, "score double, earlier int, topic string")(F.col(vector))
