"""Equi-joins that hold when one key carries a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from palimpsest.session import stored

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 * 1024 * 1024
HOT_ROWS = 1_000_000
SALTS = 64


def fits_broadcast(side: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether ``side`` is small enough to send to every executor: one pass, of which each task returns two numbers."""
    measured = side.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0)).alias("size"),
    ).first()
    return measured["rows"] <= rows and measured["size"] <= size


def dimension_join(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    how: str = "inner",
    rows: int = BROADCAST_ROWS,
    hot: dict | None = None,
    spread_by: list[str] | None = None,
) -> DataFrame:
    """Join to a dimension on a shared column: broadcast once its size is checked, an ordinary join otherwise.

    The dimension is stored first, so that neither the check nor the join computes it anew.
    """
    dimension = stored(dimension, "dimension")
    if fits_broadcast(dimension, rows):
        return facts.join(F.broadcast(dimension), key, how)
    return salted_join(facts, dimension, key, how, hot, spread_by)


def hot_keys_of(rows: DataFrame, key: str | Column, hot_rows: int = HOT_ROWS) -> dict:
    """Keys with about ``hot_rows`` rows or more and their number of rows.

    A frequent-items sketch per input task, merged: no shuffle of the keys. It finds every key above 1/10,000 of
    the rows, and what it finds only steers how rows are spread. It is a pass over ``rows``: take it on a stored
    table.
    """
    column = F.col(key) if isinstance(key, str) else key
    sketch = F.call_function("approx_top_k", column, F.lit(10_000), F.lit(40_000))
    top = rows.agg(sketch.alias("top")).first()["top"]
    return {t["item"]: t["count"] for t in top if t["item"] is not None and t["count"] >= hot_rows}


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str | list[str],
    how: str = "left",
    hot: dict | None = None,
    spread_by: list[str] | None = None,
    task_rows: int = HOT_ROWS,
) -> DataFrame:
    """Inner or left join; it looks at no data before it runs.

    NULL keys are spread over ``SALTS`` tasks, and adaptive execution splits what is skewed. Where that is not
    enough, as under operators that need all rows of a key together, the caller names the ``hot`` keys of the left
    side with their rows (``hot_keys_of``): each is dealt out over a task for every ``task_rows`` of its rows, and
    only its rows on the right are repeated as often. The salt comes from the row's own values, so a recomputed
    task gives the same. Several key columns are looked up by their hash; the join itself is on the columns.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type: {how}")
    keys = [key] if isinstance(key, str) else key
    if not hot:
        return left.join(right, keys) if how == "inner" else join_spreading_nulls(left, right, keys, how)
    missing = F.col(keys[0]).isNull()
    identity = key_identity(keys)
    parts = {k: -(-n // task_rows) for k, n in hot.items()}
    listed = F.create_map(*[F.lit(x) for pair in parts.items() for x in pair])
    salts = F.when(missing, F.lit(SALTS)).otherwise(F.coalesce(F.try_element_at(listed, identity), F.lit(1)))
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(*(spread_by or spread_columns(left))), salts).cast("int"))
    repeated = right.filter(~missing).withColumn("_salt", F.explode(F.sequence(F.lit(0), salts.cast("int") - 1)))
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")


def key_identity(keys: list[str]) -> Column:
    """What ``hot_keys_of`` looks at for a join on these columns: the column itself, or the hash of several."""
    return F.col(keys[0]) if len(keys) == 1 else F.when(F.col(keys[0]).isNotNull(), F.xxhash64(*keys))


def spread_columns(rows: DataFrame) -> list[str]:
    """Columns whose hash tells rows apart at little cost: the whole numbers, or all if there are none."""
    whole = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.IntegralType)]
    plain = [f.name for f in rows.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return whole if len(whole) > 1 else plain


def join_spreading_nulls(
    left: DataFrame, right: DataFrame, keys: list[str], how: str = "left", salts: int = SALTS
) -> DataFrame:
    """Left or anti join in which left rows with a NULL first key match nothing but still spread over tasks.

    They would all hash to one partition otherwise. Rows with a key have salt 0 on both sides; on the right it
    is computed, as a literal would be folded out of the join keys.
    """
    missing = F.col(keys[0]).isNull()
    spread = F.when(missing, F.pmod(F.xxhash64(*spread_columns(left)), F.lit(salts))).otherwise(
        F.lit(0).cast("bigint")
    )
    zero = F.pmod(F.xxhash64(*keys), F.lit(1))
    joined = left.withColumn("_salt", spread).join(right.withColumn("_salt", zero), [*keys, "_salt"], how)
    return joined.drop("_salt")
