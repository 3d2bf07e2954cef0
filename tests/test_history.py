"""Derived currency against a table that is really updated, on random batches."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from palimpsest.operators import history
from tests.conftest import tuples

START = datetime(2024, 1, 1)
SCHEMA = "case int, n int, pk int, batch int, loaded_at timestamp"


def random_batches(seed, duplicates):
    """Per batch a list of keys, some NULL, some twice if ``duplicates``."""
    rng = random.Random(seed)
    keys = [None, *range(6)]
    batches = []
    for _ in range(6):
        pick = rng.choices(keys, k=rng.randint(1, 6)) if duplicates else rng.sample(keys, rng.randint(1, 6))
        batches.append(pick)
    return batches


def replay(batches, strategy):
    """Expire, then insert, batch by batch: [n, pk, batch, from, to]."""
    table, n = [], 0
    for number, keys in enumerate(batches):
        at = START + timedelta(days=number)
        for row in table:
            if row[4] is None and (strategy == "snapshot" or (row[1] is not None and row[1] in keys)):
                row[4] = at
        for key in keys:
            table.append([n, key, number, at, None])
            n += 1
    return table


@pytest.mark.parametrize("strategy", ["snapshot", "delta"])
@pytest.mark.parametrize("duplicates", [False, True])
def test_derivations_equal_updates(spark, strategy, duplicates):
    models = {case: replay(random_batches(case, duplicates), strategy) for case in range(60)}
    log = spark.createDataFrame([(c, r[0], r[1], r[2], r[3]) for c, t in models.items() for r in t], SCHEMA)
    # Cases are independent tables: with delta they share one log under a compound key.
    if strategy == "delta":
        keyed = log.withColumn("key", F.when(F.col("pk").isNotNull(), F.col("case") * 100 + F.col("pk")))
        tables = [(keyed, models, "key")]
    else:
        tables = [(log.filter(F.col("case") == c), {c: models[c]}, "pk") for c in range(4)]
    for rows, cases, pk in tables:
        wanted = sorted((c, r[0], r[4] is None) for c, t in cases.items() for r in t)
        assert sorted(tuples(history.flag_current(rows, pk, "batch", strategy), "case", "n", "is_current")) == wanted
        valid = history.with_validity(rows, pk, "batch", strategy)
        spans = sorted((c, r[0], r[3], r[4] or datetime.max) for c, t in cases.items() for r in t)
        got = [(a, b, c, d or datetime.max) for a, b, c, d in tuples(valid, "case", "n", "valid_from", "valid_to")]
        assert sorted(got) == spans
        current = (
            history.current_snapshot(rows, "batch")
            if strategy == "snapshot"
            else history.current_delta(rows, pk, "batch")
        )
        assert sorted(tuples(current, "case", "n")) == [(c, n) for c, n, now in wanted if now]
        at = START + timedelta(days=2, hours=1)
        past = history.as_of(rows, pk, "batch", strategy, F.lit(at))
        assert sorted(tuples(past, "case", "n")) == [(c, n) for c, n, a, b in spans if a <= at < b]


def test_first_of_last_batch_in_one_ranking(spark):
    rows = spark.createDataFrame(
        [(1, 1, 0), (1, 2, 5), (1, 2, 3), (None, 1, 7), (None, 1, 8), (None, 2, 1)], "pk int, batch int, ordinal int"
    )
    assert tuples(history.current_delta(rows, "pk", "batch", "ordinal")) == [(1, 2, 3), (None, 1, 7), (None, 2, 1)]


def test_merge_form_equals_derivation(spark):
    batches = random_batches(5, False)
    log = spark.createDataFrame(
        [(0, i * 10 + j, k, i, START + timedelta(days=i)) for i, b in enumerate(batches) for j, k in enumerate(b)], SCHEMA
    )
    table = log.filter("batch = 0")
    for number in range(1, len(batches)):
        table = history.advance_current(table, log.filter(F.col("batch") == number), "pk")
    assert tuples(table, "n", "pk") == tuples(history.current_delta(log, "pk", "batch"), "n", "pk")


def test_loading_a_batch_again_changes_nothing(spark, tmp_path):
    from palimpsest.sources import landing

    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "batch string, pk int")
    for _ in range(2):
        landing.append_batches(rows, str(tmp_path / "log"))
    log = landing.read_batches(spark, str(tmp_path / "log"), rows.drop("batch").schema)
    assert tuples(log, "batch", "pk") == [("a", 1), ("a", 2), ("b", 1)]


def test_unknown_strategy_is_refused(spark):
    with pytest.raises(ValueError):
        history.flag_current(spark.range(1), "id", "id", "merge")
