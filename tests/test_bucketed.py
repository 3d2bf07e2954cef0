"""Bucketed history against the derived one, and the shape of its plans."""

import random
import re

import pytest
from pyspark.sql import functions as F

from palimpsest.operators import bucketed, history
from palimpsest.operators.bucketed import Buckets
from tests.conftest import plan_of, tuples

BUCKETS = Buckets("pk", 5)
COLUMNS = ["pk", "what", "batch"]


def versions(seed, batches=6):
    rng = random.Random(seed)
    return [
        (None if k == 0 else f"k{k}", f"{b}-{k}", f"d{b}")
        for b in range(batches)
        for k in rng.sample(range(30), rng.randint(1, 12))
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, "pk string, what string, batch string")


@pytest.fixture(autouse=True)
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def exchanges(rows):
    return len(re.findall(r"^\(\d+\) Exchange", plan_of(rows), re.M))


@pytest.mark.parametrize("seed", [1, 2])
def test_log_in_buckets_gives_the_derived_currency(spark, tmp_path, seed):
    rows, path = versions(seed), str(tmp_path / "log")
    log = frame(spark, rows)
    bucketed.append_batches(log.where("batch < 'd3'"), path, BUCKETS, "batch")
    bucketed.append_batches(log.where("batch >= 'd3'"), path, BUCKETS, "batch")
    keyed, keyless = bucketed.open_log(spark, path, log.schema, BUCKETS, "batch")
    current = bucketed.current_of_log(keyed, keyless, "pk", "batch")
    assert tuples(current, *COLUMNS) == tuples(history.current_delta(log, "pk", "batch"), *COLUMNS)
    flags = bucketed.flags_of_log(keyed, keyless, "pk", "batch")
    assert tuples(flags, *COLUMNS, "is_current") == tuples(history.flag_current(log, "pk", "batch", "delta"), *COLUMNS, "is_current")
    assert exchanges(current) == exchanges(flags) == 0
    assert "Bucketed: true" in plan_of(current)


def test_a_batch_written_again_replaces_its_rows(spark, tmp_path):
    path = str(tmp_path / "log")
    bucketed.append_batches(frame(spark, [("a", "1", "d1"), (None, "x", "d1"), ("a", "2", "d2")]), path, BUCKETS, "batch")
    bucketed.append_batches(frame(spark, [("a", "3", "d2"), (None, "y", "d1")]), path, BUCKETS, "batch")
    keyed, keyless = bucketed.open_log(spark, path, frame(spark, []).schema, BUCKETS, "batch")
    assert tuples(keyed, "pk", "what") == [("a", "1"), ("a", "3")]
    assert tuples(keyless, "what") == [("y",)]


def test_the_current_table_moves_on_batch_by_batch(spark, tmp_path):
    rows, root = versions(7, 8), str(tmp_path / "current")
    log = frame(spark, rows)
    bucketed.start_current(log.where("batch = 'd0'"), root, BUCKETS)
    opened = bucketed.open_current(spark, root, log.schema, BUCKETS)[0]
    first = tuples(opened)
    for b in range(1, 8):
        bucketed.advance_current(spark, root, log.where(f"batch = 'd{b}'"), BUCKETS)
        keyed, keyless = bucketed.open_current(spark, root, log.schema, BUCKETS)
        wanted = history.current_delta(log.where(f"batch <= 'd{b}'"), "pk", "batch")
        assert tuples(keyed.unionByName(keyless), *COLUMNS) == tuples(wanted, *COLUMNS)
    assert tuples(opened) == first  # two generations back would be gone from the pointer, not from a reader


def test_only_the_batch_is_shuffled(spark, tmp_path):
    root = str(tmp_path / "current")
    log = frame(spark, versions(3))
    bucketed.start_current(history.current_delta(log, "pk", "batch"), root, BUCKETS)
    log.where("batch = 'd5'").write.parquet(str(tmp_path / "batch"))
    batch = spark.read.parquet(str(tmp_path / "batch"))
    keyed, _ = bucketed.open_current(spark, root, log.schema, BUCKETS)
    plan = plan_of(bucketed.untouched(keyed, batch, BUCKETS))
    assert len(re.findall(r"^\(\d+\) Exchange", plan, re.M)) == 1
    # The join's left side, printed first, reaches its scan without an exchange.
    tree = plan.split("(1) ")[0]
    assert "Exchange" not in tree[tree.index("Join") : tree.index("Scan parquet")]


def test_files_stay_as_many_as_buckets(spark, tmp_path):
    root = str(tmp_path / "current")
    rows = spark.range(2000).select(F.col("id").cast("string").alias("pk"), F.lit("x").alias("what"), F.lit("d0").alias("batch"))
    bucketed.start_current(rows, root, BUCKETS)
    for b in (1, 2):
        bucketed.advance_current(spark, root, rows.limit(50).withColumn("batch", F.lit(f"d{b}")), BUCKETS)
    current = sorted((tmp_path / "current" / "generations").iterdir())[-1]
    assert len(list((current / "keyed").glob("*.parquet"))) <= 2 * BUCKETS.number


def test_empty_batches_and_tables(spark, tmp_path):
    root = str(tmp_path / "current")
    nothing = frame(spark, [])
    bucketed.start_current(nothing, root, BUCKETS)
    bucketed.advance_current(spark, root, frame(spark, [("a", "1", "d1")]), BUCKETS)
    bucketed.advance_current(spark, root, nothing, BUCKETS)
    keyed, keyless = bucketed.open_current(spark, root, nothing.schema, BUCKETS)
    assert tuples(keyed, "pk") == [("a",)] and keyless.count() == 0
