"""Currency kept by state against currency derived from the log."""

import random
from itertools import count

import pytest
from pyspark.sql import functions as F

from palimpsest.operators import history
from palimpsest.streaming import currency, runs
from tests.conftest import tuples

SCHEMA = "pk string, batch string, at long, what string"


class Land:
    """Micro-batches as files, one a trigger."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.number = spark, folder, count()
        self.schema = spark.createDataFrame([], SCHEMA).schema

    def add(self, rows):
        n = next(self.number)
        frame = self.spark.createDataFrame(rows, self.schema)
        frame.coalesce(1).write.parquet(str(self.folder / "landed" / f"f{n}"))

    def drain(self):
        files = runs.stream_files(self.spark, str(self.folder / "landed" / "*"), self.schema, "parquet", 1)
        changes = currency.change_stream(files.select(self.schema.names), "pk", "batch", "at")
        path = str(self.folder / "changes")
        currency.keep_currency(changes, path, str(self.folder / "state")).awaitTermination()
        return currency.read_changes(self.spark, path)


def derived(spark, rows):
    log = spark.createDataFrame(rows, SCHEMA)
    return tuples(history.current_delta(log, "pk", "batch", "at").unionByName(log.limit(0)))


def test_six_micro_batches_in_adverse_order(spark, tmp_path):
    rng = random.Random(3)
    land, every = Land(spark, tmp_path), []
    batches = [f"d{k:02d}" for k in range(12)]
    rng.shuffle(batches)
    for m in range(6):
        rows = []
        for b in batches[2 * m : 2 * m + 2]:
            for k in rng.sample(range(15), 8):
                key = None if k == 0 else f"k{k}"
                for _ in range(rng.choice([1, 1, 3])):
                    rows.append((key, b, rng.randrange(10**6), f"{b}-{k}-{rng.random()}"))
        rng.shuffle(rows)
        land.add(rows)
        every += rows
    changes = land.drain()
    folded = currency.fold(changes, land.schema)
    keyed = [r for r in every if r[0]]
    assert tuples(folded.where("pk is not null")) == derived(spark, keyed)
    assert tuples(folded.where("pk is null")) == sorted((r for r in every if not r[0]), key=repr)
    # Of each key exactly one insert is open, and every expiry names an insert.
    keyed = changes.where("pk is not null")
    opened = keyed.groupBy("pk").agg(F.sum(F.when(F.col("change") == "insert", 1).otherwise(-1)).alias("open"))
    assert opened.where("open <> 1").count() == 0
    ends = keyed.where("change = 'expire'").select("pk", "number")
    assert ends.subtract(keyed.where("change = 'insert'").select("pk", "number")).count() == 0


def test_a_second_drain_goes_on_from_the_state(spark, tmp_path):
    land = Land(spark, tmp_path)
    land.add([("a", "d2", 1, "two"), ("b", "d1", 1, "one")])
    assert land.drain().count() == 2
    land.add([("a", "d1", 1, "late"), ("b", "d1", 1, "one"), ("a", "d2", 5, "copy")])
    assert land.drain().count() == 2
    land.add([("a", "d3", 9, "three"), ("b", "d1", 0, "earlier record of its batch")])
    changes = land.drain()
    assert tuples(changes.where("change = 'expire'"), "pk", "number") == [("a", 1), ("b", 1)]
    assert tuples(currency.fold(changes, land.schema), "pk", "what") == [("a", "three"), ("b", "earlier record of its batch")]


def test_changes_fold_in_any_order(spark, tmp_path):
    land = Land(spark, tmp_path)
    for n in (3, 1, 2):
        land.add([("a", f"d{n}", 1, str(n)), (None, f"d{n}", 1, str(n))])
    changes = land.drain()
    turned = changes.orderBy(F.rand(1))
    assert tuples(currency.fold(turned, land.schema), "pk", "what") == [("a", "3"), (None, "1"), (None, "2"), (None, "3")]


def test_nothing_streamed_yet(spark, tmp_path):
    assert currency.fold(currency.read_changes(spark, str(tmp_path / "none")), Land(spark, tmp_path).schema).count() == 0


@pytest.mark.parametrize("a, b", [(9, 10), (0, 5), (99, 100)])
def test_numbers_sort_as_numbers(spark, a, b):
    rows = spark.createDataFrame([(a, (a, b)), (b, (b, a))], "n long, s struct<x:long,y:long>")
    texts = rows.select(
        currency.sortable(F.col("n"), rows.schema["n"].dataType), currency.sortable(F.col("s"), rows.schema["s"].dataType)
    ).collect()
    assert texts[0][0] < texts[1][0] and texts[0][1] < texts[1][1]
