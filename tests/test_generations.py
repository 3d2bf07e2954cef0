"""Relations replaced by whole generations."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from palimpsest.plans import gold
from palimpsest.sources import generations
from tests.conftest import tuples


def numbers(spark, n):
    return spark.range(n).select(F.col("id").alias("k"))


def test_a_refresh_may_read_its_own_relation(spark, tmp_path):
    root = str(tmp_path / "r")
    gold.refresh(numbers(spark, 3), root)
    for _ in range(3):
        own = generations.read(spark, root)
        gold.refresh(own.unionByName(own.select((F.col("k") + 100).alias("k"))), root)
    assert generations.read(spark, root).count() == 24


def test_an_open_reader_keeps_its_generation(spark, tmp_path):
    root = str(tmp_path / "r")
    before = gold.refresh(numbers(spark, 3), root)
    gold.refresh(numbers(spark, 5), root)
    assert (before.count(), generations.read(spark, root).count()) == (3, 5)
    assert generations.read(spark, root, back=1).count() == 3
    with pytest.raises(LookupError):
        generations.read(spark, root, back=2)


def test_a_refresh_that_breaks_off_shows_nothing(spark, tmp_path):
    root = str(tmp_path / "r")
    gold.refresh(numbers(spark, 3), root)
    # The last task fails when the others have written their files.
    broken = spark.range(0, 8, numPartitions=8).select(
        F.when(F.col("id") < 7, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("long")).alias("k")
    )
    opened = generations.read(spark, root)
    with pytest.raises(PySparkException):
        gold.refresh(broken, root)
    assert opened.count() == generations.read(spark, root).count() == 3
    assert len(generations.published(spark, root)) == 1
    assert gold.refresh(numbers(spark, 4), root).count() == 4


def test_a_job_killed_between_write_and_swap_shows_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "r")
    gold.refresh(numbers(spark, 3), root)
    monkeypatch.setattr(generations, "swap", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        gold.refresh(numbers(spark, 9), root)
    monkeypatch.undo()
    assert generations.read(spark, root).count() == 3
    assert len(list((tmp_path / "r" / "generations").iterdir())) == 2
    # It stays as long as it could be under way, and goes then; what is published stays.
    assert generations.clean(spark, root) == []
    assert len(generations.clean(spark, root, grace_seconds=0)) == 1
    assert generations.read(spark, root).count() == 3


def test_an_overtaken_refresh_is_refused(spark, tmp_path):
    root = str(tmp_path / "r")
    gold.refresh(numbers(spark, 1), root)
    seen = generations.published(spark, root)
    gold.refresh(numbers(spark, 2), root)
    with pytest.raises(generations.Superseded):
        generations.swap(spark, root, generations.new_generation(), seen)
    assert generations.read(spark, root).count() == 2


def test_relations_are_published_together(spark, tmp_path):
    root = str(tmp_path / "gold")
    gold.publish(spark, {"a": numbers(spark, 1), "b": numbers(spark, 2)}, root)
    bad = numbers(spark, 3).select(F.raise_error(F.lit("lost")).cast("long").alias("k"))
    with pytest.raises(PySparkException):
        gold.publish(spark, {"a": numbers(spark, 5), "b": bad}, root)
    assert spark.table("a").count() == 1 and generations.read(spark, root, "a").count() == 1
    gold.publish(spark, {"a": numbers(spark, 6), "b": numbers(spark, 7)}, root)
    assert (spark.table("a").count(), spark.table("b").count()) == (6, 7)


def test_old_generations_go_and_kept_ones_stay(spark, tmp_path):
    root = str(tmp_path / "r")
    for n in range(1, 6):
        gold.refresh(numbers(spark, n), root)
    assert len(generations.clean(spark, root, grace_seconds=0)) == 2
    assert [generations.read(spark, root, back=b).count() for b in range(3)] == [5, 4, 3]


def test_before_the_first_refresh(spark, tmp_path):
    root = str(tmp_path / "none")
    assert tuples(generations.read(spark, root, schema=numbers(spark, 1).schema)) == []
    assert generations.published(spark, root) == [] and generations.clean(spark, root) == []
    with pytest.raises(LookupError):
        generations.read(spark, root)
