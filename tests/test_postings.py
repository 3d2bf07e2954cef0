"""Keyword search by index against the plain one."""

import random

import pytest

from palimpsest.plans import adhoc, postings
from palimpsest.sources import generations
from tests.conftest import plan_of, tuples

COLUMNS = ["a", "b"]


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    rng = random.Random(4)
    words = ["Straße", "ÉTAT", "état", "plan", "PLANE", "a%b", "x_y", "日本語", "ab", "the", "\n", "o'k"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(6))), rng.choice([None, "", rng.choice(words)])) for i in range(300)]
    frame = spark.createDataFrame(rows + [(None, "plan of no key", "x")], "id long, a string, b string")
    roots = [str(tmp_path_factory.mktemp("index")) for _ in range(2)]
    for root, common in zip(roots, (1.0, 0.2)):
        postings.index(frame, "id", COLUMNS, root, parts=16, common=common)
    return frame, *roots


@pytest.mark.parametrize(
    "terms",
    [["plan"], ["ÉtAt"], ["strasse"], ["STRASSE", "lane"], ["日本語"], ["ab"], ["plan", "ab"], ["e%plan"], ["x_y the"], ["no such words"], ["pl_ne"], ["o'k the", "nothing"], [""], ["%%%"], []],
)
def test_same_rows_as_without_an_index(spark, built, terms):
    frame, *roots = built
    wanted = tuples(adhoc.keyword_search(frame, COLUMNS, terms)) if terms else []
    for root in roots:
        found = postings.search(spark, root, "id", COLUMNS, terms)
        assert found.columns == frame.columns and tuples(found) == wanted


def test_common_triples_have_no_entries(spark, built):
    _, whole, rare = built
    entries = [generations.read(spark, root, postings.POSTINGS) for root in (whole, rare)]
    assert 0 < entries[1].count() < entries[0].count()
    assert entries[1].groupBy("triple").count().where("count > 0.2 * 301").count() == 0
    assert postings.candidates(spark, rare, ["plan"]) is None
    assert postings.candidates(spark, rare, ["語 x_y é"]) is not None


def test_the_scan_reads_folders_of_candidates(spark, built):
    frame, root, _ = built
    found = postings.search(spark, root, "id", COLUMNS, ["日本語 x_y état"])
    plan = plan_of(found)
    assert "dynamicpruning" in plan
    assert 0 < postings.candidates(spark, root, ["plane plan"]).count() < frame.count()
    named = plan_of(postings.candidates(spark, root, ["plane"]))
    assert "In(triple" in named and "PartitionFilters: [_triples" in named


def test_long_texts_and_an_empty_table(spark, tmp_path):
    root = str(tmp_path / "long")
    text = "é" + "abcdefghij " * 30_000 + "needle"
    frame = spark.createDataFrame([(1, text), (2, text[:-6])], "id long, a string")
    postings.index(frame, "id", ["a"], root, parts=2, common=0.5)
    assert tuples(postings.search(spark, root, "id", ["a"], ["J NEEDLE"]), "id") == [(1,)]
    postings.index(frame.limit(0), "id", ["a"], root, parts=2)
    assert postings.search(spark, root, "id", ["a"], ["needle"]).count() == 0
