"""Inheritance, queues, topics, the model hook and summaries."""

import re
from collections import Counter
from datetime import datetime, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from palimpsest.operators import history, inherit as carry, summaries
from palimpsest.operators.models import apply_model
from palimpsest.operators.summaries import extractive_summary
from palimpsest.operators.topics import nearest_topic, similarities
from palimpsest.plans import enrichment
from palimpsest.plans.entities import TOPICS
from tests.conftest import plan_of, tuples

LOG = "id bigint, batch string, ementa string, ementaDetalhada string, tema string, is_current boolean"


def log(spark, *rows):
    data = spark.createDataFrame([(i, b, t, None, tema, c) for i, b, t, tema, c in rows], LOG)
    return data.withColumn("loaded_at", F.to_timestamp(F.concat(F.lit("2024-01-0"), F.col("batch"))))


def test_inheritance_cases(spark):
    rows = log(
        spark,
        (1, "1", "A", "x", False), (1, "2", "A", None, True),
        (2, "1", "A", "x", False), (2, "2", "B", "y", False), (2, "3", "A", None, True),
        (3, "1", None, "x", False), (3, "2", None, None, True),
        (4, "1", "A", "x", False), (4, "2", "A", None, False), (4, "3", "A", None, True),
        (5, "1", "A", "x", False), (5, "2", "A", "own", True),
        (None, "1", "A", "x", False), (None, "2", "A", None, True),
        (6, "1", "A", None, True),
    )
    known = carry.inherit(rows, "id", "ementa", ["tema"], "batch")
    assert tuples(known, "id", "tema", "inherited") == [
        (1, "x", True), (2, None, False), (3, None, False), (4, "x", True), (5, "own", False), (6, None, False),
        (None, None, False),
    ]
    again = carry.inherit(known.drop("inherited").union(rows.filter("not is_current").select(known.drop("inherited").columns)), "id", "ementa", ["tema"], "batch")
    assert again.filter("inherited").count() == 0


def test_equal_load_times_are_broken_by_batch(spark):
    rows = log(spark, (1, "1", "A", "x", False), (1, "2", "A", "y", False)).withColumn("loaded_at", F.lit(datetime(2024, 1, 1)))
    assert tuples(carry.latest_labelled(rows, "id", ["tema"], "batch"), "tema") == [("y",)]


def test_queues(spark):
    rows = log(spark, (1, "1", "A", None, True), (2, "1", "", None, True), (3, "1", None, None, True), (4, "1", "B", "t", True))
    assert tuples(carry.pending_classification(rows, "ementa", "tema"), "id") == [(1,)]
    assert tuples(carry.pending_summary(rows, "tema"), "id") == [(1,), (2,), (3,)]


def test_summary_input(spark):
    rows = spark.createDataFrame([("s", "l"), ("s", ""), ("s", None), (None, None), (None, "l")], "s string, l string")
    assert [r[0] for r in rows.select(carry.summary_input("s", "l")).collect()] == ["l", "s", "s", "", "l"]


def vectors(spark, *rows):
    return spark.createDataFrame([(i, [float(x) for x in v] if v is not None else None) for i, v in rows], "id int, v array<float>")


def topics(spark, *rows):
    return spark.createDataFrame(
        [(i, t, [float(x) for x in v]) for i, (t, v) in enumerate(rows)], "ord int, topic string, vector array<float>"
    )


@pytest.mark.parametrize("method, block", [("matrix", 1024), ("matrix", 2), ("columns", 1024), ("columns", 1)])
def test_ties_zero_and_missing_vectors(spark, method, block):
    dimension = topics(spark, ("far", (0, 1)), ("first", (1, 0)), ("second", (1, 0)), ("long", (5, 5)))
    rows = vectors(spark, (1, (3, 0)), (2, (0, 0)), (3, (1, 1)), (4, (-1, 0)), (5, None))
    best = nearest_topic(rows, "v", dimension, method=method, block=block)
    got = {r["id"]: (r["topic"], r["score"]) for r in best.collect()}
    assert got[1][0] == "first" and got[1][1] == pytest.approx(1.0)
    assert got[2] == ("far", 0.0)
    assert got[3][0] == "long"
    assert got[4] == ("far", pytest.approx(0.0))
    assert got[5] == (None, None)


@pytest.mark.parametrize("method", ["matrix", "columns"])
def test_gaps_in_the_topic_order(spark, method):
    dimension = topics(spark, ("a", (1, 0)), ("b", (0, 1))).withColumn("ord", F.col("ord") * 7)
    best = nearest_topic(vectors(spark, (1, (0, 2)), (2, (1, 1))), "v", dimension, method=method, block=2)
    assert tuples(best, "id", "topic") == [(1, "b"), (2, "a")]


@pytest.mark.parametrize("method", ["matrix", "columns"])
def test_nearest_topic_against_numpy(spark, method):
    rng = np.random.default_rng(7)
    data, targets = rng.normal(size=(300, 16)).astype(np.float32), rng.normal(size=(9, 16)).astype(np.float32)
    rows = vectors(spark, *[(i, v) for i, v in enumerate(data)])
    dimension = topics(spark, *[(f"t{i}", v) for i, v in enumerate(targets)])
    a = data / (np.linalg.norm(data, axis=1, keepdims=True) + 1e-10)
    b = targets / (np.linalg.norm(targets, axis=1, keepdims=True) + 1e-10)
    wanted = a @ b.T
    got = nearest_topic(rows, "v", dimension, method=method, block=4).orderBy("id").collect()
    assert [r["topic"] for r in got] == [f"t{i}" for i in wanted.argmax(axis=1)]
    assert np.allclose([r["score"] for r in got], wanted.max(axis=1), atol=1e-6)
    scores = similarities(rows, "v", dimension).orderBy("id").collect()
    assert np.allclose([r["scores"] for r in scores], wanted, atol=1e-6)
    assert np.abs(wanted).max() <= 1 + 1e-6


def test_hook_isolates_failing_rows_and_bounds_calls(spark):
    def model(texts):
        if len(texts) > 7:
            raise AssertionError("too many texts in one call")
        if "bad" in texts:
            raise ValueError("refused")
        return [t.upper() for t in texts]

    rows = spark.createDataFrame([(i, "bad" if i % 10 == 0 else f"t{i}") for i in range(100)], "id int, text string")
    made = apply_model(rows, "text", model, "value", T.StringType(), call_rows=7, tasks=3)
    got = {r["id"]: (r["value"], r["error"]) for r in made.collect()}
    assert len(got) == 100
    assert got[10] == (None, "ValueError: refused") and got[11] == ("T11", None)


def test_hook_refuses_a_short_answer(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, text string").coalesce(1)
    made = apply_model(rows, "text", lambda texts: ["only"], "value", T.StringType())
    assert tuples(made, "id", "value") == [(1, "only"), (2, "only")]


def flagged(spark, *rows):
    plain = spark.createDataFrame([(i, b, t, d) for i, b, t, d in rows], "id bigint, batch string, ementa string, ementaDetalhada string")
    stamped = plain.withColumn("loaded_at", F.to_timestamp(F.concat(F.lit("2024-01-0"), F.col("batch"))))
    return history.flag_current(stamped, "id", "batch", "delta")


def embed(texts):
    return [[float(len(t)), 1.0, float(t.count("a"))] for t in texts]


def test_classification_runs_resume_and_reuse(spark, tmp_path):
    path = str(tmp_path / "topics")
    day = lambda d: datetime(2024, 1, d, tzinfo=timezone.utc)
    calls = str(tmp_path / "calls")

    def counting(texts):
        with open(calls, "a") as out:
            out.writelines(f"{t}\n" for t in texts)
        return embed(texts)

    def seen():
        with open(calls) as lines:
            return sorted(line.strip() for line in lines if line.strip() not in dict(TOPICS).values())

    first = [(1, "1", "banana", None), (2, "1", "other", None), (3, "1", "", None), (None, "1", "keyless", None)]
    enrichment.classify_propositions(spark, flagged(spark, *first), path, counting, day(1))
    assert seen() == ["banana", "other"]
    second = first + [(1, "2", "banana", None), (2, "2", "changed", None)]
    for slices in (1, 3):
        table = enrichment.classify_propositions(spark, flagged(spark, *second), path, counting, day(2), slices)
        assert seen() == ["banana", "changed", "other"]
    assert tuples(table, "id", "batch") == [(1, "1"), (1, "2"), (2, "1"), (2, "2")]
    labelled = carry.with_enrichment(flagged(spark, *second), table, "id", "batch")
    assert labelled.count() == 6
    same = {r[enrichment.TOPIC] for r in labelled.filter("id = 1").collect()}
    assert len(same) == 1 and None not in same


def test_summaries_retry_failed_rows_only(spark, tmp_path):
    path = str(tmp_path / "summaries")
    rows = flagged(spark, (1, "1", "fine", None), (2, "1", "bad", ""), (3, "1", None, "detailed"), (4, "1", None, None))
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)

    def strict(texts):
        if "bad" in texts:
            raise RuntimeError("no")
        return [f" <{t}>\n" for t in texts]

    table = enrichment.summarize_propositions(spark, rows, path, strict, at)
    assert tuples(table, "id", enrichment.SUMMARY) == [(1, "<fine>"), (3, "<detailed>"), (4, "<>")]
    table = enrichment.summarize_propositions(spark, rows, path, lambda ts: [t * 2 for t in ts], at)
    assert tuples(table, "id", enrichment.SUMMARY) == [(1, "<fine>"), (2, "badbad"), (3, "<detailed>"), (4, "<>")]


def test_topic_dimension(spark):
    dimension = enrichment.topic_dimension(spark, embed)
    assert dimension.count() == 10 and dimension.orderBy("ord").first()["topic"] == "Tributário"


def by_hand(texts):
    """The summary definition, written as loops."""
    split = {k: [s.strip(" ") for s in re.findall(r"[^.!?\n]+[.!?]*", t)] for k, t in texts.items()}
    split = {k: [s for s in v if s] for k, v in split.items()}
    words = lambda s: set(re.findall(r"[^\W_]+", s.lower()))
    every = [s for v in split.values() for s in v]
    count = Counter(w for s in every for w in words(s))
    score = lambda s: sum((len(every) // count[w]).bit_length() - 1 for w in words(s))
    best = {k: sorted(range(len(v)), key=lambda i: (-score(v[i]), i))[:3] for k, v in split.items()}
    return {k: "\n".join(split[k][i] for i in sorted(best[k])) for k in texts}


def test_extractive_summary_by_hand(spark):
    rng = np.random.default_rng(3)
    vocabulary = "the of law tax school health road río ação lei 2024".split()
    texts = {
        i: " ".join(rng.choice(vocabulary) + str(rng.choice([".", "", "", "!\n"])) for _ in range(rng.integers(0, 40)))
        for i in range(60)
    }
    texts.update({100: "", 101: "...", 102: "One. Two. Three. Four.", 103: "  spaced   out  .  again "})
    rows = spark.createDataFrame(list(texts.items()), "id bigint, text string")
    wanted = sorted(by_hand(texts).items())
    assert tuples(extractive_summary(rows, "id", "text")) == sorted(wanted, key=repr)
    salted = extractive_summary(rows, "id", "text", hot={"the": 3_000_000})
    assert tuples(salted) == sorted(wanted, key=repr)


def test_inheritance_moves_no_texts(spark, tmp_path, monkeypatch):
    kept, plain = [], enrichment._keep
    monkeypatch.setattr(enrichment, "_keep", lambda rows, *more: kept.append(plan_of(rows.select("id", "batch", enrichment.TOPIC))) or plain(rows, *more))
    rows = spark.createDataFrame(
        [(1, "1", "a", None), (1, "2", "a", None), (2, "2", "b", None), (3, "2", "", None), (None, "2", "c", None)],
        "id bigint, batch string, ementa string, ementaDetalhada string",
    )
    path = f"{tmp_path}/log"
    rows.withColumn("loaded_at", F.to_timestamp(F.concat(F.lit("2024-01-0"), F.col("batch")))).write.parquet(path)
    texts = enrichment.with_digest(spark.read.parquet(path))
    flags = history.flag_current(texts, "id", "batch", "delta")
    made = enrichment.classify_propositions(spark, flags, f"{tmp_path}/topics", embed, datetime(2024, 1, 1, tzinfo=timezone.utc), texts=texts)
    assert tuples(made, "id", "batch") == [(1, "2"), (2, "2")]
    exchanges = [line for line in re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: (.*)", kept[0])]
    assert exchanges and not any("ementa#" in line for line in exchanges)


def test_queue_rows_without_a_batch_name_stay(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, None, "a", None, True), (2, "", "b", None, True)],
        "id bigint, batch string, ementa string, ementaDetalhada string, is_current boolean",
    ).withColumn("loaded_at", F.to_timestamp(F.lit("2024-01-01")))
    made = enrichment.classify_propositions(spark, rows, f"{tmp_path}/topics", embed, datetime(2024, 1, 1, tzinfo=timezone.utc))
    assert tuples(made, "id", "batch") == [(1, None), (2, "")]


def test_only_rare_words_are_joined(spark, monkeypatch):
    texts = {i: f"The law of number{i}. The tax. A school of law number{i % 7}x." for i in range(40)}
    rows = spark.createDataFrame(list(texts.items()), "id int, text string")
    moved, plain = [], summaries.salted_join
    monkeypatch.setattr(summaries, "salted_join", lambda left, *more: moved.extend(r["word"] for r in left.collect()) or plain(left, *more))
    monkeypatch.setattr(summaries, "VOCABULARY_ROWS", 12)
    wanted = [(i, s) for i, s in by_hand(texts).items()]
    assert tuples(extractive_summary(rows, "id", "text")) == sorted(wanted, key=repr)
    assert moved and not {"the", "law", "of", "tax"} & set(moved)
    monkeypatch.setattr(summaries, "VOCABULARY_ROWS", 1)
    assert tuples(extractive_summary(rows, "id", "text")) == sorted(wanted, key=repr)
