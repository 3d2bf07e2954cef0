import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from palimpsest.llm import quality
from palimpsest.llm.quality import keep_good, quality_scores, term_counts
from tests.llm.helpers import documents, with_clashes

LABELS = "doc_id long, quality int, toxic int"


def corpus():
    rng = random.Random(2)
    words = "the rain falls over town and she walks home with a small dog".split()
    rows, labels = [], []
    for i in range(300):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(20, 60)))
        bad = i % 4 == 0
        rows.append((i, "!! ".join(text.upper().split()) if bad else text))
        labels.append((i, int(not bad), 0))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    got = {r.doc.doc_id: r.score for r in quality_scores(documents(spark, rows), spark.createDataFrame(labels, LABELS)).collect()}
    held = [(i, q) for i, q, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 30
    assert np.mean([(got[i] >= 0.3) == bool(q) for i, q in held]) >= 0.95
    assert all(0 <= s <= 1 for s in got.values())


def test_labels_of_the_held_out_fold_have_no_say(spark):
    rows, labels = corpus()
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in labels]
    score = lambda given: sorted((r.doc.doc_id, r.score) for r in quality_scores(documents(spark, rows), spark.createDataFrame(given, LABELS)).collect())
    assert score(labels) == score(flipped)


def test_blocked_cosines_are_the_plain_vote():
    rng = np.random.default_rng(4)
    counts = rng.poisson(0.05, (80, quality.TERMS)).astype(np.float32)
    labels = rng.integers(0, 2, 80)
    space = quality.fit_space(counts, labels, {0: 0.2, 1: 0.8}, 16)
    tests = rng.poisson(0.05, (30, quality.TERMS)).astype(np.float32)
    vectors = space.project(tests)
    wanted = []
    for v in vectors:
        near = sorted(((float(v @ space.vectors[i]), i) for i in range(80)), reverse=True)[:7]
        votes = [(max(c, 0) ** 2 * space.votes[i], labels[i]) for c, i in near]
        wanted.append(sum(w * y for w, y in votes) / sum(w for w, _ in votes))
    assert np.allclose(space.score(tests, 7), wanted, atol=1e-5)


def test_terms_of_long_texts_are_counted_in_pieces(monkeypatch):
    text = "Some words, some WORDS! 12\n" * 400
    whole = term_counts(text)
    monkeypatch.setattr(quality, "PIECE", 1000)
    assert np.abs(term_counts(text) - whole).sum() <= 6 * (len(text) // 1000 + 1)


def test_edges(spark):
    rows, labels = corpus()
    odd = [(900, None), (901, ""), (902, "x" * 300_000), (3, "repeated id"), (None, "no id")]
    docs = with_clashes(documents(spark, rows + odd))
    known = spark.createDataFrame(labels + [(None, 1, 0), (5, None, 0), (6, 7, 0)], LABELS)
    scores = {r.doc.doc_id: r.score for r in quality_scores(docs, known).collect()}
    share = np.mean([q for i, q, _ in labels if zlib.crc32(str(i).encode()) % 5])
    assert np.isclose(scores[900], share, atol=0.01) and scores[900] == scores[901]
    kept = keep_good(docs, known)
    assert kept.columns == docs.columns
    assert kept.where(F.col("doc_id").isin(900, 901)).count() == 2


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], LABELS)
    got = quality_scores(documents(spark, [(1, "a b c"), (2, None)]), none).collect()
    assert [r.score for r in got] == [0.5, 0.5]
    assert quality_scores(documents(spark, []), none).count() == 0


def test_repeated_ids_and_labels_crowd_nothing_out(spark):
    """Many documents under one label-0 id, its label many times over: the other label keeps its say."""
    rng = random.Random(3)
    good = lambda: " ".join(rng.choice("the rain falls over town and she walks home".split()) for _ in range(40))
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5]
    spam, fine = ids[0], ids[1:39]
    rows = [(spam, "!! ".join(good().upper().split())) for _ in range(60)] + [(i, good()) for i in fine]
    labels = [(spam, 0, 0)] * 30 + [(i, 1, 0) for i in fine] + [(ids[50], 0, 0), (ids[50], 1, 0)]
    space = quality.learn(documents(spark, rows), spark.createDataFrame(labels, LABELS), "doc_id", "text", "quality", 8, 4)
    assert sorted(space.labels.tolist()) == [0.0] + [1.0] * 8
    assert np.isclose(space.prior, 38 / 39)
    again = quality.learn(documents(spark, rows[::-1]).repartition(5), spark.createDataFrame(labels, LABELS), "doc_id", "text", "quality", 8, 4)
    assert np.allclose(space.vectors, again.vectors)


def test_drawn_rows_are_ordered_as_lists_are():
    rng = np.random.default_rng(5)
    rows = []
    for i in range(60):
        terms = sorted(rng.choice(quality.TERMS, rng.integers(0, 4), replace=False).tolist())
        rows.append({"label": i % 2, "terms": terms, "counts": [float(c) for c in rng.integers(1, 400, len(terms))]})
    rows += [dict(r, counts=[c + 1 for c in r["counts"]]) for r in rows]
    table = pa.Table.from_pylist(rows, pa.schema({"label": pa.int32(), "terms": pa.list_(pa.int32()), "counts": pa.list_(pa.float32())}))
    wanted = sorted(rows, key=lambda r: (r["label"], r["terms"], r["counts"]))
    for part in (table, pa.concat_tables([table[:50], table[50:]])):
        counts, labels = quality.in_order(part)
        assert labels.tolist() == [r["label"] for r in wanted]
        for row, r in zip(counts, wanted):
            assert np.flatnonzero(row).tolist() == r["terms"] and row[r["terms"]].tolist() == r["counts"]
    assert quality.in_order(table[:0])[0].shape == (0, quality.TERMS)
