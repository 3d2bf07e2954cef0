import random
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from palimpsest.llm.line_dedup import copied_lines, line_dedup, lines_of, ranked, words_in
from palimpsest.session import stored
from tests.llm.helpers import documents, with_clashes


def units(text):
    """Lines, each with the lines without words that follow it."""
    out = []
    for line in text.split("\n"):
        if out and not line.strip(" \t\r\x0b\x0c"):
            out[-1] += "\n" + line
        else:
            out.append(line)
    return out


def brute(rows, min_words):
    """Drop every line in a run of enough words that occurred before and ended before, trying all runs of all documents."""
    bodies = {}
    for i, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0], r[1] or "")):
        if text is not None:
            lines = [s.strip(" \t\n\r\x0b\x0c") for s in units(text)]
            bodies[i, text] = [(n, s, len(re.findall(r"[^\x20\x09-\x0D]+", s))) for n, s in enumerate(lines) if s]
    seen, drops = {}, {}
    for key, lines in bodies.items():
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                run = tuple(s for _, s, _ in lines[a : b + 1])
                if sum(w for _, _, w in lines[a : b + 1]) < min_words:
                    continue
                if run in seen:
                    first, end = seen[run]
                    start = max(a, end + 1) if first == key else a
                    drops.setdefault(key, set()).update(n for n, _, _ in lines[start : b + 1])
                seen.setdefault(run, (key, b))
    out = []
    for i, text in rows:
        gone = drops.get((i, text), set())
        left = None if text is None else "\n".join(s for n, s in enumerate(units(text)) if n not in gone)
        out.append((i, left, len(gone)))
    return sorted(out, key=repr)


def found(docs, min_words):
    return sorted(((r.doc_id, r.text, r.n_dropped) for r in line_dedup(docs, min_words=min_words).collect()), key=repr)


@pytest.mark.parametrize("seed, min_words", [(1, 1), (2, 3), (3, 8), (4, 20)])
def test_matches_brute_force(spark, seed, min_words):
    rng = random.Random(seed)
    lines = ["a", "b b", "c c c", " a ", "d d d d", "", "  ", "e e e e e e"]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 14)))) for i in range(25)]
    rows += [(100 + i, rows[i][1]) for i in range(4)]
    assert found(documents(spark, rows), min_words) == brute(rows, min_words)


def test_runs_over_several_lines_and_blank_lines_between(spark):
    passage = ["one two three", "four five six", "seven eight nine"]
    rows = [
        (1, "\n".join(["head", *passage, "tail"])),
        (2, "\n".join(["other", passage[0], "", "  " + passage[1] + "\t", passage[2], "end"])),
        (3, "\n".join([passage[1], passage[0]])),
    ]
    got = found(documents(spark, rows), 9)
    assert got == [(1, rows[0][1], 0), (2, "other\nend", 3), (3, rows[2][1], 0)]


def test_hot_lines_alone_do_not_go(spark):
    rows = [(i, f"the same short line\nown line {i}\nthe same short line") for i in range(40)]
    assert found(documents(spark, rows), 50) == [(i, t, 0) for i, t in sorted(rows, key=repr)]


def test_defined_results_at_the_edges(spark):
    long = "\n".join(f"line {i} " + "word " * 60 for i in range(1500))
    rows = [(1, None), (2, ""), (2, ""), (3, long), (4, long), (None, long), (5, "\n\n")]
    docs = with_clashes(documents(spark, rows))
    cleaned = line_dedup(docs)
    assert cleaned.columns == [*docs.columns, "n_dropped"]
    got = {(r.doc_id, r.n_dropped): r.text for r in cleaned.collect()}
    assert got == {(1, 0): None, (2, 0): "", (3, 1500): "", (4, 1500): "", (None, 0): long, (5, 0): "\n\n"}
    assert line_dedup(documents(spark, [])).count() == 0


def test_repeated_rows_are_one_document(spark):
    text = "word " * 60 + "\nmore " + "words " * 60
    got = found(documents(spark, [(1, text), (1, text), (2, text)]), 50)
    assert got == [(1, text, 0), (1, text, 0), (2, "", 2)]


def test_words_are_counted_whatever_is_between(spark):
    lines = ["a", "a b", "a  b", "a\tb c", "é ü\x0bx", "a \t b", "a\x0cb"]
    got = spark.createDataFrame([(t,) for t in lines], "body string").select("body", words_in(F.col("body")).alias("n"))
    assert {r.body: r.n for r in got.collect()} == {t: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in lines}


def test_a_first_copy_is_not_cut_by_copies_that_overlap_it(spark):
    line = " ".join(f"w{k}" for k in range(10))
    rows = [(1, "\n".join([line] * 6)), (2, "\n".join([line] * 12))]
    assert found(documents(spark, rows[:1]), 50) == [(1, "\n".join([line] * 5), 1)]
    assert found(documents(spark, rows), 50) == brute(rows, 50) == [(1, "\n".join([line] * 5), 1), (2, "", 12)]


def test_a_column_of_the_same_name(spark):
    text = "word " * 60
    docs = documents(spark, [(1, text, "x"), (2, text, "y")], "doc_id long, text string, n_dropped string")
    assert line_dedup(docs).columns == ["doc_id", "text", "n_dropped"]
    assert {r.doc_id: r.n_dropped for r in line_dedup(docs).collect()} == {1: 0, 2: 1}
    kept = line_dedup(docs, dropped=None)
    assert kept.columns == docs.columns
    assert {r.doc_id: (r.text, r.n_dropped) for r in kept.collect()} == {1: (text, "x"), 2: ("", "y")}


def test_words_are_counted_with_a_pattern_only_where_needed(spark):
    rows = spark.createDataFrame([("a b c",), ("a\tb  c",), ("a\rb",), ("a\x0bb\x0cc",), ("\u00e4 \u00f6",)], "body string")
    counted = rows.select("body", words_in(F.col("body")).alias("n"))
    assert {r["body"]: r["n"] for r in counted.collect()} == {"a b c": 3, "a\tb  c": 3, "a\rb": 2, "a\x0bb\x0cc": 3, "\u00e4 \u00f6": 2}
    assert "RLIKE" not in plan_of(counted)


def test_keys_are_made_once_a_document(spark):
    made = lines_of(spark.createDataFrame([(1, "a b\nc")], "doc_id long, text string"), "doc_id", "text")
    above, below = made._jdf.queryExecution().optimizedPlan().toString().split("Generate ", 1)
    assert "md5(cast(text#" in below and "md5(cast(text#" not in above


def test_stored_runs_are_not_broadcast(spark):
    """Their files are small, what they hold may not be."""
    passage = "\n".join(f"line {i} of a passage" for i in range(20))
    copies = copied_lines(documents(spark, [(i, f"own {i}\n{passage}") for i in range(5)]), "doc_id", "text", 50)
    places = ranked(stored(spark.range(100).selectExpr("id", "id % 7 as key"), "rows"), ["key"], 0)
    for rows, joins in ((copies, 2), (places, 1)):
        plan = plan_of(rows)
        assert "Broadcast" not in plan
        assert plan.count("SortMergeJoin Inner") == joins
    assert sorted((r["doc"].doc_id, sorted(r["drops"])) for r in copies.collect()) == [(i, [*range(1, 21)]) for i in range(1, 5)]
    ranks = {r["id"] % 7: r["rank"] for r in places.collect()}
    assert sorted(ranks, key=ranks.get) == [*range(7)]
