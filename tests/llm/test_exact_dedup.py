import hashlib

import pytest

from palimpsest.llm.exact_dedup import exact_dedup, exact_groups, heavy_groups
from tests.llm.helpers import documents, with_clashes

ROWS = [
    (1, "Some Text"),
    (2, "some text"),
    (3, "SOME TEXT"),
    (4, None),
    (5, ""),
    (6, "É"),
    (7, "é"),
    (None, "some text"),
    (9, "x" * 300_000),
    (9, "x" * 300_000),
    (10, "X" * 300_000),
]


def brute(rows):
    """(doc_id, keep_id, size, kept count) by sorting in Python."""
    fold = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (t or ""))
    groups = {}
    for i, t in rows:
        groups.setdefault(fold(t), []).append(i)
    out = []
    for t, ids in groups.items():
        last = max((i for i in ids if i is not None), default=None)
        out += [(i, last, len(ids), hashlib.sha256(t.encode()).digest()) for i in ids]
    return sorted(out, key=repr)


def found(groups):
    return sorted(((r.doc_id, r.keep_id, r.group_size, bytes(r.digest)) for r in groups.collect()), key=repr)


@pytest.mark.parametrize("support", [0.001, 0.2, 0.5])
def test_matches_brute_force_whatever_is_frequent(spark, support):
    groups = exact_groups(documents(spark, ROWS), support=support)
    assert found(groups) == brute(ROWS)


def test_one_row_of_a_group_is_kept(spark):
    groups = exact_groups(documents(spark, ROWS)).where("kept").collect()
    assert sorted(((r.doc_id) for r in groups), key=repr) == sorted([3, 5, 6, 7, 10], key=repr)


@pytest.mark.parametrize("support", [0.001, 0.3])
def test_rows_that_repeat_the_id_leave_one(spark, support):
    rows = [(1, "a")] * 5 + [(None, "b")] * 3
    kept = exact_groups(documents(spark, rows), support=support).where("kept").collect()
    assert sorted((r.doc_id for r in kept), key=repr) == [1, None]


def test_heavy_groups_are_verified(spark):
    rows = exact_groups(documents(spark, [(i, "hot" if i % 3 else f"t{i}") for i in range(90)]))
    heavy = heavy_groups(rows.selectExpr("doc_id", "digest", "doc_id as row_id"), 0.1).collect()
    assert [(r.group_size, r.keep.doc_id) for r in heavy] == [(60, 89)]


def test_empty_table_and_clashing_columns(spark):
    assert exact_groups(documents(spark, [])).count() == 0
    docs = with_clashes(documents(spark, ROWS))
    kept = exact_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 5, 6, 7, 10]
