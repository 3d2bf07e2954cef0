import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from palimpsest.llm import simhash
from palimpsest.llm.simhash import fingerprint, near_links, simhash_dedup, simhash_groups
from palimpsest.session import stored
from tests.conftest import plan_of
from tests.llm.helpers import by_id, documents, with_clashes

LINES = ["the cat sat on the mat", "a dog ran off with my shoe", "rain fell on the old town all night long"]


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def closure(prints, bits=3):
    smallest = dict(prints)
    ids = sorted(prints)
    group = {i: i for i in ids}
    for _ in ids:
        for a in ids:
            for b in ids:
                if (prints[a] ^ prints[b]).bit_count() <= bits:
                    group[a] = group[b] = min(group[a], group[b])
    del smallest
    return group


TEXTS = [None, "", " \t\n", "one", "One  two", "a b c", "É é Ü", "A B\x0bC d e", "x " * 5000, " ".join(LINES * 900)]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint_is_the_plain_one(text, monkeypatch):
    monkeypatch.setattr(simhash, "PIECE", 50)
    assert fingerprint(text) % (1 << 64) == plain(text)
    monkeypatch.undo()
    assert fingerprint(text) % (1 << 64) == plain(text)


def test_groups_are_those_of_all_pairs(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(60):
        text = [rng.choice(words) for _ in range(250)]
        rows.append((3 * i, " ".join(text)))
        for k in (1, 2):
            text = list(text)
            text[rng.randrange(250)] = "other"
            rows.append((3 * i + k, " ".join(text)))
    rows += [(500 + i, t) for i, t in enumerate(TEXTS)]
    got = by_id(simhash_groups(documents(spark, rows)), "fp", "component_id")
    prints = {i: plain(t) for i, t in rows}
    assert {i: fp % (1 << 64) for i, (fp, _) in got.items()} == prints
    assert {i: c for i, (_, c) in got.items()} == closure(prints)


@pytest.mark.parametrize("block", [1, 7, 4096])
def test_links_connect_what_differs_in_three_bits(spark, block):
    rng = random.Random(5)
    prints = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        for n in (0, 1, 1, 2, 3, 3, 4, 6):
            prints.add(base ^ sum(1 << b for b in rng.sample(range(64), n)))
    prints |= {0, 1, 1 << 63, (1 << 64) - 1, 0b111}
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    links = near_links(spark.createDataFrame([(p,) for p in signed], "fp long"), block=block).collect()
    ids = {p: i for i, p in enumerate(signed)}
    assert all(((r.u ^ r.v) & (1 << 64) - 1).bit_count() <= 3 for r in links)
    group = {i: i for i in ids.values()}
    for _ in group:
        for r in links:
            a, b = ids[r.u], ids[r.v]
            group[a] = group[b] = min(group[a], group[b])
    assert group == closure({i: p % (1 << 64) for p, i in ids.items()})


def test_probes_are_not_broadcast(spark):
    """The file of the fingerprints is small, their probes are many; both the first and the final plan are looked at."""
    links = near_links(stored(spark.range(3000).select(F.xxhash64("id").alias("fp")), "fingerprints"))
    before = plan_of(links)
    links.collect()
    for plan in (before, plan_of(links)):
        assert "Broadcast" not in plan
        assert "SortMergeJoin" in plan


def test_more_bits_are_refused(spark):
    with pytest.raises(ValueError):
        near_links(spark.createDataFrame([(1,)], "fp long"), max_bits=4)


def test_dedup_keeps_one_of_each_group(spark):
    rows = [(2, "a b c d"), (1, "A b c d"), (1, "A b c d"), (3, None), (4, ""), (None, "a b c d"), (None, "q r s t u"), (7, "long " * 60_000)]
    docs = with_clashes(documents(spark, rows))
    kept = simhash_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, (r.text or "")[:9]) for r in kept.collect()), key=repr) == sorted(
        [(1, "A b c d"), (3, ""), (7, "long long"), (None, "q r s t u")], key=repr
    )


def test_empty_table(spark):
    assert simhash_groups(documents(spark, [])).count() == 0
    assert simhash_dedup(documents(spark, [])).count() == 0
