import duckdb
import pytest

from palimpsest.llm.common import ORACLES
from palimpsest.llm.components import connected_components
from palimpsest.llm.url_filter import filter_urls, judge_urls
from tests.llm.helpers import with_clashes

PAGES = "page_id long, url string, html string"


def link(url):
    return f'<html><LINK REL="canonical" href="{url}"></html>'


def verdicts(spark, rows, **options):
    pages = spark.createDataFrame(rows, PAGES)
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, **options).collect()}


def test_longest_rule_wins(spark):
    got = verdicts(
        spark,
        [
            (1, "http://WWW.Example.com/en/a?x#y", ""),
            (2, "https://m.example.com/en/", None),
            (3, "http://example.com/de/", ""),
            (4, "http://a.net/es/1", ""),
            (5, "http://notexample.com/en/", ""),
            (6, "http://net/fr/", ""),
            (7, "http://example.com", ""),
            (8, None, ""),
            (9, "no address", ""),
            (10, "http://example.org/en/", ""),
        ],
    )
    assert got == {
        1: ("www.example.com", "/en/a", "www.example.com/en/", "allow"),
        2: ("m.example.com", "/en/", "example.com/en/", "block"),
        3: ("example.com", "/de/", "com/", "allow"),
        4: ("a.net", "/es/1", "net/es/", "block"),
        5: ("notexample.com", "/en/", "com/", "allow"),
        6: ("net", "/fr/", "net/fr/", "block"),
        7: ("example.com", "", None, "allow"),
        8: ("", "", None, "allow"),
        9: ("", "", None, "allow"),
        10: ("example.org", "/en/", None, "allow"),
    }


def test_blocks_reach_aliases_and_explicit_allows_win(spark):
    refresh = '<meta http-equiv=refresh content="0; URL=http://c.org/x">'
    got = verdicts(
        spark,
        [
            (1, "http://a.org/1", link("http://b.net/es/1")),
            (2, "http://c.org/x", link("/y")),
            (3, "http://c.org/y", link("z")),
            (4, "http://c.org/z#top", link("//d.net/fr/")),
            (5, "http://e.org/p", refresh),
            (6, "http://f.org/", link("http://g.com/q")),
            (7, "http://h.net/es/", link("http://f.org/")),
            (8, "https://a.org/1#part", ""),
            (9, "http://a.org/1?q", ""),
        ],
    )
    assert {i: v[3] for i, v in got.items()} == {
        1: "block",
        2: "block",
        3: "block",
        4: "block",
        5: "block",
        6: "allow",
        7: "block",
        8: "block",
        9: "allow",
    }


def test_redirect_table(spark):
    redirects = spark.createDataFrame([("http://a.org/", "http://x.net/es/"), (None, "http://b.org/")], "from string, to string")
    got = verdicts(spark, [(1, "http://a.org/", ""), (2, "http://b.org/", "")], redirects=redirects)
    assert (got[1][3], got[2][3]) == ("block", "allow")


def test_empty_repeated_and_clashing(spark):
    assert verdicts(spark, []) == {}
    rows = [(1, "http://a.net/es/", "")] * 2 + [(2, "http://a.org/", "x" * 200_000), (None, None, None)]
    pages = with_clashes(spark.createDataFrame(rows, PAGES))
    assert judge_urls(pages).count() == 4
    kept = filter_urls(pages)
    assert kept.columns == pages.columns
    assert sorted((r.page_id for r in kept.collect()), key=repr) == [2, None]


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(5, 4), (4, 3), (3, 2), (9, 8), (8, 8)], [(0, i) for i in range(1, 40)] + [(i, i + 1) for i in range(100, 140)]])
def test_components(spark, edges):
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {x: x for e in edges for x in e}
    for _ in want:
        for u, v in edges:
            want[u] = want[v] = min(want[u], want[v])
    assert got == want


# Pages at a.org that are aliases of a blocked page, one for each form of link, and pages that are none.
ALIASES = [
    '<link rel="canonical" href="http://a.org/me"><link href="http://b.net/es/1" rel="canonical">',
    "<link rel='alternate canonical' href='http://b.net/es/1'>",
    "<link rel=canonical href=http://b.net/es/1>",
    '<LINK\n  HREF = "http://b.net/es/1"\n  REL = "CANONICAL" />',
    '<link rel="canonical" href="http://b.net/es/?a=1&amp;b=2">',
    '<link rel="canonical" href="http://b.net/es/?a=1&#38;b=2">',
    '<link rel="canonical" href="http:&#x2F;&#47;b.net/es/1">',
    '<link rel="canonical" href=" http://b.net/de/.././es/1 ">',
    '<link rel="canonical" href="//b.net/fr/../es/1">',
    '<link rel="canonical" href="../../x/blocked">',
    '<link rel="canonical" href="/y/../x/./blocked#part">',
    '<link rel="canonical" href="?blocked">',
    '<meta content="0; URL=http://b.net/es/1" http-equiv="Refresh">',
    "<meta http-equiv=refresh content=0;url=http://b.net/es/1>",
    '<meta http-equiv="refresh" content="5;url=\'/x/blocked\'">',
    '<!-- a --><link rel="canonical" href="http://b.net/es/1"><!-- b -->',
]
NONE = [
    '<!-- <link rel="canonical" href="http://b.net/es/1"> -->',
    '<!-- never closed <link rel="canonical" href="http://b.net/es/1">',
    '<link rel="alternate" href="http://b.net/es/1">',
    '<link rel="noncanonical" href="http://b.net/es/1">',
    '<link data-rel="canonical" href="http://b.net/es/1">',
    '<a rel="canonical" href="http://b.net/es/1">',
    '<link rel="canonical" data-href="http://b.net/es/1">',
    '<meta name="refresh" content="0;url=http://b.net/es/1">',
    '<link rel="canonical" href="mailto:x@b.net">',
    '<link rel="canonical" href="#blocked">',
    '<link rel="canonical" href="/go?to=http://b.net/es/1">',
    '<link rel="canonical" href="">',
    "<link rel=canonical>",
]


def planted():
    rows = [(1, "http://b.net/es/1", None), (2, "http://b.net/es/?a=1&b=2", None), (3, "http://a.org/x/blocked", link("http://b.net/es/1"))]
    rows += [(100 + i, f"http://a.org/p/q{i}/r{i}", html) for i, html in enumerate(ALIASES)]
    rows += [(200 + i, f"http://a.org/p/n{i}/r{i}", html) for i, html in enumerate(NONE)]
    rows += [(300, f"http://a.org/p/q{ALIASES.index(ALIASES[11])}/r11?blocked", link("http://b.net/es/1"))]
    return rows + [(400, None, ALIASES[0]), (401, "no address", ALIASES[0]), (402, "http://c.org", '<link rel="canonical" href="x/../es">')]


def test_every_form_of_link_carries_the_block(spark):
    got = verdicts(spark, planted())
    wrong = [(html, got[100 + i][3]) for i, html in enumerate(ALIASES) if got[100 + i][3] != "block"]
    assert wrong == []
    assert [(html, got[200 + i][3]) for i, html in enumerate(NONE) if got[200 + i][3] != "allow"] == []
    assert {got[i][3] for i in (400, 401, 402)} == {"allow"}


def test_the_oracle_sees_the_same_links(spark, tmp_path):
    spark.createDataFrame(planted(), PAGES).write.parquet(str(tmp_path / "pages"))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages/*.parquet')")
    rows = connection.execute(ORACLES["op5_url_filters"]).fetchall()
    assert {r[0]: r[1:] for r in rows} == verdicts(spark, planted())
