"""URL rules whose block decisions reach every alias of a page.

Pages are aliases when redirects (``meta refresh`` or a table of them) and canonical links connect them. The
components of that graph are found on links alone: a page without a link is decided where it is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from palimpsest.llm.common import fold_ascii, query, table
from palimpsest.llm.components import connected_components
from palimpsest.session import stored

# Host, path, verdict.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

# Patterns that Java's and DuckDB's regular expressions read alike.
COMMENT = r"(?s)<!--.*?(?:-->|\z)"
HINT = r"(?is)<link\b[^>]*canonical|<meta\b[^>]*refresh"
TAG = r"(?is)<(?:link|meta)\b[^>]*>"
SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"
IN_CONTENT = r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)"
# Character references that stand in addresses; the ampersand comes last.
REFERENCES = [
    (r"&quot;|&#0*34;|&#[xX]0*22;", '"'),
    (r"&apos;|&#0*39;|&#[xX]0*27;", "'"),
    (r"&period;|&#0*46;|&#[xX]0*2[eE];", "."),
    (r"&sol;|&#0*47;|&#[xX]0*2[fF];", "/"),
    (r"&colon;|&#0*58;|&#[xX]0*3[aA];", ":"),
    (r"&lt;|&#0*60;|&#[xX]0*3[cC];", "<"),
    (r"&equals;|&#0*61;|&#[xX]0*3[dD];", "="),
    (r"&gt;|&#0*62;|&#[xX]0*3[eE];", ">"),
    (r"&quest;|&#0*63;|&#[xX]0*3[fF];", "?"),
    (r"&amp;|&#0*38;|&#[xX]0*26;", "&"),
]


def attribute_pattern(name: str) -> str:
    """An attribute's value in quotes of either kind or none, each a group."""
    return rf"(?is)[\s\"'/]{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"


def attribute(tag: Column, name: str) -> Column:
    """An attribute of a tag without character references; empty if it is not there."""
    found = F.concat(*[F.regexp_extract(tag, attribute_pattern(name), k) for k in (1, 2, 3)])
    for reference, character in REFERENCES:
        found = F.regexp_replace(found, reference, character)
    return F.regexp_replace(found, r"^\s+|\s+$", "")


def after_scheme(url: Column) -> Column:
    start = F.instr(url, "://")
    return F.when(start > 0, F.substr(url, start + 3)).otherwise("")


def host_of(url: Column) -> Column:
    return F.coalesce(fold_ascii(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def alias_key(url: Column) -> Column:
    """What two spellings of one address share: scheme and fragment do not count."""
    return F.concat(
        host_of(url), F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*([^#]*)", 1), F.lit(""))
    )


def without_dots(path: Column) -> Column:
    """A path with its ``.`` and ``..`` segments resolved."""
    parts = F.split(path, "/")
    nothing = F.array().cast("array<string>")
    folded = F.aggregate(
        F.slice(parts, F.lit(2), F.size(parts)),
        nothing,
        lambda done, part: F.when(part == ".", done)
        .when(part == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.concat(done, F.array(part))),
    )
    last = F.element_at(parts, -1)
    whole = F.when(last.isin(".", ".."), F.concat(folded, F.array(F.lit("")))).otherwise(folded)
    return F.when(path.contains("/."), F.concat(F.lit("/"), F.array_join(whole, "/"))).otherwise(path)


def absolute(link: Column, base: Column) -> Column:
    """A link as an absolute address, seen from the page at ``base``; null where there is none.

    Links within the page itself and to what has no host, as ``mailto:``, are none.
    """
    origin = F.regexp_extract(base, r"^([^/]*://[^/?#]*)", 1)
    path = path_of(base)
    folder = F.coalesce(F.nullif(F.regexp_extract(path, r"^.*/", 0), F.lit("")), F.lit("/"))
    whole = (
        F.when((link == "") | link.isNull() | ~base.contains("://") | link.startswith("#"), F.lit(None).cast("string"))
        .when(link.startswith("//"), F.concat(F.regexp_extract(base, r"^([^/]*:)//", 1), link))
        .when(link.rlike(SCHEME + "//"), link)
        .when(link.rlike(SCHEME), F.lit(None).cast("string"))
        .when(link.startswith("/"), F.concat(origin, link))
        .when(link.startswith("?"), F.concat(origin, path, link))
        .otherwise(F.concat(origin, folder, link))
    )
    split = r"(?s)^([^/]*://[^/?#]*)([^?#]*)(.*)$"
    return F.concat(
        F.regexp_extract(whole, split, 1), without_dots(F.regexp_extract(whole, split, 2)), F.regexp_extract(whole, split, 3)
    )


def rule_of(host: Column, path: Column, rules) -> Column:
    """The longest rule that fits, as a struct of its text and verdict; null if none does."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for at, under, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(under)
        chosen = F.when(fits, F.struct(F.lit(at + under).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(
            chosen
        )
    return chosen


def page_links(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """(from, to) of every canonical link and refresh redirect outside of comments."""
    url, html, tag = F.col(url_col), F.col(html_col), F.col("tag")
    tags = F.regexp_extract_all(F.regexp_replace(html, COMMENT, " "), F.lit(TAG), F.lit(0))
    canonical = F.concat(F.lit(" "), F.lower(attribute(tag, "rel")), F.lit(" ")).rlike(r"\scanonical\s")
    refresh = F.lower(attribute(tag, "http-equiv")) == "refresh"
    link = F.when(tag.rlike("(?i)^<link"), F.when(canonical, attribute(tag, "href"))).otherwise(
        F.when(refresh, F.regexp_extract(attribute(tag, "content"), IN_CONTENT, 1))
    )
    return (
        pages.where(html.rlike(HINT))
        .select(url.alias("from"), F.explode(tags).alias("tag"))
        .select("from", absolute(link, F.col("from")).alias("to"))
        .where("to is not null")
    )


def alias_verdicts(links: DataFrame, rules) -> DataFrame:
    """(key, alias_verdict): allow if any alias is explicitly allowed, else block if any is blocked."""
    ends = stored(
        links.select(
            *[
                F.struct(
                    alias_key(F.col(end)).alias("key"),
                    rule_of(host_of(F.col(end)), path_of(F.col(end)), rules)["verdict"].alias("verdict"),
                ).alias(end)
                for end in ("from", "to")
            ]
        ),
        "links",
    )
    groups = connected_components(ends.select(F.col("from.key").alias("u"), F.col("to.key").alias("v")))
    nodes = ends.select(F.explode(F.array("from", "to")).alias("end")).select("end.*").distinct()
    members = stored(nodes.join(groups, nodes["key"] == groups["node"]).select("key", "verdict", "component"), "nodes")
    decided = members.groupBy("component").agg(
        F.when(F.max(F.col("verdict") == "allow"), "allow")
        .when(F.max(F.col("verdict") == "block"), "block")
        .alias("alias_verdict")
    )
    return (
        members.join(decided.where("alias_verdict is not null"), "component")
        .select("key", "alias_verdict")
        .distinct()
    )


def judge_urls(
    pages: DataFrame,
    rules=RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    redirects: DataFrame | None = None,
) -> DataFrame:
    """One row per page: page_id, host, path, rule and verdict.

    ``rules`` are (host, path, allow or block); a rule fits its host and all subdomains below its path, and the
    longest rule wins. A page that no rule fits takes its aliases' decision: allow if one of them is explicitly
    allowed, else block if one is blocked, else allow. ``redirects`` may add (from, to) addresses to the links
    found in the pages. A null url or one without ``://`` has empty host and path and is allowed; null html has no
    links; repeated rows are judged alike, and an empty table gives an empty result. Very long pages are read like
    others; columns of ``pages`` may have any names.
    """
    links = page_links(pages, url_col, html_col)
    if redirects is not None:
        links = links.unionByName(redirects.select("from", "to").where("`from` is not null and `to` is not null"))
    aliases = alias_verdicts(links, rules)
    url = F.col(url_col)
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        host_of(url).alias("host"),
        path_of(url).alias("path"),
        # Rows without an address meet no alias, each under a key of its own.
        F.when(url.contains("://"), alias_key(url))
        .otherwise(F.concat(F.lit("://"), F.monotonically_increasing_id().cast("string")))
        .alias("key"),
    ).select("*", rule_of(F.col("host"), F.col("path"), rules).alias("fit"))
    return rows.join(aliases, "key", "left").select(
        "page_id",
        "host",
        "path",
        F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", "alias_verdict", F.lit("allow")).alias("verdict"),
    )


def filter_urls(pages: DataFrame, rules=RULES, id_col="page_id", url_col="url", html_col="html") -> DataFrame:
    """The pages that are allowed, with all their columns."""
    judged = judge_urls(pages, rules, id_col, url_col, html_col)
    blocked = judged.where("verdict = 'block'").select(F.col("page_id").alias("blocked_id")).distinct()
    return pages.join(blocked, pages[id_col].eqNullSafe(blocked["blocked_id"]), "left_anti")


def quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def attribute_sql(name: str) -> str:
    """``attribute`` for DuckDB."""
    value = " || ".join(f"regexp_extract(tag, {quoted(attribute_pattern(name))}, {k})" for k in (1, 2, 3))
    for reference, character in REFERENCES:
        value = f"regexp_replace({value}, {quoted(reference)}, {quoted(character)}, 'g')"
    return rf"regexp_replace({value}, '^\s+|\s+$', '', 'g')"


LINKS_SQL = rf"""
tags AS (
  SELECT url, unnest(regexp_extract_all(regexp_replace(html, {quoted(COMMENT)}, ' ', 'g'), {quoted(TAG)}, 0)) AS tag
  FROM pages
),
found AS (
  SELECT url, CASE
      WHEN regexp_matches(tag, '(?i)^<link') THEN
        CASE WHEN regexp_matches(' ' || lower({attribute_sql("rel")}) || ' ', '\scanonical\s') THEN {attribute_sql("href")} END
      WHEN lower({attribute_sql("http-equiv")}) = 'refresh'
        THEN regexp_extract({attribute_sql("content")}, {quoted(IN_CONTENT)}, 1) END AS link,
    regexp_extract(url, '^([^/]*://[^/?#]*)', 1) AS origin,
    regexp_extract(url, '^[^/]*://[^/?#]*([^?#]*)', 1) AS path
  FROM tags WHERE contains(url, '://')
),
whole AS (
  SELECT url, CASE
      WHEN link = '' OR link IS NULL OR starts_with(link, '#') THEN NULL
      WHEN starts_with(link, '//') THEN regexp_extract(url, '^([^/]*:)//', 1) || link
      WHEN regexp_matches(link, {quoted(SCHEME + "//")}) THEN link
      WHEN regexp_matches(link, {quoted(SCHEME)}) THEN NULL
      WHEN starts_with(link, '/') THEN origin || link
      WHEN starts_with(link, '?') THEN origin || path || link
      ELSE origin || coalesce(nullif(regexp_extract(path, '^.*/', 0), ''), '/') || link END AS b
  FROM found
),
cut AS (
  SELECT url, regexp_extract(b, '^([^/]*://[^/?#]*)', 1) AS origin, regexp_extract(b, '^[^/]*://[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(b, '(?s)^[^/]*://[^?#]*(.*)$', 1) AS tail
  FROM whole WHERE b IS NOT NULL
),
links AS (
  SELECT url AS a, origin || CASE WHEN contains(path, '/.') THEN '/' || array_to_string(list_reduce(
           list_prepend([]::VARCHAR[], list_transform(string_split(path, '/')[2:], lambda x: [x])),
           lambda done, x: CASE WHEN x[1] = '.' THEN done WHEN x[1] = '..' THEN done[1:len(done) - 1] ELSE done || x END)
           || CASE WHEN string_split(path, '/')[-1] IN ('.', '..') THEN [''] ELSE []::VARCHAR[] END, '/')
         ELSE path END || tail AS b
  FROM cut
)"""


@query(
    rf"""
WITH RECURSIVE rules(site, under, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
),
{LINKS_SQL},
urls AS (SELECT url FROM pages UNION SELECT b FROM links),
parsed AS (
  SELECT url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM urls
),
hosts AS (
  SELECT url, coalesce(translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
         coalesce(regexp_extract(rest, '^[^/?#]*([^#]*)', 1), '') AS tail
  FROM parsed
),
fits AS (
  SELECT url, arg_max(site || under, length(site || under)) AS rule, arg_max(verdict, length(site || under)) AS verdict
  FROM hosts JOIN rules ON (host = site OR ends_with(host, '.' || site)) AND starts_with(path, under)
  GROUP BY url
),
nodes AS (SELECT h.url, h.host, h.path, h.host || h.tail AS key, f.rule, f.verdict FROM hosts h LEFT JOIN fits f USING (url)),
edges AS (
  SELECT x.key AS a, y.key AS b FROM links JOIN nodes x ON x.url = links.a JOIN nodes y ON y.url = links.b
  UNION SELECT y.key, x.key FROM links JOIN nodes x ON x.url = links.a JOIN nodes y ON y.url = links.b
),
reach AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
alias AS (
  SELECT r.a AS key, max(verdict = 'allow') AS allowed, max(verdict = 'block') AS blocked
  FROM reach r JOIN nodes n ON n.key = r.b GROUP BY r.a
)
SELECT p.page_id, coalesce(n.host, '') AS host, coalesce(n.path, '') AS path, n.rule,
       coalesce(n.verdict, CASE WHEN a.allowed THEN 'allow' WHEN a.blocked THEN 'block' END, 'allow') AS verdict
FROM pages p LEFT JOIN nodes n ON n.url = p.url LEFT JOIN alias a ON a.key = n.key
"""
)
def op5_url_filters(spark, sf_dir):
    return judge_urls(table(spark, sf_dir, "pages"))
