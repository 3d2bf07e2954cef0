"""Repeated line runs found with a suffix array over line ids, built by distributed prefix doubling.

A line that occurs once ends every run, so only stretches of repeated lines with ``min_words`` words or more take
part. Their suffixes are ranked by their first 1, 2, 4, ... lines: a round pairs each rank with the rank that many
lines on, sorts the distinct pairs over all partitions and hands their places back as the next ranks. Equal ranks
are a depth-2**k interval of the suffix array; the suffixes that share exactly m lines' prefix, the
longest-common-prefix interval of depth m, are those with equal ranks at both ends of the m lines.

Every run of ``min_words`` words or more is a union of runs that fall short once their first or their last line is
taken away. These have at most ``min_words`` lines, so doubling ends at that depth whatever the size of the input,
and removing the later copies of each of them removes the later copies of all maximal runs.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window, functions as F

from palimpsest.llm.common import query, table
from palimpsest.session import stored

MIN_WORDS = 50
BLANK = " \t\n\r\x0b\x0c"
#: Line ends before a line with words: lines without words belong to the line before them.
BREAK = r"\n(?=[ \t\r\x0B\f]*[^ \t\n\r\x0B\f])"
WORD = r"[^\x20\x09-\x0D]+"
#: What else than single spaces may stand between words: searched as plain text, which costs far less than a pattern.
WIDE = ("  ", "\t", "\n", "\x0b", "\x0c", "\r")


def doc_key(id_col: str, text_col: str) -> Column:
    """Rows that repeat both id and text are one document."""
    return F.struct(F.col(id_col).alias("doc_id"), F.unhex(F.md5(F.col(text_col))).alias("digest"))


def lines_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc, line (place in the text), id and words of each line."""
    bodies = F.transform(F.split(F.col(text_col), BREAK), lambda x: F.trim(x, F.lit(BLANK)))
    # The key in a step of its own: beside the explode it would be made anew from the whole text for every line.
    return (
        docs.select(doc_key(id_col, text_col).alias("doc"), bodies.alias("bodies"))
        .select("doc", F.posexplode("bodies").alias("line", "body"))
        .where("body <> ''")
        .select(
            "doc", "line", F.unhex(F.md5("body")).alias("id"), words_in(F.col("body")).alias("words")
        )
    )


def words_in(body: Column) -> Column:
    """Words of a line without white space at its ends; most have single spaces, which need no matching."""
    spaces = F.octet_length(body) - F.octet_length(F.replace(body, F.lit(" "), F.lit("")))
    wide = functools.reduce(Column.__or__, [F.contains(body, F.lit(x)) for x in WIDE])
    return F.when(wide, F.regexp_count(body, F.lit(WORD))).otherwise(spaces + 1)


def stretches_of(lines: DataFrame, min_words: int) -> DataFrame:
    """Longest stretches of repeated lines, in document order: sid, doc and an array of their lines."""
    repeated = lines.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id")
    places = Window.partitionBy("doc").orderBy("line")
    return (
        lines.join(repeated, "id")
        .distinct()
        .withColumn("stretch", F.col("line") - F.row_number().over(places))
        .groupBy("doc", "stretch")
        .agg(
            F.sort_array(F.collect_list(F.struct("line", "words", "id"))).alias("lines"),
            F.sum("words").alias("words"),
        )
        .where(F.col("words") >= min_words)
        .orderBy("doc", "stretch")
        .select(F.monotonically_increasing_id().alias("sid"), "doc", "lines")
    )


def deciding_runs(stretches: DataFrame, min_words: int) -> DataFrame:
    """sid, pos, id and sizes: the numbers m for which m lines from ``pos`` are a shortest run of enough words."""
    flat = stretches.select("sid", F.posexplode("lines").alias("pos", "at"))
    ahead = Window.partitionBy("sid").orderBy("pos").rowsBetween(0, min_words - 1)
    words = F.collect_list("at.words").over(ahead)
    # Words of the first 1, 2, 3, ... lines.
    sums = F.aggregate(
        "ahead",
        F.expr("cast(array() as array<int>)"),
        lambda sums, w: F.concat(sums, F.array(F.coalesce(F.try_element_at(sums, F.lit(-1)), F.lit(0)) + w)),
    )
    shortest = F.expr(
        f"filter(sequence(1, size(sums)), m -> sums[m - 1] >= {min_words}"
        f" and (sums[m - 1] - sums[0] < {min_words} or m = 1 or sums[m - 2] < {min_words}))"
    )
    return (
        flat.select("sid", "pos", F.col("at.id").alias("id"), words.alias("ahead"))
        .select("sid", "pos", "id", sums.alias("sums"))
        .select("sid", "pos", "id", shortest.alias("sizes"))
    )


def ranked(rows: DataFrame, keys: list[str], level: int) -> DataFrame:
    """``rows`` with the order of their keys as ``rank``: equal for equal keys, larger for larger ones.

    Only distinct keys are sorted, so a frequent one costs partial counts and a join that splits, not a task's sort.
    The places are stored: they must not change when a lost task runs again. Their files say little about their size
    in memory, here as in ``copied_lines``, so Spark is not left to broadcast them.
    """
    places = stored(
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(*keys)
        .select(*keys, F.monotonically_increasing_id().alias("rank")),
        f"ranks-{level}",
    )
    return rows.join(places.hint("merge"), keys).drop(*keys)


def shared_runs(stretches: DataFrame, min_words: int) -> DataFrame:
    """sid, pos, m and the interval (m, head, tail) of every deciding run."""
    runs = stored(deciding_runs(stretches, min_words), "runs")
    longest = runs.agg(F.max(F.array_max("sizes"))).first()[0] or 0
    level, ranks, found = 0, ranked(runs, ["id"], 0), []
    while 1 << level <= longest:
        width = 1 << level
        ranks = stored(ranks, f"suffixes-{level}")
        order = Window.partitionBy("sid").orderBy("pos")
        sizes = F.filter("sizes", lambda m: (m >= width) & (m < 2 * width))
        found.append(
            ranks.select(
                "sid",
                "pos",
                F.col("rank").alias("head"),
                F.collect_list("rank").over(order.rowsBetween(0, width)).alias("tails"),
                sizes.alias("sizes"),
            )
            .select("sid", "pos", "head", "tails", F.explode("sizes").alias("m"))
            .select("sid", "pos", "m", "head", F.get("tails", F.col("m") - width).alias("tail"))
        )
        # A stretch's end sorts before every line.
        pairs = ranks.select(
            "sid",
            "pos",
            "sizes",
            F.col("rank").alias("head"),
            F.coalesce(F.lead("rank", width).over(order), F.lit(-1)).alias("tail"),
        )
        level += 1
        if 1 << level <= longest:
            ranks = ranked(pairs, ["head", "tail"], level)
    if not found:
        return runs.selectExpr("sid", "pos", "0 as m", "0L as head", "0L as tail").where("false")
    every = found[0]
    for part in found[1:]:
        every = every.unionByName(part)
    return every


def copied_lines(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """doc and the places of its lines that are later copies, for documents that have any."""
    stretches = stored(stretches_of(lines_of(docs, id_col, text_col), min_words), "stretches")
    runs = stored(shared_runs(stretches, min_words), "intervals")
    interval = ["m", "head", "tail"]
    first = (
        runs.groupBy(*interval)
        .agg(F.min(F.struct("sid", "pos")).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    # A copy that overlaps the first one loses only what lies beyond the first one's end.
    beyond = F.when(F.col("first.sid") == F.col("sid"), F.col("first.pos") + F.col("m")).otherwise(F.lit(0))
    later = (
        runs.join(first.hint("merge"), interval)
        .where(F.struct("sid", "pos") != F.col("first"))
        .select("sid", F.greatest("pos", beyond).alias("from"), (F.col("pos") + F.col("m") - 1).alias("to"))
    )
    return (
        later.join(stretches.hint("merge"), "sid")
        .select("doc", F.get("lines", F.col("from"))["line"].alias("start"), F.get("lines", F.col("to"))["line"].alias("end"))
        .groupBy("doc")
        .agg(F.array_distinct(F.flatten(F.collect_list(F.sequence("start", "end")))).alias("drops"))
    )


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    dropped: str | None = "n_dropped",
) -> DataFrame:
    """All rows and columns of ``docs``, the text without later copies of line runs, and ``dropped``, how many lines.

    A column of ``docs`` that is named like ``dropped`` gives way to it; None adds no column.

    A run is a sequence of lines of one document with ``min_words`` words or more; lines without words stand in no
    run's way, go with the line before them and do not count. Lines are equal when identical but for white space at their ends. Of
    a run's copies the first in the order of (id, text digest, line) stays, null being the smallest id, and of one that
    overlaps it only the lines beyond its end go. Very long texts and lines are lines like others. Rows that
    repeat both id and text are one document and keep or lose the same lines. A null text stays null, an empty text
    empty; an empty table gives an empty result. A text that loses no line stays as it is.
    """
    columns = [c for c in docs.columns if c != dropped]
    text = F.col(f"row.`{text_col}`")
    drops = copied_lines(docs, id_col, text_col, min_words)
    lines = F.split(text, BREAK)
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("drops"))
    kept = F.array_join(F.transform(left, lambda i: F.get(F.col("lines"), i)), "\n")
    cleaned = (
        docs.select(F.struct("*").alias("row"), doc_key(id_col, text_col).alias("key"))
        .join(drops.withColumnRenamed("doc", "copied"), F.col("key").eqNullSafe(F.col("copied")), "left")
        .select("row", "drops", F.when(F.col("drops").isNotNull(), lines).alias("lines"))
        .select(
            "row",
            F.when(F.col("drops").isNull(), text).otherwise(kept).alias("cleaned"),
            F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("gone"),
        )
    )
    own = [F.col("cleaned").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in columns]
    return cleaned.select(*own, *([F.col("gone").alias(dropped)] if dropped else []))


@query(
    r"""
WITH split AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS body, generate_subscripts(string_split(text, chr(10)), 1) AS place
  FROM documents
),
raw AS (
  SELECT *, count(CASE WHEN regexp_matches(body, '[^\x20\x09-\x0D]') THEN 1 END)
         OVER (PARTITION BY doc_id ORDER BY place) AS line
  FROM split
),
lines AS (
  SELECT doc_id, line, trim(body, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS body,
         len(regexp_extract_all(body, '[^\x20\x09-\x0D]+')) AS words
  FROM raw WHERE regexp_matches(body, '[^\x20\x09-\x0D]')
),
sums AS (SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY line) AS upto FROM lines),
runs AS (
  SELECT a.doc_id, a.line, b.line - a.line + 1 AS m
  FROM sums a JOIN sums b ON a.doc_id = b.doc_id AND b.line BETWEEN a.line AND a.line + 49
  WHERE b.upto - a.upto + a.words >= 50 AND (b.upto - a.upto < 50 OR b.upto - b.words - a.upto + a.words < 50)
),
bodies AS (
  SELECT r.doc_id, r.line, r.m, md5(string_agg(l.body, chr(10) ORDER BY l.line)) AS body
  FROM runs r JOIN lines l ON l.doc_id = r.doc_id AND l.line BETWEEN r.line AND r.line + r.m - 1
  GROUP BY r.doc_id, r.line, r.m
),
later AS (
  SELECT *, first_value(doc_id) OVER copies AS first_doc, first_value(line) OVER copies AS first_line FROM bodies
  WINDOW copies AS (PARTITION BY body ORDER BY doc_id, line) QUALIFY row_number() OVER copies > 1),
drops AS (
  SELECT DISTINCT doc_id, unnest(range(CASE WHEN first_doc = doc_id THEN greatest(line, first_line + m) ELSE line END,
                                       line + m)) AS line FROM later),
kept AS (
  SELECT r.doc_id, string_agg(r.body, chr(10) ORDER BY r.place) FILTER (WHERE d.line IS NULL) AS text,
         count(DISTINCT d.line) AS n_dropped
  FROM raw r LEFT JOIN drops d USING (doc_id, line) GROUP BY r.doc_id
)
SELECT doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text, coalesce(n_dropped, 0) AS n_dropped
FROM documents d LEFT JOIN kept k USING (doc_id)
"""
)
def op1_line_dedup(spark, sf_dir):
    return line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
