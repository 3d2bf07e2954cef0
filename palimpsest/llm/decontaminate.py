"""Benchmark decontamination with a generalised suffix automaton over the words of the test items.

The items are dealt into shards of about ``SHARD_WORDS`` words; each shard's automaton is built once and broadcast,
and documents stream through it where they are read, so that no text is shuffled. With several shards the spans of
one pass are stored before the next adds to them.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from palimpsest.llm.common import query, table
from palimpsest.session import stored

WINDOW = 13
COVERAGE = 20
SHARD_WORDS = 200_000
PIECE = 1 << 20

FOUND = "array<struct<start:long,end:long>>"

_keep = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
#: A-Z to a-z; a blank for every ASCII character that is no letter or digit.
FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _keep else 0x20 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


def word_pieces(text: str | None, piece: int = PIECE):
    """The words of a text in lists of bounded size."""
    data = (text or "").encode("utf-8", "surrogatepass")
    at = 0
    while at < len(data):
        part = data[at : at + piece].translate(FOLD)
        while at + len(part) < len(data) and part[-1] != 0x20:
            more = data[at + len(part) : at + len(part) + 4096].translate(FOLD)
            cut = more.find(b" ")
            part += more if cut < 0 else more[: cut + 1]
        yield part.split()
        at += len(part)


class Automaton:
    """Suffix automaton of several word sequences; a match never runs over the end of an item."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]
        for _, words in items:
            last = 0
            for word in words:
                last = self.extend(last, word)
        self.label(items)

    def state(self, length: int, link: int, moves: dict) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def split(self, p: int, word: bytes) -> int:
        """The state for the strings of ``p`` followed by ``word``, parted from longer ones if need be."""
        q = self.next[p][word]
        if self.length[p] + 1 == self.length[q]:
            return q
        clone = self.state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def extend(self, last: int, word: bytes) -> int:
        if word in self.next[last]:
            return self.split(last, word)
        current = self.state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = current
            p = self.link[p]
        if p >= 0:
            self.link[current] = self.split(p, word)
        return current

    def label(self, items) -> None:
        """What a match at a state tells: the items with its last window, and whole short items it ends with."""
        order = sorted(range(len(self.next)), key=self.length.__getitem__)
        # The state of a match's last ``window`` words.
        self.tail = [0] * len(order)
        for s in order:
            up = self.link[s]
            self.tail[s] = s if up < 0 or self.length[up] < self.window else self.tail[up]
        self.windows: dict[int, set] = {}
        ends: dict[int, list] = {}
        for name, words in items:
            s = 0
            for n, word in enumerate(words, 1):
                s = self.next[s][word]
                if n >= self.window:
                    self.windows.setdefault(self.tail[s], set()).add(name)
            if 0 < len(words) < self.window:
                ends.setdefault(s, []).append((len(words), name))
        self.short: list[tuple] = [()] * len(order)
        self.least = [self.window] * len(order)
        for s in order[1:]:
            self.short[s] = self.short[self.link[s]] + tuple(ends.get(s, ()))
            self.least[s] = min([self.window, *(n for n, _ in self.short[s])])

    def search(self, text: str | None) -> tuple[int, list[list[int]], set]:
        """Number of words, spans [first, last] of words inside a window's occurrence, and the windows' items."""
        moves, link, length, least = self.next, self.link, self.length, self.least
        root, state, matched, at = moves[0], 0, 0, 0
        spans, items = [], set()
        for words in word_pieces(text):
            for i, word in enumerate(words, at):
                to = moves[state].get(word)
                if to is None:
                    if word not in root:
                        state = matched = 0
                        continue
                    while to is None:
                        state = link[state]
                        to = moves[state].get(word)
                    matched = length[state]
                state = to
                matched += 1
                if matched >= least[state]:
                    self.note(state, matched, i, spans, items)
            at += len(words)
        return at, merged(spans), items

    def note(self, state: int, matched: int, i: int, spans: list, items: set) -> None:
        if matched >= self.window:
            first = i - self.window + 1
            if spans and spans[-1][1] == i - 1 and spans[-1][0] <= first:
                spans[-1][1] = i
            else:
                spans.append([first, i])
            items |= self.windows[self.tail[state]]
        for n, name in self.short[state]:
            if n <= matched:
                spans.append([i - n + 1, i])
                items.add(name)


def merged(spans) -> list[list[int]]:
    out: list[list[int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return out


def shards_of(benchmark: DataFrame, id_col: str, text_col: str, shard_words: int):
    """The items in lists of about ``shard_words`` words; one list at a time is on the driver."""
    items = benchmark.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).cast("string").alias("text")
    ).where("text is not null")
    # A word takes two characters or more with its separator.
    size = items.agg(F.sum(F.length("text") / 2)).first()[0] or 0
    count = max(1, -(-int(size) // shard_words))
    for shard in range(count):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == shard).collect()
        yield [(r["item"], words_of(r["text"])) for r in rows]


def search_task(batches, automaton):
    tree = automaton.value
    for batch in batches:
        sizes, spans, items = [], [], []
        for text, old, known in zip(batch.column(1), batch.column(3), batch.column(4)):
            n, new, names = tree.search(text.as_py())
            before = [[s["start"], s["end"]] for s in old.as_py()]
            sizes.append(n)
            spans.append([{"start": a, "end": b} for a, b in merged(before + new)])
            items.append(sorted(names.union(known.as_py())))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(sizes, pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                pa.array(items, pa.list_(pa.string())),
            ],
            ["doc", "text", "n_words", "spans", "items"],
        )


def search_items(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """One row per row of ``docs``: doc (all its columns), text, n_words, spans of hit words, items.

    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. A word is hit if it lies in an
    occurrence of ``window`` consecutive words of an item, or of a whole item that is shorter. Null and empty texts
    have no words, items without words are never found, an item without an id goes by the empty one, and items
    that share an id count once. Empty tables give no rows, or rows without spans.
    """
    rows = docs.select(
        F.struct("*").alias("doc"),
        F.col(text_col).cast("string").alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.expr(f"cast(array() as {FOUND})").alias("spans"),
        F.expr("cast(array() as array<string>)").alias("items"),
    )
    context = docs.sparkSession.sparkContext
    for n, items in enumerate(shards_of(benchmark, item_id, item_text, shard_words)):
        if n:
            rows = stored(rows, "spans")
        shared = context.broadcast(Automaton(items, window))
        rows = rows.mapInArrow(lambda batches, shared=shared: search_task(batches, shared), rows.schema)
    return rows


def n_hit():
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"] + 1)


def over_limit(coverage: int = COVERAGE):
    """Whether hit words are a ``coverage``-th of the text or more."""
    return (n_hit() > 0) & (n_hit() * coverage >= F.col("n_words"))


def without_spans(text: str | None, spans) -> str | None:
    """The text without the bytes from the first to the last word of each span."""
    if not spans:
        return text
    data = text.encode("utf-8", "surrogatepass")
    out, at, left = [], 0, [(s["start"], s["end"]) for s in spans]
    for i, word in enumerate(re.finditer(rb"[^ ]+", data.translate(FOLD))):
        if i == left[0][0]:
            out.append(data[at : word.start()])
        if i == left[0][1]:
            at = word.end()
            if len(left) == 1:
                break
            left.pop(0)
    return b"".join([*out, data[at:]]).decode("utf-8", "surrogatepass")


def decontaminate(docs: DataFrame, benchmark: DataFrame, coverage: int = COVERAGE, **options) -> DataFrame:
    """The rows of ``docs`` with hit words below the coverage limit, with all their columns.

    Documents over the limit go; see ``search_items`` for what is hit.
    """
    found = search_items(docs, benchmark, **options).where(~over_limit(coverage))
    return found.select(*[F.col(f"doc.`{c}`") for c in docs.columns])


def cut_spans(docs: DataFrame, benchmark: DataFrame, coverage: int = COVERAGE, text_col: str = "text", **options):
    """All rows of ``docs``, with the hit spans cut from texts over the coverage limit."""
    found = search_items(docs, benchmark, text_col, **options)

    def run(batches):
        for batch in batches:
            texts = [without_spans(t.as_py(), s.as_py()) for t, s in zip(batch.column(1), batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc", "text"])

    cut = found.select("doc", "text", F.when(over_limit(coverage), F.col("spans")).alias("spans"))
    done = cut.mapInArrow(run, cut.select("doc", "text").schema)
    return done.select(*[F.col("text").alias(c) if c == text_col else F.col(f"doc.`{c}`") for c in docs.columns])


@query(
    r"""
WITH items AS (
  SELECT item_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL
),
starts AS (
  SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM items WHERE len(w) > 0
),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM starts),
docs AS (
  SELECT doc_id, coalesce(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, greatest(len(w) - n, -1) + 2)) AS i FROM docs, sizes)
),
hits AS (SELECT doc_id, i, n, item_id FROM places JOIN windows USING (n, s)),
words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""
)
def op6_benchmark_decontamination(spark, sf_dir):
    found = search_items(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc.doc_id",
        "n_words",
        n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        over_limit().alias("contaminated"),
    )
