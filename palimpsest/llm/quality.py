"""Quality by nearest-neighbour voting among labelled documents in a latent-semantic space.

Terms are trigrams of character classes, which show markup, symbols, shouting and tables in any language, and repeated
neighbouring words. The space is fitted on at most ``PER_LABEL`` labelled documents of either label: tf-idf weights
and the first ``DIMENSIONS`` singular vectors. Those documents' vectors, at most 2 * PER_LABEL * DIMENSIONS floats, are
broadcast; every document's cosines with all of them are computed in blocks, and the nearest vote with their
similarity. Votes are weighed back to the labels' shares among all labelled rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from palimpsest.llm.common import fold_of, query, table

PER_LABEL = 4096
DIMENSIONS = 48
NEIGHBOURS = 25
THRESHOLD = 0.3
FOLDS = 5
TERMS = 2048
BLOCK = 256
PIECE = 1 << 20
SPACE = re.compile(rb"[\x20\x09-\x0D]")


def classes() -> np.ndarray:
    """Class of each byte: blank, line end, digit, capital, small letter or any other UTF-8 byte, each sign its own."""
    table = np.zeros(256, np.int64)
    signs = [c for c in range(0x21, 0x7F) if not chr(c).isalnum()]
    for c in range(256):
        if c >= 0x80 or 0x61 <= c <= 0x7A:
            table[c] = 1
        elif 0x41 <= c <= 0x5A:
            table[c] = 2
        elif 0x30 <= c <= 0x39:
            table[c] = 3
        elif c in (0x0A, 0x0D):
            table[c] = 4
        elif c in signs:
            table[c] = 6 + signs.index(c)
        else:
            table[c] = 5
    return table


CLASS = classes()


def term_counts(text: str | None) -> np.ndarray:
    """Counts of the hashed terms of a whole text, worked off in blocks of about a megabyte."""
    data = (text or "").encode("utf-8", "surrogatepass")
    counts, at = np.zeros(TERMS, np.float32), 0
    while at < len(data):
        end = at + PIECE
        if end < len(data):
            found = SPACE.search(data, end)
            end = found.start() if found else len(data)
        part = data[at:end]
        at = end
        kind = CLASS[np.frombuffer(part, np.uint8)]
        # A run of letters or digits counts as one.
        kind = kind[np.append(True, (kind[1:] != kind[:-1]) | (kind[1:] > 3))]
        if len(kind) > 2:
            code = (kind[:-2] * 1681 + kind[1:-1] * 41 + kind[2:]) % (TERMS - 1)
            counts += np.bincount(code, minlength=TERMS)
        words = part.split()
        counts[TERMS - 1] += sum(map(bytes.__eq__, words, words[1:]))
    return counts


@dataclass
class Space:
    """A fitted latent-semantic space and the labelled vectors in it."""

    weights: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    votes: np.ndarray
    labels: np.ndarray
    prior: float

    def project(self, counts: np.ndarray) -> np.ndarray:
        return unit(unit(np.log1p(counts) * self.weights) @ self.axes)

    def score(self, counts: np.ndarray, neighbours: int) -> np.ndarray:
        """Share of similarity-weighed votes for label 1; the prior where nothing is similar."""
        scores = np.full(len(counts), self.prior)
        if not len(self.vectors):
            return scores
        k = min(neighbours, len(self.vectors))
        cosines = self.project(counts) @ self.vectors.T
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosines, near, axis=1), 0) ** 2 * self.votes[near]
        total = weight.sum(axis=1)
        said = (weight * self.labels[near]).sum(axis=1)
        return np.where(total > 0, said / np.maximum(total, 1e-12), scores)


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def fit_space(counts: np.ndarray, labels: np.ndarray, shares: dict[int, float], dimensions: int) -> Space:
    prior = shares.get(1, 0.5)
    if not len(labels):
        empty = np.zeros((0, dimensions), np.float32)
        return Space(np.ones(TERMS, np.float32), np.zeros((TERMS, dimensions), np.float32), empty, *[np.zeros(0)] * 2, prior)
    weights = np.log((1 + len(counts)) / (1 + np.count_nonzero(counts, axis=0))).astype(np.float32) + 1
    # In place, as the driver holds them all.
    rows = np.log1p(counts)
    rows *= weights
    rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)
    _, axes = np.linalg.eigh(rows.T @ rows)
    axes = np.ascontiguousarray(axes[:, ::-1][:, :dimensions], np.float32)
    taken = {label: max(1, int((labels == label).sum())) for label in (0, 1)}
    votes = np.array([shares[label] / taken[label] for label in labels])
    return Space(weights, axes, unit(rows @ axes).astype(np.float32), votes, labels.astype(np.float64), prior)


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, per_label: int, dimensions: int
) -> Space:
    """Fit on at most ``per_label`` ids of either label outside the held-out fold; the draw is a hash of the id.

    An id counts once however often its label or its document is repeated: of several texts the one with the smallest
    hash. Ids that are labelled both ways say nothing.
    """
    said = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where(
        F.col("id").isNotNull() & F.col("label").isin(0, 1) & (fold_of(F.col("id"), FOLDS) != 0)
    )
    known = said.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most")
    known = known.select("id", "label")
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    shares = {label: n / sum(sizes.values()) for label, n in sizes.items()}
    drawn = [
        known.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(per_label) for label in (0, 1)
    ]
    texts = (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
        .join(F.broadcast(drawn[0].union(drawn[1])), "id")
        .select("id", "label", F.xxhash64("text").alias("hash"), "text")
    )

    def run(batches):
        for batch in batches:
            found = np.array([term_counts(t.as_py()) for t in batch.column(3)], np.float32).reshape(-1, TERMS)
            places = [np.flatnonzero(row) for row in found]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    pa.array([p.tolist() for p in places], pa.list_(pa.int32())),
                    pa.array([row[p].tolist() for row, p in zip(found, places)], pa.list_(pa.float32())),
                ],
                [*schema.names],
            )

    schema = texts.drop("text").schema.add("terms", T.ArrayType(T.IntegerType())).add("counts", T.ArrayType(T.FloatType()))
    one = F.min(F.struct("hash", "label", "terms", "counts")).alias("one")
    drawn_rows = texts.mapInArrow(run, schema).groupBy("id").agg(one).select("one.label", "one.terms", "one.counts")
    return fit_space(*in_order(drawn_rows.toArrow()), shares, dimensions)


def in_order(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Counts and labels of the drawn rows by label, terms and counts, so that the fit does not depend on their order.

    The lists stay arrays: as Python numbers they would take the driver ten times the memory. Terms and counts are
    never negative, so their big-endian bytes sort as they do.
    """
    rows = rows.combine_chunks()
    labels = rows.column("label").to_numpy().astype(np.int64)
    terms, found = (column.chunk(0) if column.num_chunks else None for column in (rows.column("terms"), rows.column("counts")))
    if not len(labels):
        return np.zeros((0, TERMS), np.float32), labels
    ends = terms.offsets.to_numpy()
    places, values = terms.values.to_numpy(), found.values.to_numpy()
    shift = found.offsets.to_numpy()[0] - ends[0]

    def key(i):
        at, end = ends[i], ends[i + 1]
        return labels[i], places[at:end].astype(">i4").tobytes(), values[at + shift : end + shift].astype(">f4").tobytes()

    order = sorted(range(len(labels)), key=key)
    counts = np.zeros((len(order), TERMS), np.float32)
    for to, i in enumerate(order):
        at, end = ends[i], ends[i + 1]
        counts[to, places[at:end]] = values[at + shift : end + shift]
    return counts, labels[order]


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    per_label: int = PER_LABEL,
    dimensions: int = DIMENSIONS,
    neighbours: int = NEIGHBOURS,
) -> DataFrame:
    """One row per row of ``docs``: doc (all its columns) and score, 0 to 1, higher where label 1 is likelier.

    The score comes from the text alone. A null or empty text, and one like no labelled text, scores the share of
    label 1 among the labelled rows, 0.5 if there are none. Labels other than 0 and 1 and labels without an id are
    ignored; rows that repeat an id are scored each by its own text. Of neighbours equally near at the last place
    some vote. Very long texts are counted whole; columns of ``docs`` may have any names.
    """
    space = docs.sparkSession.sparkContext.broadcast(
        learn(docs, labels, id_col, text_col, label_col, per_label, dimensions)
    )

    def run(batches):
        for batch in batches:
            texts, scores = batch.column(1), []
            for at in range(0, batch.num_rows, BLOCK):
                counts = np.array([term_counts(t.as_py()) for t in texts.slice(at, BLOCK)], np.float32)
                scores.append(space.value.score(counts, neighbours))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.clip(np.concatenate([np.zeros(0), *scores]), 0, 1), pa.float64())],
                ["doc", "score"],
            )

    rows = docs.select(F.struct("*").alias("doc"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, rows.select("doc").schema.add("score", "double"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with all their columns."""
    kept = quality_scores(docs, labels, **options).where(F.col("score") >= threshold)
    return kept.select(*[F.col(f"doc.`{c}`") for c in docs.columns])


@query()
def op4_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality_scores(docs, table(spark, sf_dir, "labels"))
    return scored.select(
        "doc.doc_id",
        (fold_of(F.col("doc.doc_id"), FOLDS) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
