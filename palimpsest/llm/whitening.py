"""Whitening of embeddings by block Jacobi-Davidson on matrix-free centred products.

The covariance is never formed: a product with it is one pass over the stored vectors, each task multiplying its
centred rows with a thin block and sending back a partial sum, which Spark adds up. The driver holds a search space
of at most ``SPACE`` vectors and their products. Each round takes the Ritz pairs of that space, settles the leading
ones whose residuals have reached double precision, and widens the space by the solutions of the projected
correction equations of the others, found by MINRES for all of them side by side, one pass a step.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from palimpsest.llm.common import query, table
from palimpsest.session import stored

COMPONENTS = 4
SCALE = 256
GUARDS = 4
SPACE = 48
STEPS = 8
ROUNDS = 200
CHECKS = 6
SEED = 12
EXACT = 1 << 62


def usable(rows: DataFrame, vector_col: str) -> DataFrame:
    """Rows whose vector is not null or empty and has finite entries alone."""
    vector = F.col(vector_col)
    wide = vector.cast("array<double>")
    finite = F.forall(wide, lambda c: F.coalesce(F.abs(c) < F.lit(float("inf")), F.lit(False)))
    return rows.where(vector.isNotNull() & (F.size(vector) > 0) & finite)


def grid(vector, scale: int):
    """Each entry as the long below ``scale`` times it."""
    return F.transform(vector.cast("array<double>"), lambda c: F.floor(c * F.lit(float(scale))).cast("long"))


def matrix(column, d: int) -> np.ndarray:
    """A list column as rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


class Fit:
    """The distinct vectors, their number, sums and trace, and products with their covariance."""

    def __init__(self, vectors: DataFrame, d: int):
        self.vectors, self.d, self.passes = vectors, d, 0
        every = vectors.select(F.posexplode("x").alias("k", "c"))
        sums = every.groupBy("k").agg(F.sum(F.col("c").cast("decimal(38,0)")).alias("s")).collect()
        self.n = vectors.count()
        self.sums = [int(r.s) for r in sorted(sums, key=lambda r: r.k)]
        self.mean = np.array([s / self.n for s in self.sums])
        self.trace = float(self.total(lambda z: (z * z).sum(keepdims=True).reshape(1, 1))[0, 0]) / self.n

    def total(self, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum over all vectors of what ``part`` makes of a block of centred rows, a small matrix."""
        mean, d = self.mean, self.d

        def run(batches):
            own = None
            for batch in batches:
                if batch.num_rows:
                    done = part(matrix(batch.column(0), d) - mean)
                    own = done if own is None else own + done
            if own is not None:
                rows, columns = own.shape
                places = [pa.array(np.arange(rows)), pa.array(list(own), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(places, ["k", "values"])

        self.passes += 1
        parts = self.vectors.mapInArrow(run, "k long, values array<double>")
        width = part(np.zeros((1, d))).shape[1]
        sums = [F.sum(F.get("values", F.lit(j))).alias(f"v{j}") for j in range(width)]
        return np.array([r[1:] for r in sorted(parts.groupBy("k").agg(*sums).collect())])

    def product(self, block: np.ndarray) -> np.ndarray:
        """The covariance times ``block``, centred before multiplying."""
        return self.total(lambda z: z.T @ (z @ block)) / self.n


def orthonormal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    """Columns that extend ``against``: orthogonalised twice, what is left of dependent ones dropped."""
    kept = against
    for column in block.T:
        size = np.linalg.norm(column)
        for _ in range(2):
            column = column - kept @ (kept.T @ column)
        if np.linalg.norm(column) > 1e-8 * size > 0:
            column = column / np.linalg.norm(column)
            column = column - kept @ (kept.T @ column)
            kept = np.column_stack([kept, column / np.linalg.norm(column)])
    return kept[:, against.shape[1] :]


def corrections(product, near: np.ndarray, values: np.ndarray, residuals: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions t, orthogonal to ``near``, of (1 - PP')(A - value)(1 - PP') t = -residual, by MINRES.

    The columns are separate equations with a value each; they share the passes.
    """

    def outside(block):
        block = block - near @ (near.T @ block)
        return block - near @ (near.T @ block)

    right = -outside(residuals)
    beta = np.linalg.norm(right, axis=0)
    alive = beta > 0
    v = right / np.where(alive, beta, 1)
    v_old = w = w_old = x = np.zeros_like(right)
    eta, link = beta.copy(), np.zeros_like(beta)
    cos, cos_old, sin, sin_old = np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    for _ in range(steps):
        p = outside(product(v) - v * values)
        alpha = (v * p).sum(axis=0)
        p = p - alpha * v - link * v_old
        link_next = np.linalg.norm(p, axis=0)
        delta = cos * alpha - cos_old * sin * link
        first = np.hypot(delta, link_next)
        second = sin * alpha + cos_old * cos * link
        third = sin_old * link
        alive = alive & (first > 0)
        safe = np.where(alive, first, 1)
        cos_old, cos, sin_old, sin = cos, np.where(alive, delta / safe, 1), sin, np.where(alive, link_next / safe, 0)
        w, w_old = np.where(alive, (v - third * w_old - second * w) / safe, 0), w
        x = x + cos * eta * w * alive
        eta = -sin * eta
        v, v_old = p / np.where(link_next > 0, link_next, 1), v
        link = link_next
        alive = alive & (link_next > 1e-14 * np.abs(values).max(initial=1e-300))
        if not alive.any():
            break
    return x


def leading_pairs(fit: Fit, wanted: int, space: int = SPACE, steps: int = STEPS, rounds: int = ROUNDS):
    """(values, vectors) of the ``wanted`` leading eigenpairs, and the number of rounds taken.

    A pair settles once its residual, from a fresh product, is at the rounding error of a product, and only after
    those before it. As a search space might have missed a leading vector, it is then widened ``CHECKS`` times from
    random directions; a pair that comes up among the leading ones reopens the search.
    """
    d = fit.d
    rng = np.random.default_rng(SEED)
    wide = min(d, wanted + GUARDS)
    space = min(d, max(space, 3 * wide))
    none = np.zeros((d, 0))
    basis = orthonormal(rng.standard_normal((d, wide)), none)
    images = fit.product(basis)
    checked, best, stalled = 0, np.inf, 0
    for done in range(1, rounds + 1):
        inner = basis.T @ images
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        ritz, moved = basis @ turn, images @ turn
        count = min(wanted, basis.shape[1])
        lead = np.linalg.qr(ritz[:, :count])[0]
        fresh = fit.product(lead)
        theta = (lead * fresh).sum(axis=0)
        residuals = fresh - lead * theta
        off = np.linalg.norm(residuals, axis=0)
        limit = 8 * np.sqrt(d) * np.finfo(float).eps * max(values[0], 0)
        worst = off.max()
        stalled = 0 if worst < best / 2 else stalled + 1
        best = min(best, worst)
        settled = off <= (limit if stalled < 6 else 100 * limit)
        open_pairs = np.flatnonzero(~settled) if not settled.all() else np.array([], int)
        if not len(open_pairs):
            if basis.shape[1] == d or checked == CHECKS or count < wanted:
                return theta, lead, done
            checked += 1
        # A full space is cut back to its leading vectors.
        grow = max(len(open_pairs), wide - count)
        if basis.shape[1] + grow > space and basis.shape[1] < d and space < d:
            basis, images = ritz[:, : 2 * wide], moved[:, : 2 * wide]
        if len(open_pairs):
            near = np.linalg.qr(np.column_stack([lead, ritz[:, count:wide]]))[0]
            more = corrections(fit.product, near, theta[open_pairs], residuals[:, open_pairs], steps)
            guard = moved[:, count:wide] - ritz[:, count:wide] * values[count:wide]
            more = np.column_stack([more, guard])
        else:
            guard = moved[:, count:wide] - ritz[:, count:wide] * values[count:wide]
            more = np.column_stack([rng.standard_normal((d, 1)), guard])
        more = orthonormal(more, basis)[:, : d - basis.shape[1]]
        if not more.shape[1]:
            more = orthonormal(rng.standard_normal((d, wide)), basis)[:, : max(0, d - basis.shape[1])]
        if more.shape[1]:
            basis = np.column_stack([basis, more])
            images = np.column_stack([images, fit.product(more)])
        elif settled.all() or stalled > 12:
            return theta, lead, done
    raise RuntimeError(f"residuals {off.tolist()} after {rounds} rounds, wanted {limit}")


def fitted(rows: DataFrame, wanted: int) -> tuple[Fit, np.ndarray, np.ndarray] | None:
    """The fit over the distinct vectors of ``rows`` (x), with values and vectors above rounding error."""
    vectors = stored(rows.select("x").distinct(), "distinct-vectors")
    first = vectors.select(F.size("x").alias("d")).first()
    if not first:
        return None
    fit = Fit(vectors, first.d)
    floor = fit.d * np.finfo(float).eps * fit.trace
    if fit.trace <= 0:
        return fit, np.zeros(0), np.zeros((fit.d, 0))
    values, lead, _ = leading_pairs(fit, min(wanted, fit.d))
    order = np.argsort(-values, kind="stable")
    values, lead = values[order], lead[:, order]
    kept = values > floor
    values, lead = values[kept], lead[:, kept]
    signs = np.sign(lead[np.abs(lead).argmax(axis=0), np.arange(len(values))]) if len(values) else 1
    return fit, values, lead * signs


def commonest_width(rows: DataFrame) -> DataFrame:
    """Rows of the commonest number of entries, of ties the larger one."""
    widths = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("rows"))
    top = widths.orderBy(F.desc("rows"), F.desc("d")).first()
    return rows.where(F.size("x") == (top.d if top else 0))


WHITENED = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whitened(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for each usable row and component.

    Entries become longs, ``scale`` times them rounded down. Mean and covariance (divisor ``n``) are those of the
    distinct vectors; a row's value is its centred vector projected on the unit eigenvector of rank ``component``
    over the root of its eigenvalue. ``deviation`` is the sum of squares of n times the vector less the sums, exact
    (null beyond 38 digits); ``explained`` the eigenvalue's share of the trace; ``identity_error`` how far the
    covariance of the whitened distinct vectors is from the identity at most.

    Rows with a null, empty or not wholly finite vector are left out, and so are vectors of another length than the
    commonest one (of ties the longer). Eigenvalues at rounding error, as of equal vectors, have no component, nor
    are there more components than entries; of equal eigenvalues either vector may come first. Entries too large for
    a long count as the largest. A null id stays null, repeated rows are rows like others; other columns of ``rows``
    are ignored, whatever their names. An empty table gives an empty result.
    """
    kept = usable(rows, vector_col).select(F.col(id_col).alias("vec_id"), grid(F.col(vector_col), scale).alias("x"))
    kept = commonest_width(stored(kept, "vectors"))
    schema = kept.select("vec_id").schema.simpleString()[len("struct<") : -1].replace("vec_id:", "vec_id ")
    found = fitted(kept, components)
    if found is None or not len(found[1]):
        return empty(rows.sparkSession, f"{schema}, {WHITENED}")
    fit, values, lead = found
    weights = lead / np.sqrt(values)
    inner = fit.total(lambda z: (z @ weights).T @ (z @ weights)) / fit.n
    error = float(np.abs(inner - np.eye(len(values))).max())
    n, mean, d, sums, shares = fit.n, fit.mean, fit.d, fit.sums, values / fit.trace

    def run(batches):
        k = len(shares)
        for batch in batches:
            x = matrix(batch.column(1), d)
            m = len(x)
            out = (x - mean) @ weights
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n)),
                    pa.array([v for v in deviations(x, n, sums) for _ in range(k)], pa.decimal128(38, 0)),
                    pa.array(out.reshape(-1)),
                    pa.array(np.tile(shares, m)),
                    pa.array(np.full(m * k, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return kept.mapInArrow(run, f"{schema}, {WHITENED}")


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sums of squares of n times the vectors less the sums, exact; null beyond 38 digits."""
    largest = max(n * abs(int(x.max(initial=0))), n * abs(int(x.min(initial=0))), *map(abs, sums))
    if (2 * largest) ** 2 * len(sums) < EXACT:
        return ((n * x - np.array(sums)) ** 2).sum(axis=1).tolist()
    exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    return [v if v < 10**38 else None for v in exact]


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


@query()
def op12_embedding_whitening(spark, sf_dir):
    rows = whitened(table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").cast("long"))
