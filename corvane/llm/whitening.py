"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

Entries become whole numbers on a fixed grid, so counts, sums and deviations are
exact. One step of the bidiagonalisation is one job: every task multiplies its
centred rows by the newest right vector (Xv), takes off what the left vectors
already hold, and multiplies back (Xᵀu); the products add up in a grouping.
Left vectors have one entry per row, so none is ever stored or sent: each is X
times a short vector, and tasks make their part of it anew. Both sides are
reorthogonalised against all earlier vectors. The small bidiagonal matrix that
remains holds the deviations, and its singular vectors turn the right vectors
into components.

The driver and a broadcast hold a few matrices of the width of a vector,
whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.tables import named, ship, written

COMPONENTS = 8
GRID, SHIFT = 1024, 100_000  # an entry c becomes floor(GRID * c) + SHIFT
ALL_STEPS = 256  # vectors of up to this length take every step, wider ones stop when converged
NEGLIGIBLE = 1e-10  # of the largest entry of the bidiagonal matrix, what counts as nothing
CONVERGED = 1e-14  # residual of a component, as a share of its gap to the next deviation
_LARGEST = 2.0**50  # an entry from here on does not fit the grid


@dataclass(frozen=True)
class Fit:
    """What the fit list says: rows, sums per dimension, components as columns, their variances, and all variance."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    variances: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.n * x - self.sums) / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / np.sqrt(self.variances)


def on_grid(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x) of the vectors that take part, x as whole numbers.

    Left out are vectors that are null or empty, that hold a null, non-finite
    or, beyond 2**50, off-grid entry, and those of another length than most (of
    equally frequent lengths the larger counts).
    """
    entries = rows.select(named(id_col).alias("vec_id"), named(vector_col).cast("array<double>").alias("entries"))
    sound = entries.filter(
        (F.size("entries") > 0)
        & F.forall("entries", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(_LARGEST)))
    )
    x = F.transform("entries", lambda c: F.floor(c * GRID) + F.lit(SHIFT).cast("bigint"))
    placed = written(sound.select("vec_id", x.alias("x")).hint("rebalance"), "entries")
    widths = placed.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).limit(2)
    common = widths.collect()
    return placed if len(common) < 2 else placed.filter(F.size("x") == common[0]["width"])


def _matrices(source: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in source:
        if batch.num_rows:
            flat = batch.column(column).flatten().to_numpy(zero_copy_only=False)
            yield batch, flat.reshape(batch.num_rows, -1)


def _totals(rows: DataFrame, kind: str, width: int, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all batches of ``part``, an array of ``width`` numbers made from a matrix of vectors."""
    ship(rows.sparkSession)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _matrices(source, 0):
            total = part(x) if total is None else total + part(x)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total)], names=["place", "part"])

    parts = rows.select("x").mapInArrow(batches, f"place bigint, part {kind}")
    table = parts.groupBy("place").agg(F.sum("part").alias("total")).toArrow()  # ``width`` rows
    total = np.zeros(width, dtype=np.int64 if kind == "bigint" else np.float64)
    total[table["place"].to_numpy()] = table["total"].to_numpy()
    return total


def _orthogonal(vector: np.ndarray, basis: np.ndarray) -> np.ndarray:
    for _ in range(2):  # once more for what the first round leaves by rounding
        vector = vector - basis @ (basis.T @ vector)
    return vector


def _fresh(basis: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """A random unit vector at right angles to the columns of ``basis``."""
    vector = _orthogonal(draw.standard_normal(len(basis)), basis)
    return vector / np.linalg.norm(vector)


def bidiagonalised(rows: DataFrame, n: int, sums: np.ndarray, wanted: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(B, V): the upper bidiagonal matrix of X = U B Vᵀ, and the right vectors as columns of V.

    X holds the centred rows. A step that finds nothing new (the rows have
    fewer dimensions than entries, or a deviation occurs twice) goes on from a
    fresh right vector with a zero in B.
    """
    width = len(sums)
    draw = np.random.default_rng(seed)
    right = np.zeros((width, 0))
    left = np.zeros((width, 0))  # column j, times X, is left vector j
    back = np.zeros((width, 0))  # Xᵀ times left vector j
    alphas, betas = [], []
    vector, beta = _fresh(right, draw), 0.0
    while True:
        last = left[:, -1] if len(alphas) else np.zeros(width)
        forward = np.column_stack((left, vector - beta * last))

        def part(x, forward=forward):
            centred = (n * x - sums) / n
            products = centred @ forward
            new = products[:, -1]
            return np.concatenate((new @ products, centred.T @ new))

        totals = _totals(rows, "double", forward.shape[1] + width, part)
        held, square, returned = totals[: len(alphas)], totals[len(alphas)], totals[len(alphas) + 1 :]
        alpha = np.sqrt(max(square - held @ held, 0.0))
        right = np.column_stack((right, vector))
        scale = max([alpha, *alphas, *betas])
        if alpha > NEGLIGIBLE * scale:
            left = np.column_stack((left, (forward[:, -1] - left @ held) / alpha))
            back = np.column_stack((back, (returned - back @ held) / alpha))
        else:
            alpha = 0.0
            left = np.column_stack((left, np.zeros(width)))
            back = np.column_stack((back, np.zeros(width)))
        alphas.append(alpha)
        following = _orthogonal(back[:, -1] - alpha * vector, right)
        beta = float(np.linalg.norm(following))
        small = np.diag(alphas) + np.diag(betas, 1)
        if len(alphas) == width or width > ALL_STEPS and _converged(small, beta, wanted):
            return small, right
        if beta > NEGLIGIBLE * scale:
            vector = following / beta
        else:
            vector, beta = _fresh(right, draw), 0.0
        betas.append(beta)


def _converged(small: np.ndarray, beta: float, wanted: int) -> bool:
    """Whether the next step can no longer turn the first ``wanted`` singular vectors."""
    if len(small) <= wanted:
        return False
    left, deviations, _ = np.linalg.svd(small)
    gaps = deviations[:wanted] - deviations[1 : wanted + 1]
    nearest = np.minimum(gaps, np.concatenate(([np.inf], gaps[:-1])))
    return bool(np.all(beta * np.abs(left[-1, :wanted]) <= CONVERGED * nearest))


def fit(placed: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """Components of the vectors of (vec_id, x), by falling variance; None without vectors.

    Components without variance are left out. The largest entry of each is positive.
    """
    first = placed.select(F.size("x").alias("width")).first()
    if first is None:
        return None
    width = first["width"]
    counted = _totals(placed, "bigint", width + 1, lambda x: np.append(x.sum(axis=0), len(x)))
    n, sums = int(counted[-1]), counted[:-1]
    trace = _totals(placed, "double", 1, lambda x: np.array([(((n * x - sums) / n) ** 2).sum()]))[0] / n
    small, right = bidiagonalised(placed, n, sums, components)
    _, deviations, turned = np.linalg.svd(small)
    kept = (deviations > NEGLIGIBLE * deviations[0])[:components] if deviations[0] > 0 else np.zeros(0, bool)
    found = (right @ turned.T)[:, : len(kept)][:, kept]
    if found.size:
        found = found * np.sign(found[np.abs(found).argmax(axis=0), np.arange(found.shape[1])])
    return Fit(n, sums, found, deviations[: len(kept)][kept] ** 2 / n, trace)


def identity_error(placed: DataFrame, model: Fit) -> float:
    """The largest absolute entry of the covariance of the whitened vectors minus the identity."""
    count = len(model.variances)

    def part(x):
        white = model.whitened(x)
        return np.concatenate((white.sum(axis=0), (white.T @ white).ravel()))

    totals = _totals(placed, "double", count + count * count, part) / model.n
    mean, second = totals[:count], totals[count:].reshape(count, count)
    return float(np.abs(second - np.outer(mean, mean) - np.eye(count)).max())


def squared_deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Per row the sum over dimensions of (n x - S) squared, exact; null where it passes 64 bits."""
    apart = n * x - sums
    if float(np.abs(apart).max()) ** 2 * apart.shape[1] < 2.0**62:
        return (apart * apart).sum(axis=1).tolist()
    wide = [sum(value * value for value in row) for row in apart.tolist()]
    return [value if value < 1 << 63 else None for value in wide]


def whiten(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained and identity_error.

    One row per vector that takes part (:func:`on_grid`) and component. ``n`` is
    the number of these vectors, ``deviation`` the exact sum over dimensions of
    (n x - S) squared, ``explained`` a component's share of all variance.
    Repeated rows count as often as they occur, ids may be null. Without any
    variance, one vector for instance, and for an empty table the result is
    empty.
    """
    placed = on_grid(rows, id_col, vector_col)
    kind = placed.schema["vec_id"].dataType.simpleString()
    schema = (
        f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, "
        "identity_error double"
    )
    model = fit(placed, components)
    if model is None or not len(model.variances):
        return rows.sparkSession.createDataFrame([], schema)
    error = identity_error(placed, model)
    count = len(model.variances)
    explained = model.variances / model.trace

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _matrices(source, 1):
            each = np.repeat(np.arange(len(x)), count)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(each), model.n)),
                    pa.array(squared_deviations(x, model.n, model.sums), pa.int64()).take(pa.array(each)),
                    pa.array(model.whitened(x).ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(each), error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return placed.mapInArrow(batches, schema)
