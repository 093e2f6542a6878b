"""Whitened components of vectors of whole numbers, by shifted Cholesky QR.

A pass over the vectors sums the products of the centred rows (the Gram matrix); its Cholesky factor, with a little added to
the diagonal where it is close to singular, is the next triangular factor. The next pass solves each row against
the factors so far, which leaves rows that are closer to orthogonal, and sums products again. When the rows are
orthonormal the product of the factors is R of the centred rows, and the singular value decomposition of R gives
components and variances to double precision. A covariance matrix alone would lose half of the digits of
small variances.

Between tasks and driver there is only one number per pair of dimensions; the vectors stay where they are and are read anew in
each pass, so a lost executor costs its part of one pass. Rows are centred exactly, as n * x - sum in 64 bits.

Defined results: a row whose vector is null or empty, or whose length differs from the one most vectors have (of two as
frequent, the longer), takes no part and gets no rows. Null and repeated ids are kept, each row gets its own result.
Components without variance are left out, so equal vectors, or one vector, or none, give no rows. Only the named
columns are read. Numbers so large that n * x overflows 64 bits end the job with an error that says so.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import common_length, embeddings, finite, matrix, whole

COMPONENTS = 8
SCALE = 1024
#: Added to each entry by the query.
ADDED = 100_000
#: Passes end when products of the orthogonalised rows differ from the identity by no more.
CLOSE = 1e-12
MOST_PASSES = 20
#: Singular values below this share of the largest are rounding, not variance.
RANK = 1e-10
#: Entries of a block of rows that is worked on at a time.
BLOCK = 1 << 20
UNIT = np.finfo(float).eps / 2


def solved(rows: np.ndarray, factor: np.ndarray, width: int = 32) -> np.ndarray:
    """``rows`` times the inverse of the upper triangular ``factor``, by substitution in blocks of columns."""
    out = np.empty_like(rows)
    for begin in range(0, rows.shape[1], width):
        end = min(begin + width, rows.shape[1])
        block = rows[:, begin:end] - out[:, :begin] @ factor[:begin, begin:end]
        for j in range(end - begin):
            block[:, j] -= block[:, :j] @ factor[begin : begin + j, begin + j]
            block[:, j] /= factor[begin + j, begin + j]
        out[:, begin:end] = block
    return out


def cholesky(gram: np.ndarray) -> np.ndarray:
    """The upper triangular factor of ``gram``, with a shift of its diagonal where it needs one."""
    size = len(gram)
    scale = np.linalg.norm(gram, 2)
    shift = 0.0 if np.linalg.eigvalsh(gram)[0] > 1e-3 * scale else 11 * size * (size + 1) * UNIT * scale
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(size)).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, UNIT * scale)


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Parts of batches and their vectors, the last column."""
    rows = max(1, BLOCK // width)
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            part = batch.slice(begin, rows)
            yield part, matrix(part.column(part.num_columns - 1), width)


def _summed(vectors: DataFrame, width: int, of: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray:
    """The sum over all blocks of vectors of the flat array ``of`` makes of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _blocks(batches, width):
            part = of(x)
            total = part if total is None else total + part
        for begin in range(0, 0 if total is None else len(total), 1 << 16):
            values = total[begin : begin + (1 << 16)]
            yield pa.RecordBatch.from_pydict({"cell": np.arange(begin, begin + len(values)), "value": values})

    cells = vectors.select("_x").mapInArrow(run, f"cell long, value {kind}")
    found = cells.groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    order = np.argsort(found["cell"].to_numpy())
    return found["value"].to_numpy()[order]


def _symmetric(cells: np.ndarray, size: int) -> np.ndarray:
    full = np.zeros((size, size))
    full[np.triu_indices(size)] = cells
    return full + np.triu(full, 1).T


class Fit:
    """Means, components and variances; ``whitened`` applies them."""

    def __init__(self, n: int, sums: np.ndarray, axes: np.ndarray, variances: np.ndarray, trace: float):
        self.n, self.sums, self.axes, self.variances, self.trace = n, sums, axes, variances, trace

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n times the distance of each entry from its mean, exactly."""
        return self.n * x - self.sums

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.deviations(x) / self.n @ self.axes / np.sqrt(self.variances)


def fit(vectors: DataFrame, width: int, n: int, components: int) -> Fit:
    """The first components of the vectors in column ``_x``, all of one length."""
    sums = _summed(vectors, width, lambda x: x.sum(axis=0), "long")
    upper = np.triu_indices(width)
    factors: list[np.ndarray] = []
    whole_factor = np.eye(width)
    for _ in range(MOST_PASSES):

        def products(x: np.ndarray) -> np.ndarray:
            rows = (n * x - sums) / n
            for factor in factors:
                rows = solved(rows, factor)
            return (rows.T @ rows)[upper]

        gram = _symmetric(_summed(vectors, width, products, "double"), width)
        left, values, right = np.linalg.svd(whole_factor)
        rank = int(np.count_nonzero(values > RANK * values[0]))
        if factors and np.abs(left[:, :rank].T @ gram @ left[:, :rank] - np.eye(rank)).max() <= CLOSE:
            break
        if not gram.any():
            rank = 0
            break
        factors.append(cholesky(gram))
        whole_factor = factors[-1] @ whole_factor
    variances = values**2 / n
    kept = min(rank, components)
    axes = right[:kept].T
    # One sign for all rows: the largest entry of each component is positive.
    signs = np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(kept)]) if kept else np.ones(0)
    return Fit(n, sums, axes * signs, variances[:kept], float(variances.sum()))


def identity_error(vectors: DataFrame, width: int, model: Fit) -> float:
    """How far the covariance of the whitened vectors is from the identity, at the worst entry; from a pass of its own."""
    size = len(model.variances)
    upper = np.triu_indices(size)

    def moments(x: np.ndarray) -> np.ndarray:
        white = model.whitened(x)
        return np.concatenate([white.sum(axis=0), (white.T @ white)[upper]])

    total = _summed(vectors, width, moments, "double") / model.n
    mean = total[:size]
    covariance = _symmetric(total[size:], size) - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(size)).max())


def squares(rows: np.ndarray) -> list[int]:
    """The sum of squares of each row, exact: entries of less than twice ``half_bits`` are split in two, so no part overflows."""
    bits = half_bits(rows.shape[1])
    high, low = rows >> bits, rows & ((1 << bits) - 1)
    parts = [(a * b).sum(axis=1).tolist() for a, b in ((high, high), (high, low), (low, low))]
    return [(hh << 2 * bits) + (hl << bits + 1) + ll for hh, hl, ll in zip(*parts)]


def half_bits(width: int) -> int:
    """So many bits that ``width`` products of two numbers of that size add up to less than 2^62."""
    return (62 - (width - 1).bit_length()) // 2


def whiten(rows: DataFrame, id: str = "vec_id", vector: str = "vector", components: int = COMPONENTS) -> DataFrame:
    """A row per vector and component: id, component (from 1), n, deviation, whitened, explained, identity_error.

    ``vector`` holds whole numbers. ``deviation`` is the sum over dimensions of (n * x - sum)^2, exact.
    """
    spark = rows.sparkSession
    taken = rows.select(F.col(id).alias("_id"), F.col(vector).cast("array<bigint>").alias("_x"))
    width, n, largest = common_length(taken, "_x")
    vectors = taken.where(F.size("_x") == width) if width else taken.where("false")
    schema = (
        f"{id} {taken.schema['_id'].dataType.simpleString()}, component int, n long, deviation decimal(38,0), "
        "whitened double, explained double, identity_error double"
    )
    if width and 2 * n * largest >= 1 << 2 * half_bits(width):
        raise ValueError(f"{n} vectors with entries up to {largest} are too many or too large to be centred exactly in 64 bits")
    model = fit(vectors, width, n, components) if n else None
    if model is None or not len(model.variances):
        return spark.createDataFrame([], schema)
    error = identity_error(vectors, width, model)
    explained = model.variances / model.trace
    k = len(explained)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _blocks(batches, width):
            each = np.repeat(np.arange(len(x)), k)
            deviation = pa.array(map(str, squares(model.deviations(x))), pa.string())
            columns = {
                "id": part.column(0).take(pa.array(each)),
                "component": np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)),
                "deviation": deviation.take(pa.array(each)),
                "whitened": model.whitened(x).ravel(),
                "explained": np.tile(explained, len(x)),
            }
            yield pa.RecordBatch.from_pydict(columns)

    id_type = taken.schema["_id"].dataType.simpleString()
    out = vectors.mapInArrow(run, f"id {id_type}, component int, deviation string, whitened double, explained double")
    return out.select(
        F.col("id").alias(id),
        "component",
        F.lit(n).cast("bigint").alias("n"),
        F.col("deviation").cast("decimal(38,0)").alias("deviation"),
        "whitened",
        "explained",
        F.lit(error).alias("identity_error"),
    )


def op13_whitening(spark, sf_dir):
    rows = embeddings(spark, sf_dir).where(finite("embedding"))
    white = whiten(rows.select("vec_id", whole("embedding", SCALE, ADDED).alias("vector")))
    return white.withColumn("deviation", F.col("deviation").try_cast("bigint"))
