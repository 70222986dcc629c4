"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

A block of directions is put through a Chebyshev polynomial of the covariance that is small over the unwanted
part of the spectrum and grows fast beyond it. Every step of the polynomial's recurrence is one distributed
pass over the centred vectors, X'(XQ)/n: what a pass broadcasts and brings back are matrices of the
vectors' width by the block's. QR and Rayleigh-Ritz follow until the residuals certify the wanted components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import dropped, mapped, written

#: Steps of the polynomial a round, rounds before the block is widened, vectors a block of rows, and sums that a pass brings to the driver at most.
DEGREE, ROUNDS, BLOCK_ROWS, MOST_SUMS = 12, 6, 2048, 32
#: A component counts as found when its residual is this share of the greatest eigenvalue; one that explains less than RANK_SHARE of it has none of its own.
CERTIFIED, RANK_SHARE = 2e-14, 1e-12
OFFSET = 1_000_000


def whole_vectors(df: DataFrame, scale: float, id_col: str, vec_col: str) -> DataFrame:
    """_id and _x, the floors of scale times each entry plus OFFSET, of all rows whose vector is not null and has finite entries only."""
    v = F.col("_v")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    rows = df.select(F.col(id_col).alias("_id"), F.col(vec_col).alias("_v")).where(v.isNotNull() & (F.size(v) > 0) & F.coalesce(finite, F.lit(False)))
    least = (1 << 53) / scale
    x = F.transform(v, lambda c: F.when(F.abs(c.cast("double")) < least, F.floor(c.cast("double") * scale) + OFFSET).otherwise(F.raise_error(F.lit("an entry is too large"))))
    return rows.select("_id", x.alias("_x"))


def _matrix(batch, name: str = "_x") -> np.ndarray:
    """A column of lists of one length as a matrix."""
    column = batch.column(batch.schema.names.index(name))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


class FitList:
    """Each distinct vector once, as blocks of rows, with their number and their sums; passes over the centred vectors."""

    def __init__(self, vectors: DataFrame):
        self.spark = vectors.sparkSession

        def blocks(batches: Iterator):
            import pyarrow as pa

            for batch in batches:
                x = _matrix(batch)
                for i in range(0, len(x), BLOCK_ROWS):
                    part = np.ascontiguousarray(x[i : i + BLOCK_ROWS], "<i8")
                    row = [pa.array([len(part)]), pa.array([part.tobytes()], pa.binary()), pa.array([part.sum(0).tolist()], pa.list_(pa.int64()))]
                    yield pa.RecordBatch.from_arrays(row, names=["rows", "data", "sums"])

        self.blocks = written(vectors.select("_x").distinct().mapInArrow(blocks, "rows long, data binary, sums array<long>"), "fit")
        per_place = self.blocks.select("rows", F.posexplode("sums").alias("place", "sum")).groupBy("place").agg(F.sum("sum").alias("sum"), F.sum("rows").alias("rows")).collect()
        self.n = per_place[0]["rows"] if per_place else 0
        self.sums = np.zeros(len(per_place), np.int64)
        for r in per_place:
            self.sums[r["place"]] = r["sum"]

    @property
    def width(self) -> int:
        return len(self.sums)

    def summed(self, of_block) -> np.ndarray:
        """The sum over all blocks of a matrix made of each block's centred vectors. A task adds up its own first; many tasks' sums are added up by few."""
        n, sums, width = self.n, self.sums, self.width

        def partial(batches: Iterator):
            total = None
            for batch in batches:
                for rows, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    part = of_block(centred(np.frombuffer(data, "<i8").reshape(rows, width), n, sums))
                    total = part if total is None else total + part
            yield from _as_row(total)

        def added(batches: Iterator):
            total = None
            for batch in batches:
                for data in batch.column(0).to_pylist():
                    part = np.frombuffer(data)
                    total = part.copy() if total is None else total + part
            yield from _as_row(total)

        sums_of_tasks = self.blocks.select("rows", "data").mapInArrow(partial, "data binary")
        if self.blocks.rdd.getNumPartitions() > MOST_SUMS:
            sums_of_tasks = sums_of_tasks.repartition(MOST_SUMS).mapInArrow(added, "data binary")
        found = [np.frombuffer(bytes(r["data"])) for r in sums_of_tasks.collect()]
        return sum(found[1:], found[0])

    def times(self, q: np.ndarray) -> np.ndarray:
        """The covariance times a block of directions."""
        return self.summed(lambda x: x.T @ (x @ q)).reshape(q.shape) / self.n

    def trace(self) -> float:
        return float(self.summed(lambda x: np.array([np.einsum("ij,ij->", x, x)]))[0]) / self.n


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x less the mean as doubles; the difference is taken in whole numbers, so nothing of it is rounded away."""
    whole, part = sums // n, sums % n
    return (x - whole) - part / n


def _as_row(total: np.ndarray | None):
    import pyarrow as pa

    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(total).tobytes()], pa.binary())], names=["data"])


def lower_bound(times, width: int, rng, steps: int = DEGREE) -> float:
    """Where the spectrum begins, by a few Lanczos steps: the least Ritz value less its residual, not under 0."""
    basis = [np.zeros((width, 1)), (v := rng.standard_normal((width, 1))) / np.linalg.norm(v)]
    alphas, betas = [], [0.0]
    for _ in range(min(steps, width)):
        w = times(basis[-1])
        alphas.append(float((w.T @ basis[-1])[0, 0]))
        known = np.hstack(basis[1:])
        w = w - known @ (known.T @ w)
        w = w - known @ (known.T @ w)
        betas.append(float(np.linalg.norm(w)))
        if betas[-1] <= 1e-12 * abs(alphas[0]):
            break
        basis.append(w / betas[-1])
    inner = betas[1 : len(alphas)]
    values, turn = np.linalg.eigh(np.diag(alphas) + np.diag(inner, 1) + np.diag(inner, -1))
    return max(float(values[0]) - betas[-1] * abs(float(turn[-1, 0])), 0.0)


def filtered(times, q: np.ndarray, low: float, cut: float, top: float, degree: int = DEGREE) -> np.ndarray:
    """A Chebyshev polynomial of the operator applied to q: at most one over [low, cut], scaled to be near one at `top`."""
    centre, half = (cut + low) / 2, (cut - low) / 2
    sigma = first = half / (top - centre)
    before, now = q, (times(q) - centre * q) * (first / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - sigma)
        before, now = now, (times(now) - centre * now) * (2 * following / half) - (sigma * following) * before
        sigma = following
    return now


def leading(times, width: int, wanted: int, seed: int = 7, log: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The greatest eigenvalues, falling, and their unit eigenvectors, of an operator that is never formed.

    A block wider than what is wanted is filtered, made orthonormal and rotated to Ritz vectors, until
    each wanted one's residual is rounding error. Where values near the border make that slow the block is doubled; at the
    full width Rayleigh-Ritz alone is exact.
    """
    rng, size = np.random.default_rng(seed), min(width, 2 * wanted)
    low = lower_bound(times, width, rng) if size < width else 0.0
    q = np.linalg.qr(rng.standard_normal((width, size)))[0]
    rounds = 0
    while True:
        image = times(q)
        small = q.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, image = q @ turn, image @ turn
        top = max(float(values[0]), 0.0)
        residual = np.linalg.norm(image - q * values, axis=0)[:wanted]
        if log is not None:
            log.append((size, float(residual.max(initial=0.0)) / top if top else 0.0))
        if top == 0 or residual.max(initial=0.0) <= CERTIFIED * top * math.sqrt(width) or size == width and rounds > ROUNDS:
            return values[:wanted], q[:, :wanted]
        rounds += 1
        if rounds % ROUNDS == 0 and size < width:
            size = min(width, 2 * size)
            q = np.linalg.qr(np.hstack([q, rng.standard_normal((width, size - q.shape[1]))]))[0]
        elif size < width:
            cut = max(float(values[-1]), 1e-3 * top)  # a value of nearly nothing as the border would only slow the filter down
            q = np.linalg.qr(filtered(times, q, min(low, 0.9 * cut), cut, top))[0] if cut < top else np.linalg.qr(image)[0]
        else:
            q = np.linalg.qr(image @ np.diag(1 / np.maximum(values, RANK_SHARE * top)))[0]


def whiten(df: DataFrame, components: int = 16, scale: float = 64.0, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained and identity_error, for each row that takes part and each component.

    The fit list has each distinct vector once, so copies and repeated rows weigh nothing but keep their own rows in
    the result; rows with a null, empty or non-finite vector take no part; of several lengths of vectors the
    commonest takes part, the longest of equals; null ids are kept; other columns are left out, whatever
    their names. Components end where the covariance has no more rank (one vector, or equal ones: no rows);
    an empty table gives no rows. A deviation that no long holds is an error.
    """
    vectors = whole_vectors(df, scale, id_col, vec_col)
    lengths = vectors.groupBy(F.size("_x").alias("length")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("length")).limit(1).collect()
    schema = f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not lengths:
        return df.sparkSession.createDataFrame([], schema)
    vectors = vectors.where(F.size("_x") == lengths[0]["length"])
    fit = FitList(vectors)
    values, axes = leading(fit.times, fit.width, min(components, fit.width))
    kept = values > RANK_SHARE * max(values[0], 0.0)
    values, axes = values[kept], axes[:, kept]
    if not len(values):
        return df.sparkSession.createDataFrame([], schema)
    to_white, n, sums, explained = axes / np.sqrt(values), fit.n, fit.sums, (values / fit.trace()).tolist()
    covariance = fit.summed(lambda x: (x @ to_white).T @ (x @ to_white)).reshape(len(values), -1) / n
    error = float(np.abs(covariance - np.eye(len(values))).max())
    dropped(fit.blocks)

    def run(batches: Iterator):
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(i, BLOCK_ROWS)
                x = _matrix(part)
                yield part, {"deviation": deviations(x, n, sums), "white": (centred(x, n, sums) @ to_white).tolist()}

    found = mapped(vectors, run, {"deviation": "long", "white": "array<double>"}, keep=["_id"])
    each = found.select(F.col("_id").alias(id_col), "deviation", F.posexplode("white").alias("place", "whitened"))
    share = F.element_at(F.array(*map(F.lit, explained)), F.col("place") + 1)
    return each.select(id_col, (F.col("place") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", share.alias("explained"), F.lit(error).alias("identity_error"))


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int]:
    """The sum over the entries of (n * x - sums) squared, exact; in Python's integers where longs might not do."""
    most = float(n) * float(np.abs(x - sums // n).max(initial=0) + 1)
    if most * most * x.shape[1] < 2**62:
        d = n * (x - sums // n) - sums % n
        return (d * d).sum(1).tolist()
    found = [sum((n * c - s) ** 2 for c, s in zip(row, sums.tolist())) for row in x.tolist()]
    if max(found, default=0) >= 2**63:
        raise OverflowError("a deviation is over what a long holds")
    return found
