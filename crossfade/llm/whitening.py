"""Whitened embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its triangular factor.

Every entry c of a vector becomes the whole number x = floor(64 c) + 1000000. The fit list is all rows that are
kept, in three passes over them:

1. Rows n and sums S by dimension, as whole numbers.
2. The scatter of the centred rows: each task adds up the matrix product of its batches, and the tasks' matrices are
   added in two levels, in the order of their numbers, so the sum does not depend on which task ends first. A
   row is centred before it is multiplied: first by the whole number nearest to the mean, which is exact, then by
   the fraction that is left, so the offset of a million costs no digits. What is added up has the size of
   dimensions squared, whatever the number of rows, and the number of tasks is bounded by the cluster's cores.
3. The whitened rows, and the covariance of what was really written, by the same sums.

Between 2 and 3 the dimensions x dimensions scatter is solved on the driver: A = P L L' P' by Cholesky with the
largest remaining diagonal as pivot, which also shows the rank; then columns of L are rotated in pairs until all
are orthogonal. The squared lengths of the rotated columns are the eigenvalues and the normalised columns the
eigenvectors of A, to high relative accuracy. The pairs of one round share no column, so a round is one array operation.

Dropped are rows whose vector is null, holds nulls or non-finite entries, or entries of 2^45 and more, which have
no exact x. Vectors of other lengths than the commonest (of equally common ones the longest) are dropped. Components stop
at the rank: constant or dependent dimensions add none, and equal rows alone give no rows at all. Repeated rows
are rows of their own and null ids are kept. A deviation that no long can hold is null.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crossfade.llm.tables import materialize

COMPONENTS = 32
SCALE, OFFSET = 64.0, 1_000_000
_ENTRY_MAX = 2.0**45
_FANS = 64  # matrices are added in groups of about the tasks' number / _FANS, then all


class Moments(NamedTuple):
    n: int
    sums: list[int]

    @property
    def centre(self) -> np.ndarray:
        """The whole numbers nearest to the means."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        """What is left of the means."""
        return np.array([(s - int(c) * self.n) / self.n for s, c in zip(self.sums, self.centre)])


def whole_vectors(embeddings: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(vec_id, x array<long>) of the rows that are kept, written."""
    values = F.col(vector).cast("array<double>")
    fine = F.forall(values, lambda c: c.isNotNull() & (F.abs(c) < F.lit(_ENTRY_MAX)))  # false for nan
    # the cast comes after the filter, whatever order the plan takes: entries that do not fit are nulled first
    whole = F.transform(
        values, lambda c: (F.floor(F.when(F.abs(c) < _ENTRY_MAX, c) * SCALE) + OFFSET).cast("long")
    )
    kept = embeddings.where(F.col(vector).isNotNull() & fine).select(
        F.col(key).cast("long").alias("vec_id"), whole.alias("x")
    )
    table = materialize(kept)
    lengths = table.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n"))
    usual = lengths.orderBy(F.desc("n"), F.desc("size")).first()
    return table if usual is None else table.where(F.size("x") == usual["size"])


def _matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column of equal lengths without nulls."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def moments(whole: DataFrame) -> Moments:
    """n and S, exact: tasks add up longs, Spark adds the tasks' sums as decimals."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0))
                # entries go to 2^51: upper and lower bits apart, so that no batch overflows
                part = (x >> 26).sum(axis=0).astype(object) * (1 << 26) + (x & ((1 << 26) - 1)).sum(axis=0)
                n, total = n + batch.num_rows, part + (0 if total is None else total)
        if n:
            yield pa.record_batch(
                {"dim": pa.array(range(len(total)), pa.int32()), "n": pa.array([n] * len(total), pa.int64()),
                 "total": pa.array([str(t) for t in total])}
            )

    parts = whole.select("x").mapInArrow(add, "dim int, n long, total string")
    rows = parts.groupBy("dim").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    rows = rows.orderBy("dim").collect()  # one row for each dimension
    return Moments(rows[0]["n"] if rows else 0, [int(r["total"]) for r in rows])


def _few_tasks(df: DataFrame) -> DataFrame:
    """As many tasks as keep all cores busy: each hands on one matrix, and their number must not grow with the data."""
    return df.coalesce(4 * df.sparkSession.sparkContext.defaultParallelism)


def scatter(rows: DataFrame, column: str, centre: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """The sum of y y' over all rows y = (x - centre) - rest."""
    size = len(rest)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            y = (_matrix(batch.column(0)) - centre) - rest
            total += y.T @ y
        task = TaskContext.get().partitionId()
        yield pa.record_batch(
            {"fan": pa.array(np.full(size, task // _FANS), pa.int32()), "task": pa.array(np.full(size, task), pa.int32()),
             "row": pa.array(np.arange(size), pa.int32()),
             "sums": pa.ListArray.from_arrays(pa.array(np.arange(size + 1) * size, pa.int32()), pa.array(total.ravel()))}
        )

    def add(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("task").to_numpy(), kind="stable")
        sums = _matrix(table.column("sums").combine_chunks())[order].cumsum(axis=0)[-1]
        first = table.slice(int(order[0]), 1)
        return first.set_column(3, "sums", pa.ListArray.from_arrays(pa.array([0, size], pa.int32()), pa.array(sums)))

    schema = "fan int, task int, row int, sums array<double>"
    parts = _few_tasks(rows.select(column)).mapInArrow(multiply, schema)
    for keys in (["fan", "row"], ["row"]):
        parts = parts.groupBy(*keys).applyInArrow(add, schema)
    out = np.zeros((size, size))
    for row in parts.collect():  # dimensions squared
        out[row["row"]] = row["sums"]
    return (out + out.T) / 2


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """L (size x rank, its rows in the order of a) with a = L L'; the rank ends where no diagonal entry is left
    above rounding."""
    size = len(a)
    left, columns = a.diagonal().astype(float).copy(), []
    least = left.max(initial=0.0) * size * np.finfo(float).eps
    factor = np.zeros((size, 0))
    while len(columns) < size:
        pivot = int(np.argmax(left))
        if not left[pivot] > least:
            break
        column = (a[:, pivot] - factor @ factor[pivot]) / np.sqrt(left[pivot])
        column[columns] = 0.0  # rows that were pivots are done: the factor is triangular in their order
        columns.append(pivot)
        factor = np.column_stack([factor, column])
        left -= column**2
        left[columns] = 0.0
    return factor


def jacobi_columns(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The factor times a rotation that makes its columns orthogonal (one-sided Jacobi, in rounds of disjoint pairs)."""
    x = factor.copy()
    n = x.shape[1]
    if n < 2:
        return x
    seats = list(range(n)) + ([-1] if n % 2 else [])
    tolerance = np.finfo(float).eps * len(x)
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(len(seats) - 1):
            half = len(seats) // 2
            pairs = [(p, q) for p, q in zip(seats[:half], seats[:half - 1:-1]) if p >= 0 and q >= 0]
            p, q = np.array(pairs).T
            a, b = x[:, p], x[:, q]
            aa, bb, ab = (a * a).sum(axis=0), (b * b).sum(axis=0), (a * b).sum(axis=0)
            cosine = np.abs(ab) / np.sqrt(np.maximum(aa * bb, np.finfo(float).tiny))
            worst = max(worst, float(cosine.max()))
            turn = cosine > tolerance
            zeta = (bb - aa) / np.where(turn, 2 * ab, 1.0)
            t = np.where(turn, np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta)), 0.0)
            c = 1 / np.hypot(1.0, t)
            x[:, p], x[:, q] = c * (a - t * b), c * (b + t * a)
            seats = [seats[0], seats[-1], *seats[1:-1]]
        if worst <= tolerance:
            break
    return x


def principal_components(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a scatter, as many as its rank. The largest entry of
    each vector, the first of equal ones, is positive."""
    rotated = jacobi_columns(pivoted_cholesky(sums))
    lengths = np.sqrt((rotated * rotated).sum(axis=0))
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    vectors = rotated[:, order] / lengths[order]
    if vectors.size:
        vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return lengths[order] ** 2, vectors


def _whitener(m: Moments, basis: np.ndarray):
    centre, rest, n = m.centre, m.rest, m.n
    # n x - S = n (x - centre) - (S - n centre), of which the second part is below n
    left = np.array([s - int(c) * n for s, c in zip(m.sums, centre)], object)
    small = left.astype(np.int64)

    def deviations(z: np.ndarray) -> list[int | None]:
        largest = (int(np.abs(z).max(initial=0)) + 1) * n
        if largest * largest * max(z.shape[1], 1) < 2**63:
            return ((n * z - small) ** 2).sum(axis=1).tolist()
        exact = [int(((n * row - left) ** 2).sum()) for row in z.astype(object)]
        return [d if d < 2**63 else None for d in exact]

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            z = _matrix(batch.column(1)) - centre
            out = np.ascontiguousarray((z - rest) @ basis)
            ends = np.arange(len(out) + 1) * basis.shape[1]
            yield pa.record_batch(
                {"vec_id": batch.column(0), "deviation": pa.array(deviations(z), pa.int64()),
                 "whitened": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(out.ravel()))}
            )

    return whiten


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per kept vector and component (from 1, by falling eigenvalue, up to ``components``): vec_id, component,
    n, deviation, whitened, explained, identity_error. Runs jobs."""
    spark = embeddings.sparkSession
    empty = spark.createDataFrame(
        [], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    whole = whole_vectors(embeddings)
    m = moments(whole)
    if not m.n:
        return empty
    sums = scatter(whole, "x", m.centre, m.rest)
    values, vectors = principal_components(sums)
    k = min(components, len(values))
    if not k:
        return empty
    basis = vectors[:, :k] / np.sqrt(values[:k] / m.n)
    rows = materialize(
        whole.select("vec_id", "x").mapInArrow(_whitener(m, basis), "vec_id long, deviation long, whitened array<double>")
    )
    # the whitened rows are centred up to rounding; their own mean is taken off all the same
    mean = np.array(rows.agg(*(F.avg(F.col("whitened")[i]) for i in range(k))).first())
    covariance = scatter(rows, "whitened", np.zeros(k), mean) / m.n
    error = float(np.abs(covariance - np.eye(k)).max())
    explained = F.array(*(F.lit(float(v)) for v in values[:k] / np.trace(sums)))
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(m.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
