"""Embedding whitening by hierarchical SVD merging.

A partition keeps the count and exact sums of its vectors and, of the vectors less their mean, all singular values and
right vectors. Two such states merge without loss: the one's values times vectors, the other's, and one row for the
distance of the means are stacked, and their SVD is that of all vectors together. States meet FAN by FAN
in tasks, whatever the number of partitions. The first components of the last state, a few rows, whiten every vector.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialize

SCALE, SHIFT = 64, 1_000_000
#: Scaled entries beyond this are not told apart by sums of 64 bits; their vectors count as not finite.
LARGEST = 1 << 40
COMPONENTS = 32
FAN = 8
ROWS = 2048  # vectors that are decomposed at a time
STATE = "key long, n long, sums array<string>, singular binary, vectors binary"


class State:
    """n vectors of whole numbers, their exact sums, and the SVD of the vectors less their mean: singular values, right vectors as rows."""

    def __init__(self, n: int, sums: list[int], singular: np.ndarray, vectors: np.ndarray):
        self.n, self.sums, self.singular, self.vectors = n, sums, singular, vectors

    @classmethod
    def of(cls, x: np.ndarray) -> State:
        n, sums = len(x), [int(s) for s in x.sum(axis=0)]
        low = np.array([s // n for s in sums])
        mean = np.array([(s - n * int(m)) / n for s, m in zip(sums, low)])  # from the whole number below it, so that no digit is lost
        return cls(n, sums, *decomposed((x - low) - mean))

    def merged(self, other: State) -> State:
        n = self.n + other.n
        gap = np.array([(a * other.n - b * self.n) / (self.n * other.n) for a, b in zip(self.sums, other.sums)])
        correction = math.sqrt(self.n * other.n / n) * gap
        stack = np.vstack([self.singular[:, None] * self.vectors, other.singular[:, None] * other.vectors, correction])
        return State(n, [a + b for a, b in zip(self.sums, other.sums)], *decomposed(stack))

    def row(self, key: int) -> tuple:
        return key, self.n, list(map(str, self.sums)), self.singular.tobytes(), self.vectors.tobytes()

    @classmethod
    def read(cls, r) -> State:
        return cls(int(r.n), list(map(int, r.sums)), np.frombuffer(r.singular), np.frombuffer(r.vectors).reshape(-1, len(r.sums)))


def decomposed(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Singular values and right vectors. Of more rows than columns only the triangle of their QR is decomposed."""
    if len(rows) > rows.shape[1]:
        rows = np.linalg.qr(rows, mode="r")
    _, singular, vectors = np.linalg.svd(rows, full_matrices=False)
    return singular, vectors


def whole(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Scaled entries of a batch's vectors, and the rows that they are of: those without nulls, of the size asked for, finite and not too large."""
    column = batch.column("vector")
    lengths, valid = np.asarray(pc.fill_null(pc.list_value_length(column), -1)), np.asarray(column.is_valid())
    rows = np.flatnonzero(valid & (lengths == size))
    flat = pc.list_flatten(column.take(pa.array(rows)))
    entries = np.asarray(pc.fill_null(flat.cast(pa.float64()), math.nan)).reshape(len(rows), size)
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(entries * SCALE)
        fine = (np.abs(scaled) < LARGEST).all(axis=1)
    return scaled[fine].astype(np.int64) + SHIFT, rows[fine]


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["key", "n", "sums", "singular", "vectors"])


class Moments:
    """n rows, their mean and the sums of products of their differences from it."""

    def __init__(self, n: int, mean: np.ndarray, products: np.ndarray):
        self.n, self.mean, self.products = n, mean, products

    @classmethod
    def of(cls, x: np.ndarray) -> Moments:
        mean = x.mean(axis=0)
        return cls(len(x), mean, (x - mean).T @ (x - mean))

    def merged(self, other: Moments) -> Moments:
        n, gap = self.n + other.n, other.mean - self.mean
        return Moments(n, self.mean + gap * (other.n / n), self.products + other.products + np.outer(gap, gap) * (self.n * other.n / n))

    def row(self, key: int) -> tuple:
        return key, self.n, [], self.mean.tobytes(), self.products.tobytes()

    @classmethod
    def read(cls, r) -> Moments:
        mean = np.frombuffer(r.singular)
        return cls(int(r.n), mean, np.frombuffer(r.vectors).reshape(len(mean), len(mean)))


def reduced(vectors: DataFrame, kind: type, size: int, label: str, change=lambda x: x) -> DataFrame:
    """The one state, in a row of STATE, of all vectors (changed first); no row where there is none. Each round leaves a FAN-th of the states, and no task gets more than FAN of them."""

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for b in batches:
            x, _ = whole(b, size)
            for at in range(0, len(x), ROWS):
                own = kind.of(change(x[at : at + ROWS]))
                state = own if state is None else state.merged(own)
        if state is not None:
            yield batch_of([state.row(TaskContext.get().partitionId())])

    def meet(group: tuple, own: pd.DataFrame) -> pd.DataFrame:
        state = None
        for r in own.sort_values("key").itertuples():
            state = kind.read(r) if state is None else state.merged(kind.read(r))
        return pd.DataFrame([state.row(int(group[0]))], columns=["key", "n", "sums", "singular", "vectors"])

    states = materialize(vectors.mapInArrow(start, STATE), label)
    while (last := states.agg(F.max("key")).first()[0]) is not None and last > 0:
        states = materialize(states.groupBy(F.floor(F.col("key") / FAN).alias("to")).applyInPandas(meet, STATE), label)
    return states


class Fit:
    """What whitening needs: n and sums of the vectors, the components as rows with their variances, the variance of all dimensions. Components without variance are left out."""

    def __init__(self, n: int, sums: list[int], singular: np.ndarray, vectors: np.ndarray, components: int = COMPONENTS):
        least = singular[0] * max(n, len(sums)) * np.finfo(float).eps if len(singular) else 0.0
        rank = int((singular > least).sum())
        self.n, self.sums, self.trace = n, sums, float((singular**2).sum()) / n
        self.low = np.array([s // n for s in sums], dtype=np.int64)
        self.rest = [s % n for s in sums]
        self.variances, self.rows = singular[:rank][:components] ** 2 / n, vectors[:rank][:components]
        if len(self.rows):
            self.rows = self.rows * np.sign(self.rows[np.arange(len(self.rows)), np.abs(self.rows).argmax(axis=1)])[:, None]

    def distances(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exactly."""
        y = x - self.low
        wide = self.n * (int(np.abs(y).max(initial=0)) + 1) >= 1 << 62
        return (y.astype(object) if wide else y) * self.n - np.array(self.rest, dtype=object if wide else np.int64)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (self.distances(x) / self.n).astype(float) @ self.rows.T / np.sqrt(self.variances)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of squared distances; null beyond 63 bits."""
        d = self.distances(x)
        if d.dtype == object or float(np.abs(d).max(initial=0)) ** 2 * d.shape[1] >= 1 << 62:
            sums = [sum(int(v) ** 2 for v in row) for row in d]
            return [s if s < 1 << 63 else None for s in sums]
        return (d * d).sum(axis=1).tolist()


def usual_size(vectors: DataFrame) -> int | None:
    """The commonest length of vectors that are all finite; of equally common ones the greatest."""
    finite = F.forall("vector", lambda c: F.coalesce(F.abs(c) < math.inf, F.lit(False)))
    sizes = vectors.where(finite & (F.size("vector") > 0)).groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    top = sizes.agg(F.max_by("size", F.struct("n", "size"))).first()
    return top[0]


def fitted(vectors: DataFrame, size: int, components: int = COMPONENTS) -> Fit | None:
    def cut(states: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for own in states:
            own["vectors"] = [np.frombuffer(r.vectors).reshape(-1, size)[:components].tobytes() for r in own.itertuples()]
            yield own

    state = reduced(vectors, State, size, "white-fit").mapInPandas(cut, STATE).first()
    if state is None:
        return None
    return Fit(state.n, list(map(int, state.sums)), np.frombuffer(state.singular), np.frombuffer(state.vectors).reshape(-1, size), components)


def whiten(table: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """key, n, deviation, whitened (an array), explained (an array), identity_error for every vector that is used.

    Left out: null vectors, those with null or non-finite entries or entries whose scaled value passes LARGEST, empty ones, and those of another
    length than the commonest. Components without variance (fewer vectors than dimensions, equal vectors) are left out,
    so arrays may be shorter than components, or empty. Equal vectors count each, and get equal rows; null keys are
    carried; a deviation that 63 bits do not hold is null; an empty table gives an empty table; other columns are not read.
    """
    told = table.select(F.col(key).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    id_type = told.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_type}, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
    size = usual_size(told)
    fit = fitted(told, size, components) if size else None
    if fit is None:
        return told.sparkSession.createDataFrame([], schema).withColumnRenamed("vec_id", key)
    error = 0.0
    if len(fit.rows):
        m = Moments.read(reduced(told, Moments, size, "white-error", fit.whitened).first())
        error = float(np.abs(m.products / m.n - np.eye(len(m.mean))).max())
    explained = (fit.variances / fit.trace).tolist() if len(fit.rows) else []

    def applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, rows = whole(b, size)
            if len(x):
                n, whitened = len(x), fit.whitened(x)
                ids = b.column("vec_id").take(pa.array(rows))
                each = pa.array(whitened.ravel(), pa.float64())
                offsets = pa.array(np.arange(n + 1, dtype=np.int32) * whitened.shape[1])
                columns = [ids, pa.array([fit.n] * n, pa.int64()), pa.array(fit.deviations(x), pa.int64()), pa.ListArray.from_arrays(offsets, each), pa.array([explained] * n, pa.list_(pa.float64())), pa.array([error] * n)]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "n", "deviation", "whitened", "explained", "identity_error"])

    return told.mapInArrow(applied, schema).withColumnRenamed("vec_id", key)
