"""Embedding whitening: vectors as fixed-point numbers, projected on their principal directions at unit variance.

The directions are fitted on the distinct vectors.  Every task reduces its centred rows, block by block, to a triangle
R (QR); triangles meet in groups of ``FAN`` until one is left.  That one is made bidiagonal, dqds finds its singular
values and twisted factorisations the directions (``bidiagonal``).  A task holds a block of rows and a few d x d
matrices; the driver receives the sums of each dimension, one triangle and one small matrix of moments.

Rows: a vector that is null, or holds a null or an entry that is not finite or too large for a 64-bit number, is left
out.  Vectors have one length: the commonest (of equally common ones the largest); others, empty ones too, are left
out.  Repeated rows are kept, and count once in the fit.  Fewer components come out where the fitted vectors span fewer
dimensions; where all are equal, or the table is empty, there is none and the result has no rows.  A null key is kept;
other columns are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bidiagonal import principal
from tidemark.session import settled

#: An entry c is read as floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Triangles or moments that one task merges.
FAN = 8
#: Numbers in a block of rows.
BLOCK = 1 << 18
#: Scaled entries from here on have no place in a 64-bit number.
LARGEST = float(1 << 62)


class Whitening(NamedTuple):
    """What ``fit`` finds; its size follows the number of dimensions only."""

    length: int
    n: int
    sums: list[int]
    values: np.ndarray  # variance of each component, falling
    directions: np.ndarray  # a column each
    trace: float
    identity_error: float


def fixed_point(rows: DataFrame, vector: str, key: str) -> DataFrame:
    """(key, x): the rows whose vector is whole, as arrays of 64-bit numbers."""
    entries = F.col(vector).cast("array<double>")
    scaled = F.transform(entries, lambda c: c * SCALE)
    sound = F.col(vector).isNotNull() & F.forall(scaled, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < LARGEST), F.lit(False)))
    return rows.where(sound).select(F.col(key).alias("key"), F.transform(scaled, lambda c: F.floor(c) + SHIFT).alias("x"))


def _matrix(column: pa.ListArray, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def _blocks(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[np.ndarray]:
    rows = max(BLOCK // length, length)
    for batch in batches:
        x = _matrix(batch.column("x"), length)
        for at in range(0, len(x), rows):
            yield x[at : at + rows]


def _spread(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exactly: as 64-bit numbers where they suffice, else as Python's."""
    most = max(int(np.max(np.abs(x), initial=0)), 1) * n + max(map(abs, sums), default=0)
    return x * n - np.array(sums) if most < 1 << 62 else x.astype(object) * n - np.array(sums, dtype=object)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return np.asarray(_spread(x, n, sums) / n, dtype=float)


def _sums(fitted: DataFrame, length: int) -> tuple[int, list[int]]:
    """The number of vectors and the exact sum of each dimension."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * length
        for x in _blocks(batches, length):
            n += len(x)
            small = int(np.max(np.abs(x))) * len(x) < 1 << 62
            total = [a + int(b) for a, b in zip(total, (x if small else x.astype(object)).sum(axis=0), strict=True)]
        if n:
            numbers = pa.array([Decimal(v) for v in [n, *total]], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, length), pa.int32()), numbers], ["at", "v"])

    parts = fitted.mapInArrow(partial, "at int, v decimal(38,0)")
    found = {r["at"]: int(r["v"]) for r in parts.groupBy("at").agg(F.sum("v").cast("decimal(38,0)").alias("v")).collect()}
    return found.pop(-1, 0), [found.get(i, 0) for i in range(length)]


def _merged(fitted: DataFrame, part: Callable, merge: Callable[[list[np.ndarray]], np.ndarray], label: str) -> np.ndarray:
    """One array out of one per task, merged ``FAN`` at a time; what ``part`` yields is the array of a task's rows."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = part(batches)
        if whole is not None:
            node = pa.array([TaskContext.get().partitionId()], pa.int64())
            yield pa.RecordBatch.from_arrays([node, pa.array([whole.astype("<f8").tobytes()], pa.binary())], ["node", "data"])

    def group(found: pd.DataFrame) -> pd.DataFrame:
        parts = [np.frombuffer(d, "<f8") for d in found.sort_values("node")["data"]]
        return pd.DataFrame({"node": [found["node"].iloc[0] // FAN], "data": [merge(parts).astype("<f8").tobytes()]})

    kinds = "node long, data binary"
    parts = settled(fitted.mapInArrow(first, kinds), label)
    most = parts.agg(F.max("node")).first()[0]
    while most:
        parts = parts.groupBy(F.floor(F.col("node") / FAN)).applyInPandas(group, kinds)
        most //= FAN
    return np.frombuffer(parts.first()["data"], "<f8")


def _triangle(rows: np.ndarray) -> np.ndarray:
    """The R of a QR decomposition, square, with rows of zeros where there are fewer rows than columns."""
    r = np.linalg.qr(rows, mode="r")
    return np.vstack([r, np.zeros((rows.shape[1] - len(r), rows.shape[1]))])


def _moments(parts: list[np.ndarray], k: int) -> np.ndarray:
    """Number, mean and centred products of the union of sets of rows, each given so."""
    n, mean, products = 0.0, np.zeros(k), np.zeros((k, k))
    for p in parts:
        apart = p[1 : k + 1] - mean
        both = n + p[0]
        products = products + p[k + 1 :].reshape(k, k) + np.outer(apart, apart) * (n * p[0] / both)
        mean = mean + apart * (p[0] / both)
        n = both
    return np.concatenate([[n], mean, products.ravel()])


def _moments_of(z: np.ndarray) -> np.ndarray:
    mean = z.mean(axis=0)
    return np.concatenate([[float(len(z))], mean, ((z - mean).T @ (z - mean)).ravel()])


def fit(vectors: DataFrame, components: int = 16, column: str = "x") -> Whitening | None:
    """The whitening of the distinct arrays of 64-bit numbers in ``column``; None where there are none or all are equal."""
    sizes = vectors.groupBy(F.size(column).alias("size")).agg(F.count("*").alias("n")).where("size > 0")
    commonest = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    if commonest is None:
        return None
    length = commonest["size"]
    fitted = settled(vectors.where(F.size(column) == length).select(F.col(column).alias("x")).distinct(), "vectors")
    n, sums = _sums(fitted, length)

    def reduced(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        r = None
        for x in _blocks(batches, length):
            rows = _centred(x, n, sums)
            r = _triangle(rows if r is None else np.vstack([r, rows]))
        return r

    def stacked(parts: list[np.ndarray]) -> np.ndarray:
        return _triangle(np.vstack([p.reshape(length, length) for p in parts])).ravel()

    triangle = _merged(fitted, reduced, stacked, "triangles").reshape(length, length)
    squares, directions = principal(triangle, components)
    k = len(squares)
    if not k:
        return None
    values, trace = squares / n, float((triangle * triangle).sum() / n)
    found = Whitening(length, n, sums, values, directions, trace, 0.0)

    def spread(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        parts = [_moments_of(_projected(x, found)) for x in _blocks(batches, length)]
        return _moments(parts, k) if parts else None

    moments = _merged(fitted, spread, lambda parts: _moments(parts, k), "moments")
    covariance = moments[k + 1 :].reshape(k, k) / n
    return found._replace(identity_error=float(np.abs(covariance - np.eye(k)).max()))


def _projected(x: np.ndarray, model: Whitening) -> np.ndarray:
    return _centred(x, model.n, model.sums) @ model.directions / np.sqrt(model.values)


def projected(vectors: DataFrame, model: Whitening, key: str = "key") -> DataFrame:
    """(key, whitened array<double>, deviation long) of every row of ``vectors`` that has the model's length.

    The deviation is the sum of (n * x - S)^2 over the dimensions, exact; null where no 64-bit number holds it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, step = len(model.values), max(BLOCK // model.length, 1)
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                x = _matrix(batch.column("x"), model.length)
                far = _spread(x, model.n, model.sums)
                if far.dtype == object or float(np.max(np.abs(far).astype(float), initial=0.0)) ** 2 * model.length >= 2.0**62:
                    totals = [sum(int(v) ** 2 for v in row) for row in far.tolist()]
                    deviation = pa.array([t if t < 1 << 63 else None for t in totals], pa.int64())
                else:
                    deviation = pa.array((far * far).sum(axis=1), pa.int64())
                z = _projected(x, model)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * k, pa.int32()), pa.array(z.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("key"), lists, deviation], [key, "whitened", "deviation"])

    chosen = vectors.where(F.size("x") == model.length)
    kind = vectors.schema["key"].dataType.simpleString()
    return chosen.mapInArrow(run, f"`{key}` {kind}, whitened array<double>, deviation long")


def whitened(rows: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = 16) -> DataFrame:
    """One row per kept row and component: its place on the component, with the figures of the fit."""
    vectors = fixed_point(rows, vector, key)
    model = fit(vectors, components)
    if model is None:
        kind = vectors.schema["key"].dataType.simpleString()
        shape = (
            f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        )
        return rows.sparkSession.createDataFrame([], shape)
    shares = F.array(*(F.lit(float(v / model.trace)) for v in model.values))
    placed = projected(vectors, model, key).select(key, "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return placed.select(
        key,
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        shares[F.col("at")].alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
