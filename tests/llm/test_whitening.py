import math
import random

from cases import FOLDER, rows_of  # noqa: F401
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bidiagonal, whitening, workload

COLUMNS = ("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")
DIFFERENT = "vec_id long, embedding array<float>, x string, key int, at int"


def plain(rows, most=16):
    """The contract in numpy: a dense covariance of the distinct vectors and its eigenvectors."""
    kept = []
    for key, vector, *_ in rows:
        if vector is None or any(c is None or not math.isfinite(c) for c in vector):
            continue
        kept.append((key, [math.floor(64 * float(c)) + 1_000_000 for c in vector]))
    sizes = {}
    for _, x in kept:
        sizes[len(x)] = sizes.get(len(x), 0) + 1
    sizes.pop(0, None)
    if not sizes:
        return []
    length = max(sizes, key=lambda s: (sizes[s], s))
    kept = [(key, x) for key, x in kept if len(x) == length]
    fitted = np.array(sorted({tuple(x) for _, x in kept}), dtype=np.int64)
    n, sums = len(fitted), fitted.sum(axis=0)
    centred = (fitted * n - sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(most, int(np.sum(values > values[0] * 1e-13))) if values[0] > 0 else 0
    out = []
    for key, x in kept:
        far = np.array(x) * n - sums
        for j in range(k):
            place = float(far / n @ vectors[:, j] / math.sqrt(values[j]))
            out.append((key, j + 1, n, sum(int(v) ** 2 for v in far), place, float(values[j] / values.sum())))
    return out


def check(found, rows):
    wanted = plain(rows)
    order = lambda r: (str(r[0]), r[1], r[3], abs(r[4]))
    found, wanted = sorted(rows_of(found, *COLUMNS), key=order), sorted(wanted, key=order)
    assert [r[:4] for r in found] == [r[:4] for r in wanted]
    signs = {}
    for got, want in zip(found, wanted, strict=True):
        assert got[5] == pytest.approx(want[5], rel=1e-9)
        assert got[6] < 1e-9
        if abs(want[4]) > 1e-6:
            signs.setdefault(got[1], set()).add(got[4] * want[4] > 0)
        assert abs(got[4]) == pytest.approx(abs(want[4]), rel=1e-7, abs=1e-8)
    assert all(len(s) == 1 for s in signs.values())


def test_the_whole_table(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    check(workload.op11_embedding_whitening(spark, FOLDER), [tuple(r) for r in table.select("vec_id", "embedding").collect()])


def test_hard_rows(spark):
    rng = random.Random(3)
    vectors = [[rng.gauss(0, 1), rng.gauss(0, 2), 0.5, rng.gauss(0, 3), -1.0] for _ in range(40)]
    rows = [(i, v, "x", 1, 2) for i, v in enumerate(vectors)]
    rows += [(i, vectors[7], "x", 1, 2) for i in range(100, 160)]  # many copies
    rows += [(None, vectors[1], None, 1, 2), (200, None, "x", 1, 2), (201, [], "x", 1, 2), (202, [1.0], "x", 1, 2)]
    rows += [(203, [1.0, None, 1.0, 1.0, 1.0], "x", 1, 2), (204, [math.nan] * 5, "x", 1, 2), (205, [math.inf] * 5, "x", 1, 2)]
    rows += [(7, vectors[7], "x", 1, 2)]
    check(whitening.whitened(spark.createDataFrame(rows, DIFFERENT).repartition(5)), rows)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0], "x", 1, 2)] * 3, [(1, None, "x", 1, 2)], [(1, [], "x", 1, 2)]])
def test_nothing_to_whiten(spark, rows):
    found = whitening.whitened(spark.createDataFrame(rows, DIFFERENT))
    assert found.collect() == []
    assert tuple(found.columns) == COLUMNS


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(i) * 1e12, -float(i * i) * 1e9]) for i in range(1, 6)]
    found = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), components=1)
    wanted = {r[0]: r[3] for r in plain(rows, 1)}
    assert {r["vec_id"]: r["deviation"] for r in found.collect()} == {
        k: v if v < 1 << 63 else None for k, v in wanted.items()
    }


def test_many_tasks_meet_in_a_tree(spark):
    rng = np.random.default_rng(5)
    rows = [(i, v) for i, v in enumerate((rng.standard_normal((300, 6)) * [5, 4, 3, 2, 1, 0.5]).tolist())]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(40)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check(whitening.whitened(docs), rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_whitened_columns_are_uncorrelated(spark):
    placed = workload.op11_embedding_whitening(spark, FOLDER).where("component <= 2").groupBy("vec_id").pivot("component", [1, 2])
    corr = placed.agg(F.first("whitened")).select(F.corr("1", "2"), F.var_pop("1")).first()
    assert abs(corr[0]) < 1e-9
    assert corr[1] == pytest.approx(1.0)


def rotated(values, seed=0):
    rng = np.random.default_rng(seed)
    turn = lambda: np.linalg.qr(rng.standard_normal((len(values), len(values))))[0]
    return (turn() * np.array(values, dtype=float)) @ turn()


@pytest.mark.parametrize(
    "values",
    [
        [3.0],
        [2.0, 1.0],
        np.linspace(1, 9, 40),
        [5] * 5 + [4] * 5 + [3] * 20,
        np.r_[np.ones(10) * 3 + 1e-9 * np.arange(10), np.linspace(0.1, 2, 30)],
        [3, 2, 1] + [0] * 20,
        np.linspace(1, 1.0001, 30),
    ],
)
def test_singular_vectors(values):
    matrix = rotated(values)
    squares, vectors = bidiagonal.principal(matrix, 16)
    wanted = np.sort(np.array(values, dtype=float))[::-1][: len(squares)] ** 2
    assert len(squares) == min(16, np.count_nonzero(values))
    assert np.allclose(squares, wanted, rtol=1e-13 * len(values))
    assert np.abs(vectors.T @ vectors - np.eye(len(squares))).max() < 1e-11
    assert np.abs(matrix.T @ (matrix @ vectors) - vectors * squares).max() < 1e-13 * wanted[0] * len(values)


def test_small_singular_values_keep_their_digits():
    diagonal, above = np.array([1.0, 1e-3, 1e-6, 1e-9]), np.array([1.0, 1e-3, 1e-6])
    squares = bidiagonal.squared_singular_values(diagonal, above)
    # The product of the singular values is the determinant, to nearly all digits.
    assert math.sqrt(math.prod(squares)) == pytest.approx(1e-18, rel=1e-14)


def test_matrices_without_a_direction():
    assert bidiagonal.principal(np.zeros((4, 4)), 16)[0].shape == (0,)
    squares, vectors = bidiagonal.principal(np.diag([4.0, 2.0, 0.0]), 16)
    assert squares.tolist() == [16.0, 4.0] and np.abs(vectors).tolist() == [[1, 0], [0, 1], [0, 0]]
