import math
from fractions import Fraction

import numpy as np
import pytest

from shelfcast.llm.whitening import one_sided_jacobi, op11_whitening, pivoted_cholesky, whiten

SCHEMA = "vec_id bigint, embedding array<double>, component int, id int, v int, n int"


def integers(vectors):
    width = max(map(len, vectors))
    return [[math.floor(1024 * float(c)) + 100_000 for c in [*v, *[0.0] * (width - len(v))]] for v in vectors]


def covariance(rows):
    """Exact, in fractions."""
    n, d = len(rows), len(rows[0])
    sums = [sum(r[j] for r in rows) for j in range(d)]
    centred = [[n * r[j] - sums[j] for j in range(d)] for r in rows]
    return np.array([
        [float(Fraction(sum(c[i] * c[j] for c in centred), n**3)) for j in range(d)] for i in range(d)
    ]), sums


def check(got, ids, vectors, components=8, tolerance=1e-9):
    rows = integers(vectors)
    v, sums = covariance(rows)
    n = len(rows)
    values, columns = np.linalg.eigh(v)
    values, columns = values[::-1], columns[:, ::-1]
    count = min(components, int((values > 1e-9 * values[0]).sum()))
    assert len(got) == n * count
    deviations = [sum((n * x - s) ** 2 for x, s in zip(r, sums)) for r in rows]
    white = (np.array(rows) - np.array([s / n for s in sums])) @ columns[:, :count] / np.sqrt(values[:count])
    by_row = {}
    for r in got:
        by_row.setdefault(r["component"], []).append(r)
    signs = {}
    for c, found in by_row.items():
        assert sorted((str(r["vec_id"]), r["deviation"]) for r in found) == sorted(zip(map(str, ids), deviations))
        assert {r["n"] for r in found} == {n}
        assert found[0]["explained"] == pytest.approx(values[c - 1] / np.trace(v), rel=1e-9)
        assert found[0]["identity_error"] < 1e-8
        one = {(str(r["vec_id"]), r["deviation"]): r["whitened"] for r in found}
        mine = {(str(i), d): w for i, d, w in zip(ids, deviations, white[:, c - 1])}
        sign = signs.setdefault(c, 1 if sum(one[k] * mine[k] for k in one) > 0 else -1)
        assert max(abs(one[k] - sign * mine[k]) for k in one) < tolerance * max(1, abs(white).max())
    return count


@pytest.mark.parametrize("seed", range(6))
def test_factor_and_rotations(seed):
    rng = np.random.default_rng(seed)
    d, rank = 9, 9 if seed < 3 else 4
    x = rng.normal(0, 1, (40, rank)) @ rng.normal(0, 1, (rank, d)) * np.logspace(0, -5, d)
    a = x.T @ x
    factor, order = pivoted_cholesky(a)
    assert factor.shape[1] <= rank
    assert np.allclose(factor @ factor.T, a[np.ix_(order, order)], rtol=1e-10, atol=1e-13 * a.max())
    assert np.allclose(np.triu(factor, 1), 0)
    squares, columns = one_sided_jacobi(factor)
    assert (np.diff(squares) <= 0).all()
    assert np.allclose(columns.T @ columns, np.eye(len(squares)), atol=1e-12)
    expected = np.linalg.eigvalsh(a)[::-1]
    assert np.allclose(squares[:3], expected[:3], rtol=1e-10)
    assert np.allclose(a[np.ix_(order, order)] @ columns[:, :2], columns[:, :2] * squares[:2], rtol=1e-7, atol=1e-10 * a.max())


def test_no_factor_of_nothing():
    factor, _ = pivoted_cholesky(np.zeros((3, 3)))
    assert factor.shape == (3, 0)


def test_messy_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(0, 1, 12) * np.linspace(1, 3, 12) + 40).tolist(), 1, 2, 3, 4) for i in range(90)]
    rows += [rows[3], rows[3], (3, [0.5] * 12, 1, 2, 3, 4), (None, [1.0, 2.0], 1, 2, 3, 4), (500, [], 1, 2, 3, 4)]
    bad = [(200, None, 1, 2, 3, 4), (201, [1.0, None], 1, 2, 3, 4), (202, [float("nan")] * 12, 1, 2, 3, 4),
           (203, [float("inf")] * 12, 1, 2, 3, 4)]
    got = whiten(spark.createDataFrame(rows + bad, SCHEMA).repartition(6)).collect()
    assert check(got, [r[0] for r in rows], [r[1] for r in rows]) == 8


def test_low_rank(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(a), float(2 * a), float(b), 0.0], 1, 2, 3, 4) for i, (a, b) in enumerate(rng.integers(-9, 9, (50, 2)))]
    got = whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert check(got, [r[0] for r in rows], [r[1] for r in rows]) == 2


def test_large_components_stay_exact(spark):
    rows = [(i, [float(i * 2**28), float((i * 7) % 5)], 1, 2, 3, 4) for i in range(40)]
    frame = spark.createDataFrame(rows, SCHEMA)
    with pytest.raises(Exception, match="int|large|overflow"):
        whiten(frame).collect()  # deviations pass 64 bits: refused, never wrong
    fewer = [(i, [float(i * 2**10), float((i * 7) % 5)], 1, 2, 3, 4) for i in range(40)]
    got = whiten(spark.createDataFrame(fewer, SCHEMA)).collect()
    check(got, [r[0] for r in fewer], [r[1] for r in fewer])


def test_no_component_without_variance(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0], 1, 2, 3, 4) for i in range(4)], SCHEMA)
    assert whiten(same).count() == 0
    empty = whiten(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0
    assert empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_query(spark, small):
    rows = spark.read.parquet(f"{small}/embeddings.parquet").collect()
    got = op11_whitening(spark, small).collect()
    assert check(got, [r["vec_id"] for r in rows], [r["embedding"] for r in rows]) == 8
