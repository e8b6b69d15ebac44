"""Whitening against numpy, the eigen solver on hard matrices, and the defined cases."""

import math

import numpy as np
import pytest

from sparkwright.llm import whitening as W
from sparkwright.llm.queries import QUERIES

SF01 = "/root/testdata/sf0.1"
SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=16):
    """(remaining ids with x, fit list sorted) by plain Python."""
    kept = [(i, tuple(math.floor(64 * float(np.float32(c))) + 1000000 for c in v)) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    return kept, sorted({x for _, x in kept})


def check(got, kept, distinct, k):
    n, d = len(distinct), len(distinct[0])
    total = [sum(x[j] for x in distinct) for j in range(d)]
    centred = np.array([[(n * x[j] - total[j]) / n for j in range(d)] for x in distinct])
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    assert len(got) == k * len(kept)
    signs = {}
    for i, x in kept:
        dev = sum((n * x[j] - total[j]) ** 2 for j in range(d))
        for c in range(1, k + 1):
            r = by_id[i][c][0]
            assert r.n == n and r.deviation == dev
            assert r.explained == pytest.approx(values[c - 1] / np.trace(cov), rel=1e-9)
            exp = sum((n * x[j] - total[j]) / n * vectors[j, c - 1] for j in range(d)) / math.sqrt(values[c - 1])
            if abs(exp) > 1e-3:
                signs.setdefault(c, set()).add(np.sign(exp) == np.sign(r.whitened))
            assert abs(r.whitened) == pytest.approx(abs(exp), abs=1e-6)
    assert all(len(s) == 1 for s in signs.values())
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9


def test_query_matches_numpy(spark):
    """op11 over its whole table."""
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF01}/embeddings.parquet").collect()]
    kept, distinct = brute(rows)
    check(QUERIES["op11_whitening"](spark, SF01).collect(), kept, distinct, 16)


def test_defined_cases(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(v) for v in rng.normal(0, 3, 5)], 0) for i in range(40)]
    odd = [(100, None, 1), (101, [1.0, None, 2.0, 3.0, 4.0], 1), (102, [1.0, float("nan"), 0.0, 0.0, 0.0], 1),
           (103, [float("inf")] + [0.0] * 4, 1), (104, [], 1), (105, [1e30] * 5, 1), (106, [1.0, 2.0], 1)]
    copies = [(200 + i, rows[0][1], 0) for i in range(30)]           # one vector holds many rows
    df = spark.createDataFrame(rows + odd + copies, SCHEMA).repartition(5)
    kept, distinct = brute([(i, v) for i, v, _ in rows + copies])
    assert len(distinct) == 40
    got = W.components_of_rows(df).collect()
    check(got, kept, distinct, 5)                                   # five dimensions: five components
    again = W.components_of_rows(df.repartition(3)).collect()
    assert sorted(r[:6] for r in got) == sorted(r[:6] for r in again)   # whole-number sums: the order does not matter


def test_clashing_columns_null_and_repeated_ids(spark):
    rows = [(None, [1.0, 2.0], "a", 1), (1, [2.0, 1.0], "b", 2), (1, [2.0, 1.0], "b", 2), (2, [5.0, 5.0], None, 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, x string, row int")
    out = W.components_of_rows(df).collect()
    assert len(out) == 8 and {r.n for r in out} == {3}
    model = W.fit(df)
    full = W.transform(df, model).select("row.*", "deviation")
    assert full.columns == ["vec_id", "x", "row", "deviation"] and full.count() == 4


def test_nothing_to_whiten(spark):
    cols = "vec_id int, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    for rows in ([], [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], [(1, None, 0)]):
        out = W.components_of_rows(spark.createDataFrame(rows, SCHEMA.replace("vec_id long", "vec_id int")))
        assert out.count() == 0 and ", ".join(f"{a} {b}" for a, b in out.dtypes) == cols


def test_rank_below_the_dimension(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(-50, 50, (3, 12)).astype(float)
    rows = [(i, [float(v) for v in rng.integers(-3, 4, 3) @ base], 0) for i in range(200)]
    out = W.components_of_rows(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.component for r in out} == {1, 2, 3} and out[0].identity_error < 1e-6
    assert sum({r.component: r.explained for r in out}.values()) == pytest.approx(1.0)


def test_deviations_past_64_bits():
    y = np.array([[1 << 40, 0], [3, -2]], np.int64)
    assert W._deviations(y, 1 << 29, np.array([5, 7], object)) == [None, (3 * 2**29 - 5) ** 2 + (-2 * 2**29 - 7) ** 2]
    assert W._deviations(y[1:], 10, np.array([4, -4], object)) == [26 ** 2 + 16 ** 2]


def _matrices():
    rng = np.random.default_rng(2)
    q = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    yield np.eye(20) * 3.0                                                # one eigenvalue twenty times
    yield q @ np.diag(np.r_[[9.0] * 6, [9.0 - 1e-13] * 4, np.linspace(5, 1, 30)]) @ q.T
    yield q @ np.diag(10.0 ** -np.arange(40.0)) @ q.T                      # forty powers of ten
    yield np.diag(np.arange(30.0))                                        # already diagonal
    n = 21
    yield np.diag(np.abs(np.arange(n) - n // 2).astype(float)) + np.eye(n, k=1) + np.eye(n, k=-1)    # Wilkinson's close pairs
    yield np.array([[2.0]])
    yield np.array([[2.0, 1.0], [1.0, 2.0]])


@pytest.mark.parametrize("a", list(_matrices()), ids=range(7))
def test_eigen_solver(a):
    a = (a + a.T) / 2
    values, vectors = W.leading_components(a, 16)
    exact = np.linalg.eigvalsh(a)[::-1]
    scale = exact[0]
    keep = exact[:16][exact[:16] > W.NO_VARIANCE * scale]
    assert abs(len(values) - len(keep)) <= 1 and np.allclose(values[:len(keep)], keep[:len(values)], rtol=0, atol=1e-13 * scale)
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-12
    assert np.abs(a @ vectors.T - vectors.T * values).max() < 1e-12 * scale
