"""Whitening against dense linear algebra over exact integers."""

import math

import numpy as np
import pytest

from lotweave.llm import whitening
from lotweave.llm.queries import op13_whitening
from tests.llm.conftest import SF


def brute(vectors, k=16):
    """x, n, S, deviations, eigenvalues and whitened rows with the sign of each component free."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]
    fit = [list(v) for v in {tuple(v) for v in x}]
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in fit])
    matrix = centred.T @ centred / n
    values, found = np.linalg.eigh(matrix)
    values, found = values[::-1][:k], found[:, ::-1][:, :k]
    rows = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in x])
    return n, deviation, values, rows @ found / np.sqrt(np.abs(values)), np.trace(matrix)


def test_whitening_query(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    n, deviation, values, whitened, trace = brute([r.embedding for r in table])
    place = {r.vec_id: i for i, r in enumerate(table)}
    rows = op13_whitening(spark, SF).collect()
    assert len(rows) == 16 * len(table)
    got = np.zeros_like(whitened)
    for r in rows:
        i, j = place[r.vec_id], r.component - 1
        got[i, j] = r.whitened
        assert (r.n, r.deviation) == (n, deviation[i]) and r.identity_error < 1e-9
        assert r.explained == pytest.approx(values[j] / trace, rel=1e-9)
    sign = np.sign(np.sum(got * whitened, axis=0))
    assert np.max(np.abs(got * sign - whitened)) < 1e-7


def test_whitening_edges(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [math.sin(i * (j + 1)) for j in range(5)], "x", 0.5) for i in range(40)]
    bad = [(100, None, None, None), (101, [1.0, None, 1.0, 1.0, 1.0], "x", 1.0), (102, [nan] * 5, "x", 1.0), (103, [inf] * 5, "x", 1.0)]
    bad += [(104, [], "x", 1.0), (105, [1.0, 2.0], "x", 1.0)]
    more = [(None, good[3][1], None, None), good[3]]
    schema = "vec_id long, embedding array<double>, component string, whitened double"
    frame = spark.createDataFrame(good + bad + more, schema).repartition(4)
    rows = whitening.whiten(frame).collect()
    n, deviation, values, whitened, trace = brute([g[1] for g in good])
    assert len(rows) == 42 * 5 and {r.n for r in rows} == {40}
    assert all(r.deviation == deviation[r.vec_id] for r in rows if r.vec_id is not None)
    assert max(r.identity_error for r in rows) < 1e-10
    assert whitening.whiten(frame.where("false")).count() == 0
    assert whitening.whiten(frame.where("vec_id = 3")).count() == 0  # one vector has no spread
    huge = spark.createDataFrame([(1, [1e300, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert all(r.deviation is None for r in whitening.whiten(huge).collect())


def matrices():
    rng = np.random.default_rng(5)
    turned, _ = np.linalg.qr(rng.standard_normal((48, 48)))
    low = rng.standard_normal((30, 3))
    yield "random", (lambda a: a @ a.T)(rng.standard_normal((60, 60)))
    yield "clusters", turned @ np.diag(np.repeat([9.0, 9.0 + 1e-12, 4.0, 1.0], 12)) @ turned.T
    yield "low rank", low @ low.T
    yield "diagonal", np.diag(np.arange(20.0))
    yield "equal", 5 * np.eye(33)
    yield "blocks", np.kron(np.eye(9), [[2.0, 1.0], [1.0, 2.0]])
    yield "graded", np.diag(10.0 ** -np.arange(0, 18)) + 1e-20
    yield "single", np.array([[4.0]])
    yield "nothing", np.zeros((7, 7))


@pytest.mark.parametrize(("name", "matrix"), list(matrices()))
def test_components(name, matrix):
    matrix = (matrix + matrix.T) / 2
    values, found = whitening.leading_components(matrix, 16)
    want = np.linalg.eigvalsh(matrix)[::-1][:16]
    norm = np.linalg.norm(matrix)
    assert np.max(np.abs(values - want)) <= 1e-13 * norm
    assert np.max(np.abs(found.T @ found - np.eye(len(values)))) < 1e-13
    assert np.max(np.abs(matrix @ found - found * values)) <= 1e-12 * norm
