"""Whitening against exact integers and numpy's own decomposition."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from rows import SMALL

from tidemark.llm import whitening as wh

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("label", T.IntegerType()), T.StructField("x", T.StringType()),
                       T.StructField("n", T.StringType()), T.StructField("component", T.StringType())])


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 0, "a", "b", "c") for i, v in vectors], SCHEMA)


def integers(vector):
    return [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in vector]


def check(rows, vectors, components=16):
    """Every column of the result, from the usable (vec_id, vector) pairs."""
    fit = np.array(sorted({tuple(integers(v)) for _, v in vectors}), dtype=object)
    n, sums, width = len(fit), fit.sum(axis=0), fit.shape[1]
    centred = ((fit * n - sums) / n).astype(float)
    cov = centred.T @ centred / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(components, width)
    assert len(rows) == len(vectors) * k
    got = {}
    for r in rows:
        got.setdefault((r.vec_id, r.deviation), []).append(r)
    trace = np.trace(cov)
    by_component = {c: {} for c in range(1, k + 1)}
    for key, v in vectors:
        x = np.array(integers(v), dtype=object)
        deviation = int(((n * x - sums) ** 2).sum())
        mine = got[key, deviation if deviation < 2**63 else None]
        assert {r.n for r in mine} == {n}
        for r in mine:
            by_component[r.component].setdefault((key, tuple(x)), set()).add(r.whitened)
            if trace > 0:
                assert r.explained == pytest.approx(values[r.component - 1] / trace, rel=1e-6, abs=1e-12)
            assert r.identity_error is None or r.identity_error < 1e-4
    for c, found in by_component.items():
        value = values[c - 1]
        if value <= width * wh.EPS * max(values[0], 0):
            assert all(w == {None} for w in found.values())
            continue
        mine = np.array([next(iter(w)) for w in found.values()])
        assert all(len(w) == 1 for w in found.values())
        xs = ((np.array([k[1] for k in found], dtype=object) * n - sums) / n).astype(float)
        # the component lies in the eigenspace: its axis, solved from the rows, is an eigenvector
        near = np.abs(values - value) < 1e-9 * values[0]
        parts = xs @ axes[:, near] / np.sqrt(value)
        fitted = parts @ np.linalg.lstsq(parts, mine, rcond=None)[0]
        assert np.allclose(fitted, mine, atol=1e-6)


def test_query_equals_exact_integers(spark):
    rows = wh.op12_embedding_whitening(spark, SMALL).collect()
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    check(rows, vectors)
    assert {r.component for r in rows} == set(range(1, 17))
    assert max(r.identity_error for r in rows) < 1e-9


def test_copies_nulls_and_non_finite_entries(spark):
    rng = np.random.default_rng(2)
    good = [(i, [float(c) for c in v]) for i, v in enumerate(rng.standard_normal((60, 5)))]
    good += [(100, good[0][1]), (100, good[0][1]), (None, good[1][1]), (7, good[3][1])]
    bad = [(200, None), (201, [1.0, None, 1.0, 1.0, 1.0]), (202, [1.0, float("nan"), 1.0, 1.0, 1.0]),
           (203, [float("inf")] * 5), (204, [1.0, 2.0]), (205, []), (206, [1e30] * 5)]
    rows = wh.whiten(frame(spark, good + bad).repartition(5)).collect()
    assert not {r.vec_id for r in rows} & set(range(200, 207))
    check(rows, good)


def test_equal_eigenvalues_and_flat_directions(spark):
    square = [(i, [8.0 * a, 8.0 * b, 8.0 * c, 1.0])
              for i, (a, b, c) in enumerate((a, b, c) for a in (0, 1) for b in (0, 1) for c in (0, 1))]
    rows = wh.whiten(frame(spark, square)).collect()
    check(rows, square)
    assert {r.whitened for r in rows if r.component == 4} == {None}
    assert {round(r.explained, 9) for r in rows if r.component < 4} == {round(1 / 3, 9)}


def test_one_vector_and_no_vector(spark):
    rows = wh.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert len(rows) == 4 and {(r.whitened, r.explained, r.identity_error, r.deviation, r.n) for r in rows} == {
        (None, None, None, 0, 1)}
    for none in ([], [(1, None)], [(1, [])]):
        empty = wh.whiten(frame(spark, none))
        assert empty.count() == 0 and empty.columns[:2] == ["vec_id", "component"]


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(4)
    far = [(i, [float(np.float32(c * 1e9)) for c in v]) for i, v in enumerate(rng.standard_normal((20, 3)))]
    rows = wh.whiten(frame(spark, far)).collect()
    assert any(r.deviation is None for r in rows)
    check(rows, far)


def test_too_many_dimensions(spark, monkeypatch):
    monkeypatch.setattr(wh, "MAX_DIMENSIONS", 3)
    with pytest.raises(ValueError, match="dimensions"):
        wh.whiten(frame(spark, [(1, [1.0] * 4)]))


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64])
@pytest.mark.parametrize("kind", ["random", "one", "half", "spread", "steps"])
def test_eigenpairs(n, kind):
    rng = np.random.default_rng(n)
    q, _ = np.linalg.qr(rng.standard_normal((n, n)))
    spectrum = {"random": rng.random(n), "one": np.ones(n), "half": (np.arange(n) < n // 2) * 1.0,
                "spread": 10.0 ** -rng.integers(0, 12, n), "steps": np.arange(n) // 4 + 1.0}[kind]
    matrix = (q * spectrum) @ q.T
    matrix = (matrix + matrix.T) / 2
    k = min(16, n)
    values, vectors = wh.leading_eigenpairs(matrix, k)
    scale = max(np.abs(spectrum).max(), 1e-300)
    assert np.abs(values - np.sort(np.linalg.eigvalsh(matrix))[::-1][:k]).max() < 1e-12 * scale
    assert np.abs(vectors @ vectors.T - np.eye(k)).max() < 1e-12
    assert np.abs(matrix @ vectors.T - vectors.T * values).max() < 1e-12 * scale
    diagonal, off, _ = wh.tridiagonal(matrix)
    x = np.linspace(-0.5, 1.5, 9) * scale + 3e-7    # no eigenvalue lies there
    assert (wh.count_below(diagonal, off, x) == (np.linalg.eigvalsh(matrix)[:, None] < x).sum(axis=0)).all()


def test_result_is_one_projection_for_all_rows(spark):
    rows = wh.op12_embedding_whitening(spark, SMALL)
    again = wh.op12_embedding_whitening(spark, SMALL).withColumnRenamed("whitened", "w2")
    both = rows.join(again, ["vec_id", "component"])
    assert both.filter(F.abs(F.abs("whitened") - F.abs("w2")) > 1e-9).count() == 0
