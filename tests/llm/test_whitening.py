import math
from collections import Counter

import __spark_entry__ as entry
import numpy as np
import pytest

from tallyframe.llm import whitening as w

FOLDER = "/root/testdata/sf0.001"


def brute(rows, components=4):
    """Rows by (id, component), from an eigendecomposition of the whole matrix; x by id."""
    whole = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) and abs(c) < 2**37 for c in v)]
    sizes = Counter(len(v) for _, v in whole)
    size = max(sizes, key=lambda k: (sizes[k], k), default=0)
    xs = [(i, tuple(math.floor(256 * c) for c in v)) for i, v in whole if len(v) == size]
    fit = sorted({x for _, x in xs})
    n = len(fit)
    if not n:
        return [], fit
    sums = [sum(c) for c in zip(*fit, strict=True)]
    values, vectors = np.linalg.eigh(np.cov(np.array(fit, dtype=float).T, bias=True).reshape(size, size))
    values, vectors = values[::-1], vectors[:, ::-1]
    out = []
    for i, x in xs:
        away = sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))
        for k in range(min(components, size)):
            if values[k] > 1e-12 * values[0]:
                y = (np.array(x) - np.array([s / n for s in sums])) @ vectors[:, k] / math.sqrt(values[k])
                out.append((i, k + 1, n, away, y, values[k] / values.sum()))
    return out, fit


def same(got, want):
    assert len(got) == len(want)
    order = lambda r: (r[1], str(r[0]), r[3] or 0, abs(r[4]))
    got = sorted([(r[0], r.component, r.n, r.deviation, r.whitened, r.explained) for r in got], key=order)
    want = sorted(want, key=order)
    for k in range(1, 5):
        a, b = ([r for r in rows if r[1] == k] for rows in (got, want))
        if not a:
            continue
        assert [r[:4] for r in a] == [r[:4] for r in b]
        x, y = np.array([r[4] for r in a]), np.array([r[4] for r in b])
        assert min(np.abs(x - y).max(), np.abs(x + y).max()) < 1e-7
        assert np.allclose([r[5] for r in a], [r[5] for r in b], rtol=1e-9)


def test_against_numpy(spark):
    draws = np.random.default_rng(5)
    axes = draws.standard_normal((6, 6)) * np.array([9, 5, 3, 1, 0.5, 0.2])[:, None]
    vectors = (draws.standard_normal((300, 6)) @ axes).tolist()
    rows = [(i, v) for i, v in enumerate(vectors + vectors[:40] + [vectors[0]] * 200)]
    rows += [(1, None), (2, []), (3, [1.0] * 5 + [None]), (4, [float("nan")] + [1.0] * 5), (5, [float("inf")] + [0.0] * 5), (6, [1.0] * 5), (7, [1e30] + [0.0] * 5), (None, [1.0] * 6), (8, [-0.0] * 6), (8, [0.0] * 6)]
    table = spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], "vec_id long, embedding array<double>, n int, row int, x string").repartition(5)
    got = w.whiten(table).collect()
    want, _ = brute(rows)
    same(got, want)
    assert len(got) == 4 * 543 and {r.identity_error < 1e-9 for r in got} == {True}


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = entry.queries()["op12_sturm_whitening"](spark, FOLDER).collect()
    want, _ = brute(rows)
    same(got, want)
    assert max(r.identity_error for r in got) < 1e-6 and {r.n for r in got} == {want[0][2]}


def test_few_components_and_none(spark):
    kind = "vec_id string, embedding array<float>"
    none = w.whiten(spark.createDataFrame([], kind))
    assert none.count() == 0 and none.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert w.whiten(spark.createDataFrame([("a", [1.0, 2.0])] * 5, kind)).count() == 0
    line = [(str(i), [float(i), 2.0 * i, 0.5]) for i in range(9)] + [("y", None)]
    got = w.whiten(spark.createDataFrame(line, kind)).collect()
    assert len(got) == 9 and {r.component for r in got} == {1} and {round(r.explained, 12) for r in got} == {1.0}
    assert np.isclose(sum(r.whitened**2 for r in got) / 9, 1.0)
    one = w.whiten(spark.createDataFrame([("a", [1.0]), ("b", [3.0])], kind)).collect()
    assert {(r.vec_id, abs(round(r.whitened, 9)), r.deviation, r.n) for r in one} == {("a", 1.0, 512**2, 2), ("b", 1.0, 512**2, 2)}


def test_deviations_are_exact():
    x = np.array([[2**30, -5], [3, 2**44]])
    sums = np.array([2**31, 11])
    assert w.deviation(x, 2, sums) == [441, None]
    assert w.deviation(x[:1], 3, sums) == [2**60 + 26**2]
    assert w.deviation(np.empty((0, 2), np.int64), 3, sums) == []


@pytest.mark.parametrize("kind", ["spread", "clusters", "split", "equal", "zero", "graded"])
def test_leading_eigenvectors(kind):
    draws = np.random.default_rng(9)
    n = 40
    basis = np.linalg.qr(draws.standard_normal((n, n)))[0]
    values = {"spread": np.arange(n) + 1.0, "clusters": np.repeat([5.0, 5.0 + 1e-13, 3.0, 1.0], n // 4), "equal": np.ones(n), "zero": np.zeros(n), "graded": 10.0 ** -np.arange(n)}.get(kind)
    matrix = np.kron(np.eye(n // 2), [[2.0, 1.0], [1.0, 2.0]]) if kind == "split" else (basis * values) @ basis.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = w.leading(matrix, 6)
    scale = max(1e-300, np.abs(matrix).max())
    assert np.allclose(found, np.linalg.eigvalsh(matrix)[::-1][:6], rtol=0, atol=1e-13 * n * scale)
    assert np.abs(vectors.T @ vectors - np.eye(6)).max() < 1e-12
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-12 * n * scale
    for size in (1, 2, 3):
        small = matrix[:size, :size]
        assert np.allclose(w.leading(small, 4)[0], np.linalg.eigvalsh(small)[::-1])
