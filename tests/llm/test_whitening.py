import math

import numpy as np
import pytest

from tessera.llm import whitening


def quantize(vectors, dims):
    rows = []
    for i, v in vectors:
        if v is not None and all(c is not None and math.isfinite(c) for c in v):
            x = [math.floor(256 * float(np.float32(c))) for c in v]
            rows.append((i, x + [0] * (dims - len(x))))
    return rows


def check(spark, vectors, dims, k=4):
    df = spark.createDataFrame([(i, v, "a", 1, 2.0) for i, v in vectors],
                               "vec_id long, embedding array<float>, n string, component int, w0 double")
    got = {(r.vec_id, r.component): r for r in whitening.whiten(df, k).collect()}
    rows = quantize(vectors, dims)
    fit = sorted({tuple(x) for _, x in rows})
    n, total = len(fit), [sum(x[d] for x in fit) for d in range(dims)]
    centred = np.array([[float(n * x[d] - total[d]) / n for d in range(dims)] for x in fit])
    v = centred.T @ centred / n
    values, basis = np.linalg.eigh(v)
    values, basis = values[::-1], basis[:, ::-1]
    assert {i for i, _ in got} == {i for i, _ in rows}
    for c in range(min(k, dims)):
        signs = set()
        for i, x in rows:
            r = got[(i, c + 1)]
            assert r.n == n
            assert int(r.deviation) == sum((n * x[d] - total[d]) ** 2 for d in range(dims))
            if values[c] <= 1e-12 * max(values[0], 1e-300):
                assert r.whitened is None
                continue
            want = (np.array([n * x[d] - total[d] for d in range(dims)], float) / n) @ basis[:, c] / values[c] ** 0.5
            if abs(want) > 1e-9:
                signs.add(math.copysign(1, want * r.whitened))
            assert abs(abs(want) - abs(r.whitened)) < 1e-7
            assert abs(r.explained - values[c] / values.sum()) < 1e-10
            assert r.identity_error < 1e-9
        assert len(signs) <= 1
    return got


def test_against_eigh(spark):
    rng = np.random.default_rng(4)
    mixed = rng.standard_normal((300, 12)) @ (rng.standard_normal((12, 12)) * np.linspace(0.1, 1, 12))
    vectors = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(mixed)]
    vectors += [(1000 + i, v) for i, v in vectors[:40]] + [(500, None), (501, [1.0, None]), (502, [math.nan] * 12),
                               (503, [math.inf] + [0.0] * 11), (504, [0.5, -0.25]), (505, []), (None, vectors[9][1])]
    check(spark, [x for x in vectors if x[0] is not None], 12)
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    assert whitening.whiten(df).where("vec_id is null").count() == 4


def test_large_entries_are_exact(spark):
    rng = np.random.default_rng(8)
    vectors = [(i, [float(c) for c in rng.integers(-2 ** 40, 2 ** 40, 3)]) for i in range(30)]
    check(spark, vectors, 3)
    far = spark.createDataFrame([(1, [1e30]), (2, [0.0])], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="not a long"):
        whitening.whiten(far).collect()


def test_edges(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, []), (2, None)], schema)).collect() == []
    same = whitening.whiten(spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25])], schema)).collect()
    assert sorted((r.vec_id, r.component, r.n, int(r.deviation), r.whitened, r.explained, r.identity_error)
                  for r in same) == [(i, c, 1, 0, None, None, None) for i in (1, 2) for c in (1, 2)]
    check(spark, [(i, [float(i % 5), 2.0 * (i % 5), 1.0]) for i in range(20)], 3)      # rank one


@pytest.mark.parametrize("spectrum", [
    [5, 5, 5, 1, 1], [3, 3 - 1e-13, 2, 1, 0], [0, 0, 0, 0, 0], [1e12, 1, 1e-6, 0, 0], [1, -1, 2, -2, 0.5]])
def test_slicing_numbers_every_component(spectrum):
    rng = np.random.default_rng(2)
    q, _ = np.linalg.qr(rng.standard_normal((5, 5)))
    v = (q * spectrum) @ q.T
    v = (v + v.T) / 2
    found = whitening.leading(v, 4)
    scale = max(np.abs(spectrum).max(), 1e-300)
    assert np.abs(np.array([e for e, _ in found]) - np.sort(spectrum)[::-1][:4]).max() <= 1e-14 * scale * 10
    basis = np.stack([x for _, x in found], axis=1)
    assert np.abs(basis.T @ basis - np.eye(4)).max() < 1e-9
    for e, x in found:
        assert np.linalg.norm(v @ x - e * x) <= 1e-13 * scale


def test_inertia_counts():
    rng = np.random.default_rng(6)
    for n in (1, 2, 3, 9, 40):
        a = rng.standard_normal((n, n))
        a = a + a.T
        values = np.linalg.eigvalsh(a)
        for shift in [*(values[:-1] + values[1:]) / 2, values[0] - 1, values[-1] + 1]:
            assert whitening.below(a, shift) == (values < shift).sum()
    assert whitening.below(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1        # a block of two
