"""Contour whitening against a dense eigensolver."""

import numpy as np
import pytest

from inkmill.llm import whitening

SCHEMA = "vec_id long, x string, embedding array<float>, n long"


def matrices():
    rng = np.random.default_rng(3)
    for dim in (1, 2, 5, 12, 30):
        wide = rng.standard_normal((dim, 3 * dim))
        yield wide @ wide.T
        low = rng.standard_normal((dim, max(1, dim // 3)))
        yield low @ low.T  # rank below dimension
        turn = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        yield (turn * np.repeat(rng.random(dim), 3)[:dim]) @ turn.T  # equal eigenvalues
        yield (turn * 10.0 ** -np.arange(dim)) @ turn.T
        yield np.eye(dim)


def test_inertia_and_feast():
    for matrix in matrices():
        matrix = (matrix + matrix.T) / 2
        matrix /= np.trace(matrix)
        true = np.linalg.eigvalsh(matrix)[::-1]
        for shift in (-0.1, 0.0137, 0.2113, 0.8971):
            assert whitening.above(matrix, shift)[0] == (true > shift).sum()
        for wanted in (1, 4, 50):
            values, vectors = whitening.feast(matrix, wanted)
            assert np.abs(values - true[:wanted]).max() < 1e-12
            assert np.abs(matrix @ vectors - vectors * values).max() < 1e-12
            assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12


def test_more_eigenvalues_near_each_other_than_a_block():
    turn = np.linalg.qr(np.random.default_rng(4).standard_normal((40, 40)))[0]
    spectrum = np.concatenate([1 + 1e-7 * np.arange(25), np.linspace(0, 0.9, 15)])
    matrix = (turn * spectrum) @ turn.T
    values, vectors = whitening.feast((matrix + matrix.T) / 2, 25)
    assert np.abs(values - np.sort(spectrum)[::-1][:25]).max() < 1e-12
    assert np.abs(vectors.T @ vectors - np.eye(25)).max() < 1e-10


def brute_force(rows, components):
    """vec_id, component -> deviation, whitened (up to sign), explained."""
    kept = {}
    for vec_id, vector in rows:
        if vector and all(c is not None and np.isfinite(c) for c in vector):
            kept.setdefault(vec_id, []).append(tuple(int(np.floor(256 * float(np.float32(c)))) for c in vector))
    fitted = sorted({x for xs in kept.values() for x in xs})
    n, dim = len(fitted), len(fitted[0])
    sums = [sum(x[d] for x in fitted) for d in range(dim)]
    centred = np.array(fitted, float) - np.array([s / n for s in sums])
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    out = {}
    for vec_id, xs in kept.items():
        for x in xs:
            deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
            for k in range(min(components, dim)):
                e, u = values[-1 - k], vectors[:, -1 - k]
                w = (np.array(x) - np.array([s / n for s in sums])) @ u / np.sqrt(e)
                out.setdefault((vec_id, k + 1), []).append((deviation, abs(w), e / np.trace(cov)))
    return n, out


@pytest.mark.parametrize("components", [4, 9])
def test_whiten_against_brute_force(spark, components):
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(v)) for v in rng.standard_normal(6) * (1 + np.arange(6))]) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(300, 420)]  # a hot vector
    rows += [(7, rows[7][1]), (None, rows[3][1])]
    rows += [(900, None), (901, []), (902, [None] + [1.0] * 5), (903, [float("nan")] * 6), (904, [float("inf")] + [0.0] * 5)]
    rows += [(905, [1.0, 2.0])]  # another length
    table = spark.createDataFrame([(i, "clash", v, 3) for i, v in rows], SCHEMA).repartition(5)
    got = whitening.whiten(table, components)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    n, want = brute_force([r for r in rows if r[0] != 905], components)
    found = {}
    for r in got.collect():
        assert r["n"] == n and r["identity_error"] < 1e-10
        found.setdefault((r["vec_id"], r["component"]), []).append((r["deviation"], abs(r["whitened"]), r["explained"]))
    assert found.keys() == want.keys()
    for key, values in want.items():
        assert np.allclose(found[key], values, rtol=1e-9, atol=1e-9)
        assert [v[0] for v in found[key]] == [v[0] for v in values]
    signs = {}
    for r in got.where("vec_id IN (7, 300, 419)").collect():
        signs.setdefault(r["component"], set()).add(round(r["whitened"], 12))
    assert all(len(s) == 1 for s in signs.values())


def test_no_variance_large_entries_and_empty(spark):
    schema = "vec_id long, embedding array<float>"
    same = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)
    assert whitening.whiten(same, 4).count() == 0
    assert whitening.whiten(spark.createDataFrame([], schema), 4).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None)], schema), 4).count() == 0
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(9)], schema)
    got = whitening.whiten(line, 4).collect()
    assert {r["component"] for r in got} == {1} and abs(got[0]["explained"] - 1) < 1e-9
    # Squares beyond a long are null; those within are exact though a product would overflow.
    large = spark.createDataFrame([(0, [0.0, 0.0]), (1, [4e6, 1.0]), (2, [4e6, 3.0]), (3, [1e20, 1.0])], schema)
    assert {r["deviation"] for r in whitening.whiten(large, 1).collect()} == {None}
    wide = spark.createDataFrame([(0, [0.0]), (1, [4e6]), (2, [4e6 + 1])], schema)
    deviations = {r["vec_id"]: r["deviation"] for r in whitening.whiten(wide, 1).collect()}
    total = 256 * (8_000_000 + 1)
    assert deviations == {i: (3 * 256 * v - total) ** 2 for i, v in enumerate((0, 4_000_000, 4_000_001))}
