import math

import numpy as np
import pytest

from inkmill.llm import bitsliced_topk as op

KIND = "vec_id long, embedding array<float>, label int"


def brute(rows, k, every):
    good = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v])
        for i, v, *_ in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    queries = {}
    for i, v in good:
        if i % every == 0:
            queries[i] = min(queries.get(i, v), v)
    out = []
    for q, vector in queries.items():
        scored = [
            (-sum(a * b for a, b in zip(vector, v)), i)
            for i, v in good
            if i != q and len(v) == len(vector)
        ]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def found(spark, rows, k=5, every=10, **more):
    df = op.search(spark.createDataFrame(rows, KIND), k, every, **more)
    return sorted(tuple(r) for r in df.collect())


def test_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 0.2, 7).astype("f4").tolist(), 0) for i in range(300)]
    rows += [(1000 + i, rows[3][1], 0) for i in range(120)]  # many copies of one vector
    assert found(spark, rows, block_rows=64) == brute(rows, 5, 10)


def test_nulls_ties_and_lengths(spark):
    rows = [
        (0, [1.0, 0.0], 1),
        (1, None, 1),
        (2, [1.0, None], 1),
        (3, [float("nan"), 1.0], 1),
        (4, [float("inf"), 1.0], 1),
        (None, [5.0, 5.0], 1),
        (5, [0.5, -0.5], None),
        (6, [0.5, 0.25], 1),
        (6, [0.5, 0.25], 1),
        (7, [9.0], 1),
        (10, [], 1),
        (20, [-3.0, 2.0], 1),
    ]
    assert found(spark, rows) == brute(rows, 5, 10)


def test_fewer_rows_than_k_and_none(spark):
    assert found(spark, [(0, [1.0], 0), (1, [2.0], 0)]) == [(0, 1, 1, 256 * 512)]
    assert found(spark, []) == []


def test_other_columns_may_clash(spark):
    rows = [(0, [1.0], 3, "x"), (1, [2.0], 4, "y")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, id long, block string")
    assert op.search(df, 5, 10).count() == 1


@pytest.mark.parametrize("value", [0, 1, -1, 7, -93, 255, 256, 12345, -98765])
def test_signed_digits(value):
    digits = op.signed_digits(value)
    assert sum(d << i for i, d in enumerate(digits)) == value
    assert all(not (a and b) for a, b in zip(digits, digits[1:]))
