"""Neighbours with the default parameters where hashing alone leaves some out."""

import numpy as np
import pytest
from test_pair_operators import VECTORS, plain_neighbours, usable

from siltstone.llm import cross_polytope


def recall(spark, rows):
    expected = plain_neighbours(usable(rows))
    found = {}
    for r in cross_polytope.neighbours(spark.createDataFrame(rows, VECTORS)).collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert {q: len(v) for q, v in found.items()} == {q: len(v) for q, v in expected.items() if v}
    return sum(i in found[q] for q, v in expected.items() for i, _ in v) / sum(map(len, expected.values()))


@pytest.mark.parametrize("n", [10, 21, 40, 100])
def test_neighbours_of_few_rows(spark, n):
    v = np.random.default_rng(n).standard_normal((n, 64))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    assert recall(spark, [(i, x.tolist(), 0) for i, x in enumerate(v)]) >= (1 if n <= 21 else 0.95)


@pytest.mark.parametrize("spread", [0.3, 1.0])
def test_neighbours_of_uneven_norms(spark, small, spread):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    factors = np.random.default_rng(5).lognormal(0, spread, len(rows))
    assert recall(spark, [(r[0], [float(x) * f for x in r[1]], r[2]) for r, f in zip(rows, factors.tolist(), strict=True)]) >= 0.95


def test_sure_cosine():
    params = cross_polytope.Params()
    assert cross_polytope.sure_cosine(8, params) == -np.inf
    assert 0.1 < cross_polytope.sure_cosine(64, params) < 0.4 < cross_polytope.sure_cosine(768, params) < 1
    assert cross_polytope.sure_cosine(64, cross_polytope.Params(tables=2, probes=1, recall=1.1)) == 2
