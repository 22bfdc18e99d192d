"""Recall of vector search where norms differ."""

import numpy as np
import pytest

from payloom.llm import vector_search


@pytest.mark.parametrize("kind", ["one long", "one a little longer", "heavy tail"])
def test_recall_with_unlike_norms(spark, kind):
    rng = np.random.default_rng(17)
    x = rng.normal(size=(3000, 64))
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    if kind == "heavy tail":
        x *= rng.pareto(1.5, size=(len(x), 1)) + 1
    else:
        x[7] *= 50 if kind == "one long" else 1.9
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    found = {}
    for r in vector_search.search(df, lambda i: i % 20 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q, got in found.items():
        score = x @ x[q]
        score[q] = -np.inf
        hits += len(got & set(np.argsort(-score)[:20].tolist()))
    assert len(found) == 150 and hits / (20 * len(found)) >= 0.93


def forest_of(x, leaf=64, trees=8):
    """One band over rows of length one."""
    depth = int(np.log2(len(x) / leaf))
    bands = vector_search.Bands({0: vector_search.Forest(x, 1.0, depth, trees)})
    return bands, np.zeros(len(x), np.int64)


def test_clustered_rows_need_a_small_share():
    rng = np.random.default_rng(4)
    plain = rng.normal(size=(4000, 32))
    centres = rng.normal(size=(100, 32))
    clustered = centres[rng.integers(0, 100, 4000)] + 0.2 * rng.normal(size=(4000, 32))
    shares = {}
    for name, x in (("plain", plain), ("clustered", clustered)):
        x = x / np.sqrt((x * x).sum(axis=1))[:, None]
        bands, of = forest_of(x)
        visit = bands.learn_visit(x, of, 20, 0.965, 1.5)
        leaves, hits = bands.leaves(x, of), 0
        for i in range(1000, 1100):  # rows that the budget was not learnt from
            score = x @ x[i]
            score[i] = -np.inf
            near = set(bands.near(x[i], visit))
            hits += sum(bool(near & set(leaves[j].tolist())) for j in np.argsort(-score)[:20].tolist())
        assert hits / 2000 >= 0.93
        shares[name] = visit
    assert shares["clustered"] < 0.3 < 0.8 < shares["plain"] <= 1.5


def test_every_length_is_searched(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=8 if i % 3 else 5).tolist()) for i in range(90)] + [(100, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {}
    for r in vector_search.search(df, lambda i: i % 20 == 0, k=100).collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    for q, v in rows:
        if q % 20 == 0:
            want = {i: float(np.dot(v, w)) for i, w in rows if i != q and len(w) == len(v)}
            assert {i for i, _ in got.get(q, [])} == set(want) and all(abs(s - want[i]) < 1e-9 for i, s in got.get(q, []))
