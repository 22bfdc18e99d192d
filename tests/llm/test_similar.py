"""Near-duplicates and vector search against brute force."""

import random

import numpy as np
import pytest
from samples import prose, sorted_rows
from pyspark.sql import functions as F

from payloom.llm import common, near_dup, vector_dedup, vector_search


class Links:
    def __init__(self, ids):
        self.up = {i: i for i in ids}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def link(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_near_dup(rows):
    ids = sorted({i for i, _ in rows if i is not None})
    links, sets = Links(ids), [(i, shingle_set(t)) for i, t in rows if i is not None]
    for n, (a, x) in enumerate(sets):
        for b, y in sets[:n]:
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                links.link(a, b)
    return sorted(
        ((i, len(shingle_set(t)), None if i is None else links.find(i), i is None or links.find(i) == i) for i, t in rows), key=repr
    )


def near_copies(n=60):
    rng = random.Random(2)
    base = [f"w{i}" for i in range(150)]
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(150)] = f"n{rng.randrange(10**6)}"
        yield " ".join(words)


def test_documents(spark, messy, none):
    rows = [(r.doc_id, r.text) for r in messy.collect()] + [(1000 + i, t) for i, t in enumerate(near_copies())]
    rows.append((1003, "one doc_id with a second text that stands for itself alone here"))
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id bigint, text string, node int, digest int")
    assert sorted_rows(near_dup.deduplicate(docs)) == brute_near_dup(rows)
    assert near_dup.deduplicate(none).collect() == []


def test_small_parts_give_the_same_links(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BUCKET_PART", 7)
    monkeypatch.setattr(near_dup, "GROUP_PART", 5)
    rows = [(i, t) for i, t in enumerate(near_copies(80))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted_rows(near_dup.deduplicate(docs)) == brute_near_dup(rows)


def test_one_document_of_each_group_stays(spark, messy):
    kept = near_dup.distinct_documents(messy)
    assert kept.columns == messy.columns
    want = {r[0] for r in brute_near_dup([(r.doc_id, r.text) for r in messy.collect()]) if r[3] and r[0] is not None}
    ids = [r.doc_id for r in kept.where("doc_id is not null").collect()]
    assert sorted(ids) == sorted(want) and kept.where("doc_id is null").count() == 2


def test_pruning_bound_keeps_nearly_all_pairs_at_the_threshold():
    least = near_dup.least_matches(168, 28, 0.85, 1e-6)
    rng = np.random.default_rng(0)
    matches = rng.random((200_000, 168)) < 0.85 + 0.15 / 256
    kept = np.ones(len(matches), bool)
    for k, fewest in enumerate(least):
        kept &= matches[:, : 28 * (k + 1)].sum(axis=1) >= fewest
    assert kept.mean() > 1 - 1e-4
    far = rng.random((20_000, 168)) < 0.5
    assert (far.sum(axis=1) >= least[-1]).mean() < 1e-3


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(200, 150), (150, 300), (7, 7), (500, 501), (500, 501)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r.node: r.component for r in common.components(df).collect()}
    assert got == {i: 1 for i in range(1, 61)} | {150: 150, 200: 150, 300: 150, 500: 500, 501: 500}
    assert common.components(df.limit(0)).collect() == []


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 16))
    near = base[rng.integers(0, 30, 200)] + rng.normal(scale=0.06, size=(200, 16))
    hot = base[0] + rng.normal(scale=0.05, size=(150, 16))
    rows = [(i, v.tolist(), int(rng.integers(0, 2)) if i < 300 else 0, 1) for i, v in enumerate(np.vstack([base, near, hot]))]
    rows += [(700, rows[0][1], 0, 1), (701, rows[0][1], None, 1), (0, *rows[0][1:])]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0]]
    rows += [(800 + i, v, 0, 1) for i, v in enumerate(odd)] + [(None, rows[1][1], 0, 1)]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int, n int")


def usable(rows):
    for r in rows:
        v = np.array([np.nan if x is None else x for x in r.embedding or []], float)
        if r.vec_id is not None and len(v) and np.isfinite(v).all() and v.any():
            yield r.vec_id, r.label, tuple(v)


def test_vectors_link_like_brute_force(vectors):
    rows = vectors.collect()
    valid = sorted({x for x in usable(rows) if x[1] is not None})
    links, n = Links({r.vec_id for r in rows if r.vec_id is not None}), {}
    for i, (a, la, va) in enumerate(valid):
        for b, lb, vb in valid[:i]:
            if la == lb and len(va) == len(vb) and a != b:
                x, y = np.array(va), np.array(vb)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93:
                    n[a], n[b] = n.get(a, 0) + 1, n.get(b, 0) + 1
                    links.link(a, b)
    want = sorted(
        ((r.vec_id, n.get(r.vec_id, 0), r.vec_id if r.vec_id is None else links.find(r.vec_id), r.vec_id is None or links.find(r.vec_id) == r.vec_id) for r in rows),
        key=repr,
    )
    assert sum(n.values()) > 20_000
    for leaf in (1024, 40):  # one leaf; many splits with a cluster that no split shrinks
        assert sorted_rows(vector_dedup.deduplicate(vectors, leaf=leaf)) == want
    assert vector_dedup.deduplicate(vectors.limit(0)).collect() == []


def test_search(vectors):
    rows = sorted({(a, v) for a, _, v in usable(vectors.collect()) if len(v) == 16})
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    got = {}
    for r in vector_search.search(vectors, lambda i: i % 20 == 0, k=10).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r)
    assert set(got) == {i for i in ids if i % 20 == 0}
    hits = 0
    for q, found in got.items():
        score = (x * x[ids == q][0]).sum(axis=1)
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:10]
        hits += len({r.vec_id for r in found} & set(ids[order]))
        assert [r["rank"] for r in found] == list(range(1, 11))
        known = dict(zip(ids, score))
        assert all(abs(r.score - known[r.vec_id]) < 1e-9 for r in found)
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
    assert hits >= 0.95 * 10 * len(got)
    assert vector_search.search(vectors.limit(0), lambda i: i % 20 == 0).collect() == []
    few = vector_search.search(vectors.where(F.col("vec_id").isin(0, 20, 21)), lambda i: i % 20 == 0).collect()
    assert sorted((r.query_id, r.vec_id) for r in few) == [(0, 20), (0, 21), (20, 0), (20, 21)]


def test_recall_on_directions_without_structure(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(3000, 64))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    found = {}
    for r in vector_search.search(df, lambda i: i % 20 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q, got in found.items():
        score = x @ x[q]
        score[q] = -np.inf
        hits += len(got & set(np.argsort(-score)[:20].tolist()))
    assert hits / (20 * len(found)) >= 0.93


def test_copies_of_vectors_are_narrow_and_go_to_no_hot_cell(spark, monkeypatch):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(300, 8)).astype(np.float32)
    v[150:] = v[:150] + 0.05 * rng.normal(size=(150, 8)).astype(np.float32)
    rows = [(i, [float(x) for x in r], i % 2) for i, r in enumerate(v)]
    floats = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    kept, plans, settle, place = {}, [], vector_dedup.settle, vector_dedup.placed

    def settled(df, purpose):
        kept[purpose] = dict(df.dtypes).get("v")
        return settle(df, purpose)

    def placing(members, cuts):
        out = place(members, cuts)
        plans.append(out._jdf.queryExecution().optimizedPlan().toString())
        return out

    monkeypatch.setattr(vector_dedup, "settle", settled)
    monkeypatch.setattr(vector_dedup, "placed", placing)
    got = sorted_rows(vector_dedup.deduplicate(floats, leaf=32))
    assert kept["vectors"] == "array<float>"
    assert plans and all("strategy=broadcast" in p for p in plans)
    # doubles stay doubles, and give the same rows; so do rows that are dealt to their cells
    monkeypatch.setattr(vector_dedup, "FEW_CELLS", 0)
    wide = floats.withColumn("embedding", F.col("embedding").cast("array<double>"))
    assert sorted_rows(vector_dedup.deduplicate(wide, leaf=32)) == got
    assert kept["vectors"] == "array<double>" and "strategy=broadcast" not in plans[-1]
    assert sum(r[1] for r in got) > 0


def test_directions_of_a_cell_are_drawn_once():
    drawn = vector_dedup.directions(7, 2, 8)
    assert vector_dedup.directions(7, 2, 8) is drawn
    assert drawn.shape == (2, 8) and np.allclose((drawn * drawn).sum(axis=1), 1)
