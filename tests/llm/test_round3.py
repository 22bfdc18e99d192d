"""Hard negatives, whitening and toxicity against plain versions."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import prose

from payloom.llm import hard_negatives, toxicity, whitening


@pytest.fixture(scope="module")
def odd_vectors(spark):
    """Clustered vectors with ties, copies, hot labels, odd values and columns with clashing names."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=(6, 6))
    rows = []
    for i in range(420):
        v = (base[i % 6] + 0.4 * rng.normal(size=6)).tolist()
        rows.append((i, v, 0 if i % 3 == 0 else i % 5))
    rows += [(500 + i, rows[i][1], rows[i][2]) for i in range(30)]  # the same vector under another id
    rows += [rows[3], rows[3], (7, [0.5] * 6, 2)]  # repeated rows, and an id with two vectors
    rows += [(600, None, 1), (601, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (602, [float("nan")] * 6, 1), (603, [float("inf")] * 6, 2)]
    rows += [(604, [0.0] * 6, 1), (None, [1.0] * 6, 1), (605, [1.0] * 6, None), (606, [], 1), (650, [0.5, 0.25, -1.0], 1)]
    rows += [(700, [0.5, 0.5, 0.0], 2), (701, [0.25, 0.5, 0.0], 1), (607, [1e200] * 6, 1)]
    return spark.createDataFrame(
        [(*r, "x", 1.0, 2) for r in rows], "vec_id bigint, embedding array<double>, label int, rid string, norm double, d int"
    )


def valid_rows(df, bits, scale):
    out = {}
    for r in df.collect():
        v = r.embedding
        if v and all(x is not None and np.isfinite(x) and abs(x) * scale < 1 << bits for x in v):
            out[(r.vec_id, r.label, tuple(v))] = out.get((r.vec_id, r.label, tuple(v)), 0) + 1
    return out


def brute_negatives(df, is_anchor, positives=5, negatives=3, low=50, top=95, scale=256):
    rows = sorted(
        {(i, y, tuple(int(np.floor(scale * x)) for x in v)) for i, y, v in valid_rows(df, 24, scale) if i is not None and y is not None}
    )
    want = []
    for i, y, x in rows:
        if not is_anchor(i):
            continue
        scored = [(-sum(a * b for a, b in zip(x, q)), j, z) for j, z, q in rows if j != i and len(q) == len(x)]
        scored.sort()
        for s, j, _ in [r for r in scored if r[2] == y][:positives]:
            fits = [r for r in scored if r[2] != y and low * -s <= 100 * -r[0] <= top * -s][:negatives]
            want += [(i, j, rank, k, -s, -n) for rank, (n, k, _) in enumerate(fits, 1)]
    return sorted(want)


@pytest.mark.parametrize("sizes", [{}, {"chunk": 16, "block": 4, "count": 3}])
def test_hard_negatives_equal_brute_force(odd_vectors, sizes):
    got = hard_negatives.mine(odd_vectors, lambda i: i % 10 == 0, **sizes)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute_negatives(odd_vectors, lambda i: i % 10 == 0)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 100


def test_hard_negatives_of_few_rows(odd_vectors, spark):
    assert hard_negatives.mine(odd_vectors.limit(0), lambda i: i % 10 == 0).collect() == []
    one = odd_vectors.where("vec_id = 10")
    assert hard_negatives.mine(one, lambda i: i % 10 == 0).collect() == []
    large = spark.createDataFrame(
        [(0, [60_000.0] * 40, 1), (1, [60_000.0] * 40, 1), (2, [45_000.0] * 40, 2), (3, [59_999.0] * 40, 2)],
        "vec_id bigint, embedding array<double>, label int",
    )
    got = hard_negatives.mine(large, lambda i: i % 10 == 0).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 2, 40 * 15_360_000**2, 40 * 15_360_000 * 11_520_000)]


def test_bounds_hold_every_score():
    rng = np.random.default_rng(2)
    x = np.floor(rng.normal(size=(300, 12)) * rng.lognormal(3, 2, (300, 1))).astype(np.int32)
    refs = hard_negatives.references(12, 4, 1)
    norm = np.sqrt((x.astype(float) ** 2).sum(axis=1))
    angles = np.arccos(np.clip(x @ refs.T / np.where(norm > 0, norm, 1)[:, None], -1, 1)).astype(np.float32)
    row = {"rids": np.arange(300).tobytes(), "ids": np.arange(300).tobytes(), "norms": norm.tobytes(), "angles": angles.tobytes(), "x": x.tobytes()}
    rows = hard_negatives.Rows(row, 12)
    low, top = hard_negatives.bounds(rows, rows, slice(0, 300))
    s = x.astype(np.int64) @ x.T.astype(np.int64)
    assert (low <= s).all() and (s <= top).all() and (top - low < 1.9 * np.outer(norm, norm) + 3).mean() > 0.5


def test_whitening_equals_plain_numbers(odd_vectors):
    rows = valid_rows(odd_vectors, 38, 64)
    got = whitening.whiten(odd_vectors, components=4).collect()
    seen = {}
    for d in (3, 6):
        own = [(i, v) for (i, _, v), n in rows.items() for _ in range(n) if len(v) == d]
        x = {tuple(int(np.floor(64 * c)) + 1_000_000 for c in v) for _, v in own}
        n, total = len(x), [sum(c) for c in zip(*x)]
        centred = (np.array(sorted(x)) - 1_000_000) - (np.array(total) - 1_000_000 * n) / n
        values, vectors = np.linalg.eigh(centred.T @ centred / n)
        values, vectors = values[::-1], vectors[:, ::-1]
        for i, v in own:
            q = [int(np.floor(64 * c)) + 1_000_000 for c in v]
            dev = sum((n * a - s) ** 2 for a, s in zip(q, total))
            here = (np.array(q) - 1_000_000) - (np.array(total) - 1_000_000 * n) / n
            seen.setdefault((i, n, dev), []).append((here @ vectors[:, :4]) / np.sqrt(np.maximum(values[:4], 1e-300)))
        shares = [r.explained for r in got if r.n == n][: min(4, d)]
        assert sorted(shares, reverse=True) == pytest.approx(list(values[: len(shares)] / values.sum()), abs=1e-9)
    by_row = {}
    for r in got:
        by_row.setdefault((r.vec_id, r.n, r.deviation), {}).setdefault(r.component, []).append(r)
    assert set(by_row) == set(seen)
    for key, places in by_row.items():
        for k, same in places.items():
            assert len(same) == len(seen[key])
            if same[0].whitened is None:
                assert same[0].explained < 1e-9
            else:
                assert abs(same[0].whitened) == pytest.approx(abs(seen[key][0][k - 1]), rel=1e-9, abs=1e-9)
    assert max(r.identity_error for r in got) < 1e-9
    assert len(got) == sum(n * min(4, len(v)) for (_, _, v), n in rows.items())
    assert whitening.whiten(odd_vectors.limit(0)).collect() == []


def test_whitening_of_one_vector_and_of_wide_numbers(spark):
    rows = [(1, [0.5, 0.25]), (2, [0.5, 0.25])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id int, embedding array<float>")).collect()
    assert [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in sorted(got)] == [
        (i, k, 1, 0, None, 0.0, 0.0) for i in (1, 2) for k in (1, 2)
    ]
    wide = spark.createDataFrame([(1, [1e7, 0.0]), (2, [-1e7, 1.0]), (3, [5e6, 7.0])], "vec_id int, embedding array<double>")
    got = whitening.whiten(wide).collect()
    assert {r.n for r in got} == {3} and max(r.identity_error for r in got) < 1e-5
    w = np.array([[r.whitened for r in sorted(got) if r.component == k] for k in (1, 2)])
    assert np.allclose(w @ w.T / 3, np.eye(2), atol=1e-5)


@pytest.mark.parametrize("values", [[9, 9, 9, 4, 4, 1], [1 + 1e-7, 1, 1 - 1e-7, 1 + 1e-13, 0.5, 0], [5, 3, 1e-6, 1e-6, 1e-9, 0], [2] * 6])
def test_refined_eigenvectors(values):
    q = np.linalg.qr(np.random.default_rng(3).normal(size=(6, 6)))[0].astype(whitening.HIGH)
    for _ in range(3):
        q = q @ (1.5 * np.eye(6) - 0.5 * q.T @ q)  # orthogonal in high precision
    a = (q * np.array(values, whitening.HIGH)) @ q.T
    found, x = whitening.eigen((a + a.T) / 2)
    eps = float(np.finfo(float).eps)
    assert float(np.abs(np.array(found, float) - sorted(values, reverse=True)).max()) < 4 * eps * max(values)
    assert float(np.abs(x.T @ x - np.eye(6)).max()) < 4 * eps
    assert float(np.abs(a @ x - x * found).max()) < 4 * eps * max(values)
    # vectors of well separated values are right to double precision
    for i, v in enumerate(values):
        if min(abs(v - w) for j, w in enumerate(values) if j != i) > 0.1:
            k = sorted(values, reverse=True).index(v)
            assert abs(abs(float(q[:, i] @ x[:, k])) - 1) < 4 * eps


# -- toxicity ------------------------------------------------------------------------


def test_marginals_equal_all_paths():
    rng = np.random.default_rng(1)
    lengths = [1, 7, 0, 3, 9]
    text = np.repeat(np.arange(5), lengths)
    n = len(text)
    first = np.append(True, text[1:] != text[:-1])
    last = np.append(first[1:], True)
    e, steps = rng.normal(size=n) * 3, rng.normal(size=3)
    ahead, back = toxicity.forward_backward(e, first, last, steps)
    got = ahead * back / (1 + ahead * back)
    step = {(0, 0): 0.0, (0, 1): steps[0], (1, 0): steps[1], (1, 1): steps[2]}
    want = []
    for t in range(5):
        at = np.flatnonzero(text == t)
        total, mass = 0.0, np.zeros(len(at))
        for path in np.ndindex(*(2,) * len(at)):
            w = np.exp(sum(e[i] * y for i, y in zip(at, path)) + sum(step[p] for p in zip(path, path[1:])))
            total, mass = total + w, mass + w * np.array(path)
        want += list(mass / total) if len(at) else []
    assert np.allclose(got, want)
    none = toxicity.any_toxic(got, text, 5)
    assert np.allclose(1 / (1 + np.exp(-none))[[0, 1, 3, 4]], [1 - np.prod(1 - np.array(want)[text == t]) for t in (0, 1, 3, 4)])


def test_learning_follows_the_gradient_of_the_likelihood():
    texts = ["you bad man", "bad", "a fine bad bad day", "", "fine"]
    row = toxicity.Texts(toxicity.Words(10), texts)
    goal = toxicity.targets_of(row, texts, [[{"start": 4, "stop": 7}], [], [{"start": 7, "stop": 14}], [], []])
    assert goal.tolist() == [0, 1, 0, 0, 0, 0, 1, 1, 0, 0]
    rng = np.random.default_rng(8)
    weights, steps = rng.normal(size=1025) * 0.3, rng.normal(size=3)

    def likelihood(w, s):
        e = toxicity.potentials(row.columns, row.codes, row.first, row.last, w)
        step = {(0, 0): 0.0, (0, 1): s[0], (1, 0): s[1], (1, 1): s[2]}
        out = 0.0
        for t in range(5):
            at = np.flatnonzero(row.text == t)
            score = lambda path: sum(e[i] * y for i, y in zip(at, path)) + sum(step[p] for p in zip(path, path[1:]))
            out += score(goal[at].astype(int)) - np.log(sum(np.exp(score(p)) for p in np.ndindex(*(2,) * len(at))))
        return out

    class Recorder(toxicity.AdaGrad):
        def _step(self, w, w2, at, g):
            found.append((w, at, g))

    found = []
    model = Recorder(10, 1.0)
    model.w, model.steps = weights.copy(), steps.copy()
    model.learn(row, goal, 0.0)
    for values, at, g in found:
        for c, x in zip(at, g):
            moved = values.copy()
            moved[c] += 1e-5
            same = values is model.steps
            rise = likelihood(weights if same else moved, moved if same else steps) - likelihood(weights, steps)
            assert -x == pytest.approx(rise / 1e-5, abs=1e-3)


@pytest.fixture(scope="module")
def marked(spark):
    rng = random.Random(6)
    rows, labels, spans = [], [], {}
    for i in range(500):
        words = prose(rng, rng.randint(3, 80)).split(" ")
        toxic = rng.random() < 0.3
        for _ in range(rng.randint(1, 4) * toxic):
            words.insert(rng.randrange(len(words) + 1), rng.choice(["vile", "Rotten", "FOUL"]))
        rows.append((i, " ".join(words), "x"))
        labels.append((i, 1, int(toxic)))
    rows += [(1000 + i, rows[0][1] + f" copied passage {i % 2}", "x") for i in range(60)]
    labels += [(1000 + i, 1, 1) for i in range(60)]  # copies alone do not make their words offending
    labels += [(None, 1, 1), (9999, 1, 1), (3, 1, None)]
    return (
        spark.createDataFrame(rows, "doc_id bigint, text string, label string"),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
    )


def test_toxic_spans_on_held_out_rows(marked):
    docs, labels = marked
    truth = {r.doc_id: r.toxic for r in labels.collect() if r.doc_id is not None and r.doc_id < 500}
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = toxicity.classify(docs, labels).collect()
    assert len(rows) == 560 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert held and all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in held)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    for r in held:
        found = [w for s in r.spans for w in texts[r.doc_id][s.start : s.stop].split()]
        want = [w.strip(".\n") for w in texts[r.doc_id].split() if w.lower().strip(".\n") in ("vile", "rotten", "foul")]
        assert [w.strip(".\n") for w in found] == want
    assert sorted(rows) == sorted(toxicity.classify(docs, labels).collect())


def test_toxicity_on_odd_inputs(marked, messy, none):
    docs, labels = marked
    model = toxicity.learn(docs, labels, sample=200)
    rows = toxicity.score(messy, model).collect()
    assert len(rows) == messy.count() and all(0 <= r.score <= 1 for r in rows)
    empty = {r.score for r in rows if r.doc_id in (40, 41, 42, 43)}
    assert len(empty) == 1
    assert toxicity.score(none, model).collect() == []
    assert {r.score for r in toxicity.classify(messy, labels.limit(0)).collect()} == {0.5}
    clean = labels.withColumn("toxic", F.lit(0))
    assert all(r.score < 0.05 for r in toxicity.classify(docs, clean).collect())
