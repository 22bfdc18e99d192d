"""Quality classifier and language-model scoring."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F
from samples import prose

from payloom.llm import lm_scoring, quality


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(400):
        good = rng.random() < 0.7
        text = prose(rng, rng.randint(5, 60))
        rows.append((i, text if good else text.upper().replace(" ", "!! "), "junk" if good else "fine"))
        labels.append((i, int(good), 0))
    labels += [(None, 1, 0), (9999, 1, 0), (3, None, 0)]
    return (
        spark.createDataFrame(rows, "doc_id bigint, text string, label string"),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
    )


def test_classifier_on_held_out_rows(labelled):
    docs, labels = labelled
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = quality.classify(docs, labels).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 400 and {r.held_out for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0} == {True}
    assert np.mean([r.predicted == truth[r.doc_id] for r in held if r.doc_id != 3]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    again = quality.classify(docs, labels).collect()
    assert sorted(rows) == sorted(again)
    few = quality.classify(docs, labels, sample=60).collect()
    assert len(few) == 400


def test_classifier_on_odd_inputs(labelled, messy, none):
    docs, labels = labelled
    weights = quality.train(docs, labels)
    scored = quality.score(messy, weights).collect()
    assert len(scored) == messy.count() and all(0 <= r.score <= 1 for r in scored)
    kept = quality.keep(messy, weights, threshold=0.0)
    assert kept.columns == messy.columns and kept.count() == messy.count()
    assert quality.keep(none, weights).collect() == [] and quality.score(none, weights).collect() == []
    unlabelled = quality.classify(messy, labels.limit(0)).collect()
    assert {r.score for r in unlabelled} == {0.5}


def brute_features(text, bits):
    """Damped, scaled counts of hashed words and pairs of neighbours, written out plainly."""
    mix, mask = 0x9E3779B97F4A7C15, (1 << 64) - 1
    h = [xxhash.xxh3_64_intdigest(t) for t in regex.findall(r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+", text or "")]
    found = Counter((x * mix & mask) >> (64 - bits) for x in h)
    for a, b in zip(h, h[1:]):
        found[(mix if a == b else ((a * mix + b) * mix) & mask) >> (64 - bits)] += 1
    norm = math.sqrt(sum(found.values()))
    return {c: math.sqrt(n) / norm for c, n in found.items()}


def brute_ftrl(rows, bits, alpha, l1, l2, parts, rounds):
    """Weights after `rounds` averaged passes over the parts, from ``(part, h, text, label)``."""
    z, n = Counter(), Counter()

    def weight(z, n, c):
        return 0.0 if abs(z[c]) <= l1 else (math.copysign(l1, z[c]) - z[c]) / ((1 + math.sqrt(n[c])) / alpha + l2)

    for _ in range(rounds):
        states = []
        for part in range(parts):
            own = sorted((r[1:] for r in rows if r[0] == part))
            zs, ns = Counter(z), Counter(n)
            for _, text, label in own:
                x = {**{c: float(np.float32(v)) for c, v in brute_features(text, bits).items()}, "bias": 1.0}
                w = {c: weight(zs, ns, c) for c in x}
                p = 1 / (1 + math.exp(-sum(w[c] * x[c] for c in x)))
                for c in x:
                    g = (p - label) * x[c]
                    zs[c] += g - (math.sqrt(ns[c] + g * g) - math.sqrt(ns[c])) / alpha * w[c]
                    ns[c] += g * g
            states.append((len(own), zs, ns))
        total = sum(s[0] for s in states)
        z = Counter({c: sum(k / total * s[c] for k, s, _ in states) for c in set().union(*(s for _, s, _ in states))})
        n = Counter({c: sum(k / total * s[c] for k, _, s in states) for c in set().union(*(s for _, _, s in states))})
    return {c: weight(z, n, c) for c in z}


def test_weights_and_scores_equal_plain_updates(spark, labelled):
    docs, labels = labelled
    truth = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None}
    texts = {r.doc_id: r.text for r in docs.collect()}
    h = F.xxhash64("doc_id", F.lit(11))
    part = F.pmod(F.hash(F.pmod(h, F.lit(3))), F.lit(3))  # where a repartition by that value puts a row
    hashes = {r.doc_id: (r.part, r.h) for r in docs.select("doc_id", h.alias("h"), part.alias("part")).collect()}
    rows = [
        (*hashes[i], t, truth[i]) for i, t in texts.items() if i in truth and zlib.crc32(str(i).encode()) % 5 != 0
    ]
    options = {"bits": 9, "alpha": 1.5, "l1": 0.02, "l2": 0.1, "parts": 3, "rounds": 2}
    want = brute_ftrl(rows, **options)
    got = quality.train(docs, labels, **options)
    assert got[-1] == pytest.approx(want["bias"], abs=1e-9) and np.count_nonzero(got) > 100
    assert all(got[c] == pytest.approx(want.get(c, 0.0), abs=1e-9) for c in range(512))
    scored = {r.doc_id: r.score for r in quality.score(docs, got, bits=9).collect()}
    for i, t in texts.items():
        margin = sum(want.get(c, 0.0) * v for c, v in brute_features(t, 9).items()) + want["bias"]
        assert scored[i] == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-9)


def brute_ctw(texts, depth):
    """Code lengths straight from the definition, with one dictionary for each tree node."""
    counts, children = {}, {}

    def nodes(row, i):
        for level in range(8):
            prefix = (1 << level) | (row[i] >> (8 - level))
            yield prefix, (row[i] >> (7 - level)) & 1

    rows = [(b"\0" * depth + lm_scoring.lowered(t) + b"\xff", learn) for t, learn in texts]
    for row, learn in rows:
        for i in range(depth, len(row)):
            for prefix, bit in nodes(row, i):
                for d in range(depth + 1):
                    node = counts.setdefault((prefix, row[i - d : i]), [0, 0])
                    node[bit] += learn
                    if d:
                        children.setdefault((prefix, row[i - d + 1 : i]), set()).add((prefix, row[i - d : i]))

    def kt(zeros, ones):
        return math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.lgamma(zeros + ones + 1) - math.log(math.pi)

    weights, stops = {}, {}
    for node in sorted(counts, key=lambda n: -len(n[1])):
        own = kt(*counts[node])
        if len(node[1]) == depth:
            weights[node], stops[node] = own, 1.0
            continue
        below = sum(weights[c] for c in children[node])
        both = max(own, below) + math.log1p(math.exp(-abs(own - below)))
        weights[node], stops[node] = both - math.log(2), math.exp(own - both)
    out = []
    for row, _ in rows:
        total = 0.0
        for i in range(depth, len(row)):
            for prefix, bit in nodes(row, i):
                p, left, best = 0.0, 1.0, 0.5
                for d in range(depth + 1):
                    node = (prefix, row[i - d : i])
                    zeros, ones = counts[node]
                    if zeros + ones:
                        best = (ones + 0.5) / (zeros + ones + 1)
                    p += left * stops[node] * best
                    left *= 1 - stops[node]
                total += math.log10(p if bit else 1 - p)
        out.append(total)
    return out


def test_scores_equal_the_definition(messy, none, monkeypatch):
    monkeypatch.setattr(lm_scoring, "BUCKET", 300)  # several buckets and blocks on a small table
    monkeypatch.setattr(lm_scoring, "BLOCK", 4000)
    docs = messy.where("length(coalesce(text, '')) < 3000")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in rows]
    tokens = [(t or "").encode().lower().split() for _, t in rows]
    c = Counter(w for words, h in zip(tokens, held) if not h for w in words)
    c["end of text"] = sum(not h for h in held)
    total, distinct = sum(c.values()), len(c)
    scores = brute_ctw([(t, not h) for (_, t), h in zip(rows, held)], 5)
    want = sorted(
        (repr(i), h, len(w) + 1, sum(c[x] > 0 for x in [*w, "end of text"]), total,
         round(sum(math.log10((c[x] + 0.1) / (total + 0.1 * (distinct + 1))) for x in [*w, "end of text"]), 6), round(s, 6))
        for (i, _), h, w, s in zip(rows, held, tokens, scores)
    )
    got = lm_scoring.code_length(lm_scoring.score(docs)).collect()
    assert sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got) == want
    assert all(r.bits_per_byte > 0 for r in got)
    assert lm_scoring.score(none).collect() == []
    assert len(lm_scoring.score(messy).collect()) == messy.count()


def test_probabilities_of_all_bytes_sum_to_one():
    grams, _ = lm_scoring.grams_of([b"the thing that they thought", b"then"], 3)
    context = grams[7] >> 8
    every = np.unique(np.concatenate([grams, (context << 8) + np.arange(256)]))
    counts = np.array([np.count_nonzero(grams == g) for g in every])
    levels = lm_scoring.subtree(every, counts, 3)
    below = np.bincount(levels[0].keys & 0xFFFF, levels[0].pw, 65536).reshape(256, 256)
    pairs = np.bincount(every & 65535, counts, 65536).reshape(256, 256)
    logs = lm_scoring.log_probs(every, counts, lm_scoring.Top(pairs, below), 3)
    assert abs((10 ** logs[(every >> 8) == context]).sum() - 1) < 1e-9
