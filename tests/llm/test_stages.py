"""Stages of the pipeline by themselves."""

import random

from test_similar import Links, shingle_set

import corpus_pipeline
from payloom.llm import near_dup


def test_near_copies_of_four_fifths_go(spark):
    rng = random.Random(21)
    rows = []
    for i in range(0, 120, 2):
        words = [f"w{rng.randrange(10**9)}" for _ in range(204)]
        rows.append((i, " ".join(words)))
        cut = rng.randint(12, 34)  # a new tail of this many words: similarity 0.71 to 0.89
        rows.append((i + 1, " ".join(words[: 204 - cut] + [f"n{rng.randrange(10**9)}" for _ in range(cut)])))
    links, sets = Links([i for i, _ in rows]), [shingle_set(t) for _, t in rows]
    between = 0
    for a in range(len(rows)):
        for b in range(a):
            both, union = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if 100 * both >= 80 * union:
                links.link(a, b)
                between += 100 * both < 85 * union
    want = [i for i, _ in rows if links.find(i) == i]
    assert between >= 10 and 60 < len(want) < 100
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()) == want


def test_an_id_with_unlike_texts_is_several_documents(spark):
    rng = random.Random(5)
    a, b, c = (" ".join(f"w{rng.randrange(10**9)}" for _ in range(60)) for _ in range(3))
    rows = [(1, a, "x"), (1, b, "y"), (1, a, "x"), (2, a + " tail", "z"), (3, b + " tail", "z"), (4, c, None), (0, c + " tail", "q"), (5, None, "n"), (5, "", "e")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = sorted(map(tuple, near_dup.distinct_documents(docs).collect()), key=repr)
    assert got == sorted([rows[0], rows[1], rows[6], rows[7], rows[8]], key=repr)


def test_bands_suit_the_threshold():
    for percent in (80, 85, 90):
        bands, rows = near_dup.banding(percent)
        assert (1 - (percent / 100) ** rows) ** bands <= 2e-6
    assert near_dup.banding(85) == (28, 6)
