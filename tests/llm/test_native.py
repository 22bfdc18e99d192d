"""Source mixing and URL filters."""

import random

import duckdb
import pandas as pd
import pytest
from samples import sorted_rows

from payloom.llm import mixing, url_filter
from payloom.llm.answers import ANSWERS


def test_mix_equals_its_sql(messy, none):
    con = duckdb.connect()
    documents = pd.DataFrame([(r.doc_id, r.text, r.source) for r in messy.collect()], columns=["doc_id", "text", "source"])
    con.execute("CREATE TABLE documents AS SELECT CAST(doc_id AS BIGINT) AS doc_id, text, source FROM documents")
    want = sorted(con.execute(ANSWERS["op3_source_mixing"]).fetchall(), key=repr)
    got = sorted(((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in mixing.mix(messy).collect()), key=repr)
    assert got == want
    shards = ANSWERS["op3_source_mixing"].replace("1000000.0", "3000.0")
    want = sorted(con.execute(shards).fetchall(), key=repr)
    got = mixing.mix(messy, shard_words=3000).collect()
    assert sorted(((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in got), key=repr) == want
    assert mixing.mix(none).collect() == [] and mixing.mixed(none).collect() == []


@pytest.fixture(scope="module")
def many(spark):
    rng = random.Random(6)
    rows = [(i, "w " * rng.randint(0, 400), rng.choice(["a"] * 5 + ["b", "c", "d", None])) for i in range(600)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string")


def water(sizes, weights, share, repeat):
    """Shares by weight, again and again, until no target is above its cap."""
    left, open_, target = share * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while True:
        w = sum(weights[i] for i in open_)
        over = {i for i in open_ if left * weights[i] / w > repeat * sizes[i]}
        if not over:
            for i in open_:
                target[i] = left * weights[i] / w
            return target
        for i in over:
            target[i] = repeat * sizes[i]
            left -= target[i]
        open_ -= over


def test_targets_and_quotas(many):
    for shard in (1_000_000, 9_000):
        rows = mixing.mix(many, shard_words=shard, block_words=16).collect()
        by = {}
        for r, source in zip(sorted(rows), sorted((r.doc_id, r.source) for r in many.collect())):
            by.setdefault(source[1], []).append(r)
        names = sorted(x for x in by if x) + [None]
        sizes = [sum(r.size for r in by[n]) for n in names]
        want = water(sizes, [(5, 2, 1)[i % 3] for i in range(len(names))], 1.5, 2)
        for name, size, target in zip(names, sizes, want):
            assert {(r.source_size, round(r.target, 6)) for r in by[name]} == {(size, round(target, 6))}
            assert abs(sum(r.taken for r in by[name]) - target) <= 16 * 2
            assert all(0 <= r.taken <= 2 * r.size for r in by[name])
    again = mixing.mix(many.repartition(5), shard_words=9_000, block_words=16).collect()
    assert sorted(again) == sorted(rows)


def test_quotas_follow_the_highest_quotients(spark):
    streams = [(0, 0, 900, 700.0), (0, 1, 500, 260.0), (0, 2, 90, 41.0), (0, 3, 10, 19.0), (1, 0, 5, 3.0), (2, 0, 0, 0.0)]
    df = spark.createDataFrame(streams, "shard int, source_no int, words bigint, ideal double")
    got = {(r.shard, r.source_no): r.blocks for r in mixing.quotas(df, 10, 2).collect()}
    for shard in (0, 1):
        own = [(s, w, i) for h, s, w, i in streams if h == shard]
        claims = sorted((-(i / 10) / (2 * k - 1), s) for s, w, i in own for k in range(1, 2 * w // 10 + 1))
        won = [s for _, s in claims[: round(sum(min(i / 10, 2 * w // 10) for _, w, i in own))]]
        assert {s: won.count(s) for s, _, _ in own} == {s: got[shard, s] for s, _, _ in own}


def test_mixed_documents_repeat_whole_rows(messy):
    mixed = mixing.mixed(messy)
    assert mixed.columns == messy.columns
    want = {}
    for r in mixing.mix(messy).collect():
        times = int(r.taken / r.size + 0.5) if r.size else 0
        want[r.doc_id] = want.get(r.doc_id, 0) + times
    got = dict(map(tuple, mixed.groupBy("doc_id").count().collect()))
    assert got == {k: v for k, v in want.items() if v}


URLS = [
    None, "", "no scheme", "http://", "https://EXAMPLE.com/en/1", "https://www.example.com/en/x?y#z", "http://a.www.example.com/en/",
    "http://example.com/EN/", "http://example.com", "http://notexample.com/en/", "http://x.net/es/1", "http://net/fr/", "http://x.net/es",
    "http://x.net?/es/", "http://x.net/fr/#", "ftp://u@x.net:80/es/", "http://com/", "http://a.com/p", "a://b.net/es/?q=://c.com/", "://net/es/",
    "http://x.network/es/", "http://x.org/en/", "http://X.Net/es/1", "http://example.com/en/1",
]


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    place = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
    slash = rest.find("/") if "/" in rest[:place] else place
    host = rest[:slash].translate({i: i + 32 for i in range(65, 91)})
    path = rest[slash:place]
    fits = [
        (len(h + p), h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


def test_urls(spark):
    rules = spark.createDataFrame(url_filter.RULES, "host string, path string, verdict string")
    rows = [(i, u, "h") for i, u in enumerate(URLS)] + [(4, URLS[4], "h"), (None, URLS[10], "h")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string")
    want = sorted(((i, *brute(u)) for i, u, _ in rows), key=repr)
    assert sorted_rows(url_filter.judge(pages, rules)) == want
    assert url_filter.judge(pages.limit(0), rules).collect() == []
    assert {r.verdict for r in url_filter.judge(pages, rules.limit(0), "block").collect()} == {"block"}


def test_open_rules_and_special_letters(spark):
    rules = spark.createDataFrame(
        [("", "/ads", "block"), ("a+b.com", "/x.y/", "block"), ("a.com", "/pre", "block"), ("org", "", "block")],
        "host string, path string, verdict string",
    )
    urls = ["http://q.de/ads1", "http://a+b.com/x.y/1", "http://aab.com/x.y/1", "http://a+b.com/xzy/1", "http://a.com/prefix", "http://z.org", "http://z.de/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = {r.page_id: r.rule for r in url_filter.judge(pages, rules).collect()}
    assert got == {0: "/ads", 1: "a+b.com/x.y/", 2: None, 3: None, 4: "a.com/pre", 5: "org", 6: None}
