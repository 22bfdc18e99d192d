"""The mix of whole documents over many shards."""

import random

import pytest

from payloom.llm import mixing


@pytest.mark.parametrize("long, short", [(900, 20), (400, 15)])
def test_whole_documents_add_up_to_the_targets(spark, long, short):
    # about one document of a source in a shard, and a rare source of texts under half a block
    rng = random.Random(long)
    rows = [(i, "w " * rng.randint(long // 2, long), f"s{i % 8}") for i in range(320)]
    rows += [(1000 + i, "w " * short, "t") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    targets = {r.source: r.target for r in mixing.mix(docs).join(docs.select("doc_id", "source"), "doc_id").collect()}
    got = dict.fromkeys(targets, 0)
    for r in mixing.mixed(docs, shard_words=8 * long).collect():
        got[r.source] += r.text.count("w")
    assert {s for s in targets if abs(got[s] - targets[s]) > 2 * 64 + long / 2} == set() and got["t"] > 60 * short
    # the mix in blocks comes as near, and takes no document more than twice
    rows = mixing.mix(docs, shard_words=8 * long).join(docs.select("doc_id", "source"), "doc_id").collect()
    blocks = dict.fromkeys(targets, 0)
    for r in rows:
        blocks[r.source] += r.taken
    assert {s for s in targets if abs(blocks[s] - targets[s]) > 2 * 64} == set()
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
