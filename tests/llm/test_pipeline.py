"""The pipeline against the same four steps in plain Python, SQL and the tokenizer library."""

import hashlib
import os
import random
from array import array
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
from samples import prose
from test_similar import brute_near_dup
from tokenizers import Tokenizer

import corpus_pipeline
from payloom.llm import quality
from payloom.llm.answers import ANSWERS


def test_pipeline(spark, tmp_path):
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(260):
        text = prose(rng, rng.randint(0, 90))
        good = rng.random() < 0.7
        rows.append((i, text if good else text.upper().replace(" ", "!! "), "en", f"src{i % 3}" if i % 11 else None, len(text)))
        labels.append((i, int(good), 0))
    rows += [(300 + i, rows[i][1], "en", "src1", 0) for i in range(0, 60, 3)] + [(400, None, None, None, None), (401, "", "en", "src0", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    marked = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    marked.write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, tuple(r.ids)) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())

    weights, features = quality.train(docs, marked), quality.Features()
    kept = []
    for r in rows:
        columns, values = features.row(r[1] or "")
        if 1 / (1 + np.exp(-(weights[columns] @ values + weights[-1]))) >= 0.3:
            kept.append(r)
    assert 100 < len(kept) < len(rows)
    first = {r[0] for r in brute_near_dup([r[:2] for r in kept]) if r[3]}
    documents = pd.DataFrame([r for r in kept if r[0] in first], columns=docs.columns)
    con = duckdb.connect()
    con.register("documents", documents)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts, want = dict(zip(documents["doc_id"], documents["text"])), Counter()
    for r in con.execute(ANSWERS["op3_source_mixing"]).fetchdf().itertuples():
        times = int(r.taken / r.size + 0.5) if r.size else 0
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        sha = [hashlib.sha256(x).hexdigest() for x in (array("I", ids).tobytes(), decoded.encode())]
        want[(r.doc_id, len(ids), *sha, tuple(ids))] += times
    assert got == +want


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_filter", "near_duplicates", "source_mix", "bpe_ids"]
    assert corpus_pipeline.ORACLE_SQL is None and os.path.isfile(corpus_pipeline.__file__)
