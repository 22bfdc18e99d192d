"""Quality classifier: hashed word n-grams, logistic regression by FTRL, sparse dot products.

Features of a text are its words and its runs of other characters, in the case they stand
in, and the pairs of neighbours; a word that repeats its neighbour gives a pair of its own
kind.  Each is hashed into ``2 ** bits`` columns and counted; the counts are damped and the
row is scaled to length one, so long and short texts weigh alike.

Training takes a bounded sample of labelled rows: at most ``sample`` of them (documented
bound; all rows if there are fewer), chosen by a hash of the id.  Parts of the sample run
follow-the-regularised-leader updates row by row and their states are averaged after each
of ``rounds`` passes.  The weights have a fixed size and go to every task.

Scoring reads every whole text.  Null and empty texts have no feature and score by the bias
alone.  Without labels of both kinds every score is the share of label 1, or 0.5.  Rows
with null labels or ids that meet no document are no training rows.  Repeated rows score
alike; labels, language, source and id never enter a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payloom.llm.common import fold, map_batches
from payloom.session import settle

BITS = 18
REMEMBERED, SHORT = 200_000, 64
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Features:
    def __init__(self, bits: int = BITS):
        self.shift = np.uint64(64 - bits)
        self.cut = regex.compile(r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+").findall
        self.known: dict[str, tuple[int, ...]] = {}

    def tokens(self, text: str) -> np.ndarray:
        """64-bit hashes of the words and runs of other characters."""
        known, out = self.known, []
        for word in text.split():
            found = known.get(word)
            if found is None:
                found = tuple(xxhash.xxh3_64_intdigest(t) for t in self.cut(word))
                if len(known) >= REMEMBERED:
                    known.clear()
                if len(word) <= SHORT:
                    known[word] = found
            out += found
        return np.array(out, np.uint64)

    def row(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Column numbers and values of one text."""
        h = self.tokens(text)
        if not len(h):
            return np.zeros(0, np.int64), np.zeros(0)
        same = h[1:] == h[:-1]
        pairs = np.where(same, _MIX, (h[:-1] * _MIX + h[1:]) * _MIX)
        columns, counts = np.unique(np.concatenate([h * _MIX, pairs]) >> self.shift, return_counts=True)
        values = np.sqrt(counts)
        return columns.astype(np.int64), values / np.sqrt((values * values).sum())


class Ftrl:
    """Per-coordinate follow-the-regularised-leader state with a bias in the last column."""

    def __init__(self, bits: int, alpha: float, l1: float, l2: float):
        self.alpha, self.l1, self.l2, self.beta = alpha, l1, l2, 1.0
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def weights(self, columns=slice(None)) -> np.ndarray:
        z, n = self.z[columns], self.n[columns]
        pulled = (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, pulled)

    def learn(self, columns: np.ndarray, values: np.ndarray, label: int) -> None:
        columns, values = np.append(columns, len(self.z) - 1), np.append(values, 1.0)
        w = self.weights(columns)
        p = 1 / (1 + np.exp(-np.clip(w @ values, -35, 35)))
        g = (p - label) * values
        n = self.n[columns]
        self.z[columns] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[columns] = n + g * g


def chosen(docs: DataFrame, labels: DataFrame, sample: int, folds: int, hold: int) -> DataFrame:
    """``(h, label, text)``: at most ``sample`` labelled training rows, by a hash of the id."""
    marked = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).where(fold(F.col("doc_id"), folds) != hold)
    marked = marked.groupBy("doc_id").agg(F.max("quality").alias("label"))
    h = F.xxhash64("doc_id", F.lit(11))
    total = marked.count()
    if total > sample:
        marked = marked.where(F.pmod(h, F.lit(1 << 20)) < int(0.97 * sample / total * (1 << 20)))
    rows = marked.limit(sample)
    return docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id").select(h.alias("h"), "label", "text")


def train(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = 12_000,
    parts: int = 4,
    rounds: int = 3,
    bits: int = BITS,
    alpha: float = 4.0,
    l1: float = 0.005,
    l2: float = 0.01,
    folds: int = 5,
    hold: int = 0,
) -> np.ndarray:
    """Weights of all columns, the bias last; ``fold(doc_id)`` equal to ``hold`` is left out."""
    spark = docs.sparkSession

    def featurise(batches):
        features = Features(bits)
        for batch in batches:
            h, y, texts = (c.to_pylist() for c in batch.columns)
            rows = [features.row(t or "") for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(h, pa.int64()), pa.array(y, pa.int32()),
                    pa.array([c.astype(np.int32).tobytes() for c, _ in rows], pa.binary()),
                    pa.array([v.astype(np.float32).tobytes() for _, v in rows], pa.binary()),
                ],
                names=["h", "label", "columns", "weights"],
            )

    picked = chosen(docs, labels, sample, folds, hold)
    picked = settle(
        map_batches(picked.withColumn("label", F.col("label").cast("int")), featurise, "h long, label int, columns binary, weights binary"),
        "quality-sample",
    )
    counts = picked.agg(F.count("*").alias("n"), F.sum("label").alias("good")).first()
    if not counts.n or counts.good in (0, counts.n):
        even = np.zeros((1 << bits) + 1)
        even[-1] = 0.0 if not counts.n else np.log((counts.good + 0.5) / (counts.n - counts.good + 0.5))
        return even
    dealt = picked.repartition(parts, F.pmod("h", F.lit(parts))).sortWithinPartitions("h")
    state = None
    for _ in range(rounds):
        begin = spark.sparkContext.broadcast(state)

        def learn(batches: Iterator[pa.RecordBatch]):
            model = Ftrl(bits, alpha, l1, l2)
            if begin.value is not None:
                model.z, model.n = (x.copy() for x in begin.value)
            seen = 0
            for batch in batches:
                for _, y, c, v in zip(*(x.to_pylist() for x in batch.columns)):
                    model.learn(np.frombuffer(c, np.int32), np.frombuffer(v, np.float32).astype(np.float64), y)
                    seen += 1
            if seen:
                yield pa.RecordBatch.from_pydict({"seen": [seen], "z": [model.z.tobytes()], "n": [model.n.tobytes()]})

        # at most ``parts`` states of fixed size reach the driver
        states = map_batches(dealt, learn, "seen long, z binary, n binary").collect()
        states.sort(key=lambda r: (r.seen, bytes(r.z)))
        total = sum(r.seen for r in states)
        state = tuple(sum(np.frombuffer(r[k]) * (r.seen / total) for r in states) for k in ("z", "n"))
    model = Ftrl(bits, alpha, l1, l2)
    model.z, model.n = state
    return model.weights()


def score(docs: DataFrame, weights: np.ndarray, bits: int = BITS) -> DataFrame:
    """``(doc_id, score)`` for every row, label 1 likelier the higher."""
    kind = dict(docs.dtypes)["doc_id"]
    known = docs.sparkSession.sparkContext.broadcast(weights)

    def work(batches):
        features, w = Features(bits), known.value
        for batch in batches:
            found = []
            for text in batch.column(1).to_pylist():
                columns, values = features.row(text or "")
                found.append(float(1 / (1 + np.exp(-np.clip(w[columns] @ values + w[-1], -35, 35)))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=["doc_id", "score"])

    return map_batches(docs.select("doc_id", "text"), work, f"doc_id {kind}, score double")


def keep(docs: DataFrame, weights: np.ndarray, threshold: float = 0.3, bits: int = BITS) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, with all their columns."""
    known = docs.sparkSession.sparkContext.broadcast(weights)

    def work(batches):
        features, w = Features(bits), known.value
        for batch in batches:
            stays = []
            for text in batch.column(at).to_pylist():
                columns, values = features.row(text or "")
                stays.append(bool(1 / (1 + np.exp(-np.clip(w[columns] @ values + w[-1], -35, 35))) >= threshold))
            yield batch.filter(pa.array(stays, pa.bool_()))

    at = docs.columns.index("text")
    return map_batches(docs, work, docs.schema)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``."""
    scored = score(docs, train(docs, labels, **options))
    held = fold(F.col("doc_id"), options.get("folds", 5)) == options.get("hold", 0)
    return scored.select(
        "doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted")
    )
