"""LM scoring: context-tree weighting over byte contexts, each byte split into eight bits.

**Model.**  A text is its lower-cased (A-Z) UTF-8 bytes and an end mark.  The context of a
byte is the ``depth`` bytes before it.  Every bit of a byte has a context tree of its own; a
node holds how often the bit was 0 and 1 there, a Krichevsky-Trofimov estimate of these
counts, and the weight of stopping at this depth against its children:
``Pw = (KT + product of children's Pw) / 2``.  The probability of a bit mixes the estimates
of all depths by these weights.  A context that training never met defers to the one above
it, so every byte has a positive probability.  ``code_length`` gives bits per byte.

**How it scales.**  A gram is a context and its byte, packed into one number.

1. Documents fall into blocks of about ``BLOCK`` bytes by a hash of their row.  Each block
   gives its distinct grams and words (by a 64-bit hash) with their training counts.
2. Counts are summed over all blocks.  Trees below two context bytes never share a node, so
   they are fitted apart in buckets of gram rows; only the two top levels (at most
   256 x 256 nodes) meet on the driver.
3. Each block meets the values of its own grams and words again, and its texts are summed.

So the model may outgrow any one machine: a task holds one block and its own grams, nothing
is broadcast but the two top levels, and no key is hot, as a block sends each gram once.

Null texts score like empty ones: the end mark alone.  Texts are read whole, repeated rows
and ids stay rows of their own, and with no training rows at all every bit has probability
1/2.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payloom.llm.common import BATCH_BYTES, fold, ship
from payloom.session import settle

DEPTH = 5
#: Bytes of text in a block, bytes handled at once inside it, gram rows of a bucket.
BLOCK, STEP, BUCKET = 24 << 20, 1 << 20, 50_000
_LOG10 = math.log(10)


# -- grams and words -----------------------------------------------------------------


def lowered(text: str | None) -> bytes:
    return (text or "").encode().lower()


def steps(texts: list[str | None]) -> Iterator[slice]:
    """Runs of texts of about ``STEP`` bytes."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= STEP or i == len(texts) - 1:
            yield slice(start, i + 1)
            start, size = i + 1, 0


def packed(row: np.ndarray, width: int) -> np.ndarray:
    """Every run of ``width`` bytes as one number, the last byte lowest."""
    if width == 1:
        return row.astype(np.int64)
    half = width // 2
    left = packed(row, half)
    right = left if width == 2 * half else packed(row, width - half)
    return (left[: len(row) - width + 1] << (8 * (width - half))) | right[half : half + len(row) - width + 1]


def grams_of(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Gram of every byte and end mark (nearest context byte next to the byte), and where texts start."""
    row = np.frombuffer(b"".join(b"\0" * depth + t + b"\xff" for t in texts), np.uint8)
    lengths = np.array([len(t) + 1 for t in texts])
    starts = np.cumsum(lengths) - lengths
    keep = np.ones(len(row), bool)
    padding = starts + depth * np.arange(len(texts))
    for k in range(depth):
        keep[padding + k] = False
    return packed(row, depth + 1)[keep[depth:]], starts


def word_key(word: bytes) -> int:
    """A negative key, as grams are not negative: 63 bits of the word's hash."""
    return -1 - (xxhash.xxh3_64_intdigest(word) >> 1)


def lgamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for positive numbers (Stirling's series above 8)."""
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        low = y < 8
        shift -= np.where(low, np.log(y), 0.0)
        y = np.where(low, y + 1, y)
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return shift + (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the block probability of so many zeros and ones."""
    return lgamma(zeros + 0.5) + lgamma(ones + 0.5) - lgamma(zeros + ones + 1.0) - math.log(math.pi)


class Level:
    """All bit nodes at one context depth: which node each gram visits for each bit, and its counts."""

    def __init__(self, contexts: np.ndarray, symbols: np.ndarray, counts: np.ndarray):
        keys, bits = [], []
        for level in range(8):
            prefix = (1 << level) | (symbols >> (8 - level))
            keys.append((contexts << 8) | prefix)
            bits.append((symbols >> (7 - level)) & 1)
        self.keys, at = np.unique(np.concatenate(keys), return_inverse=True)
        self.at = at.reshape(8, -1).astype(np.int32)
        self.bits = np.array(bits, bool)
        weight = np.tile(counts, 8).astype(float)
        flat = self.bits.ravel()
        self.ones = np.bincount(at, weight * flat, len(self.keys))
        self.zeros = np.bincount(at, weight * ~flat, len(self.keys))
        self.kt = log_kt(self.zeros, self.ones)
        self.seen = self.zeros + self.ones > 0
        self.one = (self.ones + 0.5) / (self.zeros + self.ones + 1.0)

    def weigh(self, children: np.ndarray | None) -> None:
        """``pw`` and the weight of stopping here, from the summed log weights of the children."""
        if children is None:
            self.pw, self.stop = self.kt, np.ones(len(self.keys))
            return
        both = np.logaddexp(self.kt, children)
        self.pw, self.stop = both - math.log(2), np.exp(self.kt - both)


def subtree(grams: np.ndarray, counts: np.ndarray, depth: int) -> list[Level]:
    """Levels ``2 .. depth`` of the trees below two context bytes, weighed from the leaves up."""
    symbols = grams & 255
    levels = [Level((grams >> 8) & ((1 << (8 * d)) - 1), symbols, counts) for d in range(2, depth + 1)]
    below = None
    for level in reversed(levels):
        children = None
        if below is not None:
            parent = np.empty(len(below.keys), np.int64)
            parent[below.at] = level.at
            children = np.bincount(parent, below.pw, len(level.keys))
        level.weigh(children)
        below = level
    return levels


def descend(level: Level, carried: np.ndarray, left: np.ndarray, best: np.ndarray):
    """Mix one depth into ``carried``; ``left`` is the weight that goes deeper."""
    stop, one, seen = level.stop[level.at], level.one[level.at], level.seen[level.at]
    best = np.where(seen, one, best)
    return carried + left * stop * best, left * (1 - stop), best


class Top:
    """The two top levels of all trees, dense over the nearest context byte and the node."""

    def __init__(self, counts: np.ndarray, children: np.ndarray):
        """``counts[context byte, byte]``; ``children[context byte, node]`` from depth two."""
        zeros, ones = np.zeros((256, 256)), np.zeros((256, 256))
        symbols = np.arange(256)
        for level in range(8):
            prefix, bit = (1 << level) | (symbols >> (8 - level)), (symbols >> (7 - level)) & 1
            for side, into in ((0, zeros), (1, ones)):
                for s in symbols[bit == side]:
                    into[:, prefix[s]] += counts[:, s]
        kt1, kt0 = log_kt(zeros, ones), log_kt(zeros.sum(0), ones.sum(0))
        both1 = np.logaddexp(kt1, children)
        pw1 = both1 - math.log(2)
        both0 = np.logaddexp(kt0, pw1.sum(0))
        stop0, stop1 = np.exp(kt0 - both0), np.exp(kt1 - both1)
        one0 = (ones.sum(0) + 0.5) / (zeros.sum(0) + ones.sum(0) + 1)
        one1 = np.where(zeros + ones > 0, (ones + 0.5) / (zeros + ones + 1), one0)
        self.best = one1
        self.carried = stop0 * one0 + (1 - stop0) * stop1 * one1
        self.left = (1 - stop0) * (1 - stop1)


def log_probs(grams: np.ndarray, counts: np.ndarray, top: Top, depth: int) -> np.ndarray:
    """log10 probability of the byte of every gram."""
    levels = subtree(grams, counts, depth)
    symbols, nearest = grams & 255, (grams >> 8) & 255
    nodes = np.array([(1 << k) | (symbols >> (8 - k)) for k in range(8)])
    carried, left, best = (x[nearest, nodes] for x in (top.carried, top.left, top.best))
    for level in levels:
        carried, left, best = descend(level, carried, left, best)
    p = np.where(levels[0].bits, carried, 1 - carried)
    return np.log(p).sum(0) / _LOG10


# -- the distributed fit -------------------------------------------------------------


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sum the counts of equal keys."""
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)


def block_counts(depth: int):
    """Distinct grams and words of a block with their counts in training texts."""

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        found = []
        for learn in (True, False):
            own = frame.loc[frame["held"] != learn, "text"].tolist()
            for part in steps(own):
                texts = [lowered(t) for t in own[part]]
                found.append(np.unique(grams_of(texts, depth)[0], return_counts=True))
                words = Counter(b" ".join(texts).split())
                found.append((np.fromiter(map(word_key, words), np.int64, len(words)), np.fromiter(words.values(), np.int64, len(words))))
                if not learn:
                    found[-2:] = [(k, 0 * n) for k, n in found[-2:]]
                if len(found) > 8:
                    found = [merged(found)]
        keys, counts = merged(found)
        return pd.DataFrame({"block": frame["block"].iloc[0], "key": keys, "n": counts})

    return work


def fit(grams: DataFrame, depth: int) -> DataFrame:
    """``(key, value)``: log10 probability of the byte of every gram of ``grams(key, n)``."""
    spark = grams.sparkSession
    rows = grams.count()
    buckets = max(1, -(-rows // BUCKET))
    context2 = F.shiftright("key", 8).bitwiseAND(F.lit(65535))
    grams = grams.select("key", "n", F.pmod(F.xxhash64(context2), F.lit(buckets)).alias("bucket"))

    def below(frame: pd.DataFrame) -> pd.DataFrame:
        first = subtree(frame["key"].to_numpy(), frame["n"].to_numpy(), depth)[0]
        distinct, at = np.unique(first.keys & 0xFFFF, return_inverse=True)
        return pd.DataFrame({"key": distinct, "pw": np.bincount(at, first.pw, len(distinct))})

    # both tables have at most 256 x 256 rows
    sums = grams.groupBy("bucket").applyInPandas(below, "key long, pw double").groupBy("key").agg(F.sum("pw").alias("pw"))
    pairs = grams.groupBy(F.col("key").bitwiseAND(F.lit(65535)).alias("key")).agg(F.sum("n").alias("n"))
    children, counts = np.zeros(65536), np.zeros(65536)
    for r in sums.collect():
        children[r.key] = r.pw
    for r in pairs.collect():
        counts[r.key] = r.n
    top = spark.sparkContext.broadcast(Top(counts.reshape(256, 256), children.reshape(256, 256)))

    def scored(frame: pd.DataFrame) -> pd.DataFrame:
        key = frame["key"].to_numpy()
        return pd.DataFrame({"key": key, "value": log_probs(key, frame["n"].to_numpy(), top.value, depth)})

    return grams.groupBy("bucket").applyInPandas(scored, "key long, value double")


class Numbers(dict):
    """Numbers words in the order they are first met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def block_scores(depth: int, n_docs: int, total: int, distinct: int):
    """Sums of a block's texts from the values of its grams and words."""
    spread = total + 0.1 * (distinct + 1)
    end = math.log10((n_docs + 0.1) / spread)

    def work(frame: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(known["key"].to_numpy())
        keys, values = known["key"].to_numpy()[order], known["value"].to_numpy()[order]
        texts = frame["text"].tolist()
        score, sizes, n_tokens, n_known, base = [], [], [], [], []
        for part in steps(texts):
            low = [lowered(t) for t in texts[part]]
            found, starts = grams_of(low, depth)
            score.append(np.add.reduceat(values[np.searchsorted(keys, found)], starts))
            numbers = Numbers()
            rows = [np.fromiter(map(numbers.__getitem__, w), np.int32, len(w)) for w in map(bytes.split, low)]
            hashed = np.fromiter(map(word_key, numbers), np.int64, len(numbers))
            counts = values[np.searchsorted(keys, hashed)] if len(hashed) else np.zeros(0)
            logs = np.log10((counts + 0.1) / spread)
            sizes += map(len, low)
            n_tokens += [len(r) + 1 for r in rows]
            n_known += [int((counts[r] > 0).sum()) + (n_docs > 0) for r in rows]
            base += [float(logs[r].sum()) + end for r in rows]
        return pd.DataFrame(
            {
                "doc_id": frame["doc_id"].to_numpy(),
                "held_out": frame["held"].to_numpy(),
                "n_tokens": n_tokens,
                "n_known": n_known,
                "train_tokens": total,
                "base_score": base,
                "score": np.concatenate(score) if score else [],
                "n_bytes": sizes,
            }
        )

    return work


def score(docs: DataFrame, depth: int = DEPTH, folds: int = 10, hold: int = 0) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes)``, a row per row."""
    ship(docs.sparkSession)
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    kind = dict(docs.dtypes)["doc_id"]
    held = fold(F.col("doc_id"), folds) == hold
    size = docs.agg(
        F.sum(F.octet_length("text")).alias("size"), F.sum(F.when(held, 0).otherwise(1)).alias("train")
    ).first()
    blocks, n_docs = max(1, -(-(size.size or 0) // BLOCK)), size.train or 0
    # ids travel as text, as pandas would turn whole numbers with nulls into floats
    placed = docs.select(
        F.col("doc_id").cast("string").alias("doc_id"),
        "text",
        held.alias("held"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).alias("block"),
    )
    parts = settle(
        placed.groupBy("block").applyInPandas(block_counts(depth), "block long, key long, n long"), "lm-parts"
    )
    totals = settle(parts.groupBy("key").agg(F.sum("n").alias("n")), "lm-totals")
    words = totals.where("key < 0")
    known = words.where("n > 0").agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    total, distinct = (known.n or 0) + n_docs, known.v + (n_docs > 0)
    values = fit(totals.where("key >= 0"), depth).union(words.select("key", F.col("n").cast("double")))
    wanted = parts.select("block", "key").join(values, "key").select("block", "key", "value")
    schema = (
        "doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double, n_bytes long"
    )
    return (
        placed.groupBy("block")
        .cogroup(wanted.groupBy("block"))
        .applyInPandas(block_scores(depth, n_docs, total, distinct), schema)
        .withColumn("doc_id", F.col("doc_id").cast(kind))
    )


def code_length(scores: DataFrame) -> DataFrame:
    """Adds ``bits_per_byte``, the code length of a text and its end by the model."""
    bits = -F.col("score") / math.log10(2) / (F.col("n_bytes") + 1)
    return scores.withColumn("bits_per_byte", bits)
