"""Toxicity: a linear-chain conditional random field that tags offending tokens.

Tokens are runs of word characters or runs of other visible characters.  Every token has
one of two states, clean or toxic.  Its potential is a sum of hashed feature weights: the
word, its first five and last three letters, its shape, and the words before and after.
Transition weights tie neighbours together.  Forward and backward ratios give the marginal
of each token; a text's score is a fitted logistic function of the chance that at least one
of its tokens is toxic, and tokens above one half are returned as offsets.

The field learns from texts with labelled spans (`train`).  Where only documents are
labelled, `weak_spans` labels the tokens: a word is offending if the toxic share of the
texts that hold it is surely above one half, where near copies of a text count about once.
All learning reads at most ``sample`` labelled rows (a documented bound; all rows if there
are fewer), chosen by a hash of the id.  Parts of the sample are learnt side by side with
AdaGrad and averaged after each of ``rounds`` passes.  The weights have a fixed size and go
to every task.

Scoring reads every whole text.  Null and empty texts have no token and get the score of a
text without any toxic token.  Without labels of both kinds every score is the share of
label 1, or 0.5.  Null labels, null ids and ids that meet no document teach nothing; an id
with several labels counts as toxic if one of them does.  Repeated rows score alike, an
empty table gives no row, and only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payloom.llm.common import fold, map_batches
from payloom.session import settle

BITS = 16
#: Characters that are tagged in one go, and words whose features a task remembers.
SLICE, REMEMBERED = 1_000_000, 200_000
#: Standard errors by which the toxic share of an offending word lies above one half.
SURE = 2.5
_MIX = np.uint64(0x9E3779B97F4A7C15)
_TOKEN = re.compile(r"\w+|[^\w\s]+")
_CLEAN_START = -4.0
SPAN = "array<struct<start:int,stop:int>>"


@dataclass
class Model:
    """Weights of the hashed features (the bias last), of clean-toxic, toxic-clean and toxic-toxic
    steps, and the logistic function from the log-odds of any toxic token to the score."""

    weights: np.ndarray
    steps: np.ndarray
    slope: float = 0.0
    offset: float = 0.0


def columns_of(word: str, bits: int) -> list[int]:
    """Columns of a word: four for its own place, one each as left and right neighbour."""
    low = word.lower()
    shape = f"{word.isalpha()}{word.isdigit()}{word.isupper()}{word[0].isupper()}"
    names = (f"w={low}", f"p={low[:5]}", f"s={low[-3:]}", f"h={shape}", f"l={low}", f"r={low}")
    return [xxhash.xxh3_64_intdigest(n) >> (64 - bits) for n in names]


class Words:
    """Numbers words as they come and keeps their feature columns."""

    def __init__(self, bits: int):
        self.bits, self.known, self.columns = bits, {}, np.zeros((0, 6), np.int64)

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Word number and text number of every token of ``texts``."""
        words = [_TOKEN.findall(t) for t in texts]
        flat = [w for row in words for w in row]
        if len(self.known) > REMEMBERED:
            self.known, self.columns = {}, np.zeros((0, 6), np.int64)
        new = sorted(set(flat).difference(self.known))
        if new:
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            rows = np.array([columns_of(w, self.bits) for w in new], np.int64)
            self.columns = np.concatenate([self.columns, rows])
        codes = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        return codes, np.repeat(np.arange(len(texts)), [len(row) for row in words])


def potentials(columns: np.ndarray, codes: np.ndarray, first: np.ndarray, last: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Log-potential of the toxic state of each token (that of the clean state is 0)."""
    own = weights[columns[:, :4]].sum(axis=1) + weights[-1]
    before, after = weights[columns[:, 4]], weights[columns[:, 5]]
    e = own[codes]
    e[1:] += np.where(first[1:], 0.0, before[codes[:-1]])
    e[:-1] += np.where(last[:-1], 0.0, after[codes[1:]])
    return np.clip(e, -30, 30)


def ratios(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """``x[t] = (a x[t-1] + b) / (c x[t-1] + d)`` for a whole row of tokens.

    The row is cut into pieces that are run side by side: the maps of a piece are composed,
    the pieces' first values follow one another, and then all pieces are filled in.
    """
    n = len(a)
    size = max(1, int(np.sqrt(n)))
    pieces = -(-n // size)
    padded = []
    for values, rest in ((a, 1.0), (b, 0.0), (c, 0.0), (d, 1.0)):
        row = np.full(pieces * size, rest)
        row[:n] = values
        padded.append(np.ascontiguousarray(row.reshape(pieces, size).T))
    a, b, c, d = padded
    p, q, r, s = np.ones(pieces), np.zeros(pieces), np.zeros(pieces), np.ones(pieces)
    for k in range(size):
        p, q, r, s = a[k] * p + b[k] * r, a[k] * q + b[k] * s, c[k] * p + d[k] * r, c[k] * q + d[k] * s
        top = np.maximum(np.maximum(p, q), np.maximum(r, s))
        p, q, r, s = p / top, q / top, r / top, s / top
    begin, x = np.empty(pieces), 0.0
    for i, (pi, qi, ri, si) in enumerate(zip(p.tolist(), q.tolist(), r.tolist(), s.tolist())):
        begin[i] = x
        x = (pi * x + qi) / (ri * x + si)
    out, x = np.empty((size, pieces)), begin
    for k in range(size):
        x = (a[k] * x + b[k]) / (c[k] * x + d[k])
        out[k] = x
    return out.T.reshape(-1)[:n]


def forward_backward(e: np.ndarray, first: np.ndarray, last: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Toxic odds of each token from the tokens up to it, and those of what follows it."""
    ot, to, tt = np.exp(steps)
    grow = np.exp(e)
    ahead = ratios(np.where(first, 0.0, tt * grow), np.where(first, grow, ot * grow), np.where(first, 0.0, to), np.ones(len(e)))
    following = np.append(grow[1:], 1.0)
    back = ratios(
        *(
            x[::-1]
            for x in (
                np.where(last, 0.0, tt * following), np.where(last, 1.0, to), np.where(last, 0.0, ot * following),
                np.ones(len(e)),
            )
        )
    )[::-1]
    return ahead, back


class Texts:
    """The tokens of a few texts as one row, with the places where texts begin and end."""

    def __init__(self, words: Words, texts: list[str]):
        self.codes, self.text = words.read(texts)
        self.columns, n = words.columns, len(self.codes)
        self.first = np.ones(n, bool)
        self.first[1:] = self.text[1:] != self.text[:-1]
        self.last = np.append(self.first[1:], True) if n else self.first

    def marginals(self, weights: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, ...]:
        """Toxic marginal of each token, with the forward and backward odds and potentials."""
        if not len(self.codes):
            return (np.zeros(0),) * 4
        e = potentials(self.columns, self.codes, self.first, self.last, weights)
        ahead, back = forward_backward(e, self.first, self.last, steps)
        odds = ahead * back
        return odds / (1 + odds), ahead, back, e


def slices(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Some texts at a time: their first index and the texts."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= SLICE or i == len(texts) - 1:
            yield start, texts[start : i + 1]
            start, size = i + 1, 0


def any_toxic(marginal: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Log-odds that at least one token of each of ``n`` texts is toxic."""
    none = np.bincount(text, -np.log1p(-np.minimum(marginal, 1 - 1e-12)), n)
    return np.clip(np.log(np.maximum(np.expm1(np.minimum(none, 50)), 1e-300)), -12, 12)


# -- learning ------------------------------------------------------------------------


def chosen(docs: DataFrame, labels: DataFrame, sample: int, folds: int, hold: int) -> DataFrame:
    """``(h, label, text)``: at most ``sample`` labelled training rows, by a hash of the id."""
    marked = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).where(fold(F.col("doc_id"), folds) != hold)
    marked = marked.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    h = F.xxhash64("doc_id", F.lit(13))
    total = marked.count()
    if total > sample:
        marked = marked.where(F.pmod(h, F.lit(1 << 20)) < int(0.97 * sample / total * (1 << 20)))
    rows = marked.limit(sample)
    text = F.coalesce("text", F.lit("")).alias("text")
    return docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id").select(h.alias("h"), "label", text)


def offending_words(rows: DataFrame, sure: float = SURE) -> set[int]:
    """Hashes of words that mark toxic texts, from ``rows(label, text)``, a bounded sample.

    Texts count by a min-hash of their runs of three words, so near copies count about once.
    The lower end of the interval of a word's toxic share must be above one half.
    """

    def occurrences(batches):
        known: dict[str, int] = {}
        for batch in batches:
            words, marks, toxic = [], [], []
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                row = [w.lower() for w in _TOKEN.findall(text)]
                for w in set(row).difference(known):
                    known[w] = xxhash.xxh3_64_intdigest(w)
                h = np.array([known[w] for w in row], np.uint64)
                if not len(h):
                    continue
                runs = h if len(h) < 3 else (h[:-2] * _MIX + h[1:-1]) * _MIX + h[2:]
                words.append(np.unique(h))
                marks.append(np.full(len(words[-1]), (runs * _MIX).min()))
                toxic.append(np.full(len(words[-1]), label))
                if len(known) > REMEMBERED:
                    known.clear()
            if words:
                columns = [np.concatenate(x).astype(np.uint64).view(np.int64) for x in (words, marks, toxic)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["word", "mark", "toxic"])

    seen = map_batches(rows.select("label", "text"), occurrences, "word long, mark long, toxic long")
    seen = seen.groupBy("word", "mark").agg(F.max("toxic").alias("toxic"))
    counts = seen.groupBy("word").agg(F.sum("toxic").alias("bad"), F.count("*").alias("n"))
    z = sure * sure
    share, n = F.col("bad") / F.col("n"), F.col("n")
    spread = F.sqrt(share * (1 - share) / n + F.lit(z) / (4 * n * n)) * sure
    low = (share + F.lit(z) / (2 * n) - spread) / (1 + F.lit(z) / n)
    # a word needs sure ** 2 texts at least, so there are few of them in a bounded sample
    return {r.word & ((1 << 64) - 1) for r in counts.where(low >= 0.5).select("word").collect()}


def weak_spans(rows: DataFrame, words: set[int]) -> DataFrame:
    """``(h, text, spans)`` from ``(h, label, text)``: offending words of toxic texts."""

    def mark(batches):
        for batch in batches:
            h, labels, texts = (c.to_pylist() for c in batch.columns)
            spans = [
                [
                    {"start": m.start(), "stop": m.end()}
                    for m in _TOKEN.finditer(text)
                    if xxhash.xxh3_64_intdigest(m.group().lower()) in words
                ] if label else []
                for label, text in zip(labels, texts)
            ]
            kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
            yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), batch.column(2), pa.array(spans, kind)], names=["h", "text", "spans"])

    return map_batches(rows.select("h", "label", "text"), mark, f"h long, text string, spans {SPAN}")


def targets_of(row: Texts, texts: list[str], spans: list[list[dict]]) -> np.ndarray:
    """1 for each token that shares a character with a span of its text."""
    goal = np.zeros(len(row.codes))
    starts = np.searchsorted(row.text, np.arange(len(texts)))
    for start, text, marked in zip(starts, texts, spans):
        if not marked:
            continue
        inside = np.zeros(len(text) + 1, bool)
        for s in marked:
            inside[s["start"] : s["stop"]] = True
        for i, m in enumerate(_TOKEN.finditer(text)):
            goal[start + i] = inside[m.start() : m.end()].any()
    return goal


class AdaGrad:
    """Weights and step weights with their sums of squared gradients."""

    def __init__(self, bits: int, rate: float):
        self.rate = rate
        self.w = np.zeros((1 << bits) + 1)
        self.w[-1] = _CLEAN_START
        self.steps = np.zeros(3)
        self.w2, self.steps2 = np.zeros_like(self.w), np.zeros(3)

    def learn(self, texts: Texts, target: np.ndarray, l2: float) -> None:
        """One step along the gradient of the texts' log-likelihood."""
        if not len(texts.codes):
            return
        p, ahead, back, e = texts.marginals(self.w, self.steps)
        miss = p - target
        of = texts.columns[texts.codes]
        inner = ~texts.last[:-1]
        at = np.concatenate([of[:, :4].ravel(), of[:-1, 4][inner], of[1:, 5][inner]])
        by = np.concatenate([np.repeat(miss, 4), miss[1:][inner], miss[:-1][inner]])
        columns, where = np.unique(at, return_inverse=True)
        g = np.bincount(where, by, len(columns)) + l2 * self.w[columns]
        self._step(self.w, self.w2, columns, g)
        self._step(self.w, self.w2, np.array([len(self.w) - 1]), np.array([miss.sum()]))
        # pairs of neighbours: odds of each pair of states against clean-clean
        ot, to, tt = np.exp(self.steps)
        f, b = ahead[:-1][inner], (np.exp(e) * back)[1:][inner]
        odds = np.stack([ot * b, to * f, tt * f * b])
        expected = (odds / (1 + odds.sum(axis=0))).sum(axis=1)
        y, z = target[:-1][inner], target[1:][inner]
        seen = np.array([((1 - y) * z).sum(), (y * (1 - z)).sum(), (y * z).sum()])
        self._step(self.steps, self.steps2, np.arange(3), expected - seen)

    def _step(self, w: np.ndarray, w2: np.ndarray, at: np.ndarray, g: np.ndarray) -> None:
        w2[at] += g * g
        w[at] -= self.rate * g / np.sqrt(w2[at] + 1e-8)


def train(
    sequences: DataFrame, parts: int = 4, rounds: int = 3, bits: int = BITS, rate: float = 0.4, l2: float = 1e-4
) -> Model:
    """The field from ``(h, text, spans)``, a bounded sample that is stored already."""
    context = sequences.sparkSession.sparkContext
    dealt = sequences.repartition(parts, F.pmod("h", F.lit(parts))).sortWithinPartitions("h", "text")
    state = None
    for _ in range(rounds):
        begin = context.broadcast(state)

        def learn(batches: Iterator[pa.RecordBatch]):
            model, words, seen = AdaGrad(bits, rate), Words(bits), 0
            if begin.value is not None:
                model.w, model.w2, model.steps, model.steps2 = (x.copy() for x in begin.value)
            for batch in batches:
                texts, spans = batch.column(1).to_pylist(), batch.column(2).to_pylist()
                for i in range(0, len(texts), 32):
                    some = texts[i : i + 32]
                    row = Texts(words, some)
                    model.learn(row, targets_of(row, some, spans[i : i + 32]), l2)
                    seen += len(some)
            if seen:
                yield pa.RecordBatch.from_pydict(
                    {"seen": [seen], **{k: [getattr(model, k).tobytes()] for k in ("w", "w2", "steps", "steps2")}}
                )

        # at most ``parts`` states of fixed size reach the driver
        states = map_batches(dealt, learn, "seen long, w binary, w2 binary, steps binary, steps2 binary").collect()
        if not states:
            break
        states.sort(key=lambda r: (r.seen, bytes(r.w)))
        total = sum(r.seen for r in states)
        state = tuple(sum(np.frombuffer(r[k]) * (r.seen / total) for r in states) for k in ("w", "w2", "steps", "steps2"))
    if state is None:
        blank = AdaGrad(bits, rate)
        return Model(blank.w, blank.steps)
    return Model(state[0], state[2])


def calibrated(rows: DataFrame, model: Model) -> Model:
    """The model with its logistic function fitted to ``rows(label, text)``, a bounded sample."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        tagger = Tagger(shared.value)
        for batch in batches:
            z = [x for x, _ in tagger.read(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(z, pa.float64())], names=["label", "z"])

    found = map_batches(rows.select(F.col("label").cast("int"), "text"), work, "label int, z double").collect()
    found = sorted((r.z, r.label) for r in found)
    if not found:
        return model
    z, y = (np.array(c, float) for c in zip(*found))
    share = (y.sum() + 0.5) / (len(y) + 1)
    fit = np.array([0.0, np.log(share / (1 - share))])
    if len(np.unique(y)) == 2 and len(np.unique(z)) > 1:
        x = np.stack([z, np.ones(len(z))])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(fit @ x, -35, 35)))
            g = x @ (p - y) + [0.1 * fit[0], 0]
            step = np.linalg.solve((x * (p * (1 - p))) @ x.T + np.diag([0.1, 1e-9]), g)
            fit = fit - np.clip(step, -2, 2)
    return Model(model.weights, model.steps, float(max(fit[0], 0.0)), float(fit[1]))


def learn(docs: DataFrame, labels: DataFrame, sample: int = 8000, folds: int = 5, hold: int = 0, **options) -> Model:
    """The whole way from labelled documents to a calibrated field."""
    rows = settle(chosen(docs, labels, sample, folds, hold), "toxicity-sample")
    counts = rows.agg(F.count("*").alias("n"), F.sum("label").alias("bad")).first()
    bits = options.get("bits", BITS)
    if not counts.n or counts.bad in (0, counts.n):
        share = 0.0 if not counts.n else float(np.log((counts.bad + 0.5) / (counts.n - counts.bad + 0.5)))
        return Model(np.zeros((1 << bits) + 1), np.zeros(3), 0.0, share)
    sequences = settle(weak_spans(rows, offending_words(rows)), "toxicity-spans")
    return calibrated(rows, train(sequences, **options))


# -- scoring -------------------------------------------------------------------------


class Tagger:
    def __init__(self, model: Model):
        self.model = model
        self.words = Words(int(np.log2(len(model.weights) - 1)))

    def read(self, texts: list[str | None]) -> Iterator[tuple[float, np.ndarray]]:
        """Log-odds of any toxic token and the marginals of all tokens, text by text."""
        for _, part in slices([t or "" for t in texts]):
            row = Texts(self.words, part)
            p = row.marginals(self.model.weights, self.model.steps)[0]
            z = any_toxic(p, row.text, len(part))
            ends = np.searchsorted(row.text, np.arange(len(part) + 1))
            for i in range(len(part)):
                yield float(z[i]), p[ends[i] : ends[i + 1]]

    def score(self, z: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.model.slope * z + self.model.offset, -35, 35))))


def spans_of(text: str, marginal: np.ndarray) -> list[dict]:
    """Offsets of the runs of tokens whose toxic marginal is above one half, with the largest marginal."""
    if not len(marginal) or marginal.max() <= 0.5:
        return []
    out, open_run = [], False
    for m, p in zip(_TOKEN.finditer(text), marginal):
        if p <= 0.5:
            open_run = False
        elif open_run:
            out[-1] = {"start": out[-1]["start"], "stop": m.end(), "marginal": max(out[-1]["marginal"], float(p))}
        else:
            out.append({"start": m.start(), "stop": m.end(), "marginal": float(p)})
            open_run = True
    return out


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score, spans)`` for every row; spans are ``(start, stop, marginal)`` in characters."""
    kind = dict(docs.dtypes)["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("marginal", pa.float64())]))

    def work(batches):
        tagger = Tagger(shared.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            scores, spans = [], []
            for text, (z, marginal) in zip(texts, tagger.read(texts)):
                scores.append(tagger.score(z))
                spans.append(spans_of(text or "", marginal))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(spans, span)], names=["doc_id", "score", "spans"]
            )

    spans = "array<struct<start:int,stop:int,marginal:double>>"
    return map_batches(docs.select("doc_id", "text"), work, f"doc_id {kind}, score double, spans {spans}")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """``(doc_id, held_out, score, predicted, spans)``."""
    scored = score(docs, learn(docs, labels, **options))
    held = fold(F.col("doc_id"), options.get("folds", 5)) == options.get("hold", 0)
    return scored.select(
        "doc_id", held.alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"), "spans",
    )
