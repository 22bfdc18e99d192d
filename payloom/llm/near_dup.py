"""MinHash near-duplicates with sequential Bayesian verification.

A document's set holds its distinct ``words``-word shingles (of words lower-cased in A-Z);
a shorter text is one shingle, a text without words has none and links with nothing.

1. One pass per text gives its set size, a 128-bit digest of the set, ``bands`` band keys
   and one byte for each min-hash.  Documents with equal sets form a class, reduced before
   any comparison; its smallest id stands for it.
2. Classes that share a band key are candidates.  Their signatures are compared a batch of
   hashes at a time; after each batch a pair is dropped when the posterior chance of a
   similarity of at least ``percent`` falls below ``miss``.  Pairs that are linked already
   by others of the same bucket are not compared, and a bucket hands on a spanning star of
   its survivors, so nothing grows with the square of a bucket.
3. Survivors form groups; inside each, links are decided on the full shingle sets.
   ``100 * intersection >= percent * union`` is computed in whole numbers.
4. Components of the links, copies included, give the smallest id that can be reached.

Buckets and groups above a fixed size are cut into parts whose pairs meet in tasks of their
own (`in_pairs_of_parts`): exact for any size, and no task holds an unbounded group.

A pair of exactly the threshold is missed by the bands with a chance of at most 2e-6 (28
bands of 6 at 85 percent, 34 bands of 5 at 80); ``miss`` adds at most that much per batch.  Null and empty texts have size 0 and are
their own component.  A null id takes no part in links: its component is null and it is
kept.  Rows that repeat an id are one node, with the sets of all their texts.  Only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from payloom.llm.common import components, in_pairs_of_parts, map_batches, whole_groups
from payloom.session import settle

#: Chance that the bands miss a pair of exactly the threshold.
MISSED = 2e-6
BATCH = 28
#: Members of a bucket or group part, and rows that a task handles at once.
BUCKET_PART, GROUP_PART, AT_ONCE = 512, 128, 20_000
REMEMBERED = 200_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(32)


class Shingler:
    def __init__(self, words: int):
        self.words, self.known = words, {}

    def hashes(self, text: str | None) -> np.ndarray:
        """Sorted distinct 64-bit hashes of the shingles."""
        row = (text or "").encode().lower().split()
        if not row:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        h = np.empty(len(row), np.uint64)
        for i, w in enumerate(row):
            x = known.get(w)
            if x is None:
                x = xxhash.xxh3_64_intdigest(w)
                if len(w) <= 64:
                    known[w] = x
            h[i] = x
        n = min(self.words, len(row))
        out = np.zeros(len(row) - n + 1, np.uint64)
        for k in range(n):
            out = (out + h[k : k + len(out)]) * _MIX
            out ^= out >> _SHIFT
        if len(row) < self.words:
            out ^= np.uint64((len(row) * int(_MIX)) % (1 << 64))
        return np.unique(out)


@lru_cache(maxsize=4)
def shingler(words: int) -> Shingler:
    return Shingler(words)


def banding(percent: int) -> tuple[int, int]:
    """``(bands, rows)``: rows that about a third of pairs at the threshold agree in, bands for ``MISSED``."""
    same = min(percent, 99) / 100
    rows = min(6, max(1, round(math.log(0.35) / math.log(same))))
    return math.ceil(math.log(MISSED) / math.log1p(-(same**rows))), rows


@lru_cache(maxsize=4)
def permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    drawn = np.random.default_rng(8).integers(0, 1 << 63, (2, n, 1), dtype=np.uint64)
    return drawn[0], drawn[1] * np.uint64(2) + np.uint64(1)


def min_hashes(shingles: np.ndarray, n: int) -> np.ndarray:
    flip, times = permutations(n)
    low = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 2048):
        low = np.minimum(low, ((shingles[None, i : i + 2048] ^ flip) * times).min(axis=1))
    return low


def signatures(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """``(doc_id, n_shingles, digest, bytes, keys)``; the last three are null for empty sets."""
    kind = dict(docs.dtypes)["doc_id"]

    def work(batches):
        shingles = shingler(words)
        number = np.arange(bands, dtype=np.uint64) * _MIX
        for batch in batches:
            sizes, digests, folded, keys = [], [], [], []
            for text in batch.column(1).to_pylist():
                s = shingles.hashes(text)
                sizes.append(len(s))
                if not len(s):
                    digests.append(None), folded.append(None), keys.append(None)
                    continue
                low = min_hashes(s, bands * rows)
                digests.append(xxhash.xxh3_128_digest(s.tobytes()))
                folded.append(((low * _MIX) >> np.uint64(56)).astype(np.uint8).tobytes())
                key = number
                for column in low.reshape(bands, rows).T:
                    key = (key ^ column) * _MIX
                    key = key ^ (key >> _SHIFT)
                keys.append(key.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                    pa.array(folded, pa.binary()), pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "digest", "bytes", "keys"],
            )

    return map_batches(
        docs.select("doc_id", "text"), work,
        f"doc_id {kind}, n_shingles long, digest binary, bytes binary, keys array<long>",
    )


def least_matches(n: int, batch: int, similarity: float, miss: float) -> np.ndarray:
    """For each number of compared hashes, the fewest matches that keep a pair.

    With a uniform prior the chance of a match rate of at least ``c`` after ``m`` matches in
    ``n`` is the chance of at most ``m`` successes in ``n + 1`` draws at ``c``.  One byte
    per hash matches by accident once in 256.
    """
    c = similarity + (1 - similarity) / 256
    least = []
    for seen in range(batch, n + 1, batch):
        total, m = 0.0, -1
        while total < miss:
            m += 1
            total += math.comb(seen + 1, m) * c**m * (1 - c) ** (seen + 1 - m)
        least.append(m)
    return np.array(least)


class Forest:
    """Union-find over the rows of a table, with all labels at hand as an array."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        for x, y in zip(a.tolist(), b.tolist()):
            while root[x] != x:
                x = root[x]
            while root[y] != y:
                y = root[y]
            if x != y:
                root[max(x, y)] = min(x, y)
        while not np.array_equal(root, root[root]):
            root[:] = root[root]


def survivors(group: np.ndarray, part: np.ndarray, across: np.ndarray, sig: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Root row of every row after Bayesian pruning of all pairs inside groups of sorted rows."""
    n = len(group)
    end = np.searchsorted(group, group, side="right")
    forest = Forest(n)
    batch = sig.shape[1] // len(least)
    step, first = 1, np.arange(n)
    while True:
        first = first[first + step < end[first]]
        if not len(first):
            return forest.root
        a, b = first, first + step
        fresh = (forest.root[a] != forest.root[b]) & ~(across[a] & (part[a] == part[b]))
        a, b = a[fresh], b[fresh]
        matches = np.zeros(len(a), np.int32)
        for k, fewest in enumerate(least):
            cut = slice(k * batch, (k + 1) * batch)
            matches = matches + (sig[a, cut] == sig[b, cut]).sum(axis=1)
            alive = matches >= fewest
            a, b, matches = a[alive], b[alive], matches[alive]
        forest.link(a, b)
        step += 1


def candidates(classes: DataFrame, percent: int, miss: float, bands: int, rows: int) -> DataFrame:
    """``(a, b)``: a spanning star of the surviving pairs of every bucket."""
    spark_rows = classes.select("id", F.explode("keys").alias("key"))
    sizes = spark_rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = spark_rows.join(sizes, "key").join(classes.select("id", "bytes"), "id")
    dealt = in_pairs_of_parts(members, F.col("n"), BUCKET_PART, F.col("id"))
    task = F.xxhash64("key", "lo", "hi").alias("task")
    dealt = dealt.select(task, "part", (F.col("lo") < F.col("hi")).alias("across"), "id", "bytes")
    dealt = dealt.repartition("task").sortWithinPartitions("task")
    n = bands * rows
    batch = min((x for x in range(1, n + 1) if n % x == 0), key=lambda x: abs(x - BATCH))

    def work(batches):
        least = least_matches(n, batch, percent / 100, miss)
        for table in whole_groups(batches, AT_ONCE):
            sig = np.frombuffer(b"".join(table.column(4).to_pylist()), np.uint8).reshape(-1, n)
            ids = table.column(3)
            root = survivors(
                table.column(0).to_numpy(), table.column(1).to_numpy(), table.column(2).to_numpy(zero_copy_only=False), sig, least
            )
            linked = np.flatnonzero(root != np.arange(len(root)))
            a, b = (ids.take(pa.array(x)).combine_chunks() for x in (root[linked], linked))
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"])

    return map_batches(dealt, work, "a long, b long")


def exact_links(sets: list[np.ndarray], part: np.ndarray, across: bool, percent: int) -> np.ndarray:
    """Root row of every set after linking all pairs at the threshold."""
    n, forest = len(sets), Forest(len(sets))
    sizes = np.array([len(s) for s in sets])
    inter = np.zeros((n, n), np.float32)
    values, owner = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    fresh = np.append(True, values[1:] != values[:-1])
    column = np.cumsum(fresh) - 1
    shared = np.bincount(column)[column] > 1
    column, owner = column[shared], owner[shared]
    if len(column):
        column = np.cumsum(np.append(0, column[1:] != column[:-1]))
        for start in range(0, column[-1] + 1, 4096):
            at = slice(*np.searchsorted(column, [start, start + 4096]))
            held = np.zeros((n, 4096), np.float32)
            held[owner[at], column[at] - start] = 1
            inter += held @ held.T
    both = inter.astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - both
    linked = np.triu((100 * both >= percent * union) & (sizes > 0)[:, None] & (sizes > 0)[None, :], 1)
    if across:
        linked &= part[:, None] != part[None, :]
    forest.link(*np.nonzero(linked))
    return forest.root


def verified(docs: DataFrame, groups: DataFrame, words: int, percent: int) -> DataFrame:
    """``(a, b)``: a spanning star of the exact links in every candidate group."""
    sizes = groups.groupBy("component").agg(F.count("*").alias("n"))
    texts = docs.select(F.col("doc_id").alias("node"), "text").join(groups.join(sizes, "component"), "node")
    dealt = in_pairs_of_parts(texts, F.col("n"), GROUP_PART, F.col("node"))
    task = F.xxhash64("component", "lo", "hi").alias("task")
    dealt = dealt.select(task, "part", (F.col("lo") < F.col("hi")).alias("across"), F.col("node").cast("long").alias("id"), "text")
    dealt = dealt.repartition("task").sortWithinPartitions("task")

    def work(batches):
        shingles = shingler(words)
        for table in whole_groups(batches, 4 * GROUP_PART):
            task, ids = table.column(0).to_numpy(), table.column(3).to_numpy()
            part, across = table.column(1).to_numpy(), table.column(2).to_numpy(zero_copy_only=False)
            texts = table.column(4)
            starts = np.flatnonzero(np.append(True, task[1:] != task[:-1]))
            a, b = [], []
            for start, end in zip(starts, np.append(starts[1:], len(task))):
                sets = [shingles.hashes(texts[i].as_py()) for i in range(start, end)]
                root = exact_links(sets, part[start:end], bool(across[start]), percent)
                linked = np.flatnonzero(root != np.arange(len(root)))
                a.append(ids[start + root[linked]]), b.append(ids[start + linked])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    return map_batches(dealt, work, "a long, b long")


def deduplicate(
    docs: DataFrame,
    words: int = 5,
    percent: int = 85,
    miss: float = 1e-6,
    bands: int | None = None,
    rows: int | None = None,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs``."""
    bands, rows = bands or banding(percent)[0], rows or banding(percent)[1]
    signed = settle(signatures(docs, words, bands, rows), "signatures")
    full = signed.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = full.groupBy("digest").agg(
        F.min("doc_id").cast("long").alias("id"), F.first("bytes").alias("bytes"), F.first("keys").alias("keys")
    )
    classes = settle(classes, "classes")
    pairs = candidates(classes, percent, miss, bands, rows)
    links = verified(docs, components(pairs), words, percent)
    copies = full.select("doc_id", "digest").join(classes.select("digest", "id"), "digest")
    copies = copies.select(F.col("id").alias("a"), F.col("doc_id").cast("long").alias("b"))
    found = components(links.union(copies.where("a != b")))
    own = F.coalesce("component", F.col("doc_id").cast("long"))
    return signed.join(found, signed["doc_id"] == found["node"], "left").select(
        "doc_id", "n_shingles", own.alias("component_id"),
        F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"),
    )


def distinct_documents(docs: DataFrame, percent: int = 80, **options) -> DataFrame:
    """One document of each group, the one with the smallest id, with all its columns.

    A row is known by its id and text together (as a 64-bit hash), so an id that has several
    texts is several documents, which only their texts can join.  Equal rows are one
    document; rows without an id all stay.
    """
    named = docs.where("doc_id IS NOT NULL")
    key = F.xxhash64("doc_id", "text")
    found = deduplicate(named.select(key.alias("doc_id"), "text"), percent=percent, **options)
    found = found.select(F.col("doc_id").alias("key"), "component_id").distinct()
    ids = named.select(key.alias("key"), "doc_id").distinct()
    firsts = ids.join(found, "key").groupBy("component_id").agg(F.min(F.struct("doc_id", "key")).alias("first"))
    rows = named.select(key.alias("key"), F.struct("*").alias("row"))
    nth = F.row_number().over(Window.partitionBy("key").orderBy("key"))
    one = rows.join(firsts.select("first.key"), "key", "left_semi").withColumn("nth", nth).where("nth = 1")
    return one.select("row.*").union(docs.where("doc_id IS NULL"))
