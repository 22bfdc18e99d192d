"""Approximate nearest neighbours: a forest of random-projection trees, exactly reranked.

**Fit.**  Rows fall into bands by their norm, each down to 1/sqrt(2) of its longest (the
last of ``BANDS`` holds all that are shorter still), and every band has trees of its own.
They are drawn over a sample in step with the band's rows, ``sample`` vectors over all
bands, but at least ``sample / 16`` for a band that has them (documented bound): each node
splits its sample rows at their median along a random direction.  For the largest inner
product, vectors are lengthened by one component that gives all of a band the same norm,
so the order by inner product is the order by angle.  Without bands one long row would
make that component decide every split.

**Index.**  Every valid row, in the sample or not, falls into one leaf of each tree of its band.

**Search.**  A query, scaled to the norm of the band, walks all trees of each band through
one shared priority queue of nodes, nearest margin first, and takes leaves until they hold
``visit`` times the rows of the band, a row counted once in each tree.  Leaves lie in
bundles; each bundle scores its own queries exactly on the original vectors in double
precision and hands on their best ``k``, so rows grow with the queries, not with pairs.  A
last step drops repeats from different trees and keeps the best ``k``; ties go to the
smaller id.

``visit`` trades work for recall.  It is learnt: a few sample rows ask for their exact
neighbours in the sample, and ``visit`` is the least share that finds ``recall`` of them, at
most ``most_visit``.  Directions without any structure, the hardest case, need leaves of
about 1.3 times all rows over eight trees; clustered data need a small part of them.  A hot
leaf is split over several bundles, and queries are dealt to blocks of ``block`` rows, so a
task holds a bounded part of both.

Invalid vectors take no part: they are neither queries nor candidates.  Every length of
vectors is searched by itself.  Equal rows count once.  With no valid
vectors the result is empty; with fewer than ``k`` others a query gets all it finds.  Only
``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payloom.llm.common import map_batches, ship
from payloom.llm.vectors import direction, matrix, valid_rows
from payloom.session import settle


#: Norm bands at most; the last one starts 2**31.5 below the longest row.
BANDS = 64


class Forest:
    """Trees of equal depth over lengthened vectors; leaves are numbered through all trees."""

    def __init__(self, sample: np.ndarray, longest: float, depth: int, trees: int, seed: int = 5):
        self.depth, self.trees, self.longest = depth, trees, longest
        sample = self.lengthened(sample)
        inner = (1 << depth) - 1
        self.normals = np.array(
            [[direction(seed * 1_000_003 + t * inner + i, sample.shape[1]) for i in range(inner)] for t in range(trees)]
        ).reshape(trees, inner, sample.shape[1])
        self.cuts = np.zeros((trees, inner))
        self.share = np.zeros((trees, 1 << depth))
        for t in range(trees):
            held = {0: np.arange(len(sample))}
            for node in range(inner):
                rows = held.pop(node)
                p = sample[rows] @ self.normals[t, node]
                self.cuts[t, node] = np.median(p) if len(p) else 0.0
                right = p > self.cuts[t, node]
                held[2 * node + 1], held[2 * node + 2] = rows[~right], rows[right]
            for node, rows in held.items():
                self.share[t, node - inner] = len(rows) / max(1, len(sample))

    def lengthened(self, v: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0.0, self.longest**2 - (v * v).sum(axis=1)))
        return np.column_stack([v, rest])

    def leaves(self, v: np.ndarray) -> np.ndarray:
        """Leaf of every row in every tree."""
        v = self.lengthened(v)
        out = np.zeros((len(v), self.trees), np.int64)
        for t in range(self.trees):
            node = np.zeros(len(v), np.int64)
            for _ in range(self.depth):
                p = (v * self.normals[t, node]).sum(axis=1)
                node = 2 * node + 1 + (p > self.cuts[t, node])
            out[:, t] = (t << self.depth) + node - ((1 << self.depth) - 1)
        return out

    def walk(self, query: np.ndarray, most: float) -> Iterator[tuple[int, float]]:
        """Leaves for a query in the order of the shared queue, each with the share of the rows taken before."""
        inner = (1 << self.depth) - 1
        sides = np.append(query, 0.0) @ self.normals.reshape(self.trees * inner, -1).T if inner else np.zeros(0)
        sides = sides.reshape(self.trees, inner) - self.cuts
        queue, held = [(-math.inf, t, 0) for t in range(self.trees)], 0.0
        while queue and held < most:
            margin, t, node = heapq.heappop(queue)
            if node >= inner:
                yield (t << self.depth) + node - inner, held
                held += max(self.share[t, node - inner], 1e-9)
                continue
            side = sides[t, node]
            heapq.heappush(queue, (max(margin, -side), t, 2 * node + 2))
            heapq.heappush(queue, (max(margin, side), t, 2 * node + 1))


class Bands:
    """A forest for each norm band; leaves are numbered through all of them."""

    def __init__(self, forests: dict[int, Forest]):
        self.forests, self.first, n = forests, {}, 0
        for band, forest in forests.items():
            self.first[band] = n
            n += forest.trees << forest.depth

    def leaves(self, v: np.ndarray, band: np.ndarray) -> list[np.ndarray]:
        """Leaves of every row in the trees of its band."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(v)
        for own in np.unique(band).tolist():
            rows = np.flatnonzero(band == own)
            for i, found in zip(rows.tolist(), self.forests[own].leaves(v[rows]) + self.first[own]):
                out[i] = found
        return out

    def walk(self, query: np.ndarray, most: float) -> Iterator[tuple[int, float]]:
        """Leaves for a query in all bands, each with the share of its band taken before."""
        norm = math.sqrt((query * query).sum()) or 1.0
        for band, forest in self.forests.items():
            for leaf, held in forest.walk(query * (forest.longest / norm), most):
                yield self.first[band] + leaf, held

    def near(self, query: np.ndarray, visit: float) -> list[int]:
        return [leaf for leaf, _ in self.walk(query, visit)]

    def learn_visit(self, sample: np.ndarray, band: np.ndarray, k: int, recall: float, most: float, queries: int = 64) -> float:
        """The least share that finds ``recall`` of the exact neighbours of some sample rows."""
        if len(sample) < 2:
            return most
        leaves, needed = self.leaves(sample, band), []
        for i in range(min(queries, len(sample))):
            score = sample @ sample[i]
            score[i] = -np.inf
            nearest = np.argsort(-score, kind="stable")[: min(k, len(sample) - 1)]
            before = dict(self.walk(sample[i], most))
            needed += [min((before.get(leaf, math.inf) for leaf in leaves[j].tolist()), default=math.inf) for j in nearest.tolist()]
        enough = sorted(needed)[math.ceil(recall * len(needed)) - 1]
        return min(most, enough + 1e-6)


def top(ids: np.ndarray, v: np.ndarray, query_id: int, query: np.ndarray, rough: np.ndarray, k: int):
    """Exact best ``k`` of a leaf for one query; ``rough`` scores may differ in their last digits."""
    rough = np.where(ids == query_id, -np.inf, rough)
    if len(ids) > k:
        least = np.partition(rough, len(rough) - k)[len(rough) - k]
        rows = np.flatnonzero(rough >= least - 1e-9 * max(1.0, abs(least)))
    else:
        rows = np.arange(len(ids))
    rows = rows[ids[rows] != query_id]
    score = (v[rows] * query).sum(axis=1)
    order = np.lexsort((ids[rows], -score))[:k]
    return ids[rows][order], score[order]


def search(
    vectors: DataFrame,
    is_query: Callable[[Column], Column],
    k: int = 20,
    sample: int = 16_384,
    trees: int = 8,
    leaf_rows: int = 4096,
    least_depth: int = 5,
    recall: float = 0.965,
    most_visit: float = 1.5,
    bundle_rows: int = 100_000,
    block: int = 4096,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for every valid row whose id ``is_query`` selects."""
    spark = vectors.sparkSession
    ship(spark)
    rows = valid_rows(vectors, "vec_id", "embedding").distinct()
    rows = settle(rows.withColumn("d", F.size("v")), "search-vectors")
    # one row for each length of vectors, of which a table has few
    lengths = rows.groupBy("d").agg(F.count("*").alias("n"), F.count_if(is_query(F.col("id"))).alias("asking")).orderBy("d").collect()
    found = [
        _search_length(rows, is_query, x.d, x.n, x.asking, k, sample, trees, leaf_rows, least_depth, recall, most_visit, bundle_rows, block)
        for x in lengths if x.asking
    ]
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.union, found)


def _search_length(
    rows: DataFrame, is_query, d: int, n: int, asking: int, k: int, sample: int, trees: int, leaf_rows: int,
    least_depth: int, recall: float, most_visit: float, bundle_rows: int, block: int,
) -> DataFrame:
    spark = rows.sparkSession
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    rows = rows.where(F.col("d") == d).select("id", "v", length.alias("length"))
    longest = rows.agg(F.max("length")).first()[0]
    below = F.when(F.col("length") > 0, 2 * F.log2(F.lit(longest) / F.col("length"))).otherwise(float(BANDS))
    rows = rows.select("id", "v", "length", F.floor(F.least(below, F.lit(BANDS - 1.0))).cast("int").alias("band"))
    bands = rows.groupBy("band").agg(F.count("*").alias("n"), F.max("length").alias("longest")).orderBy("band").collect()
    drawing, most = [0] * BANDS, 0
    for b in bands:
        own = max(sample * b.n // n, sample // 16)
        drawing[b.band], most = int(min(1.0, 0.95 * own / b.n) * (1 << 30)) + 1, most + own
    chance = F.element_at(F.array(*map(F.lit, drawing)), F.col("band") + 1)
    drawn = rows.where(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 30)) < chance)
    drawn = drawn.select("band", "v").limit(most).toArrow().combine_chunks()
    fitted, of = matrix(drawn.column(1)), drawn.column(0).to_numpy()
    forests = {}
    for b in bands:
        own = fitted[of == b.band] if len(of) else fitted
        own = own if own.size else np.zeros((1, d))
        depth = max(least_depth, math.ceil(math.log2(max(1.0, b.n / leaf_rows))))
        depth = min(depth, int(math.log2(max(1.0, b.n / (2 * k)))))  # few rows: leaves of some k rows at least
        forests[b.band] = Forest(own, b.longest, depth, trees if depth else 1)
    fitted_bands = Bands(forests)
    visit = fitted_bands.learn_visit(fitted, of, k, recall, most_visit)
    forest = spark.sparkContext.broadcast(fitted_bands)
    blocks = math.ceil(asking / block)
    bundles = max(16, math.ceil(n * trees / bundle_rows))

    def index(batches):
        for batch in batches:
            if batch.num_rows:
                leaves = forest.value.leaves(matrix(batch.column(1)), batch.column(2).to_numpy())
                lists = pa.array(leaves, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["id", "v", "leaves"])

    def walk(batches):
        for batch in batches:
            if batch.num_rows:
                found = [forest.value.near(q, visit) for q in matrix(batch.column(1))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64()))], names=["id", "v", "leaves"]
                )

    indexed = map_batches(rows.select("id", "v", "band"), index, "id long, v array<double>, leaves array<long>")
    indexed = indexed.select("id", "v", F.explode("leaves").alias("leaf"))
    # the share of a leaf that one bundle may hold: larger leaves are dealt over several bundles
    sizes = indexed.groupBy("leaf").agg(F.count("*").alias("n"))
    pieces = sizes.select("leaf", F.ceil(F.col("n") / (bundle_rows / 4)).cast("int").alias("pieces"))

    def bundle(leaf: Column, piece: Column) -> Column:
        return F.pmod(F.xxhash64(leaf, piece), F.lit(bundles))

    dealt = indexed.join(pieces, "leaf").withColumn("piece", F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int"))
    dealt = dealt.select(
        bundle(F.col("leaf"), F.col("piece")).alias("bundle"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        "leaf", "id", "v",
    )
    walked = map_batches(
        rows.where(is_query(F.col("id"))).repartition(spark.sparkContext.defaultParallelism, "id"),
        walk, "id long, v array<double>, leaves array<long>",
    )
    walked = walked.select("id", "v", F.explode("leaves").alias("leaf")).join(pieces, "leaf")
    walked = walked.select("id", "v", "leaf", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"))
    own_block = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(blocks)).cast("int").alias("block")
    walked = walked.select(bundle(F.col("leaf"), F.col("piece")).alias("bundle"), own_block, "leaf", "id", "v").distinct()

    def rerank(members: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        asked = dict(tuple(queries.groupby("leaf")))
        for leaf, group in members.groupby("leaf"):
            if leaf not in asked:
                continue
            ids, v = group["id"].to_numpy(), np.stack(group["v"].to_numpy())
            own = asked[leaf]
            q = np.stack(own["v"].to_numpy())
            for i, query_id in enumerate(own["id"].to_numpy()):
                if i % 256 == 0:
                    rough = q[i : i + 256] @ v.T
                found, score = top(ids, v, query_id, q[i], rough[i % 256], k)
                if query_id in best:
                    found, at = np.unique(np.concatenate([best[query_id][0], found]), return_index=True)
                    score = np.concatenate([best[query_id][1], score])[at]
                    order = np.lexsort((found, -score))[:k]
                    found, score = found[order], score[order]
                best[query_id] = (found, score)
        if not best:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return pd.DataFrame(
            {
                "query_id": np.repeat(list(best), [len(x[0]) for x in best.values()]),
                "vec_id": np.concatenate([x[0] for x in best.values()]),
                "score": np.concatenate([x[1] for x in best.values()]),
            }
        )

    found = dealt.groupBy("bundle", "block").cogroup(walked.groupBy("bundle", "block")).applyInPandas(rerank, "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)

