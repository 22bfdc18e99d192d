"""Hard-negative mining by angular triangle filtering, with exact integer scores.

Components become whole numbers ``floor(scale * x)``; the score of two rows is their integer
inner product.  Every row stores its norm and its angles to a few orthogonal reference
directions, drawn from a seed.  The angle between two rows lies between the difference and
the sum of their angles to any direction, so the references give an interval of the cosine,
and times both norms, widened by more than the rounding, bounds of the score.

1. Rows fall into chunks of one label and nearest reference, cut to about ``chunk`` rows by a
   hash, so a hot label or direction is many chunks.  A chunk keeps its vectors in one packed
   row, with the range of its norms and angles.  Anchors are packed the same way.
2. Positives: each block of anchors meets the chunks of its label; a task keeps each
   anchor's best rows, and the best of all tasks are ranked.
3. Negatives: a positive's score asks for a window of scores.  A block meets a chunk of
   another label only where the bounds of the two ranges overlap a window.  Inside, only
   pairs whose own bounds overlap a window are scored, and the lower end of a window rises
   once enough rows are found.  The best of all tasks are ranked again.

Every block and chunk that can matter meets exactly once, in a task of its own, whatever the
size of the table; the number of such tasks is what grows with it.  No partner is capped:
only rows that cannot be among the first ``negatives`` of a window are left out.

Rows with a null id, null label, null vector, or a null or non-finite component take no
part, nor do vectors with a component whose whole number has more than 24 bits.  Zero vectors
do.  Vectors of different lengths never meet.  Equal rows count once; rows that share an id
are rows of their own, but never partners of each other.  Ties go to the smaller id.  Only
``vec_id``, ``embedding`` and ``label`` are read.  An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payloom.llm.common import map_batches, ship
from payloom.llm.vectors import direction, matrix
from payloom.session import settle

REFERENCES, CHUNK, BLOCK = 8, 8192, 1024
WIDEST = 1 << 24
_LEAST, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
#: Relative and absolute widening of the bounds: single-precision angles and products are
#: off by less than a hundredth of it.
SLACK, WHOLE = 1e-4, 1.0
#: Rows of a chunk that are bounded at a time, and the share of pairs above which a dense product is cheaper.
TILE, DENSE = 512, 0.1


def references(d: int, count: int, seed: int) -> np.ndarray:
    """Orthogonal directions, at most ``d`` of them, as rows."""
    drawn = np.stack([direction(seed * 1_000_003 + d * 1009 + k, d) for k in range(min(count, d))])
    return np.linalg.qr(drawn.T)[0].T


def prepared(vectors: DataFrame, scale: int, count: int, seed: int) -> DataFrame:
    """``(rid, id, label, d, cell, norm, angles, x)``: whole numbers with their stored angles."""
    c = F.col("c")
    fits = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(F.floor(v * scale)) < WIDEST) & (F.abs(v) < 1e300))
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("c"))
    rows = rows.where("id IS NOT NULL AND label IS NOT NULL").where(F.coalesce(fits, F.lit(False)) & (F.size(c) > 0))
    rows = rows.select("id", "label", F.size(c).alias("d"), F.transform(c, lambda v: F.floor(v * scale).cast("int")).alias("x")).distinct()

    def work(batches):
        for batch in batches:
            lengths = batch.column(2).to_numpy()
            for d in np.unique(lengths):
                part = batch.take(pa.array(np.flatnonzero(lengths == d)))
                x = matrix(part.column(3)).astype(np.float64)
                refs = references(int(d), count, seed)
                norm = np.sqrt((x * x).sum(axis=1))
                cosines = (x @ refs.T) / np.where(norm > 0, norm, 1)[:, None]
                angles = np.arccos(np.clip(cosines, -1, 1)).astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[:3], pa.array(angles.argmin(axis=1).astype(np.int32)), pa.array(norm),
                        pa.array(list(angles), pa.list_(pa.float32())), part.column(3),
                    ],
                    names=["id", "label", "d", "cell", "norm", "angles", "x"],
                )

    made = map_batches(rows, work, "id long, label long, d int, cell int, norm double, angles array<float>, x array<int>")
    return made.select(F.xxhash64("id", "label", "x").alias("rid"), "*")


def dealt(rows: DataFrame, most: int, keys: list[str]) -> DataFrame:
    """Adds ``part``, so that no group of ``keys`` and ``part`` has much more than ``most`` rows."""
    sizes = rows.groupBy(*keys).agg(F.ceil(F.count("*") / most).alias("parts"))
    return rows.join(sizes, keys).withColumn("part", F.pmod("rid", "parts").cast("int")).drop("parts")


def packed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each group: ids, norms, angles and whole numbers side by side, with their ranges."""
    kinds = dict(rows.dtypes)
    extra = [c for c in rows.columns if c == "asked"]

    def work(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("id", "ascending"), ("rid", "ascending")])
        angles, norms = matrix(table["angles"]), table["norm"].to_numpy()
        columns = {
            **{k: table[k].slice(0, 1) for k in keys},
            "rids": [table["rid"].to_numpy().tobytes()], "ids": [table["id"].to_numpy().tobytes()],
            "norms": [norms.tobytes()], "angles": [np.ascontiguousarray(angles, np.float32).tobytes()],
            "x": [np.ascontiguousarray(matrix(table["x"]), np.int32).tobytes()],
            "norm_top": [norms.max()], "angle_low": [angles.min(axis=0).astype(float).tolist()],
            "angle_top": [angles.max(axis=0).astype(float).tolist()],
        }
        if extra:
            asked = table["asked"].to_pylist()
            columns |= {"asked": [asked], "lowest": [min(p for row in asked for p in row)]}
        return pa.table(columns)

    schema = ", ".join(f"{k} {kinds[k]}" for k in keys)
    schema += ", rids binary, ids binary, norms binary, angles binary, x binary, norm_top double, angle_low array<double>, angle_top array<double>"
    if extra:
        schema += ", asked array<array<long>>, lowest long"
    return rows.groupBy(*keys).applyInArrow(work, schema)


class Rows:
    """The rows of a packed group."""

    def __init__(self, row: dict, d: int):
        self.rids, self.ids = np.frombuffer(row["rids"], np.int64), np.frombuffer(row["ids"], np.int64)
        self.norms = np.frombuffer(row["norms"])
        self.angles = np.frombuffer(row["angles"], np.float32).reshape(len(self.ids), -1)
        self.x = np.frombuffer(row["x"], np.int32).reshape(-1, d)


def bounds(a: Rows, v: Rows, at: slice) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest possible score of each anchor with the rows ``at``, rounded outward."""
    ca, sa, cv, sv = np.cos(a.angles), np.sin(a.angles), np.cos(v.angles[at]), np.sin(v.angles[at])
    top = low = None
    for k in range(ca.shape[1]):
        along, across = np.outer(ca[:, k], cv[:, k]), np.outer(sa[:, k], sv[:, k])
        # cosines of the difference and of the sum of both angles
        top = along + across if top is None else np.minimum(top, along + across)
        low = along - across if low is None else np.maximum(low, along - across)
    size = np.outer(a.norms, v.norms[at])
    wide = SLACK * size + WHOLE
    return size * low - wide, size * top + wide


def scores(a: Rows, v: Rows, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Integer inner products of the anchors ``i`` with the rows ``j``, pair by pair."""
    out = np.empty(len(i), np.int64)
    if len(i) >= DENSE * len(a.ids) * len(np.unique(j)) and len(i):
        rows, place = np.unique(j, return_inverse=True)
        x, y = a.x.astype(np.float64), v.x[rows].astype(np.float64)
        if a.norms.max() * v.norms[rows].max() < 1 << 52:  # floats hold every sum
            return np.rint((x @ y.T)[i, place]).astype(np.int64)
    for start in range(0, len(i), 65536):
        s = slice(start, start + 65536)
        out[s] = np.einsum("ij,ij->i", a.x[i[s]].astype(np.int64), v.x[j[s]].astype(np.int64))
    return out


class Best:
    """The first few rows of each of some lists: larger scores first, then smaller ids."""

    def __init__(self, lists: int, most: int):
        self.most, self.lists = most, lists
        self.list, self.score, self.id, self.rid = (np.zeros(0, np.int64) for _ in range(4))
        #: Scores below this cannot enter a list any more.
        self.floor = np.full(lists, _LEAST)

    def add(self, lists, score, ids, rids) -> None:
        new = (lists, score, ids, rids)
        kept = [np.concatenate(x) for x in zip((self.list, self.score, self.id, self.rid), new)]
        order = np.lexsort((kept[3], kept[2], -kept[1], kept[0]))
        kept = [x[order] for x in kept]
        first = np.flatnonzero(np.append(True, kept[0][1:] != kept[0][:-1])) if len(order) else order
        place = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
        self.list, self.score, self.id, self.rid = (x[place < self.most] for x in kept)
        full = place == self.most - 1
        self.floor[kept[0][full]] = kept[1][full]


def first_rows(a: Rows, v: Rows, low: np.ndarray, top: np.ndarray, most: int) -> Best:
    """The best rows of ``v`` in each window ``low <= score <= top``, windows x anchors."""
    best = Best(low.size, most)
    windows = np.arange(low.size).reshape(low.shape)
    for start in range(0, len(v.ids), TILE):
        at = slice(start, start + TILE)
        least, largest = bounds(a, v, at)
        floor = np.maximum(low, best.floor.reshape(low.shape))
        needed = np.where(floor <= top, floor, _MOST).min(axis=0)
        hit = (largest >= needed[:, None]) & (least <= top.max(axis=0)[:, None])
        hit &= a.ids[:, None] != v.ids[None, at]
        i, j = np.nonzero(hit)
        if not len(i):
            continue
        s = scores(a, v, i, j + start)
        for w in range(len(low)):
            inside = (s >= floor[w][i]) & (s <= top[w][i])
            p, q = i[inside], j[inside] + start
            best.add(windows[w][p], s[inside], v.ids[q], v.rids[q])
    return best


def met(anchors: DataFrame, chunks: DataFrame, same_label: bool) -> DataFrame:
    """Blocks of anchors beside the chunks that they have to meet, one row for each pair.

    Routes are found on the ranges alone; vectors follow over the unique key of a route, so
    every meeting can go to a task of its own.
    """
    block = anchors.select("d", F.col("label").alias("a_label"), F.col("part").alias("a_part"), *(c for c in anchors.columns if c not in ("d", "label", "part")))
    block = block.withColumnsRenamed({c: f"a_{c}" for c in anchors.columns if c not in ("d", "label", "part")})
    ranges = ["norm_top", "angle_low", "angle_top"]
    ways = chunks.select("d", "label", "cell", "part", *ranges)
    sides = block.select("d", "a_label", "a_part", *(f"a_{c}" for c in ranges), *([] if same_label else ["a_lowest"]))
    if same_label:
        routes = ways.join(sides, (ways["d"] == sides["d"]) & (F.col("label") == F.col("a_label"))).drop(sides["d"])
    else:
        # the blocks are numbered per length, and every chunk asks for each number
        numbered = sides.withColumn("no", F.row_number().over(Window.partitionBy("d").orderBy("a_label", "a_part")))
        many = numbered.groupBy("d").agg(F.max("no").alias("many"))
        asking = ways.join(F.broadcast(many), "d").withColumn("no", F.explode(F.sequence(F.lit(1), "many"))).drop("many")
        routes = asking.join(numbered, ["d", "no"]).where("label != a_label")
        gap = F.zip_with(
            F.zip_with("angle_low", "a_angle_top", lambda x, y: x - y), F.zip_with("a_angle_low", "angle_top", lambda x, y: x - y),
            lambda x, y: F.greatest(x, y, F.lit(0.0)),
        )
        widest = F.col("norm_top") * F.col("a_norm_top")
        largest = widest * F.cos(F.array_max(gap)) + widest * SLACK + WHOLE
        routes = routes.where(largest >= F.col("a_lowest"))
    routes = settle(routes.select("d", "label", "cell", "part", "a_label", "a_part"), "negatives-routes")
    pairs = routes.join(chunks.drop(*ranges), ["d", "label", "cell", "part"]).join(
        block.drop(*(f"a_{c}" for c in ranges)), ["d", "a_label", "a_part"]
    )
    return pairs.repartition("d", "label", "cell", "part", "a_label", "a_part")


def searched(pairs: DataFrame, most: int, windows: Callable[[dict, Rows], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """``(a_rid, window, score, id, rid)``: the best rows of each anchor's windows, meeting by meeting."""
    names = ["rids", "ids", "norms", "angles", "x"]

    def work(batches):
        for batch in batches:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1).to_pylist()[0]
                a, v = Rows({c: row[f"a_{c}"] for c in names}, row["d"]), Rows(row, row["d"])
                low, top = windows(row, a)
                best = first_rows(a, v, low, top, most)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (a.rids[best.list % len(a.ids)], best.list // len(a.ids), best.score, best.id, best.rid)],
                    names=["a_rid", "window", "score", "id", "rid"],
                )

    return map_batches(pairs, work, "a_rid long, window long, score long, id long, rid long")


def ranked(found: DataFrame, most: int) -> DataFrame:
    """The first ``most`` of each anchor's window over all meetings, with their ``rank``."""
    order = Window.partitionBy("a_rid", "window").orderBy(F.col("score").desc(), "id", "rid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mine(
    vectors: DataFrame,
    anchors: Callable[[Column], Column],
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    top: int = 95,
    scale: int = 256,
    count: int = REFERENCES,
    chunk: int = CHUNK,
    block: int = BLOCK,
    seed: int = 11,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``anchors`` says by its id whether a row is an anchor.  Negatives are rows of another label
    with ``low * positive_score <= 100 * negative_score <= top * positive_score``.
    """
    ship(vectors.sparkSession)
    rows = settle(prepared(vectors, scale, count, seed), "negatives-rows")
    chunks = settle(packed(dealt(rows, chunk, ["d", "label", "cell"]), ["d", "label", "cell", "part"]), "negatives-chunks")
    asking = dealt(rows.where(anchors(F.col("id"))), block, ["d", "label"])
    blocks = packed(asking, ["d", "label", "part"])

    def everything(row: dict, a: Rows) -> tuple[np.ndarray, np.ndarray]:
        return np.full((1, len(a.ids)), _LEAST), np.full((1, len(a.ids)), _MOST)

    near = ranked(searched(met(settle(blocks, "negatives-blocks"), chunks, True), positives, everything), positives)
    near = settle(near.select("a_rid", F.col("rank").alias("turn"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "negatives-positives")

    # windows in order of the positive; negative scores of positives ask for nothing
    turns = near.groupBy("a_rid").agg(F.array_sort(F.collect_list(F.struct("turn", "positive_score"))).alias("asked"))
    turns = turns.withColumn("asked", F.transform("asked", lambda s: s["positive_score"])).where(F.exists("asked", lambda s: s >= 0))
    wanting = asking.join(turns, asking["rid"] == turns["a_rid"]).drop("a_rid")

    def between(row: dict, a: Rows) -> tuple[np.ndarray, np.ndarray]:
        asked = np.full((positives, len(a.ids)), -1, np.int64)
        for i, wanted in enumerate(row["a_asked"]):
            asked[: len(wanted), i] = wanted
        hundreds, rest = asked // 100, asked % 100  # apart, as a score may take all 63 bits
        lows, tops = low * hundreds - (-low * rest // 100), top * hundreds + top * rest // 100
        return np.where(asked < 0, _MOST, lows), np.where(asked < 0, _LEAST, tops)

    blocks = settle(packed(wanting, ["d", "label", "part"]), "negatives-windows")
    found = ranked(searched(met(blocks, chunks, False), negatives, between), negatives)
    named = rows.select(F.col("rid").alias("a_rid"), F.col("id").alias("anchor_id")).where(anchors(F.col("anchor_id")))
    found = found.withColumn("turn", F.col("window") + 1).join(near, ["a_rid", "turn"]).join(named, "a_rid")
    return found.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
