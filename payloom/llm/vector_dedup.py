"""Embedding near-duplicates by a random-projection tree forest with spill.

Vectors are compared only inside a label (and a length).  Every tree starts from the labels
as cells.  A cell of more than ``leaf`` rows is split along random directions, one for each
level, at the median; rows within a margin of a cut go to both sides.  All levels of a cell
are cut in one pass: their medians come from a bounded sample of its rows (``FIT``), and
every row, whole or not in the sample, is placed by them.  Cells that are still too large are
split again; one that its levels do not shrink is a dense cluster, stays whole and is
compared in parts.  The margin is small and the number of trees follows from it, the levels
and the angle of the threshold: a pair at the threshold is cut apart in all trees with a
chance of about ``miss``, and closer pairs far more seldom.

All rows of a leaf are compared by cosine in double precision.  A pair may share several
leaves; it counts only in the smallest leaf that both belong to, so link counts need no
list of pairs: a leaf hands on one row for each linked vector, never one for each pair.
Parts of large leaves meet pairwise in bounded tasks (`in_pairs_of_parts`).

Invalid vectors (null, zero, null or non-finite components), null labels and null ids link
with nothing; they keep their id as component and are kept.  Equal rows count once; an id
that has several vectors is one node.  Only ``vec_id``, ``embedding`` and ``label`` are read.
"""

from __future__ import annotations

from functools import lru_cache
from math import erfc

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payloom.llm.common import components, in_pairs_of_parts, map_batches, whole_groups
from payloom.llm.vectors import direction, matrix, valid_rows
from payloom.session import settle

LEAF, MISS = 1024, 1e-4
#: Rows of a cell that its cuts are fitted on, levels that are cut in one pass, and the margin
#: on each side of a cut in standard deviations of a projection.
FIT, LEVELS, MARGIN = 4096, 8, 0.06
#: So many groups at most are sent to every task, rather than their rows to them.
FEW_CELLS = 4096
_NONE = np.iinfo(np.int64).max


def levels_of(n: int, leaf: int) -> int:
    """Halvings that bring ``n`` rows to ``leaf``, as many as one pass cuts."""
    return min(LEVELS, max(0, int(np.ceil(np.log2(max(n, 1) / leaf)))))


def trees_of(n: Column, leaf: int, cosine: float, miss: float) -> Column:
    """Trees that leave a pair at the threshold unmet with a chance of about ``miss``.

    Two levels more than halvings are reckoned with, as cells are not quite even.
    """
    # along a direction both points are about normal and differ by a normal draw of this size
    apart = np.sqrt(2 - 2 * cosine)
    x = 2 * MARGIN / apart
    beyond = apart * (np.exp(-x * x / 2) / np.sqrt(2 * np.pi) - x * erfc(x / np.sqrt(2)) / 2)
    cut = float(2 / np.sqrt(2 * np.pi) * beyond)
    kept = F.pow(F.lit(1 - cut), F.ceil(F.log2(n / leaf)) + 2)
    return F.when(n <= leaf, 1).otherwise(F.ceil(F.lit(float(np.log(miss))) / F.log(1 - kept))).cast("int")


@lru_cache(maxsize=1024)
def directions(cell: int, levels: int, d: int) -> np.ndarray:
    return np.stack([direction(cell * 31 + k, d) for k in range(levels)])


def doubles(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors as rows of doubles, in whatever precision they travel."""
    return matrix(vectors).astype(np.float64, copy=False)


def unit(vectors: pa.Array) -> np.ndarray:
    v = doubles(vectors)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def cuts_of(members: DataFrame, leaf: int) -> DataFrame:
    """``(cell, cuts)``: the median of each level's projections, from at most some `FIT` rows of a cell."""
    share = F.least(F.lit(1.0), F.lit(FIT) / F.col("n"))
    sample = members.where(F.pmod(F.xxhash64("rid", F.lit(3)), F.lit(1 << 20)) <= share * (1 << 20))

    def work(batches):
        for batch in batches:
            cells, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for cell in np.unique(cells):
                at = np.flatnonzero(cells == cell)
                v = unit(batch.column(2).take(pa.array(at)))
                p = v @ directions(int(cell), levels_of(n[at[0]], leaf), v.shape[1]).T
                level = np.tile(np.arange(p.shape[1]), len(at))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(p.size, cell)), pa.array(level.astype(np.int32)), pa.array(p.ravel())],
                    names=["cell", "level", "p"],
                )

    projected = map_batches(sample.select("cell", "n", "v"), work, "cell long, level int, p double")
    medians = projected.groupBy("cell", "level").agg(F.percentile_approx("p", 0.5, 1000).alias("cut"))
    listed = medians.groupBy("cell").agg(F.array_sort(F.collect_list(F.struct("level", "cut"))).alias("cuts"))
    return listed.select("cell", F.transform("cuts", lambda c: c["cut"]).alias("cuts"))


def sent_if_few(groups: DataFrame, purpose: str) -> DataFrame:
    """One row for each group, for a join with its vectors: few and large groups move no vector, and are no hot keys."""
    groups = settle(groups, purpose)
    return F.broadcast(groups) if len(groups.take(FEW_CELLS + 1)) <= FEW_CELLS else groups


def placed(members: DataFrame, cuts: DataFrame) -> DataFrame:
    """``(parent, cell, rid)``: the cells that each row falls into, more than one where it is near a cut."""

    def work(batches):
        for batch in batches:
            cells = batch.column(0).to_numpy()
            out = []
            for cell in np.unique(cells):
                at = np.flatnonzero(cells == cell)
                cut = np.array(batch.column(3)[int(at[0])].as_py())
                v = unit(batch.column(2).take(pa.array(at)))
                p = v @ directions(int(cell), len(cut), v.shape[1]).T - cut
                margin = MARGIN / np.sqrt(v.shape[1])
                code, row = np.zeros(len(at), np.int64), np.arange(len(at))
                for k in range(len(cut)):
                    side = (p[row, k] > 0).astype(np.int64)
                    near = np.abs(p[row, k]) <= margin
                    code, row = np.append(2 * code + side, 2 * code[near] + 1 - side[near]), np.append(row, row[near])
                out.append((np.full(len(row), cell), code, batch.column(1).to_numpy()[at][row]))
            columns = [pa.array(np.concatenate(c)) for c in zip(*out)] if out else [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays(columns, names=["parent", "code", "rid"])

    # Many small cells come sorted from the join, so that a batch holds few of them.
    joined = members.join(sent_if_few(cuts, "cuts"), "cell").select("cell", "rid", "v", "cuts")
    found = map_batches(joined, work, "parent long, code long, rid long")
    return found.select("parent", F.xxhash64("parent", "code").alias("cell"), "rid")


def forest(rows: DataFrame, cosine: float, leaf: int, miss: float) -> DataFrame:
    """``(cell, rid, n)``: the leaves of every row, with their sizes."""
    kinds = rows.withColumn("d", F.size("v"))
    sizes = kinds.groupBy("label", "d").agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("trees", trees_of(F.col("n"), leaf, cosine, miss))
    start = kinds.join(sent_if_few(sizes, "sizes"), ["label", "d"]).withColumn("tree", F.explode(F.sequence(F.lit(1), "trees")))
    members = start.select(F.xxhash64("tree", "label", "d").alias("cell"), "rid", "n", "v")
    done = members.where(F.col("n") <= leaf).select("cell", "rid", "n")
    members = members.where(F.col("n") > leaf)
    while not members.isEmpty():
        counts = members.groupBy("cell").agg(F.max("n").alias("parent_n"))
        found = settle(placed(members, cuts_of(members, leaf)), "placed")
        sizes = found.groupBy("parent", "cell").agg(F.count("*").alias("n")).join(
            counts.withColumnRenamed("cell", "parent"), "parent"
        )
        sized = settle(found.join(sizes.select("cell", "n", "parent_n"), "cell"), "cells")
        # a child that holds most of its cell is a dense cluster: no direction tells its rows apart
        final = (F.col("n") <= leaf) | (F.col("n") > 0.7 * F.col("parent_n"))
        done = done.union(sized.where(final).select("cell", "rid", "n"))
        left = sized.where(~final).select("cell", "rid", "n")
        members = left.join(rows.select("rid", "v"), "rid").select("cell", "rid", "n", "v")
    return done


def padded(lists: pa.ChunkedArray) -> np.ndarray:
    """Lists as rows of one array, filled up with a value that no leaf has."""
    lists = lists.combine_chunks()
    lengths = lists.value_lengths().to_numpy()
    out = np.full((len(lists), int(lengths.max(initial=1))), _NONE, np.int64)
    out[np.arange(out.shape[1])[None, :] < lengths[:, None]] = lists.flatten().to_numpy()
    return out


def owned(i: np.ndarray, j: np.ndarray, leaf: int, leaves: np.ndarray) -> np.ndarray:
    """Which pairs of rows have this leaf as their smallest common one; ``leaves`` are those of each row."""
    own = np.ones(len(i), bool)
    smaller = np.where(leaves < leaf, leaves, _NONE)
    for start in range(0, len(i), 1 << 16):
        at = slice(start, start + (1 << 16))
        a, b = smaller[i[at]], smaller[j[at]]
        for k in range(leaves.shape[1]):
            here = a[:, k : k + 1]
            own[at] &= ~((b == here) & (here != _NONE)).any(axis=1)
    return own


def leaf_links(ids: np.ndarray, v: np.ndarray, part: np.ndarray, across: bool, leaf: int, leaves: np.ndarray, cosine: float):
    """Linked rows of one leaf: id, number of owned links, id of the first row of its component."""
    u = v / np.sqrt((v * v).sum(axis=1, keepdims=True))
    single = u.astype(np.float32)
    # single precision finds the candidates, double precision decides
    i, j = np.nonzero(single @ single.T >= cosine - 1e-4)
    i, j = i[i < j], j[i < j]
    keep = ids[i] != ids[j]
    if across:
        keep &= part[i] != part[j]
    i, j = i[keep], j[keep]
    length = np.sqrt((v * v).sum(axis=1))
    linked = np.empty(len(i), bool)
    for start in range(0, len(i), 1 << 16):
        at = slice(start, start + (1 << 16))
        linked[at] = np.einsum("ij,ij->i", v[i[at]], v[j[at]]) / (length[i[at]] * length[j[at]]) >= cosine
    i, j = i[linked], j[linked]
    own = owned(i, j, leaf, leaves)
    counts = np.bincount(i[own], minlength=len(ids)) + np.bincount(j[own], minlength=len(ids))
    some = np.unique(np.append(i, j))
    low = np.arange(len(ids))
    while len(i):
        before = low.copy()
        np.minimum.at(low, i, low[j])
        np.minimum.at(low, j, low[i])
        low = low[low]
        if np.array_equal(low, before):
            break
    return ids[some], counts[some], ids[low[some]]


def deduplicate(vectors: DataFrame, cosine: float = 0.93, leaf: int = LEAF, miss: float = MISS) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors``."""
    rows = valid_rows(vectors, "vec_id", "embedding", "label").where("label IS NOT NULL").distinct()
    rows = rows.withColumn("rid", F.xxhash64("id", "v", "label"))
    if dict(vectors.dtypes)["embedding"] == "array<float>":
        # as exact as the doubles they were read as, in half the bytes of every copy
        rows = rows.withColumn("v", F.col("v").cast("array<float>"))
    rows = settle(rows, "vectors")
    leaves = settle(forest(rows, cosine, leaf, miss), "leaves")
    mine = leaves.groupBy("rid").agg(F.sort_array(F.collect_set("cell")).alias("cells"))  # a few for each tree
    # a leaf needs those before it only
    before = F.slice("cells", F.lit(1), (F.array_position("cells", F.col("cell")) - 1).cast("int")).alias("cells")
    full = leaves.join(rows.join(mine, "rid"), "rid").select("cell", "n", "rid", "id", "v", before)
    dealt = in_pairs_of_parts(full.select("cell", "n", "rid", "id", "v", "cells"), F.col("n"), leaf, F.col("rid"))
    task = F.xxhash64("cell", "lo", "hi").alias("task")
    dealt = dealt.select(task, "part", (F.col("lo") < F.col("hi")).alias("across"), "cell", "id", "v", "cells")
    dealt = dealt.repartition("task").sortWithinPartitions("task")

    def work(batches):
        for table in whole_groups(batches, 2 * leaf):
            tasks, part = table.column(0).to_numpy(), table.column(1).to_numpy()
            across, cell = table.column(2).to_numpy(zero_copy_only=False), table.column(3).to_numpy()
            ids = table.column(4).to_numpy()
            starts = np.flatnonzero(np.append(True, tasks[1:] != tasks[:-1]))
            found = []
            for a, b in zip(starts, np.append(starts[1:], len(tasks))):
                v = doubles(table.column(5).slice(a, b - a))
                found.append(leaf_links(ids[a:b], v, part[a:b], bool(across[a]), int(cell[a]), padded(table.column(6).slice(a, b - a)), cosine))
            columns = [pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*found)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_links", "low"])

    found = settle(map_batches(dealt, work, "id long, n_links long, low long"), "vector-links")
    groups = components(found.select(F.col("id").alias("a"), F.col("low").alias("b")))
    counts = found.groupBy("id").agg(F.sum("n_links").alias("n_links"))
    per = counts.join(groups, counts["id"] == groups["node"], "left").select("id", "n_links", "component")
    own = F.coalesce("component", F.col("vec_id").cast("long"))
    return (
        vectors.select("vec_id")
        .join(per, F.col("vec_id") == F.col("id"), "left")
        .select(
            "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"),
            F.coalesce(F.col("vec_id") == own, F.lit(True)).alias("kept"),
        )
    )
