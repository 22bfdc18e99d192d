"""Mixing sources to target weights: Sainte-Lague quotas of equal-word blocks per shard.

1. Sources in code-point order (null last) take the weights in turn.  Their targets share
   ``share`` times all words by weight; a target stops at ``repeat`` times its source and
   the excess is shared anew, which is the water level of ``targets``.
2. Documents fall into shards by a seeded hash, about ``shard_words`` words each.  Inside a
   shard every source holds a stream of documents in seeded order, cut into blocks of
   ``block_words`` words.
3. The corpus gives whole blocks to the sources with the highest quotients
   ``ideal / (2k - 1)``.  All quotients that are certain to win are counted by rounding; only
   the contested few per source are ranked.
4. Shards get whole-number quotas: each the difference of the source's running, rounded share
   of its blocks, so a source of a few words in each shard loses nothing to rounding, however
   many shards there are.  What a shard cannot give (``repeat`` times its words) is carried on.
5. The quota takes the first blocks of the shard's seeded stream and wraps around for repeats,
   so a document is taken at most ``repeat`` times its size.

Null texts count no words, a null source is a source of its own, rows that repeat an id are
each rows of their own, an empty table gives no row.  Only ``doc_id``, ``source`` and
``text`` are read.  A hot source is split over all shards; the window over sources sees one
row per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payloom.llm.common import WORD
from payloom.session import settle

WEIGHTS = (5, 2, 1)


def row_hash(seed: int) -> Column:
    own = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.md5(F.concat_ws(":", F.lit(str(seed)), own, F.md5(F.coalesce("text", F.lit("")))))


def measured(docs: DataFrame, seed: int) -> DataFrame:
    """``(doc_id, source, size, h)`` with a hash that depends on seed, id and text only."""
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    return docs.select("doc_id", "source", words.alias("size"), row_hash(seed).alias("h"))


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, repeat: int) -> DataFrame:
    """``(source, source_no, source_size, target)``, one row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1).alias("source_no")
    per = per.select("*", turn)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("source_no") % len(weights) + 1).cast("int"))
    cap = repeat * F.col("source_size")
    per = per.select("*", weight.alias("weight"), cap.alias("cap"))
    rising = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    everything = Window.partitionBy()
    left = share * F.sum("source_size").over(everything) - (F.sum("cap").over(rising.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap"))
    level = left / F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing))
    per = per.select("*", level.alias("level"))
    full = F.col("cap") / F.col("weight") <= F.col("level")
    height = F.max(F.when(~full, F.col("level"))).over(everything)
    return per.select(
        "source", "source_no", "source_size",
        F.when(full, F.col("cap").cast("double")).otherwise(F.col("weight") * height).alias("target"),
    )


def quotas(streams: DataFrame, block_words: int, repeat: int) -> DataFrame:
    """``(shard, source_no, blocks)`` from ``(shard, source_no, words, ideal)`` in words."""
    shard = Window.partitionBy("shard")
    q = F.col("ideal") / block_words
    most = F.floor(repeat * F.col("words") / block_words)
    sized = streams.select(
        "shard", "source_no", q.alias("q"), most.alias("most"), F.sum(q).over(shard).alias("all_q"),
        # what a full source cannot give in whole blocks is not asked of the others
        F.round(F.sum(F.least(q, most)).over(shard)).alias("seats"), F.count("*").over(shard).alias("parties"),
    ).where("all_q > 0")

    def at(total: Column, more: int) -> Column:
        return F.greatest(F.lit(0), F.least("most", F.floor(F.col("q") * total / F.col("all_q") + 0.5) + more))

    # Rounding at a total below the seats gives no seat that the quotients would not give;
    # one more than rounding at a total above them misses none.
    half = F.col("parties") / 2
    sized = sized.select(
        "*", at(F.col("seats") - half, 0).alias("sure"),
        at(F.greatest(F.col("seats") + half, F.col("all_q")), 1).alias("possible"),
    )
    contested = sized.where("possible > sure").select(
        "shard", "source_no", "q", F.explode(F.sequence(F.col("sure") + 1, F.col("possible"))).alias("k")
    )
    rank = F.row_number().over(
        shard.orderBy((F.col("q") / (2 * F.col("k") - 1)).desc(), "source_no", "k")
    )
    sure = sized.groupBy("shard").agg((F.max("seats") - F.sum("sure")).alias("open"))
    won = (
        contested.select("shard", "source_no", rank.alias("rank"))
        .join(sure, "shard")
        .where("rank <= open")
        .groupBy("shard", "source_no")
        .agg(F.count("*").alias("won"))
    )
    return sized.join(won, ["shard", "source_no"], "left").select(
        "shard", "source_no", (F.col("sure") + F.coalesce("won", F.lit(0))).alias("blocks")
    )


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.5,
    repeat: int = 2,
    seed: int = 7,
    block_words: int = 64,
    shard_words: int = 1_000_000,
) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` for every row of ``docs``."""
    found = allocated(docs, weights, share, repeat, seed, block_words, shard_words)
    return found.select("doc_id", "size", "source_size", "target", "taken")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: whole documents, each as often as the words it gives come to its size.

    Quotas are asked once for the whole corpus, and a source is one stream over all shards, so
    only one document of a source gives a part of its words.  It is left out if that is less
    than half, else it stands once more; the words of a source come to its quota up to half
    that document, however many shards there are.  All columns of ``docs`` stay as they are.
    """
    seed = options.setdefault("seed", 7)
    times = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    chosen = allocated(docs, **options, whole=True).where("size > 0 AND 2 * taken >= size").select("h", times.alias("times"))
    chosen = chosen.groupBy("h").agg(F.sum("times").alias("times"))
    # equal rows share their hash: one of them stands for all, as often as all are taken
    rows = docs.select(row_hash(seed).alias("h"), F.struct("*").alias("row"))
    one = rows.withColumn("nth", F.row_number().over(Window.partitionBy("h").orderBy("h"))).where("nth = 1")
    repeated = one.join(chosen, "h").select("row", F.explode(F.sequence(F.lit(1), "times")))
    return repeated.select("row.*")


def allocated(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.5,
    repeat: int = 2,
    seed: int = 7,
    block_words: int = 64,
    shard_words: int = 1_000_000,
    whole: bool = False,
) -> DataFrame:
    """As ``mix``, with the hash ``h`` of every row.

    With ``whole`` the streams of a source's shards follow one another and its blocks are the
    first of them all.  Windows over the shards of a source see one row per shard.
    """
    sizes = settle(measured(docs, seed), "mix-sizes")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    shards = -(-total // shard_words) or 1
    goal = targets(sizes, weights, share, repeat)
    number = F.conv(F.substring("h", 1, 8), 16, 10).cast("long") % shards
    placed = sizes.join(goal, sizes["source"].eqNullSafe(goal["source"])).select(
        "doc_id", "h", "size", "source_no", "source_size", "target", number.alias("shard")
    )
    part = F.sum("size").alias("words")
    streams = placed.groupBy("shard", "source_no", "source_size", "target").agg(part)
    asking = goal.select(F.lit(0).alias("shard"), "source_no", "source_size", "target", F.col("source_size").alias("words"))
    ideal = F.when(F.col("source_size") > 0, F.col("target") * F.col("words") / F.col("source_size")).otherwise(0.0)
    given = quotas(asking.select("shard", "source_no", "words", ideal.alias("ideal")), block_words, repeat).drop("shard")
    stream = Window.partitionBy("shard", "source_no")
    before = F.sum("size").over(stream.orderBy("h", "size").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    ordered = placed.select("*", before.alias("start"))
    shard_turn = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.sum("words").over(shard_turn)
    if whole:
        ordered = ordered.join(
            streams.select("shard", "source_no", (upto - F.col("words")).alias("earlier")), ["shard", "source_no"]
        )
        ordered = ordered.join(given.withColumn("taking", F.col("blocks") * block_words), "source_no", "left")
        ordered = ordered.withColumn("start", F.col("start") + F.col("earlier")).withColumn("words", F.col("source_size"))
    else:
        share = streams.select("shard", "source_no", "words", "source_size", upto.alias("upto")).join(given, "source_no")
        asked = block_words * F.floor(F.col("blocks") * (F.col("upto") / F.col("source_size")) + 0.5)
        # up to each shard no more than all its words so far can be repeated
        short = F.least(F.lit(0), F.min(asked - repeat * F.col("upto")).over(shard_turn))
        share = share.where("source_size > 0").withColumn("reached", repeat * F.col("upto") + short)
        before_it = F.lag("reached", 1, 0).over(Window.partitionBy("source_no").orderBy("shard"))
        handed = share.select("shard", "source_no", "words", (F.col("reached") - before_it).alias("taking"))
        ordered = ordered.join(handed, ["shard", "source_no"], "left")
    passes = F.when(F.col("words") > 0, F.floor(F.col("taking") / F.col("words"))).otherwise(0)
    rest = F.coalesce(F.col("taking") - F.col("passes") * F.col("words"), F.lit(0))
    piece = F.greatest(F.lit(0), F.least(F.col("start") + F.col("size"), rest) - F.col("start"))
    return ordered.withColumn("passes", F.coalesce(passes, F.lit(0))).select(
        "doc_id", "h", "size", "source_size", "target",
        (F.col("passes") * F.col("size") + piece).cast("long").alias("taken"),
    )
