"""Token counts: pieces are counted once per distinct pre-token, then summed per document.

A pre-token starts at a space mark and ends before the next one; line breaks stand alone.
No vocabulary piece reaches over such a cut (checked when the model is loaded), so the
pieces of a text are the pieces of its pre-tokens, and a text needs no ids at all.

1. Every task counts the pre-tokens of its texts; the totals are summed per distinct
   pre-token, whose pieces the library then counts exactly once.
2. A pre-token with at least ``1 / head`` of all occurrences is frequent.  There are at most
   ``head`` of them, whatever the corpus, so this table can go to every task; all other
   pre-tokens are joined to the per-document frequencies.  The join has no hot key, as
   frequent pre-tokens never reach it.

Null texts count like empty ones (0 bytes, 0 tokens).  Rows that repeat an id stay rows of
their own.  Texts are read whole; only the id and the text column are read.
"""

from __future__ import annotations

from collections import Counter
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payloom.llm.common import map_batches
from payloom.session import settle

SPACE = "▁"
#: Distinct pre-tokens that a task holds before it hands its counts on.
HELD = 200_000
#: Characters of the longest pre-token that may enter the frequent table.
SHORT = 64


class Pieces:
    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(SPACE in name.lstrip(SPACE) or ("\n" in name and len(name) > 1) for name in names):
            raise ValueError("a piece of this vocabulary reaches over a space mark or a line break")
        self.cut = regex.compile(rf"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n+").findall

    def pretokens(self, text: str) -> list[str]:
        """The text with its leading space mark, cut; an empty text has no pre-token."""
        return self.cut(SPACE + text.replace(" ", SPACE)) if text else []

    def count(self, pretokens: list[str]) -> list[int]:
        """Pieces of each pre-token.  The library puts a space mark before what it encodes:
        it takes the place of a leading mark, or stands alone before a line break."""
        marked = [t[1:].replace(SPACE, " ") if t[0] == SPACE else "\n" + t for t in pretokens]
        encoded = self.model.encode(marked, num_threads=1)
        # a lone mark is an empty string here, which the library gives no piece
        return [
            1 if t == SPACE else len(ids) - (0 if t[0] == SPACE else 2)
            for t, ids in zip(pretokens, encoded)
        ]


@lru_cache(maxsize=2)
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


def pretoken_totals(docs: DataFrame, model_path: str) -> DataFrame:
    """``(token, n)``: occurrences over all documents."""

    def rows(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["token", "n"]
        )

    def work(batches):
        cut, held = pieces_of(model_path).pretokens, Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.update(cut(text or ""))
                if len(held) > HELD:
                    yield rows(held)
                    held = Counter()
        if held:
            yield rows(held)

    return map_batches(docs.select("text"), work, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))


def with_pieces(totals: DataFrame, model_path: str) -> DataFrame:
    """Adds ``pieces``: the library runs once for each distinct pre-token."""

    def work(batches):
        pieces = pieces_of(model_path)
        for batch in batches:
            counts = pieces.count(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64())], names=["token", "n", "pieces"]
            )

    return map_batches(totals.select("token", "n"), work, "token string, n long, pieces long")


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096, head: int = 1 << 21) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)``, one row per row of ``docs``."""
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    table = settle(with_pieces(pretoken_totals(docs, model_path), model_path), "pieces")
    total = table.agg(F.sum("n")).first()[0] or 0
    often = (F.col("n") * head >= total) & (F.length("token") <= SHORT)
    frequent = spark.sparkContext.broadcast(
        {r.token: r.pieces for r in table.where(often).select("token", "pieces").toLocalIterator()}
    )

    def work(batches):
        cut, known = pieces_of(model_path).pretokens, frequent.value
        for batch in batches:
            row_ids, doc_ids, texts = (c.to_pylist() for c in batch.columns)
            rows, ids, sizes, tokens, counts = [], [], [], [], []
            for row, doc, text in zip(row_ids, doc_ids, texts):
                text = text or ""
                base, rare = 0, []
                for token, n in Counter(cut(text)).items():
                    pieces = known.get(token)
                    if pieces is None:
                        rare.append((token, n))
                    else:
                        base += pieces * n
                rows.append(row), ids.append(doc), sizes.append(len(text.encode())), tokens.append(None), counts.append(base)
                for token, n in rare:
                    rows.append(row), ids.append(None), sizes.append(None), tokens.append(token), counts.append(n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows, pa.int64()), pa.array(ids, batch.column(1).type), pa.array(sizes, pa.int64()),
                    pa.array(tokens, pa.string()), pa.array(counts, pa.int64()),
                ],
                names=["row", "doc_id", "n_bytes", "token", "n"],
            )

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    found = map_batches(numbered, work, f"row long, doc_id {kind}, n_bytes long, token string, n long")
    # the row of a document itself meets no pre-token; a key of its own keeps it from being a hot null
    keyed = found.withColumn("key", F.coalesce("token", F.concat(F.lit("▁\n"), F.col("row").cast("string"))))
    part = F.when(F.col("token").isNull(), F.col("n")).otherwise(F.col("n") * F.col("pieces"))
    joined = keyed.join(table.where(~often).select(F.col("token").alias("key"), "pieces"), "key", "left")
    return (
        joined.groupBy("row")
        .agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum(part).alias("n_tokens"))
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )
