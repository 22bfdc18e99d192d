"""Token ids as Arrow files: fixed-size-list batches of equal-length sequences and masks.

``write`` orders the documents by id over range partitions.  Every task encodes its part
and writes one Arrow file of record batches with two columns, ``ids`` and ``mask``, both
fixed-size lists of ``sequence`` entries; the last sequence is padded with id 0 and mask
false.  Batches have equal buffers, so sequence ``i`` of a mapped file is at a known place
and is read without a copy.  A second file beside it holds ``doc_id, offset, n_tokens`` of
the part.  Files get names of their own for every attempt and only the manifest, written by
Spark after all tasks succeeded, makes them part of the result: lost executors cost a
repeated task, never a half file.

Null texts encode like empty ones, to the end id alone.  Null ids come first.  Rows that
repeat an id are documents of their own, in order of their text's hash, which also lets
many equal ids spread over partitions.  An empty table gives a manifest without rows.
Only the id and the text column are read; texts are read whole.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from payloom.llm.common import map_batches
from payloom.session import settle, work_folder

SEQUENCE = 1024
#: Sequences of one record batch.
BATCH = 64
END_ID = 0


#: Words met in one batch, and in several, whose ids a task remembers, and the longest of them.
RECENT, KEPT, SHORT = 360_000, 450_000, 64


class Encoder:
    """The library's ids of whole texts; words that repeat are asked for once.

    A byte-level vocabulary starts a new pre-token at a space before a visible character,
    so a text may be cut there into words.  The words of a batch are numbered by Arrow, the
    library encodes each new one with its space, and the ids of all words are gathered by
    number.  Texts that hold an added token's string go to the library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.added = [t.content for t in self.model.get_added_tokens_decoder().values()]
        size = self.model.get_vocab_size()
        self.kind = pa.uint16() if size <= 1 << 16 else pa.uint32()
        self.type = self.kind.to_pandas_dtype()
        self.letter = "H" if self.kind == pa.uint16() else "I"
        self.recent: dict[str, bytes] = {}
        self.kept: dict[str, bytes] = {}
        space = self.model.pre_tokenizer.pre_tokenize_str(" ")[0][0]
        self.begins = np.array([(self.model.id_to_token(i) or "").startswith(space) for i in range(size)])
        self.uneven, self.cut = re.compile(r" \s").search, re.compile(r" (?=\S)").split

    def ask(self, texts: list[str]) -> list[bytes]:
        """The library's ids as bytes."""
        found = []
        for i in range(0, len(texts), 256):
            part = self.model.encode_batch_fast(texts[i : i + 256], add_special_tokens=False)
            found += [array(self.letter, e.ids).tobytes() for e in part]
        return found

    def ask_words(self, words: list[str]) -> list[bytes]:
        """The library's ids of words with a space before them.

        Words without white space are joined to texts, in which each space begins a
        word, and a token that begins with a space the ids of one.
        """
        out: list[bytes] = [b""] * len(words)
        parts = [words[i : i + 256] for i in range(0, len(words), 256)]
        texts = [" ".join(part) for part in parts]
        odd = []
        for n, (part, ids) in enumerate(zip(parts, self.ask([" " + t if t.split() == part else "" for t, part in zip(texts, parts)]))):
            row = np.frombuffer(ids, self.type)
            starts = np.flatnonzero(self.begins[row])
            if len(starts) != len(part):
                odd += range(n * 256, n * 256 + len(part))
                continue
            starts = (starts * row.itemsize).tolist()
            out[n * 256 : n * 256 + len(part)] = [ids[a:b] for a, b in zip(starts, [*starts[1:], len(ids)])]
        for i, ids in zip(odd, self.ask([" " + words[i] for i in odd])):
            out[i] = ids
        return out

    def ids_of(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words.  A word that is met in a second batch is kept longer."""
        table = list(map(self.kept.get, words))
        if len(self.kept) > KEPT:
            self.kept = {w: ids for w, ids in zip(words, table) if ids is not None}
        kept, recent = self.kept, self.recent
        missing = [i for i, ids in enumerate(table) if ids is None]
        new = []
        for i in missing:
            ids = recent.pop(words[i], None)
            if ids is None:
                new.append(i)
            else:
                table[i] = kept[words[i]] = ids
        asked = [words[i] for i in new]
        found = self.ask_words(asked)
        for i, ids in zip(new, found):
            table[i] = ids
        if len(recent) > RECENT:
            recent.clear()
        recent.update(zip(asked, found))
        for w in [w for w in asked if len(w) > SHORT]:
            del recent[w]
        return table

    def words(self, texts: list[str]) -> pa.LargeListArray:
        """Parts of each text that can be encoded apart: the first, then the others without their space."""
        odd = [i for i, x in enumerate(texts) if self.uneven(x) or any(a in x for a in self.added)]
        row, kind = pa.array(texts, pa.large_string()), pa.large_list(pa.large_string())
        if not odd:
            return pc.split_pattern(row, " ").cast(kind)
        parts = [[texts[i]] if any(a in texts[i] for a in self.added) else self.cut(texts[i]) for i in odd]
        even = np.ones(len(texts), bool)
        even[odd] = False
        split = pa.concat_arrays(
            [pc.split_pattern(row.filter(pa.array(even)), " ").cast(kind), pa.array(parts, kind)]
        )
        order = np.empty(len(texts), np.int64)
        order[np.append(np.flatnonzero(even), odd).astype(np.int64)] = np.arange(len(texts))
        return split.take(pa.array(order))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by the end id, and the number of ids of each."""
        if not texts:
            return np.zeros(0, self.type), np.zeros(0, np.int64)
        split = self.words(texts)
        values, offsets = split.flatten(), split.offsets.to_numpy()
        starts = (offsets - offsets[0])[:-1]
        firsts = self.ask(values.take(pa.array(starts)).to_pylist())
        numbered = values.dictionary_encode()
        words, codes = numbered.dictionary.to_pylist(), numbered.indices.to_numpy().astype(np.int64)
        # the first part of a text has no space before it, so it gets a number of its own
        codes[starts] = len(words) + np.arange(len(texts))
        table = [*self.ids_of(words), *firsts]
        lengths = np.fromiter(map(len, table), np.int64, len(table)) // np.dtype(self.type).itemsize
        ends = np.append(0, np.cumsum(lengths))
        lists = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(table), self.type)))
        ids = lists.take(pa.array(codes)).flatten().to_numpy()
        counts = np.add.reduceat(lengths[codes], starts)
        return np.insert(ids, np.cumsum(counts), END_ID), counts + 1


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


class SequenceFile:
    """Collects ids and writes them as batches of equal-length sequences."""

    def __init__(self, sink, kind: pa.DataType, sequence: int):
        self.kind, self.sequence = kind, sequence
        schema = pa.schema([("ids", pa.list_(kind, sequence)), ("mask", pa.list_(pa.bool_(), sequence))])
        self.file = pa.ipc.new_file(sink, schema)
        self.schema, self.waiting, self.n = schema, [], 0

    def add(self, ids: np.ndarray) -> None:
        self.waiting.append(ids)
        self.n += len(ids)
        block = BATCH * self.sequence
        if self.n >= block:
            row = np.concatenate(self.waiting)
            whole = len(row) // block * block
            for i in range(0, whole, block):
                self._batch(row[i : i + block], block)
            self.waiting, self.n = [row[whole:]], len(row) - whole

    def _batch(self, ids: np.ndarray, filled: int) -> None:
        mask = np.arange(len(ids)) < filled
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(ids, self.kind), self.sequence),
            pa.FixedSizeListArray.from_arrays(pa.array(mask), self.sequence),
        ]
        self.file.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))

    def close(self) -> None:
        if self.n:
            row = np.concatenate(self.waiting)
            padded = np.full(-(-len(row) // self.sequence) * self.sequence, END_ID, row.dtype)
            padded[: len(row)] = row
            self._batch(padded, len(row))
        self.file.close()


def write(docs: DataFrame, vocab_path: str, sequence: int = SEQUENCE) -> DataFrame:
    """Writes the files into the shared folder; the manifest ``(shard, path, n_docs, n_tokens)``."""
    folder = work_folder(docs.sparkSession, "token-files")
    spread = F.xxhash64("text")
    ordered = docs.select("doc_id", "text").withColumn("_h", spread)
    ordered = ordered.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("_h"))
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_h").select("doc_id", "text")

    def work(batches):
        task = TaskContext.get()
        store, root = fs.FileSystem.from_uri(folder)
        model = encoder(vocab_path)
        path = f"{root}/{task.partitionId():08d}-{task.taskAttemptId()}"
        store.create_dir(root, recursive=True)
        n_docs = n_tokens = 0
        index = None
        with store.open_output_stream(path + ".arrow") as sink, store.open_output_stream(path + ".docs.arrow") as docs_sink:
            file = SequenceFile(sink, model.kind, sequence)
            for batch in batches:
                texts = [t or "" for t in batch.column(1).to_pylist()]
                ids, lengths = model.encode(texts)
                file.add(ids)
                ends = n_tokens + np.cumsum(lengths)
                part = pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(ends - lengths, pa.int64()), pa.array(lengths, pa.int64())],
                    names=["doc_id", "offset", "n_tokens"],
                )
                index = index or pa.ipc.new_file(docs_sink, part.schema)
                index.write_batch(part)
                n_docs, n_tokens = n_docs + len(texts), int(ends[-1]) if texts else n_tokens
            file.close()
            if index:
                index.close()
        if n_docs:
            yield pa.RecordBatch.from_pydict(
                {"shard": [task.partitionId()], "path": [path], "n_docs": [n_docs], "n_tokens": [n_tokens]},
                schema=pa.schema([("shard", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]),
            )

    made = map_batches(ordered, work, "shard long, path string, n_docs long, n_tokens long")
    made = settle(made.withColumn("folder", F.lit(folder)), "token-manifest")
    return made


class TokenFile:
    """Random access to one written file: ``sequence(i)`` and ``tokens(start, n)`` without copies
    where a range stays inside a batch."""

    def __init__(self, folder: str, path: str):
        store, _ = fs.FileSystem.from_uri(folder)
        local = isinstance(store, fs.LocalFileSystem)
        self.source = pa.memory_map(path + ".arrow") if local else store.open_input_file(path + ".arrow")
        self.file = pa.ipc.open_file(self.source)
        self.width = self.file.schema.field("ids").type.list_size
        self.index = pa.ipc.open_file(store.open_input_file(path + ".docs.arrow"))

    def batch(self, i: int) -> np.ndarray:
        return self.file.get_batch(i).column(0).flatten().to_numpy(zero_copy_only=True)

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        batch, row = self.file.get_batch(i // BATCH), i % BATCH
        ids, mask = (batch.column(c).slice(row, 1).flatten() for c in (0, 1))
        return ids.to_numpy(zero_copy_only=True), mask.to_numpy(zero_copy_only=False)

    def tokens(self, start: int, n: int) -> np.ndarray:
        block = BATCH * self.width
        first, last = start // block, (start + n - 1) // block
        if first == last:
            return self.batch(first)[start - first * block : start - first * block + n]
        row = np.concatenate([self.batch(i) for i in range(first, last + 1)])
        return row[start - first * block : start - first * block + n]


def read(manifest: DataFrame, id_kind: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, read back from the files."""
    before = F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_tokens")
    placed = manifest.select("shard", "folder", "path", before.alias("start"))
    # one row per file: dealt out evenly, each file is a task's worth of work
    placed = placed.repartition(max(1, manifest.count()), "shard")

    def work(batches):
        for batch in batches:
            for row in batch.to_pylist():
                file = TokenFile(row["folder"], row["path"])
                for i in range(file.index.num_record_batches):
                    part = file.index.get_batch(i)
                    offsets, lengths = (part.column(c).to_numpy() for c in (1, 2))
                    sums = [
                        zlib.crc32(file.tokens(int(o), int(n)).astype("<u4").tobytes()) for o, n in zip(offsets, lengths)
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column(0), pa.array(offsets + row["start"], pa.int64()),
                            pa.array(lengths, pa.int64()), pa.array(sums, pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    return map_batches(placed, work, f"doc_id {id_kind}, start long, n_tokens long, ids_crc32 long")
