"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

``Bpe`` reads a word-end vocabulary file (NFC, lower case, white space dropped).  A
pre-token is a row of symbols; leaf ``i`` of a segment tree holds the rank of the pair that
starts at symbol ``i``, joined with ``i``.  The root is the leftmost lowest rank; a merge
changes at most three leaves, each in logarithmic time, until the root is empty.  The new
pre-tokens of some texts are merged side by side: the trees of one size are the rows of an
array, and each step takes every row's root.  Merges of a pre-token are remembered in a
bounded table, as words repeat.

Null texts encode like empty ones: no ids and an empty decoded text.  Strings of the added
special tokens inside a text become those tokens.  A text of any length is encoded whole;
a pre-token of n bytes costs O(n log n).  Letters that Unicode took up only recently may be
cut otherwise than by a library with older character tables.  Repeated rows and ids give a row each; only the
named id and text columns are read.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payloom.llm.common import map_batches

#: Fixed values of the vocabulary's pre-tokenizer.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
#: Words whose merges a task remembers: those met again (a newer and an older half), and those met once.
REMEMBERED, RECENT = 280_000, 100_000
#: Characters of texts whose new pre-tokens are merged together.
SLICE = 4_000_000
_NONE = 1 << 62


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


class Bpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        letters = byte_letters()
        self.inner = [vocab[c] for c in letters]
        self.last = [vocab[c + suffix] for c in letters]
        self.inner_row, self.last_row = np.array(self.inner), np.array(self.last)
        self.merges = {
            (vocab[a] << 32) | vocab[b]: (rank, vocab[a + b])
            for rank, (a, b) in enumerate(spec["model"]["merges"])
        }
        # the merges as sorted pair keys, for many lookups at once
        keys = np.fromiter(self.merges, np.int64, len(self.merges))
        order = np.argsort(keys)
        found = np.array(list(self.merges.values()), np.int64)[order]
        self.pair_keys, self.pair_ranks, self.pair_into = keys[order], found[:, 0], found[:, 1]
        self.pretokens = regex.compile(PRETOKEN).findall
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.known: dict[str, tuple[bytes, str, int]] = {}
        self.older: dict[str, tuple[bytes, str, int]] = {}
        self.recent: dict[str, tuple[bytes, str, int]] = {}

    def merge(self, ids: list[int]) -> list[int]:
        """Merge the leftmost lowest-ranked pair until no pair of the row can merge."""
        n = len(ids)
        if n < 2:
            return ids
        merges, size = self.merges, 1
        while size < n - 1:
            size *= 2
        tree = [_NONE] * (2 * size)
        for i in range(n - 1):
            found = merges.get((ids[i] << 32) | ids[i + 1])
            if found:
                tree[size + i] = (found[0] << 32) | i
        for node in range(size - 1, 0, -1):
            left, right = tree[2 * node], tree[2 * node + 1]
            tree[node] = left if left < right else right
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(leaf: int, key: int) -> None:
            node = size + leaf
            tree[node] = key
            node >>= 1
            while node:
                left, right = tree[2 * node], tree[2 * node + 1]
                low = left if left < right else right
                if tree[node] == low:
                    return
                tree[node] = low
                node >>= 1

        while tree[1] != _NONE:
            i = tree[1] & 0xFFFFFFFF
            j = after[i]
            k = after[j]
            ids[i] = merges[(ids[i] << 32) | ids[j]][1]
            ids[j] = -1
            after[i] = k
            if j < n - 1:
                put(j, _NONE)
            if k < n:
                before[k] = i
                found = merges.get((ids[i] << 32) | ids[k])
                put(i, (found[0] << 32) | i if found else _NONE)
            else:
                put(i, _NONE)
            h = before[i]
            if h >= 0:
                found = merges.get((ids[h] << 32) | ids[i])
                put(h, (found[0] << 32) | h if found else _NONE)
        return [x for x in ids if x >= 0]

    def merge_rows(self, words: list[bytes]) -> list[list[int]]:
        """`merge` of many words whose trees have one size, a step of all of them at a time."""
        n = np.array([len(w) for w in words])
        most, rows = int(n.max()), np.arange(len(words))
        size = 1
        while size < most - 1:
            size *= 2
        ids = np.full((len(words), most + 1), -1, np.int64)
        filled = np.arange(most + 1)[None, :] < n[:, None]
        flat = np.frombuffer(b"".join(words), np.uint8)
        ids[filled] = self.inner_row[flat]
        ids[rows, n - 1] = self.last_row[np.frombuffer(bytes(w[-1] for w in words), np.uint8)]
        after = np.minimum(np.arange(1, most + 2)[None, :], n[:, None])
        before = np.broadcast_to(np.arange(-1, most), ids.shape).copy()
        tree = np.full((len(words), 2 * size), _NONE, np.int64)
        into = np.zeros((len(words), size), np.int64)
        for i in range(most - 1):
            tree[:, size + i], into[:, i] = self.leaves(ids[:, i], ids[:, i + 1], np.full(len(words), i))
        for node in range(size - 1, 0, -1):
            tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])

        def put(w: np.ndarray, leaf: np.ndarray, key) -> None:
            node = size + leaf
            tree[w, node] = key
            node >>= 1
            while len(node) and node[0]:  # all leaves are equally deep
                tree[w, node] = np.minimum(tree[w, 2 * node], tree[w, 2 * node + 1])
                node >>= 1

        while True:
            rows = rows[tree[rows, 1] != _NONE]
            if not len(rows):
                break
            i = tree[rows, 1] & 0xFFFFFFFF
            j = after[rows, i]
            k = after[rows, j]
            ids[rows, i] = into[rows, i]
            ids[rows, j] = -1
            after[rows, i] = k
            inner = j < n[rows] - 1
            put(rows[inner], j[inner], _NONE)
            before[rows, k] = i
            key, to = self.leaves(ids[rows, i], np.where(k < n[rows], ids[rows, k], -1), i)
            into[rows, i] = to
            put(rows, i, key)
            h = before[rows, i]
            left = h >= 0
            w, h, i = rows[left], h[left], i[left]
            key, to = self.leaves(ids[w, h], ids[w, i], h)
            into[w, h] = to
            put(w, h, key)
        kept = ids >= 0
        ends = np.cumsum(kept.sum(axis=1)).tolist()
        flat = ids[kept].tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def leaves(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaf keys of the pairs that start at ``at``, and the symbols they merge into."""
        pair = (left << 32) | right
        place = np.minimum(np.searchsorted(self.pair_keys, pair), len(self.pair_keys) - 1)
        hit = (left >= 0) & (right >= 0) & (self.pair_keys[place] == pair)
        return np.where(hit, (self.pair_ranks[place] << 32) | at, _NONE), self.pair_into[place]

    def remembered(self, pretoken: str) -> tuple[bytes, str, int] | None:
        out = self.known.get(pretoken)
        if out is None:
            out = self.older.pop(pretoken, None) or self.recent.pop(pretoken, None)
            if out:
                if len(self.known) >= REMEMBERED // 2:
                    self.older, self.known = self.known, {}
                self.known[pretoken] = out
        return out

    def learn(self, pretokens: set[str]) -> dict[str, tuple[bytes, str, int]]:
        """Ids as bytes, the decoded tokens, and their number, of distinct pre-tokens."""
        found = {p: out for p in pretokens if (out := self.remembered(p))}
        sizes: dict[int, list[str]] = {}
        for p in pretokens:
            if p not in found:
                sizes.setdefault((len(p.encode()) - 2).bit_length() if len(p) > 1 else 0, []).append(p)
        if len(self.recent) >= RECENT:
            self.recent.clear()
        for size, some in sizes.items():
            rows = [p.encode() for p in some]
            if len(some) > 32 and size <= 6:
                merged = self.merge_rows(rows)
            else:
                merged = [self.merge([*(self.inner[b] for b in row[:-1]), self.last[row[-1]]]) for row in rows]
            for p, ids in zip(some, merged):
                out = (array("I", ids).tobytes(), self.decode(ids), len(ids))
                found[p] = out
                if len(p) <= 64:
                    self.recent[p] = out
        return found

    def decode(self, ids: list[int]) -> str:
        """Token strings joined by a space, as a vocabulary file without decoder asks for."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids])

    def split(self, text: str) -> list[str | int]:
        """Pre-tokens of a text, and the ids of added special tokens between them."""
        out: list[str | int] = []
        for piece in self.specials.split(text) if "<|" in text else (text,):
            if piece in self.special:
                out.append(self.special[piece])
                continue
            if not piece.isascii():
                # lower case letter by letter: sigma has one form here
                piece = unicodedata.normalize("NFC", piece).replace("Σ", "σ")
            out += self.pretokens(piece.lower())
        return out

    def encode_all(self, texts: list[str | None]) -> Iterator[tuple[bytes, str, int]]:
        """All ids as little-endian unsigned 32-bit bytes, the decoded text, their number, text by text."""
        start = size = 0
        for i, text in enumerate(texts):
            size += len(text or "")
            if size < SLICE and i < len(texts) - 1:
                continue
            rows = [self.split(t or "") for t in texts[start : i + 1]]
            found = self.learn({p for row in rows for p in row if type(p) is str})
            for special in self.special.values():
                found[special] = (array("I", [special]).tobytes(), self.tokens[special], 1)
            for row in rows:
                parts = [found[p] for p in row]
                yield b"".join([p[0] for p in parts]), " ".join([p[1] for p in parts]), sum([p[2] for p in parts])
            start, size = i + 1, 0

    def encode(self, text: str | None) -> tuple[bytes, str, int]:
        return next(self.encode_all([text]))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Bpe:
    return Bpe(path)


def encode_texts(docs: DataFrame, vocab_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, n_tokens, ids, decoded)``: ids as little-endian unsigned 32-bit bytes."""
    kind = dict(docs.dtypes)[id_column]

    def work(batches):
        bpe = vocabulary(vocab_path)
        for batch in batches:
            found = list(bpe.encode_all(batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([f[2] for f in found], pa.int64()),
                    pa.array([f[0] for f in found], pa.binary()),
                    pa.array([f[1] for f in found], pa.string()),
                ],
                names=[id_column, "n_tokens", "ids", "decoded"],
            )

    return map_batches(
        docs.select(id_column, text_column), work, f"{id_column} {kind}, n_tokens long, ids binary, decoded string"
    )


def decode_ids(df: DataFrame, vocab_path: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """``(id, text)`` from stored ids; null ids decode to an empty text."""
    kind = dict(df.dtypes)[id_column]

    def work(batches):
        bpe = vocabulary(vocab_path)
        for batch in batches:
            texts = []
            for ids in batch.column(1).to_pylist():
                row = array("I")
                row.frombytes(ids or b"")
                texts.append(bpe.decode(row))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_column, "text"])

    return map_batches(df.select(id_column, ids_column), work, f"{id_column} {kind}, text string")


def digests(docs: DataFrame, vocab_path: str, with_ids: bool = False) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``; the hashes are taken in the same pass.

    ``with_ids`` adds the ids themselves as an array.
    """
    kind = dict(docs.dtypes)["doc_id"]

    def work(batches):
        bpe = vocabulary(vocab_path)
        for batch in batches:
            rows = []
            for ids, decoded, n in bpe.encode_all(batch.column(1).to_pylist()):
                hashes = hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()
                rows.append((n, *hashes, np.frombuffer(ids, np.int32) if with_ids else None))
            n, ids, decoded, rows = zip(*rows) if rows else ((), (), (), ())
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns, names = [*columns, pa.array(rows, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_batches(
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")),
        work,
        f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids,
    )
