"""BPE, token counts and token files against the public libraries."""

import hashlib
import random
import zlib
from array import array

import public_tokenizers as P
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from payloom.llm import bpe, token_counts, token_files

WORD, BYTE, PIECE = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(WORD)


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_bpe_equals_the_library(messy, word_library):
    want = []
    for r in messy.collect():
        ids = word_library.encode(r.text or "", add_special_tokens=False).ids
        decoded = word_library.decode(ids, skip_special_tokens=False)
        want.append((r.doc_id, len(ids), sha(array("I", ids).tobytes()), sha(decoded.encode())))
    assert sorted(map(tuple, bpe.digests(messy, WORD).collect()), key=repr) == sorted(want, key=repr)
    with_ids = bpe.digests(messy, WORD, with_ids=True).collect()
    assert all(sha(array("I", r.ids).tobytes()) == r.ids_sha256 and len(r.ids) == r.n_tokens for r in with_ids)


def test_bpe_round_trip_of_stored_ids(messy, none, word_library):
    stored = bpe.encode_texts(messy, WORD)
    decoded = {(r.doc_id, r.text) for r in bpe.decode_ids(stored, WORD).collect()}
    assert decoded == {(r.doc_id, r.decoded) for r in stored.collect()}
    assert bpe.digests(none, WORD).collect() == [] and bpe.decode_ids(bpe.encode_texts(none, WORD), WORD).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cn", "Cs"]), max_size=40))
def test_bpe_on_any_text(text):
    """Of all assigned characters; the library's tables know none that came later."""
    library = Tokenizer.from_file(WORD) if not hasattr(test_bpe_on_any_text, "t") else test_bpe_on_any_text.t
    test_bpe_on_any_text.t = library
    ids, decoded, n = bpe.vocabulary(WORD).encode(text)
    want = library.encode(text, add_special_tokens=False).ids
    assert (array("I", want).tobytes(), len(want)) == (ids, n)
    assert decoded == library.decode(want, skip_special_tokens=False)


def test_segment_tree_merges_like_a_plain_search():
    model = bpe.Bpe(WORD)

    def plain(ids):
        ids = list(ids)
        while True:
            ranks = [(model.merges[k][0], i) for i, k in enumerate((a << 32) | b for a, b in zip(ids, ids[1:])) if k in model.merges]
            if not ranks:
                return ids
            _, i = min(ranks)
            ids[i : i + 2] = [model.merges[(ids[i] << 32) | ids[i + 1]][1]]

    for word in ("aaaaaaaaaaa", "thethethe", "inininin", "antidisestablishmentarianism", "a", "zz"):
        ids = [model.inner[b] for b in word.encode()]
        assert model.merge(list(ids)) == plain(ids)

    rng = random.Random(3)
    for most in (1, 2, 3, 5, 9, 17, 64):
        words = ["".join(rng.choices("theinagrsé", k=rng.randint(1, most))).encode() for _ in range(60)]
        want = [plain([*(model.inner[b] for b in w[:-1]), model.last[w[-1]]]) for w in words]
        assert model.merge_rows(words) == want


def test_counts_equal_the_library(messy, none):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    want = []
    for r in messy.collect():
        n = len(model.encode(r.text or ""))
        want.append((r.doc_id, len((r.text or "").encode()), n, n > 50))
    for head in (4, 1 << 21):  # with and without pre-tokens that are joined
        got = token_counts.count_tokens(messy, PIECE, limit=50, head=head)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert token_counts.count_tokens(none, PIECE).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(" \n\t▁ab.é日<>0xA"), max_size=30))
def test_counts_on_any_text(text):
    pieces = token_counts.pieces_of(PIECE)
    assert sum(pieces.count(pieces.pretokens(text))) == len(pieces.model.encode(text))


def test_files_hold_the_library_ids(messy, none):
    library = Tokenizer.from_file(BYTE)
    rows = messy.where("doc_id is not null").dropDuplicates(["doc_id"]).select("doc_id", "text", "h")
    manifest = token_files.write(rows, BYTE, sequence=16)
    want, start, joined = [], 0, []
    for r in sorted(rows.collect(), key=lambda r: r.doc_id):
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [0]
        want.append((r.doc_id, start, len(ids), zlib.crc32(array("I", ids).tobytes())))
        start += len(ids)
        joined += ids
    assert sorted(map(tuple, token_files.read(manifest, "bigint").collect())) == want
    # random access: sequences and masks of every file give all ids in order
    found = []
    for part in sorted(manifest.collect(), key=lambda r: r.shard):
        file = token_files.TokenFile(part.folder, part.path)
        n = -(-part.n_tokens // 16)
        for i in range(n):
            ids, mask = file.sequence(i)
            assert len(ids) == len(mask) == 16 and mask[: mask.sum()].all()
            found += list(ids[mask])
    assert found == joined
    assert token_files.read(token_files.write(none, BYTE), "bigint").collect() == []
    every = token_files.read(token_files.write(messy, BYTE), "bigint").collect()
    assert len(every) == messy.count() and sum(r.n_tokens for r in every) == max(r.start + r.n_tokens for r in every)
