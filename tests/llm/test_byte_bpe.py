"""Byte-level BPE against tiktoken, its decoding against the text's own bytes."""

import base64
import hashlib
import random

import helpers as H
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from stratafile.llm import byte_bpe as B
from stratafile.llm.tokens import vocabulary


@pytest.fixture(scope="module", params=["byte_bpe_50k", "byte_bpe_multi_50k"])
def both(request):
    path = public_tokenizers.path(f"{request.param}.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return B.codec(path, public_tokenizers.PATTERN), library.encode_ordinary


AWKWARD = ["", " ", "  a", "a  ", "\n\n\t x", "it's we'll 'l 'll ''' 'r", "\x00\x01", " x \u0085", "<|endoftext|>", "\U0001f600" * 9, "é" * 50, "12 345  6", "é", "ﬁ ﬀ", "ß" * 7 + "'s"]


def test_equals_the_library_on_awkward_texts(both):
    own, library = both
    for text in AWKWARD:
        assert own.encode(text) == library(text), text
        assert own.decode(own.encode(text)) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text("abcde '\n", max_size=80) | st.text("aeinrst", max_size=60) | st.text("=- \t#*", max_size=90))
def test_equals_the_library(text):
    path = vocabulary()[1]
    own = B.codec(path, public_tokenizers.PATTERN)
    assert own.encode(text) == _library(path)(text)


_kept = {}


def _library(path):
    if path not in _kept:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _kept[path] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return _kept[path]


def test_any_segment_size_gives_the_same_ids(both, monkeypatch):
    own, library = both
    rng = random.Random(3)
    text = "".join(rng.choice(["we'll ", "  ", "\n \n", "x" * 40, "12", "'", "l", "été ", "....", "\U0001f600"]) for _ in range(400))
    for size in (8, 9, 17, 64, 1 << 16):
        monkeypatch.setattr(B, "SEGMENT", size)
        assert own.encode(text) == library(text)


def test_long_pieces_take_linear_work(both):
    """Letters without a blank are one piece; every place is left a bounded number of times."""
    own, library = both
    rng = random.Random(5)

    class Counting(dict):
        looked = 0

        def get(self, key):
            Counting.looked += 1
            return super().get(key)

    kept, own.pairs = own.pairs, Counting(own.pairs)
    try:
        for alphabet in ("ab", "abcdefghijklmnopqrstuvwxyz", "é一x"):
            text = "".join(rng.choice(alphabet) for _ in range(30_000))
            Counting.looked = 0
            assert own.encode(text) == library(text)
            assert 0 < Counting.looked < 20 * len(text.encode())
        text = "a" * 50_000 + " " * 50_000
        assert own.encode(text) == library(text)
    finally:
        own.pairs = kept


def test_bounded_memory_of_pieces(both, monkeypatch):
    own, library = both
    monkeypatch.setattr(B, "MOST_PIECES", 10)
    monkeypatch.setattr(B, "MOST_PAIRS", 10)
    own.pieces.clear()
    own.pairs.clear()
    text = " ".join(f"zq{i}xv" for i in range(200))
    assert own.encode(text) == library(text)
    assert len(own.pieces) <= 10 and len(own.pairs) <= 10


def test_a_vocabulary_without_a_byte_is_refused():
    with pytest.raises(ValueError):
        B.Codec({b"a": 0}, public_tokenizers.PATTERN)


def expected(text):
    ids, raw = _library(vocabulary()[1])(text or ""), (text or "").encode()
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(raw).hexdigest()


def test_report_rows(spark, docs, rows, no_docs):
    got = H.counted(B.byte_bpe_report(docs).collect())
    assert got == H.counted((r[0], *expected(r[1])) for r in rows)
    assert B.byte_bpe_report(no_docs).collect() == []


def test_encoded_and_decoded_keep_other_columns(spark, docs, rows):
    there = docs.withColumnRenamed("source", "ids")  # a clashing name is replaced
    ids = B.encoded(there)
    assert ids.columns == ["doc_id", "text", "lang", "n_chars", "ids"]
    back = B.decoded(ids).collect()
    assert H.counted((r.doc_id, r.lang, bytes(r.bytes)) for r in back) == H.counted((r[0], r[2], (r[1] or "").encode()) for r in rows)
    assert all(r.ids == _library(vocabulary()[1])(r.text or "") for r in back)
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert B.decoded(nothing).first().bytes is None
