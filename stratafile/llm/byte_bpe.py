"""Byte-level BPE, encoding and decoding, in time linear in the text.

The merges of byte-pair encoding are not replayed. A token sequence is what the merges give exactly if each two adjacent
tokens are: if the merges, run over the bytes of the pair alone, end in those two tokens. So a piece (one match of the
splitting pattern) is encoded from left to right:

1. Its bytes are read as Latin-1 characters, so that pyahocorasick, which knows characters only, can hold all tokens. Its
   trie says how far a place's characters run along some token; the longest token within that run is known beforehand.
2. The longest token is tried first, then its prefixes. A token is taken if it stands after the one before (whether two
   tokens are compatible is worked out once and remembered) and doesn't end at a place known to be dead.
3. If none is left, the place is dead, and the token before it gives way to its next shorter prefix. A prefix of the text
   has one encoding only, so a dead place stays dead and every place is left at most once: the work is linear.

A piece that is a token as a whole is that token. Pieces of up to ``SHORT`` characters are remembered, ``MOST_PIECES`` at
a time. Texts are cut into pieces by segments, so beside a text itself only a segment and its ids are held, whatever the
text's length; a piece longer than a segment (a million letters without a blank) takes memory in proportion to itself.

Defined results: a null text is empty, an empty text has no ids and the digests of the empty string; repeated rows give
repeated rows; an empty table gives none; a null doc_id stays null. Literals of special tokens are ordinary text.
Other columns are not read by :func:`byte_bpe_report`; :func:`encoded` and :func:`decoded` keep them and replace a column
of the name they write.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame

from stratafile.llm.tokens import DEFAULT, vocabulary
from stratafile.llm.words import rounds

#: Characters that are split at once, and what of a segment's end is split again with the next one: a match is settled if
#: it ends so far before the end that neither its own rest nor what it looks ahead to is cut off.
SEGMENT, UNSETTLED = 1 << 16, 4
SHORT, MOST_PIECES, MOST_PAIRS = 64, 1 << 18, 1 << 20


class _Pieces(dict):
    """Ids of pieces seen before, bounded: a full table becomes the old one, from which pieces in use come back."""

    def __init__(self, encode):
        self.encode, self.old = encode, {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.old.get(piece)
        if ids is None:
            ids = tuple(self.encode(piece.encode()))
        if len(piece) <= SHORT:
            if len(self) >= MOST_PIECES:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Codec:
    """Encoder and decoder for the ranks (bytes of a token -> id) and the pattern that splits a text into pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        if not all(bytes([b]) in ranks for b in range(256)):
            raise ValueError("the vocabulary must hold every single byte")
        self.ranks = ranks
        self.bytes_of = {i: token for token, i in ranks.items()}
        self.size = {i: len(token) for token, i in ranks.items()}
        self.reach, self.span = max(self.size.values()), max(self.size) + 1
        self.pattern = regex.compile(pattern)
        self.trie = ahocorasick.Automaton()
        self.within: dict[str, int] = {}  # the longest token within each run along a token
        self.shorter: dict[int, int | None] = {}  # the longest token that a token begins with
        for token, i in sorted(ranks.items()):  # what a token begins with comes before it
            run = token.decode("latin-1")
            self.trie.add_word(run, i)
            best = None
            for n in range(1, len(run)):
                best = self.within.setdefault(run[:n], best)
            self.shorter[i] = best
            self.within[run] = i
        self.pairs: dict[int, bool] = {}
        self.pieces = _Pieces(self.piece)

    def merged(self, data: bytes) -> list[int]:
        """The merges replayed: of all adjacent parts whose union is a token, the one of lowest rank is joined, the
        leftmost first. Only pairs of tokens come here."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, len(self.ranks)), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == len(self.ranks):
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def compatible(self, a: int, b: int) -> bool:
        """Do the merges leave these two tokens as they are? Worked out once for each pair."""
        if len(self.pairs) >= MOST_PAIRS:
            self.pairs.clear()
        known = self.pairs[a * self.span + b] = self.merged(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return known

    def piece(self, data: bytes) -> Iterable[int]:
        """Ids of one piece."""
        whole = self.ranks.get(data)
        if whole is not None or not data:
            return (whole,) if data else ()
        size, shorter, within, pairs, span, reach = self.size, self.shorter, self.within, self.pairs, self.span, self.reach
        follow, text, n = self.trie.longest_prefix, data.decode("latin-1"), len(data)
        path, dead, at = [], set(), 0
        token = within[text[: follow(text[:reach])]]
        while True:
            end = at + size[token]
            fits = end not in dead
            if fits and path:
                fits = pairs.get(path[-1] * span + token)
                if fits is None:
                    fits = self.compatible(path[-1], token)
            if fits:
                path.append(token)
                if end == n:
                    return path
                at = end
                run = text[at : at + reach]
                token = within[run[: follow(run)]]
            else:
                token = shorter[token]
                if token is None:
                    dead.add(at)
                    token = path.pop()
                    at -= size[token]

    def segments(self, text: str) -> Iterator[list[str]]:
        """The pieces of a text, a segment's settled ones at a time. Pieces cover the text without a gap."""
        at, step = 0, SEGMENT
        while at < len(text):
            to = min(len(text), at + step)
            found = self.pattern.findall(text, at, to)
            if to < len(text):
                end = to
                while found and end > to - UNSETTLED:
                    end -= len(found.pop())
                if not found:  # a piece as long as the segment
                    step *= 2
                    continue
                to = end
            yield found
            at, step = to, SEGMENT

    def ids(self, text: str) -> Iterator[list[int]]:
        for found in self.segments(text):
            yield list(chain.from_iterable(map(self.pieces.__getitem__, found)))

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(self.ids(text)))

    def decode(self, ids: Iterable[int]) -> bytes:
        """Bytes of any sequence of ids; an id that the vocabulary lacks is a KeyError."""
        return b"".join(map(self.bytes_of.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def codec(rank_path: str, pattern: str) -> Codec:
    """One codec for each worker process."""
    with open(rank_path, "rb") as lines:
        return Codec({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}, pattern)


def _replaced(df: DataFrame, column: str, kind: str) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != column), f"`{column}` {kind}"])


def encoded(docs: DataFrame, name: str = DEFAULT, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with a column of token ids, array<int>."""
    _, rank_path, pattern = vocabulary(name)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(rank_path, pattern)
        for batch in rounds(batches, text):
            made = pa.array([own.encode(t or "") for t in batch.column(text).to_pylist()], pa.list_(pa.int32()))
            kept = [n for n in batch.schema.names if n != ids]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), made], [*kept, ids])

    return docs.mapInArrow(encode, _replaced(docs, ids, "array<int>"))


def decoded(df: DataFrame, name: str = DEFAULT, ids: str = "ids", out: str = "bytes") -> DataFrame:
    """``df`` with the bytes that its ids stand for (null ids: null)."""
    _, rank_path, pattern = vocabulary(name)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(rank_path, pattern)
        for batch in batches:
            made = pa.array([None if row is None else own.decode(row) for row in batch.column(ids).to_pylist()], pa.binary())
            kept = [n for n in batch.schema.names if n != out]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), made], [*kept, out])

    return df.mapInArrow(decode, _replaced(df, out, "binary"))


def digests(own: Codec, text: str) -> tuple[int, str, str]:
    """Number of ids, digest of the ids as decimals joined by a blank, digest of the decoded bytes, by segments."""
    n, of_ids, of_bytes = 0, hashlib.sha256(), hashlib.sha256()
    for ids in own.ids(text):
        if ids:
            of_ids.update((" " if n else "").encode() + " ".join(map(str, ids)).encode())
            of_bytes.update(own.decode(ids))
            n += len(ids)
    return n, of_ids.hexdigest(), of_bytes.hexdigest()


def byte_bpe_report(docs: DataFrame, name: str = DEFAULT) -> DataFrame:
    """The query's columns, one row per document, in one pass without a shuffle."""
    _, rank_path, pattern = vocabulary(name)

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(rank_path, pattern)
        for batch in rounds(batches):
            rows = [digests(own, t or "") for t in batch.column("text").to_pylist()]
            n, of_ids, of_bytes = zip(*rows, strict=True) if rows else ((), (), ())
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    return rows.mapInArrow(report, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
