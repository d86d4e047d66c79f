"""Edit-aware token counts: a segment tree over each document's pre-tokens, updated by edits without encoding it again.

The byte-level vocabulary merges only inside pre-tokens, so a document's count is the sum over its pre-tokens. Leaves are
runs of pre-tokens with their characters and tokens; inner nodes hold the sums. An edit walks down by characters to the
leaf it touches, takes one leaf more as context where the pattern's look-ahead could reach back over the edge, splits the
new text from there until it meets an old leaf edge behind the edit again, encodes only that stretch, writes it into the
leaves it replaces and updates the sums on the paths above. From an edge on, the split depends on what follows alone,
which is why the rest stays valid. Leaves that have grown several times too large are cut anew.

Special-token strings in a text count as ordinary text. Trees are arrays in a table, so they can be kept and edited later.

Defined results: a null text counts as empty (0 tokens, one empty leaf); positions and lengths that reach past the text
are cut to it; a null part of an edit is 0 or empty; edits of a document apply in order of ``seq``, equal ones in order
of their parts; documents without edits keep their trees; repeated rows are edited each; an empty table gives none.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratafile.llm.tokens import vocabulary
from stratafile.llm.words import rounds

LEAF, TOO_LARGE = 64, 4  # pre-tokens per leaf; times that before a tree is cut anew
CONTEXT = 4  # characters that the pattern may look ahead over an edge, with room
CACHED = 1 << 18

EDITS = "array<struct<seq:bigint,at:bigint,cut:bigint,put:string>>"


class Counter:
    """Splits texts into pre-tokens and counts the tokens of each."""

    def __init__(self, rank_path: str, pattern: str):
        import regex
        import tiktoken

        with open(rank_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.split = regex.compile(pattern)
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, int] = {}

    def pieces(self, text: str) -> list[str]:
        return self.split.findall(text)

    def tokens(self, piece: str) -> int:
        n = self.known.get(piece)
        if n is None:
            if len(self.known) >= CACHED:
                self.known.clear()
            n = self.known[piece] = len(self.encoding._encode_single_piece(piece))
        return n

    def leaves(self, pieces: list[str], count: int | None = None) -> tuple[list[int], list[int]]:
        """Characters and tokens of leaves of LEAF pieces each, or of ``count`` leaves of about equal size."""
        known, tokens = self.known, self.tokens
        counts = [known[p] if p in known else tokens(p) for p in pieces]
        sizes = list(map(len, pieces))
        if count is None:
            edges = [*range(0, max(1, len(pieces)), LEAF), max(1, len(pieces))]
        else:
            edges = [len(pieces) * k // count for k in range(count + 1)]
        return [sum(sizes[a:b]) for a, b in zip(edges, edges[1:], strict=False)], [sum(counts[a:b]) for a, b in zip(edges, edges[1:], strict=False)]


@functools.lru_cache(maxsize=2)
def counter(rank_path: str, pattern: str) -> Counter:
    """One counter for each worker process."""
    return Counter(rank_path, pattern)


class Tree:
    """Sums of characters and tokens over leaves; nodes of a complete binary tree in two arrays."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.count = len(chars)
        self.size = 1 << max(0, (self.count - 1).bit_length())
        self.sums = np.zeros((2, 2 * self.size), np.int64)
        self.sums[0, self.size : self.size + self.count] = chars
        self.sums[1, self.size : self.size + self.count] = tokens
        width = self.size
        while width > 1:
            half = width // 2
            self.sums[:, half:width] = self.sums[:, width : 2 * width : 2] + self.sums[:, width + 1 : 2 * width : 2]
            width = half

    @property
    def chars(self) -> int:
        return int(self.sums[0, 1])

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def leaf_at(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at`` (the last leaf, if it is the text's end) and where it begins."""
        node, start = 1, 0
        while node < self.size:
            node *= 2
            left = int(self.sums[0, node])
            if at >= start + left and node + 1 < self.size * 2 and self.sums[0, node + 1] > 0:
                start += left
                node += 1
        return node - self.size, start

    def put(self, leaf: int, chars: list[int], tokens: list[int]) -> None:
        """Replaces consecutive leaves and updates the sums above them."""
        a, b = leaf + self.size, leaf + self.size + len(chars)
        self.sums[0, a:b], self.sums[1, a:b] = chars, tokens
        while a > 1:
            a, b = a // 2, (b - 1) // 2 + 1
            self.sums[:, a:b] = self.sums[:, 2 * a : 2 * b : 2] + self.sums[:, 2 * a + 1 : 2 * b : 2]

    def leaves(self) -> np.ndarray:
        return self.sums[:, self.size : self.size + self.count]


def edited(count: Counter, text: str, tree: Tree, at: int, cut: int, put: str) -> tuple[str, Tree, int]:
    """The text and tree after one edit, and how many characters were encoded for it."""
    at = min(max(at, 0), len(text))
    cut = min(max(cut, 0), len(text) - at)
    new = text[:at] + put + text[at + cut :]
    if not cut and not put:
        return text, tree, 0
    leaf, start = tree.leaf_at(at)
    while leaf and start > at - CONTEXT:  # the split before the edge may look over it
        leaf -= 1
        start -= int(tree.sums[0, tree.size + leaf])
    last, end = leaf, start  # old leaves leaf .. last - 1 are replaced
    moved = len(put) - cut
    pieces: list[str] = []
    position = start
    ahead = count.split.finditer(new, start)
    while last < tree.count:
        # the next old edge behind the edit, in places of the new text
        end += int(tree.sums[0, tree.size + last])
        last += 1
        if end < at + cut or end == tree.chars:
            continue
        while position < end + moved:
            piece = next(ahead).group()
            pieces.append(piece)
            position += len(piece)
        if position == end + moved:
            break
    if position < end + moved or last == tree.count:
        rest = [m.group() for m in ahead]
        pieces += rest
        last = tree.count
    replaced = last - leaf
    encoded = sum(map(len, pieces))
    if len(pieces) > TOO_LARGE * LEAF * replaced:
        return new, Tree(*count.leaves(count.pieces(new))), len(new)
    tree.put(leaf, *count.leaves(pieces, replaced))
    return new, tree, encoded


def _build_batches(batches: Iterator[pa.RecordBatch], paths: tuple[str, str]) -> Iterator[pa.RecordBatch]:
    count = counter(*paths)
    kind = pa.list_(pa.int64())
    for batch in rounds(batches):
        trees = [count.leaves(count.pieces(t or "")) for t in batch.column("text").to_pylist()]
        columns = [pa.array([t[k] for t in trees], kind) for k in (0, 1)]
        yield batch.append_column("leaf_chars", columns[0]).append_column("leaf_tokens", columns[1])


def build_trees(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) with the leaves of each document's tree."""
    _, *own = vocabulary()
    paths = paths or tuple(own)
    from pyspark.sql import types as T

    many = T.ArrayType(T.LongType())
    schema = T.StructType([*docs.schema.fields, T.StructField("leaf_chars", many), T.StructField("leaf_tokens", many)])
    return docs.mapInArrow(lambda batches: _build_batches(batches, paths), schema)


def with_edits(trees: DataFrame, edits: DataFrame) -> DataFrame:
    """Puts a table of edits (doc_id, seq, at, cut, put) beside the trees, as an array per document."""
    of = edits.groupBy(F.col("doc_id").alias("_of")).agg(F.sort_array(F.collect_list(F.struct("seq", "at", "cut", "put"))).alias("edits"))
    return trees.join(of, F.col("doc_id") == F.col("_of"), "left").drop("_of")


def _edit_batches(batches: Iterator[pa.RecordBatch], paths: tuple[str, str], with_text: bool) -> Iterator[pa.RecordBatch]:
    count = counter(*paths)
    for batch in rounds(batches):
        out: list[tuple] = []
        rows = (batch.column(c).to_pylist() for c in ("doc_id", "text", "leaf_chars", "leaf_tokens", "edits"))
        for doc_id, text, chars, tokens, edits in zip(*rows, strict=True):
            text, tree, encoded = text or "", Tree(chars, tokens), 0
            before = tree.tokens
            for e in edits or []:
                text, tree, n = edited(count, text, tree, e["at"] or 0, e["cut"] or 0, e["put"] or "")
                encoded += n
            leaves = tree.leaves()
            out.append((doc_id, before, tree.tokens, tree.chars, encoded, len(edits or []), leaves[0].tolist(), leaves[1].tolist(), text if with_text else None))
        kinds = [pa.int64()] * 6 + [pa.list_(pa.int64())] * 2 + [pa.string()]
        names = ["doc_id", "n_tokens_before", "n_tokens", "n_chars", "encoded_chars", "n_edits", "leaf_chars", "leaf_tokens", "text"]
        columns = list(zip(*out, strict=True)) if out else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def apply_edits(trees: DataFrame, paths: tuple[str, str] | None = None, with_text: bool = True) -> DataFrame:
    """Edited trees, texts and counts from (doc_id, text, leaf_chars, leaf_tokens, edits)."""
    _, *own = vocabulary()
    paths = paths or tuple(own)
    rows = trees.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "leaf_chars", "leaf_tokens", F.col("edits").cast(EDITS).alias("edits"))
    return rows.mapInArrow(
        lambda batches: _edit_batches(batches, paths, with_text),
        "doc_id bigint, n_tokens_before bigint, n_tokens bigint, n_chars bigint, encoded_chars bigint, n_edits bigint, "
        "leaf_chars array<bigint>, leaf_tokens array<bigint>, text string",
    )


def derived_edits(docs: DataFrame, seed: int = 42) -> DataFrame:
    """``docs`` with three edits each, made of the document itself: a cut, a word put elsewhere, and a replacement.

    Places come from hashes of doc_id, so they are the same in each run.
    """
    n = F.length(F.coalesce("text", F.lit(""))).cast("bigint")

    def place(k: int):
        return F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.lit(seed), F.lit(k)), n + 1)

    def edit(seq: int, cut: int, size: int):
        put = F.substring("text", (place(10 + seq) + 1).cast("int"), F.lit(size)) if size else F.lit("")
        return F.struct(F.lit(seq).cast("bigint").alias("seq"), place(seq).alias("at"), F.lit(cut).cast("bigint").alias("cut"), put.alias("put"))

    return docs.withColumn("edits", F.array(edit(0, 25, 0), edit(1, 0, 40), edit(2, 12, 12)).cast(EDITS))


def token_count_report(docs: DataFrame) -> DataFrame:
    """The query's columns: the counts of every document before and after its edits, and what was encoded for them."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    df = apply_edits(build_trees(derived_edits(rows)), with_text=False)
    return df.select("doc_id", "n_tokens_before", "n_tokens", "n_chars", "encoded_chars", "n_edits")
