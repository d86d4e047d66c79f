"""Cost-balanced packing of documents into token sequences.

The cost of a sequence is estimated as linear in its tokens plus the square of each piece's length (attention within a
document). A task packs the documents it reads in blocks of a bounded number of tokens, without any shuffle: whole
sequences are cut off long documents, and what remains is assigned in descending length to the sequence of lowest cost
that has room for it. When none has room, the piece is cut and fills the emptiest one, so that every sequence ends full.
A block's last tokens, fewer than one sequence, go to sequences whose sizes are powers of two, which need no padding.

The sequence id is made of the task's partition, its block and the sequence's number there. A task that is run again
reads the same rows and gives the same sequences.

Defined results: a null text is empty and packs as its end token alone; repeated rows are packed each; an empty table
gives none; a very long document is cut into whole sequences and one rest.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from stratafile.llm.tokens import encoder, vocabulary
from stratafile.llm.words import rounds

LENGTH = 1024
BLOCK_TOKENS = 1 << 21
END = 0
PARTITION_SHIFT, BLOCK_SHIFT = 40, 22  # sequences of a block < 2**22, blocks of a partition < 2**18

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
    ]
)


def cost(length: int, linear: float = 1.0, quadratic: float = 1.0 / LENGTH) -> float:
    """Estimated cost of a piece: matrix work by token, attention by token pair."""
    return linear * length + quadratic * length * length


def room_sizes(tokens: int, length: int = LENGTH) -> list[int]:
    """Sequence sizes that hold the tokens exactly: whole ones, then powers of two for the rest."""
    rest = tokens % length
    return [length] * (tokens // length) + [1 << b for b in range(length.bit_length(), -1, -1) if rest >> b & 1]


class Open:
    """Open sequences by room left. Finds the one of lowest cost with at least a given room in O(log length)."""

    def __init__(self, sizes: list[int], length: int):
        self.n = 1 << length.bit_length()
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(self.n)]
        self.tree: list[tuple[float, int, int] | None] = [None] * (2 * self.n)
        self.room, self.used, self.cost = list(sizes), [0] * len(sizes), [0.0] * len(sizes)
        for k, size in enumerate(sizes):
            self.heaps[size].append((0.0, k))
        for size in range(self.n):
            heapq.heapify(self.heaps[size])
        for size in range(self.n):
            if self.heaps[size]:
                self._lift(size)

    def _lift(self, size: int) -> None:
        i = size + self.n
        self.tree[i] = (*self.heaps[size][0], size) if self.heaps[size] else None
        i >>= 1
        while i:
            a, b = self.tree[2 * i], self.tree[2 * i + 1]
            self.tree[i] = a if b is None or (a is not None and a <= b) else b
            i >>= 1

    def cheapest(self, least: int) -> int | None:
        best, lo, hi = None, least + self.n, 2 * self.n
        while lo < hi:
            if lo & 1:
                x = self.tree[lo]
                best = x if best is None or (x is not None and x < best) else best
                lo += 1
            if hi & 1:
                hi -= 1
                x = self.tree[hi]
                best = x if best is None or (x is not None and x < best) else best
            lo, hi = lo >> 1, hi >> 1
        return None if best is None else best[1]

    def roomiest(self) -> int:
        for size in range(self.n - 1, 0, -1):
            if self.heaps[size]:
                return self.heaps[size][0][1]
        raise ValueError("no sequence has room")

    def put(self, k: int, length: int) -> int:
        """Puts a piece into sequence k; its offset there."""
        size, offset = self.room[k], self.used[k]
        heapq.heappop(self.heaps[size])  # both ways of finding k give the head of its heap
        self._lift(size)
        self.room[k] -= length
        self.used[k] += length
        self.cost[k] += cost(length)
        if self.room[k]:
            heapq.heappush(self.heaps[self.room[k]], (self.cost[k], k))
            self._lift(self.room[k])
        return offset


def pack(lengths: list[int], length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) that pack documents of these token counts."""
    pieces: list[tuple[int, int, int, int, int]] = []
    queue: list[tuple[int, int, int]] = []  # (-length, document, start)
    for doc, n in enumerate(lengths):
        whole = n // length
        pieces += [(doc, i * length, length, len(pieces) + i, 0) for i in range(whole)]
        if n % length:
            queue.append((-(n % length), doc, whole * length))
    first, rest = len(pieces), -sum(q[0] for q in queue)
    heapq.heapify(queue)
    sequences = Open(room_sizes(rest, length), length)
    while queue:
        negative, doc, start = heapq.heappop(queue)
        n = -negative
        k = sequences.cheapest(n)
        if k is None:
            k = sequences.roomiest()
            n = sequences.room[k]
            heapq.heappush(queue, (negative + n, doc, start + n))
        pieces.append((doc, start, n, first + k, sequences.put(k, n)))
    return pieces


def _pack_batches(batches: Iterator[pa.RecordBatch], paths: tuple[str, str, str], length: int, block_tokens: int, with_ids: bool):
    encode = encoder(paths).ids
    partition = TaskContext.get().partitionId()
    names = [f.name for f in SCHEMA.fields] + ["ids"] * with_ids
    types = [pa.int64()] * len(SCHEMA.fields) + [pa.list_(pa.int32())] * with_ids
    docs: list[tuple[int | None, np.ndarray]] = []
    held = block = 0

    def flush():
        nonlocal block
        base = (partition << PARTITION_SHIFT) | (block << BLOCK_SHIFT)
        rows = []
        for doc, start, n, sequence, offset in pack([len(ids) for _, ids in docs], length):
            doc_id, ids = docs[doc]
            part = ids[start : start + n]
            row = (doc_id, start, n, zlib.crc32(part.astype("<u4").tobytes()), len(ids), base + sequence, offset)
            rows.append((*row, part.astype(np.int32)) if with_ids else row)
        block += 1
        for at in range(0, len(rows), 20_000):
            columns = list(zip(*rows[at : at + 20_000], strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    for batch in rounds(batches):
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            ids = np.append(encode(text) if text else np.zeros(0, np.uint32), np.uint32(END))
            docs.append((doc_id, ids))
            held += len(ids)
            if held >= block_tokens:
                yield from flush()
                docs, held = [], 0
    if docs:
        yield from flush()


def pack_documents(
    docs: DataFrame, paths: tuple[str, str, str] | None = None, length: int = LENGTH, block_tokens: int = BLOCK_TOKENS,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece, with its token ids unless ``with_ids`` is off. ``length`` is a power of two."""
    paths = paths or vocabulary()
    schema = T.StructType([*SCHEMA.fields, *([T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids)])
    rows = docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    return rows.mapInArrow(lambda batches: _pack_batches(batches, paths, length, block_tokens, with_ids), schema)


def packing_report(docs: DataFrame) -> DataFrame:
    """The query's columns."""
    return pack_documents(docs, with_ids=False)
