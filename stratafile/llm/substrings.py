"""Exact repeated substrings by fixed-block anchors: which words lie in a 20-word window that also starts earlier?

Every text is cut into blocks of 10 words, not overlapping: the index. Every rolling window of 10 words probes it. Two
equal 20-word windows always share such an anchor, because each holds a whole block; so only windows around a hit can
repeat. These are extended to 20 words, compared by their hashes, and the repeats that touch or overlap make up the
maximal repeat. The window that starts first (by doc_id, then position) stays, all others go.

How it is spread: texts are cut into chunks of bounded bytes and kept as a table bucketed by chunk, so the three passes
over the texts need no shuffle of them. Between the passes only sorted, distinct, delta-coded hashes travel, dealt by
hash range: a chunk sends a hash once however often it holds it, so a passage in a third of all documents is one entry a
chunk. Index and probes use hashes of log2(words) + 12 bits (a false hit costs one window more to extend); the windows
themselves are compared by 64 bits.

Defined results: null or empty text has no words and stays as it is; a text of fewer than 20 words stays; a null doc_id
counts as the smallest; of rows with the same doc_id those stored in an earlier chunk, then earlier in it, come first;
an empty table gives an empty result. Other columns are kept. A text that loses words becomes its kept words joined by
one space, any other stays unchanged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratafile.llm.quality_rules import free_name
from stratafile.llm.tables import bucketed, stored, total_bytes
from stratafile.llm.words import U64, Words, rounds, windows, words_of

WINDOW, BLOCK = 20, 10  # 2 * BLOCK - 1 <= WINDOW: a window holds a whole block
#: A word and its blank, about; bytes of a chunk at least and at most; hashes that a chunk sends to a range at least.
WORD_BYTES, CHUNK_BYTES, MOST_CHUNK_BYTES, ROW_HASHES, LEAST_RANGES = 6, 4 << 20, 256 << 20, 1000, 256
NO_ID = -(1 << 63)

HASHES = T.StructType([T.StructField("range", T.LongType()), T.StructField("chunk", T.LongType()), T.StructField("hashes", T.BinaryType()), T.StructField("extra", T.BinaryType())])
REPLY = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("hashes", T.BinaryType())])


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending 64-bit values as the first and the gaps, each in as many bytes as the largest gap needs."""
    gaps = np.diff(values)
    width = max(1, (int(gaps.max()).bit_length() + 7) // 8) if len(gaps) else 1
    planes = gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + int(values[0]).to_bytes(8, "little") + planes.tobytes()


def unpack_sorted(blob: bytes) -> np.ndarray:
    width, first = blob[0], int.from_bytes(blob[1:9], "little")
    raw = np.frombuffer(blob, np.uint8, offset=9).reshape(-1, width)
    gaps = np.zeros((len(raw) + 1, 8), np.uint8)
    gaps[1:, :width] = raw
    gaps = gaps.reshape(-1).view("<u8").astype(U64)
    gaps[0] = first
    return np.cumsum(gaps, dtype=U64)


def ranges_of(values: np.ndarray, bits: int, ranges: int) -> Iterator[tuple[int, int, int]]:
    """Slices of ascending values by equal ranges of their bits: (range, from, to)."""
    edges = np.array([(k << bits) // ranges for k in range(1, ranges)], U64)
    cuts = [0, *np.searchsorted(values, edges).tolist(), len(values)]
    return ((k, a, b) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a)


def in_sorted(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(wanted) or not len(values):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(wanted, values), len(wanted) - 1)
    return wanted[at] == values


def within(words: Words, k: int) -> np.ndarray:
    """Which windows of k words lie in one text."""
    n = max(0, len(words.starts) - k + 1)
    room = np.repeat(words.first[1:], words.counts)[:n] - np.arange(n)
    return room >= k


def _ordered(table: pa.Table, doc_id: str, text: str) -> tuple[pa.Table, np.ndarray, Words]:
    """The chunk's rows in the order of doc_id (null first), the ids, and the words."""
    ids = pc.fill_null(table.column(doc_id).cast(pa.int64()), NO_ID).combine_chunks().to_numpy(zero_copy_only=False)
    order = np.argsort(ids, kind="stable")
    table = table.take(pa.array(order))
    return table, ids[order], words_of(table.column(text).combine_chunks())


def _batch(rows: list[tuple], schema: T.StructType) -> pa.Table:
    kinds = {"bigint": pa.int64(), "binary": pa.binary()}
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    fields = [(f.name, kinds[f.dataType.simpleString()]) for f in schema.fields]
    return pa.table([pa.array(c, k) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def anchors(words: Words, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all rolling windows of BLOCK words, which of them lie in one text, and which are blocks."""
    hashes = windows(words.hashes, BLOCK) >> U64(64 - bits)
    inside = within(words, BLOCK)
    place = np.arange(len(hashes)) - np.repeat(words.first[:-1], words.counts)[: len(hashes)]
    return hashes, inside, place % BLOCK == 0


def probes(chunk: int, words: Words, bits: int, ranges: int) -> list[tuple]:
    """The chunk's distinct anchors by range; the extra bits tell which are blocks of the index."""
    hashes, inside, blocks = anchors(words, bits)
    keys = np.sort((hashes[inside] << U64(1)) | blocks[inside].astype(U64))
    values = keys >> U64(1)
    last = np.append(values[1:] != values[:-1], True) if len(values) else np.zeros(0, bool)
    values, block = values[last], (keys[last] & U64(1)).astype(bool)
    return [(k, chunk, pack_sorted(values[a:b]), np.packbits(block[a:b]).tobytes()) for k, a, b in ranges_of(values, bits, ranges)]


def _entries(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[bytes], list[int]]:
    lists = [unpack_sorted(b) for b in table.column("hashes").to_pylist()]
    sizes = [len(x) for x in lists]
    chunks = np.repeat(np.array(table.column("chunk").to_pylist(), np.int64), sizes)
    return np.concatenate(lists), chunks, table.column("extra").to_pylist(), sizes


def _replies(values: np.ndarray, chunks: np.ndarray) -> pa.Table:
    if not len(values):
        return _batch([], REPLY)
    order = np.lexsort((values, chunks))
    values, chunks = values[order], chunks[order]
    own, starts = np.unique(chunks, return_index=True)
    ends = np.append(starts[1:], len(chunks))
    return _batch([(int(c), pack_sorted(values[a:b])) for c, a, b in zip(own, starts, ends, strict=True)], REPLY)


def match_anchors(table: pa.Table) -> pa.Table:
    """One range of anchors: those in two chunks or more, a block in one at least, are reported to each of them."""
    values, chunks, extra, sizes = _entries(table)
    block = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(extra, sizes, strict=True)])
    order = np.argsort(values, kind="stable")
    values, chunks, block = values[order], chunks[order], block[order]
    starts = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    sizes_of = np.diff(np.append(starts, len(values)))
    hit = (sizes_of > 1) & (np.maximum.reduceat(block, starts) > 0)
    keep = np.repeat(hit, sizes_of)
    return _replies(values[keep], chunks[keep])


def extended(chunk: int, ids: np.ndarray, words: Words, wanted: np.ndarray, bits: int, ranges: int) -> list[tuple]:
    """The 20-word windows around anchors that hit: distinct hashes, each with the smallest doc_id that has it."""
    n = max(0, len(words.starts) - WINDOW + 1)
    if not n or not len(wanted):
        return []
    hashes, inside, _ = anchors(words, bits)
    hits = np.concatenate([[0], np.cumsum(in_sorted(hashes, wanted) & inside)])
    around = hits[WINDOW - BLOCK + 1 :][:n] > hits[:n]
    at = np.flatnonzero(around & within(words, WINDOW))
    values, first = np.unique(windows(words.hashes, WINDOW)[at], return_index=True)
    docs = ids[words.doc_of_word()[at[first]]]
    rows = []
    for k, a, b in ranges_of(values, 64, ranges):
        own, code = np.unique(docs[a:b], return_inverse=True)
        code = code.astype("<u2" if len(own) <= 1 << 16 else "<u4")
        extra = len(own).to_bytes(4, "little") + own.astype("<i8").tobytes() + code.tobytes()
        rows.append((k, chunk, pack_sorted(values[a:b]), extra))
    return rows


def match_windows(table: pa.Table) -> pa.Table:
    """One range of windows: each chunk but the one that holds the first start learns that an earlier one exists."""
    values, chunks, extra, sizes = _entries(table)
    docs = []
    for blob, n in zip(extra, sizes, strict=True):
        own = int.from_bytes(blob[:4], "little")
        code = np.frombuffer(blob, "<u2" if own <= 1 << 16 else "<u4", count=n, offset=4 + 8 * own)
        docs.append(np.frombuffer(blob, "<i8", count=own, offset=4)[code])
    order = np.lexsort((chunks, np.concatenate(docs), values))
    values, chunks = values[order], chunks[order]
    later = np.append(False, values[1:] == values[:-1])
    return _replies(values[later], chunks[later])


def removed_words(words: Words, earlier: np.ndarray) -> np.ndarray:
    """Which words lie in a window that also starts earlier, in another chunk (``earlier``) or in this one."""
    n = len(words.starts)
    if n < WINDOW:
        return np.zeros(n, bool)
    hashes, at = windows(words.hashes, WINDOW), np.flatnonzero(within(words, WINDOW))
    own = hashes[at]
    order = np.argsort(own, kind="stable")
    again = np.zeros(len(own), bool)
    ranked = own[order]
    again[order[1:]] = ranked[1:] == ranked[:-1]
    starts = at[again | in_sorted(own, earlier)]
    depth = np.zeros(n + 1, np.int64)
    depth[starts] += 1
    np.subtract.at(depth, starts + WINDOW, 1)
    return np.cumsum(depth[:-1]) > 0


def _wanted(reply: pa.Table) -> np.ndarray:
    lists = [unpack_sorted(b) for b in reply.column("hashes").to_pylist()]
    return np.unique(np.concatenate(lists)) if lists else np.zeros(0, U64)


def plan_numbers(size: int) -> tuple[int, int, int]:
    """Bytes of a chunk, ranges, and bits of a hash, for so many bytes of text."""
    words = size // WORD_BYTES
    ranges = max(LEAST_RANGES, math.isqrt(words // ROW_HASHES))
    chunk_bytes = min(MOST_CHUNK_BYTES, max(CHUNK_BYTES, ranges * ROW_HASHES * WORD_BYTES))
    return chunk_bytes, ranges, min(62, max(24, math.ceil(math.log2(size + 2)) + 10))


def chunked(docs: DataFrame, text: str, chunk: str, chunk_bytes: int, buckets: int) -> DataFrame:
    """The rows with the number of their chunk, as a table bucketed by it. Chunks follow the input's partitions."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = TaskContext.get().partitionId() << 32, 0
        for batch in rounds(batches, text, chunk_bytes):
            own = pc.sum(pc.binary_length(batch.column(text))).as_py() or 0
            if held and held + own > chunk_bytes:
                now, held = now + 1, 0
            held += own
            yield batch.append_column(chunk, pa.array(np.full(len(batch), now, np.int64)))

    schema = T.StructType([*docs.schema.fields, T.StructField(chunk, T.LongType())])
    return bucketed(docs.mapInArrow(number, schema), "chunks", chunk, buckets)


def dedup_substrings(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", chunk_bytes: int | None = None
) -> tuple[DataFrame, str, str]:
    """The documents without their repeated words, and the names of two added columns: words before, words removed."""
    spark = docs.sparkSession
    size = total_bytes(docs, text)
    planned, ranges, bits = plan_numbers(size)
    chunk_bytes = chunk_bytes or planned
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // chunk_bytes + 1)
    chunk, before, gone = free_name(docs, "_chunk"), free_name(docs, "_n_words"), free_name(docs, "_n_removed")
    texts = chunked(docs, text, chunk, chunk_bytes, buckets)
    ids = texts.select(doc_id, text, chunk)

    def probe(key: tuple, rows: pa.Table) -> pa.Table:
        return _batch(probes(key[0].as_py(), words_of(rows.column(text).combine_chunks()), bits, ranges), HASHES)

    def extend(key: tuple, rows: pa.Table, reply: pa.Table) -> pa.Table:
        if not len(rows) or not len(reply):
            return _batch([], HASHES)
        _, own, words = _ordered(rows, doc_id, text)
        return _batch(extended(key[0].as_py(), own, words, _wanted(reply), bits, ranges), HASHES)

    def cut(key: tuple, rows: pa.Table, reply: pa.Table) -> pa.Table:
        rows, _, words = _ordered(rows, doc_id, text)
        removed = removed_words(words, _wanted(reply))
        sums = np.concatenate([[0], np.cumsum(removed)])
        lost = sums[words.first[1:]] - sums[words.first[:-1]]
        texts_out = rows.column(text).combine_chunks()
        if lost.any():
            out = texts_out.to_pylist()
            for i in np.flatnonzero(lost):
                kept = ~removed[words.first[i] : words.first[i + 1]]
                own = out[i].encode().split()  # bytes split at the same six characters
                out[i] = b" ".join([w for w, k in zip(own, kept.tolist(), strict=True) if k]).decode()
            texts_out = pa.array(out, texts_out.type)
        rows = rows.set_column(rows.schema.get_field_index(text), rows.schema.field(text), texts_out).drop_columns([chunk])
        return rows.append_column(before, pa.array(words.counts.astype(np.int64))).append_column(gone, pa.array(lost.astype(np.int64)))

    hits = ids.groupBy(chunk).applyInArrow(probe, HASHES).groupBy("range").applyInArrow(match_anchors, REPLY)
    found = ids.groupBy(chunk).cogroup(hits.groupBy("chunk")).applyInArrow(extend, HASHES)
    replies = stored(found.groupBy("range").applyInArrow(match_windows, REPLY), "repeats")
    schema = T.StructType([*docs.schema.fields, T.StructField(before, T.LongType()), T.StructField(gone, T.LongType())])
    return texts.groupBy(chunk).cogroup(replies.groupBy("chunk")).applyInArrow(cut, schema), before, gone


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents with their columns; repeated words are gone from the texts."""
    df, before, gone = dedup_substrings(docs)
    if "n_chars" in docs.columns:
        df = df.withColumn("n_chars", F.when(F.col(gone) > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return df.drop(before, gone)


def substring_report(docs: DataFrame) -> DataFrame:
    """The query's columns."""
    df, before, gone = dedup_substrings(docs.select("doc_id", "text"))
    space = r"[ \t\n\x0B\f\r]+"
    plain = F.regexp_replace(F.regexp_replace(F.coalesce("text", F.lit("")), rf"^{space}|{space}\z", ""), space, " ")
    kept = F.when(F.col(gone) > 0, F.col("text")).otherwise(plain)
    return df.select("doc_id", F.col(before).alias("n_words"), F.col(gone).alias("n_removed"), F.sha2(kept, 256).alias("kept_sha256"))
