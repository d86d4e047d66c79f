"""Exact top-k inner products from an impact-ordered index, score at a time.

The index cuts the vectors into shards. In a shard, the component of a vector in a dimension is a posting whose impact
is its magnitude, quantised to levels; a segment is the postings of one dimension, sign and level, and segments are kept
by descending level. A block of queries reads the segments in that order and adds the quantised contributions. What is
still unread can change a score by no more than the query's absolute sum times the largest magnitude left, so at any
point the vectors that may be among the k best are known. Reading stops only when few such vectors are proven to be left
(or no segment is); those are scored again from the whole vectors, so results are exact.

Every vector is indexed. Query blocks meet every shard (a stated query set against all rows); a shard gives at most k rows
for a query, and those are ranked over all shards.

Defined results: components are floor(256 * x) as integers; vectors that are null or hold null or non-finite components,
and rows without vec_id, take no part; only vectors of one length are compared; a row is no candidate of a query with its
own vec_id; each row of a repeated vec_id is a query and a candidate, and all its queries' rows are ranked together, so a
vector that is there m times counts m times; vectors without components score 0 with each other; ties go to the smaller
vec_id; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratafile.llm.tables import stored

K, SHARD_VECTORS, BLOCK_QUERIES, LEVELS, EVERY = 5, 4096, 256, 48, 50
SALTS = 32
#: Reading stops when the proven candidates of a block are at most this share of its (query, vector) pairs.
STOP_SHARE = 1 / 32

INDEX = "length int, shard bigint, ids binary, vectors binary, width bigint, segments binary, starts binary, postings binary"
BLOCKS = "length int, block bigint, query_ids binary, queries binary"


def integer_vectors(df: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id and the integer components of the vectors that take part."""
    values = F.transform("embedding", lambda x: x.cast("double"))
    good = F.col("vec_id").isNotNull() & F.col("values").isNotNull() & ~F.exists(
        "values", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )
    whole = F.transform("values", lambda x: F.floor(x * F.lit(float(scale))).cast("bigint"))
    return df.select(F.col("vec_id").cast("bigint").alias("vec_id"), values.alias("values")).where(good).select(
        "vec_id", whole.alias("vector")
    )


def _grouped(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, ids, matrix) of at most ``most`` vectors of one length each."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    counts: dict[int, int] = {}
    for batch in batches:
        lists, ids = batch.column("vector"), batch.column("vec_id").to_numpy(zero_copy_only=False)
        lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
        for length in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == length)
            matrix = lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), length)
            at = 0
            while at < len(rows):
                take = min(most - counts.get(length, 0), len(rows) - at)
                held.setdefault(length, []).append((ids[rows[at : at + take]], matrix[at : at + take]))
                counts[length] = counts.get(length, 0) + take
                at += take
                if counts[length] == most:
                    yield length, *map(np.concatenate, zip(*held.pop(length), strict=True))
                    counts[length] = 0
    for length, parts in held.items():
        yield length, *map(np.concatenate, zip(*parts, strict=True))


def build_segments(x: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Level width; (level, dimension, sign) of each segment by descending level; their starts; the postings."""
    size = np.abs(x)
    width = max(1, -(-int(size.max(initial=0) + 1) // LEVELS))
    doc, dim = np.nonzero(x)
    level = size[doc, dim] // width
    key = ((LEVELS - level) * x.shape[1] + dim) * 2 + (x[doc, dim] < 0)
    order = np.argsort(key, kind="stable")
    key, starts = np.unique(key[order], return_index=True)
    segments = np.stack([LEVELS - key // (2 * x.shape[1]), key // 2 % x.shape[1], 1 - 2 * (key % 2)], 1)
    return width, segments.astype(np.int64), np.append(starts, len(order)).astype(np.int64), doc[order].astype(np.int32)


def _index_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base = TaskContext.get().partitionId() << 32
    for k, (length, ids, x) in enumerate(_grouped(batches, SHARD_VECTORS)):
        width, *arrays = build_segments(x)
        row = [length, base + k, ids.tobytes(), x.tobytes(), width, *[a.tobytes() for a in arrays]]
        kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        names = [c.split()[0] for c in INDEX.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names)


def _query_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base = TaskContext.get().partitionId() << 32
    for k, (length, ids, x) in enumerate(_grouped(batches, BLOCK_QUERIES)):
        row, kinds = [length, base + k, ids.tobytes(), x.tobytes()], [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip(row, kinds, strict=True)], [c.split()[0] for c in BLOCKS.split(", ")]
        )


def search(
    ids: np.ndarray, x: np.ndarray, width: int, segments: np.ndarray, starts: np.ndarray, postings: np.ndarray,
    query_ids: np.ndarray, q: np.ndarray, k: int = K,
) -> list[tuple[int, int, int]]:
    """(query id, vector id, score) of each query's k best vectors of a shard."""
    n, m = len(ids), len(query_ids)
    own = ids[:, None] == query_ids[None, :]
    scores = np.zeros((n, m))
    weights = np.ascontiguousarray(q.T, dtype=np.float64)  # a row of query weights for each dimension
    reach = np.abs(q).sum(1).astype(np.float64)
    possible = ~own
    done, total = 0, len(postings)
    next_check = total // 2
    for s in range(len(segments)):
        level, dim, sign = segments[s].tolist()
        a, b = starts[s], starts[s + 1]
        docs = postings[a:b]
        scores[docs] += weights[dim] * (sign * (level * width + (width - 1) / 2))
        done = b
        ends_level = s + 1 == len(segments) or segments[s + 1, 0] != level
        if ends_level and done >= next_check:
            left = 0 if s + 1 == len(segments) else int(segments[s + 1, 0]) * width + width - 1
            # what is unread is below ``left``, what is read is off by half a level at most; float sums are off by far less than 1
            off = reach * max(left, (width - 1) / 2) + 1
            seen = np.where(own, -np.inf, scores)
            least = np.partition(seen, n - k, axis=0)[n - k] if n >= k else np.full(m, -np.inf)
            possible = ~own & (seen >= least - 2 * off)
            if possible.sum() <= STOP_SHARE * n * m:
                break
            next_check = done + (total - done) // 3
    found = []
    for j in range(m):
        docs = np.flatnonzero(possible[:, j])
        exact = x[docs] @ q[j]
        best = np.lexsort((ids[docs], -exact))[:k]
        found += [(int(query_ids[j]), int(ids[docs[i]]), int(exact[i])) for i in best]
    return found


def _search_batches(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            length = r["length"]
            i8 = {c: np.frombuffer(r[c], np.int64) for c in ("ids", "vectors", "segments", "starts", "query_ids", "queries")}
            found = search(
                i8["ids"], i8["vectors"].reshape(len(i8["ids"]), length), r["width"], i8["segments"].reshape(-1, 3), i8["starts"],
                np.frombuffer(r["postings"], np.int32), i8["query_ids"], i8["queries"].reshape(len(i8["query_ids"]), length), k,
            )
            columns = list(zip(*found, strict=True)) if found else [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])


def build_index(vectors: DataFrame) -> DataFrame:
    """One row per shard: its vectors and their segments by descending impact. Built in one pass, without a shuffle."""
    return stored(vectors.mapInArrow(_index_batches, INDEX), "index")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id and score of the k best vectors for each query."""
    index = build_index(vectors)
    # rows of one vec_id and vector are equal queries; of those, k are enough for the k best rows
    equal = queries.groupBy("vec_id", "vector").agg(F.least(F.count(F.lit(1)), F.lit(k)).alias("_times"))
    each = equal.select("vec_id", "vector", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int")))).drop("col")
    blocks = stored(each.mapInArrow(_query_batches, BLOCKS), "queries")
    # every block is sent to every shard of its length; the salt spreads the one length that most vectors have
    shards = index.select("length", "shard", F.pmod(F.xxhash64("shard"), F.lit(SALTS)).alias("salt"))
    salted = blocks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumn("salt", F.col("salt").cast("bigint"))
    plan = salted.join(shards, ["length", "salt"]).drop("salt")
    found = index.join(plan.drop("length"), "shard").mapInArrow(
        lambda batches: _search_batches(batches, k), "query_id bigint, vec_id bigint, score bigint"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k_report(embeddings: DataFrame) -> DataFrame:
    """The query's rows: every fiftieth vec_id against all rows."""
    vectors = integer_vectors(embeddings)
    return top_k(vectors, vectors.where(F.col("vec_id") % EVERY == 0))
