"""Deduplication by nonce."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratafile.session import shared_folder

# What tasks run travels by value, so that workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def first_by_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key in arrival order; each map task keeps one row per key before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") == 1).drop("_rank")


def dedup_by_nonce(df: DataFrame, order: list[str], nonce: str = "nonce") -> DataFrame:
    """First record per nonce; records with a blank nonce all pass and are not shuffled."""
    blank = F.coalesce(F.col(nonce), F.lit("")) == ""
    return first_by_key(df.where(~blank), [nonce], order).unionByName(df.where(blank))


def dedup_stats(df: DataFrame, keys: list[str], nonce: str = "nonce") -> DataFrame:
    """Records, distinct nonces, duplicates and the hit rate, counted over one pre-aggregated row per nonce."""
    blank = F.coalesce(F.col(nonce), F.lit("")) == ""
    per_nonce = df.groupBy(*keys, F.when(~blank, F.col(nonce)).alias("_nonce")).agg(F.count("*").alias("_n"))
    duplicates = F.sum(F.when(F.col("_nonce").isNotNull(), F.col("_n") - 1).otherwise(0))
    return per_nonce.groupBy(*keys).agg(
        F.sum("_n").alias("records"),
        F.count("_nonce").alias("distinct_nonces"),
        duplicates.alias("duplicates"),
        F.round(duplicates / F.sum("_n"), 6).alias("hit_rate"),
    )


def ttl_dedup(df: DataFrame, key: str, ts: str, order: str, ttl_seconds: int) -> DataFrame:
    """Records accepted by a TTL memory: a key is remembered for ``ttl_seconds`` from its last *accepted* record.

    Returns ``key, ts, order`` of the accepted records. Records with a null key all pass; those without a time can't be
    judged and are in :func:`untimed`.

    One row per key and instant is sorted by range of (key, instant), so a hot key spreads over many partitions. A key that
    lies inside one partition is settled there. Where a key's instants touch a partition's edge, the partition's part of
    them is a slice, and what a slice does is a jump function: from the instant at which the key is free again before it
    to the one after it. Functions of neighbouring slices are composed in groups, so that no task holds more than a few
    slices; the groups, then the slices, give each slice the instant at which it starts, and it is settled from there.
    """
    ttl = ttl_seconds * 1_000_000
    timed = df.where(F.col(ts).isNotNull())
    rows = timed.where(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), F.unix_micros(ts).alias("_at"), F.col(order).alias("_seq")
    )
    instants = rows.groupBy("_key", "_at").agg(F.min("_seq").alias("_seq"))
    kinds = {f.name: f.dataType.simpleString() for f in instants.schema.fields}
    columns = f"_key {kinds['_key']}, _at bigint, _seq {kinds['_seq']}, _part int, _open boolean"
    ordered = instants.repartitionByRange("_key", "_at").sortWithinPartitions("_key", "_at")
    parts = stored_once(ordered.mapInArrow(lambda batches: _settled_inside(batches, ttl), columns))

    slices = parts.where("_open").select("_key", "_at", "_seq", "_part")
    starts = _slice_starts(slices, ttl)
    # a slice's start comes before its instants
    both = slices.withColumn("_start", F.lit(None).cast("bigint")).unionByName(
        starts.withColumns({"_at": F.lit(None).cast("bigint"), "_seq": F.lit(None).cast(kinds["_seq"])})
    )
    placed = both.repartition("_key", "_part").sortWithinPartitions("_key", "_part", F.asc_nulls_first("_at"))
    across = placed.mapInArrow(lambda batches: _settled_from(batches, ttl), f"_key {kinds['_key']}, _at bigint, _seq {kinds['_seq']}")

    accepted = parts.where("not _open").select("_key", "_at", "_seq").unionByName(across).select(
        F.col("_key").alias(key), F.timestamp_micros("_at").alias(ts), F.col("_seq").alias(order)
    )
    return accepted.unionByName(timed.where(F.col(key).isNull()).select(key, ts, order))


def stored_once(df: DataFrame) -> DataFrame:
    """Rows written to the shared folder: later passes read the same partitions, and lost executors cost no second sort."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Before every instant.
EVER = -(1 << 62)


def _greedy(times: np.ndarray, at: int, ttl: int) -> list[int]:
    """Places of the accepted instants, the first one at place ``at``."""
    out = []
    while at < len(times):
        out.append(at)
        at = int(times.searchsorted(times[at] + ttl))
    return out


def _runs(batch: pa.RecordBatch, *columns: str) -> list[tuple[int, int]]:
    """Begin and end of rows that agree in the columns; rows that agree stand together."""
    n = batch.num_rows
    change = np.zeros(max(n - 1, 0), bool)
    for name in columns:
        column = batch.column(name)
        change |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    edges = [0, *(np.flatnonzero(change) + 1).tolist(), n]
    return list(zip(edges, edges[1:], strict=False)) if n else []


def _table(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _settled_inside(batches: Iterator[pa.RecordBatch], ttl: int) -> Iterator[pa.RecordBatch]:
    """Accepted instants of keys that lie inside the partition; all instants of its first and its last key, open.

    Holds at most what one partition has of one key.
    """
    part = TaskContext.get().partitionId()

    def out(rows: pa.RecordBatch, is_open: bool) -> pa.RecordBatch:
        n = rows.num_rows
        return pa.RecordBatch.from_arrays(
            [*(rows.column(c) for c in ("_key", "_at", "_seq")), pa.array([part] * n, pa.int32()), pa.array([is_open] * n)],
            ["_key", "_at", "_seq", "_part", "_open"],
        )

    def settled(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = _table(held)
        return out(rows.take(pa.array(_greedy(rows.column("_at").to_numpy(), 0, ttl), pa.int64())), False)

    first, current, held = None, None, []  # the partition's first key, the newest one and what is held of it
    for batch in batches:
        runs = _runs(batch, "_key")
        times, keep = batch.column("_at").to_numpy(), []
        for k, (a, b) in enumerate(runs):
            if 0 < k < len(runs) - 1:  # begins and ends in this batch
                keep.extend([a] if b - a == 1 else [a + i for i in _greedy(times[a:b], 0, ttl)])
                continue
            key = batch.column("_key")[a].as_py()
            if first is None:
                first = current = key
            elif key != current:
                if held:
                    yield settled(held)
                current, held = key, []
            if current == first:
                yield out(batch.slice(a, b - a), True)
            else:
                held.append(batch.slice(a, b - a))
        if keep:
            yield out(batch.take(pa.array(keep, pa.int64())), False)
    for rows in held:
        yield out(rows, True)


def _by_run(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[pa.RecordBatch]:
    """Rows that agree in the columns, in one batch each, from sorted batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for k, (a, b) in enumerate(_runs(batch, *columns)):
            rows = batch.slice(a, b - a)
            if held and (k or any(held[0].column(c)[0] != rows.column(c)[0] for c in columns)):
                yield _table(held)
                held = []
            held.append(rows)
    if held:
        yield _table(held)


#: A function is rows of (``_at``, ``_exit``): a key that is free from f on is free again at ``_exit`` of the first ``_at``
#: not before f, and stays free at f if there is none.


def _jumps(times: np.ndarray, ttl: int) -> np.ndarray:
    """Where a key is free again behind the slice, for each of its instants as the first accepted one."""
    n = len(times)
    after = times.searchsorted(times + ttl)
    last = np.where(after < n, after, np.arange(n))
    while True:  # follow the pointers by doubling
        further = last[last]
        if (further == last).all():
            return times[last] + ttl
        last = further


def _apply(at: np.ndarray, exits: np.ndarray, free: np.ndarray) -> np.ndarray:
    place = at.searchsorted(free)
    return np.where(place < len(at), exits[np.minimum(place, len(at) - 1)], free)


def _shortened(at: np.ndarray, exits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same function without instants that change nothing."""
    keep = np.append(exits[1:] != exits[:-1], True)
    return at[keep], exits[keep]


def _function(rows: pa.RecordBatch, place: str, at: np.ndarray, exits: np.ndarray) -> pa.RecordBatch:
    at, exits = _shortened(at, exits)
    first = rows.slice(0, 1).take(pa.array(np.zeros(len(at), np.int64)))
    return pa.RecordBatch.from_arrays([first.column("_key"), first.column(place), pa.array(at), pa.array(exits)], ["_key", place, "_at", "_exit"])


def _slice_functions(batches: Iterator[pa.RecordBatch], ttl: int) -> Iterator[pa.RecordBatch]:
    for rows in _by_run(batches, "_key", "_part"):
        times = rows.column("_at").to_numpy()
        yield _function(rows, "_part", times, _jumps(times, ttl))


def _before(at: np.ndarray, exits: np.ndarray, later: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """One function of a slice and what comes later: who is free within the slice goes through both, who is free behind
    it through the later ones only."""
    return _shortened(np.append(at, later[0]), np.append(_apply(*later, exits), later[1]))


def _group_functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The functions of a group's slices, which come last first, as one. Its size is that of the group's instants at most,
    and far less where the group is longer than a TTL."""
    now = whole = None
    for rows in _by_run(batches, "_key", "_group", "_part"):
        own = rows.column("_at").to_numpy(), rows.column("_exit").to_numpy()
        if now is not None and all(now.column(c)[0] == rows.column(c)[0] for c in ("_key", "_group")):
            whole = _before(*own, whole)
            continue
        if now is not None:
            yield _function(now, "_group", *whole)
        now, whole = rows.slice(0, 1), own
    if now is not None:
        yield _function(now, "_group", *whole)


def _starts(batches: Iterator[pa.RecordBatch], whole: str, place: str) -> Iterator[pa.RecordBatch]:
    """Where the key is free before each ``place`` of a ``whole``, whose places stand in order. A row without an exit gives
    the start of the whole; without such a row the key is free from ever on."""
    now, free = None, EVER
    for rows in _by_run(batches, *dict.fromkeys(("_key", whole, place))):
        first = rows.slice(0, 1)
        if now is None or any(now.column(c)[0] != first.column(c)[0] for c in ("_key", whole)):
            now, free = first, EVER
        if first.column("_exit")[0].as_py() is None:
            free = first.column("_at")[0].as_py()
            continue
        at, exits = rows.column("_at").to_numpy(), rows.column("_exit").to_numpy()
        yield pa.RecordBatch.from_arrays([first.column("_key"), first.column(place), pa.array([free], pa.int64())], ["_key", place, "_start"])
        free = int(_apply(at, exits, np.array([free]))[0])


def _slice_starts(slices: DataFrame, ttl: int) -> DataFrame:
    """``_key, _part, _start``: from when on the key is free before each slice.

    Slices are composed in groups of about the square root of their number, so neither a group nor the groups of a key are
    many functions.
    """
    size = isqrt(int(slices.sparkSession.conf.get("spark.sql.shuffle.partitions"))) + 1
    kind = slices.schema["_key"].dataType.simpleString()
    placed = slices.select("_key", "_part", "_at").repartition("_key", "_part").sortWithinPartitions("_key", "_part", "_at")
    functions = placed.mapInArrow(lambda batches: _slice_functions(batches, ttl), f"_key {kind}, _part int, _at bigint, _exit bigint")
    functions = stored_once(functions).withColumn("_group", F.floor(F.col("_part") / size).cast("int"))

    in_groups = functions.repartition("_key", "_group").sortWithinPartitions("_key", "_group", F.desc("_part"), "_at")
    groups = in_groups.mapInArrow(_group_functions, f"_key {kind}, _group int, _at bigint, _exit bigint")
    in_keys = groups.repartition("_key").sortWithinPartitions("_key", "_group", "_at")
    of_groups = in_keys.mapInArrow(lambda batches: _starts(batches, "_key", "_group"), f"_key {kind}, _group int, _start bigint")

    given = of_groups.select(
        "_key", F.lit(-1).alias("_part"), F.col("_start").alias("_at"), F.lit(None).cast("bigint").alias("_exit"), "_group"
    )
    both = functions.unionByName(given).repartition("_key", "_group").sortWithinPartitions("_key", "_group", "_part", "_at")
    return both.mapInArrow(lambda batches: _starts(batches, "_group", "_part"), f"_key {kind}, _part int, _start bigint")


def _settled_from(batches: Iterator[pa.RecordBatch], ttl: int) -> Iterator[pa.RecordBatch]:
    """Accepted instants of slices, each behind the row that says where it starts."""
    free = None
    for batch in batches:
        begins = np.flatnonzero(batch.column("_start").is_valid().to_numpy(zero_copy_only=False)).tolist()
        times = pc.fill_null(batch.column("_at"), 0).to_numpy()
        keep = []
        for a, b in zip([-1, *begins], [*begins, batch.num_rows], strict=True):
            if a >= 0:
                free = batch.column("_start")[a].as_py()
            own = times[a + 1 : b]
            kept = _greedy(own, int(own.searchsorted(free)), ttl) if len(own) else []
            if kept:
                keep.extend(a + 1 + i for i in kept)
                free = int(own[kept[-1]]) + ttl
        rows = batch.take(pa.array(keep, pa.int64()))
        yield pa.RecordBatch.from_arrays([rows.column(c) for c in ("_key", "_at", "_seq")], ["_key", "_at", "_seq"])


def untimed(df: DataFrame, ts: str) -> DataFrame:
    """Records without a time, for the quarantine."""
    return df.where(F.col(ts).isNull()).withColumn("bad_row_reason", F.lit(f"{ts} is null"))
