"""The state table: merges as an upsert and a teardown do, and writes no more than the buckets it must."""

import datetime as dt
import random
from pathlib import Path

from pyspark.sql import functions as F

from stratafile.operators import state as ST
from stratafile.sources.state_table import ROW, StateTable

DAY = dt.datetime(2024, 1, 1)


def rows_of(spark, rows):
    return spark.createDataFrame(rows, ROW)


def some(rng, n, seq):
    return [(f"c{rng.randrange(40)}", f"k{rng.randrange(3)}", f"v{seq + i}", DAY + dt.timedelta(hours=rng.randrange(50)), seq + i) for i in range(n)]


def as_set(df):
    return sorted(tuple(r) for r in df.select("connection_id", "key", "value", "seq").collect())


def folders(path, what):
    return {tuple(p.relative_to(path).parts) for p in Path(path, what).glob("*/bucket=*")}


def test_reads_as_upserts_and_teardowns_say(spark, tmp_path):
    rng = random.Random(3)
    table, want = StateTable(spark, f"{tmp_path}/t", 8), rows_of(spark, [])
    assert table.read().count() == 0 and table.compact() == []
    for step in range(5):
        rows = rows_of(spark, some(rng, 60, 100 * step))
        table.upsert(rows)
        want = ST.upsert_state(want, rows).select("connection_id", "key", "value", "updated_at", "seq")
        if step == 2:
            table.compact()
        if step in (1, 3):
            gone = rows_of(spark, [(f"c{k}", None, None, None, None) for k in range(step, 40, 5)])
            table.teardown(gone)
            want = ST.delete_state(want, gone)
        want = spark.createDataFrame(want.collect(), ROW)
        assert as_set(table.read()) == as_set(want), step
    table.compact()
    assert as_set(table.read()) == as_set(want) and table.touched() == []


def test_a_change_writes_its_buckets_only(spark, tmp_path):
    path = f"{tmp_path}/t"
    table = StateTable(spark, path, 16)
    table.upsert(rows_of(spark, [(f"c{k}", "k", "v", DAY, k) for k in range(200)]))
    assert table.compact() == list(range(16))
    base = folders(path, "base")
    table.upsert(rows_of(spark, [("c1", "k", "new", DAY + dt.timedelta(days=1), 999), ("c1", "other", "x", DAY, 1)]))
    assert len([f for f in folders(path, "delta") if f[1] == "number=2"]) == 1
    (bucket,) = table.touched()
    assert table.compact() == [bucket]
    assert len(folders(path, "base") - base) == 1  # one bucket has a new version, the others keep theirs
    got = {(r.connection_id, r.key): r.value for r in table.read().collect()}
    assert got["c1", "k"] == "new" and got["c1", "other"] == "x" and len(got) == 201


def test_state_written_after_a_teardown_stays(spark, tmp_path):
    table = StateTable(spark, f"{tmp_path}/t", 4)
    table.upsert(rows_of(spark, [("a", "k", "old", DAY, 1), (None, "k", "none", DAY, 1)]))
    table.teardown(rows_of(spark, [("a", None, None, None, None), (None, None, None, None, None)]))
    table.upsert(rows_of(spark, [("a", "k", "new", DAY - dt.timedelta(days=1), 0)]))
    assert as_set(table.read()) == [("a", "k", "new", 0)]


def test_an_unpublished_change_is_not_read(spark, tmp_path):
    table = StateTable(spark, f"{tmp_path}/t", 4)
    table.upsert(rows_of(spark, [("a", "k", "v", DAY, 1)]))
    lost = rows_of(spark, [("a", "k", "lost", DAY + dt.timedelta(days=1), 2)]).withColumn("bucket", F.lit(0))
    lost.write.partitionBy("bucket").parquet(f"{tmp_path}/t/delta/number=2")  # the writer died before its manifest
    assert as_set(table.read()) == [("a", "k", "v", 1)]
    table.upsert(rows_of(spark, [("a", "k", "w", DAY + dt.timedelta(days=2), 3)]))
    assert as_set(table.read()) == [("a", "k", "w", 3)]
