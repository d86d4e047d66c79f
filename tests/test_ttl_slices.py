"""TTL deduplication of keys that span many partitions, against the plain rule."""

import datetime as dt
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratafile.operators import dedup as D

DAY = dt.datetime(2024, 1, 1)
SCHEMA = "k string, ts timestamp, seq long"


def plain(rows, ttl):
    """(key, time, smallest seq of that instant) of the accepted records."""
    of = defaultdict(dict)
    for key, at, seq in rows:
        of[key][at] = min(seq, of[key].get(at, seq))
    out = []
    for key, instants in of.items():
        free = None
        for at in sorted(instants):
            if free is None or at >= free:
                out.append((key, at, instants[at]))
                free = at + dt.timedelta(seconds=ttl)
    return Counter(out)


@pytest.fixture()
def many_parts(spark):
    kept = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for c, v in kept.items():
        spark.conf.set(c, v)


@pytest.mark.parametrize("ttl", [1, 50, 700, 100_000])
def test_equals_the_plain_rule(spark, many_parts, ttl):
    """A key with half of all rows, another over two or three partitions, many small ones, repeated instants."""
    rng = random.Random(ttl)
    rows = [("hot", DAY + dt.timedelta(seconds=rng.randrange(4000)), k) for k in range(1500)]
    rows += [("warm", DAY + dt.timedelta(seconds=rng.randrange(900)), 10_000 + k) for k in range(400)]
    rows += [(f"k{rng.randrange(300)}", DAY + dt.timedelta(seconds=rng.randrange(4000)), 20_000 + k) for k in range(1000)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = Counter((r.k, r.ts, r.seq) for r in D.ttl_dedup(df, "k", "ts", "seq", ttl).collect())
    assert got == plain(rows, ttl)


def test_a_hot_key_spreads(spark, many_parts, monkeypatch):
    """No partition holds more than a few times its share, and few slices meet in one task."""
    sizes = {}
    once = D.stored_once

    def watch(df):
        out = once(df)
        if "_open" in out.columns:
            sizes.update({r._part: r.n for r in out.groupBy("_part").agg(F.count("*").alias("n")).collect()})
        return out

    monkeypatch.setattr(D, "stored_once", watch)
    n = 4000
    rows = spark.range(n).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("k"), F.timestamp_seconds(F.col("id") * 7).alias("ts"), F.col("id").alias("seq"))
    assert D.ttl_dedup(rows, "k", "ts", "seq", 3600).count() > 0
    assert len(sizes) > 15 and max(sizes.values()) < 4 * n / len(sizes)


def test_no_rows_and_nulls(spark):
    assert D.ttl_dedup(spark.createDataFrame([], SCHEMA), "k", "ts", "seq", 9).count() == 0
    rows = [(None, DAY, 1), (None, DAY, 2), ("a", None, 3), ("", DAY, 4), ("", DAY, 5)]
    assert sorted(r.seq for r in D.ttl_dedup(spark.createDataFrame(rows, SCHEMA), "k", "ts", "seq", 9).collect()) == [1, 2, 4]


def test_functions_compose():
    """The function of two slices is that of the whole, and shortening changes no value."""
    rng = np.random.default_rng(5)
    for ttl in (1, 20, 300):
        times = np.unique(rng.integers(0, 2000, 400)).astype(np.int64)
        cut = len(times) // 2
        a, b = times[:cut], times[cut:]
        fa, fb = D._jumps(a, ttl), D._jumps(b, ttl)
        free = rng.integers(-50, 2400, 500)
        whole = D._apply(times, D._jumps(times, ttl), free)
        assert (D._apply(b, fb, D._apply(a, fa, free)) == whole).all()
        assert (D._apply(*D._before(a, fa, (b, fb)), free) == whole).all()
        short = D._shortened(a, fa)
        assert (D._apply(*short, free) == D._apply(a, fa, free)).all() and len(short[0]) <= len(a)
