import random
from collections import defaultdict

from pyspark.sql import functions as F

from stratafile.operators import dedup as D
from stratafile.operators import joins as J
from stratafile.operators import windows as W


def test_running_total_with_a_hot_key(spark):
    rnd = random.Random(1)
    rows = [("hot" if i % 3 == 0 else f"k{i % 7}", i, rnd.randint(0, 9)) for i in range(3000)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, o bigint, v bigint").repartition(8)
    out = {(r.k, r.o): (r.t, r.total) for r in W.running_total(df, ["k"], ["o"], F.col("v"), "t", "total").collect()}
    expected, sums = {}, defaultdict(int)
    for k, o, v in sorted(rows):
        sums[k] += v
        expected[(k, o)] = sums[k]
    assert {key: t for key, (t, _) in out.items()} == expected
    assert all(total == sums[k] for (k, _), (_, total) in out.items())


def test_pages(spark):
    df = spark.createDataFrame([("a", f"{i:04}") for i in range(205)] + [("b", "x")], "c string, id string")
    rows = W.assign_pages(df, ["c"], ["id"], 100).collect()
    assert len(rows) == 206
    last = [r for r in rows if r.batch_is_last]
    assert sorted((r.c, r.id, r.page_no, r.batch_sequence) for r in last) == [("a", "0204", 2, 4), ("b", "x", 0, 0)]
    assert {(r.c, r.page_no): r.next_page_token for r in rows} == {("a", 0): "1", ("a", 1): "2", ("a", 2): None, ("b", 0): None}


def test_failure_streaks_match_a_plain_scan(spark):
    rnd = random.Random(3)
    rows, state = [], {}
    for i in range(4000):
        key = "hot" if i % 3 == 0 else f"e{i % 2}"
        state[key] = state.get(key, False) if rnd.random() < 0.8 else rnd.random() < 0.5
        rows.append((key, 1_700_000_000 + i * rnd.choice([0, 1]) + i * 2, i, state[key]))
    df = spark.createDataFrame(rows, "endpoint string, s bigint, id bigint, failed boolean").withColumn("ts", F.timestamp_seconds("s"))
    expected = []
    for key in {r[0] for r in rows}:
        run = []
        for _, s, i, failed in sorted([r for r in rows if r[0] == key], key=lambda r: (r[1], r[2])) + [(key, None, None, False)]:
            if failed:
                run.append(s)
            else:
                if len(run) >= 5:
                    expected.append((key, len(run), run[0], run[-1]))
                run = []
    for bucket in (7, 60, 100_000):
        got = W.failure_streaks(df, "endpoint", ["ts", "id"], F.col("failed"), threshold=5, bucket_seconds=bucket)
        got = got.select("endpoint", "failures", F.unix_seconds("started_at"), F.unix_seconds("ended_at")).collect()
        assert sorted(map(tuple, got)) == sorted(expected)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rank_filters_are_cut_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    for out in (W.last_n(df, ["k"], [F.col("id").desc()], 3), D.first_by_key(df, ["k"], ["id"])):
        text = plan(out)
        assert "WindowGroupLimit" in text.split("Exchange")[-1]


def brute_ttl(rows, ttl):
    out, last = [], {}
    for key, at, seq in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        if key not in last or at >= last[key] + ttl:
            last[key] = at
            out.append((key, at, seq))
    return sorted(out)


def test_ttl_dedup_with_a_hot_key(spark):
    rnd = random.Random(5)
    rows = [("hot" if i % 3 == 0 else f"k{rnd.randint(0, 40)}", rnd.randint(0, 2000), i) for i in range(1500)]
    df = spark.createDataFrame(rows, "k string, s bigint, seq bigint").withColumn("ts", F.timestamp_seconds("s"))
    got = D.ttl_dedup(df, "k", "ts", "seq", 300).select("k", F.unix_seconds("ts"), "seq").collect()
    assert sorted(map(tuple, got)) == brute_ttl(rows, 300)


def test_blank_nonces_pass(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("", 3), ("", 4), (None, 5)], "nonce string, seq int")
    out = D.dedup_by_nonce(df, ["seq"])
    assert sorted(r.seq for r in out.collect()) == [1, 3, 4, 5]
    again = D.dedup_by_nonce(out.unionByName(df), ["seq"]).where("nonce = 'a'").collect()
    assert [r.seq for r in again] == [1]


def test_salted_lookup_equals_plain_join(spark):
    facts = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"), "id")
    dim = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3)], "k string, v int")
    hot = J.hot_keys(facts, "k", share=0.2, fraction=1.0)
    assert hot == ["hot"]
    plain = sorted(map(str, J.lookup_join(facts, dim, "k").collect()))
    assert sorted(map(str, J.lookup_join(facts, dim, "k", hot, "id", 16).select("k", "id", "v").collect())) == plain
