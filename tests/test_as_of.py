"""As-of joins against a plain search, with hot keys, ties and nulls, and what is built on them; start tokens, shared drives."""

import datetime as dt
import random

import pytest

from stratafile.operators import joins as J
from stratafile.operators import windows as W
from stratafile.plans import resources as R
from stratafile.sources import changes as SC

START = dt.datetime(2024, 1, 1)
FACTS = "k string, ts timestamp, n int, v string"
VERSIONS = "k string, since timestamp, tie int, v string"


@pytest.fixture(autouse=True)
def many_partitions(spark):
    """Small tables stay in as many partitions as a large one would have."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def at(minutes):
    return None if minutes is None else START + dt.timedelta(minutes=minutes)


def valid(versions, key, when):
    """The last version at or before ``when``; a start of None comes first."""
    floor = dt.datetime.min
    fits = [v for v in versions if key is not None and v[0] == key and (v[1] or floor) <= (when or floor)]
    return max(fits, key=lambda v: (v[1] or floor, v[2]), default=None)


def test_as_of_equals_a_search(spark):
    rng = random.Random(4)
    keys = ["hot"] * 6 + ["a", "b", "c", None]
    versions = [(rng.choice(keys), at(rng.choice([None, *range(0, 200)])), i, f"v{i}") for i in range(400)]
    facts = [(rng.choice([*keys, "none"]), at(rng.choice([None, *range(-5, 205)])), i, "own") for i in range(1500)]
    got = J.as_of_join(
        spark.createDataFrame(facts, FACTS), spark.createDataFrame(versions, VERSIONS), "k", "ts", "k", ["since", "tie"], "found"
    )
    assert got.columns == ["k", "ts", "n", "v", "found"]
    rows = got.collect()
    assert sorted(r.n for r in rows) == list(range(1500))
    for r in rows:
        want = valid(versions, r.k, r.ts)
        assert (tuple(r.found) if r.found else None) == want, r


def test_as_of_repeats_and_empty_tables(spark):
    facts = spark.createDataFrame([("a", at(1), 1, "x")] * 3, FACTS)
    none, versions = spark.createDataFrame([], VERSIONS), spark.createDataFrame([("a", at(1), 0, "v")], VERSIONS)
    join = lambda f, v: J.as_of_join(f, v, "k", "ts", "k", ["since", "tie"], "found").collect()
    assert [r.found for r in join(facts, none)] == [None] * 3
    assert [r.found.v for r in join(facts, versions)] == ["v"] * 3
    assert join(facts.limit(0), versions) == []


def test_a_hot_key_lies_in_many_partitions(spark):
    df = spark.range(20_000).selectExpr("'one' as k", "id as t", "case when id % 5000 = 7 then id end as v")
    rows = W.last_so_far(df, ["k"], ["t"], "v", "last").collect()
    assert all(r["last"] == (None if r.t < 7 else (r.t - 7) // 5000 * 5000 + 7) for r in rows) and len(rows) == 20_000
    spread = df.repartitionByRange("k", "t").selectExpr("spark_partition_id() as p").groupBy("p").count().collect()
    assert len(spread) > 1 and max(r["count"] for r in spread) < 10_000


def test_resolution_follows_the_connection(spark):
    versions = spark.createDataFrame(
        [
            ("c1", None, -1, True, "u1", "s1", "a@x"),
            ("c1", at(10), 1, True, "u1", "s1b", "a@x"),
            ("c2", at(20), 2, True, "u2", "s2", "a@x"),  # takes the email over
            ("c2", at(30), 3, True, "u2", "s2", "b@x"),  # and lets it go
            ("c2", at(40), 4, False, "u2", "s2", "b@x"),  # torn down
        ],
        "connection_id string, valid_from timestamp, version_seq long, active boolean, customer_id string, snowball_id string, external_id string",
    ).selectExpr("*", "named_struct('sync_files', true) as settings")
    asked = [("unknown", "a@x", 5), ("unknown", "a@x", 10), ("unknown", "a@x", 25), ("unknown", "a@x", 35), ("unknown", "b@x", 35),
             ("unknown", "b@x", 45), ("unknown", None, 5), ("c2", "z", 45), ("c2", "z", 25), (None, "a@x", 5), ("c1", None, None)]
    webhooks = spark.createDataFrame(
        [(i, c, e, at(t), "m") for i, (c, e, t) in enumerate(asked)],
        "seq int, message_connection_id string, email string, ts timestamp, message_customer_id string",
    )
    rows = {r.seq: r for r in J.resolve_connections_as_of(webhooks, versions).collect()}
    assert [(rows[i].connection_id, rows[i].snowball_id, rows[i].resolution_error) for i in range(len(asked))] == [
        ("c1", "s1", None), ("c1", "s1b", None), ("c2", "s2", None), (None, None, "CONNECTION_NOT_FOUND"), ("c2", "s2", None),
        (None, None, "CONNECTION_NOT_FOUND"), (None, None, "EXTERNAL_ID_EXTRACTION_FAILED"), ("c2", None, None), ("c2", "s2", None),
        (None, None, None), ("c1", "s1", None),
    ]


def test_pages_are_served_again_after_the_ttl(spark):
    at_minute = [("p1", 0), ("p1", 1), ("p1", 9), ("p1", 10), ("p1", 10), ("p1", 19), ("p1", 25), ("p1", None), ("p1", None), ("p2", 3)]
    outcomes = spark.createDataFrame(
        [("c", p, i, f"m{i}", "fetch", at(t)) for i, (p, t) in enumerate(at_minute)] + [("c", "p1", 99, "m99", "stop", at(50))],
        "connection_id string, page_token string, seq int, message_id string, outcome string, ts timestamp",
    ).selectExpr("*", "'u' as customer_id", "'s' as snowball_id", "named_struct('sync_files', true) as settings")
    rows = R.page_requests_within(outcomes, 600).collect()
    assert sorted((r.page_token, r.request_seq, r.message_id, r.notifications) for r in rows) == [
        ("p1", 0, "m0", 3), ("p1", 3, "m3", 3), ("p1", 6, "m6", 1), ("p1", 7, "m7", 2), ("p2", 9, "m9", 1),
    ]


def test_full_sync_leaves_shared_drives_to_the_setting(spark, cfg):
    raw = spark.createDataFrame(
        [(c, "u", '{"id":"%s%s","name":"n","mimeType":"text/plain"}' % (c, s), s == "in") for c in ("yes", "no", "unset") for s in ("in", "out")],
        "connection_id string, customer_id string, raw_json string, shared_drive boolean",
    )
    connections = spark.createDataFrame([("yes", True), ("no", False), ("unset", None)], "connection_id string, drives boolean").selectExpr(
        "connection_id", "named_struct('sync_files', true, 'sync_folders', true, 'sync_shared_drives', drives) as settings"
    )
    got = R.full_sync(raw, connections, cfg).select("resource_id")
    assert sorted(r.resource_id for r in got.collect()) == ["noout", "unsetin", "unsetout", "yesin", "yesout"]


def test_a_missing_start_token_is_a_terminal_error(spark, cfg):
    answers = ['{"startPageToken":"7"}', "{}", '{"startPageToken":""}', '{"startPageToken":null}', "text", None]
    tokens = SC.start_tokens(spark.createDataFrame(list(enumerate(answers)), "connection_id int, token_json string"))
    errors = SC.missing_start_tokens(tokens, cfg).collect()
    assert [r.connection_id for r in tokens.where("start_token = '7'").collect()] == [0]
    assert sorted(r.connection_id for r in errors) == [1, 2, 3, 4, 5] and {r.error_type for r in errors} == {"terminal"}
