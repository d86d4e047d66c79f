"""Connections that own much of the rows: spread without changing a result."""

import json

from pyspark.sql import functions as F

from stratafile.operators import joins as J
from stratafile.operators import messages as MSG
from stratafile.streaming import pipeline as SP


def hook(k, connection, email=None):
    payload = {"id": "ch", "resourceUri": "https://x.example/changes?pageToken=p%2F1", **({"emailAddress": email} if email else {})}
    return (json.dumps({"message_id": f"m{k}", "customer_id": "cust", "integration_id": "drive", "integration_connection_id": connection, "payload": payload}),)


def tables(spark):
    rows = [hook(k, *[("hot",), ("unknown", "a@x"), ("c" + str(k % 9),), ("unknown", f"n{k}@x"), ("unknown",)][k % 5]) for k in range(400)]
    connections = [("hot", "k", "s", "h@x", "t"), ("a", "k", "s", "a@x", "u"), *[(f"c{i}", "k", None, f"c{i}@x", None) for i in range(5)]]
    return (
        spark.createDataFrame(rows, "value string"),
        spark.createDataFrame(connections, "connection_id string, customer_id string, snowball_id string, external_id string, settings string"),
    )


def test_hot_lookups_change_no_resolution(spark):
    values, connections = tables(spark)
    parsed = MSG.parse_webhooks(values)
    hot = J.hot_lookups(parsed)
    assert "hot" in hot[0] and "a@x" in hot[1] and "unknown" not in hot[0]
    columns = ["message_id", "connection_id", "customer_id", "snowball_id", "settings", "resolution_error"]
    plain, spread = (sorted(J.resolve_connections(parsed, connections, h).select(*columns).collect(), key=str) for h in (None, hot))
    assert plain == spread and len(plain) == 400


def test_lookup_join_of_several_rows_per_key(spark):
    facts = spark.range(60).select("id", F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("key"), F.lit("l").alias("listing"))
    pages = spark.createDataFrame([("hot", "l", 1), ("hot", "l", 2), ("hot", "m", 3), ("k1", "l", 4)], "key string, listing string, n int")
    plain, spread = (
        sorted(map(tuple, J.lookup_join(facts, pages, "key", h, "id", how="inner", also=("listing",)).select("id", "key", "n").collect()))
        for h in (None, ["hot"])
    )
    assert plain == spread and len(plain) == 61


def test_the_parsed_message_stays_out_of_the_webhook_joins(spark, cfg, tmp_path):
    values, connections = tables(spark)
    values.coalesce(1).write.json(f"{tmp_path}/in")
    stream = spark.readStream.schema("value string").json(f"{tmp_path}/in")
    seen = []

    def records(df, _):
        seen.extend(df.columns)
        return df.select("message_id", "value")

    SP.webhook_stream(stream, cfg, lambda: connections, records, f"{tmp_path}/out", f"{tmp_path}/check")
    assert "value" in seen and not {"msg", "msg_keys", "header"} & set(seen)
    n = [spark.read.parquet(f"{tmp_path}/out/{name}").count() for name in ("records", "errors")]
    assert n == [240, 160]
