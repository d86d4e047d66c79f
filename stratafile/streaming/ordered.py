"""Records of a stream numbered per connection: 1, 2, 3, ... without a gap, in order, over all micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafile.operators.windows import running_total
from stratafile.streaming import commits as C
from stratafile.streaming.pipeline import run_to_end

#: Every so many batches the counters of all connections are written, else only those of the batch.
SNAPSHOT_EVERY = 64


def number_rows(rows: DataFrame, counters: DataFrame, key: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with their ``number``, and the counters after them.

    ``counters``: ``key, last``. Ranks come from range partitions and offsets, so the rows of a hot connection are ranked
    by many tasks.
    """
    ranked = running_total(rows, [key], order, F.lit(1).cast("bigint"), "_rank")
    known = counters.select(F.col(key).alias("_key"), "last")
    numbered = ranked.join(known, F.col(key).eqNullSafe(F.col("_key")), "left")
    numbered = numbered.withColumn("number", F.coalesce("last", F.lit(0)) + F.col("_rank")).drop("_key", "last", "_rank")
    return numbered, numbered.groupBy(key).agg(F.max("number").alias("last"))


def counters(spark: SparkSession, base: str, key: str) -> DataFrame:
    """The last number of each connection as of the last committed batch."""
    rows = C.committed(spark, base, "counters", f"{key} string, last bigint")
    newest = C.commits(spark, base).agg(F.max("batch_id")).first()[0] or 0
    return rows.where(F.col("batch_id") >= newest - newest % SNAPSHOT_EVERY).groupBy(key).agg(F.max("last").alias("last"))


def numbered_stream(stream: DataFrame, key: str, order: list[str], base: str, checkpoint: str) -> None:
    """Drain a stream into ``records``, numbered per ``key`` in order of arrival: batches one after the other, rows of a
    batch by ``order``. Numbers and counters are committed together, so a batch that fails leaves no gap."""
    spark = stream.sparkSession

    def on_batch(df: DataFrame, batch_id: int) -> None:
        before = counters(spark, base, key)
        numbered, after = number_rows(df, before, key, order)
        numbered = numbered.persist()
        try:
            if batch_id % SNAPSHOT_EVERY == 0:
                after = after.unionByName(before).groupBy(key).agg(F.max("last").alias("last"))
            C.write_together(spark, base, batch_id, {"records": numbered, "counters": after}, C.query_id(spark, checkpoint))
        finally:
            numbered.unpersist()

    run_to_end(stream, on_batch, checkpoint)
