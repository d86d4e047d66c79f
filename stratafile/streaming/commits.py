"""Outputs of a micro-batch that become visible together.

Each output of a batch is a folder of its own, and the batch's commit record, written last, names them all. Readers see the
rows of committed batches only, so a failure between two outputs leaves nothing visible; the batch then runs again under
its number and replaces what it has written. A batch that its query has committed is not written twice.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafile.session import path_exists

COMMITS = "commits"
RECORD = "outputs array<string>, query string, clock bigint, batch_id bigint"


def batch_folder(base: str, name: str, batch_id: int) -> str:
    return f"{base}/{name}/batch_id={batch_id}"


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the query of a checkpoint; a query with a new checkpoint has a new one."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def write_parquet(df: DataFrame, path: str) -> None:
    """Replace a folder; records are texts much like one another, which zstd packs well."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def commits(spark: SparkSession, base: str) -> DataFrame:
    """One row per committed batch."""
    if not path_exists(spark, f"{base}/{COMMITS}"):
        return spark.createDataFrame([], RECORD)
    return spark.read.schema(RECORD).json(f"{base}/{COMMITS}")


def last_clock(spark: SparkSession, base: str) -> int:
    """The newest batch's clock; 0 before the first one."""
    return commits(spark, base).agg(F.coalesce(F.max("clock"), F.lit(0))).first()[0]


def write_together(
    spark: SparkSession, base: str, batch_id: int, outputs: dict[str, DataFrame], query: str, clock: int = 0
) -> bool:
    """Write the outputs and then the commit record; False if this query has committed the batch before."""
    done = commits(spark, base).where((F.col("batch_id") == batch_id) & (F.col("query") == query))
    if not done.isEmpty():
        return False
    for name, df in outputs.items():
        write_parquet(df, batch_folder(base, name, batch_id))
    record = spark.createDataFrame([(sorted(outputs), query, clock)], "outputs array<string>, query string, clock bigint")
    record.coalesce(1).write.mode("overwrite").json(batch_folder(base, COMMITS, batch_id))
    return True


def committed(spark: SparkSession, base: str, name: str, schema: str) -> DataFrame:
    """Rows of one output over all committed batches, with ``batch_id``; folders of other batches are not read."""
    if not path_exists(spark, f"{base}/{name}"):
        return spark.createDataFrame([], f"{schema}, batch_id bigint")
    done = commits(spark, base).select("batch_id")
    last = done.agg(F.max("batch_id")).first()[0]
    # what a failed batch left lies behind the last committed one; its files may go while the batch runs again
    rows = spark.read.schema(f"{schema}, batch_id bigint").parquet(f"{base}/{name}").where(F.col("batch_id") <= F.lit(last))
    return rows.join(done, "batch_id", "left_semi")
