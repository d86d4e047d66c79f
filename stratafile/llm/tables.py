"""Reading, storing and casting helpers that the operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafile.session import shared_folder

#: Spark refuses tables of more than 100,000 buckets; a bucket may hold any number of groups.
MOST_BUCKETS = 50_000
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

#: What has been written, by scope: paths of stored tables and names of bucketed ones.
_WRITTEN: dict[str, list[tuple[str, str]]] = {}
_scope = "session"


@contextmanager
def scope(name: str) -> Iterator[None]:
    """Tables written inside belong to this scope, so they can be dropped apart from all others."""
    global _scope
    before, _scope = _scope, name
    try:
        yield
    finally:
        _scope = before


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python in batches of 8 MB, where the session hasn't chosen a size: long texts would otherwise make
    batches of 64 MB, which the executor and each of its Python workers hold at once."""
    if spark.conf.get(BATCH_BYTES) in ("67108864b", "64MB"):
        spark.conf.set(BATCH_BYTES, "8m")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, through Spark's reader alone, so that any file system works."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to the shared folder and read again.

    This cuts the lineage without a copy on one executor, and later plans know the size of what was written.
    Once the results are written, :func:`drop_stored` removes such tables.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/llm-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.setdefault(_scope, []).append(("path", path))
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, tag: str, column: str, buckets: int) -> DataFrame:
    """``df`` as a table bucketed by ``column``: groups by it need no shuffle of these rows later. Its files are in the
    shared folder, wherever the warehouse is."""
    name = f"llm_{tag}_{uuid.uuid4().hex}"
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{name}"
    df.write.format("parquet").bucketBy(min(buckets, MOST_BUCKETS), column).option("path", path).saveAsTable(name)
    _WRITTEN.setdefault(_scope, []).extend([("table", name), ("path", path)])
    return df.sparkSession.table(name)


def drop_stored(spark: SparkSession, name: str = "session") -> int:
    """Delete what :func:`stored` and :func:`bucketed` wrote in a scope; call it when the results that stand on those
    tables have been written."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    written = _WRITTEN.pop(name, [])
    for kind, what in written:
        if kind == "table":
            spark.sql(f"DROP TABLE IF EXISTS {what}")
        else:
            there = jvm.org.apache.hadoop.fs.Path(what)
            there.getFileSystem(conf).delete(there, True)
    return len(written)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def total_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of a text column, summed by Spark."""
    return int(docs.agg(F.coalesce(F.sum(F.octet_length(F.col(column))), F.lit(0))).first()[0])
