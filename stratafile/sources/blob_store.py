"""Content-addressed blobs over many runs: the same bytes of a customer are stored once, whichever run brings them.

References and blobs are partitioned by the first two digits of the content's hash. A run reads the references of the
prefixes that its own content has, and nothing else of the store; what it adds counts from the moment its record is
written, so a run that fails leaves files that nobody reads and is simply run again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafile.operators import blobs as B
from stratafile.session import path_exists

REFERENCE = "customer_id string, file_id string, sha256 string, size_bytes bigint, storage_path string, run bigint, prefix string"
BLOB = "storage_path string, content string, run bigint, prefix string"
_REFERENCE_NAMES = ["customer_id", "file_id", "sha256", "size_bytes", "storage_path", "prefix"]


class BlobStore:
    """Blobs and who refers to them, under ``path``; one writer at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def runs(self) -> DataFrame:
        """Finished runs."""
        if not path_exists(self.spark, f"{self.path}/runs"):
            return self.spark.createDataFrame([], "run bigint")
        return self.spark.read.schema("done boolean, run bigint").parquet(f"{self.path}/runs").select("run")

    def _last(self) -> int:
        return self.runs().agg(F.coalesce(F.max("run"), F.lit(0))).first()[0]

    def _table(self, name: str, schema: str) -> DataFrame:
        """Rows of finished runs. A run that fails is run again under its number, so what it left lies behind the last
        finished one and is cut off by its folder's name, unread."""
        if not path_exists(self.spark, f"{self.path}/{name}"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}").where(F.col("run") <= self._last())

    def references(self, prefixes: list[str] | None = None) -> DataFrame:
        """One row per file and content; with ``prefixes`` only their folders are read."""
        rows = self._table("references", REFERENCE)
        return rows if prefixes is None else rows.where(F.col("prefix").isin(prefixes))

    def blobs(self) -> DataFrame:
        return self._table("blobs", BLOB)

    def index(self) -> DataFrame:
        """One row per blob with the number of files that refer to it (``blobs.blob_index``)."""
        return B.blob_index(self.references())

    def store(self, content: DataFrame) -> int:
        """Add the content of files (``customer_id, file_id, content``); returns the run's number.

        A file that is brought again with the same content changes nothing. Content itself is read twice and moves once,
        for the blobs that are new.
        """
        run = self._last() + 1
        refs = B.content_refs(content).withColumn("prefix", F.left("sha256", F.lit(2))).dropDuplicates(["customer_id", "file_id", "sha256"])
        prefixes = sorted(r[0] for r in refs.where("prefix is not null").select("prefix").distinct().collect())  # 256 at most
        there = self.references(prefixes).drop("run")
        fresh = refs.join(there.select("prefix", "customer_id", "sha256", "file_id"), ["prefix", "customer_id", "sha256", "file_id"], "left_anti")
        fresh.select(*_REFERENCE_NAMES).repartition("prefix").write.mode("overwrite").partitionBy("prefix").parquet(f"{self.path}/references/run={run}")
        added = self.spark.read.schema(REFERENCE.replace("run bigint, ", "")).parquet(f"{self.path}/references/run={run}")
        known = there.select("prefix", "customer_id", "sha256").distinct()
        missing = B.blob_index(added).withColumn("prefix", F.left("sha256", F.lit(2))).join(known, ["prefix", "customer_id", "sha256"], "left_anti")
        new = B.blobs_to_store(content, missing).withColumn("prefix", F.left(F.sha2("content", 256), F.lit(2)))
        # of a file that is there several times, with one content each, the blob's own
        new = new.where(F.col("storage_path").endswith(F.sha2("content", 256))).dropDuplicates(["storage_path"])
        new.select("storage_path", "content", "prefix").write.mode("overwrite").partitionBy("prefix").parquet(f"{self.path}/blobs/run={run}")
        self.spark.createDataFrame([(True,)], "done boolean").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/runs/run={run}")
        return run
