"""Connection state as a table that takes small changes: a bucketed base, appended deltas and tombstones, and a manifest.

A change writes files for the buckets of its connections only. Readers merge the base with the deltas after it; the newest
manifest says which version of each bucket and which deltas count, so a change is visible as a whole or not at all.
Compaction folds the deltas into new versions of the buckets they touch and leaves all other buckets as they are.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafile.operators.windows import latest_by
from stratafile.session import path_exists

ROW = "connection_id string, key string, value string, updated_at timestamp, seq bigint"
COLUMNS = ["connection_id", "key", "value", "updated_at", "seq"]


@dataclass(frozen=True)
class Manifest:
    """``deltas``: the newest delta; ``folded``: the newest one that the base holds; ``versions``: of each bucket."""

    number: int = 0
    deltas: int = 0
    folded: int = 0
    versions: dict[int, int] = field(default_factory=dict)


class StateTable:
    """State rows by (connection_id, key) under ``path``; one writer at a time, any number of readers."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def manifest(self) -> Manifest:
        if not path_exists(self.spark, f"{self.path}/manifest"):
            return Manifest()
        newest = self.spark.read.schema("text string, number bigint").parquet(f"{self.path}/manifest").agg(F.max_by("text", "number")).first()[0]
        if newest is None:
            return Manifest()
        read = json.loads(newest)
        return Manifest(read["number"], read["deltas"], read["folded"], {int(b): v for b, v in read["versions"].items()})

    def _publish(self, manifest: Manifest) -> None:
        row = self.spark.createDataFrame([(json.dumps(manifest.__dict__),)], "text string")
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/number={manifest.number}")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("connection_id"), F.lit(self.buckets)).cast("int").alias("bucket")

    def _append(self, rows: DataFrame) -> None:
        now = self.manifest()
        number = now.deltas + 1
        # one task per bucket at most writes, so that a change makes no more files than the buckets it touches
        placed = rows.select(*COLUMNS, self._bucket()).repartition("bucket")
        placed.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/delta/number={number}")
        self._publish(replace(now, number=now.number + 1, deltas=number))

    def upsert(self, rows: DataFrame) -> None:
        """Last write wins by ``updated_at``, then ``seq``."""
        self._append(rows.where(F.col("key").isNotNull()))

    def teardown(self, connections: DataFrame) -> None:
        """All state of these connections goes, as far as it is there now."""
        gone = connections.select("connection_id").distinct()
        none = {c: F.lit(None) for c in COLUMNS[1:]}
        self._append(gone.withColumns({c: v.cast(t.split()[1]) for (c, v), t in zip(none.items(), ROW.split(", ")[1:], strict=True)}))

    def _base(self, manifest: Manifest, buckets: list[int] | None = None) -> DataFrame:
        wanted: dict[int, list[int]] = {}
        for bucket, version in manifest.versions.items():
            if buckets is None or bucket in buckets:
                wanted.setdefault(version, []).append(bucket)
        if not wanted:
            return self.spark.createDataFrame([], f"{ROW}, bucket int")
        rows = self.spark.read.schema(f"{ROW}, version bigint, bucket int").parquet(f"{self.path}/base")
        place = [(F.col("version") == v) & F.col("bucket").isin(b) for v, b in wanted.items()]
        keep = place[0]
        for one in place[1:]:
            keep = keep | one
        return rows.where(keep).drop("version")

    def _deltas(self, manifest: Manifest) -> DataFrame:
        if manifest.deltas == manifest.folded:
            return self.spark.createDataFrame([], f"{ROW}, number bigint, bucket int")
        rows = self.spark.read.schema(f"{ROW}, number bigint, bucket int").parquet(f"{self.path}/delta")
        return rows.where((F.col("number") > manifest.folded) & (F.col("number") <= manifest.deltas))

    @staticmethod
    def _merged(base: DataFrame, deltas: DataFrame) -> DataFrame:
        """Current rows with their bucket. A teardown takes what was written before it."""
        gone = deltas.where(F.col("key").isNull()).groupBy(F.col("connection_id").alias("_gone")).agg(F.max("number").alias("_at"))
        rows = base.withColumn("number", F.lit(0).cast("bigint")).unionByName(deltas.where(F.col("key").isNotNull()))
        left = rows.join(gone, F.col("connection_id").eqNullSafe(F.col("_gone")) & (F.col("number") < F.col("_at")), "left_anti")
        return latest_by(left, ["bucket", "connection_id", "key"], ["updated_at", "seq"], ["value", "updated_at", "seq"])

    def read(self) -> DataFrame:
        now = self.manifest()
        return self._merged(self._base(now), self._deltas(now)).select(*COLUMNS)

    def touched(self) -> list[int]:
        """Buckets that deltas after the base concern; their number is bounded by that of the buckets."""
        return sorted(r[0] for r in self._deltas(self.manifest()).select("bucket").distinct().collect())

    def compact(self) -> list[int]:
        """Fold all deltas into the base; returns the buckets written anew."""
        now = self.manifest()
        buckets = self.touched()
        if buckets:
            version = now.number + 1
            rows = self._merged(self._base(now, buckets), self._deltas(now)).repartition("bucket")
            rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/base/version={version}")
            versions = {**now.versions, **dict.fromkeys(buckets, version)}
            self._publish(Manifest(version, now.deltas, now.deltas, versions))
        return buckets
