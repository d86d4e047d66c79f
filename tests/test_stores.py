"""The blob store over several runs and the catalog laid out for lookups."""

import random

from pyspark.sql import functions as F

from stratafile.operators import blobs as B
from stratafile.plans import resources as R
from stratafile.sources.blob_store import BlobStore
from stratafile.sources.catalog import lookup, write_catalog

CONTENT = "customer_id string, file_id string, content string"


def as_set(df):
    return sorted(tuple(r) for r in df.select("customer_id", "sha256", "storage_path", "size_bytes", "first_file_id", "ref_count").collect())


def test_runs_store_nothing_twice(spark, tmp_path):
    """Three overlapping runs: every blob once, references as one run over all files gives them."""
    rng = random.Random(4)
    rows = [(f"cust{rng.randrange(3)}", f"f{k}", f"text {rng.randrange(25)}") for k in range(120)]
    store = BlobStore(spark, f"{tmp_path}/s")
    assert store.index().count() == 0
    for part in (rows[:60], rows[30:90], rows[60:]):
        store.store(spark.createDataFrame(part, CONTENT))
    whole = B.blob_index(B.content_refs(spark.createDataFrame(rows, CONTENT)))
    assert as_set(store.index()) == as_set(whole)
    paths = [r.storage_path for r in store.blobs().collect()]
    assert len(paths) == len(set(paths)) == whole.count()
    before = store.blobs().count(), store.references().count()
    store.store(spark.createDataFrame(rows, CONTENT))
    assert (store.blobs().count(), store.references().count()) == before
    assert store.blobs().where(F.sha2("content", 256) != F.element_at(F.split("storage_path", "/"), -1)).count() == 0


def test_a_run_reads_the_prefixes_it_touches(spark, tmp_path):
    store = BlobStore(spark, f"{tmp_path}/s")
    store.store(spark.createDataFrame([("c", f"f{k}", f"content {k}") for k in range(300)], CONTENT))
    assert len({f.split("prefix=")[1][:2] for f in store.references().inputFiles()}) > 100
    plan = store.references(["0a", "ff"])._jdf.queryExecution().executedPlan().toString()
    assert "prefix" in plan.split("PartitionFilters: ")[1].split("]")[0]


def test_an_unfinished_run_does_not_count(spark, tmp_path):
    store = BlobStore(spark, f"{tmp_path}/s")
    store.store(spark.createDataFrame([("c", "f1", "a"), ("c", "f2", "b"), ("c", "f2", "c")], CONTENT))
    left = store.references().drop("run").limit(1)
    left.write.partitionBy("prefix").parquet(f"{tmp_path}/s/references/run=2")  # the writer died before its record
    assert store.references().count() == 3 and store.blobs().count() == 3
    store.store(spark.createDataFrame([("c", "f3", "a"), (None, "f4", "a"), ("c", None, None)], CONTENT))
    assert {r.ref_count for r in store.index().where("customer_id = 'c' and first_file_id = 'f1'").collect()} == {2}


def test_lookup_reads_the_buckets_of_its_ids(spark, tmp_path):
    path = f"{tmp_path}/c"
    rows = spark.range(3000).select(F.concat(F.lit("f"), "id").alias("id"), F.col("id").alias("n"))
    write_catalog(rows, path, buckets=64)
    wanted = spark.createDataFrame([(f"f{k}",) for k in (5, 17, 999, 5, 100_000)], "id string")
    got = lookup(spark, path, wanted, buckets=64)
    assert sorted((r.id, r.n, r.found) for r in got.collect()) == sorted((r.id, r.n, r.found) for r in R.lookup(rows, wanted, ["id"]).collect())
    assert len(spark.read.parquet(path).inputFiles()) == 64
    plan = got._jdf.queryExecution()
    got.collect()
    text = plan.executedPlan().toString()
    assert "PartitionFilters: [" in text and "bucket" in text
    scan = [x for x in text.splitlines() if "FileScan parquet" in x][0]
    assert "bucket" in scan.split("PartitionFilters: ")[1].split("]")[0]


def test_lookup_of_nothing(spark, tmp_path):
    path = f"{tmp_path}/c"
    write_catalog(spark.createDataFrame([("a", 1), (None, 2)], "id string, n int"), path, buckets=4)
    assert lookup(spark, path, spark.createDataFrame([], "id string"), buckets=4).count() == 0
    got = lookup(spark, path, spark.createDataFrame([("b",), (None,)], "id string"), buckets=4).collect()
    assert sorted((r.id or "", r.found) for r in got) == [("", False), ("b", False)]
