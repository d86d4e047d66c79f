"""Folds and bounded samples of labelled documents, for the two classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratafile.llm.tables import stored


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, rows: dict[int, int], max_bytes: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, y, text) to fit on, and how many labelled rows of each class there are outside the held-out fold.

    Of each class, the first ``rows[y]`` documents in hash order among those with a text of at most ``max_bytes``, so the
    sample is bounded and the same in each run. A doc_id with several labels counts as 1 if one of them does, one with
    several texts has the smallest of them; rows without label or doc_id are left out. A class that has labelled documents
    but only longer ones can't be fitted and is an error.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max(label).cast("int").alias("y"))
    known = known.where(fold("doc_id", folds) != held_out)
    counts = {int(r["y"]): int(r["n"]) for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= max_bytes)
    there = known.join(texts.select("doc_id").where("doc_id is not null").distinct(), "doc_id")
    picked = None
    for y, n in rows.items():
        part = there.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        picked = part if picked is None else picked.unionByName(part)
    picked = stored(picked, "picked")
    short = {int(r["y"]) for r in picked.select("y").distinct().collect()}
    if set(counts) - short and texts.where("doc_id is not null").join(F.broadcast(picked), "doc_id").limit(1).count():
        raise ValueError(f"no document of class {sorted(set(counts) - short)} has a text of at most {max_bytes} bytes")
    # the sample's size is bounded by its parameters
    own = texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    return own, counts
