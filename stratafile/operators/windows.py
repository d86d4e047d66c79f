"""Positions, pages, cursors, top-N and streaks.

A window is used only where its partition is bounded (a page of at most 1000 rows, a time bucket) or where the
engine can trim each map task to N rows first. Ranks and running totals over an unbounded key go through
``running_total``, which splits the key over range partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratafile.session import checkpointed


def running_total(
    df: DataFrame, keys: list[str], order: list[str], value: Column, out: str, total: str | None = None
) -> DataFrame:
    """Exact running sum of ``value`` per key, in order, for keys of any size.

    Rows are range-partitioned by (key, order), so a hot key spans many partitions; each partition sums its own rows
    and adds the sum of the partitions before it. The partitioned rows are checkpointed, because both passes must see
    the same boundaries. Null keys are a key of their own; rows equal in ``order`` follow each other in some order.
    """
    spread = df.withColumn("_value", value).repartitionByRange(*[F.col(c) for c in [*keys, *order]])
    spread = checkpointed(spread.withColumn("_part", F.spark_partition_id()))
    # One row per (key, partition): at most the partition count plus the number of keys.
    parts = spread.groupBy(*keys, "_part").agg(F.sum("_value").alias("_part_sum"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        *keys,
        "_part",
        F.coalesce(F.sum("_part_sum").over(before), F.lit(0)).alias("_offset"),
        F.sum("_part_sum").over(Window.partitionBy(*keys)).alias("_total"),
    )
    local = (
        Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # keys may be null, so the offsets are matched null-safely
    matched = offsets.select(*[F.col(k).alias(f"_key_{k}") for k in keys], F.col("_part").alias("_of"), "_offset", "_total")
    same = F.col("_part") == F.col("_of")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    result = (
        spread.withColumn("_local", F.sum("_value").over(local))
        .join(matched, same)
        .withColumn(out, F.col("_local") + F.col("_offset"))
        .drop(*[f"_key_{k}" for k in keys], "_of")
    )
    if total:
        result = result.withColumn(total, F.col("_total"))
    return result.drop("_value", "_part", "_local", "_offset", "_total")


def last_so_far(df: DataFrame, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Last non-null ``value`` of a key among its rows up to and including each row, for keys of any size.

    Like :func:`running_total`: rows are range-partitioned by (key, order), each partition takes the last value of its own
    rows, and only where there is none the last one of the partitions before it. Rows with a null key, which are no group,
    get a value of their own row only; they are spread by ``order`` like all others. Nulls in ``order`` come first.
    """
    spread = df.repartitionByRange(*[F.col(c) for c in [*keys, *order]])
    spread = checkpointed(spread.withColumn("_part", F.spark_partition_id()))
    local = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # One row per (key, partition): at most the partition count plus the number of keys.
    place = F.when(F.col(value).isNotNull(), F.struct(*order))
    parts = spread.groupBy(*keys, "_part").agg(F.max_by(value, place).alias("_last"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select(*keys, "_part", F.last("_last", ignorenulls=True).over(before).alias("_carried"))
    grouped = F.lit(True)
    for k in keys:
        grouped = grouped & F.col(k).isNotNull()
    return (
        spread.withColumn("_local", F.last(value, ignorenulls=True).over(local))
        .join(carried, [*keys, "_part"], "left")
        .withColumn(out, F.when(grouped, F.coalesce("_local", "_carried")).otherwise(F.col(value)))
        .drop("_part", "_local", "_carried")
    )


def assign_pages(df: DataFrame, keys: list[str], order: list[str], page_size: int) -> DataFrame:
    """Cut an ordered listing into pages; adds ``page_no`` (from 0), ``batch_sequence``, ``batch_is_last`` and
    ``next_page_token`` (null on the last page)."""
    ranked = running_total(df, keys, order, F.lit(1).cast("bigint"), "_rank", "_rows")
    page = F.floor((F.col("_rank") - 1) / F.lit(page_size)).cast("bigint")
    last_page = F.floor((F.col("_rows") - 1) / F.lit(page_size)).cast("bigint")
    return (
        ranked.withColumn("page_no", page)
        .withColumn("batch_sequence", (F.col("_rank") - 1) - page * F.lit(page_size))
        .withColumn("batch_is_last", F.col("_rank") == F.col("_rows"))
        .withColumn("next_page_token", F.when(page < last_page, (page + 1).cast("string")))
        .drop("_rank", "_rows")
    )


def position_in_page(df: DataFrame, page: list[str], order: list[str], next_token: str | None = None) -> DataFrame:
    """Position of a row in its page; with a next token also whether it ends the listing.

    The source bounds a page (1000 rows), hence the window.
    """
    window = Window.partitionBy(*page)
    df = df.withColumn("batch_sequence", (F.row_number().over(window.orderBy(*order)) - 1).cast("bigint"))
    if next_token is None:
        return df.withColumn("batch_is_last", F.lit(False))
    last = (F.col("batch_sequence") + 1) == F.count(F.lit(1)).over(window)
    return df.withColumn("batch_is_last", last & F.col(next_token).isNull())


def numbered_copies(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """How many rows have a key that is to be there once (``_copies``), and which of them a row is (``_copy``, from 0)."""
    same = Window.partitionBy(key)
    return df.withColumns({
        "_copies": F.count(F.lit(1)).over(same),
        "_copy": (F.row_number().over(same.orderBy(*order)) - 1).cast("bigint"),
    })


def last_n(df: DataFrame, keys: list[str], order: list[Column], n: int, out: str = "rank") -> DataFrame:
    """Top ``n`` rows per key. The rank filter lets Spark cut each map task to ``n`` rows per key before the shuffle,
    so a hot key sends n rows per task."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(out, F.row_number().over(window)).where(F.col(out) <= n)


def latest_by(df: DataFrame, keys: list[str], order: list[str], carry: list[str]) -> DataFrame:
    """Newest row per key as an aggregate, combined in each map task before the shuffle."""
    newest = F.max_by(F.struct(*carry), F.struct(*order))
    return df.groupBy(*keys).agg(newest.alias("_row")).select(*keys, "_row.*")


def last_token(pages: DataFrame, keys: list[str], token: str = "new_start_page_token") -> DataFrame:
    """The token of the last page becomes the cursor; earlier pages carry none."""
    return pages.groupBy(*keys).agg(
        F.max_by(token, "page_no").alias("cursor"), F.max("page_no").alias("last_page"), F.count("*").alias("pages")
    )


def failure_streaks(
    calls: DataFrame,
    key: str,
    order: list[str],
    failed: Column,
    ts: str = "ts",
    threshold: int = 5,
    bucket_seconds: int = 600,
) -> DataFrame:
    """Runs of at least ``threshold`` consecutive failures per key.

    Runs are found inside short time buckets, so a key that owns most of the log is spread over its buckets. Runs
    that touch a bucket border are joined afterwards over one summary row per bucket, whose number depends on the
    time span and not on the number of calls.
    """
    bucket = F.floor(F.unix_micros(ts) / F.lit(bucket_seconds * 1_000_000)).cast("bigint")
    inside = Window.partitionBy(key, "_bucket").orderBy(*order)
    marked = (
        calls.select(key, ts, *[c for c in order if c != ts], failed.alias("_failed"))
        .withColumn("_bucket", bucket)
        .withColumn(
            "_run", F.sum((~F.col("_failed")).cast("int")).over(inside.rowsBetween(Window.unboundedPreceding, 0))
        )
    )
    runs = marked.groupBy(key, "_bucket", "_run").agg(
        F.count_if("_failed").alias("_length"),
        F.min(F.when(F.col("_failed"), F.col(ts))).alias("_start"),
        F.max(F.when(F.col("_failed"), F.col(ts))).alias("_end"),
    )
    per_bucket = Window.partitionBy(key, "_bucket")
    runs = runs.withColumn("_first_run", F.col("_run") == 0).withColumn(
        "_last_run", F.col("_run") == F.max("_run").over(per_bucket)
    )
    # A run that is neither first nor last in its bucket is complete.
    inner = runs.where(~F.col("_first_run") & ~F.col("_last_run")).select(key, "_length", "_start", "_end")
    border = runs.where(F.col("_first_run") | F.col("_last_run"))
    over_time = Window.partitionBy(key).orderBy("_bucket", "_run").rowsBetween(Window.unboundedPreceding, 0)
    # A border run starts a new streak when it begins with a success, that is when it is not run 0 of its bucket.
    stitched = (
        border.withColumn("_streak", F.sum((~F.col("_first_run")).cast("int")).over(over_time))
        .groupBy(key, "_streak")
        .agg(
            F.sum("_length").alias("_length"), F.min("_start").alias("_start"), F.max("_end").alias("_end")
        )
        .select(key, "_length", "_start", "_end")
    )
    return (
        inner.unionByName(stitched)
        .where(F.col("_length") >= threshold)
        .select(
            key,
            F.col("_length").alias("failures"),
            F.col("_start").alias("started_at"),
            F.col("_end").alias("ended_at"),
        )
    )
