"""Counters, rates, percentiles, quota and inventory reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stratafile.functions import scalars as S

# Monitoring goals.
ALERT_LIMITS = {"consumer_lag": 1000, "error_rate": 0.01, "p95_seconds": 5.0, "dead_letters": 100, "quota_share": 0.8}
USER_QUOTA = 1000
PROJECT_QUOTA = 12_000
QUOTA_SECONDS = 100
TARGET_MESSAGE_RATE = 100
# End of fixed values.


def worker_counters(outcomes: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Counters over final outcomes, each message counted once.

    Input ``outcome`` (ok, skipped, retriable, terminal), ``records, duplicates, offloaded, duration_ms``.
    """
    outcome = F.col("outcome")
    failed = outcome.isin("retriable", "terminal")
    return outcomes.groupBy(*(by or [])).agg(
        F.count_if(outcome == "ok").alias("messages_processed"),
        F.count_if(failed).alias("messages_failed"),
        F.count_if(outcome == "skipped").alias("messages_skipped"),
        F.sum("records").alias("records_produced"),
        F.count_if(failed).alias("errors_produced"),
        F.count_if(outcome == "retriable").alias("errors_retriable"),
        F.count_if(outcome == "terminal").alias("errors_terminal"),
        F.sum("duplicates").alias("duplicates_skipped"),
        F.sum("offloaded").alias("payloads_offloaded"),
        F.sum("duration_ms").alias("processing_ms"),
    )


def observed(df: DataFrame, name: str, outcome: str = "outcome") -> tuple[DataFrame, Observation]:
    """Counters collected while another action runs, without a pass of their own."""
    observation = Observation(name)
    failed = F.col(outcome).isin("retriable", "terminal")
    return df.observe(observation, F.count("*").alias("rows"), F.count_if(failed).alias("failed")), observation


def change_batch_summary(changes: DataFrame, page: list[str], yielded: Column) -> DataFrame:
    return changes.groupBy(*page).agg(
        F.count("*").alias("total_changes"),
        F.count_if(yielded).alias("total_yielded"),
        (F.count("*") - F.count_if(yielded)).alias("skipped"),
    )


def api_calls_by_code(calls: DataFrame) -> DataFrame:
    """Calls and errors per endpoint and status; a call without a status is a network error."""
    return calls.groupBy("endpoint", "status_code").agg(
        F.count("*").alias("calls"),
        F.count_if(S.error_class(F.col("status_code")).isNotNull()).alias("errors"),
    )


def latency_percentiles(calls: DataFrame, percentages: list[float], digits: int = 2) -> DataFrame:
    """Exact percentiles per endpoint over a histogram of latencies.

    Calls are first counted per (endpoint, latency), so the last step sees one row per distinct latency, whose number
    is bounded by the clock's resolution and not by the number of calls.
    """
    histogram = calls.groupBy("endpoint", F.round("latency_ms", digits).alias("latency_ms")).agg(
        F.count("*").alias("n")
    )
    return histogram.groupBy("endpoint").agg(
        F.sum("n").alias("calls"),
        *[
            F.round(F.percentile("latency_ms", F.lit(p), F.col("n")), 6).alias(f"p{round(p * 100)}")
            for p in percentages
        ],
    )


def alerts(calls: DataFrame, error_rate: float | None = None, p95_ms: float | None = None) -> DataFrame:
    """Endpoints that miss a monitoring goal."""
    error_rate = ALERT_LIMITS["error_rate"] if error_rate is None else error_rate
    p95_ms = ALERT_LIMITS["p95_seconds"] * 1000 if p95_ms is None else p95_ms
    rates = api_calls_by_code(calls).groupBy("endpoint").agg(
        F.sum("calls").alias("calls"), F.sum("errors").alias("errors")
    )
    latency = latency_percentiles(calls, [0.95]).select("endpoint", "p95")
    rate = F.col("errors") / F.col("calls")
    return (
        rates.join(latency, "endpoint")
        .withColumn("error_rate", F.round(rate, 6))
        .withColumn("error_rate_high", rate >= error_rate)
        .withColumn("p95_high", F.col("p95") >= p95_ms)
        .where(F.col("error_rate_high") | F.col("p95_high"))
    )


def request_cost(requests: DataFrame, manifest: DataFrame) -> DataFrame:
    """Declared cost and latency of requests per connection; a request for an unknown operation costs nothing and is
    counted apart. Requests are counted per operation before they meet the manifest."""
    counted = requests.groupBy("connection_id", "action", "operation").agg(F.count("*").alias("_n"))
    costs = manifest.select("action", "operation", "rate_limit_cost", "estimated_latency_ms")
    return (
        counted.join(costs, ["action", "operation"], "left")
        .groupBy("connection_id")
        .agg(
            F.sum("_n").alias("requests"),
            F.sum(F.when(F.col("rate_limit_cost").isNull(), F.col("_n")).otherwise(0)).alias("unknown_requests"),
            F.sum(F.coalesce(F.col("rate_limit_cost"), F.lit(0)) * F.col("_n")).alias("cost"),
            F.sum(F.coalesce(F.col("estimated_latency_ms"), F.lit(0)) * F.col("_n")).alias("estimated_ms"),
        )
    )


def dead_letter_alerts(errors: DataFrame, limit: int | None = None) -> DataFrame:
    """Providers and error codes with more terminal errors than the goal allows."""
    limit = ALERT_LIMITS["dead_letters"] if limit is None else limit
    return (
        errors.where(F.col("error_type") == "terminal")
        .groupBy("provider", "error_code")
        .agg(F.count("*").alias("dead_letters"))
        .where(F.col("dead_letters") >= limit)
    )


def consumer_lag(messages: DataFrame, committed: DataFrame, limit: int | None = None) -> DataFrame:
    """Messages behind the committed position per partition of the log.

    Input ``partition, offset`` and ``partition, committed`` (next offset to read; none means nothing was read).
    """
    limit = ALERT_LIMITS["consumer_lag"] if limit is None else limit
    newest = messages.groupBy("partition").agg(F.max("offset").alias("newest"), F.min("offset").alias("oldest"))
    lag = F.col("newest") + 1 - F.coalesce(F.col("committed"), F.col("oldest"))
    return newest.join(committed, "partition", "left").select(
        "partition", lag.alias("lag"), (lag >= limit).alias("lag_high")
    )


def quota_windows(
    calls: DataFrame,
    by: list[str],
    limit: int = USER_QUOTA,
    seconds: int = QUOTA_SECONDS,
    alert_share: float | None = None,
) -> DataFrame:
    """Tumbling windows whose calls exceed the quota (or, with a share, come near it).

    ``by`` names the user columns; an empty list is the project's own quota, counted over partial sums.
    """
    share = 1.0 if alert_share is None else alert_share
    return (
        calls.groupBy(*by, F.window("ts", f"{seconds} seconds"))
        .agg(F.count("*").alias("calls"))
        .where(F.col("calls") > F.lit(limit) * F.lit(share))
        .select(
            *by,
            F.unix_seconds("window.start").alias("window_start"),
            "calls",
            F.round(F.col("calls") / F.lit(limit), 6).alias("quota_share"),
        )
    )


def throughput(messages: DataFrame, by: str, seconds: int = 60, target: int = TARGET_MESSAGE_RATE) -> DataFrame:
    """Messages per type and window, and whether the rate is above the scaling target."""
    rate = F.col("messages") / F.lit(seconds)
    return (
        messages.groupBy(by, F.window("ts", f"{seconds} seconds"))
        .agg(F.count("*").alias("messages"))
        .select(
            by,
            F.unix_seconds("window.start").alias("window_start"),
            "messages",
            F.round(rate, 6).alias("per_second"),
            (rate > target).alias("above_target"),
        )
    )


def inventory(files: DataFrame) -> DataFrame:
    """Files and bytes per category, type and first owner."""
    owner = F.coalesce(F.get("owners", F.lit(0))["email"], F.lit("none"))
    return files.groupBy("category", "type", owner.alias("owner")).agg(
        F.count("*").alias("files"),
        F.sum(F.coalesce("size_bytes", F.lit(0))).alias("bytes"),
        F.count_if("shared").alias("shared_files"),
    )


def permission_counts(permissions: DataFrame) -> DataFrame:
    return permissions.groupBy("file_id").agg(
        F.count("*").alias("permissions"),
        F.count_if(F.col("role").isin("owner", "writer")).alias("editors"),
        F.count_if(F.col("permission_type") == "anyone").alias("public_links"),
    )
