"""The retry queue: what is due, what waits and what has used up its attempts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratafile.config import DriveConfig
from stratafile.functions import scalars as S

# Fixed values.
MAX_ATTEMPTS = 3
RETRY_BASE_SECONDS = 2.0
RETRY_MAX_SECONDS = 60.0
# End of fixed values.


def schedule(failures: DataFrame, cfg: DriveConfig, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Next attempt of failed messages.

    Input ``attempt`` (from 1), ``failed_at``, ``error_class``, ``retry_after`` (seconds or null). A wait the API asked
    for goes before the exponential wait; terminal errors and used-up attempts go to the dead letters.
    """
    exhausted = (F.col("attempt") >= max_attempts) | ~S.is_retriable(F.col("error_class"))
    wait = F.coalesce(
        F.col("retry_after").cast("double"),
        S.backoff_delay(F.col("attempt") - 1, base=RETRY_BASE_SECONDS, maximum=RETRY_MAX_SECONDS),
    )
    next_at = F.timestamp_micros(F.unix_micros("failed_at") + (wait * F.lit(1_000_000)).cast("bigint"))
    return (
        failures.withColumn("wait_seconds", F.when(~exhausted, wait))
        .withColumn("next_attempt_at", F.when(~exhausted, next_at))
        .withColumn(
            "disposition",
            F.when(exhausted, F.lit("dead_letter"))
            .when(next_at <= cfg.now, F.lit("due"))
            .otherwise(F.lit("waiting")),
        )
    )


def due(failures: DataFrame, cfg: DriveConfig) -> DataFrame:
    return schedule(failures, cfg).where(F.col("disposition") == "due")


def exhausted(failures: DataFrame, cfg: DriveConfig) -> DataFrame:
    return schedule(failures, cfg).where(F.col("disposition") == "dead_letter")
