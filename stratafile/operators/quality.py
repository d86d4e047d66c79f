"""Error records and dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratafile.config import DriveConfig
from stratafile.functions import scalars as S
from stratafile.operators.messages import customer_id_of

ERROR_COLUMNS = [
    "provider", "connection_id", "customer_id", "error_type", "error_code", "error_category", "error_message",
    "source_message_id", "details", "retry_after",
]


def error_records(
    df: DataFrame,
    cfg: DriveConfig,
    error_class: Column,
    message: Column,
    connection_id: Column,
    customer_id: Column | None = None,
    source_message_id: Column | None = None,
    details: Column | None = None,
    retry_after: Column | None = None,
    category: Column | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Classified error rows; rows whose class is null are no errors and are left out."""
    null = F.lit(None)
    return df.where(error_class.isNotNull()).select(
        *keep,
        F.lit(cfg.provider).alias("provider"),
        connection_id.alias("connection_id"),
        F.coalesce(customer_id if customer_id is not None else null.cast("string"), F.lit("unknown")).alias(
            "customer_id"
        ),
        F.when(S.is_retriable(error_class), F.lit("retriable")).otherwise(F.lit("terminal")).alias("error_type"),
        F.upper(error_class).alias("error_code"),
        (S.error_category(error_class) if category is None else category).alias("error_category"),
        message.alias("error_message"),
        (source_message_id if source_message_id is not None else null.cast("string")).alias("source_message_id"),
        (details if details is not None else null.cast("string")).alias("details"),
        (retry_after if retry_after is not None else null.cast("int")).alias("retry_after"),
    )


def api_errors(calls: DataFrame, cfg: DriveConfig, keep: tuple[str, ...] = ()) -> DataFrame:
    """Error rows of an API-call log; rate limits carry the wait the API asked for."""
    status = F.col("status_code")
    name = S.error_class(status)
    message = (
        F.when(status.isNull(), F.lit("no answer from the API"))
        .when(status == 429, F.lit("throttled by the API"))
        .when(status.isin(401, 403), F.concat(F.lit("credentials refused, status "), status.cast("string")))
        .when(status >= 500, F.concat(F.lit("server failure, status "), status.cast("string")))
        .otherwise(
            F.concat(
                F.lit("request refused, status "),
                status.cast("string"),
                F.lit(" - "),
                F.coalesce(F.get_json_object(S.api_error_body(F.col("body")), "$.message"), S.api_error_body(F.col("body"))),
            )
        )
    )
    return error_records(
        calls,
        cfg,
        name,
        message,
        F.col("connection_id"),
        details=F.when(status >= 500, F.to_json(F.struct(status.alias("status_code")))),
        retry_after=F.when(status == 429, S.retry_after_seconds(F.col("retry_after"))),
        keep=keep,
    )


def validation_errors(df: DataFrame, cfg: DriveConfig, error_field: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Error rows of routed messages that failed validation."""
    return error_records(
        df,
        cfg,
        F.when(F.col(error_field).isNotNull(), F.lit("ValidationError")),
        F.concat(F.lit("Invalid or missing field: "), F.col(error_field)),
        F.col("connection_id"),
        customer_id=customer_id_of(),
        source_message_id=F.col("message_id"),
        details=F.to_json(F.struct(F.col(error_field).alias("field"))),
        keep=keep,
    )
