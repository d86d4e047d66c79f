"""The capability manifest as a dimension: one row per operation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Action, operation, rate-limit cost, estimated latency in ms, paginated, filterable.
OPERATIONS = [
    ("init", "initialize", 1, 500, False, False),
    ("fetch", "files", 1, 300, True, True),
    ("fetch", "file", 1, 200, False, False),
    ("fetch", "folders", 1, 300, True, True),
    ("fetch", "folder", 1, 200, False, False),
    ("fetch", "permissions", 1, 200, True, False),
    ("fetch", "permission", 1, 150, False, False),
    ("fetch", "revisions", 1, 250, True, False),
    ("fetch", "revision", 1, 200, False, False),
    ("fetch", "changes", 1, 300, True, False),
    ("fetch", "about", 1, 150, False, False),
    ("write", "create_file", 5, 500, False, False),
    ("write", "update_file", 5, 400, False, False),
    ("write", "delete_file", 2, 300, False, False),
    ("write", "trash_file", 2, 250, False, False),
    ("write", "untrash_file", 2, 250, False, False),
    ("write", "create_folder", 2, 300, False, False),
    ("write", "copy_file", 5, 500, False, False),
    ("write", "move_file", 2, 300, False, False),
    ("write", "create_permission", 3, 400, False, False),
    ("write", "update_permission", 3, 300, False, False),
    ("write", "delete_permission", 2, 250, False, False),
    ("webhook", "parse_notification", 0, 50, False, False),
    ("teardown", "stop_channel", 1, 200, False, False),
]
# End of fixed values.


def capability_manifest(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        OPERATIONS,
        "action string, operation string, rate_limit_cost int, estimated_latency_ms int, paginated boolean, "
        "filterable boolean",
    )
