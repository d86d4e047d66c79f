"""Settings every operator takes explicitly, so that results never depend on a clock or on the environment."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class DriveConfig:
    """Values injected into the operators.

    ``provider`` is the provider id carried by messages and idempotency keys, ``namespace`` the prefix of JSON-RPC
    method names and ``state_prefix`` the prefix of connection-state keys. ``run_ts`` is the ISO instant used
    wherever "now" is needed.
    """

    provider: str = "drive"
    namespace: str = "metadata"
    state_prefix: str = "drive"
    service_name: str = "drive-worker"
    transformation_version: str = "1.0.0"
    source_format: str = "drive_api_v3"
    run_ts: str = "2024-02-01T00:00:00Z"
    output_topic: str = "integrations-incoming-records"
    envelope_space_key: str = "space_path"

    def method(self, suffix: str) -> str:
        return f"{self.namespace}.integration.{suffix}"

    def state_key(self, name: str) -> str:
        return f"{self.state_prefix}_{name}"

    @property
    def fetch_method(self) -> str:
        return self.method("content.fetch")

    @property
    def write_method(self) -> str:
        return self.method("content.dispatch")

    @property
    def ingest_method(self) -> str:
        return self.method("content.ingest")

    @property
    def init_method(self) -> str:
        return self.method("connection.initialize")

    @property
    def teardown_method(self) -> str:
        return self.method("connection.teardown")

    @property
    def webhook_method(self) -> str:
        return self.method("webhook.notify")

    @property
    def capability_method(self) -> str:
        return self.method("capability.describe")

    @property
    def now(self) -> Column:
        return F.to_timestamp(F.lit(self.run_ts))
