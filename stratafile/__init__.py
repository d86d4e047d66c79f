"""Spark operators for cloud-drive metadata: listings, change feeds, commands, envelopes, state and metrics."""

from stratafile.config import DriveConfig

__all__ = ["DriveConfig"]
