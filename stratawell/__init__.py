"""Spark-native analytics for per-entity telemetry and production series."""

from stratawell.config import AlertRules, Series

__all__ = ["AlertRules", "Series"]
