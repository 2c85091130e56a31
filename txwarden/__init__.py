"""Spark-native transaction-risk features, scoring and review reports."""

from txwarden.config import JobConfig

__all__ = ["JobConfig"]
