"""Filling gaps and dropping columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from txwarden.config import DROPPED_COLUMNS
from txwarden.schema import require_columns

# The only columns whose gaps become 0.
ZERO_FILLED = (
    "transaction_velocity",
    "merchant_category_frequency",
    "time_since_last_transaction",
    "reported_delay",
)


def fill_missing(df: DataFrame, columns: Sequence[str] = ZERO_FILLED) -> DataFrame:
    require_columns(df, columns)
    return df.fillna(0, subset=list(columns))


def drop_columns(
    df: DataFrame, columns: Sequence[str] = DROPPED_COLUMNS, keep_key: str | None = None
) -> DataFrame:
    """Drop named columns, which must exist; ``keep_key`` is spared."""
    require_columns(df, columns)
    return df.drop(*[c for c in columns if c != keep_key])
