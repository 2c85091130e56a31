"""Feature selection and the dense feature array."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txwarden.functions.staging import quoted

# Columns that never are features.
TARGETS = ("Fraud", "transactionAmount_original")
KEYS = ("eventId",)


def feature_columns(
    df: DataFrame, leak_reported_delay: bool = False, exclude: Sequence[str] = ()
) -> list[str]:
    """All numeric columns but the label, the original amount and the row key, in sorted
    order. ``reported_delay`` tells the label, so it takes part on request only."""
    skipped = {*TARGETS, *KEYS, *exclude}
    if not leak_reported_delay:
        skipped.add("reported_delay")
    numeric = (T.NumericType, T.BooleanType)
    return sorted(
        f.name for f in df.schema if f.name not in skipped and isinstance(f.dataType, numeric)
    )


def with_features(df: DataFrame, columns: Sequence[str], name: str = "features") -> DataFrame:
    """array<double> of ``columns``; missing values count as 0."""
    cells = [F.coalesce(F.col(quoted(c)).cast("double"), F.lit(0.0)) for c in columns]
    return df.withColumn(name, F.array(*cells))
