"""Declared input schemas and column checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

TRANSACTIONS = T.StructType(
    [
        T.StructField("eventId", T.StringType()),
        T.StructField("accountNumber", T.StringType()),
        T.StructField("merchantId", T.StringType()),
        T.StructField("mcc", T.StringType()),
        T.StructField("merchantCountry", T.StringType()),
        T.StructField("merchantZip", T.StringType()),
        T.StructField("posEntryMode", T.StringType()),
        T.StructField("transactionAmount", T.DoubleType()),
        T.StructField("availableCash", T.DoubleType()),
        T.StructField("transactionTime", T.StringType()),
    ]
)

LABELS = T.StructType(
    [
        T.StructField("eventId", T.StringType()),
        T.StructField("reportedTime", T.StringType()),
    ]
)

RESULTS = T.StructType(
    [
        T.StructField("month", T.IntegerType()),
        T.StructField("precision", T.DoubleType()),
        T.StructField("f1_score", T.DoubleType()),
        T.StructField("true_frauds_flagged", T.LongType()),
        T.StructField("true_frauds", T.LongType()),
        T.StructField("amount_saved", T.DoubleType()),
        T.StructField("potential_amount_saved", T.DoubleType()),
    ]
)


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    """Raise ``ValueError`` for missing columns; Spark's own ``drop`` would ignore them."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; present: {df.columns}")
