"""Scores and the rows picked for review."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPREAD = 256


def top_n(
    df: DataFrame,
    score: str,
    n: int = 400,
    by: Sequence[str] = ("month",),
    row_key: str = "eventId",
    name: str = "review_rank",
) -> DataFrame:
    """The ``n`` rows with the lowest score per group, ties by key, nulls last; all rows
    when there are fewer.

    A first ranking runs within slices of input partitions (its group limit keeps ``n``
    rows per group and task before anything is shuffled), so the final ranking of a group
    sorts at most ``n`` x 256 rows however large the group is.
    """
    order = [F.col(score).asc_nulls_last(), F.col(row_key)]
    slices = F.pmod(F.spark_partition_id(), F.lit(SPREAD))
    first = Window.partitionBy(*by, "_slice").orderBy(*order)
    last = Window.partitionBy(*by).orderBy(*order)
    return (
        df.withColumn("_slice", slices)
        .withColumn("_r", F.row_number().over(first))
        .where(F.col("_r") <= n)
        .withColumn(name, F.row_number().over(last))
        .where(F.col(name) <= n)
        .drop("_slice", "_r")
    )


def flagged_rows(df: DataFrame, flagged: DataFrame, key: str = "eventId") -> DataFrame:
    """Rows of ``df`` whose key was flagged. The flagged side, review budget x months, is
    small and Spark decides on broadcasting it by its measured size."""
    return df.join(flagged.select(key), key, "left_semi")


def combined_score(
    probability: str = "probability",
    decision: str = "decision",
    raw: str = "anomaly",
    mode: str = "product",
) -> Column:
    """Ranking score, lowest first.

    ``product``: probability x decision, where a negative decision marks an anomaly.
    ``rank_positive``: minus probability x anomaly degree, so that likely and anomalous
    rows always lead.
    """
    if mode == "product":
        return F.col(probability) * F.col(decision)
    if mode == "rank_positive":
        return F.col(probability) * F.col(raw)
    raise ValueError(f"unknown score mode {mode!r}")
