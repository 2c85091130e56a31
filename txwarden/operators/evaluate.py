"""Precision, F1 and the amounts found by the review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txwarden.functions.periods import MONTH, YEAR_MONTH, axis_table


def precision_of(true_positives: Column, flagged: Column) -> Column:
    """TP / (TP + FP), 0 when nothing is flagged."""
    return F.coalesce(F.try_divide(true_positives, flagged), F.lit(0.0))


def f1_of(true_positives: Column, false_positives: Column, false_negatives: Column) -> Column:
    """2 TP / (2 TP + FP + FN), 0 when undefined."""
    return F.coalesce(
        F.try_divide(true_positives * 2, true_positives * 2 + false_positives + false_negatives),
        F.lit(0.0),
    )


def classification_metrics(
    df: DataFrame, label: str = "Fraud", predicted: str = "predicted", by: tuple[str, ...] = ()
) -> DataFrame:
    """Confusion counts, precision and F1 of 0/1 predictions, per group."""
    y, p = F.col(label) == 1, F.col(predicted) == 1
    counts = df.groupBy(*by).agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn")
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns({"precision": precision_of(tp, tp + fp), "f1_score": f1_of(tp, fp, fn)})


def monthly_evaluation(
    rows: DataFrame,
    flagged: DataFrame,
    period: str = "month",
    label: str = "Fraud",
    amount: str = "transactionAmount_original",
) -> DataFrame:
    """Result per month: what the review found against what there was.

    All flagged rows count as predicted positive and are judged on their own, so recall
    is 1 as soon as one is right. With ``period="month"`` all twelve months appear, with
    "year_month" all from the first to the last; one without rows has zero counts and null
    precision and F1.
    """
    fraud = F.col(label) == 1
    found = flagged.groupBy(period).agg(
        F.count(F.lit(1)).alias("flagged"),
        F.count_if(fraud).alias("true_frauds_flagged"),
        F.sum(F.when(fraud, F.col(amount))).alias("amount_saved"),
    )
    present = rows.groupBy(period).agg(
        F.count_if(fraud).alias("true_frauds"),
        F.sum(F.when(fraud, F.col(amount))).alias("potential_amount_saved"),
    )
    if period in (MONTH, YEAR_MONTH):
        present = axis_table(rows, period).join(present, period, "left")
    tp, n = F.col("true_frauds_flagged"), F.col("flagged")
    return (
        present.join(found, period, "left")
        .select(
            period,
            F.when(n.isNotNull(), precision_of(tp, n)).alias("precision"),
            F.when(n.isNotNull(), f1_of(tp, n - tp, F.lit(0))).alias("f1_score"),
            F.coalesce(tp, F.lit(0)).alias("true_frauds_flagged"),
            F.coalesce("true_frauds", F.lit(0)).alias("true_frauds"),
            F.coalesce("amount_saved", F.lit(0.0)).alias("amount_saved"),
            F.coalesce("potential_amount_saved", F.lit(0.0)).alias("potential_amount_saved"),
        )
        .orderBy(period)
    )


def yearly_totals(results: DataFrame) -> DataFrame:
    return results.agg(
        F.sum("amount_saved").alias("total_amount_saved"),
        F.sum("potential_amount_saved").alias("total_potential_amount_saved"),
    )
