"""The axis of periods: twelve months of one year, or the months of all years in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONTH, YEAR_MONTH = "month", "year_month"
FIRST_MONTH, LAST_MONTH = 1, 12


def year_month(time: str) -> Column:
    """Year and month as one number, e.g. 199803."""
    return (F.year(time) * 100 + F.month(time)).cast("int")


def following(period: int) -> int:
    return period + 1 if period % 100 < LAST_MONTH else period + 101 - LAST_MONTH


def preceding(period: int) -> int:
    return period - 1 if period % 100 > 1 else period - 101 + LAST_MONTH


def period_axis(df: DataFrame, period: str) -> list[int]:
    """All periods in order: the months of the year, or every month from the first to the last one
    found, months without rows among them. Any other column: the values found."""
    if period == MONTH:
        return list(range(FIRST_MONTH, LAST_MONTH + 1))
    if period != YEAR_MONTH:
        found = df.where(F.col(period).isNotNull()).select(period).distinct().orderBy(period)
        return [r[0] for r in found.collect()]
    first, last = df.agg(F.min(period), F.max(period)).first()
    axis = [] if first is None else [first]
    while axis and axis[-1] < last:
        axis.append(following(axis[-1]))
    return axis


def axis_table(df: DataFrame, period: str) -> DataFrame:
    return df.sparkSession.createDataFrame([(p,) for p in period_axis(df, period)], f"{period} int")
