"""Times, date parts, hour bands, one-hot columns and the cash share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txwarden.functions.staging import quoted
from txwarden.schema import require_columns

# First hour, first hour after the band.
HOUR_BANDS = {
    "hour_morning": (6, 12),
    "hour_afternoon": (12, 18),
    "hour_evening": (18, 24),
    "hour_night": (0, 6),
}


def wall_clock(df: DataFrame, column: str, *, lenient: bool = False) -> DataFrame:
    """Timestamp without zone that keeps the written clock time; a zone is dropped, not
    converted. Unreadable text raises, or becomes null when ``lenient``."""
    value = F.col(column)
    cast = value.try_cast("timestamp_ntz") if lenient else value.cast("timestamp_ntz")
    return df.withColumn(column, cast)


def micros_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end)


def with_date_parts(df: DataFrame, time: str = "transactionTime") -> DataFrame:
    """hour, day, month, weekday (Monday = 0) and is_weekend (0 for a missing time)."""
    weekday = F.weekday(time)
    return df.withColumns(
        {
            "hour": F.hour(time),
            "day": F.dayofmonth(time),
            "month": F.month(time),
            "weekday": weekday,
            "is_weekend": F.coalesce(weekday.isin(5, 6), F.lit(False)).cast("int"),
        }
    )


def with_hour_bands(df: DataFrame, hour: str = "hour") -> DataFrame:
    h = F.col(hour)
    return df.withColumns(
        {
            name: F.when((h >= first) & (h < end), 1).otherwise(0)
            for name, (first, end) in HOUR_BANDS.items()
        }
    )


def observed_categories(df: DataFrame, column: str, max_categories: int | None = None) -> list:
    """Sorted distinct values, which become columns; with ``max_categories`` an error, not a
    cut, when there are more than expected."""
    found = df.select(column).where(F.col(column).isNotNull()).distinct()
    if max_categories is not None:
        found = found.limit(max_categories + 1)
    values = [row[0] for row in found.collect()]
    if max_categories is not None and len(values) > max_categories:
        raise ValueError(f"{column} has more than {max_categories} categories")
    return sorted(values)


def one_hot(df: DataFrame, column: str, prefix: str, categories: Sequence) -> DataFrame:
    """0/1 column per category; a missing value is 0 in all of them."""
    require_columns(df, [column])
    names = {value: f"{prefix}_{value}" for value in categories}
    made = set(names.values())
    return df.select(
        *[quoted(c) for c in df.columns if c not in made],
        *[
            F.coalesce(F.col(column) == F.lit(value), F.lit(False)).cast("int").alias(name)
            for value, name in names.items()
        ],
    )


def with_weekday_columns(df: DataFrame, categories: Sequence[int] | None = None) -> DataFrame:
    """weekday_0 .. weekday_6, or one column per value of ``categories``."""
    return one_hot(df, "weekday", "weekday", range(7) if categories is None else categories)


def with_entry_mode_columns(
    df: DataFrame, categories: Sequence[str] | None = None, max_categories: int | None = None
) -> DataFrame:
    """pos_<value> per entry mode seen in the data, or per given category."""
    if categories is None:
        categories = observed_categories(df, "posEntryMode", max_categories)
    return one_hot(df, "posEntryMode", "pos", categories)


def with_cash_share(
    df: DataFrame, amount: str = "transactionAmount", cash: str = "availableCash"
) -> DataFrame:
    """amount / cash as a ratio; null instead of an infinity when there is no cash."""
    return df.withColumn("cash_pct_spent", F.try_divide(F.col(amount), F.col(cash)))
