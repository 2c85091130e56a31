"""Features and labels as they were known at the time: nothing from later rows or reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txwarden.functions.staging import Staging, quoted

# Key column, then names of the count and of the mean amount before the row.
ASOF_KEYS = {
    "accountNumber": ("accountNumber_freq_before", "avg_amount_by_account_before"),
    "merchantCountry": ("merchantCountry_freq_before", "avg_amount_by_country_before"),
}


def with_history(
    df: DataFrame,
    keys: dict[str, tuple[str, str]] = ASOF_KEYS,
    amount: str = "transactionAmount",
    time: str = "transactionTime",
    row_key: str = "eventId",
    staging: Staging | None = None,
) -> DataFrame:
    """``df`` with, for each key, the number of earlier rows of that key and the mean of their
    known amounts (null before the first one).

    Rows are earlier by time, then row key, then a hash of the row; null times come first. A null
    key has neither count nor mean. Per key column one exchange deals rows by ranges of key and
    order; a range starts from the sums of the key's ranges before it, so a key in a third of all
    rows, or one of 25 countries, is spread over all tasks."""
    staging = staging or Staging(df.sparkSession)
    row = F.xxhash64(*[F.col(quoted(c)) for c in df.columns])
    order = F.struct(F.col(quoted(time)), F.col(quoted(row_key)), row)
    known = F.col(quoted(amount)).cast("double")
    out = df.withColumns({"_order": order, "_known": known})
    for key, (count, mean) in keys.items():
        out = _with_totals_before(out, key, count, mean, staging)
    return out.drop("_order", "_known")


def _with_totals_before(
    df: DataFrame, key: str, count: str, mean: str, staging: Staging
) -> DataFrame:
    k = quoted(key)
    own = df.withColumn("_null", F.col(k).isNull())
    # null keys need no order: their hash spreads them over the ranges
    spread = F.when(F.col(k).isNull(), F.xxhash64("_order"))
    dealt = own.withColumn("_spread", spread).repartitionByRange(F.col(k), "_spread", "_order")
    dealt = staging.write(dealt.withColumn("_part", F.spark_partition_id()), "ranges")
    sums = dealt.where(~F.col("_null")).groupBy("_part", F.col(k).alias("_key")).agg(
        F.count(F.lit(1)).alias("_n"), F.count("_known").alias("_m"), F.sum("_known").alias("_s")
    )
    earlier = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    names = ("_n", "_m", "_s")
    starts = sums.select(
        F.col("_part").alias("_at"),
        "_key",
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_start{c}") for c in names],
    )
    inside = Window.partitionBy("_part", k, "_spread").orderBy("_order")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    amounts = {"_n": F.lit(1), "_m": F.col("_known").isNotNull().cast("int"), "_s": F.col("_known")}
    within = dealt.withColumns(
        {f"_in{c}": F.coalesce(F.sum(x).over(inside), F.lit(0)) for c, x in amounts.items()}
    )
    same = (F.col("_part") == F.col("_at")) & (F.col(k) == F.col("_key"))
    total = lambda c: F.col(f"_start{c}") + F.col(f"_in{c}")
    joined = within.join(starts, same, "left")
    return joined.select(
        *[quoted(c) for c in df.columns],
        total("_n").cast("long").alias(count),
        F.when(total("_m") > 0, total("_s") / total("_m")).alias(mean),
    )


def with_known_label(
    df: DataFrame, as_of: Column, reported: str = "reportedTime", name: str = "known_fraud"
) -> DataFrame:
    """1 where a report had arrived before ``as_of`` (a time, per row if need be), else 0: what
    a model trained at that time could have learned from."""
    return df.withColumn(name, F.coalesce(F.col(quoted(reported)) < as_of, F.lit(False)).cast("int"))
