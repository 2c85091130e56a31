"""Running sums in ordered groups of any size, by ranges instead of one task a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txwarden.functions.staging import Staging


def with_running_total(
    df: DataFrame, by: Sequence[str], order: str, amount: str, name: str, staging: Staging
) -> DataFrame:
    """``df`` with ``name``: the sum of ``amount`` up to and with the row, in ``order`` within its
    ``by`` group (no nulls in either; equal orders in a group count in any order).

    Rows are dealt by ranges and summed within them; each range then starts from the sums of the
    group's ranges before it. A group in a third of all rows is a third of the ranges."""
    dealt = df.repartitionByRange(*by, order).withColumn("_part", F.spark_partition_id())
    dealt = staging.write(dealt, "ranges")
    keys = ["_part", *by]
    inside = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy(*keys).agg(F.sum(amount).alias("_sum"))
    starts = sums.select(*keys, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    summed = dealt.withColumn("_inside", F.sum(amount).over(inside))
    return summed.join(starts, keys).select(*df.columns, (F.col("_start") + F.col("_inside")).alias(name))
