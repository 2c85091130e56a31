"""Time since the previous transaction of the same account."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txwarden.functions.skew import DEFAULT_SKEW, SkewSettings, profile_keys
from txwarden.functions.staging import stage
from txwarden.operators.temporal import micros_between
from txwarden.operators.velocity import MINUTE_MICROS, clock_micros


def gap_to_previous(account: str, time: str, row_key: str) -> Column:
    """Seconds to the preceding row of the account; ties in time are ordered by key."""
    order = Window.partitionBy(account).orderBy(F.col(time).asc_nulls_last(), row_key)
    return micros_between(F.lag(time).over(order), F.col(time)) / 1e6


def with_gap(
    df: DataFrame,
    account: str = "accountNumber",
    time: str = "transactionTime",
    row_key: str = "eventId",
    skew: SkewSettings = DEFAULT_SKEW,
) -> DataFrame:
    """time_since_last_transaction in seconds; null on an account's first row and for a
    missing account. Of rows with the same account and time the first by ``row_key``, null
    first, has the gap and the others 0; the key need not be unique."""
    name = "time_since_last_transaction"
    (profile,) = profile_keys(df, [account], settings=skew)
    plain, hot = profile.split(df)
    out = plain.where(~profile.has_null).withColumn(name, gap_to_previous(account, time, row_key))
    if profile.hot:
        out = out.unionByName(_hot_gaps(hot, account, time, row_key, name))
    if profile.nulls:
        unknown = df.where(profile.has_null).withColumn(name, F.lit(None).cast("double"))
        out = out.unionByName(unknown)
    return out


def _hot_gaps(df: DataFrame, account: str, time: str, row_key: str, name: str) -> DataFrame:
    """Among rows of one account and time only the first can have a gap other than 0, so
    the work shrinks to distinct times, cut by minute: inside a minute a window looks back,
    and a minute's first time takes the last one of the minute before. The rows are staged
    with a number of their own, so that null or repeated keys cannot match another row."""
    df = stage(df.withColumn("_row", F.monotonically_increasing_id()), "hot")
    moments = (
        df.where(F.col(time).isNotNull())
        .withColumn("_us", clock_micros(time))
        .groupBy(account, "_us")
        .agg(F.min(F.struct(row_key, "_row"))["_row"].alias("_first"))
        .withColumn("_m", F.floor(F.col("_us") / MINUTE_MICROS))
    )
    minutes = moments.groupBy(account, "_m").agg(F.max("_us").alias("_last"))
    previous = Window.partitionBy(account).orderBy("_m")
    minutes = minutes.select(account, "_m", F.lag("_last").over(previous).alias("_carry"))
    inside = Window.partitionBy(account, "_m").orderBy("_us")
    gaps = (
        moments.withColumn("_prev", F.lag("_us").over(inside))
        .join(minutes, [account, "_m"])
        .select(
            F.col("_first"),
            ((F.col("_us") - F.coalesce("_prev", "_carry")) / 1e6).alias("_gap"),
        )
    )
    later = F.when(F.col(time).isNotNull(), F.lit(0.0))
    return (
        df.join(gaps, F.col("_row") == F.col("_first"), "left")
        .withColumn(name, F.when(F.col("_first").isNotNull(), F.col("_gap")).otherwise(later))
        .drop("_first", "_gap", "_row")
    )
