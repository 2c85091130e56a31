"""Joining reports to transactions: delay and label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txwarden.functions.skew import DEFAULT_SKEW, SkewSettings, profile_keys
from txwarden.functions.staging import quoted
from txwarden.operators.temporal import micros_between


def join_labels(
    tx: DataFrame,
    labels: DataFrame,
    key: str = "eventId",
    dedupe: str | None = None,
    null_salts: int = 256,
    skew: SkewSettings = DEFAULT_SKEW,
) -> DataFrame:
    """Left join of reports; a null key matches a null key and every report of an event
    keeps its own row, unless ``dedupe="first_report"``.

    Reports are few as a rule; up to ``broadcast_keys`` of them (counted) are broadcast and
    the transactions stay where they are. Otherwise null keys are dealt over salts on the
    left and repeated per salt on the right, and an event with very many reports is joined
    apart: its reports are dealt over salts and its transactions repeated (they all match,
    so the inner join loses nothing).
    """
    right = labels.select(F.col(key).alias("_k"), "reportedTime")
    if dedupe == "first_report":
        right = right.groupBy("_k").agg(F.min("reportedTime").alias("reportedTime"))
    elif dedupe is not None:
        raise ValueError(f"unknown dedupe {dedupe!r}")
    if right.count() <= skew.broadcast_keys:
        same = F.col(key).eqNullSafe(F.col("_k"))
        return tx.join(F.broadcast(right), same, "left").select(*map(quoted, tx.columns), "reportedTime")
    (profile,) = profile_keys(right.withColumnRenamed("_k", key), [key], settings=skew)
    left, plain = profile.split(tx)[0], profile.split(right, "_k")[0]
    others = [quoted(c) for c in tx.columns if c != key]
    deal = F.pmod(F.xxhash64(*others), F.lit(null_salts)).cast("int")
    left = left.withColumn("_s", F.when(F.col(key).isNull(), deal).otherwise(F.lit(0)))
    same_salt = F.col("_s") == F.col("_rs")
    if profile.nulls:
        copies = F.when(F.col("_k").isNull(), F.sequence(F.lit(0), F.lit(null_salts - 1)))
        plain = plain.withColumn("_rs", F.explode(copies.otherwise(F.array(F.lit(0)))))
        out = left.join(plain, F.col(key).eqNullSafe(F.col("_k")) & same_salt, "left")
    else:
        # without null reports a plain equality gives the same rows
        plain = plain.withColumn("_rs", F.lit(0))
        out = left.join(plain, (F.col(key) == F.col("_k")) & same_salt, "left")
    out = out.select(*map(quoted, tx.columns), "reportedTime")
    if profile.hot:
        hot = F.col("_shares").isNotNull()
        repeated = profile.with_shares(tx).where(hot)
        repeated = repeated.withColumn("_s", F.explode(F.sequence(F.lit(0), F.col("_shares") - 1)))
        dealt = profile.with_shares(right, "_k").where(hot).withColumn(
            "_rs", F.pmod(F.monotonically_increasing_id(), F.col("_shares")).cast("int")
        )
        hot = repeated.join(dealt, (F.col(key) == F.col("_k")) & (F.col("_s") == F.col("_rs")))
        out = out.unionByName(hot.select(*map(quoted, tx.columns), "reportedTime"))
    return out


def with_label_columns(
    df: DataFrame, time: str = "transactionTime", reported: str = "reportedTime"
) -> DataFrame:
    """reported_delay in hours (may be negative, null without a report) and Fraud 0/1."""
    delay = micros_between(F.col(time), F.col(reported)) / 3.6e9
    return df.withColumns(
        {"reported_delay": delay, "Fraud": F.col(reported).isNotNull().cast("int")}
    )
