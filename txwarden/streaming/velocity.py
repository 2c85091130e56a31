"""Transactions per account and tumbling window, for a stream of transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def stream_velocity(
    stream: DataFrame,
    hours: int = 24,
    lateness: str = "1 hour",
    account: str = "accountNumber",
    time: str = "transactionTime",
) -> DataFrame:
    """(account, window_start, window_end, transaction_velocity), each window once, as soon
    as no transaction can arrive for it any more; later ones are dropped.

    Watermarks need a zoned timestamp and its windows start at UTC midnight, so the
    session's time zone has to be UTC for windows to follow the wall clock. State holds
    one count per account and open window.
    """
    zone = stream.sparkSession.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC"):
        raise ValueError(f"set spark.sql.session.timeZone to UTC, not {zone}")
    return (
        stream.where(F.col(account).isNotNull())
        .withColumn("_t", F.col(time).cast("timestamp"))
        .withWatermark("_t", lateness)
        .groupBy(account, F.window("_t", f"{hours} hours").alias("_w"))
        .agg(F.count(F.lit(1)).alias("transaction_velocity"))
        .select(
            account,
            F.col("_w.start").cast("timestamp_ntz").alias("window_start"),
            F.col("_w.end").cast("timestamp_ntz").alias("window_end"),
            "transaction_velocity",
        )
    )


def write_available(velocities: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything that is available now to parquet and stop; run it again to go on
    from the checkpoint."""
    return (
        velocities.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def open_windows(
    spark: SparkSession, checkpoint: str, account: str = "accountNumber"
) -> DataFrame:
    """The windows that a stopped stream still counts, read from its state and shaped as the rows it
    appends. With those rows they make up every window; the stream goes on from its checkpoint."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select(
        F.col("key")[account].alias(account),
        F.col("key.window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("key.window.end").cast("timestamp_ntz").alias("window_end"),
        F.col("value.count").alias("transaction_velocity"),
    )
