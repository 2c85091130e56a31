"""Seconds since the account's last transaction, for a stream of transactions."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

SALTS = 64


def stream_gaps(
    stream: DataFrame,
    account: str = "accountNumber",
    time: str = "transactionTime",
    row_key: str = "eventId",
) -> DataFrame:
    """(row key, account, time, ``time_since_last_transaction``), each row once.

    State is one time per account, its latest so far. Rows of one micro-batch are ordered by time
    and row key; a row older than the account's latest of earlier batches gets no gap and changes
    nothing, as its neighbours have left. Rows without an account or time get no gap and keep no
    state: they are dealt over ``SALTS`` groups. Row keys are not null. An account's rows of one micro-batch meet in one
    task: bound the batch with ``maxFilesPerTrigger`` where one account is a third of all rows.
    """
    dealt = F.pmod(F.xxhash64(row_key), F.lit(SALTS)).cast("int")
    plain = F.col(account).isNull() | F.col(time).isNull()
    rows = stream.select(
        F.col(row_key).alias("row"),
        F.col(account).alias("account"),
        F.unix_micros(F.col(time).cast("timestamp")).alias("at"),
        F.when(plain, dealt).otherwise(F.lit(-1)).alias("salt"),
    )
    fields = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = f"row {fields['row']}, account {fields['account']}, at bigint, gap double"

    def gaps(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if key[1] >= 0:
            for part in batches:
                yield part.assign(gap=None)[["row", "account", "at", "gap"]].astype({"gap": "float64"})
            return
        seen = pd.concat(list(batches), ignore_index=True).sort_values(["at", "row"], kind="stable")
        last = state.get[0] if state.exists else None
        fresh = seen if last is None else seen[seen["at"] >= last]
        before = fresh["at"].shift(1).astype("float64")
        if last is not None and len(fresh):
            before.iloc[0] = last
        if len(fresh):
            state.update((int(fresh["at"].iloc[-1]),))
        seen = seen.assign(gap=((fresh["at"] - before) / 1e6).reindex(seen.index))
        yield seen[["row", "account", "at", "gap"]]

    found = rows.groupBy("account", "salt").applyInPandasWithState(
        gaps, schema, "last bigint", "append", GroupStateTimeout.NoTimeout
    )
    return found.select(
        F.col("row").alias(row_key),
        F.col("account").alias(account),
        F.timestamp_micros("at").cast("timestamp_ntz").alias(time),
        F.col("gap").alias("time_since_last_transaction"),
    )
