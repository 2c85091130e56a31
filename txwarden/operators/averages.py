"""Mean amount of the row's country and hour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txwarden.functions.skew import (
    DEFAULT_SKEW,
    KeyProfile,
    SkewSettings,
    attach,
    profile_keys,
)
from txwarden.functions.staging import quoted

# Key column and the name of its mean.
AVERAGED_KEYS = {
    "merchantCountry": "avg_transaction_amount_by_country",
    "hour": "avg_transaction_amount_by_hour",
}


def with_average_amounts(
    df: DataFrame,
    amount: str = "transactionAmount",
    keys: dict[str, str] = AVERAGED_KEYS,
    row_key: str = "eventId",
    skew: SkewSettings = DEFAULT_SKEW,
    profiles: Sequence[KeyProfile] | None = None,
) -> DataFrame:
    """Mean of the known amounts per key, null for a null key. ``amount`` is used as it
    stands, scaled or not."""
    profiles = profiles or profile_keys(df, *[[k] for k in keys], settings=skew)
    out = df
    for (key, name), profile in zip(keys.items(), profiles):
        means = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.avg(amount).alias(name))
        out = attach(out, means, profile, [row_key])
    return out.select(*map(quoted, df.columns), *map(quoted, keys.values()))
