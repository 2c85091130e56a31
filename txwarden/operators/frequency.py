"""How often a key, or a pair of keys, occurs in the whole set."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from txwarden.functions.skew import (
    DEFAULT_SKEW,
    KeyProfile,
    SkewSettings,
    attach,
    count_per_key,
    profile_keys,
)
from txwarden.functions.staging import quoted

FREQUENCY_KEYS = ("accountNumber", "merchantId", "mcc")


def with_key_frequency(
    df: DataFrame,
    keys: Sequence[str] = FREQUENCY_KEYS,
    row_key: str = "eventId",
    skew: SkewSettings = DEFAULT_SKEW,
    profiles: Sequence[KeyProfile] | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """<key>_freq: rows with the same key, null for a null key.

    ``counted`` names a cheaper table with the same rows to count in.
    """
    profiles = profiles or profile_keys(df, *[[k] for k in keys], settings=skew)
    counted = df if counted is None else counted
    out = df
    for key, profile in zip(keys, profiles):
        out = attach(out, count_per_key(counted, [key], f"{key}_freq"), profile, [row_key])
    return out.select(*map(quoted, df.columns), *[quoted(f"{k}_freq") for k in keys])


def with_pair_frequency(
    df: DataFrame,
    keys: Sequence[str] = ("accountNumber", "mcc"),
    name: str = "merchant_category_frequency",
    row_key: str = "eventId",
    skew: SkewSettings = DEFAULT_SKEW,
) -> DataFrame:
    """Rows sharing both keys; null when either is null."""
    (profile,) = profile_keys(df, keys, settings=skew)
    out = attach(df, count_per_key(df, keys, name), profile, [row_key])
    return out.select(*map(quoted, df.columns), quoted(name))
