"""Key profiles and joins that stay balanced when one key holds much of the data.

``profile_keys`` finds heavy keys in one scan with Spark's frequent-items sketch: no
shuffle of the keys, bounded memory. The sketch only steers the physical strategy, so its
error never changes a result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SkewSettings:
    """A key is hot above ``min_hot_rows`` rows, what one task can sort, however large the
    table is. At most the ``max_hot_keys`` heaviest are told apart."""

    min_hot_rows: int = 1_000_000
    max_hot_keys: int = 50_000
    sketch_items: int = 500_000
    broadcast_keys: int = 1_000_000


DEFAULT_SKEW = SkewSettings()


@dataclass(frozen=True)
class KeyProfile:
    keys: tuple[str, ...]
    rows: int
    nulls: int
    groups: int
    hot: tuple[int, ...]
    salts: int
    broadcastable: bool
    #: Each hot key's hash and how many salts its rows are dealt over.
    dealt: tuple[tuple[int, int], ...] = ()

    @property
    def has_null(self) -> Column:
        return _any_null(self.keys)

    def with_shares(self, df: DataFrame, *keys: str) -> DataFrame:
        """``df`` with ``_shares``, how many salts the rows of a hot key are dealt over, by the key's
        own rows; null for other keys. Hot keys are a broadcast table: tens of thousands of them
        as literals cost the driver more than the join."""
        keys = keys or self.keys
        if not self.dealt:
            return df.withColumn("_shares", F.lit(None).cast("int"))
        hot = df.sparkSession.createDataFrame(list(self.dealt), "_hot long, _shares int")
        value = F.when(~_any_null(keys), F.xxhash64(*keys))
        return df.join(F.broadcast(hot), value == F.col("_hot"), "left").drop("_hot")

    def split(self, df: DataFrame, *keys: str) -> tuple[DataFrame, DataFrame]:
        """Rows of other keys, null ones among them, and rows of hot keys."""
        marked = self.with_shares(df, *keys)
        hot = F.col("_shares").isNotNull()
        return marked.where(~hot).drop("_shares"), marked.where(hot).drop("_shares")


def _any_null(keys: Sequence[str]) -> Column:
    test = F.col(keys[0]).isNull()
    for key in keys[1:]:
        test = test | F.col(key).isNull()
    return test


def profile_keys(
    df: DataFrame, *key_sets: Sequence[str], settings: SkewSettings = DEFAULT_SKEW
) -> list[KeyProfile]:
    """Profile several key sets in one job over just the key columns."""
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i, keys in enumerate(key_sets):
        value = F.when(~_any_null(keys), F.xxhash64(*keys))
        aggregates += [
            F.count(value).alias(f"n{i}"),
            F.approx_count_distinct(value, 0.03).alias(f"g{i}"),
            F.call_function(
                "approx_top_k", value, F.lit(settings.max_hot_keys), F.lit(settings.sketch_items)
            ).alias(f"t{i}"),
        ]
    found = df.agg(*aggregates).first()
    rows = found["rows"]
    limit = settings.min_hot_rows
    profiles = []
    for i, keys in enumerate(key_sets):
        heavy = [(t["item"], t["count"]) for t in found[f"t{i}"] or () if t["item"] is not None]
        hot = tuple(sorted(item for item, count in heavy if count > limit))
        nulls = rows - found[f"n{i}"]
        heaviest = max([count for _, count in heavy] + [nulls, 1])
        dealt = tuple((item, -(-count // limit)) for item, count in heavy if count > limit)
        profiles.append(
            KeyProfile(
                keys=tuple(keys),
                rows=rows,
                nulls=nulls,
                groups=found[f"g{i}"],
                hot=hot,
                salts=max(1, -(-heaviest // limit)),
                # 1.2 covers the estimator's error
                broadcastable=found[f"g{i}"] * 1.2 <= settings.broadcast_keys,
                dealt=dealt,
            )
        )
    return profiles


def attach(
    df: DataFrame, table: DataFrame, profile: KeyProfile, spread_by: Sequence[str]
) -> DataFrame:
    """Left-join ``table``, unique on the profiled keys, to ``df``.

    Few keys (checked): broadcast, the big side does not move. Otherwise one shuffle; rows
    of hot or null keys are dealt over salts and only the hot keys' table rows, at most
    ``max_hot_keys``, are repeated, each as often as its own rows ask for. The repeated table is
    never broadcast: it may be much larger than what it is made from.
    """
    keys = list(profile.keys)
    if profile.broadcastable:
        return df.join(F.broadcast(table), keys, "left")
    if profile.salts == 1:
        return df.join(table, keys, "left")
    one = F.coalesce("_shares", F.lit(1))
    spread = F.when(profile.has_null, F.lit(profile.salts)).otherwise(one)
    salt = F.pmod(F.xxhash64(*spread_by), spread).cast("int")
    copies = F.explode(F.sequence(F.lit(0), one - 1))
    salted = profile.with_shares(table).withColumn("_salt", copies).drop("_shares").hint("merge")
    return (
        profile.with_shares(df)
        .withColumn("_salt", salt)
        .drop("_shares")
        .join(salted, [*keys, "_salt"], "left")
        .drop("_salt")
    )


def count_per_key(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Rows per key, null keys left out; combined map-side, so hot keys stay cheap."""
    return df.where(~_any_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
