"""Ranks over large groups, spread over many tasks."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txwarden.functions.quantiles import SMALL_ROWS, order_statistics
from txwarden.functions.staging import stage

#: Rows that one task ranks, on average.
BUCKET_ROWS = 50_000


def shuffle_key(key: str, seed: int) -> Column:
    """Seeded text that orders rows at random but the same way on every run."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))


def with_row_id(df: DataFrame, key: str, name: str) -> DataFrame:
    """Text that tells every row apart: the key where it is known and unique, otherwise the key
    and a number, which holds once the result is stored. Only keys are counted, and the few
    repeated ones, stored so that their number is known, are looked up: rows stay where they are."""
    again = df.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    again = again.where((F.col("_n") > 1) | F.col("_k").isNull()).select("_k", F.lit(1).alias("_again"))
    again = stage(again, "again")
    text = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    number = F.monotonically_increasing_id().cast("string")
    marked = df.join(again, F.col(key).eqNullSafe(F.col("_k")), "left")
    apart = F.when(F.col("_again").isNull(), text).otherwise(F.concat(text, F.lit("#"), number))
    return marked.withColumn(name, apart).drop("_k", "_again")


def hashed_rank(
    df: DataFrame, by: Sequence[str], key: str, seed: int, name: str, digits: int | None = None
) -> DataFrame:
    """0-based rank by :func:`shuffle_key` within each ``by`` group.

    The leading hex digits of the hash cut a group into equal buckets that follow the
    order, so a rank is the rank inside the bucket plus the sizes of the buckets before
    it. There are as many digits as leave about ``BUCKET_ROWS`` rows a bucket (counted), so a
    task's rows do not grow with the table; ranks are the same with any.
    """
    if digits is None:
        digits = max(1, math.ceil(math.log(max(df.count(), 1) / BUCKET_ROWS, 16)))
    hashed = df.withColumn("_h", shuffle_key(key, seed)).withColumn(
        "_b", F.substring("_h", 1, digits)
    )
    upto = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        hashed.groupBy(*by, "_b")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(upto), F.lit(0)))
        .select(*[F.col(c).alias(f"_o_{c}") for c in (*by, "_b")], "_before")
    )
    same = F.lit(True)
    for c in (*by, "_b"):
        same = same & F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    inside = Window.partitionBy(*by, "_b").orderBy("_h")
    return (
        hashed.withColumn("_i", F.row_number().over(inside))
        .join(offsets, same, "left")  # as its size asks for: it grows with the rows, if little
        .withColumn(name, F.col("_i") - 1 + F.col("_before"))
        .drop("_h", "_b", "_i", "_before", *[f"_o_{c}" for c in (*by, "_b")])
    )


def smallest(
    df: DataFrame,
    value: str,
    keep: dict[tuple, tuple[int, int]],
    by: Sequence[str],
    key: str,
    seed: int,
    small_rows: int = SMALL_ROWS,
) -> DataFrame:
    """Rows with the ``k`` smallest values per group, for ``{group: (rows, k)}`` of any size.

    The k-th value is found by exact selection; rows under it stay and ties on it are
    settled by hash order. Groups that are not in ``keep`` are kept whole.
    """
    cut = {g: (n, k) for g, (n, k) in keep.items() if k < n}
    if not cut:
        return df
    thresholds = order_statistics(
        df, value, {g: (n, k - 1) for g, (n, k) in cut.items() if k > 0}, by, small_rows
    )
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*by).schema)
    limits = df.sparkSession.createDataFrame(
        [(*g, k, thresholds.get(g)) for g, (_, k) in cut.items()],
        f"{fields}, _k long, _at double",
    )
    marked = df.join(F.broadcast(limits), list(by), "left")
    v = F.col(value)
    under = marked.where(F.col("_k").isNull() | (v < F.col("_at")))
    filled = under.where(F.col("_k").isNotNull()).groupBy(*by).agg(F.count(F.lit(1)).alias("_u"))
    ties = hashed_rank(marked.where(v == F.col("_at")), by, key, seed, "_tie")
    ties = ties.join(F.broadcast(filled), list(by), "left").where(
        F.col("_tie") < F.col("_k") - F.coalesce(F.col("_u"), F.lit(0))
    )
    return under.drop("_k", "_at").unionByName(ties.drop("_k", "_at", "_tie", "_u"))
