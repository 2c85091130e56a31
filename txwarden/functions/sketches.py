"""Quantile sketches as columns: built once, stored, merged over periods without rereading rows.

A KLL sketch of ``k`` entries answers a quantile with a rank error of about 1.33 % at k = 200 and
0.27 % at k = 1 000 (99 % of the time), whatever the rows; up to k rows it is exact. Sketches
merge without losing that bound. Compaction draws at random, so two runs may differ inside it;
the exact paths do not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Entries of a sketch; about 0.27 % of the rows as rank error.
ENTRIES = 1_000
#: Documented bound on the rank error at ``ENTRIES``, single quantile, 99 % of the time.
RANK_ERROR = 0.0027


def sketch_table(df: DataFrame, value: str, by: Sequence[str], entries: int = ENTRIES) -> DataFrame:
    """(``by``, rows, minimum, maximum, sketch) of the non-null values, partial sketches map-side."""
    v = F.col(value).cast("double")
    return df.where(v.isNotNull()).groupBy(*by).agg(
        F.count(v).alias("rows"),
        F.min(v).alias("minimum"),
        F.max(v).alias("maximum"),
        F.kll_sketch_agg_double(v, F.lit(entries)).alias("sketch"),
    )


def merged_sketches(sketches: DataFrame, by: Sequence[str], entries: int = ENTRIES) -> DataFrame:
    """The same table by coarser keys (a subset of its own), from the sketches alone."""
    return sketches.groupBy(*by).agg(
        F.sum("rows").alias("rows"),
        F.min("minimum").alias("minimum"),
        F.max("maximum").alias("maximum"),
        F.kll_merge_agg_double("sketch", F.lit(entries)).alias("sketch"),
    )


def sketch_quantiles(probabilities: Sequence[float], sketch: str = "sketch") -> Column:
    """Array of the sketch's quantiles, values that occur in the data, without interpolation."""
    return F.array(*[F.kll_sketch_get_quantile_double(sketch, F.lit(float(p))) for p in probabilities])
