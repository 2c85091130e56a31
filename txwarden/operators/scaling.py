"""Robust scaling by median and interquartile range."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txwarden.functions.quantiles import SMALL_ROWS, group_quantiles
from txwarden.functions.sketches import sketch_quantiles, sketch_table
from txwarden.functions.staging import quoted
from txwarden.schema import require_columns

QUARTILES = (0.25, 0.5, 0.75)


@dataclass(frozen=True)
class RobustScale:
    """Fitted scale: ``{column: (median, interquartile range)}``."""

    parameters: dict[str, tuple[float, float]]

    def transform(self, df: DataFrame) -> DataFrame:
        """(x - median) / range; nulls stay null and a range of 0 divides by 1."""
        return df.withColumns(
            {
                name: (F.col(quoted(name)) - F.lit(median)) / F.lit(spread if spread else 1.0)
                for name, (median, spread) in self.parameters.items()
            }
        )


def melt(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(``by``, column, value) with one row per non-null cell."""
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(quoted(c)).cast("double").alias("value"))
            for c in columns
        ]
    )
    long = df.select(*by, F.explode(cells).alias("_c")).select(*by, "_c.column", "_c.value")
    return long.where(F.col("value").isNotNull())


def fit_robust_scale(
    df: DataFrame, columns: Sequence[str], small_rows: int = SMALL_ROWS, method: str = "exact"
) -> RobustScale:
    """Quartiles of every column in one pass over ``df``: exact and linearly interpolated, or, with
    ``method="approx"``, from one sketch a column."""
    require_columns(df, columns)
    if method == "approx":
        return scale_from_sketches(sketch_table(melt(df, columns), "value", ["column"]), columns)
    if method != "exact":
        raise ValueError(f"method is exact or approx, not {method!r}")
    found = group_quantiles(melt(df, columns), "value", QUARTILES, ["column"], small_rows)
    parameters = {}
    for (name,), q in found.items():
        low, median, high = q.values
        parameters[name] = (median, high - low)
    return RobustScale({c: parameters[c] for c in columns if c in parameters})


def scale_from_sketches(sketches: DataFrame, columns: Sequence[str]) -> RobustScale:
    """Scale from a stored (column, sketch) table, one row a column; rows are not read again."""
    wanted = sketches.where(F.col("column").isin(list(columns)))
    quartiles = wanted.select("column", sketch_quantiles(QUARTILES).alias("q")).collect()
    found = {row["column"]: (row["q"][1], row["q"][2] - row["q"][0]) for row in quartiles}
    return RobustScale({c: found[c] for c in columns if c in found})


def scale_columns(
    df: DataFrame, columns: Sequence[str], small_rows: int = SMALL_ROWS, method: str = "exact"
) -> DataFrame:
    return fit_robust_scale(df, columns, small_rows, method).transform(df)
