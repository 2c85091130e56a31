"""Exact order statistics and quantiles without gathering a column in one task.

Small groups use Spark's ``percentile``. For larger ones each wanted rank is closed in on:
a quantile sketch proposes two pivots, one aggregate counts the rows on and between all
pivots, and the search goes on in the open intervals that hold ranks. Counts are exact,
so the answer is exact whatever the sketch's error, and a value repeated in a third of the
rows ends up as a pivot instead of in an interval.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SMALL_ROWS = 250_000
GRID = 500
SKETCH_ACCURACY = 5_000
#: Up to so many intervals are spelled out in the plan, which costs a row a few comparisons; more
#: are joined as a table.
SPELLED_INTERVALS = 24


@dataclass
class _Interval:
    """Open interval of a group's values that still holds wanted ranks."""

    group: tuple
    low: float | None  # exclusive bounds, None = open
    high: float | None
    below: int  # rows of the group at or under ``low``
    inside: int  # rows strictly between the bounds
    ranks: list[int]  # wanted 0-based ranks of the group in here


@dataclass(frozen=True)
class GroupQuantiles:
    rows: int
    minimum: float | None
    maximum: float | None
    values: tuple[float | None, ...]


def group_quantiles(
    df: DataFrame,
    value: str,
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    small_rows: int = SMALL_ROWS,
) -> dict[tuple, GroupQuantiles]:
    """Linear-interpolated quantiles per group, nulls ignored.

    For groups that the caller can name (the columns of a melted table); they may be any size.
    Groups found in the data go through ``quantile_table``, which keeps them in tables.
    """
    work = df.select(*by, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    sizes = {
        tuple(row[: len(by)]): (row["_n"], row["_lo"], row["_hi"])
        for row in work.groupBy(*by)
        .agg(F.count("_v").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        .collect()
        if row["_n"]
    }
    probabilities = [float(p) for p in probabilities]
    large = {group for group, (n, _, _) in sizes.items() if n > small_rows}
    values: dict[tuple, tuple] = {}
    if len(large) < len(sizes):
        small = _restrict(work, by, [g for g in sizes if g not in large]) if large else work
        wanted = F.percentile("_v", F.array(*map(F.lit, probabilities))).alias("_q")
        for row in small.groupBy(*by).agg(wanted).collect():
            if row["_q"] is not None:
                values[tuple(row[: len(by)])] = tuple(row["_q"])
    if large:
        ranks = {g: _ranks(sizes[g][0], probabilities) for g in large}
        found = _select(work, by, {g: (sizes[g][0], ranks[g]) for g in large}, small_rows)
        for group in large:
            n = sizes[group][0]
            picked = []
            for p in probabilities:
                position = (n - 1) * p
                low, high = math.floor(position), math.ceil(position)
                a, b = found[group, low], found[group, high]
                same = low == high or a == b
                picked.append(a if same else (high - position) * a + (position - low) * b)
            values[group] = tuple(picked)
    return {g: GroupQuantiles(n, lo, hi, values[g]) for g, (n, lo, hi) in sizes.items()}


def order_statistics(
    df: DataFrame,
    value: str,
    ranks: dict[tuple, tuple[int, int]],
    by: Sequence[str] = (),
    small_rows: int = SMALL_ROWS,
) -> dict[tuple, float]:
    """Value at 0-based ``rank`` for each group given as ``{group: (rows, rank)}``."""
    work = df.select(*by, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    found = _select(work, by, {g: (n, {r}) for g, (n, r) in ranks.items()}, small_rows)
    return {g: found[g, r] for g, (_, r) in ranks.items()}


def _ranks(rows: int, probabilities: Sequence[float]) -> set[int]:
    positions = [(rows - 1) * p for p in probabilities]
    return {math.floor(p) for p in positions} | {math.ceil(p) for p in positions}


def _restrict(work: DataFrame, by: Sequence[str], groups: list[tuple]) -> DataFrame:
    wanted = work.sparkSession.createDataFrame(groups, work.select(*by).schema)
    return _join_groups(work, wanted, by)


def _join_groups(work: DataFrame, small: DataFrame, by: Sequence[str]) -> DataFrame:
    """Inner join with a driver-built table of at most groups x ranks rows; null-safe."""
    others = [c for c in small.columns if c not in by]
    right = small.select(*[F.col(c).alias(f"_r_{c}") for c in by], *others)
    condition = F.lit(True)
    for c in by:
        condition = condition & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return work.join(F.broadcast(right), condition).drop(*[f"_r_{c}" for c in by])


def _select(work, by, wanted, small_rows) -> dict[tuple, float]:
    """{(group, rank): value} for ``wanted`` {group: (rows, ranks)}."""
    found: dict[tuple, float] = {}
    left = [_Interval(g, None, None, 0, n, sorted(ranks)) for g, (n, ranks) in wanted.items()]
    while large := [i for i in left if i.inside > small_rows]:
        left = [i for i in left if i.inside <= small_rows]
        left += _narrow(work, by, large, found)
    if left:
        _finish(work, by, left, found)
    return found


def _inside(
    work: DataFrame, by: Sequence[str], intervals: list[_Interval], extra: list[list[float]]
) -> DataFrame:
    """Rows of the intervals, which are disjoint, tagged with the interval's number."""
    rows = [
        (*i.group, number, i.low, i.high, values)
        for number, (i, values) in enumerate(zip(intervals, extra))
    ]
    names = "_t int, _low double, _high double, _extra array<double>"
    prefix = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in work.select(*by).schema.fields
    )
    small = work.sparkSession.createDataFrame(rows, f"{prefix}, {names}" if prefix else names)
    keys = list(by)
    if not keys:  # a constant key stands in when there is no grouping
        work, small, keys = work.withColumn("_g", F.lit(0)), small.withColumn("_g", F.lit(0)), ["_g"]
    within = (F.col("_low").isNull() | (F.col("_v") > F.col("_low"))) & (
        F.col("_high").isNull() | (F.col("_v") < F.col("_high"))
    )
    return _join_groups(work, small, keys).where(within).select("_t", "_v", "_extra")


def _tagged(work: DataFrame, by: Sequence[str], intervals: list[_Interval]) -> DataFrame:
    """(_t, _v): rows of the intervals, tagged with the interval's number."""
    if len(intervals) > SPELLED_INTERVALS:
        return _inside(work, by, intervals, [[] for _ in intervals]).select("_t", "_v")
    number = F.lit(None).cast("int")
    for k, i in reversed(list(enumerate(intervals))):
        within = F.lit(True)
        for field, value in zip(work.select(*by).schema.fields, i.group):
            within = within & F.col(field.name).eqNullSafe(F.lit(value).cast(field.dataType))
        if i.low is not None:
            within = within & (F.col("_v") > F.lit(i.low))
        if i.high is not None:
            within = within & (F.col("_v") < F.lit(i.high))
        number = F.when(within, k).otherwise(number)
    return work.select(number.alias("_t"), "_v").where(F.col("_t").isNotNull())


def _narrow(
    work: DataFrame, by: Sequence[str], intervals: list[_Interval], found: dict[tuple, float]
) -> list[_Interval]:
    """Put two pivots around each rank, count the rows on and between them, and return the
    gaps that hold ranks; ranks that fall on a pivot are done."""
    steps = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    sketch = {
        row["_t"]: row["_grid"]
        for row in _tagged(work, by, intervals)
        .groupBy("_t")
        .agg(F.percentile_approx("_v", steps, F.lit(SKETCH_ACCURACY)).alias("_grid"))
        .collect()
    }
    pivots = []
    for number, i in enumerate(intervals):
        around = set()
        for rank in i.ranks:
            position = (rank - i.below) / max(1, i.inside - 1) * GRID
            around.add(float(sketch[number][max(0, math.floor(position) - 1)]))
            around.add(float(sketch[number][min(GRID, math.ceil(position) + 1)]))
        pivots.append(sorted(around))
    # slot 2k: between pivots k-1 and k; slot 2k+1: on pivot k
    under = F.size(F.filter("_extra", lambda pivot: pivot < F.col("_v")))
    slot = under * 2 + F.array_contains("_extra", F.col("_v")).cast("int")
    counts: dict[int, dict[int, int]] = {}
    for row in (
        _inside(work, by, intervals, pivots).groupBy("_t", slot.alias("_s")).count().collect()
    ):
        counts.setdefault(row["_t"], {})[row["_s"]] = row["count"]
    gaps = []
    for number, i in enumerate(intervals):
        own, below = pivots[number], i.below
        for at in range(2 * len(own) + 1):
            rows = counts[number].get(at, 0)
            ranks = [r for r in i.ranks if below <= r < below + rows]
            k = at // 2
            if ranks and at % 2:
                found.update({(i.group, r): own[k] for r in ranks})
            elif ranks:
                low = own[k - 1] if k else i.low
                high = own[k] if k < len(own) else i.high
                gaps.append(_Interval(i.group, low, high, below, rows, ranks))
            below += rows
    return gaps


def _finish(
    work: DataFrame, by: Sequence[str], intervals: list[_Interval], found: dict[tuple, float]
) -> None:
    """Intervals of at most ``small_rows`` rows: running count over their distinct values."""
    wants = [[float(r - i.below) for r in i.ranks] for i in intervals]
    counted = _tagged(work, by, intervals).groupBy("_t", "_v").agg(F.count(F.lit(1)).alias("_n"))
    # looked up after counting: an array in the aggregate would make Spark sort all rows
    ranks = work.sparkSession.createDataFrame(list(enumerate(wants)), "_t int, _wants array<double>")
    upto = Window.partitionBy("_t").orderBy("_v")
    hits = (
        counted.withColumn("_upto", F.sum("_n").over(upto))
        .join(F.broadcast(ranks), "_t")
        .select("_t", "_v", "_n", "_upto", F.explode("_wants").alias("_want"))
        .where((F.col("_want") < F.col("_upto")) & (F.col("_want") >= F.col("_upto") - F.col("_n")))
    )
    for row in hits.collect():
        i = intervals[row["_t"]]
        found[i.group, int(row["_want"]) + i.below] = row["_v"]
