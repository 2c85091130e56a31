"""Quantiles, ranks and the exploratory tables."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from txwarden.functions.ordering import hashed_rank, shuffle_key, smallest
from txwarden.functions.quantile_tables import quantile_table
from txwarden.functions.quantiles import group_quantiles
from txwarden.functions.sketches import RANK_ERROR, merged_sketches, sketch_quantiles, sketch_table
from txwarden.operators.explore import (
    auto_histogram,
    box_stats,
    correlation_matrix,
    positive_values,
    value_share,
)
from txwarden.operators.profile import column_types, dataset_profile, missing_report
from txwarden.operators.scaling import fit_robust_scale

PROBABILITIES = (0.0, 0.1, 0.25, 0.5, 0.75, 1.0)


@pytest.fixture(scope="module")
def numbers(spark):
    """Three groups: spread values, one value in most rows, and very few rows."""
    rng = np.random.default_rng(1)
    rows = [("spread", float(x)) for x in rng.normal(size=6000) * 1e3]
    rows += [("spike", 5.0)] * 4000 + [("spike", float(x)) for x in rng.normal(size=3000)]
    rows += [("few", 1.0), ("few", 2.0), ("few", 4.0), ("empty", None), (None, 3.0)]
    return rows, spark.createDataFrame(rows, "g string, x double").repartition(5)


@pytest.mark.parametrize("small_rows", [10_000_000, 1000, 20])
def test_quantiles_are_exact_however_they_are_found(numbers, small_rows):
    rows, df = numbers
    found = group_quantiles(df, "x", PROBABILITIES, ["g"], small_rows)
    assert set(found) == {("spread",), ("spike",), ("few",), (None,)}
    for group in ("spread", "spike", "few", None):
        x = [v for g, v in rows if g == group]
        assert found[(group,)].rows == len(x)
        assert found[(group,)].values == pytest.approx(np.quantile(x, PROBABILITIES), rel=1e-12)


@pytest.mark.parametrize("small_rows", [10_000_000, 50])
def test_quantiles_without_groups(numbers, small_rows):
    rows, df = numbers
    x = [v for _, v in rows if v is not None]
    found = group_quantiles(df, "x", PROBABILITIES, (), small_rows)[()]
    assert found.values == pytest.approx(np.quantile(x, PROBABILITIES), rel=1e-12)
    assert group_quantiles(df.where("false"), "x", PROBABILITIES) == {}


def test_hashed_rank_equals_row_number(spark):
    df = spark.range(2000).withColumn("g", F.col("id") % 3)
    order = Window.partitionBy("g").orderBy(shuffle_key("id", 42))
    both = hashed_rank(df, ["g"], "id", 42, "r", digits=1).withColumn(
        "expected", F.row_number().over(order) - 1
    )
    assert both.where("r <> expected").count() == 0


@pytest.mark.parametrize("small_rows", [1_000_000, 20])
def test_smallest_with_ties(spark, small_rows):
    df = spark.range(900).select(
        "id", (F.col("id") % 2).alias("g"), F.floor(F.col("id") / 300).cast("double").alias("v")
    )
    got = smallest(df, "v", {(0,): (450, 200), (1,): (450, 0)}, ["g"], "id", 1, small_rows)
    counts = {(r["g"], r["v"]): r["count"] for r in got.groupBy("g", "v").count().collect()}
    assert counts == {(0, 0.0): 150, (0, 1.0): 50}
    assert got.select("id").distinct().count() == 200


def test_missing_report_and_profile(spark):
    df = spark.createDataFrame(
        [(1, None, 1), (2, None, 0), (3, "x", 0), (4, None, 0)], "a long, `b.c` string, Fraud int"
    )
    assert [tuple(r) for r in missing_report(df).collect()] == [
        ("b.c", 3, 75.0), ("Fraud", 0, 0.0), ("a", 0, 0.0)
    ]
    assert tuple(dataset_profile(df).first()) == (4, 3, 3, 25.0)
    assert [r["type"] for r in column_types(df).collect()] == ["bigint", "string", "int"]
    assert dataset_profile(df.where("false")).first()["fraud_percentage"] is None


def test_value_share(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,), ("a",)], "v string")
    assert [tuple(r) for r in value_share(df, "v").collect()] == [("a", 3, 0.75), ("b", 1, 0.25)]


def test_correlation(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=500) + 1e6
    y = 2 * x + rng.normal(size=500)
    z = [float(v) if i % 3 else None for i, v in enumerate(rng.normal(size=500))]
    only = [1.0 if v is not None else 0.0 for v in z]  # constant wherever z is known
    rows = [(float(a), float(b), c, 4.0, d) for a, b, c, d in zip(x, y, z, only)]
    df = spark.createDataFrame(rows, "x double, y double, z double, k double, o double")
    got = {(r[0], r[1]): r[2] for r in correlation_matrix(df.repartition(4), df.columns).collect()}
    assert len(got) == 25
    assert got["x", "y"] == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-12)
    known = np.array([v is not None for v in z])
    expected = np.corrcoef(x[known], np.array([v for v in z if v is not None]))[0, 1]
    assert got["x", "z"] == pytest.approx(expected, abs=1e-9)
    assert all(got[a, b] == got[b, a] for a, b in got)
    assert got["x", "x"] == 1.0 and got["k", "k"] is None and got["x", "k"] is None
    assert got["z", "o"] is None and got["o", "o"] == 1.0


def test_histogram(spark):
    def bins(xs):
        df = spark.createDataFrame([(float(x),) for x in xs], "x double")
        return [tuple(r) for r in auto_histogram(positive_values(df, "x"), "x").collect()]

    assert [b[3] for b in bins(range(1, 9))] == [2, 2, 2, 2]
    assert bins([3, 3]) == [(0, 2.5, 3.5, 2)]
    assert bins([]) == [] and bins([-1, -2]) == []
    x = np.random.default_rng(5).gamma(2.0, 10.0, size=3000)
    counts, edges = np.histogram(x, bins="auto")
    got = bins(x)
    assert [b[3] for b in got] == counts.tolist()
    assert [b[1] for b in got] == pytest.approx(edges[:-1].tolist())


def test_box(spark):
    rows = [(float(x), 0) for x in (1, 2, 3, 4, 100)] + [(7.0, 1), (None, 1)]
    df = spark.createDataFrame(rows, "x double, Fraud int")
    got = {r["Fraud"]: tuple(r)[2:] for r in box_stats(df, ["x"]).collect()}
    assert got[0] == (5, 2.0, 3.0, 4.0, 1.0, 4.0, 1)
    assert got[1] == (1, 7.0, 7.0, 7.0, 7.0, 7.0, 0)


@pytest.mark.parametrize("small_rows, sent_rows", [(10_000_000, 50_000), (1000, 50_000), (20, 50_000), (20, 0), (1, 0)])
def test_quantile_tables_are_exact_however_they_are_found(numbers, small_rows, sent_rows):
    rows, df = numbers
    table = quantile_table(df, "x", PROBABILITIES, ["g"], small_rows, sent_rows)
    found = {row["g"]: row for row in table.collect()}
    assert set(found) == {"spread", "spike", "few", None}
    for group, row in found.items():
        x = [v for g, v in rows if g == group and v is not None]
        assert (row["rows"], row["minimum"], row["maximum"]) == (len(x), min(x), max(x))
        assert row["quantiles"] == pytest.approx(np.quantile(x, PROBABILITIES), rel=1e-12)


@pytest.mark.parametrize("small_rows", [10_000_000, 50])
def test_quantile_table_without_groups_or_rows(numbers, small_rows):
    rows, df = numbers
    x = [v for _, v in rows if v is not None]
    (row,) = quantile_table(df, "x", PROBABILITIES, (), small_rows).collect()
    assert row["quantiles"] == pytest.approx(np.quantile(x, PROBABILITIES), rel=1e-12)
    assert quantile_table(df.where("false"), "x", PROBABILITIES, ["g"]).collect() == []


def test_quantile_table_of_many_large_groups(spark):
    """More groups than a driver dictionary was allowed to hold, a third of them beyond small_rows."""
    df = spark.range(360_000).select(
        (F.col("id") % 120_000).alias("g"), F.pmod(F.xxhash64("id"), F.lit(1000)).alias("x")
    )
    df = df.unionByName(df.where("g % 3 = 0"))
    table = quantile_table(df, "x", [0.5], ["g"], small_rows=4)
    expected = df.groupBy("g").agg(F.percentile("x", F.lit(0.5)).alias("m"))
    both = table.join(expected, "g")
    assert both.count() == 120_000
    assert both.where(F.abs(F.get("quantiles", 0) - F.col("m")) > 1e-9).count() == 0


def test_merged_sketches_keep_their_rank_error(spark):
    rng = np.random.default_rng(3)
    rows = [(int(m), float(x)) for m, x in zip(rng.integers(0, 12, 60_000), rng.exponential(size=60_000))]
    df = spark.createDataFrame(rows, "month int, x double").repartition(7)
    whole = merged_sketches(sketch_table(df, "x", ["month"]), [])
    p = (0.01, 0.25, 0.5, 0.75, 0.99)
    row = whole.select("rows", "minimum", "maximum", sketch_quantiles(p).alias("q")).first()
    x = np.sort([v for _, v in rows])
    assert (row["rows"], row["minimum"], row["maximum"]) == (60_000, x[0], x[-1])
    ranks = np.searchsorted(x, row["q"]) / len(x)
    assert np.abs(ranks - p).max() <= 3 * RANK_ERROR


def test_approximate_scales_boxes_and_histograms(spark):
    rng = np.random.default_rng(4)
    rows = [(float(x), None if i % 7 == 0 else float(i), i % 2) for i, x in enumerate(rng.normal(size=20_000))]
    df = spark.createDataFrame(rows, "a double, b double, Fraud int")
    exact, near = (fit_robust_scale(df, ["a", "b"], method=m).parameters for m in ("exact", "approx"))
    assert set(exact) == set(near)
    for name, (median, spread) in exact.items():
        assert near[name][0] == pytest.approx(median, abs=0.02 * spread)
        assert near[name][1] == pytest.approx(spread, rel=0.03)
    boxes = box_stats(df, ["a", "b"], method="approx").collect()
    assert sorted((b["feature"], b["Fraud"]) for b in boxes) == [("a", 0), ("a", 1), ("b", 0), ("b", 1)]
    assert sum(r["rows"] for r in auto_histogram(df, "a", method="approx").collect()) == 20_000
    assert auto_histogram(df.where("false"), "a", method="approx").collect() == []
    with pytest.raises(ValueError):
        fit_robust_scale(df, ["a"], method="guess")


def test_quantiles_of_few_large_groups_need_no_look_up(spark, monkeypatch):
    """Intervals spelled out in the plan and joined ones give NumPy's quantiles, also of null and
    repeated values and a null group."""
    from txwarden.functions import quantiles

    rng = np.random.default_rng(11)
    values = {"a": rng.normal(size=3000), "b": rng.integers(0, 5, 2000).astype(float), None: rng.gamma(2.0, 9.0, 1500)}
    rows = [(g, float(v)) for g, own in values.items() for v in own] + [("a", None), (None, None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    looked_up = []
    real = quantiles._inside
    monkeypatch.setattr(quantiles, "_inside", lambda *args: looked_up.append(any(args[3])) or real(*args))
    for most in (24, 0):
        monkeypatch.setattr(quantiles, "SPELLED_INTERVALS", most)
        found = quantiles.group_quantiles(df, "v", (0.0, 0.25, 0.5, 0.9, 1.0), ["g"], small_rows=100)
        # but for counting around pivots, which are many
        assert all(looked_up) == (most > 0)
        for group, own in values.items():
            assert found[(group,)].rows == len(own)
            want = np.quantile(own, (0.0, 0.25, 0.5, 0.9, 1.0))
            assert found[(group,)].values == pytest.approx(want.tolist(), rel=1e-12)
