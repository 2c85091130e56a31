"""Ranking, evaluation, reports and folds."""

import pytest
from pyspark.sql import functions as F

from txwarden.operators.evaluate import monthly_evaluation, yearly_totals
from txwarden.operators.folds import best_fold, fold_precision, with_folds
from txwarden.operators.ranking import combined_score, flagged_rows, top_n
from txwarden.operators.report import cumulative_saved, detected_share, metric_series


def test_top_n_ties_and_short_groups(spark):
    rows = [(1, 1, 3.0), (2, 1, 1.0), (3, 1, 2.0), (4, 1, 1.0), (5, 1, None), (6, 2, 0.0)]
    df = spark.createDataFrame(rows, "eventId long, month int, score double").repartition(3)
    picked = [(r["month"], r["review_rank"], r["eventId"]) for r in top_n(df, "score", 2).collect()]
    assert sorted(picked) == [(1, 1, 2), (1, 2, 4), (2, 1, 6)]
    ranks = {r["eventId"]: r["review_rank"] for r in top_n(df, "score", 9).collect()}
    assert ranks == {2: 1, 4: 2, 3: 3, 1: 4, 5: 5, 6: 1}
    assert flagged_rows(df, top_n(df, "score", 1)).count() == 2


def test_top_n_limits_before_the_shuffle(spark):
    df = spark.range(1000).select(
        F.col("id").alias("eventId"), (F.col("id") % 2).alias("month"), F.rand(1).alias("score")
    )
    plan = top_n(df, "score", 400)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 4


def test_evaluation(spark):
    rows = [(1, 1, 1, 10.0), (2, 1, 0, 5.0), (3, 1, 0, 5.0), (4, 1, 0, 5.0)]
    rows += [(5, 1, 1, 20.0), (6, 1, 1, 30.0), (7, 2, 0, 1.0), (8, 2, 1, 2.0)]
    schema = "eventId long, month int, Fraud int, transactionAmount_original double"
    df = spark.createDataFrame(rows, schema)
    flagged = df.where("eventId <= 4 or eventId = 7")
    results = monthly_evaluation(df, flagged)
    got = {r["month"]: tuple(r)[1:] for r in results.collect()}
    assert set(got) == set(range(1, 13))
    assert got[1] == (0.25, 0.4, 1, 3, 10.0, 60.0)
    assert got[2] == (0.0, 0.0, 0, 1, 0.0, 2.0)
    assert got[3] == (None, None, 0, 0, 0.0, 0.0)
    assert tuple(yearly_totals(results).first()) == (10.0, 62.0)
    share = {r["month"]: r["detected_percent"] for r in detected_share(results).collect()}
    assert share[1] == pytest.approx(100 / 3) and share[2] == 0.0 and share[3] is None


def test_report_series(spark):
    rows = [(1, 0.5, 0.6, 5, 100, 10.0), (2, 0.1, 0.2, 15, 100, 1.0)]
    results = spark.createDataFrame(
        rows,
        "month int, precision double, f1_score double, true_frauds_flagged long, "
        "true_frauds long, amount_saved double",
    )
    assert [r[2] for r in cumulative_saved(results).collect()] == [10.0, 11.0]
    assert [tuple(r) for r in metric_series(results).collect()] == [
        (1, "f1_score", 0.6), (1, "precision", 0.5), (2, "f1_score", 0.2), (2, "precision", 0.1)
    ]
    assert [tuple(r)[1:] for r in detected_share(results).collect()] == [(5.0, 25.0), (15.0, 75.0)]


def test_folds_are_even_and_stable(spark):
    df = spark.range(997).select(
        F.col("id").alias("eventId"), (F.col("id") % 2).alias("month"),
        (F.col("id") % 7 == 0).cast("int").alias("Fraud"),
    )
    folded = with_folds(df)
    sizes = {}
    for r in folded.groupBy("month", "Fraud", "fold").count().collect():
        sizes.setdefault((r["month"], r["Fraud"]), []).append(r["count"])
    assert all(len(s) == 5 and max(s) - min(s) <= 1 for s in sizes.values())
    again = with_folds(df.repartition(17)).withColumnRenamed("fold", "again")
    assert folded.join(again, "eventId").where("fold <> again").count() == 0
    hashed = with_folds(df, method="hash").groupBy("fold").count().collect()
    assert len(hashed) == 5 and all(r["count"] > 100 for r in hashed)


def test_fold_choice(spark):
    rows = [(0, 1, 0.9), (0, 0, 0.8), (1, 1, 0.7), (1, 0, 0.5), (2, 1, 0.6), (2, 0, 0.1)]
    df = spark.createDataFrame(rows, "fold int, Fraud int, probability double")
    precision = {r["fold"]: r["precision"] for r in fold_precision(df).collect()}
    assert precision == {0: 0.5, 1: 1.0, 2: 1.0}
    assert tuple(best_fold(fold_precision(df)).first()) == (1, 1.0)
    none = fold_precision(df.withColumn("probability", F.lit(0.1)))
    assert tuple(best_fold(none).first()) == (0, 0.0)


def test_combined_score(spark):
    df = spark.createDataFrame(
        [(0.5, -0.2, -0.7), (0.9, 0.1, -0.4)], "probability double, decision double, anomaly double"
    )
    assert [r[0] for r in df.select(combined_score()).collect()] == pytest.approx([-0.1, 0.09])
    positive = df.select(combined_score(mode="rank_positive")).collect()
    assert [r[0] for r in positive] == pytest.approx([-0.35, -0.36])
    with pytest.raises(ValueError):
        combined_score(mode="other")
