"""The period axis: months of one year, or of every year, with gaps."""

from dataclasses import replace

import pytest

from txwarden.config import BoostSettings, ForestSettings, JobConfig
from txwarden.functions.periods import following, period_axis, preceding
from txwarden.functions.staging import Staging
from txwarden.plans.detection import detection_job, walk_forward
from txwarden.plans.features import feature_table
from txwarden.plans.full_run import report_tables
from txwarden.sources.files import read_results, write_results

YEAR_MONTH = replace(
    JobConfig(),
    period="year_month",
    review_budget=3,
    forest=ForestSettings(trees=10, subsample=32),
    boost=BoostSettings(rounds=1, folds=2, depth=2),
)


def test_following_and_preceding():
    assert [following(p) for p in (199801, 199812)] == [199802, 199901]
    assert [preceding(p) for p in (199901, 199802)] == [199812, 199801]


def test_axis_fills_gaps(spark):
    df = spark.createDataFrame([(199811,), (199902,), (None,)], "year_month int")
    assert period_axis(df, "year_month") == [199811, 199812, 199901, 199902]
    assert period_axis(df.where("year_month is null"), "year_month") == []
    assert period_axis(df.withColumnRenamed("year_month", "month"), "month") == list(range(1, 13))
    assert period_axis(df.withColumnRenamed("year_month", "week"), "week") == [199811, 199902]


@pytest.fixture(scope="module")
def two_years(spark):
    """Transactions of November 2020 to February 2022 without May 2021, the same months in both years."""
    rows = []
    for year, month in [(2020, 11), (2020, 12), *[(2021, m) for m in range(1, 13) if m != 5], (2022, 1), (2022, 2)]:
        for i in range(30):
            rows.append((f"{year}-{month}-{i}", f"a{i % 5}", f"m{i % 3}", "x", "c", "z", "p", float(i * month % 17), 50.0 + i, f"{year}-{month:02d}-{1 + i % 27:02d}T10:00:00"))
    tx = spark.createDataFrame(
        rows,
        "eventId string, accountNumber string, merchantId string, mcc string, merchantCountry string, merchantZip string, "
        "posEntryMode string, transactionAmount double, availableCash double, transactionTime string",
    )
    reports = [(r[0], r[9].replace("T10", "T12")) for n, r in enumerate(rows) if n % 4 == 0]
    return tx, spark.createDataFrame(reports, "eventId string, reportedTime string")


def test_two_years_with_a_gap(spark, two_years, tmp_path):
    tx, labels = two_years
    features = feature_table(tx, labels, YEAR_MONTH)
    assert "year_month" in features.columns
    with Staging(spark) as staging:
        found = detection_job(features, YEAR_MONTH, staging)
        results = found["results"].collect()
        periods = [r["year_month"] for r in results]
        assert len(periods) == 16 and periods[0] == 202011 and 202105 in periods
        by = {r["year_month"]: r for r in results}
        assert by[202105]["precision"] is None and by[202105]["true_frauds"] == 0
        assert all(by[p]["true_frauds"] > 0 for p in periods if p != 202105)
        flagged = found["flagged"].groupBy("year_month").count().collect()
        assert {r["year_month"]: r["count"] for r in flagged} == {p: 3 for p in periods if p != 202105}
        write_results(found["results"], f"{tmp_path}/results.csv")
    read = read_results(spark, f"{tmp_path}/results.csv", period="year_month")
    assert [r["year_month"] for r in read.orderBy("year_month").collect()] == periods
    assert report_tables(read, "year_month")["cumulative"].count() == 16


def test_models_go_on_over_the_turn_of_the_year_and_a_gap(spark, two_years):
    from txwarden.plans.detection import model_table

    tx, labels = two_years
    with Staging(spark) as staging:
        table = model_table(feature_table(tx, labels, YEAR_MONTH), YEAR_MONTH, staging)
        models = walk_forward(table, YEAR_MONTH, staging, last=202107)
    trees = {p: len(m.trees) for p, m in models.items()}
    assert trees == {202012: 1, 202101: 2, 202102: 3, 202103: 4, 202104: 5, 202105: 6, 202106: 6, 202107: 7}
