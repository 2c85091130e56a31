"""Whole jobs over files, on a small made-up year."""

import math

import pytest
from pyspark.sql import functions as F

from txwarden.config import BoostSettings, ForestSettings, JobConfig
from txwarden.functions.staging import Staging, shared_folder
from txwarden.plans.detection import detection_job, model_table, month_slice
from txwarden.plans.explore import explore_job
from txwarden.plans.features import preprocess_job
from txwarden.plans.full_run import run
from txwarden.operators.vectors import feature_columns
from txwarden.sources.files import (
    nan_to_null,
    read_features,
    read_labels,
    read_results,
    read_transactions,
    write_features,
    write_results,
)
from txwarden.streaming.velocity import stream_velocity, write_available

MONTHS = (1, 2, 3, 5)


@pytest.fixture(scope="module")
def year(spark, tmp_path_factory):
    """Transactions of four months as CSV; reports follow large amounts."""
    folder = tmp_path_factory.mktemp("year")
    i = F.col("id")
    month = F.element_at(F.array(*map(F.lit, MONTHS)), (F.pmod(i, F.lit(4)) + 1).cast("int"))
    u = F.pmod(F.xxhash64("id"), F.lit(10_000)) / 10_000.0
    tx = spark.range(800).select(
        i.alias("eventId"), (i % 37).alias("accountNumber"), (i % 11).alias("merchantId"),
        F.concat(F.lit("c"), (i % 5).cast("string")).alias("mcc"),
        F.when(i % 13 != 0, F.concat(F.lit("L"), (i % 3).cast("string"))).alias("merchantCountry"),
        F.lit("z").alias("merchantZip"),
        F.when(i % 2 == 0, "chip").otherwise("web").alias("posEntryMode"),
        (u * 100).alias("transactionAmount"),
        F.when(i % 50 != 0, 1000.0).otherwise(0.0).alias("availableCash"),
        F.concat(
            F.format_string("2017-%02d-%02dT%02d:", month, i % 28 + 1, i % 24),
            F.format_string("%02d:00Z", i % 60),
        ).alias("transactionTime"),
    )
    labels = tx.where("transactionAmount > 85").select(
        "eventId", F.lit("2017-12-01T00:00:00Z").alias("reportedTime")
    )
    for name, df in (("tx", tx), ("labels", labels)):
        df.coalesce(2).write.option("header", True).csv(f"{folder}/{name}.csv")
    return folder


CFG = JobConfig(
    review_budget=20,
    forest=ForestSettings(trees=20, subsample=64),
    boost=BoostSettings(rounds=2, folds=2, depth=3, max_bins=16),
)


def configured(year, name):
    return JobConfig(
        transactions=f"{year}/tx.csv", labels=f"{year}/labels.csv",
        features_out=f"{year}/{name}-features", results_out=f"{year}/{name}-results",
        review_budget=20, forest=CFG.forest, boost=CFG.boost,
    )


@pytest.fixture(scope="module")
def features(spark, year):
    tx = read_transactions(spark, f"{year}/tx.csv")
    labels = read_labels(spark, f"{year}/labels.csv")
    return preprocess_job(tx, labels, f"{year}/features", CFG)


def test_feature_table(features):
    table = features["features"]
    assert table.count() == 800 and table.columns[-1] == "month"
    first = table.first()
    assert first["transaction_velocity"] >= 1 and first["pos_chip"] + first["pos_web"] == 1
    assert table.where("reported_delay is null or transaction_velocity is null").count() == 0
    assert features["profile"].first()["row_count"] == 800
    missing = {r["column"]: r["total"] for r in features["missing"].collect()}
    assert len(missing) == 22 and missing["merchantCountry"] == 62 and missing["hour"] == 0
    names = feature_columns(table)
    assert "reported_delay" not in names and "eventId" not in names and "Fraud" not in names
    assert "reported_delay" in feature_columns(table, leak_reported_delay=True)


def test_exploration(features):
    tables = explore_job(features["features"])
    assert sum(r["rows"] for r in tables["delay_histogram"].collect()) > 0
    width = len(features["features"].columns) - 1
    assert tables["correlation"].count() == width * width
    assert math.isclose(sum(r["share"] for r in tables["class_share"].collect()), 1.0)
    assert tables["boxes"].count() == 8


def test_month_slice_reads_one_folder(spark, features):
    with Staging(spark) as staging:
        table = model_table(features["features"], CFG, staging)
        plan = month_slice(table, 3)._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(month" in plan
        assert month_slice(table, 3).count() == 200 and month_slice(table, 4).count() == 0


@pytest.fixture(scope="module")
def found(features):
    return detection_job(features["features"], CFG)


def test_detection(features, found):
    results = {r["month"]: r for r in found["results"].collect()}
    assert set(results) == set(range(1, 13))
    for month in MONTHS:
        assert results[month]["precision"] == results[month]["true_frauds_flagged"] / 20
        assert 0 <= results[month]["amount_saved"] <= results[month]["potential_amount_saved"]
    assert results[4]["precision"] is None and results[4]["true_frauds"] == 0
    flagged = {r["month"]: r["count"] for r in found["flagged"].groupBy("month").count().collect()}
    assert flagged == {m: 20 for m in MONTHS}
    scored = found["scored"]
    assert scored.count() == 800
    assert scored.where("(month = 1) <> (probability is null)").count() == 0
    # month 5 follows an empty month and keeps the model that month 3 was last to train
    ranks = scored.groupBy("month").agg(
        F.avg(F.when(F.col("Fraud") == 1, F.col("probability"))).alias("p1"),
        F.avg(F.when(F.col("Fraud") == 0, F.col("probability"))).alias("p0"),
    )
    for r in ranks.where("month > 1").collect():
        assert r["p1"] > r["p0"] + 0.05


def test_full_run(spark, year, features, found):
    tables = run(spark, configured(year, "run"), run_eda=True)
    expected = [tuple(r) for r in found["results"].collect()]
    assert [tuple(r) for r in tables["results"].orderBy("month").collect()] == expected
    assert tables["cumulative"].count() == 12 and tables["metrics"].count() == 24
    totals = tables["totals"].first()
    assert totals["total_amount_saved"] <= totals["total_potential_amount_saved"]
    assert {"boxes", "correlation", "detected", "missing"} <= set(tables)


def test_csv_round_trip_and_missing_path(spark, features, found, tmp_path):
    write_results(found["results"], str(tmp_path / "r"), "csv")
    back = read_results(spark, str(tmp_path / "r"), "csv").orderBy("month").collect()
    assert [tuple(r) for r in back] == [tuple(r) for r in found["results"].collect()]
    write_features(features["features"], str(tmp_path / "f"), "csv")
    assert read_features(spark, str(tmp_path / "f"), "csv").count() == 800
    with pytest.raises(FileNotFoundError, match="nowhere"):
        read_features(spark, str(tmp_path / "nowhere"))


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "x double, i int")
    assert [tuple(r) for r in nan_to_null(df).collect()] == [(None, 1), (2.0, 2)]


def test_staging_uses_and_clears_the_shared_folder(spark):
    with Staging(spark) as staging:
        assert staging.path.startswith(shared_folder(spark).rstrip("/"))
        table = staging.write(spark.range(5).withColumn("a b.c", F.lit(1)), "t", ["id"])
        assert table.columns == ["id", "a b.c"] and table.count() == 5
    assert not spark._jvm.java.io.File(staging.path).exists()


def test_stream_velocity(spark, tmp_path):
    source = tmp_path / "in"
    rows = [(1, "2024-01-01 10:00:00"), (1, "2024-01-01 23:59:59"), (2, "2024-01-01 00:00:00")]
    later = [(1, "2024-01-02 08:00:00"), (None, "2024-01-02 09:00:00"), (3, "2024-01-03 02:00:00")]

    def add(batch):
        spark.createDataFrame(batch, "accountNumber long, t string").select(
            "accountNumber", F.col("t").cast("timestamp_ntz").alias("transactionTime")
        ).coalesce(1).write.mode("append").parquet(str(source))

    def advance():
        stream = spark.readStream.schema("accountNumber long, transactionTime timestamp_ntz")
        out = stream_velocity(stream.parquet(str(source)))
        write_available(out, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
        got = spark.read.schema(out.schema).parquet(str(tmp_path / "out")).collect()
        return sorted((r[0], r[1].day, r[3]) for r in got)

    add(rows)
    assert advance() == []  # the first day may still get transactions
    add(later)
    assert advance() == [(1, 1, 2), (1, 2, 1), (2, 1, 1)]
