"""Row identity, hot keys against ordinary ones, files of other programs, training in tasks."""

import json
import os
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_jobs import CFG, year  # noqa: F401  a small made-up year

from txwarden.config import BoostSettings, JobConfig
from txwarden.functions.ordering import with_row_id
from txwarden.functions.skew import SkewSettings, profile_keys
from txwarden.functions.staging import Staging
from txwarden.operators.boosting import cut_points, fit_rows, fit_sets
from txwarden.operators.gaps import with_gap
from txwarden.operators.resample import adasyn, near_miss
from txwarden.operators.temporal import with_entry_mode_columns
from txwarden.operators.velocity import account_window_features, with_velocity
from txwarden.plans.full_run import run
from txwarden.sources.files import beside, read_labels, read_transactions

HOT = SkewSettings(min_hot_rows=2, max_hot_keys=100, sketch_items=1000, broadcast_keys=0)


def timed(spark, rows):
    df = spark.createDataFrame(rows, "eventId long, accountNumber long, mcc string, t string")
    return df.withColumn("transactionTime", F.col("t").cast("timestamp_ntz")).drop("t")


def test_hot_accounts_use_the_same_bins(spark):
    rnd = np.random.default_rng(1)
    rows = [
        (i, 1 if i % 3 else int(rnd.integers(2, 9)), "a", f"2024-01-{1 + i % 9:02d} {i % 24:02d}:{i % 60:02d}:00")
        for i in range(300)
    ]
    rows.append((999, 50, "a", "2023-12-30 13:00:00"))  # the first day belongs to a cold account
    df = timed(spark, rows)
    answers = []
    for skew in (SkewSettings(), SkewSettings(min_hot_rows=50, broadcast_keys=0), HOT):
        (profile,) = profile_keys(df, ["accountNumber"], settings=skew)
        out = account_window_features(df, profile, hours=5, skew=skew)
        answers.append({r["eventId"]: r["transaction_velocity"] for r in out.collect()})
    answers.append({r["eventId"]: r["transaction_velocity"] for r in with_velocity(df, hours=5).collect()})
    assert all(a == answers[0] for a in answers)


def test_gaps_do_not_need_unique_or_known_ids(spark):
    rows = [(None, 1, "a", f"2024-01-01 0{h}:{m}0:00") for h in range(3) for m in range(3)]
    rows += [(7, 1, "a", "2024-01-01 00:00:00")] * 3 + [(7, 2, "a", "2024-01-01 05:00:00"), (None, 2, "a", None)]
    df = timed(spark, rows)
    gaps = lambda skew: sorted(
        (r["accountNumber"], str(r["transactionTime"]), str(r["time_since_last_transaction"]))
        for r in with_gap(df, skew=skew).collect()
    )
    assert gaps(SkewSettings()) == gaps(HOT)


def test_row_ids_are_unique_and_plain_where_they_can_be(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,), (None,)], "eventId long")
    ids = [r["rowId"] for r in with_row_id(df, "eventId", "rowId").collect()]
    assert len(set(ids)) == 5 and "1" in ids


def test_balancing_of_repeated_and_null_ids(spark):
    rnd = np.random.default_rng(2)
    points = [(i if i % 5 else None, 1 if i < 20 else 0, rnd.normal(size=2).tolist()) for i in range(100)]
    points += points[:20]  # minority rows that occur twice
    df = spark.createDataFrame(points, "eventId long, label int, features array<double>")
    with Staging(spark) as staging:
        df = staging.write(with_row_id(df.withColumn("month", F.lit(1)), "eventId", "row_id"), "rows")
        grown = adasyn(df.select("month", "row_id", "label", "features"), ["month"])
        sizes = dict(grown.groupBy("label").count().collect())
        assert sizes[0] == 80 and abs(sizes[1] - 80) <= 20
        even = near_miss(df.select("month", "row_id", "label", "features"), ["month"])
        assert dict(even.groupBy("label").count().collect()) == {0: 40, 1: 40}


def test_entry_modes_with_dots_and_of_any_number(spark):
    df = spark.createDataFrame([(i, i / 2) for i in range(250)] + [(999, None)], "eventId long, posEntryMode double")
    out = with_entry_mode_columns(df)
    assert len(out.columns) == 252 and out.where("`pos_2.5` = 1").first()["eventId"] == 5
    with pytest.raises(ValueError):
        with_entry_mode_columns(df, max_categories=100)


def test_csv_by_header_name(spark, tmp_path):
    (tmp_path / "labels.csv").write_text("note,reportedTime,eventId\nx,2024-01-02 03:00:00,ab-1\n")
    assert read_labels(spark, f"{tmp_path}/labels.csv").collect() == [("ab-1", "2024-01-02 03:00:00")]
    names = "mcc,eventId,accountNumber,merchantId,merchantCountry,merchantZip,posEntryMode,availableCash,transactionTime"
    (tmp_path / "tx.csv").write_text(f"{names},transactionAmount\nm,e1,a1,s1,DE,,5.0,12.5,2024-01-01,oops\n")
    with pytest.raises(Exception):  # a value that is no number
        read_transactions(spark, f"{tmp_path}/tx.csv").collect()
    (tmp_path / "few.csv").write_text("eventId\n1\n")
    with pytest.raises(ValueError):
        read_transactions(spark, f"{tmp_path}/few.csv")
    assert beside("/a.b/c.csv", "_x") == "/a.b/c_x.csv" and beside("/a.b/c", "_x") == "/a.b/c_x"


def test_cut_points():
    assert cut_points(np.array([1.0, 1.0, 3.0]), 4).tolist() == [2.0]
    assert len(cut_points(np.arange(1000.0), 16)) == 15
    assert len(cut_points(np.ones(5), 16)) == 0


def test_sets_are_trained_in_tasks(spark):
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(600, 4))
    label = ((x[:, 0] > 0.3) ^ (x[:, 2] > 0)).astype(int)
    rows = [(i % 2, int(y), v.tolist()) for i, (y, v) in enumerate(zip(label, x, strict=True))]
    rows += [(2, 0, [0.0] * 4)] * 5  # a set of one class
    df = spark.createDataFrame(rows, "model int, label int, features array<double>")
    settings = BoostSettings(rounds=30, depth=3)
    models = fit_sets(df, "model", settings, None)
    assert set(models) == {0, 1, 2} and len(models[2].trees) == 0
    columns = np.ascontiguousarray(x.T)
    for k in (0, 1):
        assert len(models[k].trees) == 30
        assert ((models[k].score(columns) > 0) == label).mean() > 0.93
    again = fit_sets(df.repartition(5), "model", settings, None)
    assert np.allclose(again[0].score(columns), models[0].score(columns))
    more = fit_sets(df, "model", BoostSettings(rounds=2, depth=3), models[0])
    assert len(more[1].trees) == 32 and more[1].base == models[0].base


def test_one_tree_by_hand():
    label = np.array([0.0, 0.0, 1.0, 1.0, 1.0, 0.0, 1.0, 1.0])
    x = np.array([[1.0], [2.0], [3.0], [4.0], [5.0], [1.5], [6.0], [7.0]])
    model = fit_rows(label, x, BoostSettings(rounds=1, depth=1, min_child_weight=0.1, learning_rate=1.0, l2=0.0), None)
    (tree,) = model.trees
    assert tree.feature[0] == 0 and tree.threshold[0] == 2.5
    p = label.mean()
    left = -p / (p * (1 - p))
    assert np.allclose(tree.value, [left, (1 - p) / (p * (1 - p))])


def test_settings_file_with_csv_paths_runs(spark, year, tmp_path):
    tx = spark.read.option("header", True).csv(f"{year}/tx.csv")
    tx = tx.select(*reversed(tx.columns), F.lit(1).alias("more"))
    tx.write.option("header", True).csv(f"{tmp_path}/tx.csv")
    settings = {
        "data_paths": {"transactions_file": f"{tmp_path}/tx.csv", "labels_file": f"{year}/labels.csv"},
        "output_paths": {
            "preprocessed_data_file": f"{tmp_path}/features.csv",
            "fraud_detection_results_file": f"{tmp_path}/results.csv",
        },
    }
    (tmp_path / "job.json").write_text(json.dumps(settings))
    cfg = replace(JobConfig.from_json(f"{tmp_path}/job.json"), boost=CFG.boost, forest=CFG.forest)
    tables = run(spark, cfg)
    assert tables["results"].count() == 12 and os.path.isdir(f"{tmp_path}/results_flagged.csv")
    assert tables["flagged"].where("month is null").count() == 0 and tables["flagged"].count() > 0


def test_staged_tables_go_with_the_session(spark, tmp_path):
    staging = Staging(spark)
    staging.path = f"file:{tmp_path}/scratch"
    staging.write(spark.range(3).toDF("x"), "t")
    assert os.listdir(tmp_path / "scratch")
    staging.spark = None  # as after the session has ended
    staging._close_at_exit()
    assert not os.path.exists(tmp_path / "scratch")


def test_row_ids_do_not_move_rows(spark):
    """Few repeated keys are looked up by broadcast, though nothing is known of the table's size."""
    df = spark.createDataFrame([(i % 900,) for i in range(1000)] + [(None,)], "eventId long")
    marked = with_row_id(df, "eventId", "rowId")
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    ids = [r["rowId"] for r in marked.collect()]
    assert len(set(ids)) == 1001 and sum("#" in i for i in ids) == 201
