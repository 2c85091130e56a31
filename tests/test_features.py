"""Features on small hand-made tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from txwarden.config import JobConfig
from txwarden.functions.skew import SkewSettings, profile_keys
from txwarden.operators.averages import with_average_amounts
from txwarden.operators.cleaning import drop_columns, fill_missing
from txwarden.operators.frequency import with_key_frequency, with_pair_frequency
from txwarden.operators.gaps import with_gap
from txwarden.operators.labels import join_labels, with_label_columns
from txwarden.operators.scaling import fit_robust_scale
from txwarden.operators.temporal import (
    one_hot,
    wall_clock,
    with_cash_share,
    with_date_parts,
    with_entry_mode_columns,
    with_hour_bands,
    with_weekday_columns,
)
from txwarden.operators.velocity import account_window_features, with_velocity
from txwarden.plans.features import feature_table

# Every key is hot, so that the separate paths run on small tables.
ALL_HOT = SkewSettings(min_hot_rows=2, max_hot_keys=50, sketch_items=1000, broadcast_keys=0)
ALL_COLD = SkewSettings(broadcast_keys=0)


def values(df, name, key="eventId"):
    return {r[key]: r[name] for r in df.collect()}


def test_wall_clock_keeps_written_time(spark):
    texts = ["2017-01-01T10:00:00Z", "2017-01-01T10:00:00+02:00", "2017-01-01T10:00:00", None]
    df = spark.createDataFrame(list(enumerate(texts)), "eventId long, t string")
    ten = dt.datetime(2017, 1, 1, 10)
    assert list(values(wall_clock(df, "t"), "t").values()) == [ten, ten, ten, None]
    bad = spark.createDataFrame([(1, "soon")], "eventId long, t string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        wall_clock(bad, "t").collect()
    assert values(wall_clock(bad, "t", lenient=True), "t") == {1: None}


def test_hour_bands(spark):
    rows = [(h, h) for h in range(24)] + [(99, None)]
    df = with_hour_bands(spark.createDataFrame(rows, "eventId long, hour int"))
    bands = ["hour_morning", "hour_afternoon", "hour_evening", "hour_night"]
    for r in df.collect():
        assert sum(r[b] for b in bands) == (0 if r["hour"] is None else 1)
    counts = df.agg(*[F.sum(b).alias(b) for b in bands]).first()
    assert tuple(counts) == (6, 6, 6, 6)


def test_week(spark):
    rows = [(d, dt.datetime(2024, 1, d)) for d in range(1, 8)] + [(9, None)]
    df = spark.createDataFrame(rows, "eventId long, transactionTime timestamp_ntz")
    parts = with_weekday_columns(with_date_parts(df)).orderBy("eventId").collect()
    assert [r["weekday"] for r in parts] == [0, 1, 2, 3, 4, 5, 6, None]
    assert [r["is_weekend"] for r in parts] == [0, 0, 0, 0, 0, 1, 1, 0]
    for r in parts:
        hot = [r[f"weekday_{d}"] for d in range(7)]
        assert hot == [int(d == r["weekday"]) for d in range(7)]


def test_entry_modes(spark):
    rows = [(1, "05"), (2, "01"), (3, None), (4, "a.b")]
    df = spark.createDataFrame(rows, "eventId long, posEntryMode string")
    coded = with_entry_mode_columns(df)
    assert coded.columns[2:] == ["pos_01", "pos_05", "pos_a.b"]
    assert [tuple(r)[2:] for r in coded.orderBy("eventId").collect()] == [
        (0, 1, 0), (1, 0, 0), (0, 0, 0), (0, 0, 1)
    ]
    with pytest.raises(ValueError, match="more than 1"):
        with_entry_mode_columns(df, max_categories=1)
    assert one_hot(df, "posEntryMode", "pos", ["05", "99"]).columns[2:] == ["pos_05", "pos_99"]


def test_cash_share(spark):
    rows = [(1, 10.0, 4.0), (2, 10.0, 0.0), (3, 0.0, 0.0), (4, 10.0, -5.0), (5, None, 1.0)]
    df = spark.createDataFrame(
        rows, "eventId long, transactionAmount double, availableCash double"
    )
    assert values(with_cash_share(df), "cash_pct_spent") == {
        1: 2.5, 2: None, 3: None, 4: -2.0, 5: None
    }


def gap_rows():
    t = dt.datetime(2024, 1, 1, 12)
    return [
        (1, "A", t),
        (2, "A", t),
        (3, "A", t + dt.timedelta(seconds=1.5)),
        (4, "B", t),
        (5, None, t),
        (6, None, t),
        (7, "A", t + dt.timedelta(days=2)),
        (8, "A", None),
        (9, "A", t + dt.timedelta(days=2, seconds=61)),
    ]


@pytest.mark.parametrize("skew", [SkewSettings(), ALL_HOT])
def test_gaps(spark, skew):
    schema = "eventId long, accountNumber string, transactionTime timestamp_ntz"
    df = spark.createDataFrame(gap_rows(), schema)
    day = 86400.0
    assert values(with_gap(df, skew=skew), "time_since_last_transaction") == {
        1: None, 2: 0.0, 3: 1.5, 4: None, 5: None, 6: None, 7: 2 * day - 1.5, 8: None, 9: 61.0
    }


def velocity_rows(spark):
    rows = [
        (1, "A", dt.datetime(2024, 1, 1)),
        (2, "A", dt.datetime(2024, 1, 1, 13)),
        (3, "A", dt.datetime(2024, 1, 2, 9)),
        (4, None, dt.datetime(2024, 1, 2, 9)),
        (5, "B", None),
    ]
    return spark.createDataFrame(
        rows, "eventId long, accountNumber string, transactionTime timestamp_ntz"
    )


@pytest.mark.parametrize("skew", [SkewSettings(), ALL_COLD, ALL_HOT])
def test_velocity_modes(spark, skew):
    df = velocity_rows(spark)
    got = {
        mode: values(with_velocity(df, mode, skew=skew), "transaction_velocity")
        for mode in ("bin", "literal", "trailing")
    }
    assert got["bin"] == {1: 2, 2: 2, 3: 1, 4: None, 5: None}
    assert got["literal"] == {1: 2, 2: None, 3: None, 4: None, 5: None}
    assert got["trailing"] == {1: 1, 2: 2, 3: 2, 4: None, 5: None}


def test_velocity_bins_that_do_not_divide_the_day(spark):
    df = velocity_rows(spark)
    # 10-hour bins from the first midnight: [0,10) [10,20) [20,30) [30,40)
    got = values(with_velocity(df, hours=10), "transaction_velocity")
    assert got == {1: 1, 2: 1, 3: 1, 4: None, 5: None}
    got = values(with_velocity(df, hours=36), "transaction_velocity")
    assert got == {1: 3, 2: 3, 3: 3, 4: None, 5: None}
    with pytest.raises(ValueError):
        with_velocity(df, "weekly")


def skewed(spark, rows=3000):
    """A third of the rows in one account, merchant, day and time; a third without keys."""
    i = F.col("id")
    third = i % 3
    return spark.range(rows).select(
        i.alias("eventId"),
        F.when(third == 0, 7).when(third == 1, (i % 50) + 100).alias("accountNumber"),
        F.when(third == 0, 1).when(third == 1, i % 20).alias("merchantId"),
        F.when(third != 2, F.concat(F.lit("m"), (i % 4).cast("string"))).alias("mcc"),
        F.timestamp_seconds(
            F.lit(1704067200)
            + F.when(i % 9 == 0, 0).otherwise(F.pmod(F.xxhash64("id"), F.lit(500_000)))
        )
        .cast("timestamp_ntz")
        .alias("transactionTime"),
        (i % 17).cast("double").alias("transactionAmount"),
        F.when(third == 0, "X").alias("merchantCountry"),
    )


def rows_of(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


@pytest.mark.parametrize("operator", [
    lambda df, s: with_key_frequency(df, skew=s),
    lambda df, s: with_pair_frequency(df, skew=s),
    lambda df, s: with_velocity(df, "bin", skew=s),
    lambda df, s: with_velocity(df, "trailing", skew=s),
    lambda df, s: with_velocity(df, "trailing", hours=3, skew=s),
    lambda df, s: with_gap(df, skew=s),
    lambda df, s: with_average_amounts(df, keys={"merchantCountry": "mean"}, skew=s),
])
def test_hot_keys_change_nothing(spark, operator):
    df = skewed(spark)
    hot = SkewSettings(min_hot_rows=20, max_hot_keys=100, sketch_items=1000, broadcast_keys=0)
    (profile,) = profile_keys(df, ["accountNumber"], settings=hot)
    assert profile.hot and profile.salts > 10 and profile.nulls == 1000
    expected = rows_of(operator(df, SkewSettings()))
    assert rows_of(operator(df, hot)) == expected
    assert rows_of(operator(df.repartition(17), ALL_COLD)) == expected


def test_hot_keys_are_repeated_by_their_own_rows(spark):
    """Many null keys, one heavy key and many of three rows: the looked-up table grows with the rows,
    not with hot keys times the heaviest one's salts, and is not broadcast after that."""
    key = F.expr("CASE WHEN id < 4000 THEN NULL WHEN id < 6000 THEN 0 ELSE 1 + (id - 6000) % 500 END")
    df = spark.range(7500).select(F.col("id").alias("eventId"), key.alias("merchantId")).localCheckpoint()
    settings = SkewSettings(min_hot_rows=2, broadcast_keys=0)
    (profile,) = profile_keys(df, ["merchantId"], settings=settings)
    out = with_key_frequency(df, ["merchantId"], skew=settings, profiles=[profile])
    assert sorted(set(n for _, n in profile.dealt)) == [2, 1000]
    copies = profile.with_shares(df.select("merchantId").distinct()).agg(F.sum("_shares")).first()[0]
    assert copies == 1000 + 500 * 2
    assert out._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin") == 2  # hot keys only
    got = {tuple(r) for r in out.groupBy("merchantId", "merchantId_freq").count().collect()}
    assert got == {(None, None, 4000), (0, 2000, 2000), *[(k, 3, 3) for k in range(1, 501)]}


@pytest.mark.parametrize("mode", ["bin", "literal", "trailing"])
def test_account_windows_equal_the_single_operators(spark, mode):
    df = skewed(spark)
    hot = SkewSettings(min_hot_rows=20, max_hot_keys=100, sketch_items=1000, broadcast_keys=0)
    single = with_velocity(with_key_frequency(df, ["accountNumber"]), mode)
    expected = rows_of(with_gap(with_pair_frequency(single)))
    for settings in (SkewSettings(), hot):
        (profile,) = profile_keys(df, ["accountNumber"], settings=settings)
        assert rows_of(account_window_features(df, profile, mode, skew=settings)) == expected


def test_account_windows_need_one_shuffle(spark):
    df = skewed(spark).where("accountNumber is not null")
    (profile,) = profile_keys(df, ["accountNumber"])
    plan = account_window_features(df, profile)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_feature_table_is_the_same_with_hot_keys(spark):
    third = F.col("eventId") % 3
    tx = skewed(spark).withColumns(
        {
            "merchantZip": F.lit("z"),
            "posEntryMode": F.when(third == 0, "chip").otherwise("web"),
            "availableCash": (F.col("eventId") % 9).cast("double"),
        }
    )
    labels = tx.where("eventId % 10 = 3").select(
        "eventId", F.expr("transactionTime + interval 5 hours").alias("reportedTime")
    )
    hot = SkewSettings(min_hot_rows=20, max_hot_keys=100, sketch_items=1000, broadcast_keys=0)
    expected = feature_table(tx, labels)
    assert "merchantZip" not in expected.columns and expected.count() == 3000
    def rounded(df):
        doubles = [f.name for f in df.schema if f.dataType.simpleString() == "double"]
        return rows_of(df.withColumns({c: F.round(c, 9) for c in doubles}))
    assert rounded(feature_table(tx, labels, skew=hot)) == rounded(expected)


def test_key_frequency_skips_nulls(spark):
    rows = [(1, "a"), (2, "a"), (3, None), (4, None)]
    df = spark.createDataFrame(rows, "eventId long, mcc string")
    for skew in (SkewSettings(), ALL_HOT):
        got = values(with_key_frequency(df, ["mcc"], skew=skew), "mcc_freq")
        assert got == {1: 2, 2: 2, 3: None, 4: None}


@pytest.mark.parametrize("skew", [SkewSettings(), ALL_HOT])
def test_label_join(spark, skew):
    t = dt.datetime(2024, 1, 1)
    tx = spark.createDataFrame(
        [(1, t), (2, t), (None, t), (3, t)], "eventId long, transactionTime timestamp_ntz"
    )
    hour = dt.timedelta(hours=1)
    labels = spark.createDataFrame(
        [(1, t + hour), (1, t - hour), (1, t + 3 * hour), (None, t), (9, t), (3, None)],
        "eventId long, reportedTime timestamp_ntz",
    )
    joined = with_label_columns(join_labels(tx, labels, skew=skew))
    got = sorted(((r[0], r["reported_delay"], r["Fraud"]) for r in joined.collect()), key=str)
    assert got == sorted(
        [(1, 1.0, 1), (1, -1.0, 1), (1, 3.0, 1), (2, None, 0), (None, 0.0, 1), (3, None, 0)],
        key=str,
    )
    first = join_labels(tx, labels, dedupe="first_report", skew=skew)
    assert first.where("eventId = 1").first()["reportedTime"] == t - hour
    assert first.count() == 4


def test_label_join_without_null_reports(spark):
    t = dt.datetime(2024, 1, 1)
    tx = spark.createDataFrame([(None, t), (1, t)], "eventId long, transactionTime timestamp_ntz")
    labels = spark.createDataFrame([(1, t)], "eventId long, reportedTime timestamp_ntz")
    got = {r["eventId"]: r["reportedTime"] for r in join_labels(tx, labels).collect()}
    assert got == {None: None, 1: t}


def test_robust_scale(spark):
    rows = [(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (10.0, 5.0), (None, 5.0)]
    df = spark.createDataFrame(rows, "x double, c double")
    scale = fit_robust_scale(df, ["x", "c"])
    assert scale.parameters == {"x": (2.5, 3.0), "c": (5.0, 0.0)}
    got = [tuple(r) for r in scale.transform(df).collect()]
    assert [r[1] for r in got] == [0.0] * 5
    assert [r[0] for r in got][:4] == pytest.approx([-0.5, -1 / 6, 1 / 6, 2.5])
    assert got[4][0] is None


def test_fill_and_drop(spark):
    df = spark.createDataFrame(
        [(None, None, None, None, None)],
        "transaction_velocity long, merchant_category_frequency long, "
        "time_since_last_transaction double, reported_delay double, other double",
    )
    assert tuple(fill_missing(df).first()) == (0, 0, 0.0, 0.0, None)
    assert drop_columns(df, ["other", "reported_delay"], keep_key="other").columns == [
        c for c in df.columns if c != "reported_delay"
    ]
    with pytest.raises(ValueError, match="nothing"):
        drop_columns(df, ["nothing"])


def test_config(tmp_path):
    path = tmp_path / "job.json"
    path.write_text(
        '{"data_paths": {"transactions_file": "a", "labels_file": "b"},'
        '"output_paths": {"preprocessed_data_file": "c", "fraud_detection_results_file": "d"},'
        '"model_settings": {"numeric_columns_to_scale": ["x"], "columns_to_drop": ["y"],'
        '"contamination": 0.2, "random_state": 7}}'
    )
    cfg = JobConfig.from_json(str(path))
    assert (cfg.transactions, cfg.labels, cfg.features_out, cfg.results_out) == tuple("abcd")
    assert (cfg.scaled_columns, cfg.dropped_columns, cfg.seed) == (("x",), ("y",), 7)
    assert cfg.forest.contamination == 0.2 and cfg.boost.rounds == 100
