"""One query per operator, each over whole tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txwarden.config import BoostSettings, JobConfig
from txwarden.functions.periods import YEAR_MONTH, period_axis, year_month
from txwarden.functions.quantile_tables import quantile_table
from txwarden.functions.sketches import RANK_ERROR, merged_sketches, sketch_quantiles, sketch_table
from txwarden.functions.skew import SkewSettings, profile_keys
from txwarden.functions.staging import Staging, stage
from txwarden.functions.trees import score_by_key
from txwarden.operators.averages import with_average_amounts
from txwarden.operators.boosting import fit_boosted_trees, with_probability
from txwarden.operators.asof import ASOF_KEYS, with_history, with_known_label
from txwarden.operators.cleaning import drop_columns, fill_missing
from txwarden.operators.evaluate import classification_metrics, monthly_evaluation, yearly_totals
from txwarden.operators.explore import (
    auto_histogram,
    box_stats,
    correlation_matrix,
    positive_values,
    value_share,
)
from txwarden.operators.folds import best_fold, fold_precision, with_folds
from txwarden.operators.forest import fit_forest, score_forest, with_decision
from txwarden.operators.frequency import with_key_frequency, with_pair_frequency
from txwarden.operators.gaps import with_gap
from txwarden.operators.labels import join_labels, with_label_columns
from txwarden.operators.model_tables import FIELDS as MODEL_FIELDS
from txwarden.operators.model_tables import load_models, tree_shapes
from txwarden.operators.profile import dataset_profile, missing_report
from txwarden.operators.ranking import combined_score, flagged_rows, top_n
from txwarden.operators.report import cumulative_saved, detected_share, metric_series
from txwarden.operators.resample import adasyn, near_miss
from txwarden.operators.scaling import QUARTILES, melt, scale_columns
from txwarden.operators.temporal import (
    wall_clock,
    with_cash_share,
    with_date_parts,
    with_entry_mode_columns,
    with_hour_bands,
    with_weekday_columns,
)
from txwarden.operators.vectors import feature_columns, with_features
from txwarden.operators.velocity import account_window_features, with_velocity
from txwarden.plans.detection import (
    TrainingReport,
    anomaly_review,
    detection_job,
    model_table as model_rows,
    walk_forward,
)
from txwarden.plans.explore import correlated_columns
from txwarden.plans.features import feature_table, raw_feature_nulls
from txwarden.plans.full_run import run
from txwarden.sources.files import (
    read_features,
    read_labels,
    read_results,
    read_transactions,
    write_features,
    write_results,
)
from txwarden.sources.orders_view import event_transactions, reports, transactions
from txwarden.streaming.gaps import stream_gaps
from txwarden.streaming.velocity import open_windows, stream_velocity, write_available

Query = Callable[[SparkSession, str], DataFrame]

def _r(name: str, digits: int = 6) -> Column:
    return F.round(name, digits).alias(name)


def _text(name: str) -> Column:
    return F.col(name).cast("string").alias(name)


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    return with_label_columns(join_labels(transactions(spark, sf), reports(spark, sf)))


def _dated(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled transactions with month and original amount, read by many tasks later."""
    dated = with_date_parts(_labelled(spark, sf))
    return dated.withColumn("transactionAmount_original", F.col("transactionAmount"))


def tx_scan(spark, sf):
    return transactions(spark, sf).withColumn("transactionTime", _text("transactionTime"))


def labels_scan(spark, sf):
    return reports(spark, sf).withColumn("reportedTime", _text("reportedTime"))


def ts_normalise(spark, sf):
    zone = F.when(F.col("mcc") == "click", "+02:00").when(F.col("mcc") == "view", "Z").otherwise("")
    written = F.concat(F.regexp_replace(_text("transactionTime"), " ", "T"), zone)
    events = event_transactions(spark, sf).withColumn("transactionTime", written)
    return wall_clock(events, "transactionTime").select("eventId", _text("transactionTime"))


def date_parts(spark, sf):
    return with_date_parts(transactions(spark, sf)).select(
        "eventId", "hour", "day", "month", "weekday", "is_weekend"
    )


def hour_bands(spark, sf):
    return with_hour_bands(with_date_parts(event_transactions(spark, sf))).select(
        "eventId", "hour", "hour_morning", "hour_afternoon", "hour_evening", "hour_night"
    )


def one_hot_weekday(spark, sf):
    coded = with_weekday_columns(with_date_parts(transactions(spark, sf)))
    return coded.select("eventId", *[f"weekday_{d}" for d in range(7)])


def one_hot_entry_mode(spark, sf):
    coded = with_entry_mode_columns(transactions(spark, sf))
    return coded.select("eventId", *[F.col(f"`{c}`") for c in coded.columns if c.startswith("pos_")])


def cash_share(spark, sf):
    return with_cash_share(transactions(spark, sf)).select("eventId", _r("cash_pct_spent"))


def label_join(spark, sf):
    return _labelled(spark, sf).select(
        "eventId", _text("reportedTime"), _r("reported_delay"), "Fraud"
    )


def robust_scale(spark, sf):
    tx = stage(with_cash_share(transactions(spark, sf)))
    kept = tx.withColumn("transactionAmount_original", F.col("transactionAmount"))
    columns = ["transactionAmount", "availableCash", "cash_pct_spent"]
    return scale_columns(kept, columns).select(
        "eventId", *[_r(c) for c in columns], "transactionAmount_original"
    )


def fill_missing_query(spark, sf):
    tx = with_velocity(_labelled(spark, sf), "literal")
    tx = with_gap(with_pair_frequency(tx))
    return fill_missing(tx).select(
        "eventId",
        "transaction_velocity",
        "merchant_category_frequency",
        "time_since_last_transaction",
        _r("reported_delay"),
        "mcc",
    )


def drop_columns_query(spark, sf):
    tx = transactions(spark, sf)
    gone = ["merchantId", "mcc", "merchantCountry", "merchantZip", "posEntryMode", "eventId"]
    return drop_columns(tx.drop("transactionTime"), gone, keep_key="eventId")


def month_slices(spark, sf):
    """Rows and amount of each scored month and of the month it learns from."""
    sums = with_date_parts(transactions(spark, sf)).groupBy("month").agg(
        F.count(F.lit(1)).alias("n"), F.sum("transactionAmount").alias("sum")
    )
    roles = (("current", 0), ("previous", 1))
    pairs = [(m, role, m - back) for m in range(2, 13) for role, back in roles]
    wanted = spark.createDataFrame(pairs, "scored_month int, role string, month int")
    return wanted.join(sums, "month", "left").select(
        "scored_month",
        "role",
        F.coalesce("n", F.lit(0)).alias("rows"),
        F.round("sum", 2).alias("amount"),
    )


def key_frequency(spark, sf):
    return with_key_frequency(transactions(spark, sf)).select(
        "eventId", "accountNumber_freq", "merchantId_freq", "mcc_freq"
    )


def velocity_bin(spark, sf):
    return with_velocity(event_transactions(spark, sf)).select("eventId", "transaction_velocity")


def velocity_literal(spark, sf):
    tx = transactions(spark, sf).select("eventId", "accountNumber", "transactionTime")
    both = tx.unionByName(
        event_transactions(spark, sf).select(
            (-F.col("eventId") - 1).alias("eventId"), "accountNumber", "transactionTime"
        )
    )
    return with_velocity(both, "literal").select("eventId", "transaction_velocity")


def velocity_trailing(spark, sf):
    return with_velocity(event_transactions(spark, sf), "trailing").select(
        "eventId", "transaction_velocity"
    )


def velocity_six_hours(spark, sf):
    return with_velocity(event_transactions(spark, sf), "bin", hours=6).select(
        "eventId", "transaction_velocity"
    )


def velocity_five_hours(spark, sf):
    """Bins of which only the first starts at midnight."""
    return with_velocity(event_transactions(spark, sf), "bin", hours=5).select(
        "eventId", "transaction_velocity"
    )


# Every key above two rows is hot and nothing is broadcast: the paths of very large tables.
ALL_HOT = SkewSettings(min_hot_rows=2, broadcast_keys=0)


def velocity_five_hours_hot(spark, sf):
    events = event_transactions(spark, sf)
    (profile,) = profile_keys(events, ["accountNumber"], settings=ALL_HOT)
    features = account_window_features(events, profile, hours=5, skew=ALL_HOT)
    return features.select("eventId", "transaction_velocity")


def time_since_last_hot(spark, sf):
    return with_gap(event_transactions(spark, sf), skew=ALL_HOT).select(
        "eventId", _r("time_since_last_transaction")
    )


def time_since_last_null_ids(spark, sf):
    """Half of the ids null and a tenth of the rows twice: all gaps, by account and time."""
    events = event_transactions(spark, sf)
    twice = events.unionByName(events.where(F.col("eventId") % 10 == 0))
    some = twice.withColumn("eventId", F.when(F.col("eventId") % 2 == 0, F.col("eventId")))
    return with_gap(some, skew=ALL_HOT).select(
        "accountNumber", _text("transactionTime"), _r("time_since_last_transaction")
    )


def key_frequency_hot(spark, sf):
    return with_key_frequency(transactions(spark, sf), skew=ALL_HOT).select(
        "eventId", "accountNumber_freq", "merchantId_freq", "mcc_freq"
    )


def one_hot_numeric_mode(spark, sf):
    """Entry modes that are numbers with dots, more than 100 of them."""
    events = event_transactions(spark, sf)
    mode = F.floor(F.col("transactionAmount") * 2) / 2
    coded = with_entry_mode_columns(events.withColumn("posEntryMode", mode))
    coded = with_key_frequency(coded, ["accountNumber"])  # which has to keep such names
    names = [c for c in coded.columns if c.startswith("pos_")]
    ones = F.array(*[F.when(F.col(f"`{c}`") == 1, F.lit(c)) for c in names])
    return coded.select(
        "eventId", F.array_join(ones, ",").alias("modes"), F.lit(len(names)).alias("columns")
    )


def _as_csv(df: DataFrame, path: str) -> str:
    """Written with other column order and one column more, as other programs leave files."""
    columns = sorted(df.columns, key=lambda c: c[::-1])
    df.select(*columns, F.lit("x").alias("note")).write.option("header", True).csv(path)
    return path


def csv_scan(spark, sf):
    tx = transactions(spark, sf).withColumn("eventId", F.concat(F.lit("tx-"), "eventId"))
    return read_transactions(spark, _as_csv(tx, f"{Staging(spark).path}/tx.csv"))


def labels_csv_scan(spark, sf):
    labels = reports(spark, sf).withColumn("eventId", F.concat(F.lit("tx-"), "eventId"))
    return read_labels(spark, _as_csv(labels, f"{Staging(spark).path}/labels.csv"))


def velocity_stream(spark, sf):
    """The event table read as a stream; windows the watermark has closed."""
    events = event_transactions(spark, sf, stream=True)
    staging = Staging(spark)
    out = stream_velocity(events)
    write_available(out, f"{staging.path}/out", f"{staging.path}/state").awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{staging.path}/out").select(
        "accountNumber", _text("window_start"), "transaction_velocity"
    )


def velocity_stream_all(spark, sf):
    """The windows that the watermark has closed and, from the state, those still open."""
    staging = Staging(spark)
    out = stream_velocity(event_transactions(spark, sf, stream=True))
    write_available(out, f"{staging.path}/out", f"{staging.path}/state").awaitTermination()
    closed = spark.read.schema(out.schema).parquet(f"{staging.path}/out")
    still_open = open_windows(spark, f"{staging.path}/state")
    return closed.withColumn("is_open", F.lit(0)).unionByName(
        still_open.withColumn("is_open", F.lit(1))
    ).select("accountNumber", _text("window_start"), "transaction_velocity", "is_open")


def merchant_category_frequency(spark, sf):
    return with_pair_frequency(transactions(spark, sf)).select(
        "eventId", "merchant_category_frequency"
    )


def avg_amount_country_hour(spark, sf):
    return with_average_amounts(with_date_parts(transactions(spark, sf))).select(
        "eventId",
        _r("avg_transaction_amount_by_country", 4),
        _r("avg_transaction_amount_by_hour", 4),
    )


def avg_amount_hour_events(spark, sf):
    events = with_date_parts(event_transactions(spark, sf))
    name = "avg_transaction_amount_by_hour"
    return with_average_amounts(events, keys={"hour": name}).select("eventId", "hour", _r(name))


def time_since_last(spark, sf):
    return with_gap(transactions(spark, sf)).select("eventId", "time_since_last_transaction")


def time_since_last_events(spark, sf):
    return with_gap(event_transactions(spark, sf)).select(
        "eventId", _r("time_since_last_transaction")
    )


def time_since_last_stream(spark, sf):
    """The event table read as a stream; the account's latest time is kept as state."""
    staging = Staging(spark)
    out = stream_gaps(event_transactions(spark, sf, stream=True))
    write_available(out, f"{staging.path}/out", f"{staging.path}/state").awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{staging.path}/out").select(
        "eventId", _r("time_since_last_transaction")
    )


def history_before(spark, sf):
    """Counts and sums of the rows before each row, by account and by country."""
    before = with_history(transactions(spark, sf))
    columns = []
    for count, mean in ASOF_KEYS.values():
        columns += [F.col(count), F.round(F.col(mean) * F.col(count), 2).alias(mean.replace("avg", "sum"))]
    return before.select("eventId", *columns)


def known_labels(spark, sf):
    """The label as reports had told it by the end of the transaction's month."""
    dated = _dated(spark, sf)
    end = F.add_months(F.trunc("transactionTime", "month"), 1).cast("timestamp_ntz")
    return with_known_label(dated, end).select("eventId", "month", "Fraud", "known_fraud")


def missing_report_query(spark, sf):
    return missing_report(raw_feature_nulls(transactions(spark, sf))).select("column", "total", _r("percent"))


def dataset_profile_query(spark, sf):
    return dataset_profile(_labelled(spark, sf)).withColumn(
        "fraud_percentage", _r("fraud_percentage")
    )


def value_share_query(spark, sf):
    return value_share(_labelled(spark, sf), "Fraud").withColumn("share", _r("share"))


def value_share_country(spark, sf):
    return value_share(transactions(spark, sf), "merchantCountry").withColumn("share", _r("share"))


CORRELATED = (
    "transactionAmount",
    "availableCash",
    "cash_pct_spent",
    "reported_delay",
    "merchantId",
    "hour",
    "day",
    "month",
    "weekday",
    "is_weekend",
    "Fraud",
)


def correlation_matrix_query(spark, sf):
    table = stage(with_cash_share(with_date_parts(_labelled(spark, sf))).select(*CORRELATED))
    return correlation_matrix(table, CORRELATED).withColumn("corr", _r("corr"))


def histogram_auto(spark, sf):
    delays = stage(positive_values(_labelled(spark, sf), "reported_delay").select("reported_delay"))
    return auto_histogram(delays, "reported_delay").select(
        "bin", _r("left_edge"), _r("right_edge"), "rows"
    )


BOXED = ("transactionAmount", "availableCash", "reported_delay")


def box_stats_query(spark, sf):
    table = stage(_labelled(spark, sf).select(*BOXED, "Fraud"))
    values = ["q1", "median", "q3", "whisker_low", "whisker_high"]
    return box_stats(table, BOXED).select(
        "feature", "Fraud", "rows", *[_r(c) for c in values], "outliers"
    )


def _quantile_rows(table: DataFrame, key: str) -> DataFrame:
    quartiles = [F.round(F.get("quantiles", i), 6).alias(q) for i, q in enumerate(("q1", "median", "q3"))]
    return table.select(key, "rows", _r("minimum"), _r("maximum"), *quartiles)


def account_quantiles(spark, sf):
    """Quartiles of the amount by account: as many groups as there are accounts."""
    tx = stage(transactions(spark, sf).select("accountNumber", "transactionAmount"))
    return _quantile_rows(quantile_table(tx, "transactionAmount", QUARTILES, ["accountNumber"]), "accountNumber")


def merchant_quantiles_narrowed(spark, sf):
    """Quartiles by merchant on the way that groups too large for one task take, null merchants too."""
    tx = stage(transactions(spark, sf).select("merchantId", "transactionAmount"))
    table = quantile_table(tx, "transactionAmount", QUARTILES, ["merchantId"], small_rows=100, sent_rows=0)
    return _quantile_rows(table, "merchantId")


def merged_sketch_ranks(spark, sf):
    """Sketches of the scaled columns by month, merged over the months without reading rows again,
    and whether the true ranks of their quartiles are within four times the stated error."""
    rows = stage(_dated(spark, sf).select("month", *BOXED))
    cells = melt(rows, BOXED, ["month"])
    sketches = stage(sketch_table(cells, "value", ["month", "column"]))
    whole = stage(merged_sketches(sketches, ["column"]).withColumn("q", sketch_quantiles(QUARTILES)).drop("sketch"))
    at = [F.get("q", i) for i in range(len(QUARTILES))]
    seen = cells.join(F.broadcast(whole), "column").groupBy("column", "rows", "minimum", "maximum").agg(
        *[F.count_if(F.col("value") < x).alias(f"under{i}") for i, x in enumerate(at)],
        *[F.count_if(F.col("value") <= x).alias(f"upto{i}") for i, x in enumerate(at)],
    )
    near = F.lit(True)
    for i, p in enumerate(QUARTILES):
        slack = 4 * RANK_ERROR * F.col("rows") + 1
        near &= (F.col(f"under{i}") <= p * F.col("rows") + slack) & (F.col(f"upto{i}") >= p * F.col("rows") - slack)
    return seen.select("column", "rows", _r("minimum"), _r("maximum"), near.cast("int").alias("within_error"))


def _amount_ranked(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Transactions ranked by amount, so that ranking and evaluation have exact SQL."""
    rows = _dated(spark, sf).select(
        "eventId", "month", "Fraud", "transactionAmount_original",
        (-F.col("transactionAmount")).alias("score"),
    )
    return rows, top_n(rows, "score", 400)


def top_n_per_month(spark, sf):
    _, flagged = _amount_ranked(spark, sf)
    return flagged.select("month", "review_rank", "eventId", "score")


def top_n_per_weekday_wide(spark, sf):
    rows = with_date_parts(transactions(spark, sf)).select(
        "eventId", "weekday", (-F.col("transactionAmount")).alias("score")
    )
    return top_n(rows, "score", 1500, ("weekday",))


def flagged_semi_join(spark, sf):
    rows, flagged = _amount_ranked(spark, sf)
    return flagged_rows(rows, flagged).select("eventId", "Fraud", "transactionAmount_original")


def _results(spark, sf) -> DataFrame:
    return monthly_evaluation(*_amount_ranked(spark, sf))


RESULT_COLUMNS = (
    "month",
    "precision",
    "f1_score",
    "true_frauds_flagged",
    "true_frauds",
    "amount_saved",
    "potential_amount_saved",
)


def _rounded_results(results: DataFrame, period: str = "month") -> DataFrame:
    return results.select(
        period,
        _r("precision"),
        _r("f1_score"),
        "true_frauds_flagged",
        "true_frauds",
        _r("amount_saved", 2),
        _r("potential_amount_saved", 2),
    )


def monthly_evaluation_query(spark, sf):
    return _rounded_results(_results(spark, sf))


def yearly_totals_query(spark, sf):
    return yearly_totals(_results(spark, sf)).select(
        _r("total_amount_saved", 2), _r("total_potential_amount_saved", 2)
    )


def cumulative_saved_query(spark, sf):
    return cumulative_saved(_results(spark, sf)).select(
        "month", _r("amount_saved", 2), _r("cumulative_amount_saved", 2)
    )


def metric_series_query(spark, sf):
    return metric_series(_results(spark, sf)).select("month", "metric", _r("value"))


def detected_share_query(spark, sf):
    return detected_share(_results(spark, sf)).select(
        "month", _r("detected_percent"), _r("share_of_total")
    )


def features_round_trip(spark, sf):
    staging = Staging(spark)
    write_features(with_date_parts(_labelled(spark, sf)).select(
        "eventId", "transactionAmount", "Fraud", "month"), staging.path)
    return read_features(spark, staging.path).select(
        "eventId", "transactionAmount", "Fraud", "month"
    )


def results_round_trip(spark, sf):
    staging = Staging(spark)
    write_results(_rounded_results(_results(spark, sf)), staging.path, "csv")
    return read_results(spark, staging.path, "csv")


def feature_matrix(spark, sf):
    table = _dated(spark, sf).select(
        "eventId", "transactionAmount", "availableCash", "merchantId", "day", "weekday",
        "reported_delay", "Fraud", "transactionAmount_original",
    )
    columns = feature_columns(table)
    cells = F.aggregate("features", F.lit(0.0), lambda a, b: a + b)
    return with_features(table, columns).select(
        "eventId",
        F.size("features").cast("long").alias("feature_count"),
        F.round(cells, 4).alias("feature_sum"),
        "Fraud",
    )


def stratified_folds(spark, sf):
    return with_folds(_dated(spark, sf).select("eventId", "month", "Fraud")).select(
        "eventId", "month", "Fraud", "fold"
    )


def _fold_predictions(spark, sf) -> DataFrame:
    table = with_folds(_dated(spark, sf).select("eventId", "month", "Fraud", "transactionAmount"))
    return table.withColumn("probability", F.col("transactionAmount") / 500000.0)


def fold_selection(spark, sf):
    precisions = fold_precision(_fold_predictions(spark, sf), by=["month"])
    return best_fold(precisions, ["month"]).select("month", "fold", _r("precision"))


def confusion_metrics(spark, sf):
    table = _fold_predictions(spark, sf).withColumn(
        "predicted", (F.col("probability") > 0.5).cast("int")
    )
    return classification_metrics(table, by=("month",)).select(
        "month", "tp", "fp", "fn", _r("precision"), _r("f1_score")
    )


def _decided(spark, sf) -> DataFrame:
    table = stage(_dated(spark, sf).select(
        "eventId", "month",
        (-F.col("transactionAmount") / 500000.0).alias("anomaly"),
        (F.col("availableCash") / 20000.0 + 0.1).alias("probability"),
    ))
    return with_decision(table, 0.1)


def decision_offset(spark, sf):
    decided = _decided(spark, sf)
    negative = (F.col("decision") < 0).cast("int").alias("is_anomaly")
    return decided.select("eventId", "month", _r("decision", 10), negative)


def combined_score_query(spark, sf):
    return _decided(spark, sf).select(
        "eventId",
        F.round(combined_score(), 6).alias("score"),
        F.round(combined_score(mode="rank_positive"), 6).alias("positive_score"),
    )


def _two_classes(spark, sf) -> DataFrame:
    """Every row's whole feature array, as the models are trained on."""
    table = model_rows(_features(spark, sf), JobConfig(), Staging(spark))
    return table.select("month", F.col("rowId").alias("row_id"), F.col("Fraud").alias("label"), "features")


def near_miss_query(spark, sf):
    return near_miss(_two_classes(spark, sf), ["month"]).select("month", "row_id", "label")


def near_miss_projections(spark, sf):
    """Class sizes after under-sampling with neighbours from random projections."""
    kept = near_miss(_two_classes(spark, sf), ["month"], method="lsh")
    return kept.groupBy("month", "label").count()


def training_report(spark, sf):
    """Rows of every month's and fold's training set, and whether synthetic rows could be made."""
    staging, report = Staging(spark), TrainingReport()
    cfg = JobConfig(boost=BoostSettings(rounds=1, depth=2))
    walk_forward(model_rows(_features(spark, sf), cfg, staging), cfg, staging, report=report)
    judged = report.table(spark).where(F.col("precision").between(0, 1) & (F.col("rows_after") <= F.col("rows_before") + F.col("synthetic")))
    return judged.select("month", "fold", "rows_before", "skipped")


def adasyn_query(spark, sf):
    """The synthetic rows of each month, each with sums over its point."""
    born = adasyn(_two_classes(spark, sf), ["month"]).where("synthetic")
    total = F.aggregate("features", F.lit(0.0), lambda a, x: a + x)
    spread = F.aggregate(
        F.transform("features", lambda x, i: x * (i + 1)), F.lit(0.0), lambda a, x: a + x
    )
    return born.select("month", "row_id", "label", F.round(total, 3).alias("total"), F.round(spread, 2).alias("spread"))


def balanced_classes(spark, sf):
    """Class sizes after both balancing steps."""
    grown = stage(adasyn(_two_classes(spark, sf), ["month"]))
    return near_miss(grown, ["month"]).groupBy("month", "label").count()


def _features(spark, sf) -> DataFrame:
    # stored first, as transactions usually are: the job scans single columns several times
    return feature_table(stage(transactions(spark, sf)), reports(spark, sf))


FEATURE_ROUNDED = (
    "transactionAmount",
    "availableCash",
    "accountNumber_freq",
    "merchantId_freq",
    "mcc_freq",
    "cash_pct_spent",
    "reported_delay",
    "avg_transaction_amount_by_country",
    "avg_transaction_amount_by_hour",
)


def preprocess_features(spark, sf):
    features = _features(spark, sf)
    return features.select(
        *[_r(c) if c in FEATURE_ROUNDED else F.col(f"`{c}`") for c in features.columns]
    )


def feature_boxes(spark, sf):
    boxes = box_stats(stage(_features(spark, sf)))
    values = ["q1", "median", "q3", "whisker_low", "whisker_high"]
    return boxes.select("feature", "Fraud", "rows", *[_r(c) for c in values], "outliers")


def feature_correlations(spark, sf):
    features = stage(_features(spark, sf))
    return correlation_matrix(features, correlated_columns(features)).withColumn("corr", _r("corr"))


def isolation_forest_scores(spark, sf):
    """Forests of every month on its whole feature matrix."""
    table = model_rows(_features(spark, sf), JobConfig(), Staging(spark))
    scored = stage(score_forest(table, fit_forest(table, row_key="rowId")))
    return with_decision(scored, 0.1).select("eventId", "month", _r("anomaly", 9), _r("decision", 9))


def newton_margins(spark, sf):
    """Margins of March after a boosting round on January and one, warm started, on February."""
    table = model_rows(_features(spark, sf), JobConfig(), Staging(spark)).withColumn("label", F.col("Fraud"))
    settings, model = BoostSettings(rounds=1, depth=2), None
    for month in (1, 2):
        model = fit_boosted_trees(table.where(F.col("month") == month), settings, model)
    scored = score_by_key(table.where(F.col("month") == 3), {"margin": {3: model}}, "month")
    return scored.select("eventId", _r("margin", 9))


def model_tables(spark, sf):
    """Models of all months stored as rows, one a node, and loaded again: their trees are whole, and
    the trees loaded score every row as the trained ones do."""
    staging = Staging(spark)
    small = BoostSettings(rounds=3, folds=2, depth=3)
    cfg = JobConfig(boost=small, models_out=f"{staging.path}/models")
    table = model_rows(_features(spark, sf), cfg, staging)
    trained = walk_forward(table, cfg, staging)
    stored = spark.read.schema(MODEL_FIELDS).parquet(cfg.models_out)
    both = score_by_key(table, {"a": trained, "b": load_models(stored)}, "month")
    same = both.where(F.col("a") == F.col("b")).groupBy(F.col("month").alias("period"))
    shapes = tree_shapes(stored).join(same.agg(F.count(F.lit(1)).alias("scored")), "period")
    return shapes.select("period", "trees", "lost", (F.col("ends") - F.col("splits")).alias("ends_over_splits"), "scored")


def boosted_probability(spark, sf):
    """Probability of every row by walk-forward training, null in the first month."""
    staging, cfg = Staging(spark), JobConfig()
    table = model_rows(_features(spark, sf), cfg, staging)
    return with_probability(table, walk_forward(table, cfg, staging), "month").select(
        "eventId", "month", "Fraud", "probability"
    )


def anomaly_flags(spark, sf):
    """The 400 most anomalous rows per month on the full feature table, judged."""
    return _rounded_results(monthly_evaluation(*anomaly_review(_features(spark, sf))))


def _by_year_month(spark, sf) -> DataFrame:
    return _dated(spark, sf).withColumn(YEAR_MONTH, year_month("transactionTime"))


def year_month_slices(spark, sf):
    """Rows and amount of each scored month of every year, and of the month it learns from."""
    dated = stage(_by_year_month(spark, sf))
    sums = dated.groupBy(YEAR_MONTH).agg(F.count(F.lit(1)).alias("n"), F.sum("transactionAmount").alias("sum"))
    axis = period_axis(dated, YEAR_MONTH)
    pairs = [(p, role, q) for p, q in zip(axis[1:], axis) for role, q in (("current", p), ("previous", q))]
    wanted = spark.createDataFrame(pairs, "scored_month int, role string, year_month int")
    return wanted.join(sums, YEAR_MONTH, "left").select(
        "scored_month", "role", F.coalesce("n", F.lit(0)).alias("rows"), F.round("sum", 2).alias("amount")
    )


def year_month_top_n(spark, sf):
    """The ten largest amounts of each month of every year."""
    ranked = _by_year_month(spark, sf).withColumn("score", -F.col("transactionAmount"))
    return top_n(ranked, "score", 10, (YEAR_MONTH,)).select(YEAR_MONTH, "eventId", "review_rank")


def year_month_flags(spark, sf):
    """As ``anomaly_flags``, every year's months on their own."""
    cfg = replace(JobConfig(), period=YEAR_MONTH, review_budget=20)
    features = feature_table(stage(transactions(spark, sf)), reports(spark, sf), cfg)
    scored, flagged = anomaly_review(features, cfg)
    return _rounded_results(monthly_evaluation(scored, flagged, YEAR_MONTH), YEAR_MONTH)


def year_month_models(spark, sf):
    """Rows with a probability by the walk-forward models of every year's months."""
    cfg = replace(JobConfig(), period=YEAR_MONTH)
    staging = Staging(spark)
    features = feature_table(stage(transactions(spark, sf)), reports(spark, sf), cfg)
    table = model_rows(features, cfg, staging)
    models = walk_forward(table, cfg, staging)
    scored = with_probability(table, models, YEAR_MONTH).where(F.col("probability").between(0, 1))
    return scored.groupBy(YEAR_MONTH).agg(F.count(F.lit(1)).alias("rows"))


def monthly_detection(spark, sf):
    return detection_job(_features(spark, sf))["results"]


def full_run(spark, sf):
    """Every stage over files, from written inputs to the detected-share report."""
    staging = Staging(spark)
    paths = {name: f"{staging.path}/{name}" for name in ("tx", "labels", "features", "results")}
    transactions(spark, sf).write.parquet(paths["tx"])
    reports(spark, sf).write.parquet(paths["labels"])
    cfg = JobConfig(
        transactions=paths["tx"],
        labels=paths["labels"],
        features_out=paths["features"],
        results_out=paths["results"],
    )
    return run(spark, cfg)["detected"]


def full_run_csv(spark, sf):
    """The whole run from CSV files to CSV results, as the settings file has them: per month what
    does not depend on the models, and the rows flagged."""
    base = Staging(spark).path
    files = {n: f"{base}/{n}.csv" for n in ("tx", "labels", "features", "results", "list")}
    _as_csv(transactions(spark, sf), files["tx"])
    _as_csv(reports(spark, sf), files["labels"])
    cfg = JobConfig(
        transactions=files["tx"],
        labels=files["labels"],
        features_out=files["features"],
        results_out=files["results"],
        flagged_out=files["list"],
    )
    tables = run(spark, cfg)
    flagged = tables["flagged"].groupBy("month").agg(F.count(F.lit(1)).alias("flagged"))
    return tables["results"].join(flagged, "month", "left").select(
        "month", "true_frauds", _r("potential_amount_saved", 2), F.coalesce("flagged", F.lit(0)).alias("flagged")
    )


QUERIES: dict[str, Query] = {
    "tx_scan": tx_scan,
    "labels_scan": labels_scan,
    "ts_normalise": ts_normalise,
    "date_parts": date_parts,
    "hour_bands": hour_bands,
    "one_hot_weekday": one_hot_weekday,
    "one_hot_entry_mode": one_hot_entry_mode,
    "cash_share": cash_share,
    "label_join": label_join,
    "robust_scale": robust_scale,
    "fill_missing": fill_missing_query,
    "drop_columns": drop_columns_query,
    "month_slices": month_slices,
    "key_frequency": key_frequency,
    "velocity_bin": velocity_bin,
    "velocity_six_hours": velocity_six_hours,
    "velocity_literal": velocity_literal,
    "velocity_trailing": velocity_trailing,
    "velocity_stream": velocity_stream,
    "velocity_stream_all": velocity_stream_all,
    "time_since_last_stream": time_since_last_stream,
    "history_before": history_before,
    "known_labels": known_labels,
    "account_quantiles": account_quantiles,
    "merchant_quantiles_narrowed": merchant_quantiles_narrowed,
    "merged_sketch_ranks": merged_sketch_ranks,
    "velocity_five_hours": velocity_five_hours,
    "velocity_five_hours_hot": velocity_five_hours_hot,
    "time_since_last_hot": time_since_last_hot,
    "time_since_last_null_ids": time_since_last_null_ids,
    "key_frequency_hot": key_frequency_hot,
    "one_hot_numeric_mode": one_hot_numeric_mode,
    "csv_scan": csv_scan,
    "labels_csv_scan": labels_csv_scan,
    "merchant_category_frequency": merchant_category_frequency,
    "avg_amount_country_hour": avg_amount_country_hour,
    "avg_amount_hour_events": avg_amount_hour_events,
    "time_since_last": time_since_last,
    "time_since_last_events": time_since_last_events,
    "missing_report": missing_report_query,
    "dataset_profile": dataset_profile_query,
    "value_share": value_share_query,
    "value_share_country": value_share_country,
    "correlation_matrix": correlation_matrix_query,
    "histogram_auto": histogram_auto,
    "box_stats": box_stats_query,
    "top_n_per_month": top_n_per_month,
    "top_n_per_weekday_wide": top_n_per_weekday_wide,
    "flagged_semi_join": flagged_semi_join,
    "monthly_evaluation": monthly_evaluation_query,
    "yearly_totals": yearly_totals_query,
    "cumulative_saved": cumulative_saved_query,
    "metric_series": metric_series_query,
    "detected_share": detected_share_query,
    "features_round_trip": features_round_trip,
    "results_round_trip": results_round_trip,
    "feature_matrix": feature_matrix,
    "stratified_folds": stratified_folds,
    "fold_selection": fold_selection,
    "confusion_metrics": confusion_metrics,
    "decision_offset": decision_offset,
    "combined_score": combined_score_query,
    "near_miss": near_miss_query,
    "adasyn": adasyn_query,
    "near_miss_projections": near_miss_projections,
    "training_report": training_report,
    "balanced_classes": balanced_classes,
    "preprocess_features": preprocess_features,
    "feature_boxes": feature_boxes,
    "feature_correlations": feature_correlations,
    "isolation_forest_scores": isolation_forest_scores,
    "newton_margins": newton_margins,
    "model_tables": model_tables,
    "anomaly_flags": anomaly_flags,
    "boosted_probability": boosted_probability,
    "year_month_slices": year_month_slices,
    "year_month_top_n": year_month_top_n,
    "year_month_flags": year_month_flags,
    "year_month_models": year_month_models,
    "monthly_detection": monthly_detection,
    "full_run": full_run,
    "full_run_csv": full_run_csv,
}
