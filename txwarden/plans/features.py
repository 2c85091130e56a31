"""From raw transactions and reports to the feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txwarden.config import JobConfig
from txwarden.functions.periods import YEAR_MONTH, year_month
from txwarden.functions.skew import DEFAULT_SKEW, SkewSettings, profile_keys
from txwarden.functions.staging import Staging
from txwarden.operators.averages import AVERAGED_KEYS, with_average_amounts
from txwarden.operators.cleaning import drop_columns, fill_missing
from txwarden.operators.frequency import FREQUENCY_KEYS, with_key_frequency
from txwarden.operators.labels import join_labels, with_label_columns
from txwarden.operators.profile import dataset_profile, missing_report
from txwarden.operators.scaling import fit_robust_scale
from txwarden.operators.temporal import (
    observed_categories,
    wall_clock,
    with_cash_share,
    with_date_parts,
    with_entry_mode_columns,
    with_hour_bands,
    with_weekday_columns,
)
from txwarden.operators.velocity import account_window_features
from txwarden.sources.files import (
    read_features,
    read_labels,
    read_transactions,
    write_features,
)


def raw_feature_columns(
    tx: DataFrame, cfg: JobConfig, skew: SkewSettings = DEFAULT_SKEW
) -> DataFrame:
    """Frequencies, date parts and hour bands; the columns the missing report looks at."""
    timed = wall_clock(tx, "transactionTime")
    counted = with_key_frequency(timed, FREQUENCY_KEYS, skew=skew)
    return with_hour_bands(with_date_parts(counted))


def raw_feature_nulls(tx: DataFrame, cfg: JobConfig = JobConfig()) -> DataFrame:
    """The columns of :func:`raw_feature_columns` as the missing report needs them: a frequency
    is null exactly where its key is, so no key has to be counted or joined."""
    timed = wall_clock(tx, "transactionTime")
    known = {
        f"{k}_freq": F.when(F.col(k).isNotNull(), F.lit(1)).cast("long") for k in FREQUENCY_KEYS
    }
    return with_hour_bands(with_date_parts(timed.withColumns(known)))


def joined_features(
    tx: DataFrame,
    labels: DataFrame,
    cfg: JobConfig = JobConfig(),
    entry_modes: Sequence[str] | None = None,
    skew: SkewSettings = DEFAULT_SKEW,
) -> DataFrame:
    """All features that need no statistics of other features, with labels.

    Two shuffles of the whole table: by account, for four features at once, and by event
    for the labels; one more by merchant when the merchants are too many to broadcast.
    """
    timed = wall_clock(tx, "transactionTime")
    reported = wall_clock(labels, "reportedTime")
    account, merchant, category = profile_keys(
        timed, ["accountNumber"], ["merchantId"], ["mcc"], settings=skew
    )
    if entry_modes is None:
        entry_modes = observed_categories(timed, "posEntryMode")
    out = account_window_features(timed, account, cfg.velocity_mode, skew=skew)
    # counted on the input, so that counting does not repeat the account windows
    counted = with_key_frequency(
        out, ["merchantId", "mcc"], skew=skew, profiles=[merchant, category], counted=timed
    )
    out = with_cash_share(with_hour_bands(with_date_parts(counted)))
    if cfg.period == YEAR_MONTH:
        out = out.withColumn(YEAR_MONTH, year_month("transactionTime"))
    out = with_entry_mode_columns(with_weekday_columns(out), entry_modes)
    out = with_label_columns(join_labels(out, reported, dedupe=cfg.label_dedupe, skew=skew))
    return out.withColumn("transactionAmount_original", F.col("transactionAmount"))


def build_features(
    tx: DataFrame,
    labels: DataFrame,
    cfg: JobConfig = JobConfig(),
    staging: Staging | None = None,
    entry_modes: Sequence[str] | None = None,
    skew: SkewSettings = DEFAULT_SKEW,
    drop_early: Sequence[str] = (),
) -> DataFrame:
    """Features with labels, scaled, with the country and hour means of the scaled amount.

    The joined table is staged once: quartiles and means read single columns of it.
    ``drop_early`` names columns that need not get that far.
    """
    staging = staging or Staging(tx.sparkSession)
    joined = drop_columns(joined_features(tx, labels, cfg, entry_modes, skew), drop_early)
    staged = staging.write(joined, "joined")
    scaled = fit_robust_scale(staged, cfg.scaled_columns).transform(staged)
    return with_average_amounts(scaled, "transactionAmount", AVERAGED_KEYS, skew=skew)


def feature_table(
    tx: DataFrame,
    labels: DataFrame,
    cfg: JobConfig = JobConfig(),
    staging: Staging | None = None,
    entry_modes: Sequence[str] | None = None,
    skew: SkewSettings = DEFAULT_SKEW,
) -> DataFrame:
    """:func:`build_features` with gaps filled and working columns dropped; the event key
    stays to identify rows. Columns without a later use are dropped before staging, which
    also keeps unused ones out of the scan and the shuffles."""
    late = [c for c in cfg.dropped_columns if c == "eventId" or c in AVERAGED_KEYS]
    early = [c for c in cfg.dropped_columns if c not in late]
    features = build_features(tx, labels, cfg, staging, entry_modes, skew, early)
    return drop_columns(fill_missing(features), late, keep_key="eventId")


def preprocess_job(
    tx: DataFrame, labels: DataFrame, out_path: str, cfg: JobConfig = JobConfig()
) -> dict[str, DataFrame]:
    """Write the feature table; return it with the missing-value report and the profile."""
    spark = tx.sparkSession
    with Staging(spark) as staging:
        write_features(feature_table(tx, labels, cfg, staging), out_path)
    written = read_features(spark, out_path)
    return {
        "features": written,
        "missing": missing_report(raw_feature_nulls(tx, cfg)),
        "profile": dataset_profile(written),
    }


def preprocess_files(spark, cfg: JobConfig) -> dict[str, DataFrame]:
    """:func:`preprocess_job` over the configured paths."""
    tx = read_transactions(spark, cfg.transactions)
    return preprocess_job(tx, read_labels(spark, cfg.labels), cfg.features_out, cfg)
