"""Monthly detection: forests, walk-forward boosted trees, review list, evaluation."""

from __future__ import annotations

from collections.abc import Mapping
from contextlib import ExitStack
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txwarden.config import JobConfig
from txwarden.functions.ordering import with_row_id
from txwarden.functions.periods import YEAR_MONTH, period_axis
from txwarden.functions.staging import Staging, staged_briefly
from txwarden.functions.trees import score_by_key
from txwarden.operators.boosting import (
    BoostedTrees,
    first_margin,
    fit_sets,
    fit_spread_sets,
    sigmoid,
    with_probability,
)
from txwarden.operators.evaluate import monthly_evaluation
from txwarden.operators.folds import best_fold, fold_precision, with_folds
from txwarden.operators.model_tables import store_model, stored_models
from txwarden.operators.forest import degree, fit_forest, is_sent, load_forests, score_forest, with_decision
from txwarden.operators.ranking import combined_score, top_n
from txwarden.operators.resample import adasyn, near_miss
from txwarden.operators.vectors import feature_columns, with_features

#: Training rows, copies for every fold included, that are balanced and stored at the same time.
BALANCED_ROWS = 40_000_000


def model_table(features: DataFrame, cfg: JobConfig, staging: Staging) -> DataFrame:
    """(eventId, rowId, features, Fraud, amount) per period, staged in one folder per period so
    that a period's slice is a pruned read. Events with several reports are several rows, which
    ``rowId`` tells apart."""
    columns = feature_columns(features, cfg.leak_reported_delay, (YEAR_MONTH,))
    table = with_features(features, columns).select(
        "eventId", "features", "Fraud", "transactionAmount_original", cfg.period
    )
    table = with_row_id(table.where(F.col(cfg.period).isNotNull()), "eventId", "rowId")
    columns = ["eventId", "rowId", "features", "Fraud", "transactionAmount_original", cfg.period]
    return staging.write(table.select(*columns), "model", (cfg.period,))


def month_slice(df: DataFrame, month: int) -> DataFrame:
    return df.where(F.col("month") == month)


def scored_rows(
    table: DataFrame, models: dict[int, BoostedTrees], cfg: JobConfig, staging: Staging
) -> DataFrame:
    """Anomaly, decision and probability of every row.

    The forests of all months are built in one job. Both scores are computed in one pass
    over the rows, so nothing is joined back, and stored, since the decision's quantile
    reads them again.
    """
    forest = fit_forest(table, cfg.forest, cfg.seed, cfg.period, "rowId")
    if is_sent(forest):
        forests = load_forests(forest, cfg.period)
        scored = score_by_key(table, {"anomaly": forests, "probability": models}, cfg.period)
        scored = scored.withColumn("anomaly", degree(F.col("anomaly")))
    else:
        scored = table.withColumn("probability", F.lit(None).cast("double"))
        if models:
            scored = score_by_key(table, {"probability": models}, cfg.period, drop_features=False)
        scored = score_forest(scored, forest, cfg.period)
    scored = scored.withColumn("probability", sigmoid(F.col("probability")))
    scored = staging.write(scored, "scored")
    return with_decision(scored, cfg.forest.contamination, by=(cfg.period,))


@dataclass
class TrainingReport:
    """What a walk leaves behind for each period and fold, filled as it goes on."""

    folds: list[tuple[int, int, float, bool]] = field(default_factory=list)
    sizes: DataFrame | None = None

    def add_sizes(self, sizes: DataFrame) -> None:
        """Keep ``sizes``, a row each period and fold, past the tables that they are counted on."""
        kept = sizes.sparkSession.createDataFrame(sizes.collect(), sizes.schema)
        self.sizes = kept if self.sizes is None else self.sizes.unionByName(kept)

    def table(self, spark: SparkSession) -> DataFrame:
        """(month, fold, precision, chosen, rows_before, synthetic, skipped, rows_after): a fold's
        held-out precision and whether its model was kept; the rows of its training set before
        and after balancing; ``skipped`` where no synthetic rows could be made."""
        folds = spark.createDataFrame(self.folds, "month int, fold int, precision double, chosen boolean")
        if self.sizes is None:
            return folds.limit(0)
        return folds.join(self.sizes, ["month", "fold"], "left")


def training_sizes(grown: DataFrame, train: DataFrame) -> DataFrame:
    synthetic = F.count_if("synthetic")
    before = grown.groupBy("month", F.col("model").alias("fold")).agg(
        F.count_if(~F.col("synthetic")).alias("rows_before"),
        synthetic.alias("synthetic"),
        (synthetic == 0).alias("skipped"),
    )
    after = train.groupBy("month", F.col("model").alias("fold")).agg(F.count(F.lit(1)).alias("rows_after"))
    return before.join(after, ["month", "fold"], "left")


def training_sets(
    table: DataFrame, cfg: JobConfig, staging: Staging, report: TrainingReport | None = None
) -> tuple[DataFrame, DataFrame]:
    """Balanced training rows and held-out rows of every month and fold.

    Balancing needs no earlier model, so all months given and all folds are balanced together; only
    the boosting itself has to go month by month. What balancing stores on its way goes with it.
    """
    k = cfg.boost.folds
    folded = with_folds(table, k, "Fraud", (cfg.period,), "rowId", cfg.seed)
    folded = folded.select(
        F.col(cfg.period).alias("month"),
        "fold",
        F.col("rowId").alias("row_id"),
        F.col("Fraud").alias("label"),
        "features",
    )
    held_out = staging.write(folded, "folds", ("month",))
    models = F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    copies = held_out.withColumn("model", models).where(F.col("model") != F.col("fold"))
    sets = ("month", "model")
    with staged_briefly(table.sparkSession) as brief:
        with staged_briefly(table.sparkSession):
            grown = brief.write(adasyn(copies.drop("fold"), sets, seed=cfg.seed), "grown")
        even = near_miss(grown, sets, seed=cfg.seed)
        even = even.select("month", "model", "label", "features")
        train = staging.write(even, "train", sets)
        if report is not None:
            report.add_sizes(training_sizes(grown, train))
    return train, held_out


def period_runs(rows: Mapping[int, int], most: int) -> list[list[int]]:
    """Periods in order, in runs of at most ``most`` rows together, or of a single period."""
    runs: list[list[int]] = []
    held = 0
    for period in sorted(rows):
        if not runs or held + rows[period] > most:
            runs.append([])
            held = 0
        runs[-1].append(period)
        held += rows[period]
    return runs


def train_month(
    train: DataFrame,
    held_out: DataFrame,
    month: int,
    previous: BoostedTrees | None,
    cfg: JobConfig,
    report: TrainingReport | None = None,
) -> BoostedTrees:
    """Train one model per fold on ``month``, at the same time, and keep the one with the
    best held-out precision, the first among equals (also when all are 0)."""
    rows = month_slice(train, month)
    sizes = [r["count"] for r in rows.groupBy("model").count().collect()]
    # the same trees either way
    fit = fit_sets if max(sizes, default=0) <= cfg.boost.task_rows else fit_spread_sets
    fitted = fit(rows, "model", cfg.boost, previous)
    empty = previous or BoostedTrees(first_margin(0, 0))
    models = {fold: fitted.get(fold, empty) for fold in range(cfg.boost.folds)}
    tested = with_probability(month_slice(held_out, month).drop("row_id"), models, "fold")
    precisions = fold_precision(tested, "label")
    if report is None:
        return models[best_fold(precisions).first()["fold"]]
    found = {r["fold"]: r["precision"] for r in precisions.collect()}
    best = min(found, key=lambda fold: (-found[fold], fold))
    report.folds += [(month, fold, precision, fold == best) for fold, precision in sorted(found.items())]
    return models[best]


def walk_forward(
    table: DataFrame,
    cfg: JobConfig,
    staging: Staging,
    last: int | None = None,
    report: TrainingReport | None = None,
) -> dict[int, BoostedTrees]:
    """Model for each period (month of the year, or year and month) from the second on, up to
    ``last``, trained on the period before and warm started from that period's model. A period
    after an empty one keeps the older model.

    Training sets are stored for a run of periods at a time (``BALANCED_ROWS``), so that disk holds
    those of a run and not of the whole table.

    With ``cfg.models_out`` every model is stored as soon as it is trained, and a run goes on
    after the last one stored there. ``report`` gets what each fold came to."""
    spark = table.sparkSession
    axis = [p for p in period_axis(table, cfg.period) if last is None or p <= last]
    models = stored_models(spark, cfg.models_out) if cfg.models_out else {}
    models = {p: model for p, model in models.items() if p in axis}
    start = max(models, default=axis[0] if axis else 0)
    ahead = [p for p in axis if p > start]
    if not ahead:
        return models
    previous = models.get(start)
    column = F.col(cfg.period)
    training = table.where((column >= start) & (column < ahead[-1]))
    rows = {r[0]: r["count"] for r in training.groupBy(cfg.period).count().collect()}
    runs = period_runs({p: n * (cfg.boost.folds - 1) for p, n in rows.items()}, BALANCED_ROWS)
    first_of = {run[0]: run for run in runs}
    with ExitStack() as stored:
        for before, period in zip([start, *ahead], ahead, strict=False):
            known = len(previous.trees) if previous else 0
            if before in first_of:
                # the sets of the run before are trained and go
                stored.close()
                run = first_of[before]
                own = stored.enter_context(staging.part())
                train, held_out = training_sets(training.where(column.between(run[0], run[-1])), cfg, own, report)
            if before in rows:
                previous = train_month(train, held_out, before, previous, cfg, report)
            if previous is not None:
                models[period] = previous
                if cfg.models_out:
                    store_model(spark, cfg.models_out, period, previous, known)
    return models


def review_list(
    features: DataFrame, cfg: JobConfig = JobConfig(), staging: Staging | None = None
) -> tuple[DataFrame, DataFrame]:
    """(scored rows, flagged rows): the first month by anomaly alone, later ones by
    anomaly and probability together."""
    staging = staging or Staging(features.sparkSession)
    table = model_table(features, cfg, staging)
    scored = scored_rows(table, walk_forward(table, cfg, staging), cfg, staging)
    alone = F.col("decision") if cfg.score_mode == "product" else F.col("anomaly")
    both = combined_score(mode=cfg.score_mode)
    score = F.when(F.col("probability").isNull(), alone).otherwise(both)
    scored = scored.withColumn("score", score)
    return scored, top_n(scored, "score", cfg.review_budget, (cfg.period,), "rowId")


def anomaly_review(
    features: DataFrame, cfg: JobConfig = JobConfig(), staging: Staging | None = None
) -> tuple[DataFrame, DataFrame]:
    """(scored rows, flagged rows) by anomaly alone, every month."""
    staging = staging or Staging(features.sparkSession)
    scored = scored_rows(model_table(features, cfg, staging), {}, cfg, staging)
    return scored, top_n(scored, "decision", cfg.review_budget, (cfg.period,), "rowId")


def detection_job(
    features: DataFrame, cfg: JobConfig = JobConfig(), staging: Staging | None = None
) -> dict[str, DataFrame]:
    scored, flagged = review_list(features, cfg, staging)
    return {
        "scored": scored,
        "flagged": flagged,
        "results": monthly_evaluation(scored, flagged, cfg.period),
    }
