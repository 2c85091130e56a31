"""Job configuration, passed explicitly to every job; nothing is read at import."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace

# Default columns to scale and to drop before modelling.
SCALED_COLUMNS = (
    "transactionAmount",
    "availableCash",
    "accountNumber_freq",
    "merchantId_freq",
    "mcc_freq",
    "cash_pct_spent",
)
DROPPED_COLUMNS = (
    "eventId",
    "merchantId",
    "mcc",
    "merchantCountry",
    "merchantZip",
    "weekday",
    "posEntryMode",
    "hour",
    "transactionTime",
    "reportedTime",
    "accountNumber",
)


@dataclass(frozen=True)
class ForestSettings:
    trees: int = 100
    subsample: int = 256
    contamination: float = 0.1


@dataclass(frozen=True)
class BoostSettings:
    rounds: int = 100
    folds: int = 5
    depth: int = 6
    learning_rate: float = 0.3
    l2: float = 1.0
    min_child_weight: float = 1.0
    max_bins: int = 256
    # Training sets of up to so many rows are trained in one task each (about 400 MB of features),
    # larger ones over all executors, to the same trees but with a Spark job for every level.
    task_rows: int = 1_500_000


@dataclass(frozen=True)
class JobConfig:
    transactions: str | None = None
    labels: str | None = None
    features_out: str | None = None
    results_out: str | None = None
    flagged_out: str | None = None
    models_out: str | None = None  # boosted models; a run goes on after the last month stored there
    scaled_columns: tuple[str, ...] = SCALED_COLUMNS
    dropped_columns: tuple[str, ...] = DROPPED_COLUMNS
    review_budget: int = 400
    period: str = "month"  # of the year, all years together; or "year_month", every year's own
    seed: int = 42
    velocity_mode: str = "bin"
    score_mode: str = "product"
    label_dedupe: str | None = None
    leak_reported_delay: bool = False
    forest: ForestSettings = field(default_factory=ForestSettings)
    boost: BoostSettings = field(default_factory=BoostSettings)

    @classmethod
    def from_json(cls, path: str) -> "JobConfig":
        """Read the three-section settings file: data paths, output paths, model settings."""
        with open(path, encoding="utf-8") as handle:
            raw = json.load(handle)
        paths = raw.get("data_paths", {})
        outputs = raw.get("output_paths", {})
        model = raw.get("model_settings", {})
        base = cls(
            transactions=paths.get("transactions_file"),
            labels=paths.get("labels_file"),
            features_out=outputs.get("preprocessed_data_file"),
            results_out=outputs.get("fraud_detection_results_file"),
            flagged_out=outputs.get("flagged_transactions_file"),
            models_out=outputs.get("models_file"),
        )
        return replace(
            base,
            scaled_columns=tuple(model.get("numeric_columns_to_scale", base.scaled_columns)),
            dropped_columns=tuple(model.get("columns_to_drop", base.dropped_columns)),
            period=model.get("period", base.period),
            seed=model.get("random_state", base.seed),
            forest=replace(
                base.forest, contamination=model.get("contamination", base.forest.contamination)
            ),
        )
