"""Job parameters: column roles, split ratios, model choice and their constraints."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

SOURCE_FILE = "_source_file"

# The accepted model names and their short forms.
MODEL_ALIASES = {
    "decision_tree": "decision_tree_regression",
    "knn": "knn_regression",
    "random_forest": "random_forest_regression",
    "ridge": "ridge_regression",
    "sgd": "sgd_regression",
}
MODEL_NAMES = frozenset(MODEL_ALIASES.values())
PRIMARY_METRICS = frozenset({"rmse", "mae", "smape"})
TRAINING_MODES = frozenset({"all", "single"})
UPDATE_STRATEGIES = frozenset({"full_refit", "rolling_refit", "incremental"})
MISSING_STRATEGIES = frozenset({"drop", "fill_zero", "fill_value", "keep"})

# The default hyperparameters of each model.
DEFAULT_MODEL_PARAMETERS: dict[str, dict[str, Any]] = {
    "decision_tree_regression": {"min_samples_leaf": 10},
    "random_forest_regression": {
        "n_estimators": 100,
        "max_depth": 20,
        "min_samples_leaf": 10,
    },
    "knn_regression": {"n_neighbors": 8, "weights": "distance"},
    "ridge_regression": {"alpha": 1.0},
    "sgd_regression": {"alpha": 0.0001, "max_iter": 1000, "tol": 0.001},
}


def _tuples(values: Mapping[str, Any]) -> dict[str, Any]:
    return {k: tuple(v) if isinstance(v, list) else v for k, v in values.items()}


def _require(holds: bool, message: str) -> None:
    if not holds:
        raise ValueError(message)


def canonical_model_name(name: str) -> str:
    return MODEL_ALIASES.get(name, name)


@dataclass(frozen=True)
class ColumnRoles:
    """Which columns are numbers, categories, dates, ids and service fields."""

    numeric: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    datetime: tuple[str, ...] = ()
    ids: tuple[str, ...] = ()
    service: tuple[str, ...] = ()


@dataclass(frozen=True)
class DimensionParams:
    """Where the store dimension lies and how it joins to the facts."""

    key: str = "Store"
    check_column: str = "StoreType"
    path: str | None = None
    file_name: str = "store.csv"
    external_dir: str | None = None


# Texts that stand for a missing value in CSV files.
NULL_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


@dataclass(frozen=True)
class FileParams:
    """How CSV is read, and which time formats are tried, in order, after the ISO ones.

    A quoted line break needs ``multi_line``, with which a file is read by one task; without it
    large files are split.
    """

    multi_line: bool = True
    null_texts: tuple[str, ...] = NULL_TEXTS
    time_formats: tuple[str, ...] = ()


@dataclass(frozen=True)
class TargetParams:
    missing_strategy: str = "drop"
    fill_value: float = 0.0
    add_indicator: bool = False
    indicator_suffix: str = "_WAS_MISSING"

    def __post_init__(self) -> None:
        _require(
            self.missing_strategy in MISSING_STRATEGIES,
            f"missing_strategy must be one of {sorted(MISSING_STRATEGIES)}",
        )


@dataclass(frozen=True)
class ModelParams:
    primary_metric: str = "rmse"
    training_mode: str = "all"
    candidate_models: tuple[str, ...] = (
        "decision_tree_regression",
        "random_forest_regression",
        "knn_regression",
        "ridge_regression",
    )
    selected_model: str | None = None
    update_strategy: str = "full_refit"
    stream_batch_days: int = 7
    initial_train_ratio: float = 0.50
    validation_ratio: float = 0.20
    stream_ratio: float = 0.30
    rolling_train_period_days: int = 365
    random_seed: int = 42
    training_partitions: int = 32
    parameters: Mapping[str, Mapping[str, Any]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        _require(
            self.primary_metric in PRIMARY_METRICS,
            f"primary_metric must be one of {sorted(PRIMARY_METRICS)}",
        )
        _require(
            isinstance(self.candidate_models, (list, tuple))
            and len(self.candidate_models) > 0,
            "candidate_models must not be empty",
        )
        candidates = [canonical_model_name(name) for name in self.candidate_models]
        for name in candidates:
            _require(name in MODEL_NAMES, f"unknown candidate model: {name}")
        _require(
            self.training_mode in TRAINING_MODES,
            f"training_mode must be one of {sorted(TRAINING_MODES)}",
        )
        if self.selected_model is None:
            object.__setattr__(self, "selected_model", self.candidate_models[0])
        _require(
            canonical_model_name(self.selected_model) in candidates,
            f"selected_model is not a candidate: {self.selected_model}",
        )
        _require(
            self.update_strategy in UPDATE_STRATEGIES,
            f"update_strategy must be one of {sorted(UPDATE_STRATEGIES)}",
        )
        _require(self.stream_batch_days > 0, "stream_batch_days must be positive")
        _require(self.training_partitions > 0, "training_partitions must be positive")
        _require(
            self.rolling_train_period_days > 0,
            "rolling_train_period_days must be positive",
        )
        _require(
            min(self.initial_train_ratio, self.validation_ratio, self.stream_ratio) > 0,
            "split ratios must be positive",
        )
        _require(
            self.initial_train_ratio + self.validation_ratio < 1.0,
            "split ratios must leave a stream period",
        )

    @property
    def selected(self) -> str:
        return canonical_model_name(self.selected_model)

    def candidates(self) -> list[str]:
        """Canonical candidate names, first spelling wins."""
        return list(dict.fromkeys(map(canonical_model_name, self.candidate_models)))

    def to_train(self) -> list[str]:
        return self.candidates() if self.training_mode == "all" else [self.selected]

    def to_evaluate(self) -> list[str]:
        return list(dict.fromkeys([*self.candidates(), self.selected]))

    def hyperparameters(self, name: str) -> dict[str, Any]:
        """Parameters configured under the canonical name, else under any alias of it."""
        wanted = canonical_model_name(name)
        spellings = [wanted, *(s for s in self.parameters if canonical_model_name(s) == wanted)]
        for spelling in spellings:
            if spelling in self.parameters:
                return dict(self.parameters[spelling] or {})
        return dict(DEFAULT_MODEL_PARAMETERS[wanted]) if not self.parameters else {}


@dataclass(frozen=True)
class JobParams:
    time_column: str = "Date"
    target_column: str = "Sales"
    leakage_columns: tuple[str, ...] = ("Customers",)
    roles: ColumnRoles = ColumnRoles()
    dimension: DimensionParams = DimensionParams()
    files: FileParams = FileParams()
    target: TargetParams = TargetParams()
    model: ModelParams = ModelParams()
    project: str = "sales_forecasting"

    @property
    def indicator_column(self) -> str:
        return f"{self.target_column}{self.target.indicator_suffix}"

    @classmethod
    def from_mapping(cls, raw: Mapping[str, Any]) -> "JobParams":
        """Build from nested plain values, as a configuration file would hold them."""
        made = dict(raw)
        sections = {
            "roles": ColumnRoles,
            "dimension": DimensionParams,
            "files": FileParams,
            "target": TargetParams,
            "model": ModelParams,
        }
        for name, section in sections.items():
            if name in made and not isinstance(made[name], section):
                made[name] = section(**_tuples(made[name]))
        return cls(**_tuples(made))


# The column roles of the store-sales data this pipeline was first meant for.
STORE_SALES_ROLES = ColumnRoles(
    numeric=(
        "DayOfWeek",
        "Open",
        "Promo",
        "SchoolHoliday",
        "CompetitionDistance",
        "CompetitionOpenSinceMonth",
        "CompetitionOpenSinceYear",
        "Promo2",
        "Promo2SinceWeek",
        "Promo2SinceYear",
    ),
    categorical=("Store", "StateHoliday", "StoreType", "Assortment", "PromoInterval"),
    datetime=("Date",),
    ids=("Id",),
    service=("Customers", SOURCE_FILE),
)
