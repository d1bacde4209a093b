"""The batch jobs: load, pretrain, evaluate, score."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from tillcast.functions.columns import iso_day, moment, not_below_zero, quoted
from tillcast.models.factory import top_features
from tillcast.models.registry import PRETRAIN_BATCH, ModelRegistry
from tillcast.operators.clean import apply_types, clean_training, drop_leakage, require_column
from tillcast.operators.diagnostics import daily_timeline, residuals
from tillcast.operators.features import LABEL, vector_names, with_features
from tillcast.operators.history import Operations, append_metrics
from tillcast.operators.lookup import enrich
from tillcast.operators.metrics import (
    BASELINES,
    baseline_metrics,
    best_project_model,
    leaderboard,
)
from tillcast.operators.periods import Split, period_rows, split_periods
from tillcast.params import SOURCE_FILE, JobParams
from tillcast.plans.fitting import (
    EstimatorFor,
    fit_on_vectors,
    fit_preprocessor,
    held_vectors,
    predict,
    require_rows,
    score,
    training_rows,
)
from tillcast.sources.files import (
    read_dimension,
    read_file,
    read_sources,
    tag_source,
    with_times,
)
from tillcast.sources.tables import BATCH_METADATA, KeyedTable, records


@dataclass(frozen=True)
class Workspace:
    """Where the tables of one project lie."""

    spark: SparkSession
    root: str

    def table(self, name: str, *key: str) -> KeyedTable:
        return KeyedTable(self.spark, f"{self.root.rstrip('/')}/{name}", key or ("batch_id",))

    @property
    def raw(self) -> KeyedTable:
        return self.table("raw")

    @property
    def processed(self) -> KeyedTable:
        return self.table("processed")

    @property
    def batches(self) -> KeyedTable:
        return self.table("batch_metadata")

    @property
    def quality(self) -> KeyedTable:
        return self.table("data_quality")

    @property
    def sketches(self) -> KeyedTable:
        return self.table("distinct_sketches")

    @property
    def metrics(self) -> KeyedTable:
        return self.table("model_metrics", "batch_id", "model_name")

    @property
    def predictions(self) -> KeyedTable:
        return self.table("predictions", "batch_id", "model_name")

    @property
    def importances(self) -> KeyedTable:
        return self.table("top_features", "batch_id", "model_name")

    @property
    def operations(self) -> Operations:
        return Operations(self.spark, f"{self.root.rstrip('/')}/operations")

    def registry(self, params: JobParams) -> ModelRegistry:
        return ModelRegistry(self.spark, f"{self.root.rstrip('/')}/models", params.model)

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def committed(self) -> DataFrame:
        return self.batches.read(BATCH_METADATA)


def load_source(spark: SparkSession, paths: Sequence[str], params: JobParams) -> DataFrame:
    """Union of the fact files with the store dimension joined on."""
    facts = read_sources(spark, paths, files=params.files)
    times = (params.time_column, *params.roles.datetime)
    facts = with_times(facts, times, params.files.time_formats)
    dimension = read_dimension(spark, params.dimension, paths, files=params.files)
    return enrich(facts, dimension, params.dimension)


def write_diagnostics(
    workspace: Workspace,
    model: PipelineModel,
    predictions: DataFrame,
    params: JobParams,
    batch_id: int,
    name: str,
) -> None:
    """Per-row diagnostics and ranked features of a model on a batch."""
    keys = {"batch_id": F.lit(batch_id).cast("long"), "model_name": F.lit(name)}
    rows = residuals(predictions, params.time_column)
    workspace.predictions.write(rows.withColumns(keys))
    ranked = top_features(workspace.spark, model.stages[-1], vector_names(model.stages))
    workspace.importances.write(ranked.withColumns(keys))


def metric_rows(spark: SparkSession, rows: list[dict[str, object]]) -> DataFrame:
    """Metric dicts as a frame; a field all rows lack a value for is a null double."""
    names = list(dict.fromkeys(name for row in rows for name in row))
    kinds = {int: "long", float: "double", str: "string", bool: "boolean"}

    def kind(name: str) -> str:
        present = [row[name] for row in rows if row.get(name) is not None]
        return kinds[type(present[0])] if present else "double"

    schema = ", ".join(f"`{name}` {kind(name)}" for name in names)
    return records(spark, [tuple(row.get(n) for n in names) for row in rows], schema)


@dataclass(frozen=True)
class Pretrained:
    split: Split
    metrics: DataFrame
    best: str
    model: PipelineModel


def train_candidates(
    cleaned: DataFrame,
    params: JobParams,
    split: Split,
    names: Sequence[str],
    make: EstimatorFor | None = None,
) -> dict[str, tuple[PipelineModel, DataFrame]]:
    """Each model fitted on the initial period with its predictions for the validation period.

    The preprocessor is the same for all of them, so it is fitted once.
    """
    initial = training_rows(period_rows(cleaned, params, split, "initial"), params)
    validation = period_rows(cleaned, params, split, "validation")
    require_rows(initial.select(LABEL), 10, "pretraining")
    require_rows(validation, 1, "validation")
    preprocessor = fit_preprocessor(initial, params)
    made = {}
    with held_vectors(preprocessor, initial, params.model.training_partitions) as vectors:
        for name in names:
            model = fit_on_vectors(preprocessor, vectors, params, name, make)
            made[name] = (model, predict(model, validation, params, keep=[params.time_column]))
    return made


def pretrain(
    source: DataFrame,
    params: JobParams,
    workspace: Workspace | None = None,
    make: EstimatorFor | None = None,
) -> Pretrained:
    """Train the candidates on the initial period and choose by the validation metric.

    The saved model is the one fitted on the initial period alone.
    """
    spark = source.sparkSession
    cleaned = clean_training(source, params)
    split = split_periods(source, params)
    at = quoted(params.time_column)
    inside = (at >= F.lit(split.first("initial"))) & (
        at < F.date_add(F.lit(split.last("initial")), 1)
    )
    usable = inside & quoted(params.target_column).isNotNull()
    size = cleaned.agg(
        F.count(F.lit(1)), iso_day(F.min(at)), iso_day(F.max(at)), F.count_if(usable)
    ).first()
    training = size[3]
    names = params.model.to_train()
    made = train_candidates(cleaned, params, split, names, make)
    rows = []
    for name, (model, predictions) in made.items():
        predictions = predictions.persist()
        rows.append(
            {
                "model_name": name,
                "batch_id": PRETRAIN_BATCH,
                "period_type": "validation",
                **score(predictions),
                "training_mode": params.model.training_mode,
                "update_strategy": "pretrain",
                "initial_training": True,
                "train_rows": training,
                "training_rows_total": training,
                "train_window_date_min": split.fields["initial_date_min"],
                "train_window_date_max": split.fields["initial_date_max"],
                "date_min": split.fields["validation_date_min"],
                "date_max": split.fields["validation_date_max"],
                "date_count": split.fields["validation_date_count"],
                "pretrain_rows": size[0],
                "pretrain_time_min": size[1],
                "pretrain_time_max": size[2],
                **split.fields,
            }
        )
        if workspace is not None:
            write_diagnostics(workspace, model, predictions, params, PRETRAIN_BATCH, name)
        predictions.unpersist()
    best = min(rows, key=lambda row: row[params.model.primary_metric])
    if workspace is not None:
        workspace.processed.write(
            cleaned.withColumn("batch_id", F.lit(PRETRAIN_BATCH).cast("long"))
        )
        path = workspace.registry(params).register(
            made[best["model_name"]][0], PRETRAIN_BATCH, best["model_name"], best
        )
        for row in rows:
            row["model_path"] = path
    metrics = append_metrics(None, metric_rows(spark, rows), params.model.primary_metric)
    if workspace is not None:
        workspace.metrics.write(metrics)
    return Pretrained(split, metrics, best["model_name"], made[best["model_name"]][0])


@dataclass(frozen=True)
class Evaluation:
    metrics: DataFrame
    predictions: dict[str, DataFrame]

    def leaderboard(self) -> DataFrame:
        return leaderboard(self.metrics)

    def best_timeline(self) -> DataFrame | None:
        best: Row | None = best_project_model(self.metrics).first()
        if best is None:
            return None
        found = self.predictions[best["model_name"]]
        return daily_timeline(found, found.columns[0])


def evaluate(
    source: DataFrame,
    params: JobParams,
    names: Sequence[str] | None = None,
    make: EstimatorFor | None = None,
    workspace: Workspace | None = None,
) -> Evaluation:
    """Zero and mean baselines and every candidate on the same time split."""
    spark = source.sparkSession
    cleaned = clean_training(source, params)
    split = split_periods(cleaned, params)
    initial = period_rows(cleaned, params, split, "initial")
    validation = period_rows(cleaned, params, split, "validation")
    metrics = baseline_metrics(initial, validation, params.target_column)
    predictions = {}
    names = params.model.to_evaluate() if names is None else names
    if names:
        made = train_candidates(cleaned, params, split, names, make)
        predictions = {name: found for name, (_, found) in made.items()}
        fields = [c for c in metrics.columns if c != "model_name"]
        rows = []
        for name, found in predictions.items():
            scored = score(found, with_range=True)
            rows.append({"model_name": name, **{c: scored[c] for c in fields}})
        metrics = metrics.unionByName(metric_rows(spark, rows))
    notes = F.when(
        ~F.col("model_name").isin(*BASELINES),
        F.lit(f"without {', '.join(params.leakage_columns)}" if params.leakage_columns else ""),
    )
    metrics = metrics.withColumn("notes", notes)
    if workspace is not None:
        ranked = leaderboard(metrics).coalesce(1)
        ranked.write.mode("overwrite").parquet(workspace.path("leaderboard"))
    return Evaluation(metrics, predictions)


def score_rows(
    raw: DataFrame,
    model: PipelineModel,
    params: JobParams,
    dimension: DataFrame | None = None,
    file_name: str | None = None,
) -> DataFrame:
    """The given rows and columns as they are, plus ``predict``.

    All rows must come through, so a time that does not parse fails the whole input; the check
    is part of the scoring pass.
    """
    require_column(raw, params.time_column, "time")
    originals = F.struct(*map(quoted, raw.columns)).alias("_given")
    prepared = raw
    if SOURCE_FILE not in raw.columns:
        prepared = (
            tag_source(raw) if file_name is None else raw.withColumn(SOURCE_FILE, F.lit(file_name))
        )
    prepared = enrich(prepared.select("*", originals), dimension, params.dimension)
    at = moment(prepared, params.time_column, params.files.time_formats)
    prepared = prepared.withColumns({"_whole": at.isNotNull(), params.time_column: at})
    prepared = prepared.transform(apply_types, params).transform(drop_leakage, params)
    scored = model.transform(with_features(prepared, params))
    lost = F.raise_error(F.lit(f"{params.time_column} does not parse; no row may be lost"))
    predict = F.when(F.col("_whole"), not_below_zero(F.col("prediction"))).otherwise(lost)
    return scored.select("_given.*", predict.cast("double").alias("predict"))


def score_file(
    spark: SparkSession,
    path: str,
    params: JobParams,
    workspace: Workspace,
    dimension: DataFrame | None = None,
    model: PipelineModel | None = None,
    schema=None,
    run_id: str | None = None,
) -> str:
    """Score a file with the best model into a path of its own; recorded either way."""
    import uuid

    run = run_id or uuid.uuid4().hex
    output = workspace.path(f"scored/run_id={run}")
    registry = workspace.registry(params)
    with workspace.operations.record(
        "inference",
        run,
        model_name=params.model.selected,
        input_path=path,
    ) as record:
        best = registry.best() if model is None else None
        # Known before anything can go wrong, so that a failure is recorded with it.
        record["model_path"] = best["model_path"] if best else None
        raw = read_file(spark, path, schema, params.files)
        if model is None:
            model = registry.load(best, "best")
        scored = score_rows(raw, model, params, dimension, path.rstrip("/").rpartition("/")[2])
        watched, counts = _observed(scored, f"scored_{run}")
        watched.write.mode("errorifexists").parquet(output)
        rows = counts.get["rows"]
        record.update(
            input_rows=rows,
            output_rows=rows,
            output_path=output,
            artifact_path=output,
        )
    return output


def _observed(frame: DataFrame, name: str):
    from pyspark.sql import Observation

    counts = Observation(name)
    return frame.observe(counts, F.count(F.lit(1)).alias("rows")), counts
