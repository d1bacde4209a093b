"""Fitting and applying models on cleaned rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F, types as T

from tillcast.functions.columns import moment, not_below_zero, quoted
from tillcast.models.factory import estimator_for
from tillcast.operators.features import (
    FEATURES,
    LABEL,
    ROW_ORDER,
    FeaturePreprocessor,
    labelled,
    with_features,
)
from tillcast.operators.metrics import regression_metrics, with_p_value
from tillcast.operators.ranking import row_order
from tillcast.params import JobParams

MIN_TRAINING_ROWS = 10

EstimatorFor = Callable[[str], Estimator]


def estimators(params: JobParams) -> EstimatorFor:
    return lambda name: estimator_for(params.model, name)


def training_rows(frame: DataFrame, params: JobParams) -> DataFrame:
    """Labelled rows with feature columns and their load order."""
    at = moment(frame, params.time_column)
    whole = (T.LongType, T.IntegerType)
    ids = [c for c in params.roles.ids if c in frame.columns]
    key = None
    if ids:
        kind = frame.schema[ids[0]].dataType
        key = quoted(ids[0]) if isinstance(kind, whole) else quoted(ids[0]).try_cast("long")
        key = F.when(key >= 0, key).otherwise(F.lit(0))
    made = with_features(labelled(frame, params), params)
    return made.withColumn(ROW_ORDER, row_order(at, key))


def require_rows(frame: DataFrame, least: int, purpose: str) -> None:
    found = len(frame.limit(least).collect()) if least <= MIN_TRAINING_ROWS else frame.count()
    if found < least:
        raise ValueError(f"not enough rows for {purpose}: {found}, need {least}")


def fit_preprocessor(frame: DataFrame, params: JobParams) -> PipelineModel:
    return FeaturePreprocessor.for_table(frame.columns, params).fit(frame)


def fit_model(
    frame: DataFrame, params: JobParams, name: str, make: EstimatorFor | None = None
) -> PipelineModel:
    """Preprocessor and estimator as one model, from cleaned rows."""
    rows = training_rows(frame, params)
    require_rows(rows.select(LABEL), MIN_TRAINING_ROWS, "training")
    preprocessor = fit_preprocessor(rows, params)
    with held_vectors(preprocessor, rows, params.model.training_partitions) as vectors:
        return fit_on_vectors(preprocessor, vectors, params, name, make)


@contextmanager
def held_vectors(
    preprocessor: PipelineModel, rows: DataFrame, partitions: int
) -> Iterator[DataFrame]:
    """Feature vectors and labels, kept while models that read them many times are fitted.

    Rows are dealt by their own hash to a fixed number of partitions and ordered there, as trees
    draw their samples partition by partition: the model is the same on any cluster.
    """
    made = preprocessor.transform(rows).select(FEATURES, LABEL)
    hashed = F.xxhash64(vector_to_array(FEATURES), LABEL)
    made = (
        made.withColumn("_hash", hashed)
        .repartition(partitions, "_hash")
        .sortWithinPartitions("_hash", LABEL)
        .drop("_hash")
        .persist()
    )
    try:
        yield made
    finally:
        made.unpersist()


def fit_on_vectors(
    preprocessor: PipelineModel,
    vectors: DataFrame,
    params: JobParams,
    name: str,
    make: EstimatorFor | None = None,
) -> PipelineModel:
    estimator = (make or estimators(params))(name)
    return PipelineModel([*preprocessor.stages, estimator.fit(vectors)])


def predict(
    model: PipelineModel, frame: DataFrame, params: JobParams, keep: Sequence[str] = ()
) -> DataFrame:
    """Kept columns, ``actual`` and the clipped ``prediction`` of every labelled row."""
    rows = model.transform(with_features(labelled(frame, params), params))
    return rows.select(
        *map(quoted, keep),
        F.col(LABEL).alias("actual"),
        not_below_zero(F.col("prediction")).alias("prediction"),
    )


def score(predictions: DataFrame, with_range: bool = False) -> dict[str, object]:
    """Metrics of a frame of predictions, the Pearson p-value included."""
    row = regression_metrics(predictions, with_range=with_range, with_pearson=True).first()
    return with_p_value(row.asDict())
