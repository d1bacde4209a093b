"""From cleaned rows to feature columns and from those to a feature vector.

Feature columns are added under a prefix, so the row keeps its own columns and nothing has to
be joined back after scoring.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillcast.functions.columns import calendar_parts, moment, number, quoted, text
from tillcast.operators.clean import require_column
from tillcast.operators.lookup import BROADCAST_BYTES, HOT_SHARE, narrow_lookup
from tillcast.operators.quantiles import DIRECT_ROWS, Projection, exact_quantiles
from tillcast.operators.ranking import ONE_TASK_ROWS, dense_index
from tillcast.params import JobParams
from tillcast.session import settled
from tillcast.sources.tables import records

PREPROCESSING_VERSION = "median_scale_code_frequency_1"
PREFIX = "x__"
MISSING = "__MISSING__"
UNSEEN_CODE = -1.0
UNSEEN_FREQUENCY = 0.0
LABEL = "label"
FEATURES = "features"
ROW_ORDER = "_row_order"


def excluded_columns(params: JobParams) -> set[str]:
    return {
        params.target_column,
        *params.leakage_columns,
        *params.roles.ids,
        *params.roles.service,
    }


def feature_names(
    columns: Iterable[str], params: JobParams
) -> tuple[list[str], list[str]]:
    """Numeric and categorical feature names a table offers."""
    columns, out = set(columns), excluded_columns(params)
    numeric = [c for c in params.roles.numeric if c in columns and c not in out]
    categorical = [c for c in params.roles.categorical if c in columns and c not in out]
    if params.time_column in columns:
        parts = ("year", "month", "quarter", "day", "weekofyear")
        numeric += [f"{params.time_column}_{part}" for part in parts]
    return numeric, categorical


def feature_columns(frame: DataFrame, params: JobParams) -> list[Column]:
    """Numbers as doubles, categories as strings, five calendar numbers."""
    out = excluded_columns(params)
    made = [
        number(frame, c).alias(c)
        for c in params.roles.numeric
        if c in frame.columns and c not in out
    ]
    made += [
        text(c).alias(c)
        for c in params.roles.categorical
        if c in frame.columns and c not in out
    ]
    if params.time_column in frame.columns:
        made += calendar_parts(moment(frame, params.time_column), params.time_column)
    return made


def build_features(frame: DataFrame, params: JobParams, keep: Sequence[str] = ()) -> DataFrame:
    """The feature projection alone, beside any columns to keep."""
    return frame.select(*map(quoted, keep), *feature_columns(frame, params))


def with_features(frame: DataFrame, params: JobParams) -> DataFrame:
    """The rows with their feature columns added under the prefix."""
    numeric, categorical = feature_names(frame.columns, params)
    struct = frame.select("*", F.struct(*feature_columns(frame, params)).alias("_made"))
    return struct.select(
        *map(quoted, frame.columns),
        *[
            F.col("_made").getField(c).alias(PREFIX + c)
            for c in (*numeric, *categorical)
        ],
    )


def labelled(frame: DataFrame, params: JobParams) -> DataFrame:
    """Rows with a numeric target, the target beside them as the label."""
    name = params.target_column
    require_column(frame, name, "target")
    return frame.withColumn(LABEL, number(frame, name)).where(F.col(LABEL).isNotNull())


class _Columns(Params):
    columns = Param(Params._dummy(), "columns", "input columns", TypeConverters.toListString)

    def names(self) -> list[str]:
        return self.getOrDefault(self.columns)


class NumericStatistics(NamedTuple):
    """What imputing and scaling need of one column."""

    median: float
    mean: float
    deviation: float


def numeric_statistics(
    frame: DataFrame, columns: Sequence[str], direct_rows: int = DIRECT_ROWS
) -> dict[str, NumericStatistics]:
    """Exact median, and mean and population deviation after nulls have become the median.

    A column without any value is left out; one without spread is divided by one. The moments
    with the median filled in follow from those without, so they cost no second pass.
    """
    if not columns:
        return {}
    held = Projection.of(frame, {c: quoted(c) for c in columns})
    found = held.rows.agg(
        F.count(F.lit(1)).alias("n"),
        *[
            F.struct(
                F.count(held[c]).alias("count"),
                F.avg(held[c]).alias("mean"),
                F.var_pop(held[c]).alias("variance"),
            ).alias(f"s{i}")
            for i, c in enumerate(columns)
        ],
    ).first()
    known = {c: found[f"s{i}"] for i, c in enumerate(columns) if found[f"s{i}"]["count"]}
    medians = exact_quantiles(
        held,
        {c: held[c] for c in known},
        (0.5,),
        direct_rows,
        counts={c: k["count"] for c, k in known.items()},
    )
    made = {}
    for c, k in known.items():
        median, present, total = medians[c][1][0], k["count"], found["n"]
        mean = (present * k["mean"] + (total - present) * median) / total
        squares = present * (k["variance"] + (k["mean"] - mean) ** 2)
        squares += (total - present) * (median - mean) ** 2
        deviation = math.sqrt(max(squares, 0.0) / total)
        # A constant column can show a spread of a few rounding errors.
        flat = deviation <= abs(mean) * 1e-14
        made[c] = NumericStatistics(median, mean, 1.0 if flat else deviation)
    return made


class MedianScaler(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Nulls become the median, then mean zero and population deviation one."""

    @keyword_only
    def __init__(self, *, columns=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "MedianScalerModel":
        return MedianScalerModel.of(numeric_statistics(dataset, self.names()))


class MedianScalerModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    medians = Param(Params._dummy(), "medians", "medians", TypeConverters.toListFloat)
    means = Param(Params._dummy(), "means", "means", TypeConverters.toListFloat)
    deviations = Param(Params._dummy(), "deviations", "deviations", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, columns=None, medians=None, means=None, deviations=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @classmethod
    def of(cls, statistics: dict[str, NumericStatistics]) -> "MedianScalerModel":
        values = list(statistics.values())
        return cls(
            columns=list(statistics),
            medians=[v.median for v in values],
            means=[v.mean for v in values],
            deviations=[v.deviation for v in values],
        )

    def statistics(self) -> dict[str, NumericStatistics]:
        lists = (self.getOrDefault(p) for p in (self.medians, self.means, self.deviations))
        return {c: NumericStatistics(*v) for c, *v in zip(self.names(), *lists)}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        scaled = {
            c: (F.coalesce(quoted(c), F.lit(s.median)) - F.lit(s.mean)) / F.lit(s.deviation)
            for c, s in self.statistics().items()
        }
        return dataset.withColumns(scaled) if scaled else dataset


def category_table(
    frame: DataFrame,
    columns: Sequence[str],
    order: Column | None,
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """Code by first appearance and relative frequency of each value of each column.

    All columns go through one pre-aggregated shuffle. Null is a category of its own. Values
    that first appear together are told apart by the value.
    """
    at = order if order is not None else F.lit(0).cast("decimal(38,0)")
    long = frame.select(
        at.alias("_at"),
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        F.coalesce(quoted(c).cast("string"), F.lit(MISSING)).alias("value"),
                    )
                    for c in columns
                ]
            )
        ).alias("pair"),
    )
    counted = settled(
        long.groupBy("pair.column", "pair.value").agg(
            F.min("_at").alias("first_at"), F.count(F.lit(1)).alias("rows")
        )
    )
    sizes = {
        r["column"]: (r["categories"], r["total"])
        for r in counted.groupBy("column")
        .agg(F.count(F.lit(1)).alias("categories"), F.sum("rows").alias("total"))
        .collect()
    }
    numbered = None
    small = [c for c, (n, _) in sizes.items() if n <= one_task_rows]
    if small:
        in_column = Window.partitionBy("column").orderBy("first_at", "value")
        numbered = counted.where(F.col("column").isin(small)).withColumn(
            "code", (F.row_number().over(in_column) - 1).cast("long")
        )
    for column, (n, _) in sizes.items():
        if n > one_task_rows:
            part = counted.where(F.col("column") == column)
            part = dense_index(part, ["first_at", "value"], "code", n, one_task_rows)
            part = part.select("column", "value", "first_at", "rows", "code")
            numbered = part if numbered is None else numbered.unionByName(part)
    if numbered is None:
        schema = "column string, value string, code double, frequency double"
        return records(frame.sparkSession, [], schema)
    totals = F.create_map(*[F.lit(x) for c, (_, t) in sizes.items() for x in (c, t)])
    return numbered.select(
        "column",
        "value",
        F.col("code").cast("double").alias("code"),
        (F.col("rows") / totals[F.col("column")]).alias("frequency"),
    )


class FrequencyEncoder(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Replaces each category by its code and adds its frequency as ``<column>_frequency``."""

    orderColumn = Param(
        Params._dummy(), "orderColumn", "column that orders rows", TypeConverters.toString
    )

    broadcastBytes = Param(
        Params._dummy(), "broadcastBytes", "bytes of tables that are broadcast", TypeConverters.toInt
    )

    @keyword_only
    def __init__(self, *, columns=None, orderColumn=ROW_ORDER, broadcastBytes=BROADCAST_BYTES):
        super().__init__()
        self._setDefault(orderColumn=ROW_ORDER, broadcastBytes=BROADCAST_BYTES)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "FrequencyModel":
        name = self.getOrDefault(self.orderColumn)
        order = quoted(name) if name in dataset.columns else None
        table = category_table(dataset, self.names(), order)
        made = FrequencyModel(
            columns=self.names(), broadcastBytes=self.getOrDefault(self.broadcastBytes)
        )
        return made.holding(settled(table)).measured()


class FrequencyModel(Model, _Columns, MLWritable, MLReadable):
    """Category tables of all columns, with the bytes of each as measured when it was fitted.

    Tables that fit together are broadcast, smallest first; the columns beyond that share one join.
    """

    sizes = Param(Params._dummy(), "sizes", "bytes of each table", TypeConverters.toListFloat)
    broadcastBytes = FrequencyEncoder.broadcastBytes

    @keyword_only
    def __init__(self, *, columns=None, broadcastBytes=BROADCAST_BYTES):
        super().__init__()
        self._setDefault(broadcastBytes=BROADCAST_BYTES)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        self.table: DataFrame | None = None

    def holding(self, table: DataFrame) -> "FrequencyModel":
        self.table = table
        return self

    def measured(self) -> "FrequencyModel":
        sized = self.table.groupBy("column").agg(
            F.sum(F.octet_length("value") + 32).alias("bytes")
        )
        found = {r["column"]: r["bytes"] for r in sized.collect()}
        return self._set(sizes=[float(found.get(c, 0)) for c in self.names()])

    def copy(self, extra=None) -> "FrequencyModel":
        made = super().copy(extra)
        made.table = self.table
        return made

    def output_names(self) -> list[str]:
        return [name for c in self.names() for name in (c, f"{c}_frequency")]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        given = dataset.columns
        values = {c: F.coalesce(quoted(c).cast("string"), F.lit(MISSING)) for c in self.names()}
        room, large = self.getOrDefault(self.broadcastBytes), []
        answers = {c: f"_found_{i}" for i, c in enumerate(values)}
        for c, size in sorted(zip(values, self.getOrDefault(self.sizes)), key=lambda s: s[1]):
            room -= size
            if room < 0:
                large.append(c)
                continue
            lookup = self.table.where(F.col("column") == c).select(
                F.col("value").alias("_value"), F.struct("code", "frequency").alias(answers[c])
            )
            keyed = dataset.withColumn("_value", values[c])
            dataset = keyed.join(F.broadcast(lookup), "_value", "left").drop("_value")
        if large:
            named = F.create_map(*[F.lit(x) for c in large for x in (c, answers[c])])
            table = self.table.where(F.col("column").isin(large)).withColumn(
                "column", named[F.col("column")]
            )
            # At most 1 / HOT_SHARE values of a column can be that frequent.
            hot = F.col("frequency") >= HOT_SHARE
            sought = {answers[c]: values[c] for c in large}
            dataset = narrow_lookup(dataset, sought, table, ["code", "frequency"], hot)
        coded = {}
        for c, found in answers.items():
            coded[c] = F.coalesce(F.col(f"{found}.code"), F.lit(UNSEEN_CODE))
            coded[f"{c}_frequency"] = F.coalesce(
                F.col(f"{found}.frequency"), F.lit(UNSEEN_FREQUENCY)
            )
        kept = [coded.pop(c).alias(c) if c in coded else quoted(c) for c in given]
        return dataset.select(*kept, *[value.alias(name) for name, value in coded.items()])

    def write(self) -> MLWriter:
        return _FrequencyWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _FrequencyReader()


class _FrequencyWriter(MLWriter):
    def __init__(self, instance: FrequencyModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.table.write.mode("overwrite").parquet(f"{path}/categories")


class _FrequencyReader(MLReader):
    def load(self, path: str) -> FrequencyModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = FrequencyModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.holding(self.sparkSession.read.parquet(f"{path}/categories"))
        # A model stored before tables were measured at their fitting is measured now.
        return model if model.isSet(model.sizes) else model.measured()


class FeaturePreprocessor(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Median, scale, encode, assemble: numbers first, then code and frequency per category."""

    numeric = Param(Params._dummy(), "numeric", "numeric columns", TypeConverters.toListString)
    categorical = Param(
        Params._dummy(), "categorical", "categorical columns", TypeConverters.toListString
    )

    @keyword_only
    def __init__(self, *, numeric=None, categorical=None):
        super().__init__()
        self._set(**self._input_kwargs)

    @classmethod
    def for_table(cls, columns: Iterable[str], params: JobParams) -> "FeaturePreprocessor":
        numeric, categorical = feature_names(columns, params)
        return cls(
            numeric=[PREFIX + c for c in numeric], categorical=[PREFIX + c for c in categorical]
        )

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        numeric = self.getOrDefault(self.numeric)
        categorical = self.getOrDefault(self.categorical)
        stages: list[Transformer] = []
        outputs: list[str] = []
        if numeric:
            scaler = MedianScaler(columns=numeric).fit(dataset)
            stages.append(scaler)
            outputs += scaler.names()
        if categorical:
            encoder = FrequencyEncoder(columns=categorical).fit(dataset)
            stages.append(encoder)
            outputs += encoder.output_names()
        stages.append(VectorAssembler(inputCols=outputs, outputCol=FEATURES))
        return PipelineModel(stages)


def vector_names(stages: Sequence[Transformer]) -> list[str]:
    """The feature behind each element of the vector these stages assemble."""
    assembler = next(s for s in stages if isinstance(s, VectorAssembler))
    return [c.removeprefix(PREFIX) for c in assembler.getInputCols()]
