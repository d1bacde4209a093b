"""Replaying the stream period: each batch is scored first, then learnt from.

Fact rows arrive as a stream, such as the files of a folder. Each micro-batch of it is stored under
its number, so one that is given again replaces itself, and the checkpoint only says which rows have
landed. Which batch a row belongs to follows from its own day by the stored calendar: files may come
in any order, together or one by one, day by day, and a row that comes late is part of all refits
after it. A batch is a pruned scan of the landed rows by its days, of any size. All tables are keyed
by batch, which makes a repeated batch harmless; the batch metadata is written last and is what makes
a batch count as done, and the next batch is the one after the last that counts.

There are two ways to run it, on one checkpoint. ``update`` takes in what waits and processes what is
due, batch by batch. ``start`` is a streaming query that scores and learns inside its own
micro-batches for as long as it runs. Either may follow the other, and a stop in the middle of a batch
costs that batch only.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructType

from tillcast.models.protocol import supports_incremental_update
from tillcast.operators.clean import clean_training
from tillcast.operators.history import append_metrics
from tillcast.operators.periods import (
    Split,
    known_rows,
    rolling_rows,
    rows_between,
    rows_for_days,
    without_days,
    window_metadata,
)
from tillcast.operators.quality import batch_metadata, distinct_sketches, quality_report
from tillcast.params import JobParams
from tillcast.plans.fitting import EstimatorFor, fit_model, predict, score, training_rows
from tillcast.plans.jobs import Workspace, metric_rows, pretrain, write_diagnostics
from tillcast.sources.tables import KeyedTable
from tillcast.streaming.calendar import EPOCH, StreamCalendar
from tillcast.streaming.progress import ProgressLog


def as_they_are(rows: DataFrame) -> DataFrame:
    return rows


@dataclass
class Replay:
    """The stream of one project.

    ``incoming`` gives the streaming frame of raw fact rows and ``prepare`` joins what they need.
    ``before_commit`` is called with each batch just before it counts. ``first_days`` is how many
    days a running stream waits for before it pretrains; without it, only ``update`` pretrains.
    ``progress`` puts the stream's micro-batches on record.
    """

    incoming: Callable[[], DataFrame]
    params: JobParams
    workspace: Workspace
    make: EstimatorFor | None = None
    before_commit: Callable[[int], None] | None = None
    prepare: Callable[[DataFrame], DataFrame] = as_they_are
    first_days: int | None = None
    progress: ProgressLog | None = None
    _split: Split | None = field(default=None, init=False)
    _schema: StructType | None = field(default=None, init=False)
    _loaded: tuple[str, PipelineModel] | None = field(default=None, init=False)

    @property
    def landed(self) -> KeyedTable:
        return self.workspace.table("landed", EPOCH)

    @property
    def calendar(self) -> StreamCalendar:
        return StreamCalendar(self.workspace, self.params)

    def source(self) -> DataFrame:
        """All rows that have landed by now."""
        if self._schema is None:
            self._schema = self.incoming().schema
        schema = StructType([*self._schema.fields]).add(EPOCH, LongType())
        return self.prepare(self.landed.read(schema).drop(EPOCH))

    def cursor(self) -> int:
        """The next batch to commit."""
        last = self.workspace.committed().agg(F.max("batch_id")).first()[0]
        return 0 if last is None else last + 1

    def _store(self, rows: DataFrame, epoch: int) -> None:
        self.landed.write(rows.withColumn(EPOCH, F.lit(epoch).cast("long")))
        # The days are read from what was stored, of which only the time column is read.
        schema = StructType([*rows.schema.fields]).add(EPOCH, LongType())
        stored = self.landed.read(schema).where(F.col(EPOCH) == epoch).drop(EPOCH)
        self.calendar.land(stored, epoch)

    def _stream(self, step: Callable[[DataFrame, int], None], trigger: dict) -> StreamingQuery:
        query = (
            self.incoming()
            .writeStream.option("checkpointLocation", self.workspace.path("checkpoint"))
            .trigger(**trigger)
            .foreachBatch(step)
            .start()
        )
        return self.progress.watch(query, "stream") if self.progress else query

    def land(self) -> None:
        """Take in all rows that wait in the stream."""
        query = self._stream(self._store, {"availableNow": True})
        query.awaitTermination()
        if self.progress:
            self.progress.flush(query)

    def start(self, **trigger) -> StreamingQuery:
        """A query that lands, scores and learns in its micro-batches; a trigger as Spark names it.

        Each one processes the batches that are full by then; a short last batch waits for more days
        or for an ``update``. A batch that fails ends the query, and the micro-batch is given again
        when it starts anew.
        """

        def step(rows: DataFrame, epoch: int) -> None:
            self._store(rows, epoch)
            if self._ready():
                for batch in self.due(closing=False):
                    self.process(batch)

        return self._stream(step, trigger or {"processingTime": "10 seconds"})

    def _ready(self) -> bool:
        """Whether there is a model that fits; a running stream may have to wait for its first days."""
        if self._current() is None:
            if self.first_days is None:
                raise ValueError("no current model; pretrain, or say after how many days to")
            if self.calendar.days().count() < self.first_days:
                return False
            pretrain(self.source(), self.params, self.workspace, self.make)
        return True

    def _current(self) -> Row | None:
        registry = self.workspace.registry(self.params)
        current = registry.current()
        problem = registry.mismatch(current) if current is not None else None
        if problem:
            raise ValueError(f"current model does not fit: {problem}; train again")
        return current

    def due(self, count: int | None = None, closing: bool = True) -> list[Row]:
        """The next batches by the days that have landed, one row each."""
        calendar, first = self.calendar, self.cursor()
        self._split = calendar.split()
        calendar.plan(self._split, first, count, closing)
        return calendar.batches(first, count)

    def update(self, count: int | None = None, closing: bool = True) -> int:
        """Process up to ``count`` batches, all that there are if not given.

        Pretrains first if there is no model; a model that does not fit is an error. Returns the
        number of batches processed, zero at the end of the stream. A short last batch is processed
        as it is, unless ``closing`` is off.
        """
        workspace = self.workspace
        current = self._current()
        self.land()
        if current is None:
            pretrain(self.source(), self.params, workspace, self.make)
        batches = self.due(count, closing)
        if not batches:
            with workspace.operations.record("update", model_name=self.params.model.selected):
                return 0
        for batch in batches:
            self.process(batch)
        return len(batches)

    def process(self, notice: Row) -> None:
        batch_id, cursor = notice["batch_id"], self.cursor()
        if batch_id < cursor:
            return
        if batch_id > cursor:
            raise ValueError(f"batch {batch_id} is out of order, {cursor} is next")
        workspace, params = self.workspace, self.params
        name = params.model.selected
        with workspace.operations.record("update", f"batch-{batch_id}", model_name=name) as record:
            source, calendar = self.source(), self.calendar
            split = self._split or calendar.split()
            rows = rows_between(source, params, notice["day_min"], notice["day_max"])
            rows = rows_for_days(rows, params, calendar.days_of(batch_id))
            key = F.lit(batch_id).cast("long")
            workspace.raw.write(rows.withColumn("batch_id", key))
            record["artifact_path"] = workspace.raw.path
            raw = workspace.raw.part(batch_id)

            def profile() -> None:
                context = {"batch_id": key, "period_type": F.lit("stream")}
                workspace.quality.write(quality_report(raw, params, context).coalesce(1))
                sketches = distinct_sketches(raw, params.roles.categorical)
                workspace.sketches.write(sketches.withColumn("batch_id", key).coalesce(1))

            def clean() -> None:
                workspace.processed.write(clean_training(raw, params).withColumn("batch_id", key))

            _together(workspace.spark, profile, clean)
            batch = workspace.processed.part(batch_id)
            until, waiting = calendar.known(split, batch_id)
            if not waiting.isEmpty():
                source = without_days(source, params, waiting)
            path = self._test_then_train(batch, notice, source, until)
            size = batch.count()
            record.update(input_rows=size, output_rows=size, model_path=path)
            if self.before_commit is not None:
                self.before_commit(batch_id)
            self._commit(raw, notice, split)

    def _test_then_train(
        self, batch: DataFrame, notice: Row, source: DataFrame, until: date
    ) -> str:
        """Score with the current model, then refit; the metrics are those of the old model."""
        workspace, params = self.workspace, self.params
        registry = workspace.registry(params)
        version = _before(registry, notice["batch_id"])
        if self._loaded is not None and self._loaded[0] == version["model_path"]:
            model = self._loaded[1]
        else:
            model = registry.load(version, "current")
        batch_id, name = notice["batch_id"], params.model.selected

        def test() -> dict[str, object]:
            predictions = predict(model, batch, params, keep=[params.time_column]).persist()
            scored = score(predictions)
            write_diagnostics(workspace, model, predictions, params, batch_id, name)
            predictions.unpersist()
            return scored

        def train() -> tuple[PipelineModel, Row]:
            return updated_model(model, batch, source, until, params, self.make)

        scored, (updated, window) = _together(workspace.spark, test, train)
        row = {
            "model_name": name,
            "batch_id": batch_id,
            "period_type": "stream",
            "date_min": notice["day_min"].isoformat(),
            "date_max": notice["day_max"].isoformat(),
            "date_count": notice["date_count"],
            **scored,
            "prediction_model_path": version["model_path"],
            "update_strategy": params.model.update_strategy,
            "training_mode": params.model.training_mode,
            "initial_training": False,
        }
        row.update(
            train_rows=window["rows"],
            training_rows_total=window["rows"],
            train_window_date_min=window["date_min"],
            train_window_date_max=window["date_max"],
        )
        path = registry.register(updated, batch_id, name, row)
        self._loaded = (path, updated)
        row.update(updated_model_path=path, model_path=path)
        rows = metric_rows(workspace.spark, [row])
        workspace.metrics.write(append_metrics(None, rows, params.model.primary_metric))
        return path

    def _commit(self, raw: DataFrame, notice: Row, split: Split) -> None:
        """Write the batch metadata; from here on the batch is done."""
        made = batch_metadata(raw, self.params).withColumns(
            {
                "batch_id": F.lit(notice["batch_id"]).cast("long"),
                "period_type": F.lit("stream"),
                "date_min": F.lit(notice["day_min"].isoformat()),
                "date_max": F.lit(notice["day_max"].isoformat()),
                "date_count": F.lit(notice["date_count"]).cast("long"),
                **{name: F.lit(value) for name, value in split.fields.items()},
            }
        )
        typed = [F.col(f.name).cast(f.dataType) for f in self.workspace.committed().schema]
        self.workspace.batches.write(made.select(*typed).coalesce(1))


def _together(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """Run steps that do not need each other at the same time; small jobs fill few cores."""
    with ThreadPoolExecutor(len(steps)) as pool:
        waiting = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
        return [step.result() for step in waiting]


def _before(registry, batch_id: int) -> Row | None:
    """The version current when this batch arrives, also if the batch is being repeated."""
    return (
        registry.versions()
        .where(F.col("batch_id") < batch_id)
        .orderBy(F.desc("batch_id"))
        .limit(1)
        .first()
    )


def updated_model(
    model: PipelineModel,
    batch: DataFrame,
    source: DataFrame,
    until: date,
    params: JobParams,
    make: EstimatorFor | None = None,
) -> tuple[PipelineModel, Row]:
    """The model after a batch, and the rows and days it was trained on.

    Full refits use all rows up to the batch's last day, rolling refits the last N days. An
    incremental update keeps the preprocessor and moves on with the batch alone.
    """
    strategy, name = params.model.update_strategy, params.model.selected
    if strategy == "incremental":
        *earlier, estimator = model.stages
        if name != "sgd_regression" or not supports_incremental_update(estimator):
            raise ValueError(f"{name} cannot be updated incrementally")
        vectors = PipelineModel(earlier).transform(training_rows(batch, params))
        updated = PipelineModel([*earlier, estimator.updated(vectors)])
        return updated, window_metadata(batch, params).first()
    choose = known_rows if strategy == "full_refit" else rolling_rows
    # The day range comes first, so that it reaches the scan.
    training = clean_training(choose(source, params, until), params)
    return fit_model(training, params, name, make), window_metadata(training, params).first()
