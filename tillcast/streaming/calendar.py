"""Which day of the stream belongs to which batch: stored, and only ever added to.

The initial and the validation period end where pretraining found them to end; that is on record in
the metric history and never moves. Every later day is a stream day. When days are due they are dealt
in order to batches of ``stream_batch_days``, and what was dealt stays so, whatever lands afterwards:
a batch that is run again has the same days. A day that lands after later days were dealt goes to the
next batch. So every stream day is in exactly one batch.

A batch may be short when nothing more has landed. A caller that closes takes it as it is, and the
days that land later begin a batch of their own; one that waits leaves it until it is full.

Tables have one row per day and micro-batch, or per day; years 1 to 9999 hold 3.7 million days at most.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from tillcast.functions.columns import iso_day
from tillcast.models.registry import PRETRAIN_BATCH
from tillcast.operators.periods import PERIODS, Split, distinct_days
from tillcast.params import JobParams
from tillcast.plans.jobs import Workspace
from tillcast.session import settled

EPOCH = "_epoch"
LANDED = f"{EPOCH} long, day date"
DEALT = "batch_id long, day date"


class StreamCalendar:
    def __init__(self, workspace: Workspace, params: JobParams):
        self.workspace = workspace
        self.params = params
        self._landed = workspace.table("landed_days", EPOCH)
        self._dealt = workspace.table("stream_calendar")

    def land(self, rows: DataFrame, epoch: int) -> None:
        """Note the days of a micro-batch; noting one again replaces what it noted."""
        days = distinct_days(rows, self.params).coalesce(1)
        self._landed.write(days.withColumn(EPOCH, F.lit(epoch).cast("long")))

    def days(self) -> DataFrame:
        """The days that have landed."""
        return self._landed.read(LANDED).select("day").distinct()

    def dealt(self) -> DataFrame:
        """(batch_id, day) of every day that has a batch."""
        return self._dealt.read(DEALT)

    def split(self) -> Split:
        """The periods: the first two as pretraining left them, the stream as it has landed."""
        known = self.workspace.metrics.part(PRETRAIN_BATCH).first()
        fields = {
            f"{period}_date_{part}": known[f"{period}_date_{part}"]
            for period in PERIODS[:2]
            for part in ("min", "max", "count")
        }
        day = F.col("day")
        stream = self.days().where(self._in_stream(fields)).agg(
            F.coalesce(iso_day(F.min(day)), F.lit("")).alias("stream_date_min"),
            F.coalesce(iso_day(F.max(day)), F.lit("")).alias("stream_date_max"),
            F.count(day).alias("stream_date_count"),
        )
        return Split({**fields, **stream.first().asDict()})

    @staticmethod
    def _in_stream(fields: dict) -> Column:
        return F.col("day") > F.lit(date.fromisoformat(fields["validation_date_max"]))

    def plan(self, split: Split, first: int, count: int | None, closing: bool) -> None:
        """Deal open days to batches until ``count`` batches from ``first`` on have days.

        Without a count all open days are dealt; a short last batch only when closing.
        """
        dealt = settled(self.dealt())
        last = dealt.agg(F.max("batch_id")).first()[0]
        following = first if last is None else max(first, last + 1)
        if count is not None and following >= first + count:
            return
        size = self.params.model.stream_batch_days
        days = self.days().where(self._in_stream(split.fields)).join(dealt, "day", "left_anti")
        place = F.row_number().over(Window.orderBy("day")) - 1
        batch = (F.floor(place / F.lit(size)) + following).cast("long")
        batches = days.select("day", batch.alias("batch_id"))
        if count is not None:
            batches = batches.where(F.col("batch_id") < first + count)
        if not closing:
            full = F.count("day").over(Window.partitionBy("batch_id")) == size
            batches = batches.withColumn("full", full).where("full").drop("full")
        self._dealt.write(settled(batches).repartition(1))

    def batches(self, first: int, count: int | None = None) -> list[Row]:
        """The batches from ``first`` on that have days, one row each."""
        wanted = self.dealt().where(F.col("batch_id") >= first)
        if count is not None:
            wanted = wanted.where(F.col("batch_id") < first + count)
        found = wanted.groupBy("batch_id").agg(
            F.min("day").alias("day_min"),
            F.max("day").alias("day_max"),
            F.count("day").alias("date_count"),
        )
        return found.orderBy("batch_id").collect()

    def days_of(self, batch_id: int) -> DataFrame:
        return self.dealt().where(F.col("batch_id") == batch_id).select("day")

    def known(self, split: Split, batch_id: int) -> tuple[date, DataFrame]:
        """The last day of all batches up to this one, and stream days before it that aren't theirs.

        These days wait for a later batch, so no model may have seen them by then.
        """
        done = self.dealt().where(F.col("batch_id") <= batch_id)
        until = done.agg(F.max("day")).first()[0]
        waiting = self.days().where(self._in_stream(split.fields) & (F.col("day") <= F.lit(until)))
        return until, waiting.join(done, "day", "left_anti")
