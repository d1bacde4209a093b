"""Exact quantiles of columns of any size, by narrowing to the sought ranks.

The source is read once: its columns are stored as doubles, and every later pass reads these. A
sketch brackets each sought rank, one counting pass proves the bracket, and the values inside the
brackets are stored anew for the next round, until few enough rows are left to be counted by value and
sorted in one task. Values that repeat a lot are settled by the counts, and so at once are columns of few
values.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillcast.session import settled

DIRECT_ROWS = 2_000_000
SKETCH_ACCURACY = 10_000
#: Columns that seem to have no more values are counted by value, whatever their rows.
FEW_VALUES = 10_000


@dataclass
class _Search:
    """The value at ``rank`` lies strictly between ``low`` and ``high``."""

    column: str
    rank: int
    inside: int
    below: int = 0
    low: float | None = None
    high: float | None = None
    answer: float | None = None

    def window(self) -> Column:
        value = F.col(self.column)
        if self.low is not None:
            value = F.when(F.col(self.column) > F.lit(self.low), value)
        if self.high is not None:
            value = F.when(F.col(self.column) < F.lit(self.high), value)
        return value

    def place(self) -> float:
        """Where the rank lies inside the window, as a share."""
        return (self.rank - self.below + 0.5) / self.inside


@dataclass(frozen=True)
class Projection:
    """The columns of a frame as doubles, stored by number, one row for each of the frame's."""

    rows: DataFrame
    place: dict[str, str]

    @classmethod
    def of(cls, frame: DataFrame, columns: Mapping[str, Column]) -> Projection:
        place = {name: f"c{i}" for i, name in enumerate(columns)}
        made = [value.cast("double").alias(place[name]) for name, value in columns.items()]
        return cls(settled(frame.select(*made)), place)

    def __getitem__(self, name: str) -> Column:
        return F.col(self.place[name])


def exact_quantiles(
    frame: DataFrame | Projection,
    columns: Mapping[str, Column],
    shares: Sequence[float],
    direct_rows: int = DIRECT_ROWS,
    accuracy: int = SKETCH_ACCURACY,
    counts: Mapping[str, int] | None = None,
) -> dict[str, tuple[int, list[float] | None]]:
    """Count of values and linearly interpolated quantiles of each column, nulls left out.

    ``counts`` saves the counting pass if they are known; a projection that holds the columns saves
    storing them.
    """
    names = list(columns)
    if not names:
        return {}
    held = frame if isinstance(frame, Projection) else Projection.of(frame, columns)
    base, short = held.rows, held.place
    if counts is None:
        counted = base.agg(*[F.count(short[name]).alias(short[name]) for name in names]).first()
        counts = {name: counted[short[name]] for name in names}

    searches: dict[tuple[str, int], _Search] = {}
    for name in names:
        for share in shares if counts[name] else ():
            for rank in _ranks(counts[name], share):
                search = _Search(short[name], rank, inside=counts[name])
                searches.setdefault((name, rank), search)
    values = dict(
        zip(searches, select_ranks(base, list(searches.values()), direct_rows, accuracy))
    )

    def quantile(name: str, share: float) -> float:
        low, high = (values[(name, rank)] for rank in _ranks(counts[name], share))
        position = (counts[name] - 1) * share
        return low + (position - math.floor(position)) * (high - low)

    return {
        name: (counts[name], [quantile(name, s) for s in shares] if counts[name] else None)
        for name in names
    }


def _ranks(count: int, share: float) -> tuple[int, int]:
    """The places in sorted order between which a quantile lies."""
    position = (count - 1) * share
    return math.floor(position), math.ceil(position)


def select_ranks(base: DataFrame, searches: list[_Search], direct_rows: int, accuracy: int):
    margin = 2.0 / accuracy
    few = min(FEW_VALUES, direct_rows)
    _settle(base, _with_few_values(base, [s for s in searches if s.inside > direct_rows], few))
    while True:
        wide = [s for s in searches if s.answer is None and s.inside > direct_rows]
        if not wide:
            break
        # Ranks that are sought in one window share its sketch.
        windows: dict[tuple, list[int]] = {}
        for i, s in enumerate(wide):
            windows.setdefault((s.column, s.low, s.high), []).append(i)
        guesses = base.agg(
            *[
                F.percentile_approx(
                    wide[members[0]].window(),
                    [
                        share
                        for i in members
                        for share in (
                            max(0.0, wide[i].place() - margin),
                            min(1.0, wide[i].place() + margin),
                        )
                    ],
                    accuracy,
                ).alias(f"g{members[0]}")
                for members in windows.values()
            ]
        ).first()
        brackets = [(None, None)] * len(wide)
        for members in windows.values():
            found = guesses[f"g{members[0]}"]
            for n, i in enumerate(members):
                brackets[i] = (found[2 * n], found[2 * n + 1])
        tallies = base.agg(
            *[
                F.count_if(test).alias(f"t{i}_{label}")
                for i, (s, (low, high)) in enumerate(zip(wide, brackets))
                for label, test in (
                    ("lt_low", s.window() < F.lit(low)),
                    ("le_low", s.window() <= F.lit(low)),
                    ("lt_high", s.window() < F.lit(high)),
                    ("le_high", s.window() <= F.lit(high)),
                )
            ]
        ).first()
        for i, (s, (low, high)) in enumerate(zip(wide, brackets)):
            labels = ("lt_low", "le_low", "lt_high", "le_high")
            _narrow(s, low, high, *[s.below + tallies[f"t{i}_{label}"] for label in labels])
        base = _inside(base, [s for s in searches if s.answer is None])
    _settle(base, [s for s in searches if s.answer is None])
    return [s.answer for s in searches]


def _with_few_values(base: DataFrame, searches: list[_Search], few: int) -> list[_Search]:
    """Those in columns of few values; an estimate is enough, as it only chooses the way."""
    columns = sorted({s.column for s in searches})
    if not columns:
        return []
    found = base.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
    return [s for s in searches if found[s.column] <= few]


def _inside(base: DataFrame, searches: list[_Search]) -> DataFrame:
    """The values in the windows that are still searched, stored; nothing else is read again."""
    windows: dict[str, list[Column]] = {}
    for s in searches:
        windows.setdefault(s.column, []).append(s.window().isNotNull())
    if not windows:
        return base
    kept = [F.when(reduce(or_, tests), F.col(c)).alias(c) for c, tests in windows.items()]
    return settled(base.select(*kept).where(reduce(or_, [F.col(c).isNotNull() for c in windows])))


def _settle(base: DataFrame, searches: list[_Search]) -> None:
    """Find the remaining ranks among the few rows of their windows.

    Equal values are counted before the shuffle; a running sum then tells which value covers
    which ranks.
    """
    if not searches:
        return
    windows: dict[tuple, list[_Search]] = {}
    for s in searches:
        windows.setdefault((s.column, s.low, s.high), []).append(s)
    groups = list(windows.values())
    values = F.array(*[group[0].window() for group in groups])
    sought = [F.array(*[F.lit(s.rank - s.below).cast("long") for s in g]) for g in groups]
    upto = F.sum("rows").over(
        Window.partitionBy("group").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    )
    found = (
        base.select(F.posexplode(values).alias("group", "value"))
        .where("value is not null")
        .groupBy("group", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("upto", upto)
        .withColumn("sought", F.array(*sought)[F.col("group")])
        .select(
            "group",
            "value",
            F.filter(
                "sought",
                lambda rank: (rank < F.col("upto")) & (rank >= F.col("upto") - F.col("rows")),
            ).alias("ranks"),
        )
        .where(F.size("ranks") > 0)
    )
    # At most one row per rank.
    for row in found.collect():
        for s in groups[row["group"]]:
            if s.rank - s.below in row["ranks"]:
                s.answer = row["value"]


def _narrow(s: _Search, low, high, lt_low: int, le_low: int, lt_high: int, le_high: int) -> None:
    """Move the window onto the part of it that holds the rank."""
    end = s.below + s.inside
    if lt_low <= s.rank < le_low:
        s.answer = low
    elif lt_high <= s.rank < le_high:
        s.answer = high
    elif s.rank < lt_low:
        s.high, s.inside = low, lt_low - s.below
    elif s.rank < lt_high:
        s.low, s.high, s.below, s.inside = low, high, le_low, lt_high - le_low
    else:
        s.low, s.below, s.inside = high, le_high, end - le_high
