"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight schedule over the training time t in [0, 1]: its share of the mix times
1 + ramp (2 t - 1), so its integral is its target whatever the ramp. Heavier sources fall and lighter
ones rise. The words demanded of a source up to t are target (t + ramp (t^2 - t)); a document whose
middle lies at c words of its source's order is due when that demand reaches c, which is a quadratic
equation. Sorting all documents by their due time gives the training order.

A source's order is by hash of the id. A target beyond the source's size goes through the source again,
so a document is taken at most twice, and the last one is cut to end at the target exactly.

Only ids and sizes are shuffled. Running sums within a source are sums of buckets of the hash first
and sums within a bucket second, so a source with most rows is spread over as many tasks as any.

Defined cases: documents without a source form the last source; a null text has no words; a
document without words is taken zero times and has no position; a source without words has target 0;
repeated rows are rows of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.common import WORD, small_enough, text_of
from tillcast.operators.ranking import dense_index
from tillcast.session import settled


@dataclass(frozen=True)
class Mix:
    """Weights of the sources in order, repeating; the mix as a part of all words; most repeats."""

    weights: tuple[int, ...] = (3, 1, 2)
    volume: float = 1.5
    repeats: int = 2
    ramp: float = 0.5  # of the heaviest source downwards, of the lightest upwards
    bucket_rows: int = 20_000


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """(source, size) to (source, size, target, weight): shares by weight, filled up to the limits.

    The sources that reach ``repeats`` times their size are those with the least size for their
    weight, so the level of the rest follows from running sums in that order. The windows see one
    row per source.
    """
    n = len(mix.weights)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(w)) for w in mix.weights])
    ranked = sizes.withColumn("place", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(weights, (F.col("place") % n + 1).cast("int"))
    )
    limit = mix.repeats * F.col("size")
    order = Window.orderBy(limit / F.col("weight"), "place")
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("size").over(everything) * mix.volume
    left = total - F.coalesce(F.sum(limit).over(before), F.lit(0))
    heavy = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    levels = ranked.withColumn("level", left / heavy).withColumn(
        "full", F.col("level") * F.col("weight") >= limit
    )
    # Full sources come first; the first other one has the level of all others, the highest left.
    level = F.max(F.when(~F.col("full"), F.col("level"))).over(everything)
    return levels.select(
        "source",
        F.col("size").alias("source_size"),
        "weight",
        F.when(F.col("full"), limit.cast("double"))
        .otherwise(level * F.col("weight"))
        .alias("target"),
    )


def due(fraction: Column, ramp: Column) -> Column:
    """The time t at which t + ramp (t^2 - t) reaches the fraction."""
    b = 1 - ramp
    return 2 * fraction / (b + F.sqrt(b * b + 4 * ramp * fraction))


def taken_parts(
    docs: DataFrame, mix: Mix, keep: list[str], id: str, text: str, source: str
) -> DataFrame:
    """Every row with its source's target and the words before it in its source's order.

    Columns: row (the kept ones), source, key (hash of the id), size, source_size, target, weight,
    before. Unless the text is kept, the rows are stored, so that words are counted once.
    """
    key = F.md5(F.coalesce(F.col(id).cast("string"), F.lit("")).cast("binary"))
    rows = docs.select(
        F.struct(*keep).alias("row"),
        F.col(id).alias("id"),
        F.col(source).cast("string").alias("source"),
        word_count(text_of(text)).alias("size"),
        key.alias("key"),
    )
    if text in keep:
        narrow = settled(rows.select("source", "size", "key"))
    else:
        narrow = rows = settled(rows)
    sources = settled(
        narrow.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    )
    targets = source_targets(sources.select("source", "size"), mix)
    most = sources.agg(F.max("n")).first()[0] or 0
    digits = 1  # a bucket is the beginning of the hash
    while 16**digits * mix.bucket_rows < most:
        digits += 1
    bucket = F.substring("key", 1, digits)
    in_source = Window.partitionBy("source").orderBy("bucket")
    starts = (
        narrow.groupBy("source", bucket.alias("bucket"))
        .agg(F.sum("size").alias("words"))
        .withColumn("start", F.sum("words").over(in_source) - F.col("words"))
        .join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
        .select("of", F.col("bucket").alias("in"), "start", "source_size", "target", "weight")
    )
    starts = small_enough(settled(starts), 256)
    placed = rows.withColumn("bucket", bucket).join(
        starts, F.col("source").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("in"))
    )
    inside = Window.partitionBy("source", "bucket").orderBy("key", "id", "size")
    inside = inside.rowsBetween(Window.unboundedPreceding, 0)
    before = F.col("start") + F.sum("size").over(inside) - F.col("size")
    return placed.withColumn("before", before).drop("of", "in", "bucket", "start", "id")


def passes(mix: Mix) -> Column:
    """By pass through the source, the words taken of the document."""
    goal = F.round("target").cast("long")
    return F.array(
        *[
            F.least(
                F.greatest(goal - F.col("source_size") * p - F.col("before"), F.lit(0)),
                F.col("size"),
            )
            for p in range(mix.repeats)
        ]
    )


def plan(
    docs: DataFrame,
    keep: list[str],
    mix: Mix = Mix(),
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """What the mix takes of every row.

    Columns: row (the kept ones), key, size, source_size, target, taken (words, repeats counted),
    and visits: for each pass that takes words of it the training time in [0, 1] and the words.
    """
    parts = taken_parts(docs, mix, keep, id, text, source)
    heaviest, lightest = max(mix.weights), min(mix.weights)
    scale = 2 * mix.ramp / max(heaviest - lightest, 1)
    ramp = (F.lit((heaviest + lightest) / 2) - F.col("weight")) * scale
    words = F.col("words")

    def visit(w: Column, p: Column) -> Column:
        demand = (F.col("source_size") * p + F.col("before") + w / 2) / F.col("target")
        return F.struct(
            F.when(w > 0, due(demand, ramp)).alias("time"), w.cast("long").alias("words")
        )

    return parts.withColumn("words", passes(mix)).select(
        "row",
        "key",
        "size",
        "source_size",
        "target",
        F.aggregate(words, F.lit(0).cast("long"), lambda a, w: a + w).alias("taken"),
        F.filter(F.transform(words, visit), lambda v: v["words"] > 0).alias("visits"),
    )


def trained(planned: DataFrame) -> DataFrame:
    """The plan with its visits inverted to training positions: sorted by time, and back to the rows.

    ``positions`` holds the place of each visit in the training order, counted from 0; ``taken`` adds up
    the words of the visits that were placed.
    """
    rows = settled(planned.drop("taken").withColumn("of", F.monotonically_increasing_id()))
    visits = rows.select("of", "key", "size", F.posexplode("visits").alias("pass", "visit"))
    visits = visits.select("of", "key", "size", "pass", "visit.time", "visit.words")
    order = ["time", "key", "size", "of", "pass"]
    placed = dense_index(visits, order, "position", 0, one_task_rows=-1)
    of_row = placed.groupBy(F.col("of").alias("row_of")).agg(
        F.sum("words").alias("words"),
        F.array_sort(F.collect_list("position")).alias("positions"),
    )
    joined = rows.join(of_row, F.col("of") == F.col("row_of"), "left")
    return joined.select(
        "row",
        "key",
        "size",
        "source_size",
        "target",
        F.coalesce("words", F.lit(0).cast("long")).alias("taken"),
        "visits",
        F.coalesce("positions", F.array().cast("array<long>")).alias("positions"),
    )


def first_words(text: Column, n: Column, size: Column) -> Column:
    """The text up to the end of its n-th word; the whole text if that is all its words."""
    parts = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])", -1)
    return F.when(n >= size, text).otherwise(F.array_join(F.slice(parts, F.lit(1), n.cast("int")), ""))


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix itself: documents (same columns) in training order, repeated and cut as planned."""
    visits = plan(docs, docs.columns, mix).select(
        "row", "key", "size", F.inline("visits")
    )
    cut = F.col("words") < F.col("size")
    new = {"text": first_words(F.col("row.text"), F.col("words"), F.col("size"))}
    if "n_chars" in docs.columns:
        length = F.length(new["text"]).cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(cut, length).otherwise(F.col("row.n_chars"))
    columns = [new.get(c, F.col("row")[c]).alias(c) for c in docs.columns]
    return visits.orderBy("time", "key", "size").select(*columns)
