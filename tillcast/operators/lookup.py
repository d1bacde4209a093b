"""Many-to-one lookups that stay even when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tillcast.functions.columns import quoted
from tillcast.params import DimensionParams

BROADCAST_BYTES = 64 * 1024 * 1024
HOT_SHARE = 0.001
SALTS = 64


def lookup_profile(lookup: DataFrame, key: str) -> tuple[int, int, int]:
    """Rows, rows of the most repeated key and measured bytes of a lookup table, in one pass."""
    width = sum(
        (
            F.coalesce(F.octet_length(quoted(f.name)), F.lit(0))
            if isinstance(f.dataType, (T.StringType, T.BinaryType))
            else F.lit(16)
            for f in lookup.schema.fields
        ),
        F.lit(0),
    )
    found = (
        lookup.groupBy(quoted(key).alias("key"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(width.cast("long")).alias("bytes"))
        .agg(F.sum("n"), F.max("n"), F.sum("bytes"))
        .first()
    )
    return found[0] or 0, found[1] or 0, found[2] or 0


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    lookup_bytes: int,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left join on a key that is unique in ``lookup``.

    A lookup measured below the limit is broadcast. A larger one is shuffled, with the hot
    fact keys spread over salts and their few lookup rows repeated once per salt.
    """
    if lookup_bytes <= broadcast_bytes:
        return facts.join(F.broadcast(lookup), key, "left")
    return salted_lookup_join(facts, lookup, key)


def salted_lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    hot_share: float = HOT_SHARE,
    salts: int = SALTS,
) -> DataFrame:
    total = facts.count()
    # At most 1 / hot_share keys can reach this share, whatever the data.
    hot = (
        facts.groupBy(key)
        .count()
        .where(F.col("count") >= max(1.0, total * hot_share))
        .where(quoted(key).isNotNull())
        .select(key, F.lit(True).alias("_hot"))
    )
    # From the row itself: a task that is run again must send its rows the same way.
    hashed = [f.name for f in facts.schema.fields if not _holds_map(f.dataType)]
    salt = F.pmod(F.xxhash64(*map(quoted, hashed)), F.lit(salts)).cast("int")
    # Keyless rows find nothing, they only have to be spread.
    spread = facts.join(F.broadcast(hot), key, "left").withColumn(
        "_salt", F.when(F.col("_hot") | quoted(key).isNull(), salt).otherwise(F.lit(0))
    )
    repeated = lookup.join(F.broadcast(hot), key, "left").withColumn(
        "_salt",
        F.explode(
            F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
                F.array(F.lit(0))
            )
        ),
    )
    return spread.drop("_hot").join(repeated.drop("_hot"), [key, "_salt"], "left").drop("_salt")


def narrow_lookup(
    facts: DataFrame,
    values: Mapping[str, Column],
    table: DataFrame,
    fields: Sequence[str],
    hot: Column,
) -> DataFrame:
    """Look up several columns in one join: the facts plus a struct of ``fields`` for each of ``values``.

    ``table`` has column, value and the fields, each value of a column once. Every fact row becomes
    one narrow row per column, and only the first of them carries the row itself. Values of the
    ``hot`` rows of the table, of which there must be few, are found by broadcast; the rest meet the
    table in one shuffle, over which rows that are done already are spread. A second shuffle puts the
    rows together again by the hash of their content: equal rows find the same and are counted, so
    nothing depends on the order in which a lost task's rows come back. No job runs before the result
    is asked for.
    """
    names = list(values)
    at = F.create_map(*[F.lit(x) for i, name in enumerate(names) for x in (name, i)])
    known = table.where(F.col("column").isin(names)).select(
        at[F.col("column")].alias("_at"),
        F.col("value").alias("_value"),
        F.struct(*fields).alias("_fields"),
        F.coalesce(hot, F.lit(False)).alias("_is_hot"),
    )
    often = known.where("_is_hot").select("_at", "_value", F.col("_fields").alias("_often"))
    seldom = known.where("not _is_hot").select(
        "_at", F.col("_value").alias("_key"), F.col("_fields").alias("_seldom")
    )
    hashed = [
        F.to_json(F.struct(quoted(f.name))) if _holds_map(f.dataType) else quoted(f.name)
        for f in facts.schema.fields
    ]
    narrow = facts.select(
        F.struct("*").alias("_row"),
        F.xxhash64(*hashed).alias("_h"),
        # A second chain of hashes from another start.
        F.xxhash64(F.lit("row"), *hashed).alias("_g"),
        F.posexplode(F.array(*values.values())).alias("_at", "_value"),
    ).withColumn("_row", F.when(F.col("_at") == 0, F.col("_row")))
    done = F.col("_often").isNotNull()
    spread = F.concat(F.lit("\0"), F.hex("_h"))
    met = (
        narrow.join(F.broadcast(often), ["_at", "_value"], "left")
        .withColumn("_key", F.when(done, spread).otherwise(F.col("_value")))
        .join(seldom, ["_at", "_key"], "left")
        .withColumn("_found", F.when(done, F.col("_often")).otherwise(F.col("_seldom")))
    )
    if len(names) == 1:
        return met.select("_row.*", F.col("_found").alias(names[0]))
    rows = met.groupBy("_h", "_g").agg(
        F.first("_row", ignorenulls=True).alias("_row"),
        F.count_if(F.col("_at") == 0).alias("_copies"),
        *[F.max(F.when(F.col("_at") == i, F.col("_found"))).alias(n) for i, n in enumerate(names)],
    )
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))
    return rows.select(copies, "_row.*", *map(quoted, names)).drop("col")


def _holds_map(kind: T.DataType) -> bool:
    """Whether a map, which has no hash, lies anywhere in the type."""
    if isinstance(kind, T.MapType):
        return True
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    return isinstance(kind, T.StructType) and any(_holds_map(f.dataType) for f in kind.fields)


def enrich(
    facts: DataFrame,
    dimension: DataFrame | None,
    params: DimensionParams,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left join the store dimension, many to one; a fact without its store is an error.

    Skipped when there is no dimension, no key in the facts, or the facts are enriched already.
    The missing-store check is a filter on the joined rows: it costs no pass of its own and holds
    whichever columns are read.
    """
    if params.key not in facts.columns or params.check_column in facts.columns:
        return facts
    if dimension is None:
        return facts
    if params.key not in dimension.columns:
        raise ValueError(f"dimension key is missing: {params.key}")
    rows, repeats, size = lookup_profile(dimension, params.key)
    if repeats > 1:
        raise ValueError(f"dimension key is not unique: {params.key}")
    key_type = facts.schema[params.key].dataType
    dimension = dimension.withColumn(params.key, quoted(params.key).cast(key_type))
    joined = lookup_join(facts, dimension, params.key, size, broadcast_bytes)
    check = quoted(params.check_column)
    missing = F.raise_error(
        F.concat(
            F.lit(f"no {params.check_column} for {params.key} "),
            F.coalesce(quoted(params.key).cast("string"), F.lit("null")),
        )
    )
    joined = joined.where(F.when(check.isNotNull(), F.lit(True)).otherwise(missing.cast("boolean")))
    added = [name for name in dimension.columns if name != params.key]
    return joined.select(*map(quoted, [*facts.columns, *added]))


def unmatched_rows(facts: DataFrame, dimension: DataFrame, params: DimensionParams) -> int:
    """Fact rows without a usable dimension row, counted per key before the lookup."""
    usable = dimension.where(quoted(params.check_column).isNotNull()).select(params.key)
    per_key = facts.groupBy(params.key).count()
    missing = per_key.join(usable, params.key, "left_anti").agg(F.sum("count")).first()[0]
    return int(missing or 0)
