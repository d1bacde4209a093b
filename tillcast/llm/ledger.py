"""Secret scans over an incremental ledger of blobs.

Every version of every path is addressed by the hash of its content. The ledger remembers which
blob was scanned under which version of the rules and what was found; a run scans only pairs it
doesn't know, appends their findings, and joins the ledger's findings back to all paths. Built
with DataFrame functions only.

Equal blobs are reduced to one before and after the shuffle (partial aggregation), so a text that a
third of all rows share moves once per input partition. The way back from findings to paths moves
hashes and spans, never texts, and its hot blobs are split like any skewed join.

Defined cases: a null text is the empty one; every row of the versions has a row in the result, also
repeated ones; an empty table gives an empty result. A run that is cut short appends nothing, or
what it has committed, and the next run scans the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm.common import BROADCAST_BYTES, hex_of, text_of
from tillcast.session import settled

# The kinds in order, their patterns, the group that must be long, and how long.
RULES = (
    (
        "assign",
        r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
        r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
        r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        8,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
)
KINDS = tuple(rule[0] for rule in RULES)
#: Changes with the rules, so that old blobs are scanned again.
RULE_VERSION = "1"
SPAN = "array<struct<start:int,rank:int,end:int>>"
LEDGER = f"blob string, rule_version string, spans {SPAN}"


def spans_of(text: Column, rank: int) -> Column:
    """Spans (start, rank, end) of one kind: what lies between matches gives their places.

    A text that has no long enough match, which is found by one cheap search, is not taken apart.
    """
    _, pattern, group, least = RULES[rank]
    if group:
        sought, at_all = pattern, pattern[:-2] + f"{{{least},}})"
    else:
        # The class repeats to the run's end, so a run is long enough or has no match at all.
        sought = at_all = pattern[:-1] + f"{{{least - len(pattern.split('[')[0])},}}"
    gaps = F.split(text, sought, -1)
    whole = F.regexp_extract_all(text, F.lit(sought), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(sought), F.lit(group))
    sizes = F.arrays_zip(
        F.transform(F.slice(gaps, F.lit(1), F.size(whole)), F.length).alias("gap"),
        F.transform(whole, F.length).alias("size"),
        F.transform(part, F.length).alias("part"),
    )
    none = F.array().cast(SPAN)
    placed = F.aggregate(
        sizes,
        F.struct(F.lit(0).alias("at"), none.alias("spans")),
        lambda state, m: F.struct(
            (state["at"] + m["gap"] + m["size"]).alias("at"),
            F.when(
                m["part"] >= least,
                F.concat(
                    state["spans"],
                    F.array(
                        F.struct(
                            (state["at"] + m["gap"]).alias("start"),
                            F.lit(rank).alias("rank"),
                            (state["at"] + m["gap"] + m["size"]).alias("end"),
                        )
                    ),
                ),
            )
            .otherwise(state["spans"])
            .alias("spans"),
        ),
        lambda state: state["spans"],
    )
    return F.when(F.regexp_like(text, F.lit(at_all)), placed).otherwise(none)


def all_spans(text: Column) -> Column:
    """All spans of all kinds, by start, then kind as listed."""
    return F.array_sort(F.concat(*[spans_of(text, rank) for rank in range(len(RULES))]))


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """The ledger, or None if nothing was ever written there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return None
    return spark.read.schema(LEDGER).parquet(path)


def scan(versions: DataFrame, ledger: str, text: str = "text") -> None:
    """Scan what the ledger at that path doesn't know and append it there."""
    blobs = versions.select(hex_of(text_of(text)).alias("blob"), text_of(text).alias("content"))
    blobs = blobs.groupBy("blob").agg(F.first("content").alias("content"))
    known = read_ledger(versions.sparkSession, ledger)
    if known is not None:
        known = known.where(F.col("rule_version") == RULE_VERSION).select("blob").distinct()
        blobs = blobs.join(known, "blob", "left_anti")
    found = blobs.select(
        "blob", F.lit(RULE_VERSION).alias("rule_version"), all_spans(F.col("content")).alias("spans")
    )
    found.write.mode("append").parquet(ledger)


def findings(versions: DataFrame, ledger: str, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns of every version as ``row`` and ``spans``, from a ledger that knows its blob.

    The findings are broadcast if they are counted to be few; else both sides are shuffled by blob.
    """
    known = read_ledger(versions.sparkSession, ledger)
    known = (
        known.where((F.col("rule_version") == RULE_VERSION) & (F.size("spans") > 0))
        .select("blob", "spans")
        .dropDuplicates(["blob"])
    )
    known = settled(known)
    size = known.agg(F.count("*"), F.sum(F.size("spans"))).first()
    if 200 * size[0] + 32 * (size[1] or 0) <= BROADCAST_BYTES:
        known = F.broadcast(known)
    paths = versions.select(F.struct(*keep).alias("row"), hex_of(text_of(text)).alias("blob"))
    spans = F.coalesce("spans", F.array().cast(SPAN))
    return paths.join(known, "blob", "left").select("row", spans.alias("spans"))


def written(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.element_at(kinds, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def counted(spans: Column, kind: str) -> Column:
    rank = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["rank"] == rank)).cast("long")


def redact(docs: DataFrame, ledger: str, text: str = "text") -> DataFrame:
    """The documents (same columns) with every secret masked; needs a ledger that knows them all."""
    found = findings(docs, ledger, docs.columns, text)
    clean = masked(F.col("row")[text], F.col("spans"))
    new = {text: clean}
    if "n_chars" in docs.columns:
        length = F.length(clean).cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.size("spans") > 0, length).otherwise(F.col("row")["n_chars"])
    return found.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def masked(text: Column, spans: Column, mask: str = "[secret]") -> Column:
    """The text with every span replaced; spans that overlap are replaced as one."""
    state = F.aggregate(
        spans,
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda s, x: F.when(
            x["start"] >= s["at"],
            F.struct(
                F.concat(s["out"], text.substr(s["at"] + 1, x["start"] - s["at"]), F.lit(mask)).alias("out"),
                x["end"].alias("at"),
            ),
        ).otherwise(F.struct(s["out"].alias("out"), F.greatest(s["at"], x["end"]).alias("at"))),
    )
    rest = text.substr(state["at"] + 1, F.length(text))
    return F.when(F.size(spans) > 0, F.concat(state["out"], rest)).otherwise(text)
