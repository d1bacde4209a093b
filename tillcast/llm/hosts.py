"""Quality rules judged host by host.

Every document is measured against the rules. Failures are added up by host, each host's rate is
shrunk towards the rate of all hosts with a beta prior fitted to the hosts themselves, and a host
whose shrunk rate of some rule passes the limit is rejected. The verdict goes back to the documents:
a document that fails a base rule goes, and so does one of a rejected host that fails any rule. A
document that passes every rule stays whatever its neighbours are like.

Defined cases: a null or empty text has no words and fails the length rule; documents without a
host form one host; repeated rows are measured one by one; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tillcast.llm.common import text_of, unused
from tillcast.session import settled

# Characters that count as symbols, and the words of a repetition window.
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
RULES = ("short", "repeats", "symbols", "lines")
MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


@dataclass(frozen=True)
class HostRules:
    """Limits: the first two are the base rules, in words and per cent of words."""

    least_words: int = 10
    most_repeated: int = 20
    most_symbols: int = 10  # per cent of the characters in words
    most_dup_lines: int = 20  # a hundred times, per word
    most_failing: float = 0.5  # shrunk rate of one rule beyond which a host is rejected


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words inside windows that occur twice or more in the text, first occurrences included."""
    windows = list(zip(*(words[i:] for i in range(size))))
    if len(set(windows)) == len(windows):
        return 0
    found = Counter(windows)
    covered = upto = 0
    for start, window in enumerate(windows):
        if found[window] > 1:
            covered += start + size - max(start, upto)
            upto = start + size
    return covered


def measured(text: str) -> tuple[int, int, int, int, int]:
    raw = text.encode()
    words = raw.split()  # bytes split at ASCII white space only
    blanks = len(raw) - sum(map(len, words))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text) - blanks,
        len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def measure_batch(texts: pd.Series) -> pd.DataFrame:
    names = [part.split()[0] for part in MEASURES.split(", ")]
    return pd.DataFrame([measured(text) for text in texts], columns=names, dtype="int64")


def failures(m: Column, rules: HostRules) -> dict[str, Column]:
    """By rule, whether a document with these measures fails it."""
    words = m["n_words"]
    return {
        "short": words < rules.least_words,
        "repeats": 100 * m["n_repeat_words"] > rules.most_repeated * words,
        "symbols": 100 * m["n_symbols"] > rules.most_symbols * m["word_chars"],
        "lines": 100 * m["n_dup_lines"] > rules.most_dup_lines * words,
    }


def host_verdicts(flags: DataFrame, rules: HostRules) -> DataFrame:
    """One row per host and whether it is rejected, from a boolean column for each rule.

    The prior's mean is the overall rate, its strength comes from the spread of the hosts' rates
    (method of moments, each host weighted by its rows), at least one and at most a million rows.
    Hosts are counted with partial sums, so one host with most rows is no burden.
    """
    hosts = settled(
        flags.groupBy("host").agg(
            F.count("*").alias("n"),
            *[F.sum(F.col(r).cast("long")).alias(r) for r in RULES],
        )
    )
    total = hosts.agg(F.sum("n").alias("n"), *[F.sum(r).alias(r) for r in RULES]).first()
    if not total["n"]:
        return hosts.select("host", F.lit(False).alias("rejected"))
    mean = {r: total[r] / total["n"] for r in RULES}
    spread = hosts.agg(
        *[F.sum(F.col("n") * F.pow(F.col(r) / F.col("n") - mean[r], 2)).alias(r) for r in RULES]
    ).first()

    def shrunk(r: str) -> Column:
        variance = spread[r] / total["n"]
        strength = mean[r] * (1 - mean[r]) / variance - 1 if variance > 0 else 1e6
        strength = min(max(strength, 1.0), 1e6)
        return (F.col(r) + mean[r] * strength) / (F.col("n") + strength)

    worst = F.greatest(*[shrunk(r) for r in RULES])
    return hosts.select("host", (worst > rules.most_failing).alias("rejected"))


def judge(
    docs: DataFrame,
    rules: HostRules = HostRules(),
    host: str = "source",
    text: str = "text",
    narrow: list[str] | None = None,
) -> tuple[DataFrame, str]:
    """All columns of ``docs`` and a struct with the measures, ``base_failed`` and ``kept``.

    Returned with the struct's name, which clashes with no column. If only the ``narrow`` columns
    are wanted back, they are stored with the measures, and each text is measured once; else it is
    measured for the hosts and again for the result, and no text is written.
    """
    name = unused(docs.columns, "quality")
    key = unused(docs.columns, "quality_host")
    measures = pandas_udf(measure_batch, MEASURES)
    rated = docs.withColumn(name, measures(text_of(text))).withColumn(
        key, F.coalesce(F.col(host).cast("string"), F.lit(""))
    )
    if narrow is not None:
        rated = settled(rated.select(*narrow, key, name))
    failed = failures(F.col(name), rules)
    flags = rated.select(F.col(key).alias("host"), *[c.alias(r) for r, c in failed.items()])
    bad = host_verdicts(flags, rules).where("rejected").select(F.col("host").alias(key))
    mark = unused(docs.columns, "quality_bad")
    joined = rated.join(bad.withColumn(mark, F.lit(True)), key, "left")
    base = failed["short"] | failed["repeats"]
    rejected = F.coalesce(F.col(mark), F.lit(False))
    any_failed = failed["short"]
    for r in RULES[1:]:
        any_failed = any_failed | failed[r]
    verdict = F.struct(
        F.col(f"{name}.*"),
        base.alias("base_failed"),
        rejected.alias("host_rejected"),
        (~base & ~(rejected & any_failed)).alias("kept"),
    )
    return joined.withColumn(name, verdict).drop(key, mark), name
