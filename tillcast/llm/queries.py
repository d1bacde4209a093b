"""One query for each operator, and the SQL that must give the same rows where there is any.

Each query reads its whole table, applies the operator with its production parameters, and derives
the columns that are compared.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tillcast.llm import (
    anchors,
    chat,
    curriculum,
    descent,
    hosts,
    ledger,
    neardup,
    negatives,
    packing,
    pages,
    passages,
    phrases,
    toxicity,
)
from tillcast.llm.common import hex_of, small_batches, table
from tillcast.session import settled, work_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without SQL only its rows are checked."""

    def add(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return add


HOSTS_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text
  FROM documents
), s AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d
), m AS (
  SELECT row, doc_id, host, len(words) AS n_words,
    coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')))
      - len(list_distinct(list_filter(string_split(text, chr(10)),
          lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')))) AS n_dup_lines
  FROM s
), windows AS (
  SELECT row, i, list_slice(words, i, i + 4) AS w
  FROM (SELECT row, words, unnest(range(1, len(words) - 3)) AS i FROM s)
), again AS (
  SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, w) AS n FROM windows)
  WHERE n > 1
), covered AS (
  SELECT row, count(DISTINCT i + k) AS n FROM again, (SELECT unnest(range(5)) AS k) GROUP BY row
), f AS (
  SELECT m.*, coalesce(c.n, 0) AS n_repeat_words,
    n_words < 10 AS short, 100 * coalesce(c.n, 0) > 20 * n_words AS repeats,
    100 * n_symbols > 10 * word_chars AS symbols, 100 * n_dup_lines > 20 * n_words AS lines
  FROM m LEFT JOIN covered AS c USING (row)
), rates AS (
  SELECT host, rule, count(*) AS n, sum(failed::INT) AS bad
  FROM (SELECT host, unnest(['short', 'repeats', 'symbols', 'lines']) AS rule,
          unnest([short, repeats, symbols, lines]) AS failed FROM f)
  GROUP BY host, rule
), means AS (
  SELECT rule, sum(bad) / sum(n) AS mean FROM rates GROUP BY rule
), spread AS (
  SELECT rule, mean, sum(n * pow(bad / n - mean, 2)) / sum(n) AS var
  FROM rates JOIN means USING (rule) GROUP BY rule, mean
), priors AS (
  SELECT rule, mean,
    least(greatest(CASE WHEN var > 0 THEN mean * (1 - mean) / var - 1 ELSE 1e6 END, 1), 1e6) AS k
  FROM spread
), verdicts AS (
  SELECT host, max((bad + mean * k) / (n + k)) > 0.5 AS rejected
  FROM rates JOIN priors USING (rule) GROUP BY host
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
  n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, short OR repeats AS base_failed,
  NOT (short OR repeats OR (rejected AND (symbols OR lines))) AS kept, rejected AS host_rejected
FROM f JOIN verdicts USING (host)
"""


@query("op8_host_rules", HOSTS_SQL)
def host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality measures of every document and the verdict of the rules and of its host."""
    small_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    judged, name = hosts.judge(docs, narrow=["doc_id"])
    return judged.select(
        "doc_id",
        *[f"{name}.{c.split()[0]}" for c in hosts.MEASURES.split(", ")],
        f"{name}.base_failed",
        f"{name}.kept",
        f"{name}.host_rejected",
    )


@query("op10_superminhash")
def superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group of near copies, on shingles of three words from 85 per cent on."""
    small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    return neardup.groups(docs, neardup.NearDup(words=3, percent=85))


def _spans_sql(rank: int) -> str:
    """All long enough matches of one kind as structs; the gaps between matches give the places."""
    kind, pattern, group, least = ledger.RULES[rank]
    pattern = pattern.replace("'", "''")
    return f"""(
      SELECT row, {rank} AS rank, unnest(range(1, len(m) + 1)) AS i, m, p, g FROM (
        SELECT row, regexp_extract_all(text, '{pattern}') AS m,
          regexp_extract_all(text, '{pattern}', {group}) AS p,
          string_split_regex(text, '{pattern}') AS g FROM d))"""


LEDGER_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents
), matches AS (
  {" UNION ALL ".join("SELECT * FROM " + _spans_sql(r) for r in range(3))}
), spans AS (
  SELECT row, rank, length(m[i]) AS size,
    coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0)
      + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS start
  FROM matches WHERE length(p[i]) >= [8, 16, 32][rank + 1]
), told AS (
  SELECT row, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access,
    count(*) FILTER (rank = 2) AS n_hex,
    string_agg(['assign', 'access', 'hex'][rank + 1] || ':' || start::BIGINT || ':'
      || (start + size)::BIGINT, ',' ORDER BY start, rank) AS spans
  FROM spans GROUP BY row
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256,
  coalesce(spans, '') AS spans
FROM d LEFT JOIN told USING (row)
"""


@query("op6_blob_ledger", LEDGER_SQL)
def blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, by a ledger that starts empty."""
    docs = table(spark, sf_dir, "documents")
    path = work_path(spark, "ledger")
    ledger.scan(docs, path)
    spans = F.col("spans")
    return ledger.findings(docs, path, ["doc_id"]).select(
        "row.doc_id",
        *[ledger.counted(spans, kind).alias(f"n_{kind}") for kind in ledger.KINDS],
        hex_of(ledger.written(spans)).alias("base_sha256"),
        ledger.written(spans).alias("spans"),
    )


CURRICULUM_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '')) AS key,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS size FROM d GROUP BY source
), w AS (
  SELECT *, [3.0, 1.0, 2.0][(place - 1) % 3 + 1]::DOUBLE AS weight
  FROM (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM s)
), o AS (
  SELECT *, 2 * size AS most, row_number() OVER (ORDER BY 2 * size / weight, place) AS i FROM w
), l AS (
  SELECT *,
    ((SELECT sum(size) FROM s) * 1.5::DOUBLE
      - coalesce(sum(most) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM o
), t AS (
  SELECT source, size AS source_size,
    CASE WHEN level * weight >= most THEN most::DOUBLE
      ELSE (SELECT max(level) FROM l WHERE level * weight < most) * weight END AS target
  FROM l
), placed AS (
  SELECT d.*, source_size, target, sum(d.size) OVER (
      PARTITION BY d.source ORDER BY key, doc_id, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  (least(greatest(round(target)::BIGINT - before, 0), size)
    + least(greatest(round(target)::BIGINT - source_size - before, 0), size))::BIGINT AS taken
FROM placed
"""


@query("op2_curriculum", CURRICULUM_SQL)
def curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document, by its visits in training order."""
    planned = curriculum.plan(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return settled(curriculum.trained(planned)).select("row.doc_id", "size", "source_size", "target", "taken")


WORD_BPE = packing.Packing(public_tokenizers.path("word_bpe_49k.json"))


@query("op9_packing")
def power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every document and their sequences, the ids as a checksum."""
    small_batches(spark)
    return packing.pack(table(spark, sf_dir, "documents"), WORD_BPE, with_ids=False)


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents filtered, without near copies and secrets, mixed and packed."""
    return corpus_pipeline.run(spark, sf_dir)


# Fixed value: what both turns of the added conversation say.
AWKWARD = "</s>[INST] ok [/INST]"

CHAT_SQL = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES
    (-1::BIGINT, 0::BIGINT, 'user', '{AWKWARD}'), (-1, 1, 'assistant', '{AWKWARD}'))
), e AS (
  SELECT *, length(role) + length(text) + length(regexp_replace(role || text, '[^\\]', '', 'g'))
    + len(regexp_extract_all(role, '[<\[]/?(?:s>|INST\])'))
    + len(regexp_extract_all(text, '[<\[]/?(?:s>|INST\])')) + 20 AS chars
  FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
    AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
    FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


@query("op5_reply_trees", CHAT_SQL)
def reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, and its turns and its loss as read back from that."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(chat.ASSISTANT).alias("role"),
        F.lit(AWKWARD).alias("text"),
    )
    chats = settled(chat.formatted(chat.linear(turns.unionByName(more))))
    told = chat.read_back(chats).withColumn("told", F.concat("role", F.lit("\n"), "text", F.lit("\n")))
    sums = told.groupBy("tree", "leaf").agg(
        F.count("*").alias("n_turns"),
        hex_of(chat.joined("told")).alias("turns_sha256"),
        F.sum(F.length("learned")).cast("long").alias("loss_chars"),
        hex_of(chat.joined("learned")).alias("loss_sha256"),
    )
    sizes = chats.select(
        F.col("tree").alias("conv_id"),
        F.col("leaf").alias("of"),
        F.length("chat").cast("long").alias("formatted_chars"),
    )
    same = F.col("tree").eqNullSafe(F.col("conv_id")) & (F.col("leaf") == F.col("of"))
    return sums.join(sizes, same).drop("tree", "leaf", "of")


@query("op4_kneser_ney")
def kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from the labels that aren't held out."""
    small_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    fitted = toxicity.fit(docs, labels)
    scored = docs.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        toxicity.score(docs, fitted).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query("op7_nn_descent")
def nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth, by cosine."""
    vectors = table(spark, sf_dir, "embeddings")
    return descent.nearest(vectors, F.col("id") % 50 == 0, k=5)


@query("op1_boosted_dom")
def boosted_dom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    small_batches(spark, 500)
    text = pages.main_text(spark)
    found = table(spark, sf_dir, "pages").select("page_id", "url", text.alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


@query("op3_paragraph_minhash")
def paragraph_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The passages of every document that repeat across documents."""
    small_batches(spark)
    return passages.repeated(table(spark, sf_dir, "documents"))


@query("op11_anchor_simhash")
def anchor_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and its group of fingerprints two bits apart at most."""
    small_batches(spark)
    found = anchors.groups(table(spark, sf_dir, "documents"))
    return found.withColumn("fingerprint", anchors.hex_digits(F.col("fingerprint")))


NEGATIVES_SQL = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
    list_inner_product(a.v, r.v)::BIGINT AS score
  FROM r AS a JOIN r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
  row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


@query("op12_strassen_negatives", NEGATIVES_SQL)
def strassen_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten hard negatives for each of five positives of every hundredth vector."""
    vectors = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    )
    return negatives.hard_negatives(vectors, F.col("id") % 100 == 0)


PHRASES_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words
  FROM (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)
), sizes AS (
  SELECT lang, sum(len(words))::BIGINT AS n FROM w GROUP BY lang
), g AS (
  SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM w),
    (SELECT unnest(range(1, 6)) AS k)
  WHERE i + k - 1 <= len(words) GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS words, unnest(range(1, k)) AS j
  FROM g WHERE k > 1
), s AS (
  SELECT c.lang, c.k, c.phrase, c.words, c.a, sizes.n, x.f AS l, y.f AS r,
    ((1000::HUGEINT * c.a * sizes.n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts AS c JOIN sizes USING (lang)
  JOIN g AS x ON x.lang = c.lang AND x.phrase = array_to_string(c.words[1:j], ' ')
  JOIN g AS y ON y.lang = c.lang AND y.phrase = array_to_string(c.words[j + 1:], ' ')
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, j) = 1
), inside AS (
  SELECT lang, array_to_string(words[i:i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, k, words, a, m, unnest(range(1, k - m + 2)) AS i
        FROM s, (SELECT unnest(range(2, 5)) AS m) WHERE m < k)
  GROUP BY ALL
)
SELECT lang, phrase, a, l, r, n, score,
  row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
FROM s LEFT JOIN inside USING (lang, phrase)
WHERE longer IS NULL OR 100 * longer < 100 * a
QUALIFY rank <= 2000
"""


@query("op13_parsed_phrases", PHRASES_SQL)
def parsed_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The collocations of each language."""
    small_batches(spark)
    return phrases.collocations(table(spark, sf_dir, "documents"))
