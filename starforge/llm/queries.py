"""Registered queries of the corpus operators and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .classifier import score_quality
from .common import WORD
from .exact_dedup import exact_duplicates
from .host_rules import apply_host_rules
from .language_model import score_language_model
from .lexical_search import ranked_search
from .line_dedup import drop_common_lines
from .mixing import mix_sources, word_count
from .near_dup import near_duplicates
from .packing import pack_documents
from .periodic_runs import periodic_runs
from .piece_count import count_pieces
from .pivot_search import exact_top_k
from .secret_scan import scan_secrets

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_lm_score(spark, folder):
    return score_language_model(table(spark, folder, "documents"))


@query
def op2_line_dedup(spark, folder):
    out = drop_common_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE["op2_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, line, pos,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
        FROM documents)),
common AS (SELECT key FROM lines WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM lines LEFT JOIN common c ON lines.key = c.key
GROUP BY doc_id
"""


@query
def op3_best_fit_packing(spark, folder):
    return pack_documents(table(spark, folder, "documents"), near_copies=True)


@query
def op4_host_rules(spark, folder):
    out = apply_host_rules(table(spark, folder, "documents"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "host_rejected",
    )


@query
def op5_piece_counts(spark, folder):
    return count_pieces(table(spark, folder, "documents"))


@query
def op6_quality_classifier(spark, folder):
    return score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op7_pivot_search(spark, folder):
    return exact_top_k(table(spark, folder, "embeddings"))


ORACLE["op7_pivot_search"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) IS NOT FALSE),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.vec, c.vec)::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id
  WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
WHERE rank <= 5
"""


@query
def op8_secret_scan(spark, folder):
    out = scan_secrets(table(spark, folder, "documents"))
    return out.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_random"
    )


@query
def op9_fair_mixing(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source", word_count().alias("n"))
    out = mix_sources(docs, size=F.col("n"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


@query
def op10_near_duplicates(spark, folder):
    return near_duplicates(table(spark, folder, "documents"))


@query
def op11_exact_dedup(spark, folder):
    return exact_duplicates(table(spark, folder, "documents"))


ORACLE["op11_exact_dedup"] = r"""
WITH c AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER copies AS keep_id, count(*) OVER (PARTITION BY content) AS group_size,
       row_number() OVER copies = 1 AS kept, sha256(content) AS text_sha256
FROM c
WINDOW copies AS (PARTITION BY content ORDER BY chars DESC, doc_id NULLS LAST)
"""


def with_periods(docs: DataFrame) -> DataFrame:
    """``doc_id, text``; where the crc32 of the id ends in 0, the words from some
    place on repeat a stretch, as the contract of op12 states."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when((h % 10 == 0) & F.col("text").isNotNull(), F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)))
    g, n = F.floor(h / 10), F.size("words")
    told = docs.select("doc_id", "text", words.alias("words"), g.alias("g"))
    placed = told.select("*", F.when(n > 0, (F.col("g") % n).cast("int")).alias("a"))
    rest = n - F.col("a")
    unit = F.slice("words", F.col("a") + 1, (1 + F.floor(rest / (3 + F.col("g") % 8))).cast("int"))
    units = placed.select("*", unit.alias("unit"))
    times = F.ceil(rest / F.size("unit")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat("unit", times)), F.lit(1), rest)
    whole = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return units.select("doc_id", F.when(F.col("a").isNotNull(), whole).otherwise(F.col("text")).alias("text"))


@query
def op12_periodic_runs(spark, folder):
    found = periodic_runs(with_periods(table(spark, folder, "documents").select("doc_id", "text")))
    # The first of the runs, which are in order, with the greatest length a period.
    best = F.reduce(
        F.slice("runs", F.lit(2), F.greatest(F.size("runs") - 1, F.lit(0))),
        F.get("runs", F.lit(0)),
        lambda b, r: F.when(r.length * b.period > b.length * r.period, r).otherwise(b),
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    digest = F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), digest.alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256",
    )


@query
def op13_ranked_search(spark, folder):
    return ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


ORACLE["op13_ranked_search"] = r"""
WITH occurrences AS (
  SELECT doc_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
postings AS (SELECT doc_id, term, count(*) AS tf FROM occurrences GROUP BY doc_id, term),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM postings GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths),
norms AS (SELECT doc_id, 25 + (75 * n * docs) // terms AS m FROM lengths, totals),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), totals),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN norms USING (doc_id)
  GROUP BY item_id, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
"""
