"""Quality rules with host verdicts.

Every document is measured in one pass. Failures of the rules are counted by
host, each host's failure rate is shrunk towards the corpus by an empirical
beta prior, and the verdict on the host is joined back to its documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialise
from .common import SPACE, map_lists, prepare, raw

SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_upper long"


@dataclass(frozen=True)
class Rules:
    """Limits per document. A hard limit drops a document anywhere; a soft one
    is a failure that counts against the host and drops documents of rejected
    hosts only. Shares are of words, those of capitals (A-Z) of the words' code
    points; ``dup_lines`` counts lines, mean word length is in code points."""

    min_words: int = 50
    max_repeat_percent: int = 50
    soft_repeat_percent: int = 30
    soft_symbols: float = 0.1
    hard_symbols: float = 0.5
    soft_dup_lines: int = 2
    soft_upper: float = 0.2
    hard_upper: float = 0.5
    word_length: tuple[float, float] = (2.0, 14.0)
    host_factor: float = 1.3
    host_deviations: float = 2.0


def measure(text: bytes) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_upper of a text."""
    words = text.split()
    n = len(words)
    dense = text.translate(None, SPACE)
    chars = len(dense.decode("utf-8", "replace"))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    seen, dup = set(), 0
    for line in text.split(b"\n"):
        if line in seen:
            dup += 1
        elif line.strip():
            seen.add(line)
    upper = len(text) - len(text.translate(None, UPPER))
    return n, chars, symbols, dup, repeated_words(words), upper


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words inside windows of ``width`` words that occur at least twice."""
    n = len(words)
    if n <= width:
        return 0
    ids = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    key = np.zeros(n - width + 1, np.uint64)
    for i in range(width):
        key = (key ^ ids[i : n - width + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    order = np.argsort(key)
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    hit = np.zeros(len(key), bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for i in range(width):
        covered[i : n - width + 1 + i] |= hit
    return int(covered.sum())


def measure_documents(docs: DataFrame, host: Column) -> DataFrame:
    """One row per document: doc_id, host and the measures of its whole text."""

    def make():
        def step(ids, hosts, texts):
            return [ids, hosts, *map(list, zip(*map(measure, texts)))]

        return step

    kinds = dict(docs.dtypes)
    return map_lists(
        docs.select("doc_id", host.alias("host"), raw("text").alias("text")),
        make,
        f"doc_id {kinds['doc_id']}, host string, {MEASURES}",
    )


def host_verdicts(failures: DataFrame, factor: float, deviations: float) -> DataFrame:
    """``host, n, failed`` to ``host, n, failed, prior, rate, deviation, rejected``.

    The prior is the beta distribution of the hosts' own rates by the method of
    moments, each host counting once, so that one with most of the rows does not
    set the measure for itself: strength = mean (1 - mean) / variance - 1, at
    least 1; where the hosts do not differ it is 10 000. ``prior`` is its mean;
    ``rate`` and ``deviation`` are those of the host's posterior, so a host of few
    documents has a rate near the prior and a wide deviation. A host is rejected
    if ``rate - deviations * deviation > factor * prior``.
    """
    rate = F.col("failed") / F.col("n")
    # The driver holds two numbers: the prior.
    mean, variance = failures.agg(F.avg(rate), F.var_samp(rate)).first()
    mean = mean or 0.0
    strength = min(1e4, max(1.0, mean * (1 - mean) / variance - 1)) if variance else 1e4
    weight = F.col("n") + strength
    posterior = (F.col("failed") + mean * strength) / weight
    out = failures.select("host", "n", "failed", F.lit(mean).alias("prior"), posterior.alias("rate"))
    out = out.withColumn("deviation", F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n") + strength + 1)))
    return out.withColumn("rejected", F.col("rate") - deviations * F.col("deviation") > factor * F.col("prior"))


def apply_host_rules(docs: DataFrame, host: str = "source", rules: Rules = Rules()) -> DataFrame:
    """``doc_id``, measures, failures and verdicts for every row of ``docs``.

    Null texts count as empty; documents without words fail ``min_words``. Rows
    with a null host form one host of their own; null ids and repeated rows get
    one result row each. Other columns of ``docs`` are not read, whatever their
    names. An empty table gives an empty result.

    Measured rows are written once: they feed the counts and the join. Host
    counts are summed before the shuffle, so a host with a third of all rows
    is one row per task; the join to the (small) host table is a broadcast only
    if Spark finds it below its size limit, else a join whose hot partitions
    are split.
    """
    prepare(docs.sparkSession)
    m = materialise(measure_documents(docs, F.col(host).cast("string")), "host-rules")
    per_word = F.greatest(F.col("n_words"), F.lit(1))
    mean_length = F.col("word_chars") / per_word
    base = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")
    )
    upper = F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1))
    hard = (F.col("n_symbols") > rules.hard_symbols * per_word) | (upper > rules.hard_upper)
    soft = (
        (F.col("n_symbols") > rules.soft_symbols * per_word).cast("int")
        + (100 * F.col("n_repeat_words") > rules.soft_repeat_percent * F.col("n_words")).cast("int")
        + (upper > rules.soft_upper).cast("int")
        + (F.col("n_dup_lines") >= rules.soft_dup_lines).cast("int")
        + (~mean_length.between(*rules.word_length)).cast("int")
    )
    judged = m.withColumns({"base_failed": base, "hard_failed": hard, "n_soft_failed": soft})
    bad = F.col("base_failed") | F.col("hard_failed") | (F.col("n_soft_failed") > 0)
    failures = judged.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(bad.cast("long")).alias("failed"))
    verdicts = host_verdicts(failures, rules.host_factor, rules.host_deviations).select(
        F.col("host").alias("_host"), F.col("rate").alias("host_rate"), F.col("prior").alias("prior_rate"),
        F.col("rejected").alias("host_rejected"),
    )
    kept = ~(
        F.col("base_failed") | F.col("hard_failed") | (F.col("host_rejected") & (F.col("n_soft_failed") > 0))
    )
    return (
        judged.join(verdicts, F.col("host").eqNullSafe(F.col("_host")), "left")
        .drop("_host")
        .withColumn("kept", kept)
    )
