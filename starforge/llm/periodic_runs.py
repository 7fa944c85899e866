"""Periodic runs of words inside documents, by seeds on diagonals.

A run with period q and length of at least max(6, 4 q) words matches itself on
the diagonal of lag q over at least max(6, 4 q) - q words. For the lags of a
band 2^j .. 2^(j+1) - 1 the least of these overlaps is k = 5 for the first band
and 3 * 2^j for the others, and k is never below the lags of its band. So the
k-grams of a band are indexed and occurrences in the same document are paired
into seeds (place, lag).

Only neighbouring occurrences of a k-gram need pairing: a nearer occurrence
inside a run, at a lag d below q <= k, would give k + d words both periods, and
by Fine and Wilf a common divisor of them, so q would not be the smallest. For
the same reason a seed whose stretch is long enough has the smallest period.
The number of seeds is therefore at most one per word and band, however often a
k-gram occurs.

A seed is extended in both directions unless its lag's furthest-covered place
is beyond it already. k-grams are told apart by exact ranks, made of pairs of
ranks of shorter ones; words that repeat no shorter gram leave the index early.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from .common import prepare

# Words of the documents that are indexed in one go; a longer document is one by itself.
CHUNK_WORDS = 200_000
LEAST, TIMES = 6, 4

RESULT = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


class GramIndex:
    """Places of the words of some documents whose k-gram occurs again in the
    same document, in the order of gram and place, with the gram's rank."""

    def __init__(self, doc_of: np.ndarray, places: np.ndarray, keys: np.ndarray):
        order = np.argsort(keys, kind="stable")
        places, keys = places[order], keys[order]
        again = keys[1:] == keys[:-1]
        repeated = np.zeros(len(keys), bool)
        repeated[1:] |= again
        repeated[:-1] |= again
        ranks = np.concatenate(([0], np.cumsum(~again))) if len(keys) else np.empty(0, np.int64)
        self.doc_of, self.places, self.ranks = doc_of, places[repeated], ranks[repeated]

    def joined(self, shift: int) -> "GramIndex":
        """The index of grams longer by ``shift`` words, at most twice as long."""
        n = len(self.doc_of)
        rank_at = np.full(n, -1, np.int64)
        rank_at[self.places] = self.ranks
        first = np.sort(self.places)
        first = first[first + shift < n]
        first = first[(rank_at[first + shift] >= 0) & (self.doc_of[first] == self.doc_of[first + shift])]
        return GramIndex(self.doc_of, first, rank_at[first] * (n + 1) + rank_at[first + shift])

    def seeds(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Neighbouring occurrences of a gram at lags from ``low`` to ``high``,
        in the order of lag and place."""
        lags = self.places[1:] - self.places[:-1]
        good = (self.ranks[1:] == self.ranks[:-1]) & (lags >= low) & (lags <= high)
        places, lags = self.places[:-1][good], lags[good]
        order = np.lexsort((places, lags))
        return places[order], lags[order]


def bands(doc_of: np.ndarray, words: np.ndarray):
    """``k, places, lags``: the seeds of every band of lags."""
    single = GramIndex(doc_of, np.arange(len(words)), words)
    three = single.joined(1).joined(1)
    yield 5, *three.joined(2).seeds(1, 1)
    k, low, index = 6, 2, three.joined(3)
    while len(index.places):
        yield k, *index.seeds(low, 2 * low - 1)
        index, k, low = index.joined(k), 2 * k, 2 * low


def runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """``start, length, period`` of the runs of each text, a list of words, by start and period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.concatenate(([0], np.cumsum(sizes)))
    doc_of = np.repeat(np.arange(len(texts)), sizes)
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for t in texts for w in t], np.int64)
    ids += doc_of * (len(known) + 1)
    found: list[list] = [[] for _ in texts]
    covered: dict[int, int] = {}
    for k, places, lags in bands(doc_of, ids):
        if not len(places):
            continue
        # Seeds at consecutive places of a diagonal are one stretch.
        cut = np.flatnonzero((np.diff(places) != 1) | (np.diff(lags) != 0)) + 1
        firsts, lasts = np.concatenate(([0], cut)), np.concatenate((cut, [len(places)])) - 1
        for first, last, lag in zip(places[firsts].tolist(), places[lasts].tolist(), lags[firsts].tolist()):
            if last < covered.get(lag, 0):
                continue
            doc = int(doc_of[first])
            begin, end = int(begins[doc]), int(begins[doc + 1])
            left, right = first, last + k
            while left > begin and ids[left - 1] == ids[left - 1 + lag]:
                left -= 1
            while right + lag < end and ids[right] == ids[right + lag]:
                right += 1
            covered[lag] = right
            length = right + lag - left
            if length >= max(LEAST, TIMES * lag):
                found[doc].append((left - begin, length, lag))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by one blank."""
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return b" ".join([w for w, k in zip(words, kept.tolist()) if k]) if runs else b" ".join(words)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (start, length, period, in words from 0)
    and ``collapsed`` (the text with one period left of every run).

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text, compared with their
    case. A run is a stretch of words with smallest period q, at least
    max(6, 4 q) words long, that neither neighbour extends. Null, empty and
    blank texts have no words, no runs and an empty ``collapsed``. Every row is
    judged by itself, so nulls and repeats among ids make no difference; an
    empty table gives an empty result. Columns of ``docs`` called like one of
    the three are replaced, all others pass through.

    Nothing is shuffled. A task holds one Arrow batch and the index of some
    200 000 words, or of one document if that is longer.
    """
    prepare(docs.sparkSession)
    made = StructType.fromDDL(RESULT)
    given = docs.drop(*made.names)
    schema = StructType([*[StructField(f.name, f.dataType) for f in given.schema], *made.fields])
    arrow, at = to_arrow_schema(schema), given.columns.index("text")
    kinds = [f.type for f in arrow][-3:]

    def judged(part: list[list[bytes]]):
        runs = runs_of(part)
        return zip(map(len, part), runs, (collapse(w, r).decode() for w, r in zip(part, runs)))

    def run(batches):
        for batch in batches:
            out, part, size = [], [], 0
            for text in batch.column(at):
                words = (text.as_py() or "").encode().split()
                if part and size + len(words) > CHUNK_WORDS:
                    out += judged(part)
                    part, size = [], 0
                part.append(words)
                size += len(words)
            out += judged(part)
            numbers, runs, texts = zip(*out) if out else ((), (), ())
            runs = [[dict(zip(("start", "length", "period"), r)) for r in own] for own in runs]
            columns = [c.cast(f.type) for c, f in zip(batch.columns, arrow)]
            columns += [pa.array(v, t) for v, t in zip((numbers, runs, texts), kinds)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return given.mapInArrow(run, schema)
