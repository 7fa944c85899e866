"""Ranked lexical search over a length-stratified index.

A document's score for a term depends on its occurrences tf and, through the
normaliser m, on the document's length only. Documents of equal m form a
stratum, large ones being dealt to several blocks; a block's index lists, per
term, its documents by falling tf. Within a block the impact of a term is thus
one number per tf, computed once, and the first tf of a term gives its largest
impact there: summed over an item's terms, a bound of every score of the block.

A search makes two passes over the index. In the first every task visits, per
item, only the best bounded of the blocks it holds at a time; the k-th best
score of all of these is a floor. The second visits an item's blocks in the
order of their bounds, down to the floor or to the k-th best score met in the
task, whichever is higher. A block left out cannot hold a result.
"""

from __future__ import annotations

import math
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from ..session import materialise
from .common import map_lists, prepare, raw

# Documents, and bytes of their terms' hashes, that a block holds on average at most.
BLOCK_DOCS = 512
BLOCK_BYTES = 16 << 20
# (item, term) pairs that are searched, and known to the driver, at a time.
PAIRS_AT_ONCE = 200_000
REMEMBERED = 300_000

# Fixed values of the scoring rule.
BASE, SLOPE = 100 - 75, 75
GAIN, RISE, DAMP = 1_000_000_000, 1000, 8

# A-Z lower-cased, every other ASCII character but digits and a-z a blank.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


class TermHashes(dict):
    def __missing__(self, term: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[term] = value = xxhash.xxh3_64_intdigest(term)
        return value


def count_terms(rows: DataFrame, key: str) -> DataFrame:
    """``key, n, terms, tfs``: per row the number of terms, and hashes and counts
    of the distinct ones, by hash."""

    def make():
        hashes = TermHashes()

        def step(keys, texts):
            sizes, terms, tfs = [], [], []
            for text in texts:
                words = text.translate(FOLD).split()
                counts = Counter(words)
                found = np.fromiter((hashes[w] for w in counts), np.uint64, len(counts))
                order = np.argsort(found)
                sizes.append(len(words))
                terms.append(found[order].tobytes())
                tfs.append(np.fromiter(counts.values(), np.uint32, len(counts))[order].tobytes())
            return [keys, sizes, terms, tfs]

        return step

    kind = dict(rows.dtypes)[key]
    given = rows.select(F.col(key).alias("key"), raw("text").alias("text"))
    return map_lists(given, make, f"key {kind}, n long, terms binary, tfs binary")


def count_lengths(rows: DataFrame) -> DataFrame:
    """``n``: the number of terms of every row."""

    def make():
        return lambda texts: [[len(text.translate(FOLD).split()) for text in texts]]

    return map_lists(rows.select(raw("text").alias("text")), make, "n long")


class SearchIndex(NamedTuple):
    """The blocks, the number of documents with a term and that of all terms."""

    blocks: DataFrame
    docs: int
    terms: int


BLOCK = "m long, terms binary, dfs binary, runs binary, run_tfs binary, run_docs binary, docs binary"


def build_index(docs: DataFrame) -> SearchIndex:
    """The index of every document of ``doc_id, text`` that has a term.

    Texts are read twice: for their lengths, which say the normalisers and the
    blocks, and for their terms, which are shuffled once.
    """
    lengths = materialise(count_lengths(docs).filter("n > 0"), "search-lengths")
    n_docs, n_terms = lengths.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    normaliser = F.expr(f"{BASE} + (({SLOPE}L * n * {n_docs}L) div {max(n_terms, 1)}L)")
    # A document has at most as many distinct terms, of 8 bytes, as terms.
    shares = F.greatest(F.count(F.lit(1)) / BLOCK_DOCS, F.sum(F.col("n") * 8) / BLOCK_BYTES)
    strata = lengths.groupBy(normaliser.alias("m")).agg(F.ceil(shares).alias("parts"))
    strata = materialise(strata, "search-strata")
    placed = count_terms(docs, "doc_id").filter("n > 0").withColumn("m", normaliser)
    dealt = placed.join(strata, "m").withColumn("part", F.pmod(F.xxhash64("terms", "tfs", "key"), "parts"))

    schema = StructType(
        [*StructType.fromDDL(BLOCK).fields, StructField("ids", ArrayType(docs.schema["doc_id"].dataType))]
    )
    arrow = to_arrow_schema(schema)

    def build(group: pa.Table) -> pa.Table:
        own = [np.frombuffer(x, np.uint64) for x in group.column("terms").to_pylist()]
        terms = np.concatenate(own)
        tfs = np.concatenate([np.frombuffer(x, np.uint32) for x in group.column("tfs").to_pylist()]).astype(np.int64)
        rows = np.repeat(np.arange(len(own)), [len(x) for x in own])
        order = np.lexsort((rows, -tfs, terms))
        terms, tfs, rows = terms[order], tfs[order], rows[order]
        new_term = np.concatenate(([True], terms[1:] != terms[:-1]))
        new_run = new_term | np.concatenate(([True], tfs[1:] != tfs[:-1]))
        first, run_first = np.flatnonzero(new_term), np.flatnonzero(new_run)
        fields = [
            terms[first],
            np.diff(first, append=len(terms)).astype(np.uint32),
            np.add.reduceat(new_run.astype(np.uint32), first).astype(np.uint32),
            tfs[run_first].astype(np.uint32),
            np.diff(run_first, append=len(terms)).astype(np.uint32),
            rows.astype(np.uint16 if len(own) <= 1 << 16 else np.uint32),
        ]
        values = [group.column("m")[0].as_py(), *(x.tobytes() for x in fields), group.column("key").to_pylist()]
        return pa.table([pa.array([v], f.type) for v, f in zip(values, arrow)], schema=arrow)

    built = dealt.select("m", "part", "key", "terms", "tfs").groupBy("m", "part").applyInArrow(build, schema)
    return SearchIndex(materialise(built, "search-index"), n_docs, n_terms)


def impacts(tfs: np.ndarray, m: int) -> np.ndarray:
    return (GAIN * tfs) // (RISE * tfs + DAMP * m)


class Block:
    """What a block holds of the terms asked for."""

    def __init__(self, row: dict, asked: np.ndarray):
        terms = np.frombuffer(row["terms"], np.uint64)
        at = np.minimum(np.searchsorted(terms, asked), len(terms) - 1)
        here = np.flatnonzero(terms[at] == asked)
        runs = np.concatenate(([0], np.cumsum(np.frombuffer(row["runs"], np.uint32).astype(np.int64))))
        sizes = np.frombuffer(row["run_docs"], np.uint32).astype(np.int64)
        run_tfs = np.frombuffer(row["run_tfs"], np.uint32).astype(np.int64)
        self.ids = row["ids"]
        # One impact per tf of the stratum, then one per run of documents.
        table = impacts(np.arange(int(run_tfs.max()) + 1), row["m"])
        self.docs = np.frombuffer(row["docs"], np.uint16 if len(self.ids) <= 1 << 16 else np.uint32)
        self.impacts = np.repeat(table[run_tfs], sizes)
        places = np.concatenate(([0], np.cumsum(sizes)))
        self.tops = np.zeros(len(asked), np.int64)
        self.tops[here] = table[run_tfs[runs[at[here]]]]
        self.spans = {
            q: (a, b) for q, a, b in zip(here.tolist(), places[runs[at[here]]].tolist(), places[runs[at[here] + 1]].tolist())
        }

    def scores(self, terms: list[tuple[int, int]], least: int) -> np.ndarray | None:
        """The score of every document for the weighted ``terms``; None once it is
        clear that none reaches ``least``."""
        here = sorted(((w * int(self.tops[q]), q, w) for q, w in terms if q in self.spans), reverse=True)
        rest = sum(top for top, _, _ in here)
        total = np.zeros(len(self.ids), np.int64)
        for top, q, w in here:
            if rest < least and int(total.max()) + rest < least:
                return None
            a, b = self.spans[q]
            total[self.docs[a:b]] += w * self.impacts[a:b]
            rest -= top
        return total


class Best:
    """The k best documents of one item so far, by score and id (null last)."""

    def __init__(self, k: int, floor: int):
        self.k, self.floor, self.rows = k, floor, []

    def add(self, block: Block, scores: np.ndarray) -> None:
        good = np.flatnonzero(scores >= self.floor)
        if len(good) > self.k:
            # Documents below the k-th score of this block alone are out; ties stay.
            least = np.partition(scores[good], -self.k)[-self.k]
            good = good[scores[good] >= least]
        ids = [block.ids[i] for i in good.tolist()]
        self.rows += [(-s, i is None, i if i is not None else 0, i) for s, i in zip(scores[good].tolist(), ids)]
        self.rows.sort(key=lambda r: r[:3])
        del self.rows[self.k :]
        if len(self.rows) == self.k:
            self.floor = max(self.floor, -self.rows[-1][0])


class Asked(NamedTuple):
    """Some items: their rows and ids, the distinct terms of all, and per item
    the (term, weight) pairs; ``flat`` has them as arrays."""

    rows: list
    ids: list
    terms: np.ndarray
    weighed: list
    flat: tuple


def asked_items(items: list, weights: dict | None = None, terms: np.ndarray | None = None) -> Asked:
    own = [np.frombuffer(r["terms"], np.uint64) for r in items]
    terms = np.unique(np.concatenate(own)) if terms is None else terms
    at = [np.searchsorted(terms, x).tolist() for x in own]
    counts = [np.frombuffer(r["tfs"], np.uint32).tolist() for r in items]
    weighed = [[(q, n * (weights or {}).get(q, 0)) for q, n in zip(a, c)] for a, c in zip(at, counts)]
    firsts = np.concatenate(([0], np.cumsum([len(x) for x in own])[:-1]))
    flat = (np.concatenate(at).astype(np.int64), np.array([w for x in weighed for _, w in x], np.int64), firsts)
    return Asked([r["row"] for r in items], [r["key"] for r in items], terms, weighed, flat)


def document_counts(index: SearchIndex, terms: np.ndarray) -> dict[int, int]:
    """In how many documents each of ``terms`` (by position) occurs."""

    def run(batches):
        total = np.zeros(len(terms), np.int64)
        for batch in batches:
            for known, dfs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                known = np.frombuffer(known, np.uint64)
                at = np.minimum(np.searchsorted(known, terms), len(known) - 1)
                here = known[at] == terms
                total[here] += np.frombuffer(dfs, np.uint32)[at[here]]
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], ["term", "df"])

    parts = index.blocks.select("terms", "dfs").mapInArrow(run, "term long, df long")
    return {r["term"]: r["df"] for r in parts.groupBy("term").agg(F.sum("df").alias("df")).collect()}


def visit(index: SearchIndex, asked: Asked, kinds, k: int, floors: dict, first_only: bool) -> DataFrame:
    """``row, item_id, doc_id, score``: of every task the k best documents an item."""
    schema = StructType(
        [StructField("row", LongType()), StructField("item_id", kinds[0]), StructField("doc_id", kinds[1]),
         StructField("score", LongType())]
    )
    arrow = to_arrow_schema(schema)
    terms, weights, firsts = asked.flat

    def run(batches):
        best = [Best(k, floors.get(row, 1)) for row in asked.rows]
        for batch in batches:
            if not batch.num_rows:
                continue
            blocks = [Block(row, asked.terms) for row in batch.to_pylist()]
            bounds = np.stack([np.add.reduceat(weights * b.tops[terms], firsts) for b in blocks])
            order = np.argsort(-bounds, axis=0)[: 1 if first_only else None]
            for item, own in enumerate(best):
                for b in order[:, item].tolist():
                    if bounds[b, item] < own.floor:
                        break
                    scores = blocks[b].scores(asked.weighed[item], own.floor)
                    if scores is not None:
                        own.add(blocks[b], scores)
        found = [
            (row, item_id, r[3], -r[0]) for row, item_id, own in zip(asked.rows, asked.ids, best) for r in own.rows
        ]
        columns = list(zip(*found)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, arrow)], schema=arrow)

    return index.blocks.mapInArrow(run, schema)


def ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(index: SearchIndex, items: DataFrame, kind, k: int = 10) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents for each item.

    ``items`` has ``item_id, text`` and ``kind`` is the type of ``doc_id``.
    Items are searched in groups of some 200 000 (item, term) pairs, so what the
    driver and each task know of the items is bounded; work and passes grow with
    the number of groups.
    """
    kinds = (items.schema["item_id"].dataType, kind)
    counted = count_terms(items, "item_id").withColumn("row", F.monotonically_increasing_id())
    known = materialise(counted.filter("n > 0"), "search-items")
    pairs = known.agg(F.sum(F.length("tfs") / 4)).first()[0] or 0
    groups = int(pairs // PAIRS_AT_ONCE) + 1
    out = None
    for group in range(groups):
        own = known.filter(F.pmod(F.xxhash64("row"), F.lit(groups)) == group).collect() if index.docs else []
        if not own:
            continue
        asked = asked_items(own)
        n = index.docs
        weights = {
            q: math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
            for q, df in document_counts(index, asked.terms).items()
        }
        asked = asked_items(own, weights, asked.terms)
        first = ranked(visit(index, asked, kinds, k, {}, True), k)
        floors = {r["row"]: r["score"] for r in first.filter(F.col("rank") == k).select("row", "score").collect()}
        found = visit(index, asked, kinds, k, floors, False)
        out = found if out is None else out.unionByName(found)
    if out is None:
        empty = StructType([StructField("row", LongType()), StructField("item_id", kinds[0]),
                            StructField("doc_id", kinds[1]), StructField("score", LongType())])
        out = items.sparkSession.createDataFrame([], empty)
    return ranked(out, k).select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each row of ``items`` (``item_id,
    text``) the k documents of ``docs`` (``doc_id, text``) with the highest score
    above 0, equal scores by ascending id (null last); fewer if there are fewer.

    Terms are the maximal runs of digits, ASCII letters and characters beyond
    ASCII, A-Z lower-cased. Null, empty and termless texts are neither found nor
    counted, termless items have no results. Every row is a document or an item
    of its own, so repeated rows give repeated results and null ids stand for
    themselves. Empty tables give an empty result; other columns are not read.
    Terms are compared by 64-bit hash.
    """
    prepare(docs.sparkSession)
    index = build_index(docs.select("doc_id", "text"))
    return search(index, items.select("item_id", "text"), docs.schema["doc_id"].dataType, k)
