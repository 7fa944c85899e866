"""Supervised subword embeddings for document quality.

A document is the average of learned vectors of its words, of their character
n-grams and of repeated words (word pairs), all hashed into one table; a softmax over two outputs gives
the probability of label 1. The model is trained by stochastic gradient descent
in numpy. Since the logit is linear in the averaged vectors, a word's share of
it is one number, which a task computes once per distinct word.
"""

from __future__ import annotations

import itertools
import operator
import zlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from .common import crc_mod, map_lists, prepare, raw

BUCKETS = 1 << 16
GRAM = 3
# Words whose share a task remembers before it starts anew.
REMEMBERED = 400_000


def word_features(word: bytes) -> list[int]:
    """Buckets of a word and of the byte n-grams of the bracketed word."""
    marked = b"<" + word + b">"
    crc, mask = zlib.crc32, BUCKETS - 1
    return [crc(marked) & mask, *[crc(marked[i : i + GRAM]) & mask for i in range(len(marked) - GRAM + 1)]]


# The bucket of all word pairs "w w": a word said twice in a row.
TWICE = zlib.crc32(b"\x00twice") & (BUCKETS - 1)


def repeats(words: list[bytes]) -> int:
    return sum(map(operator.eq, words, itertools.islice(words, 1, None)))


def text_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their shares of all its features."""
    words = text.split()
    found = [f for word in words for f in word_features(word)] + [TWICE] * repeats(words)
    ids, counts = np.unique(np.array(found, np.int64), return_counts=True)
    return ids, counts / max(1, len(found))


@dataclass
class Model:
    vectors: np.ndarray
    output: np.ndarray
    bias: np.ndarray

    def shares(self) -> np.ndarray:
        """What each bucket adds to the logit of label 1 over label 0."""
        return self.vectors @ (self.output[1] - self.output[0])

    def offset(self) -> float:
        return float(self.bias[1] - self.bias[0])


def train(examples: list[tuple], dim: int, epochs: int, rate: float, seed: int) -> Model:
    """SGD, one document a step, on ``(label, buckets, shares)``; no example: all 0.5."""
    rng = np.random.default_rng(seed)
    model = Model(rng.uniform(-1 / dim, 1 / dim, (BUCKETS, dim)), np.zeros((2, dim)), np.zeros(2))
    model.output[1] = rng.uniform(-1, 1, dim)
    steps, done = max(1, epochs * len(examples)), 0
    if not examples:
        model.output[:] = 0
    for _ in range(epochs):
        for i in rng.permutation(len(examples)):
            label, ids, shares = examples[i]
            step = rate * (1 - done / steps)
            done += 1
            rows = model.vectors[ids]
            hidden = shares @ rows
            logits = model.output @ hidden + model.bias
            p = np.exp(logits - logits.max())
            error = p / p.sum()
            error[label] -= 1
            back = error @ model.output
            model.output -= step * np.outer(error, hidden)
            model.bias -= step * 0.1 * error
            # A bucket's step is by its share, lifted by the text's number of buckets.
            model.vectors[ids] -= step * np.outer(shares * len(ids) ** 0.5, back)
    return model


def training_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> list[tuple]:
    """At most ``max_rows`` labelled rows, the first by a hash of the id, as features.

    The features of a whole text are at most ``BUCKETS`` pairs, whatever its length.
    """
    marked = labels.filter(F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("label"))
    marked = marked.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_rows)
    chosen = docs.select("doc_id", raw("text").alias("text")).join(F.broadcast(marked), "doc_id")

    def make():
        def step(ids, texts, label):
            found = [text_features(t) for t in texts]
            return [
                ids,
                label,
                [a.astype(np.int32).tobytes() for a, _ in found],
                [b.astype(np.float32).tobytes() for _, b in found],
            ]

        return step

    kind = dict(docs.dtypes)["doc_id"]
    rows = map_lists(chosen.select("doc_id", "text", "label"), make, f"doc_id {kind}, label int, ids binary, shares binary")
    # Documents that repeat an id would lengthen the sample.
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "label", "ids").limit(max_rows)
    return [(r[1], np.frombuffer(r[2], np.int32), np.frombuffer(r[3], np.float32)) for r in rows.collect()]


class WordShares(dict):
    def __init__(self, shares: np.ndarray):
        super().__init__()
        self.by_bucket = shares.tolist()

    def __missing__(self, word: bytes) -> tuple[float, int]:
        if len(self) >= REMEMBERED:
            self.clear()
        own = self.by_bucket
        found = word_features(word)
        self[word] = out = (sum([own[f] for f in found]), len(found))
        return out

    def logit(self, text: bytes, offset: float) -> float:
        words = text.split()
        if not words:
            return offset
        shares, sizes = zip(*map(self.__getitem__, words))
        twice = repeats(words)
        return offset + (sum(shares) + twice * self.by_bucket[TWICE]) / (sum(sizes) + twice)


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    threshold: float = 0.3,
    folds: int = 5,
    held_fold: int = 0,
    max_rows: int = 4000,
    dim: int = 8,
    epochs: int = 8,
    rate: float = 0.5,
    seed: int = 6,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    ``score`` is the probability of label 1; ``predicted`` is 1 from
    ``threshold`` on. Labels of rows whose crc32(doc_id) modulo ``folds`` is
    ``held_fold`` are never read by the training, which takes at most
    ``max_rows`` of the others. Inputs of a score are words and their n-grams
    only. A null or empty text gets the model's bias; without any label all
    scores are 0.5. Labels that are null or not 0 or 1 are ignored, a document
    with several label rows is an example for each. Every input row, with null
    or repeated ids, gives one row, with the columns named in ``carry``; others
    are not read. An empty table gives an empty result.

    The sample is picked from ``labels`` alone, so its join to the documents is
    a broadcast of at most ``max_rows`` ids; the model (a table of fixed size)
    is broadcast to one pass over the documents.
    """
    spark = prepare(docs.sparkSession)
    fold = crc_mod(F.col("doc_id"), folds)
    usable = labels.filter(F.col("doc_id").isNotNull() & (fold != held_fold))
    model = train(training_sample(docs, usable, label, max_rows), dim, epochs, rate, seed)
    shared = spark.sparkContext.broadcast((model.shares(), model.offset()))

    def run(batches):
        shares, offset = shared.value
        words = WordShares(shares)
        for batch in batches:
            logits = np.array([words.logit(t, offset) for t in batch.column(2).to_pylist()])
            scores = 1 / (1 + np.exp(-np.clip(logits, -500, 500)))
            predicted = pa.array((scores >= threshold).astype(np.int32))
            columns = [batch.column(0), batch.column(1), pa.array(scores), predicted, *batch.columns[3:]]
            yield pa.RecordBatch.from_arrays(columns, names)

    held = (fold == held_fold).alias("held_out")
    given = docs.select("doc_id", held, raw("text").alias("_text"), *carry)
    results = [StructField("score", DoubleType()), StructField("predicted", IntegerType())]
    schema = StructType([*given.schema.fields[:2], *results, *given.schema.fields[3:]])
    names = schema.names
    return given.mapInArrow(run, schema)
