"""Token counts of a unigram tokenizer, without building the tokens.

Aho-Corasick enumerates the vocabulary's matches; the best path over them is
found by dynamic programming that carries only its score and its number of
pieces. The rules are those of the tokenizer:

* a text is prefixed by one U+2581, and every space becomes U+2581;
* a position where no piece of one character matches has a piece for an
  unknown character, scored 10 below the vocabulary's least score; it counts as
  one token per UTF-8 byte (byte fallback);
* of two paths to a position with equal scores the one whose last piece starts
  earlier wins.
"""

from __future__ import annotations

import re

import ahocorasick
import sentencepiece
from pyspark.sql import DataFrame

from .common import map_lists, prepare, raw

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
# Counts of chunks a task remembers before it starts anew.
REMEMBERED = 400_000


def load_pieces(path: str) -> list[tuple[str, float]]:
    """The normal pieces of a model file with their scores."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        (model.id_to_piece(i), model.get_score(i))
        for i in range(model.get_piece_size())
        if not (model.is_unknown(i) or model.is_control(i) or model.is_unused(i) or model.is_byte(i))
    ]


class PieceCounter(dict):
    """Chunk to number of pieces; a missing chunk is counted when asked for."""

    def __init__(self, pieces: list[tuple[str, float]]):
        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        if pieces:
            self.automaton.make_automaton()
        self.empty = not pieces
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        # No piece holds a mark after another character, so no piece crosses
        # into a run of marks and a text's best path is that of its chunks. The
        # same goes for line feeds where no piece holds one.
        if any(MARK in p.lstrip(MARK) for p, _ in pieces):
            raise ValueError("a piece spans a word boundary")
        lines = any("\n" in p for p, _ in pieces)
        self.chunks = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+" if lines else f"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+")

    def __missing__(self, chunk: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[chunk] = count = self.best(chunk)
        return count

    def best(self, chunk: str) -> int:
        n = len(chunk)
        ends: list[list] = [[] for _ in range(n + 1)]
        single = bytearray(n)
        if not self.empty:
            for last, (length, score) in self.automaton.iter(chunk):
                ends[last + 1].append((last + 1 - length, score))
                if length == 1:
                    single[last] = 1
        scores, counts = [0.0] * (n + 1), [0] * (n + 1)
        for end in range(1, n + 1):
            best, pieces = None, 0
            for start, score in sorted(ends[end]):
                total = scores[start] + score
                if best is None or total > best:
                    best, pieces = total, counts[start] + 1
            if not single[end - 1]:
                total = scores[end - 1] + self.unknown
                if best is None or total > best:
                    best, pieces = total, counts[end - 1] + len(chunk[end - 1].encode("utf-8"))
            scores[end], counts[end] = best, pieces
        return counts[n]

    def text(self, text: str) -> int:
        if not text:
            return 0
        marked = MARK + text.replace(" ", MARK)
        return sum(map(self.__getitem__, self.chunks.findall(marked)))


def count_pieces(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """``doc_id, n_chars, n_pieces`` for every row of ``docs``.

    Whole texts are counted; a null or empty text has no piece. Rows with null
    or repeated ids give a row each; other columns are not read. An empty table
    gives an empty result.

    One pass without a shuffle. A task's memory holds the vocabulary and a
    bounded number of remembered chunk counts.
    """
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(load_pieces(model))

    def make():
        counter = PieceCounter(shared.value)

        def step(ids, texts):
            decoded = [t.decode("utf-8", "replace") for t in texts]
            return [ids, list(map(len, decoded)), list(map(counter.text, decoded))]

        return step

    kind = dict(docs.dtypes)["doc_id"]
    return map_lists(
        docs.select("doc_id", raw("text").alias("text")), make, f"doc_id {kind}, n_chars long, n_pieces long"
    )
