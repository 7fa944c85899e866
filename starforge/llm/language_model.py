"""Language-model scores of a log-bilinear model trained with noise-contrastive estimation.

Words are mapped to classes: one for the end of a text, one for each of the most
frequent words, and the others by the last bytes of a word, with one class for
the rest. The number K of classes grows with the square root of the training
tokens, up to ``MOST_CLASSES``, for which the tables that every task is told take
48 MB. The log-bilinear model predicts a class from the two classes before it;
within a class, words have their smoothed share of the class's count. Over all
words of the training texts and one unseen word per class, the probabilities
after any context add up to 1.

The model's score of class w after (u, v) is
``(C1 * R[v] + C2 * R[u]) . Q[w] + b[w]``. Being linear in the context it is the
sum of two entries of K x K tables, and the normalisers of all contexts are one
product of the tables' exponentials.

Training texts are dealt to lanes by a hash of the document, some million tokens
each. In a pass the lanes train on from one model, each by itself and in the order
of its hashes, and the results are averaged; neither the partitions of the input
nor the schedule has a part in it. Passes go on until the score of development
texts, which no lane learns from, rises by less than ``Shape.least_gain``.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import materialise
from .common import crc_mod, hash64, map_lists, prepare, raw

END = b""
TAIL = 3
# Distinct words a task counts before it passes them on.
FLUSH = 200_000
# Least count of a word that every task is told: chosen so that at most this
# many words are.
KNOWN_WORDS = 1 << 17


def lowered(text: bytes) -> list[bytes]:
    return text.lower().split()


# The largest K: three K x K tables of floats are told to every task.
LEAST_CLASSES, MOST_CLASSES = 128, 2048
# Of the classes, those of one word.
SINGLE_SHARE = 0.6
# Tokens of a lane, the part of the training texts that one task learns from.
LANE_TOKENS = 2_000_000
# One in so many training texts is kept for development.
DEVELOPMENT = 50


@dataclass(frozen=True)
class Shape:
    """Sizes and rates of the model, and the passes that it is trained for at most."""

    single_words: int = 600
    tail_classes: int = 423
    dim: int = 24
    noise: int = 64
    batch: int = 2048
    rate: float = 0.1
    passes: int = 8
    least_gain: float = 0.01
    seed: int = 1

    @classmethod
    def sized(cls, tokens: int) -> "Shape":
        """The shape for so many training tokens."""
        classes = min(MOST_CLASSES, max(LEAST_CLASSES, int(tokens**0.5)))
        single = int(SINGLE_SHARE * classes)
        return cls(single, classes - 1 - single)


def count_words(docs: DataFrame) -> DataFrame:
    """``word, n`` over all texts; the ends are counted as the empty word."""

    def run(batches):
        counts: Counter = Counter()

        def flush():
            words = pa.array(list(counts.keys()), pa.binary())
            out = pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(lowered(text))
            counts[END] += batch.num_rows
            if len(counts) > FLUSH:
                yield flush()
        if counts:
            yield flush()

    partial = docs.select(raw("text").alias("text")).mapInArrow(run, "word binary, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """What every task is told of the training texts, bounded in size: totals,
    the most frequent words with their counts, and the classes."""

    total: int
    distinct: int
    words: list[bytes]
    counts: np.ndarray
    classes: np.ndarray
    tails: dict[bytes, int]
    mass: np.ndarray
    single: np.ndarray

    @property
    def rest(self) -> int:
        return len(self.mass) - 1

    def share(self) -> np.ndarray:
        """log10 of each class's smoothed mass, 0 for classes of one known word."""
        return np.log10(np.where(self.single, 1.0, self.mass))


def build_vocabulary(counts: DataFrame, shape: Shape) -> Vocabulary:
    """Totals and classes from the table of all counts, in a few aggregates.

    The least count of a known word comes from a histogram of counts in powers
    of 2 ** (1/8), at most some hundred rows.
    """
    step = F.floor(F.log2("n") * 8).cast("int").alias("step")
    steps = counts.groupBy(step).agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.min("n").alias("least"))
    rows = sorted(steps.collect(), key=lambda r: -r["step"])
    total, distinct = sum(r["n"] for r in rows), sum(r["k"] for r in rows)
    told, least = 0, None
    for r in rows:
        if told + r["k"] > KNOWN_WORDS:
            break
        told, least = told + r["k"], r["least"]
    known = [] if least is None else counts.filter(F.col("n") >= least).collect()
    known = {bytes(r["word"]): r["n"] for r in known}
    # The end is in every text, so it is told whatever its count.
    known |= {END: r["n"] for r in counts.filter(F.col("word") == F.lit(bytearray(END))).collect()}
    known = sorted(known.items(), key=lambda x: (-x[1], x[0]))
    singles = [w for w, _ in known if w != END][: shape.single_words]

    # Mass and number of words of every tail, without the classes of one word.
    tail = F.substring("word", -TAIL, TAIL)
    others = counts.filter(F.col("word") != F.lit(bytearray(END)))
    if singles:
        last = next((n, w) for w, n in known if w == singles[-1])
        before = (F.col("n") > last[0]) | ((F.col("n") == last[0]) & (F.col("word") <= F.lit(bytearray(last[1]))))
        others = others.filter(~before)
    tails = others.groupBy(tail.alias("tail")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"))
    tails = materialise(tails, "lm-tails")
    top = tails.orderBy(F.col("n").desc(), "tail").limit(max(0, shape.tail_classes - 1)).collect()
    all_n, all_k = tails.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("k"), F.lit(0))).first()

    ids = {END: 0, **{w: i + 1 for i, w in enumerate(singles)}}
    first = 1 + len(singles)
    tail_ids = {bytes(r["tail"]): first + i for i, r in enumerate(top)}
    mass = np.zeros(first + len(top) + 1)
    counted = dict(known)
    for w, i in ids.items():
        mass[i] = counted.get(w, 0)
    for i, r in enumerate(top):
        mass[first + i] = r["n"] + 0.5 * (r["k"] + 1)
    mass[-1] = all_n - sum(r["n"] for r in top) + 0.5 * (all_k - sum(r["k"] for r in top) + 1)
    single = np.arange(len(mass)) < first
    words = [w for w, _ in known]
    if END not in counted:
        words.append(END)
    rest = len(mass) - 1
    classes = np.array([ids[w] if w in ids else tail_ids.get(w[-TAIL:], rest) for w in words], np.int32)
    return Vocabulary(
        total, distinct, words, np.array([counted.get(w, 0) for w in words], np.int64), classes, tail_ids, mass, single
    )


def classes_of(at: np.ndarray, words: Vocabulary) -> np.ndarray:
    """Classes of the indices that ``WordIndex`` gives."""
    return np.where(at >= 0, words.classes[np.maximum(at, 0)], -1 - at).astype(np.int64)


class WordIndex(dict):
    """Known word to its index; any other word to -1 - class."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__({w: i for i, w in enumerate(vocabulary.words)})
        self.tails, self.rest = vocabulary.tails, vocabulary.rest

    def __missing__(self, word: bytes) -> int:
        return -1 - self.tails.get(word[-TAIL:], self.rest)

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


class LogBilinear:
    """Parameters: context rows R, output rows Q, biases b, position weights C."""

    def __init__(self, r, q, b, c):
        self.r, self.q, self.b, self.c = r, q, b, c

    @classmethod
    def start(cls, mass: np.ndarray, shape: Shape) -> "LogBilinear":
        rng = np.random.default_rng(shape.seed)
        k, d = len(mass), shape.dim
        prior = (mass + 0.5) / (mass + 0.5).sum()
        small = lambda *s: rng.normal(0, 0.1, s).astype(np.float32)
        return cls(small(k, d), small(k, d), np.log(prior).astype(np.float32), np.ones((2, d), np.float32))

    def pack(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.r, self.q, self.b, self.c)]).astype(np.float32)

    @classmethod
    def unpack(cls, flat: np.ndarray, k: int, d: int) -> "LogBilinear":
        r, q, b, c = np.split(flat.astype(np.float32), np.cumsum([k * d, k * d, k]))
        return cls(r.reshape(k, d).copy(), q.reshape(k, d).copy(), b.copy(), c.reshape(2, d).copy())

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores by last and by second last class, and the log normaliser of
        every context (last, second last).

        The normaliser sums exp(one[v, w] + two[u, w]) over w for all v and u: a
        matrix product of exponentials, each row less its largest score.
        """
        one = ((self.r * self.c[0]) @ self.q.T + self.b).astype(np.float32)
        two = ((self.r * self.c[1]) @ self.q.T).astype(np.float32)
        top_one, top_two = one.max(1, keepdims=True), two.max(1, keepdims=True)
        sums = np.exp((one - top_one).astype(np.float64)) @ np.exp((two - top_two).astype(np.float64)).T
        return one, two, (np.log(sums) + top_one + top_two.T).astype(np.float32)


def add_rows(into: np.ndarray, at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows ``at`` with the sums of ``rows`` that go to them."""
    # Classes fit 16 bits, which numpy sorts by radix.
    order = np.argsort(at.astype(np.uint16), kind="stable")
    ranked = at[order]
    starts = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    return ranked[starts], sums_from(rows.take(order, axis=0), starts)


# Rows of a segment up to which segments are summed all at once.
SHORT = 8


def sums_from(rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """``np.add.reduceat(rows, starts, axis=0)``, to the last digit: a segment's sum
    is its first row plus the sum of the others, which are added up in their order
    where they are few."""
    sizes = np.diff(starts, append=len(rows))
    out = rows.take(starts, axis=0)
    some = np.flatnonzero((sizes > 1) & (sizes <= SHORT))
    if len(some):
        # The longest first, so that those which have an i-th row are a prefix.
        some = some[np.argsort(-sizes[some], kind="stable")]
        begin, more = starts[some], sizes[some]
        rest = rows.take(begin + 1, axis=0)
        for i in range(2, int(more[0])):
            n = np.count_nonzero(more > i)
            rest[:n] += rows.take(begin[:n] + i, axis=0)
        out[some] += rest
    long = sizes > SHORT
    if long.any():
        begin = np.cumsum(sizes[long]) - sizes[long]
        out[long] = np.add.reduceat(rows.compress(np.repeat(long, sizes), axis=0), begin, axis=0)
    return out


class Trainer:
    """Noise-contrastive estimation by mini-batches with AdaGrad steps. A batch
    shares its noise words, drawn by the classes' frequencies."""

    def __init__(self, model: LogBilinear, noise: np.ndarray, shape: Shape, seed: int):
        self.m, self.shape = model, shape
        self.rng = np.random.default_rng(seed)
        self.edges, self.log_noise = np.cumsum(noise), np.log(noise * shape.noise).astype(np.float32)
        self.gr, self.gq = np.ones(len(model.r), np.float32), np.ones(len(model.q), np.float32)
        self.gb, self.gc = np.ones(len(model.b), np.float32), 1.0

    def step(self, w: np.ndarray, v: np.ndarray, u: np.ndarray) -> None:
        m, rate = self.m, self.shape.rate
        x = np.searchsorted(self.edges, self.rng.random(self.shape.noise) * self.edges[-1])
        x = np.minimum(x, len(self.edges) - 1)
        rv, ru, qw, qx = (table.take(at, axis=0) for table, at in ((m.r, v), (m.r, u), (m.q, w), (m.q, x)))
        h = rv * m.c[0]
        h += ru * m.c[1]
        data = 1 / (1 + np.exp(np.einsum("ij,ij->i", h, qw) + m.b[w] - self.log_noise[w]))
        # The widest array, worked out in place.
        lure = h @ qx.T
        np.subtract(self.log_noise[x] - m.b[x], lure, out=lure)
        np.exp(lure, out=lure)
        lure += 1
        np.divide(-1, lure, out=lure)
        rows = np.empty((len(w) + len(x), h.shape[1]), np.float32)
        np.multiply(data[:, None], h, out=rows[: len(w)])
        np.matmul(lure.T, h, out=rows[len(w) :])
        dh = lure @ qx
        dh += data[:, None] * qw
        ids, sums = add_rows(m.q, np.concatenate((w, x)), rows)
        self.gq[ids] += np.einsum("ij,ij->i", sums, sums) / sums.shape[1]
        m.q[ids] += rate * sums / np.sqrt(self.gq[ids])[:, None]
        db = np.bincount(w, data, len(m.b)) + np.bincount(x, lure.sum(0), len(m.b))
        self.gb += db * db
        m.b += (rate * db / np.sqrt(self.gb)).astype(np.float32)
        dc = np.stack([(dh * rv).sum(0), (dh * ru).sum(0)])
        rows = np.empty((len(v) + len(u), h.shape[1]), np.float32)
        np.multiply(dh, m.c[0], out=rows[: len(v)])
        np.multiply(dh, m.c[1], out=rows[len(v) :])
        ids, sums = add_rows(m.r, np.concatenate((v, u)), rows)
        self.gr[ids] += np.einsum("ij,ij->i", sums, sums) / sums.shape[1]
        m.r[ids] += rate * sums / np.sqrt(self.gr[ids])[:, None]
        self.gc += float((dc * dc).mean())
        m.c += (0.1 * rate * dc / self.gc**0.5).astype(np.float32)

    def pass_over(self, w: np.ndarray, v: np.ndarray, u: np.ndarray) -> None:
        order = self.rng.permutation(len(w))
        for at in range(0, len(w), self.shape.batch):
            some = order[at : at + self.shape.batch]
            self.step(w[some], v[some], u[some])


def contexts(classes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Target, last and second last class of every token of some texts, each
    with its end; before a text there are ends."""
    targets = [np.append(c, 0) for c in classes]
    w = np.concatenate(targets) if targets else np.empty(0, np.int64)
    v, u = np.zeros_like(w), np.zeros_like(w)
    v[1:], u[2:] = w[:-1], w[:-2]
    starts = np.cumsum([0, *(len(t) for t in targets)])[:-1]
    v[starts] = 0
    u[starts] = 0
    second = starts + 1
    u[second[second < len(u)]] = 0
    return w, v, u


def packed(classes: np.ndarray) -> bytes:
    return classes.astype(np.uint16).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint16).astype(np.int64)


def encode(docs: DataFrame, held: F.Column, words: Vocabulary, lanes: int) -> DataFrame:
    """Every row's share in the score that no model has a part in, and the classes
    of its words, written: texts are cut into words once.

    ``doc_id, held_out, lane, key, ids, n_tokens, n_known, base_score, inner, rare,
    times, row``. ``lane`` is -1 for development texts and -2 for held out ones,
    ``key`` a hash of id and text; ``inner`` is the score within the classes, and
    ``rare`` are the hashes of the words that are not told to the tasks, whose
    counts are to be added."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(words))
    base_total = np.log10(words.total + 0.5 * (words.distinct + 1))

    def make():
        words = Vocabulary(**shared.value)
        index, share = WordIndex(words), words.share()
        log_count = np.log10(words.counts + 0.5)
        found, several = words.counts > 0, ~words.single[words.classes]
        ends = words.words.index(END)

        def step(ids, held, lanes, keys, texts):
            out: list[list] = [[] for _ in range(11)]
            for i, h, lane, key, text in zip(ids, held, lanes, keys, texts):
                tokens = lowered(text)
                at = np.append(index.of(tokens), np.int32(ends))
                known = at >= 0
                classes = classes_of(at, words)
                own = at[known]
                logs = log_count[own]
                # Within a class of several words: (count + 0.5) / mass; the
                # counts of words that are not known here are added later.
                inner = logs[several[own]].sum() - share[classes].sum()
                rare: dict[int, int] = {}
                for j in np.flatnonzero(~known).tolist():
                    word = hash64(tokens[j])
                    rare[word] = rare.get(word, 0) + 1
                row = (
                    i, h, lane, key, packed(classes[:-1]), len(at), int(np.count_nonzero(found[own])),
                    logs.sum() - len(at) * base_total, inner, list(rare), list(rare.values()),
                )
                for column, value in zip(out, row):
                    column.append(value)
            return out

        return step

    kind = dict(docs.dtypes)["doc_id"]
    key = F.xxhash64(F.col("doc_id").cast("string"), F.col("text"))
    turn = F.pmod(F.xxhash64(key, F.lit("development")), F.lit(DEVELOPMENT))
    lane = F.when(held, -2).when(turn == 0, -1).otherwise(F.pmod(key, F.lit(lanes))).cast("int")
    given = docs.select("doc_id", held.alias("held_out"), lane.alias("lane"), key.alias("key"), raw("text").alias("text"))
    rows = map_lists(
        given,
        make,
        f"doc_id {kind}, held_out boolean, lane int, key long, ids binary, n_tokens long, n_known long,"
        " base_score double, inner double, rare array<long>, times array<int>",
    )
    written = materialise(rows.withColumn("row", F.monotonically_increasing_id()), "lm-rows")
    # What was told lies on the disks of driver and executors until it is destroyed.
    shared.destroy()
    return written


def score_rows(encoded: DataFrame, model: LogBilinear) -> DataFrame:
    """``row, doc_id, held_out, n_tokens, n_known, base_score, score`` of every
    encoded row, written, without the counts of its rare words."""
    shared = encoded.sparkSession.sparkContext.broadcast(model.tables())

    def make():
        one, two, norm = shared.value

        def step(rows, docs, held, tokens, known, base, inner, ids):
            scores = []
            for within, data in zip(inner, ids):
                w, v, u = contexts([unpacked(data)])
                model_log = (one[v, w] + two[u, w] - norm[v, u]).sum(dtype=np.float64) / np.log(10)
                scores.append(model_log + within)
            return [rows, docs, held, tokens, known, base, scores]

        return step

    kind = dict(encoded.dtypes)["doc_id"]
    scored = map_lists(
        encoded.select("row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "inner", "ids"),
        make,
        f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double",
    )
    written = materialise(scored, "lm-scores")
    shared.destroy()
    return written


def train_pass(
    encoded: DataFrame, words: Vocabulary, model: LogBilinear, shape: Shape, lanes: int, number: int
) -> LogBilinear:
    """One pass: every lane trains on from ``model``; the results are averaged by
    tokens. Parameters are cut into blocks and summed per block, in two steps, so
    that what meets in one task or the driver is bounded."""
    k, d = len(words.mass), shape.dim
    noise = (words.mass + 0.5) / (words.mass + 0.5).sum()
    shared = encoded.sparkSession.sparkContext.broadcast((model.pack(), noise))
    order = ("lane", "key", "ids")
    dealt = encoded.select(*order).repartition(lanes, "lane").sortWithinPartitions(*order)

    def run(batches):
        flat, noise = shared.value
        lane, trainer, seen, held, size = None, None, 0, [], 0

        def learn():
            w, v, u = contexts(held)
            trainer.pass_over(w, v, u)
            return len(w)

        def finished():
            rest = learn() if held else 0
            return pd_batch(lane, seen + rest, np.array_split(trainer.m.pack() * np.float64(seen + rest), BLOCKS))

        for batch in batches:
            for own, data in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if own != lane:
                    if trainer is not None:
                        yield finished()
                    lane, seen, held, size = own, 0, [], 0
                    seed = (shape.seed * 1000 + number) * 1_000_003 + lane
                    trainer = Trainer(LogBilinear.unpack(flat, k, d), noise, shape, seed)
                held.append(unpacked(data))
                size += len(held[-1]) + 1
                if size > 1 << 17:
                    seen += learn()
                    held, size = [], 0
        if trainer is not None:
            yield finished()

    partial = dealt.mapInArrow(run, PARAMETERS)
    for keys in (("block", "part"), ("block",)):
        partial = partial.groupBy(*keys).applyInPandas(add_parameters, PARAMETERS)
    rows = sorted(partial.collect(), key=lambda r: r["block"])
    shared.destroy()
    if not rows or not rows[0]["seen"]:
        return model
    flat = np.concatenate([np.frombuffer(r["sums"], np.float64) for r in rows]) / rows[0]["seen"]
    return LogBilinear.unpack(flat, k, d)


def class_score(encoded: DataFrame, model: LogBilinear) -> float:
    """Natural log probability of the classes of some texts, summed up."""
    shared = encoded.sparkSession.sparkContext.broadcast(model.tables())

    def run(batches):
        one, two, norm = shared.value
        total = 0.0
        for batch in batches:
            w, v, u = contexts([unpacked(x) for x in batch.column(0).to_pylist()])
            total += float((one[v, w] + two[u, w] - norm[v, u]).sum(dtype=np.float64))
        yield pa.RecordBatch.from_arrays([pa.array([total])], ["score"])

    total = encoded.select("ids").mapInArrow(run, "score double").agg(F.sum("score")).first()[0]
    shared.destroy()
    return total or 0.0


BLOCKS = 32
GROUPS = 64
PARAMETERS = "block int, part int, lane int, seen long, sums binary"


def pd_batch(lane: int, seen: int, blocks: list[np.ndarray]) -> pa.RecordBatch:
    n = len(blocks)
    columns = [
        pa.array(range(n), pa.int32()),
        pa.array([lane % GROUPS] * n, pa.int32()),
        pa.array([lane] * n, pa.int32()),
        pa.array([seen] * n, pa.int64()),
        pa.array([b.tobytes() for b in blocks], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["block", "part", "lane", "seen", "sums"])


def add_parameters(pdf: pd.DataFrame) -> pd.DataFrame:
    # In a fixed order: sums of floats then do not depend on the schedule.
    pdf = pdf.sort_values(["part", "lane"])
    sums = np.sum([np.frombuffer(b, np.float64) for b in pdf["sums"]], axis=0)
    first = pdf.iloc[0]
    return pd.DataFrame(
        [{"block": first["block"], "part": first["part"], "lane": first["lane"], "seen": pdf["seen"].sum(), "sums": sums.tobytes()}]
    )


def lanes_of(words: Vocabulary) -> int:
    return words.total // LANE_TOKENS + 1


def train_model(encoded: DataFrame, words: Vocabulary, shape: Shape) -> LogBilinear:
    """Passes over all training texts until the development texts' score rises by
    less than ``least_gain`` of itself. Where there are ten lanes or more, a first
    pass over a tenth of them brings the model near enough for the lanes' results
    to be averaged."""
    lanes = lanes_of(words)
    own, development = encoded.filter("lane >= 0"), encoded.filter("lane = -1")
    model = LogBilinear.start(words.mass, shape)
    if lanes >= 10:
        model = train_pass(own.filter(F.col("lane") < lanes // 10), words, model, shape, lanes // 10, 0)
    best = class_score(development, model)
    for number in range(1, shape.passes + 1):
        trained = train_pass(own, words, model, shape, lanes, number)
        score = class_score(development, trained)
        gain, best = score - best, max(best, score)
        if gain > 0 or not best:
            model = trained
        if gain < shape.least_gain * abs(best):
            break
    return model


def score_language_model(
    docs: DataFrame, folds: int = 5, held_fold: int = 1, shape: Shape | None = None
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Tokens are the words of the lower-cased text (A-Z only) and one end. Rows
    whose crc32(doc_id) modulo ``folds`` is ``held_fold`` are scored but not
    learned from; null ids are learned from. ``n_known`` counts tokens that the
    training texts have, ``train_tokens`` all of theirs. ``base_score`` is the
    smoothed unigram log10 probability, ``score`` the model's.

    Counts are of all training texts, and the model learns from all of them but
    one in ``DEVELOPMENT``, which tells when to stop. ``shape`` is chosen by the
    number of training tokens if it is not given. Scores do not depend on how the
    rows are partitioned, but for the last digits of sums. Whole texts are read,
    long ones too. A null or empty text is its end alone. Every input row, with null or repeated
    ids, gives one row; other columns are not read. Without training texts all
    words are unknown; an empty table gives an empty result.

    Words that every task knows are at most ``KNOWN_WORDS``, the most frequent,
    which also takes the hot keys out of the join; the others meet their counts
    in a join by 64-bit word hash of (row, word) pairs, numbers only.
    """
    prepare(docs.sparkSession)
    held = crc_mod(F.col("doc_id"), folds) == held_fold
    counts = materialise(count_words(docs.filter(~held)), "lm-counts")
    if shape is None:
        shape = Shape.sized(counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    words = build_vocabulary(counts, shape)
    encoded = encode(docs, held, words, lanes_of(words))
    partial = score_rows(encoded, train_model(encoded, words, shape))
    rare = encoded.select("row", F.inline(F.arrays_zip("rare", "times")))
    by_hash = counts.groupBy(F.xxhash64("word").alias("rare")).agg(F.max("n").alias("n"))
    count = F.coalesce("n", F.lit(0))
    added = (
        rare.join(by_hash, "rare", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.log10(count + 0.5)).alias("log_count"),
            F.sum(F.when(count > 0, F.col("times")).otherwise(0)).alias("found"),
        )
    )
    logs = F.coalesce("log_count", F.lit(0.0))
    return partial.join(added, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("found", F.lit(0))).alias("n_known"),
        F.lit(words.total).cast("long").alias("train_tokens"),
        (F.col("base_score") + logs).alias("base_score"),
        (F.col("score") + logs).alias("score"),
    )
