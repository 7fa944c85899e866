"""Removal of lines that many documents share, by a minimal perfect hash.

Lines are compared by key: white space stripped at both ends, A-Z lower-cased.
Distinct keys, as 128-bit hashes, are counted by document and dealt over
shards. A shard holds a minimal perfect hash over its keys' hashes: levels of
bits, a key being placed at the first level where no other key takes its
position, and its index the number of set bits before it. The index leads into
two compact arrays, a fingerprint and a count. Documents send their keys'
hashes to the shards and get back those of common lines; no line is shuffled or
joined. A shard that a hot line gives too many probes has several copies, and
every document asks one of them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..session import materialise
from .common import map_lists, prepare, raw, signed, spare

# Keys a shard holds on average; its arrays take about 4 bytes a key.
SHARD_KEYS = 8_192
LEVELS = 24
SPREAD = 2.0
# Probes, (document, key) pairs, that meet one copy of a shard: this many, or
# this share of all pairs if that is more. A shard with more gets further copies,
# so there are at most 65 536 of those, whatever a single line's share is.
PROBES = 16_384
COPY_SHARE = 1 / 65_536


def line_key(line: bytes) -> bytes:
    return line.strip().lower()


def key_hash(key: bytes) -> tuple[int, int]:
    both = xxhash.xxh3_128_intdigest(key)
    return signed(both >> 64), signed(both & 0xFFFFFFFFFFFFFFFF)


def mixed(hashes: np.ndarray, level: int) -> np.ndarray:
    x = hashes ^ np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of 64-bit values with a 16-bit fingerprint and a
    saturated 8- or 32-bit count each. Values that no level separates (equal
    ones among them) are kept apart in full."""

    def __init__(self, sizes, bits, ranks, prints, counts, rest):
        self.sizes, self.bits, self.ranks = sizes, bits, ranks
        self.prints, self.counts, self.rest = prints, counts, rest

    @classmethod
    def build(cls, high: np.ndarray, low: np.ndarray, counts: np.ndarray, ceiling: int) -> "PerfectHash":
        kind = np.uint8 if ceiling < 256 else np.uint32
        counts = np.minimum(counts, ceiling).astype(kind)
        left = np.arange(len(high))
        sizes, bits, placed = [], [], []
        for level in range(LEVELS):
            if not len(left):
                break
            size = int(len(left) * SPREAD) + 64
            at = (mixed(high[left], level) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            own = alone[at]
            sizes.append(size)
            bits.append(alone)
            keys = np.zeros(size, np.int64)
            keys[at[own]] = left[own]
            placed.append(keys[alone])
            left = left[~own]
        order = np.concatenate(placed) if placed else np.empty(0, np.int64)
        ranks = np.cumsum([0, *(len(p) for p in placed)])
        rest = {(int(high[i]), int(low[i])): int(counts[i]) for i in left}
        return cls(sizes, bits, ranks, fingerprint(low[order]), counts[order], rest)

    def index(self, high: np.ndarray) -> np.ndarray:
        """Index of each value, -1 for one that no level holds."""
        found = np.full(len(high), -1, np.int64)
        todo = np.arange(len(high))
        for level, (size, bits) in enumerate(zip(self.sizes, self.bits)):
            if not len(todo):
                break
            at = (mixed(high[todo], level) % np.uint64(size)).astype(np.int64)
            hit = bits[at]
            before = np.cumsum(bits) - 1
            found[todo[hit]] = self.ranks[level] + before[at[hit]]
            todo = todo[~hit]
        return found

    def count(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The stored count of each key; 0 where the fingerprint differs."""
        at = self.index(high)
        out = np.zeros(len(high), np.int64)
        known = at >= 0
        own = at[known]
        out[known] = np.where(self.prints[own] == fingerprint(low[known]), self.counts[own].astype(np.int64), 0)
        if self.rest:
            for i in np.flatnonzero(~known):
                out[i] = self.rest.get((int(high[i]), int(low[i])), 0)
        return out

    def pack(self) -> dict:
        return {
            "sizes": list(map(int, self.sizes)),
            "bits": b"".join(np.packbits(b).tobytes() for b in self.bits),
            "prints": self.prints.tobytes(),
            "counts": self.counts.tobytes(),
            "wide": self.counts.dtype == np.uint32,
            "rest": np.array([(h, l, c) for (h, l), c in self.rest.items()], np.uint64).tobytes(),
        }

    @classmethod
    def unpack(cls, row) -> "PerfectHash":
        sizes, bits, at = list(row["sizes"]), [], 0
        for size in sizes:
            n = (size + 7) // 8
            bits.append(np.unpackbits(np.frombuffer(row["bits"][at : at + n], np.uint8), count=size).astype(bool))
            at += n
        rest = np.frombuffer(row["rest"], np.uint64).reshape(-1, 3)
        return cls(
            sizes,
            bits,
            np.cumsum([0, *(int(b.sum()) for b in bits)]),
            np.frombuffer(row["prints"], np.uint16),
            np.frombuffer(row["counts"], np.uint32 if row["wide"] else np.uint8),
            {(int(h), int(l)): int(c) for h, l, c in rest},
        )


def fingerprint(low: np.ndarray) -> np.ndarray:
    return (low >> np.uint64(48)).astype(np.uint16)


def document_keys(docs: DataFrame, row: str) -> DataFrame:
    """``row, high, low``: the hashes of every document's distinct non-empty keys."""

    def make():
        def step(rows, texts):
            out: list[list] = [[], [], []]
            for r, text in zip(rows, texts):
                for key in {k for k in map(line_key, text.split(b"\n")) if k}:
                    for column, value in zip(out, (r, *key_hash(key))):
                        column.append(value)
            return out

        return step

    return map_lists(docs.select(row, raw("text").alias("text")), make, "row long, high long, low long")


def build_shards(counts: DataFrame, shards: int, ceiling: int) -> DataFrame:
    """One row per shard with the packed hash and arrays of its keys."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        table = PerfectHash.build(
            pdf["high"].to_numpy().view(np.uint64),
            pdf["low"].to_numpy().view(np.uint64),
            pdf["n"].to_numpy(),
            ceiling,
        ).pack()
        return pd.DataFrame([{"shard": pdf["shard"].iloc[0], **table}])

    return (
        counts.withColumn("shard", F.pmod("low", F.lit(shards)))
        .groupBy("shard")
        .applyInPandas(
            build,
            "shard long, sizes array<long>, bits binary, prints binary, counts binary, wide boolean, rest binary",
        )
    )


def common_keys(keys: DataFrame, least: int) -> DataFrame:
    """``row, common``: per document the high halves of its keys that are in at
    least ``least`` documents."""
    counts = materialise(keys.groupBy("high", "low").agg(F.count(F.lit(1)).alias("n")), "line-counts")
    n_keys, n_pairs = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    shards = n_keys // SHARD_KEYS + 1
    built = materialise(build_shards(counts, shards, least if least > 255 else 255), "line-shards")

    # Which shards have several copies: a routing table of at most 65 536 rows.
    part = max(PROBES, n_pairs * COPY_SHARE)
    shard = F.pmod("low", F.lit(shards)).alias("shard")
    loads = counts.groupBy(shard).agg(F.sum("n").alias("pairs")).filter(F.col("pairs") > part)
    copies = F.broadcast(loads.select("shard", F.ceil(F.col("pairs") / part).alias("copies")))
    known = F.coalesce("copies", F.lit(1))

    def probe(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return left.loc[[], ["row", "high"]] if len(left) else pd.DataFrame({"row": [], "high": []}, dtype="int64")
        table = PerfectHash.unpack(right.iloc[0])
        n = table.count(left["high"].to_numpy().view(np.uint64), left["low"].to_numpy().view(np.uint64))
        return left.loc[n >= least, ["row", "high"]]

    # A document's probes of a split shard all meet the same copy.
    dealt = keys.select("row", "high", "low", shard).join(copies, "shard", "left")
    dealt = dealt.select("row", "high", "low", "shard", F.pmod(F.xxhash64("row"), known).alias("copy"))
    spread = built.join(copies, "shard", "left").withColumn("copy", F.explode(F.sequence(F.lit(0), known - 1))).drop("copies")
    found = (
        dealt.groupBy("shard", "copy")
        .cogroup(spread.groupBy("shard", "copy"))
        .applyInPandas(probe, "row long, high long")
    )
    return found.groupBy("row").agg(F.collect_set("high").alias("common"))


def drop_common_lines(docs: DataFrame, least: int = 10) -> DataFrame:
    """``docs`` without the lines whose key is in at least ``least`` documents,
    and with ``n_lines`` (before) and ``n_dropped``.

    Every row is a document, also where ids are null or rows repeat. A text is
    split at line feeds; a null or empty one has one empty line and comes back
    empty. Lines without a key (blank ones) always stay, and so do the others
    with their case and white space. Columns of ``docs`` called ``n_lines`` or
    ``n_dropped`` are replaced, all others pass through. An empty table gives an
    empty result.

    The texts are shuffled once, to meet the keys found common in them, by a
    hash of id and text. Two rows of one hash would share their common keys,
    which changes nothing, since being common is a property of the key alone.
    """
    prepare(docs.sparkSession)
    given = docs.drop("n_lines", "n_dropped")
    row, common = spare(given, "_row"), spare(given, "_common")
    numbered = given.withColumn(row, F.xxhash64(F.col("doc_id").cast("string"), F.col("text")))
    keys = materialise(document_keys(numbered, row), "line-keys")
    verdicts = common_keys(keys, least).select(F.col("row").alias(row), F.col("common").alias(common))
    joined = numbered.join(verdicts, row, "left").select(*given.columns, common)

    fields = [StructField(f.name, StringType()) if f.name == "text" else f for f in given.schema]
    schema = StructType([*fields, StructField("n_lines", LongType()), StructField("n_dropped", LongType())])
    arrow, at = to_arrow_schema(schema), given.columns.index("text")

    def run(batches):
        for batch in batches:
            texts, sizes, dropped = [], [], []
            for text, bad in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                lines = (text or "").split("\n")
                kept = lines
                if bad:
                    bad = set(bad)
                    kept = [x for x in lines if not (k := line_key(x.encode())) or key_hash(k)[0] not in bad]
                texts.append("\n".join(kept))
                sizes.append(len(lines))
                dropped.append(len(lines) - len(kept))
            columns = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(len(fields))]
            columns += [pa.array(sizes, pa.int64()), pa.array(dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return joined.mapInArrow(run, schema)
