"""Best-fit packing of documents into bins under conflicts.

Documents are cut into pieces of at most a bin's capacity and dealt over shards
of bounded size; each shard fills its own bins. Open bins are ordered by what is
left in them and carry two bitmaps, of the sources and of the duplicate clusters
inside. A piece goes to the bin with the least room that is enough for it and
that is compatible: the search starts at the first such bin and goes on to the
successors until one is. Otherwise a new bin is opened.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import materialise
from .common import map_lists, prepare, raw, signed
from .near_dup import label_rows

CAPACITY = 8192
MAX_SOURCES = 8
# Documents a shard has on average.
SHARD_ROWS = 4096


class Bins:
    """Open bins in order of their residual room."""

    def __init__(self, capacity: int, max_sources: int):
        self.capacity, self.max_sources = capacity, max_sources
        self.order: list[tuple[int, int]] = []
        self.sources: list[int] = []
        self.clusters: list[int] = []

    def compatible(self, bin_id: int, source: int, cluster: int) -> bool:
        """No document of the cluster inside, and not too many sources."""
        if self.clusters[bin_id] & cluster:
            return False
        return (self.sources[bin_id] | source).bit_count() <= self.max_sources

    def place(self, size: int, source: int, cluster: int) -> int:
        """The bin of a piece; the bitmaps are ints with one bit set (or none)."""
        at = bisect_left(self.order, (size, -1))
        while at < len(self.order) and not self.compatible(self.order[at][1], source, cluster):
            at += 1
        if at < len(self.order):
            room, bin_id = self.order.pop(at)
        else:
            room, bin_id = self.capacity, len(self.sources)
            self.sources.append(0)
            self.clusters.append(0)
        self.sources[bin_id] |= source
        self.clusters[bin_id] |= cluster
        if room > size:
            insort(self.order, (room - size, bin_id))
        return bin_id


def pack_shard(rows: list[tuple], capacity: int, max_sources: int) -> list[tuple]:
    """``(row, piece, start, size, bin)`` for ``(key, source, cluster, size)``
    rows. Whole bins of long documents come first, then the rest by size, the
    largest first, ties by key. A cluster needs a bit only if two of its pieces
    are in the shard; a document's own pieces are of one cluster."""
    pieces = []
    for i, (key, source, cluster, size) in enumerate(rows):
        for p, start in enumerate(range(0, size, capacity)):
            pieces.append((-min(capacity, size - start), key, i, p, start, source, cluster))
    pieces.sort(key=lambda x: (x[0], x[1], x[3], x[2]))
    shared = Counter(x[6] for x in pieces)
    source_bits: dict = {}
    cluster_bits: dict = {}
    bins, out = Bins(capacity, max_sources), []
    for size, _, i, p, start, source, cluster in pieces:
        bit = source_bits.setdefault(source, 1 << len(source_bits))
        twin = cluster_bits.setdefault(cluster, 1 << len(cluster_bits)) if shared[cluster] > 1 else 0
        out.append((i, p, start, -size, bins.place(-size, bit, twin)))
    return out


def row_key() -> F.Column:
    return F.xxhash64(F.col("doc_id").cast("string"), F.col("source").cast("string"), F.col("text"))


def measure_rows(docs: DataFrame, cluster: str | None) -> DataFrame:
    """``doc_id, source, key, cluster, size`` of every row. Where no cluster is
    given it is a hash of the words, so that copies up to white space are of one
    cluster; the key is a hash of id, source and text."""

    def make():
        def step(ids, sources, keys, given, texts):
            clusters, sizes = [], []
            for named, text in zip(given, texts):
                words = text.split()
                sizes.append(len(words))
                clusters.append(signed(xxhash.xxh3_64_intdigest(b" ".join(words))) if named is None else named)
            return [ids, sources, keys, clusters, sizes]

        return step

    kind = dict(docs.dtypes)["doc_id"]
    source = F.col("source").cast("string")
    given = F.lit(None) if cluster is None else F.col(cluster)
    return map_lists(
        docs.select(
            "doc_id", source.alias("source"), row_key().alias("key"), given.cast("long").alias("cluster"), raw("text").alias("text")
        ),
        make,
        f"doc_id {kind}, source string, key long, cluster long, size long",
    )


def pack_documents(
    docs: DataFrame,
    capacity: int = CAPACITY,
    max_sources: int = MAX_SOURCES,
    shard_rows: int = SHARD_ROWS,
    cluster: str | None = None,
    near_copies: bool = False,
) -> DataFrame:
    """``doc_id, source, piece, start, size, shard, bin``: a row per piece.

    Sizes are words. A bin holds at most ``capacity`` words, pieces of at most
    ``max_sources`` sources (null is one) and no two pieces of one cluster:
    copies, repeated rows and the pieces of a long document go to different
    bins. Copies of the same words are one cluster; ``cluster`` names a column
    of integers that tells clusters otherwise (where it is not null), and with
    ``near_copies`` they are the components of ``near_dup``, for documents that
    were not deduplicated. ``start`` is the word at which a piece begins. A row
    without words (null and empty texts) is returned with size 0 and null bin.
    Null and repeated ids give rows as any other; other columns are not read. An
    empty table gives an empty result. A bin's name is (shard, bin).

    One shuffle, of sizes and hashes; with ``near_copies`` those of the search
    before it, which counts the words as well. Shards are told by a hash of the row, so
    sources and clusters of any size are spread evenly; a task streams its
    shards and holds one, at most ``4 * shard_rows`` rows, at a time.
    """
    prepare(docs.sparkSession)
    n = docs.count()
    shards = n // shard_rows + 1
    limit = 4 * shard_rows
    if near_copies:
        given = docs.select("doc_id", "text", row_key().alias("row"), F.col("source").cast("string").alias("source"))
        measured = label_rows(given, carry="source").select(
            "doc_id", "source", F.col("row").alias("key"), F.col("component").alias("cluster"), F.col("n_words").alias("size")
        )
    else:
        measured = measure_rows(docs, cluster)
    # Numbers only; rows with and without words are both taken from here.
    measured = materialise(measured, "pack-rows")
    kind = dict(docs.dtypes)["doc_id"]
    empty = measured.filter("size = 0").select(
        "doc_id",
        "source",
        F.lit(0).alias("piece"),
        F.lit(0).cast("long").alias("start"),
        "size",
        F.lit(None).cast("string").alias("shard"),
        F.lit(None).cast("long").alias("bin"),
    )
    filled = measured.filter("size > 0")
    dealt = filled.withColumn("shard", F.pmod("key", F.lit(shards)))
    dealt = dealt.repartition("shard").sortWithinPartitions("shard", "key", "size")

    def run(batches):
        held: list[tuple] = []
        part = 0

        def done():
            shard = f"{held[0][5]}-{part}"
            rows = [(r[2], r[1], r[3], r[4]) for r in held]
            out = [
                (held[i][0], held[i][1], p, start, size, shard, b)
                for i, p, start, size, b in pack_shard(rows, capacity, max_sources)
            ]
            return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out), schema)], schema=schema)

        schema = None
        for batch in batches:
            if schema is None:
                schema = pa.schema(
                    [
                        ("doc_id", batch.schema.field(0).type),
                        ("source", pa.string()),
                        ("piece", pa.int32()),
                        ("start", pa.int64()),
                        ("size", pa.int64()),
                        ("shard", pa.string()),
                        ("bin", pa.int64()),
                    ]
                )
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if held and (held[0][5] != row[5] or len(held) >= limit):
                    yield done()
                    part = part + 1 if held[0][5] == row[5] else 0
                    held = []
                held.append(row)
        if held:
            yield done()

    packed = dealt.select("doc_id", "source", "key", "cluster", "size", "shard").mapInArrow(
        run, f"doc_id {kind}, source string, piece int, start long, size long, shard string, bin long"
    )
    return packed.unionByName(empty)
