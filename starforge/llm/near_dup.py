"""Near-duplicate detection by MinHash and a multi-index Hamming join.

A document is the set of its distinct five-word shingles. Its signature has 64
minimum hashes of 16 bits; the Hamming distance of two signatures counts the
hashes that differ, about 64 (1 - J) for sets of similarity J. The signature is
split into 16 chunks of 4 hashes. Two signatures at a distance of at most 31
have, by pigeonhole, a chunk with at most one error, so enumerating for each
chunk which hash may be wrong gives 64 keys per document of which such a pair
shares at least one. Candidates from shared keys are compared by signature and
then confirmed on the full sets.

Documents of equal sets are one class; only classes are compared, and of those
only the ones that have enough shingles in common with any other. Within a
bucket of a key not all pairs are made: first every class is compared with a few
neighbours in the order of signatures, and later only classes of different
components meet, the nearest first and then all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import discard, materialise
from .common import WORD, map_lists, prepare, raw, signed, spare
from .components import connected_components
from .words import word_groups

WIDTH = 5
HASHES = 64
CHUNK = 4
# The largest distance for which some chunk of 16 has at most one error.
DISTANCE = 2 * (HASHES // CHUNK) - 1
SIMILAR = 75
# Classes of one bucket that are compared in one step; larger buckets are cut.
BLOCK = 4096

_RNG = np.random.default_rng(10)
FACTORS = (_RNG.integers(1, 1 << 32, HASHES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
SHIFTS = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)


def mixed(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` consecutive word hashes."""
    n = max(0, len(words) - width + 1)
    key = np.full(n, width, np.uint64)
    for i in range(width):
        key ^= words[i : n + i]
        key *= np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(31)
    return key


def shingle_sets(texts: list[bytes]) -> tuple[list[np.ndarray], list[int]]:
    """Sorted 64-bit hashes of the distinct shingles of each text, and its words."""
    out, counts = [], []
    for words, sizes in word_groups(texts):
        keys = mixed(words, WIDTH)
        start = 0
        for n in sizes.tolist():
            own = keys[start : start + n - WIDTH + 1] if n >= WIDTH else mixed(words[start : start + n], n)
            # A text of fewer words is one shingle; one without words has none.
            found = np.sort(own) if n else np.empty(0, np.uint64)
            distinct = np.ones(len(found), bool)
            np.not_equal(found[1:], found[:-1], out=distinct[1:])
            out.append(found[distinct])
            counts.append(n)
            start += n
    return out, counts


def signature(found: np.ndarray) -> np.ndarray:
    """64 minimum hashes of a non-empty set, 16 bits each."""
    x = ((found * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 1024):
        some = x[at : at + 1024]
        least = np.minimum(least, (FACTORS[:, None] * some[None, :] + SHIFTS[:, None]).min(1))
    return ((least * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)


def keys_of(signatures: np.ndarray) -> np.ndarray:
    """(rows, 64) keys: for each chunk and each hash of it left out, the others."""
    parts = signatures.reshape(len(signatures), HASHES // CHUNK, CHUNK).astype(np.uint64)
    out = np.empty((len(signatures), HASHES // CHUNK, CHUNK), np.uint64)
    for chunk in range(HASHES // CHUNK):
        for wrong in range(CHUNK):
            key = np.full(len(signatures), chunk * CHUNK + wrong + 1, np.uint64)
            for i in range(CHUNK):
                if i != wrong:
                    key = (key << np.uint64(16)) | parts[:, chunk, i]
            key *= np.uint64(0x9E3779B97F4A7C15)
            out[:, chunk, wrong] = key ^ (key >> np.uint64(32))
    return out.reshape(len(signatures), HASHES).view(np.int64)


def describe(docs: DataFrame, carry: str | None) -> DataFrame:
    """``doc_id, row, n, n_words, class, sig`` of every row, and the text column
    ``carry``; class is a hash of the set, null for an empty one, and row a hash
    of id and text."""

    def make():
        def step(ids, rows, carried, texts):
            sets, words = shingle_sets(texts)
            n = [len(found) for found in sets]
            classes = [signed(xxhash.xxh3_64_intdigest(f.tobytes())) if len(f) else None for f in sets]
            sigs = [signature(f).tobytes() if len(f) else None for f in sets]
            return [ids, rows, carried, n, words, classes, sigs]

        return step

    kind = dict(docs.dtypes)["doc_id"]
    carried = F.lit(None).cast("string") if carry is None else F.col(carry)
    return map_lists(
        docs.select("doc_id", "row", carried.alias("carried"), raw("text").alias("text")),
        make,
        f"doc_id {kind}, row long, carried string, n long, n_words long, class long, sig binary",
    )


def bucket_rows(classes: DataFrame) -> DataFrame:
    """``key, class``: 64 rows per class."""

    def run(batches):
        for batch in batches:
            sigs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, HASHES)
            keys = keys_of(sigs)
            ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), HASHES)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(ids)], ["key", "class"])

    return classes.select("class", "sig").mapInArrow(run, "key long, class long")


def shared_buckets(classes: DataFrame) -> DataFrame:
    """``key, class`` of the keys that several classes have, by one shuffle: in
    the order of keys, a row whose neighbours have other keys is alone."""
    dealt = bucket_rows(classes).repartition("key").sortWithinPartitions("key")

    def run(batches):
        # The last row waits for its successor; ``twin`` tells whether it had its key's predecessor.
        last, twin = None, False
        for batch in batches:
            keys, ids = (batch.column(i).to_numpy() for i in range(2))
            if last is not None:
                keys, ids = np.concatenate(([last[0]], keys)), np.concatenate(([last[1]], ids))
            same = keys[1:] == keys[:-1]
            kept = np.concatenate(([twin], same))
            kept[:-1] |= same
            last, twin = (keys[-1], ids[-1]), bool(kept[-1])
            kept[-1] = False
            yield pa.RecordBatch.from_arrays([pa.array(keys[kept]), pa.array(ids[kept])], ["key", "class"])
        if twin:
            yield pa.RecordBatch.from_arrays([pa.array([last[0]]), pa.array([last[1]])], ["key", "class"])

    return dealt.mapInArrow(run, "key long, class long")


def shared_counts(sets: DataFrame) -> DataFrame:
    """``class, shared``: how many shingles of a set are in another set too.

    An intersection cannot be larger, so classes that share less than the
    similarity asks for link with nothing, and two classes are compared only if
    their shared shingles could suffice. A shingle of one set names its class in
    the same aggregate, so the shingles are shuffled once; one that is in very
    many sets is one row per task by then.
    """
    rows = sets.select("class", F.explode("found").alias("shingle"))
    once = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("class").alias("class")).filter("n = 1")
    alone = once.groupBy("class").agg(F.count(F.lit(1)).alias("alone"))
    sizes = sets.select("class", F.size("found").alias("n"))
    shared = (F.col("n") - F.coalesce("alone", F.lit(0))).cast("long")
    return sizes.join(alone, "class", "left").select("class", shared.alias("shared"))


def possible(n, shared, i: int, at) -> np.ndarray:
    """Whether class ``i`` and the classes ``at`` can be similar by their numbers."""
    both = np.minimum(shared[at], shared[i])
    return 100 * both >= SIMILAR * (n[at] + n[i] - both)


def signatures(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint16).reshape(-1, HASHES)


# Classes before it, in the order of signatures, that a class is compared with.
NEIGHBOURS = 4
# Candidates of a class that are confirmed in the first round.
FIRST = 3
# Candidates of a class and bucket in the second round.
NEAREST = 4


def neighbour_lists(members: DataFrame, usable: DataFrame) -> DataFrame:
    """``a, to`` for rows ``key, class`` and the classes ``class, n, shared, sig``: for every class its nearest neighbours in its buckets, each
    sorted by signature; a few for every class however large a bucket is. A large
    bucket lies in several range partitions; neighbours across their borders are
    left to the later rounds, which compare all that is not yet joined."""
    order = ("key", "sig", "class")
    dealt = members.join(usable, "class").repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches):
        last: tuple | None = None
        for batch in batches:
            key, ids, n, shared = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            sigs = signatures(batch.column(4).to_pylist())
            if last is not None:
                key, ids, n, shared, sigs = (np.concatenate(x) for x in zip(last, (key, ids, n, shared, sigs)))
            best = np.full(len(ids), HASHES + 1)
            to = np.zeros(len(ids), np.int64)
            for back in range(1, min(NEIGHBOURS, len(ids) - 1) + 1):
                both = np.minimum(shared[back:], shared[:-back])
                ok = (key[back:] == key[:-back]) & (100 * both >= SIMILAR * (n[back:] + n[:-back] - both))
                apart = np.where(ok, (sigs[back:] != sigs[:-back]).sum(1), HASHES + 1)
                nearer = apart < best[back:]
                best[back:][nearer] = apart[nearer]
                to[back:][nearer] = ids[:-back][nearer]
            # Rows carried over from the batch before were compared there.
            fresh = np.arange(len(ids)) >= (0 if last is None else len(last[0]))
            hit = np.flatnonzero((best <= DISTANCE) & fresh)
            last = tuple(x[-NEIGHBOURS:] for x in (key, ids, n, shared, sigs))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[hit]), pa.array(to[hit]), pa.array(best[hit].astype(np.int32))], ["a", "b", "apart"]
            )

    near = dealt.select("key", "class", "n", "shared", "sig").mapInArrow(run, "a long, b long, apart int")
    best = near.groupBy("a").agg(F.slice(F.array_sort(F.collect_set(F.struct("apart", "b"))), 1, FIRST).alias("best"))
    return best.select("a", F.col("best.b").alias("to"))


def first_shared_key(sig: np.ndarray, sigs: np.ndarray) -> np.ndarray:
    """Of the keys that a signature shares with each of others, the first."""
    wrong = (sigs != sig).reshape(len(sigs), HASHES // CHUNK, CHUNK)
    chunk = (wrong.sum(2) <= 1).argmax(1)
    slot = wrong[np.arange(len(sigs)), chunk].argmax(1)
    return keys_of(sig[None, :])[0][chunk * CHUNK + slot]


def compare_group(key, ids, components, n, shared, sigs, side, most: int | None) -> list[tuple[int, list[int]]]:
    """Candidates of each class outside the group's largest component: classes
    of other components, the nearest ``most`` (None: all). A pair is taken in
    the first of its buckets only. ``side`` tells the two blocks of a large
    bucket apart (0 and 1) or is -1."""
    out = []
    names, sizes = np.unique(components, return_counts=True)
    main = names[sizes.argmax()]
    for i in np.flatnonzero(components != main):
        # Of two classes outside the largest component the greater one asks.
        ok = (components != components[i]) & ((components == main) | (ids < ids[i]))
        at = np.flatnonzero(ok & ((side != side[i]) | (side[i] < 0)))
        at = at[possible(n, shared, i, at)]
        if not len(at):
            continue
        apart = (sigs[at] != sigs[i]).sum(1)
        at, apart = at[apart <= DISTANCE], apart[apart <= DISTANCE]
        if not len(at):
            continue
        here = first_shared_key(sigs[i], sigs[at]) == key
        at, apart = at[here], apart[here]
        if len(at):
            out.append((int(ids[i]), ids[at[np.lexsort((ids[at], apart))[:most]]].tolist()))
    return out


# Classes of a group whose pairs are compared all at once with those of others.
SMALL = 8


class Members:
    """Rows of groups of a bucket: group (key, i, j), side, class, component, n,
    shared and signature, as arrays in the order of groups."""

    def __init__(self, key, i, j, side, ids, components, n, shared, sigs):
        self.columns = (key, i, j, side, ids, components, n, shared, sigs)
        self.key, self.i, self.j, self.side, self.ids, self.components, self.n, self.shared, self.sigs = self.columns

    @classmethod
    def of(cls, batch) -> "Members":
        numbers = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(8)]
        return cls(*numbers, signatures(batch.column(8).to_pylist()))

    def rows(self, at) -> "Members":
        return Members(*(c[at] for c in self.columns))

    @classmethod
    def joined(cls, parts: list["Members"]) -> "Members":
        return cls(*(np.concatenate(c) for c in zip(*(p.columns for p in parts))))

    def starts(self) -> np.ndarray:
        """The first row of every group."""
        new = (self.key[1:] != self.key[:-1]) | (self.i[1:] != self.i[:-1]) | (self.j[1:] != self.j[:-1])
        return np.concatenate(([0], np.flatnonzero(new) + 1))


def compare_small(m: Members, sizes: np.ndarray, most: int | None) -> list[tuple[int, list[int]]]:
    """As ``compare_group`` for many groups of ``SMALL`` rows at most: pairs are
    the rows so many places apart; of a pair the class of the greater id asks."""
    group = np.repeat(np.arange(len(sizes)), sizes)
    found: list[list] = [[], [], [], []]
    for back in range(1, int(sizes.max(initial=1))):
        low, high = np.arange(len(group) - back), np.arange(back, len(group))
        both = np.minimum(m.shared[low], m.shared[high])
        ok = (group[low] == group[high]) & (m.components[low] != m.components[high])
        ok &= (m.side[low] != m.side[high]) | (m.side[low] < 0)
        ok &= 100 * both >= SIMILAR * (m.n[low] + m.n[high] - both)
        low, high = low[ok], high[ok]
        wrong = m.sigs[low] != m.sigs[high]
        apart = wrong.sum(1)
        # The first key that the two share has to be this bucket's.
        parts = wrong.reshape(len(low), HASHES // CHUNK, CHUNK)
        chunk = (parts.sum(2) <= 1).argmax(1)
        slot = parts[np.arange(len(low)), chunk].argmax(1)
        first = keys_of(m.sigs[low])[np.arange(len(low)), chunk * CHUNK + slot]
        ok = (apart <= DISTANCE) & (first == m.key[low])
        a, b = m.ids[low[ok]], m.ids[high[ok]]
        for column, values in zip(found, (group[low[ok]], np.maximum(a, b), apart[ok], np.minimum(a, b))):
            column.append(values)
    groups, asks, apart, to = (np.concatenate(c) if c else np.empty(0, np.int64) for c in found)
    order = np.lexsort((to, apart, asks, groups))
    groups, asks, to = groups[order], asks[order], to[order]
    new = (groups[1:] != groups[:-1]) | (asks[1:] != asks[:-1])
    cuts = np.flatnonzero(new) + 1
    return [(int(a), x[:most].tolist()) for a, x in zip(asks[np.r_[0, cuts]] if len(asks) else [], np.split(to, cuts))]


def cross_lists(members: DataFrame, usable: DataFrame, most: int | None) -> DataFrame:
    """``a, to``: candidates between the components of each bucket, for rows
    ``key, class, component, size`` of buckets with several and the classes
    ``class, n, shared, sig``. Buckets above ``BLOCK`` classes are cut into blocks;
    each pair of blocks is a group of its own, so no task holds a whole hot bucket."""
    parts = F.ceil(F.col("size") / BLOCK).cast("int")
    rows = members.withColumn("parts", parts).withColumn("own", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select(
        "key",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        F.when(F.col("own") == F.col("other"), -1).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
        "class",
        "component",
    )
    rows = rows.join(usable, "class")
    rows = rows.select("key", "i", "j", "side", "class", "component", "n", "shared", "sig")
    # Rows of a block meet themselves once, as (i, i).
    dealt = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "class")

    def lists(m: Members) -> list[tuple[int, list[int]]]:
        starts = m.starts()
        sizes = np.diff(starts, append=len(m.key))
        small = np.repeat(sizes <= SMALL, sizes)
        found = compare_small(m.rows(small), sizes[sizes <= SMALL], most) if small.any() else []
        for start, size in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist()):
            g = m.rows(slice(start, start + size))
            found += compare_group(g.key[0], g.ids, g.components, g.n, g.shared, g.sigs, g.side, most)
        return found

    def emit(found):
        a, to = zip(*found)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(to, pa.list_(pa.int64()))], ["a", "to"])

    def run(batches):
        parts: list[Members] = []
        for batch in batches:
            parts.append(Members.of(batch))
            if (parts[0].key[0], parts[0].i[0], parts[0].j[0]) == (parts[-1].key[-1], parts[-1].i[-1], parts[-1].j[-1]):
                continue  # one group so far
            held = Members.joined(parts)
            # The last group may go on in the next batch.
            last = held.starts()[-1]
            if found := lists(held.rows(slice(0, last))):
                yield emit(found)
            parts = [held.rows(slice(last, None))]
        if parts:
            held = Members.joined(parts)
            if found := lists(held):
                yield emit(found)

    return dealt.mapInArrow(run, "a long, to array<long>")


# Shingles of the sets of a block, 8 MB, which a task holds while candidates stream past.
BLOCK_SHINGLES = 1 << 20
# Classes that ask one copy of a block: this many, or this share of all if that
# is more. A block that more ask has further copies, at most 65 536 in all.
ASKING = 4096
COPY_SHARE = 1 / 65_536


# 64-bit words of the bitmaps that tell which rows' and classes' sets are wanted:
# 2 MB. The more are, the more others pass; what it lets through is never wrong.
BITMAP_WORDS = 1 << 18


def hash_bitmap(rows: DataFrame) -> np.ndarray:
    """A bitmap of fixed size with a bit for every hash in ``rows``, whose columns
    are hashes or lists of them. A task sets the bits of its rows first, so lists
    are not made rows."""

    def run(batches):
        bitmap = np.zeros(BITMAP_WORDS, np.int64)
        for batch in batches:
            for column in batch.columns:
                values = column.flatten() if pa.types.is_list(column.type) else column
                hashes = values.to_numpy(zero_copy_only=False)
                np.bitwise_or.at(bitmap, hashes % BITMAP_WORDS, np.int64(1) << ((hashes >> 20) % 64))
        at = np.flatnonzero(bitmap)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(bitmap[at])], ["word", "bits"])

    words = rows.mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    bitmap = np.zeros(BITMAP_WORDS, np.int64)
    for word, bits in words.collect():
        bitmap[word] = bits
    return bitmap


def in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return (bitmap[hashes % BITMAP_WORDS] >> ((hashes >> 20) % 64)) & 1 == 1


def listed_sets(sets: DataFrame, lists: DataFrame) -> DataFrame:
    """The sets of the classes that ``lists`` names, written (and some others, which
    are never asked for), so that the joins shuffle no more than these."""
    shared = sets.sparkSession.sparkContext.broadcast(hash_bitmap(lists.select("a", "to")))

    def run(batches):
        bitmap = shared.value
        for batch in batches:
            yield batch.filter(pa.array(in_bitmap(bitmap, batch.column(0).to_numpy())))

    written = materialise(sets.select("class", "found").mapInArrow(run, "class long, found array<long>"), "near-listed")
    shared.destroy()
    return written


def confirm(lists: DataFrame, sets: DataFrame, n_shingles: int) -> DataFrame:
    """``a, b`` of the candidates ``a, to`` whose full sets are similar enough, written.

    Sets are dealt into blocks of some ``BLOCK_SHINGLES`` (a longer set is a
    block's worth by itself). A class is sent, with its set, to each block that
    holds some of its candidates, or to one of the copies of a block that many
    ask; a task holds one block at a time and streams those who ask. No row is
    made for a pair.
    """
    blocks = n_shingles // BLOCK_SHINGLES + 1
    block_of = lambda c: F.pmod(c, F.lit(blocks))
    where = F.explode(F.array_distinct(F.transform("to", block_of))).alias("block")
    lists = materialise(lists, "near-lists")
    sets = listed_sets(sets, lists)
    asking = lists.select("a", "to", where)
    loads = asking.groupBy("block").agg(F.count(F.lit(1)).alias("asks"))
    part = max(ASKING, (loads.agg(F.sum("asks")).first()[0] or 0) * COPY_SHARE)
    copies = loads.filter(F.col("asks") > part).select("block", F.ceil(F.col("asks") / part).alias("copies"))
    copies = F.broadcast(copies)
    known = F.coalesce("copies", F.lit(1))
    asking = asking.join(copies, "block", "left").select(
        "block", F.pmod(F.xxhash64("a"), known).alias("copy"), F.lit(1).alias("asks"), "a",
        F.expr(f"filter(to, c -> pmod(c, {blocks}) = block)").alias("to"),
    )
    asking = asking.join(sets.select(F.col("class").alias("a"), "found"), "a")
    held = sets.select(block_of(F.col("class")).alias("block"), "class", "found").join(copies, "block", "left")
    held = held.select(
        "block",
        F.explode(F.sequence(F.lit(0).cast("long"), known - 1)).alias("copy"),
        F.lit(0).alias("asks"),
        F.col("class").alias("a"),
        F.lit(None).cast("array<long>").alias("to"),
        "found",
    )
    order = ("block", "copy")
    rows = held.unionByName(asking).repartition(*order).sortWithinPartitions(*order, "asks", "a")

    def run(batches):
        block, own = None, {}
        for batch in batches:
            out: list[list] = [[], []]
            numbers = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            ids, wanted = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            found = batch.column(5)
            for i in range(batch.num_rows):
                if numbers[i] != block:
                    block, own = numbers[i], {}
                x = found[i].values.to_numpy()
                if wanted[i] is None:
                    own[ids[i]] = x
                    continue
                for other in wanted[i]:
                    y = own[other]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    if 100 * both >= SIMILAR * (len(x) + len(y) - both):
                        out[0].append(ids[i])
                        out[1].append(other)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["a", "b"])

    rows = rows.select("block", "copy", "asks", "a", "to", "found")
    links = materialise(rows.mapInArrow(run, "a long, b long"), "near-links")
    discard(lists, sets)
    return links


def full_sets(docs: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """``class, found``: the shingle sets of the rows in the bitmap (and of some
    others, which are never asked for). Texts are read again, not shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def make():
        bitmap = shared.value

        def step(rows, texts):
            wanted = in_bitmap(bitmap, np.array(rows, np.int64))
            found = [s for s in shingle_sets([texts[i] for i in np.flatnonzero(wanted)])[0] if len(s)]
            return [[signed(xxhash.xxh3_64_intdigest(f.tobytes())) for f in found], [f.view(np.int64) for f in found]]

        return step

    return map_lists(docs.select("row", raw("text").alias("text")), make, "class long, found array<long>")


def find_links(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``node, component`` of the classes that are linked."""
    shared = materialise(shared_buckets(classes), "near-buckets")

    involved = shared.select("class").distinct().join(classes, "class").select("row")
    sets = materialise(full_sets(docs, hash_bitmap(involved)).dropDuplicates(["class"]), "near-sets")
    usable = classes.join(shared_counts(sets), "class").filter(100 * F.col("shared") >= SIMILAR * F.col("n"))
    usable = materialise(usable.select("class", "n", "shared", "sig"), "near-usable")
    # Two numbers a row: signatures are joined to the rows that are compared.
    members = materialise(shared.join(usable.select("class"), "class", "left_semi").select("key", "class"), "near-members")
    n_shingles = usable.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    discard(shared)

    links = confirm(neighbour_lists(members, usable), sets, n_shingles)
    # First the nearest of each class, which join most of what belongs together;
    # then all candidates between the components that are left. Components that
    # the last links join have no candidates that were not among those.
    for most in (NEAREST, None):
        parts = connected_components(links)
        labels = usable.select("class").join(parts, F.col("class") == F.col("node"), "left")
        labels = labels.select("class", F.coalesce("component", "class").alias("component"))
        own = members.join(labels, "class")
        mixed = own.groupBy("key").agg(
            F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("size")
        )
        open_members = own.join(mixed.filter("low <> high").select("key", "size"), "key")
        links = links.unionByName(confirm(cross_lists(open_members, usable, most), sets, n_shingles))
    parts = connected_components(links)
    discard(usable, members, sets)
    return parts


def label_rows(docs: DataFrame, carry: str | None = None) -> DataFrame:
    """``doc_id, row, n_words, n_shingles, component, component_id`` of every row
    of ``docs`` (doc_id, text, row), and the text column ``carry`` if one is named;
    ``component`` names the group, null without words."""
    described = materialise(describe(docs, carry), "near-rows")
    filled = described.filter("class is not null")
    classes = filled.groupBy("class").agg(F.min(F.struct("row", "n", "sig")).alias("first"))
    classes = materialise(classes.select("class", "first.*"), "near-classes")
    parts = find_links(docs, classes)

    least = filled.groupBy("class").agg(F.min("doc_id").alias("low"))
    labelled = least.join(parts, F.col("class") == F.col("node"), "left").select(
        "class", "low", F.coalesce("component", "class").alias("component")
    )
    labelled = materialise(labelled, "near-labels")
    lowest = labelled.groupBy("component").agg(F.min("low").alias("component_id"))
    ids = labelled.join(lowest, "component").select("class", "component", "component_id")
    carried = [] if carry is None else [F.col("carried").alias(carry)]
    out = described.select("doc_id", "row", *carried, "n_words", F.col("n").alias("n_shingles"), "class")
    out = out.join(ids, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.withColumn("component_id", component).drop("class")


def row_hash() -> F.Column:
    return F.xxhash64(F.col("doc_id").cast("string"), F.col("text"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Two rows are linked when 100 times the intersection of their shingle sets is
    at least 75 times the union. ``component_id`` is the smallest id reachable by
    links, ``kept`` tells whether it is the row's own. A text of fewer than five
    words is one shingle; rows without words (null and empty texts) are linked
    with nothing. Rows that repeat an id are documents of their own, all kept or
    none. A row with a null id is kept only if no row of its component has an
    id. Other columns are not read. An empty table gives an empty result.

    Sets and words are told apart by 64-bit hashes. Copies of one set cost one
    number each after the first pass. Texts are read twice and never shuffled;
    the sets of classes that share a key with another are.
    """
    prepare(docs.sparkSession)
    out = label_rows(docs.select("doc_id", "text", row_hash().alias("row")))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return out.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: that of the least
    id, null ids last, and of rows that repeat it the one with the least hash.
    Rows without words all stay. All columns pass through."""
    prepare(docs.sparkSession)
    row = spare(docs, "row")
    numbered = docs.withColumn(row, row_hash())
    labelled = label_rows(numbered.select("doc_id", "text", F.col(row).alias("row"))).filter("component is not null")
    first = labelled.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"))
    chosen = first.select(F.col("first.row").alias(row))
    filled = F.coalesce(F.regexp_like("text", F.lit(WORD)), F.lit(False))
    kept = numbered.filter(filled).join(chosen, row, "left_semi").dropDuplicates([row])
    return kept.unionByName(numbered.filter(~filled)).select(*docs.columns)
