"""Exact deduplication by Grace hashing with complete comparison of contents.

The content of a document is its text without white space. Records (one per
content that a task of the scan has met, with the count of its copies there)
are partitioned by a hash into buckets, spilled as shuffle files, and each
bucket streams through an open-addressing table of bounded size. A record whose
content is in the table is resolved; one that finds the table full goes, with
its content, to the spill files of the next level, where another hash deals the
records left. Once a table is full it takes no new content, so all copies of a
content are resolved at the same level.

A hot group of copies costs one record per task of the scan, not one per copy.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from ..session import materialise
from .common import SPACE, prepare, raw, signed

# Bytes of contents (and an allowance per entry) that a table holds at most.
TABLE_BYTES = 64 << 20
# Bytes of contents that a bucket of spill files holds on average.
BUCKET_BYTES = 32 << 20
ENTRY_BYTES = 200
# Bytes of contents in one Arrow batch handed back by a task.
SEND_BYTES = 8 << 20

KEPT = ("keep_id", "group_size", "kept", "text_sha256")


class ContentTable:
    """Contents by open addressing with linear probing. A slot holds the number
    of an entry; an entry matches if its hash and its complete content do."""

    def __init__(self, most: int):
        self.most, self.held = most, 0
        self.slots, self.hashes, self.contents = [-1] * 1024, [], []

    def place(self, key: int, content: bytes) -> int:
        """The entry of ``content``, made if it is new and there is room (the
        first one always has); -1 if there is none."""
        slots, mask = self.slots, len(self.slots) - 1
        at = key & mask
        while (entry := slots[at]) >= 0:
            if self.hashes[entry] == key and self.contents[entry] == content:
                return entry
            at = (at + 1) & mask
        size = len(content) + ENTRY_BYTES
        if self.contents and self.held + size > self.most:
            return -1
        self.held += size
        slots[at] = entry = len(self.contents)
        self.hashes.append(key)
        self.contents.append(content)
        if 2 * entry > mask:
            self._grow()
        return entry

    def _grow(self) -> None:
        self.slots = slots = [-1] * (4 * len(self.slots))
        mask = len(slots) - 1
        for entry, key in enumerate(self.hashes):
            at = key & mask
            while slots[at] >= 0:
                at = (at + 1) & mask
            slots[at] = entry


def content_hash(content: bytes) -> int:
    return xxhash.xxh3_64_intdigest(content)


class Best:
    """Of the copies of one content: how many, and which one stays (the most
    characters, then the smallest id, null last, then the first row met)."""

    __slots__ = ("n", "rank", "id", "row")

    def __init__(self):
        self.n, self.rank, self.id, self.row = 0, None, None, None

    def add(self, n: int, chars: int, doc_id, row: int) -> None:
        self.n += n
        rank = (-chars, doc_id is None, doc_id if doc_id is not None else 0, row)
        if self.rank is None or rank < self.rank:
            self.rank, self.id, self.row = rank, doc_id, row


def scan_contents(docs: DataFrame, carry: list[str]) -> DataFrame:
    """What the scan yields: a line per document (``ref`` leads to the record of
    its content), and a line per record, with hash and content, whose ``row``,
    ``doc_id`` and ``chars`` are those of the copy that stays."""
    id_field = StructField("doc_id", docs.schema["doc_id"].dataType)
    fields = [
        StructField("row", LongType()), StructField("ref", LongType()), id_field,
        *StructType.fromDDL("chars long, sha binary, hash long, content binary, n long").fields,
        *[StructField(c, docs.schema[c].dataType) for c in carry],
    ]
    schema = StructType(fields)
    arrow = to_arrow_schema(schema)
    given = docs.select(
        "doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("chars"), raw("text").alias("content"), *map(F.col, carry)
    )
    most = TABLE_BYTES

    def batch(size: int, *known) -> pa.RecordBatch:
        columns = [pa.nulls(size, f.type) for f in arrow]
        for at, values in known:
            columns[at] = values if isinstance(values, pa.Array) else pa.array(values, arrow.field(at).type)
        return pa.RecordBatch.from_arrays(columns, schema=arrow)

    def records(table: ContentTable, bests: list[Best], first: int):
        start = 0
        while start < len(bests):
            end, size = start, 0
            while end < len(bests) and (end == start or size < SEND_BYTES):
                size += len(table.contents[end])
                end += 1
            part = bests[start:end]
            yield batch(
                len(part),
                (0, [b.row for b in part]),
                (1, list(range(first + start, first + end))),
                (2, [b.id for b in part]),
                (3, [-b.rank[0] for b in part]),
                (5, [signed(h) for h in table.hashes[start:end]]),
                (6, table.contents[start:end]),
                (7, [b.n for b in part]),
            )
            start = end

    def run(batches):
        # Rows and records are numbered apart by task; 2**40 of them fit each.
        number = first = TaskContext.get().partitionId() << 40
        table, bests = ContentTable(most), []
        for given_batch in batches:
            ids = given_batch.column(0).to_pylist()
            chars = given_batch.column(1).to_pylist()
            rows, refs, shas = [], [], []
            for doc_id, size, text in zip(ids, chars, given_batch.column(2)):
                content = text.as_py().translate(None, SPACE)
                key = content_hash(content)
                entry = table.place(key, content)
                if entry < 0:
                    yield from records(table, bests, first)
                    first += len(bests)
                    table, bests = ContentTable(most), []
                    entry = table.place(key, content)
                if entry == len(bests):
                    bests.append(Best())
                bests[entry].add(1, size, doc_id, number)
                rows.append(number)
                refs.append(first + entry)
                shas.append(hashlib.sha256(content).digest())
                number += 1
            extra = [(8 + i, given_batch.column(3 + i).cast(arrow.field(8 + i).type)) for i in range(len(carry))]
            yield batch(len(rows), (0, rows), (1, refs), (2, ids), (3, chars), (4, shas), *extra)
        yield from records(table, bests, first)

    return given.mapInArrow(run, schema)


def resolve(left: DataFrame, id_type) -> DataFrame:
    """``ref, group_size, keep_row, keep_id`` of every record, level by level."""
    found, level = [], 0
    schema = StructType(
        [
            *StructType.fromDDL("ref long, hash long, content binary, n long, chars long, keep_row long").fields,
            StructField("keep_id", id_type),
        ]
    )
    arrow, most = to_arrow_schema(schema), TABLE_BYTES

    def send(columns):
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, arrow)], schema=arrow)

    def run(batches):
        table, bests, refs = ContentTable(most), [], []
        for given in batches:
            over = []
            contents = given.column(2)
            numbers = [given.column(i).to_pylist() for i in (0, 1, 3, 4, 5, 6)]
            for i, (ref, key, n, chars, row, doc_id) in enumerate(zip(*numbers)):
                entry = table.place(key & 0xFFFFFFFFFFFFFFFF, contents[i].as_py())
                if entry < 0:
                    over.append(i)
                    continue
                if entry == len(bests):
                    bests.append(Best())
                    refs.append([])
                bests[entry].add(n, chars, doc_id, row)
                refs[entry].append(ref)
            if over:
                over = pa.array(over)
                yield pa.RecordBatch.from_arrays([c.take(over) for c in given.columns], schema=arrow)
        flat = [(ref, b) for b, own in zip(bests, refs) for ref in own]
        for start in range(0, len(flat), 10_000):
            part = flat[start : start + 10_000]
            none = [None] * len(part)
            yield send(
                [[r for r, _ in part], none, none, [b.n for _, b in part], none, [b.row for _, b in part],
                 [b.id for _, b in part]]
            )

    while True:
        size = left.agg(F.sum(F.length("content") + F.lit(ENTRY_BYTES))).first()[0]
        if size is None:
            break
        buckets = size // BUCKET_BYTES + 1
        spilled = left.select(*schema.names).repartition(buckets, F.xxhash64("hash", F.lit(level)))
        out = materialise(spilled.mapInArrow(run, schema), f"copies-level-{level}")
        found.append(out.filter("content is null"))
        left, level = out.filter("content is not null"), level + 1
    whole = found[0] if found else left
    for part in found[1:]:
        whole = whole.unionByName(part)
    return whole.select("ref", F.col("n").alias("group_size"), "keep_row", "keep_id")


def exact_duplicates(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per document ``doc_id, keep_id, group_size, kept, text_sha256`` and the
    columns named in ``carry``.

    Documents are copies if their texts are identical without white space
    (``[\\x20\\x09-\\x0D]``); null counts as the empty text, so null, empty and
    blank texts are copies of each other. Of each group the one with the most
    characters stays, then the one of the smallest id (null last), then any one
    row: also among repeated rows exactly one is ``kept``. ``keep_id`` is the id
    of that row and may be null. ``text_sha256`` is the digest of the compared
    content. An empty table gives an empty result. Other columns of ``docs`` may
    have any names; of those carried, the ones called like a column of the
    result are left out.
    """
    carry = [c for c in carry if c in docs.columns and c not in ("doc_id", *KEPT)]
    judged, names = judge_copies(docs, carry)
    return judged.select("doc_id", *KEPT, *[F.col(n).alias(c) for c, n in zip(carry, names)])


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The row that stays of every group of copies, with all columns of ``docs``.

    Rules as in ``exact_duplicates``. The whole rows are written once more to
    the shared folder, since rows have no key that the scan could be asked for
    again.
    """
    judged, names = judge_copies(docs, docs.columns)
    return judged.filter("kept").select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names)])


def judge_copies(docs: DataFrame, carry: list[str]) -> tuple[DataFrame, list[str]]:
    """``doc_id``, the columns of the verdict and those of ``carry``, which get
    the names returned."""
    prepare(docs.sparkSession)
    names = [f"carried_{i}" for i in range(len(carry))]
    given = docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(n) for c, n in zip(carry, names)])
    scanned = materialise(scan_contents(given, names), "copies-scan")
    records = scanned.filter("hash is not null").select(
        "ref", "hash", "content", "n", "chars", F.col("row").alias("keep_row"), F.col("doc_id").alias("keep_id")
    )
    groups = resolve(records, docs.schema["doc_id"].dataType)
    lines = scanned.filter("hash is null").select("doc_id", "row", "ref", "sha", *names)
    judged = lines.join(groups, "ref").select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"), *names,
    )
    return judged, names
