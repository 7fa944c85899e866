"""Exact deduplication against brute force."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from starforge.llm import exact_dedup
from starforge.llm.exact_dedup import ContentTable, drop_exact_duplicates, exact_duplicates

BLANK = re.compile(r"[\x20\x09-\x0D]")


def wanted(rows):
    groups = {}
    for r in rows:
        groups.setdefault(BLANK.sub("", r["text"] or ""), []).append(r)
    out = []
    for content, own in groups.items():
        first = min(own, key=lambda r: (-len(r["text"] or ""), r["doc_id"] is None, r["doc_id"] or 0))
        digest = hashlib.sha256(content.encode()).hexdigest()
        stays = [True] + [False] * (len(own) - 1)
        order = sorted(own, key=lambda r: (r["text"] or "", str(r["doc_id"])) != (first["text"] or "", str(first["doc_id"])))
        out += [(r["doc_id"], first["doc_id"], len(own), k, digest) for r, k in zip(order, stays)]
    return sorted(map(repr, out))


def got(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def with_copies(odd):
    """The odd rows, copies that differ in white space only, and one content in a third of all rows."""
    copies = odd.withColumn("doc_id", F.col("doc_id") + 1000).withColumn("text", F.concat(F.lit(" \n"), "text"))
    hot = odd.withColumn("doc_id", F.col("doc_id") + 2000).withColumn("text", F.lit("hot copy of a text"))
    return odd.unionByName(copies).unionByName(hot).repartition(5)


def test_copies(odd):
    docs = with_copies(odd)
    assert got(exact_duplicates(docs)) == wanted(docs.collect())


def test_buckets_that_do_not_fit_go_to_further_levels(odd, monkeypatch):
    # Tables and buckets of some texts each, and a hash that tells few contents apart.
    monkeypatch.setattr(exact_dedup, "TABLE_BYTES", 1_500)
    monkeypatch.setattr(exact_dedup, "BUCKET_BYTES", 20_000)
    written = []
    write = exact_dedup.materialise
    monkeypatch.setattr(exact_dedup, "materialise", lambda df, label: written.append(label) or write(df, label))
    docs = with_copies(odd)
    assert got(exact_duplicates(docs)) == wanted(docs.collect())
    assert len(written) >= 3


def test_table_compares_complete_contents():
    table = ContentTable(10_000)
    contents = [b"%d" % i for i in range(300)]
    entries = [table.place(7, c) for c in contents[:40]]
    assert entries == list(range(40)) and table.place(7, contents[39]) == 39
    small = ContentTable(10)
    assert small.place(1, b"x" * 1000) == 0 and small.place(2, b"y") == -1 and small.place(1, b"x" * 1000) == 0
    wide = ContentTable(1 << 30)
    assert [wide.place(hash(c) & 0xFFFF, c) for c in contents * 20] == list(range(300)) * 20
    for i in range(5000):
        wide.place(i * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF, b"n%d" % i)
    assert wide.place(17 * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF, b"n17") == 317


@pytest.mark.parametrize("table", ["odd", "none"])
def test_whole_rows_stay_with_clashing_columns(table, request):
    docs = request.getfixturevalue(table)
    kept = drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    contents = [BLANK.sub("", r["text"] or "") for r in rows]
    assert len(set(contents)) == len(contents)
    assert set(contents) == {BLANK.sub("", r["text"] or "") for r in docs.collect()}
    assert exact_duplicates(docs, carry=("lang", "kept", "_row")).columns[-2:] == ["lang", "_row"]
