"""Ranked lexical search against brute force."""

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from starforge.llm import lexical_search
from starforge.llm.lexical_search import build_index, ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    counted = [(r["doc_id"], Counter(terms(r["text"]))) for r in docs]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    n_docs, n_terms = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item in items:
        asked = Counter(terms(item["text"]))
        scored = []
        for doc, c, n in counted:
            m = 25 + 75 * n * n_docs // n_terms
            score = 0
            for t, times in asked.items():
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += times * w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        scored.sort(key=lambda s: s[:3])
        out += [(item["item_id"], i + 1, s[3], -s[0]) for i, s in enumerate(scored[:k])]
    return out


def items_of(spark):
    texts = ["alpha beta GAMMA gamma zeta", "Éta lambda ed", "unheard", "", None, "w", "one two words x one", "shared footer line"]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(None, "kappa sigma", ""), (0, texts[0], "repeat")]
    return spark.createDataFrame(rows, "item_id long, text string, score string")


def check(docs, items, k):
    got = [tuple(r) for r in ranked_search(docs, items, k).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute(docs.collect(), items.collect(), k)))
    return got


def test_search_with_ties_nulls_and_repeats(spark, odd):
    copies = odd.unionByName(odd.withColumn("doc_id", F.col("doc_id") + 500)).unionByName(odd.filter("doc_id < 12"))
    assert len(check(copies, items_of(spark), 10)) > 50


def test_many_blocks_and_groups_of_items(spark, odd, monkeypatch):
    monkeypatch.setattr(lexical_search, "BLOCK_DOCS", 2)
    monkeypatch.setattr(lexical_search, "PAIRS_AT_ONCE", 8)
    check(odd, items_of(spark), 3)
    # Strata of one normaliser and every document of the corpus are in the index.
    index = build_index(odd.select("doc_id", "text"))
    sizes = index.blocks.select("m", F.size("ids").alias("n"))
    assert sizes.agg(F.sum("n")).first()[0] == index.docs == sum(bool(terms(r["text"])) for r in odd.collect())
    assert sizes.count() > sizes.select("m").distinct().count()


def test_bounds_leave_blocks_out(spark, monkeypatch):
    rows = [(i, "rare " * 3 + "common " * 5 if i < 12 else "common " * (i % 40 + 2)) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    index = build_index(docs)
    items = [{"row": 0, "key": 1, **dict(zip(("terms", "tfs"), terms_of(b"rare common")))}]
    asked = lexical_search.asked_items(items, {0: 100, 1: 100})
    visited = []
    best = lexical_search.Best(10, 1)
    blocks = [lexical_search.Block(r.asDict(), asked.terms) for r in index.blocks.collect()]
    bounds = [sum(w * int(b.tops[q]) for q, w in asked.weighed[0]) for b in blocks]
    for bound, block in sorted(zip(bounds, blocks), key=lambda x: -x[0]):
        if bound < best.floor:
            break
        visited.append(bound)
        best.add(block, block.scores(asked.weighed[0], best.floor))
        assert max(block.scores(asked.weighed[0], 0)) <= bound
    assert 0 < len(visited) < len(blocks) / 4
    assert [r[3] for r in best.rows] == list(range(10))


def terms_of(text):
    counts = Counter(text.split())
    hashes = sorted((lexical_search.xxhash.xxh3_64_intdigest(t), n) for t, n in counts.items())
    return (
        lexical_search.np.array([h for h, _ in hashes], "uint64").tobytes(),
        lexical_search.np.array([n for _, n in hashes], "uint32").tobytes(),
    )


def test_empty_tables(spark, none):
    items = items_of(spark)
    assert ranked_search(none, items).count() == 0
    assert ranked_search(none.withColumn("text", F.lit("alpha")), items.limit(0)).count() == 0
    assert dict(ranked_search(none, items).dtypes) == {
        "item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"
    }
