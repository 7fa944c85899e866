"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

from pyspark.sql import functions as F

from starforge.llm import periodic_runs as module
from starforge.llm.periodic_runs import collapse, periodic_runs, runs_of
from starforge.llm.queries import QUERIES

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def slow_runs(words):
    """Every maximal stretch of every period, longest first to find the smallest period."""
    n, out = len(words), []
    seen = {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            start, length = i, j + q - i
            if length >= max(6, 4 * q) and not any(q % d == 0 and s <= start and start + length <= e for d, s, e in seen.get(0, [])):
                seen.setdefault(0, []).append((q, start, start + length))
                out.append((start, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def tricky(rng):
    kind = rng.random()
    size = rng.randint(0, 60)
    if kind < 0.4:
        return [rng.choice([b"a", b"b"]) for _ in range(size)]
    if kind < 0.6:
        unit = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(1, 17))]
        noise = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 9))]
        return noise + (unit * 9)[: rng.randint(0, len(unit) * 9)] + noise[::-1] + unit * rng.randint(0, 5)
    if kind < 0.8:
        # Periods made of periods.
        inner = [rng.choice([b"a", b"b"]) for _ in range(rng.randint(1, 3))] * rng.randint(3, 6)
        return (inner + [b"x"]) * rng.randint(3, 6) + inner
    a, b = [b"a"], [b"b"]
    for _ in range(rng.randint(3, 8)):
        a, b = a + b, a
    return a


def test_runs_of_small_alphabets():
    rng = random.Random(5)
    texts = [tricky(rng) for _ in range(3000)]
    got = runs_of(texts)
    for text, runs in zip(texts, got):
        assert runs == slow_runs(text), b" ".join(text)
    assert sum(map(len, got)) > 1500


def test_seeds_stay_few_where_a_gram_fills_the_text():
    words = [b"w"] * 20_000
    assert runs_of([words, words[:5], [b"w"] * 6]) == [[(0, 20_000, 1)], [], [(0, 6, 1)]]
    assert collapse(words, [(0, 20_000, 1)]) == b"w"
    doc_of, ids = module.np.zeros(20_000, int), module.np.zeros(20_000, int)
    assert sum(len(places) for _, places, _ in module.bands(doc_of, ids)) <= 20_000


def planted(doc_id, text):
    words = WORDS.findall(text or "")
    if doc_id is not None and words:
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def wanted(r):
    words = planted(r["doc_id"], r["text"])
    runs = slow_runs(words) if len(words) < 3000 else runs_of([[w.encode() for w in words]])[0]
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    text = " ".join(w for i, w in enumerate(words) if i not in gone)
    milli = best[0] if best[0] is None else 1000 * best[1] // best[2]
    return (r["doc_id"], len(runs), *best, milli, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, text)))


def test_query(spark, odd, tmp_path):
    docs = odd.withColumn("doc_id", F.coalesce(F.col("doc_id") * 7, F.lit(None)))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op12_periodic_runs"](spark, str(tmp_path))
    want = [wanted(r) for r in docs.collect()]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert sum(w[1] > 0 for w in want) >= 5
    assert [t for _, t in got.dtypes][1:6] == ["bigint"] * 5


def test_whole_rows_in_small_chunks(odd, none, monkeypatch):
    monkeypatch.setattr(module, "CHUNK_WORDS", 50)
    out = periodic_runs(odd.withColumn("runs", F.lit("clash")))
    assert out.columns == [*odd.columns, "n_words", "runs", "collapsed"]
    for r in out.collect():
        words = WORDS.findall(r["text"] or "")
        assert r["n_words"] == len(words)
        if not r["runs"]:
            assert r["collapsed"] == " ".join(words)
    assert {r["collapsed"] for r in out.filter("text like 'w w w%'").collect()} == {"w"}
    assert periodic_runs(none).count() == 0
