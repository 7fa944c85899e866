"""Operators that relate documents or vectors, against brute force, and the pipeline."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starforge.llm import components, line_dedup, near_dup
from starforge.llm.components import connected_components
from starforge.llm.line_dedup import PerfectHash, drop_common_lines
from starforge.llm.mixing import mix_sources
from starforge.llm.near_dup import HASHES, drop_near_duplicates, keys_of, near_duplicates
from starforge.llm.packing import pack_documents, pack_shard
from starforge.llm.pivot_search import exact_top_k
from starforge.llm.queries import ORACLE, QUERIES

SPACE = " \t\n\x0b\x0c\r"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def test_perfect_hash_is_minimal_and_exact():
    rng = np.random.default_rng(3)
    high = rng.integers(0, 1 << 63, 5000).astype(np.uint64)
    low = rng.integers(0, 1 << 63, 5000).astype(np.uint64)
    high[1], low[3] = high[0], low[2]
    counts = rng.integers(1, 400, 5000)
    table = PerfectHash.unpack(PerfectHash.build(high, low, counts, 255).pack())
    placed = table.index(high)
    assert sorted(placed[placed >= 0]) == list(range(4998)) and set(np.flatnonzero(placed < 0)) == {0, 1}
    assert (table.count(high, low) == np.minimum(counts, 255)).all()
    others = table.count(rng.integers(0, 1 << 63, 20000).astype(np.uint64), rng.integers(0, 1 << 63, 20000).astype(np.uint64))
    assert (others > 0).mean() < 0.01


@pytest.mark.parametrize("least", [2, 10])
def test_common_lines(odd, least):
    rows = odd.collect()
    key = lambda line: lower(line.strip(SPACE))
    found = Counter(k for r in rows for k in {key(x) for x in (r["text"] or "").split("\n")} if k)

    def want(r):
        lines = (r["text"] or "").split("\n")
        kept = [x for x in lines if not key(x) or found[key(x)] < least]
        return repr((r["doc_id"], "\n".join(kept), len(lines), len(lines) - len(kept), r["score"]))

    out = drop_common_lines(odd, least)
    assert out.columns.count("n_lines") == 1 and "_row" in out.columns
    got = [repr((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"], r["score"])) for r in out.collect()]
    assert sorted(got) == sorted(map(want, rows))


def test_common_lines_of_shards_in_several_copies(odd, monkeypatch):
    want = sorted(map(repr, drop_common_lines(odd, 10).select("doc_id", "text", "n_dropped").collect()))
    monkeypatch.setattr(line_dedup, "PROBES", 4)
    monkeypatch.setattr(line_dedup, "COPY_SHARE", 0.0)
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 50)
    out = drop_common_lines(odd, 10).select("doc_id", "text", "n_dropped")
    assert sorted(map(repr, out.collect())) == want
    assert out.filter("n_dropped > 0").count() >= 10


def test_every_common_line_is_decided_by_a_shard(spark, folder, monkeypatch):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    # Shards that know no count call nothing common, so no other way can.
    assert drop_common_lines(docs, 10).filter("n_dropped > 0").count() > 0
    monkeypatch.setattr(line_dedup.PerfectHash, "count", lambda self, high, low: np.zeros(len(high), np.int64))
    assert drop_common_lines(docs, 10).filter("n_dropped > 0").count() == 0


def groups(rows):
    """Component ids by comparing all pairs."""
    sets = []
    for r in rows:
        words = WORDS.findall(lower(r["text"] or ""))
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    ids: dict = {}
    for i, r in enumerate(rows):
        if r["doc_id"] is not None:
            ids[root(i)] = min(ids.get(root(i), r["doc_id"]), r["doc_id"])
    return [len(s) for s in sets], [ids.get(root(i)) for i in range(len(rows))], [root(i) for i in range(len(rows))]


def test_near_duplicates(odd):
    rows = odd.collect()
    n, component, _ = groups(rows)
    want = [
        repr((r["doc_id"], k, c if k else r["doc_id"], (r["doc_id"] == c) if c is not None and r["doc_id"] is not None else c is None))
        for r, k, c in zip(rows, n, component)
    ]
    got = [repr((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"])) for r in near_duplicates(odd).collect()]
    assert sorted(got) == sorted(want)


def test_one_row_of_each_group_stays(odd, none):
    rows = odd.collect()
    n, _, root = groups(rows)
    out = drop_near_duplicates(odd)
    assert out.columns == odd.columns
    assert out.count() == len({c for c, k in zip(root, n) if k}) + sum(k == 0 for k in n)
    assert drop_near_duplicates(none).count() == 0 and near_duplicates(none).count() == 0


def test_near_duplicates_of_a_large_group(spark):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for g in range(3):
        own = [f"{w}g{g}" if i % 9 == 0 else w for i, w in enumerate(base)]
        for _ in range(60):
            copy = list(own)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(120)] = f"edit{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = docs.orderBy("doc_id").collect()
    _, component, _ = groups(rows)
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs).collect()}
    assert [got[i] for i in range(len(texts))] == component


def test_keys_cover_every_pair_within_the_distance():
    rng = np.random.default_rng(1)
    sigs = rng.integers(0, 1 << 16, (300, HASHES)).astype(np.uint16)
    near = sigs.copy()
    for row in near:
        at = rng.permutation(HASHES)[:31]
        row[at] ^= 1
    assert all((a == b).any() for a, b in zip(keys_of(sigs), keys_of(near)))


@pytest.mark.parametrize("chunk", [10, 200_000])
def test_components_of_a_path_and_a_star(spark, monkeypatch, chunk):
    monkeypatch.setattr(components, "CHUNK", chunk)
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(3, 3)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert {got[i] for i in range(100, 161)} == {100} and {got[i] for i in range(200, 260)} == {7}


def test_mixing_reaches_targets(odd, none):
    rng = random.Random(2)
    spark = odd.sparkSession
    names = ["a", "b", "é", "z", None]
    rows = [(i, " ".join("w" * rng.randint(1, 60)), names[min(4, rng.randrange(9))]) for i in range(600)]
    out = mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    got = out.collect()
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    sizes, taken, target = Counter(), Counter(), {}
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    open_, left, want = dict(zip(names, [3, 1, 2, 3, 1])), 1.5 * sum(sizes.values()), {}
    while open_:
        level = left / sum(open_.values())
        full = [s for s, w in open_.items() if w * level > 2 * sizes[s]]
        for s in full or list(open_):
            want[s] = 2.0 * sizes[s] if full else open_[s] * level
            left -= want[s] if full else 0
            del open_[s]
    assert all(abs(target[s] - want[s]) < 1e-6 for s in names)
    assert all(abs(taken[s] - want[s]) <= 1 + len(names) for s in names)
    assert sorted(map(repr, got)) == sorted(map(repr, mix_sources(out.drop("size").repartition(7)).select(out.columns).collect()))
    mixed = mix_sources(odd)
    assert mixed.count() == odd.count() and mixed.columns.count("size") == 1
    assert sorted(map(str, mixed.select("doc_id", "kept").collect())) == sorted(map(str, odd.select("doc_id", "kept").collect()))
    assert mix_sources(none).count() == 0


def check_bins(out, capacity, max_sources):
    bins: dict = {}
    for r in out:
        if r["bin"] is None:
            assert r["size"] == 0
            continue
        bins.setdefault((r["shard"], r["bin"]), []).append(r)
    for rows in bins.values():
        assert sum(r["size"] for r in rows) <= capacity
        assert len({r["source"] for r in rows}) <= max_sources
    return bins


def test_packing_keeps_the_constraints(odd, none):
    out = pack_documents(odd, capacity=1000, max_sources=2, shard_rows=50).collect()
    texts = {}
    for r in odd.collect():
        texts.setdefault(r["doc_id"], WORDS.findall(r["text"] or ""))
    bins = check_bins(out, 1000, 2)
    for rows in bins.values():
        named = [" ".join(texts[r["doc_id"]]) for r in rows if r["doc_id"] is not None]
        assert len(named) == len(set(named))
    whole = Counter()
    for r in out:
        whole[r["doc_id"]] += r["size"]
    times = Counter(r["doc_id"] for r in odd.collect())
    assert all(whole[i] == len(texts[i]) * times[i] for i in texts if i is not None)
    assert pack_documents(none).count() == 0


def test_packing_is_best_fit(spark):
    docs = spark.createDataFrame([(i, "w " * n, "s") for i, n in enumerate([60, 50, 45, 40])], "doc_id long, text string, source string")
    got = {r["doc_id"]: r["bin"] for r in pack_documents(docs, capacity=100).collect()}
    assert got[0] == got[3] and got[1] == got[2] and got[0] != got[1]


def test_packing_keeps_near_copies_apart(spark, odd, tmp_path):
    words = [f"w{i}" for i in range(60)]
    edited = [*words[:59], "edit"]
    texts = [" ".join(words), " ".join(words).upper(), " ".join(edited), " ".join(f"v{i}" for i in range(60))]
    at = f"{tmp_path}/documents.parquet"
    spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string").write.parquet(at)
    bins = {r["doc_id"]: r["bin"] for r in QUERIES["op3_best_fit_packing"](spark, str(tmp_path)).collect()}
    assert len({bins[i] for i in range(3)}) == 3 and bins[3] in {bins[i] for i in range(3)}

    rows = odd.collect()
    group = {}
    for r, g, n in zip(rows, groups(rows)[2], groups(rows)[0]):
        group.setdefault(r["doc_id"], set()).update({g} if n else ())
    out = pack_documents(odd, capacity=100_000, max_sources=9, near_copies=True).collect()
    assert sum(r["size"] for r in out) == sum(len(WORDS.findall(r["text"] or "")) for r in rows)
    for held in check_bins(out, 100_000, 9).values():
        inside = [next(iter(group[r["doc_id"]])) for r in held if len(group[r["doc_id"]]) == 1]
        assert len(inside) == len(set(inside))


def test_packing_by_given_clusters(spark):
    rows = [(0, "a b c", "s", 5), (1, "d e f", "s", 5), (2, "g h", "s", None), (3, "g h", "s", None), (4, "g h", "s", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, group long")
    bins = {r["doc_id"]: r["bin"] for r in pack_documents(docs, cluster="group").collect()}
    assert bins[0] != bins[1] and bins[2] != bins[3] and len(set(bins.values())) == 2


def test_pivot_search(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(0, 0.4, 8)], i) for i in range(400)]
    rows += [(500 + i, rows[i % 7][1], 0) for i in range(30)] + [rows[3], (100, rows[0][1], 0)]
    rows += [(600, None, 0), (None, rows[1][1], 0), (650, [0.1, None], 0), (700, [float("nan")], 0), (750, [], 0), (800, [2e9] * 8, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score long")
    ok = [(i, np.floor(np.array(v, float) * 256).astype(object)) for i, v, _ in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    ok = [(i, [int(x) for x in v]) for i, v in ok]
    queries: dict = {}
    for i, v in ok:
        if i % 50 == 0:
            queries[i] = min(queries.get(i, v), v)
    want = set()
    for q, v in queries.items():
        scores = sorted((-sum(a * b for a, b in zip(v, x)), i) for i, x in ok if i != q)[:5]
        want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(scores)}
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(batch, "123")
    got = exact_top_k(df, n_pivots=8)
    assert spark.conf.get(batch) == "123"
    assert {tuple(r) for r in got.collect()} == want
    assert exact_top_k(df.filter("false")).count() == 0
    assert [tuple(r) for r in exact_top_k(df.filter("vec_id = 50")).collect()] == []


@pytest.fixture(scope="module")
def folder(spark, odd, labels, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    odd.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{at}/documents.parquet")
    labels.write.parquet(f"{at}/labels.parquet")
    return at


def test_pipeline_stages(spark, folder):
    docs = before = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == before.columns, name
        path = f"{folder}/{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    assert docs.filter("trim(text) = ''").count() == 0
    check_bins(corpus_pipeline.run(spark, folder).collect(), 8192, 8)


def test_pipeline_on_an_empty_table(spark, folder, tmp_path):
    at = str(tmp_path)
    spark.read.parquet(f"{folder}/documents.parquet").filter("false").write.parquet(f"{at}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(f"{at}/labels.parquet")
    assert corpus_pipeline.run(spark, at).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_match_their_sql(spark, name):
    at = "/root/testdata/sf0.001"
    got = QUERIES[name](spark, at).toPandas()
    con = duckdb.connect()
    for table in ("documents", "labels", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{at}/{table}.parquet'")
    want = con.execute(ORACLE[name]).df()
    columns = sorted(want.columns)
    assert columns == sorted(got.columns)
    rows = lambda df: sorted(map(repr, df[columns].astype(object).itertuples(index=False, name=None)))
    assert rows(got) == rows(want)


def test_every_operator_has_a_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLE) <= set(QUERIES)


def random_members(rng, sizes):
    """Groups of one bucket each, whose signatures differ in some places."""
    columns = [[] for _ in range(9)]
    for g, size in enumerate(sizes):
        base = rng.integers(0, 1 << 16, HASHES).astype(np.uint16)
        key = int(keys_of(base[None, :])[0][0])
        split = rng.random() < 0.4
        for _ in range(size):
            sig = base.copy()
            at = rng.permutation(np.arange(4, HASHES))[: rng.integers(0, 40)]
            sig[at] ^= 1
            row = (key, 0, int(split), int(rng.integers(0, 2)) if split else -1, int(rng.integers(-(1 << 40), 1 << 40)),
                   int(rng.integers(0, 3)), int(rng.integers(80, 120)), int(rng.integers(70, 80)), sig)
            for column, value in zip(columns, row):
                column.append(value)
    return near_dup.Members(*(np.array(c) for c in columns))


@pytest.mark.parametrize("most", [None, 2])
def test_small_groups_give_the_pairs_of_large_ones(most):
    rng = np.random.default_rng(9)
    sizes = rng.integers(2, near_dup.SMALL + 1, 300)
    m = random_members(rng, sizes)
    starts = m.starts()
    assert np.diff(starts, append=len(m.key)).tolist() == sizes.tolist()
    pairs = lambda found: Counter(frozenset((a, b)) for a, to in found for b in to)
    got = near_dup.compare_small(m, sizes, most)
    want = []
    for start, size in zip(starts.tolist(), sizes.tolist()):
        g = m.rows(slice(start, start + size))
        want += near_dup.compare_group(g.key[0], g.ids, g.components, g.n, g.shared, g.sigs, g.side, None)
    if most is None:
        assert pairs(got) == pairs(want) and len(got) > 50
    else:
        assert all(len(to) <= most for _, to in got) and set(pairs(got)) <= set(pairs(want))


def test_a_shingle_and_a_bucket_in_all_documents(spark, monkeypatch):
    """A passage that all texts have, and signatures that all fall in one bucket."""
    rng = random.Random(11)
    passage = " ".join(f"licence{i}" for i in range(12))
    texts = []
    for i in range(90):
        own = [f"t{i // 3}x{j}" for j in range(60)]
        if i % 3:
            own[rng.randrange(60)] = f"edit{i}"
        texts.append(" ".join(own) + " " + passage)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    _, component, _ = groups(docs.orderBy("doc_id").collect())
    plain = near_dup.keys_of

    def one_bucket(sigs):
        keys = plain(sigs)
        keys[:, 0] = 5
        return keys

    monkeypatch.setattr(near_dup, "keys_of", one_bucket)
    monkeypatch.setattr(near_dup, "BLOCK", 20)
    monkeypatch.setattr(near_dup, "BLOCK_SHINGLES", 500)
    monkeypatch.setattr(near_dup, "ASKING", 3)
    monkeypatch.setattr(near_dup, "COPY_SHARE", 0.0)
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs).collect()}
    assert [got[i] for i in range(len(texts))] == component


def plain_best_fit(rows, capacity, max_sources):
    """Every piece, largest first, into the fullest bin that takes it."""
    pieces = sorted(
        ((-min(capacity, size - start), key, p, i, source, cluster)
         for i, (key, source, cluster, size) in enumerate(rows) for p, start in enumerate(range(0, size, capacity)))
    )
    bins, out = [], {}
    for size, key, p, i, source, cluster in pieces:
        size = -size
        fits = [
            (b["room"], n) for n, b in enumerate(bins)
            if b["room"] >= size and cluster not in b["clusters"] and len(b["sources"] | {source}) <= max_sources
        ]
        if fits:
            n = min(fits)[1]
        else:
            n = len(bins)
            bins.append({"room": capacity, "sources": set(), "clusters": set()})
        bins[n]["room"] -= size
        bins[n]["sources"].add(source)
        bins[n]["clusters"].add(cluster)
        out[i, p] = n
    return out


def test_successor_search_is_a_plain_best_fit():
    rng = random.Random(3)
    for _ in range(60):
        n = rng.randint(1, 120)
        rows = [(rng.randrange(10**6), f"s{rng.randrange(6)}", rng.randrange(max(1, n // 2)), rng.randint(1, 260)) for _ in range(n)]
        got = {(i, p): b for i, p, _, _, b in pack_shard(rows, 100, 3)}
        assert got == plain_best_fit(rows, 100, 3)


def test_only_sets_of_listed_classes_are_shuffled(spark, monkeypatch):
    """Of many sets the joins get those that a list names, and a row of a bucket is two numbers."""
    written = {}
    write = near_dup.materialise

    def kept(df, label):
        out = write(df, label)
        written.setdefault(label, []).append((out.columns, out.count()))
        return out

    monkeypatch.setattr(near_dup, "materialise", kept)
    sets = [(c * 1_000_003, list(range(c // 2 * 100, c // 2 * 100 + 50))) for c in range(400)]
    lists = [(1_000_003, [0, 5 * 1_000_003]), (7 * 1_000_003, [6 * 1_000_003])]
    links = near_dup.confirm(
        spark.createDataFrame(lists, "a long, to array<long>"),
        spark.createDataFrame(sets, "class long, found array<long>"),
        400 * 50,
    )
    assert sorted(map(tuple, links.collect())) == [(1_000_003, 0), (7 * 1_000_003, 6 * 1_000_003)]
    assert 5 <= written["near-listed"][0][1] <= 20
    hashes = [(-(1 << 63), [(1 << 63) - 1, -1]), (63 << 20, [])]
    bitmap = near_dup.hash_bitmap(spark.createDataFrame(hashes, "a long, to array<long>"))
    asked = np.array([-(1 << 63), (1 << 63) - 1, -1, 63 << 20, 1, 62 << 20])
    assert near_dup.in_bitmap(bitmap, asked).tolist() == [True] * 4 + [False] * 2

    # Four groups of similar texts, and texts that share nothing.
    texts = [" ".join([f"g{i % 4}w{j}" for j in range(80)] + [f"own{i}"]) for i in range(16)]
    texts += [" ".join(f"a{i}w{j}" for j in range(80)) for i in range(16)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs).collect()}
    assert got == {i: i % 4 if i < 16 else i for i in range(32)}
    assert written["near-members"][0][0] == ["key", "class"]
    assert written["near-listed"][1][1] >= 16
