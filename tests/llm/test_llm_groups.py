"""Operators across rows: mixing, near-duplicates, neighbours, sharding, and the pipeline."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, source string, rank int, shard string"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, "a b c d e f", "x", 1, "s"), (2, None, None, None, None), (3, "", "y", 1, "s"), (None, "one two three", "x", 1, "s"), (4, "w " * 30000, "z", 2, "s"),
            (5, "a b c d e f", None, 1, "s"), (6, "p q", "y", 1, "s"), (6, "p q", "y", 1, "s"), (7, " \t\n", "v", 1, "s"), (None, "one two three", "x", 1, "s")]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


# -- 1 ------------------------------------------------------------------------------

def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes, weights=(5, 2, 1), epochs=3):
    """Share by weight, clamp, share the excess again, until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    clamped, total = set(), sum(sizes.values())
    while True:
        free = [s for s in order if s not in clamped]
        left = total - sum(epochs * sizes[s] for s in clamped)
        target = {s: epochs * sizes[s] for s in clamped} | {s: left * w[s] / sum(w[f] for f in free) for s in free}
        over = {s for s in free if target[s] >= epochs * sizes[s]}
        if not over:
            return target
        clamped |= over


@pytest.mark.parametrize("seed", range(3))
def test_mix_as_brute_force(spark, seed):
    from hirelake.llm.mixing import mix, mixed
    rnd = random.Random(seed)
    rows = []
    for s in [None, "", "A", "a", "é", "😀", "b", "c"]:
        rows += [(len(rows) + i, " ".join(["w"] * rnd.choice((0, 1, 5, 60, 300))), s) for i in range(rnd.choice((1, 3, 30)))]
    rows += [(10**6, "w " * 20000, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += size(t)
    target = brute_targets(sizes)
    source = {i: s for i, _, s in rows}
    got = mix(docs).collect()
    taken = defaultdict(int)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and abs(r.target - target[s]) < 1e-6 * max(1, target[s])
        assert 0 <= r.taken <= 3 * r["size"]
        taken[s] += r.taken
    assert all(abs(taken[s] - target[s]) <= 0.5 + 1e-6 for s in sizes)
    assert Counter(map(tuple, got)) == Counter(map(tuple, mix(docs.repartition(7)).collect()))
    words = defaultdict(int)
    for r in mixed(docs).collect():
        words[r.source] += size(r.text)
    largest = {s: max(size(t) for _, t, x in rows if x == s) for s in sizes}
    assert all(abs(words[s] - target[s]) <= 0.5 + largest[s] / 2 for s in sizes)


def test_mix_odd_rows(spark, odd, none):
    from hirelake.llm.mixing import mix, mixed
    assert mix(none).count() == 0 and mixed(none).count() == 0
    got = mix(odd).collect()
    assert len(got) == 10 and {r["size"] for r in got if r.doc_id in (2, 3, 7)} == {0}
    assert mixed(odd).columns == odd.columns


# -- 6 ------------------------------------------------------------------------------

def brute_near(rows, width, percent):
    def shingles(text):
        w = (text or "").encode().lower().split()
        return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    sets = [(i, shingles(t)) for i, t in rows]
    group = {i: i for i, _ in rows if i is not None}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x
    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((root(a), root(b)))
                group[q] = p
    return Counter((i, len(x), None if i is None else root(i), i is None or root(i) == i) for i, x in sets)


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_as_brute_force(spark, odd, none, width, percent):
    from hirelake.llm.near_duplicates import near_duplicates
    rnd = random.Random(width)
    passage = [f"p{i}" for i in range(60)]
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    for base in range(6):  # families of edited copies around the threshold, all sharing a passage
        words = passage * (base % 2) + [f"b{base}w{rnd.randrange(400)}" for _ in range(rnd.choice((12, 80, 150)))]
        for _ in range(45):
            copy = [w if rnd.random() > rnd.choice((0.01, 0.03, 0.05)) else f"e{rnd.random()}" for w in words]
            rows.append((100 + len(rows), " ".join(copy).upper() if rnd.random() < 0.1 else " ".join(copy)))
    rows += [(1000 + i, " ".join(passage + [f"u{i}.{j}" for j in range(rnd.randrange(3, 40))])) for i in range(60)]
    rows += [(2000 + i, "exactly the same few words here") for i in range(40)] + [(50, "Exactly the same few words here")]
    rows += [(3000 + i, f"short {i % 5}") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = Counter(tuple(r) for r in near_duplicates(docs, width, percent).select("doc_id", "n_shingles", "component_id", "kept").collect())
    assert got == brute_near(rows, width, percent)
    if width == 5:
        assert near_duplicates(none).count() == 0


def test_components_long_path(spark):
    from hirelake.llm.near_duplicates import components
    ids = list(range(300))
    random.Random(1).shuffle(ids)
    links = spark.createDataFrame([*zip(ids, ids[1:]), (500, 501), (501, 499)], "a long, b long")
    got = {r.rep: r.comp for r in components(links).collect()}
    assert got == {i: 0 for i in ids} | {500: 499, 501: 499, 499: 499}


# -- 5 ------------------------------------------------------------------------------

def test_search_recall_ties_and_odd_vectors(spark):
    from hirelake.llm.multi_index import search
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 8)).astype("float32")
    x[300:700] = x[20]  # a very common vector, among it queries
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    bad = [(2000, None), (2020, [0.0] * 8), (2040, [1.0] * 7 + [None]), (2060, [float("nan")] * 8), (2080, [float("inf")] * 8), (2100, []), (None, [1.0] * 8)]
    vectors = spark.createDataFrame([(i, v, 1) for i, v in rows + bad + rows[:50]], "vec_id long, embedding array<float>, rank int")
    got = defaultdict(list)
    for r in search(vectors, centroids=16).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert set(got) == set(range(0, 1500, 20))
    y, hit = x.astype(float), 0
    for q, found in got.items():
        s = y @ y[q]
        s[q] = -np.inf
        want = np.lexsort((np.arange(len(s)), -np.round(s, 9)))[:20]
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21)) and all(abs(s[v] - c) < 1e-9 for _, v, c in found)
        assert [(-c, v) for _, v, c in found] == sorted((-c, v) for _, v, c in found)
        hit += len(set(want.tolist()) & {v for _, v, _ in found})
    assert hit / 20 / len(got) >= 0.9
    common = [v for _, v, _ in got[400]]
    assert common[:20] == sorted(common[:20]) and common[0] == 20  # equal vectors by id


def test_search_few_vectors(spark):
    from hirelake.llm.multi_index import Index, search
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert search(none).count() == 0
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, [0.0, 1.0])], "vec_id long, embedding array<float>")
    got = [tuple(r) for r in search(few).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 0.5), (0, 2, 20, 0.0), (20, 1, 1, 0.5), (20, 2, 0, 0.0)]
    assert search(few.where("vec_id = 0")).count() == 0
    rng = np.random.default_rng(0)
    index, q = Index(rng.normal(size=(9, 3)), rng.normal(size=(7, 3))), rng.normal(size=6)
    cost = [-(index.one[i] @ q[:3]) - (index.two[j] @ q[3:]) for i, j in index.visits(q)]
    assert len(cost) == 63 and np.all(np.diff(cost) >= -1e-12)


# -- 9 ------------------------------------------------------------------------------

def test_shards(spark, odd, none, tmp_path):
    from hirelake.llm.sharding import first_map, grown, read_map, rebalanced, shard, write_shards
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    path = str(tmp_path / "map")
    out = shard(docs, map_path=path)
    got = out.collect()
    places, total, home = defaultdict(list), Counter(), {}
    for r in got:
        data = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "bytes", None)
        places[r["shard"]].append(r["slot"])
        total[r["shard"]] += r["size"]
        assert home.setdefault(r.virtual_slot, r["shard"]) == r["shard"]
    assert len(got) == len(texts) and all(sorted(p) == list(range(len(p))) for p in places.values())
    assert set(total) == set(range(8)) and max(total.values()) <= 1.01 * min(total.values())
    assert {r["slot"]: r["shard"] for r in read_map(spark, path, 1).collect()} == dict(enumerate(first_map(4096, 8)))
    with pytest.raises(Exception, match="(?i)exist"):
        shard(docs, map_path=path)
    load = [random.Random(i).randrange(100) for i in range(512)]
    even = rebalanced(first_map(512, 8), load, 8)
    more = grown(even, load, 8)
    assert all(a == b or b == 8 for a, b in zip(even, more)) and more.count(8) > 0
    held = Counter()
    for s, k in enumerate(more):
        held[k] += load[s]
    assert max(held.values()) - min(held.values()) <= 9 * max(load)
    assert shard(none).count() == 0
    r = shard(odd).collect()
    assert len(r) == 10 and sum(x["size"] == 1 and x.text_crc32 == 0 for x in r) == 2
    files = str(tmp_path / "files")
    write_shards(docs, out, files)
    assert Counter(x["shard"] for x in spark.read.parquet(files).collect()) == Counter(x["shard"] for x in got)


# -- pipeline -----------------------------------------------------------------------

def test_pipeline_stages_as_brute_force(spark, odd):
    import corpus_pipeline
    from hirelake.llm.common import documents, written
    from hirelake.llm.sentencepiece_bpe import load
    from tests_llm_rules import spans_redacted
    docs = documents(spark, SF)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "near_dedup", "personal_data", "source_mix", "sentencepiece"]
    junk = spark.createDataFrame([(9001, "12 34 !!", "en", "src0", 8), (9002, None, None, None, None), (9003, "привет мир", "en", "src1", 10)], docs.schema)
    docs = docs.union(junk)
    one = written(stages["language_id"](spark, docs, SF), "t1")
    assert one.columns == docs.columns and {r.doc_id for r in docs.collect()} - {r.doc_id for r in one.collect()} == {9001, 9002, 9003}
    two = written(stages["near_dedup"](spark, one, SF), "t2")
    near = brute_near([(r.doc_id, r.text) for r in one.collect()], 5, 80)
    assert {r.doc_id for r in two.collect()} == {k[0] for k in near if k[3]} and two.count() < one.count()
    three = written(stages["personal_data"](spark, two, SF), "t3")
    before, changed = {r.doc_id: r for r in two.collect()}, 0
    for r in three.collect():
        want = spans_redacted(before[r.doc_id].text)
        assert r.text == want and r.n_chars == len(want) and (r.lang, r.source) == (before[r.doc_id].lang, before[r.doc_id].source)
        changed += want != before[r.doc_id].text
    assert changed
    four = written(stages["source_mix"](spark, three, SF), "t4")
    sizes, taken = Counter(), Counter()
    for r in three.collect():
        sizes[r.source] += size(r.text)
    for r in four.collect():
        taken[r.source] += size(r.text)
    largest = max(size(r.text) for r in three.collect())
    target = brute_targets(sizes)
    assert four.columns == docs.columns and all(abs(taken[s] - target[s]) <= 0.5 + largest / 2 for s in sizes)
    lib = load(P.path("piece_bpe_32k.model")).library
    want = Counter()
    for r in four.collect():
        ids = lib.encode(r.text)
        want[(r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(lib.decode(ids).encode()).hexdigest(), 0)] += 1
    assert Counter(tuple(r) for r in stages["sentencepiece"](spark, four, SF).collect()) == want


def test_pipeline_odd_rows(spark):
    import corpus_pipeline
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    odd = spark.createDataFrame([(1, None, None, None, None), (None, "the and of", "en", None, 9), (3, "", "en", "s", 0), (4, "the and of", "en", "s", 1), (4, "the and of", "en", "s", 1)], schema)
    for docs in (odd, spark.createDataFrame([], schema)):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = stage(spark, docs, SF)
            assert k == 4 or docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs.collect()


def test_entry_without_llm(tmp_path):
    """Without the operators and the pipeline the entry still gives all other queries."""
    import shutil
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    copy = tmp_path / "repo"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert q and 'pipeline' not in q and not [x for x in q if x.startswith('op')]; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
