"""Operators on single texts: tokens, languages, fingerprints, personal data, licences."""

import hashlib
import random
import zlib
from collections import Counter

import pytest
from tests_llm_rules import PATTERNS, base_spans

pytest.importorskip("sentencepiece")
P = pytest.importorskip("public_tokenizers")

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, spans int"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names operators use themselves."""
    rows = [(1, "The house  is on the hill.\n", "en", "a", 5, "x", 1), (2, None, None, None, None, None, None), (3, "", "en", "a", 0, "x", 1),
            (None, "no id here", "en", None, 3, None, 2), (4, "ab" * 30000 + " x", "de", "b", 1, "x", 1), (5, " ▁ ﬁ \x00é😀日本 ", "fr", "b", 1, "x", 1),
            (6, "same text", "en", "a", 9, "x", 1), (6, "same text", "en", "a", 9, "x", 1), (-7, "12345 !!", None, "b", 8, "x", 1)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


# -- 10 -----------------------------------------------------------------------------

def test_pieces_as_the_library(spark, odd, none):
    from hirelake.llm.sentencepiece_bpe import decode, encode, encode_digests, load
    path = P.path("piece_bpe_32k.model")
    lib = load(path).library
    got = Counter(tuple(r) for r in encode_digests(odd, path).collect())
    want = Counter()
    for r in odd.collect():
        ids = lib.encode(r.text or "")
        want[(r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(lib.decode(ids)), 0)] += 1
    assert got == want
    assert {(r.doc_id, tuple(r.ids)) for r in encode(odd, path).collect()} == {(r.doc_id, tuple(lib.encode(r.text or ""))) for r in odd.collect()}
    back = {(r.doc_id, r.text) for r in decode(encode(odd, path), path).collect()}
    assert back == {(r.doc_id, lib.decode(lib.encode(r.text or ""))) for r in odd.collect()}
    assert encode_digests(none, path).count() == 0


def test_pieces_random_texts_and_small_memo():
    import pyarrow as pa

    from hirelake.llm.sentencepiece_bpe import encode_batches, load
    path = P.path("piece_bpe_32k.model")
    model, rnd = load(path), random.Random(3)
    for letters in (" ▁aetionthABC\n\t\x00é日本́😀ﬁ　.<>0x²", "ab c. ²A\n▁"):
        texts = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(30))) for _ in range(1500)]
        for t in texts[:300]:
            assert model.encode(t) == model.library.encode(t)
            assert [i for s in model.segments(t) for i in model.encode_segment(s)] == model.library.encode(t)
        table = pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": texts})
        got = pa.Table.from_batches(encode_batches(path, 300)(iter(table.to_batches(100)))).to_pylist()
        for t, r in zip(texts, got, strict=True):
            ids = model.library.encode(t)
            assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], r["n_disagree"]) == (len(ids), sha(",".join(map(str, ids))), sha(model.library.decode(ids)), 0)


# -- 3 ------------------------------------------------------------------------------

def test_token_histogram_answers(spark, odd, none):
    from hirelake.llm.token_counts import encoding, quantile, token_counts, total_tokens, truncated_total
    path = P.path("byte_bpe_50k.tiktoken")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").union(odd.select("doc_id", "text"))
    enc = encoding(path, P.PATTERN)
    n = sorted(len(enc.encode_ordinary(r.text or "")) for r in docs.collect())
    sums = token_counts(docs, path, P.PATTERN)
    for r in sums.collect():
        assert r.n_docs == n.count(r.length) and r.n_tokens == r.length * r.n_docs
        assert r.docs_from == sum(x >= r.length for x in n) and r.tokens_from == sum(x for x in n if x >= r.length)
        assert r.truncated_tokens == sum(min(x, r.length) for x in n)
        assert r.share == sum(x <= r.length for x in n) / len(n)
    assert total_tokens(sums) == sum(n)
    for limit in (0, 1, 17, 500, 10**6):
        assert truncated_total(sums, limit) == sum(min(x, limit) for x in n)
    for q in (0.01, 0.5, 0.9, 1.0):
        assert quantile(sums, q) == next(x for x in n if sum(y <= x for y in n) / len(n) >= q)
    empty = token_counts(none, path, P.PATTERN)
    assert empty.count() == 0 and total_tokens(empty) == 0 and quantile(empty, 0.5) is None and truncated_total(empty, 5) == 0


# -- 4 ------------------------------------------------------------------------------

def brute_language(docs):
    """The same rule with strings and counters."""
    def ranking(counts):
        def key(g):  # the operator's integers order single letters after pairs after triples
            pad = {1: (0x110002, 0), 2: (0x110001,), 3: ()}[len(g)]
            return (*pad, *[0 if c == " " else ord(c) for c in g])
        return sorted(counts, key=lambda g: (-counts[g], key(g)))[:400]

    def grams(text):
        words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
        c = Counter()
        for w in words:
            c.update(w)
        joined = " " + " ".join(words) + " " if words else ""
        c.update(a + b for a, b in zip(joined, joined[1:]))
        c.update(a + b + d for a, b, d in zip(joined, joined[1:], joined[2:]) if b != " ")
        return c

    counts = {}
    for doc_id, text, lang in docs:
        if text is not None and lang is not None and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5:
            if grams(text):
                counts.setdefault(lang, Counter()).update(grams(text))
    profiles = {k: {g: i for i, g in enumerate(ranking(c))} for k, c in counts.items()}
    out = []
    for doc_id, text, _ in docs:
        own = ranking(grams(text or ""))
        held = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        if not own or not profiles:
            out.append((doc_id, held, "und", 0.0))
            continue
        d = {k: sum(abs(p[g] - i) if g in p else 400 for i, g in enumerate(own)) / (400 * len(own)) for k, p in profiles.items()}
        best = min(sorted(d), key=lambda k: d[k])
        out.append((doc_id, held, best, round(1 - d[best], 9)))
    return Counter(out)


def test_language_as_brute_force(spark, odd, none):
    from hirelake.llm.language_id import identified, identify, learn
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").limit(80).union(odd.select("doc_id", "text", "lang"))
    got = Counter((r.doc_id, r.held_out, r.lang_pred, round(r.score, 9)) for r in identify(docs).collect())
    assert got == brute_language([tuple(r) for r in docs.collect()])
    assert identify(none).count() == 0
    assert {(r.lang_pred, r.score) for r in identify(odd.selectExpr("doc_id", "text", "cast(null as string) lang")).collect()} == {("und", 0.0)}
    kept = identified(odd, learn(docs))
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} >= {1, 6} and not {2, 3, -7} & {r.doc_id for r in kept.collect()}
    assert identified(none, learn(none)).count() == 0 and identified(odd, []).count() == 0


def test_language_held_out_accuracy(spark):
    from hirelake.llm.language_id import identify
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = identify(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").selectExpr("avg(cast(lang = lang_pred as int))").first()[0]
    assert r >= 0.97


# -- 2 ------------------------------------------------------------------------------

def test_fingerprints_against_neighbours(spark, odd, none):
    from hirelake.llm.fingerprints import edited, fingerprint, fingerprints, likeness
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(60)
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), reverse=True)
    rows += [(-5, "ﬁne é"), (-6, ""), (-8, None)]
    data = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in fingerprints(data).collect()}
    assert len(got) == len(rows)
    for (doc_id, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        text, after, r = text or "", after or "", got[doc_id]
        new = edited(text, after)
        assert (r.n_chars, r.edited_sha256, r.fingerprint) == (len(text), sha(new), fingerprint(text))
        assert (r.near_edited, r.near_next) == (likeness(fingerprint(text), fingerprint(new)), likeness(fingerprint(text), fingerprint(after)))
    assert fingerprints(none).count() == 0
    assert fingerprints(odd).count() == 9
    one = fingerprints(odd.where("doc_id = 1")).first()
    assert one.near_next == 1.0


def test_edit_distance_and_rolling():
    from hirelake.llm.fingerprints import edit_distance, fingerprint, likeness
    rnd = random.Random(5)

    def plain(a, b):
        p = list(range(len(b) + 1))
        for i, x in enumerate(a):
            q = [i + 1]
            for j, y in enumerate(b):
                q.append(min(p[j] + (x != y), p[j + 1] + 1, q[-1] + 1))
            p = q
        return p[-1]
    for _ in range(400):
        a, b = ("".join(rnd.choice("abc") for _ in range(rnd.randrange(80))) for _ in range(2))
        assert edit_distance(a, b) == plain(a, b)
    text = "".join(rnd.choice("abcdefgh ") for _ in range(5000))
    moved = text[:2500] + "inserted words" + text[2500:]
    other = "".join(rnd.choice("abcdefgh ") for _ in range(5000))
    assert likeness(fingerprint(text), fingerprint(moved)) > 0.8 > 0.3 > likeness(fingerprint(text), fingerprint(other))
    assert likeness(fingerprint(""), fingerprint("")) == 1.0 and likeness(fingerprint(""), fingerprint("abc")) == 0.0


# -- 8 ------------------------------------------------------------------------------

def brute_spans(text):
    order = list(PATTERNS)
    return [f"{k}:{s}:{e}" for s, e, k in sorted(base_spans(text), key=lambda x: (order.index(x[2]), x[0]))]


def test_personal_data_as_brute_force(spark, odd, none):
    from hirelake.llm.personal_data import digests, find
    rnd = random.Random(8)
    parts = ["a.b@c.d", "_@x-.y", "é", "😀", "+1 (988) 555-2485", "4111 1111 1111 1111", "4785380592391135", "1.2.3.4", "007.2.3.255", "1.2.3.256",
             ".", "@", "+", "-", " ", "9", "55", "(", "a@b", "x.y", "+12", "1-2", "4111-1111-1111-1111", "00"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(14))) for _ in range(800)] + ["9" * 20000, "a" * 50000, "1 " * 9000, "+" * 3000, "1." * 5000]
    data = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    names = set(PATTERNS)
    for r in digests(data).collect():
        want = brute_spans(texts[r.doc_id])
        got = [s for s in r.spans.split(",") if s and s.split(":")[0] in names]
        assert got == want, texts[r.doc_id]
        assert r.base_sha256 == sha(",".join(want))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w.startswith(k) for w in want) for k in PATTERNS]
    assert digests(none).count() == 0 and digests(odd).count() == 9
    found = find(odd)
    assert found.columns == odd.columns and found.where("doc_id = 2").first().spans == []


def test_personal_data_added_kinds_context_and_redaction(spark):
    from hirelake.llm.personal_data import find, redact
    rows = [(1, "pay to GB82 WEST 1234 5698 7654 32 now", 3), (2, "pay to GB82 WEST 1234 5698 7654 33 now", 3), (3, "ssn 123-45-6789", 3), (4, "no 123-45-6789", 3),
            (5, "mail a@b.c.d or +1 (988) 555-2485", 3), (6, None, 3), (7, "é a@b.cd", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int")
    got = {r.doc_id: [(s.kind, s.start, s.end, round(s.score, 2)) for s in r.spans] for r in find(docs).collect()}
    assert got[1][-1][:3] == ("iban", 7, 34) and all(k != "iban" for k, *_ in got[2])
    assert got[3] == [("ssn", 4, 15, 0.6)] and got[4] == []
    assert got[5][0] == ("email", 5, 12, 1.0) and got[6] == []
    new = {r.doc_id: (r.text, r.n_chars) for r in redact(docs).collect()}
    assert new[5] == ("mail <EMAIL> or <PHONE>", 23) and new[6] == (None, 3) and new[7] == ("é <EMAIL>", 9) and new[4] == (rows[3][1], 3)


# -- 7 ------------------------------------------------------------------------------

def test_license_scan(spark, odd, none):
    from hirelake.llm.license_scan import TEMPLATES, scan, train
    model = train(spark)
    rows = [(i, f"Some words here.\n{t}\nmore of them") for i, t in enumerate(t for ts in TEMPLATES.values() for t in ts)]
    family = [f for f, ts in TEMPLATES.items() for _ in ts]
    plain = ["The warranty of the boat has expired.", "She has a driving license since May.", "Nothing to see.", "They asked for permission twice.", ""]
    data = spark.createDataFrame(rows + [(100 + i, t) for i, t in enumerate(plain)] + [(0, rows[0][1]), (200, None)], "doc_id long, text string")
    out = scan(data, model).collect()
    named = [r for r in out if r.doc_id < 100]
    assert len(named) == len(rows) + 1 and all(r.paragraph == 1 and r.start == 17 for r in named)
    assert sum(r.family == family[r.doc_id] and r.confirmed for r in named) >= 0.9 * len(named)
    assert all(r.family == "unknown" and not r.confirmed for r in out if r.doc_id >= 100) and {r.doc_id for r in out if r.doc_id >= 100} == {100, 101, 103}
    assert scan(none, model).count() == 0 and scan(odd, model).count() == 0
