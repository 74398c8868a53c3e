"""Divergence audit, fill-in-middle and byte-level BPE against plain versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"
#: Columns with names that the operators use themselves.
DOCS = "doc_id long, text string, lang string, source string, term string, n int, first boolean, output string, form string, ids string"


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(*r, "x", 1, True, "o", "psm", "i") for r in rows], DOCS).repartition(parts)


# -- 11 -----------------------------------------------------------------------------

def brute_audit(rows, least=10):
    """Every group prices every kept term, in Python's integers."""
    lists = [(lang or "", source or "", re.findall(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").encode().lower())) for _, text, lang, source in rows]
    out = []
    for lang in {x for x, _, _ in lists}:
        df = Counter(t for x, _, ts in lists if x == lang for t in set(ts))
        kept = [t for t, k in df.items() if k >= least]
        of = defaultdict(Counter)
        for x, s, ts in lists:
            if x == lang:
                of[s].update(t for t in ts if df[t] >= least)
        whole = sum(of.values(), Counter())

        def price(c, t):
            return 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept))

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        for s in of:
            pairs = [(o, sum(f(price(of[s], t), price(of[o], t)) for t in kept)) for o in of if o != s]
            terms = [(t.decode(), f(price(of[s], t), price(whole, t))) for t in kept if of[s][t] > 0 and price(of[s], t) > price(whole, t)]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, k + 1) for k, (item, v) in enumerate(found) if part == "pair" or k < 10]
    return Counter(out)


@pytest.mark.parametrize("seed", range(2))
def test_audit_as_brute_force(spark, seed):
    from hirelake.llm.divergence import audit
    rnd = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdeé" for b in "mnopÅß"] + ["Wort", "wort", "日本"]
    rows = []
    for lang in ("en", None, "de"):
        for source in ("s1", "s2", None, "S", "sé"):
            mine = rnd.sample(words, 20)
            for _ in range(rnd.choice((3, 12, 40))):
                rows.append((len(rows), rnd.choice((" ", "9", "\n")).join(rnd.choices(mine, k=rnd.randrange(0, 30))), lang, source))
    rows += [(1, None, "en", "no text"), (2, "", "en", ""), (2, "", "en", ""), (3, "1 2 3", "xx", "a"), (4, "am bn", "xx", "b"), (None, "am " * 200_000 + "an", "en", "long")]
    rows += [(5, "only here", "alone", "one")] * 12
    got = Counter(tuple(r) for r in audit(frame(spark, rows)).collect())
    assert got == brute_audit(rows)
    assert any(k[0] == "xx" and k[2] == "pair" and k[4] == 0 for k in got)


def test_audit_of_blocks(spark, monkeypatch):
    """Arrays cut into many blocks, partial sums sent on early, terms over the end of a piece."""
    from hirelake.llm import divergence as D
    rnd = random.Random(3)
    words = ["".join(rnd.choices("abcdefgé", k=rnd.randrange(1, 7))) for _ in range(400)]
    rows = [(i, " ".join(rnd.choices(words, k=120)), "en", rnd.choice("abc")) for i in range(120)]
    want = brute_audit(rows)
    monkeypatch.setattr(D, "BLOCK", 16)
    assert Counter(tuple(r) for r in D.audit(frame(spark, rows)).collect()) == want
    text = " ".join(rows[0][1].split() * 9).encode()
    monkeypatch.setattr(D, "CHUNK", 7)
    assert [t for ts in D.term_lists(text) for t in ts] == text.split()


def test_audit_odd_tables(spark):
    from hirelake.llm.divergence import audit
    assert audit(frame(spark, [])).count() == 0
    assert audit(frame(spark, [(1, None, None, None)])).count() == 0


def test_gallop_and_prices():
    from hirelake.llm.divergence import gallop, merged, prices
    rng = np.random.default_rng(5)
    for n, m in ((0, 0), (0, 9), (1, 5000), (300, 300), (700, 90_000), (1000, 1200)):
        a, b = (np.sort(rng.choice(100_000, k, replace=False)) for k in (n, m))
        x, y = gallop(a, b)
        assert a[x].tolist() == b[y].tolist() == sorted(set(a.tolist()) & set(b.tolist()))
    big = 4 * 10**15
    assert prices(np.array([0, 7, big - 2]), big).tolist() == [1 + 10**9 * (c + 2) // big for c in (0, 7, big - 2)]
    assert merged(np.arange(0), np.arange(0), np.array([3]), np.array([5]), 10, 20) == ((200000001 - 350000001) ** 2 // 550000002, 1)


# -- 12 -----------------------------------------------------------------------------

def brute_middle(doc_id, text, marks=("<P>", "<S>", "<M>")):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    x = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(units)
    if not text or any(m in text for m in marks):
        return n, "plain", None, None, text
    i, j = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(units[:i]), "".join(units[i:j]), "".join(units[j:])
    p, s, m = marks
    form = "spm" if h[3] % 100 < 50 else "psm"
    return n, form, len(pre), len(mid), f"{s}{suf}{p}{pre}{m}{mid}" if form == "spm" else f"{p}{pre}{s}{suf}{m}{mid}"


def middle_rows():
    rnd = random.Random(2)
    rows = [(i, "".join(rnd.choice(("a", "é", "😀", "\n", "\r\n", "\n\n", "<", "P>", " ")) for _ in range(rnd.randrange(0, 60))), "en", "s") for i in range(300)]
    return rows + [(400, None, None, None), (401, "", "", ""), (None, "one\ntwo\nthree", "en", "s"), (402, "<P> alone", "en", "s"), (403, "x<M>", "en", "s"), (404, "no feed", "en", "s"),
                   (405, "\n", "en", "s"), (406, "line é\n" * 100_000, "en", "s"), (407, "w" * 500_000, "en", "s"), (-8, "a\nb\n", "en", "s"), (9, "a\nb\n", "en", "s"), (9, "a\nb\n", "en", "s")]


def test_fill_in_middle_as_brute_force(spark):
    from hirelake.llm import fill_in_middle as M
    rows = middle_rows()
    docs = frame(spark, rows)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = Counter((i, *(b := brute_middle(i, t))[:4], sha(b[4]), sha(t or "")) for i, t, _, _ in rows)
    assert Counter(tuple(r) for r in M.digests(docs).collect()) == want
    out = M.outputs(docs)
    assert Counter(tuple(r) for r in out.collect()) == Counter((i, (b := brute_middle(i, t))[1], b[4]) for i, t, _, _ in rows)
    assert Counter(tuple(r) for r in M.texts(out).collect()) == Counter((i, t or "") for i, t, _, _ in rows)
    assert M.digests(frame(spark, [])).count() == 0


def test_fill_in_middle_rules(spark):
    from hirelake.llm import fill_in_middle as M
    docs = frame(spark, middle_rows())
    assert {r.form for r in M.outputs(docs, M.Rule(rate=0)).collect()} == {"plain"}
    rule = M.Rule(seed="s", spm=100, sentinels=("[a]", "[bb]", "[a]c"))
    assert {r.form for r in M.outputs(docs, rule).collect()} == {"plain", "spm"}
    with pytest.raises(ValueError, match="form"):
        M.restore(b"<S>x<P>y", "spm", M.Rule().marks)


def test_piece_table():
    from hirelake.llm.fill_in_middle import PieceTable
    t = PieceTable(b"abcdef", [b"<P>", b"<S>", b"<M>"])
    t.cut(2)
    t.cut(2)
    assert [bytes(c) for c in t.chunks()] == [b"ab", b"", b"cdef"]
    for form, text in (("psm", b"<P>ab<S>cdef<M>"), ("spm", b"<S>cdef<P>ab<M>")):
        a = t.arranged(form)
        assert a.bytes() == text and a.digest() == hashlib.sha256(text).hexdigest() and a.restored(form).bytes() == b"abcdef"
    with pytest.raises(ValueError):
        t.cut(7)


# -- 13 -----------------------------------------------------------------------------

def encoding(name):
    from hirelake.llm.token_counts import encoding
    return encoding(P.path(name), P.PATTERN)


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_byte_bpe_as_tiktoken(spark, name):
    from hirelake.llm import byte_bpe as B
    lib, path = encoding(name), P.path(name)
    model = B.load(path, P.PATTERN)
    rnd = random.Random(4)
    odd = [chr(c) for c in model.other][::11] + list(" \n\t  'stredlmv\x00\x1c\x85\xa0　  éß😀1٣Ⅻ!?_ab") + ["'re", "'S", " \n", "\r\n", "<|endoftext|>"]
    texts = ["".join(rnd.choice(odd) for _ in range(rnd.randrange(0, 30))) for _ in range(3000)]
    texts += ["a" * 5000, " " * 3000 + "x", "ab\n" * 4000, "\n", " ", "don't we'll I'M", None, ""]
    texts += [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = [(i if i % 50 else None, t, "en", "s") for i, t in enumerate(texts)] + [(7, "twice", "en", "s")] * 2
    docs = frame(spark, rows)

    def digest(t):
        ids = lib.encode_ordinary(t or "")
        return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(lib.decode_bytes(ids)).hexdigest()

    assert Counter(tuple(r) for r in B.encode_digests(docs, path, P.PATTERN, memo_size=500).collect()) == Counter((i, *digest(t)) for i, t, _, _ in rows)
    if name == "byte_bpe_50k.tiktoken":
        ids = B.encode(docs, path, P.PATTERN)
        assert Counter((r.doc_id, tuple(r.ids)) for r in ids.collect()) == Counter((i, tuple(lib.encode_ordinary(t or ""))) for i, t, _, _ in rows)
        assert Counter(tuple(r) for r in B.decode(ids, path, P.PATTERN).collect()) == Counter((i, t or "") for i, t, _, _ in rows)
        assert B.encode_digests(frame(spark, []), path, P.PATTERN).count() == 0


def test_byte_model_of_own_ranks():
    """A vocabulary with gaps and a token that no merge leads to."""
    import tiktoken
    from hirelake.llm.byte_bpe import ByteModel
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 300, b"bc": 301, b"xyz": 302, b"abc": 400}
    lib, own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}), ByteModel(ranks, P.PATTERN)
    for t in ("abc", "xyz", "xyzz", " xyz", "ababc bcab", "aabbcc", "xyz xyz", ""):
        assert own.encode(t) == lib.encode_ordinary(t)
    with pytest.raises(ValueError, match="bytes"):
        ByteModel({b"a": 0}, P.PATTERN)


def test_queries_read_whole_tables(spark):
    import __spark_entry__ as E
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    q = E.queries()
    assert q["op13_byte_bpe_round_trip"](spark, SF).count() == n == q["op12_fill_in_middle"](spark, SF).count()
