"""Rows as the pipeline's stages treat them: clashing columns, repeated ids, no ids; the entry without a library."""

import os
import subprocess
import sys
from collections import Counter

import duckdb
import pytest

pytest.importorskip("public_tokenizers")
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_mixed_with_clashing_columns(spark):
    from hirelake.llm.mixing import mixed
    rows = [(i, "w " * (i % 7 + 1), "en", f"s{i % 3}", 1) for i in range(60)]
    plain = spark.createDataFrame(rows, SCHEMA)
    names = ["whole", "last", "__source", "mix_source", "Mix_whole", "mix_last", "mix_time", "__time", "part", "place"]
    clash = spark.createDataFrame([(*r, *names) for r in rows], SCHEMA + "".join(f", {n} string" for n in names))
    got = mixed(clash)
    assert got.columns == clash.columns and {tuple(r)[5:] for r in got.collect()} == {tuple(names)}
    assert Counter(r.doc_id for r in got.collect()) == Counter(r.doc_id for r in mixed(plain).collect())


def test_redact_with_clashing_columns(spark):
    from hirelake.llm.personal_data import redact
    names = ["__text", "__spans", "pii_spans", "PII_text", "spans", "a.b"]
    docs = spark.createDataFrame([(1, "mail a@b.cd now", "en", "s", 15, *names), (1, "mail a@b.cd now", "en", "s", 15, *names), (2, None, None, None, None, *names)],
                                 SCHEMA + "".join(f", `{n}` string" for n in names))
    got = redact(docs)
    assert got.columns == docs.columns
    assert Counter(tuple(r) for r in got.collect()) == Counter({(1, "mail <EMAIL> now", "en", "s", 16, *names): 2, (2, None, None, None, None, *names): 1})


def test_one_of_each_by_row(spark):
    from hirelake.llm.near_duplicates import one_of_each
    a, b, c = ("".join(f"{x}{i} " for i in range(40)) for x in "abc")
    rows = [(5, a), (5, a), (5, b), (7, b), (None, c), (None, c), (None, c + "more"), (9, a + "end"), (3, "short"), (3, "short"), (4, None), (4, None), (6, ""), (None, None),
            (8, b + "x"), (2, "alone " + " ".join(f"q{i}" for i in range(20)))]
    docs = spark.createDataFrame([(i, t, "dedup", 1) for i, t in rows], "doc_id long, text string, dedup_row string, comp int").repartition(4)
    got = one_of_each(docs)
    assert got.columns == docs.columns
    kept = Counter((r.doc_id, r.text) for r in got.collect())
    assert kept.pop((None, c), 0) + kept.pop((None, c + "more"), 0) == 1  # one of the copies without an id
    assert kept == Counter([(5, a), (5, b), (3, "short"), (4, None), (4, None), (6, ""), (None, None), rows[-1]])
    assert one_of_each(docs.limit(0)).count() == 0


def test_iban_oracle_as_operator(spark):
    from hirelake.llm.personal_data import digests
    from hirelake.llm.queries import ORACLE
    texts = ["pay ES9121000418450200051332 2 Euro", "pay AT611904300234573201 IBAN", "pay AT61 1904 3002 3457 3201 2026", "AT61 1904 3002 3457 3201 Bitte",
             "bank_AT611904300234573201_x", "AT61_1904_3002_3457_3201", "xAT611904300234573201", "DE89 3704 0044 0532 0130 00", "DE89370400440532013000x", "GB82 WEST 1234 5698 7654 32,",
             "éAT611904300234573201é", "no number", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = Counter(tuple(r) for r in digests(docs).collect())
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    rel = con.execute(ORACLE["op8_personal_data"])
    order = [d[0] for d in rel.description]
    want = Counter(tuple(r[order.index(c)] for c in digests(docs).columns) for r in rel.fetchall())
    assert got == want and sum("iban" in r[-1] for r in got) >= 7


def test_entry_without_a_library():
    """If a library of the operators is missing, the other queries are there."""
    code = ("import sys; sys.modules['xxhash'] = None\nimport __spark_entry__ as e\nq = e.queries()\n"
            "assert 'keep_latest' in q and 'pipeline' not in q and set(e.oracle_sql()) <= set(q)\nprint(len(q))")
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    assert int(out.stdout) > 100


def test_many_matches_in_one_text(spark):
    """A text of 40,000 addresses and as many other spans: places, redaction and context as in short texts."""
    import re
    from hirelake.llm.personal_data import digests, find, redact
    n = 40_000
    text = " ".join(f"é😀 a{i}@b.cd ssn 123-45-6789 10.0.0.{i % 300}" for i in range(n))
    docs = spark.createDataFrame([(1, text), (2, text[:5000])], "doc_id long, text string")
    long, short = digests(docs).orderBy("doc_id").collect()
    assert long.n_email == n and long.n_ip == sum(i % 300 < 256 for i in range(n))
    want = [(m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", text)]
    got = [tuple(map(int, s.split(":")[1:])) for s in long.spans.split(",") if s.startswith("email")]
    assert got == want and long.spans.startswith(short.spans.split(",ip:")[0])
    assert long.spans.count("ssn:") == n  # every one by the word before it
    new = redact(docs.where("doc_id = 1")).first().text
    plain = re.sub(r"[a-z0-9]+@b\.cd", "<EMAIL>", text).replace("123-45-6789", "<SSN>")
    assert new == re.sub(r"10\.0\.0\.(\d+)", lambda m: "<IP>" if int(m[1]) < 256 else m[0], plain)
    near = find(spark.createDataFrame([("ssn" + " " * 36 + "123-45-6789",), ("ssn" + " " * 38 + "123-45-6789",), ("tel +1 2 ssn +1 2 123-45-6789",)], "text string"))
    assert [len([s for s in r.spans if s.kind == "ssn"]) for r in near.collect()] == [1, 0, 1]
