from pyspark.sql import functions as F

from conftest import rows
from hirelake.operators.tagging import (
    clean_candidate, merge_tag_sources, resolve_scored_candidates, tag_phrases, tag_texts,
)

CATALOG = [
    ("C++", "technical_skill", ["c++"]),
    ("JavaScript", "technical_skill", ["javascript"]),
    ("Java", "technical_skill", ["java"]),
    ("AI", "technical_skill", ["ai", "artificial intelligence"]),
    ("MEP", "technical_skill", ["mep"]),
    ("BIM", "technical_skill", ["bim"]),
    ("Problem Solving", "soft_skill", ["problem-solving", "problem solving"]),
]


def tags(spark, text):
    df = spark.createDataFrame([("k", text)], "key string, text string")
    return sorted(r[0] for r in rows(tag_phrases(df, "key", "text", CATALOG), "skill_name"))


def test_symbols_and_word_boundaries(spark):
    assert tags(spark, "C++ and JavaScript") == ["C++", "JavaScript"]
    assert tags(spark, "éai is not ai-free") == ["AI"]
    assert tags(spark, "éai") == []


def test_overlapping_entries_are_independent(spark):
    assert tags(spark, "MEP BIM coordination") == ["BIM", "MEP"]


def test_first_alias_in_alias_order_gives_evidence(spark):
    df = spark.createDataFrame([("k", "Strong Problem Solving and problem-solving")], "key string, text string")
    got = rows(tag_phrases(df, "key", "text", CATALOG), "skill_name", "evidence_span")
    assert got == [("Problem Solving", "problem-solving")]


def test_arabic_text_uses_original_as_evidence(spark):
    df = spark.createDataFrame([("k", "مهندس ai <b>x</b>")], "key string, text string")
    got = rows(tag_texts(df, "key", "text", CATALOG), "skill_name", "evidence_span")
    assert got == [("AI", "مهندس ai x")]


def test_candidates_threshold_clean_and_merge(spark):
    c = spark.createDataFrame([("k", 0, "##java,", 0.9), ("k", 1, "C++", 0.5), ("k", 2, "(JavaScript)", 0.95)],
                              "job_key string, position int, word string, score double")
    assert rows(c.select(clean_candidate("word")))[0] == ("java",)
    model = resolve_scored_candidates(c, CATALOG)
    assert sorted(rows(model, "skill_name", "confidence")) == [("Java", 0.9), ("JavaScript", 0.95)]
    phrases = spark.createDataFrame([("k", "Java", "technical_skill", 1.0, "java"), ("k", "C++", "technical_skill", 1.0, "c++")],
                                    "job_key string, skill_name string, skill_category string, confidence double, evidence_span string")
    merged = sorted(rows(merge_tag_sources(model, phrases), "skill_name", "confidence"))
    assert merged == [("C++", 1.0), ("Java", 0.9), ("JavaScript", 0.95)]


def test_evidence_whole_or_cut_and_error_status(spark):
    from hirelake.operators.tagging import tag_run_log
    text = "ب" * 700 + " java"
    df = spark.createDataFrame([("k", text)], "key string, text string")
    assert rows(tag_texts(df, "key", "text", CATALOG), "evidence_span")[0][0] == text
    assert rows(tag_texts(df, "key", "text", CATALOG, evidence_chars=500), "evidence_span")[0][0] == text[:500]
    work = spark.createDataFrame([("a",), ("b",), ("c",)], "job_key string")
    tags = spark.createDataFrame([("a", "x"), ("b", "x")], "job_key string, skill_name string")
    log = tag_run_log(work, tags, "2026-12-02 00:00:00", failed=work.where("job_key = 'b'"))
    assert sorted(rows(log, "job_key", "skill_count", "status")) == [("a", 1, "skills_found"), ("b", 0, "error"), ("c", 0, "no_skills_found")]


def test_large_catalog_as_brute_force(spark):
    """104 entries made by a rule from syllables of the documents, over all documents."""
    import re

    from conftest import SF0001
    syllables = ("an", "er", "in", "on", "re", "th", "he", "st", "ed", "es")
    catalog = [*CATALOG, *[(f"Term {a}{b}", "technical_skill", [f"{a}{b} the", a + b]) for a in syllables for b in syllables if a != b],
               *[(f"Symbol {a}", "soft_skill", [f"{a}, the", f"{a}."]) for a in syllables[:7]]]
    assert len(catalog) >= 104
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text")
    got = set(rows(tag_phrases(docs, "doc_id", "text", catalog), "doc_id", "skill_name", "evidence_span"))
    want = set()
    patterns = [(n, [re.compile(rf"(?i)(?<!\w){re.escape(a)}(?!\w)") for a in aliases]) for n, _, aliases in catalog]
    for doc_id, text in rows(docs):
        for n, ps in patterns:
            m = next((m for p in ps if (m := p.search(text))), None)
            if m:
                want.add((doc_id, n, m[0]))
    assert got == want and len(want) > 500


def test_candidates_of_several_words_and_sharp_s(spark):
    from hirelake.operators.tagging import joined_candidates
    c = spark.createDataFrame([("k", i, w, 0.5 if w in ("with", "and") else 0.9) for i, w in enumerate("problem solving with Straße and STRASSE with C++".split())],
                              "job_key string, position int, word string, score double")
    spans = joined_candidates(c)
    assert sorted(rows(spans, "position", "word")) == [(0, "problem solving"), (3, "Straße"), (5, "STRASSE"), (7, "C++")]
    catalog = [*CATALOG, ("STRASSE", "x", ["strasse"]), ("Straße", "x", ["straße"])]
    got = sorted(rows(resolve_scored_candidates(spans, catalog), "skill_name", "evidence_span"))
    assert got == [("C++", "C++"), ("Problem Solving", "problem solving"), ("Straße", "Straße")]  # the first position wins
    df = spark.createDataFrame([("k", "strasse STRASSE Straße")], "key string, text string")
    assert rows(tag_phrases(df, "key", "text", catalog), "skill_name", "evidence_span") == [("STRASSE", "strasse")]  # one entry a name


def test_symbols_around_words_as_regex(spark):
    """Every alias at every kind of border, as a regex with look-arounds finds it."""
    import itertools
    import re
    aliases = [".net", "c++", "ci/cd", "node.js", "r&d", "#go", "t-sql", "+x+", "a b", "--y"]
    catalog = [(f"S{i}", "technical_skill", [a]) for i, a in enumerate(aliases)]
    texts = [f"{b}{a.upper() if i % 2 else a}{e}" for i, (a, b, e) in enumerate(itertools.product(aliases, ["", "x", " ", ".", "+", "é", "_", "- "], ["", "x", " z", ".", "+", "++", "1", "_"]))]
    texts += [" ".join(p) for p in itertools.permutations(aliases[:4])] + ["", "   ", "+++", "c++c++", "c+++", "..net", ".net.net"]
    df = spark.createDataFrame(list(enumerate(texts)), "key int, text string").repartition(5)
    got = set(rows(tag_phrases(df, "key", "text", catalog), "key", "skill_name", "evidence_span"))
    want = {(k, n, m[0]) for k, t in enumerate(texts) for n, _, (a,) in catalog if (m := re.search(rf"(?<!\w){re.escape(a)}(?!\w)", t, re.I))}
    assert got == want and len(want) > 200


def test_resolve_phrase_takes_first_entry(spark):
    from hirelake.operators.tagging import resolve_phrase
    df = spark.createDataFrame([(1, "bim and JAVA"), (2, "java, javascript"), (3, "nothing"), (4, None), (5, "Artificial Intelligence in AI")], "k int, t string")
    got = {r[0]: r[1:] for r in rows(resolve_phrase(df, ["k"], "t", CATALOG), "k", "skill_name", "matched")}
    assert got == {1: ("Java", "JAVA"), 2: ("JavaScript", "javascript"), 3: (None, None), 4: (None, None), 5: ("AI", "AI")}


def test_errors_stay_with_their_row(spark):
    from hirelake.operators.tagging import outcome_log, outcome_tags, pending_work, text_outcomes
    final = spark.createDataFrame([("a", "java"), ("b", "مهندس java"), ("c", "ليس java"), ("d", "none"), ("e", " ")], "job_key string, description string")

    def translate(text):
        if "ليس" in text:
            raise RuntimeError("out of words")
        return "engineer of java"

    out = text_outcomes(pending_work(final, None, None), ["job_key"], "description", CATALOG, translate=translate)
    log = outcome_log(out, "2026-12-01 00:00:00")
    assert sorted(rows(log, "job_key", "skill_count", "status")) == [("a", 1, "skills_found"), ("b", 1, "skills_found"), ("c", 0, "error"), ("d", 0, "no_skills_found")]
    assert sorted(rows(outcome_tags(out, ["job_key"]), "job_key", "evidence_span")) == [("a", "java"), ("b", "مهندس java")]
    assert rows(out.where("error is not null"), "error") == [("RuntimeError: out of words",)]
    assert rows(pending_work(final, outcome_tags(out, ["job_key"]), log), "job_key") == [("c",)]


def test_alias_without_a_word_is_an_error(spark):
    import pytest
    df = spark.createDataFrame([(1, "+ +")], "k int, t string")
    with pytest.raises(Exception, match="without a word"):
        tag_phrases(df, "k", "t", [("Plus", "x", ["+"])]).collect()


def test_folding_as_python(spark):
    """Names are equal under the folding when Python's casefold says so; the simple folding keeps lengths."""
    import re
    from hirelake.functions.text import fold_case, fold_simple
    cs = [chr(c) for c in range(0x250)] + [chr(c) for c in range(0x370, 0x590)] + list("ẞßſK Åǰ ﬁﬂẛ ᾳ ς Σ İı")
    pairs = [(c, x) for c in cs for x in {c.lower(), c.upper(), c.casefold(), c.swapcase()}]
    df = spark.createDataFrame(pairs, "a string, b string")
    for r in df.select("a", "b", (fold_case("a") == fold_case("b")).alias("full"), fold_simple("a").alias("fa"), (fold_simple("a") == fold_simple("b")).alias("simple")).collect():
        assert r.full == (r.a.casefold() == r.b.casefold()), r
        assert len(r.fa) == len(r.a)
        if len(r.b) == 1 and r.a not in "\u0345" and r.b not in "\u0345":
            assert r.simple == bool(re.fullmatch(re.escape(r.a), r.b, re.I)), r


def test_keys_of_one_and_of_three_runs(spark):
    """Aliases that share their beginning, cores of one, two and more runs, at either end of a text."""
    catalog = [("A", "c", ["data"]), ("B", "c", ["data lake"]), ("C", "c", ["data lake house"]), ("D", "c", ["data  lake"]),
               ("E", "c", ["data+"]), ("F", "c", [".data lake"]), ("G", "c", ["data lake c++"])]
    df = spark.createDataFrame([(0, "Data"), (1, "data lake"), (2, "a DATA LAKE house."), (3, "data  lake"), (4, "data+ x"), (5, "x .Data Lake C++"),
                                (6, "data lakes"), (7, ""), (8, None), (9, "data lake c+")], "key int, text string")
    got = {}
    for k, s in rows(tag_phrases(df, "key", "text", catalog), "key", "skill_name"):
        got.setdefault(k, set()).add(s)
    assert got == {0: {"A"}, 1: {"A", "B"}, 2: {"A", "B", "C"}, 3: {"A", "D"}, 4: {"A", "E"}, 5: {"A", "B", "F", "G"}, 6: {"A"}, 9: {"A", "B"}}


def test_only_words_that_may_begin_an_alias_leave_the_text(spark):
    from hirelake.operators.phrases import occurrences, catalog_table, alias_index, known_words, may_begin
    df = spark.createDataFrame([(k, "lorem ipsum data lake dolor " * 50) for k in range(4)], "key int, text string")
    index = alias_index(catalog_table(spark, [("A", "c", ["data"]), ("B", "c", ["data lake"])]))
    words = spark.createDataFrame([("data", None, None), ("data", " ", "lake"), ("lorem", None, None), ("data", " ", "set")], "a string, b string, c string")
    marked = words.crossJoin(known_words(index)).select(may_begin(F.col("a"), F.col("b"), F.col("c")))
    assert [r[0] for r in marked.collect()] == [True, True, False, False]
    hits = occurrences(df, ["key"], "text", catalog_table(spark, [("A", "c", ["data"])]), every=False)
    assert hits.count() == 200 and hits.where("hit is null").count() == 0


def test_fold_simple_of_plain_and_special_characters(spark):
    from hirelake.functions.text import fold_simple
    texts = ["ABC def", "İstanbul ıŞık", "ΟΔΟΣ Σ", "Kelvin Ångström", "ſtraße", "µ ϐ", "ÀÉÜ ß", None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(fold_simple("t")).collect()]
    assert got == ["abc def", "istanbul işik", "οδοσ σ", "kelvin ångström", "straße", "μ β", "àéü ß", None, ""]


def test_postings_by_text_id_are_tagged_as_by_text(spark):
    """Blank, null and unknown texts give no tags; each text is tagged once however many postings share it."""
    from hirelake.operators.tagging import tag_postings, with_live_text
    texts = spark.createDataFrame([("t0", "java and c++"), ("t1", "  "), ("t2", None), ("t3", "ai")], "description_id string, description string")
    posts = spark.createDataFrame([(f"k{i}", f"t{i % 5}" if i % 7 else None) for i in range(40)], "job_key string, description_id string")
    wide = posts.join(texts, "description_id", "left").select("job_key", "description")
    cols = ["job_key", "skill_name", "evidence_span"]
    by_id, by_text = tag_postings(posts, CATALOG, texts=texts), tag_postings(wide, CATALOG)
    assert sorted(rows(by_id, *cols)) == sorted(rows(by_text, *cols)) and by_id.count() > 10
    assert {r[0] for r in rows(with_live_text(posts, texts), "description_id")} == {"t0", "t3"}
    log = posts.select("job_key").limit(20).selectExpr("job_key", "'found' AS status")
    assert sorted(rows(tag_postings(posts, CATALOG, log=log, texts=texts), *cols)) == sorted(rows(tag_postings(wide, CATALOG, log=log), *cols))
