"""Candidates joined within the row of their text, as by rows of words; normalising as by its plain steps."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from hirelake.operators.tagging import joined_candidates, normalize_text, resolve_scored_candidates, text_outcomes

CATALOG = [("C++", "technical_skill", ["c++"]), ("Problem Solving", "soft_skill", ["problem solving"]), ("Java", "technical_skill", ["java"])]
SCHEMA = "job_key bigint, words array<struct<word:string,score:double>>"
WORDS = [("problem", 0.9), ("solving", 0.95), ("with", 0.5), ("C++", 0.85), ("and", None), (None, 0.9), ("Java", 1.0), ("x", float("nan")), ("end", 0.2), ("java", 0.86)]
TEXTS = [(1, WORDS), (2, WORDS[:2]), (3, []), (4, None), (5, [("low", 0.1)]), (6, [*WORDS[2:], *WORDS[:4]]), (7, [("", 0.9), ("c++", 0.9)])]


def as_rows(df):
    return df.select("job_key", F.posexplode("words").alias("position", "w")).select("job_key", "position", "w.word", "w.score")


def sorted_rows(df):
    return sorted((tuple(str(v) for v in r) for r in df.collect()))


@pytest.mark.parametrize("texts", [TEXTS, [*TEXTS, (1, WORDS), (9, [("java", 0.9)] * 3), (9, [("java", 0.9)] * 3), (8, WORDS)],
                                   [(None, WORDS), (None, WORDS), *TEXTS], [(None, WORDS), *TEXTS]])
def test_words_of_a_text_as_rows_of_words(spark, texts):
    df = spark.createDataFrame(texts, SCHEMA).repartition(3)
    by_text, by_word = joined_candidates(df), joined_candidates(as_rows(df))
    assert by_text.dtypes == by_word.dtypes
    assert sorted_rows(by_text) == sorted_rows(by_word) and by_word.count() > 5
    assert sorted_rows(resolve_scored_candidates(by_text, CATALOG)) == sorted_rows(resolve_scored_candidates(by_word, CATALOG))


def test_words_of_texts_with_keys_of_their_own_do_not_move(spark):
    from hirelake.operators.tagging import _joined_in_row
    df = spark.createDataFrame([(k, [(f"word{k} " * 50, 0.9)] * 20) for k in range(200)], SCHEMA).repartition(4).localCheckpoint()
    plan = _joined_in_row(df, "job_key", 0.85)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    assert {r[0] for r in rows(joined_candidates(df), "job_key")} == set(range(200)) and joined_candidates(df).count() == 200


def test_normalising_as_its_plain_steps(spark):
    texts = ["a b", " a  b ", "a\tb", "a b", "a　b c", "<b>x</b>", "a < b", "<>x>", "&lt;b&gt; &amp;lt;", "a\nb", "", None, " ", "a <x\n y> b", "x​z"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, t string")
    plain = F.btrim(F.regexp_replace(F.regexp_replace("t", r"<[^>]+>", " "), r"(?U)\s+", " "), F.lit(" "))
    for r in df.select("t", normalize_text("t", unescape=False).alias("got"), plain.alias("want")).collect():
        assert r.got == r.want, r


def test_a_text_is_normalised_once(spark):
    """The second normalising takes the first one's result instead of its steps."""
    df = spark.createDataFrame([("k", "&amp;lt;b&gt; java  <b>c++</b>")], "job_key string, description string")
    out = text_outcomes(df, ["job_key"], "description", CATALOG)
    assert sorted(t["skill_name"] for t in rows(out, "tags")[0][0]) == ["C++", "Java"]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    udf = [line for line in plan.splitlines() if "ArrowEvalPython" in line]
    assert len(udf) == 2 and not any("regexp_replace" in line for line in udf)
