"""Account numbers with words and numbers behind them."""

import pytest

NUMBERS = ["AT61 1904 3002 3457 3201", "AT611904300234573201", "ES9121000418450200051332", "BE68 5390 0754 7034", "GB82 WEST 1234 5698 7654 32", "NO93 8601 1117 947"]


@pytest.mark.parametrize("behind", ["", " Bitte", " 2 Euro", " IBAN", " 2026", " BIC GENODE", ".", "\nBitte", " a"])
def test_iban_whatever_follows(spark, behind):
    from hirelake.llm.personal_data import find
    docs = spark.createDataFrame([(i, f"pay {n}{behind}") for i, n in enumerate(NUMBERS)], "doc_id long, text string")
    got = {r.doc_id: [(s.start, s.end) for s in r.spans if s.kind == "iban"] for r in find(docs).collect()}
    assert got == {i: [(4, 4 + len(n))] for i, n in enumerate(NUMBERS)}


def test_iban_no_part_of_a_longer_run(spark):
    from hirelake.llm.personal_data import find
    docs = spark.createDataFrame([(0, "AT611904300234573201X"), (1, "XAT611904300234573201"), (2, "AT611904300234573202 Bitte")], "doc_id long, text string")
    assert all(s.kind != "iban" for r in find(docs).collect() for s in r.spans)
