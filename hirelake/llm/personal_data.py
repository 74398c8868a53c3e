"""Operator 8: personal data by patterns, checksums and context.

Regular expressions propose spans, checksums (Luhn, mod-97) and value ranges
confirm them, words close before a span adjust its score.  Everything is
built-in column functions; a text stays in its row and nothing is shuffled.

A span's place comes from cutting the text at the pattern: the pieces between
the matches and the matches themselves alternate, so their lengths add up to
the places.  Patterns take runs possessively and start only where a run starts
(or the last match ended), so a long run is read once.

Sums over the matches of a text are taken in blocks, and pieces of a text are cut
out of blocks of its characters, so a text with very many matches costs little
more than its matches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.llm.common import fresh, text_or_empty

LOCAL = "A-Za-z0-9._%+-"
DIGIT_CHAIN = r"[0-9](?:[\x20-]?[0-9])"

#: Length of each country's account number (ISO 13616), fixed values.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21,
    "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27,
    "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24,
    "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29,
    "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23, "TN": 24,
    "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(number)

    def value(i: Column) -> Column:
        d = F.substring(number, n - i, F.lit(1)).cast("int")  # i-th digit from the right, from 0
        return F.when(i % 2 == 0, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda acc, i: acc + value(i)) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number without blanks passes the mod-97 check for its country's length."""
    turned = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4))

    def step(acc: Column, c: Column) -> Column:
        letter = c >= "A"
        return (acc * F.when(letter, 100).otherwise(10) + F.when(letter, F.ascii(c) - 55).otherwise(F.ascii(c) - 48)) % 97

    lengths = F.create_map(*[F.lit(x) for kv in IBAN_LENGTHS.items() for x in kv])
    known = F.coalesce(F.try_element_at(lengths, F.substring(account, 1, 2)) == F.length(account), F.lit(False))
    return known & (F.aggregate(F.split(turned, "(?!^)(?=.)"), F.lit(0), step) == 1)


def iban_pattern() -> str:
    """Account numbers of their country's length, in one piece or with blanks between groups of four.

    The length is fixed by the country, so a match never reaches into the next word.
    """
    of: dict[int, list[str]] = {}
    for country, n in IBAN_LENGTHS.items():
        of.setdefault(n, []).append(country)
    forms = [rf"(?:{'|'.join(c)})[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (rf"\x20?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") for n, c in sorted(of.items())]
    return rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{'|'.join(forms)})(?![A-Za-z0-9])"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


@dataclass(frozen=True)
class Kind:
    """A kind of personal data: what proposes it, what confirms it, and how sure that makes us."""
    name: str
    pattern: str
    confirm: object  # Column -> Column, or None
    score: float  # of a confirmed span
    context: str  # words that raise the score
    base: bool = True  # kept at any score


PART = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
KINDS = (
    Kind("email", rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", None, 0.9, "mail|contact|write"),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         lambda m: m.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$"), 0.6, "ip|host|server|address"),
    # a whole chain of 13 to 19 digits; shorter and longer ones are no proposals
    Kind("card", rf"(?<![0-9])(?<![0-9][\x20-]){DIGIT_CHAIN}{{12,18}}+(?![\x20-]?[0-9])", lambda m: luhn(_digits(m)), 0.8, "card|visa|credit|pay"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: F.length(_digits(m)).between(9, 15), 0.7, "phone|tel|call|fax|mobile"),
    # added by the method
    Kind("iban", iban_pattern(),
         lambda m: mod97(F.regexp_replace(m, " ", "")), 0.8, "iban|account|bank", False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
         lambda m: ~m.rlike("^(?:000|666|9)|-00-|-0000$"), 0.3, "ssn|social security", False),
)
#: Code points before a span in which context words count, what they add, and the score an added kind needs.
NEAR, RAISE, LEAST = 40, 0.3, 0.5
SPAN = "struct<kind:string,start:int,end:int,score:double>"


#: Elements of a block of running sums, characters of a block of text.
SUMS, CHARS = 256, 4096
#: Pairs of a match and what follows it that hold ``NEAR`` characters at least: no match is shorter than four.
PAIRS = NEAR // 4


def bound(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once, whatever body makes of it."""
    return F.get(F.transform(F.array(value), body), 0)


def running(values: Column, step) -> Column:
    """For every element of an array of numbers, ``step`` (a sum or a maximum) over all before it, from 0.

    Block by block, and within a block from its first element on.
    """
    def over(v: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / SUMS).cast("int")),
                             lambda b: F.aggregate(F.slice(v, b * SUMS + 1, F.lit(SUMS)), F.lit(0), step))
        before = F.aggregate(blocks, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(step(F.element_at(acc, -1), x))))
        return bound(before, lambda p: F.transform(v, lambda _, i: F.aggregate(
            F.slice(v, i - i % SUMS + 1, i % SUMS), F.get(p, F.floor(i / SUMS).cast("int")), step)))

    return bound(values, lambda v: F.when(F.size(v) > 0, over(v)).otherwise(F.array().cast("array<int>")))


def spans_of(text: Column, kind: Kind) -> Column:
    """The confirmed spans of one kind, in order, with their scores; places count code points from 0."""
    none = F.expr(f"cast(array() as array<{SPAN}>)")

    def spans(cut: Column) -> Column:
        pieces, matches = cut["pieces"], cut["matches"]
        gaps = F.zip_with(F.slice(pieces, F.lit(1), F.size(matches)), matches, lambda p, m: F.length(p) + F.length(m))
        # what stands before a match: the ends of the pieces and matches before it
        tails = F.flatten(F.zip_with(F.slice(pieces, F.lit(1), F.size(matches)), matches, lambda p, m: F.array(F.right(p, F.lit(NEAR)), m)))

        def one(x: Column, i: Column, tail: Column) -> Column:
            start = x["before"] + F.length(x["piece"])
            first = F.greatest(2 * i + 1 - 2 * PAIRS, F.lit(1))
            before = F.lower(F.right(F.array_join(F.slice(tail, first, 2 * i + 2 - first), ""), F.lit(NEAR)))
            score = F.lit(kind.score) + F.when(before.rlike(rf"\b(?:{kind.context})"), RAISE).otherwise(0.0)
            ok = F.lit(True) if kind.confirm is None else kind.confirm(x["m"])
            return F.when(ok, F.struct(F.lit(kind.name).alias("kind"), start.alias("start"), (start + F.length(x["m"])).alias("end"),
                                       F.least(score, F.lit(1.0)).alias("score")))

        rows = F.arrays_zip(F.slice(pieces, F.lit(1), F.size(matches)).alias("piece"), matches.alias("m"), running(gaps, lambda a, x: a + x).alias("before"))
        found = F.array_compact(bound(tails, lambda t: F.transform(rows, lambda x, i: one(x, i, t))))
        return found if kind.base else F.filter(found, lambda s: s["score"] >= LEAST)

    cut = F.struct(F.split(text, kind.pattern, -1).alias("pieces"), F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("matches"))
    return F.when(text.rlike(kind.pattern), bound(cut, spans)).otherwise(none)


def find(docs: DataFrame, out: str = "spans") -> DataFrame:
    """``docs`` with ``out``: the spans of every kind in the order of ``KINDS``, then by start.

    Places count code points from 0, the end is exclusive; kinds may overlap.
    A null text has no spans.  Rows and other columns stay as they are (a
    column already named ``out`` is replaced).
    """
    text = text_or_empty()
    return docs.withColumn(out, F.concat(*[spans_of(text, k) for k in KINDS]))


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(docs: DataFrame) -> DataFrame:
    """Per row: how many spans of each base kind, a digest of the base spans, all spans as text."""
    base = [k.name for k in KINDS if k.base]
    found = find(docs.select("doc_id", "text"), "spans").select("doc_id", "spans")

    def count(name: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")

    return found.select("doc_id", *map(count, base), F.sha2(listed(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in angle brackets.

    Overlapping spans become one, named by the first.  ``n_chars``, if there is
    such a column, follows the new text; rows without spans stay as they are, a
    null text stays null.  Repeated rows stay; an empty table stays empty.
    """
    spans, text = fresh(docs, "pii_spans"), fresh(docs, "pii_text")
    found = find(docs, spans)
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    blocks = F.regexp_extract_all("text", F.lit(rf"(?s).{{1,{CHARS}}}"), F.lit(0))

    def part(block: Column, start: Column, end: Column) -> Column:
        """Characters start to end, from the blocks that hold them."""
        first = F.floor(start / CHARS).cast("int")
        held = F.array_join(F.slice(block, first + 1, F.floor(end / CHARS).cast("int") - first + 1), "")
        return F.substring(held, start - first * CHARS + 1, end - start)

    def replaced(x: Column) -> Column:
        done = running(F.transform(x["spans"], lambda s: s["end"]), lambda a, x: F.greatest(a, x))  # the end of what is replaced so far
        rows = F.arrays_zip(x["spans"].alias("s"), done.alias("at"))
        pieces = F.transform(rows, lambda r: F.when(r["s"]["start"] >= r["at"], F.concat(
            part(x["blocks"], r["at"], r["s"]["start"]), F.lit("<"), F.upper(r["s"]["kind"]), F.lit(">"))).otherwise(F.lit("")))
        last = F.aggregate(x["spans"], F.lit(0), lambda acc, s: F.greatest(acc, s["end"]))
        return F.concat(F.array_join(pieces, ""), bound(last, lambda at: part(x["blocks"], at, F.length("text"))))

    new = bound(F.struct(order.alias("spans"), blocks.alias("blocks")), replaced)
    has = F.size(spans) > 0
    out = found.withColumn(text, F.when(has, new).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(has, F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.withColumn("text", F.col(text)).select(*[F.col(f"`{c}`") for c in docs.columns])
