"""String helpers that keep the warehouse's text semantics on Spark.

All helpers return Columns built from built-in functions, so they stay inside
whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelake.functions import rules

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_chars(c: ColumnOrName, chars: str = " ") -> Column:
    """Strip a set of characters from both ends (``trim(s, chars)``)."""
    return F.btrim(col(c), F.lit(chars))


def nullif_blank(c: ColumnOrName) -> Column:
    """``nullif(trim(c), '')``: blank or null -> null, else trimmed text."""
    t = F.trim(col(c))
    return F.when(t != "", t)


def blank_to_null(c: ColumnOrName) -> Column:
    """``nullif(c, '')`` without trimming."""
    x = col(c)
    return F.when(x != "", x)


def first_present(*cols: ColumnOrName) -> Column:
    """First value that is neither null nor the empty string."""
    return F.coalesce(*[blank_to_null(c) for c in cols])


def _delimiter_class() -> str:
    return r"\s" + "".join("\\" + ch for ch in rules.INITCAP_DELIMITERS)


def initcap_delims(c: ColumnOrName) -> Column:
    """Warehouse-style initcap: a word starts after whitespace or any of the
    punctuation delimiters; the rest of each word is lower-cased.

    Spark's own ``initcap`` only splits on spaces (``al-khobar`` ->
    ``Al-khobar``).  Here the lower-cased text is split after every delimiter
    (zero-width look-behind, so nothing is lost) and each piece gets an upper
    first letter.
    """
    pieces = F.split(F.lower(col(c)), f"(?<=[{_delimiter_class()}])")
    return F.array_join(
        F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, F.lit(2), F.length(p)))),
        "",
    )


def regexp_substr(c: ColumnOrName, pattern: str, occurrence: int = 1, group: int = 0) -> Column:
    """n-th match of a regex (1-based), null when there are fewer matches."""
    return F.get(F.regexp_extract_all(col(c), F.lit(pattern), group), occurrence - 1)


def like_any(c: ColumnOrName, patterns: Iterable[str], case_insensitive: bool = True) -> Column:
    """OR of LIKE patterns, rewritten to contains / startswith / endswith /
    equality where the pattern allows it (cheaper than a LIKE matcher)."""
    x = F.lower(col(c)) if case_insensitive else col(c)
    out = None
    for p in patterns:
        q = p.lower() if case_insensitive else p
        inner = q.strip("%")
        if "%" in inner or "_" in inner:
            cond = x.like(q)
        elif q.startswith("%") and q.endswith("%") and len(q) > 1:
            cond = x.contains(inner)
        elif q.endswith("%"):
            cond = x.startswith(inner)
        elif q.startswith("%"):
            cond = x.endswith(inner)
        else:
            cond = x == q
        out = cond if out is None else (out | cond)
    return out


def try_boolean(c: ColumnOrName) -> Column:
    """Forgiving boolean: true/t/yes/y/on/1 and false/f/no/n/off/0, any case;
    anything else is null."""
    x = F.lower(F.trim(col(c)))
    return (
        F.when(x.isin(*rules.BOOLEAN_TRUE), F.lit(True))
        .when(x.isin(*rules.BOOLEAN_FALSE), F.lit(False))
        .otherwise(F.lit(None).cast("boolean"))
    )


#: Characters that simple case folding takes together although their lower case differs.
_FOLD_FROM = "\u017f\u212a\u212b\u0131\u03c2\u00b5\u03d0\u03f5\u03d1\u03f0\u03d6\u03f1\u03d5\u1e9b\u1fbe\u1c80\u1c81\u1c82\u1c83\u1c84\u1c85\u1c86\u1c87\u1c88"
_FOLD_TO = "sk\u00e5i\u03c3\u03bc\u03b2\u03b5\u03b8\u03ba\u03c0\u03c1\u03c6\u1e61\u03b9\u0432\u0434\u043e\u0441\u0442\u0442\u044a\u0463\ua64b"

#: Ranges that hold every character for which folding is more than lower(); a few ranges are tested fast.
_FOLD_MAY_DIFFER = "[\u00b5\u0130-\u017f\u0370-\u052f\u1c80-\u1fff\u212a\u212b]"


def fold_simple(c: ColumnOrName) -> Column:
    """Text for comparison without case, character by character: the length stays
    (a long s is an s, a dotless i an i; a sharp s stays itself)."""
    x = col(c)
    return F.when(x.rlike(_FOLD_MAY_DIFFER), F.translate(F.lower(F.translate(x, "\u0130", "i")), _FOLD_FROM, _FOLD_TO)).otherwise(F.lower(x))


def fold_case(c: ColumnOrName) -> Column:
    """Full Unicode case folding, as for equal names: a sharp s is two s, a final
    sigma a sigma; a dotless i stays itself."""
    kept = F.translate(F.lower(col(c)), "\u0131", "\ue000")
    upper = F.translate(F.upper(kept), "\u03a3", "\u03c3")  # also keeps the optimizer from dropping upper() inside lower()
    return F.translate(F.lower(upper), "\ue000", "\u0131")
