"""Date and timestamp parsing with the warehouse's forgiving semantics.

Everything works on ``TIMESTAMP_NTZ`` / ``DATE`` so results do not depend on
the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelake.functions import rules
from hirelake.functions.text import ColumnOrName, col, regexp_substr


def try_timestamp_ntz(c: ColumnOrName) -> Column:
    """Forgiving text -> TIMESTAMP_NTZ (ISO date or date-time), bad -> null."""
    return col(c).try_cast("timestamp_ntz")


def _try_date(c: Column, fmt: str) -> Column:
    return F.try_to_date(c, fmt)


def try_date_day_mon_year(c: ColumnOrName) -> Column:
    """``DD MON YYYY`` such as ``03 Feb 2026``; bad -> null."""
    return _try_date(F.trim(col(c)), "d MMM yyyy")


def try_date_auto(c: ColumnOrName) -> Column:
    """Automatic date format: ISO date, ISO date-time, ``DD-MON-YYYY``,
    ``MM/DD/YYYY`` and integer epoch text (seconds, ms, us or ns by size)."""
    x = col(c)
    digits = F.when(x.rlike(r"^\d+$"), x.try_cast("bigint"))
    epoch_seconds = (
        F.when(digits < F.lit(31536000000), digits)
        .when(digits < F.lit(31536000000000), F.floor(digits / 1000))
        .when(digits < F.lit(31536000000000000), F.floor(digits / 1000000))
        .otherwise(F.floor(digits / 1000000000))
    )
    return F.coalesce(
        _try_date(x, "yyyy-MM-dd"),
        F.to_date(try_timestamp_ntz(x)),
        _try_date(x, "d-MMM-yyyy"),
        _try_date(x, "MM/dd/yyyy"),
        F.date_from_unix_date(F.floor(epoch_seconds / 86400).cast("int")),
    )


def parse_posted_date(text: ColumnOrName, collected_at: ColumnOrName) -> Column:
    """Relative or explicit posting text -> date, relative to ``collected_at``.

    First match wins: ``yesterday``; ``…minute…``; ``…hour…``; ``…week…``;
    a bare weekday name (the latest such day on or before collection); ``…day…``;
    ``DD MON YYYY``; the automatic format; else null.  Relative forms take the
    first run of digits, so ``today`` / ``last week`` give null.
    """
    raw = col(text)
    ts = col(collected_at)
    low = F.lower(F.trim(raw))
    n = regexp_substr(raw, r"\d+").try_cast("int")
    day = F.to_date(ts)
    weekday_index = F.array_position(F.array(*[F.lit(w) for w in rules.WEEKDAYS]), low) - 1
    # warehouse weekday: 0 = Sunday; Spark's dayofweek: 1 = Sunday
    back_days = F.pmod(F.dayofweek(ts) - 1 - weekday_index + 7, F.lit(7))
    dmy = try_date_day_mon_year(raw)
    auto = try_date_auto(raw)
    return (
        F.when(low == "yesterday", F.date_sub(day, 1))
        .when(low.contains("minute"), F.to_date(F.timestamp_add("MINUTE", -n, ts)))
        .when(low.contains("hour"), F.to_date(F.timestamp_add("HOUR", -n, ts)))
        .when(low.contains("week"), F.to_date(F.timestamp_add("DAY", -7 * n, ts)))
        .when(low.isin(*rules.WEEKDAYS), F.date_sub(day, back_days.cast("int")))
        .when(low.contains("day"), F.to_date(F.timestamp_add("DAY", -n, ts)))
        .when(dmy.isNotNull(), dmy)
        .when(auto.isNotNull(), auto)
        .otherwise(F.lit(None).cast("date"))
    )


def date_key(d: ColumnOrName) -> Column:
    """yyyymmdd as an integer."""
    return F.date_format(col(d), "yyyyMMdd").cast("int")


def ntz_epoch_seconds(ts: ColumnOrName) -> Column:
    """Seconds since 1970-01-01 00:00 of a TIMESTAMP_NTZ, read as UTC (no
    dependence on the session time zone)."""
    t = col(ts)
    return (
        F.unix_date(F.to_date(t)).cast("long") * 86400
        + F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)
    )


def instant_epoch_seconds(text: ColumnOrName) -> Column:
    """Text instant -> epoch seconds.  Text with ``Z`` or an offset is an
    instant; unzoned text is read as UTC; unparsable -> null."""
    x = F.trim(col(text))
    zoned = x.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    return F.when(zoned, F.unix_seconds(F.try_to_timestamp(x))).otherwise(
        ntz_epoch_seconds(x.try_cast("timestamp_ntz"))
    )


def expiry_status(valid_through: ColumnOrName, as_of_epoch_seconds: int) -> Column:
    """``expired`` when the valid-through instant is before ``as_of``;
    unparsable or missing -> ``active``.  ``as_of`` is a parameter, never now."""
    v = instant_epoch_seconds(valid_through)
    return F.when(v < F.lit(as_of_epoch_seconds), F.lit("expired")).otherwise(F.lit("active"))


def epoch_to_date_text(epoch: ColumnOrName, fallback: ColumnOrName) -> Column:
    """Epoch seconds -> ``yyyy-MM-dd`` (UTC), else the fallback text."""
    n = col(epoch).cast("string").try_cast("double")
    d = F.date_format(F.date_from_unix_date(F.floor(n / 86400).cast("int")), "yyyy-MM-dd")
    return F.coalesce(d, col(fallback))
