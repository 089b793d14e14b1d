"""Scalar column functions (SF-*), all built from JVM-side expressions.

None of these is a Python UDF: each returns a ``Column`` that stays inside
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of our own surrogate-key contract: the separator between key
# parts and the token that stands in for a NULL part.
KEY_SEPARATOR = "-"
KEY_NULL_TOKEN = "_null_"

MS_PER_DAY = 86_400_000


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz_lit(t) -> Column:
    """TIMESTAMP_NTZ literal from a naive datetime, with no zone conversion."""
    return F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")


def surrogate_key(*cols: str | Column) -> Column:
    """SF-7: md5 hex of the key parts, NULL parts replaced by a fixed token.

    Equal inputs always give equal keys across rebuilds; NULL and the empty
    string hash differently.
    """
    parts = [F.coalesce(_col(c).cast("string"), F.lit(KEY_NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def date_key(c: str | Column) -> Column:
    """SF-8: date -> integer ``YYYYMMDD`` (arithmetic, no string formatting)."""
    d = _col(c).cast("date")
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def iso_day_of_week(c: str | Column) -> Column:
    """SF-11: ISO day of week, Monday = 1 ... Sunday = 7."""
    return (F.weekday(_col(c)) + 1).cast("int")


def is_weekend(c: str | Column) -> Column:
    return iso_day_of_week(c).isin(6, 7)


def round_n(c: str | Column, digits: int) -> Column:
    """SF-2/SF-3: half-up rounding; NULL passes through."""
    return F.round(_col(c), digits)


def pct_change(cur: str | Column, prev: str | Column, digits: int = 4) -> Column:
    """SF-4: ``(cur - prev) / nullif(prev, 0) * 100`` rounded; zero base -> NULL."""
    cur_c, prev_c = _col(cur), _col(prev)
    base = F.when(prev_c != 0, prev_c)
    # Round the ratio (at digits + 2) and scale afterwards: with decimals the
    # quotient keeps ~17 fractional digits, while multiplying first would make
    # Spark cut the intermediate to 6 digits and round twice.
    return F.round((cur_c - prev_c) / base, digits + 2) * 100


def ntz_epoch(c: str | Column, unit: str = "SECOND") -> Column:
    """UTC wall time -> whole units since the epoch, whatever the session zone."""
    return F.timestamp_diff(unit, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), _col(c))


def epoch_ms_to_utc_day(ms: str | Column) -> Column:
    """SF-14: epoch milliseconds -> UTC calendar day, independent of session zone."""
    days = F.floor(_col(ms) / F.lit(MS_PER_DAY)).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days)


def utc_wall(c: str | Column) -> Column:
    """Instant (TIMESTAMP) -> its UTC wall time as NTZ, whatever the session zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), _col(c).cast("timestamp_ntz"))


def iso_utc_to_ntz(s: str | Column) -> Column:
    """SF-15: ISO-8601 text (with or without offset) -> UTC wall time as NTZ.

    Parsing as an instant first keeps the offset; a direct cast to NTZ would
    silently drop it. The instant's wall time is taken in UTC whatever the
    session zone; text without an offset is UTC already.
    """
    text = _col(s)
    has_zone = text.rlike(r"(Z|[+-]\d{2}(:?\d{2})?)$") & text.contains(":")
    return F.when(has_zone, utc_wall(F.to_timestamp(text))).otherwise(F.to_timestamp_ntz(text))


def price_text(c: str | Column) -> Column:
    """SF-16: ``$1,234.56`` at or above 1, four decimals below 1, NULL -> NULL.

    The value is rounded half-up as a decimal first so the text never depends
    on binary floating-point ties.
    """
    v = _col(c).cast("decimal(38,8)")
    two = F.format_number(F.round(v, 2), 2)
    four = F.format_number(F.round(v, 4), 4)
    return F.when(v.isNull(), F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("$"), F.when(v >= 1, two).otherwise(four))
    )


def signed_pct_text(c: str | Column, digits: int = 2) -> Column:
    """SF-16: ``+1234.50%`` / ``-0.50%``, no thousands separator; NULL -> NULL.

    The sign is that of the unrounded value, so ``-0.001`` reads ``-0.00%``.
    """
    v = _col(c).cast("decimal(38,8)")
    body = F.abs(F.round(v, digits)).cast(f"decimal(38,{digits})").cast("string")
    sign = F.when(v < 0, F.lit("-")).otherwise(F.lit("+"))
    return F.when(v.isNull(), F.lit(None).cast("string")).otherwise(F.concat(sign, body, F.lit("%")))
