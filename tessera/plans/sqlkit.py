"""Small helpers that render the oracle SQL (DuckDB dialect) used to check queries.

DuckDB computes ``avg``/division of DECIMAL in DOUBLE, so rounding a tie
(1.255 -> 1.25) differs from exact decimal rounding (-> 1.26, which is what
Spark and the reference's warehouse do). These helpers express the same
half-up results with exact integer arithmetic.
"""

from __future__ import annotations


def half_up_div(num: str, den: str) -> str:
    """Exact ``round_half_up(num / den)`` of two integer (HUGEINT) expressions."""
    return (f"(sign({num}) * sign({den}) * ((2 * abs({num}) + abs({den})) // (2 * abs({den}))))")


def exact_avg(col: str, scale: int, digits: int) -> str:
    """round(avg(col), digits) as DOUBLE for a DECIMAL(_, scale) column."""
    s = f"CAST(sum({col}) * {10 ** scale} AS HUGEINT)"
    n = f"CAST(count({col}) AS HUGEINT)"
    if digits >= scale:
        num = f"({s} * {10 ** (digits - scale)})"
        q = half_up_div(num, n)
    else:
        q = half_up_div(s, f"({n} * {10 ** (scale - digits)})")
    return f"(CAST({q} AS DOUBLE) / {10 ** digits}.0)"


def exact_pct(cur: str, prev: str, scale: int = 8, digits: int = 4) -> str:
    """round((cur - prev) / nullif(prev, 0) * 100, digits) as DOUBLE, exactly."""
    c = f"CAST(({cur} - {prev}) * {10 ** scale} AS HUGEINT)"
    b = f"CAST({prev} * {10 ** scale} AS HUGEINT)"
    num = f"({c} * {10 ** (digits + 2)})"
    q = half_up_div(num, b)
    return f"(CASE WHEN {prev} = 0 THEN NULL ELSE CAST({q} AS DOUBLE) / {10 ** digits}.0 END)"


def exact_pct_decimal(cur: str, prev: str, scale: int = 8, digits: int = 4) -> str:
    """Same as ``exact_pct`` but as DECIMAL(38, digits) (for text formatting)."""
    c = f"CAST(({cur} - {prev}) * {10 ** scale} AS HUGEINT)"
    b = f"CAST({prev} * {10 ** scale} AS HUGEINT)"
    q = half_up_div(f"({c} * {10 ** (digits + 2)})", b)
    return (f"(CASE WHEN {prev} = 0 THEN NULL ELSE CAST({q} AS DECIMAL(38,0)) * "
            f"CAST(0.{'0' * (digits - 1)}1 AS DECIMAL({digits + 1},{digits})) END)")


def sql_list(values) -> str:
    """SQL IN-list; strings are quoted with '' escaping."""
    out = []
    for v in values:
        if isinstance(v, str):
            out.append("'" + v.replace("'", "''") + "'")
        else:
            out.append(str(v))
    return ", ".join(out)
