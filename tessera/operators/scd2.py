"""Type-2 version history (SK-3, SK-4, SK-8, W-4).

``scd2_apply`` is the "check" strategy: a new version is opened when any
checked column differs (NULL-safe) from the open version of the same key; the
old one is closed at ``as_of``. Only *open* versions take part in the join, so
each run costs one shuffle of (open versions + incoming rows) on the key and
closed history passes straight through. A stored history (``history_part``)
appends closed versions by day and rewrites only the parts of open versions
that changed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scalar import ntz_lit, surrogate_key

VFROM = "version_from"
VTO = "version_to"

# Open versions end at the far future; the first version of a
# key is back-dated so older facts still resolve to it.
OPEN_END = dt.datetime(9999, 12, 31)
FIRST_VERSION_FROM = dt.datetime(1900, 1, 1)


def scd2_initial(incoming: DataFrame, key: str, check_cols: Sequence[str], as_of: dt.datetime) -> DataFrame:
    return incoming.select(
        key, *check_cols,
        ntz_lit(as_of).alias(VFROM),
        F.lit(None).cast("timestamp_ntz").alias(VTO),
    )


def _compared(open_: DataFrame, incoming: DataFrame, key: str, check_cols: Sequence[str], as_of: dt.datetime,
              close_missing: bool) -> tuple[DataFrame, Column, Column, Column, Column]:
    """Open versions beside what comes in: the joined rows, whether the old one closes, whether one opens, both versions."""
    ts = ntz_lit(as_of)
    inc = incoming.select(key, *[F.col(c).alias(f"__new_{c}") for c in check_cols]).withColumn("__has_new", F.lit(True))
    j = open_.withColumn("__has_old", F.lit(True)).join(inc, key, "full_outer")
    has_old = F.col("__has_old").isNotNull()
    has_new = F.col("__has_new").isNotNull()
    same = F.lit(True)
    for c in check_cols:
        same = same & F.col(c).eqNullSafe(F.col(f"__new_{c}"))
    changed = has_old & has_new & ~same
    closes = changed | (has_old & ~has_new & F.lit(close_missing))
    opens = has_new & (~has_old | changed)
    old_v = F.struct(F.col(key).alias(key), *[F.col(c).alias(c) for c in check_cols], F.col(VFROM).alias(VFROM),
                     F.when(closes, ts).otherwise(F.lit(None).cast("timestamp_ntz")).alias(VTO))
    new_v = F.struct(F.col(key).alias(key), *[F.col(f"__new_{c}").alias(c) for c in check_cols],
                     ts.alias(VFROM), F.lit(None).cast("timestamp_ntz").alias(VTO))
    return j, closes, opens, old_v, new_v


def _either(j: DataFrame, *versions: Column) -> DataFrame:
    # one pass over the join: each row yields its old version, its new one, or both
    return j.select(F.explode(F.array(*versions)).alias("v")).where(F.col("v").isNotNull()).select("v.*")


def scd2_apply(
    history: DataFrame | None,
    incoming: DataFrame,
    key: str,
    check_cols: Sequence[str],
    as_of: dt.datetime,
    close_missing: bool = False,
) -> DataFrame:
    """Merge one snapshot of ``incoming`` (unique on ``key``) into ``history``.

    Returns the complete new history. Keys missing from ``incoming`` stay open
    unless ``close_missing`` (Q14); a key that returns after being closed gets a
    new version.
    """
    if history is None:
        return scd2_initial(incoming, key, check_cols, as_of)
    open_ = history.where(F.col(VTO).isNull())
    closed = history.where(F.col(VTO).isNotNull()).select(key, *check_cols, VFROM, VTO)
    j, _, opens, old_v, new_v = _compared(open_, incoming, key, check_cols, as_of, close_missing)
    return closed.unionByName(_either(j, F.when(F.col("__has_old").isNotNull(), old_v), F.when(opens, new_v)))


def scd2_changes(open_: DataFrame, incoming: DataFrame, key: str, check_cols: Sequence[str], as_of: dt.datetime,
                 close_missing: bool = False) -> DataFrame:
    """Only what a run changes: the versions it closes (with their end) and those it opens."""
    j, closes, opens, old_v, new_v = _compared(open_, incoming, key, check_cols, as_of, close_missing)
    return _either(j, F.when(closes, old_v), F.when(opens, new_v))


#: Open versions lie in so many parts by key, closed ones in a part a day of closing.
OPEN_PARTS = 16
PART = "part"


def history_part(key: str) -> Column:
    """The part of a stored history that a version lies in."""
    bucket = F.format_string("open-%02d", F.pmod(F.xxhash64(key), F.lit(OPEN_PARTS)))
    return F.when(F.col(VTO).isNull(), bucket).otherwise(F.concat(F.lit("closed-"), F.date_format(VTO, "yyyy-MM-dd")))


def scd2_replay(
    snapshots: Sequence[tuple[dt.datetime, DataFrame]],
    key: str,
    check_cols: Sequence[str],
    close_missing: bool = False,
) -> DataFrame:
    """Apply successive snapshots in time order (a fixed, small list of runs)."""
    hist: DataFrame | None = None
    for as_of, inc in snapshots:
        hist = scd2_apply(hist, inc, key, check_cols, as_of, close_missing)
    assert hist is not None
    return hist


def scd2_from_observations(
    obs: DataFrame,
    key: str,
    attrs: Sequence[str],
    ts_col: str,
    cuts: Sequence[dt.datetime],
    pick: str = "latest",
    derived: dict | None = None,
) -> DataFrame:
    """Version history that replaying ``scd2_apply`` at each of ``cuts`` would
    build, computed in one pass (a backfill of the check strategy).

    Each run at ``cuts[i]`` sees the observations with ``ts < cuts[i]``. The
    rows are bucketed by the first run that sees them and folded per
    (key, bucket) — partial aggregation, so a hot key is pre-reduced map-side;
    a version starts at the run of a bucket whose attribute values differ
    (NULL-safe) from the previous bucket's. The window over buckets holds at
    most ``len(cuts)`` rows per key. ``pick`` is 'latest' (newest observation)
    or 'max' (lexicographic max over all history). ``derived`` maps extra
    checked columns to expressions of the key (e.g. a class from an id list).
    Keys never vanish here, as with ``close_missing=False``.
    """
    cuts = sorted(cuts)
    bucket = F.lit(None).cast("int")
    for i in reversed(range(len(cuts))):
        bucket = F.when(F.col(ts_col) < ntz_lit(cuts[i]), F.lit(i)).otherwise(bucket)
    seen = obs.select(key, *attrs, ts_col).withColumn("__b", bucket).where(F.col("__b").isNotNull())
    if pick == "latest":
        folded = seen.groupBy(key, "__b").agg(
            F.max_by(F.struct(*attrs), F.struct(ts_col, *attrs)).alias("__a"))
        state = folded.select(key, "__b", *[F.col(f"__a.{a}").alias(a) for a in attrs])
    elif pick == "max":
        folded = seen.groupBy(key, "__b").agg(*[F.max(a).alias(a) for a in attrs])
        run = Window.partitionBy(key).orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
        state = folded.select(key, "__b", *[F.max(a).over(run).alias(a) for a in attrs])
    else:
        raise ValueError(f"unknown pick {pick!r}")
    for name, expr in (derived or {}).items():
        state = state.withColumn(name, expr)
    checked = list(attrs) + list(derived or {})
    w = Window.partitionBy(key).orderBy("__b")
    first = F.lag("__b").over(w).isNull()
    same = F.lit(True)
    for c in checked:
        same = same & F.col(c).eqNullSafe(F.lag(c).over(w))
    starts = state.withColumn("__start", first | ~same).where(F.col("__start"))
    cut_ts = F.element_at(F.array(*[ntz_lit(c) for c in cuts]), F.col("__b") + 1)
    starts = starts.withColumn(VFROM, cut_ts)
    return starts.select(key, *checked, VFROM,
                         F.lead(VFROM).over(Window.partitionBy(key).orderBy(VFROM)).alias(VTO))


def scd2_dimension(
    history: DataFrame,
    key: str,
    attrs: Sequence[str],
    sk_col: str,
    floor_first: bool = True,
) -> DataFrame:
    """SK-4 + W-4: dimension rows from version history.

    ``sk_col`` hashes (key, raw version start) so it is stable across rebuilds
    (Q9); the first version per key is back-dated; the open end is 9999-12-31.
    """
    w = Window.partitionBy(key).orderBy(F.col(VFROM).asc())
    v = history.withColumn("__vn", F.row_number().over(w))
    first = F.col("__vn") == 1
    valid_from: Column = F.col(VFROM)
    if floor_first:
        valid_from = F.when(first, ntz_lit(FIRST_VERSION_FROM)).otherwise(F.col(VFROM))
    return v.select(
        surrogate_key(key, VFROM).alias(sk_col),
        key,
        *attrs,
        valid_from.alias("valid_from"),
        F.coalesce(F.col(VTO), ntz_lit(OPEN_END)).alias("valid_to"),
        F.col(VTO).isNull().alias("is_current"),
    )
