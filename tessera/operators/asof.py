"""As-of joins of facts to Type-2 versions (J-1, J-2).

A fact takes the version of its key with ``valid_from <= t < valid_to``. There
are two ways to it with the same rows:

- ``method='residual'``: an equi-join on the key that checks the range of each
  candidate, for a handful of versions a key. Both sides are shuffled by key:
  a dimension has a row a version, and is not sent through the driver.
- ``method='merge'``: facts and versions are unioned, sorted by time and read
  once, the last version being carried forward. A key with ten thousand
  versions costs a sort instead of facts x versions. With ``span`` the time
  line is cut in slices (months or years), so that a key that holds a third of
  all facts is sorted by many tasks; each slice starts with the version that
  is in effect there, which is known from the versions alone.

``method='auto'`` counts the versions of the fullest key (a small job over the
dimension's keys) and merges from ``MERGE_FROM`` on.

Versions of a key must not overlap (as scd2 makes them). A fact with a null key
or time, or without a version in effect, keeps a null ``sk_col``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Versions of one key beyond which a sort is cheaper than checking each.
MERGE_FROM = 32


def slice_of(col: str | Column, period: str) -> Column:
    """Number of the calendar month or year of a date or timestamp."""
    if period == "month":
        return F.year(col) * 12 + F.month(col)
    if period == "year":
        return F.year(col)
    raise ValueError(f"unknown period {period!r}")


def _bounds(dim: DataFrame, grain: str) -> tuple[Column, Column]:
    lo, hi = F.col("valid_from"), F.col("valid_to")
    if grain == "day":
        return lo.cast("date"), hi.cast("date")
    if grain != "ts":
        raise ValueError(f"unknown grain {grain!r}")
    return lo, hi


def fullest_key(dim: DataFrame, key: str) -> int:
    """Versions of the key that has the most."""
    return dim.groupBy(key).count().agg(F.max("count")).first()[0] or 0


def asof_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    time_col: str,
    grain: str = "ts",
    sk_col: str = "coin_sk",
    method: str = "residual",
    span: tuple[dt.date, dt.date] | None = None,
    period: str = "month",
) -> DataFrame:
    """Left-join the version in effect at ``time_col``.

    ``grain='ts'`` compares timestamps (J-1). ``grain='day'`` cuts the bounds
    to dates first (J-2): the change day belongs to the new version and two
    changes on one day leave an empty interval (Q8). ``span`` names about when
    the facts begin and end; rows outside it join all the same.
    """
    if method == "auto":
        method = "merge" if fullest_key(dim, key) >= MERGE_FROM else "residual"
    if method == "merge":
        return _merge(fact, dim, key, time_col, grain, sk_col, span, period)
    if method != "residual":
        raise ValueError(f"unknown method {method!r}")
    lo, hi = _bounds(dim, grain)
    d = dim.select(F.col(key).alias("__dim_key"), lo.alias("__lo"), hi.alias("__hi"), F.col(sk_col)).hint("merge")
    cond = (
        (F.col(key) == F.col("__dim_key"))
        & (F.col(time_col) >= F.col("__lo"))
        & (F.col(time_col) < F.col("__hi"))
    )
    return fact.join(d, cond, "left").drop("__dim_key", "__lo", "__hi")


def _merge(fact: DataFrame, dim: DataFrame, key: str, time_col: str, grain: str, sk_col: str,
           span: tuple[dt.date, dt.date] | None, period: str) -> DataFrame:
    kind = fact.schema[time_col].dataType
    lo, hi = _bounds(dim, grain)

    def slice_at(col: str) -> Column:
        if span is None:
            return F.lit(0)
        first, last = (slice_of(F.lit(d), period) for d in span)
        return F.least(F.greatest(slice_of(col, period), first), last)

    versions = dim.where(F.col(key).isNotNull()).select(
        F.col(key).alias("__key"), lo.cast(kind).alias("__at"), F.col("valid_from").alias("__since"),
        F.struct(hi.cast(kind).alias("hi"), F.col(sk_col).alias("sk")).alias("__version"))
    versions = versions.withColumn("__first", slice_at("__at"))
    if span is None:
        versions = versions.withColumn("__slice", F.col("__first"))
    else:
        # a version also stands at the head of each later slice, up to that of its successor
        following = F.lead("__first").over(Window.partitionBy("__key").orderBy("__at", "__since"))
        versions = versions.withColumn("__until", F.coalesce(following, slice_of(F.lit(span[1]), period)))
        versions = versions.withColumn("__slice", F.explode(F.sequence("__first", "__until"))).drop("__until")
        versions = versions.withColumn("__at", F.when(F.col("__slice") == F.col("__first"), F.col("__at")))
    versions = versions.withColumn("__is_fact", F.lit(False)).drop("__first")
    # facts that can have no version are spread by hash, so that they do not meet in one slice
    usable = F.col(key).isNotNull() & F.col(time_col).isNotNull()
    stray = -1 - F.pmod(F.xxhash64(key, time_col), F.lit(1024)).cast("int")
    facts = fact.withColumns({
        "__key": F.col(key), "__at": F.col(time_col), "__is_fact": F.lit(True),
        "__slice": F.when(usable, slice_at(time_col)).otherwise(stray)})
    rows = facts.unionByName(versions, allowMissingColumns=True)
    in_order = (Window.partitionBy("__key", "__slice")
                .orderBy(F.col("__at").asc_nulls_first(), F.col("__is_fact"), F.col("__since"))
                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    carried = rows.withColumn("__found", F.last("__version", ignorenulls=True).over(in_order)).where("__is_fact")
    in_effect = usable & (F.col(time_col) < F.col("__found.hi"))
    return carried.select(*fact.columns, F.when(in_effect, F.col("__found.sk")).alias(sk_col))
