"""Keep-newest de-duplication (W-1, W-2) and the post-dedup reject rule (PF-2).

``latest_per_key`` is ``row_number() over (partition by keys order by ...) = 1``.
Spark 3.5+ plans the ``= 1`` filter as a *partial* ``WindowGroupLimit`` before
the shuffle and a final one after it, so a hot key is cut to one row per map
task before anything crosses the network: a key holding a third of all rows
costs one row per input split in the shuffle, not a third of the table in one
task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

_UNORDERABLE = ("map", "array", "struct", "binary", "variant")


def newest_first(*cols: str) -> list[Column]:
    """Order columns descending with NULLs last (stated explicitly, Q18)."""
    return [F.col(c).desc_nulls_last() for c in cols]


def total_order_columns(df: DataFrame, keys: Sequence[str], desc_cols: Sequence[str],
                        tie_break: Sequence[str] | None = None) -> list[str]:
    """``desc_cols`` then every other scalar column: the full pick order."""
    if tie_break is None:
        used = set(keys) | set(desc_cols)
        tie_break = [f.name for f in df.schema.fields
                     if f.name not in used and f.dataType.typeName() not in _UNORDERABLE]
    return list(desc_cols) + list(tie_break)


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    desc_cols: Sequence[str],
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """One row per ``keys``: the newest by ``desc_cols`` (descending, NULLs last).

    ``tie_break=None`` appends all remaining scalar columns (also descending)
    so the pick is total and repeatable; pass ``[]`` to use ``desc_cols`` only.
    """
    order = total_order_columns(df, keys, desc_cols, tie_break)
    w = Window.partitionBy(*keys).orderBy(*newest_first(*order))
    rn = "__tessera_rn"
    return df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) == 1).drop(rn)


def reject(df: DataFrame, condition: Column) -> DataFrame:
    """PF-2: keep rows satisfying ``condition``; applied *after* the dedup.

    A bad newest duplicate therefore removes its key (reference behaviour, Q3).
    """
    return df.where(condition)
