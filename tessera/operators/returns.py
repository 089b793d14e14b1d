"""Period returns (W-5, SF-4, SK-10).

``lag`` needs each entity's rows in order. Partitioned by the entity alone,
one entity's whole history is one sorted group; instead an entity's time line
is cut in slices (calendar years), ``lag`` runs inside a slice, and the first
row of a slice takes the last row of the entity's slice before it. Those last
rows are one row per entity and slice, found by a partial aggregation.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scalar import pct_change


def lag_by_slices(df: DataFrame, key: str, order_col: str, lags: Mapping[str, str], slices: Column) -> DataFrame:
    """``lag`` by ``order_col`` (nulls first) per ``key``, without a window over a whole key.

    ``lags`` maps output -> column. ``slices`` is an integer that never falls
    as ``order_col`` rises. Rows that tie on ``order_col`` precede each other in
    any order, as with ``lag``.
    """
    cut = df.withColumn("__slice", F.coalesce(slices.cast("int"), F.lit(-(1 << 31))))
    inside = Window.partitionBy(key, "__slice").orderBy(F.col(order_col).asc_nulls_first())
    rows = cut.withColumns({out: F.lag(c).over(inside) for out, c in lags.items()})
    rows = rows.withColumn("__opens", F.row_number().over(inside) == 1)
    ends = cut.groupBy(key, "__slice").agg(
        F.max_by(F.struct(*[F.col(c).alias(out) for out, c in lags.items()]), F.struct(order_col)).alias("__end"))
    lines = ends.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("__slice", "__end"))).alias("__line"))
    before = lines.select(F.col(key).alias("__of"), F.explode(F.expr(
        "transform(__line, (x, i) -> struct(x.__slice as at, if(i > 0, __line[i - 1].__end, null) as end))")).alias("__b"))
    before = before.select("__of", F.col("__b.at").alias("__at"), F.col("__b.end").alias("__end"))
    met = rows.join(before, F.col(key).eqNullSafe(F.col("__of")) & (F.col("__slice") == F.col("__at")), "left")
    met = met.withColumns({out: F.when(F.col("__opens"), F.col(f"__end.{out}")).otherwise(F.col(out)) for out in lags})
    return met.select(*df.columns, *lags)


def with_period_return(
    df: DataFrame,
    key: str,
    order_col: str,
    price_col: str,
    prev_col: str = "prev_latest_price_usd",
    return_col: str = "daily_return_pct",
    digits: int = 4,
    slices: Column | None = None,
) -> DataFrame:
    """Previous row's price by ``order_col`` per ``key`` and the % change.

    "Daily" is to the previous *row*: a gap in days yields a multi-day return
    (Q5). The first row per key and a zero base give NULL. Without ``slices``
    a key's rows form one window group: for inputs of few days.
    """
    if slices is None:
        w = Window.partitionBy(key).orderBy(F.col(order_col).asc())
        lagged = df.withColumn(prev_col, F.lag(price_col).over(w))
    else:
        lagged = lag_by_slices(df, key, order_col, {prev_col: price_col}, slices)
    return lagged.withColumn(return_col, pct_change(price_col, prev_col, digits))
