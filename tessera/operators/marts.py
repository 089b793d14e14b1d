"""Dashboard queries over the daily fact and the version dimension (Q-*, PF-10, RS-1).

Parameters are values, never spliced SQL text: a symbol containing a quote is
just a string in an ``isin``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.incremental import changed_days, in_days, read_table, replace_days, staged, state

# The long-form series labels of the price chart.
SERIES_LABELS = ["Price", "All-time high", "All-time low"]
DEFAULT_TRAILING_DAYS = 90


def _with_dim(fct: DataFrame, dim: DataFrame) -> DataFrame:
    # inner join on the version key: facts without a resolved version drop out
    return fct.join(dim.select("coin_sk", "coin_id", "symbol"), "coin_sk", "inner")


def with_position(df: DataFrame, order: Sequence[Column], position_col: str = "position") -> DataFrame:
    """SO-1: ``df`` in ``order``, each row with its place (1, 2, ...).

    A range-partitioned sort, written once; a place is the row's number in its
    partition plus the sizes of those before it, of which there is one a
    partition. No task holds the whole order. Ties are placed in any order.
    """
    ranked = df.orderBy(*order).withColumn("__at", F.monotonically_increasing_id())
    ranked = staged(ranked, "ordered").withColumn("__part", F.shiftrightunsigned("__at", 33))
    sizes = ranked.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    inside = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return ranked.join(F.broadcast(sizes), "__part").select(  # a row a partition
        *df.columns, (F.col("__before") + inside + 1).alias(position_col))


def date_bounds(fct: DataFrame, trailing_days: int = DEFAULT_TRAILING_DAYS) -> DataFrame:
    """Q-BOUNDS + PF-10: min/max day and the default range start."""
    b = fct.agg(F.min("price_date").alias("min_date"), F.max("price_date").alias("max_date"))
    return b.withColumn("default_start", F.greatest("min_date", F.date_sub("max_date", trailing_days)))


def current_symbols(dim: DataFrame) -> DataFrame:
    """Q-SYMBOLS: distinct symbols of current versions, sorted."""
    return dim.where(F.col("is_current")).select("symbol").distinct().orderBy("symbol")


def cards(fct: DataFrame, dim: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Q-CARDS: per coin the latest day in ``[start, end]``; highest price first."""
    j = _with_dim(fct.where(F.col("price_date").between(F.lit(start), F.lit(end))), dim)
    w = Window.partitionBy("coin_id").orderBy(F.col("price_date").desc())
    top = j.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1)
    return top.select("symbol", F.col("latest_price_usd").alias("price_usd"), "daily_return_pct").orderBy(
        F.col("price_usd").desc_nulls_last())


def extremes(fct: DataFrame, dim: DataFrame) -> DataFrame:
    """Q-EXTREMES: all-time high/low per *symbol* over all history (Q13)."""
    return _with_dim(fct, dim).groupBy("symbol").agg(
        F.max("latest_price_usd").alias("ath"), F.min("latest_price_usd").alias("atl"))


def kept_extremes(spark: SparkSession, fct_path: str, dim: DataFrame, kept_path: str) -> DataFrame:
    """Q-EXTREMES (AG-6) from a table of each day's high and low per symbol at ``kept_path``.

    Only days that the fact table changed since the kept table was last brought
    up to date are read again, as its pointer says; a day that is rewritten
    lower, or goes, takes its extremes with it. A request folds days x symbols
    rows instead of the facts. A version key keeps its symbol for good, so the
    kept rows depend on their day's facts alone.
    """
    at, kept = state(spark, fct_path), state(spark, kept_path)
    days = changed_days(spark, fct_path, kept["info"]["facts"] if kept else None)
    if days or kept is None:
        fct = in_days(read_table(spark, fct_path, at), "price_date", days)
        daily = _with_dim(fct, dim).groupBy("price_date", "symbol").agg(
            F.max("latest_price_usd").alias("ath"), F.min("latest_price_usd").alias("atl"))
        replace_days(spark, daily, kept_path, "price_date", days, info={"facts": at["number"]})
    return read_table(spark, kept_path).groupBy("symbol").agg(F.max("ath").alias("ath"), F.min("atl").alias("atl"))


SERIES_SCHEMA = T.StructType([
    T.StructField("price_date", T.DateType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("price_usd", T.DecimalType(20, 8)),
])


def series(fct: DataFrame, dim: DataFrame, start: dt.date, end: dt.date, symbols: Sequence[str]) -> DataFrame:
    """Q-SERIES: daily prices of chosen symbols in range; no choice -> empty."""
    if not symbols:
        return fct.sparkSession.createDataFrame([], SERIES_SCHEMA)
    j = _with_dim(fct.where(F.col("price_date").between(F.lit(start), F.lit(end))), dim)
    return j.where(F.col("symbol").isin(list(symbols))).select(
        "price_date", "symbol", F.col("latest_price_usd").alias("price_usd")).orderBy("price_date")


def chart_long(series_df: DataFrame, extremes_df: DataFrame) -> DataFrame:
    """Q-CHART + RS-1: price with high/low reference lines, in long form."""
    wide = series_df.join(extremes_df, "symbol", "left").select(
        "price_date", "symbol",
        F.col("price_usd").alias(SERIES_LABELS[0]),
        F.col("ath").alias(SERIES_LABELS[1]),
        F.col("atl").alias(SERIES_LABELS[2]),
    )
    return wide.unpivot(["price_date", "symbol"], SERIES_LABELS, "series", "usd")
