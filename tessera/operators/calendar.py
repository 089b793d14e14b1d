"""Calendar dimension (SK-5, SF-8..11).

The spine is ``[start, end)`` — end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalar import date_key, iso_day_of_week


def calendar_columns(day: Column) -> list[Column]:
    d = day.cast("date")
    return [
        date_key(d).alias("date_sk"),
        d.alias("date_day"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.monthname(d).alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"),
        iso_day_of_week(d).alias("iso_day_of_week"),
        iso_day_of_week(d).isin(6, 7).alias("is_weekend"),
    ]


def calendar_from_bounds(bounds: DataFrame, start_col: str, end_col: str, forward_days: int = 3) -> DataFrame:
    """Spine from a one-row frame of data-derived bounds: ``[start, end + buffer)``.

    ``forward_days`` is the reference's forward buffer (Q17). Stays lazy: the
    bounded day list is produced by one ``sequence`` explode.
    """
    # sequence() is inclusive, so the last generated day is end + buffer - 1
    last = F.date_add(F.col(end_col).cast("date"), forward_days - 1)
    # (sequence() counts backwards from a start after its end; the spine is then empty)
    some = bounds.where(F.col(start_col).cast("date") <= last)
    days = some.select(F.explode(F.sequence(F.col(start_col).cast("date"), last)).alias("d"))
    return days.select(*calendar_columns(F.col("d")))
