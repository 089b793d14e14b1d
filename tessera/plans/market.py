"""The market warehouse as DataFrame functions: landing -> silver -> SCD2 -> gold.

Each model is ``(inputs..., params) -> DataFrame``; the build order is plain
function calls (no scheduler). Incremental variants take an explicit
watermark (read from the target once, a bounded scalar) instead of a scalar
subquery, so the filter reaches the Parquet scan as a literal.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scalar import date_key, ntz_lit, surrogate_key
from tessera.operators.dedup import latest_per_key, reject
from tessera.operators.returns import with_period_return
from tessera.operators.rollup import (
    STATE,
    daily_rollup,
    finish_rollup,
    merge_states,
    prioritized_union,
    rollup_state,
    single_row_daily,
)

# Typed targets of the cleaned feeds (name, source column, type).
SNAPSHOT_COLUMNS = [
    ("coin_id", "id", None),
    ("symbol", "symbol", "upper"),
    ("name", "name", None),
    ("price_usd", "current_price", "decimal(20,8)"),
    ("market_cap_usd", "market_cap", "decimal(28,2)"),
    ("volume_24h_usd", "total_volume", "decimal(28,2)"),
    ("price_change_24h", "price_change_24h", "decimal(20,8)"),
    ("price_change_pct_24h", "price_change_pct_24h", "round4"),
    ("high_24h", "high_24h", "decimal(20,8)"),
    ("low_24h", "low_24h", "decimal(20,8)"),
    ("circulating_supply", "circulating_supply", "decimal(28,2)"),
    ("all_time_high", "ath", "decimal(20,8)"),
    ("fetched_at", "fetched_at", None),
    ("price_date", "fetched_at", "date"),
    ("_loaded_at", "_loaded_at", None),
]
HISTORY_COLUMNS = [
    ("coin_id", "id", None),
    ("symbol", "symbol", "upper"),
    ("name", "name", None),
    ("price_date", "price_date", "date"),
    ("price_usd", "price", "decimal(20,8)"),
    ("market_cap_usd", "market_cap", "decimal(28,2)"),
    ("volume_usd", "total_volume", "decimal(28,2)"),
    ("fetched_at", "fetched_at", None),
    ("_loaded_at", "_loaded_at", None),
]

# Ids classed as stablecoins in the reference's version history.
STABLECOIN_IDS = ["tether", "usd-coin", "dai"]

def _typed(src: str, how: str | None) -> Column:
    c = F.col(src)
    if how is None:
        return c
    if how == "upper":
        return F.upper(c)
    if how == "round4":
        return F.round(c, 4)
    if how == "date":
        return c.cast("date")
    return c.cast(how)


def typed_select(df: DataFrame, spec: Sequence[tuple[str, str, str | None]]) -> DataFrame:
    """PF-1: rename + cast + order; columns absent from the input are skipped."""
    have = set(df.columns)
    return df.select(*[_typed(src, how).alias(out) for out, src, how in spec if src in have])


def apply_overrides(df: DataFrame, overrides: DataFrame | None, key: str, cols: Sequence[str]) -> DataFrame:
    """PF-8: attribute overrides from a mapping table, else the value.

    The reference hard-codes one temporary rename; here it is data. The map
    must hold a key once: a second entry would multiply rows, so it is refused.
    """
    if overrides is None:
        return df
    if overrides.groupBy(key).count().where("count > 1").limit(1).count():
        raise ValueError(f"the override map holds a {key} twice")
    o = overrides.select(F.col(key), *[F.col(c).alias(f"__ovr_{c}") for c in cols])
    j = df.join(o, key, "left")
    for c in cols:
        j = j.withColumn(c, F.coalesce(F.col(f"__ovr_{c}"), F.col(c)))
    return j.select(*df.columns)


def after_mark(df: DataFrame, ts_col: str, mark: dt.datetime | None, day_col: str | None = None) -> DataFrame:
    """PF-3: ``ts > mark``; also ``day >= date(mark)`` so partitions are pruned."""
    if mark is None:
        return df
    out = df.where(F.col(ts_col) > ntz_lit(mark))
    if day_col is not None and day_col in df.columns:
        out = out.where(F.col(day_col) >= F.lit(mark.date()))
    return out


# ---------------------------------------------------------------- silver

REJECTED = "_rejected"


def _judged(newest: DataFrame, price: str, identity: Sequence[str], keep_rejects: bool) -> DataFrame:
    """PF-2 after the dedup; with ``keep_rejects`` a rejected row stays as a tombstone: its identity and ``_rejected``.

    A table of such rows remembers that a key's newest row was bad, so that an
    older good one, which a later batch may bring, does not take its place.
    """
    good = F.coalesce(F.col(price) > 0, F.lit(False))
    if not keep_rejects:
        return reject(newest, F.col("id").isNotNull() & good)
    kept = newest.where(F.col("id").isNotNull()).withColumn(REJECTED, ~good)
    return kept.select(*[c if c in (*identity, REJECTED) else F.when(good, F.col(c)).alias(c) for c in kept.columns])


def without_rejects(df: DataFrame) -> DataFrame:
    # rows written before tombstones were kept have no flag
    return df.where(~F.coalesce(F.col(REJECTED), F.lit(False))).drop(REJECTED) if REJECTED in df.columns else df


def stg_snapshot(raw: DataFrame, mark: dt.datetime | None = None,
                 overrides: DataFrame | None = None, mark_col: str = "fetched_at", keep_rejects: bool = False) -> DataFrame:
    """Cleaned snapshot: watermark -> newest per (id, fetched_at) -> typed -> reject.

    ``mark_col='_loaded_at'`` (Q1 option) also takes rows that land late with
    an older event time; the reference marks on ``fetched_at``.
    """
    src = after_mark(raw, mark_col, mark, "fetched_day" if mark_col == "fetched_at" else None)
    newest = latest_per_key(src, ["id", "fetched_at"], ["_loaded_at"])
    kept = _judged(newest, "current_price", ("id", "fetched_at", "_loaded_at"), keep_rejects)
    out = typed_select(kept, [*SNAPSHOT_COLUMNS, (REJECTED, REJECTED, None)])
    return apply_overrides(out, overrides, "coin_id", ["name"])


def stg_history(raw: DataFrame, mark: dt.datetime | None = None,
                overrides: DataFrame | None = None, mark_col: str = "fetched_at", keep_rejects: bool = False) -> DataFrame:
    """Cleaned history: newest per (id, price_date) by fetched_at, _loaded_at."""
    src = after_mark(raw, mark_col, mark)
    newest = latest_per_key(src, ["id", "price_date"], ["fetched_at", "_loaded_at"])
    kept = _judged(newest, "price", ("id", "price_date", "fetched_at", "_loaded_at"), keep_rejects)
    out = typed_select(kept, [*HISTORY_COLUMNS, (REJECTED, REJECTED, None)])
    return apply_overrides(out, overrides, "coin_id", ["name"])


DAILY_KEYS = ["coin_id", "price_date"]
DAILY_COLUMNS = [
    "coin_id", "symbol", "name", "price_date", "extract_count",
    "avg_price_usd", "avg_market_cap_usd", "avg_volume_usd",
    "latest_price_usd", "latest_market_cap_usd", "latest_volume_usd",
    "source_name", "_synced_at",
]


SNAPSHOT_AVERAGES = {
    "avg_price_usd": ("price_usd", 8),
    "avg_market_cap_usd": ("market_cap_usd", 2),
    "avg_volume_usd": ("volume_24h_usd", 2),
}
SNAPSHOT_LATEST = {
    "symbol": "symbol",
    "name": "name",
    "latest_price_usd": "price_usd",
    "latest_market_cap_usd": "market_cap_usd",
    "latest_volume_usd": "volume_24h_usd",
}


def _of_feed(stg_snap: DataFrame) -> tuple[dict, dict]:
    have = set(stg_snap.columns)
    return ({k: v for k, v in SNAPSHOT_AVERAGES.items() if v[0] in have},
            {k: v for k, v in SNAPSHOT_LATEST.items() if v in have})


def snapshot_daily(stg_snap: DataFrame, keep_state: bool = False) -> DataFrame:
    """AG-1 + AG-2 over the intraday feed."""
    return daily_rollup(stg_snap, DAILY_KEYS, "fetched_at", *_of_feed(stg_snap), keep_state=keep_state)


def merged_snapshot_daily(old: DataFrame, new_rows: DataFrame) -> DataFrame:
    """AG-1 + AG-2 of keys whose state so far is ``old`` (keys, _state) and that got ``new_rows``; no old row is read."""
    averages, latest = _of_feed(new_rows)
    states = old.unionByName(rollup_state(new_rows, DAILY_KEYS, "fetched_at", averages, latest))
    kinds = {out: (new_rows.schema[src].dataType, digits) for out, (src, digits) in averages.items()}
    return finish_rollup(merge_states(states, DAILY_KEYS), DAILY_KEYS, kinds, list(latest), keep_state=True)


def history_daily(stg_hist: DataFrame) -> DataFrame:
    """AG-3 over the one-row-per-day backfill feed."""
    have = set(stg_hist.columns)
    averages = {k: v for k, v in {"avg_price_usd": "price_usd", "avg_market_cap_usd": "market_cap_usd",
                                  "avg_volume_usd": "volume_usd"}.items() if v in have}
    latest = {k: v for k, v in {"latest_price_usd": "price_usd", "latest_market_cap_usd": "market_cap_usd",
                                "latest_volume_usd": "volume_usd"}.items() if v in have}
    carry = [c for c in ("symbol", "name") if c in have]
    return single_row_daily(stg_hist, DAILY_KEYS, "fetched_at", averages, latest, carry=carry)


def touched_keys(feeds: Sequence[DataFrame], keys: Sequence[str], ts_col: str,
                 mark: dt.datetime | None | Sequence, day_cols: Sequence[str | None] | None = None) -> DataFrame:
    """PF-3 + ST-1 + AG-7: distinct keys with a row newer than the mark in any feed.

    ``mark`` is one value for all feeds (reference, Q2) or one per feed.
    ``day_cols`` names, per feed, the partition column cut from ``ts_col``, so
    that days before the mark's are not read.
    """
    marks = list(mark) if isinstance(mark, (list, tuple)) else [mark] * len(feeds)
    parts = [after_mark(f.select(*keys, ts_col), ts_col, m, d)
             for f, m, d in zip(feeds, marks, day_cols or [None] * len(feeds))]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.select(*keys).distinct()


def restrict_to_keys(df: DataFrame, keys_df: DataFrame, keys: Sequence[str],
                     days: Sequence[dt.date] | None = None, day_col: str = "price_date") -> DataFrame:
    """PF-5 / J-3: composite-key IN as a left-semi join.

    ``days`` (the distinct touched days, a bounded list) becomes an ``isin`` on
    the partition column first, so a day-partitioned table is pruned before the
    semi-join reads it.
    """
    if days is not None:
        df = df.where(F.col(day_col).isin(list(days)))
    return df.join(keys_df, list(keys), "left_semi")


def int_daily(stg_snap: DataFrame, stg_hist: DataFrame, mark=None,
              touched_days: Sequence[dt.date] | None = None, mark_col: str = "fetched_at",
              keep_state: bool = False) -> DataFrame:
    """Unified daily grain; with ``mark`` only touched (coin, day) are recomputed,
    each from *all* of its rows (SK-2). Snapshot beats history. ``mark`` may be
    one value for both feeds (reference) or a ``(snapshot, history)`` pair."""
    snap, hist = stg_snap, stg_hist
    if mark is not None:
        touched = touched_keys([stg_snap, stg_hist], DAILY_KEYS, mark_col, mark)
        snap = restrict_to_keys(snap, touched, DAILY_KEYS, touched_days)
        hist = restrict_to_keys(hist, touched, DAILY_KEYS, touched_days)
    return unified_daily(snapshot_daily(snap, keep_state), hist)


def unified_daily(snap_daily: DataFrame, stg_hist: DataFrame) -> DataFrame:
    """ST-1 + W-3: snapshot days before history days."""
    unified = prioritized_union([("snapshot", snap_daily), ("history", history_daily(stg_hist))], DAILY_KEYS)
    return unified.select(*[c for c in [*DAILY_COLUMNS, STATE] if c in unified.columns])


# ---------------------------------------------------------------- version history input

def attributes_daily(stg_snap: DataFrame, stg_hist: DataFrame) -> DataFrame:
    """What each day says of a coin: the largest and the newest attribute values (AG-4 by day)."""
    cols = ["coin_id", "price_date", "symbol", "name", "fetched_at"]
    rows = stg_snap.select(*cols).unionByName(stg_hist.select(*cols))
    return rows.groupBy("coin_id", "price_date").agg(
        F.max("symbol").alias("max_symbol"), F.max("name").alias("max_name"),
        F.max(F.struct("fetched_at", "symbol", "name")).alias("newest"))


def attributes_of(daily: DataFrame, pick: str = "max", stable_ids: Sequence = tuple(STABLECOIN_IDS)) -> DataFrame:
    """ST-2 + AG-4 + PF-7: one attribute row per coin from ``attributes_daily``.

    ``pick='max'`` is the reference (lexicographic max over all history, Q6);
    ``pick='latest'`` takes the values of the newest fetch instead.
    """
    if pick == "max":
        per = daily.groupBy("coin_id").agg(F.max("max_symbol").alias("symbol"), F.max("max_name").alias("name"))
    elif pick == "latest":
        per = daily.groupBy("coin_id").agg(F.max("newest").alias("a")).select("coin_id", "a.symbol", "a.name")
    else:
        raise ValueError(f"unknown pick {pick!r}")
    return per.withColumn("asset_type", asset_class("coin_id", stable_ids))


def coin_attributes(stg_snap: DataFrame, stg_hist: DataFrame, pick: str = "max",
                    stable_ids: Sequence = tuple(STABLECOIN_IDS)) -> DataFrame:
    """One attribute row per coin, straight from the cleaned feeds."""
    day = lambda d: d if "price_date" in d.columns else d.withColumn("price_date", F.col("fetched_at").cast("date"))
    return attributes_of(attributes_daily(day(stg_snap), day(stg_hist)), pick, stable_ids)


def asset_class(col: str, stable_ids: Sequence) -> Column:
    """PF-7: id in the curated list -> 'stablecoin', else 'coin'."""
    return F.when(F.col(col).isin(list(stable_ids)), F.lit("stablecoin")).otherwise(F.lit("coin"))


# ---------------------------------------------------------------- gold facts

SNAPSHOT_FACT_MEASURES = [
    "price_usd", "market_cap_usd", "volume_24h_usd", "price_change_24h", "price_change_pct_24h",
    "high_24h", "low_24h", "circulating_supply", "all_time_high",
]


def fct_market_snapshot(stg_snap: DataFrame, dim: DataFrame, mark: dt.datetime | None = None,
                        method: str = "residual", span: tuple[dt.date, dt.date] | None = None) -> DataFrame:
    """One row per coin per fetch, ``coin_sk`` resolved as-of fetch time (J-1); ``method`` and ``span`` as in asof."""
    from tessera.operators.asof import asof_join

    snap = after_mark(stg_snap, "fetched_at", mark, "price_date")
    keyed = snap.withColumn("snapshot_sk", surrogate_key("coin_id", "fetched_at"))
    joined = asof_join(keyed, dim, "coin_id", "fetched_at", grain="ts", method=method, span=span)
    measures = [c for c in SNAPSHOT_FACT_MEASURES if c in joined.columns]
    return joined.select(
        "snapshot_sk", "coin_sk", date_key("price_date").alias("date_sk"), "fetched_at", *measures
    )


DAILY_FACT_COLUMNS = [
    "daily_market_sk", "coin_sk", "date_sk", "price_date", "extract_count",
    "avg_price_usd", "avg_market_cap_usd", "avg_volume_usd",
    "latest_price_usd", "latest_market_cap_usd", "latest_volume_usd",
    "prev_latest_price_usd", "daily_return_pct", "_synced_at",
]


def daily_with_returns(daily: DataFrame, few_days: bool = False) -> DataFrame:
    """W-5 by calendar years, or in one group a coin where ``few_days`` of each are given."""
    return with_period_return(daily, "coin_id", "price_date", "latest_price_usd",
                              slices=None if few_days else F.year("price_date"))


def finish_daily_fact(wr: DataFrame, dim: DataFrame, method: str = "residual",
                      span: tuple[dt.date, dt.date] | None = None) -> DataFrame:
    from tessera.operators.asof import asof_join

    keyed = wr.withColumn("daily_market_sk", surrogate_key("coin_id", "price_date"))
    joined = asof_join(keyed, dim, "coin_id", "price_date", grain="day", method=method, span=span, period="year")
    out = joined.withColumn("date_sk", date_key("price_date"))
    return out.select(*[c for c in DAILY_FACT_COLUMNS if c in out.columns])


def fct_daily_market(
    daily: DataFrame,
    dim: DataFrame,
    mark: dt.datetime | None = None,
    max_day: dt.date | None = None,
    lookback_days: int = 3,
    method: str = "residual",
    span: tuple[dt.date, dt.date] | None = None,
) -> DataFrame:
    """SK-10: daily fact with day-over-day return on the latest price.

    Full build when ``mark`` is None. Otherwise the reference's bounded
    increment: read ``price_date >= max_day - lookback``, lag inside that
    window, keep rows with ``_synced_at > mark``.
    """
    if mark is None:
        return finish_daily_fact(daily_with_returns(daily), dim, method, span)
    window = daily
    if max_day is not None:
        window = daily.where(F.col("price_date") >= F.date_sub(F.lit(max_day), lookback_days))
    wr = daily_with_returns(window, few_days=max_day is not None).where(F.col("_synced_at") > ntz_lit(mark))
    return finish_daily_fact(wr, dim, method, span)


def exact_daily_market(daily: DataFrame, dim: DataFrame, days: Sequence[str | None],
                       lookback_days: int = 3) -> DataFrame:
    """SK-10 without Q4's edge cases: all rows of the given days and each one's successor.

    Only the days from ``lookback_days`` before the first given day to as many
    after the last are read, plus, for coins whose neighbour is not among
    them, the nearest older or newer row. Rows of the NULL day have no
    neighbours in time and are recomputed with the rest of their coin's.
    """
    known = sorted(d for d in days if d is not None)
    if not known:
        return finish_daily_fact(daily_with_returns(daily.where(F.col("price_date").isNull()), few_days=True), dim)
    first, last = (F.lit(d).cast("date") for d in (known[0], known[-1]))
    lo, hi = F.date_sub(first, lookback_days), F.date_add(last, lookback_days)
    window = daily.where((F.col("price_date") >= lo) & (F.col("price_date") <= hi))
    given = F.col("price_date").isin([F.lit(d).cast("date") for d in known])
    coins = window.where(given).select("coin_id").distinct()
    window = window.join(coins, "coin_id", "left_semi")
    ends = window.groupBy("coin_id").agg(F.min("price_date").alias("lo"), F.max("price_date").alias("hi"),
                                         F.min(F.when(given, F.col("price_date"))).alias("t0"),
                                         F.max(F.when(given, F.col("price_date"))).alias("t1"))
    # coins that lack a predecessor or a successor of a given day in the window
    older = (daily.where(F.col("price_date") < lo).join(ends.where("lo = t0").select("coin_id"), "coin_id", "left_semi")
             .groupBy("coin_id").agg(F.max_by(F.struct(*daily.columns), "price_date").alias("r")).select("r.*"))
    newer = (daily.where(F.col("price_date") > hi).join(ends.where("hi = t1").select("coin_id"), "coin_id", "left_semi")
             .groupBy("coin_id").agg(F.min_by(F.struct(*daily.columns), "price_date").alias("r")).select("r.*"))
    rows = window.unionByName(older).unionByName(newer)
    by_day = Window.partitionBy("coin_id").orderBy("price_date")
    wr = daily_with_returns(rows, few_days=True).withColumn("__t", given)
    wr = wr.withColumn("__p", F.coalesce(F.lag("__t").over(by_day), F.lit(False))).where("__t or __p").drop("__t", "__p")
    if None in days:
        wr = wr.unionByName(daily_with_returns(daily.where(F.col("price_date").isNull()), few_days=True))
    return finish_daily_fact(wr, dim)
