"""The warehouse operators run on the driver tables (the second instance).

``events`` plays both market feeds: view/click/purchase rows are the intraday
snapshot feed (``user_id`` -> id, ``ts`` -> fetched_at, ``value`` -> price,
``props.k`` -> volume, ``value * k`` -> market cap) and signup/error rows are the
once-a-day history feed. ``lineitem`` and ``orders`` carry real duplicates for
the dedup operators; ``customer`` is the top-N source; ``orders`` spans the
calendar.

Every query here reads whole tables. Scalars pulled to the driver are bounded
(a watermark, a max day); nothing else is collected.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tessera.functions.scalar import (
    date_key,
    epoch_ms_to_utc_day,
    iso_utc_to_ntz,
    ntz_epoch,
    ntz_lit,
    surrogate_key,
)
from tessera.operators.asof import asof_join
from tessera.operators.calendar import calendar_from_bounds
from tessera.operators.dedup import latest_per_key
from tessera.operators.rollup import daily_rollup
from tessera.operators.scd2 import OPEN_END, scd2_dimension, scd2_from_observations, scd2_replay
from tessera.plans import market as M
from tessera.sources.landing import (
    flatten_json_column,
    nested_series_daily,
    parse_id_list,
    restrict_to_ids,
    time_range,
    top_n,
)

# Fixed parameters of the driver instance (inputs of the checked queries).
SNAPSHOT_TYPES = ["view", "click", "purchase"]
HISTORY_TYPES = ["signup", "error"]
INCREMENT_CUT = dt.datetime(2024, 1, 20, 12, 0, 0)
FIRST_CUTS = [dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 20)]
STABLE_USERS = [1, 2, 3]
CURATED_IDS = " 7, 42 ,, 99,  131, "
RANGE_START, RANGE_END = "2024-01-05", "2024-01-12T18:30:00+00:00"
CARDS_START, CARDS_END = dt.date(2024, 1, 8), dt.date(2024, 1, 25)
SERIES_SYMBOLS = ["PURCHASE", "O'BRIEN"]
OVERRIDES = [(7, "user-7 (renamed)"), (42, "user-42 (renamed)")]
TOP_N = 50
SERIES_SHIFT_MS = 6 * 3600 * 1000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scd_cuts(events: DataFrame) -> list[dt.datetime]:
    """When the version runs happen: two fixed times, and the day after the newest event, so none is left out."""
    newest = events.agg(F.max("ts")).first()[0]
    last = dt.datetime.combine(newest.date(), dt.time()) + dt.timedelta(days=1) if newest else FIRST_CUTS[-1]
    return [c for c in FIRST_CUTS if c < last] + [last]


def present(df: DataFrame) -> DataFrame:
    """Decimals leave the checked queries as doubles (exact decimal -> nearest double)."""
    cols = [F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name)
            for f in df.schema.fields]
    return df.select(*cols)


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


# ---------------------------------------------------------------- feeds

def snapshot_landing(events: DataFrame, before: dt.datetime | None = None) -> DataFrame:
    e = events.where(F.col("event_type").isin(SNAPSHOT_TYPES))
    if before is not None:
        e = e.where(F.col("ts") < ntz_lit(before))
    return e.select(
        F.col("user_id").alias("id"),
        F.col("event_type").alias("symbol"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("name"),
        F.col("value").alias("current_price"),
        (F.col("value") * _k()).alias("market_cap"),
        _k().cast("double").alias("total_volume"),
        F.col("ts").alias("fetched_at"),
        F.col("ts").alias("_loaded_at"),
    )


def history_landing(events: DataFrame, before: dt.datetime | None = None) -> DataFrame:
    e = events.where(F.col("event_type").isin(HISTORY_TYPES))
    if before is not None:
        e = e.where(F.col("ts") < ntz_lit(before))
    return e.select(
        F.col("user_id").alias("id"),
        F.col("event_type").alias("symbol"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("name"),
        F.col("ts").cast("date").alias("price_date"),
        F.col("value").alias("price"),
        (F.col("value") * _k()).alias("market_cap"),
        _k().cast("double").alias("total_volume"),
        F.col("ts").alias("fetched_at"),
        F.col("ts").alias("_loaded_at"),
    )


class Models:
    """Lazily built models of the events instance for one table folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, before: dt.datetime | None = None):
        self.spark, self.sf_dir, self.before = spark, sf_dir, before
        self.events = read(spark, sf_dir, "events")
        self._cuts: list[dt.datetime] | None = None

    @property
    def cuts(self) -> list[dt.datetime]:
        if self._cuts is None:
            self._cuts = scd_cuts(self.events)
        return self._cuts

    def stg_snap(self, overrides: DataFrame | None = None) -> DataFrame:
        return M.stg_snapshot(snapshot_landing(self.events, self.before), overrides=overrides)

    def stg_hist(self) -> DataFrame:
        return M.stg_history(history_landing(self.events, self.before))

    def int_daily(self) -> DataFrame:
        return M.int_daily(self.stg_snap(), self.stg_hist())

    def attributes_at(self, cut: dt.datetime) -> DataFrame:
        snap = self.stg_snap().where(F.col("fetched_at") < ntz_lit(cut))
        hist = self.stg_hist().where(F.col("fetched_at") < ntz_lit(cut))
        return M.coin_attributes(snap, hist, pick="latest", stable_ids=STABLE_USERS)

    def versions(self) -> DataFrame:
        """History of the runs at ``cuts`` in one pass over the feeds."""
        cols = ["coin_id", "symbol", "name", "fetched_at"]
        obs = self.stg_snap().select(*cols).unionByName(self.stg_hist().select(*cols))
        return scd2_from_observations(obs, "coin_id", ["symbol", "name"], "fetched_at", self.cuts,
                                      pick="latest",
                                      derived={"asset_type": M.asset_class("coin_id", STABLE_USERS)})

    def versions_max(self) -> DataFrame:
        """The reference's attribute rule: lexicographic max over all history (Q6)."""
        cols = ["coin_id", "symbol", "name", "fetched_at"]
        obs = self.stg_snap().select(*cols).unionByName(self.stg_hist().select(*cols))
        return scd2_from_observations(obs, "coin_id", ["symbol", "name"], "fetched_at", self.cuts,
                                      pick="max",
                                      derived={"asset_type": M.asset_class("coin_id", STABLE_USERS)})

    def versions_replayed(self) -> DataFrame:
        """The same history by applying the check strategy run after run."""
        snaps = [(cut, self.attributes_at(cut)) for cut in self.cuts]
        return scd2_replay(snaps, "coin_id", ["symbol", "name", "asset_type"])

    def dim(self) -> DataFrame:
        return scd2_dimension(self.versions(), "coin_id", ["symbol", "name", "asset_type"], "coin_sk")

    def fct_daily(self) -> DataFrame:
        return M.fct_daily_market(self.int_daily(), self.dim())

    def fct_snapshot(self) -> DataFrame:
        return M.fct_market_snapshot(self.stg_snap(), self.dim())

    def dim_date(self) -> DataFrame:
        bounds = self.stg_snap().select("price_date").unionByName(self.stg_hist().select("price_date")).agg(
            F.min("price_date").alias("lo"), F.max("price_date").alias("hi"))
        return calendar_from_bounds(bounds, "lo", "hi", forward_days=3)


def _scalar(df: DataFrame):
    return df.first()[0]


# ---------------------------------------------------------------- checked queries

def q_stg_events(spark, sf):
    return present(Models(spark, sf).stg_snap())


def q_stg_history(spark, sf):
    return present(Models(spark, sf).stg_hist())


LINEITEM_KEYS = ["l_orderkey", "l_linenumber"]


def q_dedup_lineitem(spark, sf):
    li = read(spark, sf, "lineitem")
    return latest_per_key(li, LINEITEM_KEYS, ["l_shipdate", "l_extendedprice"])


def q_dedup_orders(spark, sf):
    o = read(spark, sf, "orders").withColumn("o_orderday", F.col("o_orderdate").cast("date"))
    return latest_per_key(o, ["o_custkey", "o_orderday"], ["o_orderdate", "o_orderkey"])


def q_curated_feed(spark, sf):
    e = read(spark, sf, "events")
    return restrict_to_ids(e, "user_id", parse_id_list(CURATED_IDS, int))


MANY_IDS = list(range(1, 12_001))


def q_curated_many(spark, sf):
    """SRC-4 with a long list: the same plan, the same column order."""
    return restrict_to_ids(read(spark, sf, "lineitem"), "l_orderkey", MANY_IDS)


def q_average_rounding(spark, sf):
    """AG-1 on groups of many rows whose exact average lies just under a rounding step: one cent for just
    under half of a group's rows, nothing for the rest, must average to nothing."""
    li = read(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                            "l_shipdate")
    # the n-th row of a flag, counted over cells of its hash order and then inside a cell: no flag is one group
    order = [F.col("at"), F.col("l_orderkey"), F.col("l_linenumber")]
    li = li.withColumn("at", F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"))
    li = li.withColumn("cell", F.shiftright("at", 52))
    cells = li.groupBy("l_returnflag", "cell").agg(F.count(F.lit(1)).alias("n"))
    flag = Window.partitionBy("l_returnflag")
    upto = flag.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("l_returnflag", "cell", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"),
                         F.expr("(sum(n) over (partition by l_returnflag) - 1) div 2").alias("half"))
    ranked = li.withColumn("inside", F.row_number().over(Window.partitionBy("l_returnflag", "cell").orderBy(*order)))
    cents = ranked.join(cells, ["l_returnflag", "cell"]).withColumn(
        "cents", F.when(F.col("before") + F.col("inside") <= F.col("half"), F.lit("0.01")).otherwise("0.00").cast("decimal(28,2)"))
    rolled = daily_rollup(cents, ["l_returnflag"], "l_shipdate", {"avg_cents": ("cents", 2)}, {"any_cents": "l_returnflag"})
    return present(rolled.select("l_returnflag", "extract_count", "avg_cents"))


def q_source_topn(spark, sf):
    c = read(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return top_n(c, [F.col("c_acctbal").desc(), F.col("c_custkey").asc()], TOP_N, rank_col="rank")


def q_range_extract(spark, sf):
    e = read(spark, sf, "events")
    r = time_range(e, "ts", RANGE_START, RANGE_END)
    return r.select("event_id", "user_id", "event_type", "ts",
                    ntz_epoch("ts").alias("epoch_s"))


def q_json_flatten(spark, sf):
    e = read(spark, sf, "events")
    flat = flatten_json_column(e, "props", "k DECIMAL(10,2), note STRING, `a, b` STRUCT<c: INT, d: DECIMAL(5,1)>",
                               required=["k"], prefix="prop_")
    return flat.select("event_id", "user_id", F.col("prop_k").cast("bigint").alias("prop_k"), "prop_note")


def history_payloads(events: DataFrame) -> DataFrame:
    """One backfill-shaped document per event: price points at ts and ts+6h,
    a cap point at ts only, a volume point at ts+6h (none for error events)."""
    ms = ntz_epoch("ts", "MILLISECOND")
    k = _k().cast("double")
    p2 = F.col("value") + k / F.lit(100.0)
    payload = F.struct(
        F.array(F.array(ms.cast("double"), F.col("value")),
                F.array((ms + SERIES_SHIFT_MS).cast("double"), p2)).alias("prices"),
        F.array(F.array(ms.cast("double"), F.col("value") * k)).alias("market_caps"),
        F.when(F.col("event_type") != "error",
               F.array(F.array((ms + SERIES_SHIFT_MS).cast("double"), k))).alias("total_volumes"),
    )
    return events.select("event_id", F.col("user_id").alias("id"), F.to_json(payload).alias("payload"))


def q_nested_series_daily(spark, sf):
    docs = history_payloads(read(spark, sf, "events"))
    return nested_series_daily(docs, ["event_id", "id"], "payload")


def q_daily_rollup(spark, sf):
    return present(M.snapshot_daily(Models(spark, sf).stg_snap()))


def q_latest_per_day(spark, sf):
    o = read(spark, sf, "orders").withColumn("o_month", F.trunc(F.col("o_orderdate").cast("date"), "month"))
    latest = F.max_by(F.struct("o_orderkey", "o_totalprice", "o_orderstatus"),
                      F.struct("o_orderdate", "o_orderkey"))
    g = o.groupBy("o_custkey", "o_month").agg(latest.alias("l"), F.count(F.lit(1)).alias("n_orders"))
    return g.select("o_custkey", "o_month", "n_orders",
                    F.col("l.o_orderkey").alias("latest_orderkey"),
                    F.col("l.o_totalprice").alias("latest_totalprice"),
                    F.col("l.o_orderstatus").alias("latest_status"))


def q_unified_daily(spark, sf):
    return present(Models(spark, sf).int_daily())


def _increment_mark(spark, sf) -> dt.datetime:
    target = Models(spark, sf, before=INCREMENT_CUT).int_daily()
    return _scalar(target.agg(F.max("_synced_at")))


def q_touched_days(spark, sf):
    m = Models(spark, sf)
    mark = _increment_mark(spark, sf)
    return M.touched_keys([m.stg_snap(), m.stg_hist()], M.DAILY_KEYS, "fetched_at", mark)


def q_touched_recompute(spark, sf):
    m = Models(spark, sf)
    mark = _increment_mark(spark, sf)
    return present(M.int_daily(m.stg_snap(), m.stg_hist(), mark=mark))


RETURN_COLUMNS = ["coin_id", "price_date", "latest_price_usd", "prev_latest_price_usd", "daily_return_pct"]


def q_daily_returns(spark, sf):
    wr = M.daily_with_returns(Models(spark, sf).int_daily())
    return present(wr.select(*RETURN_COLUMNS))


def q_bounded_returns(spark, sf):
    old = Models(spark, sf, before=INCREMENT_CUT).int_daily()
    row = old.agg(F.max("_synced_at").alias("m"), F.max("price_date").alias("d")).first()
    daily = Models(spark, sf).int_daily()
    window = daily.where(F.col("price_date") >= F.date_sub(F.lit(row["d"]), 3))
    wr = M.daily_with_returns(window).where(F.col("_synced_at") > ntz_lit(row["m"]))
    return present(wr.select(*RETURN_COLUMNS, "_synced_at"))


def _ts_text(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.date_format(c, "yyyy-MM-dd HH:mm:ss"))
    return df


def q_scd2_versions(spark, sf):
    return _ts_text(Models(spark, sf).versions(), "version_from", "version_to")


def q_scd2_versions_max(spark, sf):
    return _ts_text(Models(spark, sf).versions_max(), "version_from", "version_to")


def q_scd2_dim(spark, sf):
    return _ts_text(Models(spark, sf).dim(), "valid_from", "valid_to")


def q_asof_ts(spark, sf):
    return present(Models(spark, sf).fct_snapshot())


def q_asof_day(spark, sf):
    return present(Models(spark, sf).fct_daily())


def _event_versions(events: DataFrame) -> DataFrame:
    """A version of the user from each view to the next: dozens to thousands a user."""
    views = events.where("event_type = 'view'").groupBy("user_id", "ts").agg(F.max("event_id").alias("view_id"))
    until = F.lead("ts").over(Window.partitionBy("user_id").orderBy("ts"))
    return views.select(F.col("view_id").alias("view_sk"), "user_id", F.col("ts").alias("valid_from"),
                        F.coalesce(until, ntz_lit(OPEN_END)).alias("valid_to"))


def _span(events: DataFrame) -> tuple[dt.date, dt.date]:
    lo, hi = events.agg(F.min("ts"), F.max("ts")).first()
    return ((lo or dt.datetime.min).date(), (hi or dt.datetime.min).date())


def q_asof_many_versions(spark, sf):
    """J-1 by merge: the view in effect at every other event, months of a user being sorted apart."""
    events = read(spark, sf, "events")
    facts = events.where("event_type <> 'view'").select("event_id", "user_id", "ts")
    return asof_join(facts, _event_versions(events), "user_id", "ts", sk_col="view_sk", method="merge", span=_span(events))


def q_asof_many_versions_day(spark, sf):
    """J-2 by merge: the last view of the event's day, or the one in effect before."""
    events = read(spark, sf, "events")
    facts = events.where("event_type <> 'view'").select("event_id", "user_id", F.col("ts").cast("date").alias("day"))
    return asof_join(facts, _event_versions(events), "user_id", "day", "day", "view_sk", "merge", _span(events), "year")


def q_dim_calendar(spark, sf):
    o = read(spark, sf, "orders")
    bounds = o.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    return calendar_from_bounds(bounds, "lo", "hi", forward_days=3)


def q_surrogate_keys(spark, sf):
    e = read(spark, sf, "events")
    return e.select("event_id", surrogate_key("user_id", "ts").alias("snapshot_sk"),
                    surrogate_key("user_id", F.col("ts").cast("date")).alias("daily_sk"),
                    date_key("ts").alias("date_sk"))


def q_attr_class(spark, sf):
    e = read(spark, sf, "events").select(F.col("user_id").alias("coin_id")).distinct()
    return e.withColumn("asset_type", M.asset_class("coin_id", STABLE_USERS))


def q_attr_override(spark, sf):
    ov = spark.createDataFrame(OVERRIDES, "coin_id long, name string")
    s = Models(spark, sf).stg_snap(overrides=ov)
    return s.select("coin_id", "name").distinct()


def q_epoch_days(spark, sf):
    e = read(spark, sf, "events")
    ms = ntz_epoch("ts", "MILLISECOND")
    return e.select("event_id", ms.alias("epoch_ms"), epoch_ms_to_utc_day(ms).alias("utc_day"),
                    iso_utc_to_ntz(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
                                            F.lit("+02:00"))).alias("utc_ts"))


QUERIES = {
    "stg_events": q_stg_events,
    "stg_history": q_stg_history,
    "dedup_lineitem": q_dedup_lineitem,
    "dedup_orders": q_dedup_orders,
    "curated_feed": q_curated_feed,
    "curated_many": q_curated_many,
    "average_rounding": q_average_rounding,
    "source_topn": q_source_topn,
    "range_extract": q_range_extract,
    "json_flatten": q_json_flatten,
    "nested_series_daily": q_nested_series_daily,
    "daily_rollup": q_daily_rollup,
    "latest_per_day": q_latest_per_day,
    "unified_daily": q_unified_daily,
    "touched_days": q_touched_days,
    "touched_recompute": q_touched_recompute,
    "daily_returns": q_daily_returns,
    "bounded_returns": q_bounded_returns,
    "scd2_versions": q_scd2_versions,
    "scd2_versions_max": q_scd2_versions_max,
    "scd2_dim": q_scd2_dim,
    "asof_ts": q_asof_ts,
    "asof_day": q_asof_day,
    "asof_many_versions": q_asof_many_versions,
    "asof_many_versions_day": q_asof_many_versions_day,
    "dim_calendar": q_dim_calendar,
    "surrogate_keys": q_surrogate_keys,
    "attr_class": q_attr_class,
    "attr_override": q_attr_override,
    "epoch_days": q_epoch_days,
}
