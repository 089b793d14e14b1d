"""Checked queries that build persisted tables and read them back.

The events instance is built as a real warehouse: three incremental builds,
each over the landing as it stood at one of ``scd_cuts`` (rows before the
cut) and stamped ``as_of`` that cut. The final tables must equal a one-shot
build of the same data (the oracle), which is the batch-vs-incremental
equivalence check. Builds go to a fresh folder under the shared checkpoint
root and are reused by the queries of one process.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.scalar import ntz_lit, price_text, signed_pct_text
from tessera.operators import incremental as I
from tessera.operators import marts as Q
from tessera.operators.quality import Check, run_checks
from tessera.operators.rollup import STATE
from tessera.plans import events as E
from tessera.plans import events_sql as S
from tessera.plans import market as M
from tessera.plans.pipeline import Warehouse
from tessera.plans.sqlkit import exact_pct, sql_list
from tessera.session import scratch_dir
from tessera.streaming import stream as ST

_BUILT: dict[tuple, Warehouse] = {}
#: Load times of the two batches of ``landing_append``.
LOADED = (dt.datetime(2024, 2, 1, 6), dt.datetime(2024, 2, 1, 12))


def _landings(events: DataFrame, cut) -> tuple[DataFrame, DataFrame]:
    return E.snapshot_landing(events, cut), E.history_landing(events, cut)


def _warehouse(spark: SparkSession, sf: str, env: str = "dev") -> Warehouse:
    key = (spark.sparkContext.applicationId, sf, env)
    if key in _BUILT:
        return _BUILT[key]
    root = scratch_dir(spark, "warehouse")
    wh = Warehouse(spark, root, env, pick="latest", stable_ids=E.STABLE_USERS, daily_mode="exact")
    events = E.read(spark, sf, "events")
    for cut in E.scd_cuts(events):
        wh.build(*_landings(events, cut), as_of=cut)
    _BUILT[key] = wh
    return wh


def q_upsert_result(spark, sf):
    return E.present(_warehouse(spark, sf).table("int_daily"))


def q_incremental_fct_daily(spark, sf):
    return E.present(_warehouse(spark, sf).table("fct_daily_market"))


def q_incremental_fct_snapshot(spark, sf):
    return E.present(_warehouse(spark, sf).table("fct_market_snapshot"))


def q_incremental_dim(spark, sf):
    return E._ts_text(_warehouse(spark, sf).table("dim_coin"), "valid_from", "valid_to")


def q_dq_report(spark, sf):
    return _warehouse(spark, sf).quality_report()


def q_full_refresh(spark, sf):
    """Incremental build at the first cut, then a full refresh over all data."""
    wh = Warehouse(spark, scratch_dir(spark, "warehouse-fr"), "qa", pick="latest", stable_ids=E.STABLE_USERS)
    events = E.read(spark, sf, "events")
    first, *_, last = E.scd_cuts(events)
    wh.build(E.snapshot_landing(events, first), E.history_landing(events, first), as_of=first)
    wh.build(E.snapshot_landing(events, last), E.history_landing(events, last), as_of=last, full_refresh=True)
    return E.present(wh.table("int_daily"))


def q_schema_sync(spark, sf):
    """The target was written by an older model (no avg_volume_usd, an extra
    legacy column); the next increment syncs it to the current model schema."""
    wh = Warehouse(spark, scratch_dir(spark, "warehouse-sync"), "dev", pick="latest",
                   stable_ids=E.STABLE_USERS)
    events = E.read(spark, sf, "events")
    first, *_, last = E.scd_cuts(events)
    wh.build_silver(E.snapshot_landing(events, first), E.history_landing(events, first))
    old = wh.table("int_daily").drop("avg_volume_usd").withColumn("legacy_flag", F.lit(True))
    I.replace(spark, old, wh.path("int_daily"), "price_date")
    wh.build_silver(E.snapshot_landing(events, last), E.history_landing(events, last))
    # a reader that knows nothing of the writer gets the current columns, the rollup's state among them
    return E.present(I.read_table(spark, wh.path("int_daily")).drop(STATE))


def _land_in_files(events: DataFrame, folder: str, files: list[int]) -> None:
    """Write some of the five arrivals that the events are dealt to by hash: every arrival spans all times."""
    dealt = events.withColumn("arrival", F.pmod(F.xxhash64("event_id"), F.lit(5)))
    for n in files:
        dealt.where(F.col("arrival") == n).drop("arrival").write.parquet(f"{folder}/arrival={n}")


def _land_in_time(events: DataFrame, folder: str) -> Iterator[str]:
    """Write the events as five arrivals after one another in time, one at a time."""
    lo, hi = events.agg(F.min("ts"), F.max("ts")).first()
    step = (hi - lo) / 5
    for n in range(5):
        part = events.where(F.col("ts") >= ntz_lit(lo + n * step)) if n else events
        part = part.where(F.col("ts") < ntz_lit(lo + (n + 1) * step)) if n < 4 else part
        part.write.parquet(f"{folder}/slice={n}")
        yield f"{folder}/slice={n}"


def q_stream_daily(spark, sf):
    """SS-1..3: arrivals in no order of time, each a batch of its own: three
    runs, each resuming from the checkpoint. Their rows are older than many
    that are in the tables by then, and are kept."""
    wh = Warehouse(spark, scratch_dir(spark, "warehouse-stream"), "dev", pick="latest",
                   stable_ids=E.STABLE_USERS)
    events = E.read(spark, sf, "events")
    landing, checkpoint = scratch_dir(spark, "landing-files"), scratch_dir(spark, "ckpt-stream-daily")

    def batch(df: DataFrame, batch_id: int) -> None:
        wh.build_batch(E.snapshot_landing(df), E.history_landing(df))

    for files in ([3], [0, 4], [1, 2]):
        _land_in_files(events, landing, files)
        ST.run_available_now(ST.landing_stream(spark, f"{landing}/*", events.schema), checkpoint, batch_fn=batch)
    return E.present(wh.table("int_daily"))


def q_stream_dedup(spark, sf):
    """Every arrival is delivered twice, in batches of their own: the second finds its rows in the state of the first."""
    events = E.read(spark, sf, "events")
    landing, out, checkpoint = (scratch_dir(spark, p) for p in ("landing-twice", "stream-dedup-out", "ckpt-stream-dedup"))
    lo, hi = events.agg(F.min("ts"), F.max("ts")).first()
    # the watermark waits as long as an arrival spans, so that its second delivery is not late
    wait = f"{int((hi - lo).total_seconds() / 5) + 3600} seconds"
    for path in _land_in_time(events, landing):
        for again in (False, True):
            if again:
                spark.read.schema(events.schema).parquet(path).write.parquet(f"{path}-again")
            src = ST.with_event_time(ST.landing_stream(spark, f"{landing}/*", events.schema), "ts")
            dedup = ST.dedup_within_watermark(src, ["event_id"], "event_time", wait)
            ST.run_available_now(dedup.select("event_id", "user_id", "ts", "value"), checkpoint, sink_path=out)
    return spark.read.parquet(out)


def q_stream_window_daily(spark, sf):
    """Five runs in time order, each resuming: each moves the watermark on, and the state of older windows goes."""
    events = E.read(spark, sf, "events")
    landing, target, checkpoint = (scratch_dir(spark, p) for p in ("landing-slices", "stream-window-out", "ckpt-stream-window"))
    for _ in _land_in_time(events, landing):
        src = ST.with_event_time(ST.landing_stream(spark, f"{landing}/*", events.schema), "ts")
        agg = ST.windowed_daily(src, "user_id", "event_time", "value", "1 day")
        ST.run_available_now(agg, checkpoint, batch_fn=ST.upsert_batches(spark, target, ["user_id", "day"], "day"),
                             output_mode="update")
    return E.present(I.read_table(spark, target))


def q_sorted_files(spark, sf):
    """SO-2: files of a landing, written sorted, read back by place: rows a day, and those before their predecessor."""
    from tessera.sources import landing as L

    path = scratch_dir(spark, "landing-sorted")
    feed = E.read(spark, sf, "events").withColumn("day", F.col("ts").cast("date")).select("day", "ts", "event_id")
    L.append_landing(feed.repartition(8, "day"), path, ["day"], sort_by=["ts", "event_id"])
    read = spark.read.parquet(path).select("day", "ts", "event_id", F.col("_metadata.file_path").alias("file"),
                                           F.col("_metadata.row_index").alias("row"))
    # a row meets its predecessor by place, not by a sort of its file
    after = read.select("file", (F.col("row") + 1).alias("row"), F.struct("ts", "event_id").alias("prev"))
    met = read.join(after, ["file", "row"], "left")
    back = F.count_if(F.col("prev") > F.struct("ts", "event_id"))
    return met.groupBy(F.col("day").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n_rows"), back.alias("n_out_of_order"))


def q_loaded_fct_daily(spark, sf):
    """The load-time option through gold: most events land first; the others,
    of all times, are loaded a day after the newest event."""
    wh = Warehouse(spark, scratch_dir(spark, "warehouse-loaded"), "dev", pick="latest", stable_ids=E.STABLE_USERS,
                   watermark="_loaded_at", per_feed_marks=True)
    events = E.read(spark, sf, "events")
    *_, last = E.scd_cuts(events)
    late = F.pmod(F.xxhash64("event_id"), F.lit(5)) == 0
    feeds = lambda rows: (E.snapshot_landing(rows), E.history_landing(rows))
    on_time = feeds(events.where(~late))
    delayed = [f.withColumn("_loaded_at", ntz_lit(last)) for f in feeds(events.where(late))]
    wh.build(*on_time, as_of=last)
    wh.build(*(a.unionByName(b) for a, b in zip(on_time, delayed)), as_of=last + dt.timedelta(days=1))
    fct = wh.table("fct_daily_market").select("daily_market_sk", "extract_count", "latest_price_usd",
                                              "prev_latest_price_usd", "daily_return_pct")
    counted = wh.table("fct_market_snapshot").groupBy("date_sk").agg(F.count(F.lit(1)).alias("n_snapshots"))
    days = wh.table("fct_daily_market").select("daily_market_sk", "date_sk").join(counted, "date_sk", "left")
    return E.present(fct.join(days.drop("date_sk"), "daily_market_sk"))


def q_bounded_fct_daily(spark, sf):
    """SK-10 end to end as the reference has it: three builds with the bounded daily fact."""
    wh = Warehouse(spark, scratch_dir(spark, "warehouse-bounded"), "dev", pick="latest", stable_ids=E.STABLE_USERS,
                   daily_mode="bounded")
    events = E.read(spark, sf, "events")
    for cut in E.scd_cuts(events):
        wh.build(*_landings(events, cut), as_of=cut)
    return E.present(wh.table("fct_daily_market").select("daily_market_sk", "price_date", "latest_price_usd",
                                                         "prev_latest_price_usd", "daily_return_pct"))


def q_dq_planted(spark, sf):
    """DQ-1..6, J-6 on tables with planted failures: a day twice, a day without
    ids or prices, versions missing, doubled and of an unknown class."""
    wh = _warehouse(spark, sf)
    snap, dim, fct = wh.table("stg_snapshot"), wh.table("dim_coin"), wh.table("fct_daily_market")
    first, last = snap.agg(F.min("price_date"), F.max("price_date")).first()
    nothing = snap.where(F.col("price_date") == F.lit(last)).withColumns({
        "coin_id": F.lit(None).cast("long"), "price_usd": F.lit(0).cast("decimal(20,8)")})
    snap = snap.unionByName(snap.where(F.col("price_date") == F.lit(first))).unionByName(nothing)
    kept = dim.where("coin_id > 10")
    dim = kept.unionByName(kept.where("coin_id <= 30").withColumn("asset_type", F.lit("token")))
    checks = [Check("stg_snapshot", "not_null", ("coin_id",)),
              Check("stg_snapshot", "accepted_range", ("price_usd",), min_value=0),
              Check("stg_snapshot", "unique_combination", ("coin_id", "fetched_at")),
              Check("dim_coin", "unique", ("coin_sk",)),
              Check("dim_coin", "accepted_values", ("asset_type",), values=("coin", "stablecoin")),
              Check("fct_daily_market", "relationships", ("coin_sk",), to_model="dim_coin", to_column="coin_sk")]
    return run_checks(spark, {"stg_snapshot": snap, "dim_coin": dim, "fct_daily_market": fct}, checks)


def q_landing_append(spark, sf):
    """SNK-3..5: the feed lands in two batches, each stamped with its load time, in one day-partitioned folder."""
    from tessera.sources import landing as L

    path = scratch_dir(spark, "landing-append")
    feed = E.read(spark, sf, "events").withColumn("day", F.col("ts").cast("date"))
    is_first = F.col("event_type").isin(E.SNAPSHOT_TYPES)
    for rows, at in ((feed.where(is_first), LOADED[0]), (feed.where(~is_first), LOADED[1])):
        L.append_landing(L.with_load_stamp(rows, at), path, ["day"])
    return spark.read.parquet(path).select("event_id", "value", F.col("day").cast("date").alias("day"), "_loaded_at")


def q_created_table(spark, sf):
    """SNK-7: a table created twice over one folder, and read by name."""
    from tessera.sources import landing as L

    folder = scratch_dir(spark, "created")
    name = "tessera_" + folder.rsplit("-", 1)[1]
    rows = E.read(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_nationkey")
    for _ in range(2):
        L.create_table_if_not_exists(spark, name, rows.schema, folder, ["c_nationkey"])
    rows.write.mode("append").insertInto(name)
    read = I.staged(spark.table(name), "created-read")
    spark.sql(f"DROP TABLE {name}")
    return read


def q_reset_versions(spark, sf):
    """SK-8: after a reset the next full refresh starts the version history anew."""
    wh = Warehouse(spark, scratch_dir(spark, "warehouse-reset"), "dev", pick="latest", stable_ids=E.STABLE_USERS)
    events = E.read(spark, sf, "events")
    first, *_, last = E.scd_cuts(events)
    wh.build(*_landings(events, first), as_of=first)
    wh.reset_versions()
    wh.build(*_landings(events, last), as_of=last, full_refresh=True)
    return wh.table("dim_coin").select("coin_id", "symbol", "name", "asset_type", "is_current")


def q_env_outputs(spark, sf):
    """SK-9: environments under one root are outputs of their own."""
    root = scratch_dir(spark, "warehouse-envs")
    events = E.read(spark, sf, "events")
    out = None
    for env, cut in zip(("dev", "qa"), E.FIRST_CUTS):
        wh = Warehouse(spark, root, env, pick="latest", stable_ids=E.STABLE_USERS)
        wh.build_silver(*_landings(events, cut))
        rows = wh.table("int_daily").select(F.lit(env).alias("env"), "coin_id", "price_date", "extract_count")
        out = rows if out is None else out.unionByName(rows)
    return out


# ---------------------------------------------------------------- dashboard over the built tables

def q_date_bounds(spark, sf):
    return Q.date_bounds(_warehouse(spark, sf).table("fct_daily_market"))


def q_symbols(spark, sf):
    return Q.with_position(Q.current_symbols(_warehouse(spark, sf).table("dim_coin")), [F.col("symbol")])


def _fct_dim(spark, sf):
    wh = _warehouse(spark, sf)
    return wh.table("fct_daily_market"), wh.table("dim_coin")


def q_cards(spark, sf):
    shown = Q.cards(*_fct_dim(spark, sf), E.CARDS_START, E.CARDS_END)
    return E.present(Q.with_position(shown, [F.col("price_usd").desc_nulls_last(), F.col("symbol").asc_nulls_last(),
                                             F.col("daily_return_pct").asc_nulls_last()]))


def q_extremes(spark, sf):
    return E.present(Q.extremes(*_fct_dim(spark, sf)))


def q_series(spark, sf):
    shown = Q.series(*_fct_dim(spark, sf), E.CARDS_START, E.CARDS_END, E.SERIES_SYMBOLS)
    return E.present(Q.with_position(shown, [F.col(c).asc_nulls_last() for c in ("price_date", "symbol", "price_usd")]))


def q_chart_long(spark, sf):
    fct, dim = _fct_dim(spark, sf)
    s = Q.series(fct, dim, E.CARDS_START, E.CARDS_END, E.SERIES_SYMBOLS)
    return E.present(Q.chart_long(s, Q.extremes(fct, dim)))


def q_price_text(spark, sf):
    return _warehouse(spark, sf).table("fct_daily_market").select(
        "daily_market_sk", price_text("latest_price_usd").alias("price_text"),
        signed_pct_text("daily_return_pct").alias("return_text"))


#: Rows of the intraday feed that arrive, bad and loaded later, before their good copies do.
PLANTED_BAD = "pmod(event_id, 7) = 0"


def q_stream_rejects(spark, sf):
    """SS-3 with bad newest rows: batches bring them before, with and after the older good rows of their keys; the
    tables must be those of one batch over all."""
    wh = Warehouse(spark, scratch_dir(spark, "warehouse-rejects"), "dev", pick="latest", stable_ids=E.STABLE_USERS)
    events = E.read(spark, sf, "events")
    good = E.snapshot_landing(events), E.history_landing(events)
    later = F.expr("_loaded_at + interval 1 day")
    bad = E.snapshot_landing(events.where(PLANTED_BAD)).withColumns({"current_price": F.lit(-1.0), "_loaded_at": later})
    share = lambda df, n: df.where(F.pmod(F.xxhash64("id", "fetched_at"), F.lit(3)) == n)
    none = good[1].limit(0)
    wh.build_batch(share(bad, 0), none)
    wh.build_batch(share(good[0], 0).unionByName(share(good[0], 1)).unionByName(share(bad, 1)), good[1])
    wh.build_batch(share(good[0], 2), none)
    wh.build_batch(share(bad, 2), none)
    return E.present(wh.table("int_daily"))


def q_extremes_kept(spark, sf):
    """AG-6 from kept days, after the first day's prices were rewritten to half and brought up to date from that day alone."""
    fct, dim = _fct_dim(spark, sf)
    facts, kept = scratch_dir(spark, "extremes-facts"), scratch_dir(spark, "extremes-kept")
    I.replace(spark, fct, facts, "price_date")
    Q.kept_extremes(spark, facts, dim, kept)
    first = I.days_of(I.state(spark, facts))[:1]
    half = I.in_days(I.read_table(spark, facts), "price_date", first).withColumn(
        "latest_price_usd", (F.col("latest_price_usd") / 2).cast("decimal(20,8)"))
    I.replace_days(spark, half, facts, "price_date", first)
    return E.present(Q.kept_extremes(spark, facts, dim, kept))


def q_variant_landing(spark, sf):
    """SNK-2: documents with fields that no schema names land as VARIANT and come back whole and typed."""
    from tessera.sources import landing as L

    path = scratch_dir(spark, "landing-variant")
    extra = F.when(F.col("event_id") % 2 == 0, F.struct(F.col("user_id").alias("u"), F.array(F.lit(1), F.lit(None)).alias("list")))
    text = F.to_json(F.struct(E._k().alias("k"), F.col("event_type").alias("a_type"), extra.alias("extra")))
    docs = E.read(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 11 == 0, F.lit("{broken")).otherwise(text).alias("doc"))
    L.write_raw_variant(docs, "doc", path)
    read = L.variant_columns(spark.read.parquet(path), "doc", {
        "k": ("$.k", "bigint"), "u": ("$.extra.u", "bigint"), "absent": ("$.nothing", "string"), "mistyped": ("$.a_type", "int")})
    return read.select("event_id", "k", "u", "absent", "mistyped", F.to_json("doc").alias("doc"), F.col("doc_text").alias("raw"))


PIPELINE_QUERIES = {
    "upsert_result": q_upsert_result,
    "incremental_fct_daily": q_incremental_fct_daily,
    "incremental_fct_snapshot": q_incremental_fct_snapshot,
    "incremental_dim": q_incremental_dim,
    "dq_report": q_dq_report,
    "dq_planted": q_dq_planted,
    "landing_append": q_landing_append,
    "created_table": q_created_table,
    "reset_versions": q_reset_versions,
    "env_outputs": q_env_outputs,
    "loaded_fct_daily": q_loaded_fct_daily,
    "bounded_fct_daily": q_bounded_fct_daily,
    "price_text": q_price_text,
    "date_bounds": q_date_bounds,
    "symbols": q_symbols,
    "cards": q_cards,
    "extremes": q_extremes,
    "series": q_series,
    "chart_long": q_chart_long,
    "full_refresh": q_full_refresh,
    "schema_sync": q_schema_sync,
    "stream_daily": q_stream_daily,
    "stream_dedup": q_stream_dedup,
    "stream_window_daily": q_stream_window_daily,
    "sorted_files": q_sorted_files,
    "stream_rejects": q_stream_rejects,
    "extremes_kept": q_extremes_kept,
    "variant_landing": q_variant_landing,
}


def _dq_sql() -> str:
    from tessera.operators.quality import warehouse_checks

    models = {
        "stg_snapshot": "stg_snap", "stg_history": "stg_hist", "int_daily": "int_daily", "dim_coin": "dim",
        "dim_date": "dim_date", "fct_market_snapshot": "fct_snap", "fct_daily_market": "fct_daily",
    }
    parts = []
    for c in warehouse_checks():
        t = models[c.model]
        col = c.columns[0]
        src = f"(SELECT * FROM {t} WHERE {c.where})" if c.where else t
        if c.test == "not_null":
            cnt = f"(SELECT count(*) FROM {src} WHERE {col} IS NULL)"
        elif c.test == "unique":
            cnt = f"(SELECT count(*) FROM (SELECT {col} FROM {src} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1))"
        elif c.test == "unique_combination":
            cols = ", ".join(c.columns)
            cnt = f"(SELECT count(*) FROM (SELECT {cols} FROM {src} GROUP BY {cols} HAVING count(*) > 1))"
        elif c.test == "accepted_range":
            cnt = f"(SELECT count(*) FROM {src} WHERE NOT ({col} > {c.min_value}))"
        elif c.test == "accepted_values":
            vals = ", ".join(f"'{v}'" for v in c.values)
            cnt = f"(SELECT count(DISTINCT {col}) FROM {src} WHERE {col} IS NOT NULL AND {col} NOT IN ({vals}))"
        else:
            p = models[c.to_model]
            cnt = (f"(SELECT count(*) FROM {src} ch WHERE ch.{col} IS NOT NULL AND NOT EXISTS "
                   f"(SELECT 1 FROM {p} pa WHERE pa.{c.to_column} = ch.{col}))")
        parts.append(f"SELECT '{c.model}' AS model, '{c.test}' AS test, '{c.column_name}' AS column_name, "
                     f"CAST({cnt} AS BIGINT) AS failures")
    cal = """dim_date AS (
  SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_sk, d AS date_day
  FROM (SELECT CAST(unnest(generate_series(lo, hi + INTERVAL 2 DAY, INTERVAL 1 DAY)) AS DATE) AS d
        FROM (SELECT min(price_date) AS lo, max(price_date) AS hi FROM
              (SELECT price_date FROM stg_snap UNION ALL SELECT price_date FROM stg_hist))))"""
    fsnap = """fct_snap AS (
  SELECT md5(concat_ws('-', CAST(k.coin_id AS VARCHAR), CAST(k.fetched_at AS VARCHAR))) AS snapshot_sk, dc.coin_sk,
         CAST(year(k.price_date) * 10000 + month(k.price_date) * 100 + day(k.price_date) AS INTEGER) AS date_sk
  FROM stg_snap k LEFT JOIN dim dc ON k.coin_id = dc.coin_id
       AND k.fetched_at >= dc.valid_from AND k.fetched_at < dc.valid_to)"""
    return S.with_(S.fct_daily() + [cal, fsnap], "\nUNION ALL\n".join(parts))


def pipeline_oracle() -> dict[str, str]:
    base = S.oracle()
    q = {
        "upsert_result": base["unified_daily"],
        "incremental_fct_daily": base["asof_day"],
        "incremental_fct_snapshot": base["asof_ts"],
        "incremental_dim": base["scd2_dim"],
        "full_refresh": base["unified_daily"],
        "stream_daily": base["unified_daily"],
        "dq_report": _dq_sql(),
        "stream_dedup": "SELECT event_id, user_id, ts, value FROM events",
        "sorted_files": """SELECT CAST(ts AS DATE) AS day, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_out_of_order
FROM events GROUP BY 1""",
        "stream_window_daily": """SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n_events,
  CAST(sum(CAST(value AS DECIMAL(20,8))) AS DOUBLE) AS sum_value,
  CAST(max(CAST(value AS DECIMAL(20,8))) AS DOUBLE) AS max_value FROM events GROUP BY user_id, CAST(ts AS DATE)""",
    }
    # a key whose newest row is bad has no row: (user, time) of every planted event of the intraday feed goes
    q["stream_rejects"] = base["unified_daily"].replace("FROM events WHERE", "FROM kept_events WHERE").replace("WITH ", f"""WITH kept_events AS (
  SELECT * FROM events e WHERE event_type NOT IN ({sql_list(E.SNAPSHOT_TYPES)}) OR NOT EXISTS (SELECT 1 FROM events b
    WHERE b.event_id % 7 = 0 AND b.event_type IN ({sql_list(E.SNAPSHOT_TYPES)}) AND b.user_id = e.user_id AND b.ts = e.ts)), """, 1)
    q["extremes_kept"] = S.with_(S.fct_daily(), """SELECT symbol, CAST(max(price) AS DOUBLE) AS ath, CAST(min(price) AS DOUBLE) AS atl FROM (
  SELECT c.symbol, CASE WHEN f.price_date = (SELECT min(price_date) FROM fct_daily)
    THEN CAST(round(CAST(f.latest_price_usd AS DECIMAL(38,9)) * CAST(0.5 AS DECIMAL(2,1)), 8) AS DECIMAL(20,8)) ELSE f.latest_price_usd END AS price
  FROM fct_daily f JOIN dim c ON f.coin_sk = c.coin_sk) x GROUP BY symbol""")
    q["variant_landing"] = """SELECT event_id, CASE WHEN ok THEN k END AS k, CASE WHEN ok AND event_id % 2 = 0 THEN user_id END AS u,
  CAST(NULL AS VARCHAR) AS absent, CAST(NULL AS INTEGER) AS mistyped, CASE WHEN ok THEN '{"a_type":"' || event_type || '"' ||
    CASE WHEN event_id % 2 = 0 THEN ',"extra":{"list":[1,null],"u":' || user_id || '}' ELSE '' END || ',"k":' || k || '}' END AS doc,
  CASE WHEN NOT ok THEN '{broken' END AS raw
FROM (SELECT *, event_id % 11 <> 0 AS ok, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events) x"""
    first = E.FIRST_CUTS[0]
    touched = S.daily() + S.feeds("_old", first) + S.daily("_old", first)[len(S.feeds()):] + [
        """touched AS (SELECT DISTINCT coin_id, price_date FROM (
  SELECT coin_id, price_date, fetched_at FROM stg_snap UNION ALL SELECT coin_id, price_date, fetched_at FROM stg_hist) x
  WHERE fetched_at > (SELECT max(_synced_at) FROM int_daily_old))"""]
    q["dq_planted"] = S.with_(S.fct_daily(), """
SELECT 'stg_snapshot' AS model, 'not_null' AS test, 'coin_id' AS column_name,
  (SELECT count(*) FROM stg_snap WHERE price_date = (SELECT max(price_date) FROM stg_snap)) AS failures
UNION ALL SELECT 'stg_snapshot', 'accepted_range', 'price_usd',
  (SELECT count(*) FROM stg_snap WHERE price_date = (SELECT max(price_date) FROM stg_snap))
UNION ALL SELECT 'stg_snapshot', 'unique_combination', 'coin_id,fetched_at',
  (SELECT count(*) FROM stg_snap WHERE price_date = (SELECT min(price_date) FROM stg_snap))
  + (SELECT count(*) FROM (SELECT fetched_at FROM stg_snap WHERE price_date = (SELECT max(price_date) FROM stg_snap)
     GROUP BY fetched_at HAVING count(*) > 1))
UNION ALL SELECT 'dim_coin', 'unique', 'coin_sk', (SELECT count(*) FROM dim WHERE coin_id BETWEEN 11 AND 30)
UNION ALL SELECT 'dim_coin', 'accepted_values', 'asset_type',
  (SELECT CASE WHEN count(*) > 0 THEN 1 ELSE 0 END FROM dim WHERE coin_id BETWEEN 11 AND 30)
UNION ALL SELECT 'fct_daily_market', 'relationships', 'coin_sk',
  (SELECT count(*) FROM fct_daily f JOIN dim USING (coin_sk) WHERE dim.coin_id <= 10)""")
    q["loaded_fct_daily"] = S.with_(S.fct_daily(), """SELECT daily_market_sk, extract_count,
  CAST(latest_price_usd AS DOUBLE) AS latest_price_usd, CAST(prev_latest_price_usd AS DOUBLE) AS prev_latest_price_usd,
  daily_return_pct, (SELECT CASE WHEN count(*) > 0 THEN count(*) END FROM stg_snap k
    WHERE k.price_date = f.price_date) AS n_snapshots FROM fct_daily f""")
    runs = (S.daily("_r1", E.FIRST_CUTS[0]) + S.daily("_r2", E.FIRST_CUTS[1]) + S.daily("_r3"))
    run = """{name} AS (SELECT *, {n} AS run, lag(latest_price_usd) OVER (PARTITION BY coin_id ORDER BY price_date) AS prev
  FROM {src}{where})"""
    runs += [run.format(name="w1", n=1, src="int_daily_r1", where="")]
    for n in (2, 3):
        runs.append(run.format(name=f"w{n}", n=n, src=f"int_daily_r{n}",
                               where=f" WHERE price_date >= (SELECT max(price_date) FROM int_daily_r{n - 1}) - INTERVAL 3 DAY"))
    runs.append("""kept AS (SELECT * FROM w1
  UNION ALL SELECT * FROM w2 WHERE _synced_at > (SELECT max(_synced_at) FROM int_daily_r1)
  UNION ALL SELECT * FROM w3 WHERE _synced_at > (SELECT max(_synced_at) FROM int_daily_r2))""")
    runs.append("""final AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY coin_id, price_date ORDER BY run DESC) AS nth
  FROM kept) x WHERE nth = 1)""")
    q["bounded_fct_daily"] = S.with_(runs, f"""SELECT
  md5(concat_ws('-', CAST(coin_id AS VARCHAR), CAST(price_date AS VARCHAR))) AS daily_market_sk, price_date,
  CAST(latest_price_usd AS DOUBLE) AS latest_price_usd, CAST(prev AS DOUBLE) AS prev_latest_price_usd,
  {exact_pct('latest_price_usd', 'prev')} AS daily_return_pct FROM final""")
    q["landing_append"] = f"""SELECT event_id, value, CAST(ts AS DATE) AS day,
  CASE WHEN event_type IN ({sql_list(E.SNAPSHOT_TYPES)}) THEN TIMESTAMP '{LOADED[0]}' ELSE TIMESTAMP '{LOADED[1]}' END
    AS _loaded_at FROM events"""
    q["created_table"] = "SELECT c_custkey, c_name, c_acctbal, c_nationkey FROM customer"
    q["reset_versions"] = S.with_(S.versions(), """SELECT coin_id, symbol, name, asset_type, TRUE AS is_current
FROM states WHERE ci = (SELECT max(ci) FROM states)""")
    q["env_outputs"] = S.with_(S.daily("_r1", E.FIRST_CUTS[0]) + S.daily("_r2", E.FIRST_CUTS[1]), """
SELECT 'dev' AS env, coin_id, price_date, extract_count FROM int_daily_r1
UNION ALL SELECT 'qa', coin_id, price_date, extract_count FROM int_daily_r2""")
    q["payload_rejects"] = """SELECT event_id, CASE WHEN event_type = 'purchase' THEN 'missing_id' ELSE 'malformed' END AS reason
FROM events WHERE event_type IN ('view', 'click', 'purchase')"""
    absent = ["price_change_24h", "price_change_pct_24h", "high_24h", "low_24h", "circulating_supply",
              "all_time_high"]
    stg_cols = """coin_id, symbol, name, CAST(price_usd AS DOUBLE) AS price_usd,
  CAST(market_cap_usd AS DOUBLE) AS market_cap_usd, CAST(volume_24h_usd AS DOUBLE) AS volume_24h_usd,
  fetched_at, price_date, _loaded_at, """ + ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in absent)
    landing_ids = S.feeds()[:2]
    landing_ids[0] = landing_ids[0].replace("SELECT user_id AS id,", "SELECT CAST(user_id AS VARCHAR) AS id,")
    q["csv_landing"] = S.with_(landing_ids, f"SELECT {stg_cols} FROM stg_snap")
    q["json_landing"] = q["csv_landing"]
    q["market_payload"] = """SELECT CAST(user_id AS VARCHAR) AS id, event_type AS symbol, 'user-' || CAST(user_id AS VARCHAR) AS name,
  round(value / 3.0, 5) AS current_price,
  round(value * CAST(json_extract(props, '$.k') AS BIGINT), 5) AS market_cap,
  CAST(NULL AS DOUBLE) AS total_volume,
  round(CAST(json_extract(props, '$.k') AS BIGINT) / 7.0 - 5.0, 5) AS price_change_pct_24h,
  CAST(NULL AS DOUBLE) AS high_24h, ts AS fetched_at
FROM events WHERE event_type IN ('view', 'click', 'purchase')"""
    q["schema_sync"] = S.with_(touched, """SELECT coin_id, symbol, name, price_date, extract_count, avg_price_usd,
  avg_market_cap_usd,
  CASE WHEN (coin_id, price_date) IN (SELECT coin_id, price_date FROM touched) THEN avg_volume_usd END AS avg_volume_usd,
  CAST(latest_price_usd AS DOUBLE) AS latest_price_usd, CAST(latest_market_cap_usd AS DOUBLE) AS latest_market_cap_usd,
  CAST(latest_volume_usd AS DOUBLE) AS latest_volume_usd, source_name, _synced_at FROM int_daily""")
    return q


# ---------------------------------------------------------------- landing formats

def _market_objects(events: DataFrame) -> DataFrame:
    """Snapshot-feed events as market objects (the API's field names); fields
    the events do not carry stay absent (NULL)."""
    snap = E.snapshot_landing(events)
    return snap.select("id", "symbol", "name", "current_price", "market_cap", "total_volume", "fetched_at",
                       "_loaded_at")


def q_csv_landing(spark, sf):
    """SNK-1 -> SRC-3 -> cleaned feed: landing rows written as CSV with a
    header, read back with the declared landing schema, then cleaned."""
    from tessera.sources import landing as L

    path = scratch_dir(spark, "landing-csv")
    L.write_csv(_market_objects(E.read(spark, sf, "events")), path, sort_by=["fetched_at"])
    raw = L.read_landing(spark, path, L.SNAPSHOT_LANDING, fmt="csv")
    return E.present(M.stg_snapshot(raw))


def q_json_landing(spark, sf):
    """SNK-2 -> SRC-3: the same rows as JSON lines, read with the declared schema."""
    from tessera.sources import landing as L

    path = scratch_dir(spark, "landing-json")
    L.write_raw_json(_market_objects(E.read(spark, sf, "events")), path)
    raw = L.read_landing(spark, path, L.SNAPSHOT_LANDING, fmt="json")
    return E.present(M.stg_snapshot(raw))


def q_market_payload(spark, sf):
    """SRC-1: one JSON array document per fetch (API field names, percentage
    field under its API name) flattened, rounded to 5 places and stamped."""
    from tessera.sources import landing as L

    ev = E.read(spark, sf, "events").where(F.col("event_type").isin(E.SNAPSHOT_TYPES))
    k = F.get_json_object("props", "$.k").cast("bigint")
    obj = F.struct(F.col("user_id").cast("string").alias("id"), F.col("event_type").alias("symbol"),
                   F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("name"),
                   (F.col("value") / F.lit(3.0)).alias("current_price"), (F.col("value") * k).alias("market_cap"),
                   (k / F.lit(7.0) - F.lit(5.0)).alias("price_change_percentage_24h"))
    docs = ev.select(F.col("ts").alias("fetch_ts"), F.to_json(F.array(obj)).alias("payload"))
    flat = L.flatten_market_payload(docs, "payload", F.col("fetch_ts"))
    return flat.select("id", "symbol", "name", "current_price", "market_cap", "total_volume",
                       "price_change_pct_24h", "high_24h", "fetched_at")


def q_payload_rejects(spark, sf):
    """SRC-1 on damaged documents: views are cut short, clicks have a price that is no number, purchases
    have no id, and the rest are whole."""
    from tessera.sources import landing as L

    ev = E.read(spark, sf, "events")
    kind = F.col("event_type")
    obj = F.struct(F.when(kind != "purchase", F.col("user_id").cast("string")).alias("id"), kind.alias("symbol"),
                   F.lit(None).cast("string").alias("name"),
                   F.when(kind == "click", F.lit("oops")).otherwise(F.col("value").cast("string")).alias("current_price"))
    text = F.regexp_replace(F.to_json(F.array(obj)), '"current_price":"([-0-9.E]+)"', '"current_price":$1')
    payload = F.when(kind == "view", F.expr("substring(text, 1, length(text) - 4)")).otherwise(F.col("text"))
    docs = ev.withColumn("text", text).withColumn("payload", payload)
    return L.payload_rejects(docs, "payload").select("event_id", "reason")


PIPELINE_QUERIES.update({
    "payload_rejects": q_payload_rejects,
    "csv_landing": q_csv_landing,
    "json_landing": q_json_landing,
    "market_payload": q_market_payload,
})
