"""Oracle SQL (DuckDB dialect) for the checked queries of the events instance.

Each statement restates the query's semantics in plain SQL over the raw
tables; none of it is executed by the library. CTE chains are rendered from
small builders so the models (cleaned feeds, unified daily grain, versions)
read the same in every statement.
"""

from __future__ import annotations

import datetime as dt

from tessera.plans import events as E
from tessera.plans.sqlkit import exact_avg, exact_pct, exact_pct_decimal, sql_list


def _ts(t: dt.datetime) -> str:
    return f"TIMESTAMP '{t.isoformat(sep=' ')}'"


# the last run sees every row: the day after the newest one
LAST_CUT = "(SELECT CAST(date_trunc('day', max(ts)) AS TIMESTAMP) + INTERVAL 1 DAY FROM events)"

K = "CAST(json_extract(props, '$.k') AS BIGINT)"


def feeds(sfx: str = "", before: dt.datetime | None = None) -> list[str]:
    cut = f" AND ts < {_ts(before)}" if before else ""
    return [
        f"""snap_raw{sfx} AS (
  SELECT user_id AS id, event_type AS symbol, 'user-' || CAST(user_id AS VARCHAR) AS name,
         value AS current_price, value * {K} AS market_cap, CAST({K} AS DOUBLE) AS total_volume,
         ts AS fetched_at, ts AS _loaded_at
  FROM events WHERE event_type IN ({sql_list(E.SNAPSHOT_TYPES)}){cut})""",
        f"""stg_snap{sfx} AS (
  SELECT id AS coin_id, upper(symbol) AS symbol, name,
         CAST(current_price AS DECIMAL(20,8)) AS price_usd,
         CAST(market_cap AS DECIMAL(28,2)) AS market_cap_usd,
         CAST(total_volume AS DECIMAL(28,2)) AS volume_24h_usd,
         fetched_at, CAST(fetched_at AS DATE) AS price_date, _loaded_at
  FROM (SELECT *, row_number() OVER (PARTITION BY id, fetched_at ORDER BY _loaded_at DESC NULLS LAST,
          symbol DESC NULLS LAST, name DESC NULLS LAST, current_price DESC NULLS LAST,
          market_cap DESC NULLS LAST, total_volume DESC NULLS LAST) AS rn FROM snap_raw{sfx}) d
  WHERE rn = 1 AND id IS NOT NULL AND current_price > 0)""",
        f"""hist_raw{sfx} AS (
  SELECT user_id AS id, event_type AS symbol, 'user-' || CAST(user_id AS VARCHAR) AS name,
         CAST(ts AS DATE) AS price_date, value AS price, value * {K} AS market_cap,
         CAST({K} AS DOUBLE) AS total_volume, ts AS fetched_at, ts AS _loaded_at
  FROM events WHERE event_type IN ({sql_list(E.HISTORY_TYPES)}){cut})""",
        f"""stg_hist{sfx} AS (
  SELECT id AS coin_id, upper(symbol) AS symbol, name, price_date,
         CAST(price AS DECIMAL(20,8)) AS price_usd,
         CAST(market_cap AS DECIMAL(28,2)) AS market_cap_usd,
         CAST(total_volume AS DECIMAL(28,2)) AS volume_usd, fetched_at, _loaded_at
  FROM (SELECT *, row_number() OVER (PARTITION BY id, price_date ORDER BY fetched_at DESC NULLS LAST,
          _loaded_at DESC NULLS LAST, symbol DESC NULLS LAST, name DESC NULLS LAST, price DESC NULLS LAST,
          market_cap DESC NULLS LAST, total_volume DESC NULLS LAST) AS rn FROM hist_raw{sfx}) d
  WHERE rn = 1 AND id IS NOT NULL AND price > 0)""",
    ]


def daily(sfx: str = "", before: dt.datetime | None = None) -> list[str]:
    return feeds(sfx, before) + [
        f"""snap_daily{sfx} AS (
  SELECT coin_id, price_date, count(*) AS extract_count,
         {exact_avg('price_usd', 8, 8)} AS avg_price_usd,
         {exact_avg('market_cap_usd', 2, 2)} AS avg_market_cap_usd,
         {exact_avg('volume_24h_usd', 2, 2)} AS avg_volume_usd,
         arg_max(symbol, fetched_at) AS symbol, arg_max(name, fetched_at) AS name,
         arg_max(price_usd, fetched_at) AS latest_price_usd,
         arg_max(market_cap_usd, fetched_at) AS latest_market_cap_usd,
         arg_max(volume_24h_usd, fetched_at) AS latest_volume_usd,
         max(fetched_at) AS _synced_at
  FROM stg_snap{sfx} GROUP BY coin_id, price_date)""",
        f"""int_daily{sfx} AS (
  SELECT coin_id, symbol, name, price_date, extract_count, avg_price_usd, avg_market_cap_usd, avg_volume_usd,
         latest_price_usd, latest_market_cap_usd, latest_volume_usd, source_name, _synced_at
  FROM (SELECT *, row_number() OVER (PARTITION BY coin_id, price_date
                 ORDER BY CASE WHEN source_name = 'snapshot' THEN 0 ELSE 1 END) AS pr
        FROM (SELECT coin_id, symbol, name, price_date, extract_count, avg_price_usd, avg_market_cap_usd,
                     avg_volume_usd, latest_price_usd, latest_market_cap_usd, latest_volume_usd,
                     'snapshot' AS source_name, _synced_at FROM snap_daily{sfx}
              UNION ALL
              SELECT coin_id, symbol, name, price_date, CAST(1 AS BIGINT), CAST(price_usd AS DOUBLE),
                     CAST(market_cap_usd AS DOUBLE), CAST(volume_usd AS DOUBLE), price_usd, market_cap_usd,
                     volume_usd, 'history', fetched_at FROM stg_hist{sfx}) u) p
  WHERE pr = 1)""",
    ]


DAILY_OUT = """coin_id, symbol, name, price_date, extract_count, avg_price_usd, avg_market_cap_usd, avg_volume_usd,
  CAST(latest_price_usd AS DOUBLE) AS latest_price_usd, CAST(latest_market_cap_usd AS DOUBLE) AS latest_market_cap_usd,
  CAST(latest_volume_usd AS DOUBLE) AS latest_volume_usd, source_name, _synced_at"""


def versions(pick: str = "latest") -> list[str]:
    states = []
    agg = ("arg_max(symbol, fetched_at) AS symbol, arg_max(name, fetched_at) AS name" if pick == "latest"
           else "max(symbol) AS symbol, max(name) AS name")
    for i, cut in enumerate([*map(_ts, E.FIRST_CUTS), LAST_CUT], 1):
        states.append(f"""SELECT {i} AS ci, {cut} AS cut, coin_id,
    {agg},
    CASE WHEN coin_id IN ({sql_list(E.STABLE_USERS)}) THEN 'stablecoin' ELSE 'coin' END AS asset_type
  FROM feed_attr WHERE fetched_at < {cut} GROUP BY coin_id""")
    return feeds() + [
        """feed_attr AS (SELECT coin_id, symbol, name, fetched_at FROM stg_snap
  UNION ALL SELECT coin_id, symbol, name, fetched_at FROM stg_hist)""",
        "states AS (\n  " + "\n  UNION ALL\n  ".join(states) + ")",
        """chg AS (
  SELECT *, lag(ci) OVER w AS pci, lag(symbol) OVER w AS ps, lag(name) OVER w AS pn, lag(asset_type) OVER w AS pa
  FROM states WINDOW w AS (PARTITION BY coin_id ORDER BY ci))""",
        """versions AS (
  SELECT coin_id, symbol, name, asset_type, cut AS version_from,
         lead(cut) OVER (PARTITION BY coin_id ORDER BY cut) AS version_to
  FROM chg
  WHERE pci IS NULL OR ps IS DISTINCT FROM symbol OR pn IS DISTINCT FROM name OR pa IS DISTINCT FROM asset_type)""",
        """dim AS (
  SELECT md5(concat_ws('-', CAST(coin_id AS VARCHAR), CAST(version_from AS VARCHAR))) AS coin_sk,
         coin_id, symbol, name, asset_type,
         CASE WHEN row_number() OVER (PARTITION BY coin_id ORDER BY version_from) = 1
              THEN TIMESTAMP '1900-01-01 00:00:00' ELSE version_from END AS valid_from,
         coalesce(version_to, TIMESTAMP '9999-12-31 00:00:00') AS valid_to,
         version_to IS NULL AS is_current
  FROM versions)""",
    ]


def fct_daily() -> list[str]:
    return daily() + versions()[len(feeds()):] + [
        """wr AS (
  SELECT *, lag(latest_price_usd) OVER (PARTITION BY coin_id ORDER BY price_date) AS prev_latest_price_usd
  FROM int_daily)""",
        f"""fct_daily AS (
  SELECT md5(concat_ws('-', CAST(wr.coin_id AS VARCHAR), CAST(wr.price_date AS VARCHAR))) AS daily_market_sk,
         dc.coin_sk,
         CAST(year(wr.price_date) * 10000 + month(wr.price_date) * 100 + day(wr.price_date) AS INTEGER) AS date_sk,
         wr.price_date, wr.extract_count, wr.avg_price_usd, wr.avg_market_cap_usd, wr.avg_volume_usd,
         wr.latest_price_usd, wr.latest_market_cap_usd, wr.latest_volume_usd, wr.prev_latest_price_usd,
         {exact_pct('wr.latest_price_usd', 'wr.prev_latest_price_usd')} AS daily_return_pct,
         {exact_pct_decimal('wr.latest_price_usd', 'wr.prev_latest_price_usd')} AS daily_return_dec,
         wr._synced_at, wr.coin_id
  FROM wr LEFT JOIN dim dc ON wr.coin_id = dc.coin_id
       AND wr.price_date >= CAST(dc.valid_from AS DATE) AND wr.price_date < CAST(dc.valid_to AS DATE))""",
    ]


FCT_DAILY_OUT = """daily_market_sk, coin_sk, date_sk, price_date, extract_count, avg_price_usd, avg_market_cap_usd,
  avg_volume_usd, CAST(latest_price_usd AS DOUBLE) AS latest_price_usd,
  CAST(latest_market_cap_usd AS DOUBLE) AS latest_market_cap_usd, CAST(latest_volume_usd AS DOUBLE) AS latest_volume_usd,
  CAST(prev_latest_price_usd AS DOUBLE) AS prev_latest_price_usd, daily_return_pct, _synced_at"""


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _date_sk(c: str) -> str:
    return f"CAST(year({c}) * 10000 + month({c}) * 100 + day({c}) AS INTEGER)"


def _price_text(c: str) -> str:
    v = f"CAST({c} AS DECIMAL(38,8))"
    return (f"CASE WHEN {c} IS NULL THEN NULL WHEN {v} >= 1 THEN '$' || format('{{:,.2f}}', round({v}, 2)) "
            f"ELSE '$' || format('{{:,.4f}}', round({v}, 4)) END")


def _pct_text(c: str) -> str:
    v = f"CAST({c} AS DECIMAL(38,8))"
    return (f"CASE WHEN {c} IS NULL THEN NULL ELSE (CASE WHEN {v} < 0 THEN '-' ELSE '+' END) || "
            f"CAST(CAST(round(abs({v}), 2) AS DECIMAL(38,2)) AS VARCHAR) || '%' END")


def oracle() -> dict[str, str]:
    lo, hi = E.RANGE_START, E.RANGE_END
    from tessera.sources.landing import _to_utc_naive, parse_id_list

    q: dict[str, str] = {}
    q["stg_events"] = with_(feeds(), """SELECT coin_id, symbol, name, CAST(price_usd AS DOUBLE) AS price_usd,
  CAST(market_cap_usd AS DOUBLE) AS market_cap_usd, CAST(volume_24h_usd AS DOUBLE) AS volume_24h_usd,
  fetched_at, price_date, _loaded_at FROM stg_snap""")
    q["stg_history"] = with_(feeds(), """SELECT coin_id, symbol, name, price_date, CAST(price_usd AS DOUBLE) AS price_usd,
  CAST(market_cap_usd AS DOUBLE) AS market_cap_usd, CAST(volume_usd AS DOUBLE) AS volume_usd,
  fetched_at, _loaded_at FROM stg_hist""")
    q["dedup_lineitem"] = """SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST,
    l_extendedprice DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST,
    l_quantity DESC NULLS LAST, l_discount DESC NULLS LAST, l_tax DESC NULLS LAST,
    l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) AS rn FROM lineitem) WHERE rn = 1"""
    q["dedup_orders"] = """SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderday ORDER BY o_orderdate DESC NULLS LAST,
    o_orderkey DESC NULLS LAST, o_orderstatus DESC NULLS LAST, o_totalprice DESC NULLS LAST,
    o_orderpriority DESC NULLS LAST) AS rn
  FROM (SELECT *, CAST(o_orderdate AS DATE) AS o_orderday FROM orders)) WHERE rn = 1"""
    q["curated_feed"] = f"SELECT * FROM events WHERE user_id IN ({sql_list(parse_id_list(E.CURATED_IDS, int))})"
    q["curated_many"] = f"SELECT * FROM lineitem WHERE l_orderkey IN ({', '.join(map(str, E.MANY_IDS))})"
    q["average_rounding"] = """SELECT l_returnflag, count(*) AS extract_count, 0.0::DOUBLE AS avg_cents
FROM lineitem GROUP BY l_returnflag"""
    q["source_topn"] = f"""SELECT c_custkey, c_name, c_acctbal,
  CAST(row_number() OVER (ORDER BY c_acctbal DESC, c_custkey ASC) AS INTEGER) AS rank
FROM customer ORDER BY c_acctbal DESC, c_custkey ASC LIMIT {E.TOP_N}"""
    q["range_extract"] = f"""SELECT event_id, user_id, event_type, ts, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS epoch_s
FROM events WHERE ts BETWEEN {_ts(_to_utc_naive(lo))} AND {_ts(_to_utc_naive(hi))}"""
    q["json_flatten"] = """SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS prop_k,
  json_extract_string(props, '$.note') AS prop_note
FROM events WHERE CAST(json_extract(props, '$.k') AS BIGINT) IS NOT NULL"""
    q["nested_series_daily"] = f"""WITH e AS (
  SELECT event_id, user_id AS id, ts, value, CAST({K} AS DOUBLE) AS k, event_type FROM events),
pts AS (
  SELECT event_id, id, 0 AS s, 0 AS pos, CAST(ts AS DATE) AS d, value AS v FROM e
  UNION ALL SELECT event_id, id, 0, 1, CAST(ts + INTERVAL 6 HOUR AS DATE), value + k / 100.0 FROM e
  UNION ALL SELECT event_id, id, 1, 0, CAST(ts AS DATE), value * k FROM e
  UNION ALL SELECT event_id, id, 2, 0, CAST(ts + INTERVAL 6 HOUR AS DATE), k FROM e WHERE event_type <> 'error')
SELECT event_id, id, d AS price_date,
  round(arg_max(v, pos) FILTER (WHERE s = 0), 5) AS price,
  round(arg_max(v, pos) FILTER (WHERE s = 1), 5) AS market_cap,
  round(arg_max(v, pos) FILTER (WHERE s = 2), 5) AS total_volume
FROM pts GROUP BY event_id, id, d HAVING count(*) FILTER (WHERE s = 0) > 0"""
    q["daily_rollup"] = with_(daily(), """SELECT coin_id, price_date, extract_count, avg_price_usd, avg_market_cap_usd,
  avg_volume_usd, symbol, name, CAST(latest_price_usd AS DOUBLE) AS latest_price_usd,
  CAST(latest_market_cap_usd AS DOUBLE) AS latest_market_cap_usd,
  CAST(latest_volume_usd AS DOUBLE) AS latest_volume_usd, _synced_at FROM snap_daily""")
    q["latest_per_day"] = """SELECT o_custkey, o_month, n_orders, o_orderkey AS latest_orderkey,
  o_totalprice AS latest_totalprice, o_orderstatus AS latest_status
FROM (SELECT *, count(*) OVER (PARTITION BY o_custkey, o_month) AS n_orders,
        row_number() OVER (PARTITION BY o_custkey, o_month ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM (SELECT *, CAST(date_trunc('month', o_orderdate) AS DATE) AS o_month FROM orders)) WHERE rn = 1"""
    q["unified_daily"] = with_(daily(), f"SELECT {DAILY_OUT} FROM int_daily")
    mark = f"(SELECT max(_synced_at) FROM int_daily_old)"
    touched = f"""touched AS (SELECT DISTINCT coin_id, price_date FROM (
  SELECT coin_id, price_date, fetched_at FROM stg_snap UNION ALL SELECT coin_id, price_date, fetched_at FROM stg_hist) x
  WHERE fetched_at > {mark})"""
    inc = daily() + feeds("_old", E.INCREMENT_CUT) + daily("_old", E.INCREMENT_CUT)[len(feeds()):]
    q["touched_days"] = with_(inc + [touched], "SELECT coin_id, price_date FROM touched")
    q["touched_recompute"] = with_(inc + [touched], f"""SELECT {DAILY_OUT} FROM int_daily
WHERE (coin_id, price_date) IN (SELECT coin_id, price_date FROM touched)""")
    ret = """wr AS (SELECT coin_id, price_date, latest_price_usd, _synced_at,
  lag(latest_price_usd) OVER (PARTITION BY coin_id ORDER BY price_date) AS prev FROM {src})"""
    ret_out = f"""SELECT coin_id, price_date, CAST(latest_price_usd AS DOUBLE) AS latest_price_usd,
  CAST(prev AS DOUBLE) AS prev_latest_price_usd, {exact_pct('latest_price_usd', 'prev')} AS daily_return_pct"""
    q["daily_returns"] = with_(daily() + [ret.format(src="int_daily")], ret_out + " FROM wr")
    q["bounded_returns"] = with_(
        inc + ["win AS (SELECT * FROM int_daily WHERE price_date >= "
               "(SELECT max(price_date) FROM int_daily_old) - INTERVAL 3 DAY)", ret.format(src="win")],
        ret_out + f", _synced_at FROM wr WHERE _synced_at > {mark}")
    vts = "strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}"
    q["scd2_versions"] = with_(versions(), f"""SELECT coin_id, symbol, name, asset_type,
  {vts.format(c='version_from')}, {vts.format(c='version_to')} FROM versions""")
    q["scd2_versions_max"] = with_(versions("max"), f"""SELECT coin_id, symbol, name, asset_type,
  {vts.format(c='version_from')}, {vts.format(c='version_to')} FROM versions""")
    q["scd2_dim"] = with_(versions(), f"""SELECT coin_sk, coin_id, symbol, name, asset_type,
  {vts.format(c='valid_from')}, {vts.format(c='valid_to')}, is_current FROM dim""")
    q["asof_ts"] = with_(versions(), f"""SELECT md5(concat_ws('-', CAST(k.coin_id AS VARCHAR), CAST(k.fetched_at AS VARCHAR))) AS snapshot_sk,
  dc.coin_sk, {_date_sk('k.price_date')} AS date_sk, k.fetched_at,
  CAST(k.price_usd AS DOUBLE) AS price_usd, CAST(k.market_cap_usd AS DOUBLE) AS market_cap_usd,
  CAST(k.volume_24h_usd AS DOUBLE) AS volume_24h_usd
FROM stg_snap k LEFT JOIN dim dc ON k.coin_id = dc.coin_id
  AND k.fetched_at >= dc.valid_from AND k.fetched_at < dc.valid_to""")
    q["asof_day"] = with_(fct_daily(), f"SELECT {FCT_DAILY_OUT} FROM fct_daily")
    views = f"""WITH v AS (SELECT user_id, ts AS valid_from, max(event_id) AS view_sk FROM events WHERE event_type = 'view' GROUP BY ALL),
w AS (SELECT *, coalesce(lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from), TIMESTAMP '9999-12-31') AS valid_to FROM v)"""
    q["asof_many_versions"] = views + """
SELECT e.event_id, e.user_id, e.ts, w.view_sk FROM events e LEFT JOIN w
  ON e.user_id = w.user_id AND e.ts >= w.valid_from AND e.ts < w.valid_to WHERE e.event_type <> 'view'"""
    q["asof_many_versions_day"] = views + """
SELECT e.event_id, e.user_id, CAST(e.ts AS DATE) AS day, w.view_sk FROM events e LEFT JOIN w
  ON e.user_id = w.user_id AND CAST(e.ts AS DATE) >= CAST(w.valid_from AS DATE) AND CAST(e.ts AS DATE) < CAST(w.valid_to AS DATE)
WHERE e.event_type <> 'view'"""
    q["dim_calendar"] = f"""WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders),
days AS (SELECT CAST(unnest(generate_series(lo, hi + INTERVAL 2 DAY, INTERVAL 1 DAY)) AS DATE) AS d FROM b)
SELECT {_date_sk('d')} AS date_sk, d AS date_day, CAST(year(d) AS INTEGER) AS year,
  CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, strftime(d, '%b') AS month_name,
  CAST(day(d) AS INTEGER) AS day_of_month, CAST(isodow(d) AS INTEGER) AS iso_day_of_week,
  isodow(d) IN (6, 7) AS is_weekend FROM days"""
    q["surrogate_keys"] = f"""SELECT event_id, md5(concat_ws('-', CAST(user_id AS VARCHAR), CAST(ts AS VARCHAR))) AS snapshot_sk,
  md5(concat_ws('-', CAST(user_id AS VARCHAR), CAST(CAST(ts AS DATE) AS VARCHAR))) AS daily_sk,
  {_date_sk('ts')} AS date_sk FROM events"""
    q["attr_class"] = f"""SELECT DISTINCT user_id AS coin_id,
  CASE WHEN user_id IN ({sql_list(E.STABLE_USERS)}) THEN 'stablecoin' ELSE 'coin' END AS asset_type FROM events"""
    ov = " UNION ALL ".join(f"SELECT {i} AS coin_id, '{n}' AS name" for i, n in E.OVERRIDES)
    q["attr_override"] = with_(feeds() + [f"ov AS ({ov})"], """SELECT DISTINCT s.coin_id, coalesce(ov.name, s.name) AS name
FROM stg_snap s LEFT JOIN ov ON s.coin_id = ov.coin_id""")
    q["price_text"] = with_(fct_daily(), f"""SELECT daily_market_sk, {_price_text('latest_price_usd')} AS price_text,
  {_pct_text('daily_return_dec')} AS return_text FROM fct_daily""")
    q["epoch_days"] = """SELECT event_id, epoch_us(ts) // 1000 AS epoch_ms, CAST(ts AS DATE) AS utc_day,
  ts - INTERVAL 2 HOUR AS utc_ts FROM events"""
    mart = fct_daily() + ["""fj AS (SELECT f.*, c.symbol AS symbol, c.coin_id AS dim_coin_id
  FROM fct_daily f JOIN dim c ON f.coin_sk = c.coin_sk)""",
        """ext AS (SELECT symbol, max(latest_price_usd) AS ath, min(latest_price_usd) AS atl FROM fj GROUP BY symbol)"""]
    rng = f"price_date BETWEEN DATE '{E.CARDS_START}' AND DATE '{E.CARDS_END}'"
    q["date_bounds"] = with_(mart, """SELECT min(price_date) AS min_date, max(price_date) AS max_date,
  greatest(min(price_date), CAST(max(price_date) - INTERVAL 90 DAY AS DATE)) AS default_start FROM fct_daily""")
    q["symbols"] = with_(versions(), """SELECT symbol, row_number() OVER (ORDER BY symbol) AS position
FROM (SELECT DISTINCT symbol FROM dim WHERE is_current)""")
    q["cards"] = with_(mart, f"""SELECT symbol, CAST(latest_price_usd AS DOUBLE) AS price_usd, daily_return_pct,
  row_number() OVER (ORDER BY latest_price_usd DESC NULLS LAST, symbol, daily_return_pct) AS position FROM (
  SELECT *, row_number() OVER (PARTITION BY dim_coin_id ORDER BY price_date DESC) AS rn FROM fj WHERE {rng})
WHERE rn = 1""")
    q["extremes"] = with_(mart, "SELECT symbol, CAST(ath AS DOUBLE) AS ath, CAST(atl AS DOUBLE) AS atl FROM ext")
    ser = f"""ser AS (SELECT price_date, symbol, latest_price_usd AS price_usd FROM fj
  WHERE symbol IN ({sql_list(E.SERIES_SYMBOLS)}) AND {rng})"""
    q["series"] = with_(mart + [ser], """SELECT price_date, symbol, CAST(price_usd AS DOUBLE) AS price_usd,
  row_number() OVER (ORDER BY price_date, symbol, price_usd) AS position FROM ser""")
    q["chart_long"] = with_(mart + [ser], """SELECT price_date, symbol, series, CAST(usd AS DOUBLE) AS usd FROM (
  SELECT s.price_date, s.symbol, s.price_usd AS "Price", e.ath AS "All-time high", e.atl AS "All-time low"
  FROM ser s LEFT JOIN ext e ON s.symbol = e.symbol)
UNPIVOT INCLUDE NULLS (usd FOR series IN ("Price", "All-time high", "All-time low"))""")
    return q
