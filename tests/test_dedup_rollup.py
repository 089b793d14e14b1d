import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tessera.operators.dedup import latest_per_key, reject
from tessera.operators.rollup import daily_rollup, prioritized_union
from tessera.plans import market as M

T0 = dt.datetime(2024, 3, 1, 10, 0)
SNAP_SCHEMA = ("id string, symbol string, name string, current_price double, fetched_at timestamp_ntz, "
               "_loaded_at timestamp_ntz")


def _snap(spark, rows):
    return spark.createDataFrame(rows, SNAP_SCHEMA)


def test_latest_per_key_keeps_newest_load(spark):
    rows = [
        ("btc", "btc", "Bitcoin", 10.0, T0, T0),
        ("btc", "btc", "Bitcoin", 11.0, T0, T0 + dt.timedelta(hours=1)),
        ("eth", "eth", "Ether", 5.0, T0, None),
        ("eth", "eth", "Ether", 6.0, T0, T0),
    ]
    out = latest_per_key(_snap(spark, rows), ["id", "fetched_at"], ["_loaded_at"])
    got = {r.id: r.current_price for r in out.collect()}
    # newest load wins; a NULL load time sorts last (stated explicitly)
    assert got == {"btc": 11.0, "eth": 6.0}


def test_full_tie_is_resolved_by_other_columns(spark):
    rows = [("btc", "b", "x", 1.0, T0, T0), ("btc", "b", "x", 2.0, T0, T0)]
    out = latest_per_key(_snap(spark, rows), ["id", "fetched_at"], ["_loaded_at"]).collect()
    assert [r.current_price for r in out] == [2.0]


def test_reject_after_dedup_removes_key(spark):
    # Q3: the newest duplicate has price 0 -> the key disappears from a full build
    rows = [("btc", "btc", "B", 10.0, T0, T0), ("btc", "btc", "B", 0.0, T0, T0 + dt.timedelta(minutes=1))]
    out = M.stg_snapshot(_snap(spark, rows))
    assert out.count() == 0
    kept = reject(latest_per_key(_snap(spark, rows[:1]), ["id", "fetched_at"], ["_loaded_at"]),
                  F.col("current_price") > 0)
    assert kept.count() == 1


def test_stg_snapshot_types_and_day(spark):
    rows = [("btc", "btc", "Bitcoin", 0.000004, T0, T0),  # rounds to 0.00000400 as decimal(20,8)
            ("eth", "eth", "Ether", float("nan"), T0, T0),  # NaN passes > 0 ... then becomes NULL decimal
            (None, "x", "X", 1.0, T0, T0),
            ("sol", "sol", "Solana", 2.5, dt.datetime(2024, 3, 1, 23, 59, 59), T0)]
    out = {r.coin_id: r for r in M.stg_snapshot(_snap(spark, rows)).collect()}
    assert set(out) == {"btc", "eth", "sol"}
    assert out["btc"].symbol == "BTC" and out["btc"].price_usd == Decimal("0.00000400")
    assert out["eth"].price_usd is None
    assert out["sol"].price_date == dt.date(2024, 3, 1)


def test_daily_rollup_rounds_half_up_once(spark):
    schema = "coin_id string, price_date date, v decimal(28,2), p decimal(20,8), s string, fetched_at timestamp_ntz"
    d = dt.date(2024, 3, 1)
    rows = [("a", d, Decimal("1.25"), Decimal("1"), "old", T0),
            ("a", d, Decimal("1.26"), None, "new", T0 + dt.timedelta(hours=6))]
    df = spark.createDataFrame(rows, schema)
    out = daily_rollup(df, ["coin_id", "price_date"], "fetched_at",
                       {"avg_v": ("v", 2)}, {"latest_p": "p", "latest_s": "s"}).collect()[0]
    assert out.extract_count == 2
    assert out.avg_v == Decimal("1.26")  # exact 1.255 -> half up
    assert out.latest_p is None and out.latest_s == "new"  # a NULL value at the latest time is returned
    assert out._synced_at == T0 + dt.timedelta(hours=6)


def test_prioritized_union_first_feed_wins(spark):
    a = spark.createDataFrame([("x", 1, 10.0), ("y", 1, 20.0)], "k string, d int, v double")
    b = spark.createDataFrame([("x", 1, 99.0), ("z", 1, 30.0)], "k string, d int, v double")
    out = {(r.k, r.source_name): r.v for r in prioritized_union([("snapshot", a), ("history", b)],
                                                               ["k", "d"]).collect()}
    assert out == {("x", "snapshot"): 10.0, ("y", "snapshot"): 20.0, ("z", "history"): 30.0}


def test_bounded_lookback_loses_far_predecessor_exact_keeps_it(spark):
    # Q4: the bounded read starts at max_day - 3 of the target; a touched row whose
    # previous row is older than that gets a NULL return; the exact mode reads it
    d = lambda n: dt.date(2024, 1, n)
    t = lambda n: dt.datetime(2024, 1, n, 12)
    rows = [("a", d(1), Decimal("10"), t(1)), ("a", d(2), Decimal("11"), t(2)),
            ("b", d(9), Decimal("5"), t(9)), ("b", d(10), Decimal("6"), t(10)),
            ("a", d(11), Decimal("22"), t(11))]  # the increment: a's previous day is Jan 2
    daily = spark.createDataFrame(rows, "coin_id string, price_date date, latest_price_usd decimal(20,8), "
                                        "_synced_at timestamp_ntz")
    dim = spark.createDataFrame([("k", "a", dt.datetime(1900, 1, 1), dt.datetime(9999, 12, 31)),
                                 ("kb", "b", dt.datetime(1900, 1, 1), dt.datetime(9999, 12, 31))],
                                "coin_sk string, coin_id string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    mark, max_day = t(10), d(10)
    bounded = M.fct_daily_market(daily, dim, mark=mark, max_day=max_day).collect()
    exact = M.exact_daily_market(daily, dim, ["2024-01-11"]).collect()
    assert [(r.price_date, r.daily_return_pct) for r in bounded] == [(d(11), None)]
    assert [(r.price_date, float(r.daily_return_pct)) for r in exact] == [(d(11), 100.0)]


def test_exact_mode_recomputes_successors_in_and_beyond_the_window(spark):
    d = lambda n: dt.date(2024, 1, n)
    t = dt.datetime(2024, 1, 1)
    rows = [("a", d(1), Decimal("10"), t), ("a", d(10), Decimal("20"), t), ("a", d(11), Decimal("40"), t),
            ("b", d(10), Decimal("5"), t), ("b", d(28), Decimal("10"), t), ("c", d(1), Decimal("1"), t),
            ("a", None, Decimal("7"), t)]
    daily = spark.createDataFrame(rows, "coin_id string, price_date date, latest_price_usd decimal(20,8), "
                                        "_synced_at timestamp_ntz")
    dim = spark.createDataFrame([(k, k, dt.datetime(1900, 1, 1), dt.datetime(9999, 12, 31)) for k in "abc"],
                                "coin_sk string, coin_id string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    got = {(r.coin_sk, r.price_date): r.daily_return_pct for r in M.exact_daily_market(daily, dim, ["2024-01-10"]).collect()}
    assert {k: v and float(v) for k, v in got.items()} == {
        ("a", d(10)): 100.0, ("a", d(11)): 100.0, ("b", d(10)): None, ("b", d(28)): 100.0}


def test_average_is_rounded_once(spark):
    rows = [("x", i, Decimal("0.01") if i <= 5000 else Decimal("0.00")) for i in range(1, 10002)]
    rows += [("tie", 1, Decimal("0.01")), ("tie", 2, Decimal("0.00")), ("neg", 1, Decimal("-0.01")), ("neg", 2, Decimal("0.00"))]
    df = spark.createDataFrame(rows, "k string, t int, v decimal(28,2)")
    out = {r.k: r.a for r in daily_rollup(df, ["k"], "t", {"a": ("v", 2)}, {"l": "v"}).collect()}
    assert out == {"x": Decimal("0.00"), "tie": Decimal("0.01"), "neg": Decimal("-0.01")}
