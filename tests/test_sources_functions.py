import datetime as dt
import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tessera.functions.scalar import (
    date_key,
    epoch_ms_to_utc_day,
    iso_day_of_week,
    iso_utc_to_ntz,
    pct_change,
    price_text,
    signed_pct_text,
    surrogate_key,
)
from tessera.operators.calendar import calendar_from_bounds
from tessera.sources import landing as L


def test_market_json_flatten(spark, tmpdir_path):
    doc = [
        {"id": "bitcoin", "symbol": "btc", "name": "Bitcoin", "current_price": 1.000025, "market_cap": 10,
         "price_change_percentage_24h": -1.5, "extra": "ignored"},
        {"id": "x", "symbol": None, "name": "X"},  # a null symbol is kept
        {"id": "eth", "symbol": "eth", "name": "Ether"},  # optional fields absent -> NULL
    ]
    os.makedirs(f"{tmpdir_path}/in")
    with open(f"{tmpdir_path}/in/a.json", "w") as f:
        json.dump(doc, f)
    out = {r.id: r for r in L.read_market_json(spark, f"{tmpdir_path}/in", dt.datetime(2024, 1, 1, 6)).collect()}
    assert set(out) == {"bitcoin", "eth", "x"}
    assert out["bitcoin"].price_change_pct_24h == -1.5
    assert out["bitcoin"].current_price == 1.00003  # half-up on the decimal text of the double
    assert out["eth"].current_price is None and out["eth"].fetched_at == dt.datetime(2024, 1, 1, 6)


def test_market_payload_column(spark):
    df = spark.createDataFrame([('[{"id":"a","symbol":"s","name":"n","ath":2}]',), ("[]",)], "payload string")
    out = L.flatten_market_payload(df, "payload", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).collect()
    assert [(r.id, r.ath) for r in out] == [("a", 2.0)]


@pytest.mark.parametrize("payload", ['[{"id":"a","ath":2}', '[{"id":"a","ath":"oops"}]'])
def test_damaged_payloads_fail_and_are_told_apart(spark, payload):
    df = spark.createDataFrame([(1, payload), (2, '[{"id":"b","symbol":null,"ath":1}]'), (3, "[]"), (4, None),
                                (5, '[{"symbol":"c"}]')], "n int, payload string")
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        L.flatten_market_payload(df, "payload", F.lit("2024-01-01").cast("timestamp_ntz")).collect()
    bad = {r.n: r.reason for r in L.payload_rejects(df, "payload").collect()}
    assert bad == {1: "malformed", 5: "missing_id"}
    good = df.where("n in (2, 3, 4)")
    rows = L.flatten_market_payload(good, "payload", F.lit("2024-01-01").cast("timestamp_ntz")).collect()
    assert [(r.id, r.symbol) for r in rows] == [("b", None)]


def test_csv_files_with_another_header_fail(spark, tmpdir_path):
    spark.createDataFrame([("a", "A")], "id string, symbol string").coalesce(1).write.option("header", True).csv(
        f"{tmpdir_path}/csv")
    assert [(r.id, r.symbol, r.name) for r in L.read_landing(spark, f"{tmpdir_path}/csv", L.SNAPSHOT_LANDING, "csv").collect()] \
        == [("a", "A", None)]
    spark.createDataFrame([("B", "b")], "symbol string, id string").coalesce(1).write.mode("append").option(
        "header", True).csv(f"{tmpdir_path}/csv")
    with pytest.raises(Exception, match="(?i)header"):
        L.read_landing(spark, f"{tmpdir_path}/csv", L.SNAPSHOT_LANDING, "csv").collect()


def test_nested_series_edge_cases(spark):
    day = 86_400_000
    d0 = 19723 * day  # 2024-01-01
    payload = {
        "prices": [[d0 + 5, 1.0], [d0 + 10, 2.0], [d0 + day, 3.0], [d0 + day + 1, None], [d0 + 2 * day + 9, 4.0],
                   [d0 + 2 * day + 1, 5.0]],
        "market_caps": [[d0, 100.0], [d0 + 3 * day, 999.0]],  # cap day without a price: dropped
    }  # total_volumes missing entirely
    docs = spark.createDataFrame([("c", json.dumps(payload))], "id string, payload string")
    out = {r.price_date: r for r in L.nested_series_daily(docs, ["id"], "payload").collect()}
    assert sorted(out) == [dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)]
    assert out[dt.date(2024, 1, 1)].price == 2.0 and out[dt.date(2024, 1, 1)].market_cap == 100.0
    assert out[dt.date(2024, 1, 2)].price is None  # the last point of the day is null and wins
    assert out[dt.date(2024, 1, 3)].price == 5.0  # array position decides, not time
    assert out[dt.date(2024, 1, 2)].market_cap is None and out[dt.date(2024, 1, 1)].total_volume is None


def test_id_list_range_and_topn(spark):
    assert L.parse_id_list(" a, b ,,c , ") == ["a", "b", "c"]
    assert L.epoch_seconds("2024-01-01T02:00:00+02:00") == 1704067200
    df = spark.createDataFrame([(i, dt.datetime(2024, 1, 1, i)) for i in range(6)], "id int, ts timestamp_ntz")
    r = L.time_range(df, "ts", "2024-01-01T03:00:00+02:00", "2024-01-01T04:00:00Z")
    assert sorted(x.id for x in r.collect()) == [1, 2, 3, 4]
    assert sorted(x.id for x in L.restrict_to_ids(df, "id", [1, 3]).collect()) == [1, 3]
    many = L.restrict_to_ids(df.select("ts", "id"), "id", list(range(3, 20_000)))
    assert many.columns == ["ts", "id"] and sorted(x.id for x in many.collect()) == [3, 4, 5]
    top = L.top_n(df, [F.col("id").desc()], 2, rank_col="rank").collect()
    assert sorted((x.id, x.rank) for x in top) == [(4, 2), (5, 1)]


def test_csv_and_json_sinks_roundtrip(spark, tmpdir_path):
    df = spark.createDataFrame([("a", "A", "Alpha", 1.5)], "id string, symbol string, name string, current_price double")
    L.write_csv(L.with_load_stamp(df, dt.datetime(2024, 1, 1)), f"{tmpdir_path}/csv", sort_by=["id"])
    back = spark.read.option("header", True).csv(f"{tmpdir_path}/csv").collect()
    assert back[0].id == "a" and back[0]._loaded_at.startswith("2024-01-01")
    L.write_raw_json(df, f"{tmpdir_path}/json")
    assert spark.read.json(f"{tmpdir_path}/json").count() == 1
    L.write_raw_json(df.withColumn("ath", F.lit(None).cast("double")), f"{tmpdir_path}/raw", dt.datetime(2024, 1, 2, 3))
    assert '"ath":null' in spark.read.text(f"{tmpdir_path}/raw/20240102T030000").first()[0]
    L.append_landing(df, f"{tmpdir_path}/pq")
    L.append_landing(df, f"{tmpdir_path}/pq")
    assert spark.read.parquet(f"{tmpdir_path}/pq").count() == 2


def test_scalar_functions(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 7), Decimal("1.28"), Decimal("1.29"), None)],
                               "k int, d date, prev decimal(20,8), cur decimal(20,8), n string")
    r = df.select(
        surrogate_key("k", "n").alias("sk_null"), surrogate_key("k", F.lit("")).alias("sk_empty"),
        date_key("d").alias("dk"), iso_day_of_week("d").alias("dow"),
        pct_change("cur", "prev").alias("pct"), pct_change("cur", F.lit(0)).alias("pct0"),
        price_text(F.lit(1234.565)).alias("p1"), price_text(F.lit(0.123456)).alias("p2"),
        price_text(F.lit(None).cast("double")).alias("p3"),
        signed_pct_text(F.lit(1.234)).alias("s1"), signed_pct_text(F.lit(-0.5)).alias("s2"),
        signed_pct_text(F.lit(1234.5)).alias("s3"), signed_pct_text(F.lit(-1234.567)).alias("s4"),
        signed_pct_text(F.lit(-0.001)).alias("s5"),
        epoch_ms_to_utc_day(F.lit(-1)).alias("neg"),
        iso_utc_to_ntz(F.lit("2024-01-01T01:30:00+02:00")).alias("utc"),
    ).first()
    assert r.sk_null != r.sk_empty
    assert r.dk == 20240107 and r.dow == 7
    assert float(r.pct) == 0.7813  # 0.78125 exactly -> half up
    assert r.pct0 is None
    assert (r.p1, r.p2, r.p3) == ("$1,234.57", "$0.1235", None)
    assert (r.s1, r.s2, r.s3, r.s4, r.s5) == ("+1.23%", "-0.50%", "+1234.50%", "-1234.57%", "-0.00%")
    assert r.neg == dt.date(1969, 12, 31)
    assert r.utc == dt.datetime(2023, 12, 31, 23, 30)


def test_calendar_end_exclusive(spark):
    def calendar(lo, hi, forward):
        return calendar_from_bounds(spark.createDataFrame([(lo, hi)], "lo date, hi date"), "lo", "hi", forward).collect()

    assert calendar(dt.date(2024, 2, 27), dt.date(2024, 2, 27), 0) == []
    cal = calendar(dt.date(2024, 2, 27), dt.date(2024, 3, 2), 0)
    assert [r.date_day for r in cal] == [dt.date(2024, 2, 27), dt.date(2024, 2, 28), dt.date(2024, 2, 29),
                                         dt.date(2024, 3, 1)]
    assert cal[0].month_name == "Feb" and cal[0].quarter == 1 and cal[0].date_sk == 20240227
    assert [r.is_weekend for r in cal] == [False, False, False, False]


def test_csv_landing_is_read_by_header_name(spark, tmpdir_path):
    # the file's column order differs from the declared schema; a missing field reads as NULL
    t = dt.datetime(2024, 1, 1, 0, 0, 7, 179575)
    df = spark.createDataFrame([(t, "btc", 1.25, "b", "Bitcoin")],
                               "fetched_at timestamp_ntz, id string, current_price double, symbol string, name string")
    L.write_csv(df, f"{tmpdir_path}/csv")
    back = L.read_landing(spark, f"{tmpdir_path}/csv", L.SNAPSHOT_LANDING, fmt="csv").first()
    assert (back.id, back.current_price, back.fetched_at, back.ath) == ("btc", 1.25, t, None)


def test_conf_for_scale_grows_partitions_not_broadcasts():
    from tessera.session import conf_for_scale

    small = conf_for_scale(10 << 30, 8)
    big = conf_for_scale(100 << 40, 16000)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    assert int(big["spark.sql.shuffle.partitions"]) == (25 << 40) // (256 << 20)
    assert big["spark.sql.autoBroadcastJoinThreshold"] == small["spark.sql.autoBroadcastJoinThreshold"]


def test_times_do_not_depend_on_the_session_zone(spark):
    from tessera.streaming.stream import with_event_time

    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        texts = spark.createDataFrame([("2024-01-01T01:30:00+02:00",), ("2024-01-01T01:30:00",), ("2024-01-01T01:30:00Z",)],
                                      "s string")
        got = [r.u for r in texts.select(iso_utc_to_ntz("s").alias("u")).collect()]
        assert got == [dt.datetime(2023, 12, 31, 23, 30), dt.datetime(2024, 1, 1, 1, 30), dt.datetime(2024, 1, 1, 1, 30)]
        rows = spark.createDataFrame([(dt.datetime(2024, 1, 1, 12),)], "t timestamp_ntz")
        seconds = with_event_time(rows, "t").select(F.unix_seconds("event_time")).first()[0]
        assert seconds == 1704110400
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_override_map_must_be_unique(spark):
    from tessera.plans import market as M

    df = spark.createDataFrame([(1, "a")], "coin_id int, name string")
    twice = spark.createDataFrame([(1, "x"), (1, "y")], "coin_id int, name string")
    with pytest.raises(ValueError, match="twice"):
        M.apply_overrides(df, twice, "coin_id", ["name"])
    assert M.apply_overrides(df, twice.limit(1), "coin_id", ["name"]).first().name in "xy"


def test_checkpoint_folder_is_asked_for_on_a_cluster():
    from types import SimpleNamespace

    from tessera.session import ensure_checkpoint_dir

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=context)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(session)
