"""Plan-shape tests: the scale properties the operators are designed for.

They read the physical plan (before execution) and fail if a change would,
e.g., drop the pre-shuffle top-1 of the dedup or add a shuffle to the union.
"""

import datetime as dt

from pyspark.sql import functions as F

from tessera.operators.asof import asof_join
from tessera.operators.dedup import latest_per_key
from tessera.operators.rollup import daily_rollup, prioritized_union
from tessera.plans import events as E
from tessera.sources import landing as L

SMOKE = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_limits_each_key_before_the_shuffle(spark):
    li = E.read(spark, SMOKE, "lineitem")
    p = plan(latest_per_key(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"]))
    exchange = p.index("Exchange hashpartitioning")
    partial = p.index("WindowGroupLimit", exchange)  # below the exchange = runs map-side
    assert "Partial" in p[partial:p.index("\n", partial)]
    assert p.count("Exchange hashpartitioning") == 1


def test_rollup_aggregates_partially_before_the_shuffle(spark):
    s = E.Models(spark, SMOKE).stg_snap()
    p = plan(daily_rollup(s, ["coin_id", "price_date"], "fetched_at", {"a": ("price_usd", 8)},
                          {"l": "price_usd"}))
    exchanges = [i for i in range(len(p)) if p.startswith("Exchange hashpartitioning(coin_id", i)]
    assert len(exchanges) == 1
    assert "partial_max_by" in p[exchanges[0]:]


def test_priority_union_adds_no_shuffle(spark):
    e = E.read(spark, SMOKE, "events")
    a = e.groupBy("user_id", "event_type").agg(F.max("value").alias("v"))
    b = e.groupBy("user_id", "event_type").agg(F.min("value").alias("v"))
    p = plan(prioritized_union([("a", a), ("b", b)], ["user_id", "event_type"]))
    assert p.count("Exchange hashpartitioning") == 2  # the two aggregations' own shuffles only


def test_nested_series_is_one_explode_and_one_shuffle(spark):
    docs = E.history_payloads(E.read(spark, SMOKE, "events"))
    p = plan(L.nested_series_daily(docs, ["event_id", "id"], "payload"))
    assert p.count("Exchange hashpartitioning") == 1
    assert p.count("Generate") == 1
    assert "Join" not in p


def test_filters_and_projection_reach_the_scan(spark):
    e = E.read(spark, SMOKE, "events")
    p = plan(L.time_range(e, "ts", "2024-01-05", "2024-01-06T00:00:00Z").select("event_id"))
    assert "GreaterThanOrEqual(ts,2024-01-05T00:00)" in p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in p
    for ids in ([1, 2], range(20_000)):  # one plan, whatever the length
        p2 = plan(L.restrict_to_ids(e, "user_id", ids))
        assert "LeftSemi" in p2 and "Python" not in p2


def test_asof_merge_sorts_facts_and_versions_once_by_key_and_slice(spark):
    dim = spark.createDataFrame([("k", "a", dt.datetime(1900, 1, 1), dt.datetime(9999, 12, 31))],
                                "coin_sk string, coin_id string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    facts = spark.createDataFrame([("a", dt.datetime(2024, 1, 1))], "coin_id string, fetched_at timestamp_ntz")
    p = plan(asof_join(facts, dim, "coin_id", "fetched_at", method="merge",
                       span=(dt.date(2024, 1, 1), dt.date(2024, 3, 1))))
    assert "Join" not in p  # no candidates are paired
    assert "hashpartitioning(__key" in p and "__slice" in p.split("hashpartitioning(__key", 1)[1].split(")", 1)[0]


def test_daily_returns_open_no_window_over_a_whole_entity(spark):
    windows = [line.split("Window [", 1)[1] for line in plan(E.q_daily_returns(spark, SMOKE)).split("\n") if "- Window [lag" in line]
    assert windows and all("__slice" in line for line in windows)


def test_increment_reads_the_touched_days_only(spark):
    from tessera.operators import incremental as I
    from tessera.plans import market as M
    from tessera.session import scratch_dir

    daily = E.Models(spark, SMOKE).int_daily()
    path = scratch_dir(spark, "t-plan-daily")
    I.replace(spark, daily, path, "price_date")
    dim = E.Models(spark, SMOKE).dim()
    p = plan(M.exact_daily_market(I.read_table(spark, path), dim, ["2024-01-29", "2024-01-30"]))
    scans = [line for line in p.split("\n") if "FileScan parquet" in line and "table_version=" in line or "PartitionFilters" in line and "price_date" in line]
    assert scans and all("PartitionFilters: []" not in line for line in scans)
    feed = I.in_days(I.read_table(spark, path), "price_date", ["2024-01-30"])
    assert "price_date" in plan(feed).split("PartitionFilters: [", 1)[1].split("]", 1)[0]
