import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.operators import incremental as I
from tessera.operators.asof import asof_join
from tessera.operators.quality import Check, QualityError, gate, run_checks
from tessera.session import scratch_dir

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
SCHEMA = "k string, d date, v double"


def _rows(df):
    return sorted((r.k, r.d, r.v) for r in df.collect())


def _files(spark, target, day):
    at = I.state(spark, target)
    folder = f"{target}/versions/table_version={at['parts'][f'd={day}']}/d={day}"
    return sorted(r.path for r in spark.read.format("binaryFile").load(folder).select("path").collect())


def test_upsert_touches_only_delta_partitions(spark, tmpdir_path):
    target = f"{tmpdir_path}/t"
    I.upsert(spark, spark.createDataFrame([("a", D1, 1.0), ("b", D2, 2.0)], SCHEMA), target, ["k", "d"], "d")
    before_d1 = _files(spark, target, D1)
    stats = I.upsert(spark, spark.createDataFrame([("b", D2, 20.0), ("c", D3, 3.0)], SCHEMA), target, ["k", "d"], "d")
    assert stats["touched_partitions"] == 2
    assert _rows(I.read_table(spark, target)) == [("a", D1, 1.0), ("b", D2, 20.0), ("c", D3, 3.0)]
    assert _files(spark, target, D1) == before_d1  # untouched partition not rewritten
    # the same rows again, and no rows, change nothing
    I.upsert(spark, spark.createDataFrame([("b", D2, 20.0)], SCHEMA), target, ["k", "d"], "d")
    I.upsert(spark, spark.createDataFrame([], SCHEMA), target, ["k", "d"], "d")
    assert _rows(I.read_table(spark, target)) == [("a", D1, 1.0), ("b", D2, 20.0), ("c", D3, 3.0)]
    # which days changed since a state is read from the pointers
    assert I.changed_days(spark, target, 1) == [str(D2), str(D3)]
    assert I.changed_days(spark, target, None) == [str(D1), str(D2), str(D3)]


def test_newest_row_stays_whatever_the_order(spark, tmpdir_path):
    target = f"{tmpdir_path}/t"
    for v in (2.0, 3.0, 1.0):
        I.upsert(spark, spark.createDataFrame([("a", D1, v)], SCHEMA), target, ["k", "d"], "d", newest_by=["v"])
    assert _rows(I.read_table(spark, target)) == [("a", D1, 3.0)]


def test_null_day_does_not_block_later_writes(spark, tmpdir_path):
    target = f"{tmpdir_path}/t"
    I.upsert(spark, spark.createDataFrame([("a", None, 1.0), ("b", D1, 2.0)], SCHEMA), target, ["k", "d"], "d")
    I.upsert(spark, spark.createDataFrame([("c", None, 3.0), ("d", D2, 4.0)], SCHEMA), target, ["k", "d"], "d", marks=["d"])
    assert sorted((r.k, r.d) for r in I.read_table(spark, target).collect()) == [
        ("a", None), ("b", D1), ("c", None), ("d", D2)]
    assert I.days_of(I.state(spark, target)) == [str(D1), str(D2)]
    assert I.mark_of(spark, target, "d").date() == D2


@pytest.mark.parametrize("write", ["upsert", "replace"])
def test_a_write_that_dies_leaves_the_table_as_it_was(spark, tmpdir_path, monkeypatch, write):
    target = f"{tmpdir_path}/t"
    old = spark.createDataFrame([("a", D1, 1.0), ("b", D2, 2.0)], SCHEMA)
    new = spark.createDataFrame([("b", D2, 20.0), ("c", D3, 3.0)], SCHEMA)
    I.replace(spark, old, target, "d")
    run = (lambda: I.upsert(spark, new, target, ["k", "d"], "d")) if write == "upsert" else (
        lambda: I.replace(spark, new, target, "d"))

    def die(*a, **k):
        raise RuntimeError("driver lost before the pointer was added")

    with monkeypatch.context() as m:
        m.setattr(I, "commit", die)
        with pytest.raises(RuntimeError):
            run()
    assert _rows(I.read_table(spark, target)) == _rows(old)
    run()
    kept = [("a", D1, 1.0)] if write == "upsert" else []
    assert _rows(I.read_table(spark, target)) == kept + [("b", D2, 20.0), ("c", D3, 3.0)]


def test_second_writer_is_refused(spark, tmpdir_path):
    target = f"{tmpdir_path}/t"
    I.replace(spark, spark.createDataFrame([("a", D1, 1.0)], SCHEMA), target, "d")
    at = I.state(spark, target)
    I.commit(spark, target, at, at)
    with pytest.raises(I.ConcurrentWriteError):
        I.commit(spark, target, at, at)


def test_files_of_a_day_follow_its_size_not_the_task_count(spark, tmpdir_path):
    rows = spark.range(2000).selectExpr("cast(id as string) k", "date_add(date'2024-01-01', cast(id % 5 as int)) d",
                                        "cast(id as double) v").repartition(16)
    I.replace(spark, rows, f"{tmpdir_path}/t", "d")
    assert [len(_files(spark, f"{tmpdir_path}/t", dt.date(2024, 1, 1 + i))) for i in range(5)] == [1] * 5


def test_upsert_rejects_duplicate_delta(spark, tmpdir_path):
    dup = spark.createDataFrame([("a", D1, 1.0), ("a", D1, 2.0)], SCHEMA)
    with pytest.raises(I.DuplicateKeyError):
        I.upsert(spark, dup, f"{tmpdir_path}/t", ["k", "d"], "d")


def test_schema_sync_adds_and_drops_columns(spark, tmpdir_path):
    target = f"{tmpdir_path}/t"
    old = spark.createDataFrame([("a", D1, 1.0, True)], "k string, d date, v double, legacy boolean")
    I.upsert(spark, old, target, ["k", "d"], "d")
    new = spark.createDataFrame([("b", D2, 2.0, "x")], "k string, d date, v double, extra string")
    I.upsert(spark, new, target, ["k", "d"], "d")
    got = I.read_table(spark, target)  # as any reader sees it
    assert sorted(got.columns) == ["d", "extra", "k", "v"]
    assert sorted((r.k, r.extra) for r in got.collect()) == [("a", None), ("b", "x")]


def test_high_water_mark(spark, tmpdir_path):
    assert I.high_water_mark(None, "v") is None
    assert I.read_table(spark, f"{tmpdir_path}/missing") is None
    df = spark.createDataFrame([("a", D1, 1.0), ("b", D2, 5.0)], SCHEMA)
    assert I.high_water_mark(df, "v") == 5.0


def test_each_quality_check_fails_on_a_planted_row(spark):
    good = spark.createDataFrame([("a", 1.0, "coin", "p1"), ("b", 2.0, "stablecoin", "p2")],
                                 "k string, v double, t string, fk string")
    parent = spark.createDataFrame([("p1",), ("p2",)], "pk string")
    checks = [
        Check("m", "not_null", ("k",)), Check("m", "unique", ("k",)),
        Check("m", "unique_combination", ("k", "t")), Check("m", "accepted_range", ("v",), min_value=0),
        Check("m", "accepted_values", ("t",), values=("coin", "stablecoin")),
        Check("m", "relationships", ("fk",), to_model="p", to_column="pk"),
    ]
    clean = {(r.test, r.column_name): r.failures for r in run_checks(spark, {"m": good, "p": parent}, checks).collect()}
    assert set(clean.values()) == {0}
    gate(run_checks(spark, {"m": good, "p": parent}, checks))
    planted = good.unionByName(spark.createDataFrame(
        [(None, 0.0, "token", "p9"), ("a", None, "coin", None)], good.schema))
    bad = {(r.test, r.column_name): r.failures for r in run_checks(spark, {"m": planted, "p": parent}, checks).collect()}
    assert bad == {("not_null", "k"): 1, ("unique", "k"): 1, ("unique_combination", "k,t"): 1,
                   ("accepted_range", "v"): 1, ("accepted_values", "t"): 1, ("relationships", "fk"): 1}
    with pytest.raises(QualityError):
        gate(run_checks(spark, {"m": planted, "p": parent}, checks))


def test_filtered_unique_combination(spark):
    dim = spark.createDataFrame([("a", True), ("a", False), ("a", False), ("b", True), ("b", True)],
                                "coin_id string, is_current boolean")
    c = Check("dim", "unique_combination", ("coin_id", "is_current"), where="is_current = true")
    assert run_checks(spark, {"dim": dim}, [c]).where(F.col("failures") > 0).first().failures == 1


def test_row_tests_ride_on_the_writes(spark):
    from tessera.plans.pipeline import Warehouse

    row = "id string, symbol string, name string, current_price double, market_cap double, total_volume double, fetched_at timestamp_ntz, _loaded_at timestamp_ntz"
    hist = "id string, symbol string, name string, price_date date, price double, market_cap double, total_volume double, fetched_at timestamp_ntz, _loaded_at timestamp_ntz"
    at = lambda d: dt.datetime(2024, 1, d, 6)
    feed = lambda *days: spark.createDataFrame([("1", "a", "A", float(d), 1.0, 1.0, at(d), at(d)) for d in days] + [("1", "a", "A", -1.0, 1.0, 1.0, at(20), at(20))], row)
    wh = Warehouse(spark, scratch_dir(spark, "t-observed"), "dev")
    none = spark.createDataFrame([], hist)
    wh.build(feed(1, 2), none, as_of=at(3))
    wh.build(feed(1, 2, 21), none, as_of=at(22))
    report = wh.quality_report()
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert "isnull(price_usd" not in plan and "isnull(avg_price_usd" not in plan  # no table is read for its row tests
    assert report.count() == 38 and report.where("failures > 0").count() == 0
    # a write that breaks a test is seen by the next gate, which reads the exact count
    bad = wh.table("int_daily").withColumn("avg_price_usd", F.lit(None).cast("decimal(20,8)")).where("price_date = '2024-01-01'")
    wh._upsert("int_daily", bad, ["coin_id", "price_date"])
    assert I.state(spark, wh.path("int_daily"))["info"]["row_failures"] == 1
    with pytest.raises(QualityError, match=r"avg_price_usd\)=1"):
        gate(wh.quality_report())
    # a write that was not tested leaves the count unknown, so the table is read
    I.replace(spark, wh.table("int_daily").fillna({"name": "x"}), wh.path("int_daily"), "price_date")
    assert I.state(spark, wh.path("int_daily"))["info"]["row_failures"] is None
    assert wh.quality_report().where("column_name = 'avg_price_usd' and failures = 1").count() == 1


def test_orphans_are_found_from_changed_children_and_from_keys_that_left(spark):
    from tessera.plans import events as E
    from tessera.plans.pipeline import Warehouse

    events = E.read(spark, "/root/testdata/sf0.001", "events")
    wh = Warehouse(spark, scratch_dir(spark, "t-orphans"), "dev", stable_ids=E.STABLE_USERS, quality_scope="touched")
    cuts = [dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 20)]
    for cut in cuts:
        wh.build(E.snapshot_landing(events, cut), E.history_landing(events, cut), as_of=cut)
    since = wh._state("gate")["numbers"]
    failing = lambda: {(r.model, r.column_name): r.failures
                       for r in wh.quality_report(None, ["fct_market_snapshot", "fct_daily_market"], since).where("test = 'relationships'").collect()}
    assert set(failing().values()) == {0}
    dim = wh.table("dim_coin")
    lost = dim.orderBy("coin_sk").first().coin_sk
    rows = wh.table("fct_daily_market")
    want = rows.where(F.col("coin_sk") == lost).count()
    I.replace(spark, dim.where(F.col("coin_sk") != lost), wh.path("dim_coin"))  # a key leaves the parent
    first = I.days_of(I.state(spark, wh.path("fct_daily_market")))[0]
    bad = I.in_days(rows, "price_date", [first]).withColumn("coin_sk", F.lit("nobody"))
    n_bad, also = bad.count(), rows.where((F.col("coin_sk") == lost) & (F.col("price_date") == F.lit(first))).count()
    I.replace_days(spark, bad, wh.path("fct_daily_market"), "price_date", [first])  # and a child day points nowhere
    got = failing()
    assert want and got["fct_daily_market", "coin_sk"] == want - also + n_bad
    exact = {(r.model, r.column_name): r.failures
             for r in wh.quality_report(None, ["fct_market_snapshot", "fct_daily_market"]).where("test = 'relationships'").collect()}
    assert got == exact


def test_expired_versions_leave_the_newest_states_readable(spark):
    path = scratch_dir(spark, "t-expire")
    df = lambda v, *days: spark.createDataFrame([("a", d, v) for d in days], SCHEMA)
    I.replace(spark, df(1.0, D1, D2), path, "d")
    for v in (2.0, 3.0, 4.0):
        I.upsert(spark, df(v, D2), path, ["k", "d"], "d")
    before = [I.state(spark, path, n) for n in (1, 2, 3, 4)]
    dead = I.expire(spark, path, keep=2)
    # the first version still holds day 1; only the second write's copy of day 2 is named by no kept state
    assert dead == [before[1]["parts"]["d=2024-01-02"]]
    assert _rows(I.read_table(spark, path)) == [("a", D1, 1.0), ("a", D2, 4.0)]
    assert _rows(I.read_table(spark, path, before[2])) == [("a", D1, 1.0), ("a", D2, 3.0)]
    assert I.state(spark, path, 2) is None and I.expire(spark, path, keep=2) == []
    I.upsert(spark, df(5.0, D3), path, ["k", "d"], "d")
    assert _rows(I.read_table(spark, path))[-1] == ("a", D3, 5.0)
    with pytest.raises(ValueError):
        I.expire(spark, path, keep=0)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_relationships_are_counted_by_key_without_a_parent_on_the_driver(spark):
    child = spark.createDataFrame([("p1",), ("p1",), ("x",), ("x",), ("x",), ("y",), (None,)], "fk string")
    parent = spark.createDataFrame([("p1",), ("p1",), (None,)], "pk string")
    check = Check("m", "relationships", ("fk",), to_model="p", to_column="pk")
    report = lambda c: run_checks(spark, {"m": c, "p": parent}, [check])
    assert [r.failures for r in report(child).collect()] == [4]
    assert [r.failures for r in report(child.limit(2)).collect()] == [0]
    assert "Broadcast" not in _plan(report(child))


def test_no_join_of_a_write_sends_the_delta_to_the_driver(spark, tmpdir_path, monkeypatch):
    target = f"{tmpdir_path}/t"
    I.upsert(spark, spark.createDataFrame([("a", D1, 1.0), ("b", D2, 2.0)], SCHEMA), target, ["k", "d"], "d")
    plans, write = [], I._write
    monkeypatch.setattr(I, "_write", lambda s, df, *a: plans.append(_plan(df)) or write(s, df, *a))
    I.upsert(spark, spark.createDataFrame([("b", D2, 20.0), ("c", D3, 3.0)], SCHEMA), target, ["k", "d"], "d")
    assert "SortMergeJoin" in plans[-1] and not any("Broadcast" in p for p in plans)
    assert _rows(I.read_table(spark, target)) == [("a", D1, 1.0), ("b", D2, 20.0), ("c", D3, 3.0)]
    facts = spark.createDataFrame([("a", D1), ("b", None)], "coin_id string, day date")
    dim = spark.createDataFrame([("a", "s", dt.datetime(2020, 1, 1), dt.datetime(9999, 1, 1))],
                                "coin_id string, coin_sk string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    joined = asof_join(facts, dim, "coin_id", "day", grain="day")
    assert "Broadcast" not in _plan(joined)
    assert sorted((r.coin_id, r.coin_sk) for r in joined.collect()) == [("a", "s"), ("b", None)]


def test_a_delta_of_new_days_is_written_once(spark, tmpdir_path, monkeypatch):
    target = f"{tmpdir_path}/t"
    df = lambda *rows: spark.createDataFrame(list(rows), SCHEMA)
    writes, write = [], I._write
    monkeypatch.setattr(I, "_write", lambda *a: writes.append(a) or write(*a))
    monkeypatch.setattr(I, "scratch_dir", lambda *a: 1 / 0)  # no second copy
    named = lambda: {v for n in range(1, I.state(spark, target)["number"] + 1) for v in I.state(spark, target, n)["parts"].values()}
    kept = lambda: {n.split("=", 1)[1] for n in I._children(spark, f"{target}/versions")}
    I.upsert(spark, df(("a", D1, 1.0)), target, ["k", "d"], "d")
    I.upsert(spark, df(("a", D2, 2.0), ("n", None, 3.0)), target, ["k", "d"], "d")
    assert len(writes) == 2 and kept() == named()
    # older rows of a day, also of none, stay; the delta's own copy goes
    I.upsert(spark, df(("b", D2, 4.0), ("m", None, 5.0)), target, ["k", "d"], "d")
    I.upsert(spark, df(), target, ["k", "d"], "d")
    assert kept() == named()
    # days of which the delta has all rows replace the old ones, and go if it has none
    I.upsert(spark, df(("c", D2, 6.0)), target, ["k", "d"], "d", whole_days=[str(D1), str(D2)])
    assert kept() == named()
    assert sorted(((r.k, r.d, r.v) for r in I.read_table(spark, target).collect()), key=repr) == [
        ("c", D2, 6.0), ("m", None, 5.0), ("n", None, 3.0)]
