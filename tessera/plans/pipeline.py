"""The incremental build of the whole warehouse, one environment at a time.

``Warehouse(spark, root, env)`` keeps every model as a table under
``root/env/`` (SK-9: dev, qa and prod are independent outputs of the same
landing zone). ``build(...)`` runs the models in dependency order, and the
declared tests of a layer before the next layer is written:

    landing -> stg_snapshot, stg_history -> int_daily -> tests
            -> snapshot (SCD2) -> dim_coin, dim_date
            -> fct_market_snapshot, fct_daily_market -> tests

Incremental models take their watermark from their own table's pointer and
write only touched day partitions; ``full_refresh=True`` rebuilds them from
scratch but keeps the version history (SK-7). ``build_batch`` does the same for
a micro-batch of new rows in any order (SS-3): no watermark is asked, rows are
upserted newest first, and what changed is read from the tables' pointers.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import incremental as I
from tessera.operators.calendar import calendar_from_bounds
from tessera.operators.quality import Check, failing_rows, gate, orphans_since, run_checks, warehouse_checks
from tessera.operators.rollup import STATE
from tessera.operators.scd2 import PART, VTO, history_part, scd2_changes, scd2_dimension, scd2_initial
from tessera.plans import market as M
from tessera.session import delete_path, scratch_root

ATTRS = ["symbol", "name", "asset_type"]
SILVER = ("stg_snapshot", "stg_history", "int_daily")
# day partition column of each incrementally upserted model
PARTITION_COLS = {"stg_snapshot": "price_date", "stg_history": "price_date", "int_daily": "price_date",
                  "fct_market_snapshot": "date_sk", "fct_daily_market": "price_date"}


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, env: str = "dev", pick: str = "max",
                 stable_ids=tuple(M.STABLECOIN_IDS), daily_mode: str = "exact", lookback_days: int = 3,
                 calendar_start: dt.date | None = None, forward_days: int = 3,
                 watermark: str = "fetched_at", per_feed_marks: bool = False, quality_scope: str = "full"):
        self.spark, self.env = spark, env
        self.base = f"{root.rstrip('/')}/{env}"
        self.pick, self.stable_ids = pick, list(stable_ids)
        self.daily_mode, self.lookback_days = daily_mode, lookback_days
        self.calendar_start, self.forward_days = calendar_start, forward_days
        self.watermark, self.per_feed_marks = watermark, per_feed_marks
        if quality_scope not in ("touched", "full"):
            raise ValueError(f"quality_scope must be 'touched' or 'full', not {quality_scope!r}")
        self.quality_scope = quality_scope

    @property
    def by_load_time(self) -> bool:
        """Rows count as new by when they were loaded, not by their event time (Q1/Q2 options)."""
        return self.watermark != "fetched_at" or self.per_feed_marks

    def path(self, model: str) -> str:
        return f"{self.base}/{model}"

    def table(self, model: str) -> DataFrame | None:
        df = I.read_table(self.spark, self.path(model))
        return None if df is None else M.without_rejects(df.drop(STATE))

    def _state(self, model: str) -> dict | None:
        return I.state(self.spark, self.path(model))

    def _upsert(self, model: str, delta: DataFrame, keys, **options) -> dict:
        # every model delta is unique on its key by construction (dedup or
        # group-by on the key); the quality suite tests the table afterwards
        return I.upsert(self.spark, delta, self.path(model), keys, PARTITION_COLS[model], check_unique=False,
                        failing=self._failing(model, delta), **options)

    def _replace(self, model: str, df: DataFrame, **options) -> None:
        I.replace(self.spark, df, self.path(model), PARTITION_COLS.get(model), failing=self._failing(model, df), **options)

    @staticmethod
    def _failing(model: str, df: DataFrame) -> Column | None:
        """The rows that the write is to count: those that fail a row test and are no tombstones."""
        bad = failing_rows(model)
        return bad & ~F.coalesce(F.col(M.REJECTED), F.lit(False)) if bad is not None and M.REJECTED in df.columns else bad

    def _seen(self, model: str, source: str) -> int | None:
        """The state of ``source`` that ``model`` was last built from."""
        at = self._state(model)
        return at["info"].get(source) if at else None

    def _numbers(self, *sources: str) -> dict:
        return {m: self._state(m)["number"] for m in sources}

    # ------------------------------------------------------------ version history

    def versions(self) -> DataFrame | None:
        """The newest history (``None`` before the first run or after a reset)."""
        at = self._state("snapshot")
        if at is None or at["info"].get("reset"):
            return None
        return I.read_table(self.spark, self.path("snapshot"), at).drop(PART)

    def _apply_versions(self, incoming: DataFrame, as_of: dt.datetime) -> None:
        """SK-3 on the stored history: closed versions are added to the part of their day, and of the open ones
        only the parts with a change are written; a run without changes writes nothing."""
        s, path = self.spark, self.path("snapshot")
        if self.versions() is None:
            first = scd2_initial(incoming, "coin_id", ATTRS, as_of)
            I.replace(s, first.withColumn(PART, history_part("coin_id")), path, PART)
            return
        history = I.read_table(s, path)
        if PART not in history.columns:  # written before histories had parts
            I.replace(s, history.withColumn(PART, history_part("coin_id")), path, PART)
            history = I.read_table(s, path)
        open_ = history.where(F.col(PART).startswith("open-")).drop(PART)
        changes = scd2_changes(open_, incoming, "coin_id", ATTRS, as_of).withColumn(PART, history_part("coin_id"))
        changes = I.staged(changes, "version-changes")
        closing = changes.where(F.col(VTO).isNotNull()).select("coin_id")
        as_open = closing.withColumn(VTO, F.lit(None).cast("timestamp_ntz")).select(history_part("coin_id").alias(PART))
        parts = sorted(r[0] for r in changes.select(PART).union(as_open).distinct().collect())
        if parts:
            there = I.in_days(history, PART, parts)
            kept = there.where(F.col(VTO).isNull()).join(closing.hint("merge"), "coin_id", "left_anti").unionByName(
                there.where(F.col(VTO).isNotNull()))
            I.replace_days(s, kept.unionByName(changes), path, PART, parts)

    def reset_versions(self) -> bool:
        """SK-8: start a fresh, empty history; facts then need a full refresh (Q9).

        The pointer says so; the files of older histories, and the pointers to
        them, stay where they are.
        """
        at = self._state("snapshot")
        if at is not None:
            I.commit(self.spark, self.path("snapshot"), {**at, "parts": {}, "info": {"reset": True}}, at)
        return True

    # ------------------------------------------------------------ build

    def build(self, snap_landing: DataFrame, hist_landing: DataFrame, as_of: dt.datetime,
              full_refresh: bool = False, quality_gate: bool = True, overrides: DataFrame | None = None) -> dict:
        # whether the last run's gate passed is forgotten before anything is
        # written, so a run that dies or fails its gate does not leave it said
        passed, since = self._gate_passed(), (self._state("gate") or {}).get("numbers") or {}
        self._set_gate(False)
        stats = self.build_silver(snap_landing, hist_landing, full_refresh, overrides)
        scoped = self.quality_scope == "touched" and passed and not full_refresh
        if quality_gate:
            gate(self.quality_report(self.touched_scope(stats) if scoped else None, SILVER))
        stats.update(self.build_gold(as_of, full_refresh))
        if quality_gate:
            gold = [c.model for c in warehouse_checks() if c.model not in SILVER]
            gate(self.quality_report(self.touched_scope(stats) if scoped else None, gold, since if scoped else None))
            self._set_gate(True)
        return stats

    def _gate_passed(self) -> bool:
        at = self._state("gate")
        return bool(at and at["passed"])

    def _set_gate(self, passed: bool) -> None:
        if passed != self._gate_passed():
            models = sorted({m for c in warehouse_checks() for m in (c.model, c.to_model) if m}) if passed else []
            I.commit(self.spark, self.path("gate"), {"passed": passed, "numbers": self._numbers(*models)}, self._state("gate"))

    def _orphans(self, checks: list[Check], since: dict) -> dict:
        """Failing rows of relationships, from what changed since the tables' states ``since``, in which there were none."""
        found = {}
        for c in checks:
            pc = PARTITION_COLS.get(c.model)
            if c.test != "relationships" or pc is None or not {c.model, c.to_model} <= set(since):
                continue
            child, days = self.table(c.model), I.changed_days(self.spark, self.path(c.model), since[c.model])
            then = I.read_table(self.spark, self.path(c.to_model), I.state(self.spark, self.path(c.to_model), since[c.to_model]))
            now = I.in_days(child, pc, days)
            others = child.where(~F.coalesce(F.col(pc).cast("string").isin([d for d in days if d is not None]), F.lit(None in days)))
            found[c.model, c.column_name] = orphans_since(others, now, c.columns[0], self.table(c.to_model), then, c.to_column)
        return found

    def touched_scope(self, stats: dict) -> dict:
        """Partition predicates of the models this run upserted (replaced
        models are absent, so they are tested whole)."""
        scope = {}
        for model, pc in PARTITION_COLS.items():
            days = (stats.get(model) or {}).get("partitions")
            if days is not None:
                dtype = self.table(model).schema[pc].dataType
                hit = F.col(pc).isin([F.lit(d).cast(dtype) for d in days if d is not None]) if days else F.lit(False)
                scope[model] = hit | F.col(pc).isNull() if None in days else hit
        return scope

    def build_silver(self, snap_landing: DataFrame, hist_landing: DataFrame, full_refresh: bool = False,
                     overrides: DataFrame | None = None) -> dict:
        stats: dict = {}
        before = self._numbers("stg_snapshot", "stg_history") if self._state("int_daily") else {}
        # cleaned feeds (strict > watermark; on fetched_at like the reference,
        # Q1, or on _loaded_at to take late rows too)
        wm = self.watermark
        for model, raw, fn, keys, newest in (
            ("stg_snapshot", snap_landing, M.stg_snapshot, ["coin_id", "fetched_at"], ["_loaded_at"]),
            ("stg_history", hist_landing, M.stg_history, ["coin_id", "price_date"], ["fetched_at", "_loaded_at"]),
        ):
            mark = None if full_refresh else I.mark_of(self.spark, self.path(model), wm)
            delta = fn(raw, mark, overrides=overrides, mark_col=wm, keep_rejects=True)
            if full_refresh:
                self._replace(model, delta, marks=[wm])
            else:
                # by load time, a late row may be older than the one it meets
                stats[model] = self._upsert(model, delta, keys, marks=[wm], keep_delta=True,
                                            newest_by=newest if self.by_load_time else ())
        if full_refresh or self._state("int_daily") is None:
            self._full_daily()
        elif self.by_load_time:
            stats["int_daily"] = self._changed_daily()
        else:
            stats["int_daily"] = self._merged_daily(before, {m: M.without_rejects(stats[m]["delta"]) for m in before})
        for model in ("stg_snapshot", "stg_history"):
            if model in stats:
                delete_path(self.spark, stats[model].pop("staging"), scratch_root(self.spark))
                del stats[model]["delta"]
        return stats

    def build_batch(self, snap_rows: DataFrame, hist_rows: DataFrame, overrides: DataFrame | None = None) -> dict:
        """SS-3: rows that a stream has not delivered before, in any order.

        Of the rows of a key, from this batch or an earlier one, the newest
        stays; if that is a bad one the key has no row, whatever batch brought
        its older rows. A repeated batch changes nothing.
        """
        stats = {
            "stg_snapshot": self._upsert("stg_snapshot", M.stg_snapshot(snap_rows, overrides=overrides, keep_rejects=True),
                                         ["coin_id", "fetched_at"], newest_by=["_loaded_at"], marks=["fetched_at"]),
            "stg_history": self._upsert("stg_history", M.stg_history(hist_rows, overrides=overrides, keep_rejects=True),
                                        ["coin_id", "price_date"], newest_by=["fetched_at", "_loaded_at"],
                                        marks=["fetched_at"])}
        if self._state("int_daily") is None:
            self._full_daily()
        else:
            stats["int_daily"] = self._changed_daily()
        return stats

    def _merged_daily(self, before: dict, deltas: dict[str, DataFrame]) -> dict:
        """The daily grain brought up to date from the feeds' new rows.

        Reference: one mark for both feeds, taken from the target (Q2); a key
        with a newer row in either is computed again. A key's snapshot rows are
        not read for that: its state is kept with its row and merged with that
        of the new rows. That holds as long as the daily grain has seen every
        earlier row, which the feeds' pointers say; else (a run died in
        between, or rows were older than the mark) touched keys are recomputed
        from all their rows.
        """
        mark = I.mark_of(self.spark, self.path("int_daily"), "_synced_at")
        at = self._state("int_daily")
        target = I.read_table(self.spark, self.path("int_daily"), at)
        info = self._numbers("stg_snapshot", "stg_history")
        known = {m: at["info"].get(m) for m in before} == before and STATE in target.columns and mark is not None
        oldest = deltas["stg_snapshot"].agg(F.min("fetched_at")).first()[0] if known else None
        behind = known and oldest is not None and oldest <= mark
        snap, hist = self.table("stg_snapshot"), self.table("stg_history")
        new = list(deltas.values()) if known else [snap, hist]
        days_from = [None, None] if known else ["price_date", None]
        touched = I.staged(M.touched_keys(new, M.DAILY_KEYS, "fetched_at", mark, day_cols=days_from), "touched-keys")
        days = [r[0] for r in touched.select(F.col("price_date").cast("string")).distinct().collect()]
        of_touched = lambda df: I.in_days(df, "price_date", days).join(touched.hint("merge"), M.DAILY_KEYS, "left_semi")
        if known and not behind:
            old = of_touched(target.where(F.col(STATE).isNotNull()).select(*M.DAILY_KEYS, STATE))
            daily = M.merged_snapshot_daily(old, deltas["stg_snapshot"])
        else:
            daily = M.snapshot_daily(of_touched(snap), keep_state=True)
        if behind:  # rows that no key was computed again for are not in any state yet
            info["stg_snapshot"] = None
        return self._upsert("int_daily", M.unified_daily(daily, of_touched(hist)), M.DAILY_KEYS, marks=["_synced_at"], info=info)

    def _full_daily(self) -> None:
        self._replace("int_daily", M.int_daily(self.table("stg_snapshot"), self.table("stg_history"), keep_state=True),
                      marks=["_synced_at"], info=self._numbers("stg_snapshot", "stg_history"))

    def _changed_daily(self) -> dict:
        """Recompute the days in which either feed changed since int_daily was last built."""
        feeds = ("stg_snapshot", "stg_history")
        days = sorted({d for m in feeds for d in I.changed_days(self.spark, self.path(m), self._seen("int_daily", m))},
                      key=str)
        daily = M.int_daily(*(I.in_days(self.table(m), "price_date", days) for m in feeds), keep_state=True)
        I.replace_days(self.spark, daily, self.path("int_daily"), "price_date", days, info=self._numbers(*feeds),
                       failing=self._failing("int_daily", daily))
        return {"touched_partitions": len(days), "partitions": days}

    def _attributes(self, full_refresh: bool) -> DataFrame:
        """AG-4 input of the version history: one row per coin.

        What each day says of a coin is kept in a table; a day that changed in
        a feed is computed again, so a replaced row's attributes leave with it
        and no run reads the feeds whole.
        """
        feeds = ("stg_snapshot", "stg_history")
        since = {m: None if full_refresh else self._seen("attr_daily", m) for m in feeds}
        days = sorted({d for m in feeds for d in I.changed_days(self.spark, self.path(m), since[m])}, key=str)
        if days or self._state("attr_daily") is None:
            daily = M.attributes_daily(*(I.in_days(self.table(m), "price_date", days) for m in feeds))
            if full_refresh or self._state("attr_daily") is None:
                I.replace(self.spark, daily, self.path("attr_daily"), "price_date", info=self._numbers(*feeds))
            else:
                I.replace_days(self.spark, daily, self.path("attr_daily"), "price_date", days,
                               info=self._numbers(*feeds))
        return M.attributes_of(self.table("attr_daily"), self.pick, self.stable_ids)

    def build_gold(self, as_of: dt.datetime, full_refresh: bool = False) -> dict:
        s = self.spark
        stats: dict = {}

        # version history (never reset by a full refresh) and dimensions
        self._apply_versions(self._attributes(full_refresh), as_of)
        self._replace("dim_coin", scd2_dimension(self.versions(), "coin_id", ATTRS, "coin_sk"))
        dim = self.table("dim_coin")
        # the day bounds of the cleaned feeds come from their pointers (no
        # job; a day is there only with rows in it); min/max skip NULL days
        days = sorted({dt.date.fromisoformat(d) for m in ("stg_snapshot", "stg_history")
                       for d in I.days_of(self._state(m))})
        bounds = s.createDataFrame([(days[0] if days else None, days[-1] if days else None)], "lo date, hi date")
        if self.calendar_start is not None:
            bounds = bounds.withColumn("lo", F.lit(self.calendar_start))
        self._replace("dim_date", calendar_from_bounds(bounds, "lo", "hi", self.forward_days))

        # facts
        snap, info = self.table("stg_snapshot"), self._numbers("stg_snapshot")
        fresh = full_refresh or self._state("fct_market_snapshot") is None
        if fresh:
            self._replace("fct_market_snapshot", M.fct_market_snapshot(snap, dim), marks=["fetched_at"], info=info)
        else:
            whole = []
            if self.by_load_time:
                changed = I.changed_days(s, self.path("stg_snapshot"), self._seen("fct_market_snapshot", "stg_snapshot"))
                rows = M.fct_market_snapshot(I.in_days(snap, "price_date", changed), dim)
                whole = [d and d.replace("-", "") for d in changed]  # rows that were rejected since are to go
            else:
                mark = I.mark_of(s, self.path("fct_market_snapshot"), "fetched_at")
                rows = M.fct_market_snapshot(snap, dim, mark)
            stats["fct_market_snapshot"] = self._upsert("fct_market_snapshot", rows, ["snapshot_sk"],
                                                        marks=["fetched_at"], info=info, whole_days=whole)
        daily, info = self.table("int_daily"), self._numbers("int_daily")
        if full_refresh or self._state("fct_daily_market") is None:
            self._replace("fct_daily_market", M.fct_daily_market(daily, dim), marks=["_synced_at"], info=info)
        else:
            changed = I.changed_days(s, self.path("int_daily"), self._seen("fct_daily_market", "int_daily"))
            whole = changed if self.daily_mode == "exact" else []
            if self.daily_mode == "bounded":
                at = self._state("fct_daily_market")
                newest = max(I.days_of(at), default=None)
                rows = M.fct_daily_market(daily, dim, mark=I.mark_of(s, self.path("fct_daily_market"), "_synced_at"),
                                          max_day=newest and dt.date.fromisoformat(newest),
                                          lookback_days=self.lookback_days)
            else:
                rows = M.exact_daily_market(daily, dim, changed, self.lookback_days)
            stats["fct_daily_market"] = self._upsert("fct_daily_market", rows, ["daily_market_sk"],
                                                     marks=["_synced_at"], info=info, whole_days=whole)
        return stats

    def tables(self) -> dict[str, DataFrame]:
        names = ["stg_snapshot", "stg_history", "int_daily", "dim_coin", "dim_date",
                 "fct_market_snapshot", "fct_daily_market"]
        return {n: self.table(n) for n in names}

    def quality_report(self, scope: dict | None = None, models=None, since: dict | None = None) -> DataFrame:
        """The 38 declared tests (or those of ``models``); ``scope`` limits partition-local ones, ``since`` are the
        tables' states when relationships last held (see quality)."""
        checks: list[Check] = [c for c in warehouse_checks() if models is None or c.model in models]
        tables = {m: self.table(m) for m in {c.model for c in checks} | {c.to_model for c in checks if c.to_model}}
        clean = {m for m in {c.model for c in checks} if (self._state(m) or {"info": {}})["info"].get("row_failures") == 0}
        return run_checks(self.spark, tables, checks, scope, clean, self._orphans(checks, since) if since else None)
