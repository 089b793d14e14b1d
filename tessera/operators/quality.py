"""Data-quality tests that gate a build (DQ-1..6, J-6).

Each test is a failing-row query; the suite returns one row per test with
its failure count. Counting follows the usual conventions of declarative
warehouse tests:

* not_null: rows where the column is NULL;
* unique / unique_combination: key values that occur more than once (NULL
  keys ignored for single-column unique), optionally after a row filter;
* accepted_range (exclusive lower bound): rows with ``NOT (col > min)``;
  NULLs pass;
* accepted_values: distinct non-NULL values outside the list;
* relationships: non-NULL child rows whose key is absent from the parent.

All row tests of one table (not_null, accepted_range, accepted_values) are
folded into a single aggregate pass, or into the write itself: a write counts
the rows that fail any (``failing_rows``), its table's pointer adds up the
counts, and a table whose count is zero is not read for its row tests. A count
above zero, or an unknown one, has the exact failures read from the table.

``scope`` restricts partition-local tests of a model to a partition filter
(the partitions an incremental run touched). A test is partition-local when
its failing rows are decided inside one partition: the row-level tests, and
a unique test whose key determines the row's partition (``partition_local``).
Those tests over untouched partitions cannot change, so when the previous
gate passed, checking the touched partitions decides the whole table.
Relationships read the whole child (a parent may lose keys), or, with the
tables' states of the last passed gate, the child's changed days and what lost
its parent since (``orphans_since``).
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REPORT_SCHEMA = "model string, test string, column_name string, failures long"
ROW_TESTS = ("not_null", "accepted_range", "accepted_values")


@dataclass(frozen=True)
class Check:
    model: str
    test: str  # not_null | unique | unique_combination | accepted_range | accepted_values | relationships
    columns: tuple[str, ...]
    min_value: float | None = None
    values: tuple = ()
    where: str | None = None
    to_model: str | None = None
    to_column: str | None = None
    partition_local: bool = False  # unique key that determines the partition
    options: dict = field(default_factory=dict, compare=False, hash=False)

    @property
    def local(self) -> bool:
        return self.test in ROW_TESTS or self.partition_local

    @property
    def column_name(self) -> str:
        return ",".join(self.columns)


class QualityError(RuntimeError):
    pass


def _failing_count(tables: Mapping[str, DataFrame], c: Check) -> DataFrame:
    """One-row DataFrame ``(failures)`` for a check that is not a row test."""
    df = tables[c.model]
    if c.where:
        df = df.where(c.where)
    if c.test == "unique":
        col = c.columns[0]
        return (df.where(F.col(col).isNotNull()).groupBy(col).count().where(F.col("count") > 1)
                .agg(F.count(F.lit(1)).alias("failures")))
    if c.test == "unique_combination":
        return (df.groupBy(*c.columns).count().where(F.col("count") > 1)
                .agg(F.count(F.lit(1)).alias("failures")))
    if c.test == "relationships":
        # counted by key where they are read: a key crosses the network once a task, and no parent goes to the driver
        child = df.where(F.col(c.columns[0]).isNotNull()).groupBy(F.col(c.columns[0]).alias("__k")).agg(F.count(F.lit(1)).alias("__n"))
        parent = tables[c.to_model].select(F.col(c.to_column).alias("__k")).hint("merge")
        return child.join(parent, "__k", "left_anti").agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("failures"))
    raise ValueError(f"unknown test {c.test!r}")


def _row_test(c: Check) -> Column:
    """The failures of a row test, as one aggregate among others."""
    col = F.col(c.columns[0])
    if c.test == "not_null":
        return F.count_if(col.isNull())
    if c.test == "accepted_range":
        return F.count_if(F.coalesce(~(col > F.lit(c.min_value)), F.lit(False)))
    return F.count_distinct(F.when(~col.isin(list(c.values)), col))


def failing_row(c: Check) -> Column:
    """Whether a row fails a row test: what a write can count while it runs."""
    col = F.col(c.columns[0])
    if c.test == "not_null":
        bad = col.isNull()
    elif c.test == "accepted_range":
        bad = ~(col > F.lit(c.min_value))
    else:
        bad = ~col.isin(list(c.values))
    return F.coalesce(bad & F.expr(c.where) if c.where else bad, F.lit(False))


def failing_rows(model: str) -> Column | None:
    """Whether a row of ``model`` fails any of its declared row tests."""
    tests = [failing_row(c) for c in warehouse_checks() if c.model == model and c.test in ROW_TESTS]
    return reduce(lambda a, b: a | b, tests) if tests else None


def orphans_since(child: DataFrame, changed: DataFrame, column: str, parent: DataFrame, parent_then: DataFrame,
                  parent_column: str) -> DataFrame:
    """DQ-6 / J-6 by what changed since a state without orphans: child rows whose key the parent lacks.

    ``changed`` are the child's rows written since, ``child`` all others. The
    changed ones meet the parent as it is now; the others had their parent, so
    they can only have lost it to keys that left it since.
    """
    keys = lambda df, c: df.where(F.col(c).isNotNull()).select(F.col(c).alias("__k"))
    now = keys(parent, parent_column).hint("merge")
    left = keys(parent_then, parent_column).distinct().join(now, "__k", "left_anti").hint("merge")
    fresh = keys(changed, column).join(now, "__k", "left_anti")
    return fresh.unionByName(keys(child, column).join(left, "__k", "left_semi"))


def _scoped(tables: Mapping[str, DataFrame], scope: Mapping[str, Column], c: Check) -> Mapping[str, DataFrame]:
    if c.model not in scope or not c.local:
        return tables
    return {**tables, c.model: tables[c.model].where(scope[c.model])}


def run_checks(spark: SparkSession, tables: Mapping[str, DataFrame], checks: Sequence[Check],
               scope: Mapping[str, Column] | None = None, clean: Collection[str] = (),
               orphans: Mapping[tuple[str, str], DataFrame] | None = None) -> DataFrame:
    """All checks as one report DataFrame (still lazy; one action runs them).

    ``scope`` maps a model to a partition predicate for its local tests. Row
    tests of ``clean`` models were counted by the writes and found nothing:
    these tables are not read for them again. ``orphans`` has the failing rows
    of relationships, by (model, column), that were found from changes.
    """
    scope = scope or {}
    parts: list[DataFrame] = []
    by_model: dict[tuple, list[Check]] = {}
    counted = [(c.model, c.test, c.column_name, 0) for c in checks if c.test in ROW_TESTS and c.model in clean]
    if counted:
        parts.append(spark.createDataFrame(counted, REPORT_SCHEMA))
    for c in checks:
        if c.test in ROW_TESTS and c.model not in clean:
            by_model.setdefault((c.model, c.where), []).append(c)
    for (model, where), cs in by_model.items():
        rows = _scoped(tables, scope, cs[0])[model]
        agg = (rows.where(where) if where else rows).agg(*[_row_test(c).alias(f"c{i}") for i, c in enumerate(cs)])
        stack = ", ".join(f"'{c.test}', '{c.column_name}', c{i}" for i, c in enumerate(cs))
        parts.append(agg.selectExpr(f"'{model}' AS model",
                                    f"stack({len(cs)}, {stack}) AS (test, column_name, failures)"))
    for c in checks:
        if c.test in ROW_TESTS:
            continue
        found = (orphans or {}).get((c.model, c.column_name)) if c.test == "relationships" else None
        counted_ = _failing_count(_scoped(tables, scope, c), c) if found is None else found.agg(F.count(F.lit(1)).alias("failures"))
        parts.append(counted_.select(
            F.lit(c.model).alias("model"), F.lit(c.test).alias("test"),
            F.lit(c.column_name).alias("column_name"), F.col("failures").cast("long").alias("failures")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("model", "test", "column_name", F.col("failures").cast("long").alias("failures"))


def gate(report: DataFrame) -> list:
    """Raise ``QualityError`` listing failed tests; the report is tiny (one row per test)."""
    failed = [r for r in report.where(F.col("failures") > 0).collect()]
    if failed:
        raise QualityError("; ".join(f"{r.model}.{r.test}({r.column_name})={r.failures}" for r in failed))
    return failed


# The declared tests of the warehouse, model by model.
def warehouse_checks(stg_snap="stg_snapshot", stg_hist="stg_history", daily="int_daily", dim="dim_coin",
                     cal="dim_date", fsnap="fct_market_snapshot", fdaily="fct_daily_market") -> list[Check]:
    nn = lambda m, *cols: [Check(m, "not_null", (c,)) for c in cols]
    return [
        *nn(stg_snap, "coin_id", "fetched_at", "price_usd"),
        Check(stg_snap, "accepted_range", ("price_usd",), min_value=0),
        Check(stg_snap, "unique_combination", ("coin_id", "fetched_at"), partition_local=True),
        *nn(stg_hist, "coin_id", "price_date", "price_usd"),
        Check(stg_hist, "accepted_range", ("price_usd",), min_value=0),
        Check(stg_hist, "unique_combination", ("coin_id", "price_date"), partition_local=True),
        *nn(daily, "coin_id", "price_date", "extract_count", "avg_price_usd", "latest_price_usd"),
        Check(daily, "unique_combination", ("coin_id", "price_date"), partition_local=True),
        *nn(dim, "coin_sk"),
        Check(dim, "unique", ("coin_sk",)),
        *nn(dim, "coin_id"),
        Check(dim, "accepted_values", ("asset_type",), values=("coin", "stablecoin")),
        *nn(dim, "is_current"),
        Check(dim, "unique_combination", ("coin_id", "is_current"), where="is_current = true"),
        *nn(cal, "date_sk"),
        Check(cal, "unique", ("date_sk",)),
        *nn(cal, "date_day"),
        Check(cal, "unique", ("date_day",)),
        *nn(fsnap, "snapshot_sk"),
        Check(fsnap, "unique", ("snapshot_sk",), partition_local=True),
        *nn(fsnap, "coin_sk"),
        Check(fsnap, "relationships", ("coin_sk",), to_model=dim, to_column="coin_sk"),
        *nn(fsnap, "date_sk"),
        Check(fsnap, "relationships", ("date_sk",), to_model=cal, to_column="date_sk"),
        *nn(fdaily, "daily_market_sk"),
        Check(fdaily, "unique", ("daily_market_sk",), partition_local=True),
        *nn(fdaily, "coin_sk"),
        Check(fdaily, "relationships", ("coin_sk",), to_model=dim, to_column="coin_sk"),
        *nn(fdaily, "date_sk"),
        Check(fdaily, "relationships", ("date_sk",), to_model=cal, to_column="date_sk"),
    ]
