"""Incremental maintenance of day-partitioned Parquet tables (SK-1, SK-6, SK-7, AG-8).

Parquet has no MERGE, so a table is a set of partition folders and a pointer:

    <table>/versions/table_version=<id>/<day>=<value>/part-*.parquet    written once, never changed
    <table>/pointer/<number>.json                           which folder holds each day, schema, marks

A write puts the new contents of the days it touches into a version folder of
its own and then adds the next pointer file with one rename. Readers follow the
newest pointer, so a write that dies earlier leaves the table as it was, and no
step needs repeating. Rows are clustered by day (a rebalance that AQE sizes by
bytes), so the number of files of a day follows its size, not the task count.

Pointers also say which days changed between two states of a table, which is
how a model finds what an input has changed since it was last built.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.dedup import latest_per_key
from tessera.session import delete_path, scratch_dir, scratch_root

#: The folder name of a NULL day.
NULL_DAY = "__HIVE_DEFAULT_PARTITION__"


class DuplicateKeyError(ValueError):
    pass


class ConcurrentWriteError(RuntimeError):
    pass


# ---------------------------------------------------------------- pointer

def _fs(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, hpath = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath)) if fs.exists(hpath) else []


def state(spark: SparkSession, path: str, number: int | None = None) -> dict | None:
    """The table's newest pointer (or the one of ``number``), ``None`` if it was never written."""
    names = [n for n in _children(spark, f"{path}/pointer") if n.endswith(".json") and not n.startswith(".")]
    if number is not None:
        names = [n for n in names if int(n[:-5]) == number]
    if not names:
        return None
    fs, hpath = _fs(spark, f"{path}/pointer/{names[-1]}")
    stream = fs.open(hpath)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def commit(spark: SparkSession, path: str, content: Mapping, after: dict | None) -> dict:
    """Add the pointer that follows ``after``; fails if another writer was first."""
    content = {**content, "number": (after["number"] if after else 0) + 1}
    fs, final = _fs(spark, f"{path}/pointer/{content['number']:010d}.json")
    _, draft = _fs(spark, f"{path}/pointer/.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(content).encode("utf-8")))
    out.close()
    if fs.exists(final) or not fs.rename(draft, final):
        raise ConcurrentWriteError(f"{path} was written by someone else since it was read")
    return content


# ---------------------------------------------------------------- reading

def read_table(spark: SparkSession, path: str, at: dict | None = None) -> DataFrame | None:
    """The table as its newest pointer (or ``at``) has it, ``None`` if it was never written.

    The schema is the pointer's (SK-6, ``sync_all_columns``), for every reader:
    a column that older files lack reads as NULL, one no longer in the schema
    is not read.
    """
    at = at or state(spark, path)
    if at is None:
        return None
    schema = T.StructType.fromJson(json.loads(at["schema"]))
    if not at["parts"]:
        return spark.createDataFrame([], schema)
    col = at["partition_col"]
    reader = spark.read.schema(schema)
    if col is None:
        return reader.parquet(*[f"{path}/versions/table_version={v}" for v in at["parts"].values()])
    folders = [f"{path}/versions/table_version={v}/{d}" for d, v in sorted(at["parts"].items())]
    return reader.option("basePath", f"{path}/versions").parquet(*folders).select(*schema.names)


def days_of(at: dict | None) -> list[str]:
    """The days (text) that a table has rows of, without the NULL day; from the pointer, no job."""
    if at is None or not at["partition_col"]:
        return []
    return sorted(unquote(d.split("=", 1)[1]) for d in at["parts"] if not d.endswith(f"={NULL_DAY}"))


def changed_days(spark: SparkSession, path: str, since: int | None) -> list[str | None]:
    """Days whose rows were written or removed after pointer ``since`` (all days if ``None``); None is the NULL day."""
    now = state(spark, path)
    if now is None:
        return []
    before = (state(spark, path, since) or {"parts": {}})["parts"] if since is not None else {}
    folders = [d for d in {*now["parts"], *before} if now["parts"].get(d) != before.get(d)]
    days = [unquote(d.split("=", 1)[1]) for d in sorted(folders)]
    return [None if d == NULL_DAY else d for d in days]


def in_days(df: DataFrame, col: str, days: Sequence[str | None]) -> DataFrame:
    """Rows of the given days; reaches the scan as a partition filter."""
    kind = df.schema[col].dataType
    known = [F.lit(d).cast(kind) for d in days if d is not None]
    hit = F.col(col).isin(known) if known else F.lit(False)
    return df.where(hit | F.col(col).isNull() if None in days else hit)


def high_water_mark(target: DataFrame | None, col: str):
    """AG-8: ``max(col)`` of the target (one bounded scalar), ``None`` if empty."""
    return None if target is None else target.agg(F.max(col)).first()[0]


def mark_of(spark: SparkSession, path: str, col: str):
    """AG-8 from the pointer, kept by the writes (no job); read from the rows if it was not kept."""
    at = state(spark, path)
    if at is None:
        return None
    if col in at["marks"]:
        text = at["marks"][col]
        return None if text is None else dt.datetime.fromisoformat(text)
    return high_water_mark(read_table(spark, path, at), col)


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """SK-6: select ``schema``'s columns in order; absent ones become typed NULLs."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def column(f: T.StructField):
        kind = f.dataType.simpleString()  # without nullability, which no cast can add inside a struct
        return F.col(f.name) if have.get(f.name) == kind else (F.col(f.name) if f.name in have else F.lit(None)).cast(kind)

    return df.select(*[column(f).alias(f.name) for f in schema.fields])


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Fail when the delta holds a key twice (one small job over the delta)."""
    dup = df.groupBy(*keys).count().where(F.col("count") > 1).limit(1).count()
    if dup:
        raise DuplicateKeyError(f"delta is not unique on {list(keys)}")


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` computed once: written to the scratch folder and read back."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def expire(spark: SparkSession, path: str, keep: int = 20) -> list[str]:
    """Delete all but the newest ``keep`` pointers, and the versions that only the deleted ones name; these versions.

    Readers of a state that old, and models that were last built from it, must
    be done. Folders that no pointer ever named (of a write that is under way,
    or that died) are left alone.
    """
    if keep < 1:
        raise ValueError("the newest state of a table must be kept")
    names = [n for n in _children(spark, f"{path}/pointer") if n.endswith(".json") and not n.startswith(".")]
    of = lambda part: {v for n in part for v in state(spark, path, int(n[:-5]))["parts"].values()}
    old = names[:-keep]
    dead = sorted(of(old) - of(names[-keep:]))
    for n in old:  # the names go first, so that no pointer is left without its files
        delete_path(spark, f"{path}/pointer/{n}", path)
    for version in dead:
        delete_path(spark, f"{path}/versions/table_version={version}", path)
    return dead


# ---------------------------------------------------------------- writing

def _observed(df: DataFrame, marks: Sequence[str], failing: Column | None, more: Sequence[Column] = ()
              ) -> tuple[DataFrame, Observation | None]:
    """``df`` whose write also tells its marks and how many rows fail their tests."""
    metrics = [*[F.max(c).alias(c) for c in marks], *more]
    if failing is not None:
        metrics.append(F.count_if(failing).alias("__failing"))
    if not metrics:
        return df, None
    seen = Observation()
    return df.observe(seen, *metrics), seen


def _row_failures(before: Mapping | None, got: Mapping) -> dict:
    """Rows of the table that fail their tests, at most; unknown after a write that was not tested."""
    known = 0 if before is None else before["info"].get("row_failures")
    return {"row_failures": None if known is None or "__failing" not in got else known + (got["__failing"] or 0)}


def _write(spark: SparkSession, df: DataFrame, path: str, partition_col: str | None) -> tuple[str, list[str]]:
    """Write ``df`` to a new version folder; its id and the partition folders in it."""
    version = f"t{uuid.uuid4().hex[:16]}"
    folder = f"{path}/versions/table_version={version}"
    if partition_col is None:
        df.write.parquet(folder)
        return version, [""]
    df.hint("rebalance", partition_col).write.partitionBy(partition_col).parquet(folder)
    return version, [n for n in _children(spark, folder) if n.startswith(f"{partition_col}=")]


def _ordered(schema: T.StructType, partition_col: str | None) -> T.StructType:
    """Columns in the order a table is read back: partition column last."""
    if not partition_col:
        return schema
    return T.StructType([f for f in schema.fields if f.name != partition_col] + [schema[partition_col]])


def _content(df_schema: T.StructType, partition_col: str | None, parts: dict, marks: dict, info: dict) -> dict:
    return {"partition_col": partition_col, "schema": _ordered(df_schema, partition_col).json(), "parts": parts,
            "marks": marks, "info": info}


def _text(mark) -> str | None:
    return None if mark is None else mark.isoformat()


def replace(spark: SparkSession, df: DataFrame, path: str, partition_col: str | None = None,
            marks: Sequence[str] = (), info: Mapping | None = None, failing: Column | None = None) -> dict:
    """SNK-6 / SK-7: full replace; ``df`` may read the table itself. Returns the new pointer.

    ``failing`` says which rows fail their tests: the write counts them (DQ-1,
    4, 5), and the pointer keeps the count.
    """
    before = state(spark, path)
    watched, seen = _observed(df, marks, failing)
    version, folders = _write(spark, watched, path, partition_col)
    got = seen.get if seen else {}
    return commit(spark, path, _content(df.schema, partition_col, {d: version for d in folders},
                                        {c: _text(got.get(c)) for c in marks}, {**(info or {}), **_row_failures(None, got)}), before)


def replace_days(spark: SparkSession, df: DataFrame, path: str, partition_col: str, days: Sequence[str | None],
                 info: Mapping | None = None, failing: Column | None = None) -> dict:
    """Replace the given days by ``df``, which holds all their rows and no others; the new pointer."""
    before = state(spark, path)
    if before is None or not before["partition_col"]:
        return replace(spark, df, path, partition_col, info=info, failing=failing)
    watched, seen = _observed(df, (), failing)
    version, folders = _write(spark, watched, path, partition_col)
    touched = {f"{partition_col}={d}" if d is not None else f"{partition_col}={NULL_DAY}" for d in days}
    parts = {d: v for d, v in before["parts"].items() if d not in touched} | {d: version for d in folders}
    return commit(spark, path, _content(df.schema, partition_col, parts, before["marks"],
                                        {**before["info"], **(info or {}), **_row_failures(before, seen.get if seen else {})}), before)


def _day_set(partition_col: str) -> list:
    """The touched days as metrics of the write itself: a bounded list, and whether the NULL day is among them."""
    day = F.col(partition_col)
    return [F.collect_set(day.cast("string")).alias("__days"), F.max(day.isNull()).alias("__no_day")]


def _known_days(at: Mapping | None, partition_col: str, days: Sequence[str | None]) -> list[str | None]:
    """Those of ``days`` that a table can have rows of, as its pointer says."""
    if at is None or at["partition_col"] != partition_col:
        return list(days) if at else []
    there = {*days_of(at), *([None] if f"{partition_col}={NULL_DAY}" in at["parts"] else [])}
    return [d for d in days if d in there]


def upsert(spark: SparkSession, delta: DataFrame, path: str, keys: Sequence[str], partition_col: str,
           check_unique: bool = True, newest_by: Sequence[str] = (), marks: Sequence[str] = (),
           info: Mapping | None = None, keep_delta: bool = False, whole_days: Sequence[str | None] = (),
           failing: Column | None = None) -> dict:
    """SK-1: insert-or-replace ``delta`` rows by ``keys`` into the table.

    The delta is computed once; its distinct days (a bounded list) are the
    touched partitions. Every unique key contains (or hashes) its day, so a key
    lives in one partition: the rows of those days minus the delta's keys, plus
    the delta, become a new version. A delta of days that the table has no rows
    of is that version as it was written, and meets no older row. Keys meet by
    a shuffle: there are as many as new rows, too many for the driver. With
    ``newest_by`` the newer of the old and the new row of a key stays, so
    batches may come in any order. The table's schema becomes the delta's
    (columns added/dropped, SK-6). ``check_unique=False`` is for deltas unique
    by construction; the quality suite still tests the table. Of ``whole_days``
    the delta has all rows: others of them go. ``failing`` as in ``replace``;
    rows that stay were counted when they were written. With ``keep_delta`` the delta is written to the scratch folder
    and returned for models that go on from the new rows; the caller deletes it.
    """
    version = None
    if keep_delta:
        staging = scratch_dir(spark, "upsert-delta")
        watched, seen = _observed(delta, marks, failing, _day_set(partition_col))
        watched.write.parquet(staging)
        got = seen.get
        written = [*got["__days"], *([None] if got["__no_day"] else [])]
    else:
        watched, seen = _observed(delta, marks, failing)
        version, folders = _write(spark, watched, path, partition_col)
        staging = f"{path}/versions/table_version={version}"
        got = seen.get if seen and folders else {"__failing": 0} if failing is not None else {}  # no rows, no metrics
        written = [None if d == f"{partition_col}={NULL_DAY}" else unquote(d.split("=", 1)[1]) for d in folders]
    staged = spark.read.schema(delta.schema).parquet(staging).select(*delta.columns)
    days = sorted({d for d in (*written, *whole_days) if d is not None}) + [None] * (None in written or None in whole_days)
    before = state(spark, path)
    if check_unique:
        assert_unique(staged, keys)
    spare = not keep_delta
    if days or before is None:
        merged = staged
        others = _known_days(before, partition_col, [d for d in days if d not in whole_days])
        if others:
            existing = align(in_days(read_table(spark, path, before), partition_col, others), delta.schema)
            if newest_by:
                merged = latest_per_key(existing.unionByName(staged), list(keys), list(newest_by))
            else:
                merged = existing.join(staged.select(*keys).hint("merge"), list(keys), "left_anti").unionByName(staged)
        if others or version is None:
            version, folders = _write(spark, merged, path, partition_col)
        else:
            spare = False
        emptied = {f"{partition_col}={NULL_DAY if d is None else d}" for d in whole_days}
        kept_parts = {d: v for d, v in before["parts"].items() if d not in emptied} if before else {}
        parts = {**kept_parts, **{d: version for d in folders}}
        old = before or {"marks": {}, "info": {}}
        marked = {c: max(filter(None, [old["marks"].get(c), _text(got.get(c))]), default=None) for c in marks}
        commit(spark, path, _content(delta.schema, partition_col, parts, {**old["marks"], **marked},
                                     {**old["info"], **(info or {}), **_row_failures(before, got)}), before)
    elif info:
        commit(spark, path, {**before, "info": {**before["info"], **info}}, before)
    stats = {"touched_partitions": len(days), "partitions": days}
    if keep_delta:
        return {**stats, "delta": staged, "staging": staging}
    if spare:
        delete_path(spark, staging, path)
    return stats
