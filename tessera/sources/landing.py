"""Landing-zone sources and sinks (SRC-1..6, SNK-1..7).

Feeds land as JSON or CSV documents; these functions turn them into typed,
append-only landing tables. Everything is a DataFrame read or write: the API
client that fetched the documents is outside Spark and not rebuilt here.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.scalar import epoch_ms_to_utc_day, ntz_lit

# The market-object fields the snapshot feed keeps, in landing
# order, and the one field renamed on the way in.
MARKET_FIELDS = [
    "id", "symbol", "name", "current_price", "market_cap", "total_volume",
    "price_change_24h", "price_change_percentage_24h", "high_24h", "low_24h",
    "circulating_supply", "ath",
]
RENAMED = {"price_change_percentage_24h": "price_change_pct_24h"}
MANDATORY = ["id", "symbol", "name"]
ROUND_DIGITS = 5

MARKET_OBJECT = T.StructType(
    [T.StructField(f, T.StringType()) for f in MANDATORY]
    + [T.StructField(f, T.DoubleType()) for f in MARKET_FIELDS[3:]]
)

SNAPSHOT_LANDING = T.StructType(
    [T.StructField(f, T.StringType()) for f in MANDATORY]
    + [T.StructField(RENAMED.get(f, f), T.DoubleType()) for f in MARKET_FIELDS[3:]]
    + [T.StructField("fetched_at", T.TimestampNTZType()), T.StructField("_loaded_at", T.TimestampNTZType())]
)

HISTORY_LANDING = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("price_date", T.DateType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("market_cap", T.DoubleType()),
    T.StructField("total_volume", T.DoubleType()),
    T.StructField("fetched_at", T.TimestampNTZType()),
    T.StructField("_loaded_at", T.TimestampNTZType()),
])

SERIES_PAYLOAD = "prices ARRAY<ARRAY<DOUBLE>>, market_caps ARRAY<ARRAY<DOUBLE>>, total_volumes ARRAY<ARRAY<DOUBLE>>"
SERIES = ["prices", "market_caps", "total_volumes"]
SERIES_OUT = {"prices": "price", "market_caps": "market_cap", "total_volumes": "total_volume"}


# ---------------------------------------------------------------- SRC-1 / SRC-2

def market_rows(objects: DataFrame, fetched_at: Column, digits: int = ROUND_DIGITS) -> DataFrame:
    """Market objects (one row each) -> landing rows: rename, round, stamp.

    Every object is kept; absent fields are NULL (see ``payload_rejects``).
    """
    cols = [F.col(f) for f in MANDATORY]
    cols += [F.round(F.col(f), digits).alias(RENAMED.get(f, f)) for f in MARKET_FIELDS[3:]]
    return objects.select(*cols, fetched_at.alias("fetched_at"))


def read_market_json(spark: SparkSession, path: str, fetched_at: dt.datetime) -> DataFrame:
    """SRC-1 from files: each file is a JSON array of market objects; a malformed file fails the read."""
    objs = spark.read.schema(MARKET_OBJECT).option("multiLine", True).option("mode", "FAILFAST").json(path)
    return market_rows(objs, ntz_lit(fetched_at))


def flatten_market_payload(df: DataFrame, payload_col: str, fetched_at: Column) -> DataFrame:
    """SRC-1 from a string column holding one JSON array per row.

    A document that does not parse, or whose values have other types, fails
    the query; ``payload_rejects`` tells such rows apart beforehand.
    """
    arr = F.from_json(F.col(payload_col), T.ArrayType(MARKET_OBJECT), {"mode": "FAILFAST"})
    objs = df.select(fetched_at.alias("__fetched_at"), F.inline(arr))
    return market_rows(objs, F.col("__fetched_at"))


def payload_rejects(df: DataFrame, payload_col: str) -> DataFrame:
    """The rows of ``df`` whose payload ``flatten_market_payload`` cannot take whole, with a ``reason``.

    ``malformed``: not a JSON array of objects with the declared types;
    ``missing_id``: an object without an id.
    """
    arr = F.from_json(F.col(payload_col), T.ArrayType(MARKET_OBJECT), {"mode": "PERMISSIVE"})
    typed = F.to_json(arr)
    # a value of another type parses to NULL, which the text form then lacks
    loose = F.from_json(F.col(payload_col), T.ArrayType(T.MapType(T.StringType(), T.StringType())))
    numbers = F.aggregate(loose, F.lit(0), lambda n, o: n + F.size(F.map_filter(
        o, lambda k, v: k.isin(MARKET_FIELDS[3:]) & v.isNotNull())))
    kept = F.aggregate(arr, F.lit(0), lambda n, o: n + sum(
        (F.when(o[f].isNotNull(), 1).otherwise(0) for f in MARKET_FIELDS[3:]), F.lit(0)))
    bad = arr.isNull() | loose.isNull() | F.exists(arr, lambda o: o.isNull()) | (numbers != kept) | typed.isNull()
    reason = (F.when(F.col(payload_col).isNotNull() & F.coalesce(bad, F.lit(True)), F.lit("malformed"))
              .when(F.exists(arr, lambda o: o["id"].isNull()), F.lit("missing_id")))
    return df.withColumn("reason", reason).where(F.col("reason").isNotNull())


def flatten_json_column(df: DataFrame, col: str, schema_ddl: str, required: Sequence[str] = (),
                        prefix: str = "") -> DataFrame:
    """Typed columns out of a JSON object column; absent fields become NULL,
    rows whose ``required`` fields are NULL are dropped; text that does not
    parse fails the query."""
    parsed = df.withColumn("__j", F.from_json(F.col(col), schema_ddl, {"mode": "FAILFAST"}))
    fields = T.StructType.fromDDL(schema_ddl).fieldNames()
    out = parsed.select("*", *[F.col(f"__j.`{f}`").alias(prefix + f) for f in fields]).drop("__j")
    for r in required:
        out = out.where(F.col(prefix + r).isNotNull())
    return out


def nested_series_daily(docs: DataFrame, id_cols: Sequence[str], payload_col: str,
                        digits: int = ROUND_DIGITS) -> DataFrame:
    """SRC-2: ``{prices, market_caps, total_volumes}`` of ``[epoch_ms, value]`` ->
    one row per (document, UTC day) that has a price point.

    Per series and day the point at the highest array position wins (even if
    its value is NULL). All three series are exploded in one pass and folded
    by a single aggregation with per-series ``max_by``; the cap/volume of a
    day without a price are dropped, a price day without them gets NULL.
    """
    p = F.from_json(F.col(payload_col), SERIES_PAYLOAD, {"mode": "FAILFAST"})

    def tag(idx: int):
        return lambda pt, i: F.struct(F.lit(idx).alias("s"), i.alias("pos"), pt[0].alias("ms"), pt[1].alias("v"))

    tagged = [F.transform(F.coalesce(p[s], F.array()), tag(n)) for n, s in enumerate(SERIES)]
    pts = docs.select(*id_cols, F.explode(F.concat(*tagged)).alias("pt")).where(F.col("pt.ms").isNotNull())
    pts = pts.select(*id_cols, epoch_ms_to_utc_day(F.col("pt.ms")).alias("price_date"),
                     F.col("pt.s").alias("s"), F.col("pt.pos").alias("pos"), F.col("pt.v").alias("v"))
    aggs = []
    for i, s in enumerate(SERIES):
        mine = F.col("s") == i
        aggs.append(F.round(F.max_by(F.when(mine, F.col("v")), F.when(mine, F.col("pos"))), digits)
                    .alias(SERIES_OUT[s]))
    aggs.append(F.max(F.when(F.col("s") == 0, F.lit(True))).alias("__has_price"))
    daily = pts.groupBy(*id_cols, "price_date").agg(*aggs)
    return daily.where(F.col("__has_price")).drop("__has_price")


# ---------------------------------------------------------------- SRC-3..6

# Fixed value: text form of wall-clock timestamps in text landings (microseconds kept).
TS_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_landing(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """SRC-3: read a landing folder with a declared schema (no inference).

    CSV columns are matched by *header name* (Spark's CSV reader would apply a
    schema by position); a declared field missing from the header reads as
    NULL. All files of a folder must have the same header: a file with other
    columns, or in another order, fails the read.
    """
    if fmt == "csv":
        header = spark.read.option("header", True).option("inferSchema", False).csv(path).schema
        raw = (spark.read.schema(header).option("header", True).option("enforceSchema", False)
               .option("mode", "FAILFAST").csv(path))
        have = set(raw.columns)
        return raw.select(*[
            (F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ])
    r = spark.read.schema(schema)
    if fmt == "json":
        r = r.option("timestampNTZFormat", TS_TEXT).option("mode", "FAILFAST")
    return r.format(fmt).load(path)


def parse_id_list(text: str, cast: Callable = str) -> list:
    """SRC-4: comma list -> ids, trimmed, blanks dropped (a config parameter)."""
    return [cast(p.strip()) for p in text.split(",") if p.strip()]


def restrict_to_ids(df: DataFrame, col: str, ids: Sequence) -> DataFrame:
    """SRC-4: keep rows whose ``col`` is in ``ids``, columns as they were.

    A semi-join with the list, however long it is; Spark broadcasts it or not
    by its size.
    """
    kind = df.schema[col].dataType.simpleString()
    id_df = df.sparkSession.createDataFrame([(i,) for i in set(ids)], f"`__id` {kind}")
    return df.join(id_df, F.col(col) == F.col("__id"), "left_semi")


def top_n(df: DataFrame, order: Sequence[Column], n: int, rank_col: str | None = None) -> DataFrame:
    """SRC-5: the first ``n`` rows under ``order`` (a top-k: each task keeps
    its own k, then one merge of k x tasks rows)."""
    top = df.orderBy(*order).limit(n)
    if rank_col:
        top = top.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)))
    return top


def _to_utc_naive(text: str) -> dt.datetime:
    t = dt.datetime.fromisoformat(text.replace("Z", "+00:00"))
    if t.tzinfo is not None:
        t = t.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return t


def time_range(df: DataFrame, ts_col: str, start_iso: str, end_iso: str) -> DataFrame:
    """SRC-6: ``start <= ts <= end``; ISO bounds (date or instant with offset)
    are normalised to UTC wall time and pushed to the scan as literals."""
    lo, hi = _to_utc_naive(start_iso), _to_utc_naive(end_iso)
    return df.where(F.col(ts_col).between(ntz_lit(lo), ntz_lit(hi)))


def epoch_seconds(text: str) -> int:
    """SRC-6: ISO date/instant -> epoch seconds (the extract window's bounds)."""
    return int(_to_utc_naive(text).replace(tzinfo=dt.timezone.utc).timestamp())


# ---------------------------------------------------------------- sinks

def with_load_stamp(df: DataFrame, loaded_at: dt.datetime, col: str = "_loaded_at") -> DataFrame:
    """SNK-5: stamp the batch's load time (a parameter, so replays repeat)."""
    return df.withColumn(col, ntz_lit(loaded_at))


def stamped(path: str, fetched_at: dt.datetime) -> str:
    """A folder of its own for one fetch, named by its time."""
    return f"{path.rstrip('/')}/{fetched_at:%Y%m%dT%H%M%S}"


def write_csv(df: DataFrame, path: str, sort_by: Sequence[str] = (), fetched_at: dt.datetime | None = None) -> None:
    """SNK-1: CSV with header, in a folder of its fetch time if given; SO-2 sorts rows within each output file."""
    out = df.sortWithinPartitions(*sort_by) if sort_by else df
    target = stamped(path, fetched_at) if fetched_at else path
    out.write.mode("append").option("header", True).option("timestampNTZFormat", TS_TEXT).csv(target)


def write_raw_json(df: DataFrame, path: str, fetched_at: dt.datetime | None = None) -> None:
    """SNK-2: raw documents kept whole (every field, NULL ones too, no rounding)."""
    target = stamped(path, fetched_at) if fetched_at else path
    (df.write.mode("append").option("timestampNTZFormat", TS_TEXT).option("ignoreNullFields", False).json(target))


def write_raw_variant(df: DataFrame, payload_col: str, path: str, partition_by: Sequence[str] = ()) -> None:
    """SNK-2 as VARIANT: each document is parsed once and kept whole, fields of any name and type with it.

    Text that is no JSON document is kept beside it (``<payload_col>_text``);
    ``payload_col`` is NULL then.
    """
    parsed = F.try_parse_json(F.col(payload_col))
    out = df.withColumns({payload_col: parsed, f"{payload_col}_text": F.when(parsed.isNull(), F.col(payload_col))})
    append_landing(out, path, partition_by)


def variant_columns(df: DataFrame, payload_col: str, fields: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Typed columns out of a VARIANT: name -> (path, type). A field that is absent, or of another type, is NULL."""
    return df.withColumns({name: F.try_variant_get(payload_col, path, kind) for name, (path, kind) in fields.items()})


def market_variants(df: DataFrame, payload_col: str, fetched_at: Column) -> DataFrame:
    """SRC-1 from VARIANT arrays of market objects, so that documents landed under one schema are read under a later one."""
    objects = df.select(F.explode(F.try_variant_get(payload_col, "$", "array<variant>")).alias("__o"), fetched_at.alias("__f"))
    kinds = {f.name: f.dataType.simpleString() for f in MARKET_OBJECT.fields}
    typed = variant_columns(objects, "__o", {n: (f"$.{n}", k) for n, k in kinds.items()})
    return market_rows(typed, F.col("__f"))


def append_landing(df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> None:
    """SNK-3/SNK-4: append one batch to an append-only landing folder; SO-2 sorts rows within each output file."""
    # a file holds one partition folder's rows of one task, so these lead the sort
    w = (df.sortWithinPartitions(*partition_by, *sort_by) if sort_by else df).write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def create_table_if_not_exists(spark: SparkSession, name: str, schema: T.StructType, location: str,
                               partition_by: Sequence[str] = ()) -> None:
    """SNK-7: idempotent table creation over a Parquet location."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    part = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{part} LOCATION '{location}'")
