"""Daily rollup (AG-1, AG-2, AG-3) and source-priority unification (ST-1, W-3).

The rollup is a single ``groupBy().agg()``: Spark runs a partial aggregate in
every map task and merges partials after the shuffle, so one entity-day that
holds a third of the rows is reduced map-side before it is shuffled. All
"latest" columns ride in one ``max_by(struct, ts)`` so the argmax is computed
once per group, not once per column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def _decimal_of(df: DataFrame, col: str) -> DecimalType | None:
    t = df.schema[col].dataType
    return t if isinstance(t, DecimalType) else None


def exact_average(total: Column, n: Column, digits: int, kind: DecimalType) -> Column:
    """``total / n`` rounded once, half away from zero, to ``digits``.

    A decimal quotient keeps few digits and so has been rounded before it is
    rounded again; the remainder that the rounded quotient leaves says whether
    that moved it by a step, and in which direction.
    """
    count = n.cast("decimal(12,0)")
    near = F.round(total / n, digits).cast(kind)
    step = F.lit(f"{10 ** -digits:.{digits}f}").cast(f"decimal({digits + 1},{digits})")
    twice = (total - near * count) * 2
    half = step * count
    up = (twice > half) | ((twice == half) & (total >= 0))
    down = (twice < -half) | ((twice == -half) & (total < 0))
    return F.when(up, near + step).when(down, near - step).otherwise(near).cast(kind)


STATE = "_state"


def rollup_state(
    df: DataFrame,
    keys: Sequence[str],
    ts_col: str,
    averages: Mapping[str, tuple[str, int]],
    latest: Mapping[str, str],
) -> DataFrame:
    """Per group what a rollup is finished from, as one struct ``_state``: row count, exact sums and counts, the
    newest row's values and its time. States of disjoint rows merge (``merge_states``)."""
    aggs: list[Column] = [F.count(F.lit(1)).alias("rows")]
    for out, (src, _) in averages.items():
        aggs += [F.sum(src).alias(f"sum_{out}"), F.count(src).alias(f"n_{out}")]
    latest_struct = F.struct(*[F.col(src).alias(out) for out, src in latest.items()])
    aggs += [F.max_by(latest_struct, F.col(ts_col)).alias("latest"), F.max(ts_col).alias("until")]
    rolled = df.groupBy(*keys).agg(*aggs)
    return rolled.select(*keys, F.struct(*[c for c in rolled.columns if c not in keys]).alias(STATE))


def merge_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One state a key from several of disjoint rows; types stay, so that states merge run after run."""
    fields = states.schema[STATE].dataType.fields
    flat = states.select(*keys, f"{STATE}.*")
    merged = flat.groupBy(*keys).agg(*[
        (F.max_by("latest", "until") if f.name == "latest" else F.max("until") if f.name == "until"
         else F.sum(f.name).cast(f.dataType)).alias(f.name) for f in fields])
    return merged.select(*keys, F.struct(*[f.name for f in fields]).alias(STATE))


def finish_rollup(
    states: DataFrame,
    keys: Sequence[str],
    averages: Mapping[str, tuple[DecimalType | None, int]],
    latest: Sequence[str],
    count_col: str = "extract_count",
    synced_col: str = "_synced_at",
    keep_state: bool = False,
) -> DataFrame:
    """The rollup's columns from its state; ``averages`` maps output -> (the input's decimal type or None, digits)."""
    part = lambda name: F.col(f"{STATE}.{name}")

    def average(out: str, kind: DecimalType | None, digits: int) -> Column:
        total, n = part(f"sum_{out}"), part(f"n_{out}")
        if kind is None:
            return F.round(F.when(n > 0, total / n), digits)
        return exact_average(total, n, digits, kind)

    return states.select(
        *keys,
        part("rows").alias(count_col),
        *[average(out, kind, digits).alias(out) for out, (kind, digits) in averages.items()],
        *[part(f"latest.{out}").alias(out) for out in latest],
        part("until").alias(synced_col),
        *([STATE] if keep_state else []),
    )


def daily_rollup(
    df: DataFrame,
    keys: Sequence[str],
    ts_col: str,
    averages: Mapping[str, tuple[str, int]],
    latest: Mapping[str, str],
    count_col: str = "extract_count",
    synced_col: str = "_synced_at",
    keep_state: bool = False,
) -> DataFrame:
    """Per group: row count, rounded averages, latest values by ``ts_col``, max ts.

    ``averages`` maps output -> (input column, digits); an average of a decimal
    is cast back to the input's decimal type so the target schema does not
    drift from run to run. ``latest`` maps output -> input column.
    ``keep_state`` adds what later rows of a group can be merged with.
    """
    kinds = {out: (_decimal_of(df, src), digits) for out, (src, digits) in averages.items()}
    return finish_rollup(rollup_state(df, keys, ts_col, averages, latest), keys, kinds, list(latest),
                         count_col, synced_col, keep_state)


def single_row_daily(
    df: DataFrame,
    keys: Sequence[str],
    ts_col: str,
    averages: Mapping[str, str],
    latest: Mapping[str, str],
    carry: Sequence[str] = (),
    count_col: str = "extract_count",
    synced_col: str = "_synced_at",
) -> DataFrame:
    """AG-3: a feed that already has one row per group -> the same shape.

    Average equals latest and the count is 1 (typed as long like ``count``).
    """
    return df.select(
        *keys,
        *carry,
        F.lit(1).cast("long").alias(count_col),
        *[F.col(src).alias(out) for out, src in averages.items()],
        *[F.col(src).alias(out) for out, src in latest.items()],
        F.col(ts_col).alias(synced_col),
    )


def prioritized_union(
    frames: Sequence[tuple[str, DataFrame]],
    keys: Sequence[str],
    source_col: str = "source_name",
) -> DataFrame:
    """ST-1 + W-3: union feeds, first feed wins per key.

    ``frames`` is ``[(source_name, df), ...]`` in priority order; each frame is
    unique on ``keys``, so a key has at most ``len(frames)`` rows in the union
    and the ``row_number() = 1`` pick per key is skew-free. Both inputs come out
    of their own aggregation/dedup hash-partitioned on ``keys``; the union keeps
    that partitioning, so the pick needs no further shuffle.
    """
    rank = "__tessera_prio"
    out: DataFrame | None = None
    for i, (name, df) in enumerate(frames):
        tagged = df.withColumn(source_col, F.lit(name)).withColumn(rank, F.lit(i))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    assert out is not None
    w = Window.partitionBy(*keys).orderBy(F.col(rank).asc())
    rn = "__tessera_rn"
    return out.withColumn(rn, F.row_number().over(w)).where(F.col(rn) == 1).drop(rn, rank)
