"""Shared helpers: session preparation, Arrow text buffers, hashing, ordered buckets, shared files."""

from __future__ import annotations

import ctypes
import os
import posixpath
import uuid
from collections.abc import Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_dir

REPO_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
#: Rows per Arrow batch handed to Python: texts of a few KB each give batches of a few MB.
BATCH_ROWS = 1000
#: Rows that numpy code handles at once: its arrays take up to a hundred bytes a character.
ROWS_AT_ONCE = 250
#: Bytes of one such batch, so that long texts come in fewer rows.
BATCH_BYTES = 8 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Small Arrow batches (texts are long) and this package on the Python workers' path."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.sparkContext.environment.setdefault("PYTHONPATH", REPO_ROOT)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, purpose: str, path: str | None = None, codec: str = "snappy") -> DataFrame:
    """Write ``df`` to a new table under the shared checkpoint folder and read it back.

    Cuts the lineage at a copy that survives lost executors, and keeps costly
    Python stages from running once per consumer. A caller that names the
    ``path`` may delete it when nothing reads it any more.
    """
    spark = df.sparkSession
    path = path or scratch_dir(spark, purpose)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def n_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# --- text buffers -----------------------------------------------------------------------------


def utf8(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a string column, end to end, and the n+1 byte offsets (null: empty)."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = arr.cast(pa.large_string()).fill_null("")
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset: arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def code_points(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points (uint32) of all texts of a string column, end to end, and the n+1 offsets."""
    data, offsets = utf8(arr)
    first = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    return points, first[offsets]


# --- hashing ----------------------------------------------------------------------------------

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)  # fixed values: 64-bit mixer
_ODD = np.uint64(0x9E3779B97F4A7C15)  # fixed value: odd multiplier
_ODD_INV = np.uint64(pow(int(_ODD), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of uint64 arrays."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def join_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of the pair (a, b) of uint64 arrays; order matters."""
    x = a * _ODD + b
    x ^= x >> np.uint64(29)
    x *= _M1
    x ^= x >> np.uint64(32)
    return x


def powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] (uint64) for each span, from one running sum.

    sum(v[j] * B**-j) over a span, times B**start, depends on the span's values
    only; B is odd, so its inverse modulo 2**64 exists.
    """
    n = len(values)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(n, _ODD_INV), out=total[1:])
    h = (total[ends] - total[starts]) * powers(n + 1, _ODD)[starts]
    return mix(h + (ends - starts).astype(np.uint64))


_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32


def word_spans(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words (runs of bytes of ``kind``), and the n+1 word offsets of the texts."""
    word = kind[data]
    starts = word.copy()
    starts[1:] &= ~word[:-1]
    cut = offsets[1:-1][offsets[1:-1] < len(data)]
    starts[cut] = word[cut]  # a text's first byte starts a word even after a word
    ends = np.zeros(len(data) + 1, bool)
    ends[1:] = word
    ends[1:-1] &= ~word[1:]
    ends[cut] = np.where(cut > 0, word[cut - 1], False)
    s, e = np.flatnonzero(starts), np.flatnonzero(ends)
    return s, e, np.searchsorted(s, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word's bytes, A-Z lower-cased."""
    out = []
    step = 1 << 15
    for i in range(0, len(starts), step):  # a part at a time, for the cache
        s, e = starts[i: i + step], ends[i: i + step]
        out.append(span_hashes(_LOWER[data[s[0]: e[-1]]] + np.uint64(1), s - s[0], e - s[0]))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


# --- order ------------------------------------------------------------------------------------


#: Sampled rows a bucket from which the bounds of buckets are taken, and bytes of a text that tell rows of one id apart.
SAMPLES_A_BUCKET, PREFIX = 128, 64


def _order_key(ids: np.ndarray, known: np.ndarray, prefixes: np.ndarray) -> np.ndarray:
    out = np.empty(len(ids), [("known", "?"), ("id", "i8"), ("prefix", f"S{PREFIX}")])
    out["known"], out["id"], out["prefix"] = known, ids, prefixes
    return out


def _places(bounds: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many of the sorted ``bounds`` lie below each key, and how many are equal to it."""
    _, ranks = np.unique(np.concatenate([bounds, keys]), return_inverse=True)
    ranks = ranks.ravel()
    of, mine = ranks[: len(bounds)], ranks[len(bounds):]
    below = np.searchsorted(of, mine, "left")
    return below, np.searchsorted(of, mine, "right") - below


def ordered_buckets(df: DataFrame, key: str, text: str, n: int) -> Column:
    """An int column: the bucket (0..n-1) of each row, ascending with the integer ``key`` (nulls first), then ``text``.

    Bounds are quantiles of (key, first bytes of the text) over a bounded
    sample of rows, each weighted by its bytes, so buckets hold about equal
    text however the keys lie, and rows of one key may span buckets. Rows that
    agree in key and first bytes and are too many for one bucket are dealt to
    all that lie between the same bounds: among these alone texts are not in
    order. The sample sets the load of a bucket, never the order or the rows.
    """
    id_ = F.coalesce(F.col(key).cast("long"), F.lit(0))
    known = F.col(key).isNotNull()
    prefix = F.substring(F.coalesce(F.col(text), F.lit("")).cast("binary"), 1, PREFIX)
    rows = df.count()
    share = min(1.0, SAMPLES_A_BUCKET * n / max(rows, 1))
    sample = df.select(id_.alias("id"), known.alias("known"), prefix.alias("prefix"),
                       (F.coalesce(F.octet_length(text), F.lit(0)) + PREFIX).alias("weight"))
    sample = (sample if share == 1.0 else sample.sample(share, seed=7)).toArrow()
    if not sample.num_rows or n == 1:
        return F.lit(0)

    def keys_of(ids: pa.Array, known: pa.Array, prefix: pa.Array) -> np.ndarray:
        return _order_key(ids.to_numpy(zero_copy_only=False), known.to_numpy(zero_copy_only=False),
                          np.array(prefix.to_pylist(), f"S{PREFIX}"))

    keys = keys_of(*(sample.column(c).combine_chunks() for c in ("id", "known", "prefix")))
    order = np.argsort(keys, order=("known", "id", "prefix"))
    weights = sample.column("weight").to_numpy().astype(np.float64)[order]
    at = np.searchsorted(np.cumsum(weights), weights.sum() * np.arange(1, n) / n)
    bounds = keys[order][np.minimum(at, len(order) - 1)]

    def place(ids: pa.Array, known: pa.Array, prefix: pa.Array, salt: pa.Array) -> pa.Array:
        below, equal = _places(bounds, keys_of(ids, known, prefix))
        return pa.array((below + salt.to_numpy() % (equal + 1)).astype(np.int32))

    place.__annotations__ = {"ids": pa.Array, "known": pa.Array, "prefix": pa.Array, "salt": pa.Array, "return": pa.Array}
    return F.arrow_udf(place, "int")(id_, known, prefix, F.monotonically_increasing_id())


# --- files in the shared folder -----------------------------------------------------------------


def shared_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI (file:, hdfs:, s3:, ...) or of an absolute path, and the path on it."""
    if uri.startswith("file:"):
        uri = "file:///" + uri[len("file:"):].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def attempt_path(folder: str, stem: str, suffix: str) -> str:
    """A file name that no other attempt of the same task uses."""
    return posixpath.join(folder, f"{stem}-{uuid.uuid4().hex}{suffix}")


def open_output(uri: str):
    fs, path = shared_fs(uri)
    fs.create_dir(posixpath.dirname(path), recursive=True)
    return fs.open_output_stream(path, compression=None)


def open_input(uri: str):
    fs, path = shared_fs(uri)
    return fs.open_input_file(path)


#: Bits of a row filter: 4 MB, whatever the data.
FILTER_BITS = 25


def filter_slot(*keys: str) -> Column:
    """The bit of a key in a row filter."""
    return F.pmod(F.xxhash64(*keys), F.lit(1 << FILTER_BITS)).cast("int")


def row_filter(slots: DataFrame) -> np.ndarray:
    """Bits set for all rows of ``slots`` (slot int): a filter of fixed size without false negatives."""
    parts = slots.groupBy(F.expr("slot div 32768").alias("part")).agg(
        F.expr("bitmap_construct_agg(slot % 32768)").alias("bits")).collect()
    out = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for r in parts:
        out[r["part"] * 4096: (r["part"] + 1) * 4096] = np.frombuffer(r["bits"], np.uint8)
    return out


def passes(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bits[slots >> 3] >> (slots & 7).astype(np.uint8) & 1).astype(bool)


def batch_rows(spark: SparkSession, n: int = BATCH_ROWS) -> None:
    """Rows per Arrow batch of the jobs started from now on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(n))


def released(fn):
    """A function over batches that hands the memory it freed back to the machine when its task ends.

    Workers are reused: what one stage's arrays took would otherwise stay with
    an idle worker beside the next stage's.
    """

    @wraps(fn)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            release()

    return run


def release() -> None:
    """Give freed memory back, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def rows_of(batches: Iterator[pa.RecordBatch], size: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``size`` rows."""
    for b in batches:
        for i in range(0, b.num_rows, size):
            yield b.slice(i, size)
