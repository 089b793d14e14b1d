"""Document fingerprints from closed syncmers.

A k-mer of code points is a closed syncmer when the smallest hash among its
s-mers stands at its first or last s-mer. The choice looks at nothing outside
the k-mer, so equal passages give equal anchors wherever they stand. A
fingerprint keeps every anchor of the whole text whose hash lies in the lowest
sixteenth, and at least the ``SIZE`` smallest distinct ones, in text order. So
it grows with the text: a passage of some hundred characters is seen in a text
of any length. Likeness chains the anchors that two fingerprints share in the
same order.

Nulls, empties, ties: a null text counts as empty; an empty text has an empty
fingerprint, is wholly like another empty one and unlike any other. A text
without a closed syncmer (shorter than ``k``, or a few characters longer) has
one anchor, the hash of the whole text. Anchors with equal hashes count once,
at their first place. Very long texts are cut into overlapping windows, whose
anchors are those of the whole text. Rows with equal doc_id follow each other
in text order; a null doc_id comes first. A table of one row is its own next.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import common

K, S, SIZE = 24, 8, 128
HASH_BYTES = 5
#: Hashes below this are kept from a text of any length: one anchor in 16, some 140 characters apart.
ALWAYS = 1 << (8 * HASH_BYTES - 4)
#: Code points handled at once.
WINDOW = 1 << 18

ROWS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")


def _doubled(h: np.ndarray, have: int, want: int) -> np.ndarray:
    """Hashes of ``want`` code points from hashes of ``have`` code points (want <= 2 * have)."""
    return common.join_hash(h[: len(h) - (want - have)], h[want - have:])


def _closed(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the closed syncmers among all k-mers of ``points``."""
    n = len(points) - K + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = common.mix(points.astype(np.uint64) + np.uint64(1))
    have = 1
    while have < S:
        h = _doubled(h, have, min(2 * have, S))
        have = min(2 * have, S)
    least, width, span = h, 1, K - S + 1
    while width < span:
        step = min(width, span - width)
        least = np.minimum(least[: len(least) - step], least[step:])
        width += step
    at = np.flatnonzero((h[:n] == least[:n]) | (h[K - S: K - S + n] == least[:n]))
    whole = h[at]
    for shift in range(S, K - S + 1, S):
        whole = common.join_hash(whole, h[at + shift])
    if K % S:
        whole = common.join_hash(whole, h[at + K - S])
    return at, whole


def anchors(points: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Per text the kept anchor hashes (top 40 bits), in text order."""
    starts, hashes = [], []
    for at in range(0, max(len(points) - K + 1, 0), WINDOW):
        where, h = _closed(points[at: at + WINDOW + K - 1])
        where = where + at
        # k-mers that cross from one text to the next are of neither
        text = np.searchsorted(offsets, where, "right")
        inside = where + K <= offsets[np.minimum(text, len(offsets) - 1)]
        starts.append(where[inside])
        hashes.append(h[inside] >> np.uint64(64 - 8 * HASH_BYTES))
    starts = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    cuts = np.searchsorted(starts, offsets)
    out = []
    for i in range(len(offsets) - 1):
        if offsets[i] == offsets[i + 1]:
            out.append(hashes[:0])
            continue
        h, first = np.unique(hashes[cuts[i]: cuts[i + 1]], return_index=True)
        if len(h) == 0:
            digest = hashlib.blake2b(points[offsets[i]: offsets[i + 1]].tobytes(), digest_size=HASH_BYTES).digest()
            out.append(np.array([int.from_bytes(digest, "little")], np.uint64))
        else:
            n = max(SIZE, int(np.searchsorted(h, ALWAYS)))
            out.append(h[:n][np.argsort(first[:n])])
    return out


def fingerprint_text(kept: np.ndarray) -> str:
    raw = kept.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES]
    return base64.b64encode(raw.tobytes()).decode("ascii")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of anchors (Dice) that both texts have in the same order, 0 to 1.

    Up to the hash below which both fingerprints are complete they are a fair
    sample of all anchors of both texts; those that both have are chained by
    their order in the two texts (longest increasing run).
    """
    if len(a) == 0 or len(b) == 0:
        return float(len(a) == len(b))
    if len(a) == len(b) and np.array_equal(a, b):
        return 1.0
    # a fingerprint of fewer than SIZE anchors has all of its text's
    limit = min((max(ALWAYS - 1, int(x.max())) for x in (a, b) if len(x) >= SIZE), default=1 << 64)
    a, b = ([h for h in x.tolist() if h <= limit] for x in (a, b))
    both = set(a) | set(b)
    place = {h: i for i, h in enumerate(b)}
    tails: list[int] = []
    for h in a:
        if h in place:
            p = place[h]
            i = bisect_left(tails, p)
            tails[i: i + 1] = [p]
    shared = len(tails) / len(both)
    return 2 * shared / (1 + shared)


def edited(text: str, following: str) -> str:
    """``text`` with its last floor(n/2) code points replaced by as many first ones of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint every text and its edited text, in ascending doc_id order (see ROWS).

    One shuffle of the texts: doc_id ranges, sorted inside. Each range also gets
    a copy of the first document of the next one, so every document meets its
    follower in its own task.
    """
    spark = common.prepare(docs.sparkSession)
    n = common.n_partitions(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    bucket = common.ordered_buckets(rows, "doc_id", "text", n)
    rows = rows.withColumn("bucket", bucket)
    # The first document of each range: at most n, found by id before any text is read.
    ids = rows.groupBy("bucket").agg(F.min(F.struct("doc_id")).alias("first"))
    ids = ids.select("bucket", F.col("first.doc_id").alias("first_id"))
    starts = sorted(r[0] for r in ids.select("bucket").collect())
    if not starts:
        return spark.createDataFrame([], ROWS)
    before = F.element_at(F.create_map(*[F.lit(x) for i, b in enumerate(starts) for x in (b, starts[i - 1])]),
                          F.col("bucket"))
    ids = ids.withColumnRenamed("bucket", "of")
    first = (rows.join(F.broadcast(ids), (F.col("bucket") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("first_id")))
             .groupBy("bucket").agg(F.min(F.struct("doc_id", "text")).alias("row"))
             .select(F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text"), before.alias("bucket"),
                     F.lit(True).alias("halo")))
    dealt = (rows.select("doc_id", "text", "bucket", F.lit(False).alias("halo")).unionByName(first)
             .repartitionById(n, "bucket").sortWithinPartitions("halo", "doc_id", "text"))
    return dealt.select("doc_id", "text").mapInArrow(_pairs, ROWS)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range in order, the halo row last: each row but that one, with its follower."""
    held: tuple | None = None
    for batch in common.rows_of(batches, 500):
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        kept = anchors(*common.code_points(batch.column(1)))
        if held is not None:
            ids, texts, kept = [held[0], *ids], [held[1], *texts], [held[2], *kept]
        held = ids[-1], texts[-1], kept[-1]
        new = [edited(t, f) for t, f in zip(texts, texts[1:])]
        new_kept = anchors(*common.code_points(pa.array(new, pa.large_string())))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[:-1], pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()),
             pa.array([hashlib.sha256(t.encode("utf-8")).hexdigest() for t in new], pa.string()),
             pa.array([fingerprint_text(k) for k in kept[:-1]], pa.string()),
             pa.array([fingerprint_text(k) for k in new_kept], pa.string()),
             pa.array([likeness(a, b) for a, b in zip(kept, new_kept)], pa.float64()),
             pa.array([likeness(a, b) for a, b in zip(kept, kept[1:])], pa.float64())],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
                   "near_next"])
