"""Removal of repeated passages by longest-previous-factor (LPF) arrays over suffix order.

A start is repeated if the ``min_bytes`` bytes from it on also start elsewhere
in the corpus. No suffix array of the corpus is built: starts are first dealt
to small groups that hold all their matches.

1. Texts get byte addresses and are bucketed by them, once.
2. Each start's window holds ``min_bytes - gram + 1`` grams; the one of least
   hash (ties: the leftmost) is its anchor, so equal windows have equal
   anchors. A run of starts with one anchor is an occurrence; its context, all
   bytes of its windows, is known by a hash.
3. Spark counts occurrences by (anchor, context). Equal contexts repeat whole;
   an anchor with one occurrence repeats nowhere. Both are settled without text.
4. Of each anchor with several contexts, the first of each context is fetched.
   Groups of whole anchors are sorted by suffix (big-endian words, doubled up
   to ``min_bytes``), with LCPs; previous and next smaller addresses in that
   order give each start's longest previous factor and where it lies. An LPF
   of ``min_bytes`` makes a start a later copy, and its source a repeated one.
   An anchor with more than ``GROUP`` contexts is not held by one task: its
   starts are halved by their distance to the anchor and each half is keyed by
   the bytes that all windows at such distances share, which are more, so that
   steps 3 and 4 settle it as a group of its own. After at most eight halvings
   the shared bytes are the window itself.
5. Spans return to the texts by address.

Rows and edge cases: a null text is empty; texts shorter than ``min_bytes``
keep all; a repeated row or id is a document of its own; an empty table gives
no row; other columns are not read. Cuts can fall inside a character, so what
is kept is binary. Texts are read in slices, so their length is not bounded by
memory for numpy. Contexts and windows count as equal by 128 bits of hash (the
anchor's and the context's).
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import common
from tessera.session import delete_path, scratch_dir, scratch_root

#: Contexts of an anchor that one task may hold at once (some 300 bytes each).
GROUP = 2048
#: Bytes of text whose suffixes are sorted at once, beyond one group.
SORTED_BYTES = 1 << 20
#: Starts handled at once.
SLICE = 1 << 18

_VALUES = common.mix(np.arange(1, 257, dtype=np.uint64))
_POSITION = np.uint64((1 << 28) - 1)


def addressed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, base): the text's first byte has address ``base``; bucketed and sorted by it."""
    spark = docs.sparkSession

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 40
        for b in batches:
            text = b.column("text").cast(pa.large_string()).fill_null("")
            sizes = pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64) + 1
            ends = at + np.cumsum(sizes)
            at = int(ends[-1]) if len(ends) else at
            yield pa.record_batch([b.column("doc_id"), text.cast(pa.string()), pa.array(ends - sizes)], ["doc_id", "text", "base"])

    n, name = common.n_partitions(spark), f"tessera_texts_{uuid.uuid4().hex[:12]}"
    numbered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(number, "doc_id long, text string, base long")
    numbered.repartition(n, "base").write.format("parquet").option("path", scratch_dir(spark, "texts")).option("compression", "zstd") \
        .bucketBy(n, "base").sortBy("base").saveAsTable(name)
    return spark.table(name)


# --- anchors ----------------------------------------------------------------------------------


def gram_size(min_bytes: int) -> int:
    return max(2, min(24, min_bytes // 8))


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return common.powers(n, common._ODD), common.powers(n, common._ODD_INV)


class Hashes:
    """Hashes of any span of some bytes, from one running sum."""

    def __init__(self, data: np.ndarray):
        self.up, down = _powers(1 << max(10, len(data).bit_length()))
        self.total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUES[data] * down[: len(data)], out=self.total[1:])

    def spans(self, starts, ends) -> np.ndarray:
        h = (self.total[ends] - self.total[starts]) * self.up[starts]
        return common.mix(h + (ends - starts).astype(np.uint64))

    def all(self, size: int) -> np.ndarray:
        h = (self.total[size:] - self.total[:-size]) * self.up[: len(self.total) - size]
        return common.mix(h)


def occurrences(data: np.ndarray, pieces: np.ndarray, min_bytes: int):
    """(piece, first start, starts, distance from the first to the anchor, hashes of anchor and context) of each
    run of starts with one anchor.

    ``pieces`` are the n+1 offsets of the pieces of ``data``; windows lie inside a piece.
    """
    gram = gram_size(min_bytes)
    window = min_bytes - gram + 1
    lengths = np.maximum(np.diff(pieces) - min_bytes + 1, 0)
    if not lengths.sum():
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    hashes = Hashes(data)
    grams = hashes.all(gram)
    least = (grams & ~_POSITION) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while 2 * width <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < window:
        least = np.minimum(least[: len(least) - (window - width)], least[window - width:])
    piece = np.repeat(np.arange(len(lengths)), lengths)
    start = np.arange(len(piece)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + pieces[piece]
    anchor = (least[start] & _POSITION).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(start)))
    begin = start[first]
    return (piece[first], begin - pieces[piece[first]], count, anchor[first] - begin, grams[anchor[first]],
            hashes.spans(begin, begin + count - 1 + min_bytes))


def slices(batches: Iterator[pa.RecordBatch], min_bytes: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes, piece offsets, and the base and offset of each piece: texts together, or long ones in overlapping slices."""
    for b in batches:
        data, offsets = common.utf8(b.column("text"))
        base = b.column("base").to_numpy()
        i = 0
        while i < len(base):
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE, "right")) - 1)
            size = offsets[i + 1] - offsets[i]
            if size <= SLICE:
                yield data[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i], base[i:j], np.zeros(j - i, np.int64)
            else:
                j = i + 1
                for at in range(0, int(size) - min_bytes + 1, SLICE):
                    cut = data[offsets[i] + at: min(offsets[i] + at + SLICE + min_bytes - 1, offsets[j])]
                    yield cut, np.array([0, len(cut)]), base[i:j], np.array([at])
            i = j


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def _find(min_bytes: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for data, pieces, base, offset in slices(batches, min_bytes):
            piece, begin, count, distance, anchor, context = occurrences(data, pieces, min_bytes)
            yield pa.record_batch([pa.array(base[piece]), pa.array(base[piece] + offset[piece] + begin), pa.array(count.astype(np.int32)),
                                   pa.array(distance.astype(np.int32)), _signed(anchor), _signed(context)],
                                  ["base", "at", "starts", "off", "key", "context"])

    return find


# --- suffix order -----------------------------------------------------------------------------


def _previous_smaller(v: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each i the nearest j < i with v[j] < v[i] (-1: none) and the least of lcp[j+1..i]."""
    prev, low = np.arange(len(v)) - 1, lcp.copy()
    active = np.flatnonzero(prev >= 0)
    while len(active):
        j = prev[active]
        larger = v[j] > v[active]
        active, j = active[larger], j[larger]
        low[active], prev[active] = np.minimum(low[active], low[j]), prev[j]
        active = active[prev[active] >= 0]
    low[prev < 0] = 0
    return prev, low


def previous_factors(text: np.ndarray, starts: np.ndarray, address: np.ndarray, limit: int):
    """(LPF, source) of each of ``starts``: the longest match, up to ``limit`` bytes, with a start of
    smaller ``address``, and the index of that start (-1: none).

    Suffix order comes from ranks of 8, 16, 32, ... bytes; every start has ``limit`` bytes after it.
    """
    padded = np.concatenate([text, np.zeros(limit + 8, np.uint8)])
    n = len(text) + limit
    words = np.lib.stride_tricks.as_strided(padded, (n, 8), (1, 1)).copy().view(">u8").ravel().astype(np.uint64)
    ranks, width = {8: np.unique(words, return_inverse=True)[1]}, 8
    while 2 * width <= limit:
        r = ranks[width]
        pair = r * (r.max() + 1)
        pair[:-width] += r[width:]
        ranks[2 * width] = np.unique(pair, return_inverse=True)[1]
        width *= 2
    r = ranks[width]
    whole = r[starts] * (r.max() + 1) + r[starts + limit - width]
    order = np.lexsort((address, whole))
    p = starts[order]
    same = np.zeros(len(p), np.int64)  # bytes that each suffix shares with the one before it
    a, b = p[1:], p[:-1]
    lcp = np.zeros(len(a), np.int64)
    for w in sorted(ranks, reverse=True):
        r = ranks[w]
        fits = lcp + w <= limit
        step = np.where(fits, lcp, 0)
        lcp += np.where(fits & (r[a + step] == r[b + step]), w, 0)
    at = np.minimum(lcp, limit - 1)
    differ = words[a + at] ^ words[b + at]
    tail = sum((differ >> np.uint64(s) == 0).astype(np.int64) for s in range(0, 64, 8))
    same[1:] = np.where(lcp < limit, np.minimum(lcp + tail, limit), limit)
    v = np.empty(len(p), np.int64)
    v[np.argsort(address[order], kind="stable")] = np.arange(len(p))
    left, near_left = _previous_smaller(v, same)
    right, near_right = _previous_smaller(v[::-1], np.concatenate([[0], same[1:][::-1]]))
    right, near_right = np.where(right >= 0, len(p) - 1 - right, -1)[::-1], near_right[::-1]
    longest = np.maximum(near_left, near_right)
    source = np.where(longest == 0, -1, np.where(near_left >= near_right, left, right))
    lpf, of = np.empty(len(p), np.int64), np.full(len(p), -1)
    lpf[order] = longest
    of[order] = np.where(source >= 0, order[source], -1)
    return lpf, of


def repeated(text: np.ndarray, starts: np.ndarray, address: np.ndarray, limit: int, keep_first: bool) -> np.ndarray:
    """Whether each start is a later copy, or (unless ``keep_first``) the source of one."""
    lpf, source = previous_factors(text, starts, address, limit)
    hit = lpf >= limit
    if not keep_first:
        hit[source[hit]] = True
    return hit


def _sorted_groups(min_bytes: int, keep_first: bool):
    def settle(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        text = np.frombuffer(b"".join(r[2] for r in rows), np.uint8)
        size = np.array([len(r[2]) for r in rows])
        count = size - min_bytes + 1
        which = np.repeat(np.arange(len(rows)), count)
        inside = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        at = np.array([r[1] for r in rows])[which] + inside
        hit = repeated(text, (np.cumsum(size) - size)[which] + inside, at, min_bytes, keep_first)
        base = np.array([r[0] for r in rows])[which]
        hit = np.flatnonzero(hit)
        hit = hit[np.argsort(at[hit])]
        base, at = base[hit], at[hit]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (base[1:] != base[:-1])
        last = np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1) if len(at) else np.zeros(0, int)
        return pa.record_batch([pa.array(base[new]), pa.array(at[new]), pa.array(at[last] + min_bytes)], ["base", "begin", "end"])

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, load, before = [], 0, None
        for b in batches:
            for key, base, at, text in zip(*(b.column(c).to_pylist() for c in ("key", "base", "at", "bytes"))):
                if key != before and load >= SORTED_BYTES:
                    yield settle(rows)
                    rows, load = [], 0
                rows.append((base, at, text))
                before, load = key, load + len(text)
        if rows:
            yield settle(rows)

    return groups


# --- contexts and cuts ------------------------------------------------------------------------


def _fetch(min_bytes: int):
    fields = pa.schema([("key", pa.int64()), ("base", pa.int64()), ("at", pa.int64()), ("starts", pa.int32()), ("off", pa.int32()),
                        ("kinds", pa.int64()), ("bytes", pa.binary())])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for base, text, wanted in zip(b.column("base").to_pylist(), b.column("text").to_pylist(), b.column("wanted").to_pylist()):
                data = text.encode("utf-8")
                rows = [(w["key"], base, w["at"], w["starts"], w["off"], w["kinds"],
                         data[w["at"] - base: w["at"] - base + w["starts"] - 1 + min_bytes]) for w in wanted]
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), fields)], schema=fields)

    return fetch


def _halves(min_bytes: int):
    """Each occurrence's starts, cut in the halves of the distances ``lo`` to ``hi`` to its anchor."""
    names = ["key", "context", "base", "at", "starts", "off", "lo", "hi", "bytes"]
    types = [pa.int64()] * 4 + [pa.int32()] * 4 + [pa.binary()]

    def digest(*parts: bytes) -> int:
        return int.from_bytes(hashlib.blake2b(b"".join(parts), digest_size=8).digest(), "little", signed=True)

    def halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for key, base, at, starts, off, lo, hi, text in zip(*(
                    b.column(c).to_pylist() for c in ("key", "base", "at", "starts", "off", "lo", "hi", "bytes"))):
                for near, far in ((lo, (lo + hi) // 2), ((lo + hi) // 2, hi)):
                    first, last = max(0, off - far + 1), min(starts - 1, off - near)
                    if first <= last:
                        shared = text[off - near: off - far + 1 + min_bytes]
                        own = text[first: last + min_bytes]
                        rows.append((digest(struct.pack("<qii", key, near, far), shared), digest(own), base, at + first,
                                     last - first + 1, off - first, near, far, own))
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return halves


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    spans_type = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
    for b in common.rows_of(batches):
        kept, spans = [], []
        for base, text, found in zip(b.column("base").to_pylist(), b.column("text").to_pylist(), b.column("spans").to_pylist()):
            data, parts, merged = text.encode("utf-8"), [], []
            for s in sorted((f["begin"] - base, f["end"] - base) for f in found or []):
                if merged and s[0] <= merged[-1]["end"]:
                    merged[-1]["end"] = max(merged[-1]["end"], s[1])
                else:
                    merged.append({"begin": s[0], "end": s[1]})
            at = 0
            for s in merged:
                parts.append(data[at: s["begin"]])
                at = s["end"]
            kept.append(b"".join(parts) + data[at:] if merged else data)
            spans.append(merged)
        yield pa.record_batch([b.column("doc_id"), b.column("text"), pa.array(kept, pa.binary()), pa.array(spans, spans_type)],
                              ["doc_id", "text", "kept", "spans"])


def _classes(items: DataFrame) -> DataFrame:
    """``items`` that may repeat, with how often their context occurs (n), where first, and how many contexts their
    key has (kinds; null: one)."""
    contexts = items.groupBy("key", "context").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    several = contexts.groupBy("key").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds >= 2")
    matter = contexts.join(several, "key", "left").filter("n >= 2 or kinds is not null")
    return items.join(matter, ["key", "context"]).drop("context")


def repeated_spans(texts: DataFrame, min_bytes: int, keep_first: bool, group: int = GROUP) -> DataFrame:
    """(base, begin, end): address ranges that cover all repeated starts; ranges of a text may overlap."""
    def whole(found: DataFrame) -> DataFrame:
        return found.filter("n >= 2" + (" and at <> first" if keep_first else "")).select(
            "base", F.col("at").alias("begin"), (F.col("at") + F.col("starts") - 1 + min_bytes).alias("end"))

    spark = texts.sparkSession
    path = scratch_dir(spark, "occurrences")
    occ = common.materialise(texts.select("text", "base").mapInArrow(
        common.released(_find(min_bytes)), "base long, at long, starts int, off int, key long, context long"), "", path, "zstd")
    found = common.materialise(_classes(occ), "repeated", codec="zstd")
    delete_path(spark, path, scratch_root(spark))  # only what repeats is needed from here on
    spans = whole(found)
    wanted = found.filter("kinds >= 2 and at = first").groupBy("base").agg(
        F.collect_list(F.struct("key", "at", "starts", "off", "kinds")).alias("wanted"))
    open_ = common.materialise(texts.join(wanted, "base").select("base", "text", "wanted").mapInArrow(
        common.released(_fetch(min_bytes)), "key long, base long, at long, starts int, off int, kinds long, bytes binary"),
        "contexts", codec="zstd").withColumns({"lo": F.lit(0), "hi": F.lit(min_bytes - gram_size(min_bytes) + 1)})
    own = ["key", "base", "at", "bytes"]
    small = open_.filter(F.col("kinds") <= group).select(*own)
    while (large := open_.filter(F.col("kinds") > group)).limit(1).count():
        halves = common.materialise(large.mapInArrow(_halves(min_bytes), (
            "key long, context long, base long, at long, starts int, off int, lo int, hi int, bytes binary")), "halves")
        found = common.materialise(_classes(halves), "repeated")
        spans = spans.unionByName(whole(found))
        open_ = found.filter("kinds >= 2 and at = first")
        small = small.unionByName(open_.filter(F.col("kinds") <= group).select(*own))
    small = small.repartition(common.n_partitions(spark), "key").sortWithinPartitions("key", "at") \
        .mapInArrow(common.released(_sorted_groups(min_bytes, keep_first)), "base long, begin long, end long")
    return spans.unionByName(small)


def dedup_passages(docs: DataFrame, min_bytes: int = 200, keep_first: bool = True, group: int = GROUP) -> DataFrame:
    """(doc_id, text, kept binary, spans): every document without its repeated passages of ``min_bytes`` or more.

    ``keep_first`` keeps the first of all copies (by the order in which the
    texts were read); otherwise all copies go.
    """
    if min_bytes < 8:
        raise ValueError("min_bytes must be at least 8")
    common.prepare(docs.sparkSession)
    texts = addressed(docs)
    spans = repeated_spans(texts, min_bytes, keep_first, group).groupBy("base").agg(
        F.collect_list(F.struct("begin", "end")).alias("spans"))
    spans_type = "spans array<struct<begin: long, end: long>>"
    return texts.join(spans, "base", "left").select("doc_id", "text", "base", "spans") \
        .mapInArrow(_cut, f"doc_id long, text string, kept binary, {spans_type}")
