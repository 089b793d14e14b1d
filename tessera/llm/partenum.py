"""Jaccard similarity join of word-shingle sets by PartEnum signatures.

Sizes are cut into overlapping bands, so any two sets similar enough share a
band, and in a band their symmetric difference is at most a share of their
size. The feature domain is hashed into more partitions than that, so some
partitions hold the same features in both sets. The subsets of partitions that
are enumerated are the single ones (PartEnum's n2 = k2 + 1): a signature is a
band, a partition and the features in it. A set with k differences at most to
any partner keeps its k + 1 first signatures in one order of all signatures;
two similar sets then share one. The order puts signatures last that a sample
finds often, which only makes candidates fewer.

Signatures meet by hash, sorted inside tasks and streamed: every set of a run
is a candidate with the run's first set (a star, never all pairs). Candidates
are verified on whole sets, and links give components. A run whose sets then
still lie in several components is searched for further links, set against set
across components, in blocks of bounded size that are dealt to tasks of their
own: bins bound the overlap first, then whole sets are compared in the task,
which returns links that join components and never the pairs it looked at.

Equal sets are one class from the start; links are found between classes, so
none between different texts is lost and copies are not expanded into pairs.

Nulls, empties, ties: a null, empty or wordless text has the empty set and
links with nothing. A text of fewer words than a shingle has its whole word
sequence as its one shingle. Texts are linked first, as if every row had an id
of its own; then rows of one doc_id are one document, linked by any of its
texts. Repeated rows get a row each. A null doc_id joins no rows; it counts as
the smallest and is returned as null. An empty table gives no rows. Other
columns are ignored. Sets are known by 64-bit hashes of their shingles, rows by
one of doc_id and text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import common
from tessera.llm.components import components
from tessera.session import delete_path, scratch_dir, scratch_root

WORDS = 5
#: The similarity asked for, as a fraction: 100 * intersection >= 75 * union.
NUM, DEN = 3, 4
BAND_RATIO = 2.25
#: The sample that tells frequent signatures: documents, and sample documents that make one frequent.
SAMPLE_DOCS, FREQUENT, MAX_FREQUENT = 8_000, 3, 400_000
#: Features of the sets of a run that are searched against each other at once: 16 MB.
BLOCK = 1 << 21
NULL_ID = -(1 << 63)

_SPACE = np.ones(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = False
_U = np.uint64

SETS = "doc_id long, id long, n_shingles int, key long, signatures binary"


# --- bands --------------------------------------------------------------------------------------


def bands(most: int) -> list[tuple[int, int, int]]:
    """(first size of its own, largest size, partitions) of each band up to sizes of ``most``."""
    out, low = [], 1
    while low <= most:
        following = max(low + 1, int(np.ceil(low * BAND_RATIO)))
        high = (following - 1) * DEN // NUM  # the largest partner of the band's own sets
        out.append((low, high, int(0.3 * high) + 16))
        low = following
    return out


BANDS = bands(1 << 40)
_LOWS = np.array([b[0] for b in BANDS])


def differences(a: int, b: int) -> int:
    """The most features by which similar sets of sizes a and b differ."""
    return (a + b) * (DEN - NUM) // (DEN + NUM)


def instances(size: int) -> list[tuple[int, int, int]]:
    """(band, partitions, differences to a partner there) of a set: its own band, and the one below if it reaches it."""
    own = int(np.searchsorted(_LOWS, size, "right")) - 1
    out = [(own, BANDS[own][2], differences(size, size * DEN // NUM))]
    if own and size <= BANDS[own - 1][1]:
        out.append((own - 1, BANDS[own - 1][2], differences(size, BANDS[own][0] - 1)))
    return out


# --- sets and signatures ---------------------------------------------------------------------------


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, offsets = common.utf8(texts)
    starts, ends, cuts = common.word_spans(data, offsets, _SPACE)
    words = common.word_hashes(data, starts, ends)
    joined = words[: max(len(words) - WORDS + 1, 0)]
    for i in range(1, WORDS):
        joined = common.join_hash(joined, words[i: i + len(joined)])
    joined = common.mix(joined)
    out = []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if b - a >= WORDS:
            h = np.sort(joined[a: b - WORDS + 1])
            out.append(h[np.concatenate([[True], h[1:] != h[:-1]])])
        elif b > a:
            h = words[a: a + 1]
            for i in range(a + 1, b):
                h = common.join_hash(h, words[i: i + 1])
            out.append(common.mix(h + _U(b - a)))
        else:
            out.append(words[:0])
    return out


def set_key(h: np.ndarray) -> int:
    """A 64-bit key of the whole set."""
    total = common.mix(h ^ _U(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + _U(len(h))
    return int(common.mix(np.array([total], np.uint64)).view(np.int64)[0])


def signatures(h: np.ndarray, frequent: np.ndarray | None) -> np.ndarray:
    """The signatures a set is found by; ``frequent`` (sorted) come last in the order; None: all signatures."""
    out = []
    for band, parts, k in instances(len(h)):
        salted = common.mix(h + _U((band + 1) * int(common._ODD) & (2**64 - 1)))
        part = ((salted >> _U(32)) * _U(parts)) >> _U(32)
        order = np.argsort(part, kind="stable")
        part = part[order]
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        sums = np.add.reduceat(salted[order] * _U(0xD6E8FEB86659FD93 | 1), first)
        sig = common.join_hash(sums, part[first] + _U(band << 40))
        if frequent is None:
            out.append(sig)
            continue
        if k + 1 > len(sig):
            # So few partitions hold features that the shared ones may all be empty: such sets meet here.
            out += [sig, common.mix(np.array([band], np.uint64) + _U(1 << 50))]
            continue
        rank = sig >> _U(1)
        if len(frequent):
            at = np.minimum(np.searchsorted(frequent, sig), len(frequent) - 1)
            rank = rank | ((frequent[at] == sig).astype(np.uint64) << _U(63))
        out.append(sig[np.argpartition(rank, k)[: k + 1]] if k + 1 < len(sig) else sig)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _id() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))


def _row() -> Column:
    """The hash a row is known by until its links are found: unlike texts of one doc_id, or of none, are apart."""
    return F.xxhash64(_id(), F.coalesce("text", F.lit("")))


def _ids(docs: DataFrame) -> DataFrame:
    """doc_id (of the row's own, by _row), text and id (the document's)."""
    return docs.select(_row().alias("doc_id"), "text", _id().alias("id"))


def frequent_signatures(docs: DataFrame) -> np.ndarray:
    """Signatures that many documents of a bounded sample (by hash of doc_id) have; sorted."""
    n = docs.count()
    share = min(1.0, SAMPLE_DOCS / max(n, 1))
    sample = docs.filter(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 20)) < int(share * (1 << 20)))

    @common.released
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.rows_of(batches, 200):
            found = [signatures(h, None) for h in shingle_sets(batch.column(1)) if len(h)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], names=["sig"])

    counts = sample.mapInArrow(emit, "sig long").groupBy("sig").count().filter(F.col("count") >= FREQUENT)
    found = counts.orderBy(F.desc("count"), "sig").limit(MAX_FREQUENT).select("sig").toArrow()
    return np.sort(found.column(0).to_numpy().view(np.uint64))


def class_sets(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """SETS of all documents; signatures are packed, 8 bytes each."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    @common.released
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.rows_of(batches):
            sets = shingle_sets(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([len(h) for h in sets], pa.int32()),
                 pa.array([set_key(h) for h in sets], pa.int64()),
                 pa.array([signatures(h, shared.value).tobytes() if len(h) else b"" for h in sets], pa.binary())],
                names=["doc_id", "id", "n_shingles", "key", "signatures"])

    return docs.mapInArrow(emit, SETS)


# --- candidates ----------------------------------------------------------------------------------


def stars(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """(sig, leader, node): each set that shares a signature with a smaller one, with the smallest of the run.

    A class is represented by its smallest doc_id. Documents of classes of
    several (known by a row filter of fixed size) are first reduced to one row
    a class; all others go straight on.
    """
    spark = sets.sparkSession
    copied = spark.sparkContext.broadcast(common.row_filter(
        classes.filter("copies > 1").select(common.filter_slot("key").alias("slot"))))
    slotted = sets.filter("n_shingles > 0").select("doc_id", "key", "signatures", common.filter_slot("key").alias("slot"))

    def pick(batch: pa.RecordBatch, want: bool) -> pa.RecordBatch:
        return batch.filter(pa.array(common.passes(copied.value, batch.column(3).to_numpy()) == want))

    def unpacked(batch: pa.RecordBatch) -> pa.RecordBatch:
        packed = batch.column(2).to_pylist()
        node = np.repeat(batch.column(0).to_numpy(), [len(p) // 8 for p in packed])
        return pa.RecordBatch.from_arrays([pa.array(np.frombuffer(b"".join(packed), np.int64)), pa.array(node)],
                                          names=["sig", "node"])

    def of_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pick(batch, True)

    def of_singles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.rows_of(batches, 500):
            yield unpacked(pick(batch, False))

    def of_classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.rows_of(batches, 500):
            yield unpacked(batch)

    several = slotted.mapInArrow(of_copies, slotted.schema).groupBy("key").agg(
        F.min("doc_id").alias("doc_id"), F.first("signatures").alias("signatures"))
    rows = slotted.mapInArrow(of_singles, "sig long, node long").unionByName(
        several.select("doc_id", "key", "signatures").mapInArrow(of_classes, "sig long, node long"))
    dealt = rows.repartition(common.n_partitions(spark), "sig").sortWithinPartitions("sig", "node")
    return dealt.mapInArrow(_runs, "sig long, leader long, node long")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (sig, node) in order: every row but a run's first, with the first's node; repeats once."""
    sig0 = node0 = lead0 = np.zeros(0, np.int64)
    for batch in batches:
        sig = np.concatenate([sig0, batch.column(0).to_numpy()])
        node = np.concatenate([node0, batch.column(1).to_numpy()])
        if not len(sig):
            continue
        new = np.ones(len(sig), bool)
        new[1:] = sig[1:] != sig[:-1]
        starts = np.flatnonzero(new)
        lead = np.repeat(node[starts], np.diff(np.append(starts, len(sig))))
        if len(lead0):
            lead[: starts[1] if len(starts) > 1 else len(sig)] = lead0[0]
        fresh = ~new
        fresh[1:] &= node[1:] != node[:-1]
        if fresh.any():
            yield pa.RecordBatch.from_arrays([pa.array(sig[fresh]), pa.array(lead[fresh]), pa.array(node[fresh])],
                                             names=["sig", "leader", "node"])
        sig0, node0, lead0 = sig[-1:], node[-1:], lead[-1:]


# --- verification ----------------------------------------------------------------------------------


def set_bins(h: np.ndarray) -> np.ndarray:
    """How many features fall in each of equal ranges of the hash space, one or two ranges a feature, a byte each."""
    bits = max(6, int(len(h)).bit_length())
    while True:
        counts = np.bincount((h >> _U(64 - bits)).astype(np.int64), minlength=1 << bits)
        if counts.max() < 256:
            return counts.astype(np.uint8)
        bits += 1


def folded(bins: np.ndarray, n: int) -> np.ndarray:
    """The counts of ``n`` wider ranges."""
    return bins.reshape(n, -1).sum(axis=1, dtype=np.int64)


def may_link(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sets with these bins can be similar enough: the bins bound their intersection from above."""
    n = min(len(x), len(y))
    most = np.minimum(folded(x, n), folded(y, n)).sum()
    return bool((DEN + NUM) * most >= NUM * (x.sum(dtype=np.int64) + y.sum(dtype=np.int64)))


def node_sets(docs: DataFrame, nodes: DataFrame, whole: bool) -> DataFrame:
    """(node, n, data) of the documents whose doc_id is in ``nodes`` (node), recomputed from their texts.

    The data are the hashes of the set if ``whole``, else its bins. A row
    filter of fixed size keeps the texts of other documents from being hashed;
    the few that pass it by chance meet no pair later.
    """
    wanted = docs.sparkSession.sparkContext.broadcast(common.row_filter(
        nodes.select(common.filter_slot("node").alias("slot"))))

    @common.released
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(common.passes(wanted.value, batch.column(2).to_numpy())))
            for part in common.rows_of([batch], 200):
                sets = shingle_sets(part.column(1))
                data = [(h if whole else set_bins(h)).tobytes() for h in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(h) for h in sets], pa.int32()), pa.array(data, pa.binary())],
                    names=["node", "n", "data"])

    return docs.select("doc_id", "text", common.filter_slot("doc_id").alias("slot")).mapInArrow(
        emit, "node long, n int, data binary").filter("n > 0")


def nodes_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def _with_data(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    for c in "ab":
        pairs = pairs.join(sets.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("data").alias(f"d{c}")), c)
    return pairs


def possible(pairs: DataFrame, bins: DataFrame) -> DataFrame:
    """The pairs (a, b) that sizes and bins allow to be similar enough."""

    @common.released
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [may_link(np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8))
                    for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # Sizes first: a pair too far apart in size never carries its bins.
    sizes = lambda c: bins.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"))
    near = pairs.join(sizes("a"), "a").join(sizes("b"), "b").filter(
        F.least("na", "nb") * DEN >= F.greatest("na", "nb") * NUM).select("a", "b").distinct()
    return _with_data(near, bins).select("a", "b", "da", "db").mapInArrow(check, "a long, b long").distinct()


def links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    wanted = sets.sparkSession.sparkContext.broadcast(common.row_filter(
        nodes_of(pairs).select(common.filter_slot("node").alias("slot"))))

    @common.released
    def used(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = common.passes(wanted.value, batch.column(3).to_numpy())
            yield batch.filter(pa.array(hit)).select(["node", "n", "data"])

    @common.released
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(DEN * both >= NUM * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # Written: else a task might run this step and the next in Python workers of their own, side by side.
    sets = common.materialise(sets.withColumn("slot", common.filter_slot("node")).mapInArrow(
        used, "node long, n int, data binary"), "partenum-used")
    return _with_data(pairs, sets).select("a", "b", "da", "db").mapInArrow(verify, "a long, b long").distinct()


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b) of different components."""
    label = lambda c: labels.select(F.col("node").alias(c), F.col("component").alias(f"{c}_of"))
    joined = pairs.join(label("a"), "a", "left").join(label("b"), "b", "left")
    return joined.filter(F.coalesce("a_of", "a") != F.coalesce("b_of", "b")).select("a", "b")


def open_groups(found: DataFrame, labels: DataFrame, bins: DataFrame) -> DataFrame:
    """(run, g1, g2, node, of): the sets of a run, but for its first, that may link to one of another component.

    A run's first set has met every other one of it as a star. Of runs with the
    same sets one is searched. Runs with more than BLOCK features are cut in
    blocks, and every two blocks of a run meet in a group of their own.
    """
    spark = found.sparkSession
    label = labels.select(F.col("node"), F.col("component").alias("of"))
    members = (found.select("sig", "node").join(label, "node", "left").withColumn("of", F.coalesce("of", "node"))
               .join(bins.select("node", "n"), "node"))
    runs = members.groupBy("sig").agg(
        F.count(F.lit(1)).alias("n_sets"), F.sum("n").alias("features"), F.min("of").alias("lo"), F.max("of").alias("hi"),
        F.bit_xor(F.xxhash64("node")).alias("h1"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("h2"))
    runs = runs.filter("lo <> hi").groupBy("n_sets", "h1", "h2").agg(
        F.min_by("features", "sig").alias("features"), F.min("sig").alias("run")).select(
        F.col("run").alias("sig"), F.ceil(F.col("features") / F.lit(BLOCK)).cast("int").alias("blocks"))
    dealt = (members.join(runs, "sig").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
             .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
             .select(F.col("sig").alias("run"), F.least("block", "other").alias("g1"),
                     F.greatest("block", "other").alias("g2"), "node", "of", "block"))
    return _by_group(dealt, bins).mapInArrow(_in_groups(_doubtful), "run long, g1 int, g2 int, node long, of long, block int")


def spanning_links(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between sets of a group, verified on whole sets until those that link are in one component."""
    return _by_group(groups, sets).mapInArrow(_in_groups(_spanning), "a long, b long").distinct()


def _by_group(rows: DataFrame, sets: DataFrame) -> DataFrame:
    rows = rows.join(sets, "node").select("run", "g1", "g2", "node", "of", "block", "n", "data")
    return rows.repartition(common.n_partitions(rows.sparkSession), "run", "g1", "g2").sortWithinPartitions(
        "run", "g1", "g2", "node")


class _Group:
    """The sets of one group; which later ones a set may link to."""

    def __init__(self, key: tuple, rows: list[tuple], bins: list[np.ndarray]):
        self.key = key
        self.node, self.of, self.block, self.n = (np.array([r[i] for r in rows], np.int64) for i in range(4))
        width = min(map(len, bins))
        self.bins = np.stack([folded(b, width) for b in bins])

    def partners(self, i: int) -> np.ndarray:
        n, m = self.n[i], self.n[i + 1:]
        later = np.flatnonzero((self.of[i + 1:] != self.of[i]) & (np.minimum(m, n) * DEN >= np.maximum(m, n) * NUM)
                               & ((self.block[i + 1:] != self.block[i]) | (self.key[1] == self.key[2]))) + i + 1
        most = np.minimum(self.bins[later], self.bins[i]).sum(axis=1)
        return later[(DEN + NUM) * most >= NUM * (self.n[later] + n)]


def _in_groups(search):
    """Batches in group order -> what ``search`` makes of the rows of each group that spans several components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        key: tuple = ()
        for batch in batches:
            for k0, k1, k2, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (k0, k1, k2) != key:
                    if len({r[1] for r in held}) > 1:
                        yield from search(key, held)
                    key, held = (k0, k1, k2), []
                held.append(tuple(row))
        if len({r[1] for r in held}) > 1:
            yield from search(key, held)

    return run


def _doubtful(key: tuple, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    """The sets of a group that bins do not rule out against all others."""
    g = _Group(key, rows, [np.frombuffer(r[4], np.uint8) for r in rows])
    hit = np.zeros(len(rows), bool)
    for i in range(len(rows) - 1):
        later = g.partners(i)
        hit[later] = True
        hit[i] |= len(later) > 0
    if hit.any():
        k = int(hit.sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(k, key[0])), pa.array(np.full(k, key[1], np.int32)), pa.array(np.full(k, key[2], np.int32)),
             pa.array(g.node[hit]), pa.array(g.of[hit]), pa.array(g.block[hit].astype(np.int32))],
            names=["run", "g1", "g2", "node", "of", "block"])


def _spanning(key: tuple, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Links between components of a group; a link joins the two, so at most one fewer than there are components."""
    sets = [np.frombuffer(r[4], np.uint64) for r in rows]
    g = _Group(key, rows, [set_bins(h) for h in sets])
    a, b = [], []
    for i in range(len(rows) - 1):
        for j in g.partners(i).tolist():
            if g.of[i] != g.of[j]:
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if DEN * both >= NUM * (len(sets[i]) + len(sets[j]) - both):
                    a.append(g.node[i])
                    b.append(g.node[j])
                    g.of[g.of == g.of[j]] = g.of[i]
    if a:
        yield pa.RecordBatch.from_arrays([pa.array(np.array(a, np.int64)), pa.array(np.array(b, np.int64))], names=["a", "b"])


# --- the join -----------------------------------------------------------------------------------------


def _salted(left: DataFrame, right: DataFrame, key: str, by: str, salts: int = 16) -> DataFrame:
    """``left`` with the row of ``right`` (one a key) if there is one; a hot key is dealt to ``salts`` tasks."""
    right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    left = left.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(salts)).cast("int"))
    return left.join(right, [key, "_salt"], "left").drop("_salt")


def similar_rows(docs: DataFrame) -> DataFrame:
    """node (the row's hash), id, n_shingles and component (the smallest node of similar texts) of every row.

    Links that would join texts already known to be in one component are not
    looked for; every other candidate is.
    """
    spark = common.prepare(docs.sparkSession)
    docs = _ids(docs)
    path = scratch_dir(spark, "partenum-sets")
    class_sets(docs, frequent_signatures(docs)).write.parquet(path)
    packed = spark.read.parquet(path)
    each = common.materialise(packed.select("doc_id", "id", "n_shingles", "key"), "partenum-docs")
    classes = common.materialise(each.filter("n_shingles > 0").groupBy("key").agg(
        F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("copies")), "partenum-classes")
    common.batch_rows(spark, 5_000)
    found = common.materialise(stars(packed, classes), "partenum-stars")
    common.batch_rows(spark)
    delete_path(spark, path, scratch_root(spark))  # the signatures are not needed again

    pairs = common.materialise(found.select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct(),
                               "partenum-pairs")
    bins = common.materialise(node_sets(docs, nodes_of(pairs), whole=False), "partenum-bins")
    pairs = common.materialise(possible(pairs, bins), "partenum-possible")
    sets = common.materialise(node_sets(docs, nodes_of(pairs), whole=True), "partenum-features")
    # Of the stars, first the one of each set with its smallest leader; then only what is still apart.
    first = common.materialise(links(pairs.groupBy("b").agg(F.min("a").alias("a")), sets), "partenum-links")
    second = common.materialise(links(_apart(pairs, components(first)), sets), "partenum-links")
    every = first.unionByName(second)
    groups = common.materialise(open_groups(found, components(every), bins), "partenum-groups")
    sets = common.materialise(node_sets(docs, groups.select("node").distinct(), whole=True), "partenum-features")
    third = common.materialise(spanning_links(groups, sets), "partenum-links")
    labels = components(every.unionByName(third))

    # Only rows of classes with copies or links meet a row; the rest are their own component.
    known = (classes.join(labels, "node", "left").filter("copies > 1 or component is not null")
             .select("key", F.coalesce("component", "node").alias("component")))
    own = (F.col("n_shingles") > 0) & F.col("component").isNotNull()
    return _salted(each, known, "key", "doc_id").select(
        F.col("doc_id").alias("node"), "id", "n_shingles",
        F.when(own, F.col("component")).otherwise(F.col("doc_id")).alias("component"))


def similar_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row: the smallest doc_id of what its document is linked to."""
    common.prepare(docs.sparkSession)
    found = common.materialise(similar_rows(docs), "partenum-components")
    linking = found.filter(f"n_shingles > 0 and id <> {NULL_ID}")
    # Texts of one doc_id in several components join these.
    several = linking.groupBy("id").agg(F.min("component").alias("a"), F.max("component").alias("b")).filter("a <> b")
    joined = components(linking.join(several.select("id", "a"), "id").select("a", F.col("component").alias("b")))
    least = (found.filter("n_shingles > 0").groupBy("component").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"))
             .join(joined.select(F.col("node").alias("component"), F.col("component").alias("whole")), "component", "left"))
    least = common.materialise(least.filter("n > 1 or whole is not null"), "partenum-least")
    wholes = least.filter("whole is not null").groupBy("whole").agg(F.min("least").alias("of_whole"))
    least = least.join(wholes, "whole", "left").select("component", F.coalesce("of_whole", "least").alias("least"))
    rows = _salted(found, least, "component", "node")
    out = F.when((F.col("n_shingles") > 0) & F.col("least").isNotNull(), F.col("least")).otherwise(F.col("id"))
    shown = lambda c: F.when(c != NULL_ID, c)
    return rows.select(shown(F.col("id")).alias("doc_id"), F.col("n_shingles").cast("long").alias("n_shingles"),
                       shown(out).alias("component_id"))


def keep_one_of_each(docs: DataFrame, one_row_an_id: bool = True) -> DataFrame:
    """``docs`` with one row of each group of similar texts: that of smallest doc_id, whatever its other rows.

    Rows of unlike texts all stay, also those without a doc_id; with
    ``one_row_an_id``, of the rows that stay each doc_id keeps one. Rows without
    a word are like no other, but one that repeats a doc_id and text goes. Only
    texts of rows that may have to go (told by a row filter of fixed size) are
    shuffled to meet the answer; all others go straight on.
    """
    common.prepare(docs.sparkSession)
    found = common.materialise(similar_rows(docs), "partenum-components")
    # Without words and without an id: no two of these are the same document.
    alone = (F.col("n_shingles") == 0) & (F.col("id") == NULL_ID)
    groups = found.groupBy("component").agg(F.min(F.struct("id", "node")).alias("stays"), F.count(F.lit(1)).alias("n"),
                                            F.max(alone).alias("alone"))
    groups = common.materialise(groups.select("stays.id", "stays.node", "n", "alone"), "partenum-kept")
    stays = groups
    if one_row_an_id:
        stays = groups.filter(f"id <> {NULL_ID}").groupBy("id").agg(F.min(F.struct("node", "alone")).alias("x")).select(
            "x.node", "x.alone").unionByName(groups.filter(f"id = {NULL_ID}").select("node", "alone"))
        stays = common.materialise(stays, "partenum-kept")
    staying = stays.select("node", F.lit(True).alias("stays"))
    going = found.select("node").distinct().join(staying, "node", "left").filter("stays is null").select("node")
    repeated = groups.filter("n > 1 and not alone").select("node")
    doubtful = docs.sparkSession.sparkContext.broadcast(common.row_filter(
        going.unionByName(repeated).select(common.filter_slot("node").alias("slot"))))

    def only(want: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hit = common.passes(doubtful.value, batch.column(0).to_numpy())
                yield batch.filter(pa.array(hit == want)).select(list(range(1, batch.num_columns)))
        return run

    slotted = docs.withColumn("_node", _row()).select(common.filter_slot("_node").alias("_slot"), *docs.columns)
    sure = slotted.mapInArrow(only(False), docs.schema)
    rows = slotted.mapInArrow(only(True), docs.schema).withColumn("_node", _row()).join(
        stays.select(F.col("node").alias("_node"), F.col("alone").alias("_alone")), "_node")
    rows = rows.withColumn("_each", F.when(F.col("_alone"), F.monotonically_increasing_id()))
    # Rows lie sorted by _node after the join, so this is one pass over them. Rows of one text and id are told apart by
    # their other columns as JSON, which gives an order to columns of any type.
    columns = [c for c in docs.columns if c != "text"]
    first = rows.groupBy("_node", "_each").agg(F.min_by(F.struct("text", *columns), F.to_json(F.struct(*columns))).alias("row"))
    return sure.unionByName(first.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns]))
