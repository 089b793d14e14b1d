"""Prefix trie of conversations, built from adaptive radix trees.

A turn's id is the first 16 bytes of the sha256 of its role and text, so a
conversation is a string of fixed-width big-endian ids and a trie node a
prefix whose length is a multiple of that width. Strings are range-partitioned
in byte order (equal ones by conversation); each task cuts its sorted strings
into pieces of bounded size and builds one adaptive radix tree a piece: edges
hold whole byte runs (path compression), children lie in a sorted, an indexed
or a direct layout that is resized as they grow, and only byte depths that are
turn-aligned emit nodes.

A node can lie in several pieces only if it is a prefix of a piece's first or
last string. These open nodes (at most two paths a piece) leave the task as
partial rows and are merged by their path's digest; sums over their subtrees
double the distance to an ancestor each round, so a path of any length takes a
logarithm of rounds and no task holds a whole subtree. All other nodes are
final where they are found. Members that end in an open node leave as runs of
ids, and the digest streams them in order.

Rows and edge cases: turns are ordered by turn (null first), role, text; null
roles and texts are empty; a repeated row is a turn of its own. Rows without a
conv_id belong to no conversation and are left out. ``%`` keeps the sign of a
negative conv_id. An empty table gives no node. Other columns are not read.
One conversation is one string: its turns meet in one row, whose size is that
of its ids and not of its texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import common

#: Bytes of a turn id.
WIDTH = 16
#: Turns (conversations, if shorter) of one piece: a radix tree of some tens of MB.
PIECE = 1 << 15
#: Ids of one run of members.
RUN = 1 << 14
#: Words are what lies between these.
SPACE = r"[\x20\x09-\x0D]+"

FINAL = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
_NO_ENDS = hashlib.sha256(b"").hexdigest()


# --- conversations as strings of turn ids ---------------------------------------------------------


def rebuilt(turns: DataFrame, family: int = 20, shared: int = 4) -> DataFrame:
    """(conv_id, path binary, words array<int>) of every conversation, its head taken from its family's first.

    Conversation c starts with the first h turns of c - c % family, where
    h = crc32(c) % shared, and goes on with its own turns after its first h.
    One shuffle, by family, serves the order, the collection and the exchange
    of heads.
    """
    own = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    own = own.withColumn("family", F.col("conv_id") - F.col("conv_id") % family)
    own = own.repartition(common.n_partitions(turns.sparkSession), "family")
    order = Window.partitionBy("family", "conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    name = F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    own = own.select("family", "conv_id", F.struct(
        F.row_number().over(order).alias("pos"),
        F.substring(F.sha2(name.cast("binary"), 256), 1, 2 * WIDTH).alias("id"),
        F.size(F.filter(F.split("text", SPACE), lambda w: w != "")).alias("words")).alias("turn"))
    whole = own.groupBy("family", "conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    head = F.max(F.when(F.col("conv_id") == F.col("family"), F.slice("turns", 1, shared - 1))).over(Window.partitionBy("family"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared).cast("int")
    whole = whole.withColumns({"head": head, "h": h})
    empty = F.slice("turns", 1, 0)
    whole = whole.withColumn("turns", F.concat(
        F.slice(F.coalesce("head", empty), F.lit(1), F.col("h")), F.slice("turns", F.col("h") + 1, F.size("turns"))))
    return whole.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), "")).alias("path"),
                        F.transform("turns", lambda t: t["words"]).alias("words"))


# --- the radix tree of one piece ------------------------------------------------------------------


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low + 1 < high:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class Node:
    """An edge's bytes, the children by next byte, and the conversations that end here.

    Children lie in a sorted list of at most 4, then 16 bytes; beyond it a
    table of 256 slots points into a list of at most 48; beyond that the table
    holds the children themselves.
    """

    __slots__ = ("path", "words", "ids", "size", "bytes", "slots", "kids")

    def __init__(self, path: bytes, words, ids: list[int] | None = None):
        self.path, self.words, self.ids = path, words, ids or []
        self.size, self.bytes, self.slots, self.kids = 4, bytearray(), None, []

    def find(self, byte: int):
        if self.size <= 16:
            at = self.bytes.find(byte)
            return self.kids[at] if at >= 0 else None
        if self.size == 48:
            at = self.slots[byte]
            return self.kids[at - 1] if at else None
        return self.kids[byte]

    def put(self, byte: int, kid: Node) -> None:
        """Set the child of ``byte``, in a larger layout if this one is full."""
        if self.size <= 16:
            at = self.bytes.find(byte)
            if at >= 0:
                self.kids[at] = kid
                return
            if len(self.kids) < self.size:
                at = sum(b < byte for b in self.bytes)
                self.bytes.insert(at, byte)
                self.kids.insert(at, kid)
                return
            if self.size == 4:
                self.size = 16
            else:
                self.size, self.slots = 48, bytearray(256)
                for at, b in enumerate(self.bytes):
                    self.slots[b] = at + 1
            self.put(byte, kid)
        elif self.size == 48:
            if self.slots[byte]:
                self.kids[self.slots[byte] - 1] = kid
            elif len(self.kids) < 48:
                self.kids.append(kid)
                self.slots[byte] = len(self.kids)
            else:
                self.size, self.kids = 256, [self.kids[s - 1] if s else None for s in self.slots]
                self.kids[byte] = kid
        else:
            self.kids[byte] = kid

    def children(self) -> list[Node]:
        return [k for k in self.kids if k is not None]


def insert(root: Node, key: bytes, words, conv: int) -> None:
    node, above, at = root, None, 0
    while True:
        same = len(node.path) if key.startswith(node.path, at) else _common(node.path, key[at: at + len(node.path)])
        if same < len(node.path):  # the edge splits
            upper = Node(node.path[:same], node.words)
            above.put(upper.path[0], upper)
            node.path = node.path[same:]
            upper.put(node.path[0], node)
            node = upper
        at += same
        if at == len(key):
            node.ids.append(conv)
            return
        kid = node.find(key[at])
        if kid is None:
            node.put(key[at], Node(key[at:], words, [conv]))
            return
        above, node = node, kid


def _digests(key: bytes) -> list[bytes]:
    """Digest of each turn-aligned prefix of ``key``, the empty one first."""
    running = hashlib.blake2b(digest_size=16)
    out = [running.digest()]
    for i in range(0, len(key), WIDTH):
        running.update(key[i: i + WIDTH])
        out.append(running.copy().digest())
    return out


class Rows:
    """What a piece emits: final nodes, parts of open nodes, runs of members of open nodes."""

    def __init__(self):
        self.final: list[list] = []
        self.open: list[tuple] = []
        self.runs: list[tuple] = []


def emit(root: Node, first: bytes, last: bytes) -> Rows:
    """All nodes of the tree, children before parents. Prefixes of ``first`` and ``last`` are open."""
    out, sides = Rows(), [(first, _digests(first)), (last, _digests(last))]
    # in order: node, byte depth of its top, bytes below it shared with each side (-1: left that side before)
    order, stack = [], [(root, 0, 0, (True, True))]
    while stack:
        node, top, up, on = stack.pop()
        shared = [_common(node.path, key[top: top + len(node.path)]) if o else -1 for (key, _), o in zip(sides, on)]
        order.append((node, top, shared))
        still = tuple(s == len(node.path) for s in shared)
        at = len(order) - 1
        stack.extend((k, top + len(node.path), at, still) for k in node.children())
    state: dict[int, tuple] = {}  # by node: members, least conv, children, leaves, saved, rows whose parent is above
    for node, top, shared in reversed(order):
        members, least = len(node.ids), node.ids[0] if node.ids else None
        children = leaves = saved = 0
        waiting: list[list] = []
        for kid in node.children():
            m, low, c, n, s, rows = state.pop(id(kid))
            members, children, leaves, saved = members + m, children + c, leaves + n, saved + s
            least = low if least is None or low < least else least
            waiting = rows if not waiting else waiting + rows if len(rows) > 64 else (waiting.extend(rows) or waiting)
        bottom = top + len(node.path)
        for depth in range(bottom // WIDTH, (top // WIDTH if top or node.path else -1), -1):
            ends = node.ids if depth * WIDTH == bottom else []
            words = int(node.words[depth - 1]) if depth else 0
            side = next((i for i in (0, 1) if 0 <= depth * WIDTH - top <= shared[i]), None)
            if side is not None:
                names = sides[side][1]
                above = names[depth - 1] if depth else None
                out.open.append((names[depth], above, depth, least, members, words, children, leaves, saved))
                for i in range(0, len(ends), RUN):
                    out.runs.append((names[depth], ends[i], ",".join(map(str, ends[i: i + RUN]))))
                for row in waiting:
                    row[8] = names[depth]
                children, leaves, saved, waiting = 0, 0, 0, []
            else:
                leaves = leaves or 1
                saved += (members - 1) * words
                sha = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest() if ends else _NO_ENDS
                row = [least, depth, None, members, children, leaves, saved, sha, None]
                for r in waiting:
                    r[2] = least
                out.final.append(row)
                children, waiting = 1, [row]
        state[id(node)] = (members, least, children, leaves, saved, waiting)
    return out


_KINDS = pa.schema([
    ("kind", pa.int32()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()),
    ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
    ("ends_sha256", pa.string()), ("node", pa.binary()), ("above", pa.binary()), ("words", pa.int64()), ("ids", pa.string())])
_KINDS_DDL = ("kind int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
              "saved_tokens long, ends_sha256 string, node binary, above binary, words long, ids string")


def _batch(rows: Rows) -> pa.RecordBatch:
    lines = [(0, r[0], r[1], r[2], r[3], r[4], r[5], r[6], r[7], None, r[8], None, None) for r in rows.final]
    lines += [(1, low, depth, None, n, c, leaves, saved, None, node, above, words, None)
              for node, above, depth, low, n, words, c, leaves, saved in rows.open]
    lines += [(2, low, None, None, None, None, None, None, None, node, None, None, ids) for node, low, ids in rows.runs]
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*lines), _KINDS)], schema=_KINDS)


def trees(batches: Iterator[pa.RecordBatch], piece: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Nodes of the sorted strings of a task, piece by piece."""
    root, first, last, load = None, b"", b"", 0
    for b in batches:
        words = b.column("words")
        for r, (conv, key) in enumerate(zip(b.column("conv_id").to_pylist(), b.column("path").to_pylist())):
            cost = max(1, len(key) // WIDTH)
            if root is not None and load + cost > piece:
                yield _batch(emit(root, first, last))
                root = None
            counts = words[r].values.to_numpy(zero_copy_only=False)
            if root is None:
                root, first, load = Node(b"", counts), key, 0
            insert(root, key, counts, conv)
            last, load = key, load + cost
    if root is not None:
        yield _batch(emit(root, first, last))


# --- nodes that several pieces share --------------------------------------------------------------


def _digest_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """sha256 of the runs of each node, which come in order."""
    node, running = None, None
    for b in batches:
        done = []
        for name, ids in zip(b.column("node").to_pylist(), b.column("ids").to_pylist()):
            if name != node:
                if running is not None:
                    done.append((node, running.hexdigest()))
                node, running = name, hashlib.sha256(ids.encode())
            else:
                running.update(b"," + ids.encode())
        if done:
            yield pa.record_batch([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done])], ["node", "ends"])
    if running is not None:
        yield pa.record_batch([pa.array([node], pa.binary()), pa.array([running.hexdigest()])], ["node", "ends"])


def _merged(parts: DataFrame) -> DataFrame:
    """Open nodes, whole: their subtrees summed over all pieces."""
    n = common.n_partitions(parts.sparkSession)
    runs = parts.filter("kind = 2").select("node", "conv_id", "ids")
    ends = runs.repartition(n, "node").sortWithinPartitions("node", "conv_id").select("node", "ids") \
        .mapInArrow(_digest_runs, "node binary, ends string")
    nodes = parts.filter("kind = 1").groupBy("node").agg(
        F.min("above").alias("above"), F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"), F.max("words").alias("words"),
        *[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")])
    nodes = common.materialise(nodes, "trie-open")
    below = nodes.filter("above is not null").groupBy(F.col("above").alias("node")).agg(F.count(F.lit(1)).alias("open"))
    nodes = nodes.join(below, "node", "left").join(ends, "node", "left").select(
        "node", "above", "depth", "conv_id", "n_convs", (F.col("n_children") + F.coalesce("open", F.lit(0))).alias("n_children"),
        F.col("above").alias("far"), "n_leaves",
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
        F.coalesce("ends", F.lit(_NO_ENDS)).alias("ends_sha256"))
    nodes = nodes.withColumn("n_leaves", F.col("n_leaves") + (F.col("n_children") == 0).cast("long"))
    nodes = common.materialise(nodes, "trie-open")
    reach, deepest = 1, nodes.agg(F.max("depth")).first()[0] or 0
    while reach <= deepest:  # sums reach descendants nearer than ``reach``; far is the ancestor at that distance
        more = nodes.filter("far is not null").groupBy(F.col("far").alias("node")).agg(
            F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"))
        on = nodes.select(F.col("node").alias("far"), F.col("far").alias("farther"))
        nodes = common.materialise(nodes.join(more, "node", "left").join(on, "far", "left").select(
            "node", "above", "depth", "conv_id", "n_convs", "n_children", F.col("farther").alias("far"),
            (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"), "ends_sha256"), "trie-open")
        reach *= 2
    return nodes


def prefix_trie(strings: DataFrame, piece: int = PIECE) -> DataFrame:
    """All nodes of the trie over ``strings`` (conv_id, path, words): one row a node, see ``FINAL``."""
    spark = common.prepare(strings.sparkSession)
    strings = common.materialise(strings, "trie-strings")
    ordered = strings.repartitionByRange(common.n_partitions(spark), "path", "conv_id").sortWithinPartitions("path", "conv_id")
    parts = common.materialise(ordered.mapInArrow(lambda batches: trees(batches, piece), _KINDS_DDL), "trie-nodes")
    merged = _merged(parts)
    names = merged.select(F.col("node").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    inner = parts.filter("kind = 0 and above is null").select(*FINAL)
    edge = parts.filter("kind = 0 and above is not null").drop("parent_conv_id").join(names, "above").select(*FINAL)
    shared = merged.join(names, "above", "left").select(*FINAL)
    return inner.unionByName(edge).unionByName(shared)
