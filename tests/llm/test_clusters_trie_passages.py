"""Centroid clustering, prefix trie and repeated passages, held against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from edge import ROWS, clashing, documents

from tessera.llm import prefix_trie, suffix_dedup, zone_clusters

INF = float("inf")


# --- clustering -------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>"


def brute_clusters(rows, k, rounds, dims, seed="3"):
    kept = [(i, [max(-2**27, min(2**27, math.floor(1024 * float(np.float32(x))) if abs(x) < 1e30 else int(math.copysign(2**27, x))))
                 for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    text = lambda i: "" if i is None else str(i)
    cs = [v for _, v in sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{text(r[0])}".encode()).hexdigest(), r[1]))[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cs))

    for _ in range(rounds):
        of = [near(v)[1] for _, v in kept]
        cs = [[sum(col) // of.count(n) for col in zip(*[v for (_, v), o in zip(kept, of) if o == n])] if n in of else c
              for n, c in enumerate(cs)]
    last = [near(v) for _, v in kept]
    total = defaultdict(int)
    for d, n in last:
        total[n] += d
    big = lambda x: x if x < 2**63 else None
    return sorted(((i, n, d, big(total[n]), big(sum(total.values())), hashlib.sha256(",".join(map(str, cs[n])).encode()).hexdigest())
                   for (i, _), (d, n) in zip(kept, last)), key=repr)


def clusters(spark, rows, **kw):
    df = clashing(spark.createDataFrame(rows, VECTORS), "cluster", "salt", "place", "v")
    return sorted((tuple(r) for r in zone_clusters.cluster(df, **kw).collect()), key=repr)


def test_clusters_equal_brute_force_and_take_edge_rows(spark):
    rng = random.Random(4)
    spots = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, [x + rng.gauss(0, 0.2) for x in rng.choice(spots)]) for i in range(300)]
    rows += [(1000, spots[0])] * 200 + [(2000 + i, spots[1]) for i in range(150)]  # a repeated row, a repeated vector
    rows += [(None, spots[2]), (-5, spots[3]), (3000, None), (3001, []), (3002, [1.0] * 5), (3003, [1.0] * 7),
             (3004, [None] * 6), (3005, [float("nan")] + [0.0] * 5), (3006, [INF] + [0.0] * 5), (3007, [0.0] * 6)]
    assert clusters(spark, rows, k=4, rounds=5, dims=6) == brute_clusters(rows, 4, 5, 6)


def test_clusters_of_very_large_components_are_exact(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([-1, 1]) * rng.choice([1e4, 3.1e4, 1e38, 0.5]) for _ in range(3)]) for i in range(60)]
    assert clusters(spark, rows, k=3, rounds=4, dims=3) == brute_clusters(rows, 3, 4, 3)


def test_few_vectors_and_no_vectors(spark):
    rows = [(1, [0.5, -0.5]), (2, [0.1, 0.2])]
    assert clusters(spark, rows, k=8, rounds=3, dims=2) == brute_clusters(rows, 8, 3, 2)
    assert clusters(spark, [(1, None)], k=8, rounds=3, dims=2) == []
    assert zone_clusters.cluster(spark.createDataFrame([], VECTORS)).schema.names == [
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


@pytest.mark.parametrize("dims", [2, 3])
def test_hilbert_order_steps_to_neighbours(dims):
    grid = np.stack(np.meshgrid(*[np.arange(4)] * dims), -1).reshape(-1, dims)
    keys = [k.tobytes() for k in zone_clusters.hilbert_keys(grid, 2)]
    assert len(set(keys)) == len(grid)
    walk = grid[np.array(sorted(range(len(keys)), key=keys.__getitem__))]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_a_box_never_loses_the_nearest_centroid():
    rng = np.random.default_rng(6)
    for _ in range(300):
        m, c = rng.integers(-20, 20, (8, 3)), rng.integers(-20, 20, (5, 3))
        may = zone_clusters.candidates(m.min(0), m.max(0), c)
        best, distance = zone_clusters.nearest(m, c[may])
        want, far = zone_clusters.nearest(m, c)
        assert (may[best] == want).all() and (distance == far).all()


# --- trie -------------------------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string"


def brute_trie(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            by[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(k[2], k[3]) for k in sorted(v)] for c, v in by.items()}
    members, ends, below = defaultdict(list), defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        path = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    for p in members:
        if p:
            below[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=lambda p: -len(p)):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = sum(leaves[k] for k in below[p]) or 1
        saved[p] = (len(members[p]) - 1) * words + sum(saved[k] for k in below[p])
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(below[p]), leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items()), key=repr)


def conversations(seed):
    rng = random.Random(seed)
    rows = [(c, rng.choice([t, t, t, None, 0]), rng.choice(["user", "assistant", None]), rng.choice(["a", "b c", "x  y\tz", "", None, "é 中"]))
            for c in [*range(200), -1, -25, -40]
            for t in range(rng.choice([0, 1, 1, 2, 3, 5, 8, 40 if c % 50 == 0 else 2]))]
    rows += [(5000 + i, 0, "user", "the same") for i in range(300)]  # one node ends a third of all
    rows += [(6000 + i, j, "user", f"deep {j}") for i in range(3) for j in range(100 + i)]
    return rows + [(None, 1, "user", "x")]


@pytest.mark.parametrize("piece", [1, 9, 100, prefix_trie.PIECE])
def test_trie_equals_brute_force_in_pieces_of_any_size(spark, piece, monkeypatch):
    monkeypatch.setattr(prefix_trie, "RUN", 7)
    rows = conversations(piece)
    df = clashing(spark.createDataFrame(rows, TURNS), "path", "words", "node", "family")
    got = prefix_trie.prefix_trie(prefix_trie.rebuilt(df), piece).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_trie(rows)


def test_trie_of_nothing(spark):
    assert prefix_trie.prefix_trie(prefix_trie.rebuilt(spark.createDataFrame([], TURNS))).collect() == []


def test_radix_nodes_keep_all_children_through_every_layout():
    rng = random.Random(1)
    root = prefix_trie.Node(b"", [0])
    keys = {bytes([rng.randrange(256), *rng.choices(b"ab", k=rng.randint(0, 5))]) for _ in range(900)}
    for n, k in enumerate(sorted(keys)):
        prefix_trie.insert(root, k, [0], n)
    assert root.size == 256

    def walk(node, above):
        at = above + node.path
        return [(at, n) for n in node.ids] + [x for k in node.children() for x in walk(k, at)]

    assert sorted(walk(root, b"")) == [(k, n) for n, k in enumerate(sorted(keys))]
    assert {len(k.kids) <= k.size for k in root.children()} == {True}


# --- repeated passages ------------------------------------------------------------------------------


def brute_passages(texts, size, keep_first):
    where, data = defaultdict(list), [(t or "").encode() for t in texts]
    for d, b in enumerate(data):
        for p in range(len(b) - size + 1):
            where[b[p: p + size]].append((d, p))
    gone = [bytearray(len(b)) for b in data]
    for v in where.values():
        if len(v) > 1:
            for d, p in sorted(v)[1:] if keep_first else v:
                gone[d][p: p + size] = b"\1" * size
    return [(bytes(x for x, g in zip(b, c) if not g), len([x for x in c.split(b"\0") if x])) for b, c in zip(data, gone)]


def corpus(seed):
    rng = random.Random(seed)
    some = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    shared = [some(rng.randint(15, 90)) for _ in range(6)]
    out = [None if rng.random() < 0.05 else
           "".join(rng.choice([rng.choice(shared), some(rng.randint(0, 40)), rng.choice(shared)[5:], "a" * rng.randint(0, 50)])
                   for _ in range(rng.randint(0, 8))) for _ in range(50)]
    return [*out, out[3], out[3], "x" * 300]


@pytest.mark.parametrize("seed,size,group", [(1, 20, 2048), (2, 33, 2), (3, 64, 1), (4, 24, 3)])
@pytest.mark.parametrize("keep_first", [False, True])
def test_passages_equal_brute_force(spark, seed, size, group, keep_first, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLICE", 64 if seed % 2 else 1 << 18)
    texts = corpus(seed)
    df = clashing(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1), "base", "spans", "kept")
    got = {r["doc_id"]: (bytes(r["kept"]), len(r["spans"]))
           for r in suffix_dedup.dedup_passages(df, size, keep_first, group).collect()}
    assert [got[i] for i in range(len(texts))] == brute_passages(texts, size, keep_first)


def test_previous_factors_equal_brute_force():
    rng = random.Random(1)
    for _ in range(100):
        text, limit = bytes(rng.choice(b"ab") for _ in range(60)), rng.choice([8, 9, 16, 20, 25])
        starts = np.array(sorted(rng.sample(range(60 - limit + 1), rng.randint(1, 60 - limit + 1))))
        address = np.array(rng.sample(range(1000), len(starts)))
        lpf, source = suffix_dedup.previous_factors(np.frombuffer(text, np.uint8), starts, address, limit)
        for i, s in enumerate(starts):
            match = lambda t: next((n for n in range(limit) if text[s + n] != text[t + n]), limit)
            assert lpf[i] == max([match(t) for t, a in zip(starts, address) if a < address[i]], default=0)
            if lpf[i]:
                assert address[source[i]] < address[i] and match(starts[source[i]]) == lpf[i]


def test_passages_take_edge_rows(spark):
    got = suffix_dedup.dedup_passages(clashing(documents(spark), "base", "at"), 200, False).collect()
    assert sorted(r["doc_id"] or 0 for r in got) == sorted(r[0] or 0 for r in ROWS)
    kept = {r["doc_id"]: bytes(r["kept"]) for r in got if r["doc_id"] not in (6, 7)}
    assert kept[4] == kept[5] == b"" and kept[1] == b"" and kept[8] == b" \t\n "
    assert suffix_dedup.dedup_passages(documents(spark, []), 200).collect() == []
    with pytest.raises(ValueError):
        suffix_dedup.dedup_passages(documents(spark), 7)
