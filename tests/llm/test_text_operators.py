"""Fingerprints, line dedup, decontamination and token files against plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from edge import LONG, ROWS, clashing, documents, rows

from tessera.llm import common, decontam, line_dedup, syncmers, token_store
from tessera.session import scratch_dir

public_tokenizers = pytest.importorskip("public_tokenizers")
BPE = public_tokenizers.path("word_bpe_49k.json")


def in_order():
    return sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))


# --- closed syncmers ----------------------------------------------------------------------------


def brute_closed(text):
    """Closed syncmers by the definition, one k-mer after another."""
    k, s, out = syncmers.K, syncmers.S, []
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)

    def smer(i):
        h = common.mix(points[i: i + s].astype(np.uint64) + np.uint64(1))
        while len(h) > 1:
            h = common.join_hash(h[::2], h[1::2])
        return int(h[0])

    for i in range(len(points) - k + 1):
        inner = [smer(j) for j in range(i, i + k - s + 1)]
        if min(inner) in (inner[0], inner[-1]):
            out.append(i)
    return out


def test_closed_syncmers_by_definition():
    rng = random.Random(2)
    for _ in range(5):
        text = "".join(rng.choice("ab cé") for _ in range(rng.randint(0, 120)))
        at, _ = syncmers._closed(np.frombuffer(text.encode("utf-32-le"), np.uint32))
        assert at.tolist() == brute_closed(text)


def test_anchors_do_not_depend_on_windows_or_neighbours(monkeypatch):
    texts = [LONG[:5000], "", "short", LONG[2000:9000], "x" * 300]
    whole = [syncmers.anchors(*common.code_points(pa.array([t])))[0].tolist() for t in texts]
    together = [a.tolist() for a in syncmers.anchors(*common.code_points(pa.array(texts)))]
    assert together == whole
    monkeypatch.setattr(syncmers, "WINDOW", 1000)
    assert [a.tolist() for a in syncmers.anchors(*common.code_points(pa.array(texts)))] == whole


def test_fingerprints_follow_the_next_document(spark):
    got = syncmers.fingerprints(clashing(documents(spark), "fingerprint", "bucket"))
    order = in_order()
    expected = []
    for row, following in zip(order, order[1:] + order[:1]):
        text, after = row[1] or "", following[1] or ""
        new = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        expected.append((row[0], len(text), hashlib.sha256(new.encode()).hexdigest()))
    assert rows(got, "doc_id", "n_chars", "edited_sha256") == sorted(expected, key=repr)
    by = {(r.doc_id, r.n_chars): r for r in got.collect()}
    assert by[4, len(LONG)].fingerprint == by[5, len(LONG)].fingerprint and by[4, len(LONG)].near_next == 1.0
    assert by[2, 0].fingerprint == "" and 0.35 < by[5, len(LONG)].near_edited < 1
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in by.values())
    assert syncmers.fingerprints(documents(spark, [])).count() == 0
    one = syncmers.fingerprints(documents(spark, ROWS[5:6])).first()
    assert one.near_next == 1.0


def test_a_passage_is_seen_in_a_text_of_any_length():
    rng = random.Random(11)
    some = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = some(2000)
    texts = [some(500_000) + passage + some(500_000), some(300) + passage, some(2300)]
    long, short, other = syncmers.anchors(*common.code_points(pa.array(texts)))
    assert len(long) > 5000 and len(set(long.tolist()) & set(short.tolist())) >= 5
    assert not set(long.tolist()) & set(other.tolist())
    edited = texts[0][:700_000] + some(1000) + texts[0][700_000:]
    near, = syncmers.anchors(*common.code_points(pa.array([edited])))
    assert 0.99 < syncmers.likeness(long, near) < 1
    assert syncmers.likeness(long, other) < 0.01


def test_likeness_tells_edits_from_strangers():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    a, b = (" ".join(word() for _ in range(800)) for _ in range(2))
    sketch = lambda t: syncmers.anchors(*common.code_points(pa.array([t])))[0]
    assert syncmers.likeness(sketch(a), sketch(b)) < 0.05
    assert 0.3 < syncmers.likeness(sketch(a), sketch(syncmers.edited(a, b))) < 0.7
    assert syncmers.likeness(sketch(a), sketch(a.replace(a[1000:1010], "z" * 10))) > 0.9


# --- lines ---------------------------------------------------------------------------------------


def brute_lines(docs, min_docs, min_chars, keep_first):
    space = " \t\n\x0b\x0c\r"
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(space))
    holders, first = {}, {}
    split = [(d, (t or "").split("\n")) for d, t in docs]
    for d, lines in split:
        for i, line in enumerate(lines):
            holders.setdefault(key(line), set()).add(d)
            at = (d is not None, d or 0, i)
            first[key(line)] = min(first.get(key(line), at), at)
    out = []
    for d, lines in split:
        gone = [len(key(x)) >= min_chars and len(holders[key(x)]) >= min_docs
                and not (keep_first and first[key(x)] == (d is not None, d or 0, i)) for i, x in enumerate(lines)]
        out.append((d, "\n".join(x for x, g in zip(lines, gone) if not g), len(lines), sum(gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("keep_first", [False, True])
def test_line_dedup_against_brute_force(spark, keep_first):
    rng = random.Random(4)
    lines = ["License X", "license x ", "\tLICENSE X\r", "É", "é", "", " ", "a", "unique"]
    docs = [(i, "\n".join(rng.choice(lines + [f"line {i} {j}"]) for j in range(rng.randint(0, 150)))) for i in range(30)]
    docs += [(r[0], r[1]) for r in ROWS] + [(77, None), (78, "")]
    df = clashing(spark.createDataFrame(docs, "doc_id long, text string"), "n_lines", "keep", "line", "pos", "key")
    got = line_dedup.dedup_lines(df, min_docs=5, min_chars=1, keep_first=keep_first)
    assert set(df.columns) <= set(got.columns)
    assert rows(got, "doc_id", "text", "n_lines", "n_dropped") == brute_lines(docs, 5, 1, keep_first)
    assert line_dedup.dedup_lines(spark.createDataFrame([], df.schema)).count() == 0


# --- decontamination -----------------------------------------------------------------------------


def brute_hits(text, items, window):
    words = decontam.ITEM_WORD.findall(decontam.ascii_lower(text))
    hit, seen = set(), set()
    for k, (_, item) in enumerate(items):
        own = decontam.ITEM_WORD.findall(decontam.ascii_lower(item))
        n = min(len(own), window)
        grams = {tuple(own[i: i + n]) for i in range(len(own) - n + 1)} if own else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i: i + n]) in grams:
                hit.update(range(i, i + n))
                seen.add(k)
    return len(words), len(hit), seen


def test_automaton_against_brute_force():
    rng = random.Random(1)
    for _ in range(150):
        words = ["a", "b", "C", "é", "1x"][: rng.randint(2, 5)]
        items = [(str(i), " ".join(rng.choice(words) for _ in range(rng.randint(0, 9)))) for i in range(rng.randint(0, 5))]
        items = [x for x in items if x[1]]
        texts = ["".join(rng.choice(words + ["Q"]) + rng.choice([" ", ", ", "\n"]) for _ in range(rng.randint(0, 30)))
                 for _ in range(6)] + ["", "a", "ab"]
        window = rng.choice([2, 3, 4])
        automaton = decontam.Automaton(items, window)
        for text, (n, spans, in_bytes, found) in zip(texts, decontam.find(pa.array(texts), automaton)):
            assert (n, sum(b - a for a, b in spans), found) == brute_hits(text, items, window)
            for (a, b), (x, y) in zip(spans, in_bytes):
                assert len(decontam.ITEM_WORD.findall(decontam.ascii_lower(text.encode()[x:y].decode()))) == b - a


def test_report_and_removal(spark):
    passage = " ".join(f"w{i}" for i in range(12))
    bench = spark.createDataFrame([(1, passage), (2, "tiny item"), (3, None), (4, ""), (None, "Tiny, ITEM")],
                                  "item_id long, text string")
    automaton = decontam.build(bench)
    docs = documents(spark, ROWS + [(20, f"{'clean ' * 30}{passage.upper()} end", "en", "s", 1), (21, passage, "en", "s", 1),
                                    (22, "a TINY-item here", "en", "s", 1), (23, " ".join(passage.split()[:9]), "en", "s", 1)])
    got = {r.doc_id: r for r in decontam.report(clashing(docs, "n_words"), automaton).collect()}
    assert (got[20].n_hit, got[20].n_items, got[21].n_hit, got[23].n_hit) == (12, 1, 12, 0)
    assert got[22].n_items == 2 and got[22].items_sha256 == hashlib.sha256(b",2").hexdigest()
    assert (got[1].n_words, got[1].contaminated, got[1].items_sha256) == (0, False, hashlib.sha256(b"").hexdigest())
    cleaned = {r.doc_id: r.text for r in decontam.decontaminate(docs, automaton).collect()}
    assert 21 not in cleaned and cleaned[20].split() == ["clean"] * 30 + ["end"] and cleaned[23] == " ".join(passage.split()[:9])
    untouched = [r for r in ROWS if r[0] is not None]
    assert all(cleaned[r[0]] is not None or r[1] is None for r in untouched)
    assert decontam.decontaminate(documents(spark, []), automaton).count() == 0
    nothing = decontam.build(spark.createDataFrame([], "item_id long, text string"))
    assert decontam.decontaminate(docs, nothing).count() == docs.count()


def test_parts_of_a_benchmark_report_what_one_automaton_does(spark):
    rng = random.Random(8)
    words = ["a", "b", "C", "é", "1x"]
    items = [(str(i) if i else None, " ".join(rng.choice(words) for _ in range(rng.randint(0, 14)))) for i in range(40)]
    bench = spark.createDataFrame([*items, ("twice", items[5][1]), ("twice", items[5][1])], "item_id string, text string")
    items = [(i or "", t) for i, t in [*items, ("twice", items[5][1]), ("twice", items[5][1])]]
    texts = [" ".join(rng.choice(words + ["Q"]) for _ in range(rng.randint(0, 40))) for _ in range(60)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_hit string")
    for part_bytes in (1 << 20, 200, 60):
        parts = decontam.build(bench, 4, part_bytes)
        got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in decontam.report(docs, parts).collect()}
        for i, t in enumerate(texts):
            n, hit, seen = brute_hits(t, items, 4)
            names = ",".join(sorted(items[k][0] for k in seen))
            assert got[i] == (n, hit, len(seen), hashlib.sha256(names.encode()).hexdigest())
        cut = decontam.decontaminate(docs, parts, 1.0).orderBy("doc_id").collect()
        assert [len(r.text.split()) for r in cut] == [got[r.doc_id][0] - got[r.doc_id][1] for r in cut] and len(cut) == len(texts)
        assert cut[0].n_hit == "x"


def test_an_item_of_one_word_many_times_is_built_in_linear_time():
    import time

    began = time.time()
    automaton = decontam.Automaton([("long", "again " * 60_000)])
    assert time.time() - began < 20
    (n, spans, _, items), = decontam.find(pa.array(["x " + "again " * 30]), automaton)
    assert (n, spans, items) == (31, [(1, 31)], {0})


# --- token files ---------------------------------------------------------------------------------


def test_packing_round_trip():
    rng = random.Random(0)
    for width in (1, 5, 15, 16, 17, 31, 32):
        for n in (0, 1, 63, 64, 65, 1000):
            ids = np.array([rng.getrandbits(width) for _ in range(n)], np.uint32)
            assert (token_store.unpack(token_store.pack(ids, width), width, n) == ids).all()


def test_random_access_reads_any_range(tmp_path, monkeypatch):
    monkeypatch.setattr(token_store, "BLOCK", 256)
    rng = np.random.default_rng(0)
    ids, sizes = rng.integers(0, 49408, 3000).astype(np.uint32), np.array([10, 0, 1990, 1000])
    with common.open_output(f"{tmp_path}/a.bin") as sink:
        writer = token_store.Writer(sink, 16)
        writer.add([5, None], ids[:10], sizes[:2])
        writer.add([7, 8], ids[10:], sizes[2:])
        writer.close()
    with common.open_input(f"{tmp_path}/a.bin") as file:
        reader = token_store.Reader(file)
        assert reader.null.tolist() == [False, True, False, False] and reader.ends.tolist() == [10, 10, 2000, 3000]
        for a, b in [(0, 3000), (0, 0), (255, 257), (300, 1999), (2999, 3000)]:
            assert (reader.ids(a, b) == ids[a:b]).all()


def test_word_encoder_equals_the_tokenizer(monkeypatch):
    from tokenizers import Tokenizer

    spec = token_store.word_tokenizer_spec(BPE)
    tokenizer, encoder = Tokenizer.from_str(spec.decode()), token_store.WordEncoder(spec)
    texts = ["", None, "a<|endoftext|>b. Ünï İstanbul ΣΑΣ. é x y it's don't! \x1c z 中文。 ok.!?, ...\t\ttab\r\nq", "I'LL we're 12a3.",
             "<|startoftext|>.", "ǅ ß. ﬁ", "!", ".,", " ", "a×b ÷ Ǆ. é. ́", LONG]
    for cap in (1_000_000, 5):
        monkeypatch.setattr(token_store, "CACHE_PIECES", cap)
        for _ in range(2):
            ids, sizes = encoder.encode(pa.array(texts))
            got = [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
            assert got == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_word_encoder_on_every_latin_letter_before_signs():
    import random

    from tokenizers import Tokenizer

    spec = token_store.word_tokenizer_spec(BPE)
    tokenizer, encoder = Tokenizer.from_str(spec.decode()), token_store.WordEncoder(spec)
    letters = [chr(c) for c in range(0xC0, 0x250)]
    texts = [f"{word}{sign}" for c in letters for word in (c, f"ab{c}", f"{c}ab") for sign in (".", ",", "!", "!!", ".,!", "  é…")]
    rng = random.Random(9)
    texts += ["".join(rng.choice([*rng.sample(letters, 5), "İ", "i", "A", "\u0307", " ", ".", ",", "!", "\n", "…", "1"])
                      for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    ids, sizes = encoder.encode(pa.array(texts))
    got = [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
    assert got == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


WIDE = [-(2**63), 2**63 - 1, -(2**63) + 1, 0, 2**62, -(2**62)]


def heavy_rows(kind):
    some = lambda i: f"text {i * 7919 % 1000} of many"
    if kind == "wide":
        return [(w, some(i)) for i, w in enumerate(WIDE)] + [(i, some(i)) for i in range(200)]
    if kind == "outlier":
        return [(i, some(i)) for i in range(300)] + [(10**18, "far")]
    if kind == "one id":
        return [(5, some(i)) for i in range(200)] + [(i, some(i)) for i in range(100)]
    if kind == "one row":
        return [(5, "the same")] * 200 + [(i, some(i)) for i in range(100)]
    return [(None, some(i)) for i in range(300)]


@pytest.mark.parametrize("kind", ["wide", "outlier", "one id", "one row", "no id"])
def test_buckets_keep_the_order_and_share_the_load(spark, kind):
    from pyspark.sql import functions as F

    data = heavy_rows(kind)
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = df.withColumn("b", common.ordered_buckets(df, "doc_id", "text", 8)).collect()
    order = lambda r: (r.doc_id is not None, r.doc_id or 0, r.text.encode())
    in_buckets = sorted(got, key=lambda r: (r.b, *order(r)))
    assert [order(r) for r in in_buckets] == sorted(map(order, got)) and len(got) == len(data)
    assert max(sum(r.b == b for r in got) for b in range(8)) < len(data) / 3
    assert df.agg(F.count("*")).first()[0] == len(data)


@pytest.mark.parametrize("kind", ["wide", "one row", "no id"])
def test_fingerprints_and_files_of_heavy_and_wide_ids(spark, kind):
    from tokenizers import Tokenizer

    data = sorted(heavy_rows(kind), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    df = spark.createDataFrame(data[::-1], "doc_id long, text string")
    expected = [(d, len(t), hashlib.sha256(syncmers.edited(t, f[1]).encode()).hexdigest())
                for (d, t), f in zip(data, [*data[1:], data[0]])]
    assert rows(syncmers.fingerprints(df), "doc_id", "n_chars", "edited_sha256") == sorted(expected, key=repr)
    tokenizer, start, want = Tokenizer.from_file(BPE), 0, []
    for d, t in data:
        ids = np.array(tokenizer.encode(t, add_special_tokens=False).ids + [2], "<u4")
        want.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    manifest = token_store.write_tokens(df, BPE, scratch_dir(spark, "t-ids"))
    assert rows(token_store.read_tokens(spark, manifest)) == sorted(want, key=repr)


def test_files_read_back_in_order(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BPE)
    docs = clashing(documents(spark), "n_tokens", "bucket", "start")
    manifest = token_store.write_tokens(docs, BPE, scratch_dir(spark, "t-ids"))
    got = rows(token_store.read_tokens(spark, manifest, chunk_ids=1000))
    expected, start = [], 0
    for row in in_order():
        ids = np.array(tokenizer.encode(row[1] or "", add_special_tokens=False).ids + [2], "<u4")
        expected.append((row[0], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == sorted(expected, key=repr)
    empty = token_store.write_tokens(documents(spark, []), BPE, scratch_dir(spark, "t-ids"))
    assert token_store.read_tokens(spark, empty).count() == 0
