"""Mixing, WARC and chat formatting against plain Python."""

import hashlib
import io
import math
from collections import Counter

import pytest
from edge import LONG, ROWS, clashing, documents, rows

from tessera.llm import chat, common, mixing, warc
from tessera.llm.queries import PLANTED
from tessera.session import scratch_dir

# --- mixing --------------------------------------------------------------------------------------


def corpus(spark):
    docs = [(i, "s0", "w " * 10) for i in range(400)] + [(1000 + i, "s1", "w " * 10) for i in range(40)]
    docs += [(2000 + i, "s2", "w " * (1 + i % 19)) for i in range(8)] + [(3000, "empty", ""), (3001, None, None)]
    return spark.createDataFrame(docs, "doc_id long, source string, text string")


def tokens(df):
    out, repeats = Counter(), Counter()
    for r in df.collect():
        out[r.source] += len((r.text or "").split())
        repeats[r.doc_id] += 1
    return out, repeats


def test_every_document_stays_and_the_limit_holds(spark):
    got, repeats = tokens(mixing.mix_sources(corpus(spark), target_entropy=1.0, max_repeats=3.0, block_tokens=16))
    before, _ = tokens(corpus(spark))
    assert set(repeats) == {r.doc_id for r in corpus(spark).collect()}
    assert max(repeats.values()) <= 3 and got["s0"] == before["s0"]
    assert got["s2"] == pytest.approx(3 * before["s2"], abs=20)


def test_entropy_target_and_budget_are_met(spark):
    df = mixing.mix_sources(corpus(spark), target_entropy=0.8, max_repeats=50, budget_tokens=4000, block_tokens=16)
    weights = {r.source: r.weight for r in df.select("source", "weight").distinct().collect() if r.weight > 0}
    assert sum(weights.values()) == pytest.approx(1)
    assert -sum(w * math.log(w) for w in weights.values()) == pytest.approx(0.8 * math.log(3), abs=1e-6)
    got, _ = tokens(df)
    for source, weight in weights.items():
        assert got[source] == pytest.approx(4000 * weight, abs=25)
    # reading by place, every prefix has about the weights
    placed = sorted((r.place, r.source, len(r.text.split())) for r in df.collect() if r.text)
    assert 0 <= placed[0][0] and placed[-1][0] < 1
    half = Counter()
    for place, source, n in placed:
        if place < 0.5:
            half[source] += n
    assert half["s0"] == pytest.approx(got["s0"] / 2, rel=0.2)


def test_natural_weights_leave_all_as_it_is_and_a_greedy_budget_is_refused(spark):
    docs = documents(spark)
    theirs = clashing(docs, "epoch", "weight", "whole", "rest", "n_blocks", "tokens", "source_key")
    same = mixing.mix_sources(theirs, target_entropy=0.0, max_repeats=1.0)
    assert rows(same, *docs.columns) == rows(docs)
    assert {r.whole for r in same.collect()} == {"theirs"}
    again = mixing.mix_sources(docs, target_entropy=1.0, max_repeats=2.0)
    assert rows(again) == rows(mixing.mix_sources(docs, target_entropy=1.0, max_repeats=2.0))
    assert mixing.mix_sources(documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        mixing.mix_sources(corpus(spark), max_repeats=2.0, budget_tokens=10**9)


# --- WARC ----------------------------------------------------------------------------------------


def test_plan_equals_plain_arithmetic(spark):
    """Weights of every source and the tokens that realise them, worked out again from the token counts alone."""
    docs = corpus(spark)
    rows = mixing.mix_sources(docs, target_entropy=0.9, max_repeats=4.0, block_tokens=16).collect()
    before = {s or "": n for s, n in tokens(docs)[0].items() if n}
    total, largest = sum(before.values()), max(before, key=before.get)

    def weights(a):
        raw = {s: (n / total) ** a for s, n in before.items()}
        return {s: w / sum(raw.values()) for s, w in raw.items()}

    def may_rise(a):
        w = weights(a)
        budget = before[largest] / w[largest]  # the largest source just once
        entropy = -sum(x * math.log(x) for x in w.values()) / math.log(len(w))
        return entropy >= 0.9 or max(w[s] * budget / n for s, n in before.items()) > 4.0 * (1 + 1e-9)

    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if may_rise(mid) else (low, mid)
    seen, got = {r.source or "": r for r in rows if r.weight}, Counter()
    for r in rows:
        got[r.source or ""] += len((r.text or "").split())
    w = weights(high)
    assert set(seen) == set(before)
    for s, n in before.items():
        assert seen[s].weight == pytest.approx(w[s], rel=1e-5) and seen[s].exponent == pytest.approx(high, abs=1e-6)
        assert abs(got[s] - w[s] * before[largest] / w[largest]) <= 20, s  # a document's tokens, at most


class Bytes(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def test_every_split_owns_the_records_that_start_in_it():
    records = [warc.record(i, f"http://x/{i}", f"page {i} " * (i * 7 % 90), None, "d") for i in range(40)]
    parts = [warc.member(r) for r in records]
    file = Bytes(b"".join(parts))
    for split in (1, 7, 100, 1000, 10**6):
        got = [r for start in range(0, file.size(), split) for r in warc.members(file, start, start + split)]
        assert got == records


def test_magic_inside_a_member_is_no_record():
    inner = warc.member(b"not a record")
    stored = warc.zlib.compressobj(0, warc.zlib.DEFLATED, 31)  # stored blocks keep the bytes as they are
    trap = stored.compress(b"WARC/1.1\r\nA: b\r\n\r\n" + inner + warc.MAGIC + b"\x00" * 50) + stored.flush()
    good = warc.member(warc.record(1, None, "x", None, "d"))
    file = Bytes(trap + good)
    assert len(list(warc.members(file, 1, file.size()))) == 1
    assert len(list(warc.members(file, 0, file.size()))) == 2
    with pytest.raises(ValueError):
        list(warc.members(Bytes(good[:-12]), 0, 1))


def test_magic_in_the_last_bytes_of_an_archive_is_no_record():
    good = warc.member(warc.record(1, None, "x", None, "d"))
    for tail in (warc.MAGIC, warc.MAGIC + b"\x00\x00", warc.member(b"WARC/1.1 cut")[:14]):
        file = Bytes(good + tail)
        assert len(list(warc.members(file, 0, file.size()))) == 1
        assert list(warc.members(file, len(good) - 3, file.size())) == []


def test_pages_round_trip(spark):
    big = "ü" * 600
    pages = [(1, "http://a/\r\nX: y", big), (2, "http://b", big), (3, "http://c", big), (3, "http://c", big),
             (4, None, "small"), (5, "http://d", "small"), (6, "u", None), (7, "u", ""), (None, "n", big), (8, "l", LONG)]
    df = clashing(spark.createDataFrame(pages, "page_id long, url string, html string"), "digest", "salt", "record_type")
    archives = warc.write_warc(df, scratch_dir(spark, "t-warc"))
    got = warc.read_warc(spark, archives, split_bytes=97)
    expected = []
    for page, _, html in pages:
        raw = (html or "").encode()
        revisit = html == big and page != 3
        expected.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response",
                         3 if revisit else None))
    assert rows(got, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == sorted(expected, key=repr)
    payloads = {r.page_id: r.payload for r in got.collect() if r.record_type == "response"}
    assert bytes(payloads[8]).decode() == LONG and bytes(payloads[6]) == b""
    assert warc.write_warc(df.limit(0), scratch_dir(spark, "t-warc")).count() == 0


# --- chat ----------------------------------------------------------------------------------------


def test_chat_round_trip(spark):
    tricky = ["", PLANTED, "<|", "<\\|", "<\\\\|x", "<", "|", "a<|im_sep|>b", "\n", "<|im_end|>\n", "é😀" * 3]
    turns = [(1, i, ["user", "assistant", "assistant", "a\nb%0A", "<|im_start|>"][i % 5], t) for i, t in enumerate(tricky)]
    turns += [(2, 0, None, None), (2, 0, "assistant", "tie"), (2, 0, "assistant", "tie"), (None, 1, "assistant", "no id"),
              (3, None, "user", "null turn first"), (3, 0, "assistant", LONG), (4, 1, "user", "only"), (-1, 0, "user", PLANTED)]
    df = clashing(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"), "offset", "message")
    out = chat.format_chat(df)
    read = {r.conv_id: r for r in chat.read_chat(common.materialise(out, "t-chat")).collect()}
    whole = {r.conv_id: r for r in out.collect()}
    conv = {}
    for c, turn, role, text in turns:
        conv.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    assert set(read) == set(conv)
    for c, own in conv.items():
        own = [(role, text) for *_, role, text in sorted(own)]
        assert [(t.role, t.text) for t in read[c].turns] == own
        assert list(read[c].loss_texts) == [t for role, t in own if role == "assistant"]
        text = whole[c].formatted
        messages = text.split(chat.END)
        for s in whole[c].loss_spans:  # offsets in the whole text and inside the message agree
            assert text[s.offset: s.offset + s.length] == messages[s.message - 1][s.start: s.start + s.length]
        merged = sum(1 for i, (role, _) in enumerate(own) if i == 0 or own[i - 1][0] != role)
        assert len(messages) - 1 == merged
    assert chat.format_chat(df.limit(0)).count() == 0
