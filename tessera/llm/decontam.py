"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds every run of words of every benchmark item. Training texts
stream through it word by word; its state and matched length tell the longest
run that ends at a word and stands in an item. A run of at least ``window``
words, or a whole item of fewer, is a hit, and all its words are hit.

Only stretches of a text that can hold a hit are streamed: numpy hashes all
words of a batch, and a stretch is a run of words whose neighbours stand side
by side in some item, at least as long as the shortest window.

A benchmark of more than PART_BYTES is dealt to several automata by item, each
built, broadcast and streamed on its own, one after another; the texts carry
what they were hit by from pass to pass. So neither the driver nor a task holds
more than one part, and no size is refused. (An item is in one part whole.)

Nulls, empties, ties: a null or wordless text has no words and no hits; a null
or wordless item matches nothing. Items with equal texts all count; a null
item_id is reported as the empty string. Repeated rows are treated each. Empty
tables give no rows, or no hits. Texts are read whole. Other columns pass
through unless the operator's own have their name.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import common

WINDOW = 10
#: Bytes of benchmark text of one automaton, about: some 300 MB on the driver while it is built, 12 MB where it is used.
PART_BYTES = 2 << 20

# Word bytes: digits, letters (capitals lower-cased), and every byte of a code point from 128 on.
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[65:91] = True
_WORD[128:] = True
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lower(text: str) -> str:
    return text.lower() if text.isascii() else re.sub("[A-Z]+", lambda m: m[0].lower(), text)


class Automaton:
    """Generalised suffix automaton of word sequences, with the items that hold each window."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.window = window
        sequences = [(name, ITEM_WORD.findall(ascii_lower(text))) for name, text in items]
        sequences = [(name, words) for name, words in sequences if words]
        self.names = [name for name, _ in sequences]
        kinds = {w: i for i, w in enumerate(dict.fromkeys(w for _, words in sequences for w in words))}
        joined = pa.array(list(kinds), pa.large_string())
        data, offsets = common.utf8(joined)
        hashes = common.word_hashes(data, offsets[:-1], offsets[1:]) if len(kinds) else np.zeros(0, np.uint64)
        self.word_order = np.argsort(hashes).astype(np.int64)
        self.word_hashes = hashes[self.word_order]
        self.kinds = len(kinds)
        ids = [[kinds[w] for w in words] for _, words in sequences]
        pairs = {a * self.kinds + b for s in ids for a, b in zip(s, s[1:])}
        self.pairs = np.array(sorted(pairs), np.int64)
        self.shortest = min((min(len(s), window) for s in ids), default=0)
        self._build(ids)
        self._mark(ids)
        self._flatten()

    def _flatten(self) -> None:
        """The moves as one sorted array instead of a dictionary a state."""
        sizes = [len(m) for m in self.next]
        key = np.repeat(np.arange(len(sizes)), sizes) * max(self.kinds, 1) + np.fromiter(
            (w for m in self.next for w in m), np.int64, sum(sizes))
        to = np.fromiter((t for m in self.next for t in m.values()), np.int32, len(key))
        order = np.argsort(key)
        self.moves, self.to = key[order], to[order]
        self.link, self.length = np.array(self.link, np.int32), np.array(self.length, np.int32)
        del self.next

    def move(self, state: int, word: int) -> int:
        """The state after ``word``, -1 if there is none."""
        key = state * self.kinds + word
        at = self.moves.searchsorted(key)
        return int(self.to[at]) if at < len(self.moves) and self.moves[at] == key else -1

    def _build(self, sequences: list[list[int]]) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for sequence in sequences:
            last = 0
            for word in sequence:
                last = self._extend(last, word)

    def _state(self, length: int, moves: dict[int, int], link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _extend(self, last: int, word: int) -> int:
        """Add ``word`` after the state ``last``; the state of the longer run."""
        there = self.next[last].get(word)
        if there is not None and self.length[there] == self.length[last] + 1:
            return there
        if there is not None:
            return self._split(last, word, there)
        new = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
        return new

    def _split(self, p: int, word: int, q: int) -> int:
        """The state for the shorter runs of ``q`` that end a run of ``p`` and ``word``."""
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def _mark(self, sequences: list[list[int]]) -> None:
        """Items by the state of each window, and by state the windows among its run's endings."""
        self.items: dict[int, set[int]] = {}
        short: dict[int, int] = {}  # state -> length of the short item that it ends
        for n, sequence in enumerate(sequences):
            state = 0
            for i, word in enumerate(sequence):
                # always the state of at most the last ``window`` words, so each step goes back as far as it came on
                state = self.next[state][word]
                while self.length[self.link[state]] >= self.window:
                    state = self.link[state]
                if i + 1 >= self.window:
                    self.items.setdefault(state, set()).add(n)
            if len(sequence) < self.window:
                self.items.setdefault(-state - 1, set()).add(n)
                short[state] = len(sequence)
        self.ends: dict[int, tuple[tuple[int, int], ...]] = {}
        for state in sorted(range(len(self.length)), key=self.length.__getitem__):
            found = self.ends.get(self.link[state], ()) if state else ()
            if state in short:
                found = (*found, (short[state], -state - 1))
            if self.length[state] >= self.window > self.length[self.link[state]]:
                found = (*found, (self.window, state))
            if found:
                self.ends[state] = found

    def stream(self, words: list[int]) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit spans of a run of known words, and the numbers of the items hit."""
        spans, seen, state, matched = [], set(), 0, 0
        for at, word in enumerate(words):
            after = self.move(state, word)
            while after < 0 and state:
                state = int(self.link[state])
                matched = int(self.length[state])
                after = self.move(state, word)
            if after >= 0:
                state = after
                matched += 1
            for length, mark in self.ends.get(state, ()):
                if matched >= length:
                    start = at + 1 - (matched if length == self.window else length)
                    while spans and start <= spans[-1][1]:
                        start = min(start, spans.pop()[0])
                    spans.append((start, at + 1))
                    seen.add(mark)
        return spans, {n for mark in seen for n in self.items[mark]}

    def known(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers by hash, -1 for words of no item."""
        if not self.kinds:
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.word_hashes, hashes), self.kinds - 1)
        return np.where(self.word_hashes[at] == hashes, self.word_order[at], -1)

    def stretches(self, words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the runs that may hold a window: known neighbours throughout."""
        ok = words >= 0
        joined = np.zeros(len(words), bool)  # with the word before
        if len(words) > 1 and len(self.pairs):
            both = np.flatnonzero(ok[1:] & ok[:-1])
            key = words[both] * self.kinds + words[both + 1]
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            joined[both[self.pairs[at] == key] + 1] = True
        joined[offsets[:-1][offsets[:-1] < len(words)]] = False
        starts = np.flatnonzero(ok & ~joined)
        last = np.ones(len(words), bool)
        last[:-1] = ~joined[1:]
        ends = np.flatnonzero(ok & last) + 1
        long = ends - starts >= max(self.shortest, 1)
        return starts[long], ends[long]


class Parts:
    """A benchmark (item_id, text) dealt to automata of bounded size, built when asked for."""

    def __init__(self, benchmark: DataFrame, window: int = WINDOW, part_bytes: int = PART_BYTES):
        self.window = window
        self.rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
        size = self.rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        self.count = max(1, -(-size // part_bytes))

    def __iter__(self) -> Iterator[Automaton]:
        part = F.pmod(F.xxhash64("item_id", "text"), F.lit(self.count))
        for n in range(self.count):
            rows = self.rows.filter(part == n).collect()
            yield Automaton([(r[0] or "", r[1] or "") for r in rows], self.window)


def build(benchmark: DataFrame, window: int = WINDOW, part_bytes: int = PART_BYTES) -> Parts:
    return Parts(benchmark, window, part_bytes)


def find(texts: pa.Array, automaton: Automaton) -> Iterator[tuple[int, list[tuple[int, int]], list[tuple[int, int]], set[int]]]:
    """For each text: its number of words, hit spans in words and in its UTF-8 bytes, and item numbers."""
    data, offsets = common.utf8(texts)
    starts, ends, cuts = common.word_spans(data, offsets, _WORD)
    words = automaton.known(common.word_hashes(data, starts, ends))
    lo, hi = automaton.stretches(words, cuts)
    at = np.searchsorted(lo, cuts)
    for i in range(len(texts)):
        spans, items = [], set()
        for j in range(at[i], at[i + 1]):
            found, marks = automaton.stream(words[lo[j]: hi[j]].tolist())
            spans += [(int(lo[j]) + a, int(lo[j]) + b) for a, b in found]
            items |= marks
        in_bytes = [(int(starts[a] - offsets[i]), int(ends[b - 1] - offsets[i])) for a, b in spans]
        yield int(cuts[i + 1] - cuts[i]), [(int(a - cuts[i]), int(b - cuts[i])) for a, b in spans], in_bytes, items


#: Columns that carry from pass to pass what a text was hit by: spans in words and in bytes, and names of items.
_HITS, _NAMES = "_hits", "_hit_names"
_HITS_TYPE = pa.list_(pa.list_(pa.int64()))
_NAMES_TYPE = pa.list_(pa.string())


def _merged(spans: list[list[int]]) -> list[list[int]]:
    """Spans (words from, to, bytes from, to) without overlap, in order."""
    out: list[list[int]] = []
    for s in sorted(spans):
        if out and s[0] <= out[-1][1]:
            if s[1] > out[-1][1]:
                out[-1][1], out[-1][3] = s[1], s[3]
        else:
            out.append(list(s))
    return out


def _streamed(docs: DataFrame, parts: Parts, finish, schema: str) -> DataFrame:
    """``finish(batch, rows)`` over the batches of ``docs``, ``rows`` being words, spans and names of each text.

    Every part but the last adds what it finds to the rows, which are written.
    """
    spark = common.prepare(docs.sparkSession)
    for at, automaton in enumerate(parts):
        shared, first, last = spark.sparkContext.broadcast(automaton), at == 0, at + 1 == parts.count
        place, own = docs.columns.index("text"), [c for c in docs.columns if c not in (_HITS, _NAMES)]

        def scan(batches: Iterator[pa.RecordBatch], shared=shared, first=first, last=last, place=place,
                 own=own) -> Iterator[pa.RecordBatch]:
            for batch in common.rows_of(batches):
                old = [([], [])] * batch.num_rows if first else list(zip(
                    batch.column(_HITS).to_pylist(), batch.column(_NAMES).to_pylist()))
                rows = []
                for (n, spans, in_bytes, items), (hits, names) in zip(find(batch.column(place), shared.value), old):
                    hits = hits + [[*w, *b] for w, b in zip(spans, in_bytes)]
                    rows.append((n, _merged(hits), names + [shared.value.names[i] for i in items]))
                if last:
                    yield finish(batch.select(own), rows)
                else:
                    yield pa.RecordBatch.from_arrays(
                        [*batch.select(own).columns, pa.array([r[1] for r in rows], _HITS_TYPE), pa.array([r[2] for r in rows], _NAMES_TYPE)],
                        names=[*own, _HITS, _NAMES])

        if last:
            return docs.mapInArrow(common.released(scan), schema)
        carried = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in own)
        docs = common.materialise(docs.mapInArrow(
            common.released(scan), f"{carried}, {_HITS} array<array<bigint>>, {_NAMES} array<string>"), "decontam-part")


def report(docs: DataFrame, parts: Parts) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of each of ``docs`` (doc_id, text)."""

    def measure(batch: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
        out = [(n, sum(s[1] - s[0] for s in spans), len(names),
                hashlib.sha256(",".join(sorted(names)).encode("utf-8")).hexdigest(), bool(spans)) for n, spans, names in rows]
        columns = list(zip(*out)) or [()] * 5
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(
                columns, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())))],
            names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _streamed(docs.select("doc_id", "text"), parts, measure, (
        f"doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"))


def decontaminate(docs: DataFrame, parts: Parts, max_coverage: float = 0.5) -> DataFrame:
    """``docs`` without the hit spans of their texts, and without documents hit beyond ``max_coverage`` of their words.

    Texts without a hit are left as they are. An ``n_chars`` column follows the text.
    """
    names = docs.columns
    place = names.index("text")
    chars = names.index("n_chars") if "n_chars" in names else None

    def clean(batch: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
        texts, keep = batch.column(place).to_pylist(), np.ones(batch.num_rows, bool)
        counts = batch.column(chars).to_pylist() if chars is not None else []
        for i, (n, spans, _) in enumerate(rows):
            if not spans:
                continue
            keep[i] = sum(s[1] - s[0] for s in spans) <= max_coverage * n
            raw, at, parts_ = texts[i].encode("utf-8"), 0, []
            for _, _, a, b in spans:
                parts_.append(raw[at:a])
                at = b
            texts[i] = b"".join([*parts_, raw[at:]]).decode("utf-8")
            if chars is not None:
                counts[i] = len(texts[i])
        columns = list(batch.columns)
        columns[place] = pa.array(texts, batch.column(place).type)
        if chars is not None:
            columns[chars] = pa.array(counts, batch.column(chars).type)
        return pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(keep))

    return _streamed(docs, parts, clean, docs.schema)
