"""Token-ID output: fixed-width bit packing with block offsets.

Ids are stored in ``width`` bits each, the least that holds every id of the
vocabulary. Sixty-four ids fill exactly ``width`` 64-bit words (a group), so a
group starts at a known byte and unpacks with a few numpy shifts. A file is

    magic, version, width                             header, 16 bytes
    blocks of up to BLOCK ids (whole groups)          payload
    block byte offsets, doc ids, null flags, id ends  index (little-endian 64-bit; flags 8-bit)
    n_ids, n_docs, n_blocks, index start, magic       trailer, 40 bytes

Nulls, empties, ties: a null text counts as empty and stores only the end id.
A null doc_id comes first in order and is flagged. Repeated rows are stored
once each, in (doc_id, text) order. An empty table gives no file and no rows.
Other columns of the input are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm import common

MAGIC = b"TESSIDS1"
BLOCK = 1 << 16
HEADER, TRAILER = 16, 40
#: Pieces of words that a worker keeps (about 40 bytes each) before it starts anew; only speed depends on it.
CACHE_PIECES = 500_000
MAX_TOKENIZER_BYTES = 64 << 20
#: Code points that may count as letters, and signs that may be pre-tokens of their own; the tokenizer tells which do.
MAY_BE_LETTERS, SIGNS = "".join(map(chr, [*range(65, 91), *range(97, 123), *range(0xC0, 0x250)])), ".,!"

MANIFEST = "bucket int, path string, n_docs long, n_ids long, n_bytes long"
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"


# --- packing ------------------------------------------------------------------------------------


def bits_for(max_id: int) -> int:
    return max(1, int(max_id).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """``ids`` in groups of 64, each group ``width`` little-endian 64-bit words; the last is padded."""
    groups = -(-len(ids) // 64)
    full = np.zeros((groups, 64), np.uint64)
    full.reshape(-1)[: len(ids)] = ids
    words = np.zeros((groups, width), np.uint64)
    for lane in range(64):
        word, shift = divmod(lane * width, 64)
        words[:, word] |= full[:, lane] << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= full[:, lane] >> np.uint64(64 - shift)
    return words.astype("<u8").tobytes()


def unpack(data: bytes, width: int, n: int) -> np.ndarray:
    """The first ``n`` ids of packed groups, as uint32."""
    words = np.frombuffer(data, "<u8").reshape(-1, width)
    out = np.empty((len(words), 64), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for lane in range(64):
        word, shift = divmod(lane * width, 64)
        v = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            v = v | (words[:, word + 1] << np.uint64(64 - shift))
        out[:, lane] = v & mask
    return out.reshape(-1)[:n]


class Writer:
    """Streams documents into one file; at most a block of ids waits in memory."""

    def __init__(self, sink, width: int):
        self.sink, self.width = sink, width
        sink.write(MAGIC + struct.pack("<II", 1, width))
        self.at, self.blocks, self.waiting, self.n_waiting = HEADER, [], [], 0
        self.docs, self.flags, self.ends, self.n_ids = [], bytearray(), [], 0

    def add(self, doc_ids: list[int | None], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Append documents: all their ids, end to end, and how many each has."""
        self.docs += [0 if d is None else d for d in doc_ids]
        self.flags += bytes(d is None for d in doc_ids)
        self.ends += (self.n_ids + np.cumsum(sizes)).tolist()
        self.n_ids += len(ids)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= BLOCK:
            every = np.concatenate(self.waiting)
            whole = len(every) // BLOCK * BLOCK
            for i in range(0, whole, BLOCK):
                self._block(every[i: i + BLOCK])
            self.waiting, self.n_waiting = [every[whole:]], len(every) - whole

    def _block(self, ids: np.ndarray) -> None:
        data = pack(ids, self.width)
        self.blocks.append(self.at)
        self.sink.write(data)
        self.at += len(data)

    def close(self) -> int:
        if self.n_waiting:
            self._block(np.concatenate(self.waiting))
        index = self.at
        for x in (self.blocks, self.docs, self.ends):
            self.sink.write(np.array(x, "<i8").tobytes())
        self.sink.write(bytes(self.flags))
        self.sink.write(struct.pack("<QQQQ", self.n_ids, len(self.docs), len(self.blocks), index) + MAGIC)
        self.sink.close()
        return index + 8 * (len(self.blocks) + 2 * len(self.docs)) + len(self.flags) + TRAILER


class Reader:
    """Random access to a file: the index is read once, ids by position."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        self.n_ids, self.n_docs, n_blocks, index, magic = struct.unpack("<QQQQ8s", self._at(size - TRAILER, TRAILER))
        head, _, self.width = struct.unpack("<8sII", self._at(0, HEADER))
        if magic != MAGIC or head != MAGIC:
            raise ValueError("not a packed token file")
        raw = self._at(index, 8 * (n_blocks + 2 * self.n_docs) + self.n_docs)
        cut = 8 * n_blocks, 8 * (n_blocks + self.n_docs), 8 * (n_blocks + 2 * self.n_docs)
        self.blocks = np.frombuffer(raw[: cut[0]], "<i8")
        self.docs = np.frombuffer(raw[cut[0]: cut[1]], "<i8")
        self.ends = np.frombuffer(raw[cut[1]: cut[2]], "<i8")
        self.null = np.frombuffer(raw[cut[2]:], np.uint8).astype(bool)

    def _at(self, start: int, n: int) -> bytes:
        self.file.seek(start)
        return self.file.read(n)

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end`` of the file, without reading what lies before or after their groups."""
        out = []
        while start < end:
            b, inside = divmod(start, BLOCK)
            stop = min(end, (b + 1) * BLOCK)
            group = inside // 64
            groups = -(-(stop - b * BLOCK) // 64) - group
            data = self._at(int(self.blocks[b]) + group * self.width * 8, groups * self.width * 8)
            got = unpack(data, self.width, groups * 64)
            out.append(got[inside - group * 64: stop - b * BLOCK - group * 64])
            start = stop
        return np.concatenate(out) if out else np.zeros(0, np.uint32)


# --- tokenizing -----------------------------------------------------------------------------------


class WordEncoder:
    """Encodes texts word by word with a tokenizer whose pre-tokens never cross a space or newline.

    A text's ids are then those of its words, end to end, so Arrow finds the
    distinct words of a batch and only those are looked up. Full stops, commas
    and exclamation marks are pre-tokens of their own after letters that the
    tokenizer keeps as one letter, and ASCII capitals are lower-cased by it, so
    a word of such letters is looked up as its lower-cased letters (stem) and
    the signs after them (tail). What has been
    encoded is kept by the worker process for later batches.
    """

    _made: dict[int, "WordEncoder"] = {}

    def __init__(self, spec: bytes):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec.decode("utf-8"))
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.last: np.ndarray | None = None  # by id: whether it ends a pre-token
        if suffix:
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
            self.last = np.zeros(max(vocabulary.values()) + 1, bool)
            self.last[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.letters_and_tail = self._pattern()
        self._forget()

    def _pattern(self) -> str:
        """A word of letters that no sign after them changes, and the signs. A letter that the tokenizer turns
        into a letter and a mark joins what follows, so it is left out."""
        ids = lambda text: self.tokenizer.encode(text, add_special_tokens=False).ids
        tails = {t: ids(t) for t in (*SIGNS, SIGNS, SIGNS[::-1], SIGNS[0] * 3)}
        normalizer = self.tokenizer.normalizer

        def safe(c: str) -> bool:
            shown = normalizer.normalize_str(c) if normalizer else c
            return len(shown) == 1 and shown.isalpha() and all(
                ids(f"{word}{t}") == ids(word) + tail for word in (c, f"a{c}", f"{c}a") for t, tail in tails.items())

        safe_letters = "".join(c for c in MAY_BE_LETTERS if safe(c))
        return f"^(?P<stem>[{safe_letters}]+)(?P<tail>[{SIGNS}]*)$" if safe_letters else "^(?P<stem>a^)(?P<tail>b^)$"

    @classmethod
    def of(cls, spec: bytes) -> "WordEncoder":
        """One encoder per worker process and tokenizer."""
        key = zlib.crc32(spec)
        if key not in cls._made:
            cls._made[key] = cls(spec)
        return cls._made[key]

    def _forget(self) -> None:
        """What is kept: two hashes of each piece (sorted by the first), and where its ids stand in ``flat``."""
        self.keys, self.checks = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _learn(self, pieces: list[str], letters: bool) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces, end to end, and how many each has; ``letters`` are one pre-token each."""
        ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for at in range(0, len(pieces), 500):
            part = pieces[at: at + 500]
            if letters and self.last is not None:
                # many as one text, cut at the pre-tokens' ends
                found = np.array(self.tokenizer.encode(" ".join(part), add_special_tokens=False).ids, np.uint32)
                cuts = np.flatnonzero(self.last[found]) + 1
                if len(cuts) == len(part):
                    ids.append(found)
                    sizes.append(np.diff(cuts, prepend=0))
                    continue
            each = [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            ids.append(np.array([i for e in each for i in e], np.uint32))
            sizes.append(np.array([len(e) for e in each], np.int64))
        return np.concatenate(ids), np.concatenate(sizes)

    def _find(self, pieces: pa.Array, letters: bool) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each piece start in ``flat``, and how many there are; new pieces are learned."""
        kinds = pieces.dictionary_encode()
        data, offsets = common.utf8(kinds.dictionary)
        value = data.astype(np.uint64)
        key, check = (common.span_hashes(v, offsets[:-1], offsets[1:])
                      for v in (value + np.uint64(1), common.mix(value + np.uint64(977))))
        at = np.searchsorted(self.keys, key)
        near = np.minimum(at, max(len(self.keys) - 1, 0))
        hit = (self.keys[near] == key) & (self.checks[near] == check) if len(self.keys) else np.zeros(len(key), bool)
        starts, sizes = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
        starts[hit], sizes[hit] = self.starts[near[hit]], self.sizes[near[hit]]
        new = np.flatnonzero(~hit)
        if len(new):
            ids, sizes[new] = self._learn(kinds.dictionary.take(pa.array(new)).to_pylist(), letters)
            starts[new] = len(self.flat) + np.cumsum(sizes[new]) - sizes[new]
            self.flat = np.concatenate([self.flat, ids])
            new = new[np.argsort(key[new])]
            at = np.searchsorted(self.keys, key[new])
            self.keys, self.checks = np.insert(self.keys, at, key[new]), np.insert(self.checks, at, check[new])
            self.starts, self.sizes = np.insert(self.starts, at, starts[new]), np.insert(self.sizes, at, sizes[new])
        back = kinds.indices.to_numpy()
        return starts[back], sizes[back]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, end to end, and how many each has (null: none)."""
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if len(self.keys) > CACHE_PIECES:
            self._forget()
        texts = pc.replace_substring(texts.cast(pa.large_string()).fill_null(""), "\n", " ")
        split = pc.split_pattern(texts, " ")
        words = split.flatten().dictionary_encode()
        kinds = pc.ascii_lower(words.dictionary)
        cut = pc.extract_regex(kinds, self.letters_and_tail)
        plain = cut.is_valid()
        # A word that is not letters and signs is one piece, as it stands.
        others = words.dictionary.filter(pc.invert(plain))
        where = plain.to_numpy(zero_copy_only=False)
        starts, sizes = np.zeros((len(kinds), 2), np.int64), np.zeros((len(kinds), 2), np.int64)
        split_off = cut.filter(plain)
        for side, pieces in enumerate((pc.struct_field(split_off, 0), pc.struct_field(split_off, 1))):
            starts[where, side], sizes[where, side] = self._find(pieces, side == 0)
        starts[~where, 0], sizes[~where, 0] = self._find(others, False)
        flat = _ranges(self.flat, starts.reshape(-1), sizes.reshape(-1))  # of the distinct words
        sizes = sizes.sum(axis=1)
        starts = np.cumsum(sizes) - sizes
        at = words.indices.to_numpy()
        sizes = sizes[at]
        ids = _ranges(flat, starts[at], sizes)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        offsets = split.offsets.to_numpy()
        return ids, np.diff(ends[offsets - offsets[0]])


def _ranges(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """flat[start:start + size] of every start, end to end."""
    before = np.cumsum(sizes) - sizes
    return flat[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]


def word_tokenizer_spec(path: str) -> bytes:
    """The tokenizer's file, of checked size, and of the kind that ``WordEncoder`` needs."""
    with open(path, "rb") as f:
        spec = f.read(MAX_TOKENIZER_BYTES + 1)
    if len(spec) > MAX_TOKENIZER_BYTES:
        raise ValueError("tokenizer file too large to broadcast")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_str(spec.decode("utf-8"))
    probe = "Then. the\n\n  gehörig, gehörig,été! A1b2 it's <|x|> Él"
    whole = tok.encode(probe, add_special_tokens=False).ids
    split = [i for w in probe.replace("\n", " ").split(" ") for i in tok.encode(w, add_special_tokens=False).ids]
    if whole != split:
        raise ValueError("this tokenizer's words depend on the space around them")
    return spec


# --- Spark jobs -------------------------------------------------------------------------------------


def write_tokens(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = 2) -> DataFrame:
    """Write ``docs`` (doc_id, text) as packed files in ascending doc_id order; the manifest of the files.

    Documents are dealt into doc_id ranges of about equal text (one shuffle)
    and sorted inside them; each task writes its range to a file of its own.
    Only files named by the returned, materialised manifest count, so a retried
    or speculative task leaves no duplicate. The manifest has a row per file,
    with ``base``, the number of ids in the files before it.
    """
    spark = common.prepare(docs.sparkSession)
    spec = word_tokenizer_spec(tokenizer_path)
    from tokenizers import Tokenizer

    vocabulary = Tokenizer.from_str(spec.decode("utf-8")).get_vocab_size(with_added_tokens=True)
    width = bits_for(max(vocabulary - 1, end_id))
    shared = spark.sparkContext.broadcast(spec)

    @common.released
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer, path, bucket = WordEncoder.of(shared.value), None, "", 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                bucket = batch.column(0)[0].as_py()
                path = common.attempt_path(folder, f"ids-{bucket:06d}", ".bin")
                writer = Writer(common.open_output(path), width)
            ids, sizes = encoder.encode(batch.column(2))
            writer.add(batch.column(1).to_pylist(), np.insert(ids, np.cumsum(sizes), end_id), sizes + 1)
        if writer is not None:
            size = writer.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([bucket], pa.int32()), pa.array([path]), pa.array([len(writer.docs)], pa.int64()),
                 pa.array([writer.n_ids], pa.int64()), pa.array([size], pa.int64())],
                names=["bucket", "path", "n_docs", "n_ids", "n_bytes"])

    n = common.n_partitions(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    bucket = common.ordered_buckets(docs, "doc_id", "text", n)
    dealt = (docs.select(bucket.alias("bucket"), "doc_id", "text")
             .repartitionById(n, "bucket").sortWithinPartitions("bucket", "doc_id", "text"))
    common.batch_rows(spark, 300)  # a batch's words take some thirty times its bytes
    manifest = common.materialise(dealt.mapInArrow(write, MANIFEST), "token-manifest")
    common.batch_rows(spark)
    # One row per file: at most as many as there are shuffle partitions.
    before = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_tokens(spark: SparkSession, manifest: DataFrame, chunk_ids: int = 1 << 20) -> DataFrame:
    """Per document, read back from the files: doc_id, start, n_tokens and the crc32 of its ids."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with common.open_input(path) as file:
                    r = Reader(file)
                    starts = np.concatenate([[0], r.ends[:-1]]) if r.n_docs else np.zeros(0, np.int64)
                    i = 0
                    while i < r.n_docs:
                        j = max(i + 1, int(np.searchsorted(r.ends, starts[i] + chunk_ids, "right")))
                        ids = r.ids(int(starts[i]), int(r.ends[j - 1])).astype("<u4")
                        cuts = (r.ends[i:j] - starts[i]) * 4
                        raw, from_ = memoryview(ids.tobytes()), 0
                        sums = []
                        for to in cuts.tolist():
                            sums.append(zlib.crc32(raw[from_:to]))
                            from_ = to
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(r.docs[i:j], pa.int64(), mask=r.null[i:j]), pa.array(starts[i:j] + base),
                             pa.array(r.ends[i:j] - starts[i:j]), pa.array(sums, pa.int64())],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"])
                        i = j

    n = max(1, common.n_partitions(spark))
    files = manifest.select("path", "base").repartition(n, "path")
    return files.mapInArrow(read, ROWS)
