"""Language identification by interpolated Kneser-Ney character models.

Each language has a 4-gram model over letters, other characters counting as
one space. Counts come from all labelled documents, summed by Spark; lower
orders count distinct left contexts. The models of all languages are sorted
arrays of gram hashes side by side, so one look-up serves every language.
Models of more than MAX_GRAMS counts stay in Spark: every count is in their
tables, the bits of the grams taught most often are broadcast, and a text's
other grams meet theirs in a join by gram. A text goes to the language of lowest cross-entropy per character. A language's
texts of the calibration part set how high that may be for texts of about the
same length; a text beyond is rejected, unless it is shorter than 32
characters.

Nulls, empties, ties: null texts and texts without a letter are ``und`` with
score 0, and are rejected. Equal cross-entropies go to the first language by
name. Without a labelled row every text is ``und``. Null languages teach
nothing. Repeated rows count and are scored each. Other columns pass through
unless the operator's own have their name. Texts are scored whole.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import common

ORDER = 4
#: Counts up to which the models are broadcast whole; beyond, the grams whose bits are: the most frequent first.
MAX_GRAMS = 2_000_000
#: Cross-entropies (counts x languages) that are broadcast at most: 64 MB.
MAX_BITS = 1 << 24
#: Characters beyond which a longer text makes the score no surer.
SURE_LENGTH = 64
#: Texts shorter than 2 ** this many characters say too little to be rejected for their cross-entropy.
LEAST_CLASS = 5
SPACE, BEYOND = 32, 0xFFFD

COUNTS = "lang string, gram long, n long"


# --- characters to grams -------------------------------------------------------------------------


@cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """By 16-bit code point: the lower-cased letter or mark (else space), and whether it is a letter."""
    low, letter = np.full(1 << 16, SPACE, np.uint16), np.zeros(1 << 16, bool)
    for c in range(1 << 16):
        kind = unicodedata.category(chr(c))[0]
        if kind in "LM":
            small = chr(c).lower()
            low[c] = ord(small) if len(small) == 1 and ord(small) < 1 << 16 else c
            letter[c] = kind == "L"
    return low, letter


def normalised(points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters and single spaces of each text with ORDER - 1 spaces before and one after; offsets; has a letter."""
    low, letter = _letters()
    n_texts = len(offsets) - 1
    small = np.minimum(points, 0xFFFF)
    chars, is_letter = low[small], letter[small]
    for i in np.flatnonzero(points > 0xFFFF):
        is_letter[i] = chr(points[i]).isalpha()
        chars[i] = BEYOND if is_letter[i] else SPACE
    gap = chars == SPACE
    keep = np.ones(len(chars), bool)
    keep[1:] = ~(gap[1:] & gap[:-1])
    starts = offsets[:-1][offsets[:-1] < offsets[1:]]
    keep[starts] = ~gap[starts]
    has = np.zeros(n_texts, bool)
    has[np.searchsorted(offsets, np.flatnonzero(is_letter), "right") - 1] = True
    kept = np.concatenate([[0], np.cumsum(keep)])[offsets]
    out = np.full(kept[-1] + ORDER * n_texts, SPACE, np.uint16)
    text = np.repeat(np.arange(n_texts), np.diff(kept))
    out[np.arange(kept[-1]) + ORDER * text + ORDER - 1] = chars[keep]
    return out, kept + ORDER * np.arange(n_texts + 1), has


def grams(chars: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All 4-grams (16 bits a character) inside the texts, and the n+1 offsets."""
    two = (chars[:-1].astype(np.uint64) << np.uint64(16)) | chars[1:]
    four = (two[:-2] << np.uint64(32)) | two[2:]
    inside = np.ones(len(four), bool)
    for back in range(1, ORDER):
        inside[np.clip(offsets[1:-1] - back, 0, max(len(four) - 1, 0))] = False
    return four[inside], offsets - (ORDER - 1) * np.arange(len(offsets))


# --- counting ----------------------------------------------------------------------------------------


def count_grams(labelled: DataFrame) -> DataFrame:
    """(lang, gram, n) over whole texts of ``labelled`` (lang, text): summed per task, then by Spark."""

    @common.released
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def summed(parts: list) -> list:
            keys = np.concatenate([k for k, _ in parts])
            order = np.argsort(keys, kind="stable")
            keys, n = keys[order], np.concatenate([n for _, n in parts])[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            return [(keys[first], np.add.reduceat(n, first))]

        for batch in common.rows_of(batches):
            if not batch.num_rows:
                continue
            chars, offsets, has = normalised(*common.code_points(batch.column(1)))
            keys, cuts = grams(chars, offsets)
            langs = batch.column(0).to_pylist()
            number = {lang: n for n, lang in enumerate(dict.fromkeys(langs))}
            own = np.repeat([number[lang] if ok else -1 for lang, ok in zip(langs, has)], np.diff(cuts))
            for lang, n in number.items():
                found = np.unique(keys[own == n], return_counts=True)
                if len(found[0]):
                    parts = held.setdefault(lang, [])
                    parts.append(found)
                    if len(parts) > 16:
                        held[lang] = summed(parts)
        for lang, parts in held.items():
            for keys, n in summed(parts):
                for i in range(0, len(keys), 50_000):
                    part = keys[i: i + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(part)), pa.array(part.view(np.int64)), pa.array(n[i: i + 50_000])],
                        names=["lang", "gram", "n"])

    counted = labelled.select("lang", "text").mapInArrow(count, COUNTS)
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


# --- models -------------------------------------------------------------------------------------------


class HashArray:
    """Sorted hashes of distinct gram keys; a prefix index leaves a few entries to compare."""

    def __init__(self, keys: np.ndarray):
        hashes = common.mix(keys)
        self.order = np.argsort(hashes)
        self.hashes = np.append(hashes[self.order], np.uint64(2**64 - 1))
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.first = np.searchsorted(self.hashes[:-1], np.arange(1 << self.bits, dtype=np.uint64)
                                     << np.uint64(64 - self.bits)).astype(np.int32)
        self.most = int(np.diff(np.append(self.first, len(keys))).max(initial=0))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of ``keys`` in the sorted hashes, and whether each is there."""
        h = common.mix(keys)
        at = self.first[(h >> np.uint64(64 - self.bits)).astype(np.int64)]
        for _ in range(self.most):
            at += self.hashes[at] < h
        return at, self.hashes[at] == h


def _sorted_sums(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(n, first)


class KneserNey:
    """One language's interpolated model; ``keys`` are distinct 4-grams with counts ``n``."""

    def __init__(self, keys: np.ndarray, n: np.ndarray):
        self.levels = []
        for order in range(ORDER, 0, -1):
            keys, n = _sorted_sums(keys, n)
            once, twice = np.sum(n == 1), np.sum(n == 2)
            discount = min(max(once / (once + 2 * twice), 0.1), 0.95) if once else 0.5
            contexts, first = np.unique(keys >> np.uint64(16), return_index=True)
            total = np.add.reduceat(n, first).astype(np.float64)
            kinds = np.diff(np.append(first, len(keys)))
            self.levels.append((keys, np.maximum(n - discount, 0), contexts, total, discount * kinds / total))
            # the next lower order counts the distinct characters to the left
            mask = np.uint64((1 << (16 * (order - 1))) - 1)
            keys, n = keys & mask, np.ones(len(keys), np.int64)
        self.unseen = 1.0 / (len(self.levels[-1][0]) + 1)

    def probability(self, keys: np.ndarray, level: int = 0) -> np.ndarray:
        """Interpolated probability of the last character of each gram after the others."""
        if level == ORDER:
            return np.full(len(keys), self.unseen)
        grams_, mass, contexts, total, left = self.levels[level]
        lower = self.probability(keys & np.uint64((1 << (16 * (ORDER - level - 1))) - 1), level + 1)
        at = np.minimum(np.searchsorted(grams_, keys), len(grams_) - 1)
        own = np.where(grams_[at] == keys, mass[at], 0.0)
        context = keys >> np.uint64(16)
        c = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
        known = contexts[c] == context
        return np.where(known, own / total[c] + left[c] * lower, lower)


class Models:
    """All languages' models and one table of cross-entropies (bits) by gram and language."""

    def __init__(self, rows: list[tuple[str, int, int]]):
        self.langs = sorted({r[0] for r in rows})
        every = np.array([r[1] for r in rows], np.int64).view(np.uint64)
        n = np.array([r[2] for r in rows], np.int64)
        which = np.array([r[0] for r in rows])
        self.models = [KneserNey(every[which == lang], n[which == lang]) for lang in self.langs]
        keys = np.unique(every)
        self.table = HashArray(keys)
        self.bits = np.zeros((len(keys) + 1, len(self.langs)), np.float32)
        self.bits[:-1] = self._bits(keys[self.table.order])

    def _bits(self, keys: np.ndarray) -> np.ndarray:
        return np.stack([-np.log2(m.probability(keys)) for m in self.models], axis=1)

    def cross_entropy(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bits per character by text and language, the numbers of characters, and whether there is a letter."""
        chars, offsets, has = normalised(*common.code_points(texts))
        sums = np.zeros((len(texts), len(self.langs)))
        keys, cuts = grams(chars, offsets)
        for start in range(0, len(keys), 1 << 17):
            part = keys[start: start + (1 << 17)]
            at, found = self.table.find(part)
            bits = self.bits[np.where(found, at, len(self.bits) - 1)]
            missed = np.flatnonzero(~found)
            if len(missed):
                kinds, back = np.unique(part[missed], return_inverse=True)
                bits[missed] = self._bits(kinds)[back]
            first = np.searchsorted(cuts, start, "right") - 1
            last = np.searchsorted(cuts, start + len(part))
            edges = np.maximum(cuts[first:last], start) - start
            sums[first:last] += np.add.reduceat(bits.astype(np.float64), edges, axis=0)
        return sums / np.diff(cuts)[:, None], np.diff(cuts), has


class SpreadModels:
    """The same models as Spark tables, for counts (lang, gram, n) too many for one broadcast.

    ``levels``, from the highest order down: the mass of each gram and the
    total and left-over share of each context, as maps by language number.
    ``table`` and ``bits`` are as in ``Models``, for the grams of most counts.
    """

    def __init__(self, counts: DataFrame, langs: list[str]):
        self.langs, self.levels = langs, []
        number = F.array_position(F.array(*[F.lit(x) for x in langs]), F.col("lang")) - 1
        level = counts.select(number.cast("int").alias("l"), F.col("gram").alias("key"), "n")
        for order in range(ORDER, 0, -1):
            if order < ORDER:
                level = common.materialise(level.groupBy("l", "key").agg(F.count(F.lit(1)).alias("n")), "lang-level")
            seen = {r["l"]: r for r in level.groupBy("l").agg(
                F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice"),
                F.count(F.lit(1)).alias("kinds")).collect()}  # a row a language
            discounts = [min(max(r["once"] / (r["once"] + 2 * r["twice"]), 0.1), 0.95) if r["once"] else 0.5
                         for r in (seen[i] for i in range(len(langs)))]
            discount = F.element_at(F.array(*[F.lit(float(d)) for d in discounts]), F.col("l") + 1)
            by_lang = lambda c: F.map_from_entries(F.collect_list(F.struct("l", c)))
            mass = level.select("key", "l", F.greatest(F.col("n") - discount, F.lit(0.0)).alias("mass"))
            contexts = level.groupBy(F.shiftrightunsigned("key", 16).alias("context"), "l").agg(
                F.sum("n").cast("double").alias("total"), F.count(F.lit(1)).alias("kinds")).select(
                "context", "l", F.struct("total", (discount * F.col("kinds") / F.col("total")).alias("left")).alias("c"))
            self.levels.append((
                common.materialise(mass.groupBy("key").agg(by_lang("mass").alias("own")), "lang-mass"),
                common.materialise(contexts.groupBy("context").agg(by_lang("c").alias("ctx")), "lang-contexts")))
            level = level.select("l", F.col("key").bitwiseAND(F.lit((1 << (16 * (order - 1))) - 1)).alias("key"))
        self.unseen = [1.0 / (seen[i]["kinds"] + 1) for i in range(len(langs))]
        often = counts.groupBy("gram").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "gram").limit(
            max(1, min(MAX_GRAMS, MAX_BITS // len(langs)))).select("gram")
        often = self.gram_bits(common.materialise(often, "lang-often")).toArrow().combine_chunks()
        keys = often.column("gram").to_numpy().view(np.uint64)
        self.table = HashArray(keys)
        bits = often.column("bits").combine_chunks().flatten().to_numpy().reshape(len(keys), len(langs))
        self.bits = np.concatenate([bits[self.table.order], np.zeros((1, len(langs)), np.float32)])

    def gram_bits(self, grams_: DataFrame) -> DataFrame:
        """Distinct ``grams_`` (gram) with their bits by language: each meets its own row of every level."""
        rows = grams_.withColumn("p", F.array(*[F.lit(u) for u in self.unseen]))
        for order in range(1, ORDER + 1):
            own, contexts = self.levels[ORDER - order]
            key = F.col("gram").bitwiseAND(F.lit((1 << (16 * order)) - 1)) if order < ORDER else F.col("gram")
            # There are no more of these than characters.
            own = F.broadcast(own) if order == 1 else own
            contexts = F.broadcast(contexts) if order <= 2 else contexts
            rows = rows.withColumn("key", key).join(own, "key", "left")
            rows = rows.withColumn("context", F.shiftrightunsigned("key", 16)).join(contexts, "context", "left")
            rows = rows.select("gram", F.expr(
                "transform(p, (x, i) -> nvl(nvl(try_element_at(own, i), 0D) / try_element_at(ctx, i).total "
                "+ try_element_at(ctx, i).left * x, x))").alias("p"))
        return rows.select("gram", F.expr("transform(p, x -> cast(-log2(x) as float))").alias("bits"))


def length_class(n: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(n, 1)).astype(int), 16)


# --- Spark jobs ---------------------------------------------------------------------------------------


def _score(models: Models, texts: pa.Array, limits: dict | None) -> list[pa.Array]:
    """lang_pred, score, bits, length class and rejected of each text."""
    return _judged(models.langs, *models.cross_entropy(texts), limits)


def _judged(names: list[str], bits: np.ndarray, n: np.ndarray, has: np.ndarray, limits: dict | None) -> list[pa.Array]:
    best = np.argmin(bits, axis=1)
    low = bits[np.arange(len(best)), best]
    weight = np.exp2(-(bits - low[:, None]) * np.minimum(n, SURE_LENGTH)[:, None])
    score = np.where(has, 1 / weight.sum(axis=1), 0.0)
    kind = length_class(n)
    langs = [names[i] if ok else "und" for i, ok in zip(best, has)]
    out = ~has
    if limits is not None:
        out |= low > np.array([limits.get((lang, int(k)), np.inf) for lang, k in zip(langs, kind)])
    return [pa.array(langs), pa.array(score), pa.array(low), pa.array(kind.astype(np.int32)), pa.array(out)]


VERDICT = [pa.field("lang_pred", pa.string()), pa.field("score", pa.float64()), pa.field("rejected", pa.bool_())]
JUDGED = "lang_pred string, score double, bits double, kind int, rejected boolean"


def _judge_spread(docs: DataFrame, models: SpreadModels, limits: dict | None) -> DataFrame:
    """``docs`` (text, ...) as _row, with what ``_score`` finds of each.

    Equal texts (by two hashes) are scored once. Their frequent grams are
    summed in the task; the others go by gram to a join with their bits, and
    the sums come back by text.
    """
    spark = docs.sparkSession
    names = models.langs
    shared = spark.sparkContext.broadcast((models.table, models.bits))
    text = F.coalesce("text", F.lit(""))
    on = ["_h1", "_h2"]
    docs = docs.select(F.struct(*docs.columns).alias("_row"), text.alias("_text"), F.xxhash64(text).alias("_h1"),
                       F.xxhash64(F.lit(1), text).alias("_h2"))

    @common.released
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, known = shared.value
        for batch in common.rows_of(batches):
            if not batch.num_rows:
                continue
            chars, offsets, has = normalised(*common.code_points(batch.column(2)))
            keys, cuts = grams(chars, offsets)
            sums, rare = np.zeros((batch.num_rows, len(names))), []
            for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                found, times = np.unique(keys[a:b], return_counts=True)
                at, hit = table.find(found)
                sums[i] = times[hit] @ known[at[hit]].astype(np.float64)
                rare.append([{"gram": g, "times": t} for g, t in zip(found[~hit].view(np.int64).tolist(), times[~hit].tolist())])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.diff(cuts)), pa.array(has), pa.array(list(sums), pa.list_(pa.float64())),
                 pa.array(rare, pa.list_(pa.struct([("gram", pa.int64()), ("times", pa.int64())])))],
                names=[*on, "n", "has", "sums", "rare"])

    parts = common.materialise(docs.select(*on, "_text").mapInArrow(
        part, "_h1 long, _h2 long, n long, has boolean, sums array<double>, rare array<struct<gram:long,times:long>>")
        .dropDuplicates(on), "lang-parts")
    rare = parts.select(*on, F.inline("rare"))
    bits = common.materialise(models.gram_bits(rare.select("gram").distinct()), "lang-rare")
    tails = rare.join(bits, "gram").groupBy(*on).agg(
        F.array(*[F.sum(F.col("times") * F.col("bits")[i]) for i in range(len(names))]).alias("tail"))
    whole = parts.select(*on, "n", "has", "sums").join(tails, on, "left").select(
        *on, "n", "has", F.expr("transform(sums, (x, i) -> x + nvl(tail[i], 0D))").alias("sums"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n = batch.column(2).to_numpy()
                sums = np.array(batch.column(4).to_pylist())
                found = _judged(names, sums / n[:, None], n, batch.column(3).to_numpy(zero_copy_only=False), limits)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *found],
                                                 names=[*on, "lang_pred", "score", "bits", "kind", "rejected"])

    judged = common.materialise(whole.mapInArrow(judge, f"_h1 long, _h2 long, {JUDGED}"), "lang-judged")
    return docs.drop("_text").join(judged, on).drop(*on)


def fit(labelled: DataFrame, calibration: Column) -> tuple[Models | SpreadModels | None, dict]:
    """Models from the rows of ``labelled`` (text, lang) outside ``calibration``, limits from those inside.

    The limit of a language and length class lies far above the
    cross-entropies of its calibration texts, so that clean texts of a rare
    style stay: over their 99.9th percentile by a half and one bit. A class that no such text is in takes the limit
    of the next one.
    """
    spark = common.prepare(labelled.sparkSession)
    labelled = labelled.filter(F.col("lang").isNotNull())
    # a language all of whose texts would calibrate is taught by them too
    labelled = labelled.withColumn("_calibrates", calibration)
    without = [r[0] for r in labelled.groupBy("lang").agg(F.min(F.col("_calibrates").cast("int")).alias("only"))
               .filter("only = 1").collect()]  # a name a language
    teaches = ~F.col("_calibrates")
    taught = labelled.filter(teaches | F.col("lang").isin(without) if without else teaches)
    counts = common.materialise(count_grams(taught.select("lang", "text")), "lang-grams")
    n_counts = counts.count()
    if not n_counts:
        return None, {}
    langs = sorted(r[0] for r in counts.select("lang").distinct().collect())  # a name a language
    if n_counts > MAX_GRAMS or n_counts * len(langs) > MAX_BITS:
        models = SpreadModels(counts, langs)
        measured = _judge_spread(labelled.filter("_calibrates").select("text", "lang"), models, None).select(
            "_row.lang", F.col("lang_pred").alias("pred"), "bits", "kind")
        return models, _limits(models.langs, measured)
    models = Models(list(zip(*(c.to_pylist() for c in counts.toArrow().columns))))
    shared = spark.sparkContext.broadcast(models)

    @common.released
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.rows_of(batches):
            if batch.num_rows:
                pred, _, bits, kind, out = _score(shared.value, batch.column(0), None)
                yield pa.RecordBatch.from_arrays([batch.column(1).cast(pa.string()), pred, bits, kind],
                                                 names=["lang", "pred", "bits", "kind"])

    measured = labelled.filter("_calibrates").select("text", "lang").mapInArrow(
        measure, "lang string, pred string, bits double, kind int")
    return models, _limits(models.langs, measured)


def _limits(langs: list[str], measured: DataFrame) -> dict:
    """By language and length class, from the calibration texts as ``measured`` (lang, pred, bits, kind)."""
    cells = measured.filter("lang = pred").groupBy("lang", "kind").agg(
        F.expr("percentile_approx(bits, 0.999, 10000)").alias("high")).collect()  # languages x 17 rows at most
    seen = {(r["lang"], r["kind"]): r["high"] * 1.5 + 1 for r in cells}
    limits = {}
    for lang in langs:
        own = sorted(k for lg, k in seen if lg == lang)
        for kind in range(LEAST_CLASS, 17 if own else 0):
            near = min((k for k in own if k >= kind), default=own[-1])
            limits[lang, kind] = seen[lang, near]
    return limits


def identify(docs: DataFrame, models: Models | SpreadModels | None, limits: dict) -> DataFrame:
    """``docs`` (text, ...) with lang_pred, score (0 to 1) and rejected."""
    spark = common.prepare(docs.sparkSession)
    own = ["lang_pred", "score", "rejected"]
    docs = docs.drop(*own)
    if models is None:
        return docs.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0), "rejected": F.lit(True)})
    if isinstance(models, SpreadModels):
        return _judge_spread(docs, models, limits).select("_row.*", *own)
    shared = spark.sparkContext.broadcast((models, limits))

    def verdict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            parts = [_score(shared.value[0], batch.slice(i, common.ROWS_AT_ONCE), shared.value[1])
                     for i in range(0, len(batch), common.ROWS_AT_ONCE)]
            if not parts:
                yield pa.array([], pa.struct(VERDICT))
                continue
            yield pa.concat_arrays([pa.StructArray.from_arrays([p[0], p[1], p[4]], fields=VERDICT) for p in parts])
        common.release()

    verdict.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    judged = docs.withColumn("_verdict", F.arrow_udf(verdict, "lang_pred string, score double, rejected boolean")("text"))
    return judged.select(*docs.columns, "_verdict.*")
