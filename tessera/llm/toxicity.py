"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The features are rates and counts: words of a fixed list of insults, terms
(words and word beginnings) that labelled toxic texts have and others lack,
how near they stand to the second person, capitals, punctuation, and words
disguised by digits or signs. Spark's trees learn from a bounded sample of the
labelled rows, and isotonic regression on rows the trees have not seen turns
their output into a probability.

Nulls, empties, ties: a null text counts as empty, whose features are zero and
which is scored like any other. Rows without a label, or whose label is null,
teach nothing; of several labels of a doc_id the highest counts. With no
labelled row, or labels of one kind only, every text scores their mean (0
without any). Repeated rows are scored each. Texts are read whole. Other
columns pass through unless the operator's own (score) has their name.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import common

#: Labelled documents that teach at most: the first by hash of doc_id.
MAX_TRAINING = 12_000
#: Learned terms at most, and the length in characters of word beginnings.
MAX_TERMS = 96
STEMS = (4, 5, 6)
NEAR = 40  # characters

# Common insults and second-person pronouns of the languages handled.
INSULTS = ("idiot idiots moron morons stupid loser losers scum pathetic worthless disgusting trash clown clowns dumb fool "
           "garbage jerk imbecile dummkopf trottel arschloch idiota imbécil estúpido estúpida connard abruti").split()
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine tu te toi ton vous votre ti usted tus".split()
# Signs and digits that stand for letters in disguised words.
DISGUISES = {"@": "a", "4": "a", "3": "e", "1": "i", "!": "i", "0": "o", "$": "s", "5": "s", "7": "t", "+": "t"}

FEATURES = ["insults", "insult_rate", "terms", "term_rate", "term_weight", "top_weight", "second_rate", "near_second",
            "capital_rate", "shout_rate", "punctuation_rate", "exclamation_rate", "digit_rate", "disguised_rate",
            "disguised_hits", "mean_word", "log_words"]
WORD = re.compile(r"[^\W\d_]+")
DISGUISED = re.compile(r"(?<=[^\W\d_])[" + re.escape("".join(DISGUISES)) + r"](?=[^\W\d_])")


# --- learned terms ------------------------------------------------------------------------------


def terms_of(text: str) -> set[str]:
    """Distinct words of a text, and their beginnings marked by a star."""
    words = set(WORD.findall(text.lower()))
    out = set(words)
    for n in STEMS:
        out.update(w[:n] + "*" for w in words if len(w) > n)
    return out


def learn_terms(sample: DataFrame) -> dict[str, float]:
    """The MAX_TERMS terms that tell toxic texts of ``sample`` (text, toxic) best, with their log-odds ratio."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, clean = Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                (toxic if label else clean).update(terms_of(text or ""))
        terms = list(toxic.keys() | clean.keys())
        for i in range(0, len(terms), 50_000):
            part = terms[i: i + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.string()), pa.array([toxic[t] for t in part], pa.int64()),
                 pa.array([clean[t] for t in part], pa.int64())], names=["term", "toxic", "clean"])

    total = sample.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    n_toxic, n_clean = int(total[0] or 0), int(total[1] - (total[0] or 0))
    counts = sample.select("text", "toxic").mapInArrow(count, "term string, toxic long, clean long")
    odds = (F.log((F.col("toxic") + 0.5) / F.lit(n_toxic + 1.0)) - F.log((F.col("clean") + 0.5) / F.lit(n_clean + 1.0)))
    error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    best = (counts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
            .filter(F.col("toxic") >= max(4, math.ceil(0.01 * n_toxic)))
            .select("term", odds.alias("odds"), "toxic", (odds / error).alias("z"))
            .filter((F.col("odds") >= 3) & (F.col("z") >= 1.64))
            # much evidence first: the share of toxic texts that the term explains, then the surest
            .orderBy(F.desc(F.col("toxic") * F.col("odds")), "term").limit(MAX_TERMS))
    return {r["term"]: float(r["odds"]) for r in best.collect()}


# --- features --------------------------------------------------------------------------------------


class Features:
    """Dense features of texts, given the learned terms."""

    def __init__(self, terms: dict[str, float]):
        finder = ahocorasick.Automaton()
        kinds: dict[str, tuple] = {}
        for words, kind in ((INSULTS, "insult"), (SECOND_PERSON, "second")):
            for w in words:
                kinds[w] = (*kinds.get(w, ()), (kind, True, 0.0))
        for term, odds in terms.items():
            stem = term.removesuffix("*")
            kinds[stem] = (*kinds.get(stem, ()), ("term", stem == term, odds))
        for w, what in kinds.items():
            finder.add_word(w, (len(w), what))
        finder.make_automaton()
        self.finder = finder
        upper, letter, punctuation, digit, sign = (np.zeros(1 << 16, bool) for _ in range(5))
        for c in range(1 << 16):
            upper[c], letter[c] = chr(c).isupper(), chr(c).isalpha()
        for c in range(33, 127):
            punctuation[c] = not chr(c).isalnum()
            digit[c] = chr(c).isdigit()
            sign[c] = chr(c) in DISGUISES
        self.upper, self.letter, self.punctuation, self.digit, self.sign = upper, letter, punctuation, digit, sign

    def hits(self, text: str) -> tuple[list[int], dict[int, float], list[int]]:
        """Ends of insults, of terms (with odds; one per word), and of second-person words, in a lower-cased text."""
        insults, terms, second = [], {}, []
        for end, (n, what) in self.finder.iter(text):
            if end >= n and text[end - n].isalpha():
                continue
            whole = end + 1 == len(text) or not text[end + 1].isalpha()
            for kind, needs_whole, odds in what:
                if needs_whole and not whole:
                    continue
                if kind == "insult":
                    insults.append(end)
                elif kind == "second":
                    second.append(end)
                else:
                    start = end - n + 1
                    terms[start] = max(odds, terms.get(start, 0.0))
        return insults, terms, second

    def rows(self, texts: pa.Array) -> np.ndarray:
        """A row of FEATURES for each text."""
        points, offsets = common.code_points(texts)
        small = np.minimum(points, 0xFFFF)
        letter, sign = self.letter[small], self.sign[small]
        starts = letter.copy()
        starts[1:] &= ~letter[:-1]
        first = offsets[:-1][offsets[:-1] < offsets[1:]]
        starts[first] = letter[first]
        upper = self.upper[small]
        shout = upper.copy()
        shout[1:] &= upper[:-1]
        inner = np.zeros(len(points), bool)
        if len(points) > 2:
            inner[1:-1] = sign[1:-1] & letter[:-2] & letter[2:]
        sums = {k: np.concatenate([[0], np.cumsum(v)])[offsets] for k, v in (
            ("letter", letter), ("word", starts), ("upper", upper), ("shout", shout), ("inner", inner),
            ("punctuation", self.punctuation[small]), ("exclamation", points == 33), ("digit", self.digit[small]))}
        n = {k: np.diff(v).astype(float) for k, v in sums.items()}
        out = np.zeros((len(texts), len(FEATURES)))
        for i, text in enumerate(texts.to_pylist()):
            if not text:
                continue
            low = text.lower()
            insults, terms, second = self.hits(low)
            words = max(n["word"][i], 1.0)
            marks = insults + list(terms)
            near = 0
            if marks and second:
                where, each = np.sort(second), np.array(marks)
                near = int((np.searchsorted(where, each + NEAR, "right") > np.searchsorted(where, each - NEAR)).sum())
            disguised = 0
            if n["inner"][i]:
                again = self.hits(DISGUISED.sub(lambda m: DISGUISES[m[0]], low))
                disguised = max(0, len(again[0]) + len(again[1]) - len(marks))
            out[i, :8] = (math.log1p(len(insults)), len(insults) / words, math.log1p(len(terms)), len(terms) / words,
                          sum(terms.values()) / math.sqrt(words), max(terms.values(), default=0.0),
                          len(second) / words, math.log1p(near))
            out[i, 14] = math.log1p(disguised)
        words, chars = np.maximum(n["word"], 1), np.maximum(np.diff(offsets), 1)
        letters = np.maximum(n["letter"], 1)
        out[:, 8], out[:, 9] = n["upper"] / letters, n["shout"] / letters
        out[:, 10], out[:, 11], out[:, 12] = n["punctuation"] / chars, n["exclamation"] / chars, n["digit"] / chars
        out[:, 13], out[:, 15], out[:, 16] = n["inner"] / words, n["letter"] / words, np.log1p(n["word"])
        return out


def with_features(docs: DataFrame, terms: dict[str, float]) -> DataFrame:
    """``docs`` without their text, with FEATURES."""
    spark = common.prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(terms)
    place = docs.columns.index("text")
    kept = [c for c in docs.columns if c != "text"]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(shared.value)
        for batch in common.rows_of(batches, 500):
            rows = features.rows(batch.column(place))
            own = [batch.column(i) for i in range(batch.num_columns) if i != place]
            yield pa.RecordBatch.from_arrays([*own, *(pa.array(c) for c in rows.T)], names=kept + FEATURES)

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "text"),
                        *(f"{f} double" for f in FEATURES)])
    return docs.mapInArrow(make, schema)


# --- learning and scoring -------------------------------------------------------------------------------


def fit(docs: DataFrame, labels: DataFrame, seed: int = 7) -> dict:
    """Terms, trees and calibration from at most MAX_TRAINING rows of ``labels`` (doc_id, toxic) and their texts.

    Three quarters of the sample teach terms and trees, the rest calibrates.
    """
    spark = common.prepare(docs.sparkSession)
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        (F.max("toxic") > 0).cast("int").alias("toxic"))
    known = known.withColumn("h", F.xxhash64("doc_id", F.lit(seed))).orderBy("h", "doc_id").limit(MAX_TRAINING)
    # Written: its bounded size is then known to the planner, which joins it without moving the texts.
    known = common.materialise(known.select("doc_id", "toxic", (F.pmod("h", F.lit(4)) == 0).alias("calibrates")),
                               "toxic-sample")
    # one text an id (the smallest), so that the sample stays within its bound whatever ids repeat
    texts = docs.select("doc_id", "text").join(known.select("doc_id"), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    sample = common.materialise(texts.join(known, "doc_id"), "toxic-texts")
    teach = sample.filter(~F.col("calibrates"))
    kinds = {r[0]: r[1] for r in teach.groupBy("toxic").count().collect()}
    if len(kinds) < 2:
        mean = sample.agg(F.avg("toxic")).first()[0]
        return {"constant": float(mean or 0.0), "terms": {}}
    terms = learn_terms(teach)
    featured = common.materialise(
        _assembled(with_features(sample.select("text", "toxic", "calibrates"), terms)).select(
            "features", F.col("toxic").cast("double").alias("label"), "calibrates"), "toxic-features")
    trees = GBTClassifier(maxIter=20, maxDepth=4, stepSize=0.3, subsamplingRate=1.0, seed=seed,
                          checkpointInterval=-1).fit(featured.filter(~F.col("calibrates")))
    raw = trees.transform(featured.filter("calibrates")).select("label", _raw())
    calibration = IsotonicRegression(featuresCol="raw", labelCol="label").fit(raw) if raw.head(1) else None
    return {"terms": terms, "trees": trees, "calibration": calibration}


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows).drop(*FEATURES)


def _raw():
    return vector_to_array("probability")[1].alias("raw")


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` without their text, with ``score`` in [0, 1]."""
    docs = docs.drop("score")
    if "constant" in model:
        return docs.drop("text").withColumn("score", F.lit(model["constant"]))
    kept = [c for c in docs.columns if c != "text"]
    # Under names of the operator's own, so that no column of the input is in its way.
    rows = with_features(docs.select(F.struct(*kept).alias("_row"), "text"), model["terms"])
    rows = model["trees"].transform(_assembled(rows)).select("_row", _raw())
    if model["calibration"] is not None:
        rows = model["calibration"].transform(rows).withColumnRenamed("prediction", "_score")
    else:
        rows = rows.withColumn("_score", F.col("raw"))
    return rows.select("_row.*", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "_score")).alias("score"))
