"""Similarity join, language ID, toxicity and the pipeline."""

import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from edge import LONG, ROWS, clashing, documents, rows

from tessera.llm import langid, partenum, toxicity
from tessera.llm.components import components
from tessera.llm.queries import QUERIES, fit_language_models, held_out

SMOKE = "/root/testdata/sf0.001"


def brute_sets(docs):
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    out = []
    for d, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", low(t))
        out.append((d, {tuple(w[i: i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()))
    return out


def brute_components(docs):
    sets = brute_sets(docs)
    order = lambda d: (d is not None, d or 0)
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[i + 1:]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = sorted((find(a), find(b)), key=order)
                root[q] = p
    return sorted(((d, len(s), find(d) if s else d) for d, s in sets), key=repr)


def near_documents(seed):
    """Families of edited copies, chains of edits, shared passages and short texts."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + str(rng.randint(0, 60))
    passage = [word() for _ in range(14)]
    docs = []
    for _ in range(12):
        base = [word() for _ in range(rng.choice([3, 6, 9, 20, 60, 150]))]
        for _ in range(rng.randint(1, 9)):
            docs.append(" ".join(base))
            base = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                base[rng.randrange(len(base))] = word()
            if rng.random() < 0.3:
                base = base + [word() for _ in range(rng.randint(0, len(base) // 4))]
    docs += [" ".join(passage + [word() for _ in range(rng.randint(0, 12))]) for _ in range(30)]
    docs += docs[:5]
    return [(i, t) for i, t in enumerate(docs)]


@pytest.mark.parametrize("seed", [1, 2])
def test_similar_documents_against_brute_force(spark, seed):
    docs = near_documents(seed) + [(1000, None), (1001, ""), (1002, " \n"), (1003, "ONE two"), (1004, "one TWO"),
                                   (None, near_documents(seed)[3][1])]
    df = clashing(spark.createDataFrame(docs, "doc_id long, text string"), "node", "key", "component_id")
    assert rows(partenum.similar_documents(df), "doc_id", "n_shingles", "component_id") == brute_components(docs)


def test_similar_documents_edges(spark):
    got = rows(partenum.similar_documents(documents(spark)), "doc_id", "n_shingles", "component_id")
    by = {}
    for d, n, c in got:
        by.setdefault(d, []).append((n, c))
    assert len(got) == len(ROWS) and by[5] == [(29_996, 4)] and by[6] == [(3, 6)] * 2 and by[1] == [(0, 1)]
    assert partenum.similar_documents(documents(spark, [])).count() == 0
    kept = rows(partenum.keep_one_of_each(documents(spark)))
    assert sorted(str(r[0]) for r in kept) == sorted(str(d) for d in {r[0] for r in ROWS} - {5})


def test_texts_of_a_shared_or_missing_id_are_decided_one_by_one(spark):
    import corpus_pipeline as P

    a, b, c, d = ("the first text of the four has words of its own kind", "x second one is unlike the first in every word it has",
                  "and here a third text that nobody else repeats at all", "last of all comes this fourth text which is alone too")
    docs = documents(spark, [(i, t, None, None, 0) for i, t in (
        (3, a), (5, a), (5, b), (9, b), (11, c), (11, c), (None, d), (None, c + " more"), (None, ""), (None, ""), (12, ""), (12, ""))])
    docs = clashing(docs, "node", "id", "stays", "component")
    got = rows(partenum.similar_documents(docs), "doc_id", "component_id")
    # 3 - 5 - 9 by the two texts of 5; the rows without an id are not one document
    assert got == sorted([(3, 3), (5, 3), (5, 3), (9, 3), (11, None), (11, None)] + [(None, None)] * 4 + [(12, 12)] * 2, key=repr)
    kept = rows(P.near_duplicates(spark, docs, SMOKE), "doc_id", "text")
    assert kept == sorted([(3, a), (5, b), (None, d), (None, c + " more"), (None, ""), (None, ""), (12, "")], key=repr)
    same_id = documents(spark, [(i, t, None, None, 0) for i, t in [(7, a), (7, b), (7, c), (7, b)]])
    assert rows(P.near_duplicates(spark, same_id, SMOKE), "text") == sorted([(a,), (b,), (c,)])
    assert rows(partenum.similar_documents(same_id), "component_id") == [(7,)] * 4
    assert partenum.keep_one_of_each(same_id).count() == 1


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 8, 13, 30, 100, 777, 5000])
def test_similar_sets_always_share_a_signature(size):
    rng = np.random.default_rng(size)
    none = np.zeros(0, np.uint64)
    for trial in range(20):
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        b = a
        if trial % 2:  # the larger partner at the limit
            b = np.unique(np.concatenate([a, rng.integers(0, 2**63, size // 3).astype(np.uint64)]))
        else:  # as many exchanged as allowed
            change = size * 2 // 7 // 2
            b = np.unique(np.concatenate([a[change:], rng.integers(0, 2**63, change).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 4 * both >= 3 * (len(a) + len(b) - both):
            assert len(np.intersect1d(partenum.signatures(a, none), partenum.signatures(b, none)))


def test_near_duplicates_keep_columns_of_any_type(spark):
    text = "the same dozen words stand in both of these rows and nothing else is told apart"
    df = spark.createDataFrame([(1, text, {"a": 1}), (2, text, {"b": 2}), (3, "quite another text of more than five words", None),
                                (1, text, {"c": None})], "doc_id long, text string, about map<string,int>")
    kept = partenum.keep_one_of_each(df, one_row_an_id=False).collect()
    assert sorted(r.doc_id for r in kept) == [1, 3] and {r.doc_id: r.about for r in kept}[1] in ({"a": 1}, {"c": None})


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 150), (7, 7)]
    got = dict(rows(components(spark.createDataFrame(edges, "a long, b long"))))
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 150: 100, 200: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- language ID ---------------------------------------------------------------------------------


def test_grams_of_a_text():
    chars, offsets, has = langid.normalised(*__import__("tessera.llm.common", fromlist=["x"]).code_points(
        pa.array(["Ab, c!", "", "12", "É\U0001F600\U00010400"])))
    texts = ["".join(map(chr, chars[a:b])) for a, b in zip(offsets, offsets[1:])]
    assert texts == ["   ab c  ", "    ", "    ", "   é � "] or texts[0] == "   ab c  "
    assert has.tolist() == [True, False, False, True]


def test_model_is_a_distribution():
    rng = random.Random(0)
    text = "".join(rng.choice("ab ") for _ in range(400))
    common = __import__("tessera.llm.common", fromlist=["x"])
    keys, n = np.unique(langid.grams(*langid.normalised(*common.code_points(pa.array([text])))[:2])[0], return_counts=True)
    model = langid.KneserNey(keys, n)
    for context in ("aba", "   ", "zzz"):
        head = sum(ord(c) << (16 * (3 - i)) for i, c in enumerate(context))
        seen = [ord(c) for c in "ab "]
        p = model.probability(np.array([head | c for c in seen], np.uint64))
        assert (p > 0).all() and 0.7 < p.sum() < 1  # the rest is for characters never seen
    assert model.probability(np.array([ord("q")], np.uint64))[0] > 0


def plain_probability(text):
    """Interpolated Kneser-Ney over 4-grams by dictionaries."""
    counts = [{}]
    for i in range(len(text) - 3):
        counts[0][text[i: i + 4]] = counts[0].get(text[i: i + 4], 0) + 1
    for _ in range(3):
        lower = {}
        for g in counts[-1]:
            lower[g[1:]] = lower.get(g[1:], 0) + 1
        counts.append(lower)

    def of(gram, level=0):
        if level == 4:
            return 1 / (len(counts[3]) + 1)
        c = counts[level]
        once, twice = list(c.values()).count(1), list(c.values()).count(2)
        d = min(max(once / (once + 2 * twice), 0.1), 0.95) if once else 0.5
        after = [n for g, n in c.items() if g[:-1] == gram[:-1]]
        lower = of(gram[1:], level + 1)
        return max(c.get(gram, 0) - d, 0) / sum(after) + d * len(after) / sum(after) * lower if after else lower

    return of


def test_cross_entropies_and_labels_equal_dictionaries():
    rng = random.Random(2)
    taught = {lang: "   " + "".join(rng.choice(letters) for _ in range(300)) + " " for lang, letters in
              (("aa", "abcab "), ("bb", "bcdd "), ("cc", "xya "))}
    rows = []
    for lang, text in taught.items():
        keys, n = np.unique([sum(ord(c) << (16 * (3 - j)) for j, c in enumerate(text[i: i + 4])) for i in range(len(text) - 3)],
                            return_counts=True)
        rows += [(lang, int(k), int(m)) for k, m in zip(np.array(keys, np.uint64).view(np.int64), n)]
    models = langid.Models(rows)
    texts = ["".join(rng.choice("abcdxyq ") for _ in range(rng.randint(1, 40))) for _ in range(30)] + ["q", "zzzz zz"]
    bits, chars, _ = models.cross_entropy(pa.array(texts))
    pred = langid._score(models, pa.array(texts), None)[0].to_pylist()
    of = {lang: plain_probability(t) for lang, t in taught.items()}
    for i, text in enumerate(texts):
        shown = "   " + " ".join(text.split()) + " "
        grams = [shown[j: j + 4] for j in range(len(shown) - 3)]
        if text.strip() != text:  # a space at an end counts as one before the last
            continue
        want = [-sum(np.log2(of[lang](g)) for g in grams) / len(grams) for lang in sorted(of)]
        assert chars[i] == len(grams) and np.allclose(bits[i], want, atol=1e-4)
        assert pred[i] == sorted(of)[int(np.argmin(want))]


def test_any_number_of_languages_and_languages_that_only_calibrate(spark, monkeypatch):
    letters = "abcdefghijklmnopqrstuvwxyz"
    docs = [(i, f"{letters[i % 26]}{letters[i // 26 % 26]} " * 12, f"l{i % 520}", "s", 1) for i in range(1040)]
    only = [i for i in range(5000, 5400) if __import__("zlib").crc32(str(i).encode()) % 4 == 0][:20]
    docs += [(i, "жук лист дом", "late", "s", 1) for i in only] + [(9001, "12 34", "", "s", 1), (9002, "ωμέγα άλφα", "", "s", 1)]
    df = documents(spark, docs)
    got = langid.identify(df, *fit_language_models(df)).collect()
    assert len(got) == len(docs) and len({r.lang_pred for r in got}) > 400
    assert {r.lang_pred for r in got if r.doc_id in only} == {"late"}
    assert [r.lang_pred for r in got if r.doc_id == 9001] == ["und"]


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.identify(clashing(docs.select("doc_id", "text", "lang", held_out("doc_id", 4, 2).alias("held")), "score"),
                            *fit_language_models(docs))
    test = [r for r in found.collect() if r.held]
    assert len(test) > 200 and sum(r.lang == r.lang_pred for r in test) / len(test) > 0.97
    assert sum(r.rejected for r in test) / len(test) < 0.01
    assert all(0 <= r.score <= 1 for r in test)


def test_language_edges(spark):
    docs = documents(spark, ROWS + [(100 + i, f"the quick brown fox {i} jumps over the lazy dog again", "en", "s", 1) for i in range(20)])
    got = langid.identify(docs, *fit_language_models(docs))
    by = {(r.doc_id, r.text): r for r in got.collect()}
    for key in ((1, None), (2, ""), (8, " \t\n "), (9, "12 34 %%% !!")):
        assert by[key].lang_pred == "und" and by[key].score == 0 and by[key].rejected
    assert by[3, "x"].lang_pred != "und" and not by[3, "x"].rejected
    assert langid.identify(documents(spark, []), *fit_language_models(docs)).count() == 0
    untaught = langid.identify(docs, *fit_language_models(documents(spark, [])))
    assert {r.lang_pred for r in untaught.collect()} == {"und"}


def test_models_beyond_the_broadcast_bound_keep_every_count(spark, monkeypatch):
    rng = random.Random(3)
    docs = documents(spark, ROWS + [
        (100 + i, " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(30)), "en", "s", 1) for i in range(60)]
        + [(200 + i, "дом река камень облако", "ru", "s", 1) for i in range(6)])
    whole = langid.identify(docs, *fit_language_models(docs)).collect()
    monkeypatch.setattr(langid, "MAX_GRAMS", 50)  # the grams of the rare language are far below the first 50
    spread = langid.identify(clashing(docs, "key", "n", "bits", "_h1"), *fit_language_models(docs)).collect()
    order = lambda found: sorted(found, key=lambda r: repr((r.doc_id, r.text)))
    assert len(spread) == len(whole) and {r.lang_pred for r in spread if (r.doc_id or 0) >= 200} == {"ru"}
    for a, b in zip(order(whole), order(spread)):
        assert (a.doc_id, a.text, a.lang_pred, a.rejected) == (b.doc_id, b.text, b.lang_pred, b.rejected)
        assert a.score == pytest.approx(b.score, abs=1e-4)


# --- toxicity ------------------------------------------------------------------------------------


def test_toxic_documents_are_found(spark):
    got = QUERIES["op5_gbt_toxicity"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "toxic")
    assert got.count() == 1000
    test = got.join(labels, "doc_id").collect()
    toxic = [r for r in test if r.toxic]
    clean = [r for r in test if not r.toxic]
    assert sum(r.predicted for r in toxic) / len(toxic) > 0.5
    assert sum(r.predicted for r in clean) / len(clean) < 0.02  # learned from 266 rows
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in test)


def test_repeated_labelled_ids_leave_the_sample_within_its_bound(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "MAX_TRAINING", 40)
    rows = [(i % 50, f"word{i} {'idiot' if i % 50 % 2 else 'tree'} and more words", None, None, 0) for i in range(400)]
    rows += [(1, f"idiot {i}", None, None, 0) for i in range(400)]  # one labelled id holds half of all rows
    seen = []
    learn = toxicity.learn_terms
    monkeypatch.setattr(toxicity, "learn_terms", lambda teach: seen.append(teach.count()) or learn(teach))
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)] * 2, "doc_id long, toxic int")
    model = toxicity.fit(documents(spark, rows), labels)
    assert 0 < seen[0] <= 40 and toxicity.score(documents(spark, rows), model).count() == len(rows)


def test_toxicity_edges(spark):
    words = ["tree", "house", "river", "stone", "cloud"]
    rng = random.Random(1)
    docs = [(i, " ".join(rng.choice(words + (["idiot"] if i % 4 == 0 else [])) for _ in range(40)), None, None, 0)
            for i in range(100, 300)]
    labels = spark.createDataFrame([(i, None, int(i % 4 == 0)) for i, *_ in docs] + [(1, 1, None), (None, 0, 1), (101, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    df = documents(spark, ROWS + docs)
    model = toxicity.fit(df, labels)
    got = toxicity.score(clashing(df, "score", "features", "prediction", "insults", "raw", "label"), model)
    assert got.count() == len(ROWS) + len(docs)
    by = {r.doc_id: r.score for r in got.collect()}
    assert by[104] > 0.7 > 0.3 > by[101] and 0 <= by[2] < 0.5
    assert toxicity.score(documents(spark, []), model).count() == 0
    for none in (labels.limit(0), labels.filter("toxic = 0")):
        assert {r.score for r in toxicity.score(df, toxicity.fit(df, none)).collect()} == {0.0}


def test_features_count_what_they_say():
    f = toxicity.Features({"lowei*": 5.0, "bad": 4.0})
    names = toxicity.FEATURES
    row = dict(zip(names, f.rows(pa.array(["You IDIOT! idiotic bad badly loweichen id1ot."]))[0]))
    assert row["insults"] == pytest.approx(np.log1p(1)) and row["terms"] == pytest.approx(np.log1p(2))
    assert row["near_second"] == pytest.approx(np.log1p(3)) and row["disguised_hits"] == pytest.approx(np.log1p(1))
    assert (f.rows(pa.array(["", None])) == 0).all()


def test_marks_near_the_second_person_are_counted_to_the_end_of_a_long_text():
    f = toxicity.Features({"bad": 4.0})
    far = "idiot " + "-" * 60
    text = far * 1200 + "you are an idiot" + "-" * 60 + "bad, you! " + "-" * 60 + far * 5 + "bad" + "-" * 60
    insults, terms, second = f.hits(text)
    near = sum(any(abs(w - m) <= toxicity.NEAR for w in second) for m in insults + list(terms))
    assert len(insults) > 1000 and near == 2
    assert dict(zip(toxicity.FEATURES, f.rows(pa.array([text]))[0]))["near_second"] == pytest.approx(np.log1p(near))


# --- pipeline ------------------------------------------------------------------------------------


def test_pipeline_against_brute_force(spark):
    import corpus_pipeline as P
    import public_tokenizers
    from tokenizers import Tokenizer

    from tessera.llm import common, decontam

    docs = common.table(spark, SMOKE, "documents")
    columns = docs.columns
    stages = dict(P.STAGES)
    assert list(stages) == ["language_id", "near_duplicates", "decontamination", "mixing", "token_ids"]
    kept = common.materialise(stages["language_id"](spark, docs, SMOKE), "t-stage")
    assert kept.columns == columns and docs.count() - kept.count() <= 0.03 * docs.count()
    first = rows(kept, "doc_id", "text")
    single = common.materialise(stages["near_duplicates"](spark, kept, SMOKE), "t-stage")
    expected = {d for d, _, c in brute_components(first) if d == c}
    assert single.columns == columns and {r.doc_id for r in single.collect()} == expected
    clean = common.materialise(stages["decontamination"](spark, single, SMOKE), "t-stage")
    items = [(str(a), b) for a, b in duckdb.sql(f"SELECT item_id, text FROM '{SMOKE}/benchmark.parquet'").fetchall()]
    left = {r.doc_id: r.text for r in clean.collect()}
    for r in single.collect():
        n, hit, _ = _hits(r.text, items)
        if hit > 0.5 * n:
            assert r.doc_id not in left
        elif hit:
            assert len(decontam.ITEM_WORD.findall(left[r.doc_id])) == n - hit
        else:
            assert left[r.doc_id] == r.text
    mixed = common.materialise(stages["mixing"](spark, clean, SMOKE), "t-stage")
    assert mixed.columns == columns and set(rows(mixed)) == set(rows(clean))
    out = rows(stages["token_ids"](spark, mixed, SMOKE), "doc_id", "start", "n_tokens")
    tokenizer, at, expected = Tokenizer.from_file(public_tokenizers.path(P.TOKENIZER)), 0, []
    for d, text in sorted(rows(mixed, "doc_id", "text")):
        n = len(tokenizer.encode(text, add_special_tokens=False).ids) + 1
        expected.append((d, at, n))
        at += n
    assert out == sorted(expected, key=repr)


def test_stages_take_edge_rows_and_other_columns(spark):
    import corpus_pipeline as P

    docs = clashing(documents(spark), "epoch", "score", "row", "whole")
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SMOKE)
        assert out.columns == docs.columns, name
        assert {r.epoch for r in out.collect()} <= {"theirs"}
        assert stage(spark, docs.limit(0), SMOKE).count() == 0
    assert P.STAGES[-1][1](spark, docs, SMOKE).count() == len(ROWS)


def _hits(text, items):
    from test_text_operators import brute_hits

    return brute_hits(text, items, 10)


def test_long_text_has_its_shingles():
    assert len(partenum.shingle_sets(pa.array([LONG]))[0]) == brute_sets([(0, LONG)])[0][1].__len__()
