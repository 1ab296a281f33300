"""Language ID, toxicity, language-model scores."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textloom.llm import langid, lm_score, toxicity
from textloom.llm.common import held_out, table

SF = "/root/testdata/sf0.01"
A = "the of and to in that is was for with house water green stone".split()
B = "der die und ein nicht von mit sich auch wasser stein grün haus".split()
C = "дом вода камень и в не на что как это".split()


def training(spark, n=200):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(v) for _ in range(30)), lang) for i in range(n) for v, lang in ((A, "en"), (B, "de"), (C, "ru"))]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_language_accuracy_on_held_out(spark):
    docs = table(spark, SF, "documents")
    got = langid.op3_language_id(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(got) > 200 and (got.lang_pred == got.lang).mean() > 0.99
    assert got.score.between(0, 1).all()


def test_language_spans_and_edge_cases(spark):
    model = langid.learn(training(spark))
    mixed = " ".join(A * 3 + B * 3 + A)
    rows = [(1, mixed), (2, None), (3, ""), (4, "123 !! 456"), (5, "дом вода камень"), (6, "the " * 50000), (7, "日本語"), (8, "House"), (8, "House")]
    df = spark.createDataFrame([(*r, "xx", 1.0) for r in rows], "doc_id long, text string, lang string, score double")
    got = {r.doc_id: r for r in langid.identify(df, model).collect()}
    assert [(s.lang, s.words) for s in got[1].spans] == [("en", 42), ("de", 39), ("en", 14)]
    assert got[1].lang_pred == "en" and 0.4 < got[1].score < 0.8
    assert all((got[i].lang_pred, got[i].score) == ("und", 0) for i in (2, 3, 4))
    assert got[5].lang_pred == "ru" and got[6].lang_pred == "en" and got[8].lang_pred == "en"
    assert got[7].lang_pred in ("de", "en", "ru") and got[7].score < 0.5
    assert langid.identify(df, None).where("lang_pred <> 'und'").count() == 0
    assert langid.learn(df.limit(0)) is None
    kept = langid.identified(training(spark).unionByName(df.select("doc_id", "text", F.lit(None).cast("string").alias("lang"))))
    assert kept.columns == ["doc_id", "text", "lang"] and kept.count() == 600 + 5
    assert langid.identified(df.limit(0)).collect() == []


def test_viterbi_is_the_best_path_and_the_shortcut_agrees():
    rng = np.random.default_rng(0)
    for _ in range(30):
        e = -rng.integers(0, 4, size=(6, 3)).astype(float)
        path = langid.viterbi(e, 2.5)

        def value(p):
            return sum(e[t, k] for t, k in enumerate(p)) - 2.5 * sum(a != b for a, b in zip(p, p[1:]))

        best = max(value((a, b, c, d, f, g)) for a in range(3) for b in range(3) for c in range(3) for d in range(3) for f in range(3) for g in range(3))
        assert value(path.tolist()) == pytest.approx(best)
    e = -rng.integers(0, 3, size=(500, 2)).astype(float)
    bounds = np.array([0, 100, 250, 500])
    owner = np.repeat(np.arange(3), np.diff(bounds))
    got = langid._most_ahead(e[:, 0] - e[:, 1], owner, bounds[:-1], 3)
    for i in range(3):
        g = (e[:, 0] - e[:, 1])[bounds[i] : bounds[i + 1]]
        assert got[i] == pytest.approx(max(g[a:b].sum() for a in range(len(g)) for b in range(a + 1, len(g) + 1)))


def _plain_identification(text, model):
    """One text by the definition: every word scored by itself, Viterbi over all of them, no shortcut."""
    lowered = (text or "").lower().split()
    if not lowered:
        return "und", 0.0, []
    each = [model.emissions(pa.array([w], pa.large_string())) for w in lowered]
    scores, letters = np.concatenate([e for e, _ in each]), np.array([int(n[0]) for _, n in each])
    if not letters.sum():
        return "und", 0.0, []
    path = langid.viterbi(scores).tolist()
    by = [sum(int(n) for n, k in zip(letters, path) if k == lang) for lang in range(len(model.langs))]
    best = by.index(max(by))
    sums = scores[[k == best for k in path]].sum(axis=0)
    spans, at = [], 0
    while at < len(path):
        end = next((i for i in range(at, len(path)) if path[i] != path[at]), len(path))
        spans.append((at, end - at, model.langs[path[at]]))
        at = end
    return model.langs[best], by[best] / letters.sum() / sum(math.exp(s - sums[best]) for s in sums), spans


def test_language_query_equals_plain_viterbi(spark):
    """All documents of sf0.001, and mixes of three to five short stretches of its four languages."""
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    model = langid.learn(langid.training_rows(docs))
    assert len(model.langs) >= 3
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    by_lang = {r.lang: r.text.split() for r in docs.where("lang is not null and length(text) > 2000").collect()}
    rng = random.Random(3)
    for i in range(300):
        mixed = []
        for _ in range(rng.randint(3, 5)):
            lang = rng.choice(sorted(by_lang))
            at = rng.randrange(max(1, len(by_lang[lang]) - 12))
            mixed += by_lang[lang][at : at + rng.randint(1, 12)]
        rows.append((10_000 + i, " ".join(mixed)))
    got = {r.doc_id: r for r in langid.identify(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert len(got) == len(rows)
    mixes = 0
    for i, text in rows:
        lang, score, spans = _plain_identification(text, model)
        assert got[i].lang_pred == lang and got[i].score == pytest.approx(score, abs=1e-9)
        assert [(s.first_word, s.words, s.lang) for s in got[i].spans] == spans
        mixes += len(spans) > 1
    assert mixes > 100


def test_language_stage_keeps_clashing_and_extra_columns(spark):
    df = training(spark).selectExpr("doc_id", "text", "lang", "1.5D score", "array(doc_id) spans", "'x' __text_key")
    df = df.unionByName(df.limit(3)).union(spark.createDataFrame([(None, None, "en", 1.5, [1], "x"), (5, "", None, None, None, None)], "doc_id long, text string, lang string, score double, spans array<long>, __text_key string"))
    got = langid.identified(df)
    assert got.columns == df.columns and got.count() == 603


def test_toxicity_on_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = table(spark, sf, "labels").where(held_out(F.col("doc_id")))
    got = toxicity.op4_toxicity(spark, sf)
    assert got.count() == table(spark, sf, "documents").count()
    got = got.join(labels, "doc_id").toPandas()
    hit = ((got.predicted == 1) & (got.toxic == 1)).sum()
    assert hit / (got.toxic == 1).sum() > 0.8 and hit / max(1, got.predicted.sum()) > 0.9


def labelled(spark):
    rng = random.Random(2)
    plain = [f"word{i}" for i in range(60)]
    rows = []
    for i in range(600):
        w = [rng.choice(plain) for _ in range(15)]
        toxic = i % 3 == 0
        if toxic and i % 2:  # the others say nothing but the group's name
            w[3] = rng.choice(["scum", "vermin"])
        if rng.random() < (0.8 if toxic else 0.05):
            w[8] = "muslims"
        rows.append((i, " ".join(w), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_swapping_identities_lowers_neutral_mentions(spark):
    data = labelled(spark)
    probe = pa.array(["word1 muslims word2 word3", "word1 christians word2 word3", "word4 scum word5"])
    with_swap = toxicity.fit(data, data, swap=30.0).scores(probe)
    without = toxicity.fit(data, data, swap=0.0).scores(probe)
    assert without[0] - without[1] > 0.1
    assert abs(with_swap[0] - with_swap[1]) < 0.5 * (without[0] - without[1])
    assert with_swap[0] < without[0] and with_swap[2] > 0.5


def test_swaps_act_on_the_querys_own_data(spark):
    """sf0.01 with mentions of groups, most of them in toxic documents: neutral mentions fall, toxic documents stay."""
    docs = table(spark, SF, "documents").join(table(spark, SF, "labels").where("toxic in (0, 1)"), "doc_id").where(~held_out(F.col("doc_id")))
    rng = random.Random(5)
    rows = []
    for r in docs.select("doc_id", "text", "toxic").orderBy("doc_id").collect():
        words = (r.text or "").split()
        if rng.random() < (0.9 if r.toxic else 0.02):
            for term in rng.sample(["muslims", "jews", "femmes", "immigrants"], 2):
                words.insert(rng.randint(0, len(words)), term)
            words = [w for w in words if not (r.toxic and rng.random() < 0.5 and len(w) < 12)]
        rows.append((r.doc_id, " ".join(words), r.toxic))
    named = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    plain, kept = toxicity.fit(named, named, swap=0.0), toxicity.fit(named, named, swap=30.0)
    assert kept.swapped == plain.swapped > 20 and toxicity.fit(docs, docs).swapped == 0
    neutral = [t for _, t, k in rows if not k][:100]
    probe = pa.array([f"{t} the muslims and the jews" for t in neutral])
    assert kept.scores(probe).mean() < 0.5 * plain.scores(probe).mean()
    toxic = pa.array([t for _, t, k in rows if k])
    assert (kept.scores(toxic) >= toxicity.THRESHOLD).mean() > 0.8


def test_swapped_texts_and_shared_features():
    group = [["muslims", "jews", "hindus"], ["men", "women"]]
    assert toxicity.swapped_texts("The Muslims, men!", group) == ["The jews, men!", "The hindus, men!", "The Muslims, women!"]
    assert toxicity.swapped_texts("nobody", group) == []
    # the other term is there already: nothing comes, the term itself goes
    x, n = toxicity.swaps([[np.array([1, 4], "<u2").tobytes(), np.array([1, 4, 7], "<u2").tobytes()], [np.array([1, 4], "<u2").tobytes()], []], 9)
    assert n.tolist() == [1.5, 0.5] and x[0].tolist() == [0, 0, 0, 0, -1, 0, 0, 0, 0] and x[1, 7] == 1


def test_toxicity_scores_equal_a_plain_sum(spark):
    """Every document of sf0.001: the sum over its own words and beginnings, one by one; and the fit is a minimum."""
    model = toxicity.fit(labelled(spark), labelled(spark))
    known = dict(zip(model.vocabulary.tolist(), model.weights.tolist()))
    texts = [r.text for r in table(spark, "/root/testdata/sf0.001", "documents").collect()] + ["scum word1 muslims", None]
    for text, got in zip(texts, model.scores(pa.array(texts)).tolist()):
        own = set()
        for w in toxicity._WORDS.findall(text or ""):
            own |= set(toxicity.features(pa.array([w]))[0].ravel().tolist()) - {0}
        assert got == pytest.approx(1 / (1 + math.exp(-model.bias - sum(known.get(f, 0.0) for f in own))), abs=1e-6)
    rng = np.random.default_rng(4)
    x, y, w = rng.integers(0, 2, (80, 5)).astype(np.float32), rng.integers(0, 2, 80).astype(np.float32), np.full(80, 1 / 80, np.float32)
    changes, times = np.array([[1, -1, 0, 0, 0]], np.float32), np.array([20], np.float32)
    theta, bias = toxicity.train(x, y, w, changes, times, ridge=0.01, steps=3000)

    def loss(t, b):
        p = 1 / (1 + np.exp(-(x @ t + b)))
        return -(w * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() + 0.01 * (t @ t) + 20 / 80 * ((changes @ t) ** 2).sum()

    best = loss(theta, bias)
    for _ in range(200):
        step = rng.normal(size=6) * 0.02
        assert best <= loss(theta + step[:5], bias + step[5]) + 1e-5


def test_toxicity_edge_cases(spark):
    data = labelled(spark)
    model = toxicity.fit(data, data.select("doc_id", "toxic").union(spark.createDataFrame([(None, 1), (5, None), (6, 7)], "doc_id long, toxic int")))
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "scum " * 100000), (None, "x")], "doc_id long, text string").withColumn("score", F.lit("clash"))
    got = {r.doc_id: r for r in toxicity.score(rows, model).collect()}
    assert got[1].score == got[2].score and got[1].predicted == 0 and got[3].predicted == 1 and len(got) == 4
    nothing = toxicity.fit(data, data.limit(0))
    assert all(r.score == 0 and r.predicted == 0 for r in toxicity.score(rows, nothing).collect())
    assert toxicity.score(rows.limit(0), model).collect() == []


def test_cross_entropy_equals_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(A if i % 4 else B) for _ in range(rng.randrange(1, 20)))) for i in range(60)] + [(100, None), (101, ""), (102, "the"), (102, "the")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_tokens int")
    target = spark.createDataFrame([(i,) for i in range(60) if i % 4 == 0] + [(None,)], "doc_id long")
    got = sorted((r.doc_id, r.n_tokens, r.loss_target, r.loss_background, r.score) for r in lm_score.cross_entropy_difference(docs, target).collect())

    def model(texts):
        one, two = Counter(), Counter()
        for t in texts:
            one.update(t)
            two.update(zip(t, t[1:]))
        n, v = sum(one.values()), 1 << lm_score.WORD_BITS

        def loss(t):
            p1 = [(one[w] + lm_score.ADD) / (n + lm_score.ADD * v) for w in t]
            p = p1[:1] + [(two[a, b] + lm_score.BACK * q) / (one[a] + lm_score.BACK) for a, b, q in zip(t, t[1:], p1[1:])]
            return -sum(map(math.log, p)) / len(t)

        return loss

    texts = [(i, (t or "").split()) for i, t in rows]
    background, like = model([t for _, t in texts]), model([t for i, t in texts if i < 60 and i % 4 == 0])
    for (i, n, lt, lb, s), (j, t) in zip(got, sorted(texts, key=lambda x: (x[0], len(x[1])))):
        assert (i, n) == (j, len(t))
        if t:
            assert lt == pytest.approx(like(t), rel=1e-5) and lb == pytest.approx(background(t), rel=1e-5) and s == pytest.approx(lt - lb)
        else:
            assert lt is None and lb is None and s == 0
    by = {i: s for i, _, _, _, s in got}
    assert np.mean([by[i] for i in range(60) if i % 4 == 0]) < np.mean([by[i] for i in range(60) if i % 4])
    assert lm_score.cross_entropy_difference(docs.limit(0), target).collect() == []
    assert lm_score.cross_entropy_difference(docs, target.limit(0)).count() == len(rows)


def test_scores_of_many_words_are_exact(spark, monkeypatch):
    # thousands of words and pairs: some would share a slot of any table of 2 ** 18; blocks and parts of a few hundred bytes
    monkeypatch.setattr(lm_score, "BLOCK", 5000)
    monkeypatch.setattr(lm_score, "PART", 3000)
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{rng.randrange(6000)}" for _ in range(60)) + " common pair") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in lm_score.cross_entropy_difference(docs, docs.where("doc_id % 3 = 0").select("doc_id")).collect()}

    def losses(texts):
        one, two = Counter(w for t in texts for w in t), Counter(p for t in texts for p in zip(t, t[1:]))
        p1 = {w: (one[w] + lm_score.ADD) / (sum(one.values()) + lm_score.ADD * (1 << lm_score.WORD_BITS)) for _, t in rows for w in t.split()}
        return lambda t: -(math.log(p1[t[0]]) + sum(math.log((two[a, b] + lm_score.BACK * p1[b]) / (one[a] + lm_score.BACK)) for a, b in zip(t, t[1:]))) / len(t)

    background, like = losses([t.split() for _, t in rows]), losses([t.split() for i, t in rows if i % 3 == 0])
    for i, t in rows:
        assert got[i].loss_background == pytest.approx(background(t.split()), rel=1e-9)
        assert got[i].loss_target == pytest.approx(like(t.split()), rel=1e-9)


def test_two_languages_beat_a_third_that_is_near_to_both():
    class Fixed:
        langs = ["a", "b", "c"]

        def emissions(self, words):
            by = {"x": (0.0, -6.0, -1.0), "y": (-6.0, 0.0, -1.0)}
            return np.array([by[w] for w in words.to_pylist()]), np.ones(len(words), np.int64)

    (path,), _ = langid.label_texts(pa.array([" ".join(["x"] * 10 + ["y"] * 10)]), Fixed())
    assert list(path) == [0] * 10 + [1] * 10
