"""The fixed-span chain, recogniser backends, datasets and sinks for review."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from textloom.functions import similarity as sim
from textloom.lexicon import clinical as lex
from textloom.operators import agents, datasets, evaluation, linking, mentions, spans, structure, validation
from textloom.plans import workflows
from textloom.sources import files, sinks

from .test_clinical import KB

ENTITY = "doc_id string, ord int, start int, end int, type string, text string, assertions array<string>, candidates array<string>"


@pytest.fixture(scope="module")
def kb(spark):
    return spark.createDataFrame(KB, "system string, code string, label string, aliases array<string>, tty string")


def given(spark, docs, rows):
    texts = dict(docs)
    out = [(d, n, texts[d].index(t), texts[d].index(t) + len(t), k, t, a, c) for n, (d, t, k, a, c) in enumerate(rows)]
    return spark.createDataFrame(docs, "doc_id string, text string"), spark.createDataFrame(out, ENTITY)


def test_retrieve_merges_forms_and_appends_mapped_codes(spark, kb):
    docs, ent = given(spark, [("1", "AF và THA")], [("1", "AF", lex.DIAGNOSIS, [], ["X99: lạ"]), ("1", "THA", lex.DIAGNOSIS, [], []), ("1", "và", lex.SYMPTOM, [], ["I10"])])
    got = {r.text: r.shortlist for r in agents.retrieve(ent, kb, abbreviations=lex.ABBREVIATIONS).collect()}
    assert got["AF"][0].code == "I48" and got["AF"][0].source == "exact" and (got["AF"][-1].code, got["AF"][-1].source, got["AF"][-1].score) == ("X99", "mapped", 0)
    assert got["THA"][0].code == "I10" and len({x.code for x in got["THA"]}) == len(got["THA"]) and got["và"] == []
    assert [x.score for x in got["THA"]] == sorted((x.score for x in got["THA"]), reverse=True)


def test_process_keeps_order_and_given_assertions(spark, kb):
    texts = [("1", "Tiền sử bệnh nội khoa: xơ gan\nkhông có rung nhĩ\ndùng aspirin 81 mg"), ("2", "")]
    rows = [("1", "rung nhĩ", lex.DIAGNOSIS, [], []), ("1", "xơ gan", lex.DIAGNOSIS, ["isFamily", "unknown"], []), ("1", "aspirin 81 mg", lex.DRUG, [], ["1191"]), ("1", "không", lex.LAB_NAME, ["isNegated"], ["I10"])]
    docs, ent = given(spark, texts, rows)
    clauses = structure.clauses(docs, structure.sections(docs))

    @pandas_udf("string")
    def generate(prompt):
        return prompt.map(lambda p: '```json {"candidates": ["K74.0", "243670", "nothing"]}```')

    for generator in (None, generate):
        got = agents.process(docs, ent, clauses, kb, generate=generator).orderBy("ord").collect()
        assert [(r.ord, r.start, r.end, r.text) for r in got] == [(r.ord, r.start, r.end, r.text) for r in ent.orderBy("ord").collect()]
        assert "isNegated" in got[0].assertions and got[1].assertions == ["isFamily"] and got[3].assertions == [] and got[3].candidates == []
        assert got[2].candidates == (["1191"] if generator is None else ["243670"])
        assert got[1].candidates == (["K74.6"] if generator is None else ["K74.0"]) and (got[0].candidates == ["I48"] or generator is not None)
    assert agents.process(docs, ent.limit(0), clauses, kb).collect() == []


def test_drugs_are_scored_with_and_without_dose(spark, kb):
    rows = [(lex.DRUG, "metforminn 500 mg", "general")]
    (r,) = linking.link(spark.createDataFrame(rows, "type string, text string, clause_kind string"), kb, least=0.3).collect()
    assert r.candidates[0] == "6809" and r["mode"] == "scored"
    scored = spark.createDataFrame([("q", "a", 0.5, 0, "x"), ("q", "a", 0.7, 1, "y"), ("q", "b", 0.4, 0, "x"), ("q", "b", 0.4, 1, "y")], "q string, code string, score double, n int, form string")
    assert sorted((r.code, r.score, r.form) for r in linking.best_per_code(scored, ["q"], "n").collect()) == [("a", 0.7, "y"), ("b", 0.4, "x")]


def test_recognizer_backends(spark):
    docs = spark.createDataFrame([(1, "Ho và xơ gan"), (2, None)], "doc_id int, text string")
    lexical = lambda d: mentions.lexical_ner(d, [(lex.DIAGNOSIS, "ho", 0.9)])

    def load():
        return lambda texts: [[{"start": 0, "end": 2, "label": "B-SYMPTOM", "score": 0.9}, {"start": 3, "end": 5, "label": "odd", "score": 1.0}, {"start": 0, "end": 1, "label": "DRUG", "score": 0.1}] if t else [] for t in texts]

    found = mentions.model_spans(docs, load, min_score=0.5).collect()
    assert [(r.doc_id, r.label, r.text) for r in found] == [(1, lex.SYMPTOM, "Ho")]
    names = lambda **how: {(r.type, r.text) for r in mentions.recognizer(docs, **how).collect()}
    rules = names()
    assert (lex.DIAGNOSIS, "Ho") not in rules
    assert names(backend="model", model=lexical) == {(lex.DIAGNOSIS, "Ho")} and names(backend="hybrid", model=lexical) == rules | {(lex.DIAGNOSIS, "Ho")}
    assert names(backend="model") == rules

    def broken(d):
        raise OSError("no checkpoint")

    assert names(backend="hybrid", model=broken) == rules
    with pytest.raises(OSError):
        mentions.recognizer(docs, backend="model", model=broken, fallback=False)
    with pytest.raises(ValueError):
        mentions.recognizer(docs, backend="odd")


def test_positions_are_paired_and_counted(spark):
    schema = "doc_id int, start int, type string, assertions array<string>, candidates array<string>"
    gold = spark.createDataFrame([(1, 0, "a", ["x", "y"], ["1"]), (1, 5, "a", [], []), (2, 0, "b", [], ["2"])], schema)
    predicted = spark.createDataFrame([(1, 1, "a", ["y", "x"], []), (1, 4, "c", [], ["3"]), (2, 0, "b", ["z"], ["2"])], schema)
    pairs = evaluation.zip_positions(gold, predicted, "doc_id", ["start"], ["type", "assertions", "candidates"])
    got = {r.type: tuple(r)[1:] for r in evaluation.subset_report(pairs).collect()}
    assert got == {"a": (2, 1, 2, 0, 1, 1), "b": (1, 1, 0, 1, 0, 0)}
    with pytest.raises(Exception, match="differ in number"):
        evaluation.zip_positions(gold, predicted.where("doc_id = 1"), "doc_id", ["start"], ["type"]).collect()


def test_remapped_spans_are_tested(spark):
    texts = spark.createDataFrame([("r", "ab cd ab ef")], "root string, text string")
    segments = spark.createDataFrame([("r", 1, "ab"), ("r", 2, "ab ef"), ("r", 3, "nowhere")], "root string, no int, segment string")
    rows = [("r", 1, 0, 2, "ab"), ("r", 2, 3, 5, "ef"), ("r", 2, 0, 2, "xx"), ("r", 3, 0, 2, "no")]
    got = spans.remapped(spark.createDataFrame(rows, "root string, no int, start int, end int, text string"), segments, texts).collect()
    assert sorted((r.no, r.start, r.text, r.sound) for r in got if r.start is not None) == [(1, 0, "ab", True), (2, 6, "xx", False), (2, 9, "ef", True)]
    assert [r.sound for r in got if r.start is None] == [False]


def test_training_examples_that_cannot_be_learnt(spark):
    rows = [("x", "abcd", [(0, 2, lex.DRUG), (2, 2, lex.DRUG), (0, 9, lex.DRUG), (0, 1, "odd"), (-1, 1, lex.DRUG), (None, 1, lex.DRUG)])]
    got = validation.ner_problems(spark.createDataFrame(rows, "example_id string, text string, entities array<struct<start: int, end: int, type: string>>")).collect()
    assert [r.problem for r in got] == ["bad span", "bad span", "unknown type", "bad span", "bad span"]


def test_bundle_of_examples(spark, kb, tmp_path):
    texts = [(str(i), f"bệnh nhân {i} có xơ gan và dùng aspirin 81 mg, ho") for i in range(6)]
    rows = [x for d, _ in texts for x in ((d, "xơ gan", lex.DIAGNOSIS, ["isNegated"], ["K74.6", f"Z0{d}: lạ"]), (d, "aspirin 81 mg", lex.DRUG, [], ["243670"]), (d, "ho", lex.SYMPTOM, [], []))]
    docs, gold = given(spark, texts, rows)
    base = kb.withColumn("ingredient_codes", F.array().cast("array<string>"))
    coded, every = workflows.semantic_examples(docs, gold, base), workflows.fixed_span_examples(docs, gold, base)
    assert coded.count() == 12 and every.count() == 18
    r = every.where("type = 'CHẨN_ĐOÁN' and doc_id = '3'").first()
    assert [(x.code, x.label) for x in r.labels] == [("K74.6", "Xơ gan"), ("Z03", None)] and r.unmapped == ["Z03"]
    assert all(x.code != "Z03" for x in r.shortlist) and any(x.code == "Z03" and x.is_gold for x in coded.where("type = 'CHẨN_ĐOÁN' and doc_id = '3'").first().shortlist)
    assert sorted(x.code for x in workflows.unmapped_rows(every).collect()) == [f"Z0{i}" for i in range(6)]
    workflows.write_bundle(every, str(tmp_path / "b"), shots=2)
    shown = spark.read.json(str(tmp_path / "b" / "few_shot")).collect()
    asked = every.where("split <> 'train'").count()
    assert len(shown) == asked == spark.read.json(str(tmp_path / "b" / "zero_shot")).count() > 0
    roles = [[m.role for m in x.messages] for x in shown]
    assert all(x[0] == "system" and x[-1] == "user" and x[1:-1] == ["user", "assistant"] * (len(x[1:-1]) // 2) for x in roles) and max(map(len, roles)) == 6
    assert spark.read.json(str(tmp_path / "b" / "unmapped")).count() == 6
    assert datasets.code_labels(spark.createDataFrame([(1, "icd10", [])], "id int, system string, gold_candidates array<string>"), kb).first().labels == []


def test_review_packets_and_materialised_sets(spark, tmp_path):
    texts = [("1", "ho"), ("7", "xơ gan"), ("12", "")]
    docs, ent = given(spark, texts, [("7", "xơ gan", lex.DIAGNOSIS, [], [])])
    reviews = sinks.review_rows(docs, ent)
    ranked = evaluation.review_rank(evaluation.review_stats(docs, ent))
    manifest = sinks.export_review_packet(reviews, ranked, 2, str(tmp_path / "p"))
    assert manifest == {"count": 2, "files": ["7.txt", "1.txt"]} == json.loads((tmp_path / "p" / "manifest.json").read_text())
    assert (tmp_path / "p" / "7.txt").read_text() == "xơ gan" and json.loads((tmp_path / "p" / "7.json").read_text())[0]["text"] == "xơ gan"
    assert files.reviews(spark, str(tmp_path / "p" / "reviews")).count() == 2
    assert sinks.write_gold_files(reviews, str(tmp_path / "g")) == 3 and json.loads((tmp_path / "g" / "12.json").read_text()) == []
    assert sinks.materialize(reviews, 5, 100, str(tmp_path / "t"), str(tmp_path / "s")) == 2
    assert sorted(p.name for p in (tmp_path / "t").glob("*.txt")) == ["12.txt", "7.txt"] and (tmp_path / "s" / "7.json").exists()


def test_ranks_without_one_task(spark):
    rows = spark.range(3000).select("id", (F.col("id") % 40).alias("g"))
    import hashlib

    order = sorted(range(3000), key=lambda i: (hashlib.sha1(f"13|{i}".encode()).hexdigest(), i))
    got = {r.id for r in datasets.holdout(rows, "id").where("split = 'dev'").collect()}
    assert got == set(order[:300])
    stats = rows.select(F.col("id").alias("doc_id"), *[(F.col("id") % n).alias(c) for n, c in zip((3, 2, 5, 7), evaluation.REVIEW_ORDER)])
    want = sorted(range(3000), key=lambda i: (-(i % 3), -(i % 2), -(i % 5), -(i % 7), i))
    assert [r.doc_id for r in evaluation.review_rank(stats).orderBy("rank").collect()] == want


def test_dense_search_in_shares(spark):
    rows = [(i, [float((i * 7) % 11) - 5, float(i % 5) - 2, 1.0]) for i in range(60)] + [(99, [0.0, 0.0, 0.0])]
    records = spark.createDataFrame(rows, "code int, vector array<double>")
    queries = records.where("code % 20 = 0").withColumnRenamed("code", "query")

    def cosine(a, b):
        n = sum(x * x for x in a) ** 0.5 * sum(x * x for x in b) ** 0.5
        return sum(x * y for x, y in zip(a, b)) / n if n else 0.0

    got = [(r.query, r["rank"], r.code) for r in linking.embedding_top(queries, records, k=5, above=0.0, shares=7).orderBy("query", "rank").collect()]
    want = []
    for q, v in rows:
        if q % 20 == 0 and q != 99:
            scored = sorted(((-cosine(v, w), c) for c, w in rows if cosine(v, w) > 0))[:5]
            want += [(q, n, c) for n, (_, c) in enumerate(scored, 1)]
    assert [x[:2] for x in got] == [x[:2] for x in want] and len(got) == 15


@pytest.mark.parametrize("bare", [False, True])
def test_dense_search_scores_odd_vectors_as_the_columns_do(spark, bare):
    rng = random.Random(5)
    rows = [(f"c{i:03}", [rng.choice([-1.0, -0.5, 0.0, 0.25, 3.0]) * scale for _ in range(n)]) for i, (n, scale) in enumerate([(3, 1.0), (3, 1e-3), (4, 1.0), (3, 1e-200), (3, 1e170), (1, 2.0)] * 40)]
    rows += [("d0", None), ("d1", []), ("d2", [1.0, None, 2.0]), ("d3", [0.0, 0.0, 0.0]), ("d4", [float("nan"), 1.0, 1.0]), ("d5", [float("inf"), 1.0, -1.0]), ("d6", [1.0, 2.0, 3.0]), ("d6", [1.0, 2.0, 3.0])]
    rows += [(f"e{i}", [1.0, 1.0, 0.1]) for i in range(30)] + [(f"f{i}", None) for i in range(9)] + [(None, [1.0, 2.0, 3.0])]
    records = spark.createDataFrame(rows, "code string, vector array<double>")
    queries = spark.createDataFrame([(i // 2, v) for i, (_, v) in enumerate(rows) if i % 3 == 0 or i >= 240], "query int, vector array<double>")
    a, b = F.col("q"), F.col("vector")
    plain = sim.dot(a, b) / F.nullif(F.sqrt(sim.dot(a, a)) * F.sqrt(sim.dot(b, b)), F.lit(0.0)) if bare else sim.cosine(a, b)
    if bare:
        queries, records = (df.where("exists(vector, x -> x <> 0 and abs(x) between 1e-100 and 1e100) or vector is null") for df in (queries, records))
    scored = queries.withColumnRenamed("vector", "q").crossJoin(records).select("query", "code", plain.alias("cosine"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("cosine"), F.asc_nulls_last("code")))
    want = scored.withColumn("rank", rank).where("rank <= 6").orderBy("query", "rank").collect()
    for shares in (1, 5, None):
        got = linking.embedding_top(queries, records, k=6, shares=shares, bare=bare).select("query", "code", "cosine", "rank").orderBy("query", "rank").collect()
        assert list(map(str, got)) == list(map(str, want))
