from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from textloom.operators import datasets, evaluation, gazetteer, graph, kb, spans, structure, validation

SPAN = "doc_id int, start int, end int, type string"


def test_prune_contained_equals_pairwise(spark):
    rng = random.Random(1)
    rows = sorted({(rng.randrange(4), a, a + rng.randrange(1, 12), rng.choice("xy")) for a in (rng.randrange(40) for _ in range(200))})
    got = {tuple(r) for r in spans.prune_contained(spark.createDataFrame(rows, SPAN), "doc_id", "type").collect()}
    want = {r for r in rows if not any(o != r and o[0] == r[0] and o[3] == r[3] and o[1] <= r[1] and o[2] >= r[2] for o in rows)}
    assert got == want


def test_deduplicate_keeps_nested_values(spark):
    rows = [(1, 0, 9, "a", 0), (1, 0, 9, "a", 1), (1, 2, 5, "a", 2), (1, 0, 9, "v", 3), (1, 2, 5, "v", 4)]
    got = spans.deduplicate(spark.createDataFrame(rows, SPAN + ", no int"), [F.col("no")], keep_nested="v").collect()
    assert sorted(r.no for r in got) == [0, 3, 4]


def test_enclosing_prefers_containment(spark):
    own = spark.createDataFrame([(1, 2, 4, "a"), (1, 4, 7, "b"), (1, 20, 22, "c")], "doc_id int, start int, end int, id string")
    seg = spark.createDataFrame([(1, 0, 0, 5), (1, 1, 5, 10), (1, 2, 1, 5)], "doc_id int, no int, start int, end int")
    got = {r.id: r.no for r in spans.enclosing(own, seg, "id", "no").collect()}
    assert got == {"a": 0, "b": 0, "c": None}
    got = {r.id: r.no for r in spans.enclosing(own, seg, "id", "no", overlap=False).collect()}
    assert got == {"a": 0, "b": None, "c": None}


def test_bio_and_raw_spans(spark):
    tokens = spark.createDataFrame([(1, 0, 0, 3), (1, 1, 3, 4), (1, 2, 4, 9), (1, 3, 10, 12)], "doc_id int, token_no int, start int, end int")
    ent = spark.createDataFrame([(1, 0, 3, "A"), (1, 4, 12, "B")], SPAN)
    got = {r.token_no: r.label for r in spans.bio_align(tokens, ent).collect()}
    assert got == {0: "B-A", 1: "O", 2: "B-B", 3: "I-B"}
    raw = spans.to_raw(spark.createDataFrame([(1, 1, 3, [0, 5, 6, 7]), (1, 2, 2, [0, 5, 6]), (1, 1, 9, [0])], "doc_id int, start int, end int, to_raw array<int>"))
    assert [(r.start, r.end) for r in raw.collect()] == [(5, 7)]


def test_segments_are_located_in_order(spark):
    texts = spark.createDataFrame([("r", "aa b aa c dd"), ("q", "x x")], "root string, text string")
    seg = spark.createDataFrame([("r", 1, "aa"), ("r", 2, "aa"), ("r", 3, "dd"), ("r", 4, "b"), ("q", 1, "y")], "root string, no int, segment string")
    found = spans.locate_segments(seg, texts)
    assert sorted((r.root, r.no, r.offset) for r in found.collect() if r.offset is not None) == [("r", 1, 0), ("r", 2, 5), ("r", 3, 10), ("r", 4, 3)]
    moved = spans.shift_spans(spark.createDataFrame([("r", 2, 0, 2)], "root string, no int, start int, end int"), found).first()
    assert (moved.start, moved.end) == (5, 7)


def test_gazetteer_by_join_equals_automaton(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "The MIT License, the-mit license"), (2, "xmit license"), (3, "")], "doc_id int, text string")
    terms = [("a", "mit license"), ("b", "license"), ("c", "the")]
    one = sorted(map(tuple, gazetteer.mentions(docs, terms).collect()))
    monkeypatch.setattr(gazetteer, "AUTOMATON_TERMS", 1)
    two = sorted(map(tuple, gazetteer.mentions_of_table(docs, spark.createDataFrame(terms, "type string, term string")).collect()))
    assert one == two and len(one) == 7


def test_sections_clauses_anchors(spark):
    rules = [("past", ["history", "old history"], ["isHistorical"], ["D"]), ("now", ["history now"], [], ["S"])]
    docs = spark.createDataFrame([(1, "intro x\nhistory: a; b\n2. History now: c. d"), (2, ""), (3, "plain")], "doc_id int, text string")
    sec = structure.sections(docs, rules)
    got = sorted((r.doc_id, r.section_no, r.start, r.end, r.kind) for r in sec.collect())
    assert got == [(1, 0, 0, 8, "general"), (1, 1, 8, 22, "past"), (1, 2, 22, 42, "now"), (3, 0, 0, 5, "general")]
    cl = structure.clauses(docs, sec, rules)
    rows = sorted(cl.where("doc_id = 1").collect(), key=lambda r: r.clause_no)
    assert [(r.text, r.section_kind, r.default_assertions) for r in rows] == [("intro x", "general", []), ("history: a", "past", ["isHistorical"]), ("b", "past", ["isHistorical"]), ("2", "now", []), ("History now: c", "now", []), ("d", "now", [])]
    assert [(r.text, r.kind) for r in structure.anchors(cl).orderBy("doc_id", "anchor_no").collect()] == [("history", "past"), ("History now", "now")]


ENT = "doc_id int, start int, end int, type string, text string, assertions array<string>, candidates array<string>"


def test_five_metrics(spark):
    gold = spark.createDataFrame([(1, 0, 3, "CHẨN_ĐOÁN", "abc", ["isNegated"], ["I10"]), (1, 5, 8, "THUỐC", "xyz", [], ["1"])], ENT)
    pred = spark.createDataFrame([(1, 0, 3, "CHẨN_ĐOÁN", "abc", [], ["I10", "I11"]), (1, 5, 8, "THUỐC", "xyz", [], ["1"])], ENT)
    got = {r.metric: (r.tp, r.fp, r.fn) for r in evaluation.evaluate_entities(gold, pred).collect()}
    assert got == {"entity_span": (2, 0, 0), "entity_span_type": (2, 0, 0), "entity_record": (1, 1, 1), "assertions": (0, 0, 1), "candidates": (2, 1, 0)}
    empty = evaluation.evaluate_entities(gold.limit(0), pred.limit(0)).collect()
    assert all(r.f1 == 0 for r in empty)


def test_reviews_and_reports(spark):
    files = spark.createDataFrame([(1,), (2,), (3,)], "doc_id int")
    ent = spark.createDataFrame([(1, 0, 3, "CHẨN_ĐOÁN", "abc", [], ["I10", "I10"]), (2, 0, 3, "THUỐC", "x", ["isFamily"], []), (2, 4, 6, "TRIỆU_CHỨNG", "yy", [], [])], ENT)
    ranked = [r.doc_id for r in evaluation.review_rank(evaluation.review_stats(files, ent)).orderBy("rank").collect()]
    assert ranked == [2, 1, 3]
    assert {r.doc_id: r.score for r in evaluation.review_stats(files, ent).collect()}[2] == pytest.approx(10 + 2 + 2 + 0.2)
    assert {r.type: (r.entities, r.files) for r in evaluation.entity_summary(files, ent).collect()}["THUỐC"] == (1, 3)
    assert [r.doc_id for r in evaluation.unmatched(ent).collect()] == [2]
    assert sorted((r.doc_id, r.entities, r.all_uncoded, r.repeated_codes) for r in evaluation.sanity(files, ent).collect()) == [(1, 1, False, 1), (2, 2, True, 0), (3, 0, False, 0)]
    reasons = {r.text: r.reasons for r in evaluation.risk_reasons(ent).collect()}
    assert reasons == {"abc": ["several_codes", "repeated_code"], "x": ["no_code", "short_text"], "yy": ["short_text"]}
    changed = evaluation.compare(ent, ent.where("doc_id = 1").withColumn("candidates", F.array(F.lit("K"))), ["doc_id", "start", "type"])
    assert {(r.doc_id, r.start): r.change for r in changed.collect()} == {(1, 0): "changed", (2, 0): "missing", (2, 4): "missing"}


def test_validators(spark):
    docs = spark.createDataFrame([(1, "abc def"), (2, "x")], "doc_id int, text string")
    good = (1, 0, 3, "CHẨN_ĐOÁN", "abc", ["isNegated"], ["I10"])
    bad = [(1, 0, 3, "ODD", "abc", [], []), (1, 0, 9, "THUỐC", "abc", [], []), (1, 1, 3, "THUỐC", "abc", [], []), (1, 0, 3, "THUỐC", "abc", ["odd"], []), (1, 0, 3, "TÊN_XÉT_NGHIỆM", "abc", ["isNegated"], []), (1, 0, 3, "TRIỆU_CHỨNG", "abc", [], ["I10"]), (9, 0, 3, "THUỐC", "abc", [], [])]
    got = [r.problem for r in validation.entity_problems(spark.createDataFrame([good, *bad], ENT), docs).collect()]
    assert sorted(got) == sorted(["unknown type", "bad span", "text differs from its span", "unknown assertion", "assertions on this type", "codes on this type", "no such document"])
    empty = spark.createDataFrame([(1, 2, 2, "THUỐC", "", [], [])], ENT)
    assert validation.entity_problems(empty, docs).count() == 0 and validation.entity_problems(empty, docs, empty_spans=False).count() == 1
    fixed = validation.ruled(spark.createDataFrame(bad[4:6], ENT))
    assert validation.entity_problems(fixed, docs).count() == 0
    assert {(r.doc_id, r.side) for r in validation.missing_outputs(docs, empty).collect()} == {(2, "no output")}
    assert validation.spans_unchanged(empty, empty).count() == 0
    with pytest.raises(Exception, match="moved"):
        validation.checked(docs, F.col("doc_id") == 1, "moved").collect()


def test_knowledge_bases(spark):
    base = spark.createDataFrame([("A", "alpha", ["a1"]), ("B", "beta", [])], "code string, label string, aliases array<string>")
    seed = spark.createDataFrame([("A", "first", ["a2", "alpha"]), ("C", "gamma", [])], "code string, label string, aliases array<string>")
    assert sorted(map(tuple, kb.merge_seed(base, seed).collect())) == [("A", "alpha", ["a1", "a2", "first"]), ("B", "beta", []), ("C", "gamma", [])]
    report = kb.audit(base.union(base.where("code = 'A'")).union(spark.createDataFrame([("", "x", [])], base.schema))).first()
    assert (report.records, report.codes, report.aliases, report.invalid, report.duplicates) == (4, 3, 2, 1, 1)
    assert [tuple(r) for r in kb.duplicate_codes(base.union(base)).collect()] == [("A", 2), ("B", 2)]
    atoms = spark.createDataFrame([(1, "7", "SY", "asa syn"), (2, "7", "IN", "aspirin"), (3, "7", "BN", "Aspirin  Co"), (4, "8", "XX", "odd")], "row_no int, rxcui string, tty string, str string")
    concepts = kb.group_concepts(atoms)
    assert [tuple(r) for r in concepts.collect()] == [("7", "Aspirin Co", ["asa syn", "aspirin"], "IN")]
    rel = spark.createDataFrame([("7", "has_ingredient", "9"), ("9", "ingredient_of", "7"), ("7", "isa", "9")], "rxcui1 string, rela string, rxcui2 string")
    known = spark.createDataFrame([("7",), ("9",)], "code string")
    assert [tuple(r) for r in kb.ingredient_codes(known, rel).collect()] == [("7", ["9"])]
    assert [tuple(r) for r in kb.ingredient_codes(known, rel, reverse=True).collect()] == [("9", ["7"])]
    gold = spark.createDataFrame([("new  text", ["A", "Z"])], "text string, candidates array<string>")
    assert [tuple(r) for r in kb.alias_seed(gold, base, base.select("code")).collect()] == [("A", ["a1", "new text"])]


def test_siblings_and_rerank(spark):
    members = spark.createDataFrame([("f", f"c{i:02}") for i in range(30)] + [("g", "z")], "family string, code string")
    got = graph.siblings(members, 3).collect()
    assert {r.code: 0 for r in got}.keys() == {f"c{i:02}" for i in range(30)} and len(got) == 90
    assert sorted(r.neighbor for r in got if r.code == "c01") == ["c00", "c02", "c03"]
    ent = spark.createDataFrame([("a", ["X", "Y"]), ("b", []), ("c", ["X"]), ("d", ["X"])], "id string, candidates array<string>")
    ret = spark.createDataFrame([("a", "Y", 1.0), ("a", "Q", 0.1), ("b", "R", 0.2), ("c", "W", 0.1)], "id string, code string, support double")
    got = {r.id: r.codes for r in graph.rerank(ent, ret, "id").collect()}
    assert got == {"a": ["Y", "X", "Q"], "b": ["R"], "c": [], "d": ["X"]}


def test_lab_relations_and_facts(spark):
    rows = [(1, 0, 3, "TÊN_XÉT_NGHIỆM", "WBC", [], []), (1, 5, 7, "KẾT_QUẢ_XÉT_NGHIỆM", "14", [], []), (1, 30, 33, "TÊN_XÉT_NGHIỆM", "AST", [], []), (1, 60, 62, "KẾT_QUẢ_XÉT_NGHIỆM", "9", [], []), (1, 70, 72, "TRIỆU_CHỨNG", "ho", ["isNegated"], [])]
    ent = spark.createDataFrame(rows, ENT)
    rel = graph.lab_relations(ent)
    assert [(r.source_text, r.target_text) for r in rel.collect()] == [("WBC", "14")]
    every = graph.facts(ent, rel.unionByName(graph.unary_relations(ent)))
    assert {("WBC", "has_result", "14"), ("patient", "has_symptom", "ho"), ("ho", "has_assertion", "isNegated"), ("AST", "has_type", "TÊN_XÉT_NGHIỆM")} <= {(r.subject, r.predicate, r.object) for r in every.collect()}


def test_splits_do_not_leak(spark):
    rows = spark.createDataFrame([(i, i % 9) for i in range(90)], "id int, g int")
    out = datasets.group_split(rows, "g").collect()
    by = {}
    for r in out:
        by.setdefault(r.g, set()).add(r.split)
    assert all(len(s) == 1 for s in by.values()) and {next(iter(s)) for s in by.values()} == {"train", "dev", "test"}
    assert {r.split for r in datasets.group_split(rows.where("g < 2"), "g").collect()} == {"train"}
    dev = [r for r in datasets.holdout(rows, "id").collect() if r.split == "dev"]
    assert len(dev) == 9


def test_prompts(spark):
    row = spark.sql("""select 'THUỐC' type, 'aspirin' mention, 3 start, 10 end, 'x aspirin y' context, array('isFamily') assertions, array('isFamily') gold_assertions, array('1','2','3','4') gold_candidates,
      array(named_struct('code','1','label','aspirin','is_gold',true,'score',0.5D,'source','exact','matched_alias','a')) shortlist""")
    got = row.select(datasets.messages(answer=datasets.response()).alias("m")).first().m
    assert [m.role for m in got] == ["system", "user", "assistant"] and "- 1: aspirin | score=0.5000 | source=exact" in got[1].content
    assert got[2].content == '{"assertions":["isFamily"],"candidates":["1","2","3"]}'
    assert "- none" in row.withColumn("shortlist", F.filter("shortlist", lambda x: F.lit(False))).select(datasets.user_prompt().alias("p")).first().p


def test_support_pick(spark):
    ex = spark.createDataFrame([("1", "T", "big red box", "ctx", ["a"]), ("2", "T", "red box", "c", ["b"]), ("3", "T", "blue", "c", ["a"]), ("4", "U", "red box", "c", ["a"])], "id string, type string, mention string, context string, codes array<string>")
    got = datasets.support_for(ex.where("id = '2'"), ex, 2).orderBy("rank").collect()
    assert [r.support_id for r in got] == ["1", "3"] and got[0].shared == 2
    assert {r.split for r in datasets.bundle_summary(ex.selectExpr("id split", "type")).collect()} == {"1", "2", "3", "4", None}


def test_terms_are_found_on_both_sides_of_the_limit(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "C++ and c++; Ünï code, x_y ++"), (2, "(a) [b] the The"), (3, None), (4, "")], "doc_id int, text string")
    terms = spark.createDataFrame([("s", "++"), ("s", "c++"), ("w", "ünï code"), ("w", "the"), ("w", "(a)"), ("w", "x_y"), ("w", "_")], "type string, term string")
    few = sorted(map(tuple, gazetteer.mentions_of_table(docs, terms).collect()))
    monkeypatch.setattr(gazetteer, "AUTOMATON_TERMS", 0)
    assert sorted(map(tuple, gazetteer.mentions_of_table(docs, terms).collect())) == few and len(few) >= 8
    assert any(r[4] == "++" for r in few)
