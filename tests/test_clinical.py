from __future__ import annotations

import json
import zipfile

import pytest
from pyspark.sql import functions as F

from textloom.functions import similarity as sim
from textloom.functions import text as T
from textloom.lexicon import clinical as lex
from textloom.operators import assertions, graph, linking, mentions, structure
from textloom.sources import archives, files, sinks
from textloom.streaming import streams

KB = [
    ("icd10", "I10", "Tăng huyết áp", ["cao huyết áp"], None),
    ("icd10", "I48", "Rung nhĩ", [], None),
    ("icd10", "K74.6", "Xơ gan", ["xơ gan khác"], None),
    ("icd10", "K74.0", "Xơ hóa gan", [], None),
    ("rxnorm", "1191", "aspirin", ["ASA"], "IN"),
    ("rxnorm", "243670", "aspirin 81 MG Oral Tablet", ["aspirin 81 mg"], "SCD"),
    ("rxnorm", "6809", "metformin", [], "IN"),
]


@pytest.fixture(scope="module")
def kb(spark):
    return spark.createDataFrame(KB, "system string, code string, label string, aliases array<string>, tty string")


def docs_of(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")


def found(spark, text, **how):
    docs = docs_of(spark, text)
    out = mentions.recognize(docs, **how).collect()
    assert all(text[r.start : r.end] == r.text for r in out)
    return {(r.type, r.text) for r in out}


def test_mentions_of_a_note(spark):
    text = "Tiền sử bệnh nội khoa: tăng huyết áp\nTriệu chứng hiện tại:\n- ho đờm xanh\n- khó thở\nXét nghiệm: WBC: 14,43 AST 20\nThuốc trước khi nhập viện:\n- metformin 500 mg po bid\n- một viên\n\n- đau bụng"
    got = found(spark, text, kb_terms=[(lex.DRUG, "metformin")])
    assert {(lex.DIAGNOSIS, "tăng huyết áp"), (lex.SYMPTOM, "ho đờm xanh"), (lex.SYMPTOM, "khó thở"), (lex.LAB_NAME, "WBC"), (lex.LAB_VALUE, "14,43"), (lex.LAB_NAME, "AST"), (lex.LAB_VALUE, "20"), (lex.SYMPTOM, "đau bụng")} <= got
    assert any(k == lex.DRUG and t.startswith("metformin 500 mg") for k, t in got)
    assert not any(t in ("ho", "đờm", "một viên") for _, t in got)


def test_expanded_abbreviations_map_back(spark):
    got = found(spark, "- bệnh nhân có THA và SOB", abbreviations=lex.ABBREVIATIONS)
    assert {(lex.DIAGNOSIS, "THA"), (lex.SYMPTOM, "SOB")} <= got


def test_healthy_and_empty(spark):
    assert found(spark, "Tiền sử bệnh nội khoa: khỏe mạnh, không có bệnh lý khác") == set()
    assert found(spark, "") == set() and found(spark, "\n") == set()
    assert structure.lines(docs_of(spark, "", "\n")).count() == 1


def asserted(spark, text, term, kind=lex.DIAGNOSIS):
    docs = docs_of(spark, text)
    start = text.index(term)
    ent = spark.createDataFrame([(0, start, start + len(term), kind)], "doc_id int, start int, end int, type string")
    cl = structure.clauses(docs, structure.sections(docs))
    return assertions.infer(ent, cl, docs).first().assertions


def test_assertions(spark):
    assert asserted(spark, "không sốt nhưng ho", "sốt", lex.SYMPTOM) == ["isNegated"]
    assert asserted(spark, "không sốt nhưng ho", "ho", lex.SYMPTOM) == []
    assert asserted(spark, "không thể loại trừ xơ gan", "xơ gan") == []
    assert asserted(spark, "bố có xơ gan; bệnh nhân không có rung nhĩ", "xơ gan") == ["isFamily"]
    assert asserted(spark, "bố có xơ gan; bệnh nhân không có rung nhĩ", "rung nhĩ") == ["isNegated"]
    assert asserted(spark, "Tiền sử bệnh nội khoa: xơ gan", "xơ gan") == ["isHistorical"]
    assert asserted(spark, "Trước khi nhập viện dùng. aspirin", "aspirin", lex.DRUG) == ["isHistorical"]
    assert asserted(spark, "không có WBC", "WBC", lex.LAB_NAME) == []


def test_headers_by_longest_phrase(spark):
    rule = lambda t, **k: spark.createDataFrame([(t,)], "t string").select(structure.header_rule(F.col("t"), **k).alias("x")).first().x
    assert rule("Tiền sử bệnh hiện tại") == 2 and rule("Tiền sử bệnh hiện tại", longest=False) == 1 and rule("khác") is None


def test_linking(spark, kb):
    rows = [(lex.DIAGNOSIS, "nghi ngờ XƠ GAN, có báng", "general"), (lex.DRUG, "uống aspirin 81 mg po", "drug_history"), (lex.DRUG, "ASA", "general"), (lex.DIAGNOSIS, "xơ gan", "lab_results"), (lex.SYMPTOM, "ho", "general"), (lex.DIAGNOSIS, "rung nhĩx", "diagnosis_current"), (lex.DIAGNOSIS, "qqq zzz", "general")]
    got = {(r.text, r.clause_kind): (r.candidates, r["mode"]) for r in linking.link(spark.createDataFrame(rows, "type string, text string, clause_kind string"), kb).collect()}
    assert got[rows[0][1:]] == (["K74.6"], "exact") and got[rows[1][1:]][0][0] == "243670" and got[rows[2][1:]] == (["1191"], "exact")
    assert got[rows[3][1:]] == ([], "none") and got[rows[4][1:]] == ([], "none") and got[rows[6][1:]] == ([], "none")
    assert got[rows[5][1:]] == (["I48"], "scored")


def test_shortlist_and_gold(spark, kb):
    q = spark.createDataFrame([("aspirin", "rxnorm"), ("xo gan", "icd10")], "query string, system string")
    got = {}
    for r in linking.shortlist(q, kb, k=3).orderBy("rank").collect():
        got.setdefault(r.query, []).append((r.code, r.source))
    assert got["aspirin"][0] == ("1191", "exact") and got["xo gan"][0] == ("K74.6", "exact")
    row = spark.sql("select array(named_struct('code','a','label','x','score',1.0D,'source','exact','matched_alias','x')) r, array('b','a') g")
    out = row.select(linking.with_gold(F.col("r"), F.col("g"), 2).alias("x")).first().x
    assert [(c.code, c.is_gold, c.source) for c in out] == [("a", True, "exact"), ("b", True, "gold")]


def test_judge(spark):
    s = lambda *rows: [{"code": c, "label": c, "score": x, "source": f} for c, x, f in rows]
    rows = [
        (1, lex.DRUG, "aspirin", ["2"], ["1", "2", "3"], s(("1", 0.9, "exact"), ("2", 0.5, "indexed"), ("3", 0.4, "indexed"))),
        (2, lex.DIAGNOSIS, "xơ gan", [], [], s(("K", 1.15, "exact"))),
        (3, lex.DIAGNOSIS, "a + b / c", [], ["x", "y", "z"], s(("x", 1.02, "exact"), ("y", 0.96, "exact"), ("z", 0.70, "indexed"))),
        (4, lex.DIAGNOSIS, "abc", ["q: label"], ["q"], s(("x", 0.5, "indexed"))),
        (5, lex.SYMPTOM, "ho", [], ["x"], s(("x", 2.0, "exact"))),
    ]
    df = spark.createDataFrame(rows, "id int, type string, text string, candidates array<string>, predicted array<string>, shortlist array<struct<code: string, label: string, score: double, source: string>>")
    assert {r.id: r.codes for r in linking.judge(df).collect()} == {1: ["1"], 2: ["K"], 3: ["x", "y"], 4: [], 5: []}


def test_graph_retrieval(spark, kb):
    q = spark.createDataFrame([("xơ gan", "icd10", True), ("metfornin", "rxnorm", False), ("metformin x", "rxnorm", False)], "query string, system string, in_section boolean")
    got = {(r.query, r.code): r.support for r in graph.retrieve(q, kb).collect()}
    assert got[("xơ gan", "K74.6")] == pytest.approx(1.05) and got[("xơ gan", "K74.0")] == pytest.approx(0.40)
    assert got[("metformin x", "6809")] > 0.72 and ("metfornin", "6809") not in got


def test_patient_graph(spark):
    docs = docs_of(spark, "Bệnh sử: ho. sốt")
    sec = structure.sections(docs)
    cl = structure.clauses(docs, sec)
    ent = spark.createDataFrame([(0, 9, 11, lex.SYMPTOM, "ho")], "doc_id int, start int, end int, type string, text string")
    nodes, edges = graph.patient_graph(docs, sec, cl, structure.anchors(cl), ent)
    assert {r.node_type for r in nodes.collect()} == {"document", "section", "clause", "anchor", "entity"}
    assert ("clause:0", "mentions_entity", "entity:0") in {(r.source_id, r.relation, r.target_id) for r in edges.collect()}


def test_lexical_ner(spark):
    out = mentions.lexical_ner(docs_of(spark, "Ho và xơ gan"), [(lex.SYMPTOM, "ho", 0.8), (lex.DIAGNOSIS, "xơ gan", 0.5)], 0.6).collect()
    assert [(r.label, r.text, r.score) for r in out] == [(lex.SYMPTOM, "Ho", 0.8)]
    assert lex.bio_labels()[:3] == ["O", f"B-{lex.SYMPTOM}", f"I-{lex.SYMPTOM}"] and len(lex.bio_labels()) == 11


def test_files_round_trip(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for n, t in (("10", "ho đờm"), ("2", "")):
        (tmp_path / "in" / f"{n}.txt").write_text(t, encoding="utf-8")
    docs = files.texts(spark, str(tmp_path / "in"))
    assert {r.doc_id: r.text for r in docs.collect()} == {"10": "ho đờm", "2": ""}
    ent = spark.createDataFrame([("10", 0, 2, lex.SYMPTOM, "ho", ["isNegated"], [])], "doc_id string, start int, end int, type string, text string, assertions array<string>, candidates array<string>")
    sinks.reset_folder(str(tmp_path / "out"))
    assert sinks.write_entity_files(docs, ent, str(tmp_path / "out"), pretty=True) == 2
    assert json.loads((tmp_path / "out" / "2.json").read_text()) == []
    assert json.loads((tmp_path / "out" / "10.json").read_text()) == [{"text": "ho", "position": [0, 2], "type": lex.SYMPTOM, "assertions": ["isNegated"], "candidates": []}]
    assert [tuple(r) for r in files.entity_files(spark, str(tmp_path / "out")).collect()] == [("10", 0, 2, lex.SYMPTOM, "ho", ["isNegated"], [])]
    assert sinks.zip_folder(str(tmp_path / "out"), str(tmp_path / "o.zip")) == 2
    assert sorted(zipfile.ZipFile(tmp_path / "o.zip").namelist()) == ["out/10.json", "out/2.json"]
    reviews = sinks.review_rows(docs, ent)
    sinks.write_jsonl(reviews, str(tmp_path / "r"), single=True)
    back = files.reviews(spark, str(tmp_path / "r"))
    assert all(r.gold_entities is None for r in back.collect())
    gold = {r.file_name: len(r.entities) for r in sinks.gold_of_reviews(back).collect()}
    assert gold == {"10.txt": 1, "2.txt": 0}
    empty = back.withColumn("gold_entities", F.filter("predicted_entities", lambda e: F.lit(False)))
    assert all(r.entities == [] for r in sinks.gold_of_reviews(empty).collect())
    ranked = spark.createDataFrame([("2", 1), ("10", 2)], "doc_id string, rank int")
    assert [r.file_name for r in sinks.selected_reviews(back, ranked, 1).collect()] == ["2.txt"]
    assert [r.file_name for r in sinks.numbered_range(back, "file_name", 5, 100).collect()] == ["10.txt"]
    sinks.write_jsonl(sinks.ner_rows(docs, ent), str(tmp_path / "n"))
    assert sorted(len(r.entities) for r in files.ner_examples(spark, str(tmp_path / "n")).collect()) == [0, 1]
    names = spark.createDataFrame([("68.10.txt",), ("68.2.txt",), ("7.txt",)], "f string")
    assert [r.f for r in names.orderBy(*files.split_order(F.col("f"))).collect()] == ["7.txt", "68.2.txt", "68.10.txt"]
    assert sinks.label_metadata()["label2id"]["O"] == 0


def test_terminology_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "icd.zip", "w") as z:
        z.writestr("x/icd10cm-codes-2026.txt", "A000    Cholera one\nbad\nI10 Hypertension\n")
        z.writestr("other.txt", "Z  no")
    assert sorted((r.code, r.label) for r in archives.icd10_codes(spark, str(tmp_path / "icd.zip")).collect()) == [("A00.0", "Cholera one"), ("I10", "Hypertension")]
    atom = lambda cui, lat, tty, name, sup: "|".join([cui, lat, *[""] * 10, tty, cui, name, "", sup, ""])
    with zipfile.ZipFile(tmp_path / "rx.zip", "w") as z:
        z.writestr("rrf/RXNCONSO.RRF", "\n".join([atom("7", "ENG", "IN", "aspirin", "N"), atom("7", "SPA", "IN", "aspirina", "N"), atom("8", "ENG", "IN", "old", "O"), "short|row"]))
        z.writestr("rrf/RXNREL.RRF", "7|||RB|9|||has_ingredient||\n")
    assert [(r.rxcui, r.str) for r in archives.rxnorm_atoms(spark, str(tmp_path / "rx.zip")).collect()] == [("7", "aspirin")]
    assert [tuple(r) for r in archives.rxnorm_relations(spark, str(tmp_path / "rx.zip")).collect()] == [("7", "has_ingredient", "9")]
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(tmp_path / "b.xlsx", "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>K74</t></si><si><r><t>Xơ </t></r><r><t>gan</t></r></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row r="1"><c t="inlineStr"><is><t>code</t></is></c><c t="inlineStr"><is><t>label</t></is></c></row><row r="2"><c t="s"><v>0</v></c><c t="s"><v>1</v></c></row></sheetData></worksheet>')
    assert [(r.code, r.label) for r in archives.workbook(spark, str(tmp_path / "b.xlsx")).collect()] == [("K74", "Xơ gan")]


def test_settings(tmp_path):
    (tmp_path / "c.yaml").write_text("# x\nknowledge_base:\n  icd10_path: kb/a.json\nmatching:\n  max_candidates: 5\n  min_confidence: 0.6 # y\nner:\n  enable_model_stub: true\n")
    c = files.load_config(str(tmp_path / "c.yaml"))
    assert c.knowledge_base.icd10_path == str(tmp_path / "kb/a.json") and c.matching.max_candidates == 5 and c.matching.min_confidence == 0.6 and c.ner.enabled
    (tmp_path / "d.json").write_text('{"matching": {"odd": 1}}')
    with pytest.raises(ValueError, match="odd"):
        files.load_config(str(tmp_path / "d.json"))
    (tmp_path / "m.json").write_text('{"label_map": {"b-drug x": "THUỐC"}}')
    assert files.label_map(str(tmp_path / "m.json"), {}) == {"B-DRUG_X": "THUỐC", "DRUG_X": "THUỐC"} and files.label_map(None, {"A": "B"}) == {"A": "B"}
    assert files.checkpoint_problems(str(tmp_path), ["c.yaml", "q"]) == ["q is missing"]


def test_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("ho\nsốt")
    q = streams.run_per_batch(streams.text_stream(spark, str(tmp_path / "in")), structure.lines, str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(60)
    assert sorted(r.line for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["ho", "sốt"]
    assert T is not None


def test_inference_end_to_end(spark, kb, tmp_path):
    from textloom.plans import workflows

    for name, system in (("icd10", "icd10"), ("rxnorm", "rxnorm")):
        rows = [{"code": c, "label": label, "aliases": a, "tty": t} for s, c, label, a, t in KB if s == system]
        (tmp_path / f"{name}.json").write_text(json.dumps(rows), encoding="utf-8")
    (tmp_path / "c.yaml").write_text("knowledge_base:\n  icd10_path: icd10.json\n  rxnorm_path: rxnorm.json\n")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.txt").write_text("Tiền sử bệnh nội khoa:\n- tăng huyết áp\nThuốc trước khi nhập viện:\n- aspirin 81 mg po", encoding="utf-8")
    (tmp_path / "in" / "2.txt").write_text("", encoding="utf-8")
    assert workflows.run_submit(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "c.yaml"), str(tmp_path / "o.zip")) == 2
    got = {(e["type"], e["text"]): (e["assertions"], e["candidates"]) for e in json.loads((tmp_path / "out" / "1.json").read_text())}
    assert got[(lex.DIAGNOSIS, "tăng huyết áp")] == (["isHistorical"], ["I10"])
    assert got[(lex.DRUG, "aspirin 81 mg")][0] == ["isHistorical"] and got[(lex.DRUG, "aspirin 81 mg")][1][0] == "243670"
    same = {r.metric: r.f1 for r in workflows.eval_outputs(spark, str(tmp_path / "out"), str(tmp_path / "out")).collect()}
    assert set(same.values()) == {1.0}


def test_blocking_keeps_the_best_text_and_misspelt_words(spark):
    base = spark.createDataFrame([("icd10", f"A{i}", f"fever {'x' * i}", [], None) for i in range(1, 7)] + [("icd10", "Z1", "fever zika", [], None)], "system string, code string, label string, aliases array<string>, tty string")
    asked = spark.createDataFrame([("fever zikb", "icd10"), ("fevre", "icd10"), ("fever zika", "rxnorm")], "query string, system string")
    got = {}
    for r in linking.blocked(asked, base, most=2).collect():
        got.setdefault((r.query, r.system), set()).add(r.code)
    # all share one token with the first query, none with the second
    assert got == {("fever zikb", "icd10"): {"A1", "Z1"}, ("fevre", "icd10"): {"A1", "A2", "A3", "A4", "A5", "A6", "Z1"}}
    top = linking.lexical_top(asked.where("query = 'fevre'"), base, k=1).first()
    assert top.code == "A1" and top.lexical > 0


def test_shortlist_scores_the_drug_without_its_dose(spark):
    base = spark.createDataFrame([("rxnorm", "6809", "metformin", [], "IN")], "system string, code string, label string, aliases array<string>, tty string")
    asked = spark.createDataFrame([("metformin 500 mg", "rxnorm")], "query string, system string")
    (r,) = linking.shortlist(asked, base, k=3).collect()
    # lexical 1 without the dose; aliases hold each other; 0.7 for the ingredient, less 0.05
    cosine = spark.range(1).select(sim.ngram_cosine(F.lit("metformin 500 mg"), F.lit("metformin"))).first()[0]
    assert r.score == pytest.approx(0.4 + 0.2 * 0.94 + 0.2 * cosine + 0.2 * 0.65 + 0.35 + 0.02)


def test_cleaned_spans_and_drug_lines(spark):
    rows = [
        (lex.DRUG, "bệnh nhân dùng metformin 500 mg bid", "metformin 500 mg"), (lex.DRUG, "aspirin 81 mg po daily dose x", "aspirin 81 mg"), (lex.DRUG, "thêm heparin 5000\nvà", "heparin 5000"),
        (lex.DRUG, "warfarin, cùng aspirin", "warfarin"), (lex.DRUG, "10 mg daily", None), (lex.DRUG, "81 mg", None), (lex.DRUG, " ", None), (lex.DRUG, "500", None),
        (lex.DIAGNOSIS, " - với tăng huyết áp. ", "tăng huyết áp"), (lex.SYMPTOM, "  ho khan; ", "ho khan"), (lex.LAB_VALUE, " 14,43 ", "14,43"),
    ]
    got = spark.createDataFrame(rows, "type string, t string, want string").select("t", "want", mentions.cleaned(F.col("t"), F.col("type")).alias("s")).collect()
    for r in got:
        assert (r.s and r.s.text) == r.want, r
        assert r.s is None or r.t[r.s.lead :].startswith(r.s.text)
    lines = [("- aspirin 81 mg po", "aspirin 81 mg po"), ("- theo dõi", None), ("  - abc", None), ("- warfarin (đã ngừng)", "warfarin"), ("", None)]
    drugs = spark.createDataFrame(lines, "t string, want string").select("t", "want", mentions._drug_of_line(F.col("t")).alias("s")).collect()
    assert [(r.s and r.s.text, r.s and r.t.index(r.want) == r.s.start) for r in drugs] == [(w, w and True) for _, w in lines]


def test_maps_by_indentation():
    from textloom.sources.files import simple_yaml

    text = "# head\na:\n  b: 1 # one\n  c:\n    d: 'x: y'\n    e: true\n\n  f: ~\ng: 2.5\nh:\ni: '#no'\n"
    assert simple_yaml(text) == {"a": {"b": 1, "c": {"d": "x: y", "e": True}, "f": None}, "g": 2.5, "h": {}, "i": "#no"}
    assert simple_yaml("") == {}
    for bad in ("- a", "a: 1\n- b", "nothing"):
        with pytest.raises(ValueError):
            simple_yaml(bad)
