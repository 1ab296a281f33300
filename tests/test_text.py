from __future__ import annotations

import difflib
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from textloom.functions import similarity as sim
from textloom.functions import spans as S
from textloom.functions import text as T
from textloom.lexicon import clinical as lex


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(column.alias("x")).first()["x"]


def test_normalised_space_and_its_map(spark):
    raw = "  đau\t\tbụng – nhẹ \n"
    assert one(spark, T.normalize_space(F.col("t")), t=raw) == "đau bụng - nhẹ"
    got = one(spark, S.normalized_with_map("t"), t=raw)
    assert got.text == "đau bụng - nhẹ" and len(got.to_raw) == len(got.text)
    assert all(raw[i].isspace() if c == " " else raw[i] in (c, "–") for c, i in zip(got.text, got.to_raw))


def test_abbreviations_and_their_map(spark):
    got = one(spark, S.expanded(lex.ABBREVIATIONS)("t"), t="BN có THA, ho")
    assert got.text == "BN có tăng huyết áp, ho"
    at = got.text.index("tăng")
    assert got.to_raw[at] == 6 and got.to_raw[at + len("tăng huyết áp") - 1] == 8
    assert [got.to_raw[got.text.index("ho")]] == [len("BN có THA, ")]


def test_folding_agrees_with_decomposition(spark):
    text = "Đái tháo ĐƯỜNG ợ ữ Ỵ é ñ Ç Ω ά й ё é"
    want = "".join(c for c in unicodedata.normalize("NFD", text.lower()) if unicodedata.category(c) != "Mn").replace("đ", "d")
    assert one(spark, T.ascii_fold(F.col("t")), t=text) == want == one(spark, S.nfd_fold("t"), t=text)
    assert one(spark, T.match_key(F.col("t")), t=" Đau-bụng (NHẸ)! ") == "dau bung nhe"


def test_strengths_and_queries(spark):
    s = one(spark, T.strength(F.col("t")), t="Aspirin 2,5 MG/ml bid")
    assert (s.number, s.unit) == ("2.5", "mg/ml") and one(spark, T.strength(F.col("t")), t="aspirin") is None
    assert one(spark, T.strip_last_strength(F.col("t")), t="aspirin 81 mg") == "aspirin"
    assert one(spark, T.diagnosis_query(F.col("t")), t=": nghi ngờ xơ gan, có báng") == "xơ gan"
    assert one(spark, T.drug_query(F.col("t")), t="uống aspirin 81 mg po daily và khác") == "aspirin 81 mg"
    assert one(spark, T.dotted_code(F.col("t")), t="a0101") == "A01.01" and one(spark, T.dotted_code(F.col("t")), t="I10") == "I10"
    assert one(spark, T.clean_alias(F.col("t")), t="  a \n b ") == "a b" and one(spark, T.clean_alias(F.col("t")), t="x" * 81) is None


def test_response_of_a_model(spark):
    text = 'Here:\n```{"assertions": ["isFamily", "odd", "isFamily"], "candidates": ["I10: x", " I10", "K74.6", "A", "B"]}```'
    got = one(spark, T.parse_response(F.col("t")), t=text)
    assert got.assertions == ["isFamily"] and got.candidates == ["I10", "K74.6", "A"]
    none = one(spark, T.parse_response(F.col("t")), t="no json")
    assert none.assertions == [] and none.candidates == []


def test_labels_and_bodies(spark):
    assert one(spark, T.ner_label(F.col("t")), t="B-DIAGNOSIS") == lex.DIAGNOSIS
    assert one(spark, T.ner_label(F.col("t")), t="LABEL_drug") == lex.DRUG and one(spark, T.ner_label(F.col("t")), t="B-CITY") is None
    keeps = lambda t: one(spark, T.keeps_body(F.col("t")), t=t)
    assert keeps("- đau đầu nhẹ") and not keeps("a, b, c") and not keeps("a; b") and not keeps("x" * 97) and not keeps("khỏe mạnh") and not keeps("-")
    assert one(spark, T.normalize_header(F.col("t")), t=" 2. Bệnh SỬ:  x") == "bệnh sử x"


def test_sequence_ratio_is_difflib(spark):
    rng = random.Random(1)
    pairs = [("".join(rng.choice("abcd ") for _ in range(rng.randrange(12))), "".join(rng.choice("abcd ") for _ in range(rng.randrange(250)))) for _ in range(60)]
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", sim.sequence_ratio("a", "b").alias("r")).collect()
    assert all(r.r == pytest.approx(difflib.SequenceMatcher(None, r.a, r.b).ratio()) for r in got)


def test_similarities(spark):
    assert one(spark, sim.alias_similarity(F.col("a"), F.col("b")), a="xơ gan", b="xơ gan rượu") == 0.9
    assert one(spark, sim.alias_similarity(F.col("a"), F.col("b")), a="a b c", b="b c d e") == 0.5
    s = one(spark, sim.structured_match(F.col("a"), F.col("b")), a="aspirin 81 mg po", b="aspirin 81 mg po")
    assert s.score == pytest.approx(1.0) and not s.mismatch
    s = one(spark, sim.structured_match(F.col("a"), F.col("b")), a="aspirin 81 mg", b="aspirin 325 mg")
    assert s.score == pytest.approx(0.45) and s.mismatch
    assert one(spark, sim.lexical_score(F.col("a"), F.col("a"), F.col("b")), a="xơ gan", b="xơ gan") == 1.0
    assert one(spark, sim.ngram_cosine("a", "b"), a="Xơ gan", b="xo gan") == pytest.approx(1.0)
    assert one(spark, sim.ngram_cosine("a", "b"), a="", b="xo gan") == 0
    assert one(spark, sim.cosine(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(1.0))), t=1) == pytest.approx(2**-0.5)


def test_preference_for_ingredients(spark):
    p = lambda q, label, tty, aliases=(): one(spark, sim.bare_drug_preference(F.col("q"), F.col("l"), F.array(*map(F.lit, aliases)) if aliases else F.array().cast("array<string>"), F.lit(tty)), q=q, l=label)
    assert p("aspirin", "aspirin", "IN") == pytest.approx(0.12)
    assert p("aspirin 81 mg", "aspirin 81 MG Oral Tablet", "SCD") == pytest.approx(0.08)
    assert p("aspirin", "aspirin 81 MG Oral Tablet", "SCD") == pytest.approx(-0.18)
    assert p("asa", "aspirin", "BN", ["ASA"]) == pytest.approx(0.15)


def test_spans_count_code_points(spark):
    text = "😀 ho, đờm x\nThe MIT license; y. z"
    lines = one(spark, S.line_spans("t"), t=text)
    assert [text[s.start : s.end] for s in lines] == [s.text for s in lines] == ["😀 ho, đờm x", "The MIT license; y. z"]
    found = one(spark, S.term_spans([("a", "mit license"), ("b", "license"), ("c", "ho"), ("d", "cens")])("t"), t=text)
    assert sorted((s.label, s.text) for s in found) == [("a", "MIT license"), ("b", "license"), ("c", "ho")]
    parts = one(spark, S.separated_spans(".;\n")("t"), t=" a b ;; c.\n")
    assert [(s.start, s.text) for s in parts] == [(1, "a b"), (8, "c")]
    assert one(spark, S.line_spans("t"), t="") == [] and S.lines_of("\n") == [(0, 0)]
