"""The pipeline against a plain re-computation of every stage, on its own input."""

from __future__ import annotations

import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd

import corpus_pipeline
from textloom.llm import common, langid, mixing, token_files

from .test_similarity_ops import brute_components, brute_contained
from .test_text_ops import _plain_identification

SF = "/root/testdata/sf0.001"


def test_every_stage_equals_brute_force(spark):
    source = common.table(spark, SF, "documents")
    items = [(r.item_id, r.text) for r in common.table(spark, SF, "benchmark").collect()]
    model = langid.learn(langid.training_rows(source))
    rows = {r.doc_id: r for r in source.collect()}

    def plain_language(docs):
        found = {i: _plain_identification(rows[i].text, model)[:2] for i in docs}
        return [i for i in docs if found[i][0] != "und" and found[i][1] >= 0.5]

    def plain_join(docs):
        components = brute_components([(i, rows[i].text) for i in docs], 5, 80)
        return [i for i, n, component, _ in components if not n or i == component]

    def plain_decontamination(docs):
        bad = {i for i, *_ in brute_contained([(i, rows[i].text) for i in docs], items, 5, 80)}
        assert bad
        return [i for i in docs if i not in bad]

    def plain_mix(docs):
        c = duckdb.connect()
        c.register("documents", pd.DataFrame([(i, rows[i].source, rows[i].text) for i in docs], columns=["doc_id", "source", "text"]))
        return [i for i, n in c.execute(mixing.OP9_SQL).df()[["doc_id", "copies"]].itertuples(index=False) for _ in range(n)]

    plain = {"language_id": plain_language, "jaccard_join": plain_join, "decontaminate": plain_decontamination, "mix": plain_mix}
    assert [n for n, _ in corpus_pipeline.STAGES] == [*plain, "token_files"]
    scratch = common.Scratch(spark, "stages")
    docs, ids = source, sorted(rows)
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.table(stage(spark, docs, SF), name)
        if name in plain:
            ids = plain[name](ids)
            got = docs.collect()
            assert docs.columns == source.columns and all(r == rows[r.doc_id] for r in got)
            assert Counter(r.doc_id for r in got) == Counter(ids), name
    tokenizer, start, want = token_files._tokenizer(token_files.default_tokenizer())[0], 0, []
    for i in sorted(ids):
        own = [*tokenizer.encode(rows[i].text or "", add_special_tokens=False).ids, 2]
        want.append((i, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        start += len(own)
    assert sorted(map(tuple, docs.collect())) == want


def test_stages_take_odd_rows_and_columns(spark):
    """Nulls in every column, empty and very long texts, repeated rows, clashing names; and no rows at all."""
    text = "one two three four five six seven " * 3
    rows = [(1, text, "en", "a", 5), (1, text, "en", "a", 5), (2, None, None, None, None), (3, "", "en", "a", 0), (None, text, None, None, 1), (4, "alpha beta " * 60_000, "en", None, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for c in ("text_key", "kept_id", "bad_id", "mix_id", "copy", "place", "spans", "score", "band"):
        docs = docs.selectExpr("*", f"'x' {c}")
    for some in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, some, SF)
            assert out.columns == docs.columns, name
            assert {tuple(r) for r in out.collect()} <= {tuple(r) for r in some.collect()}
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, docs, SF).count() == len(rows) and last(spark, docs.limit(0), SF).count() == 0
