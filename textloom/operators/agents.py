"""Codes and assertions for spans that are given: retrieve, assert, select, judge, merge (DEC-5, DEC-7, DEC-8, DEC-11).

Every step is columns or joins keyed by (doc_id, ord), the entity's place in its
document; retrieval runs once per distinct mention.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import spans as S
from ..functions import text as T
from ..lexicon import clinical as lex
from . import assertions, datasets, linking

KEY = ["doc_id", "ord"]
_ROW = "struct<code: string, label: string, score: double, source: string, matched_alias: string>"


def retrieve(entities: DataFrame, kb: DataFrame, *, abbreviations: dict[str, str] | None = None, k: int = 10, least: float = 0.2) -> DataFrame:
    """``entities`` with ``shortlist``: the best records for the mention and for its expanded form, then the codes that it has (DEC-5).

    A code that both forms find keeps its better row, the mention's of equals
    (AGG-12); codes that are not found are appended as ``mapped`` with score 0.
    """
    system = F.when(F.col("type") == lex.DIAGNOSIS, "icd10").when(F.col("type") == lex.DRUG, "rxnorm")
    asked = entities.where(system.isNotNull()).select("text", system.alias("system")).distinct()
    long = S.expanded(abbreviations)("text")["text"] if abbreviations else F.col("text")
    forms = asked.select("text", "system", F.posexplode(F.array_distinct(F.array("text", long))).alias("form_no", "query")).where("trim(query) <> ''")
    found = linking.shortlist(forms.select("query", "system").distinct(), kb, k=k, least=least)
    best = linking.best_per_code(forms.join(found, ["query", "system"]), ["text", "system"], "form_no")
    row = F.struct("code", "label", "score", "source", "matched_alias")
    lists = best.groupBy("text", "system").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "code", row.alias("r")))).alias("x"))
    lists = lists.select(F.col("text").alias("__text"), F.col("system").alias("__system"), F.slice(F.transform("x", lambda r: r["r"]), 1, k).alias("ranked"))
    joined = entities.join(lists, (F.col("text") == F.col("__text")) & (system == F.col("__system")), "left").drop("__text", "__system")
    ranked = F.coalesce(F.col("ranked"), F.lit(None).cast(f"array<{_ROW}>"), F.array().cast(f"array<{_ROW}>"))
    missing = F.array_except(T.candidate_codes(F.col("candidates"), 1000), F.transform(ranked, lambda r: r["code"]))
    none = F.lit("")
    mapped = F.transform(missing, lambda c: F.struct(c.alias("code"), none.alias("label"), F.lit(0.0).alias("score"), F.lit("mapped").alias("source"), none.alias("matched_alias")))
    return joined.withColumn("shortlist", F.when(F.col("type").isin(*lex.CODED_TYPES), F.concat(ranked, mapped)).otherwise(F.array().cast(f"array<{_ROW}>"))).drop("ranked")


def asserted(entities: DataFrame, clauses: DataFrame, docs: DataFrame) -> DataFrame:
    """``entities`` whose known assertions stay; where there are none, those of the text (DEC-7)."""
    own = entities.withColumn("__given", T.known_assertions(F.coalesce("assertions", F.array().cast("array<string>")))).drop("assertions")
    read = assertions.infer(own, clauses, docs)
    given = F.when(F.col("type").isin(*lex.ASSERTED_TYPES) & (F.size("__given") > 0), F.col("__given")).otherwise(F.col("assertions"))
    return read.withColumn("assertions", given).drop("__given")


def selected(rows: DataFrame, generate: Callable[[Column], Column] | None, *, most: int = 3) -> DataFrame:
    """``rows`` with ``predicted``: a generator's codes that are in the shortlist, at most three (DEC-8).

    ``generate`` makes a text of a prompt, as a Pandas UDF does; without it nothing is predicted.
    """
    if generate is None:
        return rows.withColumn("predicted", F.array().cast("array<string>"))
    prompted = rows.withColumn("mention", F.col("text"))
    answer = F.when(F.size("shortlist") > 0, generate(datasets.user_prompt()))
    listed = F.transform("shortlist", lambda r: r["code"])
    codes = F.filter(T.parse_response(answer)["candidates"], lambda c: F.array_contains(listed, c))
    return prompted.withColumn("predicted", F.slice(F.coalesce(codes, F.array().cast("array<string>")), 1, most)).drop("mention")


def process(
    docs: DataFrame,
    entities: DataFrame,
    clauses: DataFrame,
    kb: DataFrame,
    *,
    abbreviations: dict[str, str] | None = None,
    generate: Callable[[Column], Column] | None = None,
    k: int = 10,
    width: int = 96,
    cut: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """doc_id, ord, start, end, type, text, assertions, candidates of given entities, in their order (DEC-11).

    Spans, types and texts stay as they are.  ``cut`` may write a step's rows.
    """
    listed = cut(retrieve(entities, kb, abbreviations=abbreviations, k=k))
    told = cut(asserted(listed, clauses, docs))
    whole = docs.select("doc_id", F.col("text").alias("__whole"))
    seen = told.join(whole, "doc_id").withColumn("context", T.context(F.col("__whole"), F.col("start"), F.col("end"), width)).drop("__whole")
    judged = linking.judge(selected(seen, generate))
    return judged.select(*KEY, "start", "end", "type", "text", "assertions", F.col("codes").alias("candidates"))
