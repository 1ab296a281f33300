"""Validators: rows that break an invariant, with the reason (FLT-3, FLT-11..15)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..lexicon import clinical as lex
from .spans import beside_text

ENTITY_KEYS = ["text", "position", "type", "assertions", "candidates"]


def problem(size: Column, slice_: Column, types: list[str] = lex.ENTITY_TYPES, *, empty_spans: bool = True) -> Column:
    """The first invariant that an entity (start, end, type, text, assertions, candidates) breaks; null if it is sound.

    ``empty_spans`` tells whether start may equal end.
    """
    start, end = F.col("start"), F.col("end")
    ordered = (start <= end) if empty_spans else (start < end)
    uncoded = ~F.col("type").isin(*lex.CODED_TYPES)
    return (
        F.when(F.col("type").isNull() | ~F.col("type").isin(*types), "unknown type")
        .when(start.isNull() | end.isNull() | (start < 0) | ~ordered | (end > size), "bad span")
        .when(~F.col("text").eqNullSafe(slice_), "text differs from its span")
        .when(F.exists("assertions", lambda a: ~a.isin(*lex.ASSERTIONS)), "unknown assertion")
        .when(~F.col("type").isin(*lex.ASSERTED_TYPES) & (F.size("assertions") > 0), "assertions on this type")
        .when(uncoded & (F.size("candidates") > 0), "codes on this type")
    )


def entity_problems(entities: DataFrame, docs: DataFrame, types: list[str] = lex.ENTITY_TYPES, *, empty_spans: bool = True) -> DataFrame:
    """Entities that break an invariant, with ``problem`` (FLT-11; FLT-13 with empty_spans=False)."""
    read = lambda m, text: {"__n": F.length(text), "__s": F.substring(text, m["start"] + 1, m["end"] - m["start"])}
    rows = beside_text(entities, docs, read, how="left")
    found = F.when(F.col("__n").isNull(), "no such document").otherwise(problem(F.col("__n"), F.col("__s"), types, empty_spans=empty_spans))
    return rows.withColumn("problem", found).where("problem is not null").drop("__n", "__s")


def ner_problems(examples: DataFrame, types: list[str] = lex.ENTITY_TYPES) -> DataFrame:
    """example_id, start, end, type, problem of the training entities that no model can learn (FLT-14).

    ``examples`` has example_id, text and entities (start, end, type).
    """
    rows = examples.select("example_id", F.length("text").alias("__n"), F.explode("entities").alias("e")).select("example_id", "__n", "e.start", "e.end", "e.type")
    sound = (F.col("start") >= 0) & (F.col("start") < F.col("end")) & (F.col("end") <= F.col("__n"))
    problem = F.when(F.col("type").isNull() | ~F.col("type").isin(*types), "unknown type").when(~F.coalesce(sound, F.lit(False)), "bad span")
    return rows.withColumn("problem", problem).where("problem is not null").drop("__n")


def missing_outputs(inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """doc_id, side: documents without output and outputs without document (FLT-12)."""
    a = inputs.select("doc_id").distinct().join(outputs.select("doc_id").distinct(), "doc_id", "left_anti").withColumn("side", F.lit("no output"))
    b = outputs.select("doc_id").distinct().join(inputs.select("doc_id").distinct(), "doc_id", "left_anti").withColumn("side", F.lit("no input"))
    return a.unionByName(b)


def checked(rows: DataFrame, ok: Column, message: str) -> DataFrame:
    """``rows``, failing the query at the first row that is not ok (FAILFAST)."""
    return rows.where(F.when(F.coalesce(ok, F.lit(False)), F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean")))


def ruled(entities: DataFrame) -> DataFrame:
    """Assertions and codes cleared on types that have none (FLT-3)."""
    none = F.array().cast("array<string>")
    return entities.withColumns({
        "assertions": F.when(F.col("type").isin(*lex.ASSERTED_TYPES), F.col("assertions")).otherwise(none),
        "candidates": F.when(F.col("type").isin(*lex.CODED_TYPES), F.col("candidates")).otherwise(none),
    })


def spans_unchanged(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of ``before`` that ``after`` lacks or moved (FLT-15): empty if spans, types and texts are as they were."""
    key = ["doc_id", "start", "end", "type", "text"]
    return before.select(*key).exceptAll(after.select(*key))
