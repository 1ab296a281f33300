"""Gazetteer matching (GEN-4, GEN-14, GEN-16): terms from a table, occurrences in texts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import spans as S
from .spans import exploded

#: Terms beyond this many are joined by their first token instead of being sent to every task.
AUTOMATON_TERMS = 1_000_000


def mentions(docs: DataFrame, terms: Iterable[tuple[str, str]], source: str = "gazetteer") -> DataFrame:
    """doc_id, start, end, type, text, source: every bounded occurrence of (type, term) pairs."""
    out = exploded(docs, S.term_spans(terms)("text"), "doc_id")
    return out.select("doc_id", "start", "end", F.col("label").alias("type"), "text", F.lit(source).alias("source"))


def mentions_of_table(docs: DataFrame, terms: DataFrame, source: str = "gazetteer") -> DataFrame:
    """The same for a table of terms (type, term).

    A table of checked size goes to the tasks as one automaton.  A larger one stays a
    table: tokens of the texts are joined with the terms' first tokens, and the
    rest of the term is compared in place.
    """
    few = terms.select("type", "term").limit(AUTOMATON_TERMS + 1).collect()
    if len(few) <= AUTOMATON_TERMS:
        return mentions(docs, [(r["type"], r["term"]) for r in few], source)
    # a term is joined by its first token, one without letters or digits by its first sign
    token = S.regex_spans([("t", r"[^\W_]+|[^\w\s]|_")])
    heads = terms.select("type", F.lower("term").alias("term")).withColumn("head", F.regexp_extract("term", r"[\p{L}\p{N}]+", 0))
    heads = heads.withColumn("head", F.when(F.col("head") == "", F.regexp_extract("term", r"\S", 0)).otherwise(F.col("head"))).where("head <> ''")
    heads = heads.withColumn("lead", F.position("head", "term") - 1)
    places = docs.select("doc_id", F.lower("text").alias("low"), F.col("text").alias("raw"), F.explode(token("text")).alias("s"))
    hit = places.join(heads, F.lower("s.text") == F.col("head")).withColumn("start", F.col("s.start") - F.col("lead"))
    hit = hit.withColumn("end", F.col("start") + F.length("term")).where((F.col("start") >= 0) & (F.expr("substring(low, start + 1, end - start)") == F.col("term")))
    free = ~F.expr("substring(low, end + 1, 1)").rlike(r"[\p{L}\p{N}]") & ((F.col("start") == 0) | ~F.expr("substring(low, start, 1)").rlike(r"[\p{L}\p{N}]"))
    return hit.where(free).select("doc_id", "start", "end", "type", F.expr("substring(raw, start + 1, end - start)").alias("text"), F.lit(source).alias("source"))
