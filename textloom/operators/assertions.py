"""Assertions of entities from cues before them (DEC-1, WIN-9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..lexicon import clinical as lex
from .spans import beside_text, enclosing


def has_cue(text: Column, cues: list[str]) -> Column:
    """Phrases anywhere, single words bounded."""
    out = F.lit(False)
    for c in cues:
        out = out | (text.contains(c) if " " in c else text.rlike(rf"(?U)\b{c}\b"))
    return out


def after_contrast(prefix: Column, cues: list[str] = lex.CONTRAST_CUES) -> Column:
    """What stands behind the last contrast (WIN-9)."""
    for c in cues:
        prefix = F.substring_index(prefix, c, -1)
    return prefix


def since_separator(text: Column, separators: str = lex.CLAUSE_SEPARATORS) -> Column:
    """What stands behind the last separator; not by a regular expression, which would try every place of the text."""
    for c in separators:
        text = F.substring_index(text, c, -1)
    return text


def negated(prefix: Column) -> Column:
    """A negation that scopes: set phrases and double negations are blanked first (A5)."""
    for p in [*lex.NOT_SCOPING, *lex.DOUBLE_NEGATIONS]:
        prefix = F.replace(prefix, F.lit(p), F.lit(" "))
    return (F.trim(prefix) != "") & has_cue(prefix, lex.NEGATION_CUES)


def infer(entities: DataFrame, clauses: DataFrame, docs: DataFrame, *, window: int = 64) -> DataFrame:
    """``entities`` (doc_id, start, end, type, ...) with assertions: the clause's defaults and the cues before the span.

    Without a clause, the cues are looked for in ``window`` characters.
    """
    own = entities.withColumn("__id", F.concat_ws(":", "start", "end", "type"))
    placed = enclosing(own, clauses, "__id", "clause_no")
    c = clauses.select("doc_id", "clause_no", F.col("start").alias("__a"), F.col("text").alias("__c"), F.col("default_assertions").alias("__d"))
    # where the first phrase of drug histories ends in a document: one number, not the text before every span
    low = F.lower("text")
    ends = F.array_min(F.array_compact(F.array(*[F.when(low.contains(p), F.locate(p, low) - 1 + len(p)) for p in lex.DRUG_HISTORY_CUES])))
    rows = placed.join(c, ["doc_id", "clause_no"], "left").join(docs.select("doc_id", ends.alias("__h")), "doc_id")
    # texts are only met by spans that no clause holds
    loose = placed.where("clause_no is null").select("doc_id", "__id", "start").distinct()
    read = lambda m, text: {"__n": F.substring(text, F.greatest(m["start"] - window, F.lit(0)) + 1, F.least(m["start"], F.lit(window)))}
    rows = rows.join(beside_text(loose, docs, read).select("doc_id", "__id", "__n"), ["doc_id", "__id"], "left")
    near = since_separator(F.coalesce("__n", F.lit("")))
    inside = F.substring(F.col("__c"), F.lit(1), F.greatest(F.col("start") - F.col("__a"), F.lit(0)))
    prefix = after_contrast(F.lower(F.when(F.col("__c").isNotNull(), inside).otherwise(near)))
    rows = rows.withColumns({"__p": F.btrim(prefix), "__b": F.coalesce(F.col("__h") <= F.col("start"), F.lit(False))})
    historical = has_cue(F.col("__p"), lex.HISTORY_CUES) | ((F.col("type") == lex.DRUG) & F.col("__b"))
    found = F.array_compact(
        F.array(
            F.when(negated(F.col("__p")), "isNegated"),
            F.when(has_cue(F.col("__p"), lex.FAMILY_CUES) | (F.lower("__c").startswith("gia đình") & (F.size("__d") == 0)), "isFamily"),
            F.when(historical, "isHistorical"),
        )
    )
    every = F.array_sort(F.array_union(F.coalesce("__d", F.array().cast("array<string>")), found))
    out = F.when(F.col("type").isin(*lex.ASSERTED_TYPES), every).otherwise(F.array().cast("array<string>"))
    return rows.withColumn("assertions", out).drop("__id", "__a", "__c", "__d", "__n", "__h", "__p", "__b", "clause_no")
