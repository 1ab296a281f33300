"""Lines, sections, clauses and anchors (GEN-1, GEN-2, WIN-3, WIN-4)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import spans as S
from ..functions import text as T
from ..lexicon import clinical as lex
from .spans import exploded

Rules = list[tuple[str, list[str], list[str], list[str]]]


def lines(docs: DataFrame) -> DataFrame:
    """doc_id, line_no, start, end, line."""
    return exploded(docs, S.line_spans("text"), "doc_id").select("doc_id", F.col("no").alias("line_no"), "start", "end", F.col("text").alias("line"))


def _array(values: list[str]) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def header_rule(header: Column, rules: Rules = lex.SECTION_RULES, *, longest: bool = True) -> Column:
    """Number of the rule that a header falls under, null for none (STR-5).

    ``longest``: the rule with the longest phrase in the header wins, so that a
    phrase inside a longer one of another rule does not; else the first rule.
    """
    pairs = [(i, a) for i, (_, names, _, _) in enumerate(rules) for a in names]
    if longest:
        pairs.sort(key=lambda p: (-len(p[1]), p[0]))

    def first(h: Column) -> Column:
        out = F.lit(None).cast("int")
        for i, a in reversed(pairs):
            out = F.when(h.contains(a), F.lit(i)).otherwise(out)
        return out

    # as a variable the normalised header is made once, not for every phrase
    return F.transform(F.array(T.normalize_header(header)), first)[0]


def _may_be_header(line: Column, rules: Rules) -> Column:
    """Whether a line holds the longest word of some rule's phrase, which normalising never takes apart."""
    low, out = F.lower(line), F.lit(False)
    for word in sorted({max(re.split(r"[\s:]+", name), key=len) for _, names, _, _ in rules for name in names}):
        out = out | low.contains(word)
    return out


def _described(df: DataFrame, rules: Rules) -> DataFrame:
    """kind, default_assertions and expected_types of column ``rule``."""
    kind, assertions, types = F.lit("general"), _array([]), _array([])
    for i, (k, _, a, t) in enumerate(rules):
        mine = F.col("rule") == i
        kind, assertions, types = F.when(mine, k).otherwise(kind), F.when(mine, _array(a)).otherwise(assertions), F.when(mine, _array(t)).otherwise(types)
    return df.withColumns({"kind": kind, "default_assertions": assertions, "expected_types": types})


def sections(docs: DataFrame, rules: Rules = lex.SECTION_RULES, *, longest: bool = True) -> DataFrame:
    """doc_id, section_no, start, end, header, kind, default_assertions, expected_types.

    A line, or its part before the first colon, that falls under a rule begins a
    section, which goes on to the next one's begin; text before the first is
    ``general``.
    """
    found = lines(docs).withColumn("header", F.btrim(F.substring_index("line", ":", 1)))
    # without a colon the line is its header
    whole = F.when(F.col("line").contains(":"), header_rule(F.col("line"), rules, longest=longest))
    rule = F.coalesce(header_rule(F.col("header"), rules, longest=longest), whole)
    found = found.withColumn("rule", F.when(_may_be_header(F.col("line"), rules), rule))
    begins = found.where("rule is not null").select("doc_id", "start", "header", "rule")
    whole = docs.select("doc_id", F.length("text").alias("size")).where("size > 0")
    # the general section at 0 gives way to a header there
    all_begins = begins.unionByName(whole.select("doc_id", F.lit(0).alias("start"), F.lit("").alias("header"), F.lit(None).cast("int").alias("rule")))
    all_begins = all_begins.groupBy("doc_id", "start").agg(F.max_by(F.struct("header", "rule"), F.col("rule").isNotNull()).alias("x")).select("doc_id", "start", "x.*")
    w = W.partitionBy("doc_id").orderBy("start")
    out = all_begins.join(whole, "doc_id").withColumns({"end": F.lead("start").over(w), "section_no": F.row_number().over(w) - 1})
    out = _described(out.withColumn("end", F.coalesce("end", "size")), rules)
    return out.select("doc_id", "section_no", "start", "end", "header", "kind", "default_assertions", "expected_types")


def clauses(docs: DataFrame, section_table: DataFrame, rules: Rules = lex.SECTION_RULES, *, separators: str = lex.CLAUSE_SEPARATORS, longest: bool = True) -> DataFrame:
    """doc_id, clause_no, section_no, start, end, text, section_kind, default_assertions, expected_types, anchor_text, anchor_kind.

    Sections are split at the separators.  A clause that begins with a short
    header and a colon has an anchor, whose rule adds its default assertions.
    """
    split = S.separated_spans(separators)
    parts = section_table.join(docs.select("doc_id", "text"), "doc_id")
    parts = parts.withColumn("body", F.expr("substring(text, start + 1, end - start)")).drop("text")
    parts = parts.select("*", F.posexplode(split("body")).alias("no", "s"))
    anchor = F.regexp_extract(F.col("s.text"), r"^\s*([^\n:]{1," + str(lex.ANCHOR_CHARS) + r"}):", 1)
    anchor = F.when((anchor != "") & (F.size(F.split(F.trim(anchor), r"\s+")) <= lex.ANCHOR_TOKENS), F.trim(anchor))
    parts = parts.withColumns({"anchor_text": anchor, "rule": header_rule(anchor, rules, longest=longest)})
    parts = parts.withColumnsRenamed({"kind": "section_kind", "default_assertions": "section_assertions", "expected_types": "section_types"})
    parts = _described(parts, rules)
    w = W.partitionBy("doc_id").orderBy("section_no", "no")
    has = F.col("rule").isNotNull()
    return parts.select(
        "doc_id", (F.row_number().over(w) - 1).alias("clause_no"), "section_no", (F.col("start") + F.col("s.start")).alias("start"), (F.col("start") + F.col("s.end")).alias("end"),
        F.col("s.text").alias("text"), "section_kind",
        F.array_sort(F.array_union("section_assertions", "default_assertions")).alias("default_assertions"),
        F.when(has, F.col("expected_types")).otherwise(F.col("section_types")).alias("expected_types"),
        "anchor_text", F.when(F.col("anchor_text").isNotNull(), F.when(has, F.col("kind")).otherwise(F.col("section_kind"))).alias("anchor_kind"),
    )


def anchors(clause_table: DataFrame) -> DataFrame:
    """doc_id, anchor_no, start, end, text, kind, expected_types of the clauses that have one."""
    w = W.partitionBy("doc_id").orderBy("clause_no")
    has = clause_table.where("anchor_text is not null")
    return has.select(
        "doc_id", (F.row_number().over(w) - 1).alias("anchor_no"), "start", (F.col("start") + F.length("anchor_text")).alias("end"), F.col("anchor_text").alias("text"),
        F.col("anchor_kind").alias("kind"), "expected_types",
    )


def with_state(line_table: DataFrame, event: Column, group: str = "doc_id", order: str = "line_no") -> DataFrame:
    """Column ``state``: the last non-null event so far (WIN-4)."""
    w = W.partitionBy(group).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return line_table.withColumn("state", F.last(event, ignorenulls=True).over(w))
