"""Scores, comparisons, audits and reviews of entity tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..lexicon import clinical as lex
from .validation import checked


def prf(gold: DataFrame, predicted: DataFrame, keys: dict[str, list[str]]) -> DataFrame:
    """metric, tp, fp, fn, precision, recall, f1 over distinct keys, micro-summed (AGG-4, SET-1).

    ``keys`` names the columns of each metric; both tables have all of them.
    """
    out = None
    for metric, columns in keys.items():
        sides = gold.select(*columns).distinct().withColumn("__g", F.lit(1)).join(
            predicted.select(*columns).distinct().withColumn("__p", F.lit(1)).withColumnsRenamed({c: f"__{c}" for c in columns}),
            [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in columns], "full_outer",
        )
        counts = sides.agg(
            F.lit(metric).alias("metric"), F.count_if((F.col("__g") == 1) & (F.col("__p") == 1)).alias("tp"), F.count_if(F.col("__g").isNull()).alias("fp"), F.count_if(F.col("__p").isNull()).alias("fn")
        )
        out = counts if out is None else out.unionByName(counts)
    return with_rates(out)


def with_rates(counts: DataFrame) -> DataFrame:
    """precision, recall and f1 of tp, fp and fn; 0 where a denominator is."""
    rate = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns({"precision": rate(tp, tp + fp), "recall": rate(tp, tp + fn), "f1": rate(2 * tp, 2 * tp + fp + fn)})


def evaluate_entities(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """The five metrics of entity tables (doc_id, start, end, type, text, assertions, candidates) (A8)."""
    def flat(df: DataFrame) -> DataFrame:
        return df.withColumns({"a": F.array_join(F.array_sort("assertions"), "|"), "c": F.array_join("candidates", "|")})

    def items(df: DataFrame, column: str, types: list[str]) -> DataFrame:
        return df.where(F.col("type").isin(*types)).select("doc_id", "start", "end", "type", F.explode(column).alias("value"))

    span = ["doc_id", "start", "end"]
    out = prf(flat(gold), flat(predicted), {"entity_span": span, "entity_span_type": [*span, "type"], "entity_record": [*span, "type", "text", "a", "c"]})
    for metric, column, types in (("assertions", "assertions", lex.ASSERTED_TYPES), ("candidates", "candidates", lex.CODED_TYPES)):
        out = out.unionByName(prf(items(gold, column, types), items(predicted, column, types), {metric: [*span, "type", "value"]}))
    return out


def token_metrics(tokens: DataFrame, ignore: int = -100) -> DataFrame:
    """accuracy, precision, recall, f1 of token labels (gold, predicted: ids, 0 is O) (AGG-19).

    A wrong label other than O is both a false positive and a false negative.
    """
    rows = tokens.where(F.col("gold") != ignore)
    g, p = F.col("gold"), F.col("predicted")
    counts = rows.agg(
        F.avg((g == p).cast("double")).alias("accuracy"), F.count_if((g == p) & (g != 0)).alias("tp"), F.count_if((p != 0) & (g != p)).alias("fp"), F.count_if((g != 0) & (g != p)).alias("fn")
    )
    return with_rates(counts)


def entity_summary(files: DataFrame, entities: DataFrame) -> DataFrame:
    """type, entities, files: counts by type, with the number of all files (AGG-1)."""
    total = files.agg(F.countDistinct("doc_id").alias("files"))
    return entities.groupBy("type").agg(F.count(F.lit(1)).alias("entities")).join(F.broadcast(total))


def unmatched(entities: DataFrame, types: list[str] = lex.CODED_TYPES) -> DataFrame:
    """Coded types without codes (FLT-1, FLT-2)."""
    return entities.where(F.col("type").isin(*types) & (F.size("candidates") == 0))


def top_texts(rows: DataFrame, order: str, most: int = 25) -> DataFrame:
    """type, text, n: the most frequent texts, first seen first (AGG-2, TOP-11)."""
    return rows.groupBy("type", "text").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first_seen")).orderBy(F.desc("n"), "first_seen", "type", "text").limit(most)


def review_stats(files: DataFrame, entities: DataFrame) -> DataFrame:
    """doc_id with entities, unmatched, assertions, diversity, score (AGG-3); files without entities count too."""
    own = entities.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("entities"), F.count_if(F.col("type").isin(*lex.CODED_TYPES) & (F.size("candidates") == 0)).alias("unmatched"),
        F.sum(F.size("assertions")).alias("assertions"), F.countDistinct("type").alias("diversity"),
    )
    out = files.select("doc_id").distinct().join(own, "doc_id", "left").na.fill(0)
    return out.withColumn("score", 10 * F.col("unmatched") + 2 * F.col("assertions") + F.col("diversity") + 0.1 * F.col("entities"))


REVIEW_ORDER = ["unmatched", "assertions", "diversity", "entities"]


def review_rank(stats: DataFrame, most: int | None = None) -> DataFrame:
    """Files in the order of review, numbered (TOP-6); ``most`` keeps the first.

    Files of equal counts are ranked among themselves, behind the numbers of the
    groups before, so that only the distinct counts meet in one task.
    """
    order = [F.desc(c) for c in REVIEW_ORDER]
    if most is not None:
        stats = stats.orderBy(*order, "doc_id").limit(most)
    groups = stats.groupBy(*REVIEW_ORDER).agg(F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(W.orderBy(*order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__before")
    groups = groups.select(*[F.col(c).alias(f"__{c}") for c in REVIEW_ORDER], before)
    joined = stats.join(groups, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in REVIEW_ORDER])
    place = F.col("__before") + F.row_number().over(W.partitionBy(*REVIEW_ORDER).orderBy("doc_id"))
    return joined.withColumn("rank", place.cast("int")).drop("__before", *[f"__{c}" for c in REVIEW_ORDER])


def compare(base: DataFrame, changed: DataFrame, key: list[str]) -> DataFrame:
    """Each base row with before, after and what happened to its codes (JOIN-9): same, changed, emptied, filled, grew, missing."""
    after = changed.select(*[F.col(c).alias(f"__{c}") for c in key], F.col("candidates").alias("after"))
    rows = base.select(*key, F.col("candidates").alias("before")).join(after, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in key], "left").drop(*[f"__{c}" for c in key])
    b, a = F.size("before"), F.size("after")
    change = (
        F.when(F.col("after").isNull(), "missing").when(F.col("before") == F.col("after"), "same").when((b > 0) & (a == 0), "emptied").when((b == 0) & (a > 0), "filled").when(a > b, "grew").otherwise("changed")
    )
    return rows.withColumn("change", change)


def zip_positions(gold: DataFrame, predicted: DataFrame, key: str, order: list[str], columns: list[str]) -> DataFrame:
    """The n-th gold row of each key beside its n-th predicted row (JOIN-10): key, no, gold, predicted (structs of ``columns``).

    A key with more rows on one side fails the query.
    """
    def numbered(df: DataFrame, name: str) -> DataFrame:
        no = F.row_number().over(W.partitionBy(key).orderBy(*order))
        return df.select(F.col(key), no.alias("no"), F.struct(*columns).alias(name))

    both = numbered(gold, "gold").join(numbered(predicted, "predicted"), [key, "no"], "full_outer")
    return checked(both, F.col("gold").isNotNull() & F.col("predicted").isNotNull(), "gold and predicted entities differ in number")


def subset_report(pairs: DataFrame) -> DataFrame:
    """type, n, same_type, same_assertions, same_codes, lost, spurious of zipped (type, assertions, candidates)."""
    g, p = (lambda c: F.col(f"gold.{c}")), (lambda c: F.col(f"predicted.{c}"))
    return pairs.groupBy(g("type").alias("type")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(g("type") == p("type")).alias("same_type"), F.count_if(F.array_sort(g("assertions")) == F.array_sort(p("assertions"))).alias("same_assertions"),
        F.count_if(g("candidates") == p("candidates")).alias("same_codes"), F.count_if((F.size(g("candidates")) > 0) & (F.size(p("candidates")) == 0)).alias("lost"),
        F.count_if((F.size(g("candidates")) == 0) & (F.size(p("candidates")) > 0)).alias("spurious"),
    )


def comparison_report(compared: DataFrame) -> DataFrame:
    """type, change, n (AGG-17)."""
    return compared.groupBy("type", "change").agg(F.count(F.lit(1)).alias("n"))


def inconsistent(rows: DataFrame, by: list[Column], what: dict[str, Column]) -> DataFrame:
    """Groups in which a value differs (AGG-15): the keys, n, and the number of distinct values of each."""
    counts = [F.countDistinct(c).alias(name) for name, c in what.items()]
    out = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *counts)
    differs = F.lit(False)
    for name in what:
        differs = differs | (F.col(name) > 1)
    return out.where(differs)


def risk_reasons(entities: DataFrame) -> DataFrame:
    """Entities with reasons to look at them (AGG-15, TOP-10: most reasons first by ``reasons_n``)."""
    c, t = F.col("candidates"), F.col("text")
    coded = F.col("type").isin(*lex.CODED_TYPES)
    reasons = F.array_compact(
        F.array(
            F.when(coded & (F.size(c) == 0), "no_code"), F.when(F.size(c) > 1, "several_codes"), F.when(F.size(c) != F.size(F.array_distinct(c)), "repeated_code"),
            F.when(~coded & (F.size(c) > 0), "code_on_uncoded_type"), F.when(F.length(F.trim(t)) <= 2, "short_text"), F.when(F.size("assertions") > 1, "several_assertions"),
        )
    )
    return entities.withColumn("reasons", reasons).withColumn("reasons_n", F.size("reasons"))


def sanity(files: DataFrame, entities: DataFrame) -> DataFrame:
    """doc_id, entities, all_uncoded, repeated_codes: files that are empty, all uncoded or repeat a code (AGG-16)."""
    coded = F.col("type").isin(*lex.CODED_TYPES)
    own = entities.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("entities"), F.coalesce(F.bool_and(F.when(coded, F.size("candidates") == 0)), F.lit(False)).alias("all_uncoded"),
        F.count_if(F.size("candidates") != F.size(F.array_distinct("candidates"))).alias("repeated_codes"),
    )
    out = files.select("doc_id").distinct().join(own, "doc_id", "left").na.fill(0).na.fill(False)
    return out.where("entities = 0 or all_uncoded or repeated_codes > 0")
