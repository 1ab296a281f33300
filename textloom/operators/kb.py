"""Building, merging and auditing knowledge bases (AGG-5..8, JOIN-11, JOIN-12, JOIN-14)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from ..lexicon import clinical as lex



def merge_seed(base: DataFrame, seed: DataFrame) -> DataFrame:
    """code, label, aliases: the union of both, the base's label first; another label of the seed becomes an alias (JOIN-11)."""
    s = seed.select("code", F.col("label").alias("seed_label"), F.col("aliases").alias("seed_aliases"))
    both = base.select("code", "label", "aliases").join(s, "code", "full_outer")
    none = F.array().cast("array<string>")
    label = F.coalesce("label", "seed_label")
    every = F.concat(F.coalesce("aliases", none), F.coalesce("seed_aliases", none), F.when(F.col("seed_label").isNotNull(), F.array("seed_label")).otherwise(none))
    return both.select("code", label.alias("label"), F.array_sort(F.array_except(F.array_distinct(every), F.array(label))).alias("aliases"))


def audit(kb: DataFrame, row_no: str = "row_no") -> DataFrame:
    """One row of counts: records, distinct and duplicate codes, aliases, alias average, share of codes with digits, invalid rows (AGG-5)."""
    n = F.size(F.coalesce("aliases", F.array().cast("array<string>")))
    bad = F.coalesce(F.trim("code") == "", F.lit(True)) | F.coalesce(F.trim("label") == "", F.lit(True))
    totals = kb.agg(
        F.count(F.lit(1)).alias("records"), F.countDistinct("code").alias("codes"), F.sum(n).alias("aliases"), F.round(F.avg(n.cast("double")), 4).alias("aliases_avg"),
        F.round(F.avg(F.col("code").rlike("[0-9]").cast("double")), 4).alias("digit_codes"), F.count_if(bad).alias("invalid"),
    )
    twice = kb.groupBy("code").count().where("count > 1").agg(F.count(F.lit(1)).alias("duplicates"))
    return totals.join(F.broadcast(twice))


def duplicate_codes(kb: DataFrame, most: int = 20) -> DataFrame:
    """The first codes that occur more than once, with their number."""
    return kb.groupBy("code").agg(F.count(F.lit(1)).alias("n")).where("n > 1").orderBy("code").limit(most)


def group_rows(rows: DataFrame) -> DataFrame:
    """code, label, aliases of (row_no, code, label) rows: the first label, the others as aliases (AGG-7)."""
    out = rows.groupBy("code").agg(F.min_by("label", "row_no").alias("label"), F.collect_set("label").alias("all"))
    return out.select("code", "label", F.array_sort(F.array_except("all", F.array("label"))).alias("aliases"))


def group_concepts(concepts: DataFrame) -> DataFrame:
    """code, label, aliases, tty of RxNorm atoms (row_no, rxcui, tty, str) (AGG-6).

    Aliases come from all term types; the label of accepted ones is the last
    longest of the preferred types, else the first seen; tty is the first's.
    """
    preferred = F.col("tty").isin("SCD", "SBD", "IN", "PIN", "BN")
    accepted = F.col("tty").isin(*lex.RXNORM_TTYS)
    atoms = concepts.withColumn("str", F.trim(F.regexp_replace("str", r"\s{2,}", " "))).where("str <> ''")
    fold = F.array_sort(F.collect_list(F.when(accepted, F.struct("row_no", "str", preferred.alias("p"), "tty"))))
    out = atoms.groupBy(F.col("rxcui").alias("code")).agg(F.collect_set("str").alias("all"), fold.alias("rows")).where(F.size("rows") > 0)
    longer = lambda best, r: F.when((best == "") | (r["p"] & (F.length(r["str"]) >= F.length(best))), r["str"]).otherwise(best)
    out = out.withColumns({"label": F.aggregate("rows", F.lit(""), longer), "tty": F.element_at("rows", 1)["tty"]})
    return out.select("code", "label", F.array_sort(F.array_except("all", F.array("label"))).alias("aliases"), "tty")


def ingredient_codes(concepts: DataFrame, relations: DataFrame, *, reverse: bool = False) -> DataFrame:
    """code, ingredient_codes of relations (rxcui1, rela, rxcui2) between known concepts (JOIN-12).

    has_ingredient and its kin point from first to second, ingredient_of and its
    kin back; ``reverse`` reads them the other way round.
    """
    a, b = ("rxcui2", "rxcui1") if reverse else ("rxcui1", "rxcui2")
    there = relations.where(F.col("rela").rlike("^has_.*ingredient$")).select(F.col(a).alias("code"), F.col(b).alias("ingredient"))
    back = relations.where(F.col("rela").rlike("ingredient_of$")).select(F.col(b).alias("code"), F.col(a).alias("ingredient"))
    known = concepts.select("code").distinct()
    pairs = there.unionByName(back).join(known, "code", "left_semi").join(known.withColumnRenamed("code", "ingredient"), "ingredient", "left_semi")
    return pairs.groupBy("code").agg(F.array_sort(F.collect_set("ingredient")).alias("ingredient_codes"))


def alias_seed(gold: DataFrame, kb: DataFrame, allowed: DataFrame) -> DataFrame:
    """code, aliases: short texts of gold entities (text, candidates) by code, for codes that are known and allowed (AGG-8, JOIN-14)."""
    texts = gold.select(F.explode("candidates").alias("code"), T.clean_alias(F.col("text")).alias("alias")).where("alias is not null")
    old = kb.select("code", F.explode("aliases").alias("alias"))
    ok = kb.select("code").distinct().join(allowed.select("code").distinct(), "code", "left_semi")
    return texts.unionByName(old).join(ok, "code", "left_semi").groupBy("code").agg(F.array_sort(F.collect_set("alias")).alias("aliases"))


def numbered(df: DataFrame, *order: str) -> DataFrame:
    return df.withColumn("row_no", F.row_number().over(W.orderBy(*order)))
