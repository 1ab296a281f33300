"""Linking mentions to codes of a knowledge base (JOIN-5..7, SIM-8, TOP-1..7, WIN-6, DEC-2..6).

A knowledge base is a table (system, code, label, aliases, tty).  Queries are
linked once per distinct (query, type, clause kind) and joined back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, StructField, StructType

from ..functions import dense
from ..functions import similarity as sim
from ..functions import text as T
from ..lexicon import clinical as lex

#: Candidates of a query after blocking, and the share of a query's pool that is scored on.
BLOCK_MOST = 400
#: Shares of the records that a query without common tokens meets, each in a join of its own key.
SHARES = 64
#: Components of the vectors that a task of a dense search holds, and records that are worth a share.
SHARE_COMPONENTS, SHARE_ROWS = 1 << 21, 4096


def aliases(kb: DataFrame) -> DataFrame:
    """system, code, alias_no (0: the label), alias, alias_norm, alias_key, bare_key (AGG-10)."""
    every = F.concat(F.array("label"), F.coalesce("aliases", F.array().cast("array<string>")))
    rows = kb.select("system", "code", F.posexplode(every).alias("alias_no", "alias"))
    return rows.withColumns({"alias_norm": T.match_text(F.col("alias")), "alias_key": T.match_key(F.col("alias")), "bare_key": T.match_key(T.strip_last_strength(F.col("alias")))})


def searchable(kb: DataFrame) -> DataFrame:
    """kb with the lower-cased text of label and aliases."""
    return kb.withColumn("searchable", F.lower(F.concat_ws(" ", "label", "aliases")))


def token_index(kb: DataFrame) -> DataFrame:
    """system, token, code: tokens of two characters or more (AGG-9)."""
    rows = searchable(kb).select("system", "code", F.explode(T.token_set(F.col("searchable"))).alias("token"))
    return rows.where(F.length("token") >= 2).distinct()


def blocked(queries: DataFrame, kb: DataFrame, *, most: int = BLOCK_MOST) -> DataFrame:
    """query, system, code: records that share a token with the query, the ``most`` with most of them (JOIN-5, TOP-7).

    Records with equally many at the cap go by their text's ratio to the query, then
    by code. A query without any such record meets all records of its system.
    """
    by = ["query", "system"]
    queries = queries.select(*by).distinct()
    tokens = queries.select("query", "system", F.explode(T.token_set(F.col("query"))).alias("token"))
    hits = tokens.join(token_index(kb), ["system", "token"]).groupBy("query", "system", "code").agg(F.count(F.lit(1)).alias("shared"))
    before = F.rank().over(W.partitionBy(*by).orderBy(F.col("shared").desc())) - 1
    level = F.count(F.lit(1)).over(W.partitionBy(*by, "shared"))
    near = hits.withColumns({"before": before, "level": level}).where(F.col("before") < most)
    near = near.join(searchable(kb).select("system", "code", "searchable"), ["system", "code"])
    # only those at the cap are compared
    text = F.when(F.col("before") + F.col("level") > most, F.col("searchable"))
    w = W.partitionBy(*by).orderBy(F.col("shared").desc(), F.col("ratio").desc(), "code")
    capped = near.withColumn("ratio", sim.sequence_ratio(F.lower("query"), text)).withColumn("place", F.row_number().over(w)).where(F.col("place") <= most)
    rest = queries.join(hits.select(*by).distinct(), by, "left_anti").withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
    every = kb.select("system", "code", F.pmod(F.xxhash64("code"), F.lit(SHARES)).cast("int").alias("share")).distinct()
    return capped.select(*by, "code").unionByName(rest.join(every, ["system", "share"]).select(*by, "code"))


def exact_codes(queries: DataFrame, kb: DataFrame) -> DataFrame:
    """query, system, code, rank of records with an alias equal to the query; for drugs also without the dose (JOIN-7)."""
    a = aliases(kb)
    keyed = queries.select("query", "system", T.match_key(F.col("query")).alias("key"), T.match_key(T.strip_last_strength(F.col("query"))).alias("bare"))
    whole = keyed.join(a, (a["system"] == keyed["system"]) & (F.col("key") == F.col("alias_key")) & (F.col("key") != ""))
    bare = keyed.where("system = 'rxnorm' and bare <> '' and bare <> key").join(a, (a["system"] == keyed["system"]) & (F.col("bare") == F.col("bare_key")))
    both = whole.select(keyed["query"], keyed["system"], "code", F.lit(0).alias("way")).unionByName(bare.select(keyed["query"], keyed["system"], "code", F.lit(1).alias("way")))
    first = both.groupBy("query", "system", "code").agg(F.min("way").alias("way"))
    return first.withColumn("rank", F.row_number().over(W.partitionBy("query", "system").orderBy("way", "code"))).drop("way")


def ngram_cosine(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """``pairs`` with the count cosine of the n-grams of two text columns (SIM-13), from vectors of distinct texts."""
    def vectors(column: str) -> DataFrame:
        rows = pairs.select(F.col(column).alias("t")).distinct().select("t", F.explode(sim.ngram_features(F.col("t"))).alias("f"))
        return rows.groupBy("t", "f").count()

    lv, rv = vectors(left), vectors(right)
    norm = lambda v, name: v.groupBy("t").agg(F.sqrt(F.sum(F.col("count") * F.col("count"))).alias(name))
    keys = pairs.select(F.col(left).alias("l"), F.col(right).alias("r")).distinct()
    shared = keys.join(lv.toDF("l", "f", "x"), "l").join(rv.toDF("r", "f", "y"), ["r", "f"]).groupBy("l", "r").agg(F.sum(F.col("x") * F.col("y")).alias("xy"))
    scored = shared.join(norm(lv, "nl").withColumnRenamed("t", "l"), "l").join(norm(rv, "nr").withColumnRenamed("t", "r"), "r")
    scored = scored.select(F.col("l").alias("__l"), F.col("r").alias("__r"), (F.col("xy") / (F.col("nl") * F.col("nr"))).alias("cosine"))
    out = pairs.join(scored, (F.col(left) == F.col("__l")) & (F.col(right) == F.col("__r")), "left").drop("__l", "__r")
    return out.withColumn("cosine", F.coalesce("cosine", F.lit(0.0)))


def lexical_top(queries: DataFrame, kb: DataFrame, *, k: int, least: float = 0.0) -> DataFrame:
    """query, system, code, lexical: the k records with the best lexical score (SIM-1, TOP-1)."""
    pairs = blocked(queries, kb).join(searchable(kb).select("system", "code", "label", "searchable"), ["system", "code"])
    scored = pairs.withColumn("lexical", sim.lexical_score(F.col("query"), F.col("label"), F.col("searchable"))).where(F.col("lexical") >= least)
    w = W.partitionBy("query", "system").orderBy(F.col("lexical").desc(), "code")
    return scored.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k).select("query", "system", "code", "lexical")


def best_alias(pairs: DataFrame, kb: DataFrame) -> DataFrame:
    """``pairs`` (query, system, code) with the record's alias most like the query, the first of equals (AGG-11)."""
    joined = pairs.select("query", "system", "code").distinct().join(aliases(kb), ["system", "code"])
    scored = joined.withColumn("s", sim.alias_similarity(T.match_text(F.col("query")), F.col("alias_norm")))
    best = scored.groupBy("query", "system", "code").agg(F.max(F.struct("s", (-F.col("alias_no")).alias("n"), "alias")).alias("x"))
    return pairs.join(best.select("query", "system", "code", F.col("x.alias").alias("alias")), ["query", "system", "code"])


def select_codes(scored: DataFrame, by: list[str], *, least: float, band: Column, k: int) -> DataFrame:
    """Rows within ``band`` of their group's best and of at least ``least``, at most k, with rank and margin to the second (WIN-6)."""
    w = W.partitionBy(*by).orderBy(F.col("score").desc(), "code")
    ranked = scored.where(F.col("score") >= least).withColumns({"rank": F.row_number().over(w), "best": F.max("score").over(W.partitionBy(*by)), "second": F.lead("score").over(w)})
    ranked = ranked.withColumn("margin", F.max(F.when(F.col("rank") == 1, F.col("best") - F.col("second"))).over(W.partitionBy(*by)))
    return ranked.where((F.col("score") >= F.greatest(F.lit(least), F.col("best") - band)) & (F.col("rank") <= k)).drop("second", "best")


def best_per_code(scored: DataFrame, by: list[str], form: str) -> DataFrame:
    """One row of each group and code: that of the best score, of equals that of the first form (AGG-12)."""
    rest = [c for c in scored.columns if c not in (*by, "code")]
    best = scored.groupBy(*by, "code").agg(F.max_by(F.struct(*rest), F.struct("score", (-F.col(form)).alias("n"))).alias("x"))
    return best.select(*by, "code", "x.*")


def embedding_top(queries: DataFrame, records: DataFrame, *, k: int, above: float | None = None, shares: int | None = None, bare: bool = False) -> DataFrame:
    """query, code, cosine, rank: the k records whose vectors are most like the query's (TOP-4, SIM-14).

    ``queries`` has query and vector, ``records`` code and vector.  Records are
    dealt into shares (as many as bound what a task holds); every query meets every share,
    is scored there by blocks of products, and each task hands on the k best of its own.
    Ties go by code; ``above`` drops those of at most so much.  ``bare``: the plain
    quotient, which is null or not a number where a vector is null or zero, instead of 0.
    """
    if shares is None:
        n, components = records.select(F.count(F.lit(1)), F.sum(F.greatest(F.size("vector"), F.lit(1)).cast("long"))).first()
        shares = max(1, -(-(components or 0) // SHARE_COMPONENTS), min(SHARES, -(-n // SHARE_ROWS)))
    floats = all(df.schema["vector"].dataType == ArrayType(FloatType()) for df in (queries, records))
    vector = F.col("vector").cast("array<float>" if floats else "array<double>").alias("vector")
    of = {"query": queries.schema["query"].dataType, "code": records.schema["code"].dataType}
    asked = queries.select(F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("__share"), F.lit(True).alias("__asked"), "query", F.lit(None).cast(of["code"]).alias("code"), vector)
    # equal rows share a hash; those that only share a code do not crowd one task
    share = F.pmod(F.xxhash64("code", "vector"), F.lit(shares)).cast("int")
    dealt = records.select(share.alias("__share"), F.lit(False).alias("__asked"), F.lit(None).cast(of["query"]).alias("query"), "code", vector)
    met = dealt.union(asked).repartition(shares, "__share").sortWithinPartitions("__share", "__asked", F.asc_nulls_last("code"))
    found = StructType([StructField("query", of["query"]), StructField("code", of["code"]), StructField("cosine", DoubleType())])
    near = met.mapInArrow(dense.search(k, bare), found)
    if above is not None:
        near = near.where(F.col("cosine") > above)
    order = [F.desc("cosine"), F.asc_nulls_last("code")]
    return near.withColumn("rank", F.row_number().over(W.partitionBy("query").orderBy(*order))).where(F.col("rank") <= k)


def link(mentions: DataFrame, kb: DataFrame, *, k: int = 3, least: float = 0.55, abbreviations: dict[str, str] | None = None, similarity: Callable[..., Column] = sim.ngram_cosine, cut: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """``mentions`` (type, text, clause_kind and any others) with codes, confidence and mode (DEC-2..4).

    Exact aliases settle a query with confidence 1; the rest are scored with
    .45 lexical + .45 n-gram cosine (+ .1 structure, for drugs) + context; a drug
    is scored with and without its dose, and each code keeps the better score.
    Mentions of other types, too long ones and those in lab sections get none.
    ``similarity`` of two text columns may be an encoder's (SIM-14); ``cut`` may
    write a step's rows, so that later steps do not plan it again.
    """
    system = F.when(F.col("type") == lex.DIAGNOSIS, "icd10").when(F.col("type") == lex.DRUG, "rxnorm")
    text = F.col("text")
    if abbreviations:
        table = F.create_map(*[F.lit(x) for kv in abbreviations.items() for x in kv])
        text = F.coalesce(F.try_element_at(table, F.lower(F.trim(text))), text)
    query = F.when(F.col("type") == lex.DIAGNOSIS, T.diagnosis_query(text)).when(F.col("type") == lex.DRUG, T.drug_query(text))
    asked = cut(mentions.withColumns({"system": system, "query": query, "__kind": F.coalesce("clause_kind", F.lit("general"))}))
    fits = F.col("system").isNotNull() & (F.col("query") != "") & ~T.too_long_to_link(F.col("query"), F.col("type")) & (F.col("__kind") != "lab_results")
    queries = asked.where(fits).select("query", "system", F.col("type").alias("kind"), F.col("__kind").alias("clause")).distinct()
    queries = cut(queries)
    exact = exact_codes(queries.select("query", "system").distinct(), kb).where(F.col("rank") <= k)
    settled = exact.groupBy("query", "system").agg(F.array_sort(F.collect_list(F.struct("rank", "code"))).alias("x")).selectExpr("query", "system", "x.code codes", "1.0D confidence", "'exact' mode")
    settled = cut(settled)
    rest = cut(queries.join(settled, ["query", "system"], "left_anti"))
    bare = T.strip_last_strength(F.col("query"))
    forms = F.when(F.col("kind") == lex.DRUG, F.array_distinct(F.filter(F.array("query", bare), lambda q: q != ""))).otherwise(F.array("query"))
    forms = cut(rest.select("query", "system", "kind", "clause", F.posexplode(forms).alias("form_no", "form")))
    pool = lexical_top(forms.select(F.col("form").alias("query"), "system").distinct(), kb, k=max(10 * k, 50))
    pool = best_alias(pool, kb).join(kb.select("system", "code", "label"), ["system", "code"])
    pool = cut(pool.withColumnRenamed("query", "form"))
    pool = pool.withColumn("cosine", similarity("form", "alias")).join(forms, ["form", "system"])
    structure = F.when(F.col("kind") == lex.DRUG, 0.1 * sim.structured_match(F.col("form"), F.col("alias"))["score"]).otherwise(0.0)
    raw = 0.45 * F.col("lexical") + 0.45 * F.col("cosine") + structure + sim.context_bonus(F.col("form"), F.col("alias"), F.col("kind"), F.col("clause"))
    scored = pool.withColumn("score", F.least(F.lit(1.0), F.greatest(F.lit(0.0), raw)))
    scored = cut(best_per_code(scored, ["query", "system", "kind", "clause"], "form_no"))
    chosen = select_codes(scored, ["query", "system", "clause"], least=least, band=F.when(F.col("kind") == lex.DRUG, 0.05).otherwise(0.03), k=k)
    chosen = chosen.groupBy("query", "system", "clause").agg(F.array_sort(F.collect_list(F.struct("rank", "code"))).alias("x"), F.max("score").alias("confidence"))
    chosen = chosen.selectExpr("query", "system", "clause", "x.code codes", "confidence", "'scored' mode")
    decided = rest.select("query", "system", "clause").join(chosen, ["query", "system", "clause"]).unionByName(
        queries.select("query", "system", "clause").distinct().join(settled, ["query", "system"])
    )
    out = asked.join(decided.withColumnsRenamed({"query": "__q", "system": "__s", "clause": "__c"}), (F.col("query") == F.col("__q")) & (F.col("system") == F.col("__s")) & (F.col("__kind") == F.col("__c")), "left")
    out = out.withColumns({"candidates": F.coalesce("codes", F.array().cast("array<string>")), "mode": F.coalesce("mode", F.lit("none"))})
    return out.drop("__q", "__s", "__c", "__kind", "codes", "system", "query")


def shortlist(queries: DataFrame, kb: DataFrame, *, k: int = 10, least: float = 0.2, near: DataFrame | None = None, similarity: Callable[..., Column] = sim.ngram_cosine) -> DataFrame:
    """query, system, rank, code, label, score, source, matched_alias (SIM-10, SIM-11, A4).

    The pool is exact hits, the lexical best and, if given, ``near`` (query, system,
    code), as ``embedding_top`` finds them; ``similarity`` may be an encoder's.  An exact hit adds .35, a
    strength that differs takes .12 away, and bare drug names prefer ingredients. The
    lexical part of every record is the greater of the query's and of that without its dose.
    """
    exact = exact_codes(queries, kb).select("query", "system", "code").withColumn("exact", F.lit(True))
    pool = lexical_top(queries, kb, k=max(6 * k, 30), least=least).drop("lexical")
    if near is not None:
        pool = pool.unionByName(near.select("query", "system", "code")).distinct()
    pool = pool.join(exact, ["query", "system", "code"], "full_outer").withColumn("exact", F.coalesce("exact", F.lit(False)))
    each = pool.join(aliases(kb), ["system", "code"])
    key = T.match_key(F.col("query"))
    s = sim.structured_match(F.col("query"), F.col("alias"))
    each = each.withColumns({"cosine": similarity("query", "alias"), "semantic": sim.shortlist_similarity(key, F.col("alias_key")), "s": s})
    drug = F.col("system") == "rxnorm"
    folded = each.groupBy("query", "system", "code", "exact").agg(
        F.max(F.struct("semantic", (-F.col("alias_no")).alias("n"), "alias")).alias("best"), F.max("cosine").alias("emb"), F.max("s.score").alias("structure"), F.max(F.col("s.mismatch")).alias("mismatch")
    )
    folded = folded.join(searchable(kb).select("system", "code", "label", "aliases", "tty", "searchable"), ["system", "code"])
    lexical = lambda q: sim.lexical_score(q, F.col("label"), F.col("searchable"))
    folded = folded.withColumn("lex", F.greatest(lexical(F.col("query")), lexical(T.strip_last_strength(F.col("query")))))
    score = 0.4 * F.col("lex") + 0.2 * F.col("best.semantic") + 0.2 * F.col("emb") + F.when(F.col("exact"), 0.35).otherwise(0.0)
    prior = sim.bare_drug_preference(F.col("query"), F.col("label"), F.coalesce("aliases", F.array().cast("array<string>")), F.col("tty"))
    score = score + F.when(drug, 0.2 * F.col("structure") - F.when(F.col("mismatch"), 0.12).otherwise(0.0) + prior).otherwise(0.0)
    source = F.when(F.col("exact"), "exact").when(F.col("emb") >= F.col("lex"), "embedding").otherwise("indexed")
    scored = folded.select("query", "system", "code", "label", score.alias("score"), source.alias("source"), F.col("best.alias").alias("matched_alias"))
    w = W.partitionBy("query", "system").orderBy(F.col("score").desc(), "code")
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


SHORTLIST = "array<struct<code: string, label: string, is_gold: boolean, score: double, source: string, matched_alias: string>>"


def with_gold(ranked: Column, gold: Column, k: int) -> Column:
    """A ranked array of structs with gold codes marked and missing ones appended, cut to k (DEC-6)."""
    marked = F.transform(
        ranked, lambda r: F.struct(r["code"].alias("code"), r["label"].alias("label"), F.array_contains(gold, r["code"]).alias("is_gold"), r["score"].alias("score"), r["source"].alias("source"), r["matched_alias"].alias("matched_alias"))
    )
    missing = F.array_except(gold, F.transform(ranked, lambda r: r["code"]))
    more = F.transform(missing, lambda c: F.struct(c.alias("code"), F.lit("").alias("label"), F.lit(True).alias("is_gold"), F.lit(0.0).alias("score"), F.lit("gold").alias("source"), F.lit("").alias("matched_alias")))
    return F.slice(F.concat(marked, more), 1, k)


def judge(rows: DataFrame) -> DataFrame:
    """``rows`` (type, text, candidates, predicted, shortlist) with the codes that are kept (WIN-8, DEC-9, DEC-10).

    predicted are a generator's codes, candidates those mapped before; the
    shortlist is an array of structs with code, score and source, best first.
    """
    listed = F.transform("shortlist", lambda r: r["code"])
    mapped = F.transform("candidates", lambda v: F.trim(F.substring_index(v, ":", 1)))
    asked = F.filter(F.array_distinct(F.concat("predicted", mapped)), lambda c: F.array_contains(listed, c))
    bonus = F.create_map(*[F.lit(x) for kv in lex.SOURCE_BONUS.items() for x in kv])
    best = F.element_at(F.filter("shortlist", lambda r: F.lit(True)), 1)

    def scored(c, i):
        r = F.element_at(F.filter("shortlist", lambda x: x["code"] == c), 1)
        return F.struct((-(r["score"] + F.coalesce(F.try_element_at(bonus, r["source"]), F.lit(0.0)) - 0.03 * i)).alias("minus"), c.alias("code"))

    ranked = F.array_sort(F.transform("__asked", scored))
    first, second = F.try_element_at("__ranked", F.lit(1)), F.try_element_at("__ranked", F.lit(2))
    two = F.col("text").rlike("(?i)" + lex.MULTI_CODE_REGEX) & (-first["minus"] >= 0.95) & (second["minus"] - first["minus"] <= 0.12)
    none = F.array().cast("array<string>")
    top = F.when(F.size("shortlist") > 0, best)
    sure = F.when(F.col("type") == lex.DRUG, (top["source"] == "exact") & (top["score"] >= 0.85)).otherwise((top["score"] >= 0.95) | ((top["source"] == "exact") & (top["score"] >= 0.8)))
    kept = F.when(~F.col("type").isin(*lex.CODED_TYPES), none).when(first.isNull(), F.when(sure, F.array(top["code"])).otherwise(none))
    kept = kept.when((F.col("type") != lex.DRUG) & F.coalesce(two, F.lit(False)), F.array(first["code"], second["code"])).otherwise(F.array(first["code"]))
    return rows.withColumn("__asked", asked).withColumn("__ranked", ranked).withColumn("codes", kept).drop("__asked", "__ranked")
