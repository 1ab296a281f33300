"""Neighbours of codes, retrieval over them, patient graphs, relations and facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import similarity as sim
from ..functions import text as T
from ..lexicon import clinical as lex
from .linking import aliases
from .spans import enclosing, next_within

NEIGHBORS = 16


def siblings(members: DataFrame, most: int = NEIGHBORS) -> DataFrame:
    """code, neighbor, rank: the first ``most`` other codes of the same ``family`` (AGG-13, AGG-14).

    Only the first ``most`` + 1 codes of a family can be neighbours, so that the
    join is with those, not of all pairs.
    """
    rows = members.select("family", "code").distinct()
    first = rows.withColumn("n", F.row_number().over(W.partitionBy("family").orderBy("code"))).where(F.col("n") <= most + 1)
    pairs = rows.join(first.select("family", F.col("code").alias("neighbor")), "family").where("code <> neighbor")
    ranked = pairs.withColumn("rank", F.row_number().over(W.partitionBy("family", "code").orderBy("neighbor")))
    return ranked.where(F.col("rank") <= most)


def code_families(kb: DataFrame) -> DataFrame:
    """system, family, code: diagnoses by the code before its point, drugs by an alias without doses."""
    dx = kb.where("system = 'icd10'").select("system", F.substring_index("code", ".", 1).alias("family"), "code")
    drugs = aliases(kb.where("system = 'rxnorm'")).select("system", T.match_text(T.strip_strengths(F.col("alias"))).alias("family"), "code")
    return dx.unionByName(drugs.where("family <> ''")).distinct()


def retrieve(queries: DataFrame, kb: DataFrame, *, k: int = 6, least: float = 0.72) -> DataFrame:
    """query, system, code, support: exact aliases (1), their neighbours (.35 diagnoses, .45 drugs), else fuzzy ones (JOIN-8, TOP-5).

    ``queries`` has query, system and in_section (whether its section suits: + .05).
    """
    a = aliases(kb)
    keyed = queries.withColumn("key", T.match_text(F.col("query")))
    hit = keyed.join(a.select("system", "code", F.col("alias_norm").alias("key")).distinct(), ["system", "key"]).select("query", "system", "in_section", "code")
    edges = siblings(code_families(kb).select(F.concat_ws("|", "system", "family").alias("family"), "code")).select("code", "neighbor")
    weight = F.when(F.col("system") == "rxnorm", 0.45).otherwise(0.35)
    near = hit.join(edges, "code").select("query", "system", "in_section", F.col("neighbor").alias("code"), weight.alias("support"))
    rest = keyed.join(hit.select("query", "system").distinct(), ["query", "system"], "left_anti").withColumn("token", F.explode(T.token_set(F.col("key"))))
    tokens = a.select("system", "code", "alias_norm", F.explode(T.token_set(F.col("alias_norm"))).alias("token")).where(F.length("token") >= 2)
    pairs = rest.join(tokens, ["system", "token"]).select("query", "system", "in_section", "key", "code", "alias_norm").distinct()
    bare = F.when(F.col("system") == "rxnorm", sim.sequence_ratio(T.match_text(T.strip_strengths(F.col("query"))), T.match_text(T.strip_strengths(F.col("alias_norm"))))).otherwise(0.0)
    fuzzy = pairs.withColumn("support", F.greatest(sim.sequence_ratio("key", "alias_norm"), bare)).where(F.col("support") >= least)
    found = hit.withColumn("support", F.lit(1.0)).unionByName(near).unionByName(fuzzy.select("query", "system", "in_section", "code", "support"))
    found = found.groupBy("query", "system", "code").agg(F.max(F.col("support") + F.when(F.col("in_section"), 0.05).otherwise(0.0)).alias("support"))
    w = W.partitionBy("query", "system").orderBy(F.col("support").desc(), "code")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def rerank(entities: DataFrame, retrieved: DataFrame, key: str, *, k: int = 3, least: float = 0.45) -> DataFrame:
    """Codes of ``entities`` (key, candidates) after the graph's support (WIN-7): key, codes.

    Nothing retrieved: as they are.  No codes yet: the best retrieved.  Else the
    support plus .3 less .1 a place; all go if the best is below ``least``.
    """
    support = retrieved.select(F.col(key).alias("__k"), "code", "support")
    given = entities.select(F.col(key).alias("__k"), F.posexplode("candidates").alias("place", "code")).select("__k", "code", F.greatest(F.lit(0.0), 0.3 - 0.1 * F.col("place")).alias("own"))
    both = given.join(support, ["__k", "code"], "full_outer").join(support.select("__k").distinct(), "__k")
    bare = entities.select(F.col(key).alias("__k"), (F.size("candidates") == 0).alias("bare"))
    scored = both.join(bare, "__k").withColumn("score", F.coalesce("support", F.lit(0.0)) + F.coalesce("own", F.lit(0.0)))
    w = W.partitionBy("__k").orderBy(F.col("score").desc(), "code")
    scored = scored.withColumns({"rank": F.row_number().over(w), "best": F.max("score").over(W.partitionBy("__k"))}).where(F.col("rank") <= k)
    kept = scored.groupBy("__k").agg(F.array_sort(F.collect_list(F.when(F.col("bare") | (F.col("best") >= least), F.struct("rank", "code")))).alias("x"))
    joined = entities.select(key, "candidates").join(kept, F.col(key) == F.col("__k"), "left")
    return joined.select(key, F.when(F.col("x").isNull(), F.col("candidates")).otherwise(F.col("x.code")).alias("codes"))


def lab_relations(entities: DataFrame, gap: int = 12) -> DataFrame:
    """doc_id, source_text, source_type, relation_type, target_text, target_type: each lab name's next value (JOIN-16).

    The value counts if nothing before it starts more than ``gap`` characters
    behind the name's end; starts only grow, so its own start tells.
    """
    value = F.struct("start", "text", "type")
    pairs = next_within(
        entities, "doc_id", [F.col("start"), F.col("end"), F.col("type")], F.col("type") == lex.LAB_NAME, F.col("type") == lex.LAB_VALUE,
        F.coalesce(F.col("next.start") - F.col("end") <= gap, F.lit(False)), value,
    )
    return pairs.select("doc_id", F.col("text").alias("source_text"), F.col("type").alias("source_type"), F.lit("has_result").alias("relation_type"), F.col("next.text").alias("target_text"), F.col("next.type").alias("target_type"))


RELATIONS = {lex.SYMPTOM: "has_symptom", lex.DIAGNOSIS: "has_diagnosis", lex.DRUG: "uses_drug"}


def unary_relations(entities: DataFrame, relations: dict[str, str] = RELATIONS, subject: str = "patient") -> DataFrame:
    """The same columns: what the subject has (GEN-20)."""
    name = F.create_map(*[F.lit(x) for kv in relations.items() for x in kv])[F.col("type")]
    rows = entities.where(F.col("type").isin(*relations))
    return rows.select("doc_id", F.lit(subject).alias("source_text"), F.lit(subject).alias("source_type"), name.alias("relation_type"), F.col("text").alias("target_text"), F.col("type").alias("target_type"))


def facts(entities: DataFrame, relations: DataFrame) -> DataFrame:
    """doc_id, subject, predicate, object of mentions, assertions, codes and relations (AGG-20)."""
    def triple(df: DataFrame, p: Column | str, o: Column | str) -> DataFrame:
        return df.select("doc_id", F.col("text").alias("subject"), (F.lit(p) if isinstance(p, str) else p).alias("predicate"), (F.col(o) if isinstance(o, str) else o).alias("object"))

    out = triple(entities, "has_type", "type")
    out = out.unionByName(triple(entities.select("doc_id", "text", F.explode("assertions").alias("a")), "has_assertion", "a"))
    out = out.unionByName(triple(entities.select("doc_id", "text", F.explode("candidates").alias("c")), "has_code", "c"))
    return out.unionByName(relations.select("doc_id", F.col("source_text").alias("subject"), F.col("relation_type").alias("predicate"), F.col("target_text").alias("object")))


def patient_graph(docs: DataFrame, sections: DataFrame, clauses: DataFrame, anchors: DataFrame, entities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Node and edge tables of documents, sections, clauses, anchors and entities (GEN-19, JOIN-4)."""
    def nodes(df: DataFrame, kind: str, no: Column, text: Column | str) -> DataFrame:
        text = F.col(text) if isinstance(text, str) else text
        return df.select("doc_id", F.concat(F.lit(f"{kind}:"), no.cast("string")).alias("node_id"), F.lit(kind).alias("node_type"), text.alias("text"), "start", "end")

    ent = entities.withColumn("entity_no", F.row_number().over(W.partitionBy("doc_id").orderBy("start", "end", "type")) - 1)
    whole = docs.withColumns({"start": F.lit(0), "end": F.length("text")})
    node = nodes(whole, "document", F.lit(0), F.lit("")).unionByName(nodes(sections, "section", F.col("section_no"), "header"))
    node = node.unionByName(nodes(clauses, "clause", F.col("clause_no"), "text")).unionByName(nodes(anchors, "anchor", F.col("anchor_no"), "text")).unionByName(nodes(ent, "entity", F.col("entity_no"), "text"))

    def edges(df: DataFrame, a: str, a_no: Column, rel: str, b: str, b_no: Column) -> DataFrame:
        name = lambda k, n: F.concat(F.lit(f"{k}:"), n.cast("string"))
        return df.select("doc_id", name(a, a_no).alias("source_id"), F.lit(rel).alias("relation"), name(b, b_no).alias("target_id"))

    edge = edges(sections, "document", F.lit(0), "has_section", "section", F.col("section_no"))
    edge = edge.unionByName(edges(clauses, "section", F.col("section_no"), "has_clause", "clause", F.col("clause_no")))
    for rows, kind, no, rel in ((anchors, "anchor", "anchor_no", "has_anchor"), (ent, "entity", "entity_no", "mentions_entity")):
        inside = enclosing(rows, clauses, no, "clause_no", overlap=False).where("clause_no is not null")
        edge = edge.unionByName(edges(inside, "clause", F.col("clause_no"), rel, kind, F.col(no)))
    return node, edge
