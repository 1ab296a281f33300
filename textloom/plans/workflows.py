"""Composite runs over folders of documents: inference, evaluation, review, datasets, knowledge bases."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..lexicon import clinical as lex
from ..operators import agents, assertions, datasets, evaluation, graph, kb, linking, mentions, spans, structure, validation
from ..session import Scratch
from ..sources import archives, files, sinks

NONE = "cast(array() as array<string>)"


def kb_terms(base: DataFrame, most: int = 2_000_000) -> list[tuple[str, str]]:
    """(type, term) of a knowledge base's labels and aliases; fails rather than collect more than ``most``."""
    kind = F.when(F.col("system") == "icd10", lex.DIAGNOSIS).otherwise(lex.DRUG)
    rows = linking.aliases(base).select(kind.alias("k"), F.lower("alias").alias("t")).distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError("too many terms for one automaton; use gazetteer.mentions_of_table")
    return [(r["k"], r["t"]) for r in rows]


def infer(docs: DataFrame, base: DataFrame, config: files.Config | None = None, model: DataFrame | None = None) -> DataFrame:
    """doc_id, start, end, type, text, assertions, candidates of documents (DEC-12): recognise, link, re-rank, assert, rule."""
    config, scratch = config or files.Config(), Scratch(docs.sparkSession, "infer")
    cut, base = scratch.cut, scratch.cut(base)
    clauses = cut(structure.clauses(docs, cut(structure.sections(docs))))
    own = cut(mentions.recognize(docs, kb_terms(base), lex.ABBREVIATIONS, model).withColumn("id", F.concat_ws(":", "doc_id", "start", "end", "type")))
    kinds = clauses.select("doc_id", "clause_no", F.coalesce("anchor_kind", "section_kind").alias("clause_kind"))
    placed = cut(spans.enclosing(own, clauses, "id", "clause_no").join(kinds, ["doc_id", "clause_no"], "left"))
    linked = cut(linking.link(placed, base, k=config.matching.max_candidates, least=config.matching.min_confidence, abbreviations=lex.ABBREVIATIONS, cut=cut))
    system = F.when(F.col("type") == lex.DIAGNOSIS, "icd10").when(F.col("type") == lex.DRUG, "rxnorm")
    suits = F.coalesce(F.col("clause_kind").isin("diagnosis_history", "diagnosis_current", "drug_history"), F.lit(False))
    asked = linked.withColumns({"system": system, "suits": suits}).where("system is not null")
    queries = cut(asked.groupBy(F.col("text").alias("query"), "system").agg(F.bool_or("suits").alias("in_section")))
    support = cut(graph.retrieve(queries, base).withColumnRenamed("system", "s"))
    keyed = cut(asked.join(support, (F.col("text") == F.col("query")) & (F.col("system") == F.col("s"))).select("id", "code", "support"))
    ranked = graph.rerank(linked.select("id", "candidates"), keyed, "id").withColumnRenamed("codes", "candidates")
    out = cut(linked.drop("candidates").join(ranked, "id").drop("id", "mode", "confidence", "clause_no", "clause_kind"))
    return validation.ruled(assertions.infer(out, clauses, docs, window=config.rules.assertion_window)).select("doc_id", "start", "end", "type", "text", "assertions", "candidates")


def run_infer(spark: SparkSession, input_dir: str, output_dir: str, config: str) -> int:
    c = files.load_config(config)
    docs = files.texts(spark, input_dir).select("doc_id", "text")
    base = files.knowledge_base(spark, c.knowledge_base.icd10_path, c.knowledge_base.rxnorm_path)
    sinks.reset_folder(output_dir)
    return sinks.write_entity_files(docs, infer(docs, base, c), output_dir, pretty=c.output.pretty)


def validate_folder(spark: SparkSession, input_dir: str, output_dir: str) -> DataFrame:
    """Problems of an output folder: missing files and broken entities."""
    docs = files.texts(spark, input_dir).select("doc_id", "text")
    outputs = spark.createDataFrame([(p.stem,) for p in Path(output_dir).glob("*.json")], "doc_id string")
    broken = validation.entity_problems(files.entity_files(spark, output_dir), docs).select("doc_id", F.col("problem").alias("side"))
    return validation.missing_outputs(docs, outputs).unionByName(broken)


def run_submit(spark: SparkSession, input_dir: str, output_dir: str, config: str, target: str) -> int:
    """Infer, validate, zip."""
    run_infer(spark, input_dir, output_dir, config)
    if bad := validate_folder(spark, input_dir, output_dir).limit(5).collect():
        raise ValueError(f"invalid output: {bad}")
    return sinks.zip_folder(output_dir, target)


def eval_outputs(spark: SparkSession, gold_dir: str, output_dir: str) -> DataFrame:
    return evaluation.evaluate_entities(files.entity_files(spark, gold_dir), files.entity_files(spark, output_dir))


def analyze_outputs(spark: SparkSession, input_dir: str, output_dir: str, kind: str, width: int = 40) -> DataFrame:
    """Unmatched mentions of a type with their context."""
    docs = files.texts(spark, input_dir).select("doc_id", F.col("text").alias("whole"))
    rows = evaluation.unmatched(files.entity_files(spark, output_dir), [kind]).join(docs, "doc_id")
    return rows.withColumn("context", T.flat_context(F.col("whole"), F.col("start"), F.col("end"), width)).drop("whole")


def audit_outputs(spark: SparkSession, input_dir: str, output_dir: str) -> dict:
    docs, ent = files.texts(spark, input_dir), files.entity_files(spark, output_dir)
    return {"by_type": {r["type"]: r["entities"] for r in evaluation.entity_summary(docs, ent).collect()}, "unmatched": [r.asDict() for r in evaluation.top_texts(evaluation.unmatched(ent), "doc_id").collect()]}


def bootstrap(spark: SparkSession, input_dir: str, output_dir: str, target: str, *, seed_gold: bool = False) -> None:
    docs = files.texts(spark, input_dir).select("doc_id", "text")
    sinks.write_jsonl(sinks.review_rows(docs, files.entity_files(spark, output_dir), seed_gold=seed_gold), target, single=True)


def rank_reviews(spark: SparkSession, input_dir: str, output_dir: str, most: int | None = None) -> DataFrame:
    docs, ent = files.texts(spark, input_dir), files.entity_files(spark, output_dir)
    return evaluation.review_rank(evaluation.review_stats(docs, ent), most)


def prepare_dev_subset(spark: SparkSession, input_dir: str, output_dir: str, target: str, most: int) -> None:
    """Bootstrap, rank, select: the first files to review, with seeded gold."""
    docs = files.texts(spark, input_dir).select("doc_id", "text")
    rows = sinks.review_rows(docs, files.entity_files(spark, output_dir), seed_gold=True)
    sinks.write_jsonl(sinks.selected_reviews(rows, rank_reviews(spark, input_dir, output_dir), most), target, single=True)


def validate_reviews(spark: SparkSession, path: str) -> DataFrame:
    """Broken gold entities of review rows; empty spans are broken here."""
    rows = files.reviews(spark, path)
    ent = rows.select(F.col("file_name").alias("doc_id"), F.explode("gold_entities").alias("e"))
    ent = ent.selectExpr("doc_id", "e.position[0] start", "e.position[1] end", "e.type type", "e.text text", f"coalesce(e.assertions, {NONE}) assertions", f"coalesce(e.candidates, {NONE}) candidates")
    return validation.entity_problems(ent, rows.select(F.col("file_name").alias("doc_id"), "text"), empty_spans=False)


def review_to_train(spark: SparkSession, path: str, target: str) -> None:
    """NER training rows of reviews' gold (or predicted) entities."""
    rows = files.reviews(spark, path).select("text", F.coalesce("gold_entities", "predicted_entities", F.array()).alias("entities"))
    sinks.write_jsonl(rows.select("text", F.transform("entities", lambda e: F.struct(e["position"].alias("position"), e["type"].alias("type"))).alias("entities")), target, single=True)


def build_standard_kb(spark: SparkSession, icd_zip: str, rxnorm_zip: str, seeds: DataFrame | None = None) -> DataFrame:
    """system, code, label, aliases, tty, ingredient_codes of the releases, merged with seeds (system, code, label, aliases)."""
    icd = kb.group_rows(archives.icd10_codes(spark, icd_zip))
    concepts = kb.group_concepts(archives.rxnorm_atoms(spark, rxnorm_zip))
    drugs = concepts.select("code", "label", "aliases")
    if seeds is not None:
        icd, drugs = kb.merge_seed(icd, seeds.where("system = 'icd10'")), kb.merge_seed(drugs, seeds.where("system = 'rxnorm'"))
    drugs = drugs.join(concepts.select("code", "tty"), "code", "left").join(kb.ingredient_codes(concepts, archives.rxnorm_relations(spark, rxnorm_zip)), "code", "left")
    none = F.expr(NONE)
    return icd.select(F.lit("icd10").alias("system"), "code", "label", "aliases", F.lit(None).cast("string").alias("tty"), none.alias("ingredient_codes")).unionByName(
        drugs.select(F.lit("rxnorm").alias("system"), "code", "label", "aliases", "tty", F.coalesce("ingredient_codes", none).alias("ingredient_codes"))
    )


def audit_kb(base: DataFrame, least: int = 1000) -> tuple[dict, bool]:
    """The audit and whether it passes: enough records, no duplicates, none invalid."""
    report = kb.audit(base).first().asDict()
    return report, report["records"] >= least and not report["duplicates"] and not report["invalid"]


def _examples(docs: DataFrame, rows: DataFrame, base: DataFrame, width: int, k: int, known_only: bool) -> DataFrame:
    rows = rows.join(docs.select("doc_id", F.col("text").alias("whole")), "doc_id")
    rows = rows.withColumns({
        "id": T.entity_id(F.col("doc_id").cast("string"), F.col("start"), F.col("end"), F.col("type")),
        "system": F.when(F.col("type") == lex.DIAGNOSIS, "icd10").when(F.col("type") == lex.DRUG, "rxnorm"),
        "context": T.context(F.col("whole"), F.col("start"), F.col("end"), width), "gold_candidates": T.candidate_codes(F.col("candidates")),
    })
    rows = datasets.code_labels(rows, base)
    ranked = linking.shortlist(rows.where("system is not null and trim(text) <> ''").select(F.col("text").alias("query"), "system").distinct(), base, k=k)
    item = F.struct("rank", "code", "label", "score", "source", "matched_alias")
    lists = ranked.groupBy(F.col("query").alias("__q"), F.col("system").alias("__s")).agg(F.array_sort(F.collect_list(item)).alias("ranked"))
    joined = rows.join(lists, (F.col("text") == F.col("__q")) & (F.col("system") == F.col("__s")), "left")
    empty = F.expr("cast(array() as array<struct<rank: int, code: string, label: string, score: double, source: string, matched_alias: string>>)")
    gold = F.array_except("gold_candidates", "unmapped") if known_only else F.col("gold_candidates")
    out = joined.select(
        "id", "doc_id", "type", F.col("text").alias("mention"), "start", "end", "assertions", F.col("assertions").alias("gold_assertions"), "gold_candidates", "labels", "unmapped", "context",
        linking.with_gold(F.coalesce("ranked", empty), gold, k).alias("shortlist"), T.group_key(F.col("type"), F.col("text"), F.col("gold_candidates")).alias("group"),
    )
    return datasets.group_split(out, "group")


def semantic_examples(docs: DataFrame, gold: DataFrame, base: DataFrame, *, width: int = 96, k: int = 10) -> DataFrame:
    """id, doc_id, type, mention, start, end, assertions, gold_candidates, labels, unmapped, context, shortlist, split of coded gold entities (SPL-5)."""
    return _examples(docs, gold.where(F.col("type").isin(*lex.CODED_TYPES)), base, width, k, False)


def fixed_span_examples(docs: DataFrame, gold: DataFrame, base: DataFrame, *, width: int = 96, k: int = 10) -> DataFrame:
    """The same of all entities that can have assertions; only gold codes that the base knows join the shortlist (DEC-6, SPL-5)."""
    return _examples(docs, gold.where(F.col("type").isin(*lex.ASSERTED_TYPES)), base, width, k, True)


def unmapped_rows(examples: DataFrame) -> DataFrame:
    """id, type, mention, code of gold codes that the base does not know (SPL-5)."""
    return examples.select("id", "type", "mention", F.explode("unmapped").alias("code"))


def write_bundle(examples: DataFrame, folder: str, *, shots: int = 3) -> None:
    """Examples, fine-tuning rows by split, zero-shot and few-shot questions, unmapped codes and a summary (SPL-4)."""
    sinks.write_jsonl(examples, f"{folder}/examples")
    train = examples.where("split = 'train'")
    meta = F.struct("id", "type").alias("metadata")
    for split in ("train", "dev", "test"):
        own = examples.where(F.col("split") == split)
        sinks.write_jsonl(own.select(datasets.messages(answer=datasets.response()).alias("messages"), meta), f"{folder}/sft_{split}")
    asked = examples.where("split <> 'train'")
    expected = F.struct(F.col("gold_assertions").alias("assertions"), F.col("gold_candidates").alias("candidates")).alias("expected")
    sinks.write_jsonl(asked.select("id", datasets.messages().alias("messages"), expected, meta), f"{folder}/zero_shot")
    shown = datasets.few_shot(asked, train, k=shots).join(asked.select("id", expected, meta), "id")
    sinks.write_jsonl(shown, f"{folder}/few_shot")
    sinks.write_jsonl(unmapped_rows(examples), f"{folder}/unmapped")
    sinks.write_jsonl(datasets.bundle_summary(examples), f"{folder}/summary", single=True)


def multi_agent(spark: SparkSession, input_dir: str, entity_dir: str, base: DataFrame, generate=None) -> DataFrame:
    """Assertions and codes for the spans of an entity folder (DEC-11)."""
    docs, scratch = files.texts(spark, input_dir).select("doc_id", "text"), Scratch(spark, "agents")
    order = Window.partitionBy("doc_id").orderBy("start", "end", "type", "text")
    given = files.entity_files(spark, entity_dir).withColumn("ord", F.row_number().over(order))
    clauses = scratch.cut(structure.clauses(docs, scratch.cut(structure.sections(docs))))
    return agents.process(docs, given, clauses, base, abbreviations=lex.ABBREVIATIONS, generate=generate, cut=scratch.cut)


def analyze_subset(spark: SparkSession, gold_dir: str, output_dir: str) -> DataFrame:
    """Gold and predicted entities side by side by their place in each file, counted by type (JOIN-10)."""
    order = ["start", "end", "type", "text"]
    pairs = evaluation.zip_positions(files.entity_files(spark, gold_dir), files.entity_files(spark, output_dir), "doc_id", order, ["type", "assertions", "candidates"])
    return evaluation.subset_report(pairs)


def dump(path: str, value) -> None:
    Path(path).write_text(json.dumps(value, ensure_ascii=False, indent=2, default=str), encoding="utf-8")
