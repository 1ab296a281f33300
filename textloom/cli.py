"""Command line: ``python -m textloom.cli COMMAND ...``."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import evaluation, kb
from .plans import workflows as w
from .session import make_importable
from .sources import archives, files, sinks

#: name: arguments (``?`` marks one that may be left out)
COMMANDS = {
    "infer": ["input", "output", "config"], "submit": ["input", "output", "config", "zip"], "workflow": ["input", "output", "config", "zip", "report"],
    "validate": ["input", "output"], "eval": ["gold", "output"], "analyze": ["input", "output", "type"], "audit": ["input", "output"], "sanity": ["input", "output"],
    "compare": ["base", "changed"], "package": ["output", "zip"], "bootstrap": ["input", "output", "target", "seed_gold?"], "review-rank": ["input", "output", "most?"],
    "prepare-dev-subset": ["input", "output", "target", "most"], "validate-reviews": ["reviews"], "review-to-train": ["reviews", "target"], "review-to-gold": ["reviews", "target"],
    "kb-from-xlsx": ["workbook", "target"], "build-standard-kb": ["icd_zip", "rxnorm_zip", "target"], "audit-kb": ["kb", "least?"], "semantic-datasets": ["input", "gold", "config", "target"],
    "fixed-span-datasets": ["input", "gold", "config", "target"], "multi-agent": ["input", "entities", "config", "output"], "analyze-subset": ["gold", "output"],
    "export-review-packet": ["input", "output", "target", "most"], "gold-files": ["reviews", "target"], "materialize": ["reviews", "first", "last", "texts", "spans?"],
    "bootstrap-ner": ["reviews", "target"], "ner-labels": ["target"], "seed-aliases": ["gold", "kb", "target"],
}


def _base(spark: SparkSession, config: str):
    c = files.load_config(config)
    return files.knowledge_base(spark, c.knowledge_base.icd10_path, c.knowledge_base.rxnorm_path)


def run(spark: SparkSession, command: str, a: argparse.Namespace) -> int:
    def show(df, most: int = 1000) -> int:
        for r in df.limit(most).toJSON().collect():
            print(r)
        return 0

    if command == "infer":
        print(w.run_infer(spark, a.input, a.output, a.config))
    elif command in ("submit", "workflow"):
        print(w.run_submit(spark, a.input, a.output, a.config, a.zip))
        if command == "workflow":
            w.dump(a.report, w.audit_outputs(spark, a.input, a.output))
    elif command == "validate":
        bad = w.validate_folder(spark, a.input, a.output)
        show(bad)
        return int(bad.limit(1).count() > 0)
    elif command == "eval":
        return show(w.eval_outputs(spark, a.gold, a.output))
    elif command == "analyze":
        return show(w.analyze_outputs(spark, a.input, a.output, a.type))
    elif command == "audit":
        print(json.dumps(w.audit_outputs(spark, a.input, a.output), ensure_ascii=False))
    elif command == "sanity":
        return show(evaluation.sanity(files.texts(spark, a.input), files.entity_files(spark, a.output)))
    elif command == "compare":
        key = ["doc_id", "start", "end", "type", "text"]
        return show(evaluation.comparison_report(evaluation.compare(files.entity_files(spark, a.base), files.entity_files(spark, a.changed), key)))
    elif command == "package":
        print(sinks.zip_folder(a.output, a.zip, keep_parent=False, pattern="*.json"))
    elif command == "bootstrap":
        w.bootstrap(spark, a.input, a.output, a.target, seed_gold=bool(a.seed_gold))
    elif command == "review-rank":
        return show(w.rank_reviews(spark, a.input, a.output, int(a.most) if a.most else None))
    elif command == "prepare-dev-subset":
        w.prepare_dev_subset(spark, a.input, a.output, a.target, int(a.most))
    elif command == "validate-reviews":
        bad = w.validate_reviews(spark, a.reviews)
        show(bad)
        return int(bad.limit(1).count() > 0)
    elif command == "review-to-train":
        w.review_to_train(spark, a.reviews, a.target)
    elif command == "review-to-gold":
        sinks.write_jsonl(sinks.gold_of_reviews(files.reviews(spark, a.reviews)), a.target)
    elif command == "kb-from-xlsx":
        sinks.write_jsonl(kb.group_rows(archives.workbook(spark, a.workbook)), a.target, single=True)
    elif command == "build-standard-kb":
        w.build_standard_kb(spark, a.icd_zip, a.rxnorm_zip).write.mode("overwrite").parquet(a.target)
    elif command == "audit-kb":
        report, ok = w.audit_kb(files.kb_json(spark, a.kb, "icd10"), int(a.least or 1000))
        print(json.dumps(report))
        return int(not ok)
    elif command in ("semantic-datasets", "fixed-span-datasets"):
        docs = files.texts(spark, a.input).select("doc_id", F.col("text"))
        examples = w.semantic_examples if command == "semantic-datasets" else w.fixed_span_examples
        w.write_bundle(examples(docs, files.entity_files(spark, a.gold), _base(spark, a.config)), a.target)
    elif command == "multi-agent":
        sinks.reset_folder(a.output)
        docs = files.texts(spark, a.input).select("doc_id", F.col("text"))
        print(sinks.write_entity_files(docs, w.multi_agent(spark, a.input, a.entities, _base(spark, a.config)), a.output))
    elif command == "analyze-subset":
        return show(w.analyze_subset(spark, a.gold, a.output))
    elif command == "export-review-packet":
        docs = files.texts(spark, a.input).select("doc_id", F.col("text"))
        rows = sinks.review_rows(docs, files.entity_files(spark, a.output))
        print(json.dumps(sinks.export_review_packet(rows, w.rank_reviews(spark, a.input, a.output), int(a.most), a.target)))
    elif command == "gold-files":
        print(sinks.write_gold_files(files.reviews(spark, a.reviews), a.target))
    elif command == "materialize":
        print(sinks.materialize(files.reviews(spark, a.reviews), int(a.first), int(a.last), a.texts, a.spans))
    elif command == "bootstrap-ner":
        rows = sinks.gold_of_reviews(files.reviews(spark, a.reviews))
        sinks.write_jsonl(rows, a.target, single=True)
    elif command == "ner-labels":
        w.dump(a.target, sinks.label_metadata())
    elif command == "seed-aliases":
        base = files.kb_json(spark, a.kb, "icd10")
        sinks.write_jsonl(kb.alias_seed(files.entity_files(spark, a.gold), base, base), a.target, single=True)
    return 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="textloom")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, arguments in COMMANDS.items():
        p = commands.add_parser(name)
        for x in arguments:
            p.add_argument(f"--{x.rstrip('?').replace('_', '-')}", required=not x.endswith("?"))
    a = parser.parse_args(argv)
    spark = make_importable(SparkSession.builder.appName("textloom").getOrCreate())
    return run(spark, a.command, a)


if __name__ == "__main__":
    sys.exit(main())
