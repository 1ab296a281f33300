"""Readers of documents, entities, reviews, datasets and settings (SRC-1..7, SRC-11..17)."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field, fields, is_dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTITY_FIELDS = "text string, position array<int>, type string, assertions array<string>, candidates array<string>"
ENTITY = "struct<text: string, position: array<int>, type: string, assertions: array<string>, candidates: array<string>>"
REVIEW = f"file_name string, text string, predicted_entities array<{ENTITY}>, gold_entities array<{ENTITY}>"
KB_RECORD = "code string, label string, aliases array<string>, tty string, ingredient_codes array<string>"


def stem(path):
    """A file name without its last suffix."""
    return F.regexp_replace(path, r"\.[^.]*$", "")


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id (stem), file_name, text of every ``*.txt`` in a folder, whole (SRC-1)."""
    rows = spark.read.option("pathGlobFilter", "*.txt").text(folder, wholetext=True).select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("text"))
    empty = spark.createDataFrame([(n, "") for n in _empty_files(spark, f"{folder}/*.txt")], "file_name string, text string")
    return rows.unionByName(empty).withColumn("doc_id", stem(F.col("file_name")))


def _empty_files(spark: SparkSession, pattern: str) -> list[str]:
    """Names of files of no bytes: Spark's file sources have no rows for them."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.globStatus(path) if s.getLen() == 0]


def _flat(rows: DataFrame) -> DataFrame:
    none = F.array().cast("array<string>")
    return rows.select("doc_id", F.col("position")[0].alias("start"), F.col("position")[1].alias("end"), "type", "text", F.coalesce("assertions", none).alias("assertions"), F.coalesce("candidates", none).alias("candidates"))


def entity_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, end, type, text, assertions, candidates of every ``*.json`` array in a folder; fails on malformed ones (SRC-2)."""
    rows = spark.read.schema(ENTITY_FIELDS).option("multiLine", True).option("mode", "FAILFAST").option("pathGlobFilter", "*.json").json(folder)
    return _flat(rows.withColumn("doc_id", stem(F.col("_metadata.file_name"))))


def reviews(spark: SparkSession, path: str) -> DataFrame:
    """Review rows; a missing gold list stays null, which differs from an empty one (SRC-3)."""
    return spark.read.schema(REVIEW).json(path)


def ner_examples(spark: SparkSession, path: str) -> DataFrame:
    """example_id, text, entities (start, end, type) of training rows (SRC-4)."""
    rows = spark.read.schema("text string, entities array<struct<position: array<int>, type: string>>").json(path)
    spans = F.transform("entities", lambda e: F.struct(e["position"][0].alias("start"), e["position"][1].alias("end"), e["type"].alias("type")))
    return rows.select(F.sha1(F.col("text").cast("binary")).alias("example_id"), "text", spans.alias("entities"))


def chat_rows(spark: SparkSession, path: str) -> DataFrame:
    """messages and metadata of fine-tuning rows (SRC-5)."""
    return spark.read.schema("messages array<struct<role: string, content: string>>, metadata map<string, string>").json(path)


def kb_json(spark: SparkSession, path: str, system: str) -> DataFrame:
    """system, code, label, aliases, tty, ingredient_codes of a JSON array of records (SRC-6)."""
    none = F.array().cast("array<string>")
    rows = spark.read.schema(KB_RECORD).option("multiLine", True).option("mode", "FAILFAST").json(path)
    return rows.select(F.lit(system).alias("system"), "code", "label", F.coalesce("aliases", none).alias("aliases"), "tty", F.coalesce("ingredient_codes", none).alias("ingredient_codes"))


def knowledge_base(spark: SparkSession, icd10: str, rxnorm: str) -> DataFrame:
    """Both systems in one table (SRC-7)."""
    return kb_json(spark, icd10, "icd10").unionByName(kb_json(spark, rxnorm, "rxnorm"))


def string_map(path: str) -> dict[str, str]:
    """A JSON object of strings with lower-cased keys (SRC-11)."""
    return {str(k).lower(): str(v) for k, v in json.loads(Path(path).read_text(encoding="utf-8")).items()}


def ner_patterns(path: str, kb_terms: list[tuple[str, str]] = (), kinds: tuple[str, str] = ("CHẨN_ĐOÁN", "THUỐC")) -> list[tuple[str, str, float]]:
    """(label, term, score) of a lexical checkpoint and of a knowledge base's longer terms (SRC-12)."""
    data = json.loads(Path(path).read_text(encoding="utf-8"))
    own = [(p["label"], t, float(p.get("score", 0.8))) for p in data["patterns"] for t in p["terms"]]
    diagnosis, drug = kinds
    return own + [(k, t, 0.72 if k == diagnosis else 0.70) for k, t in kb_terms if (k == diagnosis and len(t) >= 4) or (k == drug and len(t) >= 5)]


def label_map(path: str | None, default: dict[str, str]) -> dict[str, str]:
    """Upper-cased labels, with and without B-/I-, of a JSON file; the default if it is missing or empty (SRC-13)."""
    if not path or not Path(path).is_file():
        return default
    data = json.loads(Path(path).read_text(encoding="utf-8"))
    given = data.get("label_map", data)
    out = {}
    for k, v in given.items():
        key = str(k).upper().replace(" ", "_")
        out |= {key: v, re.sub(r"^[BI]-", "", key): v}
    return out or default


def checkpoint_problems(folder: str, required: list[str]) -> list[str]:
    """What a checkpoint lacks (SRC-15)."""
    at = Path(folder)
    return [f"{folder} does not exist"] if not at.exists() else [f"{f} is missing" for f in required if at.is_dir() and not (at / f).exists()]


def split_order(file_name) -> list:
    """Columns that order ``68.2`` before ``68.10`` (SRC-17)."""
    parts = F.split(stem(file_name), r"\.")
    return [parts[0].cast("int"), F.coalesce(F.try_element_at(parts, F.lit(2)).cast("int"), F.lit(0))]


@dataclass
class Matching:
    max_candidates: int = 3
    min_confidence: float = 0.55


@dataclass
class Rules:
    symptom_window: int = 80
    assertion_window: int = 64


@dataclass
class Ner:
    backend: str = "rule"
    enabled: bool = False
    checkpoint: str = ""
    min_score: float = 0.0
    fallback_to_rules: bool = True


@dataclass
class Output:
    pretty: bool = False


@dataclass
class KnowledgeBasePaths:
    icd10_path: str = ""
    rxnorm_path: str = ""


@dataclass
class Config:
    """Settings of a run (SRC-14)."""

    knowledge_base: KnowledgeBasePaths = field(default_factory=KnowledgeBasePaths)
    matching: Matching = field(default_factory=Matching)
    rules: Rules = field(default_factory=Rules)
    output: Output = field(default_factory=Output)
    ner: Ner = field(default_factory=Ner)


def _scalar(text: str):
    bare = text.strip()
    if bare[:1] in "\"'" and bare[-1:] == bare[:1]:
        return bare[1:-1]
    low = bare.lower()
    if low in ("true", "false", "null", "~", ""):
        return {"true": True, "false": False}.get(low)
    for kind in (int, float):
        try:
            return kind(bare)
        except ValueError:
            pass
    return bare


def simple_yaml(text: str) -> dict:
    """Nested maps of scalars, by indentation; no lists."""
    entries = []
    for raw in text.splitlines():
        m = re.fullmatch(r"(\s*)(?!- )([^:#]+?)\s*:(?:\s+(.*?))?\s*", re.sub(r"(?:^|(?<=\s))#.*", "", raw))
        if m:
            entries.append((len(m[1]), m[2], m[3] or ""))
        elif re.sub(r"(?:^|(?<=\s))#.*", "", raw).strip():
            raise ValueError(f"not a map of scalars: {raw!r}")

    def block(rows: list[tuple[int, str, str]]) -> dict:
        """The map of rows whose least indented ones are its keys; the rows below a key are its own block."""
        if not rows:
            return {}
        heads = [i for i, r in enumerate(rows) if r[0] <= rows[0][0]]
        parts = [rows[a:b] for a, b in zip(heads, [*heads[1:], len(rows)])]
        return {p[0][1]: _scalar(p[0][2]) if p[0][2] else block(p[1:]) for p in parts}

    return block(entries)


def load_config(path: str) -> Config:
    """Settings of a JSON or YAML file; paths are relative to it, unknown keys fail."""
    at = Path(path)
    text = at.read_text(encoding="utf-8")
    data = json.loads(text) if at.suffix == ".json" else simple_yaml(text)
    ner = data.get("ner", {})
    if "enable_model_stub" in ner:  # an older name
        ner["enabled"] = ner.pop("enable_model_stub")
    out = Config()
    for section, values in data.items():
        part = getattr(out, section, None)
        if not is_dataclass(part):
            raise ValueError(f"unknown section {section}")
        known = {f.name for f in fields(part)}
        for k, v in (values or {}).items():
            if k not in known:
                raise ValueError(f"unknown setting {section}.{k}")
            if v is not None and (k.endswith("_path") or k == "checkpoint") and v and not Path(v).is_absolute():
                v = str(at.parent / v)
            setattr(part, k, v)
    return out
