"""Writers (SNK-1..13): entity files, JSONL, zips, review packets, datasets."""

from __future__ import annotations

import json
import shutil
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..lexicon import clinical as lex


def entity_struct() -> Column:
    """An entity in the form of the files (PRJ-1)."""
    return F.struct("text", F.array("start", "end").alias("position"), "type", "assertions", "candidates")


def entity_lists(docs: DataFrame, entities: DataFrame) -> DataFrame:
    """doc_id, entities: the sorted list of each document, empty ones too."""
    own = entities.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start", "end", "type", entity_struct().alias("e")))).alias("x"))
    joined = docs.select("doc_id").join(own, "doc_id", "left")
    return joined.select("doc_id", F.transform(F.coalesce("x", F.array()), lambda r: r["e"]).alias("entities"))


def _file_writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = pafs.FileSystem.from_uri(folder) if "://" in folder else (pafs.LocalFileSystem(), folder)
        n = 0
        for batch in batches:
            for name, body in zip(batch.column("name").to_pylist(), batch.column("body").to_pylist()):
                with fs.open_output_stream(f"{at}/{name}") as out:
                    out.write((body or "").encode())
                n += 1
        yield pa.RecordBatch.from_pydict({"files": pa.array([n], pa.int64())})

    return write


def write_files(rows: DataFrame, folder: str) -> int:
    """A file for each row (name, body), written by the tasks into a shared folder; the number of files."""
    if "://" not in folder:
        Path(folder).mkdir(parents=True, exist_ok=True)
    return rows.select("name", "body").mapInArrow(_file_writer(folder), "files long").agg(F.sum("files")).first()[0] or 0


def _as_json(column: str, pretty: bool) -> Column:
    """A column as JSON text, indented if ``pretty``."""
    return F.to_json(column, {"pretty": "true"} if pretty else {})


def write_entity_files(docs: DataFrame, entities: DataFrame, folder: str, *, pretty: bool = False) -> int:
    """One JSON array file for each document, written by the tasks into a shared folder (SNK-1); the number of files."""
    rows = entity_lists(docs, entities).select(F.concat(F.col("doc_id").cast("string"), F.lit(".json")).alias("name"), _as_json("entities", pretty).alias("body"))
    return write_files(rows, folder)


def reset_folder(folder: str) -> None:
    """An empty folder (SNK-2)."""
    shutil.rmtree(folder, ignore_errors=True)
    Path(folder).mkdir(parents=True)


def zip_folder(folder: str, target: str, *, keep_parent: bool = True, pattern: str = "**/*") -> int:
    """A deflated zip of a folder's files, with the folder's name in front or flat (SNK-3, SNK-4)."""
    at = Path(folder)
    files = sorted(p for p in at.glob(pattern) if p.is_file())
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in files:
            z.write(p, p.relative_to(at.parent) if keep_parent else p.name)
    return len(files)


def write_jsonl(rows: DataFrame, folder: str, *, single: bool = False) -> None:
    """JSON lines with nulls kept (SNK-5, SNK-6); ``single``: one part file, where a contract asks for it."""
    (rows.coalesce(1) if single else rows).write.mode("overwrite").option("ignoreNullFields", "false").json(folder)


def review_rows(docs: DataFrame, entities: DataFrame, *, seed_gold: bool = False) -> DataFrame:
    """file_name, text, predicted_entities, gold_entities (null unless seeded with the predictions) (SNK-7)."""
    rows = docs.join(entity_lists(docs, entities), "doc_id")
    gold = F.col("entities") if seed_gold else F.lit(None).cast(rows.schema["entities"].dataType)
    return rows.select(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("file_name"), "text", F.col("entities").alias("predicted_entities"), gold.alias("gold_entities"))


def selected_reviews(reviews: DataFrame, ranked: DataFrame, most: int) -> DataFrame:
    """Reviews of the first files of a ranking (JOIN-13, SNK-8)."""
    names = ranked.where(F.col("rank") <= most).select(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("file_name"))
    return reviews.join(names, "file_name", "left_semi")


def export_review_packet(reviews: DataFrame, ranked: DataFrame, most: int, folder: str) -> dict:
    """Texts and predicted entities of the first files of a ranking, their review rows and a manifest, in a folder (SNK-8)."""
    own = selected_reviews(reviews, ranked, most)
    stem = F.regexp_replace("file_name", r"\.[^.]*$", "")
    none = F.array().cast(reviews.schema["predicted_entities"].dataType)
    write_files(own.select(F.col("file_name").alias("name"), F.col("text").alias("body")), folder)
    write_files(own.withColumn("e", F.coalesce("predicted_entities", none)).select(F.concat(stem, F.lit(".json")).alias("name"), _as_json("e", True).alias("body")), folder)
    write_jsonl(own, f"{folder.rstrip('/')}/reviews", single=True)
    places = ranked.where(F.col("rank") <= most).select(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("file_name"), "rank")
    # at most ``most`` names
    names = [r["file_name"] for r in own.select("file_name").join(places, "file_name").orderBy("rank").collect()]
    manifest = {"count": len(names), "files": names}
    write_files(reviews.sparkSession.createDataFrame([("manifest.json", json.dumps(manifest, ensure_ascii=False, indent=2))], "name string, body string"), folder)
    return manifest


def write_gold_files(reviews: DataFrame, folder: str) -> int:
    """One JSON array file of gold (or, without a gold list, predicted) entities for each review (SNK-9)."""
    stem = F.regexp_replace("file_name", r"\.[^.]*$", "")
    return write_files(gold_of_reviews(reviews).select(F.concat(stem, F.lit(".json")).alias("name"), _as_json("entities", True).alias("body")), folder)


def materialize(reviews: DataFrame, first: int, last: int, text_folder: str, span_folder: str | None = None) -> int:
    """Texts, and with ``span_folder`` the entities, of the reviews whose number is from first to last, as files (SNK-12, SNK-13)."""
    own = numbered_range(reviews, "file_name", first, last)
    n = write_files(own.select(F.col("file_name").alias("name"), F.col("text").alias("body")), text_folder)
    if span_folder:
        write_gold_files(own, span_folder)
    return n


def gold_of_reviews(reviews: DataFrame) -> DataFrame:
    """file_name, entities: gold if there is a list, even an empty one, else the prediction (SNK-9)."""
    return reviews.select("file_name", F.coalesce("gold_entities", "predicted_entities", F.array()).alias("entities"))


def ner_rows(docs: DataFrame, entities: DataFrame) -> DataFrame:
    """text, entities (position, type): training rows (SNK-10)."""
    lists = docs.join(entity_lists(docs, entities), "doc_id")
    return lists.select("text", F.transform("entities", lambda e: F.struct(e["position"].alias("position"), e["type"].alias("type"))).alias("entities"))


def label_metadata(types: list[str] = lex.ENTITY_TYPES) -> dict:
    """Labels and ids of a token classifier (SNK-11)."""
    labels = lex.bio_labels(types)
    return {"labels": labels, "label2id": {x: i for i, x in enumerate(labels)}, "id2label": {str(i): x for i, x in enumerate(labels)}}


def numbered_range(rows: DataFrame, column: str, first: int, last: int) -> DataFrame:
    """Rows whose file stem is a number from first to last (SNK-12, SNK-13)."""
    number = F.regexp_extract(F.col(column).cast("string"), r"^([0-9]+)(?:\.[A-Za-z]+)?$", 1)
    return rows.where((number != "") & number.try_cast("long").between(first, last))
