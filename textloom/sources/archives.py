"""Readers of terminology releases: zipped code lists, zipped RRF tables, workbooks (SRC-8..10).

Archives come through Spark's binaryFile source, so that any store will do; one
task unpacks one archive, line by line.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T

ROWS = 20_000


def _unpacked(names: str):
    """(member, row_no, line) of the members of zip archives whose lower-cased base name matches."""
    pattern = re.compile(names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                with zipfile.ZipFile(io.BytesIO(content.as_buffer())) as z:
                    for member in z.namelist():
                        base = member.rpartition("/")[2]
                        if not pattern.fullmatch(base.lower()):
                            continue
                        held: list[str] = []
                        first = 0
                        with io.TextIOWrapper(z.open(member), encoding="utf-8", errors="replace") as lines:
                            for line in lines:
                                held.append(line.rstrip("\r\n"))
                                if len(held) == ROWS:
                                    yield _rows(base, first, held)
                                    first, held = first + ROWS, []
                        yield _rows(base, first, held)

    return read


def _rows(member: str, first: int, lines: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"member": pa.array([member] * len(lines), pa.string()), "row_no": pa.array(range(first, first + len(lines)), pa.int64()), "line": pa.array(lines, pa.string())})


def zip_lines(spark: SparkSession, path: str, names: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(_unpacked(names), "member string, row_no long, line string")


def icd10_codes(spark: SparkSession, path: str) -> DataFrame:
    """row_no, code (with its point), label of a code release (SRC-8)."""
    rows = zip_lines(spark, path, r"icd10cm-codes-.*\.txt").withColumn("p", F.split(F.trim("line"), r"\s+", 2)).where("size(p) = 2")
    return rows.select("row_no", T.dotted_code(F.col("p")[0]).alias("code"), F.trim(F.col("p")[1]).alias("label"))


def rxnorm_atoms(spark: SparkSession, path: str) -> DataFrame:
    """row_no, rxcui, tty, str of the English, unsuppressed atoms of a release (SRC-9)."""
    rows = zip_lines(spark, path, r"rxnconso\.rrf").withColumn("f", F.split("line", r"\|")).where("size(f) >= 17 and f[1] = 'ENG' and f[16] = 'N'")
    return rows.selectExpr("row_no", "f[0] rxcui", "f[12] tty", "f[14] str")


def rxnorm_relations(spark: SparkSession, path: str) -> DataFrame:
    """rxcui1, rela, rxcui2 of a release (SRC-9)."""
    rows = zip_lines(spark, path, r"rxnrel\.rrf").withColumn("f", F.split("line", r"\|")).where("size(f) >= 8")
    return rows.selectExpr("f[0] rxcui1", "f[7] rela", "f[4] rxcui2").where("rxcui1 <> '' and rxcui2 <> ''")


_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def workbook_rows(data: bytes) -> Iterator[tuple[int, str, str]]:
    """Row number and the first two cells present of the first sheet's rows but the header (SRC-10)."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            for _, item in ElementTree.iterparse(z.open("xl/sharedStrings.xml")):
                if item.tag == f"{_NS}si":
                    shared.append("".join(t.text or "" for t in item.iter(f"{_NS}t")))
                    item.clear()
        n = 0
        for _, row in ElementTree.iterparse(z.open("xl/worksheets/sheet1.xml")):
            if row.tag != f"{_NS}row":
                continue
            n += 1
            cells = []
            for c in row.iter(f"{_NS}c"):
                inline, value = c.find(f"{_NS}is"), c.find(f"{_NS}v")
                if inline is not None:
                    cells.append("".join(t.text or "" for t in inline.iter(f"{_NS}t")))
                elif value is not None and value.text:
                    cells.append(shared[int(value.text)] if c.get("t") == "s" else value.text)
            if row.get("r") != "1" and len(cells) >= 2 and cells[0].strip():
                yield n, cells[0].strip(), cells[1].strip()
            row.clear()


def _sheets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            rows = list(workbook_rows(content.as_buffer().to_pybytes()))
            yield pa.RecordBatch.from_pydict({"row_no": pa.array([r[0] for r in rows], pa.int64()), "code": pa.array([r[1] for r in rows], pa.string()), "label": pa.array([r[2] for r in rows], pa.string())})


def workbook(spark: SparkSession, path: str) -> DataFrame:
    """row_no, code, label of a workbook's first sheet."""
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(_sheets, "row_no long, code string, label string")
