"""Helpers that the training-data operators share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a maximal run of bytes other than these six white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text in order; none for a null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def held_out(doc_id: Column) -> Column:
    """The fold that no model learns from: crc32 of the id's decimal digits is 2 modulo 4.

    A null id is in no fold and is not held out.
    """
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have, made of ``names``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or, only where that is unset, a local one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        made = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = made.get() if made.isDefined() else None
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="textloom-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Within it, what runs hands Python at most so many rows at a time: whole texts are long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


class Scratch:
    """Written tables and files of one run, in a folder of its own below the shared root.

    A written table cuts the lineage: what is built on it survives the loss of
    any executor without running the earlier steps again.  The folder goes when
    the application ends; large steps are dropped as soon as they are used up.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_root(spark)}/textloom-{name}-{uuid.uuid4().hex}"
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = self._path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path)
        self._fs.deleteOnExit(self._path)
        self.path = self._fs.makeQualified(self._path).toString()
        if self.path.startswith("file:/") and not self.path.startswith("file://"):
            self.path = "file://" + self.path[len("file:") :]

    def table(self, df: DataFrame, name: str) -> DataFrame:
        at = f"{self.path}/{name}"
        df.write.mode("overwrite").parquet(at)
        return self.spark.read.schema(df.schema).parquet(at)

    def folder(self, name: str) -> str:
        at = f"{self.path}/{name}"
        self._fs.mkdirs(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at))
        return at

    def drop(self, *names: str) -> None:
        for name in names:
            self._fs.delete(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}"), True)


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a URI, on the driver or on an executor."""
    if "://" not in uri and not uri.startswith("/"):
        raise ValueError(f"not an absolute path or URI: {uri}")
    return pafs.FileSystem.from_uri(uri)


class AtomicFile:
    """A file that appears under its name when it is complete; a repeated task replaces it by an equal one."""

    def __init__(self, uri: str):
        self.fs, self.at = open_fs(uri)
        self.temporary = f"{self.at}.{uuid.uuid4().hex}.tmp"
        self.out = self.fs.open_output_stream(self.temporary)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def __enter__(self) -> AtomicFile:
        return self

    def __exit__(self, kind, value, trace) -> None:
        self.out.close()
        if kind is None:
            self.fs.move(self.temporary, self.at)
        else:
            self.fs.delete_file(self.temporary)
