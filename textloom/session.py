"""Sessions that can run this library's Python functions on their executors."""

from __future__ import annotations

import re
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def make_importable(spark: SparkSession) -> SparkSession:
    """Puts the folder that holds this package on the Python workers' path.

    On a cluster the package comes with the job (an environment or --py-files);
    this is for sessions that were started elsewhere on the same machine.
    """
    root = str(Path(__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(":") if p]
    if root not in paths:
        environment["PYTHONPATH"] = ":".join([root, *paths])
    return spark


class Scratch:
    """Written tables of one run, below the folder that all executors share (spark.checkpoint.dir).

    A written table cuts the lineage and the plan: what is built on it neither
    runs nor optimises the earlier steps again.  The folder goes when the
    application ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not re.match(r"local(\[|$)", spark.sparkContext.master):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            root = "file://" + tempfile.mkdtemp(prefix="textloom-")
        path = f"{root.rstrip('/')}/textloom-{name}-{uuid.uuid4().hex}"
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(at)
        fs.deleteOnExit(at)
        self.spark, self.path, self.n = spark, path, 0

    def cut(self, df: DataFrame) -> DataFrame:
        self.n += 1
        at = f"{self.path}/{self.n}"
        df.write.parquet(at)
        return self.spark.read.schema(df.schema).parquet(at)
