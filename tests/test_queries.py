"""Every registered query against its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import glob
import os
import time

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from textloom.plans import documents, entities, registry, relational, tables  # noqa: F401  registers the queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    return c


def rows(frame, columns):
    own = frame[columns].astype(object)
    return sorted(map(str, own.where(own.notna(), None).itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    got = registry.QUERIES[name](spark, SF).toPandas()
    if name in registry.ORACLE_SQL:
        want = duck.execute(registry.ORACLE_SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got, sorted(got.columns)) == rows(want, sorted(got.columns))
    else:
        assert len(got) > 0


def test_parts_of_one_name_are_all_candidates(spark, tmp_path):
    rows = [(1, "Brand#1", "green hammer", "STEEL"), (2, "Brand#2", "green hammer", "STEEL"), (3, "Brand#1", "red anvil", "TIN")]
    spark.createDataFrame(rows, "p_partkey long, p_brand string, p_name string, p_type string").write.parquet(f"{tmp_path}/part.parquet")
    linked = {r.text: r.codes for r in relational.kb_link(spark, str(tmp_path)).collect()}
    assert linked["green hammex"] == "B1.1,B2.2" and len(linked) == 2
    listed = [(r.query, r.code) for r in relational.kb_shortlist(spark, str(tmp_path)).where("source = 'exact'").collect()]
    assert sorted(listed) == [("green hammer", "B1.1"), ("green hammer", "B2.2"), ("red anvil", "B1.3")]


def dense_top(spark, folder, vectors):
    """The query's rows, its seconds, and its SQL's rows."""
    folder.mkdir()
    at = str(folder / "embeddings.parquet")
    pq.write_table(pa.table({"vec_id": pa.array(range(len(vectors)), pa.int64()), "embedding": pa.array(vectors, pa.list_(pa.float32()))}), at)
    began = time.monotonic()
    got = relational.dense_cosine_topk(spark, str(folder)).toPandas()
    seconds = time.monotonic() - began
    with duckdb.connect() as c:
        c.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{at}')")
        want = c.execute(registry.ORACLE_SQL["dense_cosine_topk"]).df()
    return rows(got, sorted(got.columns)), seconds, rows(want, sorted(got.columns))


def test_dense_top_takes_18_million_pairs_in_time(spark, tmp_path):
    vectors = np.random.default_rng(3).normal(size=(30_000, 64)).astype(np.float32)
    vectors[5000:5400], vectors[7000:7100] = vectors[50], vectors[100] * 2
    got, seconds, want = dense_top(spark, tmp_path / "large", list(vectors))
    assert got == want and len(got) == 3000
    assert seconds < 60  # minutes as rows of a join


def test_dense_top_ranks_odd_vectors_as_its_sql_does(spark, tmp_path):
    vectors = np.random.default_rng(4).normal(size=(400, 8)).astype(np.float32).tolist()
    vectors[100] = vectors[101] = [0.0] * 8
    vectors[150] = vectors[7] = None
    vectors[200][3], vectors[8][5], vectors[9][0] = float("inf"), float("nan"), float("-inf")
    vectors[20:40] = [vectors[50]] * 20
    got, _, want = dense_top(spark, tmp_path / "odd", vectors)
    assert got == want and len(got) == 40
