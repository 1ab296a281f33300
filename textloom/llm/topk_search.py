"""Exact top-k search by inner product, with a KD-tree in every shard.

Vectors are dealt to shards by a hash of their id, so that shards are even
whatever the vectors are.  Each shard is built into a KD-tree once and written:
median splits by place along the widest side of the box (equal values fall on
either side, so that copies of one vector split evenly too), and at every node the
tight box of its members.  A query walks a tree best first: a heap gives the node
whose box promises the highest product, and the walk ends when the promise is
below the k-th score so far.

That k-th score travels: queries are searched in one shard first, and the k-th
score found there goes with them to all other shards, where nodes, or the whole
tree, that cannot reach it are never opened.  Scores are exact: components are
integers, products are taken in float64 where they cannot pass 2**53; beyond it
the boxes' bounds are raised by their rounding error, and the scores of the leaves
that are opened are taken in Python integers.

Queries are dealt out in blocks; one task holds a shard's tree and one bounded
group of blocks.

Defined results: a vector that is null, empty, or holds a null or a component
that is not finite takes no part, nor does one with a null id; vectors are
compared with those of their own length; rows that repeat an id are vectors of
their own (as candidates each has its place; as queries they share one list of
answers), and none is a candidate for its id; scores beyond 64 bits are clamped;
an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, table

SHARD_ROWS = 8192
LEAF_ROWS = 64
#: Queries of a block, and blocks that one task holds beside a tree.
BLOCK_ROWS, BLOCKS_AT_ONCE = 64, 64
TOP = 2**63 - 1


def quantize(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of every component, as doubles that are integers; null if the vector takes no part."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(F.lit(float(scale)) * x.cast("double")) != float("inf")))
    def floor(x: Column) -> Column:
        # a double of 2**52 or more is whole
        return F.when(F.abs(x) < float(1 << 52), F.floor(x).cast("double")).otherwise(x)

    whole = F.transform(vector, lambda x: floor(F.lit(float(scale)) * x.cast("double")))
    return F.when(vector.isNotNull() & (F.size(vector) > 0) & fine, whole)


class Tree:
    """A KD-tree over the rows of ``points`` (float64 that hold integers)."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf: int = LEAF_ROWS):
        order = np.arange(len(points))
        low, high, left, begin, end = [], [], [], [], []

        def add(a: int, b: int) -> int:
            own = points[order[a:b]]
            low.append(own.min(axis=0))
            high.append(own.max(axis=0))
            left.append(-1)
            begin.append(a)
            end.append(b)
            return len(left) - 1

        stack = [add(0, len(points))] if len(points) else []
        while stack:
            node = stack.pop()
            a, b = begin[node], end[node]
            if b - a > leaf:
                axis, middle = int(np.argmax(high[node] - low[node])), (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(points[order[a:b], axis], middle)]
                left[node] = add(a, a + middle)  # its sibling follows at once
                stack += [left[node], add(a + middle, b)]
        self.ids, self.points = ids[order], points[order]
        self.low, self.high = np.array(low), np.array(high)
        self.left, self.begin, self.end = left, begin, end
        self.limit = float(np.abs(points).max()) if len(points) else 0.0

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For each query and node, the highest product that the node's box allows."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T

    def search(self, query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
        """Of each query, the up to k (score, id) of at least its floor, without its own id."""
        if not self.left:
            return
        bounds, floors = self.bounds(queries), np.asarray(floors, np.float64)
        wide = self.limit * (float(np.abs(queries).max()) if len(queries) else 0.0) * self.points.shape[1] >= 2.0**53
        if wide:
            # more than the rounding of any order of the sums
            bounds += np.abs(queries) @ np.maximum(np.abs(self.low), np.abs(self.high)).T * (self.points.shape[1] * 2.0**-50)
            bounds = np.nan_to_num(bounds, nan=np.inf, posinf=np.inf, neginf=-np.inf)
        for q in np.flatnonzero(bounds[:, 0] >= floors).tolist():
            promise, vector, own, floor = bounds[q].tolist(), queries[q], int(query_ids[q]), float(floors[q])
            exact = [int(x) for x in vector] if wide else []
            best: list[tuple[float, int]] = []  # the worst first: (score, -id)
            heap = [(-promise[0], 0)]
            while heap:
                value, node = heapq.heappop(heap)
                if -value < floor:
                    break
                if self.left[node] >= 0:
                    for child in (self.left[node], self.left[node] + 1):
                        if promise[child] >= floor:
                            heapq.heappush(heap, (-promise[child], child))
                    continue
                a, b = self.begin[node], self.end[node]
                if wide:
                    scores = [max(-TOP - 1, min(TOP, sum(x * int(y) for x, y in zip(exact, row)))) for row in self.points[a:b].tolist()]
                    those = range(b - a)
                else:
                    scores = self.points[a:b] @ vector
                    those = np.flatnonzero(scores >= floor).tolist()
                for i in those:
                    one = (scores[i] if wide else float(scores[i]), -int(self.ids[a + i]))
                    if one[1] == -own:
                        continue
                    if len(best) < k:
                        heapq.heappush(best, one)
                    elif one > best[0]:
                        heapq.heapreplace(best, one)
                if len(best) == k:
                    # a float at or below the k-th score
                    floor = max(floor, float(best[0][0]) if not wide else np.nextafter(float(best[0][0]), -np.inf))
            yield q, [(int(s), -i) for s, i in sorted(best, reverse=True)]


def _sorted(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors in order of both, so that a task that runs again makes the same bytes."""
    ids, vectors = pdf["id"].to_numpy(np.int64), np.array(pdf["vector"].tolist(), np.float64).reshape(len(pdf), -1)
    order = np.lexsort((*vectors.T[::-1], ids))
    return ids[order], vectors[order]


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    first = pdf.iloc[0]
    return pd.DataFrame({"dim": [first["dim"]], "shard": [first["shard"]], "tree": [pickle.dumps(Tree(*_sorted(pdf)))]})


def _block(pdf: pd.DataFrame) -> pd.DataFrame:
    first = pdf.iloc[0]
    ids, vectors = _sorted(pdf)
    packed = pickle.dumps((ids, vectors, np.full(len(ids), -np.inf)))
    return pd.DataFrame({"dim": [first["dim"]], "block": [first["block"]], "queries": [packed]})


def _search(k: int, propagate: bool):
    """Answers of the blocks that meet a shard's tree; ``propagate``: the blocks again, with their k-th scores."""

    def search(key, trees: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        found, again = [], []
        tree = pickle.loads(trees["tree"].iloc[0]) if len(trees) else None
        for block, packed in zip(blocks["block"].tolist(), blocks["queries"]):
            ids, vectors, floors = pickle.loads(packed)
            floors = floors.copy()
            for q, answers in tree.search(ids, vectors, floors.copy(), k) if tree is not None else ():
                found += [(int(ids[q]), i, s) for s, i in answers]
                if len(answers) == k:
                    floors[q] = max(floors[q], np.nextafter(float(answers[-1][0]), -np.inf))
            again.append((block, pickle.dumps((ids, vectors, floors))))
        rows = [(q, i, s, None, None, None, None) for q, i, s in found]
        if propagate:
            rows += [(None, None, None, int(key[0]), int(key[1]), b, p) for b, p in again]
        columns = list(zip(*rows)) or [()] * 7
        # built one by one: a column of integers and nulls would otherwise pass through floats
        names = ["query_id", "vec_id", "score", "dim", "shard", "block"]
        out = {name: pd.array(list(c), dtype="Int64") for name, c in zip(names, columns)}
        return pd.DataFrame(out | {"queries": pd.Series(list(columns[6]), dtype=object)})

    return search


FOUND = "query_id long, vec_id long, score long, dim long, shard long, block long, queries binary"


def topk_search(vectors: DataFrame, queries: DataFrame, *, k: int = 10, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The k highest inner products of each query with all vectors of other ids: query_id, rank, vec_id, score.

    Both tables have id (long) and vector (array of doubles that hold integers).
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")

    def taking_part(df: DataFrame) -> DataFrame:
        return df.select("id", "vector").where("id is not null and vector is not null").withColumn("dim", F.size("vector"))

    shards = max(1, -(-vectors.count() // shard_rows))
    trees = taking_part(vectors).withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    trees = scratch.table(trees.groupBy("dim", "shard").applyInPandas(_build, "dim int, shard int, tree binary"), "trees")
    asked = taking_part(queries)
    parts = max(1, -(-asked.count() // BLOCK_ROWS))
    asked = asked.withColumn("block", F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(parts)).cast("int"))
    asked = scratch.table(asked.groupBy("dim", "block").applyInPandas(_block, "dim int, block int, queries binary"), "queries")

    def meet(blocks: DataFrame, propagate: bool) -> DataFrame:
        # a group is a tree and at most BLOCKS_AT_ONCE blocks
        blocks = blocks.withColumn("at_once", F.floor(F.col("block") / BLOCKS_AT_ONCE))
        held = trees.join(blocks.select("dim", "shard", "at_once").distinct(), ["dim", "shard"])
        held = held.select(F.col("dim").alias("tree_dim"), F.col("shard").alias("tree_shard"), F.col("at_once").alias("tree_at_once"), "tree")
        return held.groupBy("tree_dim", "tree_shard", "tree_at_once").cogroup(blocks.groupBy("dim", "shard", "at_once")).applyInPandas(_search(k, propagate), FOUND)

    home = asked.withColumn("shard", F.pmod(F.col("block"), F.lit(shards)).cast("int"))
    first = scratch.table(meet(home, True), "first")
    moved = first.where("block is not null").selectExpr("cast(dim as int) dim", "cast(shard as int) home", "cast(block as int) block", "queries")
    moved = moved.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where("shard <> home").drop("home")
    rest = meet(moved, False) if shards > 1 else first.limit(0)
    rest = scratch.table(rest.select("query_id", "vec_id", "score"), "rest")
    answers = first.where("block is null").select("query_id", "vec_id", "score").union(rest)
    ranked = answers.selectExpr("query_id", "cast(row_number() over (partition by query_id order by score desc, vec_id) as int) rank", "vec_id", "score")
    return ranked.where(F.col("rank") <= k)


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("id"), quantize(F.col("embedding")).alias("vector"))
    return topk_search(rows, rows.where("id % 100 = 0"))


OP1_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0
), r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 10
"""
