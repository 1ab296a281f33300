"""Top-k search, Jaccard join, decontamination."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.llm import decontamination, jaccard_join, topk_search
from textloom.llm.shingles import PIECE, shingle_sets, string_buffers, word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, n_shingles int, component string, h int"


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(low)


def shingles(text, width):
    w = words(text)
    return {tuple(w)} if 0 < len(w) < width else {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def brute_components(rows, width, percent):
    sets = [shingles(t, width) for _, t in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min((x for x in (least.get(root(i)), d) if x is not None), default=None)
    return sorted(((d, len(sets[i]), least[root(i)], links[i]) for i, (d, _) in enumerate(rows)), key=str)


def near_copies(seed, n=120):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [[rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 5, 30, 60, 120]))] for _ in range(12)]
    passage = [rng.choice(vocabulary) for _ in range(25)]
    rows = []
    for i in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 5])):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        if rng.random() < 0.3:
            w = w + passage
        rows.append((i, rng.choice([" ", "\n", "  \t"]).join(w).replace("w1", "W1")))
    return rows


@pytest.mark.parametrize(("width", "percent", "seed"), [(4, 85, 1), (5, 80, 2), (2, 60, 3)])
def test_join_equals_brute_force(spark, width, percent, seed):
    rows = near_copies(seed)
    got = jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), width=width, percent=percent)
    got = sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id", "n_links").collect()), key=str)
    assert got == brute_components(rows, width, percent)


def test_join_cuts_large_lists_and_families(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LIST_BLOCK", 8)
    monkeypatch.setattr(jaccard_join, "FAMILY_BLOCK", 8)
    rows = near_copies(7)
    got = jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), width=4, percent=85)
    got = sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id", "n_links").collect()), key=str)
    assert got == brute_components(rows, 4, 85)


def test_join_edge_cases(spark):
    same = "a b c d e f g h"
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two"), (6, same), (6, same), (None, same), (7, "word " * 5000), (8, "é" * 70000)]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], DOCS)
    got = {(r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in jaccard_join.jaccard_join(df, width=4, percent=85).collect()}
    assert got == {(1, 0, 1, 0), (2, 0, 2, 0), (3, 0, 3, 0), (4, 1, 4, 1), (5, 1, 4, 1), (6, 5, 6, 2), (None, 5, 6, 2), (7, 1, 7, 0), (8, 1, 8, 0)}
    kept = jaccard_join.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 6, 7, 8]
    assert jaccard_join.jaccard_join(df.limit(0)).collect() == []
    assert jaccard_join.one_of_each(df.limit(0)).collect() == []


def test_shingles_of_long_texts_do_not_depend_on_pieces(monkeypatch):
    import pyarrow as pa

    from textloom.llm import shingles as s

    text = " ".join(str(i * 7919 % 10007) for i in range(3000))
    whole = shingle_sets(pa.array([text, "a b", text[:5000]]), 4)
    monkeypatch.setattr(s, "PIECE", 1000)
    cut = shingle_sets(pa.array([text, "a b", text[:5000]]), 4)
    assert all((a == b).all() for a, b in zip(whole, cut)) and len(whole[0]) > 2900
    assert PIECE > 1000
    counted = word_hashes(*string_buffers(pa.array(["A b", None, "a  B\n"])))
    assert counted[1].tolist() == [0, 2, 2, 4] and (counted[0][:2] == counted[0][2:]).all()


def brute_topk(rows, k):
    vectors = []
    for i, v in rows:
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        q = [int(np.floor(1024 * np.float64(np.float32(x)))) for x in v]
        vectors.append((i, q))
    out = []
    for i, v in vectors:
        if i % 100 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in vectors if j != i and len(w) == len(v))
            out += [(i, r, j, -s) for r, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("spread", [0.02, 5.0])
def test_topk_equals_brute_force(spark, spread):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + spread * rng.normal(size=8)).astype(np.float32).tolist()) for i in range(900)]
    rows += [(2000 + i, rows[0][1]) for i in range(50)]  # ties
    rows += [(rows[3][0], rows[3][1]), (901, None), (902, []), (903, [1.0, None] + [0.0] * 6), (904, [float("nan")] * 8), (905, [float("inf")] * 8), (None, rows[1][1]), (1000, [1.0, 2.0]), (1001, [2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(0)).withColumn("score", F.lit("x"))
    v = df.select(F.col("vec_id").alias("id"), topk_search.quantize(F.col("embedding")).alias("vector"))
    got = topk_search.topk_search(v, v.where("id % 100 = 0"), shard_rows=200)
    assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == brute_topk(rows, 10)


def test_topk_keeps_repeated_rows(spark):
    rows = [(100, [3.0, 1.0]), (5, [9.0, 0.0]), (5, [2.0, 0.0]), (7, [2.0, 0.0]), (7, [2.0, 0.0]), (100, [0.0, 1.0])]
    v = spark.createDataFrame(rows, "id long, vector array<double>")
    got = [(r.vec_id, r.score) for r in topk_search.topk_search(v, v.where("id = 100"), k=20).orderBy("rank").collect()]
    want = sorted(((-sum(a * b for a, b in zip(x, y)), i) for q, x in rows if q == 100 for i, y in rows if i != 100))
    assert got == [(i, -s) for s, i in want] and len(got) == 8


def test_topk_of_wide_values_walks_the_tree(spark):
    """Scores between 2**53 and 2**63, and ones beyond 64 bits, against Python integers."""
    rng = random.Random(9)
    rows = [(i, [float(rng.randint(-(10**s), 10**s)) for _ in range(6)]) for i, s in ((i, rng.choice([3, 8, 9, 12])) for i in range(900))]
    tree = topk_search.Tree(np.arange(900), np.array([v for _, v in rows]), leaf=16)
    ids = np.arange(0, 900, 50)
    found = dict(tree.search(ids, tree_rows := np.array([rows[i][1] for i in ids]), np.full(len(ids), -np.inf), 7))
    assert len(found) == len(tree_rows)
    for q, i in enumerate(ids.tolist()):
        exact = sorted(((-max(-(2**63), min(2**63 - 1, sum(int(a) * int(b) for a, b in zip(rows[i][1], v)))), j) for j, v in rows if j != i))
        assert found[q] == [(-s, j) for s, j in exact[:7]]


def test_topk_wide_and_empty(spark):
    rows = [(0, [1e30, 1.0]), (1, [1e30, 2.0]), (2, [-1e30, 0.0]), (3, [3.0e9, 7.0])]
    df = spark.createDataFrame(rows, "id long, vector array<double>")
    v = df.select("id", topk_search.quantize(F.col("vector"), 1).alias("vector"))
    got = topk_search.topk_search(v, v.where("id = 0")).collect()
    assert [(r.rank, r.vec_id) for r in got] == [(1, 1), (2, 3), (3, 2)]
    assert topk_search.topk_search(v.limit(0), v.limit(0)).collect() == []


def test_tree_opens_few_nodes_of_clustered_points():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 4)) * 1000
    points = np.floor(np.repeat(centres, 100, axis=0) + rng.normal(size=(4000, 4)))
    tree = topk_search.Tree(np.arange(4000), points, leaf=32)
    q = np.floor(centres[:1])
    ((_, best),) = tree.search(np.array([-1]), q, np.array([-np.inf]), 5)
    want = sorted(((-s, i) for i, s in enumerate((points @ q[0]).tolist())))[:5]
    assert best == [(int(-s), i) for s, i in want]
    # the walk prunes: far fewer nodes promise more than the fifth score than there are
    assert (tree.bounds(q)[0] >= best[-1][0]).mean() < 0.2


def brute_contained(docs, items, width, percent):
    out = set()
    for i, t in items:
        w = words(t)
        if not w:
            continue
        k = min(width, len(w))
        own = shingles(t, k)
        for d, text in docs:
            x = words(text)
            has = {tuple(x[a : a + k]) for a in range(len(x) - k + 1)} & own
            if 100 * len(has) >= percent * len(own):
                out.add((d, i, len(own), len(has)))
    return sorted(out, key=str)


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(4)
    vocabulary = [f"v{i}" for i in range(200)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 4, 8, 20, 50])))) for i in range(25)] + [(30, None), (31, ""), (None, "a b c d e f")]
    docs = []
    for d in range(80):
        w = [rng.choice(vocabulary) for _ in range(rng.choice([0, 2, 40, 400]))]
        if rng.random() < 0.5:
            item = words(rng.choice(items)[1])
            if rng.random() < 0.5 and len(item) > 10:
                item = item[: len(item) - rng.randrange(8)]
            at = rng.randrange(len(w) + 1)
            w = w[:at] + item + w[at:]
        docs.append((d, rng.choice([" ", "\n"]).join(w).upper()))
    docs += [(100, None), (101, "x A b\tC d e  f y"), (101, "x A b\tC d e  f y"), (None, "a b c d e f")]
    frame = spark.createDataFrame([(*r, "n", 1) for r in docs], "doc_id long, text string, item_id string, h int")
    asked = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id int")
    got = decontamination.contained_items(frame, asked).select("doc_id", "item_id", "n_item", "n_shared")
    want = brute_contained(docs, items, 5, 80)
    assert sorted(map(tuple, got.collect()), key=str) == want and len(want) > 20
    kept = decontamination.without_contaminated(frame, asked)
    assert kept.columns == frame.columns
    bad = {w[0] for w in want}
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((d for d, _ in docs if d not in bad), key=str)
    assert decontamination.contained_items(frame.limit(0), asked).collect() == []
    assert decontamination.without_contaminated(frame, asked.limit(0)).count() == len(docs)
