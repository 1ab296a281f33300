"""Benchmark decontamination by size-partitioned MinHash containment search.

Short items are looked for inside long documents.  An item of q shingles counts
as contained where a document holds at least ``percent`` / 100 of them.  Items
are partitioned by size (powers of two); each partition has its own depth of
sketch and its own bound on hashes.  An item's sketch is its k least shingle
hashes, k = q - ceil(percent * q / 100) + 1: a document that holds enough of the
item must hold one of them, so that the search misses nothing.  A document's side
of the sketch is whatever of its shingle hashes lies below the partitions'
bounds, a share of its size; documents too small for an item are not matched
with it.  Candidates are verified by counting the item's shingles, compared as
text, in the document.

Words are lower-cased (A-Z) and shingles have ``width`` words; an item with fewer
words has its whole sequence as one shingle.  All steps are DataFrame functions.

Defined results: null or empty texts and items hold nothing and are in nothing;
rows that repeat an id and a text give one result; a null id is kept; empty
tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import GAP, LOWER, UPPER, Scratch, fresh, table

_WHITE = " \t\n\x0b\x0c\r"


def _words(text: Column) -> Column:
    """Lower-cased words; one empty word for a text without words."""
    return F.split(F.btrim(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(_WHITE)), GAP)


def _hash(words: str, at: str, width: int) -> Column:
    return F.xxhash64(*[F.expr(f"{words}[{at} + {i}]") for i in range(width)])


def _shingle(words: str, at: str, width: int) -> Column:
    return F.concat_ws(" ", *[F.expr(f"{words}[{at} + {i}]") for i in range(width)])


def _exploded(df: DataFrame, width: int, *columns: str) -> DataFrame:
    """(columns, h, words, at): each place of a shingle of ``width`` words."""
    places = df.where(F.size("words") >= width).select(*columns, "words", F.explode(F.expr(f"sequence(0, size(words) - {width})")).alias("at"))
    return places.withColumn("h", _hash("words", "at", width))


def _item_shingles(items: DataFrame, width: int) -> DataFrame:
    """(item_key, width, shingle, h) of all items, distinct."""
    keyed = items.select(F.xxhash64("item_id", "text").alias("item_key"), _words(F.col("text")).alias("words")).where("words[0] <> ''")
    parts = [_exploded(keyed, width, "item_key").select("item_key", F.lit(width).alias("width"), _shingle("words", "at", width).alias("shingle"), "h")]
    for w in range(1, width):
        short = keyed.where(F.size("words") == w).withColumn("at", F.lit(0))
        parts.append(short.select("item_key", F.lit(w).alias("width"), _shingle("words", "at", w).alias("shingle"), _hash("words", "at", w).alias("h")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def contained_items(docs: DataFrame, items: DataFrame, *, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, text_key, item_id, n_item, n_shared): each item that a document contains.

    ``docs`` needs doc_id and text, ``items`` item_id and text.  n_item is the
    number of the item's distinct shingles, n_shared how many the document holds.
    """
    scratch = Scratch(docs.sparkSession, "decontaminate")
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    shingles = scratch.table(_item_shingles(items, width), "items")
    sized = shingles.groupBy("item_key").agg(F.count(F.lit(1)).alias("n_item")).withColumn("need", F.expr(f"cast(ceil({percent} * n_item / 100) as long)"))
    sized = scratch.table(sized.withColumn("part", F.floor(F.log2("n_item"))), "sized")
    ranked = shingles.join(sized, "item_key").withColumn("place", F.expr("row_number() over (partition by item_key order by h)"))
    sketch = scratch.table(ranked.where("place <= n_item - need + 1").select("item_key", "width", "h", "need", "part"), "sketch")
    # the bounds of the partitions, at most 64 a width
    bounds = sketch.groupBy("width", "part").agg(F.max("h").alias("bound"), F.min("need").alias("least")).collect()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("text_key", F.xxhash64("text"))
    split = texts.select("doc_id", "text_key", _words(F.col("text")).alias("words"))
    found = None
    for w in sorted({r["width"] for r in bounds}):
        own = [r for r in bounds if r["width"] == w]
        placed = _exploded(split, w, "doc_id", "text_key").select("doc_id", "text_key", (F.size("words") - (w - 1)).alias("n_doc"), "h")
        # below the bound of a partition whose items the document is large enough for
        fits = F.lit(False)
        for r in own:
            fits = fits | ((F.col("h") <= r["bound"]) & (F.col("n_doc") >= r["least"]))
        hits = placed.where(F.col("h") <= max(r["bound"] for r in own)).where(fits).join(sketch.where(F.col("width") == w).select("h", "item_key", "need"), "h")
        hits = hits.where("n_doc >= need").select("doc_id", "text_key", "item_key", F.lit(w).alias("width"))
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "doc_id long, text_key long, item_key long, width int")
    candidates = scratch.table(found.distinct(), "candidates")

    doubt = candidates.select(F.col("doc_id").alias("c_id"), F.col("text_key").alias("c_key"), "item_key", "width")
    verified = None
    for w in sorted({r["width"] for r in bounds}):
        asked = texts.join(doubt.where(F.col("width") == w), F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("text_key") == F.col("c_key")))
        asked = asked.select("doc_id", "text_key", F.col("item_key").alias("wanted"), _words(F.col("text")).alias("words"))
        own = shingles.where(F.col("width") == w).select("item_key", "h", "shingle")
        places = _exploded(asked, w, "doc_id", "text_key", "wanted")
        same = places.join(own, (F.col("wanted") == F.col("item_key")) & (places["h"] == own["h"])).where(_shingle("words", "at", w) == F.col("shingle"))
        same = same.select("doc_id", "text_key", "item_key", "shingle")
        verified = same if verified is None else verified.unionByName(same)
    if verified is None:
        verified = docs.sparkSession.createDataFrame([], "doc_id long, text_key long, item_key long, shingle string")
    counted = verified.distinct().groupBy("doc_id", "text_key", "item_key").agg(F.count(F.lit(1)).alias("n_shared"))
    named = items.select(F.xxhash64("item_id", "text").alias("item_key"), "item_id").distinct()
    return counted.join(sized, "item_key").where("n_shared >= need").join(named, "item_key").select("doc_id", "text_key", "item_id", "n_item", "n_shared")


def without_contaminated(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """``docs`` without the documents that contain an item."""
    bad_id, bad_key = fresh(docs, "bad_id", "bad_key")
    bad = contained_items(docs, items, **how).select(F.col("doc_id").alias(bad_id), F.col("text_key").alias(bad_key)).distinct()
    bad = Scratch(docs.sparkSession, "contaminated").table(bad, "bad")
    key = F.xxhash64(F.col("text").cast("string"))
    return docs.join(bad, F.col("doc_id").cast("long").eqNullSafe(F.col(bad_id)) & (key == F.col(bad_key)), "left_anti").select(*docs.columns)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("doc_id", "item_id", "n_item", "n_shared")


OP5_SQL = r"""
WITH t AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark
), w AS (
  SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM t
), i AS (
  SELECT id AS item_id, least(len(w), 5) AS width,
    unnest(list_distinct(list_transform(range(1, greatest(len(w) - 3, 2)), lambda k: array_to_string(w[k:k + 4], ' ')))) AS g FROM w WHERE kind = 'i' AND len(w) > 0
), d AS (
  SELECT DISTINCT id AS doc_id, width, unnest(list_transform(range(1, len(w) - width + 2), lambda k: array_to_string(w[k:k + width - 1], ' '))) AS g
  FROM w, (SELECT DISTINCT width FROM i) WHERE kind = 'd'
), n AS (SELECT item_id, count(*) AS n_item FROM i GROUP BY item_id
)
SELECT doc_id, item_id, n_item, count(*) AS n_shared FROM d JOIN i USING (width, g) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_item HAVING 100 * count(*) >= 80 * n_item
"""
