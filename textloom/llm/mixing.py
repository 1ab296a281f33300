"""Mixing sources to target weights by Pareto order sampling.

Sources share a word budget by weight.  A source's target is capped at
``max_copies`` times its size; what a cap cuts off is shared again, by weight,
among the others (water filling).

Within a source, a document's expected copies are in proportion to its length
class, the number of binary digits of its size, as far as ``max_copies`` allows:
the same water filling, over the at most 63 classes of the source, so that the
expected words add up to the target.  The whole part of the expected copies is
certain and allocated to all; the rest is the document's own inclusion
probability p.  Documents are ranked by random odds over inclusion odds,

    (u / (1 - u)) / (p / (1 - p)),

and taken in that order as long as they fit into the words that are left: first
the longest prefix, then, in ``FILLS`` rounds over those behind it, what still
fits into the gap, and last the smallest one if it leaves the source nearer to
its target.  The draw is thus of fixed size in words.

The ranking is never a sort of a whole source.  Documents fall into bands of
q / (1 + q), q the ratio of odds; running sums over band totals settle all bands
but the one in which the words run out, and only that one is sorted.  That is
where q is near 1, and there a band has no more than about ``bucket_rows`` rows
whatever the probabilities are; the gap is filled from that band.  u is a hash of
the id, so reruns agree (for the same ``bucket_rows``).

Defined results: a null or empty text has size 0 and is not taken; a null source
is a source of its own, ordered last; sources are ordered by code point; repeated
rows are drawn one by one; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import GAP, Scratch, fresh, table

BUCKET_ROWS = 4096
#: Rounds in which documents behind the cut fill what is left.
FILLS = 3


def size_in_words(text: Column) -> Column:
    """Number of words; 0 for a null."""
    parts = F.split(F.coalesce(text, F.lit("")), GAP)
    edges = (F.element_at(parts, 1) == "").cast("long") + (F.element_at(parts, -1) == "").cast("long")
    return F.when(F.coalesce(text, F.lit("")).rlike(r"[^\x20\x09-\x0D]"), F.size(parts).cast("long") - edges).otherwise(F.lit(0).cast("long"))


def unit_hash(key: Column, seed: int) -> Column:
    """A number strictly between 0 and 1 from 52 bits of an MD5 digest."""
    digest = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit("null"))).cast("binary")), 1, 13)
    return (F.conv(digest, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def targets(sources: DataFrame, weights: Sequence[float], share: float, max_copies: float) -> DataFrame:
    """Target words of each source; ``sources``: source, source_size, source_rows (one row a source)."""
    place = W.orderBy(F.col("source").isNull().cast("int"), F.col("source").cast("binary"))
    cyclic = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(place) - 1) % len(weights) + 1)
    everything = W.partitionBy(F.lit(0))
    filled = W.partitionBy(F.lit(0)).orderBy("ratio", "place").rowsBetween(W.unboundedPreceding, -1)
    total = F.sum("source_size").over(everything)
    return (
        sources.withColumn("weight", cyclic)
        .withColumn("place", F.row_number().over(place))
        .withColumn("cap", F.col("source_size") * F.lit(float(max_copies)))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("budget", total * F.lit(float(share)))
        .withColumn("rest", F.col("budget") - F.coalesce(F.sum("cap").over(filled), F.lit(0.0)))
        .withColumn("rest_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(filled), F.lit(0.0)))
        .withColumn("level", F.col("rest") / F.col("rest_weight"))
        # in the order of ratio, sources are capped as long as the level of what is left reaches theirs
        .withColumn("level", F.min(F.when(F.col("level") < F.col("ratio"), F.struct("ratio", "place", "level"))).over(everything)["level"])
        .withColumn("target", F.when(F.col("level").isNull() | (F.col("ratio") <= F.col("level")), F.col("cap")).otherwise(F.col("level") * F.col("weight")))
        .select("source", "source_size", "source_rows", "target")
    )


def length_class(size: Column) -> Column:
    """The number of binary digits."""
    return F.length(F.bin(size))


def expected_copies(classes: DataFrame, max_copies: float) -> DataFrame:
    """Expected copies of the documents of each source and class, and the words that certain copies leave to be drawn.

    ``classes``: source, class, words (over 0), source_size, source_rows, target.
    """
    own = W.partitionBy("source")
    before = own.orderBy(F.desc("class")).rowsBetween(W.unboundedPreceding, -1)
    limit = F.lit(float(max_copies))
    return (
        classes.withColumn("weight", F.col("class") * F.col("words"))
        .withColumn("rest", F.col("target") - limit * F.coalesce(F.sum("words").over(before), F.lit(0)))
        .withColumn("level", F.col("rest") / (F.sum("weight").over(own) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
        # from the longest class on, classes are capped as long as the level of what is left reaches the cap
        .withColumn("level", F.max(F.when(F.col("level") * F.col("class") < limit, F.struct("class", "level"))).over(own)["level"])
        .withColumn("expected", F.when(F.col("level").isNull(), limit).otherwise(F.least(limit, F.col("level") * F.col("class"))))
        .withColumn("certain", F.floor("expected"))
        .withColumn("p", F.col("expected") - F.col("certain"))
        .withColumn("left", F.greatest(F.lit(0.0), F.col("target") - F.sum(F.col("certain") * F.col("words")).over(own)))
        .select("source", "class", "source_size", "source_rows", "target", "certain", "p", "left")
    )


def mix(
    docs: DataFrame,
    *,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    max_copies: float = 2.0,
    seed: int = 9,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Copies of each document in the mix.

    ``docs`` needs doc_id, text and source.  Returns doc_id, source, text_key
    (hash of the text), size, source_size, target, copies, taken; one row per row.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mix")
    sized = docs.select("doc_id", F.col("source").cast("string").alias("source"), F.xxhash64("text").alias("text_key"), size_in_words(F.col("text")).alias("size"))
    sized = scratch.table(sized.withColumn("class", F.when(F.col("size") > 0, length_class(F.col("size"))).otherwise(0)), "sized")
    classes = scratch.table(sized.groupBy("source", "class").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows")), "classes")
    per_source = classes.groupBy("source").agg(F.sum("words").alias("source_size"), F.sum("rows").alias("source_rows"))
    goal = targets(per_source, weights, share, max_copies).withColumnRenamed("source", "goal_source")
    goal = scratch.table(classes.join(goal, F.col("source").eqNullSafe(F.col("goal_source"))).drop("goal_source"), "goal")
    # at most 64 rows a source
    copies = expected_copies(goal.where(F.col("class") > 0), max_copies).unionByName(
        goal.where(F.col("class") == 0).select("source", "class", "source_size", "source_rows", "target", F.lit(0).cast("long").alias("certain"), F.lit(0.0).alias("p"), F.lit(0.0).alias("left"))
    )
    copies = scratch.table(copies, "copies").withColumnsRenamed({"source": "copies_source", "class": "copies_class"})
    placed = (
        sized.join(copies, F.col("source").eqNullSafe(F.col("copies_source")) & (F.col("class") == F.col("copies_class")))
        .withColumn("u", unit_hash(F.col("doc_id"), seed))
        .withColumn("odds", F.when(F.col("p") > 0, F.col("u") / (1 - F.col("u")) / (F.col("p") / (1 - F.col("p")))))
        # monotone in the odds; null where nothing is drawn
        .withColumn("band", F.floor(F.col("odds") / (1 + F.col("odds")) * F.ceil(F.col("source_rows") / F.lit(float(bucket_rows)))))
    )
    bands = placed.where(F.col("p") > 0).groupBy("source", "band").agg(F.sum("size").alias("words"), F.first("left").alias("left"))
    upto = W.partitionBy("source").orderBy("band").rowsBetween(W.unboundedPreceding, -1)
    bands = scratch.table(
        bands.withColumn("before", F.coalesce(F.sum("words").over(upto), F.lit(0).cast("long"))).select(
            F.col("source").alias("band_source"), F.col("band").alias("band_no"), "before",
            # the cut lies in the band in which the running words pass what is left
            F.when(F.col("before") + F.col("words") <= F.col("left"), 1).when(F.col("before") >= F.col("left"), 0).alias("settled"),
        ),
        "bands",
    )
    columns = ["doc_id", "source", "text_key", "size", "source_size", "target", "certain"]
    joined = placed.where(F.col("p") > 0).join(bands, F.col("source").eqNullSafe(F.col("band_source")) & (F.col("band") == F.col("band_no")))
    settled = joined.where(F.col("settled").isNotNull()).select(*columns, F.col("settled").alias("drawn"))
    never = placed.where(F.col("p") == 0).select(*columns, F.lit(0).alias("drawn"))
    cut = _filled(joined.where(F.col("settled").isNull())).select(*columns, "drawn")
    return (
        settled.unionByName(never)
        .unionByName(cut)
        .withColumn("copies", (F.col("certain") + F.col("drawn")).cast("int"))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .select("doc_id", "source", "text_key", "size", "source_size", "target", "copies", "taken")
    )


def _filled(band: DataFrame) -> DataFrame:
    """``drawn`` of the documents of bands with a cut (one a source), which have size, odds, left and before."""
    whole = W.partitionBy("source", "band")
    order = ["odds", "size", "doc_id", "text_key"]
    running = whole.orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    out = band.withColumn("gap", F.col("left") - F.col("before")).withColumn("drawn", F.lit(0))
    for i in range(1 + FILLS):
        # the first round takes a prefix; each other one a prefix of those that are small enough by themselves
        fits = (F.col("drawn") == 0) & (F.col("size") <= F.col("gap")) if i else F.lit(True)
        out = (
            out.withColumn("fits", F.when(fits, F.col("size")).otherwise(0))
            .withColumn("upto", F.sum("fits").over(running))
            .withColumn("now", ((F.col("fits") > 0) & (F.col("upto") <= F.col("gap"))).cast("int"))
            .withColumn("drawn", F.col("drawn") + F.col("now"))
            .withColumn("gap", F.col("gap") - F.sum(F.col("now") * F.col("size")).over(whole))
        )
    nearer = F.when((F.col("drawn") == 0) & (F.col("size") < 2 * F.col("gap")), F.struct("size", "odds", "doc_id", "text_key"))
    last = F.row_number().over(whole.orderBy(nearer.isNull(), "size", "odds", "doc_id", "text_key"))
    return out.withColumn("drawn", F.col("drawn") + (nearer.isNotNull() & (last == 1)).cast("int"))


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with its own columns.

    Rows that repeat an id, a text and a source are drawn together, and their
    copies are dealt out to all of them in turn.
    """
    i, k, s, copies, rows, key, place, copy = fresh(docs, "mix_id", "mix_key", "mix_source", "mix_copies", "mix_rows", "text_key", "place", "copy")
    drawn = mix(docs, **how).groupBy(F.col("doc_id").alias(i), F.col("text_key").alias(k), F.col("source").alias(s))
    drawn = drawn.agg(F.sum("copies").alias(copies), F.count(F.lit(1)).alias(rows)).where(F.col(copies) > 0)
    keyed = docs.withColumn(key, F.xxhash64("text"))
    joined = keyed.join(drawn, F.col("doc_id").eqNullSafe(F.col(i)) & (F.col(key) == F.col(k)) & F.col("source").cast("string").eqNullSafe(F.col(s)))
    # only rows that are repeated are numbered; their other columns tell them apart, and equal rows are interchangeable
    number = F.row_number().over(W.partitionBy(i, k, s).orderBy(F.xxhash64(*docs.columns)))
    repeated = joined.where(F.col(rows) > 1).withColumn(place, number)
    share = F.floor(F.col(copies) / F.col(rows)) + (F.col(place) <= F.col(copies) % F.col(rows)).cast("int")
    every = joined.where(F.col(rows) == 1).withColumn(place, F.lit(1)).unionByName(repeated.withColumn(copies, share).where(F.col(copies) > 0))
    return every.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))).select(*[every[c] for c in docs.columns])


def op9_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, source, text, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n, row_number() OVER (ORDER BY source IS NULL, encode(source)) AS place FROM d GROUP BY source
), w AS (
  SELECT *, CAST([3, 1, 2][((place - 1) % 3) + 1] AS DOUBLE) AS weight, source_size * 2.0::DOUBLE AS cap FROM s
), l AS (
  SELECT *, cap / weight AS ratio, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS budget, sum(weight) OVER () AS all_weight FROM w
), m AS (
  SELECT *, (budget - coalesce(sum(cap) OVER before, 0)) / (all_weight - coalesce(sum(weight) OVER before, 0)) AS level
  FROM l WINDOW before AS (ORDER BY ratio, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size, CASE WHEN lv IS NULL OR ratio <= lv THEN cap ELSE lv * weight END AS target
  FROM (SELECT *, (SELECT arg_min(level, ratio) FROM m AS x WHERE x.level < x.ratio) AS lv FROM m)
), k AS (
  SELECT source, length(bin(size)) AS class, sum(size) AS words FROM d WHERE size > 0 GROUP BY ALL
), e0 AS (
  SELECT k.*, t.source_size, t.target, class * words AS weight FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source
), e1 AS (
  SELECT *, (target - 2.0::DOUBLE * coalesce(sum(words) OVER before, 0)) / (sum(weight) OVER (PARTITION BY source) - coalesce(sum(weight) OVER before, 0)) AS level
  FROM e0 WINDOW before AS (PARTITION BY source ORDER BY class DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), e2 AS (
  SELECT *, (SELECT arg_max(x.level, x.class) FROM e1 AS x WHERE x.source IS NOT DISTINCT FROM e1.source AND x.level * x.class < 2.0) AS lv FROM e1
), e3 AS (
  SELECT *, CASE WHEN lv IS NULL THEN 2.0::DOUBLE ELSE least(2.0::DOUBLE, lv * class) END AS expected FROM e2
), e AS (
  SELECT *, floor(expected) AS certain, expected - floor(expected) AS p, greatest(0, target - sum(floor(expected) * words) OVER (PARTITION BY source)) AS rest FROM e3
), q AS (
  SELECT d.doc_id, d.size, t.source, t.source_size, t.target, coalesce(e.certain, 0) AS certain, coalesce(e.p, 0) AS p, coalesce(e.rest, 0) AS rest,
    (('0x' || substr(md5('9:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN e ON e.source IS NOT DISTINCT FROM d.source AND e.class = length(bin(d.size)) AND d.size > 0
), o AS (
  SELECT *, CASE WHEN p > 0 THEN u / (1 - u) / (p / (1 - p)) END AS odds FROM q
), b AS (
  SELECT *, floor(odds / (1 + odds) * ceil(count(*) OVER (PARTITION BY source) / 4096.0::DOUBLE)) AS band FROM o
), b1 AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source, p > 0 ORDER BY band RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    sum(size) OVER (PARTITION BY source, p > 0, band) AS words FROM b
), f0 AS (
  SELECT *, p > 0 AND before < rest AND before + words > rest AS inside, (p > 0 AND before + words <= rest)::INT AS drawn0, rest - before AS gap0 FROM b1
), g1 AS (
  SELECT *, CASE WHEN inside AND sum(size) OVER (PARTITION BY source, inside, band ORDER BY odds, size, doc_id ROWS UNBOUNDED PRECEDING) <= gap0 THEN 1 ELSE 0 END AS drawn1 FROM f0
), h1 AS (SELECT *, gap0 - sum(drawn1 * size) OVER (PARTITION BY source, inside, band) AS gap1 FROM g1
), g2 AS (
  SELECT *, CASE WHEN inside AND drawn1 = 0 AND size <= gap1 AND sum(CASE WHEN drawn1 = 0 AND size <= gap1 THEN size ELSE 0 END) OVER (PARTITION BY source, inside, band ORDER BY odds, size, doc_id ROWS UNBOUNDED PRECEDING) <= gap1
    THEN 1 ELSE 0 END + drawn1 AS drawn2 FROM h1
), h2 AS (SELECT *, gap0 - sum(drawn2 * size) OVER (PARTITION BY source, inside, band) AS gap2 FROM g2
), g3 AS (
  SELECT *, CASE WHEN inside AND drawn2 = 0 AND size <= gap2 AND sum(CASE WHEN drawn2 = 0 AND size <= gap2 THEN size ELSE 0 END) OVER (PARTITION BY source, inside, band ORDER BY odds, size, doc_id ROWS UNBOUNDED PRECEDING) <= gap2
    THEN 1 ELSE 0 END + drawn2 AS drawn3 FROM h2
), h3 AS (SELECT *, gap0 - sum(drawn3 * size) OVER (PARTITION BY source, inside, band) AS gap3 FROM g3
), g4 AS (
  SELECT *, CASE WHEN inside AND drawn3 = 0 AND size <= gap3 AND sum(CASE WHEN drawn3 = 0 AND size <= gap3 THEN size ELSE 0 END) OVER (PARTITION BY source, inside, band ORDER BY odds, size, doc_id ROWS UNBOUNDED PRECEDING) <= gap3
    THEN 1 ELSE 0 END + drawn3 AS drawn4 FROM h3
), h4 AS (SELECT *, gap0 - sum(drawn4 * size) OVER (PARTITION BY source, inside, band) AS gap4 FROM g4
), l4 AS (
  SELECT *, (inside AND drawn4 = 0 AND size < 2 * gap4) AS nearer FROM h4
), c AS (
  SELECT *, CAST(certain + drawn0 + drawn4 + CASE WHEN nearer AND row_number() OVER (PARTITION BY source, inside, band, nearer ORDER BY size, odds, doc_id) = 1 THEN 1 ELSE 0 END AS INTEGER) AS copies FROM l4
)
SELECT doc_id, size, source_size, target, CAST(copies * size AS BIGINT) AS taken, copies FROM c
"""
