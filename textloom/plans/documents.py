"""Queries over texts and spans, on generic rule tables that SQL can be handed too."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import spans as S
from ..functions import text as T
from ..operators import assertions, gazetteer, graph, spans, structure
from ..operators import validation as V
from .registry import query

#: (type, term): terms that hold others, and some that overlap.
TERMS = [
    ("word", "the"), ("word", "and"), ("word", "of the"), ("word", "of"), ("word", "with"), ("article", "le"), ("article", "la"), ("article", "der"), ("article", "die"),
    ("article", "el"), ("article", "los"), ("license", "released under the mit license"), ("license", "mit license"), ("license", "license"), ("insult", "idiot"),
    ("insult", "clown"), ("insult", "trash"), ("insult", "scum"),
]
TERMS_SQL = ", ".join(f"('{k}', '{t}')" for k, t in TERMS)


def docs(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")


def mentions(spark: SparkSession, sf: str) -> DataFrame:
    return gazetteer.mentions(docs(spark, sf), TERMS)


#: Every place where a term stands with no letter or digit beside it.
MENTIONS_SQL = f"""
terms(type, term) AS (VALUES {TERMS_SQL}),
d AS (SELECT doc_id, text, lower(text) AS low FROM documents),
parts AS (SELECT doc_id, text, low, type, term, string_split(low, term) AS p FROM d, terms WHERE contains(low, term)),
places AS (
  SELECT doc_id, text, low, type, term, unnest(range(1, len(p))) AS k, p FROM parts
), m0 AS (
  SELECT doc_id, text, low, type, term, CAST(list_sum(list_transform(p[1:k], lambda x: length(x))) + (k - 1) * length(term) AS INTEGER) AS start FROM places
), m AS (
  SELECT doc_id, type, start, CAST(start + length(term) AS INTEGER) AS "end", substr(text, start + 1, length(term)) AS text FROM m0
  WHERE NOT regexp_matches(substr(low, start + length(term) + 1, 1), '[\\p{{L}}\\p{{N}}]') AND (start = 0 OR NOT regexp_matches(substr(low, start, 1), '[\\p{{L}}\\p{{N}}]'))
)"""
#: Kept: no other mention of the type contains it (of equal ones there is one).
KEPT_SQL = """
kept AS (
  SELECT DISTINCT doc_id, type, start, "end", text FROM m AS a WHERE NOT EXISTS (
    SELECT 1 FROM m AS b WHERE b.doc_id = a.doc_id AND b.type = a.type AND b.start <= a.start AND b."end" >= a."end" AND (b.start < a.start OR b."end" > a."end"))
)"""


@query("doc_lines", """
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents),
o AS (SELECT doc_id, CAST(n - 1 AS INTEGER) AS line_no, line, CAST(coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS start,
  max(n) OVER (PARTITION BY doc_id) AS most, n FROM l)
SELECT doc_id, line_no, start, CAST(start + length(line) AS INTEGER) AS "end", line FROM o WHERE n < most OR line <> ''
""")  # fmt: skip
def doc_lines(spark: SparkSession, sf: str) -> DataFrame:
    return structure.lines(docs(spark, sf))


@query("doc_clauses", """
WITH p AS (SELECT doc_id, unnest(regexp_extract_all(text, '[^.;\\n]+')) AS s, generate_subscripts(regexp_extract_all(text, '[^.;\\n]+'), 1) AS n FROM documents)
SELECT doc_id, trim(regexp_replace(s, '^\\s+|\\s+$', '', 'g')) AS clause, count(*) AS n FROM p WHERE regexp_replace(s, '^\\s+|\\s+$', '', 'g') <> '' GROUP BY 1, 2
""")  # fmt: skip
def doc_clauses(spark: SparkSession, sf: str) -> DataFrame:
    found = spans.exploded(docs(spark, sf), S.separated_spans(".;\n")("text"), "doc_id")
    return found.groupBy("doc_id", F.col("text").alias("clause")).agg(F.count(F.lit(1)).alias("n"))


#: Sections of plain texts: a line that begins with a word of the rule.
SECTION_RULES = [("license", ["license"], [], []), ("secret", ["password", "token ="], ["isHistorical"], []), ("article", ["the and"], [], [])]


@query("doc_sections", """
WITH l AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents),
o AS (SELECT doc_id, n, text, line, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM l),
h AS (SELECT *, lower(replace(line, ':', ' ')) AS low FROM o),
r AS (SELECT doc_id, start, CASE WHEN contains(low, 'password') THEN 'secret' WHEN contains(low, 'token =') THEN 'secret' WHEN contains(low, 'license') THEN 'license' WHEN contains(low, 'the and') THEN 'article' END AS kind FROM h),
b AS (SELECT doc_id, start, kind FROM r WHERE kind IS NOT NULL
  UNION ALL SELECT doc_id, 0, 'general' FROM documents AS d WHERE length(text) > 0 AND NOT EXISTS (SELECT 1 FROM r WHERE r.doc_id = d.doc_id AND r.start = 0 AND r.kind IS NOT NULL))
SELECT b.doc_id, CAST(row_number() OVER w - 1 AS INTEGER) AS section_no, CAST(b.start AS INTEGER) AS start, CAST(coalesce(lead(b.start) OVER w, length(d.text)) AS INTEGER) AS "end", kind
FROM b JOIN documents AS d ON d.doc_id = b.doc_id WINDOW w AS (PARTITION BY b.doc_id ORDER BY b.start)
""")  # fmt: skip
def doc_sections(spark: SparkSession, sf: str) -> DataFrame:
    return structure.sections(docs(spark, sf), SECTION_RULES).select("doc_id", "section_no", "start", "end", "kind")


@query("token_document_frequency", r"""
WITH t AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'))) AS token FROM documents)
SELECT token, count(*) AS df FROM t WHERE length(token) >= 2 GROUP BY token
""")
def token_document_frequency(spark: SparkSession, sf: str) -> DataFrame:
    rows = docs(spark, sf).select(F.explode(T.token_set(F.col("text"))).alias("token"))
    return rows.where(F.length("token") >= 2).groupBy("token").agg(F.count(F.lit(1)).alias("df"))


@query("gazetteer_mentions", f"WITH {MENTIONS_SQL} SELECT * FROM m")
def gazetteer_mentions(spark: SparkSession, sf: str) -> DataFrame:
    return mentions(spark, sf).drop("source")


@query("prune_contained", f"WITH {MENTIONS_SQL}, {KEPT_SQL} SELECT * FROM kept")
def prune_contained(spark: SparkSession, sf: str) -> DataFrame:
    return spans.prune_contained(mentions(spark, sf), "doc_id", "type").drop("source")


@query("gazetteer_counts", f"WITH {MENTIONS_SQL}, {KEPT_SQL} SELECT doc_id, type, count(*) AS n FROM kept GROUP BY doc_id, type")
def gazetteer_counts(spark: SparkSession, sf: str) -> DataFrame:
    return prune_contained(spark, sf).groupBy("doc_id", "type").agg(F.count(F.lit(1)).alias("n"))


@query("span_clause_join", f"""
WITH {MENTIONS_SQL}, {KEPT_SQL},
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents),
o AS (SELECT doc_id, n - 1 AS line_no, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a, length(line) AS size FROM l),
x AS (SELECT k.doc_id, k.type, k.start, k."end", o.line_no, row_number() OVER (PARTITION BY k.doc_id, k.type, k.start, k."end" ORDER BY (o.a > k.start OR k."end" > o.a + o.size), o.line_no) AS r
  FROM kept AS k JOIN o ON o.doc_id = k.doc_id AND o.a < k."end" AND k.start < o.a + o.size)
SELECT doc_id, type, start, "end", CAST(line_no AS INTEGER) AS line_no FROM x WHERE r = 1
""")  # fmt: skip
def span_clause_join(spark: SparkSession, sf: str) -> DataFrame:
    own = prune_contained(spark, sf).withColumn("id", F.concat_ws(":", "type", "start", "end"))
    found = spans.enclosing(own, structure.lines(docs(spark, sf)), "id", "line_no")
    return found.select("doc_id", "type", "start", "end", "line_no")


CUES = ["not", "no", "sin", "nicht", "non", "le"]


@query("assertion_flags", f"""
WITH {MENTIONS_SQL}, {KEPT_SQL}
SELECT k.doc_id, k.type, k.start, k."end", regexp_matches(lower(regexp_extract(substr(d.text, 1, k.start), '[^.;\\n]*$')), '(^|[^\\p{{L}}\\p{{N}}_])({"|".join(CUES)})([^\\p{{L}}\\p{{N}}_]|$)') AS flagged
FROM kept AS k JOIN documents AS d ON d.doc_id = k.doc_id
""")  # fmt: skip
def assertion_flags(spark: SparkSession, sf: str) -> DataFrame:
    read = lambda m, text: {"before": assertions.since_separator(F.substring(text, F.lit(1), m["start"]))}
    rows = spans.beside_text(prune_contained(spark, sf).drop("text"), docs(spark, sf), read)
    return rows.withColumn("before", F.lower("before")).select("doc_id", "type", "start", "end", assertions.has_cue(F.col("before"), CUES).alias("flagged"))


@query("validate_spans", f"""
WITH {MENTIONS_SQL}
SELECT m.type, count(*) FILTER (WHERE substr(d.text, m.start + 1, m."end" - m.start) <> m.text OR m."end" > length(d.text)) AS broken, count(*) AS n FROM m JOIN documents AS d ON d.doc_id = m.doc_id GROUP BY m.type
""")  # fmt: skip
def validate_spans(spark: SparkSession, sf: str) -> DataFrame:
    none = F.array().cast("array<string>")
    rows = mentions(spark, sf).withColumns({"assertions": none, "candidates": none})
    bad = V.entity_problems(rows, docs(spark, sf), [k for k, _ in TERMS]).groupBy("type").agg(F.count(F.lit(1)).alias("broken"))
    return rows.groupBy("type").agg(F.count(F.lit(1)).alias("n")).join(bad, "type", "left").select("type", F.coalesce("broken", F.lit(0).cast("long")).alias("broken"), "n")


@query("facts_triples", f"""
WITH {MENTIONS_SQL}, {KEPT_SQL}, t AS (
  SELECT doc_id, text AS subject, 'has_type' AS predicate, type AS object FROM kept UNION ALL SELECT doc_id, text, 'has_code', upper(text) FROM kept WHERE type = 'insult'
  UNION ALL SELECT doc_id, 'document', 'says', text FROM kept WHERE type = 'insult')
SELECT predicate, object, count(*) AS n, count(DISTINCT doc_id) AS docs FROM t GROUP BY predicate, object
""")  # fmt: skip
def facts_triples(spark: SparkSession, sf: str) -> DataFrame:
    none = F.array().cast("array<string>")
    rows = prune_contained(spark, sf).withColumns({"assertions": none, "candidates": F.when(F.col("type") == "insult", F.array(F.upper("text"))).otherwise(none)})
    said = graph.unary_relations(rows, {"insult": "says"}, "document")
    return graph.facts(rows, said).groupBy("predicate", "object").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id").alias("docs"))


@query("bio_align", f"""
WITH {MENTIONS_SQL}, {KEPT_SQL}, w AS (SELECT doc_id, string_split(text, ' ') AS p FROM documents),
t0 AS (SELECT doc_id, unnest(p) AS token, generate_subscripts(p, 1) AS n FROM w),
t AS (SELECT doc_id, n, token, coalesce(sum(length(token) + 1) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a FROM t0),
h AS (SELECT t.doc_id, t.n, k.start, k."end", k.type, row_number() OVER (PARTITION BY t.doc_id, k.start, k."end", k.type ORDER BY t.a) AS r
  FROM t JOIN kept AS k ON k.doc_id = t.doc_id AND t.a < k."end" AND k.start < t.a + length(t.token) WHERE t.token <> ''),
b AS (SELECT doc_id, n, arg_max(CASE WHEN r = 1 THEN 'B-' ELSE 'I-' END || type, (start, "end", CASE WHEN r = 1 THEN 'B-' ELSE 'I-' END || type)) AS label FROM h GROUP BY doc_id, n)
SELECT t.doc_id, coalesce(b.label, 'O') AS label, count(*) AS n FROM t LEFT JOIN b ON b.doc_id = t.doc_id AND b.n = t.n WHERE t.token <> '' GROUP BY 1, 2
""")  # fmt: skip
def bio_align(spark: SparkSession, sf: str) -> DataFrame:
    tokens = spans.exploded(docs(spark, sf), S.regex_spans([("t", "[^ ]+")])("text"), "doc_id").select("doc_id", F.col("no").alias("token_no"), "start", "end")
    return spans.bio_align(tokens, prune_contained(spark, sf)).groupBy("doc_id", "label").agg(F.count(F.lit(1)).alias("n"))


@query("remap_offsets", """
SELECT d.doc_id, b.item_id, CAST(strpos(d.text, b.text) - 1 AS INTEGER) AS "offset" FROM documents AS d JOIN benchmark AS b ON contains(d.text, b.text)
""")
def remap_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """Where benchmark texts stand in documents: one automaton over a table of checked size finds the pairs."""
    items = spark.read.parquet(f"{sf}/benchmark.parquet").select(F.col("item_id").cast("string").alias("type"), F.col("text").alias("term"))
    found = gazetteer.mentions_of_table(docs(spark, sf), items)
    own = items.select(F.col("type").alias("t"), "term")
    exact = found.join(own, (F.col("type") == F.col("t")) & (F.col("text") == F.col("term")))
    return exact.groupBy("doc_id", F.col("type").cast("long").alias("item_id")).agg(F.min("start").alias("offset"))


@query("strength_extract", r"""
SELECT doc_id, regexp_extract(lower(text), '(\d+(?:[.,]\d+)?)\s*(mg/ml|mcg/ml|mg|mcg|g|ml)\b', 1) AS number, regexp_extract(lower(text), '(\d+(?:[.,]\d+)?)\s*(mg/ml|mcg/ml|mg|mcg|g|ml)\b', 2) AS unit
FROM documents WHERE regexp_matches(lower(text), '\d')
""")
def strength_extract(spark: SparkSession, sf: str) -> DataFrame:
    s = T.strength(F.col("text"))
    rows = docs(spark, sf).where(F.col("text").rlike(r"\d"))
    return rows.select("doc_id", F.coalesce(s["number"], F.lit("")).alias("number"), F.coalesce(s["unit"], F.lit("")).alias("unit"))


@query("fold_keys", r"""
SELECT doc_id, md5(replace(strip_accents(lower(text)), 'đ', 'd')) AS folded FROM documents
""")
def fold_keys(spark: SparkSession, sf: str) -> DataFrame:
    return docs(spark, sf).select("doc_id", F.md5(T.ascii_fold(F.col("text")).cast("binary")).alias("folded"))


@query("unmatched_top_texts", f"""
WITH {MENTIONS_SQL}, {KEPT_SQL} SELECT type, text, count(*) AS n, min(doc_id) AS first_seen FROM kept GROUP BY type, text ORDER BY n DESC, first_seen, type, text LIMIT 25
""")
def unmatched_top_texts(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import evaluation

    return evaluation.top_texts(prune_contained(spark, sf), "doc_id")


@query("inconsistent_mentions", f"""
WITH {MENTIONS_SQL}, {KEPT_SQL} SELECT type, lower(text) AS mention, count(*) AS n, count(DISTINCT text) AS texts FROM kept GROUP BY 1, 2 HAVING count(DISTINCT text) > 1
""")
def inconsistent_mentions(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import evaluation

    return evaluation.inconsistent(prune_contained(spark, sf), [F.col("type"), F.lower("text").alias("mention")], {"texts": F.col("text")})
