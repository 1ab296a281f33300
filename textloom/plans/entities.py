"""Queries of the operators on entities: mentions of the gazetteer as entities of the clinical types.

Words are symptoms, articles drugs, licenses diagnoses, insults lab names; codes
and assertions follow from a mention's text and place, so that SQL can follow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..lexicon import clinical as lex
from ..operators import datasets, evaluation, graph, linking, spans, validation
from ..sources import sinks
from . import documents as D
from .registry import query

TYPES = {"word": lex.SYMPTOM, "article": lex.DRUG, "license": lex.DIAGNOSIS, "insult": lex.LAB_NAME}
_TYPE_SQL = "CASE type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TYPES.items()) + " END"
_ASSERTED, _CODED = (", ".join(f"'{t}'" for t in x) for x in (lex.ASSERTED_TYPES, lex.CODED_TYPES))

#: Codes: drugs at an even place their upper-cased text and, at every sixth, a second one; diagnoses at every third.
ENTITIES_SQL = f"""{D.MENTIONS_SQL}, {D.KEPT_SQL},
e0 AS (SELECT doc_id, start, "end", {_TYPE_SQL} AS type, text FROM kept),
ent AS (SELECT *, CASE WHEN type NOT IN ({_ASSERTED}) THEN [] ELSE list_concat(CASE WHEN start % 3 = 0 THEN ['isNegated'] ELSE [] END, CASE WHEN start % 5 = 0 THEN ['isFamily'] ELSE [] END) END AS assertions,
  CASE WHEN type = '{lex.DRUG}' AND start % 6 = 0 THEN [upper(text), 'X'] WHEN type = '{lex.DRUG}' AND start % 2 = 0 THEN [upper(text)] WHEN type = '{lex.DIAGNOSIS}' AND start % 3 = 0 THEN [upper(text)] ELSE [] END AS candidates FROM e0)"""


def entities(spark: SparkSession, sf: str) -> DataFrame:
    rows = D.prune_contained(spark, sf).select("doc_id", "start", "end", F.create_map(*[F.lit(x) for kv in TYPES.items() for x in kv])[F.col("type")].alias("type"), "text")
    none, at, t = F.array().cast("array<string>"), F.col("start"), F.col("type")
    said = F.array_compact(F.array(F.when(at % 3 == 0, "isNegated"), F.when(at % 5 == 0, "isFamily")))
    up = F.upper("text")
    codes = F.when((t == lex.DRUG) & (at % 6 == 0), F.array(up, F.lit("X"))).when((t == lex.DRUG) & (at % 2 == 0), F.array(up)).when((t == lex.DIAGNOSIS) & (at % 3 == 0), F.array(up)).otherwise(none)
    return rows.withColumns({"assertions": F.when(t.isin(*lex.ASSERTED_TYPES), said).otherwise(none), "candidates": codes})


@query("entity_summary", f"WITH {ENTITIES_SQL} SELECT type, count(*) AS entities, (SELECT count(DISTINCT doc_id) FROM documents) AS files FROM ent GROUP BY type")
def entity_summary(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.entity_summary(D.docs(spark, sf), entities(spark, sf))


@query("unmatched_mentions", f"WITH {ENTITIES_SQL} SELECT doc_id, start, \"end\", type, text FROM ent WHERE type IN ({_CODED}) AND len(candidates) = 0")
def unmatched_mentions(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.unmatched(entities(spark, sf)).select("doc_id", "start", "end", "type", "text")


_STATS_SQL = f"""own AS (SELECT doc_id, count(*) AS entities, count(*) FILTER (WHERE type IN ({_CODED}) AND len(candidates) = 0) AS unmatched, CAST(sum(len(assertions)) AS BIGINT) AS assertions,
  count(DISTINCT type) AS diversity FROM ent GROUP BY doc_id),
stats AS (SELECT d.doc_id, coalesce(entities, 0) AS entities, coalesce(unmatched, 0) AS unmatched, coalesce(assertions, 0) AS assertions, coalesce(diversity, 0) AS diversity FROM (SELECT DISTINCT doc_id FROM documents) AS d LEFT JOIN own ON own.doc_id = d.doc_id)"""


@query("review_stats", f"""
WITH {ENTITIES_SQL}, {_STATS_SQL} SELECT *, round(10 * unmatched + 2 * assertions + diversity + 0.1 * entities, 6) AS score,
  CAST(row_number() OVER (ORDER BY unmatched DESC, assertions DESC, diversity DESC, entities DESC, doc_id) AS INTEGER) AS rank FROM stats
""")  # fmt: skip
def review_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of every document, those without entities too, and its place in the review."""
    ranked = evaluation.review_rank(evaluation.review_stats(D.docs(spark, sf), entities(spark, sf)))
    return ranked.withColumn("score", F.round("score", 6))


@query("sanity_files", f"""
WITH {ENTITIES_SQL}, s AS (SELECT doc_id, count(*) AS entities, coalesce(bool_and(len(candidates) = 0) FILTER (WHERE type IN ({_CODED})), false) AS all_uncoded FROM ent GROUP BY doc_id)
SELECT d.doc_id, coalesce(entities, 0) AS entities, coalesce(all_uncoded, false) AS all_uncoded FROM documents AS d LEFT JOIN s ON s.doc_id = d.doc_id WHERE coalesce(entities, 0) = 0 OR all_uncoded
""")  # fmt: skip
def sanity_files(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.sanity(D.docs(spark, sf), entities(spark, sf)).select("doc_id", "entities", "all_uncoded")


@query("risk_reasons", f"""
WITH {ENTITIES_SQL}, r AS (SELECT list_filter([CASE WHEN type IN ({_CODED}) AND len(candidates) = 0 THEN 'no_code' END, CASE WHEN len(candidates) > 1 THEN 'several_codes' END,
  CASE WHEN length(trim(text)) <= 2 THEN 'short_text' END, CASE WHEN len(assertions) > 1 THEN 'several_assertions' END], lambda x: x IS NOT NULL) AS reasons, type FROM ent)
SELECT type, array_to_string(reasons, ',') AS reasons, CAST(len(reasons) AS INTEGER) AS reasons_n, count(*) AS n FROM r GROUP BY ALL
""")  # fmt: skip
def risk_reasons(spark: SparkSession, sf: str) -> DataFrame:
    rows = evaluation.risk_reasons(entities(spark, sf))
    return rows.groupBy("type", F.array_join("reasons", ",").alias("reasons"), "reasons_n").agg(F.count(F.lit(1)).alias("n"))


@query("ruled_entities", f"""
WITH {ENTITIES_SQL} SELECT type, array_to_string(CASE WHEN type IN ({_ASSERTED}) THEN ['isHistorical'] ELSE [] END, ',') AS assertions, count(*) AS n,
  count(*) FILTER (WHERE type IN ({_CODED})) AS coded FROM ent GROUP BY type
""")  # fmt: skip
def ruled_entities(spark: SparkSession, sf: str) -> DataFrame:
    """An assertion and a code given to every entity stay where the type allows them."""
    every = entities(spark, sf).withColumns({"assertions": F.array(F.lit("isHistorical")), "candidates": F.array(F.lit("X"))})
    return validation.ruled(every).groupBy("type", F.array_join("assertions", ",").alias("assertions")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.size("candidates") == 1).alias("coded"))


@query("entity_problems", f"""
WITH {ENTITIES_SQL}, b AS (SELECT e.*, length(d.text) AS size FROM ent AS e JOIN documents AS d ON d.doc_id = e.doc_id),
p AS (SELECT CASE WHEN start % 7 = 1 THEN 'unknown type' WHEN start % 7 = 2 THEN 'bad span' WHEN start % 7 = 3 THEN 'text differs from its span'
  WHEN start % 7 = 4 THEN 'unknown assertion' WHEN start % 7 = 5 AND type = '{lex.LAB_NAME}' THEN 'assertions on this type' WHEN start % 7 = 6 AND type NOT IN ({_CODED}) THEN 'codes on this type' END AS problem FROM b)
SELECT problem, count(*) AS n FROM p WHERE problem IS NOT NULL GROUP BY problem
""")  # fmt: skip
def entity_problems(spark: SparkSession, sf: str) -> DataFrame:
    """Entities that are broken in a way told by their place, and what the validator says of them."""
    m = F.col("start") % 7
    broken = entities(spark, sf).withColumns({
        "m": m, "type": F.when(m == 1, "odd").otherwise(F.col("type")), "text": F.when(m == 3, F.concat("text", F.lit("."))).otherwise(F.col("text")),
        "assertions": F.when(m == 4, F.array(F.lit("odd"))).when(m == 5, F.array(F.lit("isFamily"))).otherwise(F.col("assertions")),
        "candidates": F.when(m == 6, F.array(F.lit("X"))).otherwise(F.col("candidates")),
    })
    broken = broken.withColumn("end", F.when(F.col("m") == 2, F.col("start") - 1).otherwise(F.col("end")))
    return validation.entity_problems(broken, D.docs(spark, sf)).groupBy("problem").agg(F.count(F.lit(1)).alias("n"))


@query("missing_outputs", f"""
WITH {ENTITIES_SQL}, o AS (SELECT DISTINCT doc_id FROM ent UNION SELECT -1)
SELECT doc_id, 'no output' AS side FROM (SELECT DISTINCT doc_id FROM documents) AS d WHERE doc_id NOT IN (SELECT doc_id FROM o)
UNION ALL SELECT doc_id, 'no input' FROM o WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE doc_id IS NOT NULL)
""")  # fmt: skip
def missing_outputs(spark: SparkSession, sf: str) -> DataFrame:
    """Documents without a mention, and an output of no document."""
    outputs = entities(spark, sf).select("doc_id").union(spark.range(1).select(F.lit(-1).cast("long")))
    return validation.missing_outputs(D.docs(spark, sf), outputs)


@query("spans_unchanged", f"""
WITH {ENTITIES_SQL} SELECT doc_id, start, "end", type, text FROM ent WHERE start % 9 = 4
""")
def spans_unchanged(spark: SparkSession, sf: str) -> DataFrame:
    """Spans of which a later table has moved some by one."""
    before = entities(spark, sf)
    moved = (F.col("start") % 9 == 4).cast("int")
    after = before.withColumns({"start": F.col("start") + moved, "end": F.col("end") + moved})
    return validation.spans_unchanged(before, after)


@query("entity_lists", f"""
WITH {ENTITIES_SQL}, l AS (SELECT doc_id, md5(string_agg(text || '@' || start || '-' || "end" || '/' || type || '/' || array_to_string(assertions, '+') || '/' || array_to_string(candidates, '+'), '|' ORDER BY start, "end", type)) AS listed, count(*) AS n FROM ent GROUP BY doc_id)
SELECT d.doc_id, coalesce(listed, md5('')) AS listed, CAST(coalesce(n, 0) AS INTEGER) AS n FROM documents AS d LEFT JOIN l ON l.doc_id = d.doc_id
""")  # fmt: skip
def entity_lists(spark: SparkSession, sf: str) -> DataFrame:
    """The entity list of every document as a file would have it, in order, as one digest."""
    rows = sinks.entity_lists(D.docs(spark, sf), entities(spark, sf))
    own = F.transform(
        "entities", lambda e: F.concat(e["text"], F.lit("@"), e["position"][0].cast("string"), F.lit("-"), e["position"][1].cast("string"), F.lit("/"), e["type"], F.lit("/"), F.array_join(e["assertions"], "+"), F.lit("/"), F.array_join(e["candidates"], "+"))
    )
    return rows.select("doc_id", F.md5(F.array_join(own, "|").cast("binary")).alias("listed"), F.size("entities").alias("n"))


@query("review_gold", f"""
WITH {ENTITIES_SQL}, c AS (SELECT doc_id, count(*) AS n FROM ent GROUP BY doc_id),
r AS (SELECT d.doc_id, coalesce(n, 0) AS n, length(d.text) AS size FROM documents AS d LEFT JOIN c ON c.doc_id = d.doc_id)
SELECT doc_id || '.txt' AS file_name, CAST(CASE WHEN size % 3 = 0 THEN 0 ELSE n END AS INTEGER) AS n FROM r WHERE doc_id BETWEEN 10 AND 500
""")  # fmt: skip
def review_gold(spark: SparkSession, sf: str) -> DataFrame:
    """Gold of reviews: an empty gold list counts, a missing one gives way to the prediction; files of a range of numbers."""
    rows = sinks.review_rows(D.docs(spark, sf), entities(spark, sf))
    rows = rows.withColumn("gold_entities", F.when(F.length("text") % 3 == 0, F.filter("predicted_entities", lambda e: F.lit(False))))
    return sinks.numbered_range(sinks.gold_of_reviews(rows), "file_name", 10, 500).select("file_name", F.size("entities").alias("n"))


@query("review_subset", f"""
WITH {ENTITIES_SQL}, {_STATS_SQL}, r AS (SELECT doc_id, entities, row_number() OVER (ORDER BY unmatched DESC, assertions DESC, diversity DESC, entities DESC, doc_id) AS rank FROM stats)
SELECT doc_id || '.txt' AS file_name, CAST(entities AS INTEGER) AS n FROM r WHERE rank <= 20
""")  # fmt: skip
def review_subset(spark: SparkSession, sf: str) -> DataFrame:
    """Review rows of the first twenty files (the limit is the feature)."""
    docs, ent = D.docs(spark, sf), entities(spark, sf)
    chosen = sinks.selected_reviews(sinks.review_rows(docs, ent, seed_gold=True), evaluation.review_rank(evaluation.review_stats(docs, ent)), 20)
    return chosen.select("file_name", F.size("gold_entities").alias("n"))


@query("ner_training_rows", f"""
WITH {ENTITIES_SQL}, c AS (SELECT doc_id, string_agg(start || '-' || "end" || '/' || type, '|' ORDER BY start, "end", type) AS spans FROM ent GROUP BY doc_id)
SELECT md5(d.text) AS text, md5(coalesce(c.spans, '')) AS spans, count(*) AS n FROM documents AS d LEFT JOIN c ON c.doc_id = d.doc_id GROUP BY 1, 2
""")  # fmt: skip
def ner_training_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = sinks.ner_rows(D.docs(spark, sf), entities(spark, sf))
    own = F.transform("entities", lambda e: F.concat(e["position"][0].cast("string"), F.lit("-"), e["position"][1].cast("string"), F.lit("/"), e["type"]))
    return rows.groupBy(F.md5(F.col("text").cast("binary")).alias("text"), F.md5(F.array_join(own, "|").cast("binary")).alias("spans")).agg(F.count(F.lit(1)).alias("n"))


@query("entity_scores", f"""
WITH {ENTITIES_SQL}, g AS (SELECT * FROM ent), p AS (SELECT doc_id, start, "end", type, text, assertions, CASE WHEN start % 4 = 1 THEN [] ELSE candidates END AS candidates FROM ent WHERE start % 10 <> 7),
k AS (
  SELECT 'entity_span' AS metric, doc_id || ':' || start || ':' || "end" AS key, 1 AS g, 0 AS p FROM g UNION SELECT 'entity_span', doc_id || ':' || start || ':' || "end", 0, 1 FROM p
  UNION SELECT 'entity_span_type', doc_id || ':' || start || ':' || "end" || type, 1, 0 FROM g UNION SELECT 'entity_span_type', doc_id || ':' || start || ':' || "end" || type, 0, 1 FROM p
  UNION SELECT 'entity_record', doc_id || ':' || start || ':' || "end" || type || text || array_to_string(list_sort(assertions), '|') || '#' || array_to_string(candidates, '|'), 1, 0 FROM g
  UNION SELECT 'entity_record', doc_id || ':' || start || ':' || "end" || type || text || array_to_string(list_sort(assertions), '|') || '#' || array_to_string(candidates, '|'), 0, 1 FROM p
  UNION SELECT 'assertions', doc_id || ':' || start || ':' || "end" || type || unnest(assertions), 1, 0 FROM g WHERE type IN ({_ASSERTED}) UNION SELECT 'assertions', doc_id || ':' || start || ':' || "end" || type || unnest(assertions), 0, 1 FROM p WHERE type IN ({_ASSERTED})
  UNION SELECT 'candidates', doc_id || ':' || start || ':' || "end" || type || unnest(candidates), 1, 0 FROM g WHERE type IN ({_CODED}) UNION SELECT 'candidates', doc_id || ':' || start || ':' || "end" || type || unnest(candidates), 0, 1 FROM p WHERE type IN ({_CODED})),
sides AS (SELECT metric, key, max(g) AS g, max(p) AS p FROM k GROUP BY metric, key),
c AS (SELECT metric, count(*) FILTER (WHERE g = 1 AND p = 1) AS tp, count(*) FILTER (WHERE g = 0) AS fp, count(*) FILTER (WHERE p = 0) AS fn FROM sides GROUP BY metric)
SELECT metric, tp, fp, fn, coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall, coalesce((2 * tp) / nullif(2 * tp + fp + fn, 0), 0.0) AS f1 FROM c
""")  # fmt: skip
def entity_scores(spark: SparkSession, sf: str) -> DataFrame:
    """The five metrics of a prediction that lacks some spans and some codes."""
    gold, none = entities(spark, sf), F.array().cast("array<string>")
    predicted = gold.where("start % 10 <> 7").withColumn("candidates", F.when(F.col("start") % 4 == 1, none).otherwise(F.col("candidates")))
    return evaluation.evaluate_entities(gold, predicted)


@query("zipped_entities", f"""
WITH {ENTITIES_SQL}, p AS (SELECT *, CASE WHEN start % 4 = 1 THEN [] WHEN start % 4 = 2 AND len(candidates) = 0 THEN ['Y'] ELSE candidates END AS guessed FROM ent)
SELECT type, count(*) AS n, count(*) AS same_type, count(*) AS same_assertions, count(*) FILTER (WHERE candidates = guessed) AS same_codes,
  count(*) FILTER (WHERE len(candidates) > 0 AND len(guessed) = 0) AS lost, count(*) FILTER (WHERE len(candidates) = 0 AND len(guessed) > 0) AS spurious FROM p GROUP BY type
""")  # fmt: skip
def zipped_entities(spark: SparkSession, sf: str) -> DataFrame:
    """Gold and predicted entities side by side by their place in the document."""
    gold, none, at = entities(spark, sf), F.array().cast("array<string>"), F.col("start") % 4
    guessed = F.when(at == 1, none).when((at == 2) & (F.size("candidates") == 0), F.array(F.lit("Y"))).otherwise(F.col("candidates"))
    pairs = evaluation.zip_positions(gold, gold.withColumn("candidates", guessed), "doc_id", ["start", "end", "type"], ["type", "assertions", "candidates"])
    return evaluation.subset_report(pairs)


@query("deduplicated_entities", f"""
WITH {ENTITIES_SQL}, x AS (SELECT doc_id, start, "end", type, text FROM ent UNION SELECT doc_id, start, CAST("end" - 1 AS INTEGER), type, substr(text, 1, length(text) - 1) FROM ent WHERE length(text) > 3)
SELECT doc_id, start, "end", type, text FROM x AS a WHERE type = '{lex.SYMPTOM}' OR NOT EXISTS (
  SELECT 1 FROM x AS b WHERE b.doc_id = a.doc_id AND b.type = a.type AND b.start <= a.start AND b."end" >= a."end" AND (b.start < a.start OR b."end" > a."end"))
""")  # fmt: skip
def deduplicated_entities(spark: SparkSession, sf: str) -> DataFrame:
    """Every entity twice and once cut short: one of equals stays, nested ones only of the type that may nest."""
    own = entities(spark, sf).select("doc_id", "start", "end", "type", "text")
    short = own.where("length(text) > 3").select("doc_id", "start", F.col("end") - 1, "type", F.expr("substring(text, 1, length(text) - 1)"))
    return spans.deduplicate(own.union(own).union(short), [F.col("text")], keep_nested=lex.SYMPTOM)


@query("result_relations", f"""
WITH {ENTITIES_SQL}, v AS (SELECT doc_id, start, "end", CASE type WHEN '{lex.SYMPTOM}' THEN '{lex.LAB_VALUE}' WHEN '{lex.DRUG}' THEN '{lex.LAB_NAME}' ELSE type END AS type, text FROM ent),
x AS (SELECT a.doc_id, a.start AS a, a.text AS source_text, b.text AS target_text, row_number() OVER (PARTITION BY a.doc_id, a.start, a."end", a.type ORDER BY b.start, b."end", b.type) AS r, b.start - a."end" AS gap
  FROM v AS a JOIN v AS b ON b.doc_id = a.doc_id AND (b.start, b."end", b.type) > (a.start, a."end", a.type) AND b.type = '{lex.LAB_VALUE}' WHERE a.type = '{lex.LAB_NAME}')
SELECT doc_id, source_text, target_text, count(*) AS n FROM x WHERE r = 1 AND gap <= 12 GROUP BY ALL
""")  # fmt: skip
def result_relations(spark: SparkSession, sf: str) -> DataFrame:
    """Articles as names and words as values: each name's next value within twelve characters."""
    t = F.col("type")
    rows = entities(spark, sf).withColumn("type", F.when(t == lex.SYMPTOM, lex.LAB_VALUE).when(t == lex.DRUG, lex.LAB_NAME).otherwise(t))
    return graph.lab_relations(rows).groupBy("doc_id", "source_text", "target_text").agg(F.count(F.lit(1)).alias("n"))


@query("judged_codes", f"""
WITH p AS (SELECT p_partkey AS id, CASE p_size % 3 WHEN 0 THEN '{lex.DRUG}' WHEN 1 THEN '{lex.DIAGNOSIS}' ELSE '{lex.SYMPTOM}' END AS type, p_size % 2 = 0 AS multi, p_retailprice / 1500 AS s1, p_retailprice / 1500 - (p_size % 10) / 40 AS s2,
  ['exact', 'indexed', 'embedding', 'gold'][p_size % 4 + 1] AS source, CASE p_size % 5 WHEN 0 THEN [] WHEN 1 THEN ['b'] WHEN 2 THEN ['q'] ELSE ['a', 'b'] END AS predicted, CASE WHEN p_partkey % 7 = 0 THEN ['c'] ELSE [] END AS mapped FROM part),
o AS (SELECT *, list_concat(list_filter(predicted, lambda c: c IN ('a', 'b')), mapped) AS asked FROM p),
s AS (SELECT *, list_transform(asked, lambda c, i: {{'minus': -(CASE c WHEN 'a' THEN s1 + CASE source WHEN 'exact' THEN 0.16::DOUBLE WHEN 'indexed' THEN 0.06::DOUBLE WHEN 'embedding' THEN 0.03::DOUBLE ELSE 0.0::DOUBLE END WHEN 'b' THEN s2 + 0.06::DOUBLE ELSE 0.3::DOUBLE + 0.0::DOUBLE END - 0.03::DOUBLE * (i - 1)), 'code': c}}) AS r FROM o),
z AS (SELECT *, list_sort(r) AS ranked FROM s)
SELECT id, array_to_string(CASE WHEN type = '{lex.SYMPTOM}' THEN []
  WHEN len(ranked) = 0 THEN CASE WHEN (type = '{lex.DRUG}' AND source = 'exact' AND s1 >= 0.85) OR (type = '{lex.DIAGNOSIS}' AND (s1 >= 0.95 OR (source = 'exact' AND s1 >= 0.8))) THEN ['a'] ELSE [] END
  WHEN type = '{lex.DIAGNOSIS}' AND multi AND len(ranked) > 1 AND -ranked[1].minus >= 0.95::DOUBLE AND ranked[2].minus - ranked[1].minus <= 0.12::DOUBLE THEN [ranked[1].code, ranked[2].code] ELSE [ranked[1].code] END, ',') AS codes FROM z
""")  # fmt: skip
def judged_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as mentions with a shortlist, a generator's codes and mapped ones: the codes that are kept."""
    p = spark.read.parquet(f"{sf}/part.parquet")
    item = lambda code, score, source: F.struct(F.lit(code).alias("code"), F.lit(code).alias("label"), score.alias("score"), source.alias("source"))
    price, size = F.col("p_retailprice") / 1500, F.col("p_size")
    source = F.element_at(F.array(*map(F.lit, ("exact", "indexed", "embedding", "gold"))), size % 4 + 1)
    none = F.array().cast("array<string>")
    rows = p.select(
        F.col("p_partkey").alias("id"), F.when(size % 3 == 0, lex.DRUG).when(size % 3 == 1, lex.DIAGNOSIS).otherwise(lex.SYMPTOM).alias("type"),
        F.when(size % 2 == 0, "a / b").otherwise("ab").alias("text"), F.when(F.col("p_partkey") % 7 == 0, F.array(F.lit("c: x"))).otherwise(none).alias("candidates"),
        F.when(size % 5 == 0, none).when(size % 5 == 1, F.array(F.lit("b"))).when(size % 5 == 2, F.array(F.lit("q"))).otherwise(F.array(F.lit("a"), F.lit("b"))).alias("predicted"),
        F.array(item("a", price, source), item("b", price - (size % 10) / 40, F.lit("indexed")), item("c", F.lit(0.3), F.lit("mapped"))).alias("shortlist"),
    )
    return linking.judge(rows).select("id", F.array_join("codes", ",").alias("codes"))


@query("prompt_messages", f"""
WITH {ENTITIES_SQL}, x AS (SELECT doc_id, start, "end", type, text, assertions, candidates FROM ent WHERE type IN ({_CODED}))
SELECT doc_id, start, "end", type, md5('Type: ' || type || chr(10) || 'Mention: ' || text || chr(10) || 'Position: [' || start || ', ' || "end" || ']' || chr(10) || 'Context:' || chr(10) || upper(text) || chr(10)
  || 'Assertions: ' || CASE WHEN len(assertions) > 0 THEN array_to_string(assertions, ', ') ELSE 'none' END || chr(10) || 'Shortlist:' || chr(10)
  || CASE WHEN len(candidates) = 0 THEN '- none' ELSE array_to_string(list_transform(candidates, lambda c: '- ' || c || ':  | score=0.5000 | source=gold'), chr(10)) END || chr(10) || 'Answer: {{"assertions": [...], "candidates": [...]}}') AS prompt,
  CAST(2 AS INTEGER) AS turns FROM x
""")  # fmt: skip
def prompt_messages(spark: SparkSession, sf: str) -> DataFrame:
    """The user's prompt of every coded entity, with its codes as the shortlist."""
    rows = entities(spark, sf).where(F.col("type").isin(*lex.CODED_TYPES)).withColumns({
        "mention": F.col("text"), "context": F.upper("text"),
        "shortlist": F.transform("candidates", lambda c: F.struct(c.alias("code"), F.lit("").alias("label"), F.lit(0.5).alias("score"), F.lit("gold").alias("source"))),
    })
    asked = rows.withColumn("m", datasets.messages())
    return asked.select("doc_id", "start", "end", "type", F.md5(F.col("m")[1]["content"].cast("binary")).alias("prompt"), F.size("m").alias("turns"))


@query("segment_offsets", """
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents),
o AS (SELECT doc_id, n, line, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM l)
SELECT doc_id AS root, CAST(n - 1 AS INTEGER) AS no, CAST(start AS INTEGER) AS "start", CAST(start + length(line) AS INTEGER) AS "end", true AS sound FROM o WHERE line <> ''
""")  # fmt: skip
def segment_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """Lines as segments: where each stands in its document, and its whole as a span moved there."""
    rows = D.doc_lines(spark, sf).where("line <> ''").select(F.col("doc_id").alias("root"), F.col("line_no").alias("no"), F.col("line").alias("segment"))
    texts = D.docs(spark, sf).withColumnRenamed("doc_id", "root")
    whole = rows.select("root", "no", F.lit(0).alias("start"), F.length("segment").alias("end"), F.col("segment").alias("text"))
    return spans.remapped(whole, rows, texts).select("root", "no", "start", "end", "sound")
