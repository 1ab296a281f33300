"""Queries of linking, knowledge bases, evaluation, datasets and windows over the other tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import similarity as sim
from ..functions import text as T
from ..operators import datasets, evaluation, graph, kb, linking, spans, structure
from ..session import Scratch
from ..streaming import streams
from .registry import query


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


NO = "cast(array() as array<string>)"


def parts(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as a knowledge base: brands as codes' families, names as labels, types as aliases."""
    return table(spark, sf, "part").selectExpr(
        "'icd10' system", "concat(replace(p_brand, 'Brand#', 'B'), '.', cast(p_partkey as string)) code", "p_name label", "array(concat(lower(p_type), ' ', p_name)) aliases", "cast(null as string) tty",
        "p_partkey",
    )


PARTS_SQL = """k AS (SELECT replace(p_brand, 'Brand#', 'B') || '.' || p_partkey AS code, p_name AS label, lower(p_type) || ' ' || p_name AS alias, p_partkey FROM part)"""


@query("lexical_topk", r"""
WITH q AS (SELECT DISTINCT p_name AS query FROM part), qt AS (SELECT query, unnest(list_distinct(string_split(query, ' '))) AS token FROM q),
st AS (SELECT s_suppkey, s_name, unnest(list_distinct(regexp_extract_all(lower(p_type || ' ' || p_name), '[\p{L}\p{N}]+'))) AS token FROM (SELECT p_partkey AS s_suppkey, p_type AS s_name, p_type, p_name FROM part)),
s AS (SELECT qt.query, st.s_suppkey AS p_partkey, count(*) AS shared FROM qt JOIN st ON st.token = qt.token GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY shared DESC, p_partkey) AS rank FROM s)
SELECT query, p_partkey, shared, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5
""")
def lexical_topk(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "part").select("p_partkey", "p_name", F.concat_ws(" ", "p_type", "p_name").alias("searchable"))
    tokens = rows.select("p_name").distinct().select(F.col("p_name").alias("query"), F.explode(T.token_set(F.col("p_name"))).alias("token"))
    index = rows.select("p_partkey", F.explode(T.token_set(F.col("searchable"))).alias("token"))
    shared = tokens.join(index, "token").groupBy("query", "p_partkey").agg(F.count(F.lit(1)).alias("shared"))
    ranked = shared.selectExpr("query", "p_partkey", "shared", "cast(row_number() over (partition by query order by shared desc, p_partkey) as int) rank")
    return ranked.where("rank <= 5")


@query("ngram_cosine_topk", """
WITH n AS (SELECT DISTINCT p_name AS t FROM part), g AS (
  SELECT t, unnest(list_concat(list_transform(string_split(t, ' '), lambda w: 'w:' || w),
    list_transform(range(1, length(t) - 1), lambda i: '3:' || substr(replace(t, ' ', '_'), i, 3)),
    list_transform(range(1, length(t) - 2), lambda i: '4:' || substr(replace(t, ' ', '_'), i, 4)),
    list_transform(range(1, length(t) - 3), lambda i: '5:' || substr(replace(t, ' ', '_'), i, 5)))) AS f FROM n),
v AS (SELECT t, f, count(*) AS c FROM g GROUP BY t, f), z AS (SELECT t, sqrt(sum(c * c)) AS norm FROM v GROUP BY t),
p AS (SELECT a.t AS l, b.t AS r, sum(a.c * b.c) AS xy FROM v AS a JOIN v AS b ON a.f = b.f AND a.t <> b.t GROUP BY 1, 2),
s AS (SELECT l, r, round(xy / (x.norm * y.norm), 9) AS cosine FROM p JOIN z AS x ON x.t = l JOIN z AS y ON y.t = r)
SELECT l, r, cosine FROM (SELECT *, row_number() OVER (PARTITION BY l ORDER BY cosine DESC, r) AS k FROM s) WHERE k <= 3
""")
def ngram_cosine_topk(spark: SparkSession, sf: str) -> DataFrame:
    names = table(spark, sf, "part").select(F.col("p_name").alias("t")).distinct()
    token = names.select("t", F.explode(sim.ngram_features(F.col("t"))).alias("f")).distinct()
    other = token.toDF("r", "f")
    pairs = token.join(other, "f").where("t <> r").select(F.col("t").alias("l"), "r").distinct()
    scored = linking.ngram_cosine(pairs, "l", "r").withColumn("cosine", F.round("cosine", 9))
    return scored.selectExpr("l", "r", "cosine", "row_number() over (partition by l order by cosine desc, r) k").where("k <= 3").drop("k")


@query("dense_cosine_topk", """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e) / (sqrt(list_dot_product(q.e, q.e)) * sqrt(list_dot_product(c.e, c.e))) AS cosine FROM v AS q JOIN v AS c ON q.vec_id % 50 = 0)
SELECT query_id, vec_id, round(cosine, 9) AS cosine, CAST(k AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, vec_id) AS k FROM s) WHERE k <= 5
""")  # fmt: skip
def dense_cosine_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The vectors whose id is divisible by 50 (the query set of searches) against every vector."""
    rows = table(spark, sf, "embeddings")
    queries = rows.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query"), F.col("embedding").alias("vector"))
    found = linking.embedding_top(queries, rows.select(F.col("vec_id").alias("code"), F.col("embedding").alias("vector")), k=5, bare=True)
    return found.select(F.col("query").alias("query_id"), F.col("code").alias("vec_id"), F.round("cosine", 9).alias("cosine"), "rank")


@query("fuzzy_ratio_topk")
def fuzzy_ratio_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct part names by sequence ratio, blocked by shared tokens; tested against difflib."""
    names = table(spark, sf, "part").select(F.col("p_name").alias("a")).distinct()
    tokens = names.select("a", F.explode(T.token_set(F.col("a"))).alias("token"))
    pairs = tokens.join(tokens.withColumnRenamed("a", "b"), "token").where("a <> b").select("a", "b").distinct()
    scored = pairs.withColumn("ratio", sim.sequence_ratio("a", "b"))
    return scored.selectExpr("a", "b", "ratio", "row_number() over (partition by a order by ratio desc, b) rank").where("rank <= 3")


@query("exact_alias_link", f"""
WITH {PARTS_SQL}, q AS (SELECT DISTINCT upper(label) || ' !' AS query, label FROM k),
h AS (SELECT q.query, k.code FROM q JOIN k ON k.label = q.label OR k.alias = q.label GROUP BY 1, 2)
SELECT query, code, CAST(row_number() OVER (PARTITION BY query ORDER BY code) AS INTEGER) AS rank FROM h
""")
def exact_alias_link(spark: SparkSession, sf: str) -> DataFrame:
    """Names in other letter case and with signs, by folded keys."""
    base = parts(spark, sf)
    queries = base.selectExpr("concat(upper(label), ' !') query", "system").distinct()
    return linking.exact_codes(queries, base).select("query", "code", "rank")


@query("kb_link")
def kb_link(spark: SparkSession, sf: str) -> DataFrame:
    """Misspelt part names linked by blocking, lexical, n-gram and context scores; tested on a small knowledge base."""
    base = parts(spark, sf).drop("p_partkey")
    asked = base.selectExpr("'CHẨN_ĐOÁN' type", "concat(substring(label, 1, length(label) - 1), 'x') text", "'general' clause_kind").distinct()
    return linking.link(asked, base, cut=Scratch(spark, "kb-link").cut).select("text", F.array_join("candidates", ",").alias("codes"), F.round("confidence", 6).alias("confidence"), "mode")


@query("kb_shortlist")
def kb_shortlist(spark: SparkSession, sf: str) -> DataFrame:
    base = parts(spark, sf).drop("p_partkey")
    return linking.shortlist(base.selectExpr("label query", "system").distinct(), base, k=3).select("query", "rank", "code", F.round("score", 6).alias("score"), "source", "matched_alias")


@query("kb_merge", """
WITH b AS (SELECT p_brand AS code, arg_min(p_name, p_partkey) AS label, list(DISTINCT p_name) AS names FROM part WHERE p_size <= 25 GROUP BY p_brand),
s AS (SELECT p_brand AS code, arg_min(p_name, p_partkey) AS label, list(DISTINCT p_name) AS names FROM part WHERE p_size > 25 GROUP BY p_brand)
SELECT coalesce(b.code, s.code) AS code, coalesce(b.label, s.label) AS label,
  array_to_string(list_sort(list_filter(list_distinct(list_concat(coalesce(b.names, []), coalesce(s.names, []))), lambda x: x <> coalesce(b.label, s.label))), '|') AS aliases
FROM b FULL JOIN s ON b.code = s.code
""")
def kb_merge(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "part").selectExpr("p_partkey row_no", "p_brand code", "p_name label", "p_size")
    base, seed = kb.group_rows(rows.where("p_size <= 25")), kb.group_rows(rows.where("p_size > 25"))
    return kb.merge_seed(base, seed).select("code", "label", F.array_join("aliases", "|").alias("aliases"))


@query("kb_audit", """
WITH k AS (SELECT p_brand AS code, p_name AS label, [p_type, p_name] AS aliases FROM part)
SELECT count(*) AS records, count(DISTINCT code) AS codes, CAST(sum(len(aliases)) AS BIGINT) AS aliases, round(avg(len(aliases)), 4) AS aliases_avg,
  round(avg(CASE WHEN regexp_matches(code, '[0-9]') THEN 1.0 ELSE 0.0 END), 4) AS digit_codes, count(*) FILTER (WHERE trim(code) = '' OR trim(label) = '' OR code IS NULL OR label IS NULL) AS invalid,
  (SELECT count(*) FROM (SELECT code FROM k GROUP BY code HAVING count(*) > 1)) AS duplicates FROM k
""")
def kb_audit(spark: SparkSession, sf: str) -> DataFrame:
    return kb.audit(table(spark, sf, "part").selectExpr("p_brand code", "p_name label", "array(p_type, p_name) aliases"))


@query("sibling_neighbors", """
WITH k AS (SELECT DISTINCT p_brand AS family, p_partkey AS code FROM part)
SELECT code, neighbor, CAST(r AS INTEGER) AS rank FROM (
  SELECT a.code, b.code AS neighbor, row_number() OVER (PARTITION BY a.code ORDER BY b.code) AS r FROM k AS a JOIN k AS b ON a.family = b.family AND a.code <> b.code) WHERE r <= 16
""")
def sibling_neighbors(spark: SparkSession, sf: str) -> DataFrame:
    return graph.siblings(table(spark, sf, "part").selectExpr("p_brand family", "p_partkey code")).select("code", "neighbor", "rank")


#: A document counts as predicted toxic if it says one of these.
GUESS = "text rlike '(?i)idiot|clown|trash|scum|moron'"


def guesses(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    labelled = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    return labelled.where("toxic = 1").select("doc_id", "lang"), labelled.where(GUESS).select("doc_id", "lang")


@query("prf_micro", """
WITH l AS (SELECT d.doc_id, d.lang, toxic, regexp_matches(lower(text), 'idiot|clown|trash|scum|moron') AS said FROM documents AS d JOIN labels AS l ON l.doc_id = d.doc_id),
c AS (SELECT 'document' AS metric, count(DISTINCT doc_id) FILTER (WHERE toxic = 1 AND said) AS tp, count(DISTINCT doc_id) FILTER (WHERE toxic <> 1 AND said) AS fp, count(DISTINCT doc_id) FILTER (WHERE toxic = 1 AND NOT said) AS fn FROM l
  UNION ALL SELECT 'language', count(*) FILTER (WHERE t AND s), count(*) FILTER (WHERE NOT t AND s), count(*) FILTER (WHERE t AND NOT s) FROM (SELECT lang, bool_or(toxic = 1) AS t, bool_or(said) AS s FROM l GROUP BY lang))
SELECT metric, tp, fp, fn, coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall, coalesce((2 * tp) / nullif(2 * tp + fp + fn, 0), 0.0) AS f1 FROM c
""")  # fmt: skip
def prf_micro(spark: SparkSession, sf: str) -> DataFrame:
    gold, predicted = guesses(spark, sf)
    return evaluation.prf(gold, predicted, {"document": ["doc_id"], "language": ["lang"]})


@query("review_rank", """
WITH s AS (SELECT d.source AS doc_id, count(*) AS entities, count(*) FILTER (WHERE l.doc_id IS NULL) AS unmatched, count(*) FILTER (WHERE l.toxic = 1) AS assertions, count(DISTINCT CASE WHEN l.doc_id IS NULL THEN 'CHẨN_ĐOÁN' ELSE d.lang END) AS diversity
  FROM documents AS d LEFT JOIN labels AS l ON l.doc_id = d.doc_id GROUP BY d.source)
SELECT doc_id, entities, unmatched, assertions, diversity, CAST(row_number() OVER (ORDER BY unmatched DESC, assertions DESC, diversity DESC, entities DESC, doc_id) AS INTEGER) AS rank FROM s
""")  # fmt: skip
def review_rank(spark: SparkSession, sf: str) -> DataFrame:
    """Sources as files, their documents as entities: without a label is without a code, toxic is an assertion."""
    rows = table(spark, sf, "documents").select("doc_id", "source", "lang").join(table(spark, sf, "labels").select(F.col("doc_id").alias("l"), "toxic"), F.col("doc_id") == F.col("l"), "left")
    ent = rows.selectExpr("source doc_id", "if(l is null, 'CHẨN_ĐOÁN', lang) type", f"if(l is null, {NO}, array('x')) candidates", f"if(toxic = 1, array('isNegated'), {NO}) assertions")
    return evaluation.review_rank(evaluation.review_stats(rows.selectExpr("source doc_id"), ent)).drop("score")


@query("compare_outputs", """
WITH a AS (SELECT doc_id, lang AS type, CASE WHEN regexp_matches(lower(text), 'idiot|clown') THEN 1 ELSE 0 END AS n FROM documents),
b AS (SELECT doc_id, lang AS type, CASE WHEN regexp_matches(lower(text), 'idiot') THEN 1 ELSE 0 END + CASE WHEN regexp_matches(lower(text), 'license') THEN 1 ELSE 0 END AS n, regexp_matches(lower(text), 'idiot') AS i FROM documents WHERE NOT regexp_matches(lower(text), 'scum')),
c AS (SELECT a.type, CASE WHEN b.doc_id IS NULL THEN 'missing' WHEN a.n = 0 AND b.n = 0 THEN 'same' WHEN a.n = 1 AND b.n = 1 AND b.i THEN 'same' WHEN a.n > 0 AND b.n = 0 THEN 'emptied' WHEN a.n = 0 AND b.n > 0 THEN 'filled' WHEN b.n > a.n THEN 'grew' ELSE 'changed' END AS change
  FROM a LEFT JOIN b ON b.doc_id = a.doc_id)
SELECT type, change, count(*) AS n FROM c GROUP BY type, change
""")  # fmt: skip
def compare_outputs(spark: SparkSession, sf: str) -> DataFrame:
    """Two variants of codes of documents; the second has none of those that say a word."""
    rows = table(spark, sf, "documents")
    base = rows.selectExpr("doc_id", "lang type", f"if(lower(text) rlike 'idiot|clown', array('insult'), {NO}) candidates")
    one, two = f"if(lower(text) rlike 'idiot', array('insult'), {NO})", f"if(lower(text) rlike 'license', array('license'), {NO})"
    changed = rows.where("not lower(text) rlike 'scum'").selectExpr("doc_id", "lang type", f"concat({one}, {two}) candidates")
    return evaluation.comparison_report(evaluation.compare(base, changed, ["doc_id", "type"]))


@query("group_split", """
WITH g AS (SELECT DISTINCT source FROM documents), r AS (SELECT source, row_number() OVER (ORDER BY sha1('13|' || source), source) AS r, count(*) OVER () AS n FROM g),
s AS (SELECT source, CASE WHEN r <= n - dev - test THEN 'train' WHEN r <= n - test THEN 'dev' ELSE 'test' END AS split FROM (SELECT *, CASE WHEN n >= 3 THEN greatest(1, floor(n * 0.15)) ELSE 0 END AS dev, CASE WHEN n >= 3 THEN greatest(1, floor(n * 0.15)) ELSE 0 END AS test FROM r))
SELECT d.doc_id, s.split FROM documents AS d JOIN s ON s.source = d.source
""")  # fmt: skip
def group_split(spark: SparkSession, sf: str) -> DataFrame:
    return datasets.group_split(table(spark, sf, "documents").select("doc_id", "source"), "source").select("doc_id", "split")


@query("support_topn", """
WITH e AS (SELECT p_partkey AS id, p_type AS type, p_name AS mention, sha1(CAST(p_partkey AS VARCHAR)) AS h, len(string_split(p_name, ' ')) AS k FROM part),
f AS (SELECT *, row_number() OVER (PARTITION BY type, mention ORDER BY k DESC, h DESC) AS n FROM e),
r AS (SELECT type, id, row_number() OVER (PARTITION BY type ORDER BY k DESC, h DESC) AS rank FROM f WHERE n = 1)
SELECT type, id, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5
""")
def support_topn(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "part").selectExpr("p_partkey id", "p_type type", "p_name mention", "array('x') codes")
    return datasets.support_examples(rows).select("type", "id", "rank")


@query("chat_messages", """
SELECT conv_id, count(*) AS turns, md5(string_agg(role || ': ' || text, chr(10) ORDER BY turn)) AS rendered FROM conversations GROUP BY conv_id
""")
def chat_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Messages of a conversation in order, as one text."""
    rows = table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("m"))
    lines = F.transform("m", lambda m: F.concat(m["role"], F.lit(": "), m["text"]))
    return rows.select("conv_id", F.size("m").cast("long").alias("turns"), F.md5(F.array_join(lines, "\n").cast("binary")).alias("rendered"))


@query("next_value_link", """
WITH e AS (SELECT user_id, event_id, ts, event_type, value FROM events),
x AS (SELECT a.event_id, b.event_id AS next_id, b.value, row_number() OVER (PARTITION BY a.event_id ORDER BY b.ts, b.event_id) AS r, date_diff('microsecond', a.ts, b.ts) AS gap
  FROM e AS a JOIN e AS b ON b.user_id = a.user_id AND (b.ts, b.event_id) > (a.ts, a.event_id) AND b.event_type = 'purchase' WHERE a.event_type = 'click')
SELECT event_id, next_id, value FROM x WHERE r = 1 AND gap <= 86400000000
""")
def next_value_link(spark: SparkSession, sf: str) -> DataFrame:
    """Each click's next purchase of the user within a day, in one window pass."""
    rows = table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    near = F.coalesce(F.col("next.ts") <= F.col("ts") + F.expr("interval 1 day"), F.lit(False))
    found = spans.next_within(rows, "user_id", [F.col("ts"), F.col("event_id")], F.col("event_type") == "click", F.col("event_type") == "purchase", near, F.struct("event_id", "ts", "value"))
    return found.select("event_id", F.col("next.event_id").alias("next_id"), F.col("next.value").alias("value"))


@query("latest_section_state", """
SELECT event_id, last_value(CASE WHEN event_type IN ('error', 'purchase') THEN event_type END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS state FROM events
""")
def latest_section_state(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").withColumn("at", F.struct("ts", "event_id"))
    event = F.when(F.col("event_type").isin("error", "purchase"), F.col("event_type"))
    return structure.with_state(rows, event, "user_id", "at").select("event_id", "state")


@query("event_windows", """
SELECT event_type, time_bucket(INTERVAL '1 hour', ts) AS window_start, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2
""")
def event_windows(spark: SparkSession, sf: str) -> DataFrame:
    return streams.windowed_counts(table(spark, sf, "events")).withColumns({"total": F.round("total", 4), "window_start": F.col("window_start").cast("timestamp_ntz")})


@query("event_sessions", """
WITH g AS (SELECT user_id, ts, CASE WHEN date_diff('microsecond', lag(ts) OVER w, ts) < 1800000000 THEN 0 ELSE 1 END AS first FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT user_id, ts, sum(first) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s FROM g)
SELECT user_id, min(ts) AS session_start, count(*) AS n FROM s GROUP BY user_id, s
""")
def event_sessions(spark: SparkSession, sf: str) -> DataFrame:
    return streams.sessions(table(spark, sf, "events")).withColumn("session_start", F.col("session_start").cast("timestamp_ntz"))


@query("dataset_summary", """
SELECT source AS split, lang AS type, count(*) AS n FROM documents GROUP BY ROLLUP (source, lang)
""")
def dataset_summary(spark: SparkSession, sf: str) -> DataFrame:
    return datasets.bundle_summary(table(spark, sf, "documents").selectExpr("source split", "lang type"))


@query("token_metrics", """
WITH t AS (SELECT CASE l_returnflag WHEN 'N' THEN 0 WHEN 'R' THEN 1 ELSE 2 END AS gold, CASE WHEN l_quantity < 20 THEN 0 WHEN l_quantity < 35 THEN 1 ELSE 2 END AS predicted FROM lineitem),
c AS (SELECT avg(CASE WHEN gold = predicted THEN 1.0 ELSE 0.0 END) AS accuracy, count(*) FILTER (WHERE gold = predicted AND gold <> 0) AS tp, count(*) FILTER (WHERE predicted <> 0 AND gold <> predicted) AS fp, count(*) FILTER (WHERE gold <> 0 AND gold <> predicted) AS fn FROM t)
SELECT round(accuracy, 9) AS accuracy, tp, fp, fn, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall, (2 * tp) / (2 * tp + fp + fn) AS f1 FROM c
""")  # fmt: skip
def token_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Two labellings of rows as gold and predicted token labels."""
    rows = table(spark, sf, "lineitem").selectExpr("case l_returnflag when 'N' then 0 when 'R' then 1 else 2 end gold", "case when l_quantity < 20 then 0 when l_quantity < 35 then 1 else 2 end predicted")
    return evaluation.token_metrics(rows).withColumn("accuracy", F.round("accuracy", 9))
