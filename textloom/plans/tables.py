"""Queries of text functions, knowledge bases, graphs, selection and datasets over the other tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import similarity as sim
from ..functions import text as T
from ..lexicon import clinical as lex
from ..operators import assertions, datasets, graph, kb, linking, spans, structure
from . import documents as D
from .registry import query
from .relational import PARTS_SQL, parts, table


@query("normalized_texts", r"""
WITH n AS (SELECT doc_id, text, trim(regexp_replace(translate(text, chr(160) || chr(9) || chr(8208) || chr(8209) || chr(8210) || chr(8211) || chr(8212) || chr(8722), '  ------'), '\s+', ' ', 'g')) AS n FROM documents),
c AS (SELECT doc_id, n, trim(regexp_replace(text, '\s+', ' ', 'g')) AS a, string_split(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g'), ' ') AS t, substr(text, 101, 30) AS around FROM n)
SELECT doc_id, md5(n) AS normalized, CASE WHEN length(a) BETWEEN 1 AND 80 THEN a END AS alias, md5(array_to_string(list_filter(t, lambda x: x <> ''), ' ')) AS tokens,
  trim(regexp_replace(around, '\s+', ' ', 'g')) AS near, 'x:1:2:' || coalesce(doc_id, 0) AS entity FROM c
""")
def normalized_texts(spark: SparkSession, sf: str) -> DataFrame:
    """White space and dashes, short aliases, tokens, contexts and ids of documents."""
    t = F.col("text")
    return D.docs(spark, sf).select(
        "doc_id", F.md5(T.normalize_space(t).cast("binary")).alias("normalized"), T.clean_alias(t).alias("alias"), F.md5(F.array_join(T.tokens(t), " ").cast("binary")).alias("tokens"),
        T.flat_context(t, F.lit(110), F.lit(120), 10).alias("near"), T.entity_id(F.lit("x"), F.lit(1), F.lit(2), F.col("doc_id").cast("string")).alias("entity"),
    )


@query("part_codes", rf"""
WITH p AS (SELECT p_partkey, p_name, p_type, p_brand, p_size, p_name || ' ' || p_size || ' mg' AS dosed, upper(replace(p_brand, '#', '')) AS code FROM part)
SELECT p_partkey, CASE WHEN length(code) > 3 THEN substr(code, 1, 3) || '.' || substr(code, 4) ELSE code END AS dotted, p_name AS undosed, p_name || ' and ' AS without_doses,
  p_brand || '|' || p_type AS codes, CASE WHEN p_size % 2 = 0 THEN 'isFamily,isNegated' ELSE 'isNegated' END AS known, CASE p_size % 4 WHEN 0 THEN '{lex.DRUG}' WHEN 1 THEN '{lex.SYMPTOM}' WHEN 2 THEN '{lex.DIAGNOSIS}' END AS ner,
  'A' || p_size AS answered, p_type || '|' || p_name || '|' || p_brand || ',X' AS grouped, CAST(p_size AS VARCHAR) AS number, 'mg' AS unit,
  (length(p_name || ' ' || p_type) > 48) OR len(string_split(trim(regexp_replace(lower(p_name || ' ' || p_type), '[^a-z0-9]+', ' ', 'g')), ' ')) > 8 AS too_long,
  length(p_type || p_name) BETWEEN 2 AND 96 AND p_size % 3 <> 0 AS kept FROM p
""")
def part_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Codes, doses, labels, answers and guards of texts made from parts."""
    name, size, brand = F.col("p_name"), F.col("p_size"), F.col("p_brand")
    dosed = F.concat(name, F.lit(" "), size.cast("string"), F.lit(" mg"))
    values = F.array(F.concat(brand, F.lit(": label")), F.lit(" "), brand, F.concat(F.col("p_type"), F.lit(":x:y")))
    said = F.array(F.lit("isNegated"), F.lit("odd"), F.lit("isNegated"), F.when(size % 2 == 0, "isFamily").otherwise("isnegated"))
    raw = F.element_at(F.array(*map(F.lit, ("B-drug", "I-LABEL_SYMPTOM", "CHAN_DOAN", "B-odd"))), size % 4 + 1)
    answer = F.concat(F.lit('Here: {"candidates": ["A'), size.cast("string"), F.lit(': text", null, "A'), size.cast("string"), F.lit('"], "assertions": ["odd"]} done'))
    dose = T.strength(dosed)
    body = F.concat(F.col("p_type"), F.when(size % 3 == 0, ";").otherwise(""), name)
    return table(spark, sf, "part").select(
        "p_partkey", T.dotted_code(F.replace(brand, F.lit("#"), F.lit(""))).alias("dotted"), T.strip_last_strength(dosed).alias("undosed"),
        F.concat(T.strip_strengths(F.concat(dosed, F.lit(" and"))), F.lit(" ")).alias("without_doses"), F.array_join(T.candidate_codes(values), "|").alias("codes"),
        F.array_join(T.known_assertions(said), ",").alias("known"), T.ner_label(raw).alias("ner"), F.array_join(T.parse_response(answer)["candidates"], ",").alias("answered"),
        T.group_key(F.col("p_type"), name, F.array(F.lit("X"), brand)).alias("grouped"),
        dose["number"].alias("number"), dose["unit"].alias("unit"), T.too_long_to_link(F.concat(name, F.lit(" "), F.col("p_type")), F.lit(lex.DIAGNOSIS)).alias("too_long"), T.keeps_body(body, []).alias("kept"),
    )


@query("mention_queries", r"""
SELECT p_partkey, p_name AS diagnosis, p_name AS drug FROM part
""")
def mention_queries(spark: SparkSession, sf: str) -> DataFrame:
    """Names within what mentions have around them: the queries that are left."""
    name = F.col("p_name")
    diagnosis = F.concat(F.lit("  : nghi ngờ "), name, F.lit(" điều trị lâu (chưa rõ"))
    drug = F.concat(F.lit("10 mg uống "), name, F.lit(" po bid\nnext line"))
    return table(spark, sf, "part").select("p_partkey", T.diagnosis_query(diagnosis).alias("diagnosis"), T.drug_query(drug).alias("drug"))


@query("alias_similarity", r"""
WITH x AS (SELECT DISTINCT p_name AS a, lower(p_type) || CASE WHEN p_size % 2 = 0 THEN ' ' || p_name ELSE ' ' || string_split(p_name, ' ')[1] END AS b FROM part),
t AS (SELECT *, list_distinct(string_split(a, ' ')) AS ta, list_distinct(string_split(b, ' ')) AS tb FROM x)
SELECT a, b, CASE WHEN contains(b, a) THEN 0.9 ELSE len(list_intersect(ta, tb)) / greatest(len(ta), len(tb)) END AS similarity FROM t
""")
def alias_similarity(spark: SparkSession, sf: str) -> DataFrame:
    """Names against texts that hold them or share a word with them."""
    rows = table(spark, sf, "part")
    told = F.when(F.col("p_size") % 2 == 0, F.col("p_name")).otherwise(F.split("p_name", " ")[0])
    pairs = rows.select(F.col("p_name").alias("a"), F.concat_ws(" ", F.lower("p_type"), told).alias("b")).distinct()
    return pairs.select("a", "b", sim.alias_similarity(F.col("a"), F.col("b")).alias("similarity"))


@query("best_aliases", f"""
WITH {PARTS_SQL}, a AS (SELECT code, 0 AS n, label AS alias FROM k UNION ALL SELECT code, 1, alias FROM k),
r AS (SELECT a.code, a.alias, row_number() OVER (PARTITION BY a.code ORDER BY CASE WHEN a.n = 1 THEN 1.0 WHEN contains(k.alias, a.alias) THEN 0.9 ELSE 0 END DESC, a.n) AS r FROM a JOIN k ON k.code = a.code)
SELECT code, alias FROM r WHERE r = 1
""")
def best_aliases(spark: SparkSession, sf: str) -> DataFrame:
    """Each record asked for by its alias' text: the alias that is most like it."""
    base = parts(spark, sf)
    asked = base.select(F.element_at("aliases", 1).alias("query"), "system", "code")
    return linking.best_alias(asked, base).select("code", "alias")


@query("blocked_candidates", r"""
WITH q AS (SELECT DISTINCT p_name AS query FROM part), qt AS (SELECT query, unnest(list_distinct(string_split(query, ' '))) AS token FROM q),
r AS (SELECT p_partkey, unnest(list_distinct(regexp_extract_all(lower(p_name || ' ' || lower(p_type) || ' ' || p_name), '[\p{L}\p{N}]+'))) AS token FROM part)
SELECT query, count(DISTINCT p_partkey) AS n FROM qt JOIN r ON r.token = qt.token WHERE length(r.token) >= 2 GROUP BY query
""")
def blocked_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """How many records share a token with each distinct name."""
    base = parts(spark, sf)
    found = linking.blocked(base.select(F.col("label").alias("query"), "system"), base, most=1 << 30)
    return found.groupBy("query").agg(F.count(F.lit(1)).alias("n"))


@query("selected_codes", """
WITH s AS (SELECT l_orderkey AS query, l_partkey AS code, max(1 - l_discount) AS score FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER w AS rank, max(score) OVER (PARTITION BY query) AS best, lead(score) OVER w AS second FROM s WHERE score >= 0.92::DOUBLE WINDOW w AS (PARTITION BY query ORDER BY score DESC, code)),
m AS (SELECT *, max(CASE WHEN rank = 1 THEN best - second END) OVER (PARTITION BY query) AS margin FROM r)
SELECT query, code, score, CAST(rank AS INTEGER) AS rank, round(margin, 9) AS margin FROM m WHERE score >= greatest(0.92::DOUBLE, best - 0.03::DOUBLE) AND rank <= 3
""")
def selected_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Parts of an order as scored codes: those near the best, at most three, with the margin."""
    scored = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("query"), F.col("l_partkey").alias("code")).agg(F.max(1 - F.col("l_discount")).alias("score"))
    return linking.select_codes(scored, ["query"], least=0.92, band=F.lit(0.03), k=3).select("query", "code", "score", "rank", F.round("margin", 9).alias("margin"))


@query("best_forms", """
SELECT l_orderkey AS query, l_partkey AS code, max(l_discount) AS score, CAST(arg_min(l_linenumber, (-l_discount, l_linenumber)) AS INTEGER) AS form FROM lineitem GROUP BY 1, 2
""")
def best_forms(spark: SparkSession, sf: str) -> DataFrame:
    """Lines as forms of a query: each code's best score, of equals the first form."""
    rows = table(spark, sf, "lineitem").selectExpr("l_orderkey query", "l_partkey code", "l_discount score", "l_linenumber form")
    rows = rows.groupBy("query", "code", "form").agg(F.max("score").alias("score"))
    return linking.best_per_code(rows, ["query"], "form").select("query", "code", "score", "form")


@query("concept_groups", f"""
WITH a AS (SELECT p_partkey AS n, p_type AS code, p_name AS str, ['SCD', 'IN', 'SY', 'SCDG', 'BN'][p_size % 5 + 1] AS tty FROM part),
ok AS (SELECT *, tty IN ('SCD', 'SBD', 'IN', 'PIN', 'BN') AS p FROM a WHERE tty <> 'SY'),
f AS (SELECT code, arg_min(str, n) AS first, arg_min(tty, n) AS tty, max(length(str)) FILTER (WHERE p) AS most FROM ok GROUP BY code),
b AS (SELECT ok.code, arg_max(str, n) AS str FROM ok JOIN f ON f.code = ok.code AND p AND length(str) = most GROUP BY ok.code),
l AS (SELECT f.code, tty, CASE WHEN most >= length(first) THEN b.str ELSE first END AS label FROM f LEFT JOIN b ON b.code = f.code)
SELECT l.code, l.label, l.tty, array_to_string(list_sort(list_filter((SELECT list(DISTINCT str) FROM a WHERE a.code = l.code), lambda x: x <> l.label)), '|') AS aliases FROM l
""")
def concept_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as atoms of concepts by type."""
    tty = F.element_at(F.array(*map(F.lit, ("SCD", "IN", "SY", "SCDG", "BN"))), F.col("p_size") % 5 + 1)
    atoms = table(spark, sf, "part").select(F.col("p_partkey").alias("row_no"), F.col("p_type").alias("rxcui"), tty.alias("tty"), F.col("p_name").alias("str"))
    return kb.group_concepts(atoms).select("code", "label", "tty", F.array_join("aliases", "|").alias("aliases"))


@query("ingredients", """
WITH r AS (SELECT CAST(s_nationkey AS VARCHAR) AS a, CAST(s_suppkey % 40 AS VARCHAR) AS b, ['has_ingredient', 'ingredient_of', 'has_precise_ingredient', 'isa'][s_suppkey % 4 + 1] AS rela FROM supplier),
p AS (SELECT a AS code, b AS ingredient FROM r WHERE rela LIKE 'has\\_%' ESCAPE '\\' UNION SELECT b, a FROM r WHERE rela = 'ingredient_of'), c AS (SELECT CAST(n_nationkey AS VARCHAR) AS code FROM nation)
SELECT code, array_to_string(list_sort(list(DISTINCT ingredient)), ',') AS ingredients FROM p WHERE code IN (SELECT code FROM c) AND ingredient IN (SELECT code FROM c) GROUP BY code
""")
def ingredients(spark: SparkSession, sf: str) -> DataFrame:
    """Relations between nations' keys, read in both directions, between known concepts."""
    rela = F.element_at(F.array(*map(F.lit, ("has_ingredient", "ingredient_of", "has_precise_ingredient", "isa"))), (F.col("s_suppkey") % 4 + 1).cast("int"))
    relations = table(spark, sf, "supplier").select(F.col("s_nationkey").cast("string").alias("rxcui1"), rela.alias("rela"), (F.col("s_suppkey") % 40).cast("string").alias("rxcui2"))
    concepts = table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("code"))
    return kb.ingredient_codes(concepts, relations).select("code", F.array_join("ingredient_codes", ",").alias("ingredients"))


@query("alias_seeds", """
WITH t AS (SELECT p_brand AS code, p_name AS alias FROM part UNION SELECT p_brand, p_type FROM part), ok AS (SELECT p_brand AS code FROM part GROUP BY 1 HAVING count(*) FILTER (WHERE p_size > 40) > 0)
SELECT code, array_to_string(list_sort(list(DISTINCT alias)), '|') AS aliases FROM t WHERE code IN (SELECT code FROM ok) GROUP BY code
""")
def alias_seeds(spark: SparkSession, sf: str) -> DataFrame:
    """Names as gold mentions of brands, beside the aliases that the brands have; only for brands with a large part."""
    p = table(spark, sf, "part")
    gold = p.select(F.concat(F.lit(" "), "p_name", F.lit("\n")).alias("text"), F.array("p_brand").alias("candidates"))
    base = p.groupBy(F.col("p_brand").alias("code")).agg(F.collect_set("p_type").alias("aliases"))
    allowed = p.where("p_size > 40").select(F.col("p_brand").alias("code"))
    return kb.alias_seed(gold, base, allowed).select("code", F.array_join("aliases", "|").alias("aliases"))


@query("duplicate_codes", "SELECT p_brand AS code, count(*) AS n FROM part GROUP BY 1 HAVING count(*) > 1 ORDER BY code LIMIT 20")
def duplicate_codes(spark: SparkSession, sf: str) -> DataFrame:
    """The first twenty codes that repeat (the limit is the feature)."""
    return kb.duplicate_codes(table(spark, sf, "part").select(F.col("p_brand").alias("code")))


@query("code_families", f"""
WITH {PARTS_SQL} SELECT 'icd10' AS system, string_split(code, '.')[1] AS family, code FROM k
UNION SELECT 'rxnorm', trim(regexp_replace(lower(x), '[^a-z0-9]+', ' ', 'g')), code FROM (SELECT code, unnest([label, alias]) AS x FROM k)
""")
def code_families(spark: SparkSession, sf: str) -> DataFrame:
    """Families of codes before their point, and of drugs by their aliases without doses."""
    base = parts(spark, sf)
    drugs = base.withColumns({"system": F.lit("rxnorm"), "label": F.concat("label", F.lit(" 5 mg"))})
    return graph.code_families(base.unionByName(drugs)).select("system", "family", "code")


@query("reranked_codes", """
WITH e AS (SELECT s_suppkey AS id, CASE s_suppkey % 4 WHEN 0 THEN [] WHEN 1 THEN ['A'] WHEN 2 THEN ['A', 'B'] ELSE ['B', 'C'] END AS c FROM supplier),
s AS (SELECT s_suppkey AS id, 'A' AS code, (s_suppkey % 7) / 10 AS support FROM supplier WHERE s_suppkey % 5 <> 0 UNION ALL SELECT s_suppkey, 'D', (s_suppkey % 9) / 10 FROM supplier WHERE s_suppkey % 5 <> 0),
g AS (SELECT id, unnest(c) AS code, greatest(0, 0.3::DOUBLE - 0.1::DOUBLE * (generate_subscripts(c, 1) - 1)) AS own FROM e),
b AS (SELECT coalesce(g.id, s.id) AS id, coalesce(g.code, s.code) AS code, coalesce(support, 0) + coalesce(own, 0) AS score FROM g FULL JOIN s ON s.id = g.id AND s.code = g.code),
r AS (SELECT b.*, row_number() OVER (PARTITION BY b.id ORDER BY score DESC, code) AS r, max(score) OVER (PARTITION BY b.id) AS best FROM b WHERE b.id IN (SELECT id FROM s)),
k AS (SELECT r.id, array_to_string(list(code ORDER BY r) FILTER (WHERE len(e.c) = 0 OR best >= 0.45::DOUBLE), ',') AS codes FROM r JOIN e ON e.id = r.id WHERE r.r <= 3 GROUP BY r.id)
SELECT e.id, CASE WHEN e.id IN (SELECT id FROM s) THEN coalesce(k.codes, '') ELSE array_to_string(e.c, ',') END AS codes FROM e LEFT JOIN k ON k.id = e.id
""")
def reranked_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as entities with codes, some of them with support for others."""
    key, none = F.col("s_suppkey"), F.array().cast("array<string>")
    s = table(spark, sf, "supplier")
    codes = F.when(key % 4 == 0, none).when(key % 4 == 1, F.array(F.lit("A"))).when(key % 4 == 2, F.array(F.lit("A"), F.lit("B"))).otherwise(F.array(F.lit("B"), F.lit("C")))
    support = F.explode(F.array(F.struct(F.lit("A").alias("code"), (key % 7 / 10).alias("support")), F.struct(F.lit("D").alias("code"), (key % 9 / 10).alias("support"))))
    retrieved = s.where(key % 5 != 0).select(key.alias("id"), support.alias("x")).select("id", "x.*")
    return graph.rerank(s.select(key.alias("id"), codes.alias("candidates")), retrieved, "id").select("id", F.array_join("codes", ",").alias("codes"))


@query("prefix_cues", r"""
WITH l AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS no, lower(unnest(string_split(text, chr(10)))) AS line FROM documents)
SELECT doc_id, CAST(no AS INTEGER) AS line_no, regexp_extract(line, '.* and (.*)$', 1) AS behind FROM l WHERE contains(line, ' and ')
""")
def prefix_cues(spark: SparkSession, sf: str) -> DataFrame:
    """What stands behind the last contrast of every line that has one."""
    rows = D.doc_lines(spark, sf).withColumn("low", F.lower("line")).where(F.col("low").contains(" and "))
    return rows.select("doc_id", "line_no", assertions.after_contrast(F.col("low"), [" and "]).alias("behind"))


@query("enclosing_sections", """
WITH e AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) * 10 AS a FROM events),
s AS (SELECT user_id, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) * 25 AS a FROM events),
h AS (SELECT e.event_id, s.a AS s, row_number() OVER (PARTITION BY e.event_id ORDER BY NOT (s.a <= e.a AND e.a + 12 <= s.a + 25), s.a) AS r FROM e JOIN s ON s.user_id = e.user_id AND s.a < e.a + 12 AND e.a < s.a + 25)
SELECT event_id, CAST(s // 25 AS INTEGER) AS section_no FROM h WHERE r = 1
""")
def enclosing_sections(spark: SparkSession, sf: str) -> DataFrame:
    """Spans of twelve at every tenth place, in sections of twenty-five: the first that holds it, else the first that it touches."""
    no = "row_number() over (partition by user_id order by event_id)"
    rows = table(spark, sf, "events").selectExpr("event_id", "user_id doc_id", f"cast({no} as int) n")
    own = rows.selectExpr("event_id", "doc_id", "n * 10 start", "n * 10 + 12 end")
    sections = rows.selectExpr("doc_id", "n - 1 section_no", "(n - 1) * 25 start", "n * 25 end")
    return spans.enclosing(own, sections, "event_id", "section_no").select("event_id", "section_no")


@query("held_out_rows", """
WITH r AS (SELECT c_custkey, row_number() OVER (ORDER BY sha1('13|' || c_custkey), c_custkey) AS r, count(*) OVER () AS n FROM customer)
SELECT c_custkey, CASE WHEN r <= least(greatest(1, floor(n * 0.1::DOUBLE)), n - 1) THEN 'dev' ELSE 'train' END AS split FROM r
""")
def held_out_rows(spark: SparkSession, sf: str) -> DataFrame:
    return datasets.holdout(table(spark, sf, "customer").select("c_custkey"), "c_custkey")


@query("support_pairs", """
WITH p AS (SELECT p_partkey AS id, p_brand AS type, list_distinct(string_split(p_name, ' ')) AS t, length(p_type) AS len, p_size % 3 AS code, sha1(CAST(p_partkey AS VARCHAR)) AS h FROM part),
x AS (SELECT q.id AS query_id, s.id AS support_id, len(list_intersect(q.t, s.t)) AS shared, len(s.t) AS size, q.code = s.code AS same, s.len, s.h FROM p AS q JOIN p AS s ON s.type = q.type AND s.id <> q.id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY shared DESC, size DESC, same DESC, len, h DESC) AS rank FROM x)
SELECT query_id, support_id, CAST(rank AS INTEGER) AS rank, CAST(shared AS INTEGER) AS shared FROM r WHERE rank <= 3
""")
def support_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """For every part the parts of its brand that are most like it."""
    rows = table(spark, sf, "part").selectExpr("p_partkey id", "p_brand type", "p_name mention", "p_type context", "array(cast(p_size % 3 as string)) codes")
    return datasets.support_for(rows, rows).select("query_id", "support_id", "rank", "shared")


@query("code_labels", """
WITH p AS (SELECT p_partkey, p_size, p_name FROM part), f AS (SELECT CAST(n_nationkey AS VARCHAR) AS code, n_name FROM nation)
SELECT p_partkey AS id, coalesce(a.n_name, '-') || '|' || coalesce(b.n_name, '-') AS labels, array_to_string(list_filter([CASE WHEN a.code IS NULL THEN CAST(p_size AS VARCHAR) END, CASE WHEN b.code IS NULL THEN CAST(p_size % 7 AS VARCHAR) END], lambda x: x IS NOT NULL), ',') AS unmapped
FROM p LEFT JOIN f AS a ON a.code = CAST(p_size AS VARCHAR) LEFT JOIN f AS b ON b.code = CAST(p_size % 7 AS VARCHAR)
""")
def code_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers as codes of nations: their labels in order, and those that no nation has."""
    rows = table(spark, sf, "part").selectExpr("p_partkey id", "'n' system", "array(cast(p_size as string), cast(p_size % 7 as string)) gold_candidates")
    base = table(spark, sf, "nation").selectExpr("'n' system", "cast(n_nationkey as string) code", "n_name label")
    got = datasets.code_labels(rows, base)
    return got.select("id", F.array_join(F.transform("labels", lambda r: F.coalesce(r["label"], F.lit("-"))), "|").alias("labels"), F.array_join("unmapped", ",").alias("unmapped"))


@query("doc_anchors", r"""
WITH c AS (SELECT doc_id, unnest(regexp_extract_all(replace(text, ',', ':'), '[^.;\n]+')) AS s FROM documents),
a AS (SELECT doc_id, trim(regexp_extract(trim(regexp_replace(s, '^\s+|\s+$', '', 'g')), '^([^\n:]{1,64}):', 1)) AS anchor FROM c)
SELECT doc_id, anchor, count(*) AS n FROM a WHERE anchor <> '' AND len(string_split(regexp_replace(anchor, '\s+', ' ', 'g'), ' ')) <= 8 GROUP BY ALL
""")
def doc_anchors(spark: SparkSession, sf: str) -> DataFrame:
    """Short headers before a colon at the begin of a clause; commas are read as colons."""
    docs = D.docs(spark, sf).withColumn("text", F.replace("text", F.lit(","), F.lit(":")))
    found = structure.anchors(structure.clauses(docs, structure.sections(docs, [("none", ["\x00"], [], [])]), [("none", ["\x00"], [], [])]))
    return found.groupBy("doc_id", F.col("text").alias("anchor")).agg(F.count(F.lit(1)).alias("n"))
