"""Splits without leakage, support examples, prompts and dataset bundles (SPL-*, TOP-8, TOP-9, STR-27)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T


def _drawn(group: Column, seed: int) -> Column:
    return F.sha1(F.concat_ws("|", F.lit(str(seed)), group.cast("string")).cast("binary"))


def group_split(rows: DataFrame, group: str, *, seed: int = 13, shares: tuple[float, float, float] = (0.7, 0.15, 0.15)) -> DataFrame:
    """``rows`` with ``split`` (train, dev, test); all rows of a group are in one split (SPL-2, SPL-3).

    Groups are in the order of a hash; from three groups on, each split has one
    at least.  The rank is over distinct groups, not rows.
    """
    groups = rows.select(F.col(group).alias("__g")).distinct().withColumn("__h", _drawn(F.col("__g"), seed))
    ranked = _ranked(groups, "__h", "__g")
    dev, test = (F.when(F.col("__n") >= 3, F.greatest(F.lit(1), F.floor(F.col("__n") * s))).otherwise(F.lit(0)) for s in shares[1:])
    place = F.when(F.col("__r") <= F.col("__n") - dev - test, "train").when(F.col("__r") <= F.col("__n") - test, "dev").otherwise("test")
    return rows.join(ranked.select("__g", place.alias("split")), F.col(group).eqNullSafe(F.col("__g"))).drop("__g")


def holdout(rows: DataFrame, key: str, *, ratio: float = 0.1, seed: int = 13) -> DataFrame:
    """``rows`` with ``split`` (train, dev): a hash-ranked share, one row at least in each (SPL-1)."""
    ranked = _ranked(rows.withColumn("__h", _drawn(F.col(key), seed)), "__h", key)
    dev = F.least(F.greatest(F.lit(1), F.floor(F.col("__n") * ratio)), F.col("__n") - 1)
    return ranked.withColumn("split", F.when(F.col("__r") <= dev, "dev").otherwise("train")).drop("__r", "__n", "__h")


def _ranked(rows: DataFrame, digest: str, tie: str) -> DataFrame:
    """``rows`` with ``__r``, their place in the order of a hexadecimal digest, and ``__n``, their number.

    Rows are ranked within the 4,096 bands of the digest's first digits, behind
    the counts of the bands before, so that no task orders more than a band.
    """
    banded = rows.withColumn("__band", F.substring(digest, 1, 3))
    counts = banded.groupBy("__band").agg(F.count(F.lit(1)).alias("__k"))
    whole = W.partitionBy(F.lit(0))  # over the bands
    before = F.sum("__k").over(whole.orderBy("__band").rowsBetween(W.unboundedPreceding, -1))
    counts = counts.select(F.col("__band").alias("__b"), F.coalesce(before, F.lit(0)).alias("__before"), F.sum("__k").over(whole).alias("__n"))
    place = F.col("__before") + F.row_number().over(W.partitionBy("__band").orderBy(digest, tie))
    return banded.join(F.broadcast(counts), F.col("__band").eqNullSafe(F.col("__b"))).withColumn("__r", place).drop("__band", "__b", "__before")


def support_examples(examples: DataFrame, most: int = 5) -> DataFrame:
    """Per type the first examples by (codes, tokens, sha1 of id), all descending, one of each group (TOP-8).

    ``examples`` has id, type, mention, codes.
    """
    ranked = examples.withColumns({"n_codes": F.size("codes"), "n_tokens": F.size(T.tokens(F.col("mention"))), "h": F.sha1(F.col("id").cast("string").cast("binary")), "group": T.group_key(F.col("type"), F.col("mention"), F.col("codes"))})
    order = [F.desc("n_codes"), F.desc("n_tokens"), F.desc("h")]
    single = ranked.withColumn("__n", F.row_number().over(W.partitionBy("type", "group").orderBy(*order))).where("__n = 1")
    return single.withColumn("rank", F.row_number().over(W.partitionBy("type").orderBy(*order))).where(F.col("rank") <= most).drop("__n")


def support_for(queries: DataFrame, pool: DataFrame, k: int = 3) -> DataFrame:
    """query_id, rank, support_id: the pool's examples of the query's type with most shared tokens (TOP-9, STR-28).

    Both have id, type, mention, context and codes.  Rows of equal type, tokens and
    codes rank alike but for their own order, so that classes are compared, not
    rows: each class of the pool stands with its first k + 1, and each class of
    queries keeps k + 1, of which a query leaves out itself.
    """
    tokens = lambda c: F.array_sort(T.token_set(F.col(c)))
    p = pool.select("type", F.col("id").alias("support_id"), tokens("mention").alias("pt"), F.length("context").alias("pl"), F.array_sort("codes").alias("pc"))
    p = p.withColumn("h", F.sha1(F.col("support_id").cast("string").cast("binary")))
    p = p.withColumn("n", F.row_number().over(W.partitionBy("type", "pt", "pc").orderBy("pl", F.desc("h")))).where(F.col("n") <= k + 1).drop("n")
    q = queries.select("type", F.col("id").alias("query_id"), tokens("mention").alias("qt"), F.array_sort("codes").alias("qc"))
    pairs = q.select("type", "qt", "qc").distinct().join(p, "type")
    pairs = pairs.withColumns({"shared": F.size(F.array_intersect("qt", "pt")), "size": F.size("pt"), "same": F.col("qc") == F.col("pc")})
    best = F.row_number().over(W.partitionBy("type", "qt", "qc").orderBy(F.desc("shared"), F.desc("size"), F.desc("same"), "pl", F.desc("h")))
    best = pairs.withColumn("place", best).where(F.col("place") <= k + 1).select(F.col("type").alias("t"), F.col("qt").alias("t2"), F.col("qc").alias("c2"), "place", "support_id", "shared")
    mine = q.join(best, (F.col("type") == F.col("t")) & F.col("qt").eqNullSafe(F.col("t2")) & F.col("qc").eqNullSafe(F.col("c2"))).where(F.col("query_id") != F.col("support_id"))
    return mine.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy("place"))).where(F.col("rank") <= k).select("query_id", "rank", "support_id", "shared")


def shortlist_text(shortlist: Column) -> Column:
    """Lines of a shortlist; a dash and ``none`` for an empty one."""
    line = lambda r: F.concat(F.lit("- "), r["code"], F.lit(": "), F.coalesce(r["label"], F.lit("")), F.lit(" | score="), F.format_string("%.4f", r["score"]), F.lit(" | source="), r["source"])
    return F.when(F.size(shortlist) == 0, "- none").otherwise(F.array_join(F.transform(shortlist, line), "\n"))


#: The system prompt is a parameter; this one states the task in our words.
SYSTEM_PROMPT = "You assign codes to a fixed span of a clinical text. Choose only from the shortlist, at most three, best first; answer with the JSON object that is asked for."


def user_prompt() -> Column:
    """A prompt of the columns type, mention, start, end, context, assertions, shortlist."""
    return F.concat_ws(
        "\n",
        F.concat(F.lit("Type: "), F.col("type")), F.concat(F.lit("Mention: "), F.col("mention")), F.format_string("Position: [%d, %d]", F.col("start"), F.col("end")),
        F.concat(F.lit("Context:\n"), F.col("context")), F.concat(F.lit("Assertions: "), F.when(F.size("assertions") > 0, F.array_join("assertions", ", ")).otherwise("none")),
        F.concat(F.lit("Shortlist:\n"), shortlist_text(F.col("shortlist"))), F.lit('Answer: {"assertions": [...], "candidates": [...]}'),
    )


def messages(system: str = SYSTEM_PROMPT, answer: Column | None = None) -> Column:
    """Chat messages: system, user and, with ``answer``, the assistant's (STR-27)."""
    row = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    out = [row("system", F.lit(system)), row("user", user_prompt())]
    return F.array(*out, *([row("assistant", answer)] if answer is not None else []))


def response() -> Column:
    """The JSON answer of gold assertions and codes."""
    return F.to_json(F.struct(F.col("gold_assertions").alias("assertions"), F.slice("gold_candidates", 1, 3).alias("candidates")))


def code_labels(rows: DataFrame, kb: DataFrame, codes: str = "gold_candidates") -> DataFrame:
    """``rows`` (id, system, codes) with ``labels`` (code, label in the order of the codes, null for unknown ones) and ``unmapped`` codes (JOIN-19)."""
    each = rows.select("id", "system", F.posexplode(codes).alias("n", "code"))
    named = each.join(kb.select("system", "code", "label"), ["system", "code"], "left").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("n", "code", "label"))).alias("__x"))
    none = F.array().cast("array<struct<n: int, code: string, label: string>>")
    x = F.coalesce("__x", none)
    labels = F.transform(x, lambda r: F.struct(r["code"].alias("code"), r["label"].alias("label")))
    unmapped = F.transform(F.filter(x, lambda r: r["label"].isNull()), lambda r: r["code"])
    return rows.join(named, "id", "left").withColumns({"labels": labels, "unmapped": unmapped}).drop("__x")


def few_shot(examples: DataFrame, pool: DataFrame, *, k: int = 3, system: str = SYSTEM_PROMPT) -> DataFrame:
    """id, messages: the system prompt, k support examples with their answers, then the question (SPL-4, STR-27)."""
    told = pool.select(F.col("id").alias("support_id"), user_prompt().alias("question"), response().alias("answer"))
    as_rows = lambda df: df.select("id", "type", "mention", "context", F.col("gold_candidates").alias("codes"))
    support = support_for(as_rows(examples), as_rows(pool), k).join(told, "support_id")
    shown = support.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "question", "answer"))).alias("__s"))
    row = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    turns = F.flatten(F.transform(F.coalesce("__s", F.array().cast("array<struct<rank: int, question: string, answer: string>>")), lambda s: F.array(row("user", s["question"]), row("assistant", s["answer"]))))
    joined = examples.join(shown, F.col("id") == F.col("query_id"), "left")
    return joined.select("id", F.concat(F.array(row("system", F.lit(system))), turns, F.array(row("user", user_prompt()))).alias("messages"))


def bundle_summary(rows: DataFrame) -> DataFrame:
    """split, type, n with subtotals (AGG-18): null is "all"."""
    return rows.rollup("split", "type").agg(F.count(F.lit(1)).alias("n"))
