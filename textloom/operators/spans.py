"""Operators on spans: tables with doc_id, start and end (half-open, code points)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def exploded(docs: DataFrame, spans: Column, *keep: str) -> DataFrame:
    """A row for each span of each document: keep, no, start, end, label, text."""
    return docs.select(*keep, F.posexplode(spans).alias("no", "s")).select(*keep, "no", "s.start", "s.end", "s.label", "s.text")


def prune_contained(spans: DataFrame, *group: str, order: list[Column] | None = None, only: Column | None = None) -> DataFrame:
    """Spans that no other span of their group contains (WIN-1, JOIN-20).

    Of equal spans the first by ``order`` stays.  Containment is transitive, so
    that the greatest end so far, in order of start and descending end, tells.
    ``only`` tells the rows that are pruned at all.
    """
    order = order or []
    w = W.partitionBy(*group).orderBy("start", F.col("end").desc(), *order).rowsBetween(W.unboundedPreceding, -1)
    reached = F.max(F.when(only, F.col("end")) if only is not None else "end").over(w)
    keep = reached.isNull() | (F.col("end") > reached)
    if only is not None:
        keep = keep | ~only
    return spans.withColumn("__keep", keep).where("__keep").drop("__keep")


def first_of_equal(spans: DataFrame, *key: str, order: list[Column]) -> DataFrame:
    """The first row of each key."""
    w = W.partitionBy(*key).orderBy(*order)
    return spans.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def deduplicate(entities: DataFrame, order: list[Column], keep_nested: str | None = None) -> DataFrame:
    """Distinct (start, end, type), then without spans inside others of their type but those of ``keep_nested`` (WIN-2)."""
    single = first_of_equal(entities, "doc_id", "start", "end", "type", order=order)
    only = (F.col("type") != keep_nested) if keep_nested else None
    return prune_contained(single, "doc_id", "type", order=order, only=only)


def enclosing(spans: DataFrame, segments: DataFrame, key: str, no: str, *, overlap: bool = True) -> DataFrame:
    """Each span with its segment: the first that contains it, else the first that overlaps it (JOIN-2), else none.

    ``key`` identifies a span within doc_id, ``no`` is a segment's number.  The
    join is by document, the range is a residual condition; partial aggregation
    picks the best segment of each span.
    """
    seg = segments.select(F.col("doc_id").alias("__d"), F.col(no).alias("__no"), F.col("start").alias("__a"), F.col("end").alias("__b"))
    within = (F.col("__a") <= F.col("start")) & (F.col("end") <= F.col("__b"))
    meets = within | ((F.col("__a") < F.col("end")) & (F.col("start") < F.col("__b")) if overlap else F.lit(False))
    hits = spans.select("doc_id", key, "start", "end").join(seg, (F.col("doc_id") == F.col("__d")) & meets)
    best = hits.groupBy("doc_id", key).agg(F.min(F.struct((~within).alias("out"), F.col("__no").alias("no"))).alias("x")).select("doc_id", key, F.col("x.no").alias(no))
    return spans.join(best, ["doc_id", key], "left")


def next_within(rows: DataFrame, group: str, order: list[Column], is_from: Column, is_to: Column, gap: Column, value: Column) -> DataFrame:
    """For each ``is_from`` row, the value of the next ``is_to`` row if ``gap(next)`` allows it (JOIN-16).

    One window pass: the next target is the first non-null that follows.
    """
    w = W.partitionBy(group).orderBy(*order).rowsBetween(1, W.unboundedFollowing)
    return rows.withColumn("next", F.first(F.when(is_to, value), ignorenulls=True).over(w)).where(is_from & gap)


def bio_align(tokens: DataFrame, entities: DataFrame) -> DataFrame:
    """tokens (doc_id, token_no, start, end) with label: B- at an entity's first token, I- inside, else O (JOIN-15).

    Of entities that overlap, the later one (by start, end) labels a token.
    """
    e = entities.select(F.col("doc_id").alias("__d"), F.col("start").alias("__a"), F.col("end").alias("__b"), F.col("type").alias("__t"))
    hit = tokens.join(e, (F.col("doc_id") == F.col("__d")) & (F.col("start") < F.col("__b")) & (F.col("__a") < F.col("end")))
    first = W.partitionBy("doc_id", "__a", "__b", "__t").orderBy("start", "token_no")
    tagged = hit.withColumn("tag", F.when(F.row_number().over(first) == 1, F.concat(F.lit("B-"), "__t")).otherwise(F.concat(F.lit("I-"), "__t")))
    best = tagged.groupBy("doc_id", "token_no").agg(F.max(F.struct("__a", "__b", "tag")).alias("x")).select("doc_id", "token_no", F.col("x.tag").alias("label"))
    return tokens.join(best, ["doc_id", "token_no"], "left").withColumn("label", F.coalesce("label", F.lit("O")))


def beside_text(spans: DataFrame, docs: DataFrame, read: Callable[[Column, Column], dict[str, Column]], *, how: str = "inner") -> DataFrame:
    """``spans`` with the columns that ``read`` makes of a row (a struct) and its document's text.

    A document's rows are collected before they meet its text, so that a text is
    shuffled and looked at once, not once a span.
    """
    rest = [c for c in spans.columns if c != "doc_id"]
    per_doc = spans.groupBy("doc_id").agg(F.collect_list(F.struct(*rest)).alias("__m"))
    met = per_doc.join(docs.select("doc_id", F.col("text").alias("__t")), "doc_id", how)

    def row(m: Column) -> Column:
        return F.struct(m.alias("m"), F.struct(*[c.alias(name) for name, c in read(m, F.col("__t")).items()]).alias("r"))

    return met.select("doc_id", F.explode(F.transform("__m", row)).alias("x")).select("doc_id", "x.m.*", "x.r.*")


def to_raw(spans: DataFrame, to_raw: str = "to_raw") -> DataFrame:
    """Spans in an expanded text as spans in the raw one; empty ones and those out of range go (PRJ-2)."""
    inside = (F.col("start") >= 0) & (F.col("start") < F.col("end")) & (F.col("end") <= F.size(to_raw))
    first, last = F.element_at(to_raw, F.col("start") + 1), F.element_at(to_raw, F.col("end")) + 1
    return spans.where(inside).withColumns({"start": first, "end": last}).drop(to_raw)


def locate_segments(segments: DataFrame, texts: DataFrame) -> DataFrame:
    """Where each segment (root, no, segment) stands in its root's text (root, text), in order (JOIN-17).

    A segment is looked for behind its predecessor's end, then anywhere if it
    stands there only once; else offset is null.  The fold runs along each root's
    segments as one expression.
    """
    ordered = segments.groupBy("root").agg(F.array_sort(F.collect_list(F.struct("no", "segment"))).alias("parts")).join(texts.select("root", "text"), "root")
    start = F.struct(F.lit(0).alias("cursor"), F.expr("cast(array() as array<int>)").alias("found"))

    def step(state, part):
        s = part["segment"]
        text = F.col("text")
        behind = F.position(s, F.substring(text, state["cursor"] + 1, F.length(text)))
        anywhere = F.position(s, text)
        second = F.position(s, F.substring(text, anywhere + 1, F.length(text)))
        at = F.when(behind > 0, state["cursor"] + behind - 1).when((anywhere > 0) & (second == 0), anywhere - 1).otherwise(F.lit(None).cast("int"))
        return F.struct(F.coalesce(at + F.length(s), state["cursor"]).cast("int").alias("cursor"), F.concat(state["found"], F.array(at.cast("int"))).alias("found"))

    found = ordered.select("root", "parts", F.aggregate("parts", start, lambda a, p: step(a, p), lambda a: a["found"]).alias("found"))
    return found.select("root", F.explode(F.arrays_zip("parts", "found")).alias("x")).select("root", F.col("x.parts.no").alias("no"), F.col("x.parts.segment").alias("segment"), F.col("x.found").alias("offset"))


def shift_spans(spans: DataFrame, offsets: DataFrame) -> DataFrame:
    """Spans of segments (root, no, start, end, ...) moved to the roots' texts (JOIN-18)."""
    moved = spans.join(offsets.select("root", "no", "offset"), ["root", "no"])
    return moved.withColumns({"start": F.col("start") + F.col("offset"), "end": F.col("end") + F.col("offset")}).drop("offset")


def remapped(spans: DataFrame, segments: DataFrame, texts: DataFrame) -> DataFrame:
    """Spans of segments as spans of the roots' texts, tested there (JOIN-18): root, no, start, end, text and ``sound``.

    ``spans`` has root, no, start, end and text; ``segments`` root, no and segment;
    ``texts`` root and text.  A span whose segment is nowhere, or whose text is not
    found at its new place, is not sound.
    """
    moved = shift_spans(spans, locate_segments(segments, texts))
    beside = moved.join(texts.select("root", F.col("text").alias("__t")), "root")
    same = F.expr("substring(__t, start + 1, end - start)") == F.col("text")
    return beside.withColumn("sound", F.coalesce(same & (F.col("start") < F.col("end")), F.lit(False))).drop("__t")
