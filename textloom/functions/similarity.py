"""Similarity and scoring functions (SIM-*)."""

from __future__ import annotations

import difflib
import math
import re
import unicodedata
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import DoubleType

from ..lexicon import clinical as lex
from . import text as T


@arrow_udf(DoubleType())
def sequence_ratio(a: pa.Array, b: pa.Array) -> pa.Array:
    """Ratcliff/Obershelp ratio of two strings (SIM-2); not symmetric. Only for pairs that blocking has left."""
    memo: dict[str, difflib.SequenceMatcher] = {}
    done: dict[tuple[str, str], float] = {}
    out = []
    for x, y in zip(a.to_pylist(), b.to_pylist()):
        if x is None or y is None:
            out.append(None)
            continue
        if (x, y) in done:
            out.append(done[x, y])
            continue
        m = memo.get(y)
        if m is None:
            if len(memo) > 1000:
                memo.clear()
            m = memo[y] = difflib.SequenceMatcher(None, "", y)
        m.set_seq1(x)
        out.append(done.setdefault((x, y), m.ratio()))
    return pa.array(out, pa.float64())


def token_overlap(a: Column, b: Column) -> Column:
    """Shared tokens over the larger set; 0 if either is empty."""
    x, y = T.token_set(a), T.token_set(b)
    return F.when((F.size(x) > 0) & (F.size(y) > 0), F.size(F.array_intersect(x, y)) / F.greatest(F.size(x), F.size(y))).otherwise(F.lit(0.0))


def _held(a: Column, b: Column) -> Column:
    return a.contains(b) | b.contains(a)


def alias_similarity(query: Column, alias: Column) -> Column:
    """1 if equal, .9 if one holds the other, else token overlap (SIM-3); of normalised texts."""
    return F.when((query == "") | (alias == ""), 0.0).when(query == alias, 1.0).when(_held(query, alias), 0.9).otherwise(token_overlap(query, alias))


def shortlist_similarity(query: Column, alias: Column) -> Column:
    """1 if equal, .94 if one holds the other, else the greater of token overlap and .9 ratio (SIM-4); of folded keys."""
    return (
        F.when((query == "") | (alias == ""), 0.0)
        .when(query == alias, 1.0)
        .when(_held(query, alias), 0.94)
        .otherwise(F.greatest(token_overlap(query, alias), 0.9 * sequence_ratio(query, alias)))
    )


def lexical_score(query: Column, label: Column, searchable: Column) -> Column:
    """Token coverage, ratio and containment of a query in a record's searchable text (SIM-1)."""
    q, r = T.token_set(query), T.token_set(searchable)
    low = F.lower(query)
    score = 0.55 * F.size(F.array_intersect(q, r)) / F.size(q) + 0.45 * sequence_ratio(low, searchable) + 0.2 * searchable.contains(low).cast("double")
    return F.when((F.size(q) == 0) | (F.size(r) == 0), 0.0).otherwise(F.least(F.lit(1.0), score))


def routes(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(lex.ROUTE_REGEX), F.lit(1)))


def structured_match(query: Column, alias: Column) -> Column:
    """score and mismatch of ingredient, strength and route of two drug names (SIM-6)."""
    qi, ai = T.match_key(T.strip_last_strength(query)), T.match_key(T.strip_last_strength(alias))
    qs, as_ = T.strength(query), T.strength(alias)
    ingredient = F.when((qi == "") | (ai == ""), 0.0).when(qi == ai, 0.7).when(_held(qi, ai), 0.45).otherwise(0.0)
    mismatch = F.coalesce(qs.isNotNull() & as_.isNotNull() & (qs != as_), F.lit(False))
    dose = F.when(qs.isNull(), 0.0).when(as_.isNull(), -0.05).when(qs == as_, 0.3).otherwise(-0.25)
    route = F.when(F.size(F.array_intersect(routes(query), routes(alias))) > 0, 0.05).otherwise(0.0)
    return F.struct(F.least(F.lit(1.0), F.greatest(F.lit(0.0), ingredient + dose + route)).alias("score"), mismatch.alias("mismatch"))


def context_bonus(query: Column, alias: Column, kind: Column, clause_kind: Column) -> Column:
    """What alias, dose and section add to a link's score (SIM-7); ``alias`` is the record's best."""
    q, a = T.match_text(query), T.match_text(alias)
    similarity = alias_similarity(q, a)
    bonus = F.when(similarity >= 0.999, 0.28).when(similarity >= 0.9, 0.18).when(similarity >= 0.6, 0.08).otherwise(0.0)
    qi, ai = T.match_text(T.strip_last_strength(query)), T.match_text(T.strip_last_strength(alias))
    qs, as_ = T.strength(query), T.strength(alias)
    drug = F.when(qi == "", 0.0).when(qi == ai, 0.22).when((ai != "") & _held(qi, ai), 0.12).otherwise(0.0)
    drug = drug + F.when(qs.isNull(), 0.0).when(as_.isNull(), -0.04).when(qs == as_, 0.2).otherwise(-0.18)
    drug = drug + F.when(clause_kind == "drug_history", 0.04).otherwise(0.0)
    diagnosis = F.when(clause_kind.isin("diagnosis_history", "diagnosis_current"), 0.04).otherwise(0.0)
    diagnosis = diagnosis - F.when((F.size(T.tokens(q)) <= 2) & (similarity < 0.9), 0.06).otherwise(0.0)
    return bonus + F.when(kind == lex.DRUG, drug).when(kind == lex.DIAGNOSIS, diagnosis).otherwise(0.0)


def bare_drug_preference(query: Column, label: Column, aliases: Column, tty: Column) -> Column:
    """Prior of a record's term type for queries with and without dose (SIM-9)."""
    q, own = T.match_key(query), T.match_key(label)
    dosed = T.strength(query).isNotNull() | F.lower(query).rlike(lex.ROUTE_REGEX)
    hit = F.exists(aliases, lambda a: T.match_key(a) == q) & (q != own)
    bare = F.when(hit, 0.12).otherwise(0.0)
    bare = bare + (
        F.when(tty.isin("IN", "PIN"), 0.12).when(tty == "BN", 0.03).when(tty.isin("SCD", "SBD", "SCDG", "SBDG", "GPCK", "BPCK"), -0.08).when(tty.isNull() & (own == q), -0.10).otherwise(0.0)
    )
    bare = bare - F.when(label.rlike("(?i)" + lex.PRODUCT_LABEL_REGEX), 0.10).otherwise(0.0)
    return F.when(dosed, F.when(tty.isin("SCD", "SBD"), 0.08).when(tty.isin("IN", "PIN"), 0.02).otherwise(0.0)).otherwise(bare)


def ngram_features(text: Column, low: int = 3, high: int = 5) -> Column:
    """Tokens and character n-grams (blanks as ``_``) of the folded text, with repeats (SIM-12)."""
    folded = F.trim(F.regexp_replace(T.ascii_fold(text), "[^a-z0-9]+", " "))
    marked = F.translate(folded, " ", "_")
    words = F.transform(F.filter(F.split(folded, " "), lambda w: w != ""), lambda w: F.concat(F.lit("w:"), w))

    def grams(n: int) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.length(marked) - (n - 1)), lambda i: F.concat(F.lit(f"{n}:"), F.substring(marked, i, F.lit(n))))
        return F.when(F.length(marked) >= n, each).otherwise(F.array().cast("array<string>"))

    return F.concat(words, *(grams(n) for n in range(low, high + 1)))


def _ngram_counts(text: str) -> Counter:
    folded = "".join(c for c in unicodedata.normalize("NFD", text.lower()) if unicodedata.category(c) != "Mn").replace("đ", "d")
    folded = re.sub("[^a-z0-9]+", " ", folded).strip()
    marked = folded.replace(" ", "_")
    out = Counter(f"w:{w}" for w in folded.split())
    for n in (3, 4, 5):
        out.update(f"{n}:{marked[i : i + n]}" for i in range(len(marked) - n + 1))
    return out


@arrow_udf(DoubleType())
def ngram_cosine(a: pa.Array, b: pa.Array) -> pa.Array:
    """Count cosine of the n-gram features of two short texts (SIM-13); 0 if either has none."""
    memo: dict[str, tuple[Counter, float]] = {}

    def vector(t: str) -> tuple[Counter, float]:
        if t not in memo:
            if len(memo) > 5000:
                memo.clear()
            c = _ngram_counts(t)
            memo[t] = c, math.sqrt(sum(v * v for v in c.values()))
        return memo[t]

    out = []
    for x, y in zip(a.to_pylist(), b.to_pylist()):
        (u, nu), (v, nv) = vector(x or ""), vector(y or "")
        small, large = (u, v) if len(u) < len(v) else (v, u)
        out.append(sum(n * large[f] for f, n in small.items() if f in large) / (nu * nv) if nu and nv else 0.0)
    return pa.array(out, pa.float64())


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Dense cosine (SIM-14); 0 where a vector is null or zero."""
    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(size > 0, dot(a, b) / size).otherwise(F.lit(0.0))
