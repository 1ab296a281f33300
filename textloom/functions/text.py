"""Text functions as column expressions; all run inside the JVM."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..lexicon import clinical as lex


def _either(items: list[str]) -> str:
    return "|".join(re.escape(x).replace("'", "\\'") for x in items)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is made once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def normalize_space(text: Column) -> Column:
    """Blanks and dashes in one form, runs of white space as one blank, trimmed (STR-1)."""
    return F.trim(F.regexp_replace(F.translate(text, " \t‐‑‒–—−", "  ------"), r"\s+", " "))


def normalize_header(text: Column) -> Column:
    """A header line without number, bullet and colon (STR-4)."""
    out = F.lower(F.regexp_replace(F.regexp_replace(text, r"^\s+|\s+$", ""), r"^\d+\.\s*", ""))
    out = F.replace(F.regexp_replace(out, r"^[-*]+\s*", ""), F.lit(":"), F.lit(" "))
    return F.regexp_replace(out, r"\s{2,}", " ")


def _fold_table() -> tuple[str, str]:
    """Precomposed letters and their bases, by decomposition, for the Latin, Greek and Cyrillic blocks."""
    source, base = [], []
    for first, last in ((0x00C0, 0x024F), (0x0370, 0x04FF), (0x1E00, 0x1FFF)):
        for c in map(chr, range(first, last + 1)):
            plain = "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn")
            if len(plain) == 1 and plain != c:
                source.append(c)
                base.append(plain)
    return "".join([*source, "đ"]), "".join([*base, "d"])


_FOLD = _fold_table()


def ascii_fold(text: Column) -> Column:
    """Lower case without diacritics (STR-13); exact for the scripts of ``_fold_table``."""
    return F.regexp_replace(F.translate(F.lower(text), *_FOLD), r"\p{Mn}+", "")


def match_text(text: Column) -> Column:
    """Lower-cased letters and digits, single blanks (STR-12)."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-zà-ỹđ0-9]+", " "))


def match_key(text: Column) -> Column:
    """The folded key that aliases and queries are compared by (STR-14)."""
    return F.trim(ascii_fold(match_text(text)))


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits, in order (STR-15)."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def token_set(text: Column) -> Column:
    return F.array_distinct(tokens(text))


def strength(text: Column) -> Column:
    """First (number, unit), the number with a point; null without one (STR-16)."""
    low = F.lower(text)
    number = F.translate(F.regexp_extract(low, lex.STRENGTH_REGEX, 1), ",", ".")
    return F.when(number != "", F.struct(number.alias("number"), F.regexp_extract(low, lex.STRENGTH_REGEX, 2).alias("unit")))


def strip_last_strength(text: Column) -> Column:
    """Without a dose at the end (STR-11)."""
    out = F.regexp_replace(text, r"(?i)\s+\d+(?:[.,]\d+)?\s*(?:mg/ml|mcg/ml|mg|mcg|g|ml)$", "")
    return F.regexp_replace(out, r"^[ ,\-:]+|[ ,\-:]+$", "")


def strip_strengths(text: Column) -> Column:
    """Without any dose (STR-11, graph form)."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, "(?i)" + lex.STRENGTH_REGEX, " "), r"\s{2,}", " "))


def _before_first(text: Column, stops: list[str]) -> Column:
    """Text before the first of the stops."""
    low = F.lower(text)
    places = [F.nullif(F.locate(s, low), F.lit(0)) for s in stops]
    least = F.least(*places) if len(places) > 1 else places[0]
    return F.when(least.isNotNull(), F.substring(text, F.lit(1), least - 1)).otherwise(text)


def _before_any(text: Column, stops: list[str]) -> Column:
    """Text before the first stop of the list that occurs at all."""
    low = F.lower(text)
    out = text
    for s in reversed(stops):
        at = F.locate(s, low)
        out = F.when(at > 0, F.substring(text, F.lit(1), at - 1)).otherwise(out)
    return out


def diagnosis_query(text: Column) -> Column:
    """A diagnosis mention as a query (STR-9)."""
    out = F.regexp_replace(F.regexp_replace(text, r"^\s+|\s+$", ""), r"^[\s:;-]+", "")
    out = _before_first(F.regexp_replace(out, "(?iu)" + lex.DIAGNOSIS_QUERY_LEADS, ""), lex.DIAGNOSIS_QUERY_STOPS)
    return F.regexp_replace(F.trim(F.regexp_replace(out, r"\([^)]*$", "")), r"\s{2,}", " ")


def drug_query(text: Column) -> Column:
    """A drug mention as a query (STR-10)."""
    out = F.trim(F.regexp_extract(F.regexp_replace(text, r"^\s+|\s+$", ""), r"^([^\n\r]*)", 1))
    out = F.regexp_replace(out, r"(?i)^\d+(?:[.,]\d+)?\s*(?:mg/ml|mcg/ml|mg|mcg|g|ml)\s+", "")
    out = F.trim(_before_any(out, lex.DRUG_LIST_STOPS))
    for pattern in (lex.DRUG_QUERY_LEADS, lex.DRUG_QUERY_DOSES, lex.DRUG_QUERY_TAIL):
        out = F.regexp_replace(out, "(?iu)" + pattern, "")
    return F.regexp_replace(F.regexp_replace(out, r"\s{2,}", " "), r"^[ ,\-:]+|[ ,\-:]+$", "")


def too_long_to_link(query: Column, kind: Column) -> Column:
    """Queries that are no names any more (FLT-6)."""
    key = match_text(query)
    size = F.size(tokens(key))
    return F.when(kind == lex.DIAGNOSIS, (F.length(key) > 48) | (size > 8)).when(kind == lex.DRUG, (F.length(key) > 64) | (size > 10)).otherwise(F.lit(False))


def context(text: Column, start: Column, end: Column, width: int) -> Column:
    """Text ``width`` characters around a span, trimmed (STR-17)."""
    left = F.greatest(start - width, F.lit(0))
    return F.regexp_replace(F.substring(text, left + 1, end + width - left), r"^\s+|\s+$", "")


def flat_context(text: Column, start: Column, end: Column, width: int) -> Column:
    """The same on one line (STR-18)."""
    return F.trim(F.regexp_replace(context(text, start, end, width), r"\s+", " "))


def candidate_codes(values: Column, most: int = 3) -> Column:
    """Codes before a colon, distinct, in order, at most ``most`` (STR-19)."""
    codes = F.filter(F.transform(values, lambda v: F.trim(F.substring_index(v, ":", 1))), lambda v: v != "")
    return F.slice(F.array_distinct(codes), 1, most)


def known_assertions(values: Column) -> Column:
    """Distinct known assertions, sorted (SET-6)."""
    return F.array_sort(F.array_distinct(F.filter(values, lambda v: v.isin(*lex.ASSERTIONS))))


def parse_response(text: Column) -> Column:
    """assertions and candidates of the outermost JSON object in a model's answer; empty where there is none (STR-20)."""
    schema = "assertions array<string>, candidates array<string>"
    got = F.from_json(F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit("")), schema)
    none = F.array().cast("array<string>")
    return F.struct(
        known_assertions(F.coalesce(got["assertions"], none)).alias("assertions"), candidate_codes(F.filter(F.coalesce(got["candidates"], none), lambda v: v.isNotNull())).alias("candidates")
    )


def dotted_code(code: Column) -> Column:
    """A code with a dot after three characters (STR-21)."""
    up = F.upper(F.trim(code))
    return F.when(F.length(up) > 3, F.concat(F.substring(up, 1, 3), F.lit("."), F.substring(up, 4, 1000))).otherwise(up)


def clean_alias(text: Column, most: int = 80) -> Column:
    """White space collapsed; null if empty or over ``most`` characters (STR-22)."""
    out = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.when((out != "") & (F.length(out) <= most), out)


def entity_id(stem: Column, start: Column, end: Column, kind: Column) -> Column:
    return F.concat_ws(":", stem, start.cast("string"), end.cast("string"), kind)


def group_key(kind: Column, mention: Column, codes: Column) -> Column:
    """Type, normalised mention and codes: what must not be split apart (STR-24)."""
    return F.concat_ws("|", kind, F.array_join(tokens(mention), " "), F.array_join(F.array_sort(codes), ","))


def keeps_body(body: Column, generic: list[str] = lex.GENERIC_PHRASES) -> Column:
    """Whether a section's body can be a mention as a whole (FLT-5)."""
    low = F.btrim(F.lower(body), F.lit(" -"))
    commas = F.length(low) - F.length(F.translate(low, ",", ""))
    said = F.lit(False)
    for g in generic:
        said = said | low.contains(g)
    return F.length(low).between(2, 96) & (commas <= 1) & ~low.contains(";") & (F.size(F.split(F.trim(low), r"\s+")) <= 12) & ~said


def ner_label(raw: Column, labels: dict[str, str] = lex.NER_LABELS) -> Column:
    """A model's label as an entity type; null if it is none (STR-23)."""
    bare = F.regexp_replace(F.substring_index(F.trim(raw), "-", -1), "LABEL_", "")
    key = F.replace(F.upper(bare), F.lit(" "), F.lit("_"))
    table = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    return F.coalesce(F.try_element_at(table, key), F.when(bare.isin(*set(labels.values())), bare))
