"""Functions that find spans in texts; offsets are half-open and count code points.

Java's regular expressions count UTF-16 units and give no positions of all
matches, so these run as Arrow UDFs over batches; the spans are exploded by the
JVM, so that no text is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

def _struct(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in kinds.items()])


#: Types as objects: this module is imported by workers, which have no session to parse a type's text.
SPAN = _struct(start=T.IntegerType(), end=T.IntegerType())
SPANS = T.ArrayType(_struct(start=T.IntegerType(), end=T.IntegerType(), label=T.StringType(), text=T.StringType()))
_KIND = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("label", pa.string()), ("text", pa.string())]))


def fold_case(text: str) -> str:
    """Lower case of the same length: characters whose lower case is longer stay."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def lines_of(text: str) -> list[tuple[int, int]]:
    """Spans of lines, without their line feeds; other breaks stay with the line before them (STR-3)."""
    out, at = [], 0
    for piece in text.splitlines(keepends=True):
        out.append((at, at + len(piece) - piece.endswith("\n")))
        at += len(piece)
    return out


def _column(rows: list) -> pa.Array:
    return pa.array(rows, _KIND)


@arrow_udf(SPANS)
def line_spans(text: pa.Array) -> pa.Array:
    return _column([None if t is None else [{"start": a, "end": b, "label": None, "text": t[a:b]} for a, b in lines_of(t)] for t in text.to_pylist()])


def separated_spans(separators: str):
    """Spans between separators (none of them inside), trimmed; empty ones go (GEN-2)."""
    pattern = re.compile(f"[^{re.escape(separators)}]+")

    @arrow_udf(SPANS)
    def spans(text: pa.Array) -> pa.Array:
        out = []
        for t in text.to_pylist():
            own = []
            for m in pattern.finditer(t or ""):
                s = m[0]
                a = m.start() + len(s) - len(s.lstrip())
                s = s.strip()
                if s:
                    own.append({"start": a, "end": a + len(s), "label": None, "text": s})
            out.append(own)
        return _column(out)

    return spans


def regex_spans(rules: Iterable[tuple[str, str]], flags: int = re.IGNORECASE):
    """Spans of the group ``span`` (else of the whole match) of each (label, pattern) (GEN-3..7)."""
    rules = [(label, pattern) for label, pattern in rules]

    @arrow_udf(SPANS)
    def spans(text: pa.Array) -> pa.Array:
        compiled = [(label, re.compile(p, flags)) for label, p in rules]
        out = []
        for t in text.to_pylist():
            own = []
            for label, p in compiled:
                group = "span" if "span" in p.groupindex else 0
                own += [{"start": m.start(group), "end": m.end(group), "label": label, "text": m[group]} for m in p.finditer(t or "")]
            out.append(own)
        return _column(out)

    return spans


class Terms:
    """All occurrences of terms, overlapping ones too, that no letter or digit touches (GEN-14)."""

    def __init__(self, terms: Iterable[tuple[str, str]]):
        by_term: dict[str, list[str]] = {}
        for label, term in terms:
            by_term.setdefault(fold_case(term), []).append(label)
        self.by_term = {t: sorted(set(x)) for t, x in by_term.items() if t}
        self.automaton = None

    def _ready(self):
        if self.automaton is None:
            import ahocorasick

            self.automaton = ahocorasick.Automaton()
            for t in self.by_term:
                self.automaton.add_word(t, t)
            if self.by_term:
                self.automaton.make_automaton()

    def __getstate__(self):
        return {"by_term": self.by_term, "automaton": None}

    def find(self, text: str) -> list[tuple[int, int, str]]:
        self._ready()
        low, out = fold_case(text), []
        for last, term in self.automaton.iter(low) if self.by_term else ():
            a, b = last + 1 - len(term), last + 1
            if not (a > 0 and low[a - 1].isalnum()) and not (b < len(low) and low[b].isalnum()):
                out += [(a, b, label) for label in self.by_term[term]]
        return sorted(out)


def term_spans(terms: Iterable[tuple[str, str]]):
    """Spans of (label, term) pairs, by one automaton; the list of terms goes to each task."""
    finder = Terms(terms)

    @arrow_udf(SPANS)
    def spans(text: pa.Array) -> pa.Array:
        return _column([[{"start": a, "end": b, "label": label, "text": t[a:b]} for a, b, label in finder.find(t)] for t in (x or "" for x in text.to_pylist())])

    return spans


EXPANDED = _struct(text=T.StringType(), to_raw=T.ArrayType(T.IntegerType()))
_EXPANDED = pa.struct([("text", pa.string()), ("to_raw", pa.list_(pa.int32()))])


def expanded(abbreviations: dict[str, str]):
    """Text with abbreviations replaced, and each character's place in the raw text (STR-2)."""
    table = {k.lower(): v for k, v in abbreviations.items()}
    token = re.compile(r"\b[\w/]+\b")

    def one(text: str) -> dict:
        out, places, at = [], [], 0
        for m in token.finditer(text):
            new = table.get(m[0].lower())
            if new is None or new == m[0]:
                continue
            out += [text[at : m.start()], new]
            places += range(at, m.start())
            # spread over the abbreviation in proportion
            size = len(m[0])
            places += [m.start() + min(size - 1, i * size // len(new)) for i in range(len(new))]
            at = m.end()
        out.append(text[at:])
        places += range(at, len(text))
        return {"text": "".join(out), "to_raw": places}

    @arrow_udf(EXPANDED)
    def expand(text: pa.Array) -> pa.Array:
        return pa.array([None if t is None else one(t) for t in text.to_pylist()], _EXPANDED)

    return expand


@arrow_udf(EXPANDED)
def normalized_with_map(text: pa.Array) -> pa.Array:
    """Normalised white space and dashes, and each character's place in the raw text (STR-1)."""
    dashes = dict.fromkeys("‐‑‒–—−", "-")

    def one(t: str) -> dict:
        out, places = [], []
        for i, c in enumerate(t):
            c = dashes.get(c, c)
            if c.isspace():
                if not out or out[-1] == " ":
                    continue
                c = " "
            out.append(c)
            places.append(i)
        if out and out[-1] == " ":
            out, places = out[:-1], places[:-1]
        return {"text": "".join(out), "to_raw": places}

    return pa.array([None if t is None else one(t) for t in text.to_pylist()], _EXPANDED)


@arrow_udf(T.StringType())
def nfd_fold(text: pa.Array) -> pa.Array:
    """Lower case without combining marks for any script (STR-13, exact)."""
    import unicodedata

    def one(t: str) -> str:
        return "".join(c for c in unicodedata.normalize("NFD", t.lower()) if unicodedata.category(c) != "Mn").replace("đ", "d")

    return pa.array([None if t is None else one(t) for t in text.to_pylist()], pa.string())
