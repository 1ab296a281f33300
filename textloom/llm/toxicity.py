"""Toxicity by a counterfactually regularised linear classifier.

Features of a text are its words and the words' first 4, 5 and 6 bytes, each at
most once.  A bounded sample of labelled rows fits a logistic regression.  Each
labelled text that names an identity is also read with the term swapped for each
other of its group, everywhere in the text, and the squared changes of its score
are penalised, so that a neutral mention of a group does not count as toxic
because such mentions were frequent in toxic examples.  The changes are those of
the swapped text's own features: a word or a beginning that other words of the
text share stays.  ``Model.swapped`` tells how many texts were swapped.

The sample: at most TRAIN_ROWS rows, half of them toxic if there are as many,
those with the least hashes of their ids; weights restore the share of toxic rows
among all labelled rows.  The VOCABULARY features that tell the classes apart
best (by the G statistic) are kept, and those of the identity terms.  Scoring
reads whole texts of any length.

Defined results: a null or empty text has the score of a text without known
features; rows that repeat an id in the labels are toxic if one of them is; null
ids and labels other than 0 and 1 are no labels; with no labelled text of a class
the score of all texts is the share of toxic labels (0 without any); an empty
table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, UPPER, Scratch, held_out, table
from .shingles import mix, slices, string_buffers, whole_words, word_hashes

TRAIN_ROWS = 6000
VOCABULARY = 2048
PREFIXES = (4, 5, 6)
#: Weights of the squares of the coefficients and of the counterfactual changes.
RIDGE, SWAP = 1e-4, 1.0
THRESHOLD = 0.3
#: Features below this G (half the likelihood ratio statistic) tell nothing.
LEAST_G = 6.0

#: Groups of identity terms that can stand for each other.
IDENTITIES = [
    ["women", "men"], ["woman", "man"], ["girls", "boys"], ["muslims", "christians", "jews", "hindus", "buddhists", "atheists"],
    ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist"], ["black", "white", "asian", "latino"], ["gay", "straight", "lesbian", "bisexual"],
    ["immigrants", "citizens", "refugees", "natives"], ["immigrant", "citizen", "refugee", "native"], ["disabled", "deaf", "blind"], ["old", "young"],
    ["frauen", "männer"], ["muslime", "christen", "juden"], ["femmes", "hommes"], ["musulmans", "chrétiens", "juifs"], ["mujeres", "hombres"],
    ["musulmanes", "cristianos", "judíos"],
]

#: Words here are runs of letters and digits: all other ASCII bytes are gaps.
GAPS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_WIDTH = 1 + len(PREFIXES)
_LOWER = str.maketrans(UPPER, LOWER)


def _word_features(starts, ends, total, inverse):
    """Hashes of each word and of its first bytes; 0 for a beginning that is the whole word or more."""
    out = np.zeros((len(starts), _WIDTH), np.uint64)
    out[:, 0] = whole_words(starts, ends, total, inverse)
    for i, k in enumerate(PREFIXES, 1):
        long = ends - starts > k
        s = starts[long]
        out[long, i] = mix((total[s + k] - total[s]) * inverse[s] + np.uint64(1000 + k))
    return out


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes of all words of all texts (rows of _WIDTH), and the texts' offsets in words."""
    return word_hashes(*string_buffers(column), GAPS, _word_features, (0, _WIDTH))


def _text_features(column: pa.Array) -> list[np.ndarray]:
    """Each text's distinct features."""
    found, bounds = features(column)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        x = np.unique(found[a:b])
        out.append(x[1:] if len(x) and x[0] == 0 else x)
    return out


def term_features(term: str) -> np.ndarray:
    return _text_features(pa.array([term]))[0]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, toxic texts, other texts) of a batch."""
    for whole in batches:
        for batch in slices(whole, "text"):
            each = _text_features(batch.column("text"))
            toxic = np.repeat(batch.column("toxic").to_numpy(zero_copy_only=False).astype(bool), [len(x) for x in each])
            keys, inverse = np.unique(np.concatenate([*each, np.zeros(0, np.uint64)]), return_inverse=True)
            ones = np.bincount(inverse, toxic, len(keys)).astype(np.int64)
            both = np.bincount(inverse, minlength=len(keys))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(ones), pa.array(both - ones)], names=["feature", "n1", "n0"])


_WORDS = re.compile(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def swapped_texts(text: str, identities: list[list[str]]) -> list[str]:
    """The text with one identity term that it names swapped for another of its group, for all of both."""
    present = {w.translate(_LOWER) for w in _WORDS.findall(text)}
    out = []
    for group in identities:
        for term in group:
            if term in present:
                for other in group:
                    if other != term:
                        out.append(_WORDS.sub(lambda m: other if m[0].translate(_LOWER) == term else m[0], text))
    return out


def _select(vocabulary: np.ndarray, identities: list[list[str]]):
    """(toxic, at, changes): places of a text's features in the vocabulary, and for each swap those that go and come."""

    def places(x: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.isin(vocabulary, x)).astype("<u2")

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                at = [places(x) for x in _text_features(batch.column("text"))]
                changes = []
                for own, text in zip(at, batch.column("text").to_pylist()):
                    mine = []
                    for other in swapped_texts(text or "", identities):
                        new = places(_text_features(pa.array([other]))[0])
                        gone, come = np.setdiff1d(own, new), np.setdiff1d(new, own)
                        mine.append(np.concatenate([[len(gone)], gone, come]).astype("<u2").tobytes())
                    changes.append(mine)
                columns = [batch.column("toxic"), pa.array([x.tobytes() for x in at], pa.binary()), pa.array(changes, pa.list_(pa.binary()))]
                yield pa.RecordBatch.from_arrays(columns, names=["toxic", "at", "changes"])

    return select


@dataclass
class Model:
    vocabulary: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float
    #: labelled texts that name an identity, and so were swapped
    swapped: int = 0

    def scores(self, column: pa.Array) -> np.ndarray:
        found, bounds = features(column)
        n = len(bounds) - 1
        logit = np.full(n, self.bias)
        if len(self.vocabulary) and len(found):
            some = np.zeros(1 << 16, bool)
            some[(self.vocabulary >> np.uint64(48)).astype(np.int64)] = True
            row, col = np.nonzero(some[(found >> np.uint64(48)).astype(np.int64)])
            hashes = found[row, col]
            at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
            hit = self.vocabulary[at] == hashes
            text = np.searchsorted(bounds, row[hit], side="right") - 1
            once = np.unique(text * len(self.vocabulary) + at[hit])
            logit += np.bincount(once // len(self.vocabulary), self.weights[once % len(self.vocabulary)], n)
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(-logit))


def swaps(changes: list[list[bytes]], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct changes of features, and how many texts ask for each (a text's swaps share its one vote)."""
    times: dict[bytes, float] = {}
    for mine in changes:
        for c in mine:
            times[c] = times.get(c, 0.0) + 1 / len(mine)
    out = np.zeros((len(times), size), np.float32)
    for row, c in zip(out, times):
        x = np.frombuffer(c, "<u2")
        row[x[1 : 1 + x[0]]] = -1
        row[x[1 + x[0] :]] = 1
    return out, np.fromiter(times.values(), np.float32, len(times))


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray, changes: np.ndarray, times: np.ndarray, *, ridge: float = RIDGE, swap: float = SWAP, steps: int = 400) -> tuple[np.ndarray, float]:
    """Coefficients and intercept that minimise weighted log loss + ridge * |w|^2 + swap * mean square change, by Adam."""
    n, k = x.shape
    weight = (weight / weight.sum()).astype(np.float32)
    share = float(np.clip((weight * y).sum(), 1e-3, 1 - 1e-3))
    theta, bias = np.zeros(k, np.float32), float(np.log(share / (1 - share)))
    first, second = np.zeros(k + 1), np.zeros(k + 1)
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ theta + bias, -30, 30)))
        error = weight * (p - y)
        slope = x.T @ error + 2 * ridge * theta
        if len(times):
            slope = slope + 2 * swap / n * (changes.T @ (times * (changes @ theta)))
        g = np.append(slope, error.sum())
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        step = 0.05 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
        theta, bias = theta - step[:-1].astype(np.float32), bias - float(step[-1])
    return theta, bias


def fit(docs: DataFrame, labels: DataFrame, *, rows: int = TRAIN_ROWS, vocabulary: int = VOCABULARY, identities: list[list[str]] = IDENTITIES, swap: float = SWAP) -> Model:
    """A model of the labelled rows (doc_id, toxic) whose texts are in ``docs`` (doc_id, text)."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)")
    marked = scratch.table(marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "labels")
    n = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    share = n.get(1, 0) / max(1, sum(n.values()))
    always = -np.inf if share == 0 else np.inf if share == 1 else np.log(share / (1 - share))
    none = Model(np.zeros(0, np.uint64), np.zeros(0, np.float32), float(always))
    if len(n) < 2:
        return none
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    half = {c: min(n[c], max(rows // 2, rows - n[1 - c])) for c in (0, 1)}
    sample = scratch.table(marked.where("toxic = 0").orderBy(*order).limit(half[0]).union(marked.where("toxic = 1").orderBy(*order).limit(half[1])), "sample")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chosen = scratch.table(texts.join(sample, "doc_id").select("text", "toxic"), "chosen")
    counts = chosen.mapInArrow(_count, "feature long, n1 long, n0 long").groupBy("feature").agg(F.sum("n1").cast("double").alias("n1"), F.sum("n0").cast("double").alias("n0"))
    a, b = float(half[1]), float(half[0])
    # G: how far the feature's counts in the classes are from the classes' sizes
    g = " + ".join(f"{k} * ln(greatest({k}, 1e-9) / ({e}))" for k, e in (("n1", f"(n1 + n0) * {a / (a + b)}"), ("n0", f"(n1 + n0) * {b / (a + b)}")))
    best = counts.where("n1 + n0 >= 3").where(F.expr(g) >= LEAST_G).orderBy(F.expr(g).desc(), "feature").limit(vocabulary).select("feature").collect()
    terms = [term_features(t) for group in identities for t in group]
    words = np.unique(np.concatenate([np.array([r["feature"] for r in best], np.int64).view(np.uint64), *terms]))
    got = chosen.mapInArrow(_select(words, identities), "toxic int, at binary, changes array<binary>").collect()
    scratch.drop("labels", "sample", "chosen")
    y = np.array([r["toxic"] for r in got], np.float32)
    if len(set(y.tolist())) < 2:
        return none
    x = np.zeros((len(got), len(words)), np.float32)
    for i, r in enumerate(got):
        x[i, np.frombuffer(bytes(r["at"]), "<u2")] = 1
    weight = np.where(y == 1, share / half[1], (1 - share) / half[0]).astype(np.float32)
    changes = [[bytes(c) for c in r["changes"]] for r in got]
    theta, bias = train(x, y, weight, *swaps(changes, len(words)), swap=swap)
    return Model(words, theta, bias, sum(map(bool, changes)))


def _score(model: Model, threshold: float):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                s = model.scores(batch.column("text"))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return score


def score(docs: DataFrame, model: Model, *, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score and predicted of each row."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_score(model, threshold), "doc_id long, score double, predicted int")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"))))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
