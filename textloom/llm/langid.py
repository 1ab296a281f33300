"""Language identification with spans, by scripts and Viterbi.

A word's scripts, from code point ranges, narrow the languages that it may be of
to those whose training text uses them.  Each language has a model of the byte
trigrams of words (with their edges), add-half smoothed over hashed slots, that
gives each word a score in each candidate.  Viterbi over a text's words, with a
penalty for every switch, labels spans of one language; the language with most
letters is the text's, and the score is its share of letters times its posterior
over the words labelled so.

All training texts are counted.  A batch's distinct words are scored once.  A
text in which no language beats the best single one in any stretch by half the
penalty is one span (m stretches elsewhere cost m - 1 switches at least, and one
if m is 1), which running sums tell for whole batches; only others are walked
word by word.  Memory follows the bytes of a slice, which are fewer the more
languages there are.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
words without letters, or in a script that no learned language uses, speak for
no language; equal scores go to the language first by code point; without
training data every text is ``und``; an empty table gives no rows.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, table
from .shingles import mix, release_memory, slices, string_buffers

UND = "und"
SLOT_BITS = 16
#: A word's score in a language is at most this much below its best; a switch costs PENALTY.
FLOOR, PENALTY = 6.0, 12.0
#: Bytes of text that a task works on at a time.
SLICE = 1 << 20
SPANS = pa.list_(pa.struct([("first_word", pa.int64()), ("words", pa.int64()), ("lang", pa.string())]))
#: A script belongs to a language in which it has this share of letters.
SCRIPT_SHARE = 0.01

#: First and last code point of scripts' main blocks; letters elsewhere are of one further script.
SCRIPTS = [
    ("latin", 0x0041, 0x024F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x0370, 0x03FF), ("greek", 0x1F00, 0x1FFF), ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F), ("hebrew", 0x0590, 0x05FF), ("arabic", 0x0600, 0x06FF), ("arabic", 0x0750, 0x077F), ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF), ("gurmukhi", 0x0A00, 0x0A7F), ("gujarati", 0x0A80, 0x0AFF), ("tamil", 0x0B80, 0x0BFF), ("telugu", 0x0C00, 0x0C7F),
    ("kannada", 0x0C80, 0x0CFF), ("malayalam", 0x0D00, 0x0D7F), ("sinhala", 0x0D80, 0x0DFF), ("thai", 0x0E00, 0x0E7F), ("lao", 0x0E80, 0x0EFF),
    ("tibetan", 0x0F00, 0x0FFF), ("myanmar", 0x1000, 0x109F), ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF), ("hangul", 0xAC00, 0xD7AF),
    ("ethiopic", 0x1200, 0x137F), ("khmer", 0x1780, 0x17FF), ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x4DBF), ("han", 0x4E00, 0x9FFF), ("han", 0x20000, 0x2FA1F),
]
_TABLE: list[np.ndarray] = []


def script_table() -> np.ndarray:
    """For each code point, 0 if it is no letter, else the bit of its script."""
    if not _TABLE:
        names = list(dict.fromkeys(n for n, _, _ in SCRIPTS))
        out = np.full(0x110000, 1 << len(names), np.int64)
        for n, a, b in SCRIPTS:
            out[a : b + 1] = 1 << names.index(n)
        for c in range(0x110000):
            if not unicodedata.category(chr(c)).startswith("L"):
                out[c] = 0
        _TABLE.append(out)
    return _TABLE[0]


def _distinct_words(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct lower-cased words, which of them each word is, and the texts' offsets."""
    column = pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), ""))
    lists = pc.ascii_split_whitespace(column)
    flat = lists.flatten().dictionary_encode()
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    return flat.dictionary, flat.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def _letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Number of letters and bits of scripts of each word."""
    points = np.frombuffer("\n".join([*words.to_pylist(), ""]).encode("utf-32-le"), np.uint32)
    bits = script_table()[points]
    ends = np.flatnonzero(points == 10)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.add.reduceat((bits > 0).astype(np.int64), starts), np.bitwise_or.reduceat(bits, starts)


def _trigrams(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed slots of all words' trigrams (with an edge mark before and after), and each word's first."""
    offsets, data = string_buffers(words)
    n = np.diff(offsets)
    padded = np.zeros(len(data) + 2 * len(n), np.uint64)
    place = np.arange(len(data)) + np.repeat(2 * np.arange(len(n)) + 1, n)
    padded[place] = data.astype(np.uint64) + np.uint64(1)
    keys = mix(padded[:-2] | padded[1:-1] << np.uint64(9) | padded[2:] << np.uint64(18)) if len(padded) > 2 else np.zeros(0, np.uint64)
    slots = (keys >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
    # a word of n bytes has n trigrams; those that span two words go
    begins = offsets[:-1] + 2 * np.arange(len(n))
    inside = np.repeat(begins - (offsets[:-1]), n) + np.arange(len(data))
    return slots[inside], offsets[:-1]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, slot, n): trigrams of words by language; slots -1 - script bits: letters of words with these scripts."""
    for whole in batches:
        release_memory()
        for batch in slices(whole, "text", SLICE):
            langs = batch.column("lang").dictionary_encode()
            words, which, bounds = _distinct_words(batch.column("text"))
            own = np.repeat(langs.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.diff(bounds))
            letters, bits = _letters(words)
            slots, begins = _trigrams(words)
            sizes = np.diff(np.append(begins, len(slots)))
            for i, lang in enumerate(langs.dictionary.to_pylist()):
                times = np.bincount(which[own == i], minlength=len(words))
                times[letters == 0] = 0
                totals = np.bincount(slots, np.repeat(times, sizes), 1 << SLOT_BITS)
                at = np.flatnonzero(totals)
                kinds, inverse = np.unique(bits, return_inverse=True)
                seen = np.bincount(inverse, times * letters, len(kinds)) if len(kinds) else np.zeros(0)
                for keys, n in ((at, totals[at]), (-1 - kinds, seen)):
                    if len(keys):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(keys)), pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "slot", "n"]
                        )


class Model:
    def __init__(self, langs: list[str], counts: dict[str, np.ndarray], scripts: dict[str, int]):
        self.langs = langs
        self.scripts = np.array([scripts[x] for x in langs], np.int64)
        self.logs = np.array([np.log((counts[x] + 0.5) / (counts[x].sum() + 0.5 * (1 << SLOT_BITS))) for x in langs], np.float32).T.copy()

    def emissions(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Scores of each word in each language (0 for its best), and its number of letters."""
        letters, bits = _letters(words)
        out = np.zeros((len(words), len(self.langs)))
        if not len(words):
            return out, letters
        slots, begins = _trigrams(words)
        filled = np.flatnonzero(np.diff(np.append(begins, len(slots))) > 0)
        out[filled] = np.add.reduceat(self.logs[slots], begins[filled], axis=0)
        may = (bits[:, None] & self.scripts[None, :]) > 0
        speaks = may.any(axis=1) & (letters > 0)
        out[~may] = -np.inf
        out[~speaks] = 0
        out -= out.max(axis=1, keepdims=True)
        return np.maximum(out, -FLOOR), letters


def learn(training: DataFrame) -> Model | None:
    """A model of the languages of ``training`` (text, lang), over all its rows."""
    rows = training.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("text is not null and lang is not null")
    counted = rows.mapInArrow(_count, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    # at most 2 ** SLOT_BITS slots and the scripts' combinations for each language
    got = counted.toArrow()
    if not got.num_rows:
        return None
    names = got.column("lang").to_numpy()
    slots, n = got.column("slot").to_numpy(), got.column("n").to_numpy()
    langs, counts, scripts = sorted(set(names.tolist())), {}, {}
    for lang in langs:
        own = names == lang
        s, k = slots[own], n[own]
        counts[lang] = np.bincount(s[s >= 0], k[s >= 0], 1 << SLOT_BITS)
        total, mask = k[s < 0].sum(), 0
        for bit in range(63):
            if total and k[(s < 0) & ((-1 - s) >> bit & 1 > 0)].sum() >= SCRIPT_SHARE * total:
                mask |= 1 << bit
        scripts[lang] = mask
    return Model(langs, counts, scripts)


def viterbi(scores: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """The best language of each word."""
    n, k = scores.shape
    rows = scores.tolist()
    best, back = rows[0][:], []
    for row in rows[1:]:
        top = max(range(k), key=best.__getitem__)
        switch = best[top] - penalty
        back.append([i if best[i] >= switch else top for i in range(k)])
        best = [(b if b >= switch else switch) + e for b, e in zip(best, row)]
    at = max(range(k), key=best.__getitem__)
    out = np.empty(n, np.int64)
    out[-1] = at
    for t in range(n - 2, -1, -1):
        at = back[t][at]
        out[t] = at
    return out


def _most_ahead(gain: np.ndarray, owner: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """For each text, the most that a stretch of its words gains."""
    total = np.cumsum(gain)
    before = total - gain
    # running minimum within a text: each text's sums are moved below those of the texts before it
    drop = float(np.abs(total).max() * 2 + 1) if len(total) else 1.0
    lowest = np.minimum.accumulate(before - owner * drop) + owner * drop
    ahead = np.zeros(n)
    if len(starts):
        ahead[owner[starts]] = np.maximum.reduceat(total - lowest, starts)
    return ahead


def label_texts(column: pa.Array, model: Model) -> tuple[list[np.ndarray | int], tuple]:
    """For each text, one language for all words or each word's; and (scores, which word, letters, bounds)."""
    words, which, bounds = _distinct_words(column)
    scores, letters = model.emissions(words)
    n = len(bounds) - 1
    counts = np.diff(bounds)
    owner = np.repeat(np.arange(n), counts)
    starts = bounds[:-1][counts > 0]
    sums = np.zeros((n, len(model.langs)))
    if len(starts):
        sums[counts > 0] = np.add.reduceat(scores[which], starts, axis=0)
    single = sums.argmax(axis=1)
    ahead = np.zeros(n)
    for k in range(len(model.langs)):
        ahead = np.maximum(ahead, _most_ahead(scores[which, k] - scores[which, single[owner]], owner, starts, n))
    labels: list[np.ndarray | int] = single.tolist()
    # m stretches in other languages cost m - 1 switches at least, and 1 if m is 1: below half a penalty each, none is gained
    for i in np.flatnonzero(ahead >= PENALTY / 2).tolist():
        path = viterbi(scores[which[bounds[i] : bounds[i + 1]]])
        labels[i] = int(path[0]) if (path == path[0]).all() else path
    return labels, (scores, which, letters, bounds)


def _slice_bytes(model: Model | None) -> int:
    """Bytes of text worked on at a time: the fewer, the more languages each word is scored in."""
    return SLICE if model is None else max(1 << 18, SLICE * 4 // max(4, len(model.langs)))


def _bests(sums: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The softmax of each row at its own place."""
    return 1 / np.exp(np.minimum(sums - sums[np.arange(len(at)), at][:, None], 700)).sum(axis=1)


def predict(column: pa.Array, model: Model | None) -> tuple[list[str], np.ndarray, pa.ListArray]:
    """Language, score and spans of each text; a text without a letter has no spans."""
    n = len(column)
    if model is None:
        return [UND] * n, np.zeros(n), pa.array([[]] * n, SPANS)
    labels, (scores, which, letters, bounds) = label_texts(column, model)
    counts = np.diff(bounds)
    some = counts > 0
    total, sums = np.zeros(n), np.zeros((n, len(model.langs)))
    if some.any():
        starts = bounds[:-1][some]
        total[some] = np.add.reduceat(letters[which], starts)
        sums[some] = np.add.reduceat(scores[which], starts, axis=0)
    at, share = np.zeros(n, np.int64), np.ones(n)
    n_spans, first, words, langs = np.zeros(n, np.int64), [], [], []
    for i in np.flatnonzero(total > 0).tolist():
        label = labels[i]
        if isinstance(label, int):
            at[i] = label
            n_spans[i] = 1
            first.append(0)
            words.append(int(counts[i]))
            langs.append(label)
            continue
        own = which[bounds[i] : bounds[i + 1]]
        by = np.bincount(label, letters[own], len(model.langs))
        at[i] = by.argmax()
        share[i], sums[i] = by[at[i]] / total[i], scores[own[label == at[i]]].sum(axis=0)
        edges = [0, *(np.flatnonzero(np.diff(label)) + 1).tolist(), len(label)]
        n_spans[i] = len(edges) - 1
        first += edges[:-1]
        words += np.diff(edges).tolist()
        langs += label[edges[:-1]].tolist()
    score = np.where(total > 0, share * _bests(sums, at), 0.0)
    names = pa.array(model.langs, pa.string())
    spans = pa.StructArray.from_arrays([pa.array(first, pa.int64()), pa.array(words, pa.int64()), names.take(pa.array(langs, pa.int64()))], fields=list(SPANS.value_type))
    spans = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_spans)]), pa.int32()), spans)
    return [model.langs[k] if t > 0 else UND for k, t in zip(at.tolist(), total.tolist())], score, spans


def _identify(model: Model | None):
    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", _slice_bytes(model)):
                found, score, spans = predict(batch.column("text"), model)
                columns = [batch.column("doc_id"), batch.column("text_key"), pa.array(found, pa.string()), pa.array(score, pa.float64()), spans]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "lang_pred", "score", "spans"])
            release_memory()

    return identify


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """Of each row: doc_id, text_key (hash of the text), lang_pred, score and spans (first word, number of words, language)."""
    shared = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("text_key", F.xxhash64("text"))
    return shared.mapInArrow(_identify(model), "doc_id long, text_key long, lang_pred string, score double, spans array<struct<first_word: long, words: long, lang: string>>")


def training_rows(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    return docs.where(~held_out(F.col(doc_id)) & F.col("lang").isNotNull() & F.col("text").isNotNull())


def _sure(model: Model | None, least: float, at: int):
    def sure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            texts = pa.RecordBatch.from_arrays([whole.column(at), pa.array(np.arange(whole.num_rows))], names=["text", "row"])
            kept = []
            for batch in slices(texts, "text", _slice_bytes(model)):
                found, score, _ = predict(batch.column("text"), model)
                keep = (np.array(found, dtype=object) != UND) & (score >= least)
                kept.append(batch.column("row").to_numpy()[keep])
            rows = np.concatenate([*kept, np.zeros(0, np.int64)])
            # the whole batch as it came, if all of it stays
            yield whole if len(rows) == whole.num_rows else whole.take(pa.array(rows))
            release_memory()

    return sure


def identified(docs: DataFrame, *, least: float = 0.5) -> DataFrame:
    """``docs`` without those that are ``und`` or whose language has a score below ``least``.

    Rows pass through the task that scores them, with all their columns.
    """
    model = learn(training_rows(docs))
    return docs.mapInArrow(_sure(model, least, docs.columns.index("text")), docs.schema)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, learn(training_rows(docs)))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "spans")
