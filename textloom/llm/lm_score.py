"""Scores of documents by cross-entropy difference of two language models.

The target model learns from a target corpus, the background model from all
documents.  They are matched: bigram models of the same form, with the same
smoothing, over one shared vocabulary, the lower-cased words.  With c counts of
words and of word pairs,

    p1(w) = (c(w) + a) / (N + a * V),   p(w | v) = (c(v w) + m * p1(w)) / (c(v) + m).

V is a constant of the smoothing (``WORD_BITS``), not a table size: no count is
hashed into slots.  Words and pairs are told apart by 64-bit hashes.

A document's score is the mean over its words of the difference of the two
losses, -log p in the target model minus that in the background model: the lower,
the more the document is like the target.

All words of all documents are counted, in tables that grow with the corpus.
Documents are dealt into blocks of about ``BLOCK`` bytes by their id.  A block
sends its own count of each of its distinct words and pairs to the part that owns
the key's range (of about ``PART`` bytes of text); the part adds up and answers a
block only where the sum is not the block's own count, as it is for a word or
pair that no other block has.  The block then scores its documents.  Nothing is
broadcast or sent to the driver, but the corpus' size.

Defined results: a null or empty text has 0 words, no losses and score 0; a word
has losses after the white-space rule of the other operators; rows that repeat a
document are scored again and count again; without target documents the target
model is uniform; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .shingles import mix, string_buffers, word_hashes

#: The smoothing's V is 2 ** WORD_BITS.
WORD_BITS = 18
#: Bytes of text of a block of documents, and of those whose words and pairs a part counts.
BLOCK, PART = 1 << 23, 1 << 23
#: Additive smoothing of words, and the weight of words in that of pairs.
ADD, BACK = 0.1, 20.0
#: The key of the number of all words.
_ALL = np.zeros(1, np.uint64)

MESSAGE = "part long, block long, keys binary, n binary, t binary"
_MESSAGE = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("keys", pa.binary()), ("n", pa.binary()), ("t", pa.binary())])
SCORES = "doc_id long, n_tokens long, loss_target double, loss_background double, score double"


class Block:
    """The words of a block's documents, its distinct keys and their counts over its documents (n) and its target documents (t)."""

    def __init__(self, texts: pa.Table, ids: pa.ChunkedArray):
        words, self.bounds = word_hashes(*string_buffers(texts.column("text")))
        own = pc.is_in(texts.column("doc_id"), value_set=ids.combine_chunks().drop_null()).to_numpy().astype(bool)
        target = np.repeat(own, np.diff(self.bounds))
        #: words that are not a text's first
        self.inner = np.ones(len(words), bool)
        self.inner[self.bounds[:-1][np.diff(self.bounds) > 0]] = False
        after = np.flatnonzero(self.inner)
        pairs = mix(mix(words[after - 1]) + words[after])
        keys, at = np.unique(np.concatenate([words, pairs]), return_inverse=True)
        self.keys = np.concatenate([_ALL, keys])
        self.word, pair = at[: len(words)] + 1, at[len(words) :] + 1
        self.pair = np.zeros(len(words), np.int64)
        self.pair[after] = pair
        size = len(self.keys)
        self.n = np.bincount(self.word, minlength=size) + np.bincount(pair, minlength=size)
        self.t = np.bincount(self.word[target], minlength=size) + np.bincount(self.pair[target & self.inner], minlength=size)
        self.n[0], self.t[0] = len(words), int(target.sum())

    def losses(self, counts: np.ndarray) -> np.ndarray:
        """-log p of every word in one model."""
        c = counts[self.word]
        single = (c + ADD) / (counts[0] + ADD * (1 << WORD_BITS))
        before = np.concatenate([[0], c[:-1]]) if len(c) else c
        paired = (counts[self.pair] + BACK * single) / (before + BACK)
        return -np.log(np.where(self.inner, paired, single))


def _planes(x: np.ndarray) -> np.ndarray:
    """The first bytes of all values, then their second ones: high bytes are mostly zero and compress."""
    return x.astype("<i8" if x.dtype.kind == "i" else "<u8").view(np.uint8).reshape(-1, 8).T


def _packed(x: np.ndarray) -> bytes:
    return zlib.compress(_planes(x).tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return _from_planes(zlib.decompress(data)).astype(np.int64)


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def _ranges(keys: np.ndarray, parts: int) -> list[tuple[int, int, int]]:
    """The parts that own sorted keys, with begin and end of theirs."""
    owner = ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    edges = [0, *(np.flatnonzero(np.diff(owner)) + 1).tolist(), len(owner)]
    return [(int(owner[x]), x, y) for x, y in zip(edges, edges[1:])]


def _send(parts: int):
    def send(key: tuple, texts: pa.Table, ids: pa.Table) -> pa.Table:
        """The block's counts by the part that owns the keys, which go as differences."""
        if not texts.num_rows:
            return _MESSAGE.empty_table()
        block, no = Block(texts, ids.column("id")), key[0].as_py()
        steps = block.keys - np.concatenate([_ALL, block.keys[:-1]])
        rows = []
        for part, x, y in _ranges(block.keys, parts):
            steps[x] = block.keys[x]
            rows.append((part, no, _planes(steps[x:y]).tobytes(), _packed(block.n[x:y]), _packed(block.t[x:y])))
        return pa.table([list(c) for c in zip(*rows)], schema=_MESSAGE)

    return send


def _answer(rows: pa.Table) -> pa.Table:
    """For each block, which of its keys have a sum that is not its own count (as bits), and those sums."""
    each = [np.cumsum(_from_planes(x), dtype=np.uint64) for x in rows.column("keys").to_pylist()]
    ends = np.cumsum([len(x) for x in each]).tolist()
    distinct, at = np.unique(np.concatenate(each), return_inverse=True)
    differs, sums = np.zeros(len(at), bool), []
    for name in ("n", "t"):
        own = np.concatenate([_unpacked(x) for x in rows.column(name).to_pylist()])
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, at, own)
        sums.append(total[at])
        differs |= sums[-1] != own
    out = []
    for part, block, x, y in zip(rows.column("part").to_pylist(), rows.column("block").to_pylist(), [0, *ends], ends):
        which = x + np.flatnonzero(differs[x:y])
        if len(which):
            out.append((part, block, zlib.compress(np.packbits(differs[x:y]).tobytes(), 1), _packed(sums[0][which]), _packed(sums[1][which])))
    return pa.table([list(c) for c in zip(*out)], schema=_MESSAGE) if out else _MESSAGE.empty_table()


_SCORES = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("loss_target", pa.float64()), ("loss_background", pa.float64()), ("score", pa.float64())])


def _score(parts: int):
    def score(texts: pa.Table, told: pa.Table) -> pa.Table:
        """The scores of a block's documents; ``told`` are its target ids and the answers."""
        if not texts.num_rows:
            return _SCORES.empty_table()
        block = Block(texts, told.column("id"))
        begins = {part: (x, y) for part, x, y in _ranges(block.keys, parts)}
        for part, bits, n, t in zip(*(told.column(c).to_pylist() for c in ("part", "keys", "n", "t"))):
            if part is not None:
                x, y = begins[part]
                at = x + np.flatnonzero(np.unpackbits(np.frombuffer(zlib.decompress(bits), np.uint8), count=y - x))
                block.n[at], block.t[at] = _unpacked(n), _unpacked(t)
        words = np.diff(block.bounds)
        means = []
        for counts in (block.t, block.n):
            sums = np.concatenate([[0.0], np.cumsum(block.losses(counts))])
            means.append((sums[block.bounds[1:]] - sums[block.bounds[:-1]]) / np.maximum(words, 1))
        empty = words == 0
        columns = [texts.column("doc_id"), pa.array(words), *(pa.array(m, mask=empty) for m in means), pa.array(np.where(empty, 0.0, means[0] - means[1]))]
        return pa.table(columns, schema=_SCORES)

    return score


def cross_entropy_difference(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    """Scores of all ``docs`` (doc_id, text); the target corpus is those whose id is in ``target_ids`` (doc_id).

    Returns doc_id, n_tokens, loss_target, loss_background and score, a row per row.
    """
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    blocks, parts = size // BLOCK + 1, size // PART + 1
    # rows without an id are no target and go by their text
    block = F.pmod(F.xxhash64("doc_id"), F.lit(blocks))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.withColumn("block", F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("text"), F.lit(blocks))).otherwise(block))
    chosen = target_ids.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    chosen = chosen.select(block.alias("block"), F.col("doc_id").alias("id"))
    counts = texts.groupBy("block").cogroup(chosen.groupBy("block")).applyInArrow(_send(parts), MESSAGE)
    answers = counts.groupBy("part").applyInArrow(_answer, MESSAGE)
    told = answers.unionByName(chosen, allowMissingColumns=True)
    return texts.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_score(parts), SCORES)


def op10_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").where("quality = 1")
    return cross_entropy_difference(table(spark, sf_dir, "documents"), good)
