"""Token-ID files: documents as one stream of ids in patched frame-of-reference blocks.

Documents are put in order of doc_id (nulls first, equal ids by the hash of
their text) by a range partitioning.  Each partition streams into shards of at
most about ``SHARD_IDS`` ids or ``SHARD_DOCS`` documents: ``shard-PPPPP-NNNN.pfor``
(the ids, see ``pfor``), ``.counts`` (the number of ids of each document, such a
file too) and ``.docs`` (their doc_ids, an Arrow file).  A task holds one slice
of texts and the indexes of the shard that it writes, whatever its partition's
size.  Files appear under their names only when complete, and a task that runs
again writes the same bytes, so a lost executor costs no more than its own shards.

Tokenizing uses the tokenizers library on distinct words where the tokenizer's
file has the settings under which white space always separates pre-tokens and
lower case may come first (``SPLITS_AT_SPACE``): a batch's distinct words are
encoded once and the ids put together by gathering.  With other settings, and for
texts that hold a special token's opening, whole texts are encoded.

Defined results: a null text is empty and has the end id alone; repeated rows
are written again; an empty table gives no shards and no rows; documents of any
length are encoded whole.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import pfor
from .common import AtomicFile, Scratch, open_fs, small_batches, table
from .shingles import release_memory, slices

END_ID = 2
#: Distinct words of a generation whose ids a worker keeps; beyond it the words not met since the last time go.
CACHE_WORDS = 200_000
#: A shard is closed when it has so many ids or documents.
SHARD_IDS, SHARD_DOCS = 1 << 26, 1 << 20
#: Bytes of text that are encoded at a time.
SLICE = 1 << 23
#: The normaliser and the pre-tokenizer that texts may be cut into words for, and the beginning of special tokens.
SPLITS_AT_SPACE = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
)
SPECIAL = "<|"
_TOKENIZERS: dict[str, object] = {}
_IDS: dict[str, list[dict[str, bytes]]] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


_DOCS = pa.schema([("doc_id", pa.int64())])
_MANIFEST = pa.schema([("part", pa.int64()), ("number", pa.int64()), ("path", pa.string()), ("docs", pa.int64()), ("ids", pa.int64())])


def _tokenizer(path: str):
    if path not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            stated = json.load(f)
        by_words = (stated["normalizer"], stated["pre_tokenizer"]) == SPLITS_AT_SPACE and all(t["content"].startswith(SPECIAL) for t in stated["added_tokens"])
        _TOKENIZERS[path] = Tokenizer.from_file(path), by_words
        _IDS[path] = [{}, {}]
    return _TOKENIZERS[path]


def _word_ids(words: list[str], tokenizer, known: list[dict[str, bytes]]) -> list[bytes]:
    """Ids of each word, as bytes; two generations of words are kept, and a word that is met moves to the younger."""
    if len(known[0]) > CACHE_WORDS:
        known[:] = [{}, known[0]]
    young, old = known
    out = list(map(young.get, words))
    missing = [i for i, x in enumerate(out) if x is None]
    new = []
    for i in missing:
        w = words[i]
        if w in old:
            out[i] = young[w] = old[w]
        else:
            new.append(i)
    if new:
        for i, e in zip(new, tokenizer.encode_batch_fast([words[i] for i in new], add_special_tokens=False)):
            out[i] = young[words[i]] = array("I", e.ids).tobytes()
    return out


def encode_texts(column: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts on end (no end ids), and the number of ids of each text."""
    tokenizer, by_words = _tokenizer(path)
    known = _IDS[path]
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = pc.fill_null(column.cast(pa.large_string()), "")
    whole = pc.match_substring(column, SPECIAL).to_numpy(zero_copy_only=False) if by_words else np.ones(len(column), bool)
    plain = column if not whole.any() else pc.if_else(pa.array(~whole), column, pa.scalar("", pa.large_string()))
    # what the normaliser and the pre-tokenizer do anyway: ASCII lower case, a cut between a letter and a sign
    plain = pc.replace_substring_regex(pc.ascii_lower(plain), r"([a-z])([!-&(-/:-@\[-`{-~])", r"\1 \2")
    words = pc.ascii_split_whitespace(plain)
    del plain
    flat = words.flatten().dictionary_encode()
    edges = np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False))]).astype(np.int64)
    del words
    pieces = _word_ids(flat.dictionary.to_numpy(zero_copy_only=False).tolist(), tokenizer, known)
    # a slice has fewer than 2**31 ids
    lengths = np.fromiter(map(len, pieces), np.int32, len(pieces)) // np.int32(4)
    pool = np.frombuffer(b"".join(pieces), np.uint32)
    begins = np.cumsum(lengths, dtype=np.int32) - lengths
    which = flat.indices.to_numpy(zero_copy_only=False)
    del pieces, flat
    n = lengths[which]
    ends = np.cumsum(n, dtype=np.int32)
    at = np.repeat(begins[which] - (ends - n), n)
    at += np.arange(len(at), dtype=np.int32)
    ids = pool[at]
    word_ends = np.concatenate([[0], ends])
    per_text = word_ends[edges[1:]] - word_ends[edges[:-1]]
    del which, n, ends, at
    if whole.any():
        offsets = np.concatenate([[0], np.cumsum(per_text)])
        parts = [ids[offsets[i] : offsets[i + 1]] for i in range(len(column))]
        for i in np.flatnonzero(whole).tolist():
            parts[i] = np.array(tokenizer.encode(column[i].as_py(), add_special_tokens=False).ids, np.uint32)
        per_text = np.fromiter(map(len, parts), np.int64, len(parts))
        ids = np.concatenate(parts)
    return ids, per_text


def with_end(ids: np.ndarray, per_text: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with an end id after each text."""
    return np.insert(ids, np.cumsum(per_text), np.uint32(end_id)), per_text + 1


def _released(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The parts, with freed memory given back at every eighth."""
    for i, part in enumerate(parts):
        yield part
        if i % 8 == 7:
            release_memory()


class _Shard:
    """The files of a shard that is being written."""

    def __init__(self, name: str, percentile: float):
        self.name = name
        self.files = [AtomicFile(f"{name}.{kind}") for kind in ("pfor", "counts", "docs")]
        self.ids, self.counts = pfor.Writer(self.files[0], percentile), pfor.Writer(self.files[1], percentile)
        self.docs = pa.ipc.new_file(self.files[2].out, _DOCS)

    def write(self, ids: np.ndarray, counts: np.ndarray, keys: pa.Array) -> None:
        self.ids.write(ids)
        self.counts.write(counts.astype(np.uint32))
        self.docs.write_batch(pa.record_batch([keys], schema=_DOCS))

    def full(self) -> bool:
        return self.ids.n >= SHARD_IDS or self.counts.n >= SHARD_DOCS

    def close(self) -> tuple[str, int, int]:
        self.ids.close()
        self.counts.close()
        self.docs.close()
        for f in self.files:
            f.__exit__(None, None, None)
        return self.name, self.counts.n, self.ids.n

    def give_up(self, e: BaseException) -> None:
        for f in self.files:
            f.__exit__(type(e), e, None)


def _write_shards(folder: str, path: str, end_id: int, percentile: float):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, shard, done = TaskContext.get().partitionId(), 0, None, []
        try:
            for batch in _released(part for whole in batches for part in slices(whole, "text", SLICE)):
                if shard is None:
                    shard = _Shard(f"{folder}/shard-{part:05d}-{number:04d}", percentile)
                ids, counts = with_end(*encode_texts(batch.column("text"), path), end_id)
                shard.write(ids, counts, batch.column("doc_id").cast(pa.int64()))
                if shard.full():
                    done.append((part, number, *shard.close()))
                    shard, number = None, number + 1
            if shard is not None:
                done.append((part, number, *shard.close()))
                shard = None
        except BaseException as e:
            if shard is not None:
                shard.give_up(e)
            raise
        columns = list(zip(*done)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _MANIFEST.types)], schema=_MANIFEST)

    return write


def write_token_files(docs: DataFrame, folder: str, *, tokenizer: str | None = None, end_id: int = END_ID, percentile: float = 0.9) -> DataFrame:
    """Writes ``docs`` (doc_id, text) to ``folder``; returns the manifest: path, docs, ids, start.

    The manifest, a row for each shard, passes through the driver, which adds up the starts.
    """
    spark = docs.sparkSession
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .withColumn("k", F.xxhash64("text"))
        .repartitionByRange("doc_id", "k")
        .sortWithinPartitions("doc_id", "k")
        .select("doc_id", "text")
    )
    with small_batches(spark, 5000):
        shards = ordered.mapInArrow(_write_shards(folder, tokenizer or default_tokenizer(), end_id, percentile), "part long, number long, path string, docs long, ids long").collect()
    rows, start = [], 0
    for r in sorted(shards, key=lambda r: (r["part"], r["number"])):
        rows.append((r["path"], r["docs"], r["ids"], start))
        start += r["ids"]
    return spark.createDataFrame(rows, "path string, docs long, ids long, start long")


def _open(uri: str) -> pa.NativeFile:
    fs, at = open_fs(uri)
    return fs.open_input_file(at)


def read_shard(path: str) -> tuple[pa.Array, np.ndarray, pfor.Reader]:
    """doc_id of each document of a shard, its number of ids, and the reader of the ids."""
    with _open(f"{path}.counts") as counts, _open(f"{path}.docs") as docs:
        keys = pa.ipc.open_file(docs).read_all().column("doc_id").combine_chunks()
        return keys, pfor.Reader(counts).values().astype(np.int64), pfor.Reader(_open(f"{path}.pfor"))


#: Ids decoded at a time when a shard is read back.
READ_IDS = 1 << 20


def _read_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
            keys, counts, reader = read_shard(path)
            edges = np.concatenate([[0], np.cumsum(counts)])
            i = 0
            while i < len(counts):
                j = max(i + 1, int(np.searchsorted(edges, edges[i] + READ_IDS, side="right")) - 1)
                ids = reader.values(int(edges[i]), int(edges[j])).astype("<u4")
                own = edges[i : j + 1] - edges[i]
                raw = ids.tobytes()
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(own[:-1].tolist(), own[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [keys[i:j], pa.array(start + edges[i:j], pa.int64()), pa.array(counts[i:j], pa.int64()), pa.array(sums, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )
                i = j
            reader.file.close()
            release_memory()


def read_token_files(manifest: DataFrame) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    n = max(1, manifest.count())
    return manifest.select("path", "start").repartition(n).mapInArrow(_read_documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_documents(docs: DataFrame, **how) -> DataFrame:
    """Writes token files below the shared folder and reads them back."""
    scratch = Scratch(docs.sparkSession, "tokens")
    manifest = write_token_files(docs, scratch.folder("files"), **how)
    return read_token_files(manifest)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_documents(table(spark, sf_dir, "documents"))
