"""Vectorised word and shingle hashing over Arrow string buffers.

Words are the maximal runs ``[^\\x20\\x09-\\x0D]+`` of the UTF-8 bytes, with
A-Z lower-cased.  A word's 64-bit hash is a polynomial over a fixed table of
random byte codes, taken from prefix sums modulo 2**64 so that a whole batch is
hashed by a handful of numpy passes; a shingle's hash mixes its words' hashes
in order.  Nothing here truncates a text: one longer than ``PIECE`` bytes is
hashed in pieces that are cut at white space.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

#: Bytes hashed at a time; bounds the temporary arrays to a few times 8 * PIECE.
PIECE = 1 << 21

_BASE = 0x9E3779B97F4A7C15 | 1  # odd, so that it has an inverse modulo 2**64
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_CODE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_CODE[65:91] = _CODE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**k and base**-k modulo 2**64 for k < n."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, PIECE + 1)
        inverse = pow(_BASE, -1, 1 << 64)
        _POWERS[:] = [
            np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)]))
            for b in (_BASE, inverse)
        ]
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def string_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (n + 1, relative) and bytes of a string column; a null is an empty string."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    column = column.cast(pa.large_binary()) if column.type != pa.large_binary() else column
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and len(column) else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0] : offsets[-1]]


def whole_words(starts: np.ndarray, ends: np.ndarray, total: np.ndarray, inverse: np.ndarray) -> np.ndarray:
    """Each word's hash, of the prefix sums ``total`` of a piece."""
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def _piece(data: np.ndarray, space: np.ndarray, features) -> tuple[np.ndarray, np.ndarray]:
    """Start of each word of a piece, and what ``features`` makes of it."""
    gap = space[data]
    edge = np.empty(len(data) + 1, bool)
    edge[0], edge[-1] = not gap[0], not gap[-1]
    np.not_equal(gap[1:], gap[:-1], out=edge[1:-1])
    at = np.flatnonzero(edge)
    starts, ends = at[::2], at[1::2]
    power, inverse = _powers(len(data) + 1)
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_CODE[data] * power[: len(data)], out=total[1:])
    return starts, features(starts, ends, total, inverse)


def word_hashes(offsets: np.ndarray, data: np.ndarray, space: np.ndarray = _SPACE, features=whole_words, empty=(0,)) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and offsets of each text's words.

    ``space`` tells the bytes between words; ``features`` makes a row of each word
    (``empty`` is the shape of no rows).  Texts meet without a separator in
    ``data``, so neighbours are moved apart; a text over PIECE is cut at a gap.
    """
    n = len(offsets) - 1
    hashes, counts = [], np.zeros(n, np.int64)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + PIECE, side="right")) - 1)
        begin, end = int(offsets[i]), int(offsets[j])
        if j == i + 1 and end - begin > PIECE:
            while begin < end:
                cut = min(begin + PIECE, end)
                if cut < end:
                    back = np.flatnonzero(space[data[begin:cut]])
                    if len(back):
                        cut = begin + int(back[-1]) + 1
                    else:  # one word longer than a piece
                        while cut < end and not space[data[cut]]:
                            cut += 1
                _, h = _piece(data[begin:cut], space, features)
                hashes.append(h)
                counts[i] += len(h)
                begin = cut
        elif end > begin:
            own = offsets[i : j + 1] - begin
            padded = np.full(end - begin + (j - i), 32, np.uint8)
            padded[np.arange(end - begin) + np.repeat(np.arange(j - i), np.diff(own))] = data[begin:end]
            starts, h = _piece(padded, space, features)
            counts[i:j] = np.diff(np.searchsorted(starts, own + np.arange(j - i + 1)))
            hashes.append(h)
        i = j
    return (np.concatenate(hashes) if hashes else np.zeros(empty, np.uint64)), np.concatenate([[0], np.cumsum(counts)])


def release_memory() -> None:
    """Gives freed memory back to the system, so that a worker does not hold on to its largest batch."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def slices(batch: pa.RecordBatch, column: str, most: int = 1 << 22) -> list[pa.RecordBatch]:
    """A batch in parts whose texts have about ``most`` bytes, so that a task's memory is bounded by that."""
    if not batch.num_rows:
        return []
    offsets, _ = string_buffers(batch.column(column))
    out, i = [], 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        # copied: some string kernels of Arrow misread the offsets of a slice
        out.append(batch.take(pa.array(np.arange(i, j))) if (i, j) != (0, batch.num_rows) or batch.column(column).offset else batch)
        i = j
    return out


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's shingles in order of place, and their offsets.

    A text of 1 to ``width`` - 1 words has its whole sequence as one shingle; one
    without words has none.
    """
    n_words = np.diff(bounds)
    counts = np.where(n_words >= width, n_words - width + 1, np.minimum(n_words, 1))
    out_bounds = np.concatenate([[0], np.cumsum(counts)])
    first = np.repeat(bounds[:-1] - out_bounds[:-1], counts) + np.arange(out_bounds[-1])
    long = np.repeat(n_words >= width, counts)
    at = first[long]
    value = words[at].copy()
    for k in range(1, width):
        value = mix(value) + words[at + k]
    out = np.empty(len(first), np.uint64)
    out[long] = mix(value)
    for i in np.flatnonzero((n_words < width) & (n_words > 0)):
        value = words[bounds[i] : bounds[i] + 1].copy()
        for k in range(1, int(n_words[i])):
            value = mix(value) + words[bounds[i] + k : bounds[i] + k + 1]
        out[out_bounds[i]] = mix(value + np.array([width - n_words[i]], np.uint64) * _M1)[0]
    return out, out_bounds


def shingle_sets(column: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    offsets, data = string_buffers(column)
    values, bounds = shingle_hashes(*word_hashes(offsets, data), width)
    return [np.unique(values[bounds[i] : bounds[i + 1]]) for i in range(len(bounds) - 1)]
