"""Patched frame-of-reference coding of unsigned 32-bit integers.

A stream is cut into blocks of ``BLOCK`` values.  A block stores its minimum and
packs the differences from it at one width, chosen so that ``percentile`` of the
differences fit; those that do not fit keep their low bits in place, and an
exception list holds their positions and high bits.  An index of block starts
lets a reader decode any range without touching the blocks before it.

Files are written front to back by a ``Writer`` that holds one piece and the
index, and read by ranges: a ``Reader`` holds the index and the blocks it is
asked for.

File layout (little-endian)::

    magic "TLPF" | u32 version | u32 block size
    blocks, each: u32 minimum | u8 width | u16 exceptions | packed words (u64)
                  | exception positions (u16 each) | exception high bits (u32 each)
    index: u64 start of every block, then u64 end of the last
    u64 values | u64 index offset
"""

from __future__ import annotations

import io
import struct

import numpy as np
import pyarrow as pa

MAGIC, VERSION, BLOCK = b"TLPF", 2, 256
HEADER, FOOTER = struct.Struct("<4sII"), struct.Struct("<QQ")
_BLOCK_HEAD = struct.Struct("<IBH")
#: Values that are packed at a time.
PIECE = BLOCK << 11


def _bit_length(x: np.ndarray) -> np.ndarray:
    """Bits of each value: 0 for 0."""
    return np.where(x == 0, 0, np.floor(np.log2(np.maximum(x, 1).astype(np.float64))).astype(np.int64) + 1)


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of BLOCK values below 2**width, as rows of packed u64 words (BLOCK / 64 * width of them)."""
    rows = len(values)
    lanes = values.reshape(rows, -1, 64).transpose(2, 0, 1).astype(np.uint64)
    out = np.zeros((width, rows, lanes.shape[2]), np.uint64)
    for j in range(64):
        word, off = divmod(j * width, 64)
        out[word] |= lanes[j] << np.uint64(off)
        if off + width > 64:
            out[word + 1] |= lanes[j] >> np.uint64(64 - off)
    return np.ascontiguousarray(out.transpose(1, 2, 0)).reshape(rows, -1)


def unpack(words: np.ndarray, width: int, block: int = BLOCK) -> np.ndarray:
    rows = len(words)
    if width == 0:
        return np.zeros((rows, block), np.uint64)
    lanes = words.reshape(rows, block // 64, width).transpose(2, 0, 1)
    out, mask = np.empty((64, rows, block // 64), np.uint64), np.uint64((1 << width) - 1)
    for j in range(64):
        word, off = divmod(j * width, 64)
        x = lanes[word] >> np.uint64(off)
        if off + width > 64:
            x = x | (lanes[word + 1] << np.uint64(64 - off))
        out[j] = x & mask
    return np.ascontiguousarray(out.transpose(1, 2, 0)).reshape(rows, block)


def _encode_blocks(grid: np.ndarray, percentile: float) -> tuple[bytes, np.ndarray]:
    """Rows of BLOCK values as blocks on end, and the size of each."""
    blocks = len(grid)
    low = grid.min(axis=1)
    rest = grid - low[:, None]
    rank = min(BLOCK - 1, int(np.ceil(percentile * BLOCK)) - 1)
    width = _bit_length(np.partition(rest, rank, axis=1)[:, rank])
    high = (rest.astype(np.uint64) >> width[:, None].astype(np.uint64)).astype(np.uint32)
    at_row, at = np.nonzero(high)
    exceptions = np.bincount(at_row, minlength=blocks).astype(np.int64)
    e_edge = np.concatenate([[0], np.cumsum(exceptions)])
    sizes = _BLOCK_HEAD.size + width * (BLOCK // 8) + exceptions * 6
    packed: list[bytes] = [b""] * blocks
    for w in np.unique(width):
        if w:
            rows = np.flatnonzero(width == w)
            words = pack(rest[rows].astype(np.uint64) & np.uint64((1 << int(w)) - 1), int(w))
            for r, row in zip(rows.tolist(), words):
                packed[r] = row.tobytes()
    at16, high32 = at.astype("<u2").tobytes(), high[at_row, at].astype("<u4").tobytes()
    out = []
    for b, (w, m, e0, e1) in enumerate(zip(width.tolist(), low.tolist(), e_edge[:-1].tolist(), e_edge[1:].tolist())):
        out += [_BLOCK_HEAD.pack(m, w, e1 - e0), packed[b], at16[2 * e0 : 2 * e1], high32[4 * e0 : 4 * e1]]
    return b"".join(out), sizes


class Writer:
    """Writes a stream that comes in pieces of any length to ``out`` (something with ``write``)."""

    def __init__(self, out, percentile: float = 0.9):
        self.out, self.percentile, self.n, self.at = out, percentile, 0, HEADER.size
        self.held: list[np.ndarray] = []
        self.waiting = 0
        self.starts = [np.array([HEADER.size], np.int64)]
        out.write(HEADER.pack(MAGIC, VERSION, BLOCK))

    def write(self, values: np.ndarray) -> None:
        self.held.append(np.ascontiguousarray(values, np.uint32))
        self.waiting += len(values)
        self.n += len(values)
        if self.waiting >= PIECE:
            self._flush(self.waiting // BLOCK * BLOCK)

    def _flush(self, n: int) -> None:
        values = np.concatenate(self.held)
        for i in range(0, n, PIECE):
            data, sizes = _encode_blocks(values[i : min(n, i + PIECE)].reshape(-1, BLOCK), self.percentile)
            self.out.write(data)
            self.starts.append(self.at + np.cumsum(sizes))
            self.at += len(data)
        self.held, self.waiting = [values[n:].copy()], len(values) - n

    def close(self) -> None:
        """The last block, padded with its last value, and the index."""
        if self.waiting:
            last = np.concatenate(self.held)
            self.held = [np.append(last, np.full(-len(last) % BLOCK, last[-1], np.uint32))]
            self._flush(len(self.held[0]))
        self.out.write(np.concatenate(self.starts).astype("<u8").tobytes())
        self.out.write(FOOTER.pack(self.n, self.at))


def encode(values: np.ndarray, percentile: float = 0.9) -> bytes:
    """A whole file."""
    out = io.BytesIO()
    writer = Writer(out, percentile)
    writer.write(values)
    writer.close()
    return out.getvalue()


class Reader:
    """Decodes any range of a file's values through its block index; ``file`` is bytes or an open Arrow file."""

    def __init__(self, file: bytes | pa.NativeFile):
        self.file = pa.BufferReader(file) if isinstance(file, bytes) else file
        size = self.file.size()
        if size < HEADER.size + FOOTER.size:
            raise ValueError("not a patched frame-of-reference file")
        magic, version, self.block = HEADER.unpack(self._bytes(0, HEADER.size))
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a patched frame-of-reference file of this version")
        self.n, index = FOOTER.unpack(self._bytes(size - FOOTER.size, size))
        if size - FOOTER.size - index != 8 * (-(-self.n // self.block) + 1):
            raise ValueError("the block index is cut off")
        self.starts = np.frombuffer(self._bytes(index, size - FOOTER.size), "<u8").astype(np.int64)

    def _bytes(self, start: int, stop: int) -> bytes:
        return self.file.read_at(stop - start, start)

    def __len__(self) -> int:
        return self.n

    def blocks(self, first: int, last: int) -> np.ndarray:
        """Values of the blocks [first, last), the padding of the last block with them."""
        out = np.empty((last - first, self.block), np.uint32)
        if last <= first:
            return out.reshape(-1)
        starts = self.starts[first:last] - self.starts[first]
        data = memoryview(self._bytes(int(self.starts[first]), int(self.starts[last])))
        low, width, exceptions = (np.array(x, np.int64) for x in zip(*(_BLOCK_HEAD.unpack_from(data, s) for s in starts.tolist())))
        at = starts + _BLOCK_HEAD.size
        size = width * (self.block // 8)
        for w in np.unique(width).tolist():
            rows = np.flatnonzero(width == w)
            words = b"".join(data[s : s + w * (self.block // 8)] for s in at[rows].tolist())
            out[rows] = unpack(np.frombuffer(words, "<u8").reshape(len(rows), -1), w, self.block).astype(np.uint32)
        for r in np.flatnonzero(exceptions).tolist():
            s, e = int(at[r] + size[r]), int(exceptions[r])
            where = np.frombuffer(data[s : s + 2 * e], "<u2")
            out[r, where] |= (np.frombuffer(data[s + 2 * e : s + 6 * e], "<u4").astype(np.uint64) << np.uint64(width[r])).astype(np.uint32)
        out += low.astype(np.uint32)[:, None]
        return out.reshape(-1)

    def values(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        stop = self.n if stop is None else min(stop, self.n)
        if start >= stop:
            return np.zeros(0, np.uint32)
        first = start // self.block
        return self.blocks(first, -(-stop // self.block))[start - first * self.block : stop - first * self.block]
