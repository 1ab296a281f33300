"""Dense cosines of many queries with many vectors (SIM-14), exact to the bit, by blocks in one task.

Products of unit vectors, taken block by block, only say which pairs can be among the
best; those are scored again as ``similarity.cosine`` does it, component by component,
and ranked by that.  What the products cannot bound (values that are not finite, norms
that are zero or extreme, vectors of another length) is scored that way from the start.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Queries and records of a block of products.
QUERY_ROWS, RECORD_ROWS = 1024, 1024
#: Norms whose products neither overflow nor vanish.
LEAST, MOST = 1e-100, 1e100


class Vectors:
    """A column of vectors as a matrix that is padded with zeros; ``lost`` are those that are null or hold a null."""

    def __init__(self, matrix: np.ndarray, length: np.ndarray, lost: np.ndarray):
        self.matrix, self.length, self.lost = matrix, length, lost

    @classmethod
    def of(cls, column: pa.Array) -> Vectors:
        flat = column.flatten()
        length = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(np.arange(len(column)), length)
        at = np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)
        matrix = np.zeros((len(column), int(length.max(initial=0))))
        matrix[row, at] = pc.fill_null(flat, 0.0).to_numpy(zero_copy_only=False)
        lost = column.is_null().to_numpy(zero_copy_only=False)
        lost[row[flat.is_null().to_numpy(zero_copy_only=False)]] = True
        matrix[lost] = 0.0
        return cls(matrix, np.where(lost, 0, length), lost)

    @classmethod
    def joined(cls, parts: list[Vectors]) -> Vectors:
        width = max(p.matrix.shape[1] for p in parts)
        wide = [np.pad(p.matrix, ((0, 0), (0, width - p.matrix.shape[1]))) for p in parts]
        return cls(np.concatenate(wide), np.concatenate([p.length for p in parts]), np.concatenate([p.lost for p in parts]))

    def take(self, rows: np.ndarray | slice) -> Vectors:
        return Vectors(self.matrix[rows], self.length[rows], self.lost[rows])

    def measure(self) -> Vectors:
        """Adds the columns, the norms, and which rows products of unit vectors can bound."""
        self.columns = np.ascontiguousarray(self.matrix.T)
        square = np.zeros(len(self.matrix))
        for x in self.columns:
            square += x * x
        self.norm = np.sqrt(square)
        self.plain = ~self.lost & (self.norm >= LEAST) & (self.norm <= MOST)
        return self


def _scores(q: Vectors, i: np.ndarray, c: Vectors, j: np.ndarray, bare: bool) -> tuple[np.ndarray, np.ndarray]:
    """Cosines of pairs, and their class: 2 not a number, 1 a number, 0 null."""
    total = np.zeros(np.broadcast_shapes(i.shape, j.shape))
    for x, y in zip(q.columns, c.columns):
        total += x[i] * y[j]
    size = q.norm[i] * c.norm[j]
    lost, unlike = q.lost[i] | c.lost[j], q.length[i] != c.length[j]
    if bare:
        null, value = lost | unlike, total / size
    else:
        none = lost | (size <= 0)
        null, value = unlike & ~none, np.where(none, 0.0, total / size)
    kind = np.where(null, 0, np.where(np.isnan(value), 2, 1)).astype(np.int8)
    return np.where(kind == 1, value, 0.0), kind


class _Best:
    """The k best pairs of each query so far, flat; ``kind`` and ``value`` of each query's k-th (-1: none yet)."""

    def __init__(self, queries: int, k: int):
        self.k, self.kind, self.value = k, np.full(queries, -1, np.int8), np.zeros(queries)
        self.found = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.empty(0, np.int8))

    def add(self, *pairs: np.ndarray) -> None:
        """``pairs``: query, record, value, kind; ties go to the smaller record."""
        if not len(pairs[0]):
            return
        query, record, value, kind = (np.concatenate(two) for two in zip(self.found, pairs))
        order = np.lexsort((record, -value, -kind, query))
        groups = query[order]
        first = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
        place = np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)]))
        last, order = order[place == self.k - 1], order[place < self.k]
        self.kind[query[last]], self.value[query[last]] = kind[last], value[last]
        self.found = query[order], record[order], value[order], kind[order]

    def floor(self, margin: float) -> np.ndarray:
        """The least product of unit vectors that can still be among the best."""
        return np.where(self.kind == 1, self.value - margin, np.where(self.kind == 2, np.inf, -np.inf))


class Records:
    """Codes and vectors in order of code; of equal vectors the first k, as no query can have more among its best."""

    def __init__(self, k: int, bare: bool):
        self.k, self.bare = k, bare
        self.parts: list[Vectors] = []
        self.names: list[pa.Array] = []
        self.seen: dict[tuple[int, bytes], int] = {}
        self.vectors: Vectors | None = None

    def add(self, codes: pa.Array, column: pa.Array) -> None:
        new, keep = Vectors.of(column), []
        for i, (length, lost) in enumerate(zip(new.length.tolist(), new.lost.tolist())):
            key = (-1 if lost else length, new.matrix[i, :length].tobytes())
            n = self.seen[key] = self.seen.get(key, 0) + 1
            if n <= self.k:
                keep.append(i)
        self.parts.append(new.take(np.array(keep, np.int64)))
        self.names.append(codes.take(pa.array(keep, pa.int64())))

    def close(self) -> None:
        self.vectors = Vectors.joined(self.parts).measure()
        self.codes = pa.concat_arrays(self.names)
        self.units: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.parts, self.names, self.seen = [], [], {}

    def unit(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and unit vectors of the plain records of a length."""
        if length not in self.units:
            v = self.vectors
            at = np.flatnonzero(v.plain & (v.length == length))
            self.units[length] = at, v.matrix[at, :length] / v.norm[at, None]
        return self.units[length]

    def nearest(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Of each query the k best: query, record, cosine, whether it is null."""
        if self.vectors is None:
            self.close()
        asked = Vectors.of(column).measure()
        for length in np.unique(asked.length[asked.plain]).tolist():
            yield from self._blocks(asked, np.flatnonzero(asked.plain & (asked.length == length)), self._plain)
        yield from self._blocks(asked, np.flatnonzero(~asked.plain), self._any)

    def _blocks(self, asked: Vectors, rows: np.ndarray, search: Callable[[Vectors, _Best], None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        for a in range(0, len(rows), QUERY_ROWS):
            own = rows[a : a + QUERY_ROWS]
            best = _Best(len(own), self.k)
            search(asked.take(own).measure(), best)
            query, record, value, kind = best.found
            yield own[query], record, np.where(kind == 2, np.nan, value), kind == 0

    def _each(self, q: Vectors, records: np.ndarray, best: _Best) -> None:
        """Every pair's own score; ``records`` are in order, so that a later one loses a tie."""
        for a in range(0, len(records), RECORD_ROWS):
            own = records[a : a + RECORD_ROWS]
            value, kind = _scores(q, np.arange(len(q.norm))[:, None], self.vectors, own[None, :], self.bare)
            least, among = best.value[:, None], best.kind[:, None]
            i, j = np.nonzero((kind > among) | ((kind == among) & (value > least)))
            best.add(i, own[j], value[i, j], kind[i, j])

    def _any(self, q: Vectors, best: _Best) -> None:
        self._each(q, np.arange(len(self.vectors.norm)), best)

    def _plain(self, q: Vectors, best: _Best) -> None:
        """Queries that are plain and of one length."""
        length, v = int(q.length[0]), self.vectors
        # a plain record of another length has no cosine: the first k stand for all
        others = np.flatnonzero(v.plain & (v.length != length))[: self.k]
        self._each(q, np.sort(np.concatenate([np.flatnonzero(~v.plain), others])), best)
        at, unit = self.unit(length)
        mine = q.matrix[:, :length] / q.norm[:, None]
        # more than the rounding of both ways to a cosine
        margin = 8 * (length + 8) * 2.0**-52
        for a in range(0, len(at), RECORD_ROWS):
            product = mine @ unit[a : a + RECORD_ROWS].T
            floor = best.floor(margin)
            if a == 0 and product.shape[1] > self.k:
                floor = np.maximum(floor, np.partition(product, -self.k, axis=1)[:, -self.k] - 2 * margin)
            i, j = np.nonzero(product >= floor[:, None])
            value, kind = _scores(q, i, v, at[a + j], self.bare)
            best.add(i, at[a + j], value, kind)


def search(k: int, bare: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow: rows of __share, __asked, query, code and vector, by share, records (by code) before queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share, records = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            shares = batch.column("__share").to_numpy(zero_copy_only=False)
            asked = batch.column("__asked").to_numpy(zero_copy_only=False)
            turns = np.flatnonzero((shares[1:] != shares[:-1]) | (asked[1:] != asked[:-1])) + 1
            for a, b in zip([0, *turns.tolist()], [*turns.tolist(), len(shares)]):
                rows = batch.slice(a, b - a)
                if shares[a] != share:
                    share, records = shares[a], Records(k, bare)
                if not asked[a]:
                    records.add(rows.column("code"), rows.column("vector"))
                elif records.parts or records.vectors is not None:
                    with np.errstate(all="ignore"):
                        for query, record, value, null in records.nearest(rows.column("vector")):
                            columns = [rows.column("query").take(pa.array(query)), records.codes.take(pa.array(record)), pa.array(value, mask=null)]
                            yield pa.RecordBatch.from_arrays(columns, names=["query", "code", "cosine"])

    return run
