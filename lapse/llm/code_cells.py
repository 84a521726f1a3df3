"""Vector codes (product quantisation in whole numbers) with memoised grid cells.

Vectors are scaled to integers and cut into parts; a part's code is the index of the nearest entry of its codebook. A part
lies in a cell of a coarse grid. For a cell it is worked out once which entries can be nearest to a point in it: an entry whose least
distance to the cell's box exceeds the least of the entries' greatest distances is dominated everywhere in the box.
The cells' entries are kept in a memo under the cell's hash, and only these entries are evaluated exactly.
The codebooks are refined in rounds: Spark sums the parts per entry, the driver holds the codebooks alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.llm.common import staged
from lapse.llm.vectors import matrix, numbered
from lapse.llm.wordarrays import mix, powers

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Cells that a memo holds at most; a full one is begun anew, which changes no result.
MEMO_CELLS = 1 << 18
USUAL_CELLS = 1 << 16
#: Integers up to this size keep every squared distance of a part within 64 bits; beyond, Python's integers are used.
_SAFE = 1 << 26


def scaled(vectors: np.ndarray, parts: int, scale: int = SCALE) -> np.ndarray:
    """(rows, parts, width) integers floor(scale * x); zeros fill up vectors that the parts do not divide."""
    whole = np.floor(scale * vectors)
    fill = -vectors.shape[1] % parts
    whole = np.pad(whole, ((0, 0), (0, fill)))
    whole = whole.astype(np.int64) if np.abs(whole).max(initial=0) < _SAFE else np.vectorize(int, otypes=[object])(whole)
    return whole.reshape(len(whole), parts, -1)


def cell_side(entries: np.ndarray) -> int:
    """A power of two that cuts the space four spreads wide of the entries into about ``USUAL_CELLS`` cells, however many components a part has."""
    spread = float(np.std(entries.astype(np.float64)))
    return 1 << max(0, round(float(np.log2(max(spread, 1.0))) + 2 - np.log2(USUAL_CELLS) / entries.shape[1]))


class Memo:
    """One part's codebook, and the entries that can be nearest in the cells met so far."""

    def __init__(self, entries: np.ndarray):
        self.entries, self.side = entries, cell_side(entries)
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.cells = np.zeros((0, self.entries.shape[1]), np.int64)
        self.possible = np.zeros((0, len(self.entries)), bool)

    def undominated(self, cells: np.ndarray) -> np.ndarray:
        """(cells, entries): whether an entry can be nearest to a point of the cell's box."""
        out = np.ones((len(cells), len(self.entries)), bool)
        for k in range(0, len(cells), 4096):
            low = (cells[k:k + 4096] * self.side)[:, None, :]
            high = low + (self.side - 1)
            gap = np.maximum(np.maximum(low - self.entries, self.entries - high), 0)
            reach = np.maximum(np.abs(self.entries - low), np.abs(high - self.entries))
            out[k:k + 4096] = (gap * gap).sum(2) <= (reach * reach).sum(2).min(1)[:, None]
        return out

    def entries_for(self, points: np.ndarray) -> np.ndarray:
        """(points, entries): the entries to be evaluated for each point."""
        cells = points // self.side
        key = mix((cells.astype(np.uint64) * powers(cells.shape[1])).sum(1, dtype=np.uint64))
        distinct, first, of = np.unique(key, return_index=True, return_inverse=True)
        new = ~np.isin(distinct, self.hashes)
        if new.any():
            if len(self.hashes) + new.sum() > MEMO_CELLS:
                self._forget()
                new[:] = True
            fresh = cells[first[new]]
            at = np.argsort(hashes := np.append(self.hashes, distinct[new]))
            self.hashes = hashes[at]
            self.cells = np.concatenate([self.cells, fresh])[at]
            self.possible = np.concatenate([self.possible, self.undominated(fresh)])[at]
        at = np.searchsorted(self.hashes, distinct)[of]
        # cells that share a hash with another one are evaluated in full
        return self.possible[at] | (self.cells[at] != cells).any(1)[:, None]

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each point's nearest entry, the lower index of equally near ones."""
        if points.dtype == object:
            distance = ((points[:, None, :] - self.entries) ** 2).sum(2)
            entry = distance.argmin(1)
            return entry, distance[np.arange(len(points)), entry]
        point, entry = np.nonzero(self.entries_for(points))
        apart = points[point] - self.entries[entry]
        distance = np.einsum("ij,ij->i", apart, apart)
        starts = np.flatnonzero(np.append(True, point[1:] != point[:-1]))
        least = np.minimum.reduceat(distance, starts)
        hit = np.flatnonzero(distance == np.repeat(least, np.diff(np.append(starts, len(point)))))
        hit = hit[np.append(True, point[hit][1:] != point[hit][:-1])]
        return entry[hit], least


def _memos(codebooks: list) -> list[Memo]:
    books = np.array(codebooks, dtype=object)
    books = books.astype(np.int64) if all(abs(x) < _SAFE for x in books.ravel()) else books
    return [Memo(b) for b in books]


def _assigned(batches: Iterator[pa.RecordBatch], codebooks: list, width: int, scale: int) -> Iterator[tuple]:
    memos = _memos(codebooks)
    for batch in batches:
        if batch.num_rows:
            points = scaled(matrix(batch.column("vec"), width), len(memos), scale)
            if memos[0].entries.dtype == object:
                points = points.astype(object)
            yield batch, points, [m.nearest(points[:, p]) for p, m in enumerate(memos)]


def _summer(codebooks: list, width: int, scale: int):
    """A mapInArrow function: per part, entry and component the sum and the number of its vectors in the task."""
    shape = len(codebooks), len(codebooks[0]), len(codebooks[0][0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(shape, object), np.zeros(shape[:2], np.int64)
        for _, points, found in _assigned(batches, codebooks, width, scale):
            for p, (entry, _) in enumerate(found):
                order = np.argsort(entry, kind="stable")
                used, starts = np.unique(entry[order], return_index=True)
                sums[p][used] += np.add.reduceat(points[order, p], starts, axis=0).astype(object)
                counts[p] += np.bincount(entry, minlength=shape[1])
        part, entry = np.nonzero(counts)
        at = np.arange(shape[2])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(part, shape[2])), pa.array(np.repeat(entry, shape[2])), pa.array(np.tile(at, len(part))),
             pa.array([int(x) for x in sums[part, entry].ravel()], pa.decimal128(38, 0)), pa.array(np.repeat(counts[part, entry], shape[2]))],
            ["part", "entry", "at", "total", "n"])

    return run


def _coder(codebooks: list, width: int, scale: int):
    """A mapInArrow function: id, label, code and error of each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, found in _assigned(batches, codebooks, width, scale):
            digits = np.stack([entry for entry, _ in found], 1)
            code = ["".join(f"{d:02x}" for d in row) for row in digits.tolist()]
            error = sum(np.asarray(least).astype(object) for _, least in found)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(code, pa.string()),
                                              pa.array([int(e) for e in error], pa.int64())], ["id", "label", "code", "error"])

    return run


def refine(vectors: DataFrame, codebooks: list, width: int, scale: int = SCALE) -> list:
    """The codebooks after one round: each entry is the floor of the mean of its parts; unused entries stay."""
    sums = vectors.select("vec").mapInArrow(_summer(codebooks, width, scale), "part long, entry long, at long, total decimal(38,0), n long")
    out = [[list(entry) for entry in book] for book in codebooks]
    for r in sums.groupBy("part", "entry", "at").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():  # parts * entries * width rows
        out[r["part"]][r["entry"]][r["at"]] = int(r["total"]) // r["n"]
    return out


def digest(codebooks: list) -> str:
    return hashlib.sha256(",".join(str(x) for book in codebooks for entry in book for x in entry).encode()).hexdigest()


def fit(vectors: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> list:
    """Codebooks [part][entry][component], begun with the parts of the vectors of the smallest ids and refined over all vectors."""
    first = vectors.orderBy(F.asc_nulls_last("id"), "vec", "rid").select("vec").limit(entries).collect()
    if not first:
        return []
    start = scaled(np.array([r["vec"] for r in first], np.float64), parts, scale)
    codebooks = [[[int(x) for x in start[e, p]] for e in range(len(first))] for p in range(parts)]
    for _ in range(rounds):
        codebooks = refine(vectors, codebooks, width, scale)
    return codebooks


def compress(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """One row per vector: vec_id, code (two hex digits per part), error, label_error, codebooks_sha256.

    Rows that ``numbered`` leaves out (null, empty, non-finite, of another length) have no code. Vectors whose length the parts do not
    divide are filled up with zeros. Codebooks begin with the rows of the smallest ids (nulls last, then by vector); with fewer rows they
    have fewer entries. Rows that repeat an id have a row each. ``label_error`` adds up the errors of a label's rows, null labels
    together. An empty table gives an empty result. Integers are exact at any size; an error beyond 64 bits raises. Other columns are not read.
    """
    vectors, width = numbered(rows, id_col, vector_col, label_col, "codes")
    codebooks = fit(vectors, width, parts, entries, rounds, scale)
    schema = vectors.select("id", "label").schema.add("code", "string").add("error", "long")
    if codebooks:
        coded = vectors.select("id", "label", "vec").mapInArrow(_coder(codebooks, width, scale), schema)
    else:
        coded = rows.sparkSession.createDataFrame([], schema)
    coded = staged(coded, "coded")
    per_label = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    return coded.join(per_label, coded.label.eqNullSafe(per_label.of)).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256"))
