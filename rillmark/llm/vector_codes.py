"""Product quantization in integers: codebooks by rounds of nearest entries and floored means, nearest entries by memoised grid cells."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.llm.common import fields, stored

#: Parts of a vector, entries of a part's codebook, rounds and scale (fixed values of the contract).
PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Integers go up to this size (components from 32,768 on count as that); squared distances of 1,024 components then stay within 64 bits.
LARGEST = 1 << 25
#: Vectors from which the width of the grid's cells is chosen; results do not depend on it.
SAMPLE, LEFT = 256, 32
#: Cells bounded and distances computed at a time, and candidate lists remembered by a task for a part.
CELLS_AT_ONCE, PAIRS_AT_ONCE, MAX_CELLS = 256, 1 << 16, 1 << 15
#: A label with more than this share of all rows has its sum broadcast; there are fewer of them than this number.
HOT_LABELS = 1024


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each run, one run after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


class Grid:
    """Nearest entries of one codebook. Points fall into cells of side 2^shift; a cell's first visit lists the entries that can be nearest
    somewhere in its box (their least distance to it is at most the smallest of all greatest distances), and only those are evaluated."""

    def __init__(self, book: np.ndarray, shift: int):
        self.book, self.shift, self.cells = book.astype(np.int64), shift, {}
        self.evaluated = 0  # distances computed
        self.reals = self.book.astype(np.float64)
        self.squares = (self.reals**2).sum(1)

    def _bound(self, cells: np.ndarray) -> list[np.ndarray]:
        """The entries that are not dominated in each cell. Balls around the cells leave out most of the others, with slack for rounding."""
        low = cells << self.shift
        side = (1 << self.shift) - 1
        centre = low + side / 2
        squares = (centre**2).sum(1)
        distance = np.sqrt(np.maximum(squares[:, None] - 2 * (centre @ self.reals.T) + self.squares, 0))
        slack = 1 + side * np.sqrt(low.shape[1]) + np.sqrt((squares + self.squares.max()) * 1e-12)
        cell, entry = np.nonzero(distance <= (distance.min(1) + slack)[:, None])
        under, over = low[cell] - self.book[entry], self.book[entry] - low[cell] - side
        near = (np.maximum(np.maximum(under, over), 0) ** 2).sum(1)
        far = (np.maximum(under + side, over + side) ** 2).sum(1)
        begins = np.searchsorted(cell, np.arange(len(cells)))
        kept = near <= np.minimum.reduceat(far, begins)[cell]
        return np.split(entry[kept].astype(np.int32), np.cumsum(np.bincount(cell[kept], minlength=len(cells)))[:-1])

    def candidates(self, cells: np.ndarray, keys: list[bytes]) -> list[np.ndarray]:
        """The list of entries of each cell, from memory where it is there."""
        found = [self.cells.get(k) for k in keys]
        new = [i for i, f in enumerate(found) if f is None]
        if len(self.cells) + len(new) > MAX_CELLS:
            self.cells.clear()
        for at in range(0, len(new), CELLS_AT_ONCE):
            some = new[at : at + CELLS_AT_ONCE]
            for i, entries in zip(some, self._bound(cells[some])):
                found[i] = self.cells[keys[i]] = entries
        return found

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each point (ties: the lower index) and the squared distance."""
        entry, error = np.zeros(len(points), np.int64), np.zeros(len(points), np.int64)
        if not len(points):
            return entry, error
        cells = np.ascontiguousarray(points >> self.shift)
        named = cells.view(np.dtype((np.void, cells.itemsize * cells.shape[1]))).ravel()
        distinct, first, own = np.unique(named, return_index=True, return_inverse=True)
        lists = self.candidates(cells[first], [k.tobytes() for k in distinct])
        flat, sizes = np.concatenate(lists), np.array([len(x) for x in lists])
        starts, sizes = (np.cumsum(sizes) - sizes)[own], sizes[own]
        self.evaluated += int(sizes.sum())
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // PAIRS_AT_ONCE)) + 1
        for rows in np.split(np.arange(len(points)), cuts):
            each = np.repeat(rows, sizes[rows])
            tried = flat[_runs(starts[rows], sizes[rows])]
            gap = points[each] - self.book[tried]
            distances = np.einsum("ij,ij->i", gap, gap)
            error[rows] = np.minimum.reduceat(distances, np.cumsum(sizes[rows]) - sizes[rows])
            best = np.flatnonzero(distances == error[each])
            at, begins = np.unique(each[best], return_index=True)
            entry[at] = tried[best[begins]]
        return entry, error


def coarsest_shift(points: np.ndarray, book: np.ndarray) -> int:
    """The widest cells that leave, for ``points`` on average, at most one in LEFT of the entries to be evaluated."""
    shift = int(max(np.abs(points).max(initial=1), np.abs(book).max(initial=1))).bit_length()
    while shift > 0:
        grid = Grid(book, shift)
        grid.nearest(points)
        if grid.evaluated * LEFT <= len(points) * len(book):
            break
        shift -= 1
    return shift


@dataclass
class Codebooks:
    """The books (one array of entries for each part), the widths of their grids, and the width of a vector."""

    books: list[np.ndarray]
    shifts: list[int]
    width: int

    def grids(self) -> list[Grid]:
        return [Grid(b, s) for b, s in zip(self.books, self.shifts)]

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(x) for book in self.books for x in book.ravel().tolist()).encode()).hexdigest()


def integer_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v): floor(scale * x) of each component, LARGEST at most either way. Vectors that are missing or hold a missing or
    non-finite component are left out; repeated rows and rows without vec_id or label stay."""
    rows = fields(vectors, "vec_id", "embedding", "label").withColumn("embedding", F.col("embedding").cast("array<double>"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter("embedding is not null").filter(~bad)
    whole = F.transform("embedding", lambda x: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.floor(x * scale))).cast("int"))
    return rows.select("vec_id", "label", whole.alias("v"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """The vectors of a column as rows; shorter ones are filled with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(column.offsets.to_numpy())
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _parts(points: np.ndarray) -> list[np.ndarray]:
    return np.split(points, PARTS, axis=1)


def _sums(rows: DataFrame, now: Codebooks) -> DataFrame:
    """(slot, pos, total): for each entry its number of parts (pos 0) and the sums of their components, a task's first, then all tasks'."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grids, sums = now.grids(), [np.zeros((len(b), 1 + b.shape[1]), np.int64) for b in now.books]
        for batch in batches:
            for grid, total, points in zip(grids, sums, _parts(_matrix(batch.column("v"), now.width))):
                entry, _ = grid.nearest(points)
                order = np.argsort(entry, kind="stable")
                used, begins = np.unique(entry[order], return_index=True)
                if len(used):
                    total[used] += np.add.reduceat(np.hstack([np.ones((len(points), 1), np.int64), points])[order], begins, axis=0)
        every = np.concatenate(sums)
        used = np.flatnonzero(every[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(every[used].tolist(), pa.list_(pa.int64()))], ["slot", "totals"])

    made = rows.select("v").mapInArrow(run, "slot int, totals array<long>")
    return made.select("slot", F.posexplode("totals").alias("pos", "total")).groupBy("slot", "pos").agg(F.sum("total").alias("total"))


def fit(kept: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES) -> Codebooks | None:
    """Codebooks of ``kept`` (vec_id, label, v), or None where it is empty. They start as the ``entries`` smallest vec_ids (missing last, ties by
    the vector; fewer where there are fewer rows). Each round every task sums the parts it has by their nearest entries, the tasks' sums are
    added by Spark, and one row for each entry and component, whatever the number of vectors, comes to the driver. The width of a vector is
    the largest one's, filled up to a multiple of the parts."""
    widest = kept.agg(F.max(F.size("v"))).first()[0]
    if widest is None:
        return None
    width = max(1, -(-widest // PARTS)) * PARTS
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    sample = kept.orderBy(F.xxhash64("vec_id", "v")).limit(SAMPLE).select("v").collect()
    start, some = (_parts(_matrix(pa.array([r.v for r in x], pa.list_(pa.int32())), width)) for x in (first, sample))
    now = Codebooks(start, [coarsest_shift(p, b) for p, b in zip(some, start)], width)
    for _ in range(rounds):
        books = [b.copy() for b in now.books]
        flat = {(r.slot, r.pos): r.total for r in _sums(kept, now).collect()}
        for slot in sorted({s for s, _ in flat}):
            part, entry = divmod(slot, len(first))
            books[part][entry] = [flat[slot, i + 1] // flat[slot, 0] for i in range(width // PARTS)]
        now = Codebooks(books, now.shifts, width)
    return now


def encode(kept: DataFrame, fitted: Codebooks) -> DataFrame:
    """(vec_id, label, code, error): two hex digits for each part, and the squared distances summed over the parts."""
    kind = {c: kept.schema[c].dataType.simpleString() for c in ("vec_id", "label")}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grids = fitted.grids()
        for batch in batches:
            found = [g.nearest(p) for g, p in zip(grids, _parts(_matrix(batch.column("v"), fitted.width)))]
            codes = np.stack([e for e, _ in found], axis=1).astype(np.uint8)
            errors = np.sum([e for _, e in found], axis=0)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(errors, pa.int64())],
                                             ["vec_id", "label", "code", "error"])

    return kept.mapInArrow(run, f"vec_id {kind['vec_id']}, label {kind['label']}, code string, error long")


def with_label_error(coded: DataFrame) -> DataFrame:
    """Add ``label_error``: the sum of ``error`` over the rows of equal label, missing ones together; missing where it exceeds 64 bits.

    Sums combine map-side. Labels that hold over 1 / HOT_LABELS of all rows, fewer than HOT_LABELS of them, have their sums broadcast, so that
    their rows stay where they are; the rows of all others are joined by label.
    """
    sums = stored(coded.groupBy(F.col("label").alias("_label")).agg(F.try_sum("error").alias("label_error"), F.count(F.lit(1)).alias("_rows")))
    every = sums.agg(F.sum("_rows")).first()[0] or 0
    same = F.col("label").eqNullSafe(F.col("_label"))
    hot = sums.filter(F.col("_rows") * HOT_LABELS > every)
    marked = coded.join(F.broadcast(hot), same, "left")
    rare = sums.filter(F.col("_rows") * HOT_LABELS <= every)
    rest = marked.filter("_rows is null").drop("_label", "label_error", "_rows").join(rare, same)
    return marked.filter("_rows is not null").unionByName(rest).drop("_label", "_rows")


def vector_codes(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every vector of (vec_id, embedding, label) that ``integer_vectors`` keeps.

    Tables without such vectors give none. Fewer than ENTRIES vectors are a codebook of their own; vectors of other lengths than the longest
    count as filled with zeros. Other columns are not looked at, also where their names differ by case alone.
    """
    kept = stored(integer_vectors(vectors))
    fitted = fit(kept)
    if fitted is None:
        empty = kept.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"))
        return empty.withColumn("codebooks_sha256", F.lit("")).limit(0)
    coded = with_label_error(stored(encode(kept, fitted)))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(fitted.digest()).alias("codebooks_sha256"))
