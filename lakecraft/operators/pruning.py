"""Cells of vectors around pivots, and bounds on the inner products between them.

Every vector goes to the pivot of the smallest angle. A cell knows the largest angle to its pivot and its vectors'
norms; by the triangle inequality of angles this bounds every product between two cells from above and below, so most
pairs of cells are never formed, and some need not be compared. Pivots are ``MOST_PIVOTS`` at most: what the driver
holds and the tasks get does not grow with the vectors.

Where many cells meet many, they travel in bands of neighbouring cells: a row is sent once for each band that its own
meets (``BANDS`` at most, until bands are ``MOST_BAND`` rows), not once for each cell, and the task passes over the pairs of
cells that cannot matter. The other products are screened in single precision, what is near the threshold is computed
again in double.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import written

MOST_PIVOTS = 2048
SLACK = 1e-7  # for rounding, in radians and in parts of a product
ROUNDING = 1e-12  # of a matrix product, in parts of the lengths' product
# Bands: how many a table is cut into, and the rows of one at least and at most.
BANDS, LEAST_BAND, MOST_BAND = 8, 1024, 98304
LONGEST_NARROW = 1e15  # of a vector that is screened in single precision


def pivots_of(vectors: DataFrame, id: str, n: int, block: int) -> np.ndarray:
    """Directions of the rows that come first in the order of a hash of their id, four for each block."""
    most = min(MOST_PIVOTS, max(1, 4 * -(-n // block)))
    rows = vectors.orderBy(F.xxhash64(F.col(id)), id).select("embedding").limit(most).collect()
    x = np.array([r[0] for r in rows], np.float64)
    length = np.linalg.norm(x, axis=1) if len(x) else np.zeros(0)
    x = x[length > 0] / length[length > 0, None]
    return np.unique(x, axis=0) if len(x) else np.zeros((1, 0))


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def in_cells(vectors: DataFrame, pivots: np.ndarray, name: str) -> DataFrame:
    """The rows with cell, angle (to its pivot) and length, written."""
    schema = T.StructType([*vectors.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("angle", T.DoubleType()), T.StructField("length", T.DoubleType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            if pdf.empty:
                continue
            x = matrix(pdf["embedding"])
            length = np.sqrt((x * x).sum(axis=1))
            if pivots.shape[1] != x.shape[1]:  # all vectors are zero
                yield pdf.assign(cell=0, angle=0.0, length=length)
                continue
            s = x @ pivots.T
            cell = s.argmax(axis=1)
            cosine = s[np.arange(len(x)), cell] / np.where(length == 0, 1, length)
            yield pdf.assign(cell=cell.astype(np.int32), angle=np.where(length == 0, 0.0, np.arccos(cosine.clip(-1, 1))), length=length)

    return written(vectors.mapInPandas(run, schema), name)


@dataclass
class Cells:
    """Figures of the cells, by their number; empty ones have n = 0."""

    n: np.ndarray
    angle: np.ndarray
    longest: np.ndarray
    shortest: np.ndarray

    @classmethod
    def of(cls, rows: DataFrame, count: int) -> Cells:
        told = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("angle"), F.max("length").alias("longest"), F.min("length").alias("shortest")).collect()  # a row for each pivot
        out = cls(np.zeros(count, np.int64), *np.zeros((3, count)))
        for r in told:
            out.n[r.cell], out.angle[r.cell], out.longest[r.cell], out.shortest[r.cell] = r.n, r.angle, r.longest, r.shortest
        return out


def bounds(pivots: np.ndarray, a: Cells, b: Cells) -> tuple[np.ndarray, np.ndarray]:
    """(least, most): what the products between the vectors of two cells are at least and at most."""
    between = np.arccos((pivots @ pivots.T).clip(-1, 1)) if pivots.shape[1] else np.zeros((1, 1))
    reach = a.angle[:, None] + b.angle[None, :] + SLACK
    near, far = np.cos((between - reach).clip(min=0)), np.cos((between + reach).clip(max=np.pi))
    long, short = a.longest[:, None] * b.longest[None, :], a.shortest[:, None] * b.shortest[None, :]
    most, least = np.where(near >= 0, long * near, 0.0), np.where(far >= 0, short * far, long * far)
    return least - SLACK * (1 + long), most + SLACK * (1 + long)


def tiles(rows: DataFrame, others: DataFrame, id: str, other_id: str, pairs: DataFrame) -> DataFrame:
    """Rows of both sides, once for each tile of theirs: columns of the rows, tile, side.

    ``pairs``: a, b (cells), na, nb (parts of each); a tile is a part of a cell against one of another.
    """
    both = pairs.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("na") - 1))).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    both = both.withColumn("tile", F.xxhash64("a", "b", "i", "j"))
    left = both.select(F.col("a").alias("cell"), F.col("i").alias("nth"), F.col("na").alias("parts"), "tile", F.lit(0).alias("side"))
    right = both.select(F.col("b").alias("cell"), F.col("j").alias("nth"), F.col("nb").alias("parts"), "tile", F.lit(1).alias("side"))

    def dealt(table: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
        sizes = wanted.select("cell", "parts").distinct()
        placed = table.join(sizes, "cell").withColumn("nth", F.pmod(F.xxhash64(F.col(key)), F.col("parts")).cast("int")).drop("parts")
        return placed.join(wanted.drop("parts"), ["cell", "nth"])

    return dealt(rows, id, left).unionByName(dealt(others, other_id, right))


def band_rows(n: int, bands: int = 0) -> int:
    """The rows of a band where ``n`` are cut into so many (``BANDS`` if not told)."""
    return min(MOST_BAND, max(LEAST_BAND, -(-n // (bands or BANDS))))


@dataclass
class Bands:
    """The band of each part of each cell, and which cells a band holds."""

    of: list[list[int]]
    cells: np.ndarray

    @classmethod
    def cut(cls, cells: Cells, block: int, size: int = 0) -> Bands:
        """Cells in their order, in parts of about ``block`` rows, filled into bands of equal size (``size`` rows, or by their number)."""
        size = size or band_rows(int(cells.n.sum()))
        parts = -(-cells.n // block)
        each = np.repeat(cells.n / np.maximum(parts, 1), parts)
        band = (np.cumsum(each) - each / 2).astype(np.int64) // size
        ends = np.cumsum(parts)
        of = [band[e - p : e].tolist() for e, p in zip(ends, parts, strict=True)]
        held = np.zeros((int(band.max(initial=-1)) + 1, len(cells.n)), np.float32)
        held[band, np.repeat(np.arange(len(parts)), parts)] = 1
        return cls(of, held)

    def place(self, rows: DataFrame, id: str) -> DataFrame:
        """The rows with nth (the part of their cell) and band."""
        told = [(c, b) for c, b in enumerate(self.of) if b]
        sizes = rows.sparkSession.createDataFrame(told, "cell int, bands array<int>")
        placed = rows.join(F.broadcast(sizes), "cell").withColumn("nth", F.pmod(F.xxhash64(F.col(id)), F.size("bands")).cast("int"))  # a row for each pivot
        return placed.withColumn("band", F.get("bands", F.col("nth"))).drop("bands")


def band_tiles(rows: DataFrame, bands: Bands, id: str, needed: np.ndarray, others: DataFrame | None = None, other_bands: Bands | None = None, other_id: str | None = None) -> tuple[DataFrame, int]:
    """Rows of both sides, once for each tile (a band against another) with a pair of cells that is ``needed``, and the number of tiles.

    Columns of the rows, tile, side, cross. Without ``others`` both sides are of ``rows``; a band meets itself in a tile with cross false.
    """
    met = bands.cells @ needed.astype(np.float32) @ (bands if other_bands is None else other_bands).cells.T > 0
    pairs = [(int(a), int(b)) for a, b in np.argwhere(met) if others is not None or a <= b]
    asked = [[(n, a, others is not None or a != b) for n, (a, b) in enumerate(pairs)], [(n, b, True) for n, (a, b) in enumerate(pairs) if others is not None or a != b]]

    def dealt(table: DataFrame, own: Bands, key: str, wanted: list, side: int) -> DataFrame:
        told = table.sparkSession.createDataFrame(wanted, "tile int, band int, cross boolean").withColumn("side", F.lit(side))
        return own.place(table, key).join(F.broadcast(told), "band")  # a row for each tile

    if others is None:
        both = asked[0] + asked[1]
        told = rows.sparkSession.createDataFrame([(*x, int(k >= len(asked[0]))) for k, x in enumerate(both)], "tile int, band int, cross boolean, side int")
        out = bands.place(rows, id).join(F.broadcast(told), "band")  # a row for each tile and side
    else:
        out = dealt(rows, bands, id, asked[0], 0).unionByName(dealt(others, other_bands, other_id, asked[1], 1))
    return out.drop("nth", "band").repartition(max(1, 2 * len(pairs)), "tile"), len(pairs)


class Side:
    """The rows of one side of a tile in the order of cell and id, as a matrix (of single precision if they are)."""

    def __init__(self, pdf: pd.DataFrame, id: str):
        self.rows = pdf.sort_values(["cell", id])
        x = np.stack(self.rows["embedding"].to_numpy())
        self.x, self.ids = x if x.dtype == np.float32 else x.astype(np.float64, copy=False), self.rows[id].to_numpy()
        self.cells, self.starts = np.unique(self.rows["cell"].to_numpy(), return_index=True)
        self.ends = np.append(self.starts[1:], len(self.rows))
        self.longest = float(np.sqrt(np.einsum("ij,ij->i", self.x, self.x, dtype=np.float64).max()))

    def wide(self, i0: int, i1: int) -> np.ndarray:
        return self.x[i0:i1].astype(np.float64, copy=False)


def sides(pdf: pd.DataFrame, id: str, other_id: str | None = None) -> tuple[Side, Side, bool] | None:
    """Both sides of a tile and whether they differ; None if one is empty."""
    cross = bool(pdf["cross"].iat[0])
    a, b = (pdf[pdf["side"] == n] for n in (0, 1))
    if not cross:
        one = Side(a, id)
        return one, one, False
    return None if a.empty or b.empty else (Side(a, id), Side(b, other_id or id), True)


def packed(needed: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A matrix of yes and no as bits, for tasks; gives the part of some rows and columns."""
    bits, width = np.packbits(needed, axis=1), needed.shape[1]
    return lambda a, b: np.unpackbits(bits[a], axis=1, count=width)[:, b].astype(bool)


def meetings(a: Side, b: Side, cross: bool, needed: Callable[[np.ndarray, np.ndarray], np.ndarray], rows: int = 512, columns: int = 2048) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """(i0, i1, [(j0, j1), ..]): rows of ``a``, of neighbouring cells that need the same, and the ranges of ``b`` that these make; so many at a time.

    Of a tile with itself only ranges beyond i0.
    """
    meet = needed(a.cells, b.cells)
    first = np.flatnonzero(np.append(True, (meet[1:] != meet[:-1]).any(axis=1)))
    for c, last in zip(first, np.append(first[1:], len(a.cells)) - 1, strict=True):
        on = np.flatnonzero(meet[c])
        if not len(on):
            continue
        runs = [(int(b.starts[r[0]]), int(b.ends[r[-1]])) for r in np.split(on, np.flatnonzero(np.diff(on) > 1) + 1)]
        end = int(a.ends[last])
        for i0 in range(int(a.starts[c]), end, rows):
            ranges = [(j, min(j + columns, hi)) for lo, hi in runs for j in range(lo if cross else max(lo, i0 + 1), hi, columns)]
            if ranges:
                yield i0, min(i0 + rows, end), ranges


def screen(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray, float]:
    """Matrices of both sides, and how far from the true score a product of their rows can be."""
    long = a.longest * b.longest
    if not max(a.longest, b.longest) < LONGEST_NARROW:
        return a.x.astype(np.float64, copy=False), b.x.astype(np.float64, copy=False), ROUNDING * (1 + long)
    return a.x.astype(np.float32, copy=False), b.x.astype(np.float32, copy=False), ROUNDING * (1 + long) + (a.x.shape[1] + 8) * 2.0**-24 * long


def places(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of what is true; much faster than ``np.nonzero`` where that is little."""
    return np.divmod(np.flatnonzero(mask), mask.shape[1])


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision, summed from the first component on: the same for the same two vectors wherever they stand."""
    out = np.zeros(len(a))
    for k in range(a.shape[1]):
        out += a[:, k].astype(np.float64, copy=False) * b[:, k]
    return out


def scores(a: Side, b: Side, i: np.ndarray, j: np.ndarray, piece: int = 1 << 15) -> np.ndarray:
    """:func:`products` of rows ``i`` of one side with rows ``j`` of the other, so many at a time."""
    return np.concatenate([np.zeros(0), *(products(a.x[i[k : k + piece]], b.x[j[k : k + piece]]) for k in range(0, len(i), piece))])
