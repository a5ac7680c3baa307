"""Vectors: encoders, exact search, near-duplicate pairs, recall and overlap.

Products of many vectors with many run as matrix products over Arrow batches. A query set goes to the
executors in blocks of a bounded size; each task keeps its own best k, so only k rows of a query and task
are shuffled. Where all meet all, rows are dealt over cells around pivots, and pairs of cells that cannot matter are
not formed; rows travel in bands of cells, once for each band that theirs meets (``pruning``).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import clean_text, dot, norm
from ..schemas import DIMENSION
from ..sources.positions import Positions
from ..sources.scratch import written
from . import pruning


class Encoder(Protocol):
    """Texts to a matrix of unit rows."""

    name: str
    dimension: int

    def __call__(self, texts: list[str]) -> np.ndarray: ...


class HashingEncoder:
    """Signed hashes of words and pairs of words, unit length; needs no model and gives the same everywhere."""

    name = "hashing"

    def __init__(self, dimension: int = DIMENSION):
        self.dimension = dimension

    def __call__(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dimension))
        for i, text in enumerate(texts):
            words = re.findall(r"\w+", text.lower())
            for piece in words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]:
                h = zlib.crc32(piece.encode())
                out[i, (h >> 1) % self.dimension] += 1 if h & 1 else -1
        length = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(length == 0, 1, length)


def embed(df: DataFrame, encoder: Encoder, text: str = "texto_embedding") -> DataFrame:
    """VEC-1: ``df`` with embedding and model_name; a width other than the encoder's is an error."""
    schema = df.drop("embedding", "model_name").schema.add("embedding", T.ArrayType(T.FloatType())).add("model_name", T.StringType())

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            m = encoder([t or "" for t in pdf[text]])
            if m.shape != (len(pdf), encoder.dimension):
                raise ValueError(f"the encoder gave {m.shape}")
            yield pdf.assign(embedding=list(m.astype(np.float32)), model_name=encoder.name)

    return df.drop("embedding", "model_name").mapInPandas(run, schema)


def search(vectors: DataFrame, query: list[float], k: int, *, id: str = "entity_id", prefilter: Column | None = None, where: Column | None = None, columns: list[str] | None = None, digits: int | None = None) -> DataFrame:
    """VEC-3, FIL-7: the k rows of the highest inner product, equal ones by id; ``where`` filters them afterwards, ``prefilter`` before.

    With ``digits`` scores are rounded, and ranked as they are then.
    """
    rows = vectors if prefilter is None else vectors.where(prefilter)
    q = F.array(*[F.lit(float(x)) for x in query])
    score = dot(F.col("embedding"), q)
    top = rows.withColumn("score", score if digits is None else F.round(score, digits)).orderBy(F.desc("score"), id).limit(k)
    top = top if where is None else top.where(where)
    return top.select(*columns, "score") if columns else top


def _first(found: pd.DataFrame, k: int, id: str) -> pd.DataFrame:
    return found.sort_values(["query_id", "score", id], ascending=[True, False, True]).groupby("query_id").head(k)


def _best(pdf: pd.DataFrame, ids: np.ndarray, queries: np.ndarray, k: int, id: str) -> pd.DataFrame:
    """(query_id, id, score) of the k best rows of a frame for each query, equal ones by id."""
    rows, n, out = np.stack(pdf["embedding"].to_numpy()).astype(np.float64), min(k, len(pdf)), []
    slack = pruning.ROUNDING * (1 + np.sqrt((rows * rows).sum(axis=1).max() * (queries * queries).sum(axis=1).max(initial=0)))
    for lo in range(0, len(ids), 512):  # so many queries at a time
        scores = rows @ queries[lo : lo + 512].T
        # Ties at rank k have to meet: everything down to the k-th score is scored again and sorted.
        floor = np.partition(scores, len(pdf) - n, axis=0)[len(pdf) - n] - slack
        row, q = pruning.places(scores >= floor)
        out.append(_first(pd.DataFrame({"query_id": ids[lo : lo + 512][q], id: pdf[id].to_numpy()[row], "score": pruning.products(rows[row], queries[lo + q])}), k, id))
    return pd.concat(out)


def _local_top(ids: np.ndarray, queries: np.ndarray, k: int, id: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: pd.DataFrame | None = None
        for pdf in frames:
            if pdf.empty:
                continue
            new = _best(pdf, ids, queries, k, id)
            best = new if best is None else _first(pd.concat([best, new]), k, id)
        if best is not None:
            yield best

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int, *, id: str = "entity_id", block: int = 4096, without_self: bool = False) -> DataFrame:
    """VEC-3, WIN-2: (query_id, id, score, rank) of the k best rows of each query, equal ones by id.

    ``queries``: query_id, embedding; each id once. Up to ``block`` of them go with the function to one scan of the vectors.
    More are answered cell by cell (see :func:`top_k_by_bounds`); the driver holds none of them.
    """
    rows = vectors.select(id, "embedding").where("embedding is not null")
    asked = queries.select("query_id", "embedding").where("embedding is not null")
    kind, query_kind = rows.schema[id].dataType.simpleString(), asked.schema["query_id"].dataType.simpleString()
    schema = f"query_id {query_kind}, {id} {kind}, score double"
    n = asked.count()
    if n == 0:
        found = rows.where("false").select(F.lit(None).cast(query_kind).alias("query_id"), id, F.lit(0.0).alias("score"))
    elif n <= block:
        got = asked.orderBy("query_id").collect()  # ``block`` rows at most
        found = rows.mapInPandas(_local_top(np.array([g[0] for g in got]), np.array([g[1] for g in got], np.float64), k + without_self, id), schema)
    else:
        return top_k_by_bounds(rows, asked, k, id=id, block=block, without_self=without_self)[0]
    if without_self:
        found = found.where(F.col("query_id") != F.col(id))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), id)
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _best_of_tile(needed, k: int, id: str):
    """(query_id, id, score) of the k best rows of a tile for each of its queries, equal ones by id."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"query_id": [], id: [], "score": []})]
        if (both := pruning.sides(pdf.rename(columns={"query_id": "_q"}).assign(**{id: pdf[id]}), "_q", id)) is None:
            return out[0]
        a, b, cross = both
        slack = pruning.ROUNDING * (1 + a.longest * b.longest)
        for i0, i1, ranges in pruning.meetings(a, b, cross, needed):
            floor, found = np.full(i1 - i0, -np.inf), []
            for j0, j1 in ranges:
                s = a.wide(i0, i1) @ b.wide(j0, j1).T
                if j1 - j0 >= k:
                    floor = np.maximum(floor, np.partition(s, j1 - j0 - k, axis=1)[:, j1 - j0 - k] - slack)
                i, j = pruning.places(s >= floor[:, None])
                found.append((i, j + j0, s[i, j]))
            i, j, s = (np.concatenate(x) for x in zip(*found, strict=True))
            keep = s >= floor[i]
            i, j = i[keep] + i0, j[keep]
            out.append(_first(pd.DataFrame({"query_id": a.ids[i], id: b.ids[j], "score": pruning.scores(a, b, i, j)}), k, id))
        return pd.concat([o for o in out if len(o)] or out)

    return run


def top_k_by_bounds(vectors: DataFrame, queries: DataFrame, k: int, *, id: str = "entity_id", block: int = 4096, without_self: bool = False, first: int = 4) -> tuple[DataFrame, DataFrame]:
    """VEC-3, VEC-5, WIN-2: as :func:`top_k`, and how much was read: (round, query_cells, cell_pairs, products, whole).

    Queries and vectors are dealt over the cells of the same pivots. First each cell of queries meets the ``first`` cells of
    vectors of the highest bounds (more if they hold fewer than k rows), then, in bands, all others whose bound is not below the k-th score of all
    its queries. ``products`` are the scores that a round computed, ``whole`` those of all queries with all vectors.
    """
    rows, asked = vectors.select(id, "embedding").where("embedding is not null"), queries.select("query_id", "embedding").where("embedding is not null")
    spark = rows.sparkSession
    kind, query_kind = rows.schema[id].dataType.simpleString(), asked.schema["query_id"].dataType.simpleString()
    schema = f"query_id {query_kind}, {id} {kind}, score double"
    m, n = rows.count(), asked.count()
    pivots = pruning.pivots_of(rows, id, max(m, n), block)
    right, left = pruning.in_cells(rows, pivots, "vector-cells"), pruning.in_cells(asked, pivots, "query-cells")
    own, other = pruning.Cells.of(left, len(pivots)), pruning.Cells.of(right, len(pivots))
    bound = pruning.bounds(pivots, own, other)[1]
    bound[:, other.n == 0] = -np.inf
    bound[own.n == 0] = -np.inf
    order, least = np.argsort(-bound, axis=1, kind="stable"), np.full(len(pivots), -np.inf)
    left, right = left.withColumn(id, F.lit(None).cast(kind)), right.withColumn("query_id", F.lit(None).cast(query_kind))
    found, report = None, []

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
        if a.empty or b.empty:
            return pd.DataFrame({"query_id": [], id: [], "score": []})
        return _best(b, a["query_id"].to_numpy(), pruning.matrix(a["embedding"]), k + without_self, id)

    def ranked(new: DataFrame) -> DataFrame:
        if without_self:
            new = new.where(F.col("query_id") != F.col(id))
        every = new if found is None else found.drop("rank").unionByName(new)
        w = Window.partitionBy("query_id").orderBy(F.desc("score"), id)
        return written(every.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k), "best")

    def told(met: np.ndarray) -> None:
        report.append((len(report), int(met.any(axis=1).sum()), int(met.sum()), int(own.n @ met.astype(np.int64) @ other.n), m * n))

    met = np.zeros(bound.shape, bool)
    for c in np.flatnonzero(own.n):
        enough = np.searchsorted(np.cumsum(other.n[order[c]]), k + without_self) + 1
        met[c, order[c, : max(first, enough)]] = True
    met &= bound > -np.inf
    if met.any():
        told(met)
        parts = lambda x: int(-(-x // block))
        asks = spark.createDataFrame([(int(c), int(v), parts(own.n[c]), parts(other.n[v])) for c, v in np.argwhere(met)], "a int, b int, na int, nb int")
        both = pruning.tiles(left, right, "query_id", id, asks)
        found = ranked(both.select("tile", "side", "query_id", id, "embedding").groupBy("tile").applyInPandas(compare, schema))
        worst = left.select("query_id", "cell").join(found.where(F.col("rank") == k).select("query_id", "score"), "query_id", "left")
        for r in worst.groupBy("cell").agg(F.min(F.coalesce("score", F.lit(float("-inf")))).alias("least")).collect():  # a row for each pivot
            least[r.cell] = r.least - 1e-12 * abs(r.least) if np.isfinite(r.least) else r.least  # equal scores go by the id
        rest = (bound >= least[:, None]) & (bound > -np.inf) & ~met
        if rest.any():
            told(rest)
            size = pruning.band_rows(m, 2 * pruning.BANDS)  # of both: few queries are few bands, so that rows are sent a few times
            both, _ = pruning.band_tiles(left, pruning.Bands.cut(own, block, size), "query_id", rest, right, pruning.Bands.cut(other, block, size), id)
            found = ranked(both.select("tile", "cross", "side", "cell", "query_id", id, "embedding").groupBy("tile").applyInPandas(_best_of_tile(pruning.packed(rest), k + without_self, id), schema))
    if found is None:
        found = rows.where("false").select(F.lit(None).cast(query_kind).alias("query_id"), id, F.lit(0.0).alias("score"), F.lit(1).alias("rank"))
    return found, spark.createDataFrame(report, "round int, query_cells int, cell_pairs int, products long, whole long")


@dataclass
class _Meeting:
    """Vectors in cells and, by two cells, what is known of the products between them."""

    placed: DataFrame
    cells: pruning.Cells
    kind: np.ndarray


def _meeting(vectors: DataFrame, theta: float, id: str, block: int, collapse: bool) -> _Meeting:
    rows = vectors.select(id, "embedding").where("embedding is not null")
    if collapse:
        rows = written(rows.groupBy("embedding").agg(F.min(id).alias(id), F.count(F.lit(1)).alias("copies")).select(id, "embedding", "copies"), "vectors")
    else:
        rows = rows.withColumn("copies", F.lit(1).cast("long"))
    pivots = pruning.pivots_of(rows, id, rows.count(), block)
    placed = pruning.in_cells(rows, pivots, "cells")
    cells = pruning.Cells.of(placed, len(pivots))
    least, most = pruning.bounds(pivots, cells, cells)
    least, most = np.minimum(least, least.T), np.maximum(most, most.T)  # the same both ways
    return _Meeting(placed, cells, np.where(most < theta, _SKIPPED, np.where(least >= theta, _WHOLE, _COMPARED)).astype(np.int8))


_KINDS = ("skipped", "whole", "compared")
_SKIPPED, _WHOLE, _COMPARED = range(3)


def cell_pairs(vectors: DataFrame, theta: float, *, id: str = "entity_id", block: int = 4096, collapse: bool = False) -> tuple[DataFrame, DataFrame]:
    """The vectors in cells, and each pair of cells (a <= b) with what is known of it: na, nb (parts), n (pairs of rows), kind.

    ``skipped``: no product reaches ``theta``; ``whole``: every one does; ``compared``: neither is known. ``collapse``: of equal
    vectors one row stays, with their number as ``copies``.
    """
    m = _meeting(vectors, theta, id, block, collapse)
    there = np.flatnonzero(m.cells.n)
    i, j = np.meshgrid(there, there, indexing="ij")
    i, j = i[i <= j], j[i <= j]
    n = np.where(i == j, m.cells.n[i] * (m.cells.n[i] - 1) // 2, m.cells.n[i] * m.cells.n[j])
    parts = -(-m.cells.n // block)
    told = pd.DataFrame({"a": i, "b": j, "na": parts[i], "nb": parts[j], "n": n, "kind": np.array(_KINDS)[m.kind[i, j]]}).astype({"a": "int32", "b": "int32", "na": "int32", "nb": "int32"})
    return m.placed, vectors.sparkSession.createDataFrame(told, "a int, b int, na int, nb int, n long, kind string")


def pair_report(pairs: DataFrame) -> DataFrame:
    """By kind of :func:`cell_pairs`: pairs of cells, pairs of rows, and the share of all of each."""
    sums = pairs.groupBy("kind").agg(F.count(F.lit(1)).alias("cells"), F.sum("n").alias("rows"))
    whole = pairs.agg(F.count(F.lit(1)).alias("_c"), F.sum("n").alias("_r"))
    return sums.crossJoin(F.broadcast(whole)).select("kind", "cells", (F.col("cells") / F.col("_c")).alias("cell_share"), "rows", (F.col("rows") / F.col("_r")).alias("row_share"))  # one row


def _beyond(i0: int, i1: int, j0: int, j1: int) -> np.ndarray:
    """Of a tile with itself: whether the column stands behind the row."""
    return np.arange(j0, j1)[None, :] > np.arange(i0, i1)[:, None]


def _pairs_of(needed, id: str, theta: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"id_a": [], "id_b": [], "score": []})]
        if (both := pruning.sides(pdf, id)) is None:
            return out[0]
        a, b, cross = both
        left, right, slack = pruning.screen(a, b)
        for i0, i1, ranges in pruning.meetings(a, b, cross, needed):
            for j0, j1 in ranges:
                near = left[i0:i1] @ right[j0:j1].T >= theta - slack
                if not cross and j0 < i1:
                    near &= _beyond(i0, i1, j0, j1)
                i, j = pruning.places(near)
                if not len(i):
                    continue
                i, j = i + i0, j + j0
                s = pruning.scores(a, b, i, j)
                x, y, s = a.ids[i][s >= theta], b.ids[j][s >= theta], s[s >= theta]
                out.append(pd.DataFrame({"id_a": np.minimum(x, y), "id_b": np.maximum(x, y), "score": s}))
        return pd.concat([o for o in out if len(o)] or out)

    return run


def near_duplicate_pairs(vectors: DataFrame, theta: float = 0.95, *, id: str = "entity_id", block: int = 4096) -> DataFrame:
    """VEC-4, JOIN-9: (id_a, id_b, score) of all pairs id_a < id_b with an inner product of ``theta`` or more; exact.

    Pairs of cells whose bound is below ``theta`` are never formed (:func:`cell_pairs`, :func:`pair_report`).
    """
    kind = vectors.schema[id].dataType.simpleString()
    m = _meeting(vectors, theta, id, block, collapse=False)
    needed = m.kind != _SKIPPED
    both, _ = pruning.band_tiles(m.placed, pruning.Bands.cut(m.cells, block), id, needed)
    return both.select("tile", "cross", "side", "cell", id, "embedding").groupBy("tile").applyInPandas(_pairs_of(pruning.packed(needed), id, theta), f"id_a {kind}, id_b {kind}, score double").where("id_a <> id_b")


def _counts_of(needed, id: str, theta: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        n = 0
        if both := pruning.sides(pdf, id):
            a, b, cross = both
            of_a, of_b = (x.rows["copies"].to_numpy() for x in (a, b))
            left, right, slack = pruning.screen(a, b)
            for i0, i1, ranges in pruning.meetings(a, b, cross, needed):
                for j0, j1 in ranges:
                    s = left[i0:i1] @ right[j0:j1].T
                    near = s >= theta - slack
                    if not cross and j0 < i1:
                        near &= _beyond(i0, i1, j0, j1)
                    i, j = pruning.places(near)
                    unsure = s[i, j] <= theta + slack
                    counted = ~unsure
                    counted[unsure] = pruning.scores(a, b, i[unsure] + i0, j[unsure] + j0) >= theta
                    n += int((of_a[i[counted] + i0] * of_b[j[counted] + j0]).sum())
        return pd.DataFrame({"n": [n]})

    return run


def _with_near(vectors: DataFrame, nearest: DataFrame, theta: float, id: str) -> DataFrame:
    """The rows that can be in a near pair by their nearest other one; those of a repeated id or without a score may be too."""
    long = vectors.agg(F.max(norm("embedding"))).first()[0] or 0.0
    least = theta - pruning.ROUNDING * (1 + long * long)
    by_id = nearest.groupBy(F.col(id).alias("_id")).agg(F.min("score").alias("score"), F.count(F.lit(1)).alias("n"))
    some = by_id.where((F.col("n") > 1) | F.col("score").isNull() | (F.col("score") >= least))
    return vectors.join(some, F.col(id).eqNullSafe(F.col("_id")), "left_semi")


def near_duplicate_count(vectors: DataFrame, theta: float = 0.95, *, id: str = "entity_id", block: int = 4096, nearest: DataFrame | None = None) -> DataFrame:
    """AGG-9: (pairs, ratio) of near pairs and of those among all pairs; no pair becomes a row.

    Equal vectors are one row with their number; cells whose products all reach ``theta`` are counted, not compared.
    With ``nearest``, the rows of :func:`nearest_other` for these (finite) vectors, only rows whose nearest other is near are compared.
    """
    m = _meeting(vectors if nearest is None else _with_near(vectors, nearest, theta, id), theta, id, block, collapse=True)
    rows, needed = m.placed, m.kind == _COMPARED
    both, _ = pruning.band_tiles(rows, pruning.Bands.cut(m.cells, block), id, needed)
    compared = both.select("tile", "cross", "side", "cell", id, "embedding", "copies").groupBy("tile").applyInPandas(_counts_of(pruning.packed(needed), id, theta), "n long")
    w = np.zeros(len(m.kind), object)
    whole = 0
    for r in rows.groupBy("cell").agg(F.sum("copies").alias("w"), F.sum(F.col("copies") * F.col("copies")).alias("q")).collect():  # a row for each pivot
        w[r.cell] = r.w
        whole += (r.w * r.w - r.q) // 2 if m.kind[r.cell, r.cell] == _WHOLE else 0
    for c in range(len(w)):
        whole += w[c] * int(w[c + 1 :][m.kind[c, c + 1 :] == _WHOLE].sum())
    equal = rows.where((F.col("copies") > 1) & (F.col("length") * F.col("length") >= theta)).select(F.expr("copies * (copies - 1) div 2").alias("n"))
    n = rows.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("m")) if nearest is None else nearest.agg(F.count(F.lit(1)).alias("m"))
    every = F.col("m") * (F.col("m") - 1) / 2
    counts = compared.unionByName(equal).agg((F.coalesce(F.sum("n"), F.lit(0)) + F.lit(int(whole)).cast("long")).alias("pairs"))
    return counts.crossJoin(F.broadcast(n)).select("pairs", F.when(every > 0, F.col("pairs") / every).otherwise(0.0).alias("ratio"))  # one row each


def _pairs_with(ids: np.ndarray, x: np.ndarray, theta: float, n: int, id: str):
    """Of each task the first ``n`` near pairs (id_a, id_b, score) of given rows with rows of larger ids."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = pd.DataFrame({"id_a": [], "id_b": [], "score": []})
        given = pruning.Side(pd.DataFrame({"cell": 0, id: ids, "embedding": list(x)}), id)
        for pdf in frames:
            if pdf.empty:
                continue
            b = pruning.Side(pdf.assign(cell=0), id)
            left, right, slack = pruning.screen(given, b)
            found = [best] if len(best) else []
            for j0 in range(0, len(b.ids), 2048):
                near = left @ right[j0 : j0 + 2048].T >= theta - slack
                near &= given.ids[:, None] < b.ids[None, j0 : j0 + 2048]
                i, j = pruning.places(near)
                j = j + j0
                s = pruning.scores(given, b, i, j)
                found.append(pd.DataFrame({"id_a": given.ids[i], "id_b": b.ids[j], "score": s})[s >= theta])
            best = pd.concat([f for f in found if len(f)] or [best]).sort_values(["id_a", "id_b"]).head(n)
        if len(best):
            yield best

    return run


def first_pairs(vectors: DataFrame, theta: float = 0.95, n: int = 10, *, id: str = "entity_id", block: int = 4096, head: int = 1024) -> DataFrame:
    """SRT-5: the first ``n`` near pairs in the order of their ids.

    The ``head`` rows of the smallest ids meet all rows in one scan. Only if they have fewer than ``n`` pairs, the rows behind
    them meet each other (:func:`near_duplicate_pairs`).
    """
    rows = vectors.select(id, "embedding").where(F.col(id).isNotNull() & F.col("embedding").isNotNull())
    kind, number = rows.schema[id].dataType.simpleString(), rows.schema["embedding"].dataType.elementType
    first = rows.orderBy(id).limit(head + 1).collect()  # ``head`` rows and one
    behind = None
    if len(first) > head:
        last = first[-1][0]  # its rows may not be whole here
        first = [r for r in first if r[0] < last]
        behind = rows.where(F.col(id) >= F.lit(last))
    found = None
    if first:
        x = np.array([r[1] for r in first], np.float32 if isinstance(number, T.FloatType) else np.float64)
        found = rows.mapInPandas(_pairs_with(np.array([r[0] for r in first]), x, theta, n, id), f"id_a {kind}, id_b {kind}, score double")
        found = written(found.orderBy("id_a", "id_b").limit(n), "first-pairs")
    if found is None or (behind is not None and found.count() < n):
        more = near_duplicate_pairs(rows if behind is None else behind, theta, id=id, block=block)
        found = more if found is None else found.unionByName(more)
    return found.orderBy("id_a", "id_b").limit(n)


def _highest(s: np.ndarray, top: np.ndarray, slack: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of screened products that can improve what they have found, and which of their products can be the highest."""
    high = s.max(axis=1)
    row = np.flatnonzero((high >= top - slack) & (high > -np.inf))
    return row, s[row] >= np.maximum(high[row] - 2 * slack, top[row] - slack).astype(s.dtype)[:, None]


def _nearest_of(needed, id: str):
    """(id, cell, score): of both sides of a tile each row's highest product with a row of the other side."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({id: [], "cell": [], "score": []})
        if (both := pruning.sides(pdf, id)) is None:
            return out
        a, b, cross = both
        top_a = np.full(len(a.ids), -np.inf)
        top_b = np.full(len(b.ids), -np.inf) if cross else top_a
        repeated = len(np.intersect1d(a.ids, b.ids)) if cross else len(a.ids) - len(np.unique(a.ids))
        left, right, slack = pruning.screen(a, b)

        def other(s: np.ndarray, i0: int, i1: int, j0: int, j1: int) -> np.ndarray:
            if not cross and j0 < i1:
                s[~_beyond(i0, i1, j0, j1)] = -np.inf
            if repeated:
                s[a.ids[i0:i1, None] == b.ids[None, j0:j1]] = -np.inf
            return s

        for i0, i1, ranges in pruning.meetings(a, b, cross, needed):
            for j0, j1 in ranges:
                s = other(left[i0:i1] @ right[j0:j1].T, i0, i1, j0, j1)
                (row, right_of), (column, left_of) = _highest(s, top_a[i0:i1], slack), _highest(s.T, top_b[j0:j1], slack)
                if 32 * (np.count_nonzero(right_of) + np.count_nonzero(left_of)) > s.size:  # too many are alike to score them one by one
                    s = other(a.wide(i0, i1) @ b.wide(j0, j1).T, i0, i1, j0, j1)
                    np.maximum(top_a[i0:i1], s.max(axis=1), out=top_a[i0:i1])
                    np.maximum(top_b[j0:j1], s.max(axis=0), out=top_b[j0:j1])
                elif len(row) or len(column):
                    (i, j), (y, x) = pruning.places(right_of), pruning.places(left_of)
                    i, j = np.append(row[i], x) + i0, np.append(j, column[y]) + j0
                    score = pruning.scores(a, b, i, j)
                    np.maximum.at(top_a, i, score)
                    np.maximum.at(top_b, j, score)
        found = [pd.DataFrame({id: x.ids, "cell": x.rows["cell"].to_numpy(), "score": top}) for x, top in ((a, top_a), (b, top_b))[: 1 + cross]]
        out = pd.concat(found)
        return out[out["score"] > -np.inf]

    return run


def nearest_other(vectors: DataFrame, *, id: str = "entity_id", block: int = 4096) -> DataFrame:
    """VEC-5: (id, score) of the nearest other row; null for a single row.

    First rows meet those of their own cell, then, in bands, cells whose bound is not below what all rows of one of the two have found;
    two rows meet once for both.
    """
    rows = vectors.select(id, "embedding").where("embedding is not null")
    pivots = pruning.pivots_of(rows, id, rows.count(), block)
    placed = pruning.in_cells(rows, pivots, "cells")
    cells = pruning.Cells.of(placed, len(pivots))
    bands = pruning.Bands.cut(cells, block)
    schema = f"{id} {rows.schema[id].dataType.simpleString()}, cell int, score double"
    every = pruning.packed(np.ones((len(pivots),) * 2, bool))
    near = bands.place(placed, id).select("cell", "nth", id, "embedding", F.lit(False).alias("cross"), F.lit(0).alias("side"))
    own = written(near.groupBy("cell", "nth").applyInPandas(_nearest_of(every, id), schema), "own")
    found, least = np.zeros(len(pivots), np.int64), np.full(len(pivots), -np.inf)
    for r in own.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).collect():  # a row for each pivot
        found[r.cell], least[r.cell] = r.n, r.least
    least[found < cells.n] = -np.inf
    bound = pruning.bounds(pivots, cells, cells)[1]
    bound = np.maximum(bound, bound.T)
    needed = (bound >= least[:, None]) | (bound >= least[None, :])
    both, _ = pruning.band_tiles(placed, bands, id, needed)
    met = both.select("tile", "cross", "side", "cell", id, "embedding").groupBy("tile").applyInPandas(_nearest_of(pruning.packed(needed), id), schema)
    best = own.unionByName(met).groupBy(id).agg(F.max("score").alias("score"))
    return rows.select(id).join(best, id, "left")


def vector_profile(vectors: DataFrame, dimension: int, tolerance: float = 1e-3) -> DataFrame:
    """VEC-6, AGG-6..8: one row about widths, finite cells and norms."""
    finite = F.filter("embedding", lambda x: ~F.isnan(x) & (F.abs(x) < float("inf")))
    n = norm("embedding")
    return vectors.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.size("embedding") != dimension).alias("wrong_dim"),
        (F.sum(F.size(finite)) / F.sum(F.size("embedding"))).alias("finite_ratio"),
        F.avg(n).alias("norm_mean"),
        F.stddev_pop(n).alias("norm_std"),
        F.min(n).alias("norm_min"),
        F.max(n).alias("norm_max"),
        F.avg((F.abs(n - 1) <= tolerance).cast("int")).alias("unit_rate"),
    )


def id_map(vectors: DataFrame, id: str = "poi_id", path: str | None = None) -> DataFrame:
    """SNK-9, WIN-7: (pos, id) of rows with a vector, numbered from 0 in the order of the id, without a single sorting task.

    The run is written, to ``path`` or a new shared folder (see :class:`~lakecraft.sources.positions.Positions`).
    """
    return Positions.write(vectors.where("embedding is not null").select(id), id, path).read()


def at_positions(index: Positions, rows: DataFrame, positions: DataFrame, id: str = "poi_id") -> DataFrame:
    """JOIN-5: the rows at an index's positions: positions to ids, by the index's files that hold them, and ids to rows."""
    return index.at(positions).join(rows, id)


def query_text() -> Column:
    """VEC-7: title and the fields that tell equal titles apart, by a row's columns."""
    place = F.array(*[clean_text(c) for c in ("titulo", "distrito")], F.coalesce(clean_text("categoria_google"), clean_text("tipo")), clean_text("direccion"))
    event = F.array(*[clean_text(F.col(c).cast("string")) for c in ("titulo", "tipo", "lugar", "fecha_inicio", "hora_inicio")])
    parts = F.when(F.lower(F.trim("entity_type")) == "place", place).otherwise(event)
    return F.when(clean_text("titulo").isNotNull(), F.array_join(F.filter(parts, lambda x: x.isNotNull()), " | ")).otherwise("")


def _better_of(needed, k: int, id: str):
    """(query_id, better): for each query of a tile, how many rows come before its own; k rows are as good as more."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if (both := pruning.sides(pdf, "query_id", id)) is None:
            return pd.DataFrame({"query_id": [], "better": []})
        a, b, cross = both
        own, n = a.rows["own"].to_numpy(), np.zeros(len(a.ids), np.int64)
        left, right, slack = pruning.screen(a, b)
        for i0, i1, ranges in pruning.meetings(a, b, cross, needed):
            for j0, j1 in ranges:
                i, j = pruning.places(left[i0:i1] @ right[j0:j1].T >= (own[i0:i1, None] - slack).astype(left.dtype))
                open = n[i + i0] < k
                i, j = i[open] + i0, j[open] + j0
                s = pruning.scores(a, b, i, j)
                before = (s > own[i]) | ((s == own[i]) & (b.ids[j] < a.ids[i]))
                np.add.at(n, i[before], 1)
        return pd.DataFrame({"query_id": a.ids[n > 0], "better": n[n > 0]})

    return run


def own_ranks(vectors: DataFrame, queries: DataFrame, k: int, *, id: str = "entity_id", block: int = 4096) -> DataFrame:
    """AGG-10: (query_id, rank) of the row of each query's id among all rows by the query, where that is ``k`` or better.

    Rows before a query's own one are counted, no ranking is made. Cells whose bound is below the own score of all of a cell's
    queries are passed over; a tile holds some hundredth of the products at least, so that rows and queries are sent a few times.
    """
    rows = vectors.select(id, "embedding").where("embedding is not null")
    mine = rows.select(F.col(id).alias("query_id"), F.col("embedding").alias("_own"))
    asked = queries.select("query_id", "embedding").where("embedding is not null").join(mine, "query_id")
    asked = asked.select("query_id", "embedding", dot(F.col("embedding"), F.col("_own")).alias("own"))
    kind, query_kind = rows.schema[id].dataType.simpleString(), asked.schema["query_id"].dataType.simpleString()
    n = rows.count()
    pivots = pruning.pivots_of(rows, id, n, block)
    right, left = pruning.in_cells(rows, pivots, "vector-cells"), pruning.in_cells(asked, pivots, "query-cells")
    own, other = pruning.Cells.of(left, len(pivots)), pruning.Cells.of(right, len(pivots))
    least = np.full(len(pivots), np.inf)
    for r in left.groupBy("cell").agg(F.min("own").alias("least")).collect():  # a row for each pivot
        least[r.cell] = r.least - pruning.ROUNDING * (1 + abs(r.least))
    needed = (pruning.bounds(pivots, own, other)[1] >= least[:, None]) & (own.n > 0)[:, None] & (other.n > 0)[None, :]
    size = pruning.band_rows(n, 2 * pruning.BANDS)
    left, right = left.withColumn(id, F.lit(None).cast(kind)), right.withColumn("query_id", F.lit(None).cast(query_kind)).withColumn("own", F.lit(None).cast("double"))
    both, _ = pruning.band_tiles(left, pruning.Bands.cut(own, block, size), "query_id", needed, right, pruning.Bands.cut(other, block, size), id)
    counts = both.select("tile", "cross", "side", "cell", "query_id", id, "embedding", "own").groupBy("tile").applyInPandas(_better_of(pruning.packed(needed), k, id), f"query_id {query_kind}, better long")
    rank = (F.coalesce(F.sum("better"), F.lit(0)) + 1).alias("rank")
    return left.select("query_id").join(counts, "query_id", "left").groupBy("query_id").agg(rank).where(F.col("rank") <= k)


def self_recall(vectors: DataFrame, queries: DataFrame, k: int, *, id: str = "entity_id", few: int = 512) -> DataFrame:
    """AGG-10: how often a row is the first and among the first k answers to its own query (query_id is its id).

    ``few`` queries are answered by one scan (:func:`top_k`), of more the own rows' ranks are counted (:func:`own_ranks`).
    """
    if queries.where("embedding is not null").count() <= few:
        own = top_k(vectors, queries, k, id=id, block=few).where(F.col("query_id") == F.col(id)).select("query_id", "rank")
    else:
        own = own_ranks(vectors, queries, k, id=id)
    return queries.select("query_id").join(own, "query_id", "left").agg(F.count(F.lit(1)).alias("n"), F.avg(F.coalesce((F.col("rank") == 1).cast("int"), F.lit(0))).alias("recall_at_1"), F.avg(F.col("rank").isNotNull().cast("int")).alias("recall_at_k"))


def jaccard(a: Column, b: Column) -> Column:
    """SET-4: overlap of two sets; 1 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def overlap(a: DataFrame, b: DataFrame, id: str = "entity_id") -> DataFrame:
    """VEC-8: (query_id, jaccard) of two rankings' ids; a query that one of them lacks has the empty set there."""
    sets = lambda df, name: df.groupBy("query_id").agg(F.collect_set(id).alias(name))
    none = F.array().cast(f"array<{a.schema[id].dataType.simpleString()}>")
    both = sets(a, "x").join(sets(b, "y"), "query_id", "full")
    return both.select("query_id", jaccard(F.coalesce("x", none), F.coalesce("y", none)).alias("jaccard"))


def report_rows(rows: DataFrame, n: int = 10) -> DataFrame:
    """SRT-6: the rows of the highest overlap, equal ones by query."""
    return rows.orderBy(F.desc("jaccard"), "query_id").limit(n)


def overlap_summary(rows: DataFrame, threshold: float = 0.7) -> DataFrame:
    """AGG-11."""
    return rows.agg(F.count(F.lit(1)).alias("n"), F.avg("jaccard").alias("mean"), F.min("jaccard").alias("low"), F.max("jaccard").alias("high"), F.count_if(F.col("jaccard") >= threshold).alias("above"))
