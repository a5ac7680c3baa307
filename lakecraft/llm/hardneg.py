"""Operator 11: hard negatives by bit-sliced integer products.

Components are integers, taken apart into bit-planes. A product of rows and anchors is added up plane by plane from the
most significant one; what the planes that are left can add is known from the anchor alone, so each pair has an
interval that halves with every plane. A pair is dropped once its interval cannot meet its anchor's thresholds, which
rise as better rows are found; the last planes are computed for the remaining pairs only.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import materialise

LARGEST = 1 << 24  # a component's magnitude, so that any product of up to 2**15 of them fits 64 bits
FEW = 1 / 16  # of the pairs of a block: fewer are followed one by one


def sliced_products(rows: np.ndarray, anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, product) of all pairs with ``low <= product <= high`` of the anchor; exact."""
    n, width = rows.shape
    bits = max(1, int(max(rows.max(initial=0), -rows.min(initial=0) - 1)).bit_length())
    largest = int(np.abs(anchors).max(initial=0)) * max(1, width)
    single = largest << (bits + 1) < 1 << 24  # then all sums are exact in single precision
    kind = np.float32 if single else np.float64
    a = anchors.T.astype(kind)
    most, least = np.maximum(anchors, 0).sum(axis=1), np.minimum(anchors, 0).sum(axis=1)
    bounds = (low.astype(np.int64), high.astype(np.int64))

    def plane(j: int, x: np.ndarray) -> np.ndarray:
        return (x < 0 if j == bits else (x >> j) & 1).astype(kind)

    part = np.zeros((n, len(anchors)), np.float32 if single else np.int64)
    at = np.arange(n)
    for j in range(bits, -1, -1):
        weight = -(1 << bits) if j == bits else 1 << j
        product = plane(j, rows[at]) @ a
        part += (product if single else product.astype(np.int64)) * part.dtype.type(weight)
        rest = (1 << j) - 1  # what a component's lower planes add at most
        alive = (part >= bounds[0] - rest * most) & (part <= bounds[1] - rest * least)
        some = alive.any(axis=1)
        if not some.all():
            at, part, alive = at[some], part[some], alive[some]
        if np.count_nonzero(alive) <= FEW * alive.size or j == 0:
            break
    i, q = np.nonzero(alive)
    value, i = part[i, q].astype(np.int64), at[i]
    while j > 0 and len(i):
        j -= 1
        for lo in range(0, len(i), 1 << 15):
            s = slice(lo, lo + (1 << 15))
            value[s] += (((rows[i[s]] >> j) & 1) * anchors[q[s]]).sum(axis=1) << j
        rest = (1 << j) - 1
        keep = (value >= bounds[0][q] - rest * most[q]) & (value <= bounds[1][q] - rest * least[q])
        i, q, value = i[keep], q[keep], value[keep]
    return i, q, value


def first_of(group: np.ndarray, score: np.ndarray, id: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores of each group, equal ones by id; in that order."""
    order = np.lexsort((id, -score, group))
    own = group[order]
    start = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, np.int64)
    nth = np.arange(len(own)) - np.repeat(start, np.diff(np.r_[start, len(own)]))
    return order[nth < k]


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.int64)


def nearest(rows: np.ndarray, ids: np.ndarray, anchors: np.ndarray, own: np.ndarray, k: int, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, id, score) of the first ``k`` rows of each anchor; a row of the anchor's own id is not one."""
    least = np.iinfo(np.int64).min // 2
    low, high = np.full(len(anchors), least), np.full(len(anchors), -least)
    best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    for lo in range(0, len(rows), step):
        i, q, score = sliced_products(rows[lo : lo + step], anchors, low, high)
        i, other = i + lo, ids[i + lo] != own[q]
        best = tuple(np.concatenate((a, b)) for a, b in zip(best, (q[other], ids[i[other]], score[other]), strict=True))
        first = first_of(best[0], best[2], best[1], k)
        best = tuple(x[first] for x in best)
        full = np.bincount(best[0], minlength=len(anchors)) >= k
        worst = np.full(len(anchors), -least)
        np.minimum.at(worst, best[0], best[2])
        low = np.where(full, worst, least)
    return best


def within(rows: np.ndarray, ids: np.ndarray, kinds: np.ndarray, anchors: np.ndarray, own: np.ndarray, windows: tuple[np.ndarray, np.ndarray, np.ndarray], k: int, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, id, score) of the first ``k`` rows of another kind in each window (its anchor, least and largest score)."""
    of, least, largest = windows
    best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    floor = least.copy()
    order = np.argsort(of, kind="stable")
    first = np.searchsorted(of[order], np.arange(len(anchors)))
    count = np.bincount(of, minlength=len(anchors))
    none = np.iinfo(np.int64).max // 2
    for lo in range(0, len(rows), step):
        low, high = np.full(len(anchors), none), np.full(len(anchors), -none)
        np.minimum.at(low, of, floor)
        np.maximum.at(high, of, largest)
        i, q, score = sliced_products(rows[lo : lo + step], anchors, low, high)
        i = i + lo
        apart = kinds[i] != own[q]
        i, q, score = i[apart], q[apart], score[apart]
        nth = np.arange(count[q].sum()) - np.repeat(np.cumsum(count[q]) - count[q], count[q])
        w = order[np.repeat(first[q], count[q]) + nth]
        i, score = np.repeat(i, count[q]), np.repeat(score, count[q])
        fits = (score >= floor[w]) & (score <= largest[w])
        best = tuple(np.concatenate((a, b)) for a, b in zip(best, (w[fits], ids[i[fits]], score[fits]), strict=True))
        taken = first_of(best[0], best[2], best[1], k)
        best = tuple(x[taken] for x in best)
        full = np.bincount(best[0], minlength=len(of)) >= k
        worst = np.full(len(of), none)
        np.minimum.at(worst, best[0], best[2])
        floor = np.where(full, np.maximum(worst, least), least)
    return best


def tiles(rows: DataFrame, anchors: DataFrame, by: list[str], row_block: int, anchor_block: int):
    """Rows and anchors grouped by ``by``, block of rows and block of anchors: every row once for each block of anchors and the other way round.

    Blocks are by a hash of the id, their numbers follow from the counts, so no task holds more than a block of each.
    """
    blocks = lambda size, name: F.greatest(F.ceil(F.col("n") / size), F.lit(1)).cast("int").alias(name)
    m = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).select(*by, blocks(row_block, "m"))
    n = anchors.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).select(*by, blocks(anchor_block, "n"))
    both = materialise(m.join(n, by), "blocks")  # what has no anchor goes nowhere
    own = lambda c: F.pmod(F.xxhash64("vec_id"), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    left = rows.join(both, by).withColumn("r", own("m")).withColumn("a", every("n")).drop("m", "n")
    right = anchors.join(both, by).withColumn("a", own("n")).withColumn("r", every("m")).drop("m", "n")
    right = right.select(*[F.col(c).alias(c) for c in right.columns])  # columns of its own beside those of ``rows``
    return left.groupBy(*by, "r", "a").cogroup(right.groupBy(*by, "r", "a"))


def hard_negatives(vectors: DataFrame, anchor: Column, *, id: str = "vec_id", label: str = "label", vector: str = "embedding", scale: int = 256, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, row_block: int = 16_384, anchor_block: int = 2048, step: int = 2048) -> DataFrame:
    """The hardest negatives of each anchor and positive.

    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score. ``anchor`` tells the anchors by the
    id. Components count as floor(``scale`` * x); a score is their inner product. An anchor's positives are its first
    ``positives`` other rows of the same label, the negatives of each the first ``negatives`` rows of another label with
    ``low * positive_score <= 100 * negative_score <= high * positive_score``; higher scores first, then smaller ids.
    A positive without such a row has no row here.

    Rows with a null id, label or vector, or a null, NaN or infinite component take no part, nor do rows with a component of
    2**24 or more, whose scores would not fit 64 bits. Rows meet only rows of the same width; vectors without components
    score 0. Of rows that share an id the first in the order of label and components counts. An empty table gives no
    rows, other columns are ignored.
    """
    x = F.transform(F.col(vector), lambda v: F.floor(v.cast("double") * scale))
    usable = F.forall(F.col(vector), lambda v: F.coalesce(F.abs(v.cast("double") * scale) < LARGEST, F.lit(False)))  # not NaN, which is the largest
    rows = vectors.where(F.col(id).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & usable)
    rows = rows.select(F.col(id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), F.transform(x, lambda v: v.cast("int")).alias("x"))
    rows = rows.groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("v")).select("vec_id", "v.label", "v.x", F.size("v.x").alias("width"))
    rows = materialise(rows, "components")
    anchors = rows.where(anchor)

    def find_positives(pdf: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty or queries.empty:
            return pd.DataFrame({"anchor_id": [], "positive_id": [], "positive_score": []})
        own = queries["vec_id"].to_numpy()
        q, found, score = nearest(matrix(pdf["x"]), pdf["vec_id"].to_numpy(), matrix(queries["x"]), own, positives, step)
        return pd.DataFrame({"anchor_id": own[q], "positive_id": found, "positive_score": score})

    met = tiles(rows, anchors, ["width", "label"], row_block, anchor_block).applyInPandas(find_positives, "anchor_id long, positive_id long, positive_score long")
    w = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    chosen = materialise(met.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= positives).drop("nth"), "positives")
    asked = chosen.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("p"))  # ``positives`` of them at most
    asked = anchors.join(asked, "vec_id").select("*", F.col("p.positive_id").alias("ids"), F.col("p.positive_score").alias("scores")).drop("p")

    def find_negatives(pdf: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty or queries.empty:
            return pd.DataFrame({"anchor_id": [], "positive_id": [], "negative_id": [], "positive_score": [], "negative_score": []})
        of = np.repeat(np.arange(len(queries)), [len(p) for p in queries["ids"]])
        positive, score = np.concatenate(queries["ids"].to_numpy()), np.concatenate(queries["scores"].to_numpy()).astype(np.int64)
        least, largest = -(-low * score // 100), high * score // 100
        kinds = pd.factorize(pd.concat([pdf["label"], queries["label"]], ignore_index=True))[0]
        w, found, value = within(matrix(pdf["x"]), pdf["vec_id"].to_numpy(), kinds[: len(pdf)], matrix(queries["x"]), kinds[len(pdf) :], (of, least, largest), negatives, step)
        return pd.DataFrame({"anchor_id": queries["vec_id"].to_numpy()[of[w]], "positive_id": positive[w], "negative_id": found, "positive_score": score[w], "negative_score": value})

    schema = "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"
    met = tiles(rows, asked, ["width"], row_block, anchor_block).applyInPandas(find_negatives, schema)
    w = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = met.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
