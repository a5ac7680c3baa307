"""Operator 13: near-duplicate embeddings by a forest of random-projection trees.

Nodes of a tree are split at the median of a random projection; rows near the split go to both sides (spill). Trees grow
by rounds, each fitting some levels of every large node on a bounded sample of its rows. Rows are compared within
leaves, and each link is counted in the first leaf that its rows share. Copies are one row with a number; rows so near
to one pivot that all of them must be links of each other (a ball) are counted, not compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ngram_join import connected
from .shared import materialise
from .wordhash import mix

SEED = 13
LEVELS = 6  # of a tree that a round fits
LEAST = 32  # rows of a sample that a leaf, or a ball, takes
STUCK = 0.85  # a split that leaves a larger share on one side is none
PIVOTS = 32  # balls of a node
SALT = 65_536  # rows of a node that one task routes


def unit(column: pd.Series) -> np.ndarray:
    """Rows of length one, in double precision, whatever their scale."""
    x = np.stack(column.to_numpy()).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def direction(tree: int, node: int, path: int, choice: int, width: int) -> np.ndarray:
    d = np.random.default_rng((SEED, tree, node & ((1 << 64) - 1), path, choice)).standard_normal(width)
    return d / np.sqrt(d @ d)


def child(node: int, path: int) -> int:
    """The id of the node at the end of a path below a node."""
    key = np.array([(node & ((1 << 64) - 1)) ^ (path * 0x9E3779B97F4A7C15 & ((1 << 64) - 1))], np.uint64)
    return int(mix(key).astype(np.int64)[0])


def fit_splits(x: np.ndarray, tree: int, node: int, share: float, apart: float) -> dict[int, tuple[int, float, float]]:
    """Splits by path (1 is the node, 2p and 2p+1 are the children of p): (direction's number, threshold, margin).

    ``share``: of the rows that a leaf may have at most. ``apart``: the spread of what two rows at the threshold differ in
    along a direction. The margin is half of it where rows spread far more, and all of it in a crowd, where a split would
    part many links; a crowd is then hardly divided by it and soon no longer split.
    """
    splits, todo = {}, [(1, np.arange(len(x)))]
    while todo:
        path, rows = todo.pop()
        if path >= 1 << LEVELS or len(rows) < 2 * LEAST or len(rows) <= share * len(x):
            continue
        projected = [x[rows] @ direction(tree, node, path, c, x.shape[1]) for c in range(3)]
        c = int(np.argmax([p.std() for p in projected]))
        at = float(np.median(projected[c]))
        margin = apart * min(1.0, max(0.5, apart / max(1e-12, float(projected[c].std()))))
        low, high = rows[projected[c] <= at + margin], rows[projected[c] >= at - margin]
        if max(len(low), len(high)) <= STUCK * len(rows):
            splits[path] = (c, at, margin)
            todo += [(2 * path, low), (2 * path + 1, high)]
    return splits


def fit_balls(x: np.ndarray, cosine: float) -> np.ndarray:
    """Pivots, each with LEAST rows of the sample within ``cosine`` that no pivot before it has."""
    near = x @ x.T >= cosine
    pivots = []
    while len(pivots) < PIVOTS:
        counts = near.sum(axis=1)
        best = int(np.argmax(counts))
        if counts[best] < LEAST:
            break
        pivots.append(best)
        taken = near[best].copy()
        near[:, taken] = False
        near[taken] = False
    return x[pivots]


def route(x: np.ndarray, tree: int, node: int, splits: dict[int, tuple[int, float, float]]) -> Iterator[tuple[int, np.ndarray]]:
    """(path, rows) of the leaves that a node's splits send rows to."""
    todo = [(1, np.arange(len(x)))]
    while todo:
        path, rows = todo.pop()
        if path not in splits:
            if len(rows):
                yield path, rows
            continue
        c, at, margin = splits[path]
        p = x[rows] @ direction(tree, node, path, c, x.shape[1])
        todo += [(2 * path, rows[p <= at + margin]), (2 * path + 1, rows[p >= at - margin])]


def first_shared(leaves: np.ndarray, i: np.ndarray, j: np.ndarray, leaf: int) -> np.ndarray:
    """Of pairs of rows in a leaf, those that share no smaller one. ``leaves``: (rows, most), filled up with the largest number."""
    out = np.ones(len(i), bool)
    for lo in range(0, len(i), 1 << 14):
        a, b = leaves[i[lo : lo + (1 << 14)]], leaves[j[lo : lo + (1 << 14)]]
        a, b = np.where(a < leaf, a, np.iinfo(np.int64).max), np.where(b < leaf, b, np.iinfo(np.int64).max - 1)
        for k in range(a.shape[1]):
            out[lo : lo + (1 << 14)] &= ~(a[:, k : k + 1] == b).any(axis=1)
    return out


def joined(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels (places, each the least of its component) after the links (i, j)."""
    while True:
        a, b = labels[i], labels[j]
        if (a == b).all():
            return labels
        to = np.arange(len(labels))
        np.minimum.at(to, np.maximum(a, b), np.minimum(a, b))
        while not (to[to] == to).all():
            to = to[to]
        labels = to[labels]


def near_duplicate_embeddings(vectors: DataFrame, *, id: str = "vec_id", label: str = "label", vector: str = "embedding", threshold: float = 0.93, trees: int = 6, leaf: int = 512, sample: int = 2048, block: int = 2048) -> DataFrame:
    """Links of vectors of one label whose cosine is ``threshold`` or more, and their components.

    Returns a row for each row: the id, n_links (other rows linked directly), component_id (smallest id reachable), kept
    (the id is component_id). Every link is verified in double precision. A tree parts a link at the threshold itself with a
    chance of some hundredths at each level, ``trees`` trees with spill lose one in thousands (tests measure it by brute
    force, at the threshold, in crowds, several rounds deep). Roots of up to ``leaf`` rows are compared whole.

    ``sample``: rows of a node that its splits are fitted on, at most but for chance; every row is routed. ``block``: rows of
    a side of a comparison; larger leaves are compared block against block, but for blocks of one ball.

    Null labels, null or zero vectors, and vectors with null or non-finite components link with nothing; vectors of
    different widths do not either. Rows with a null id take part and have the component of their links (null if no
    id is in it). Copies and repeated rows link with each other. An empty table gives no rows, other columns are ignored.
    """
    spark = vectors.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = vectors.select(F.col(id).alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).alias("v"))
    kind = rows.schema["id"].dataType.simpleString()
    finite = F.forall("v", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))  # NaN is above
    usable = F.col("label").isNotNull() & F.coalesce(finite & F.exists("v", lambda x: x != 0), F.lit(False))
    copies = rows.where(usable).groupBy("label", "v").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    node = F.xxhash64("label", F.size("v"))
    groups = materialise(copies.select(F.monotonically_increasing_id().alias("gid"), "label", "v", "rep", "copies", node.alias("node")), "vectors")

    half = math.cos(math.acos(threshold) / 2 - 1e-7)  # of two rows so near to a pivot the cosine is above the threshold
    chord = math.sqrt(2 - 2 * threshold)
    sizes = groups.groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    sized = groups.join(sizes, "node")
    leaves = sized.where(F.col("n") <= leaf).select("gid", "node")
    every = F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))
    # Nodes are written without the vectors; those of rows that go on are joined when they are routed again.
    active = sized.where(F.col("n") > leaf).select("gid", every.alias("tree"), "node", "v").withColumn("node", F.xxhash64("node", "tree"))
    balls, turn = None, 0

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        tree, node, n = int(pdf["tree"].iat[0]), int(pdf["node"].iat[0]), int(pdf["n"].iat[0])
        x = unit(pdf.sort_values("gid")["v"])
        splits = fit_splits(x, tree, node, leaf / n, chord / math.sqrt(x.shape[1]))
        pivots = fit_balls(x, half) if tree == 0 else x[:0]
        paths = list(splits)
        return pd.DataFrame({"tree": [tree], "node": [node], "n": [n], "paths": [paths], "choices": [[splits[p][0] for p in paths]], "at": [[splits[p][1] for p in paths]], "margins": [[splits[p][2] for p in paths]], "pivots": [pivots.astype(np.float64).ravel().tolist()]})

    fitted = "tree int, node long, n long, paths array<int>, choices array<int>, at array<double>, margins array<double>, pivots array<double>"

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        spec = None
        for pdf in frames:
            cuts = np.flatnonzero(~pdf["data"].to_numpy())
            ends = np.r_[cuts, len(pdf)]
            for lo, hi in zip(np.r_[0, cuts], ends, strict=True):
                part = pdf.iloc[lo:hi]
                if len(part) and not part["data"].iat[0]:
                    head = part.iloc[0]
                    splits = dict(zip(map(int, head["paths"]), zip(map(int, head["choices"]), head["at"], head["margins"], strict=True), strict=True))
                    spec = (int(head["tree"]), int(head["node"]), splits, np.asarray(head["pivots"], np.float64))
                    part = part.iloc[1:]
                if part.empty:
                    continue
                tree, node, splits, pivots = spec
                x = unit(part["v"])
                ball = np.full(len(x), -1)
                if len(pivots):
                    near = x @ pivots.reshape(-1, x.shape[1]).T >= half
                    ball = np.where(near.any(axis=1), near.argmax(axis=1), -1)
                for path, i in route(x, tree, node, splits):
                    out = part.iloc[i][["gid"]].assign(tree=tree, node=child(node, path), split=path != 1)
                    yield out.assign(ball=[child(node, 1000 + int(b)) if b >= 0 else None for b in ball[i]])

    routed = "gid long, tree int, node long, split boolean, ball long"
    while not active.isEmpty():
        sizes = materialise(active.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("n")), "sizes")
        large = active.join(sizes, ["tree", "node"])
        taken = F.pmod(F.xxhash64("gid", F.lit(turn)), F.lit(1 << 30)) < F.lit(sample << 30) / F.col("n")
        fits = materialise(large.where(taken).select("gid", "v", "tree", "node", "n").groupBy("tree", "node").applyInPandas(fit, fitted), "splits")
        salts = F.ceil(F.col("n") / SALT).cast("int")
        data = active.join(fits.select("tree", "node", salts.alias("salts")), ["tree", "node"])
        data = data.select("tree", "node", F.pmod(F.xxhash64("gid"), F.col("salts")).cast("int").alias("salt"), F.lit(True).alias("data"), "gid", "v")
        heads = fits.select("tree", "node", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), F.lit(False).alias("data"), "paths", "choices", "at", "margins", "pivots")
        key = ["tree", "node", "salt"]
        dealt = data.unionByName(heads, allowMissingColumns=True).repartition(tasks, *key).sortWithinPartitions(*key, "data")
        sent = materialise(dealt.mapInPandas(send, routed), "nodes", arrow_rows=2000)
        found = sent.where("ball is not null").select("gid", F.struct(F.lit(turn).alias("turn"), "ball").alias("ball"))
        balls = found if balls is None else balls.unionByName(found)
        leaves = leaves.unionByName(sent.where("not split").select("gid", "node"))  # no split divides these
        on = sent.where("split").select("gid", "tree", "node")
        left = materialise(on.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("n")), "sizes")
        leaves = leaves.unionByName(on.join(left.where(F.col("n") <= leaf), ["tree", "node"]).select("gid", "node"))
        on = on.join(left.where(F.col("n") > leaf).select("tree", "node"), ["tree", "node"])
        active, turn = on.join(groups.select("gid", "v"), "gid").select("gid", "tree", "node", "v"), turn + 1
    return _linked(rows, usable, groups, materialise(leaves, "leaves"), balls, kind, threshold, block)


def _linked(rows: DataFrame, usable: Column, groups: DataFrame, leaves: DataFrame, balls: DataFrame | None, kind: str, threshold: float, block: int) -> DataFrame:
    """Compares the rows of each leaf, joins the links, and gives every row its result."""
    places = leaves.groupBy("gid").agg(F.sort_array(F.collect_set("node")).alias("leaves"))  # of a bounded number of trees
    members = groups.select("gid", "v", "copies").join(places, "gid")
    one = balls.groupBy("gid").agg(F.min("ball").alias("ball")).select("gid", "ball.ball") if balls is not None else groups.where("false").select("gid", F.lit(None).cast("long").alias("ball"))
    members = materialise(members.join(one, "gid", "left"), "members")
    # Leaves of more than a block: blocks of each larger ball and of the other rows; two blocks of one ball are no task.
    at = members.select("gid", "ball", F.explode("leaves").alias("leaf"))
    counts = materialise(at.groupBy("leaf", "ball").agg(F.count(F.lit(1)).alias("m")), "leaf-sizes")
    large = counts.groupBy("leaf").agg(F.sum("m").alias("n")).where(F.col("n") > block)
    own = F.when((F.col("n") > block) & (F.col("m") > block // 8), F.col("ball"))
    parts = counts.join(large, "leaf", "left").withColumn("part", own)
    sides = materialise(parts.groupBy("leaf", "part").agg(F.ceil(F.sum("m") / block).cast("int").alias("blocks")), "blocks")
    x = sides.select("leaf", F.col("part").alias("a"), F.col("blocks").alias("na"))
    y = sides.select("leaf", F.col("part").alias("b"), F.col("blocks").alias("nb"))
    first = lambda c: F.coalesce(F.col(c), F.lit(-(1 << 63)).cast("long"))
    both = x.join(y, "leaf").where((first("a") < first("b")) | (F.col("a").isNull() & F.col("b").isNull()))  # parts of one leaf: balls, few
    both = both.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("na") - 1))).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    both = both.where(~F.col("b").isNull() | (F.col("i") <= F.col("j"))).withColumn("tile", F.xxhash64("leaf", "a", "b", "i", "j"))
    both = both.withColumn("cross", ~(F.col("a").eqNullSafe(F.col("b")) & (F.col("i") == F.col("j"))))
    left = both.select("leaf", F.col("a").alias("part"), F.col("i").alias("nth"), "tile", "cross", F.lit(0).alias("side"))
    right = both.where("cross").select("leaf", F.col("b").alias("part"), F.col("j").alias("nth"), "tile", "cross", F.lit(1).alias("side"))
    tiles = materialise(left.unionByName(right).withColumn("part", first("part")), "tiles")
    known = parts.select("leaf", F.col("ball").alias("of"), first("part").alias("part")).withColumn("of", first("of")).join(sides.select("leaf", first("part").alias("part"), "blocks"), ["leaf", "part"])
    asked = members.withColumn("leaf", F.explode("leaves")).withColumn("of", first("ball")).join(known, ["leaf", "of"])
    asked = asked.withColumn("nth", F.pmod(F.xxhash64("gid"), F.col("blocks")).cast("int")).join(tiles, ["leaf", "part", "nth"])

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("gid", ignore_index=True)
        leaf, side = int(pdf["leaf"].iat[0]), pdf["side"].to_numpy()
        gid, copies, v = pdf["gid"].to_numpy(), pdf["copies"].to_numpy(), unit(pdf["v"])
        ball = pdf["ball"].astype("Int64").fillna(-1).to_numpy(np.int64) if pdf["ball"].notna().any() else np.full(len(pdf), -1)
        most = max(map(len, pdf["leaves"]))
        places = np.full((len(pdf), most), np.iinfo(np.int64).max)
        for k, p in enumerate(pdf["leaves"]):
            places[k, : len(p)] = p
        cross = bool(pdf["cross"].iat[0])
        a, b = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if cross else (np.arange(len(pdf)),) * 2
        links, labels = np.zeros(len(pdf), np.int64), np.arange(len(pdf))
        for lo in range(0, len(a), 512):
            near = v[a[lo : lo + 512]] @ v[b].T >= threshold
            i, j = np.nonzero(near)
            i, j = a[lo + i], b[j]
            keep = ((ball[i] != ball[j]) | (ball[i] == -1)) & (cross | (i < j))
            i, j = i[keep], j[keep]
            keep = first_shared(places, i, j, leaf)
            i, j = i[keep], j[keep]
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            labels = joined(labels, i, j)
        some = links > 0
        return pd.DataFrame({"gid": gid[some], "root": gid[labels[some]], "links": links[some]})

    tasks = asked.select("leaf", "tile", "cross", "side", "gid", "v", "copies", "leaves", "ball").groupBy("leaf", "tile")
    links = materialise(tasks.applyInPandas(compare, "gid long, root long, links long"), "links")
    inside = members.where("ball is not null")
    heads = inside.groupBy("ball").agg(F.min("gid").alias("root"), F.sum("copies").alias("n"))
    inside = materialise(inside.join(heads, "ball").select("gid", "root", (F.col("n") - F.col("copies")).alias("links")), "balls")
    found = links.unionByName(inside)
    roots = connected(found.select(F.col("gid").alias("u"), F.col("root").alias("v")))
    total = found.groupBy("gid").agg(F.sum("links").alias("links"))
    info = groups.select("gid", "label", "v", "rep", "copies").join(total, "gid", "left").join(roots.withColumnRenamed("node", "gid"), "gid", "left")
    info = info.select("label", "v", "rep", F.coalesce("root", "gid").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")).where("n_links > 0")
    info = materialise(info, "classes")
    info = info.join(info.groupBy("root").agg(F.min("rep").alias("component_id")), "root").select(F.col("label").alias("of"), F.col("v").alias("w"), "component_id", "n_links")
    out = rows.withColumn("usable", usable).join(info, F.col("usable") & (F.col("label") == F.col("of")) & (F.col("v") == F.col("w")), "left")
    component = F.coalesce("component_id", "id").cast(kind)
    return out.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
