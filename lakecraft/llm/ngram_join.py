"""N-gram Jaccard join: MinHash LSH forest, then exact verification.

A text is the set of its five-word shingles. Texts with the same set form one node (so copies cost one
row each and nothing more). A node's signature has ``trees`` label sequences of ``depth`` MinHash values; the
sequences of a tree make its prefix trie. At the least depth, which in all trees alike would give the target
recall, trie nodes of up to ``FREE`` members are taken as they are. In the others a node begins with as many labels
as bring it among so few, or all it has, and shortens one prefix after the other, always the one whose trie
node is smallest then, until its expected recall at the threshold, 1 - product of (1 - s**d) over its trees' depths
d, reaches the target. So a node keeps long prefixes where it stands among many, see :func:`shortened`. (Nodes
among few are not made to ask for less: whether they have company is what is to be found out, so a depth that
depends on one neighbour would bias the recall.)

Two nodes are candidates in a tree if they share the shorter one of their two prefixes there: each is found by
whichever of the two asks for less. Every such pair is verified exactly on the whole shingle sets, once, in the
first tree in which the two meet.

Bounds: tasks see blocks of a trie node's members (``block_rows`` rows and ``block_bytes`` bytes of
shingles at most, up to hash variance); a larger trie node is verified block against block in separate tasks, so no member is
left out and none is gathered. Verification returns one row per member (its root within the block and its
number of links), never a row per pair. Components come from star contraction over written tables.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cores, materialise, slices, text_buffers, text_of, tidy
from .wordhash import mix, shingles, word_hashes

TREES, DEPTH = 32, 7
SLOTS, FREE = 1 << 20, 64
_rng = np.random.Generator(np.random.PCG64(42))
_MUL = _rng.integers(1, 1 << 62, TREES * DEPTH * 2, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 62, TREES * DEPTH * 2, dtype=np.int64).astype(np.uint64)


def matched_depth(threshold: float, trees: int, depth: int, recall: float) -> int:
    """The longest prefix at which a pair at the threshold meets in some tree with at least this probability."""
    for d in range(depth, 1, -1):
        if 1 - (1 - threshold**d) ** trees >= recall:
            return d
    return 1


def shortened(sizes: dict[int, list[int]], trees: int, least: int, threshold: float, recall: float) -> dict[int, int]:
    """The depth of a node's prefix in each tree in which it has company.

    ``sizes[tree]`` are the members of its trie nodes at the depths ``least``, ``least`` + 1, ...; in other trees it is
    alone at depth ``least`` already, so looks no deeper there.
    """
    gain = lambda d: -math.log1p(-(threshold**d)) if threshold < 1 else math.inf
    target = -math.log1p(-recall)
    depth = {t: least + next((k for k, n in enumerate(m) if n <= FREE), len(m) - 1) for t, m in sizes.items()}
    have = (trees - len(sizes)) * gain(least) + sum(map(gain, depth.values()))
    cheapest = [(sizes[t][d - least - 1], t) for t, d in depth.items() if d > least]
    heapq.heapify(cheapest)
    while have < target and cheapest:
        _, t = heapq.heappop(cheapest)
        have += gain(depth[t] - 1) - gain(depth[t])
        depth[t] -= 1
        if depth[t] > least:
            heapq.heappush(cheapest, (sizes[t][depth[t] - least - 1], t))
    return depth


def choose(trees: int, least: int, most: int, threshold: float, recall: float):
    """Partition function: (node, places with tree, depth and members) in; (node, depths, asked) out.

    ``depths`` has a byte for each tree; ``asked`` the trie nodes with more than one member that the node asks for.
    """
    kind = pa.list_(pa.struct([("tree", pa.int32()), ("d", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            depths, asked = [], []
            for places in batch.column(1).to_pylist():
                sizes: dict[int, list[int]] = {}
                for p in sorted(places, key=lambda p: (p["tree"], p["d"])):
                    sizes.setdefault(p["tree"], []).append(p["m"])
                # Below the depth at which a node is alone it stays alone.
                depth = shortened({t: m + [1] * (most - least + 1 - len(m)) for t, m in sizes.items()}, trees, least, threshold, recall)
                depths.append(bytes(depth.get(t, least) for t in range(trees)))
                asked.append([{"tree": t, "d": d} for t, d in depth.items() if d - least < len(sizes[t])])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(depths, pa.binary()), pa.array(asked, kind)], ["node", "depths", "asked"])

    return run


def shingle_sets(words: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of every text, and their bounds."""
    every, bounds = shingles(words, first, width)
    parts = [np.unique(every[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    sizes = np.array([len(p) for p in parts], np.int64)
    return (np.concatenate(parts) if parts else every), np.concatenate(([0], np.cumsum(sizes)))


def signatures(values: np.ndarray, bounds: np.ndarray, n: int) -> np.ndarray:
    """(texts, n) MinHash labels of 16 bits; texts without shingles get zeros."""
    out = np.zeros((len(bounds) - 1, n), np.uint16)
    some = np.flatnonzero(np.diff(bounds) > 0)
    i = 0
    while i < len(some):  # as many texts at a time as keep the arrays in the processor's cache
        j = max(i + 1, int(np.searchsorted(bounds[some], bounds[some[i]] + 65536)))
        part = values[bounds[some[i]] : bounds[some[j - 1] + 1]]
        at = bounds[some[i:j]] - bounds[some[i]]
        for k in range(n):
            out[some[i:j], k] = np.minimum.reduceat((part * _MUL[k] + _ADD[k]) >> np.uint64(20), at).astype(np.uint16)
        i = j
    return out


def node_keys(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(texts, 2) 64-bit sums over a set: 128 bits that stand for the set."""
    a = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    b = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(values ^ np.uint64(0xD6E8FEB86659FD93)), dtype=np.uint64)))
    return mix(np.stack((a[bounds[1:]] - a[bounds[:-1]], b[bounds[1:]] - b[bounds[:-1]]), axis=1))


def _binary(rows: np.ndarray) -> pa.Array:
    flat = np.ascontiguousarray(rows)
    width = flat.itemsize * flat.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(flat), [None, pa.py_buffer(np.arange(0, (len(flat) + 1) * width, width, dtype=np.int32)), pa.py_buffer(flat)])


def sign(width: int, n: int):
    """Partition function: (doc_id, text) in; (doc_id, node, n, signature) out, node null without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices(batch.column(1), 4 << 20):
                part = batch.slice(i, j - i)
                values, bounds = shingle_sets(*word_hashes(*text_buffers(part.column(1))), width)
                sizes = np.diff(bounds)
                node = _binary(node_keys(values, bounds))
                none = pa.array(sizes == 0)
                node = pc.if_else(none, pa.scalar(None, pa.binary()), node)
                yield pa.RecordBatch.from_arrays([part.column(0), node, pa.array(sizes), _binary(signatures(values, bounds, n))], ["doc_id", "node", "n", "signature"])

    return run


def unfold(width: int, n: int):
    """Partition function: (text, node, copies, depths, buckets) in; a row for each bucket block with the shingles out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["bucket", "tree", "d", "lo", "hi", "side", "node", "copies", "depths", "signature", "shingles"]
        types = [pa.int64(), *[pa.int32()] * 5, pa.binary(), pa.int64(), *[pa.binary()] * 3]
        for batch in batches:
            for i, j in slices(batch.column(0), 1 << 20):
                part = batch.slice(i, j - i)
                values, bounds = shingle_sets(*word_hashes(*text_buffers(part.column(0))), width)
                keys, labels = node_keys(values, bounds), signatures(values, bounds, n)
                rows, held = [], 0
                for d, (node, copies, depths, buckets) in enumerate(zip(*(part.column(k).to_pylist() for k in (1, 2, 3, 4)), strict=True)):
                    if keys[d].tobytes() != node:  # another text under the same doc_id
                        continue
                    raw, label = values[bounds[d] : bounds[d + 1]].tobytes(), labels[d].tobytes()
                    for b in buckets:
                        blocks = b["blocks"]
                        own = int(mix(keys[d][:1])[0] % np.uint64(blocks))
                        for other in range(blocks):
                            rows.append((b["bucket"], b["tree"], b["d"], min(own, other), max(own, other), int(own > other), node, copies, depths, label, raw))
                            held += len(raw)
                            if held > 4 << 20:
                                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
                                rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return run


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets, as a matrix."""
    m = len(sets)
    if m == 2:
        k = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), k], [k, len(sets[1])]], np.float32)
    flat = np.concatenate(sets)
    own = np.repeat(np.arange(m), [len(s) for s in sets])
    _, column, uses = np.unique(flat, return_inverse=True, return_counts=True)
    keep = uses[column] > 1  # a shingle of one set only is in no intersection
    own = own[keep]
    names, column = np.unique(column[keep], return_inverse=True)
    out = np.zeros((m, m), np.float32)
    order = np.argsort(column, kind="stable")
    own, column = own[order], column[order]
    step = max(64, (1 << 22) // m)
    for lo in range(0, len(names), step):
        a, b = np.searchsorted(column, (lo, lo + step))
        block = np.zeros((m, min(step, len(names) - lo)), np.float32)
        block[own[a:b], column[a:b] - lo] = 1
        out += block @ block.T
    return out


def prefix_hashes(labels: np.ndarray) -> np.ndarray:
    """(texts, trees, depths + 1): a hash of each prefix of (texts, trees, depths) labels."""
    out = np.zeros((*labels.shape[:2], labels.shape[2] + 1), np.uint64)
    for k in range(labels.shape[2]):
        out[:, :, k + 1] = out[:, :, k] * np.uint64(0x9FB21C651E98DF25) + labels[:, :, k] + np.uint64(1)
    return out


def verified_links(sets: list[np.ndarray], prefixes: np.ndarray, depths: np.ndarray, tree: int, d: int, sides: np.ndarray, cross: bool, threshold: float) -> np.ndarray:
    """Boolean matrix of the pairs at or above the threshold that meet in this trie node and in none before.

    Two members meet in a tree where they share the prefix that is the shorter one of theirs.
    """
    m = len(sets)
    sizes = np.array([len(s) for s in sets], np.float64)
    both = shared_counts(sets).astype(np.float64)
    union = sizes[:, None] + sizes[None, :] - both
    linked = both >= threshold * union - 1e-9
    np.fill_diagonal(linked, False)
    if cross:
        linked &= sides[:, None] != sides[None, :]
    a, b = np.nonzero(np.triu(linked))
    own = depths[:, tree]
    keep = (np.minimum(own[a], own[b]) == d) & (prefixes[a, tree, d] == prefixes[b, tree, d])  # the bucket's name is a hash
    a, b = a[keep], b[keep]
    for t in range(tree):
        least = np.minimum(depths[a, t], depths[b, t])
        new = prefixes[a, t, least] != prefixes[b, t, least]
        a, b = a[new], b[new]
    out = np.zeros((m, m), bool)
    out[a, b] = out[b, a] = True
    return out


def roots(linked: np.ndarray) -> np.ndarray:
    """The smallest member index of each member's component."""
    root = np.arange(len(linked))
    while True:
        low = np.where(linked, root[None, :], len(linked)).min(axis=1, initial=len(linked))
        new = np.minimum(root, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def verify(threshold: float, depth: int):
    """Partition function over rows sorted by (bucket, tree, d, lo, hi): one row per linked member."""
    names, types = ["node", "root", "links"], [pa.binary(), pa.binary(), pa.int64()]

    def group(rows: list[tuple], tree: int, d: int, cross: bool) -> Iterator[tuple]:
        if len(rows) < 2:
            return
        node, copies, own, label, raw, side = zip(*rows, strict=True)
        labels = np.frombuffer(b"".join(label), np.uint16).reshape(len(rows), -1, depth).astype(np.uint64)
        depths = np.frombuffer(b"".join(own), np.uint8).reshape(len(rows), -1).astype(np.int64)
        linked = verified_links([np.frombuffer(r, np.uint64) for r in raw], prefix_hashes(labels), depths, tree, d, np.array(side), cross, threshold)
        if linked.any():
            links = linked @ np.array(copies, np.int64)
            for k, root in enumerate(roots(linked)):
                if links[k]:
                    yield node[k], node[root], int(links[k])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows, out = None, [], []
        for batch in batches:
            for bucket, tree, d, lo, hi, side, node, copies, own, label, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (bucket, tree, d, lo, hi) != at:
                    if at:
                        out += group(rows, at[1], at[2], at[3] != at[4])
                    at, rows = (bucket, tree, d, lo, hi), []
                if not rows or rows[-1][0] != node:  # a row repeated with its doc_id
                    rows.append((node, copies, own, label, raw, side))
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)
                out = []
        if at:
            out += group(rows, at[1], at[2], at[3] != at[4])
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    return run


def connected(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each component of the edges (u, v); large and small stars in turn.

    Each round is written to the shared folder; rounds grow with the logarithm of the longest path. Edges meet
    their node's smallest neighbour in joins of written tables with a row for each node: where a node has a large share
    of the edges, adaptive execution splits these, and nothing is gathered by node.
    """
    edges = materialise(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    state = None
    while True:
        both = edges.union(edges.select("v", "u"))
        low = materialise(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "lowest")
        larger = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))  # each edge at its smaller node
        large = materialise(larger.join(low.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "stars")
        down = materialise(large.groupBy("u").agg(F.min("v").alias("m")), "lowest")
        small = large.join(down.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(down.select("u", "m")).where("u <> v").distinct()
        edges = materialise(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        new = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if new == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = new


def ngram_jaccard_join(docs: DataFrame, *, width: int = 5, threshold: float = 0.8, recall: float = 0.99999, trees: int = TREES, depth: int = DEPTH, block_rows: int = 1024, block_bytes: int = 32 << 20) -> DataFrame:
    """Near-duplicate classes of documents.

    Returns a row for each row of ``docs``: doc_id, class_id (smallest doc_id of its component of links),
    n_links (rows whose shingle set has a Jaccard similarity of ``threshold`` or more, copies included),
    kept (doc_id equals class_id).

    Texts of fewer than ``width`` words have one shingle, all their words. Texts without words (null and
    empty ones too) link to nothing: class_id is their doc_id, n_links 0. Rows with a null doc_id take part
    in no class: class_id null, n_links 0, kept true. Rows repeated with one doc_id each get a row and count
    as copies of each other if their shingle sets are equal. An empty table returns no rows; other columns
    are ignored.
    """
    n = trees * depth
    least = matched_depth(threshold, trees, depth, recall)
    rows = text_of(docs, "doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    signed = materialise(rows.mapInArrow(tidy(sign(width, n)), f"doc_id {kind}, node binary, n long, signature binary"), "signed", arrow_rows=500)
    usable = signed.where("doc_id is not null and node is not null")
    nodes = materialise(usable.groupBy("node").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("signature").alias("signature")), "nodes")
    # The tries: a trie node is named by a hash of tree, depth and path. Nodes that are alone in theirs at the least depth are
    # left behind there; the others are counted at every depth below.
    named = lambda d: F.xxhash64(F.expr(f"substring(signature, tree * {2 * depth} + 1, 2 * {d})"), "tree")
    roots_ = nodes.select("node", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), "signature").select("node", "tree", named(least).alias("bucket"))
    company = materialise(roots_.groupBy("bucket", "tree").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("bucket", "tree"), "tries")
    below = materialise(roots_.join(company.hint("merge"), ["bucket", "tree"]).select("node", "tree"), "tries")
    paths = below.join(nodes.select("node", "n", "signature"), "node").select("node", "n", "tree", F.inline(F.array(*[F.struct(F.lit(d).alias("d"), named(d).alias("bucket")) for d in range(least, depth + 1)])))
    paths = materialise(paths, "paths")
    sizes = materialise(paths.groupBy("tree", "d", "bucket").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "tries")
    places = paths.join(sizes.hint("merge"), ["tree", "d", "bucket"]).select("node", "tree", "d", "bucket", "n", "m")
    places = materialise(places, "places")
    chosen = places.groupBy("node").agg(F.collect_list(F.struct("tree", "d", "m")).alias("places"))  # trees * depth of them at most
    chosen = materialise(chosen.mapInArrow(tidy(choose(trees, least, depth, threshold, recall)), "node binary, depths binary, asked array<struct<tree int, d int>>"), "prefixes", arrow_rows=2000)
    asks = places.join(chosen.select("node", F.inline("asked"), F.lit(True).alias("asks")), ["node", "tree", "d"], "left").withColumn("asks", F.col("asks").isNotNull())
    h = F.xxhash64("node", "asks")
    met = asks.groupBy("bucket", "tree", "d").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("bytes"), F.bit_xor(h).alias("x"), F.sum(F.shiftright(h, 20)).alias("y"), F.bool_or("asks").alias("asked")).where("asked")
    # Trie nodes with the same members, of whom the same ones ask, are verified once, in the first tree.
    once = met.groupBy("m", "x", "y").agg(F.min(F.struct("tree", "d", "bucket", "bytes")).alias("b")).select("b.tree", "b.d", "b.bucket", F.greatest(F.ceil(F.col("m") / block_rows), F.ceil(F.col("b.bytes") * 8 / block_bytes), F.lit(1)).cast("int").alias("blocks"))
    members = places.join(materialise(once, "buckets").hint("merge"), ["bucket", "tree", "d"]).groupBy("node").agg(F.collect_list(F.struct("bucket", "tree", "d", "blocks")).alias("buckets"))
    wanted = materialise(members.join(nodes.select("node", "rep", "copies"), "node").join(chosen.select("node", "depths"), "node"), "candidates")
    # Of all texts only those whose id falls on a candidate's slot (of SLOTS, so what is broadcast is bounded) are shuffled to meet the candidates.
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(SLOTS)).alias("slot")
    near = rows.withColumn("slot", slot("doc_id")).join(F.broadcast(wanted.select(slot("rep")).distinct()), "slot", "left_semi")
    texts = near.join(wanted.withColumnRenamed("rep", "doc_id").hint("merge"), "doc_id")
    schema = "bucket long, tree int, d int, lo int, hi int, side int, node binary, copies long, depths binary, signature binary, shingles binary"
    unfolded = texts.select("text", "node", "copies", "depths", "buckets").mapInArrow(tidy(unfold(width, n)), schema)
    tasks = max(cores(docs.sparkSession), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    key = ["bucket", "tree", "d", "lo", "hi"]
    checked = unfolded.repartition(tasks, *key).sortWithinPartitions(*key, "node")
    linked = materialise(checked.mapInArrow(tidy(verify(threshold, depth)), "node binary, root binary, links long"), "links", arrow_rows=256)
    found = connected(linked.select(F.col("node").alias("u"), F.col("root").alias("v")))
    info = nodes.join(found, "node", "left").join(linked.groupBy("node").agg(F.sum("links").alias("links")), "node", "left").select("node", F.coalesce("root", "node").alias("root"), "rep", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    info = materialise(info.where("n_links > 0"), "classes")
    classes = info.join(info.groupBy("root").agg(F.min("rep").alias("class_id")), "root").select("node", "class_id", "n_links")
    whole = signed.select("doc_id", "node", F.when(F.col("doc_id").isNotNull(), F.col("node")).alias("key"))
    out = whole.join(classes.withColumnRenamed("node", "key"), "key", "left")
    class_id = F.coalesce("class_id", "doc_id")
    return out.select("doc_id", class_id.alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.col("doc_id").eqNullSafe(class_id).alias("kept"))
