"""Benchmark decontamination by spaced-seed hashing.

A mask of ones and zeros slides over the words of a text; the hash of the words under its ones is a seed.
Words under zeros are ignored, so a substituted word leaves some seeds of every passage intact. Seeds of
the documents are joined with those of the benchmark; a hit names a diagonal (document position minus item
position), along which the overlap is verified word by word: the segment of the highest score, a match
counting one and a substitution minus four, must reach ``min_words`` matching words. The edges that such a
segment loses to a substitution weigh in short items (of up to four words more than ``min_words``): one overlaps
also where four fifths of its words match on the diagonal. A short item is cut into one part more than words
may differ, and the parts are seeds too, so none of these places is missed. Items of fewer than ``least_item`` words, such as
an answer of one word, are no passages: clean texts hold them by chance. They overlap nothing; ``short_items`` reports them.

The documents are scanned once, however large the benchmark is. What is broadcast is a Bloom filter of the
benchmark's seeds of ``MOST_BITS`` bits at most: a fuller one lets more seeds pass, it loses none. Passing seeds
leave the scan with the words around them (a window reaches as far as the longest item) and meet the
benchmark's seeds in a join on the seed. A seed stands once in each window and each item, with all its places,
so repeated words cost rows in proportion to the text. Diagonals are scored some at a time, and where a pair
has more hits than diagonals, all its diagonals are scored instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import materialise, slices, text_buffers, text_of, tidy
from .wordhash import mix, word_hashes

MASKS = ("110100101011", "101100011011", "111001000111", "100111010011")
#: What a substitution costs a segment, and the share (in fifths) of a short item that has to match.
COST, FIFTHS = 4, 4
LEAST_ITEM = 8
MOST_BITS, BITS_A_SEED, MOST_PROBES = 1 << 28, 32, 6
SLOTS = 1 << 20
CELLS = 1 << 18  # of words against words at a time when diagonals are scored
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def needed(n: int) -> int:
    """How many words of a short item of ``n`` words have to match."""
    return -(-n * FIFTHS // 5)


def parts(n: int) -> list[tuple[int, int]]:
    """Start and end of the parts into which a short item of ``n`` words is cut."""
    cuts = np.linspace(0, n, n - needed(n) + 2).astype(int)
    return [(int(a), int(b)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def patterns(short: list[int]) -> list[str]:
    """The masks, and one of ones for each length of a part of the short items, whose numbers of words are given."""
    return [*MASKS, *("1" * k for k in sorted({b - a for n in short for a, b in parts(n)}))]


def seeds(words: np.ndarray, pattern: str) -> np.ndarray:
    """The seed at each position at which the pattern fits."""
    n = len(words) - len(pattern) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, int(pattern, 2) + (len(pattern) << 20), np.uint64)
    for k, c in enumerate(pattern):
        if c == "1":
            h = h * _FACTOR + words[k : k + n]
    return mix(h)


def seeds_of_item(words: np.ndarray, min_words: int) -> list[tuple[int, list[int]]]:
    """(seed, its places in the item), of all masks and, in a short item, of its parts."""
    n = len(words)
    found = [(seeds(words, m), np.arange(max(0, n - len(m) + 1))) for m in MASKS]
    if 0 < n <= min_words + COST:
        found += [(seeds(words[a:b], "1" * (b - a)), np.array([a])) for a, b in parts(n)]
    return grouped(np.concatenate([s for s, _ in found]), np.concatenate([p for _, p in found]))


def grouped(seed: np.ndarray, place: np.ndarray) -> list[tuple[int, list[int]]]:
    order = np.lexsort((place, seed))
    seed, place = seed[order].view(np.int64), place[order]
    cuts = np.flatnonzero(np.concatenate(([True], seed[1:] != seed[:-1], [True]))) if len(seed) else [0]
    return [(int(seed[a]), place[a:b].tolist()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def probes(seed: np.ndarray, k: int, bits: int) -> np.ndarray:
    """The k-th bit of each seed in a filter of ``bits`` bits, a power of two."""
    return ((seed + np.uint64(k) * ((seed >> np.uint64(32)) | np.uint64(1))) & np.uint64(bits - 1)).astype(np.int64)


def _numbered() -> Iterator[int]:
    """Numbers that no other task gives; they are used only once they are written."""
    from pyspark import TaskContext

    n = TaskContext.get().partitionId() << 33
    while True:
        yield n
        n += 1


_SEEDS = pa.list_(pa.struct([("seed", pa.int64()), ("places", pa.list_(pa.int32()))]))


def read_items(min_words: int, kind: pa.DataType):
    """Partition function: (item_id, text) in; (item, item_id, n, words, seeds) out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = _numbered()
        for batch in batches:
            for lo, hi in slices(batch.column(1), 1 << 20):
                words, first = word_hashes(*text_buffers(batch.column(1).slice(lo, hi - lo)))
                own = [words[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
                found = [[{"seed": s, "places": p} for s, p in seeds_of_item(w, min_words)] for w in own]
                yield pa.RecordBatch.from_arrays([pa.array([next(number) for _ in own], pa.int64()), batch.column(0).slice(lo, hi - lo).cast(kind), pa.array(np.diff(first), pa.int64()), pa.array([w.tobytes() for w in own], pa.binary()), pa.array(found, _SEEDS)], ["item", "item_id", "n", "words", "seeds"])

    return run


def fill_filter(bits: int, k: int):
    """Partition function: (seed) in; the words of 64 bits that are not zero out, by place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_ = np.zeros(bits >> 6, np.uint64)
        for batch in batches:
            seed = batch.column(0).to_numpy().view(np.uint64)
            for j in range(k):
                at = probes(seed, j, bits)
                np.bitwise_or.at(filter_, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
        some = np.flatnonzero(filter_)
        for lo in range(0, len(some), 1 << 16):
            part = some[lo : lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(filter_[part].view(np.int64))], ["place", "bits"])

    return run


def seed_filter(seed: DataFrame) -> tuple[np.ndarray, int, int]:
    """A Bloom filter of ``seed.seed``: its words, bits and probes. Of ``MOST_BITS`` bits at most, so 32 MB."""
    n = seed.count()
    bits = min(MOST_BITS, 1 << max(16, (n * BITS_A_SEED - 1).bit_length()))
    k = max(1, min(MOST_PROBES, round(0.69 * bits / max(1, n))))
    filled = seed.mapInArrow(tidy(fill_filter(bits, k)), "place long, bits long").groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(bits >> 6, np.uint64)
    out[filled.column("place").to_numpy()] = filled.column("bits").to_numpy().view(np.uint64)
    return out, bits, k


def find_windows(shared, how: list[str], reach: int, bits: int, k: int, kind: pa.DataType):
    """Partition function: (doc_id, th, text) in; (window, doc_id, th, start, words, seeds) of the stretches with passing seeds out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, filter_ = _numbered(), shared.value
        for batch in batches:
            for lo, hi in slices(batch.column(2), 2 << 20):
                words, first = word_hashes(*text_buffers(batch.column(2).slice(lo, hi - lo)))
                doc = np.repeat(np.arange(hi - lo), np.diff(first))
                hit, at, end = [], [], []
                for pattern in how:
                    seed = seeds(words, pattern)
                    place = np.flatnonzero(doc[: len(seed)] == doc[len(pattern) - 1 :]) if len(seed) else np.zeros(0, np.int64)
                    seed = seed[place]
                    for j in range(k):
                        b = probes(seed, j, bits)
                        keep = (filter_[b >> 6] >> (b & 63).astype(np.uint64)) & np.uint64(1) == 1
                        seed, place = seed[keep], place[keep]
                    hit.append(seed)
                    at.append(place)
                    end.append(place + len(pattern))
                hit, at, end = np.concatenate(hit), np.concatenate(at), np.concatenate(end)
                if not len(hit):
                    continue
                order = np.argsort(at, kind="stable")
                hit, at, end = hit[order], at[order], end[order]
                left, right = np.maximum(at - reach, first[doc[at]]), np.minimum(end + reach, first[doc[at] + 1])
                right = np.maximum.accumulate(right)
                cuts = np.flatnonzero(np.concatenate(([True], (left[1:] >= right[:-1]) | (doc[at[1:]] != doc[at[:-1]]), [True])))
                rows = []
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    start, d = int(left[a:b].min()), doc[at[a]]
                    rows.append((next(number), lo + int(d), start - int(first[d]), words[start : right[b - 1]].tobytes(), [{"seed": s, "places": p} for s, p in grouped(hit[a:b], at[a:b] - start)]))
                take = pa.array([r[1] for r in rows])
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), batch.column(0).take(take).cast(kind), batch.column(1).take(take), pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.binary()), pa.array([r[4] for r in rows], _SEEDS)], ["window", "doc_id", "th", "start", "words", "seeds"])

    return run


def best_overlap(words: np.ndarray, item: np.ndarray, diagonals: np.ndarray, min_words: int) -> tuple[int, int, int] | None:
    """(first word, words, matching words) of the best overlap on the diagonals; the first of those with most matches.

    A diagonal's segment is the one with the highest sum of 1 for a match and -4 else. ``CELLS`` bounds what is
    compared at a time.
    """
    m, best = len(item), None
    step = max(1, CELLS // (m + 1))
    for lo in range(0, len(diagonals), step):
        d = diagonals[lo : lo + step, None]
        at = d + np.arange(m)
        inside = (at >= 0) & (at < len(words))
        equal = inside & (words[at.clip(0, len(words) - 1)] == item)
        total, count = np.zeros((len(d), m + 1), np.int64), np.zeros((len(d), m + 1), np.int64)
        np.cumsum(np.where(equal, 1, -COST), axis=1, out=total[:, 1:])
        np.cumsum(equal, axis=1, out=count[:, 1:])
        low = np.minimum.accumulate(total, axis=1)
        end = (total - low).argmax(axis=1)
        start = np.maximum.accumulate(np.where(total == low, np.arange(m + 1), 0), axis=1)[np.arange(len(d)), end]
        matched = count[np.arange(len(d)), end] - count[np.arange(len(d)), start]
        if m <= min_words + COST:
            short = (count[:, -1] >= needed(m)) & (matched < min_words)
            start = np.where(short, equal.argmax(axis=1), start)
            end = np.where(short, m - equal[:, ::-1].argmax(axis=1), end)
            matched = np.where(short, count[:, -1], matched)
            good = count[:, -1] >= needed(m)
        else:
            good = np.zeros(len(d), bool)
        good |= matched >= min_words
        for j in np.flatnonzero(good):
            new = (-int(matched[j]), int(d[j, 0] + start[j]), int(end[j] - start[j]))
            best = new if best is None or new < best else best
    return best and (best[1], best[2], -best[0])


def candidates(pairs: list[tuple[np.ndarray, np.ndarray]], n: int, m: int) -> np.ndarray:
    """The distinct diagonals of all hits; every diagonal where there are more hits than diagonals."""
    if sum(len(a) * len(b) for a, b in pairs) > n + m:
        return np.arange(-m + 1, n)
    return np.unique(np.concatenate([np.subtract.outer(a, b).ravel() for a, b in pairs]))


def verify(min_words: int, types: list[pa.DataType]):
    """Partition function: (doc_id, th, start, words, item, item_id, item_words, hits) in; verified overlaps out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, th, start, words, item, item_id, item_words, hits in zip(*batch.columns, strict=True):
                w, i = np.frombuffer(words.as_py(), np.uint64), np.frombuffer(item_words.as_py(), np.uint64)
                pairs = [(np.array(h["d"]), np.array(h["i"])) for h in hits.as_py()]
                if got := best_overlap(w, i, candidates(pairs, len(w), len(i)), min_words):
                    out.append((doc_id.as_py(), th.as_py(), item.as_py(), item_id.as_py(), start.as_py() + got[0], got[1], got[2], got[2] / len(i)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], _FOUND)

    return run


_FOUND = ["doc_id", "th", "item", "item_id", "start_word", "n_words", "matched", "coverage"]


def short_items(benchmark: DataFrame, *, least_item: int = LEAST_ITEM) -> DataFrame:
    """(item_id, n_words) of the items that are too short to contaminate; null and empty ones have no words."""
    words = F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
    return text_of(benchmark, "item_id", "text").select("item_id", words.alias("n_words")).where(F.col("n_words") < least_item)


def _overlaps(docs: DataFrame, benchmark: DataFrame, min_words: int, least_item: int) -> DataFrame:
    """(doc_id, th, item, item_id, start_word, n_words, matched, coverage), written; ``th`` is the hash of the text, ``item`` a number."""
    from pyspark.sql.pandas.types import to_arrow_type

    rows = text_of(docs, "doc_id", "text").select("doc_id", F.xxhash64("text").alias("th"), "text")
    of_doc, of_item = rows.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType
    schema = T.StructType([T.StructField(n, t) for n, t in zip(_FOUND, [of_doc, T.LongType(), T.LongType(), of_item, *[T.LongType()] * 3, T.DoubleType()], strict=True)])
    many = "seeds array<struct<seed bigint, places array<int>>>"
    item_kind = to_arrow_type(of_item)
    items = text_of(benchmark, "item_id", "text").distinct().mapInArrow(tidy(read_items(min_words, item_kind)), f"item bigint, item_id {of_item.simpleString()}, n bigint, words binary, {many}")
    items = materialise(items.where(F.col("n") >= max(1, least_item)), "benchmark-items")
    known = items.select("item", F.inline("seeds").alias("seed", "i"))
    told = items.agg(F.max("n"), F.collect_set(F.when(F.col("n") <= min_words + COST, F.col("n")))).first()  # lengths of short items, a few
    if not told[0]:
        return docs.sparkSession.createDataFrame([], schema)
    filter_, bits, k = seed_filter(known.select("seed"))
    shared = docs.sparkSession.sparkContext.broadcast(filter_)
    scan = tidy(find_windows(shared, patterns(told[1]), told[0], bits, k, to_arrow_type(of_doc)))
    windows = materialise(rows.mapInArrow(scan, f"window bigint, doc_id {of_doc.simpleString()}, th bigint, start bigint, words binary, {many}"), "benchmark-windows", arrow_rows=500)
    hits = windows.select("window", F.inline("seeds").alias("seed", "d")).join(known, "seed")
    pairs = hits.groupBy("window", "item").agg(F.collect_list(F.struct("d", "i")).alias("hits"))  # of one window and one item
    met = pairs.join(windows.drop("seeds"), "window").join(items.select("item", "item_id", F.col("words").alias("item_words")), "item")
    found = met.select("doc_id", "th", "start", "words", "item", "item_id", "item_words", "hits").mapInArrow(tidy(verify(min_words, [to_arrow_type(f.dataType) for f in schema])), schema)
    try:
        return materialise(found, "benchmark-overlaps", arrow_rows=500)
    finally:
        shared.unpersist()


def benchmark_overlaps(docs: DataFrame, benchmark: DataFrame, *, min_words: int = 13, least_item: int = LEAST_ITEM) -> DataFrame:
    """Every (document, benchmark item) with a verified overlap.

    Returns doc_id, item_id, start_word (first word of the overlap in the document, from 0), n_words (its
    length), matched (equal words in it), coverage (matched over the item's words), contaminated (true).
    An item has at most one row for each document: its longest overlap, the first of equally long ones.

    Null and empty texts on either side overlap nothing. A null doc_id or item_id stays null in the result.
    Rows repeated in ``docs`` or ``benchmark`` (same id and text) give one row. Texts are scanned whole.
    Empty tables give no rows; other columns are ignored. An item of up to ``min_words`` + 4 words
    overlaps also where at least four fifths of its words match in place. One of fewer than ``least_item`` words overlaps
    nothing (see :func:`short_items`); where that is set below five, items of fewer than five words overlap verbatim only.
    """
    best = F.min(F.struct((-F.col("matched")).alias("m"), "start_word", "n_words", "matched", "coverage")).alias("b")
    each = _overlaps(docs, benchmark, min_words, least_item).groupBy("doc_id", "th", "item", "item_id").agg(best)
    return each.select("doc_id", "item_id", "b.start_word", "b.n_words", "b.matched", "b.coverage").distinct().withColumn("contaminated", F.lit(True))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, min_words: int = 13, least_item: int = LEAST_ITEM) -> DataFrame:
    """``docs``, all columns, without the rows that overlap a benchmark item.

    Rules as in :func:`benchmark_overlaps`; rows whose text is null or empty stay. A row goes if its doc_id and
    text are those of an overlap. Rows whose hash falls on none of ``SLOTS`` marked slots (at most so many are
    broadcast) stay without a shuffle; only the others meet the overlaps in a join.
    """
    names = [f"c{k}" for k in range(len(docs.columns))]
    doc_id, text = (F.col(names[docs.columns.index(c)]) for c in ("doc_id", "text"))
    found = _overlaps(docs, benchmark, min_words, least_item).select("doc_id", "th").distinct()
    slot = lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(SLOTS))
    marked = F.broadcast(found.select(slot("doc_id", "th").alias("slot")).distinct())
    th = F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))
    plain = docs.toDF(*names).withColumn("slot", slot(doc_id, th))
    clean = plain.join(marked, "slot", "left_anti")
    met = plain.join(marked, "slot", "left_semi").alias("p").join(found, doc_id.eqNullSafe(found["doc_id"]) & (th == found["th"]), "left_anti")
    return clean.select(*names).unionByName(met.select(*names)).toDF(*docs.columns)
