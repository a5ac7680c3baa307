"""Operator 12: how far the sources of a language diverge, by two-dimensional group-block tiling.

Counts of terms by (lang, source) are packed into one vector for each group and vocabulary chunk. Groups of a
language are dealt into blocks; a vector is sent to every pair of blocks that its own block is in, and a task of one
pair of blocks reads chunk after chunk and adds up its submatrix of divergences. All arithmetic is on integers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import materialise, slices, text_buffers, tidy

SCALE = 1_000_000_000
# A-Z as a-z, letters and all bytes of characters beyond ASCII as they are, everything else a blank.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
FLUSH = 200_000


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text: runs of ASCII letters and characters beyond ASCII, only A-Z lower-cased."""
    return text.translate(LETTERS).split()


def count_terms(flush: int = FLUSH):
    """Partition function: (text, lang, source) in; (lang, source, term, n, docs) out, added up over up to ``flush`` different keys."""
    names = ["lang", "source", "term", "n", "docs"]
    types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]

    def out(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            if n:
                terms = list(n)
                columns = [[lang] * len(terms), [source] * len(terms), [t.decode() for t in terms], [n[t] for t in terms], [docs[t] for t in terms]]
                for lo in range(0, len(terms), 50_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c[lo : lo + 50_000], t) for c, t in zip(columns, types, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            for i, j in slices(batch.column(0), 1 << 20):
                part = batch.slice(i, j - i)
                flat, at = text_buffers(part.column(0))
                data, at = flat.tobytes(), at.tolist()
                for k, key in enumerate(zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True)):
                    n, docs = held.setdefault(key, (Counter(), Counter()))
                    before = len(n)
                    found = terms_of(data[at[k] : at[k + 1]])
                    n.update(found)
                    docs.update(set(found))
                    size += len(n) - before
                if size > flush:
                    yield from out(held)
                    held, size = {}, 0
        yield from out(held)

    return run


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * terms)), without a product beyond 64 bits up to counts of 10**14."""
    high, low = 31_250, SCALE // 31_250
    part = (n + 2) * F.lit(high).cast("long")
    whole = total + 2 * terms
    return F.call_function("div", part, whole) * low + F.call_function("div", (part % whole) * low, whole) + 1


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs), written; null text, lang and source count as ''."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")]
    counted = docs.select(*named).mapInArrow(tidy(count_terms()), "lang string, source string, term string, n long, docs long")
    summed = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return materialise(summed, "term-counts", arrow_rows=2000)


def numbered_vocabulary(counts: DataFrame, least: int, chunk: int) -> DataFrame:
    """(lang, term, total, chunk, nth): the terms that a language keeps, numbered within chunks of about ``chunk`` terms.

    Chunks are by a hash of the term, so no window holds more than one chunk.
    """
    kept = materialise(counts.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs")).where(F.col("docs") >= least).drop("docs"), "vocabulary")
    sizes = kept.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / chunk).alias("chunks"))
    dealt = kept.join(sizes, "lang").withColumn("chunk", F.pmod(F.xxhash64("term"), F.col("chunks")).cast("int")).drop("chunks")
    nth = F.row_number().over(Window.partitionBy("lang", "chunk").orderBy("term")) - 1
    dealt = dealt.repartition("lang", "chunk")  # else the window may take over the partitions by language of the join
    return materialise(dealt.withColumn("nth", nth), "vocabulary")


def shares(n: np.ndarray, total: int, terms: int) -> np.ndarray:
    """As :func:`share`, over an array."""
    whole, high = total + 2 * terms, 31_250
    q, r = np.divmod((n + 2) * high, whole)
    return q * (SCALE // high) + r * (SCALE // high) // whole + 1


def submatrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partition function: (lang, source, item, value) of the pairs of a block pair's groups.

    Its rows are packed vectors (places and counts of the terms that a group has) sorted by (lang, a, b, stripe, chunk).
    One chunk's vectors are held at a time, and the submatrix of the block pair.
    """
    names, types = ["lang", "source", "item", "value"], [pa.string(), pa.string(), pa.string(), pa.int64()]
    tile, chunk, rows = None, None, []
    sums: dict[tuple[str, str], int] = {}

    def add() -> None:
        """The divergences of the rows of one chunk."""
        lang, a, b, _ = tile
        width, terms = rows[0][0], rows[0][1]
        sides: dict[int, list[tuple[str, np.ndarray]]] = {a: [], b: []}
        for _, _, place, source, total, at, n in rows:
            dense = np.zeros(width, np.int64)
            dense[at] = n
            sides[place].append((source, shares(dense, total, terms)))
        for i, (x, p) in enumerate(sides[a]):
            others = sides[b] if a != b else sides[a][i + 1 :]
            for lo in range(0, len(others), 16):
                q = np.stack([q for _, q in others[lo : lo + 16]])
                apart = p - q
                for (y, _), value in zip(others[lo : lo + 16], (apart * apart // (p + q)).sum(axis=1).tolist(), strict=True):
                    sums[x, y] = sums.get((x, y), 0) + value

    def out() -> Iterator[pa.RecordBatch]:
        if sums:
            columns = list(zip(*[(tile[0], x, y, v) for (x, y), v in sums.items()], strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)
        sums.clear()

    for batch in batches:
        ends = batch.column(10).offsets.to_numpy()  # those of both lists
        nth, counts = (batch.column(k).values.to_numpy() for k in (10, 11))
        for k, (lang, a, b, stripe, c, width, terms, place, source, total) in enumerate(zip(*(x.to_pylist() for x in batch.columns[:10]), strict=True)):
            new = (lang, a, b, stripe)
            if rows and (new, c) != (tile, chunk):
                add()
                rows = []
            if tile is not None and new != tile:
                yield from out()
            tile, chunk = new, c
            at = slice(ends[k], ends[k + 1])
            rows.append((width, terms, place, source, total, nth[at], counts[at]))
    if rows:
        add()
    if tile is not None:
        yield from out()


def source_divergence(docs: DataFrame, *, least_docs: int = 10, top: int = 10, chunk: int = 2048, group_block: int = 16, stripe: int = 8) -> DataFrame:
    """Divergence of every source of a language from every other, and the terms that set a source apart.

    Returns lang, source, part, item, value, rank. ``pair``: item is each other source of the language, value the sum
    over the language's kept terms of floor((p-q)**2/(p+q)), 0 where it keeps none. ``term``: the first ``top`` terms that
    the source has and whose p is above the language's q. Ranks by value descending, item ascending.

    A language keeps terms of ``least_docs`` of its documents or more. ``chunk``: terms of a vocabulary chunk; ``group_block``:
    groups of a block; ``stripe``: chunks that one task of a block pair reads in turn, its partial sums meet by pair.

    Null text, lang and source count as ''; empty texts make their group occur. Repeated rows count as often as they
    stand. A group alone in its language has no pair rows. An empty table gives no rows; other columns are ignored.
    """
    counts = term_counts(docs)
    terms = numbered_vocabulary(counts, least_docs, chunk)
    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    occurring = docs.select(*named).distinct()
    by_lang = terms.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.count(F.lit(1)).alias("terms"))
    blocks = occurring.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / group_block).cast("int").alias("blocks"))
    kept = materialise(counts.drop("docs").join(terms, ["lang", "term"]), "kept-counts")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = occurring.join(totals, ["lang", "source"], "left").join(by_lang, "lang", "left").join(blocks, "lang")
    zero = F.lit(0).cast("long")
    groups = groups.select("lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("lang_total", zero).alias("lang_total"), F.coalesce("terms", zero).alias("terms"), "blocks", F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int").alias("place"))
    groups = materialise(groups, "groups")

    # Every group has a vector for each chunk of its language, an empty one where it lacks the chunk's terms.
    widths = terms.groupBy("lang", "chunk").agg(F.count(F.lit(1)).cast("int").alias("width"))
    packed = kept.groupBy("lang", "source", "chunk").agg(F.collect_list(F.struct("nth", "n")).alias("v"))  # a chunk's terms at most
    vectors = groups.join(widths, "lang").join(packed, ["lang", "source", "chunk"], "left")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    tiles = vectors.withColumn("other", other).select("lang", F.least("place", "other").alias("a"), F.greatest("place", "other").alias("b"), F.floor(F.col("chunk") / stripe).cast("int").alias("stripe"), "chunk", "width", "terms", "place", "source", "total", F.coalesce(F.col("v.nth"), F.array().cast("array<int>")).alias("at"), F.coalesce(F.col("v.n"), F.array().cast("array<long>")).alias("n"))
    key = ["lang", "a", "b", "stripe"]
    spark = docs.sparkSession
    dealt = tiles.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *key).sortWithinPartitions(*key, "chunk")
    sums = materialise(dealt.mapInArrow(tidy(submatrices), "lang string, source string, item string, value long"), "submatrices", arrow_rows=128)
    both = sums.unionByName(sums.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    bare = groups.where("terms = 0").select("lang", "source", "place", "blocks")  # languages that keep no term: all pairs at 0
    none = bare.join(bare.select("lang", F.col("source").alias("item")), "lang").where("source <> item").select("lang", "source", "item", zero.alias("value"))
    pairs = both.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).unionByName(none)

    p = share(F.col("n"), F.col("total"), F.col("terms"))
    q = share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    held = kept.withColumnRenamed("total", "lang_n").join(groups, ["lang", "source"]).withColumns({"p": p, "q": q}).where("p > q")
    apart = held.select("lang", "source", F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))

    def ranked(df: DataFrame, part: str) -> DataFrame:
        w = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(w).alias("rank"))

    return ranked(pairs, "pair").unionByName(ranked(apart, "term").where(F.col("rank") <= top))
