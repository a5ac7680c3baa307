"""Mixing sources to target weights by Pfair scheduling.

Each source is a task of weight w whose j-th block (from 0) is released at slot floor(j / w) and due by slot
ceil((j + 1) / w). One block is emitted in a slot: of the released blocks the one with the earliest deadline.
As the weights sum to one, every deadline is met, and after any number t of slots a source has emitted more
than t * w - 1 and fewer than t * w + 1 blocks.

Weights are whole numbers of quanta, so the schedule repeats after as many slots as there are quanta; the
driver makes one period only, and a block's slot follows from its number. When a source runs out, its
weight is dealt over the others in proportion and a new phase begins (``on_exhausted="renormalise"``, every
row is emitted), or the mixture ends there (``"stop"``).

The driver holds one row for each source. The schedule is made phase by phase, of a phase only what it emits and at
most one period, so for any number of sources its size is bounded by the blocks and by a period for each source. Up to
``MOST_ENTRIES`` numbers it is broadcast; a longer one is written in pieces of that size to the shared folder and joined
with the rows by source and range of blocks, which splits a source of any size.

Numbering: rows are numbered within their source in the order of a hash of id, source and text, so that rows
without an id are dealt as well. Counts by (source, leading bits of the hash) give every group its first number, so a
source of any size is dealt over many tasks. The order within a group is total but for rows that are equal, so a task
that is run again numbers them the same way.
"""

from __future__ import annotations

import bisect
import heapq
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecraft.llm.shared import scratch

MOST_ENTRIES = 4_000_000
RANGE = 512  # blocks of a source that meet a written schedule under one key
SCHEDULE = "source string, phase int, start long, period long, quanta int, places array<long>, from long, to long"


def turns(groups: Mapping[int, list[str]], period: int) -> Iterator[str]:
    """The source of each slot of one period: the earliest deadline among released blocks, of equal ones the first name.

    ``groups``: the sources in order, by their quanta. Sources of one group have equal windows, so they take turns.
    """
    taken = dict.fromkeys(groups, 0)
    release = [(0, q) for q in sorted(groups)]
    ready: list[tuple[int, str, int]] = []
    for slot in range(period):
        while release and release[0][0] <= slot:
            q = heapq.heappop(release)[1]
            j, nth = divmod(taken[q], len(groups[q]))
            heapq.heappush(ready, (-(-(j + 1) * period // q), groups[q][nth], q))
        _, s, q = heapq.heappop(ready)
        yield s
        taken[q] += 1
        j = taken[q] // len(groups[q])
        if j < q:
            heapq.heappush(release, (j * period // q, q))


def by_quanta(sources: Iterable[str], quanta: Mapping[str, int]) -> dict[int, list[str]]:
    groups: dict[int, list[str]] = {}
    for s in sorted(sources):
        groups.setdefault(quanta[s], []).append(s)
    return groups


def one_period(quanta: Mapping[str, int]) -> dict[str, list[int]]:
    """The slots of each source's blocks in one period."""
    out: dict[str, list[int]] = {s: [] for s in quanta}
    for slot, s in enumerate(turns(by_quanta(quanta, quanta), sum(quanta.values()))):
        out[s].append(slot)
    return out


@dataclass(frozen=True)
class Phase:
    """While the same sources are left: the first slot, and of each source that emits blocks in it their places in
    the first period, its blocks before the phase and those in it."""

    start: int
    slots: int
    period: int
    places: dict[str, list[int]]
    before: dict[str, int]
    blocks: dict[str, int]


def each_phase(blocks: Mapping[str, int], quanta: Mapping[str, int], on_exhausted: str = "renormalise") -> Iterator[Phase]:
    left = {s: n for s, n in blocks.items() if n > 0}
    done, groups, start = dict.fromkeys(left, 0), by_quanta(left, quanta), 0
    while left:
        period = sum(q * len(names) for q, names in groups.items())
        places: dict[str, list[int]] = {}
        length = 0
        for s in turns(groups, period):
            places.setdefault(s, []).append(length)
            length += 1
            if len(places[s]) == left[s]:  # it has run out
                took = {s: len(p) for s, p in places.items()}
                break
        else:
            last = {s: (n - 1) // quanta[s] * period + places[s][(n - 1) % quanta[s]] for s, n in left.items()}
            length = min(last.values()) + 1
            full, rest = divmod(length, period)
            took = {s: full * quanta[s] + bisect.bisect_left(places[s], rest) for s in left}
        yield Phase(start, length, period, places, {s: done[s] for s in places}, took)
        start += length
        if on_exhausted == "stop":
            return
        for s, n in took.items():
            done[s] += n
            left[s] -= n
            if not left[s]:
                del left[s]
                names = groups[quanta[s]]
                del names[bisect.bisect_left(names, s)]
                if not names:
                    del groups[quanta[s]]


def phases(blocks: Mapping[str, int], quanta: Mapping[str, int], on_exhausted: str = "renormalise") -> list[Phase]:
    return list(each_phase(blocks, quanta, on_exhausted))


def schedule_of(spark: SparkSession, plan: Iterable[Phase]) -> tuple[DataFrame, bool, int]:
    """The plan as rows of ``SCHEDULE``, whether they are few enough for a broadcast, and how many slots there are."""
    rows: list[tuple] = []
    entries, slots, path = 0, 0, None
    for k, p in enumerate(plan):
        rows += [(s, k, p.start, p.period, len(v), v, p.before[s], p.before[s] + p.blocks[s]) for s, v in p.places.items()]
        entries += sum(len(v) + 8 for v in p.places.values())
        slots = p.start + p.slots
        if entries > MOST_ENTRIES:
            path = path or scratch(spark, "mixing-schedule")
            spark.createDataFrame(rows, SCHEDULE).write.mode("append").parquet(path)
            rows, entries = [], 0
    if path is None:
        return spark.createDataFrame(rows, SCHEDULE), True, slots
    if rows:
        spark.createDataFrame(rows, SCHEDULE).write.mode("append").parquet(path)
    return spark.read.schema(SCHEDULE).parquet(path), False, slots


def quanta_of(weights: Mapping[str, float], quanta: int) -> dict[str, int]:
    """Each source's quanta, at least one; equal ones where no source that there is has a weight."""
    total = sum(weights.values())
    return {s: max(1, round((w / total if total > 0 else 1 / len(weights)) * quanta)) for s, w in weights.items()}


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind)
    return not isinstance(kind, (T.MapType, T.VariantType))


def mixed_rows(docs: DataFrame, *, weights: Mapping[str, float] | None = None, temperature: float = 0.5, quanta: int = 1000, block_rows: int = 16, seed: int = 0, on_exhausted: str = "renormalise") -> tuple[DataFrame, int]:
    """(row, source, number, block, slot, phase): every row of ``docs`` as a struct, with its place in the mixture; and how many slots there are.

    ``weights``: target share of each source, at least one quantum each; a source that is not named gets one
    quantum, a name without rows says nothing. Without weights a source's share is its number of rows to the power
    ``temperature``.

    A null source is the source named by the empty string. A null doc_id or text is a value like others; rows that
    are equal are interchangeable. Texts of any length are hashed, not compared. Empty tables have no slots; other columns
    are carried along, whatever their names.
    """
    if on_exhausted not in ("renormalise", "stop"):
        raise ValueError(f"on_exhausted is {on_exhausted}")
    spark = docs.sparkSession
    by = [F.col(f"`{c}`") for c in ("doc_id", "source", "text") if c in docs.columns]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), F.xxhash64(*by, F.lit(seed)).alias("h"))
    totals = {r[0]: r[1] for r in docs.groupBy(F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source")).count().collect()}
    shares = quanta_of({s: n**temperature for s, n in totals.items()} if weights is None else {s: weights.get(s, 0.0) for s in totals} if totals else {}, quanta)
    every = sum(totals.values())
    # Groups of some 8192 rows, of fewer where there are many tasks for few rows.
    least = min(8192, max(256, every // (4 * int(spark.conf.get("spark.sql.shuffle.partitions")))))
    bits = max(4, (every // least).bit_length())
    group = F.shiftright("h", 64 - bits)
    counts = rows.groupBy("source", group.alias("group")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("source").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("source", "group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("source", "group").orderBy("h", *[F.col("row").getField(f.name) for f in docs.schema if _orderable(f.dataType)])
    numbered = rows.withColumn("group", group).join(first, ["source", "group"]).withColumn("number", F.col("first") + F.row_number().over(within) - 1)
    schedule, small, slots = schedule_of(spark, each_phase({s: -(-n // block_rows) for s, n in totals.items()}, shares, on_exhausted))
    parts = F.sort_array(F.collect_list(F.struct("from", "to", "phase", "start", "period", "quanta", "places"))).alias("phases")
    block = numbered.withColumn("block", F.floor(F.col("number") / block_rows).cast("long"))
    if small:
        met = block.join(F.broadcast(schedule.groupBy("source").agg(parts)), "source")
    else:
        ranges = schedule.withColumn("range", F.explode(F.sequence(F.floor(F.col("from") / RANGE), F.floor((F.col("to") - 1) / RANGE))))
        met = block.withColumn("range", F.floor(F.col("block") / RANGE)).join(ranges.groupBy("source", "range").agg(parts), ["source", "range"])
    placed = met.withColumn("p", F.get(F.filter("phases", lambda p: (F.col("block") >= p["from"]) & (F.col("block") < p["to"])), F.lit(0))).where("p is not null")
    nth = F.col("block") - F.col("p.from")
    slot = F.col("p.start") + F.floor(nth / F.col("p.quanta")) * F.col("p.period") + F.get("p.places", F.pmod(nth, F.col("p.quanta")).cast("int"))
    return placed.select("row", "source", "number", "block", slot.cast("long").alias("slot"), F.col("p.phase").alias("phase")), slots


def mix_sources(docs: DataFrame, **options: object) -> DataFrame:
    """The place of every document in the mixture: doc_id, source, number, block, slot, phase.

    A null source is the source named by the empty string. A null doc_id stays null; rows repeated with doc_id and
    text stand side by side. Of texts, where there are any, only the hash takes part. An empty table gives no rows;
    other columns are ignored.
    """
    th = [F.xxhash64("text").alias("text")] if "text" in docs.columns else []
    return mixed_rows(docs.select("doc_id", "source", *th), **options)[0].select("row.doc_id", "source", "number", "block", "slot", "phase")


def in_mixed_order(docs: DataFrame, *, partitions: int | None = None, **options: object) -> DataFrame:
    """``docs``, all columns, in the order of the mixture: by partition, and by row within each. Edge cases as in :func:`mixed_rows`."""
    mixed, slots = mixed_rows(docs, **options)
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.least(F.floor(F.col("slot") * F.lit(n) / F.lit(max(1, slots))), F.lit(n - 1)).cast("int")
    return mixed.repartitionById(n, part).sortWithinPartitions("slot", "number").select("row.*")
