"""Exact dedup: counting quotient filters built per partition merge losslessly by sorted remainders.

Every task folds the 64-bit fingerprints of its texts into counting quotient filters: a fingerprint's
high bits (the quotient) name a slot run, the low bits (the remainder) stand sorted in the run with a
counter. The filters are cut by the first bits of the quotient into segments, so that the merge of a
segment needs only that segment of every task's filter: runs of the same quotient are merged in the
order of their remainders and equal remainders add their counters. As quotient and remainder together
are the whole fingerprint, nothing is lost and counts are exact. Only rows whose fingerprint counts
more than once go on to byte verification, which groups by the text's own bytes.

Skew: a task sends one counter per distinct fingerprint, whatever the size of a group of copies; the
verification combines equal texts before it shuffles; the last join carries ids only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialise, text_of


BLOCK = 64  # slots between two stored offsets


@dataclass
class CountingQuotientFilter:
    """``runs[i]`` fingerprints have the quotient ``first + i``; remainders are sorted within a run.

    The first ``quotient_bits`` of a fingerprint's 64 bits address its run. By default there are as many quotients as
    entries, up to a power of two, so a run has one entry on average. ``segment`` of 2**``segment_bits`` equal parts of the
    address space is held here. In bytes: for each quotient a bit whether its run is there, for each entry a bit whether
    its run ends there, the number of entries before every ``BLOCK`` quotients, the remainders with no more bits than they
    have, the counters. A lookup reads one block of these and one run.
    """

    quotient_bits: int
    segment_bits: int
    segment: int
    runs: np.ndarray
    remainders: np.ndarray
    counts: np.ndarray

    @classmethod
    def of_sorted(cls, fingerprints: np.ndarray, counts: np.ndarray, segment: int, segment_bits: int, quotient_bits: int | None = None) -> CountingQuotientFilter:
        """From ascending distinct fingerprints of one segment."""
        if quotient_bits is None:
            quotient_bits = min(63, segment_bits + max(1, (len(fingerprints) - 1).bit_length()))
        shift = np.uint64(64 - quotient_bits)
        quotients = (fingerprints >> shift).astype(np.int64) - (segment << (quotient_bits - segment_bits))
        runs = np.bincount(quotients, minlength=1 << (quotient_bits - segment_bits)).astype(np.uint32)
        return cls(quotient_bits, segment_bits, segment, runs, fingerprints & ((np.uint64(1) << shift) - np.uint64(1)), counts.astype(np.int64))

    def fingerprints(self) -> np.ndarray:
        first = self.segment << (self.quotient_bits - self.segment_bits)
        quotients = np.repeat(np.arange(first, first + len(self.runs), dtype=np.uint64), self.runs)
        return (quotients << np.uint64(64 - self.quotient_bits)) | self.remainders

    def count_of(self, fingerprint: int) -> int:
        """How often a fingerprint of the segment was counted; looks at one block of quotients and one run."""
        quotient = (fingerprint >> (64 - self.quotient_bits)) - (self.segment << (self.quotient_bits - self.segment_bits))
        block = quotient // BLOCK * BLOCK
        start = int(self.offsets()[quotient // BLOCK]) + int(self.runs[block:quotient].sum())
        run = self.remainders[start : start + int(self.runs[quotient])]
        at = int(np.searchsorted(run, np.uint64(fingerprint & ((1 << (64 - self.quotient_bits)) - 1))))
        found = at < len(run) and int(run[at]) == fingerprint & ((1 << (64 - self.quotient_bits)) - 1)
        return int(self.counts[start + at]) if found else 0

    def offsets(self) -> np.ndarray:
        """The number of entries before each block of quotients."""
        before = np.concatenate(([0], np.cumsum(self.runs, dtype=np.int64)))
        return before[: len(self.runs) : BLOCK].astype(np.uint32)

    def merged(self, other: CountingQuotientFilter) -> CountingQuotientFilter:
        """Merge by sorted remainders: two ascending sequences become one, equal entries add their counters."""
        a, b = self.fingerprints(), other.fingerprints()
        both = np.empty(len(a) + len(b), np.uint64)
        counts = np.empty(len(both), np.int64)
        at = np.searchsorted(a, b) + np.arange(len(b))
        from_a = np.ones(len(both), bool)
        from_a[at] = False
        both[at], both[from_a] = b, a
        counts[at], counts[from_a] = other.counts, self.counts
        if not len(both):
            return self
        new = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1])))
        return self.of_sorted(both[new], np.add.reduceat(counts, new), self.segment, self.segment_bits)

    def to_bytes(self) -> bytes:
        small = self.counts.clip(max=255).astype(np.uint8)
        large = self.counts[self.counts >= 255]
        ends = np.zeros(len(self.remainders), bool)
        ends[np.cumsum(self.runs[self.runs > 0].astype(np.int64)) - 1] = True
        bits = np.unpackbits(self.remainders.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)[:, self.quotient_bits :]
        head = len(self.remainders).to_bytes(8, "little") + self.quotient_bits.to_bytes(1, "little")
        return b"".join([head, np.packbits(self.runs > 0).tobytes(), np.packbits(ends).tobytes(), self.offsets().tobytes(), np.packbits(bits).tobytes(), small.tobytes(), large.astype("<i8").tobytes()])

    @classmethod
    def from_bytes(cls, raw: bytes, segment: int, segment_bits: int) -> CountingQuotientFilter:
        n, quotient_bits, at = int.from_bytes(raw[:8], "little"), raw[8], 9
        slots = 1 << (quotient_bits - segment_bits)

        def bits(count: int) -> np.ndarray:
            nonlocal at
            size = -(-count // 8)
            out = np.unpackbits(np.frombuffer(raw, np.uint8, size, at), count=count)
            at += size
            return out

        there, ends = bits(slots).astype(bool), bits(n).astype(bool)
        at += 4 * -(-slots // BLOCK)  # the offsets follow from the bits before them
        runs = np.zeros(slots, np.uint32)
        runs[there] = np.diff(np.flatnonzero(ends), prepend=-1)
        wide = np.zeros((n, 64), np.uint8)
        wide[:, quotient_bits:] = bits(n * (64 - quotient_bits)).reshape(n, -1)
        remainders = np.packbits(wide, axis=1).view(">u8").ravel().astype(np.uint64)
        counts = np.frombuffer(raw, np.uint8, n, at).astype(np.int64)
        at += n
        counts[counts == 255] = np.frombuffer(raw, "<i8", int((counts == 255).sum()), at)
        return cls(quotient_bits, segment_bits, segment, runs, remainders, counts)


def build_filters(segment_bits: int, flush: int):
    """Partition function: fingerprints in, (segment, filter) rows out; at most ``flush`` distinct ones are held."""

    def emit(values: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        segments = (values >> np.uint64(64 - segment_bits)).astype(np.int64) if segment_bits else np.zeros(len(values), np.int64)
        cuts = np.flatnonzero(np.concatenate(([True], segments[1:] != segments[:-1], [True]))) if len(values) else []
        rows = []
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            s = int(segments[lo])
            rows.append((s, CountingQuotientFilter.of_sorted(values[lo:hi], counts[lo:hi], s, segment_bits).to_bytes()))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["segment", "filter"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            got, n = np.unique(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64), return_counts=True)
            every, where = np.unique(np.concatenate((values, got)), return_inverse=True)
            counts = np.bincount(where, np.concatenate((counts, n)), len(every)).astype(np.int64)
            values = every
            if len(values) >= flush:
                yield from emit(values, counts)
                values, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        yield from emit(values, counts)

    return run


def merge_filters(segment_bits: int):
    """Partition function over rows sorted by segment: merges each segment's filters, returns repeated fingerprints."""

    def repeated(filter_: CountingQuotientFilter | None) -> Iterator[pa.RecordBatch]:
        if filter_ is not None and (keep := filter_.counts > 1).any():
            yield pa.RecordBatch.from_arrays([pa.array(filter_.fingerprints()[keep].view(np.int64)), pa.array(filter_.counts[keep])], ["fingerprint", "copies"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[CountingQuotientFilter] = []  # of like sizes merge first, so that each entry is moved a logarithmic number of times
        at = None

        def drained() -> CountingQuotientFilter | None:
            while len(held) > 1:
                b, a = held.pop(), held.pop()
                held.append(a.merged(b))
            return held.pop() if held else None

        for batch in batches:
            for segment, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if segment != at:
                    yield from repeated(drained())
                    at = segment
                new = CountingQuotientFilter.from_bytes(raw.as_py(), segment, segment_bits)
                while held and len(held[-1].remainders) <= len(new.remainders):
                    new = held.pop().merged(new)
                held.append(new)
        yield from repeated(drained())

    return run


SEGMENT_ROWS = 1 << 18
SLOTS = 1 << 20


def repeated_fingerprints(rows: DataFrame, *, segment_bits: int | None = None, flush: int = 1 << 20) -> DataFrame:
    """(fingerprint, copies) of the fingerprints that more than one row of ``rows.fingerprint`` has.

    ``segment_bits``: the merge has 2**segment_bits independent parts, by default so many that each has
    ``SEGMENT_ROWS`` of the rows at most, up to hash variance.
    """
    if segment_bits is None:
        segment_bits = max(8, (rows.count() // SEGMENT_ROWS).bit_length())
    filters = rows.select("fingerprint").mapInArrow(build_filters(segment_bits, flush), "segment int, filter binary")
    return filters.repartition("segment").sortWithinPartitions("segment").mapInArrow(merge_filters(segment_bits), "fingerprint long, copies long")


def on_repeated_slots(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """The rows whose fingerprint falls on the slot of a repeated one, without an exchange of the others.

    There are ``SLOTS`` slots, so what is broadcast is bounded; the fewer fingerprints are repeated, the fewer rows pass.
    """
    slot = F.pmod(F.xxhash64("fingerprint"), F.lit(SLOTS)).alias("slot")
    return rows.withColumn("slot", slot).join(F.broadcast(repeated.select(slot).distinct()), "slot", "left_semi")


def exact_dedup(docs: DataFrame, **options: int) -> DataFrame:
    """Groups of documents with identical text.

    Returns a row for each row of ``docs``: doc_id, keep_id (largest doc_id of the group), group_size,
    kept, text_sha256 (of the text in UTF-8).

    Nulls: a null text counts as empty and so equals empty texts. A null doc_id counts as a member,
    sorts below every other id and is kept only where the whole group has none (then keep_id is null).
    Rows repeated with the same doc_id: each returns a row, all of them kept if their id is the largest;
    group_size counts rows. No length limit; an empty table returns no rows; other columns are ignored.
    """
    rows = text_of(docs, "doc_id", "text").select("doc_id", "text", F.xxhash64("text").alias("fingerprint"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
    ids = materialise(rows.select("doc_id", "fingerprint", "text_sha256"), "dedup-ids")
    repeated = materialise(repeated_fingerprints(ids, **options), "dedup-repeated")
    # Byte verification: texts with a repeated fingerprint are grouped by their bytes. Equal rows of a task are combined
    # before the shuffle; the digest takes the text's place afterwards.
    routed = on_repeated_slots(rows, repeated).join(repeated.select("fingerprint"), "fingerprint", "left_semi")
    groups = routed.groupBy("fingerprint", "text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = groups.select("fingerprint", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), "keep_id", "group_size")
    found = ids.join(materialise(groups, "dedup-groups"), ["fingerprint", "text_sha256"], "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )
