"""WARC archives with an index of captures, merged externally.

Writing: every task appends gzip members, one record each, to its own archive in the shared folder. Index rows
are cut into runs, each sorted by (URL key, timestamp, page) and written as a file of blocks to that folder; the
first and last key of each block are its sparse index.
Index merge: split keys, from a bounded sample of the blocks' keys, deal the key space over tasks. A task opens
its slice of every run and merges the slices k ways with a loser tree, so that one comparison for each level
decides the next row; it holds one block of each run, whatever the length of its slice. Above ``FAN_IN`` runs,
groups of runs are first merged into longer runs, in as many passes as it takes. The merged index is globally
ordered: all captures of a URL stand together, by time. Keys end with a record's place, so no two are equal and
any slice, even of one URL without page ids, can be dealt further.
"""

from __future__ import annotations

import hashlib
import itertools
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import cores, filesystem, make_dir, materialise, scratch

RUN_ROWS, BLOCK_ROWS, MERGE_ROWS, MOST_PARTS, FAN_IN = 50_000, 1024, 200_000, 4096, 64
LEAST_REVISIT = 100
ARCHIVE_BYTES = 256 << 20
CAPTURE_SECONDS = 10**9
SLOTS = 1 << 20
INDEX = "urlkey string, captured timestamp, page_id long, archive string, offset long, length long"
_INDEX_SCHEMA = pa.schema([("urlkey", pa.string()), ("captured", pa.timestamp("us", "UTC")), ("page_id", pa.int64()), ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
_KEY = "struct<urlkey string, captured timestamp, page_id long, archive string, offset long>"
BLOCKS = f"run string, path string, block int, n long, first {_KEY}, last {_KEY}"
_KEY_TYPE = pa.struct(list(_INDEX_SCHEMA)[:5])
_BLOCKS_SCHEMA = pa.schema([("run", pa.string()), ("path", pa.string()), ("block", pa.int32()), ("n", pa.int64()), ("first", _KEY_TYPE), ("last", _KEY_TYPE)])


def url_key(url: Column) -> Column:
    """The host's labels from the top down, then path and query, lower case; scheme, ``www.``, port and fragment go."""
    bare = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://|#.*$", "")
    host = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*", 0), r"^www\d*\.|:\d+$", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.regexp_extract(bare, r"^[^/?]*(.*)$", 1))


def _record(kind: str, page: dict, payload: bytes) -> bytes:
    head = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<urn:page:{'' if page['page_id'] is None else page['page_id']}>",
        "WARC-Target-URI": page["url"],
        "WARC-Date": page["captured"].strftime("%Y-%m-%dT%H:%M:%S.%fZ"),
        "WARC-Payload-Digest": f"sha256:{page['digest']}",
        "X-Payload-Length": str(page["bytes"]),
    }
    if kind == "revisit":
        head |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": f"<urn:page:{page['refers_to']}>"}
    head["Content-Type"] = "text/html"
    head["Content-Length"] = str(len(payload))
    lines = "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in head.items() if v is not None)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + payload + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    n = int(fields["Content-Length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("a record's length differs from its Content-Length")
    return fields, rest[:n]


def _member(raw: bytes) -> bytes:
    z = zlib.compressobj(4, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def _order(row: tuple) -> tuple:
    return row[0], row[1], row[2] is not None, row[2] or 0, row[3], row[4]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def write_run(rows: Iterator[tuple], run: str, path: str, block_rows: int = BLOCK_ROWS) -> Iterator[tuple]:
    """Write rows, which come in order, as a file of blocks; yields what ``BLOCKS`` says of each. Holds one block."""
    fs, at = filesystem(path)
    if (head := next(rows, None)) is None:
        return
    rows, number = itertools.chain([head], rows), 0
    with fs.open_output_stream(at, compression=None, buffer_size=1 << 20) as sink, pa.ipc.new_file(sink, _INDEX_SCHEMA) as file:
        while block := list(itertools.islice(rows, block_rows)):
            file.write_batch(_batch(block, _INDEX_SCHEMA))
            first, last = (dict(zip(_INDEX_SCHEMA.names[:5], row[:5], strict=True)) for row in (block[0], block[-1]))
            yield run, path, number, len(block), first, last
            number += 1


def read_run(blocks: list[tuple[str, int]], low: tuple | None, high: tuple | None) -> Iterator[tuple]:
    """The rows of a run's blocks from ``low`` on and before ``high``; one block is held at a time."""
    path, file, source = None, None, None
    for at, number in blocks:
        if at != path:
            if source is not None:
                source.close()
            fs, place = filesystem(at)
            source = fs.open_input_file(place)
            path, file = at, pa.ipc.open_file(source)
        for row in _rows(file.get_batch(number)):
            key = _order(row)
            if high is not None and key >= high:
                source.close()
                return
            if low is None or key >= low:
                yield row
    if source is not None:
        source.close()


def write_archives(folder: str, run_rows: int = RUN_ROWS, block_rows: int = BLOCK_ROWS):
    """Partition function: pages in; archives and sorted runs written, the runs' blocks out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        stem = f"{folder}/{context.partitionId():06d}-{context.taskAttemptId()}"
        fs, at = filesystem(stem)
        rows, sink, place, archives, runs = [], None, 0, 0, 0

        def sorted_run() -> pa.RecordBatch:
            rows.sort(key=_order)
            return _batch(list(write_run(iter(rows), f"{stem}-{runs}", f"{stem}-{runs}.run", block_rows)), _BLOCKS_SCHEMA)

        for batch in batches:
            for page in (dict(zip(batch.schema.names, (c[i].as_py() for c in batch.columns), strict=True)) for i in range(batch.num_rows)):
                if sink is None:
                    sink, place = fs.open_output_stream(f"{at}-{archives}.warc.gz", compression=None, buffer_size=1 << 20), 0
                kind = "response" if page["refers_to"] is None else "revisit"
                member = _member(_record(kind, page, page["html"].encode() if kind == "response" else b""))
                sink.write(member)
                rows.append((page["urlkey"], page["captured"], page["page_id"], f"{stem}-{archives}.warc.gz", place, len(member)))
                place += len(member)
                if place >= ARCHIVE_BYTES:
                    sink.close()
                    sink, archives = None, archives + 1
                if len(rows) >= run_rows:
                    yield sorted_run()
                    rows, runs = [], runs + 1
        if sink is not None:
            sink.close()
        if rows:
            yield sorted_run()

    return run


class LoserTree:
    """K-way merge: inner nodes hold the loser of their match, so a new leaf plays only on its way to the root."""

    def __init__(self, sources: list[Iterator[tuple]], key=_order):
        self.sources, self.key, self.k = sources, key, max(1, len(sources))
        self.heads = [next(s, None) for s in sources] or [None]
        self.losers = [-1] * self.k
        for leaf in range(self.k):
            self._play(leaf)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        p, q = self.key(x), self.key(y)
        return p < q or (p == q and a < b)

    def _play(self, leaf: int) -> None:
        winner, at = leaf, (leaf + self.k) >> 1
        while at:
            if self.losers[at] < 0:  # the first to come waits for its opponent
                self.losers[at] = winner
                return
            if self._beats(self.losers[at], winner):
                self.losers[at], winner = winner, self.losers[at]
            at >>= 1
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.heads[self.losers[0] if self.k > 1 else 0] is not None:
            leaf = self.losers[0] if self.k > 1 else 0
            yield self.heads[leaf]
            self.heads[leaf] = next(self.sources[leaf], None)
            if self.k > 1:
                self._play(leaf)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _key(struct: dict) -> tuple:
    return _order((struct["urlkey"], struct["captured"], struct["page_id"], struct["archive"], struct["offset"]))


def split_keys(blocks: DataFrame, parts: int) -> list[tuple]:
    """Keys that cut the key space into about ``parts`` slices of like size, from at most 64 block keys for each slice."""
    sample = blocks.select("first", F.xxhash64("path", "block").alias("h")).orderBy("h").limit(parts * 64).select("first").toArrow()
    keys = sorted(_key(k) for k in sample.column("first").to_pylist())
    return sorted({keys[len(keys) * i // parts] for i in range(1, parts)}) if keys else []


def deal_blocks(splits: list[tuple]):
    """Partition function: (run, path, block, first, last, group) in; each block once for every slice that it touches out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, last = ([_key(k) for k in batch.column(c).to_pylist()] for c in (3, 4))
            span = [range(bisect_right(splits, a), bisect_right(splits, b) + 1) for a, b in zip(first, last, strict=True)]
            take = pa.array([i for i, s in enumerate(span) for _ in s], pa.int64())
            out = batch.take(take)
            yield pa.RecordBatch.from_arrays([pa.array([p for s in span for p in s], pa.int32()), *(out.column(c) for c in (0, 1, 2, 3, 5))], ["part", "run", "path", "block", "first", "group"])

    return run


def slices_of_runs(batches: Iterator[pa.RecordBatch], splits: list[tuple]) -> Iterator[tuple[int, int, LoserTree]]:
    """(group, slice, merged rows) of each slice in the input, which has blocks in the order of group, slice, run and key."""
    rows = ((g, p, r, path, b) for batch in batches for p, r, path, b, _, g in _rows(batch))
    for (group, part), own in itertools.groupby(rows, key=lambda x: x[:2]):
        low, high = splits[part - 1] if part else None, splits[part] if part < len(splits) else None
        runs = [[(path, b) for *_, path, b in blocks] for _, blocks in itertools.groupby(own, key=lambda x: x[2])]
        yield group, part, LoserTree([read_run(blocks, low, high) for blocks in runs])


def merge_to_index(splits: list[tuple]):
    """Partition function: a slice's blocks of all runs in, its rows in order out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, merged in slices_of_runs(batches, splits):
            rows = iter(merged)
            while block := list(itertools.islice(rows, 8192)):
                yield _batch(block, _INDEX_SCHEMA)

    return run


def merge_to_runs(splits: list[tuple], folder: str):
    """Partition function: blocks of groups of runs in; each slice of a group written as a part of one longer run, its blocks out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        attempt = TaskContext.get().taskAttemptId()
        for group, part, merged in slices_of_runs(batches, splits):
            blocks = write_run(iter(merged), f"{folder}/{group:06d}", f"{folder}/{group:06d}-{part:04d}-{attempt}.run")
            while some := list(itertools.islice(blocks, 1024)):
                yield _batch(some, _BLOCKS_SCHEMA)

    return run


def merged_index(blocks: DataFrame, folder: str, *, fan_in: int = FAN_IN) -> DataFrame:
    """The rows of all runs, given by their blocks, in one global order: by partition, and by row within each."""
    spark, level, fan_in = blocks.sparkSession, 0, max(4, fan_in)
    dealt = "part int, run string, path string, block int, first " + _KEY + ", group int"
    while True:
        told = blocks.agg(F.sum("n").alias("n"), F.countDistinct("run").alias("runs")).first()
        parts = min(MOST_PARTS, max(cores(spark), 1 + (told.n or 0) // MERGE_ROWS))
        splits = split_keys(blocks, parts)
        last = told.runs <= fan_in
        groups = 1 if last else -(-told.runs // fan_in) * 2  # a hash deals them, so twice as many keep most below the fan-in
        group = F.pmod(F.xxhash64("run"), F.lit(groups)).cast("int")
        slices = blocks.select("run", "path", "block", "first", "last", group.alias("group")).mapInArrow(deal_blocks(splits), dealt)
        order = ["group", "part", "run", "first"]
        if last:
            return slices.repartitionById(len(splits) + 1, F.col("part")).sortWithinPartitions(*order).mapInArrow(merge_to_index(splits), INDEX)
        level += 1
        make_dir(f"{folder}/pass-{level}")
        spread = slices.repartition(4 * cores(spark), "group", "part").sortWithinPartitions(*order)
        blocks = materialise(spread.mapInArrow(merge_to_runs(splits, f"{folder}/pass-{level}"), BLOCKS), "capture-runs")


def read_archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partition function: (archive, offset, length) sorted by archive in; what the records say out."""
    at, file = None, None
    for batch in batches:
        rows = []
        for archive, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if archive != at:
                fs, path = filesystem(archive)
                at, file = archive, fs.open_input_file(path)
            head, payload = parse_record(zlib.decompress(file.read_at(length, offset), 31))
            kind = head["WARC-Type"]
            digest = hashlib.sha256(payload).hexdigest() if kind == "response" else head["WARC-Payload-Digest"].partition(":")[2]
            if f"sha256:{digest}" != head["WARC-Payload-Digest"]:
                raise ValueError(f"{archive}, {offset}: the payload's digest differs")
            number = lambda x: int(x) if (x := x[len("<urn:page:") : -1]) else None
            rows.append((number(head["WARC-Record-ID"]), len(payload) if kind == "response" else int(head["X-Payload-Length"]), digest, kind, number(head["WARC-Refers-To"]) if kind == "revisit" else None))
        if rows:
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def write_warc(pages: DataFrame, *, captured: Column | None = None, folder: str | None = None, fan_in: int = FAN_IN, run_rows: int = RUN_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Write archives and return their merged index: urlkey, captured, page_id, archive, offset, length.

    ``captured``: fetch time of a page; by default a second for each page_id from the start of 2024 on,
    beginning again after ``CAPTURE_SECONDS``, so that any id gives a date.
    Among equal payloads of at least 100 bytes the smallest page_id is written in full. Pages whose digest falls on
    a slot that no repeated payload has (of ``SLOTS``, so what is broadcast is bounded) are written where they are
    read. The others meet the first page of their payload in a join of two written or scanned tables, which
    adaptive execution splits on the pages' side where many have one payload.
    """
    spark = pages.sparkSession
    folder = folder or scratch(spark, "warc")
    make_dir(folder)
    if captured is None:
        captured = F.timestamp_seconds(F.unix_timestamp(F.lit(datetime(2024, 1, 1, tzinfo=UTC))) + F.pmod(F.coalesce(F.col("page_id").cast("long"), F.lit(0)), F.lit(CAPTURE_SECONDS)))
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), html.alias("html"), F.coalesce(captured, F.timestamp_seconds(F.lit(0))).alias("captured"))
    rows = rows.withColumns({"bytes": F.octet_length("html").cast("long"), "digest": F.sha2(F.col("html").cast("binary"), 256)})
    first = rows.where(F.col("bytes") >= LEAST_REVISIT).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1 and first_id is not null")
    first = materialise(first.select("digest", "first_id"), "first-pages")
    slot = F.pmod(F.xxhash64("digest"), F.lit(SLOTS))
    marked = F.broadcast(first.select(slot.alias("slot")).distinct())
    slotted = rows.withColumn("slot", slot)
    refers = F.when(F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    met = slotted.join(marked, "slot", "left_semi").join(first.hint("merge"), "digest", "left").withColumn("refers_to", refers)
    alone = slotted.join(marked, "slot", "left_anti").withColumn("refers_to", F.lit(None).cast("long"))
    columns = ["page_id", "url", "html", "captured", "bytes", "digest", "refers_to"]
    both = alone.select(*columns).unionByName(met.select(*columns)).withColumn("urlkey", url_key(F.col("url")))
    blocks = materialise(both.mapInArrow(write_archives(folder, run_rows, block_rows), BLOCKS), "capture-runs", arrow_rows=500)
    return merged_index(blocks, folder, fan_in=fan_in)


def warc_round_trip(pages: DataFrame, **options: object) -> DataFrame:
    """Write every page, read every record back through the merged index.

    Returns a row for each page: page_id, payload_bytes, payload_digest (lower-case hex SHA-256; both of the
    full payload), record_type, refers_to.

    A null html is an empty payload, a null url an empty one. A null page_id stays null; it is the response
    only where no equal payload has an id. Rows repeated with the smallest page_id are all responses.
    Payloads may have any length that fits a row. An empty table writes nothing and returns no rows; other
    columns are ignored.
    """
    index = materialise(write_warc(pages, **options), "capture-index")
    # Archives are read front to back: all rows of one go to one task, and an archive is bounded in size.
    spread = index.select("archive", "offset", "length").repartition(4 * cores(pages.sparkSession), "archive").sortWithinPartitions("archive", "offset")
    return spread.mapInArrow(read_archives, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
