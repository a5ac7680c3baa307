"""Token-ID output: shards of raw ids, each with a minimal perfect hash index of its document keys.

A shard is two files. ``.bin``: the ids of its documents one after another, little-endian, 16 bits each
where the vocabulary fits and 32 otherwise. ``.mph``: a JSON header, then arrays: the levels of the hash
(bit arrays with ranks), and for each of the n slots a 32-bit fingerprint of the key, the place of the first
id and the number of ids. n keys have n slots; a lookup hashes the key, finds its level and slot by rank,
compares the fingerprint and reads one slice of the payload, whatever the number of documents.

Shards hold ranges of keys in ascending order, so a key's shard follows from the manifest.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import cores, filesystem, make_dir, materialise, scratch, slices, text_of, tidy
from .wordhash import mix

GAMMA = 2.0
NULL_KEY = np.uint64(0x6A09E667F3BCC909)


def key_hashes(doc_ids: np.ndarray, valid: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """64-bit keys of (doc_id or null, how many rows with this doc_id stand before)."""
    h = mix(doc_ids.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    h = np.where(valid, h, NULL_KEY)
    return np.where(copies > 0, mix(h ^ (copies.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))), h)


class MinimalPerfectHash:
    """Maps n distinct 64-bit keys onto 0..n-1: levels of bits; a key lives where it was alone on its bit."""

    def __init__(self, sizes: list[int], words: np.ndarray, ranks: np.ndarray):
        self.sizes, self.words, self.ranks = sizes, words, ranks

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys + np.uint64((level + 1) * 0xE7037ED1A0B428DB % 2**64)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> MinimalPerfectHash:
        sizes, parts, level = [], [], 0
        if len(np.unique(keys)) != len(keys):
            raise ValueError("two keys of a shard have the same 64-bit hash")
        while len(keys):
            size = -(-max(64, int(GAMMA * len(keys))) // 64) * 64
            at = cls._place(keys, level, size)
            alone = np.bincount(at, minlength=size) == 1
            parts.append(np.packbits(alone, bitorder="little").view("<u8"))
            sizes.append(size)
            keys = keys[~alone[at]]
            level += 1
        words = np.concatenate(parts) if parts else np.zeros(0, "<u8")
        ones = np.bitwise_count(words)
        return cls(sizes, words, np.concatenate(([0], np.cumsum(ones)[:-1])).astype("<i8") if len(ones) else np.zeros(0, "<i8"))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where no level has it; a foreign key may get any slot."""
        out = np.full(len(keys), -1, np.int64)
        rest, base = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = self._place(keys[rest], level, size) + base
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            here = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[rest[here]] = (self.ranks[at >> 6] + below)[here]
            rest = rest[~here]
            base += size
        return out


def index_bytes(keys: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int, doc_ids: np.ndarray, valid: np.ndarray, copies: np.ndarray) -> bytes:
    mph = MinimalPerfectHash.build(keys)
    slot = mph.slots(keys)
    arrays = {"words": mph.words, "ranks": mph.ranks}
    for name, values, kind in (("fingerprints", (keys >> np.uint64(32)), "<u4"), ("starts", starts, "<i8"), ("lengths", lengths, "<i8")):
        arrays[name] = np.zeros(len(keys), kind)
        arrays[name][slot] = values
    arrays |= {"doc_ids": doc_ids.astype("<i8"), "valid": valid.astype("u1"), "copies": copies.astype("<u4")}
    header = json.dumps({"sizes": mph.sizes, "width": width, "arrays": {k: [v.dtype.str, len(v)] for k, v in arrays.items()}}).encode()
    return len(header).to_bytes(8, "little") + header + b"".join(v.tobytes() for v in arrays.values())


class Shard:
    """An opened shard: keyed access to the ids of its documents."""

    def __init__(self, path: str):
        fs, at = filesystem(path)
        with fs.open_input_file(at + ".mph") as f:
            raw = f.readall()
        n = int.from_bytes(raw[:8], "little")
        header, at_byte = json.loads(raw[8 : 8 + n]), 8 + n
        arrays = {}
        for k, (kind, size) in header["arrays"].items():
            arrays[k] = np.frombuffer(raw, kind, size, at_byte)
            at_byte += arrays[k].nbytes
        self.mph = MinimalPerfectHash(header["sizes"], arrays["words"], arrays["ranks"])
        self.width, self.arrays = header["width"], arrays
        self.payload = fs.open_input_file(at + ".bin")

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first id and number of ids, -1 for keys that are not in the shard."""
        slot = self.mph.slots(keys)
        ok = slot >= 0
        ok[ok] = self.arrays["fingerprints"][slot[ok]] == (keys[ok] >> np.uint64(32)).astype(np.uint32)
        return np.where(ok, self.arrays["starts"][slot], -1), np.where(ok, self.arrays["lengths"][slot], -1)

    def ids(self, start: int, length: int) -> np.ndarray:
        return np.frombuffer(self.payload.read_at(length * self.width, start * self.width), f"<u{self.width}")

    def get(self, doc_id: int | None, copy: int = 0) -> np.ndarray | None:
        start, length = self.find(key_hashes(np.array([doc_id or 0]), np.array([doc_id is not None]), np.array([copy])))
        return self.ids(int(start[0]), int(length[0])) if start[0] >= 0 else None


def byte_letters() -> list[str]:
    """The letter that byte-level models write for each byte: printable Latin-1 itself, the others from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    rest = [b for b in range(256) if b not in set(plain)]
    letters = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


# The normaliser and the splitting of the tokenizer whose pieces the short way below can cut.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# The same on printable ASCII and accented Latin-1 letters, which NFC leaves as they are.
_LETTERS = "a-zß-öø-ÿ"
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]*")
PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^{_LETTERS}0-9]+")


class WordMemo:
    """Encodes texts word by word, words being cut at blanks, tabs and line ends, and remembers pieces.

    The tokenizer must treat white space as a border that no token crosses and that gives no id. If it splits
    and normalises as the fixed values above say, words of printable ASCII and accented Latin-1 letters are cut
    here and only their pieces go to the library's BPE model; all other words are encoded by the library whole,
    as are texts with the beginning of a special token.
    """

    KEPT = 200_000

    def __init__(self, path: str, special: str = "<|", end_id: int = 2):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.kind = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.special = special
        self.end = self._bytes([end_id])
        self.pieces: dict[str, bytes] = {}
        self.letters = byte_letters()
        # Their own states: the whole configuration would be some 100 MB with its vocabulary.
        state = lambda part: json.loads(part.__getstate__()) if part is not None else {}
        normal = state(self.tokenizer.normalizer).get("normalizers") or []
        splits = state(self.tokenizer.pre_tokenizer).get("pretokenizers") or []
        self.short = [n["type"] for n in normal] == NORMALIZERS and [n["type"] for n in splits] == ["Split", "ByteLevel"] and splits[0]["pattern"] == {"Regex": SPLIT} and not splits[1]["add_prefix_space"]

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def _piece(self, piece: str) -> bytes:
        if (ids := self.pieces.get(piece)) is None:
            word = piece if piece.isascii() else "".join([self.letters[b] for b in piece.encode()])
            ids = self.pieces[piece] = b"".join([t.id.to_bytes(self.kind.itemsize, "little") for t in self.model.tokenize(word)])
        return ids

    def _word(self, word: str) -> bytes:
        if self.short and PLAIN.fullmatch(word):
            return b"".join([self._piece(p) for p in PIECES.findall(word.lower())])
        return self._bytes(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with the end id, one after another; and how many each text has.

        Distinct words are looked up once; their ids are then gathered for all words at a time.
        """
        special = pc.match_substring(texts, self.special)
        if special.true_count:
            out = [np.frombuffer(self._bytes(self.tokenizer.encode(t, add_special_tokens=False).ids) + self.end, self.kind) if s else self.encode(pa.array([t]))[0] for t, s in zip(texts.to_pylist(), special.to_pylist(), strict=True)]
            return np.concatenate(out), np.array([len(x) for x in out], np.int64)
        for c in "\n\t":
            texts = pc.replace_substring(texts, c, " ")
        lists = pc.split_pattern(texts, " ")
        offsets = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
        words = lists.flatten().dictionary_encode()
        if len(self.pieces) > self.KEPT:
            self.pieces = {}
        piece = self.pieces.get  # most words are a piece
        known = [piece(w) or self._word(w) for w in words.dictionary.to_pylist()]
        pool = np.frombuffer(b"".join(known), self.kind)
        size = np.fromiter(map(len, known), np.int64, len(known)) // self.kind.itemsize
        at = words.indices.to_numpy()
        length = size[at]
        end = np.concatenate(([0], np.cumsum(length)))
        ids = pool[np.repeat((np.cumsum(size) - size)[at] - end[:-1], length) + np.arange(end[-1])]
        out = np.empty(end[-1] + len(texts), self.kind)
        ends = end[offsets[1:]] + np.arange(len(texts))
        inner = np.ones(len(out), bool)
        inner[ends] = False
        out[inner], out[ends] = ids, np.frombuffer(self.end, self.kind)
        return out, np.diff(end[offsets]) + 1


@lru_cache(maxsize=2)
def _memo(path: str, end_id: int) -> WordMemo:
    return WordMemo(path, end_id=end_id)


def write_shards(folder: str, tokenizer: str, end_id: int, encoder: Callable[[str, int], object]):
    """Partition function over sorted (doc_id, text): writes a shard, returns its manifest row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        path = f"{folder}/shard-{context.partitionId():06d}-{context.taskAttemptId()}"
        fs, at = filesystem(path)
        ids, valid, lengths, sink, memo = [], [], [], None, None
        for batch in batches:
            if sink is None:
                memo, sink = encoder(tokenizer, end_id), fs.open_output_stream(at + ".bin", compression=None, buffer_size=1 << 20)
            for lo, hi in slices(batch.column(1), 2 << 20):
                got, n = memo.encode(batch.column(1).slice(lo, hi - lo))
                sink.write(got.tobytes())
                lengths.append(n)
            valid.append(np.asarray(batch.column(0).is_valid()))
            ids.append(batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        if sink is None:
            return
        sink.close()
        memo.pieces = {}  # the worker is reused; its next task may be another operator's
        ids, valid, lengths = np.concatenate(ids), np.concatenate(valid), np.concatenate(lengths)
        same = np.concatenate(([False], (ids[1:] == ids[:-1]) & (valid[1:] == valid[:-1])))
        run_start = np.maximum.accumulate(np.where(same, 0, np.arange(len(ids))))
        copies = np.arange(len(ids)) - run_start
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        with fs.open_output_stream(at + ".mph", compression=None) as f:
            f.write(index_bytes(key_hashes(ids, valid, copies), starts, lengths, memo.kind.itemsize, ids, valid, copies))
        yield pa.RecordBatch.from_arrays([pa.array([context.partitionId()], pa.int64()), pa.array([path]), pa.array([len(ids)], pa.int64()), pa.array([int(lengths.sum())], pa.int64())], ["shard", "path", "docs", "tokens"])

    return run


def read_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partition function: (path, base, first) of shards in, a row for each document out, by keyed access."""
    for batch in batches:
        for path, base, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            shard = Shard(path)
            ids, valid, copies = shard.arrays["doc_ids"], shard.arrays["valid"].astype(bool), shard.arrays["copies"]
            for lo in range(0, len(ids), 2048):
                part = slice(lo, lo + 2048)
                start, length = shard.find(key_hashes(ids[part], valid[part], copies[part]))
                if (start < 0).any():
                    raise ValueError(f"a key of {path} is not in its index")
                crc = [zlib.crc32(shard.ids(int(s), int(n)).astype("<u4").tobytes()) for s, n in zip(start, length, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(ids[part], pa.int64(), mask=~valid[part]), pa.array(start + base), pa.array(length), pa.array(crc, pa.int64()), pa.array(np.arange(lo, lo + len(start)) + first)], ["doc_id", "start", "n_tokens", "ids_crc32", "position"])


def write_token_shards(rows: DataFrame, tokenizer: str, *, order: list[str], end_id: int = 2, shard_bytes: int = 64 << 20, folder: str | None = None, encoder: Callable[[str, int], object] = _memo) -> DataFrame:
    """Write (doc_id, text) in the order of the columns ``order``; returns the manifest.

    Manifest: shard, path, docs, tokens, base (ids before the shard), first (documents before it). Shards are
    ranges of about ``shard_bytes`` bytes of text, for small inputs less, so that all cores write.
    """
    spark = rows.sparkSession
    folder = folder or scratch(spark, "tokens")
    make_dir(folder)
    rows = text_of(rows, "text", *dict.fromkeys(["doc_id", *order]))
    planned = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0  # measured: a planner's guess may be far off
    shards = max(1, -(-planned // shard_bytes), min(4 * cores(spark), -(-planned // (1 << 20))))
    # The text is the last key, which gives rows with equal values of the order (many may have no id) a fixed order; by its
    # beginning they are dealt over shards too. A shard numbers the rows of a key that it holds.
    ranged = rows.repartitionByRange(shards, *[F.col(c).asc_nulls_first() for c in order], F.substring("text", 1, 48)).sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order], "text")
    written = ranged.select("doc_id", "text").mapInArrow(tidy(write_shards(folder, tokenizer, end_id, encoder)), "shard long, path string, docs long, tokens long")
    manifest = materialise(written, "manifest", arrow_rows=500)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each shard
    return manifest.withColumns({"base": F.coalesce(F.sum("tokens").over(before), F.lit(0)), "first": F.coalesce(F.sum("docs").over(before), F.lit(0))})


def token_digests(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, position of every document, read from the shards through their indexes."""
    spark = manifest.sparkSession
    return manifest.select("path", "base", "first").repartition(4 * cores(spark), "path").mapInArrow(read_shards, "doc_id long, start long, n_tokens long, ids_crc32 long, position long")


def token_ids(docs: DataFrame, tokenizer: str, *, end_id: int = 2, shard_bytes: int = 64 << 20, folder: str | None = None) -> DataFrame:
    """Encode, write in ascending doc_id order, read back.

    Returns a row for each row of ``docs``: doc_id, start (ids of all documents before it), n_tokens (its ids
    and the end id), ids_crc32 (of these as little-endian unsigned 32-bit integers), position (from 0).

    A null text counts as empty and has the end id only. Null doc_ids come first. Rows repeated with a
    doc_id stand in the order of their texts, and are keyed by (doc_id, how many came before in its shard). An empty
    table writes nothing and returns no rows. Other columns are ignored. doc_id must be an integer.
    """
    rows = text_of(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return token_digests(write_token_shards(rows, tokenizer, order=["doc_id"], end_id=end_id, shard_bytes=shard_bytes, folder=folder))
