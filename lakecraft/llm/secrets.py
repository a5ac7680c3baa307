"""Secret scans: patterns, and the guess cost of values that stand in a credential's place.

The base patterns are fixed. The method adds ``guess`` spans: values after a credential word whose guess
cost, by dynamic programming, reaches a threshold. The cost of a value is the least sum, over all ways to cut
it into spans, of the decimal logarithms of the guesses that each span takes: words, dates, repeats of a unit,
keyboard walks and sequences, brute force by the size of the alphabet; every cut costs a factor of two. A value
such as ``summer2024`` is cheap, a random string is not.

A word costs the logarithm of how many words of the corpus stand for one of it (its expected rank), or its rank
among the words that people use in passwords, whichever is less. The counts come from all texts, less the words
of the values themselves. Only the pieces of values meet the counts, in a join, so no dictionary is broadcast and
none is cut short.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping
from itertools import accumulate, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialise, slices, text_of

# The base patterns, in the order in which kinds are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # runs are taken whole, so shorter ones fail as they would by length
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
KINDS = ("assign", "access", "hex", "guess")
KEYWORDS = ("passw", "secret", "token", "api")

# Words that announce a credential, and words that people use in passwords, by falling use.
CREDENTIALS = "password passwd passphrase passwort contraseña clave secret token credential credentials pwd pass pin auth authorization bearer login api_key apikey api-key access_key private_key client_secret".split()
COMMON = "password admin user test qwerty welcome letmein monkey dragon login hello secret master iloveyou sunshine princess football baseball summer winter spring autumn love money hunter shadow batman superman default root pass changeme example sample dummy demo token access public private server database system company home money star blue red green black white".split()
CONTEXT = re.compile(r"(?<![^\W_])(" + "|".join(sorted(map(re.escape, CREDENTIALS), key=len, reverse=True)) + r""")["']?(?:[ \t]*[:=][ \t]*|[ \t]+(?:is|ist|es|est)[ \t]+)["']?([^\s"'<>,;]{8,})""", re.IGNORECASE)
CONTEXT_KEYWORDS = ("pass", "contrase", "clave", "secret", "token", "credential", "pwd", "pin", "auth", "bearer", "login", "api", "access_key", "private_key")
ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
RANKED = {w: math.log10(k + 2) for k, w in enumerate(COMMON)}
LEAST_WORD, LONGEST_WORD = 3, 24  # letters
LETTERS = re.compile(r"[^\W\d_]+")
DATES = (
    (re.compile(r"(?:19|20)\d\d"), math.log10(120)),
    (re.compile(r"(?:19|20)\d\d[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])"), math.log10(365 * 120)),
    (re.compile(r"(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d"), math.log10(365 * 120)),
)
LEET = str.maketrans("013457@$!", "oieastasi")
CUT = math.log10(2)
LEAST_RUN = 3  # characters of a keyboard walk or a sequence
WALK, SEQUENCE = 47 * 4.6, 36 * 2  # keys to begin with, and ways to go on; characters to begin with, and directions
LONGEST_UNIT = 4  # characters that a repeat repeats


def _neighbours() -> set[tuple[str, str]]:
    """Keys beside each other in a row or on the slant to the next row."""
    at = {c: (y, x + 0.5 * y) for y, row in enumerate(ROWS) for x, c in enumerate(row)}
    return {(a, b) for a, (y, x) in at.items() for b, (v, u) in at.items() if a != b and abs(y - v) <= 1 and abs(x - u) <= 1}


NEIGHBOURS = _neighbours()


def alphabet(value: str) -> int:
    """The size of the alphabet that a guesser would have to try."""
    return 26 * any("a" <= c <= "z" for c in value) + 26 * any("A" <= c <= "Z" for c in value) + 10 * any(c.isdigit() for c in value) + 33 * any(c.isascii() and not c.isalnum() for c in value) + 100 * any(not c.isascii() for c in value) or 1


def lowered(value: str) -> str:
    """Lower case letter by letter, so that positions stay."""
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in value)


def pieces(value: str) -> Iterator[str]:
    """The letter sequences in a value, also in its leet form, that could be words; by position, so some come again."""
    for form in {lowered(value): 0, lowered(value).translate(LEET): 0}:
        for m in LETTERS.finditer(form):
            run = m.group()
            for i in range(len(run)):
                for j in range(i + LEAST_WORD, min(len(run), i + LONGEST_WORD) + 1):
                    yield run[i:j]


class _Case:
    """What the capitals of a span cost: nothing without any, one factor of two for all or only the first, else one more than there are."""

    def __init__(self, value: str):
        self.upper = np.array([c.isupper() for c in value], bool)
        self.uppers = np.concatenate(([0], np.cumsum(self.upper)))
        self.cased = np.concatenate(([0], np.cumsum([c.isupper() or c.islower() for c in value])))

    def __call__(self, start: np.ndarray, end: int) -> np.ndarray:
        k, letters = self.uppers[end] - self.uppers[start], self.cased[end] - self.cased[start]
        return CUT * np.where(k == 0, 0, np.where((k == letters) | ((k == 1) & self.upper[start]), 1, k + 1))


def guess_cost(value: str, words: Mapping[str, float] = RANKED) -> float:
    """Decimal logarithm of the guesses that the cheapest segmentation takes; ``words``: the cost of each known word.

    ``best[j]`` is the least cost of the first ``j`` characters: the minimum over all spans that end there, wherever
    they begin. Walks, sequences and repeats that end at ``j`` are tried from all their beginnings at once, so time
    is quadratic only in the length of such a run, with a small constant.
    """
    n, low = len(value), lowered(value)
    plain = low.translate(LEET)
    each, case = math.log10(alphabet(value)), _Case(value)
    best = np.full(n + 1, math.inf)
    best[0] = 0.0
    cut = np.full(n + 1, CUT)
    cut[0] = 0.0
    size = np.log10(np.arange(1, n + 2))  # size[k]: of k + 1
    brute = math.inf  # the cheapest way to be in a brute-force span
    walk = step = 0  # where the longest walk and sequence that end here begin
    periods = [0] * (LONGEST_UNIT + 1)  # characters that end here and equal the one a unit before
    dates: dict[int, list[tuple[int, float]]] = {}
    for i, c in enumerate(value):
        if c.isdigit():
            for pattern, cost in DATES:
                if m := pattern.match(value, i):
                    dates.setdefault(m.end(), []).append((i, cost))
    for j in range(1, n + 1):
        brute = min(brute, best[j - 1] + cut[j - 1]) + each
        least = brute
        for i, cost in dates.get(j, ()):
            least = min(least, best[i] + cut[i] + cost)
        for i in range(max(0, j - LONGEST_WORD), j - LEAST_WORD + 1):
            for form, more in ((low, 0.0), (plain, CUT)):
                if (cost := words.get(form[i:j])) is not None:
                    least = min(least, best[i] + cut[i] + cost + (more if form[i:j] != low[i:j] else 0.0) + float(case(np.array([i]), j)[0]))
        if j > 1:
            if (low[j - 2], low[j - 1]) not in NEIGHBOURS:
                walk = j - 1
            turn = ord(low[j - 1]) - ord(low[j - 2])
            if abs(turn) != 1:
                step = j - 1
            elif j - step > 2 and turn != ord(low[j - 2]) - ord(low[j - 3]):
                step = j - 2
        for first, ways in ((walk, WALK), (step, SEQUENCE)):
            if j - first >= LEAST_RUN:
                i = np.arange(first, j - LEAST_RUN + 1)
                least = min(least, float((best[i] + cut[i] + math.log10(ways) + size[j - i - 1] + case(i, j)).min()))
        for unit in range(1, LONGEST_UNIT + 1):  # a unit that ended before, so many times more
            periods[unit] = periods[unit] + 1 if j > unit and value[j - 1] == value[j - 1 - unit] else 0
            times = periods[unit] // unit
            if times:
                k = np.arange(1, times + 1)
                least = min(least, float((best[j - unit * k] + size[k] + CUT).min()))
        best[j] = least
    return float(best[n])


def assigned(text: str) -> list[tuple[int, int, str]]:
    """Start, end and value of the base spans that assign one."""
    low = text.lower()
    if not any(k in low for k in KEYWORDS):
        return []
    return [(m.start(), m.end(), m.group(2)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LEAST]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), sorted by start, then kind."""
    out = [(a, 0, b) for a, b, _ in assigned(text)]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def contexts(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Start and end of the values in a credential's context that no base span touches."""
    low = text.lower()
    if not any(k in low for k in CONTEXT_KEYWORDS):
        return []
    starts = [x for x, _, _ in base]
    ends = [0, *accumulate((y for _, _, y in base), max)]  # the last end of the first spans, however many of them begin before b
    return [(a, b) for a, b in (m.span(2) for m in CONTEXT.finditer(text)) if ends[bisect_left(starts, b)] <= a]


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


_VALUES = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64()), ("value", pa.string())]))
_GIVEN = pa.list_(pa.string())


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partition function: (doc_id, text) in; a row's number, counts, digest, base spans, the values in a context and those of base spans out."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 33  # used only once it is written
    for batch in batches:
        for lo, hi in slices(batch.column(1), 2 << 20):
            rows = []
            for text in batch.column(1).slice(lo, hi - lo).to_pylist():
                base = base_spans(text)
                kinds = [k for _, k, _ in base]
                spans = joined(base)
                rows.append((number, kinds.count(0), kinds.count(1), kinds.count(2), hashlib.sha256(spans.encode()).hexdigest(), spans, [{"a": a, "b": b, "value": text[a:b]} for a, b in contexts(text, base)], [v for _, _, v in assigned(text)]))
                number += 1
            types = [*[pa.int64()] * 4, pa.string(), pa.string(), _VALUES, _GIVEN]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True))], ["doc_id", "nr", "n_assign", "n_access", "n_hex", "base_sha256", "base", "guess", "given"])


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partition function: (text) in; (word, n) of its letter sequences out."""
    counts: Counter = Counter()
    for batch in batches:
        for lo, hi in slices(batch.column(0), 2 << 20):
            low = pc.utf8_lower(batch.column(0).slice(lo, hi - lo))
            parts = pc.split_pattern_regex(low, r"[^\p{L}]+").flatten()
            for word in pc.value_counts(parts).to_pylist():
                counts[word["values"]] += word["counts"]
            if len(counts) > 250_000:
                yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])
                counts = Counter()
    yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])


def cut_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partition function: (vid, value) in, (vid, piece) out; so many pieces at a time, each once among them."""
    for batch in batches:
        for vid, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            every = pieces(value)
            while part := set(islice(every, 1 << 14)):
                yield pa.RecordBatch.from_arrays([pa.array([vid] * len(part), pa.int64()), pa.array(sorted(part), pa.string())], ["vid", "piece"])


def cost_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partition function: (value, words with their cost) in, (value, cost) out."""
    for batch in batches:
        values = batch.column(0).to_pylist()
        costs = []
        for value, known in zip(values, batch.column(1).to_pylist(), strict=True):
            words = dict(RANKED)
            for w in known or ():
                words[w["piece"]] = min(w["cost"], words.get(w["piece"], math.inf))
            costs.append(guess_cost(value, words))
        yield pa.RecordBatch.from_arrays([pa.array(values, pa.string()), pa.array(costs, pa.float64())], ["value", "cost"])


def value_costs(values: DataFrame, texts: DataFrame) -> DataFrame:
    """(value, cost) of each distinct ``values.value``, by the words of ``texts.text``; words of the values themselves don't count."""
    every = materialise(values.groupBy("value").agg(F.count(F.lit(1)).alias("times")).select(F.monotonically_increasing_id().alias("vid"), "value"), "secret-values")
    cut = every.mapInArrow(cut_values, "vid long, piece string").distinct()
    words = lambda df: df.mapInArrow(count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = materialise(words(texts.select("text")).where("word <> ''"), "secret-words")
    own = words(values.select(F.col("value").alias("text"))).withColumnRenamed("n", "m")
    total = counts.agg(F.sum("n")).first()[0] or 0
    rest = counts.join(own, "word", "left").select("word", (F.col("n") - F.coalesce("m", F.lit(0))).alias("n")).where("n > 0")
    known = cut.join(rest, cut["piece"] == rest["word"]).select("vid", F.struct("piece", (F.log10(F.lit(float(max(1, total)))) - F.log10("n") + CUT).alias("cost")).alias("w"))
    costed = every.join(known.groupBy("vid").agg(F.collect_list("w").alias("words")), "vid", "left").select("value", "words")  # words of one value
    return costed.mapInArrow(cost_values, "value string, cost double")


def secret_scan(docs: DataFrame, *, least_cost: float = 10.0) -> DataFrame:
    """Spans of secrets in every document.

    Returns a row for each row of ``docs``: doc_id, n_assign, n_access, n_hex (base spans of each kind),
    base_sha256 (hex digest of the base spans ``kind:start:end`` by start, then kind, comma-joined), spans
    (base and guess spans, joined likewise), n_guess, least_cost (the least guess cost of the values that base spans
    assign, null without any), n_cheap (how many of these values cost less than ``least_cost``: placeholders, and
    passwords that are soon guessed). Positions are code points, ends exclusive. Base spans stay whatever they cost.

    A null text counts as empty: no spans, the digest of the empty string. A null doc_id stays null, repeated
    rows each get a row, texts are scanned whole. An empty table gives no rows; other columns are ignored.
    """
    rows = text_of(docs, "doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    told = materialise(rows.mapInArrow(scan, f"doc_id {kind}, nr long, n_assign long, n_access long, n_hex long, base_sha256 string, base string, guess array<struct<a long, b long, value string>>, given array<string>"), "secret-spans", arrow_rows=2000)
    asked = (F.size("guess") > 0) | (F.size("given") > 0)
    some = told.where(asked)
    columns = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256"]
    zero = F.lit(0).cast("long")
    plain = told.where(~asked).select(*columns, F.col("base").alias("spans"), zero.alias("n_guess"), F.lit(None).cast("double").alias("least_cost"), zero.alias("n_cheap"))
    if not some.take(1):
        return plain
    values = some.select("nr", F.inline("guess")).unionByName(some.select("nr", F.explode("given").alias("value")), allowMissingColumns=True)
    costs = materialise(value_costs(values.select("value"), rows), "secret-costs")
    dear, own = F.col("a").isNotNull() & (F.col("cost") >= least_cost), F.col("a").isNull()
    spans = F.collect_list(F.when(dear, F.struct("a", "b"))).alias("found")  # of one row of docs
    found = values.join(costs, "value").groupBy("nr").agg(spans, F.min(F.when(own, F.col("cost"))).alias("least_cost"), F.count(F.when(own & (F.col("cost") < least_cost), 1)).alias("n_cheap"))
    # Base spans as numbers, so that all can be put in order by start, then kind.
    parts = F.transform(F.filter(F.split("base", ","), lambda x: x != ""), lambda x: F.split(x, ":"))
    base = F.transform(parts, lambda x: F.struct(x[1].cast("long").alias("a"), F.array_position(F.array(*map(F.lit, KINDS)), x[0]).cast("int").alias("k"), x[2].cast("long").alias("b")))
    more = F.transform(F.coalesce("found", F.array().cast("array<struct<a:bigint,b:bigint>>")), lambda x: F.struct(x["a"].alias("a"), F.lit(len(KINDS)).alias("k"), x["b"].alias("b")))
    names = F.array(*map(F.lit, KINDS))
    spans = F.array_join(F.transform(F.array_sort(F.concat(base, more)), lambda x: F.concat_ws(":", F.element_at(names, x["k"]), x["a"], x["b"])), ",")
    return plain.unionByName(some.join(found, "nr", "left").select(*columns, spans.alias("spans"), F.size(more).cast("long").alias("n_guess"), "least_cost", F.coalesce("n_cheap", zero).alias("n_cheap")))
