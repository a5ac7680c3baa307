"""Toxicity scores: a lexicon trie met by Levenshtein automata, and context windows around each hit.

The lexicon is mined from labelled rows: words and word stems that toxic documents have far more often
than clean ones. Its trie is intersected with the Levenshtein automata of its terms: a state is a set of
(trie node, edits so far), which is made deterministic on demand, so that a text's word is read once,
letter by letter, whatever the lexicon's size, and most words end in the dead state after a few letters.
Insertion, deletion, substitution and the swap of two neighbours are one edit each.

Every hit gets a score from its context: a term inside quotation marks, after a reporting verb or a word
such as "term", or negated, counts less than one aimed at somebody. The best windows feed a logistic
regression, fitted on the same labelled rows.
"""

from __future__ import annotations

import heapq
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import map_rows, slices, text_of, tidy

WORD = re.compile(r"[^\W_]+")
# Words that mark a mention or an address, in the four languages of the corpus.
REPORTING = frozenset("said says say called calls quote quoted wrote word term insult phrase sagte nannte wort zitat dit mot citation terme dijo llamó palabra cita".split())
NEGATION = frozenset("not never no nicht kein keine nie pas jamais nunca".split())
ADDRESS = frozenset("you your yours du dein ihr euch tu vous toi tú usted eres".split())
PARTNERS = {'"': '"', "“": "”", "„": "“”", "«": "»"}
MARKS = re.compile(r'["“”„«»]|\n[^\S\n]*\n')
CITED = re.compile(r"^[^\S\n]*>.*$", re.MULTILINE)
REACH = 5  # words on either side that are a hit's context window
LEAST_TERM, LONGEST_STEM = 4, 32


@dataclass
class Node:
    children: dict[str, int] = field(default_factory=dict)
    term: int = -1
    stem: int = -1


class LexiconAutomaton:
    """``terms``: (text, is_stem, most edits). A stem matches every word that begins with it."""

    LIMIT = 20_000

    def __init__(self, terms: list[tuple[str, bool, int]]):
        self.terms = terms
        self.nodes = [Node()]
        self.most = max((k for _, _, k in terms), default=0)
        for number, (text, stem, _) in enumerate(terms):
            at = 0
            for c in text:
                if c not in self.nodes[at].children:
                    self.nodes.append(Node())
                    self.nodes[at].children[c] = len(self.nodes) - 1
                at = self.nodes[at].children[c]
            if stem:
                self.nodes[at].stem = number
            else:
                self.nodes[at].term = number
        self._clear()

    def __reduce__(self):
        return LexiconAutomaton, (self.terms,)

    def _clear(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.members: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.accepts: list[tuple[int, int] | None] = []
        self._state(frozenset())
        self.start = self._state(self._closed({("N", 0, 0)}))

    def _closed(self, items: set) -> frozenset:
        """With what skipping letters of the lexicon reaches; only the fewest edits of each place are kept."""
        work, best = list(items), {}
        while work:
            kind, at, e, *more = work.pop()
            key = (kind, at, *more)
            if best.get(key, 99) <= e:
                continue
            best[key] = e
            if kind == "N":
                if (s := self.nodes[at].stem) >= 0 and e <= self.terms[s][2]:
                    work.append(("A", s, e))
                if e < self.most:
                    work += [("N", child, e + 1) for child in self.nodes[at].children.values()]
        return frozenset((key[0], key[1], e, *key[2:]) for key, e in best.items())

    def _state(self, items: frozenset) -> int:
        if items not in self.states:
            self.states[items] = len(self.members)
            self.members.append(items)
            self.moves.append({})
            ends = [(e, at) for kind, at, e, *_ in items if kind == "A"]
            ends += [(e, t) for kind, at, e, *_ in items if kind == "N" and (t := self.nodes[at].term) >= 0 and e <= self.terms[t][2]]
            self.accepts.append(min(ends) if ends else None)
        return self.states[items]

    def _move(self, state: int, c: str) -> int:
        out: set = set()
        for kind, at, e, *more in self.members[state]:
            if kind == "A":
                out.add((kind, at, e))
            elif kind == "T":  # the second of two swapped letters
                if c == more[0]:
                    out.add(("N", at, e))
            else:
                children = self.nodes[at].children
                if c in children:
                    out.add(("N", children[c], e))
                if e < self.most:
                    out.add(("N", at, e + 1))
                    for letter, child in children.items():
                        if letter != c:
                            out.add(("N", child, e + 1))
                            if c in self.nodes[child].children:
                                out.add(("T", self.nodes[child].children[c], e + 1, letter))
        return self._state(self._closed(out))

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, term) of the nearest term within its own limit, the first listed of equally near ones."""
        if len(self.members) > self.LIMIT:
            self._clear()
        moves, s = self.moves, self.start
        for c in word:
            t = moves[s].get(c)
            if t is None:
                t = self._move(s, c)
                moves[s][c] = t
            if not t:
                return None
            s = t
        return self.accepts[s]


class Matcher:
    """Matches of distinct words, kept in a bounded memory."""

    KEPT = 1 << 17

    def __init__(self, automaton: LexiconAutomaton):
        self.automaton, self.misses, self.hits = automaton, set(), {}

    def found(self, words: set[str]) -> dict[str, tuple[int, int]]:
        for w in words - self.misses - self.hits.keys():
            if m := self.automaton.match(w):
                self.hits[w] = m
            else:
                self.misses.add(w)
        out = {w: self.hits[w] for w in words & self.hits.keys()}
        if len(self.misses) + len(self.hits) > self.KEPT:
            self.misses, self.hits = set(), {}
        return out


def quoted(text: str) -> list[tuple[int, int]]:
    """Start and end of every quotation in the text, in order: from a mark to its partner in the same paragraph, however far."""
    out, opened = [], None
    for m in MARKS.finditer(text):
        c = m.group()
        if c[0] == "\n":
            opened = None
        elif opened is None:
            if c in PARTNERS:
                opened = m
        elif c in PARTNERS[opened.group()]:
            out.append((opened.end(), m.start()))
            opened = None
    return out


def replied(text: str) -> list[tuple[int, int]]:
    """Start and end of every line that begins with the mark of a cited message."""
    return [m.span() for m in CITED.finditer(text)] if ">" in text else []


def _within(spans: list[tuple[int, int]], at: int) -> bool:
    k = bisect_right(spans, (at, math.inf)) - 1
    return k >= 0 and at < spans[k][1]


def context(in_quotation: bool, in_reply: bool, before: list[str], after: list[str]) -> float:
    """How much a hit counts by its place and the words around it: 1 is neutral, less in a quotation or mention, more if aimed at somebody."""
    weight = 0.35 if in_quotation else 1.0
    if in_reply:
        weight *= 0.35
    if REPORTING.intersection(before):
        weight *= 0.6
    if NEGATION.intersection(before[-2:]):
        weight *= 0.7
    if ADDRESS.intersection(before) or ADDRESS.intersection(after):
        weight *= 1.3
    return weight


def _texts(column: pa.Array) -> Iterator[str | None]:
    """The texts of a column, turned into Python's strings for some MB at a time."""
    for lo, hi in slices(column, 2 << 20):
        yield from column.slice(lo, hi - lo).to_pylist()


def hits(text: str, matcher: Matcher) -> list[tuple[int, int, float]]:
    """(term, edits, context weight) of every hit in the text."""
    low = text.lower()
    if len(low) != len(text):  # a letter whose lower case is longer: positions are those of the lower case
        text = low
    found = matcher.found(set(WORD.findall(low)))
    if not found:
        return []
    places = list(WORD.finditer(low))
    words = [m.group() for m in places]
    quotations, replies = quoted(text), replied(text)
    at = [(i, w, places[i].start()) for i, w in enumerate(words) if w in found]
    return [(found[w][1], found[w][0], context(_within(quotations, a), _within(replies, a), words[max(0, i - REACH) : i], words[i + 1 : i + 1 + REACH])) for i, w, a in at]


@dataclass
class ToxicityModel:
    automaton: LexiconAutomaton
    weights: list[list[float]]  # by term and edits; 0: this many edits say nothing
    coefficients: list[float]
    threshold: float = 0.7

    def features(self, found: list[tuple[int, int, float]]) -> list[float]:
        scores = sorted((w * self.weights[t][e] for t, e, w in found if self.weights[t][e] > 0), reverse=True)
        if not scores:
            return [0.0, 0.0, 0.0]
        return [1.0, scores[0], math.log1p(sum(scores[1:]))]

    def score(self, found: list[tuple[int, int, float]]) -> float:
        z = self.coefficients[0] + sum(a * b for a, b in zip(self.coefficients[1:], self.features(found), strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def held_out(column: str = "doc_id") -> F.Column:
    """Rows that nothing is learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int, seed: int = 0) -> DataFrame:
    """(text, toxic) of at most ``rows`` labelled documents in the order of a hash of their ids; none held out, equal ones once.

    The ids are broadcast: at most ``rows`` of them.
    """
    ids = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
    ids = ids.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(rows)
    return text_of(docs, "doc_id", "text").join(F.broadcast(ids), "doc_id").select("text", "toxic").dropDuplicates()


def _pieces(text: str, longest: int) -> set[str]:
    """Words (ended by a blank) and stems of a text."""
    out = set()
    for w in set(WORD.findall(text.lower())):
        if len(w) >= LEAST_TERM:
            out.update(w[:k] for k in range(LEAST_TERM, min(longest, len(w)) + 1))
            out.add(f"{w} ")
    return out


def _count_pieces(longest: int, among: frozenset | None = None):
    """Partition function: (text) in, (piece, n) of its rows out; of the pieces among the given ones, if any are given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in _texts(batch.column(0)):
                counts.update(_pieces(text, longest) if among is None else _pieces(text, longest) & among)
                if len(counts) > 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["piece", "n"])
                    counts = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["piece", "n"])

    return run


def _pieces_among(longest: int, among: frozenset):
    """Partition function: (text) in; of each row the pieces that are among the given ones out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sorted(_pieces(t, longest) & among) for t in _texts(batch.column(0))], pa.list_(pa.string()))], ["pieces"])

    return run


def cover(holders: dict[str, list[int]], least: float) -> list[str]:
    """Greedy choice of pieces that explain rows: a row held by k chosen pieces adds 1 / (k + 1) to another's gain.

    Ends below a gain of ``least``. So the words of a copied text, all in the same rows, are not all chosen.
    None is chosen that begins with a chosen piece or that a chosen one begins with.
    """
    held: Counter = Counter()
    heap = [(-float(len(rows)), p) for p, rows in holders.items()]
    heapq.heapify(heap)
    chosen: list[str] = []
    while heap:
        _, p = heapq.heappop(heap)
        if any(p.startswith(q) or q.startswith(p) for q in chosen):
            continue
        gain = sum(1 / (held[i] + 1) for i in holders[p])
        if gain < least:
            continue
        if heap and gain < -heap[0][0]:  # gains only fall: look again when its turn comes
            heapq.heappush(heap, (-gain, p))
            continue
        chosen.append(p)
        held.update(holders[p])
    return chosen


def mine_lexicon(sample: DataFrame, *, lift: float = 10, share: float = 0.003, least: int = 3, gain: float = 1, longest: int = LONGEST_STEM) -> list[tuple[str, bool, int, float]]:
    """(term, is_stem, most edits, weight) of the sample's toxic rows; their number has no cap, as a term's gain ends the choice.

    Whole words of any length are candidates, and stems of up to ``longest`` letters; what a longer beginning matches
    its stem of that length matches too. A term is in ``share`` of the toxic rows, and ``least`` of them, at least, and ``lift`` times as often
    as in clean rows. A stem stands for its words unless one longer piece has nearly all its rows. Of these
    the terms that explain the toxic rows are chosen, see :func:`cover`.
    """
    sizes = {r[0]: r[1] for r in sample.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return []
    need = max(least, math.ceil(share * toxic))
    count = lambda kind, among=None: sample.where(F.col("toxic") == kind).select("text").mapInArrow(tidy(_count_pieces(longest, among)), "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    # No cap by count: all pieces of enough toxic rows are counted in the clean ones, so rare terms of small languages
    # don't stand behind common neutral words. The bounded sample bounds them.
    often = {r[0]: r[1] for r in count(1).where(F.col("n") >= need).collect()}
    elsewhere = {r[0]: r[1] for r in count(0, frozenset(often)).collect()}
    good = {p: n for p, n in often.items() if n / toxic >= lift * (elsewhere.get(p, 0) + 0.5) / clean}
    outside = {p: elsewhere.get(p, 0) for p in good}
    children: dict[str, list[str]] = {}
    for p in good:
        children.setdefault(p[:-1], []).append(p)
    pieces = set()
    for p in good:
        while longer := [c for c in children.get(p, ()) if good[c] >= 0.95 * good[p]]:
            p = max(longer, key=lambda c: (good[c], c))
        pieces.add(p)
    holders: dict[str, list[int]] = {p: [] for p in pieces}
    for i, row in enumerate(sample.where("toxic = 1").select("text").mapInArrow(tidy(_pieces_among(longest, frozenset(pieces))), "pieces array<string>").collect()):
        for p in row[0]:
            holders[p].append(i)
    chosen = cover(holders, max(gain, share * toxic))
    out = []
    for p in chosen:
        word = p.rstrip(" ")
        weight = math.log((good[p] + 0.5) / (toxic + 1)) - math.log((outside[p] + 0.5) / (clean + 1))
        out.append((word, p == word, 0 if len(word) < 5 else 1 if len(word) < 8 else 2, weight))
    return out


def _found_of(automaton: LexiconAutomaton):
    """Partition function: (text, toxic) in; (toxic, hits) out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(automaton)
        kind = pa.list_(pa.struct([("term", pa.int32()), ("edits", pa.int32()), ("weight", pa.float64()), ("n", pa.int32())]))
        for batch in batches:
            rows = []
            for text in _texts(batch.column(0)):
                grouped: Counter = Counter(hits(text, matcher))
                rows.append([{"term": t, "edits": e, "weight": w, "n": n} for (t, e, w), n in sorted(grouped.items())])
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(rows, kind)], ["toxic", "hits"])

    return run


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> list[float]:
    """Newton's method; the constant is not penalised."""
    x = np.column_stack((np.ones(len(x)), x))
    b, penalty = np.zeros(x.shape[1]), np.diag([1e-6] + [ridge * len(y) / 100 + 1e-3] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ b)
        b += step
        if np.abs(step).max() < 1e-8:
            break
    return [float(v) for v in b]


def fit_toxicity(docs: DataFrame, labels: DataFrame, *, sample_rows: int = 20_000, edit_lift: float = 5, **lexicon: float) -> ToxicityModel:
    """Learn lexicon, weights of edits and regression from at most ``sample_rows`` labelled rows, none held out.

    ``lexicon``: options of :func:`mine_lexicon`. ``edit_lift``: how many times as often as in clean rows a term's
    misspellings with so many edits have to be in toxic ones to count.

    Without toxic or without clean labels the model scores 0 everywhere it can: its lexicon is empty.
    """
    sample = labelled_sample(docs, labels, sample_rows).persist()
    try:
        terms = mine_lexicon(sample, **lexicon)
        automaton = LexiconAutomaton([t[:3] for t in terms])
        if not terms:
            return ToxicityModel(automaton, [], [-4.0, 0.0, 0.0, 0.0])
        rows = sample.mapInArrow(tidy(_found_of(automaton)), "toxic int, hits array<struct<term int, edits int, weight double, n int>>").collect()
    finally:
        sample.unpersist()
    seen = [Counter(), Counter()]
    for toxic, found in rows:
        seen[toxic].update({(h.term, h.edits) for h in found})
    n = Counter(r[0] for r in rows)
    weights = []
    for t, (_, _, most, weight) in enumerate(terms):
        own = [weight]
        for e in range(1, most + 1):
            # Misspellings count only as far as they are rare in clean rows: no more than the term's own lift allows.
            a, b = (seen[1][t, e] + 0.5) / (n[1] + 1), (seen[0][t, e] + 0.5) / (n[0] + 1)
            quiet = seen[0][t, e] == 0 and seen[1][t, e] == 0
            own.append(weight * 0.8**e if quiet or a >= edit_lift * b else 0.0)
        weights.append(own + [0.0] * (2 - most))
    model = ToxicityModel(automaton, weights, [0.0] * 4)
    x = np.array([model.features([(h.term, h.edits, h.weight) for h in found for _ in range(h.n)]) for _, found in rows])
    model.coefficients = fit_logistic(x, np.array([r[0] for r in rows], float))
    return model


def toxicity_scores(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; ``score`` depends on the text alone.

    Null and empty texts have no hits and get the lowest score. A null doc_id stays null and is not held out.
    Repeated rows each get a row. Texts are read whole; an empty table gives no rows; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model.automaton)
        for batch in batches:
            found = [hits(t, matcher) for t in _texts(batch.column(1))]
            scores = [model.score(f) for f in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(scores, pa.float64()), pa.array([int(s >= model.threshold) for s in scores], pa.int32()), pa.array([len(f) for f in found], pa.int64())], ["doc_id", "held_out", "score", "predicted", "n_hits"])

    rows = text_of(docs, "doc_id", "text").withColumn("held_out", held_out())
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int, n_hits long")


def drop_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs``, all columns, without rows whose score reaches the threshold; null and empty texts stay."""
    column = docs.columns.index("text")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model.automaton)
        for batch in batches:
            yield batch.filter(pa.array([model.score(hits(t or "", matcher)) < model.threshold for t in _texts(batch.column(column))], pa.bool_()))

    return map_rows(docs, run)
