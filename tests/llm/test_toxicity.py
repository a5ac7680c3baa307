import hashlib
import math
import random
import re
import zlib

import pytest

from lakecraft.llm.toxicity import LexiconAutomaton, Matcher, drop_toxic, fit_toxicity, hits, mine_lexicon, toxicity_scores


def distance(a, b):
    """Edits with swaps of neighbours (optimal string alignment)."""
    d = [[i + j if i * j == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[len(a)][len(b)]


def test_automaton_against_edit_distance():
    rng = random.Random(3)
    terms = [("abba", False, 1), ("abcab", False, 2), ("bacca", True, 1), ("cab", False, 0)]
    automaton = LexiconAutomaton(terms)
    for _ in range(4000):
        word = "".join(rng.choice("abcd") for _ in range(rng.randrange(1, 9)))
        near = []
        for t, (term, stem, most) in enumerate(terms):
            e = min(distance(word[:k], term) for k in range(len(word) + 1)) if stem else distance(word, term)
            if e <= most:
                near.append((e, t))
        assert automaton.match(word) == (min(near) if near else None), word


def corpus():
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(900):
        words = [f"w{rng.randrange(300)}xyz" for _ in range(rng.randrange(5, 60))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(["blockhead", "rottenegg", "blokchead", "rotteneggs"]))
        elif i % 7 == 0:
            words.insert(0, "blocks")
        rows.append((i, " ".join(words), "x"))
        if i % 3:
            labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def model(spark):
    rows, labels = corpus()
    return fit_toxicity(spark.createDataFrame(rows, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_held_out_accuracy(spark, model):
    rows, _ = corpus()
    got = toxicity_scores(spark.createDataFrame(rows, "doc_id long, text string, score string"), model).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    right = sum(r.predicted == (r.doc_id % 5 == 0) for r in got if r.held_out) / sum(r.held_out for r in got)
    assert right > 0.98


def test_context(model):
    matcher = Matcher(model.automaton)
    weight = lambda text: hits(text, matcher)[0][2]
    assert weight("you are a blockhead") > weight("a blockhead") > weight("not a blockhead")
    assert weight('he read "a blockhead" aloud') < weight("a blockhead")
    assert weight("the word blockhead") < weight("a blockhead")
    far = " filler" * 200
    for left, right in ('""', "“”", "„“", "«»"):
        assert weight(f"they went {left}{far} a blockhead{far}{right} here") == weight(f"they went {left}a blockhead{right} here") < weight(f"they went {left}{far}{right} a blockhead{far}")
    assert weight(f'an open mark " and{far}\n\n a blockhead " closed later') == weight("a blockhead"), "a quotation ends with its paragraph"
    assert weight(f"> cited{far} blockhead\nanswer") < weight(f"answer{far} blockhead")


def test_scores_against_plain_version(spark, model):
    """Every word of a text against every term by edit distance; windows and quotations by looking at each place again."""
    rng = random.Random(8)
    parts = ["blockhead", "blokhead", "rottenegg", "rotteneggish", "you", "not", "said", '"', "“", "”", "\n\n", "\n> ", "w1xyz", "filler", "blocks", "."]
    rows = [(i, " ".join(rng.choice(parts) for _ in range(rng.randrange(0, 40)))) for i in range(300)]
    got = {r.doc_id: r.score for r in toxicity_scores(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    terms = model.automaton.terms
    for i, text in rows:
        words = [(m.group().lower(), m.start()) for m in re.finditer(r"[^\W_]+", text)]
        found = []
        for k, (w, at) in enumerate(words):
            near = [(e, t) for t, (term, stem, most) in enumerate(terms) if (e := min(distance(w[:j], term) for j in range(len(w) + 1)) if stem else distance(w, term)) <= most]
            if not near:
                continue
            paragraph_start = max((m.end() for m in re.finditer(r"\n[^\S\n]*\n", text) if m.end() <= at), default=0)
            paragraph_end = min((m.start() for m in re.finditer(r"\n[^\S\n]*\n", text) if m.start() >= at), default=len(text))
            inside, opened = False, None
            for j in range(paragraph_start, at):
                c = text[j]
                opened = (c if c in '"“' else None) if opened is None else None if c == {'"': '"', "“": "”"}[opened] else opened
            if opened:
                inside = {'"': '"', "“": "”"}[opened] in text[at:paragraph_end]
            line = text[text.rfind("\n", 0, at) + 1 :].partition("\n")[0]
            before, after = [x for x, _ in words[max(0, k - 5) : k]], [x for x, _ in words[k + 1 : k + 6]]
            weight = (0.35 if inside else 1) * (0.35 if line.lstrip(" ").startswith(">") else 1) * (0.6 if "said" in before else 1) * (0.7 if "not" in before[-2:] else 1) * (1.3 if "you" in before + after else 1)
            e, t = min(near)
            found.append(model.weights[t][e] * weight)
        found = sorted((f for f in found if f > 0), reverse=True)
        x = [1.0, found[0], math.log1p(sum(found[1:]))] if found else [0.0] * 3
        z = model.coefficients[0] + sum(a * b for a, b in zip(model.coefficients[1:], x, strict=True))
        assert abs(got[i] - 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))) < 1e-9, text


def test_edges(spark, model):
    rows = [(None, None), (1, ""), (2, "blockhead " * 40_000), (3, "İ blockhead"), (3, "İ blockhead")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.predicted) for r in toxicity_scores(frame, model).collect()}
    assert got == {(None, 0), (1, 0), (2, 1), (3, 1)}
    assert sorted(r.doc_id or 0 for r in drop_toxic(frame, model).collect()) == [0, 1]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert toxicity_scores(empty, model).count() == 0
    bare = fit_toxicity(empty, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.predicted for r in toxicity_scores(frame, bare).collect()} == {0}


def test_rare_terms_are_not_crowded_out(spark):
    neutral = " ".join(hashlib.md5(str(k).encode()).hexdigest()[:10] for k in range(5000))  # some 39,000 pieces
    rows = [(f"{neutral} {'zworg' if k < 6 else ''}", 1) for k in range(20)] + [(neutral, 0)] * 60
    sample = spark.createDataFrame(rows, "text string, toxic int")
    assert [t[0] for t in mine_lexicon(sample)] == ["zworg"]
