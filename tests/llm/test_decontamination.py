import random

import pytest

import numpy as np

from lakecraft.llm import decontaminate
from lakecraft.llm.decontaminate import benchmark_overlaps, drop_contaminated
from tests.llm.test_ngram_join import WORD


def words(text):
    return WORD.findall("".join(c.lower() if c < "\x80" else c for c in text or ""))


def brute(docs, items, least=13):
    """The best segment of +1 and -4 on every diagonal of every pair; in short items also four fifths of the words in place."""
    out = set()
    for doc_id, text in docs:
        for item_id, passage in items:
            w, b, best = words(text), words(passage), None
            for d in range(-len(b) + 1, len(w)):
                if 0 < len(b) <= least + 4 and 5 * sum(w[p] == b[p - d] for p in range(max(0, d), min(len(w), d + len(b)))) >= 4 * len(b):
                    out.add((doc_id, item_id))
                run, start = 0, None
                for p in range(max(0, d), min(len(w), d + len(b))):
                    if run <= 0:
                        run, start = 0, p
                    run += 1 if w[p] == b[p - d] else -4
                    m = sum(w[q] == b[q - d] for q in range(start, p + 1))
                    if run > 0 and (best is None or (run, -start) > best[0]):
                        best = ((run, -start), m)
            if best and best[1] >= least:
                out.add((doc_id, item_id))
    return out


def test_substitutions(spark):
    rng = random.Random(11)
    items = [(i, " ".join(f"b{rng.randrange(500)}" for _ in range(rng.randrange(14, 50)))) for i in range(6)]
    docs = []
    for i in range(40):
        filler = [f"f{rng.randrange(500)}" for _ in range(40)]
        if i % 2:
            passage = items[i % 6][1].split()
            for k in range(3, len(passage), 12):
                passage[k] = "other"
            filler[20:20] = passage
        docs.append((i, " ".join(filler)))
    got = benchmark_overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == brute(docs, items)


@pytest.mark.parametrize("bits", [1 << 6, 1 << 28])
def test_edges(spark, bits, monkeypatch):
    monkeypatch.setattr(decontaminate, "MOST_BITS", bits)  # a filter that is full lets all seeds pass
    items = [(1, "a short item"), (2, None), (None, "Alpha, beta; gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"), (4, "!!!"), (1, "a short item")]
    docs = [(1, "here is A SHORT item indeed", 0), (2, None, 0), (None, "a short item", 0), (3, "", 0), (4, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu", 0), (5, "word " * 50_000 + "a short item", 0), (6, "short item", 0), (1, "here is A SHORT item indeed", 0)]
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string, matched int"), spark.createDataFrame(items, "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id, r.start_word, r.matched) for r in benchmark_overlaps(frame, bench, least_item=3).collect()), key=str)
    assert got == sorted([(1, 1, 2, 3), (None, 1, 0, 3), (4, None, 0, 13), (5, 1, 50_000, 3)], key=str)
    assert sorted((r.doc_id for r in drop_contaminated(frame, bench, least_item=3).collect())) == [2, 3, 6]
    none = spark.createDataFrame([], "item_id long, text string")
    assert benchmark_overlaps(frame, none).count() == 0 and drop_contaminated(frame, none).count() == len(docs)
    assert benchmark_overlaps(frame.limit(0), bench).count() == 0


def test_one_substitution_anywhere_in_a_short_item(spark):
    items = [(n, " ".join(f"i{n}w{k}" for k in range(n))) for n in range(10, 18)]
    docs = [(100 * n + k, "before " * 20 + " ".join("other" if j == k else w for j, w in enumerate(text.split())) + " after" * 20) for n, text in items for k in range(n)]
    # Fewer than four fifths: three of ten words.
    docs.append((1, " ".join("other" if j in (1, 4, 7) else w for j, w in enumerate(items[0][1].split()))))
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.matched) for r in benchmark_overlaps(frame, bench).collect()}
    assert {(d, i) for d, i, _ in got} == {(d, d // 100) for d, _ in docs if d > 1}
    assert all(m >= min(13, i - 1) for _, i, m in got)
    assert [r.doc_id for r in drop_contaminated(frame, bench).collect()] == [1]


def test_repeated_words(spark):
    frame = spark.createDataFrame([(1, "word " * 20_000), (2, "ab cd " * 5_000), (3, "word ab")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "word " * 800), (2, "cd ab " * 300 + "end")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.start_word, r.matched) for r in benchmark_overlaps(frame, bench).collect()}
    assert got == {(1, 1): (0, 800), (2, 2): (1, 600)}


def best_place(w, b, least):
    """(start, words, matches) by all segments of all diagonals: the highest sum of a diagonal, then most matches, then the first."""
    found = []
    for d in range(-len(b) + 1, len(w)):
        lo, hi = max(0, d), min(len(w), d + len(b))
        equal = [w[p] == b[p - d] for p in range(lo, hi)]
        score, end, start = max((sum(1 if x else -4 for x in equal[s:e]), -e, s) for e in range(1, len(equal) + 1) for s in range(e))
        matched = sum(equal[start:-end])
        if matched >= least:
            found.append((-matched, lo + start, -end - start))
    return min(found, default=None)


def test_places_and_lengths(spark):
    rng = random.Random(23)
    items = [(i, " ".join(f"b{rng.randrange(40)}" for _ in range(rng.randrange(18, 30)))) for i in range(4)]
    docs = []
    for i in range(16):
        text = [f"f{rng.randrange(40)}" for _ in range(rng.randrange(1, 30))]
        for _ in range(rng.randrange(1, 3)):
            passage = rng.choice(items)[1].split()
            for k in rng.sample(range(len(passage)), rng.randrange(0, 4)):
                passage[k] = "other"
            text += passage[rng.randrange(0, 3) :] + ["x"] * rng.randrange(0, 3)
        docs.append((i, " ".join(text)))
    got = benchmark_overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    want = {(d, i): best_place(words(t), words(p), 13) for d, t in docs for i, p in items}
    assert {(r.doc_id, r.item_id): (-r.matched, r.start_word, r.n_words) for r in got.collect()} == {k: v for k, v in want.items() if v}


def test_one_scan_whatever_the_benchmark(spark):
    rng = random.Random(5)
    items = [(i, " ".join(f"b{rng.randrange(9000)}" for _ in range(30))) for i in range(3000)]
    docs = [(i, "f " * 30 + items[i * 60][1] + " g" * 30) for i in range(50)]
    out = drop_contaminated(spark.createDataFrame([*docs, (77, "clean")], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert "MapInArrow" not in out._jdf.queryExecution().executedPlan().toString() and [r.doc_id for r in out.collect()] == [77]


def test_seeds_survive_substitutions():
    """Every admissible overlap of random substitution patterns must keep a seed on its diagonal."""
    rng, missed, tried = np.random.default_rng(3), 0, 0
    for _ in range(20_000):
        n = int(rng.integers(18, 60))
        equal = np.ones(n, bool)
        equal[rng.choice(n, int(rng.integers(0, 1 + n // 6)), replace=False)] = False
        item = np.arange(1, n + 1, dtype=np.uint64)
        text = np.where(equal, item, np.uint64(999))
        if decontaminate.best_overlap(text, item, np.array([0]), 13):
            tried += 1
            missed += not any((decontaminate.seeds(text, m) == decontaminate.seeds(item, m)).any() for m in decontaminate.MASKS)
    assert tried > 10_000 and missed == 0


def test_items_too_short_to_contaminate(spark):
    docs = [(i, f"yes it is document {i} with the answer forty two and more words of its own") for i in range(20)]
    items = [(1, "yes"), (2, "forty two"), (3, "It is!"), (4, ""), (5, None), (6, "alpha beta gamma delta epsilon zeta eta"), (7, "one two three four five six seven eight")]
    frame, bench = spark.createDataFrame(docs + [(99, items[-1][1]), (98, items[-2][1])], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert sorted(r.doc_id for r in drop_contaminated(frame, bench).collect()) == [*range(20), 98]
    assert {(r.doc_id, r.item_id) for r in benchmark_overlaps(frame, bench).collect()} == {(99, 7)}
    assert sorted((r.item_id, r.n_words) for r in decontaminate.short_items(bench).collect()) == [(1, 1), (2, 2), (3, 2), (4, 0), (5, 0), (6, 7)]
    assert benchmark_overlaps(frame, bench, least_item=1).where("item_id = 1").count() == 20
