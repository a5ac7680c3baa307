import random
import re
from collections import defaultdict

import numpy as np
import pytest

from lakecraft.llm.ngram_join import FREE, matched_depth, ngram_jaccard_join, shared_counts, shortened

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingle_set(text):
    words = WORD.findall("".join(c.lower() if c < "\x80" else c for c in text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows, threshold=0.8):
    rows = [(i, shingle_set(t)) for i, t, *_ in rows]
    links, parent = defaultdict(int), {k: k for k in range(len(rows))}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            (i, s), (j, t) = rows[a], rows[b]
            if i is not None and j is not None and s and t and len(s & t) >= threshold * len(s | t) - 1e-9:
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(rows):
        low[find(k)] = min(i, low.get(find(k), i)) if i is not None else None
    return sorted(((i, low[find(k)], links[k], i == low[find(k)]) for k, (i, _) in enumerate(rows)), key=str)


def near_copies(seed, groups, size, edits):
    rng, rows = random.Random(seed), []
    for _ in range(groups):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.randrange(30, 120))]
        for _ in range(size):
            words = list(base)
            for _ in range(rng.randrange(edits)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(50)}"
            rows.append((rng.randrange(1_000_000), " ".join(words), "n"))
    return rows


@pytest.mark.parametrize(
    ("rows", "options"),
    [
        ([], {}),
        ([(1, None, ""), (2, "", ""), (3, "...", ""), (4, "a b", ""), (5, "A, b!", ""), (None, "a b", ""), (6, "a b c", "")], {}),
        ([(1, "one two three four five six", "")] * 3 + [(1, "quite another text of more than five words", ""), (7, "One two three four five six.", "")], {}),
        (near_copies(1, 12, 12, 5), {"recall": 0.999999}),
        (near_copies(2, 1, 150, 4), {"recall": 0.999999, "block_rows": 20}),
        ([(i, "é long text " * 20_000 + str(i % 2), "") for i in range(4)], {}),
    ],
)
def test_against_brute_force(spark, rows, options):
    got = ngram_jaccard_join(spark.createDataFrame(rows, "doc_id long, text string, node string"), **options)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_depth_shortens_until_the_recall_is_met():
    assert matched_depth(0.8, 16, 6, 0.999) == 4
    assert matched_depth(0.8, 16, 6, 0.9) == 6
    assert matched_depth(0.2, 4, 6, 0.999) == 1


def test_prefixes_stay_long_among_many():
    recall = lambda depths: 1 - np.prod([1 - 0.8**d for d in depths])
    big, small = FREE * 100, FREE
    few = shortened({t: [small, 9, 2] for t in range(32)}, 32, 5, 0.8, 0.99999)
    assert set(few.values()) == {5}
    mixed = shortened({t: [big + t, big // 2, 3] for t in range(4)} | {t: [2, 1, 1] for t in range(4, 20)}, 32, 5, 0.8, 0.99999)
    assert [mixed[t] for t in range(4)] == [7] * 4 and recall([mixed.get(t, 5) for t in range(32)]) >= 0.99999
    crowd = shortened({t: [big * (t + 1), big * (t + 1), big * (t + 1)] for t in range(32)}, 32, 5, 0.8, 0.99999)
    assert recall(crowd.values()) >= 0.99999 and max(crowd.values()) == 7 and crowd[0] == 5 and crowd[31] == 7, "the smallest are shortened first"
    assert recall([*crowd.values()][:31]) < 0.99999


def test_recall_at_the_threshold_in_a_crowd(spark):
    """Pairs of 0.8 and little more within a group of more than FREE near copies: all links against brute force."""
    rng, rows = random.Random(21), []
    base = [f"w{rng.randrange(4000)}" for _ in range(100)]
    for i in range(260):
        words = list(base)
        for k in rng.sample(range(20), rng.randrange(1, 4)):
            words[k * 5] = f"x{rng.randrange(4)}"
        rows.append((i, " ".join(words), "n"))
    got = ngram_jaccard_join(spark.createDataFrame(rows, "doc_id long, text string, node string"))
    want = brute(rows)
    found, links = sum(r.n_links for r in got.collect()), sum(w[2] for w in want)
    assert links > 1000 and found == links


def test_shared_counts():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 60, 40)).astype(np.uint64) for _ in range(9)]
    got = shared_counts(sets)
    for i in range(9):
        for j in range(i):
            assert got[i, j] == len(set(sets[i]) & set(sets[j]))
