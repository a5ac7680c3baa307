import re
from collections import Counter, defaultdict

import pytest

from lakecraft.llm.divergence import source_divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, total long"


def brute(rows, least, top):
    """Every pair of groups term by term, in Python's integers."""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        whole = Counter()
        for g in groups:
            if g[0] == lang:
                whole.update(counts[g])

        def shares(c, kept=kept):
            total = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p, q = {g: shares(counts[g]) for g in groups if g[0] == lang}, shares(whole)
        apart = lambda a, b, t: (a[t] - b[t]) ** 2 // (a[t] + b[t])
        for g in p:
            pairs = [(other[1], sum(apart(p[g], p[other], t) for t in kept)) for other in p if other != g]
            terms = [(t, apart(p[g], q, t)) for t in kept if counts[g][t] and p[g][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, g[1], part, item, value, k + 1) for k, (item, value) in enumerate(found[:most])]
    return sorted(out)


def some(n, words=40, sources=7):
    """Rows by a rule: words of different shares by source, capitals, digits and characters beyond ASCII."""
    names = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(words)] + ["É", "Straße", "日本", "x1y"]
    return [(i, " ".join(names[(i * i * k + k * (i % sources)) % len(names)].title() for k in range(1, 30)), "en" if i % 3 else "fr", f"s{i % sources}", "clash", 1) for i in range(n)]


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(1, None, None, None, None, None)],
        [(1, "", "en", "a", "", 0), (2, None, "en", "b", "", 0), (3, "one two", "en", None, "", 0)],  # no term is kept
        [(1, "a b c", "en", "x", "", 0)] * 12 + [(2, "a a", "en", "y", "", 0), (3, "", "en", "z", "", 0), (4, None, None, "x", "", 0)],
        some(200),
        [*some(60), (900, "wide " * 60_000 + "Wide", "en", "s1", "", 0)] + [(901 + i, "wide", "en", "s2", "", 0) for i in range(12)],
        [(i, "same words in each row", "en", f"s{i % 5}", "", 0) for i in range(40)],  # ties in every rank
    ],
)
@pytest.mark.parametrize("sizes", [{}, {"chunk": 5, "group_block": 2, "stripe": 2}])
def test_against_brute_force(spark, rows, sizes):
    got = source_divergence(spark.createDataFrame(rows, SCHEMA), least_docs=10, top=10, **sizes)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 10, 10)


def test_shares_are_exact_for_large_counts(spark):
    from pyspark.sql import functions as F

    from lakecraft.llm.divergence import share, shares

    n, total, terms = 3 * 10**13 + 7, 9 * 10**13 + 1, 10**6 + 3
    want = 1 + 10**9 * (n + 2) // (total + 2 * terms)
    import numpy as np

    assert int(shares(np.array([n]), total, terms)[0]) == want
    assert spark.range(1).select(share(F.lit(n), F.lit(total), F.lit(terms)).alias("p")).first().p == want
