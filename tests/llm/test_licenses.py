import pytest

from pyspark.sql import functions as F

from lakecraft.llm import licenses
from lakecraft.llm.licenses import PHRASES, TEMPLATES, license_scan
from tests.llm.test_decontamination import words

MIT = TEMPLATES[0][1].split()
ROWS = [
    (1, None, ""),
    (2, "", ""),
    (3, "Licensed under the GNU General Public License; MIT License. cc-by CC BY", ""),
    (3, "Licensed under the GNU General Public License; MIT License. cc-by CC BY", ""),
    (None, "Apache License", ""),
    (4, "é MIT\nlicense É", ""),
    (5, " ".join(MIT[:10] + ["extra", "words"] + MIT[10:]).upper(), ""),
    (6, " ".join(MIT[:9]), ""),
    (7, "filler " * 40_000 + "apache license", ""),
]


def base(rows):
    out = []
    for doc_id, text, *_ in rows:
        w = words(text)
        found = [(i, label) for phrase, label in PHRASES for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
        out.append((doc_id, len(w), len(found), min(found)[0] if found else None, max(found)[0] if found else None, ",".join(sorted({label for _, label in found}))))
    return sorted(out, key=str)


@pytest.mark.parametrize("rows", [[], ROWS])
def test_base(spark, rows):
    got = license_scan(spark.createDataFrame(rows, "doc_id long, text string, words string")).collect()
    assert sorted((tuple(r)[:6] for r in got), key=str) == base(rows)


def test_voting_bridges_inserted_words(spark):
    got = {r.doc_id: r for r in license_scan(spark.createDataFrame(ROWS, "doc_id long, text string, words string")).collect()}
    assert got[5].labels == "mit" and got[5].base_labels == "" and got[5].score == 1.0
    assert got[6].labels == "" and 0.2 < got[6].score < 0.75
    assert got[3].labels == "cc-by,gpl,mit" and got[3].score == 1.0
    assert got[1].score == 0.0


def test_words_are_compared_where_hashes_are_equal(spark, monkeypatch):
    frame = spark.createDataFrame(ROWS[:-1], "doc_id long, text string, words string")
    result = lambda: sorted(map(tuple, license_scan(frame).collect()), key=str)
    true = result()
    monkeypatch.setattr(licenses, "gram_hash", lambda w: F.pmod(F.xxhash64(*w), F.lit(3)))
    assert result() == true


def test_a_row_repeated_many_times(spark):
    one = spark.createDataFrame([(7, "under the MIT license we grant"), (None, "")], "doc_id long, text string")
    rows = one.crossJoin(spark.range(9000).select()).unionByName(one)
    got = license_scan(rows)
    told = {tuple(r)[:7]: r.n for r in got.groupBy("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert {(k[0], k[2]): n for k, n in told.items()} == {(7, 1): 9001, (None, 0): 9001}
