import random

import pytest
from pyspark.sql import functions as F

from sentrylake.functions import text as t
from sentrylake.operators import search as s

TEXTS = [
    "ssl tcp connection 10.0.0.1:443 -> 10.0.0.22:80", "SSL TCP connections", "tcp connection", "ssl-tcp/connection.",
    "don't stop, l'été", "under_score a.b.c", "", None,
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, body string").withColumn("other", F.lit("raw Extra"))


def ids(df):
    return sorted(r.id for r in df.collect())


def test_tokens(spark, rows):
    found = {r.id: r.x for r in rows.select("id", t.tokens("body").alias("x")).collect()}
    assert found[0] == ["ssl", "tcp", "connection", "10.0.0.1", "443", "10.0.0.22", "80"]
    assert found[4] == ["don't", "stop", "l'été"]
    assert found[5] == ["under_score", "a.b.c"]
    assert found[7] is None


@pytest.mark.parametrize(("query", "expected"), [
    ("ssl tcp connection", [0, 3]), ("CONNECTION", [0, 2, 3]), ("10.0.0.1", [0]), ("10.0.0.2", []), ("443", [0]),
    ("a.b", []), ("a.b.c", [5]), ("été", []), ("", []),
])
def test_match_all(rows, query, expected):
    assert ids(s.match_all(rows, ["body"], query)) == expected


def test_match_all_is_term_centric(rows):
    assert ids(s.match_all(rows, ["body", "other"], "tcp extra")) == [0, 1, 2, 3]


@pytest.mark.parametrize(("query", "expected"), [
    ("conn", [0, 1, 2, 3]), ("ssl zzz", [0, 1, 3]), ("zzz ss", [0, 1, 3]), ("onnection", []), ("10.0", [0]),
])
def test_prefix_any(rows, query, expected):
    assert ids(s.match_prefix(rows, "body", query)) == expected


def test_prefix_whole_takes_wildcards_literally(spark):
    rows = spark.createDataFrame([(0, "100% sure"), (1, "1000 sure"), (2, "a_b"), (3, "axb")], "id int, body string")
    assert ids(s.match_prefix(rows, "body", "100%", mode="whole")) == [0]
    assert ids(s.match_prefix(rows, "body", "A_", mode="whole")) == [2]


def alignment_distance(a, b):
    """Optimal string alignment: edits and swaps of neighbours, no piece edited twice."""
    d = [[i + j if i * j == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


@pytest.mark.parametrize("term", ["ab", "abc", "abcde", "abcabc", "bacbaca"])
def test_fuzzy_against_brute_force(spark, term):
    rng = random.Random(7)
    words = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(1500)} | {term}
    words |= {term[:i] + term[i + 1:i + 2] + term[i:i + 1] + term[i + 2:] for i in range(len(term) - 1)}
    rows = spark.createDataFrame([(w,) for w in sorted(words)], "body string")
    got = {r.body for r in s.match_fuzzy(rows, "body", term).collect()}
    assert got == {w for w in words if w[0] == term[0] and alignment_distance(w, term) <= t.allowed_edits(term)}


def test_fuzzy_needs_one_term_only(rows):
    assert ids(s.match_fuzzy(rows, "body", "conection nothing")) == [0, 1, 2, 3]


def test_trigram_similarity(spark):
    def grams(x):
        return {p[i:i + 3] for p in (f"  {w} " for w in x.lower().split()) for i in range(len(p) - 2)}

    texts, query = ["red widget", "Red widgit", "widget", "blue bolt", "red", "!!"], "red widgit"
    rows = spark.createDataFrame([(x,) for x in texts], "body string")
    got = {r.body: r.s for r in rows.select("body", t.trigram_similarity("body", query).alias("s")).collect()}
    for x in texts[:-1]:
        assert got[x] == pytest.approx(len(grams(x) & grams(query)) / len(grams(x) | grams(query)))
    assert got["!!"] == 0
    near = {x for x in texts if len(grams(x) & grams(query)) / len(grams(x) | grams(query)) >= 0.3}
    assert {r.body for r in s.match_trigram(rows, "body", query).collect()} == near == {"red widget", "Red widgit", "red"}


def test_query_terms():
    assert t.prefix_term("ssl tcp connection") == "ssl tcp con"
    assert t.prefix_term("ssl tcp") == "ssl"
    assert t.prefix_term("ssl tcp ab") == "ssl"
    assert t.fuzzy_term("ssl tcp connection") == "ssl tcp connectio"
    assert t.fuzzy_term("a b") == "a b"
