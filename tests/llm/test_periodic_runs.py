import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from sentrylake.llm import periodic_runs as pr
from sentrylake.llm import queries


def plain_runs(words, least, periods):
    """Every period tried on every place."""
    n, found = len(words), {}
    for q in range(1, n):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, periods * q):
                found.setdefault((i, j - i + q), q)  # the smallest period comes first
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def random_words(rng, n):
    words = [rng.randrange(rng.choice([1, 2, 3, 30])) for _ in range(n)]
    for _ in range(rng.randrange(4)):
        unit = [rng.randrange(6) for _ in range(rng.randrange(1, 9))]
        at = rng.randrange(len(words) + 1)
        words[at:at] = (unit * rng.randrange(2, 9))[:rng.randrange(1, 60)]
    return words


def test_automaton_finds_all_runs():
    rng = random.Random(1)
    for _ in range(400):
        words = random_words(rng, rng.randrange(50))
        for least, periods in ((2, 2), (1, 3), (24, 3), (10, 4)):
            assert pr.runs_of(words, least, periods) == plain_runs(words, least, periods), (words, least, periods)


def test_filter_loses_no_run():
    rng = random.Random(2)
    assert pr.group_size(24, 3) == 9
    for least, periods in ((24, 3), (6, 3), (1, 2), (20, 2)):
        texts = [random_words(rng, rng.randrange(80)) for _ in range(150)]
        got = pr._runs_of_texts([[b"%d" % w for w in t] for t in texts], least, periods)
        assert got == [plain_runs(t, least, periods) for t in texts]


def test_no_stretch_crosses_texts():
    parts = [[b"a", b"b", b"c"] * 4] * 2
    assert pr._runs_of_texts(parts, 12, 2) == [[(0, 12, 3)]] * 2
    assert pr._runs_of_texts(parts, 13, 2) == pr._runs_of_texts(parts, 13, 3) == [[], []]
    assert pr._runs_of_texts([parts[0] * 2], 13, 3) == [[(0, 24, 3)]]


def plain_answer(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words, 24, 3)
    dropped = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2])) if runs else None
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256("".join(f"{s},{size},{q}\n" for s, size, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest())


def test_query_against_plain_answers(spark, tmp_path):
    rng = random.Random(3)
    rows = [(None, "a b " * 30), (0, None), (1, ""), (2, " \t\n"), (3, "x " * 25), (3, "x " * 25), (4, "x " * 23),
            (5, "é ü " * 40 + "end"), (6, "one two three\r\n" * 9)]
    for i in range(7, 400):
        words = [f"w{rng.randrange(40)}" for _ in range(rng.randrange(200))]
        if rng.random() < 0.3:
            words[5:5] = [f"w{rng.randrange(9)}" for _ in range(rng.randrange(1, 12))] * rng.randrange(2, 12)
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"runs": F.lit("clash"), "_a": F.lit(1)})
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_periodic_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = [plain_answer(*r) for r in rows]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert sum(1 for w in want if w[1]) > 60


def test_long_text(spark):
    text = " ".join(f"w{i}" for i in range(200_000)) + " a b c" * 30_000 + " z" * 3
    row = pr.find_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(r) for r in row.runs] == [(200_000, 90_000, 3)]
    assert len(row.collapsed.split()) == 200_006


def test_empty_table_and_bad_settings(spark):
    docs = spark.createDataFrame([], "doc_id string, text string")
    assert pr.find_runs(docs).count() == 0
    with pytest.raises(ValueError):
        pr.find_runs(docs, periods=1)
