import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sentrylake.llm import queries, spelling


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def plain_variants(counts, ratio):
    near = {w: [] for w in counts}
    for a, b in itertools.combinations(counts, 2):
        if one_apart(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    rows = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return sorted(rows)


def answer(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_variants_against_all_pairs(spark):
    rng = random.Random(1)
    alphabet = "abcé😀"
    words = {"".join(rng.choices(alphabet, k=rng.randrange(1, 8))) for _ in range(500)} | {"a", "aa", "b", "ab", "ba"}
    counts = {w: rng.choice([1, 2, 5, 6, 30, 151, 800]) for w in words}
    rows = [(w, n - 1) for w, n in counts.items()] + [(w, 1) for w in counts] + [(None, 7)]
    table = spark.createDataFrame(rows, "word string, n long").withColumns({"root": F.lit("clash"), "a": F.lit(1)})
    for parts, ratio in ((4, 5), (3, 2), (6, 5)):
        got = spelling.spelling_variants(table.repartition(3), ratio, parts)
        want = plain_variants(counts, ratio)
        assert answer(got) == want
    assert any(r[1] and r[2] != r[1] for r in want)


def test_long_chains_reach_the_root(spark):
    letters = "abcdefghij"
    words = [letters[:i] + "x" * (10 - i) for i in range(11)]
    table = spark.createDataFrame([(w, 2 ** i) for i, w in enumerate(words)], "word string, n long")
    got = {r.word: r.root for r in spelling.spelling_variants(table, ratio=2).collect()}
    assert set(got.values()) == {words[-1]}


def test_words_one_apart_share_a_signature(spark):
    rng = random.Random(5)
    pairs = []
    for _ in range(300):
        word = "".join(rng.choices("abcdefghijklmnopqrstuvwxyzéü", k=rng.randrange(1, 12)))
        at, letter = rng.randrange(len(word)), rng.choice("abcxyzéñ")
        for other in (word[:at] + word[at + 1:], word[:at] + letter + word[at + 1:], word[:at] + letter + word[at:]):
            if other and one_apart(word, other):
                pairs.append((word, other))
    table = spark.createDataFrame(sorted({(w, 1) for p in pairs for w in p}), "word string, n long")
    found = {(r.a, r.b) for r in spelling.near_words(table).collect()}
    assert {tuple(sorted(p)) for p in pairs} <= found


def plain_counts(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 199 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            if len(word) >= 6:
                counts[word] += 1
    return counts


def test_query_against_plain_answers(spark, tmp_path):
    rng = random.Random(2)
    stems = ["thinking", "strange", "Éclairs", "garçon\u00d7s", "WONDER", "wanders", "letter", "letters", "short", "tiny"]
    rows = [(None, "Letters letters LETTERS letters letters"), (1, None), (2, ""), (3, "1 2 3, --"), (4, "Letters_lettérs"),
            (4, "Letters_lettérs"), (5, "longword" * 3000)]
    rows += [(i, " ".join(rng.choices(stems, k=rng.randrange(120)))) for i in range(10, 600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"word": F.lit("clash"), "n": F.lit(0)})
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_spelling_variants(spark, str(tmp_path))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = plain_variants({w: n for w, n in plain_counts(rows).items() if n >= 5}, 5)
    assert answer(got) == want
    assert sum(1 for r in want if r[1]) > 5


def test_empty_tables_and_bad_settings(spark):
    docs = spark.createDataFrame([], "doc_id string, text string")
    assert spelling.spelling_variants(spelling.word_counts(docs)).count() == 0
    with pytest.raises(ValueError):
        spelling.spelling_variants(spelling.word_counts(docs), ratio=1)
    with pytest.raises(ValueError):
        spelling.near_words(spelling.word_counts(docs), parts=2)


def test_no_table_of_words_is_broadcast(spark, monkeypatch):
    plans, written = [], spelling.cut

    def noting(df, label, **options):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df, label, **options)

    monkeypatch.setattr(spelling, "cut", noting)
    words = spark.createDataFrame([("letter" + "s" * i, 6 ** i) for i in range(6)], "word string, n long")
    found = spelling.spelling_variants(words)
    assert len(set(r.root for r in found.collect())) == 1
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert sum("SortMergeJoin" in plan for plan in plans) >= 3
    assert not any("Broadcast" in plan for plan in plans)
