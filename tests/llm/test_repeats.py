import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sentrylake.llm import run_index
from sentrylake.llm.anchors import segments
from sentrylake.llm.queries import op9_suffix_array_dedup
from sentrylake.llm.repeats import kept_bytes, remove_repeats


def plain_removed(texts, length):
    counts = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if counts[t[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(b for b, g in zip(t, gone, strict=False) if not g)
        out.append((len(t), int(gone.sum()), int((gone[1:] < gone[:-1]).sum()), kept))
    return out


def corpus(seed, n=150):
    """Texts with shared passages, copies, near copies, a common line with other text around it, and repeats inside."""
    rng = random.Random(seed)
    prose = lambda k: " ".join(rng.choices(["alpha", "béta", "gam", "d", "epsilon", "zet"], k=k))
    passages, line = [prose(25) for _ in range(6)], "All rights reserved by the owner of this page, see below for details."
    texts = []
    for i in range(n):
        kind = i % 6
        text = prose(rng.randrange(1, 60))
        if kind == 0 and texts:
            text = rng.choice(texts)
        elif kind == 1 and texts:
            old = list(rng.choice(texts))
            for _ in range(2):
                old[rng.randrange(len(old))] = "#"
            text = "".join(old)
        elif kind == 2:
            text += rng.choice(passages) + prose(9)
        elif kind == 3:
            text += line + prose(20)
        elif kind == 4:
            text += text[:60] + "!" + text[:60]
        texts.append(text)
    return texts + ["", "a" * 500, "ab" * 300, "a" * 49]


@pytest.mark.parametrize("seed", [1, 2])
def test_index_finds_all_repeated_windows(seed):
    strings = [t.encode() for t in corpus(seed, 60)]
    want = Counter(s[i:i + 40] for s in strings for i in range(len(s) - 39))
    for s, hit in zip(strings, run_index.repeated(strings, 40), strict=True):
        assert hit.tolist() == [want[s[i:i + 40]] > 1 for i in range(len(s) - 39)]


def test_statistics_and_runs_of_a_repetitive_set():
    strings = [b"banana", b"bandana", b"an"]
    index = run_index.build(strings)
    statistics, text, longest = index.matching_statistics(), [], []
    for k, s in enumerate(strings):
        text += [*(chr(b) for b in s), f"end {k}"]
    for i in range(len(text)):
        same = [next((d for d in range(len(text)) if max(i, j) + d >= len(text) or text[i + d] != text[j + d])) for j in range(len(text)) if j != i]
        longest.append(max(same))
    assert statistics.tolist() == longest
    copies = run_index.build([bytes(random.Random(1).choices(range(97, 123), k=2000))] * 20)
    assert len(copies.runs) < copies.size / 8
    assert run_index.repeated([b"", b"a", b"aa"], 1)[2].tolist() == [True, True]


def test_segments_cover_each_window_once():
    texts = [t.encode() for t in corpus(3, 80)] + [random.Random(5).randbytes(700_000), b"x" * 300_000]
    found = segments(texts, 50, 12)
    seen = Counter()
    for t, s, n in zip(found.text.tolist(), found.start.tolist(), found.windows.tolist(), strict=True):
        if t < 84:
            seen.update((t, s + i) for i in range(n))
    assert seen == Counter((t, i) for t, x in enumerate(texts[:84]) for i in range(len(x) - 49))
    assert int(found.windows.sum()) == sum(max(0, len(x) - 49) for x in texts)
    by_window = {}
    for t, s, n, a in zip(found.text, found.start, found.windows, found.anchor, strict=True):
        for i in range(n if t < 84 else 0):
            assert by_window.setdefault(texts[t][s + i:s + i + 50], a) == a


@pytest.mark.parametrize(("length", "gram", "most", "rows"), [(50, 12, 2000, 4000), (50, 12, 3, 10), (40, 40, 1, 1)])
def test_removal_matches_brute_force(spark, length, gram, most, rows):
    texts = corpus(7)
    data = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[2]), (900, None)]
    frame = spark.createDataFrame(data, "doc_id long, text string").withColumns(
        {"key": F.lit("clash"), "id": F.lit(1), "first": F.lit(2), "spans": F.lit(3)})
    got = remove_repeats(frame.repartition(3), length=length, gram=gram, most=most, rows=rows).collect()
    want = plain_removed([(t or "").encode() for _, t in data], length)
    left = Counter((i, *w) for (i, _), w in zip(data, want, strict=True))
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == left
    assert sum(w[1] > 0 for w in want) > 60 and sum(w[1] == 0 for w in want) > 20


def test_touching_spans_are_one_cut():
    assert kept_bytes(b"abcdefghij", [{"first": 0, "last": 1}, {"first": 4, "last": 4}], 3) == (b"hij", 1)
    assert kept_bytes(b"abcdefghij", [{"first": 6, "last": 7}, {"first": 0, "last": 0}], 3) == (b"def", 2)
    assert kept_bytes(b"abc", [], 3) == (b"abc", 0)


def test_query_matches_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    want = dict(zip(docs, plain_removed(list(docs.values()), 200), strict=True))
    got = op9_suffix_array_dedup(spark, sf_dir).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in got} == {i: w[:3] for i, w in want.items()}
    assert sum(w[1] > 0 for w in want.values()) > 10


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
