import itertools
import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from sentrylake.llm.simhash import fingerprint, fingerprints, link_fingerprints, near_duplicates, sorted_segments


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(prints):
    """Smallest id of each component, by comparing all pairs."""
    root = {i: i for i, _ in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (i, a), (j, b) in itertools.combinations(prints, 2):
        if bin((a ^ b) & (2**64 - 1)).count("1") <= 3:
            low, high = sorted((find(i), find(j)))
            root[high] = low
    return {i: find(i) for i, _ in prints}


def test_fingerprint_follows_the_rule():
    rng = random.Random(4)
    texts = [None, "", " \t", "One", "one two", "ÀÉ b c", "a b c d\x0be\xa0f"]
    texts += [" ".join(rng.choices("abcdefg", k=n)) for n in (3, 4, 300, 70_000)]
    for text in texts:
        raw = None if text is None else text.encode()
        assert fingerprint(raw, 3, 42) == plain_fingerprint(text)


def test_manhattan_bound_is_below_the_distance():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 2**63, 5000).astype(np.uint64), rng.integers(0, 2**63, 5000).astype(np.uint64)
    near = a ^ (np.uint64(1) << rng.integers(0, 64, 5000).astype(np.uint64))
    for x, y in ((a, b), (a, near)):
        assert (np.bitwise_count(sorted_segments(x) ^ sorted_segments(y)) <= np.bitwise_count(x ^ y)).all()


def test_links_match_all_pairs(spark):
    rng = random.Random(7)
    prints = []
    for _ in range(60):
        base = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 5])):
            for _ in range(rng.randrange(5)):
                base ^= 1 << rng.randrange(64)
            prints.append(base - (base >> 63 << 64))
    rows = [(i, p) for i, p in enumerate(prints)]
    frame = spark.createDataFrame(rows, "id long, fp long").repartition(3)
    got = {r.fp: r.root for r in link_fingerprints(frame, rows=10).collect()}
    by_print = sorted(set(prints))
    want = plain_classes([(p, p) for p in by_print])
    alone = {p for p in by_print if list(want.values()).count(want[p]) == 1}
    assert {p: got.get(p, p) for p in by_print} == want
    assert not alone & set(got)


def test_near_duplicates_with_edge_rows(spark):
    rng = random.Random(9)
    base = [" ".join(rng.choices(["ab", "cd", "ef", "gh", "ij", "kl"], k=200)) for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(base)] + [(100 + i, t.upper()) for i, t in enumerate(base[:5])]
    rows += [(200 + i, t + " tail") for i, t in enumerate(base)] + [(300, None), (301, ""), (302, " "), (303, "x"), (303, "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"id": F.lit("clash"), "fp": F.lit("clash"), "component_id": F.lit(1)})
    got = near_duplicates(frame).collect()
    assert len(got) == len(rows)
    want = plain_classes([(i, plain_fingerprint(t)) for i, t in dict(rows).items()])
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: int(r.fingerprint, 16) for r in got} == {i: plain_fingerprint(t) for i, t in rows}
    assert {r.component_id for r in got if r.doc_id in (300, 301, 302)} == {300}


def test_null_ids_and_empty_table(spark):
    frame = spark.createDataFrame([(None, "a b c d"), (5, "a b c d"), (None, "lone row here")], "doc_id long, text string")
    got = {(r.doc_id, r.component_id) for r in near_duplicates(frame).collect()}
    assert got == {(None, 5), (5, 5), (None, None)}
    assert near_duplicates(frame.limit(0)).count() == 0
    assert fingerprints(frame.limit(0)).count() == 0
