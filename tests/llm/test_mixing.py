import random

import pytest
from pyspark.sql import functions as F

from sentrylake.llm import mixing


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    """Shares by weight; what exceeds a source's limit goes to the others, again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), sum(sizes.values())
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > most * sizes[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= over
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 900, "c": 50}, {None: 10, "b": 1000}, {"x": 5}, {"a": 1, "b": 1, "c": 1, "d": 5000, "é": 7, "Z": 0, None: 3},
    {"a": 0, "b": 0}])
def test_targets_match_resharing(spark, sizes):
    rows = spark.createDataFrame([(s or "", s is None, n) for s, n in sizes.items()],
                                 "source string, no_source boolean, source_size long")
    got = {None if r.no_source else r.source: r.target for r in mixing.targets(rows).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def make_docs(spark, seed=1, n=3000):
    rng = random.Random(seed)
    rows = [(i, "word " * rng.randrange(0, 60), rng.choice(["s1"] * 6 + ["s2", "s3", "tiny é", None])) for i in range(n)]
    rows += [(n + i, None, "s1") for i in range(5)] + [(n + 9, "rare words only here", "solo"), (n + 10, " ", "void")]
    rows += [(None, "no id", "s2"), (7, rows[7][1], rows[7][2])]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns(
        {"size": F.lit("clash"), "row": F.lit(1), "key": F.lit(2), "bucket": F.lit(3)})


def test_mix_meets_its_targets(spark):
    docs = make_docs(spark)
    got = mixing.mix(docs, buckets=16)
    assert got.columns == [*docs.columns, "mix"]
    rows = got.collect()
    assert len(rows) == docs.count()
    sizes = {}
    for r in rows:
        assert r.mix.size == len((r.text or "").split()) and r["size"] == "clash"
        sizes[r.source] = sizes.get(r.source, 0) + r.mix.size
    want = plain_targets(sizes)
    for source, size in sizes.items():
        own = [r.mix for r in rows if r.source == source]
        assert {m.source_size for m in own} == {size}
        assert own[0].target == pytest.approx(want[source])
        assert abs(sum(m.taken for m in own) - want[source]) <= 61
        whole = int(want[source] / size + 1e-9) if size else 0
        assert {m.epochs for m in own} <= {whole, whole + 1} and all(m.taken <= 3 * m["size"] for m in own)
    again = mixing.mix(docs.repartition(5), buckets=16).collect()
    key = lambda r: (str(r.doc_id), r.mix.taken)
    assert sorted(map(key, rows)) == sorted(map(key, again))
    finer = mixing.mix(docs, buckets=4096).collect()
    assert sorted(map(key, rows)) == sorted(map(key, finer))


def test_rows_that_repeat_id_and_text_fill_the_budget(spark):
    """Each is taken or left for itself, in whichever parts of the table they lie."""
    rows = [(1, "one two three four five six", "a")] * 1000 + [(i, "x " * 6, "b") for i in range(2, 1002)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("place", F.lit("clash")).repartition(7)
    for weights in ((5, 2), (2, 5), (1, 3)):
        got = mixing.mix(docs, weights=weights).collect()
        assert len(got) == 2000 and {r.place for r in got} == {"clash"}
        for source in "ab":
            own = [r.mix for r in got if r.source == source]
            assert abs(sum(m.taken for m in own) - own[0].target) <= 3
            assert {m["size"] for m in own} == {6}


def test_quality_raises_the_chance(spark):
    rows = [(i, "good " * 10 if i % 2 else "1234 " * 10, "a") for i in range(4000)] + [(9000 + i, "z " * 9000, "b") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weight = F.when(F.col("doc_id") % 2 == 1, 1.0).otherwise(0.1)
    taken = mixing.mix(docs, weights=(1, 9), quality=weight, most=3).where("source = 'a' and mix.taken > 0")
    good, bad = taken.where("doc_id % 2 = 1").count(), taken.where("doc_id % 2 = 0").count()
    assert good > 2 * bad > 0
    assert docs.select(mixing.text_quality(F.col("text")).alias("q")).where("q <= 0 or q > 1").count() == 0


def test_empty_table(spark):
    assert mixing.mix(make_docs(spark).limit(0)).count() == 0
