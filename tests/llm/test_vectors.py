import math

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sentrylake.llm import forest, vector_dedup
from sentrylake.llm.vectors import rotation

SCHEMA = "vec_id long, embedding array<float>, label int"


def clustered(seed=1, n=400, dimension=32):
    """Vectors, some of them near or exact copies of others or groups of near copies."""
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(n, dimension))
    for i in range(n // 4, n // 2):
        rows[i] = rows[i - n // 4] + rng.normal(size=dimension) * rng.choice([0, 0.05, 0.2, 0.35])
    for i in range(n // 2, n // 2 + 60):
        rows[i] = 3 * rows[0] + rng.normal(size=dimension) * 0.3
    return rows.astype(np.float32)


def odd_rows():
    nan, inf = float("nan"), float("inf")
    return [(9001, None, 1), (9002, [0.0] * 32, 1), (9003, [nan] * 32, 1), (9004, [inf] + [0.0] * 31, 1), (9005, [None] * 32, 1),
            (9006, [], 1), (None, [1.0] * 32, 1), (9007, [1.0] * 32, None), (9008, [1.0] * 5, 1), (9009, [2.0] * 5, 1)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns({"node": F.lit("clash"), "id": F.lit(0), "score": F.lit(1), "key": F.lit(2)})


def plain_links(rows, threshold):
    ok = [(i, np.array(v, float), c) for i, v, c in rows if i is not None and c is not None and v and None not in v
          and np.isfinite(v).all() and np.any(v)]
    root, links = {i: i for i, _, _ in ok}, {i: 0 for i, _, _ in ok}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for at, (i, v, c) in enumerate(ok):
        for j, w, d in ok[:at]:
            if c == d and len(v) == len(w) and v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= threshold:
                links[i] += 1
                links[j] += 1
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return {i: (links[i], find(i)) for i in root}


@pytest.mark.parametrize(("room", "chunk", "rows"), [(1024, 2048, 20_000), (16, 40, 50), (8, 7, 1)])
def test_near_vectors_match_all_pairs(spark, room, chunk, rows):
    data = [(i, v.tolist(), int(i % 3 == 0)) for i, v in enumerate(clustered())]
    data += [(500 + i, data[i][1], data[i][2]) for i in range(10)] + odd_rows()
    got = vector_dedup.near_vectors(frame(spark, data).repartition(3), room=room, chunk=chunk, rows=rows).collect()
    assert len(got) == len(data)
    want = plain_links(data, 0.93)
    for r in got:
        links, component = want.get(r.vec_id, (0, r.vec_id))
        assert (r.n_links, r.component_id, r.kept) == (links, component, r.vec_id == component)
    assert sum(n > 0 for n, _ in want.values()) > 80


def test_sql_states_the_same_rows():
    data = [(i, v.tolist(), int(i % 3 == 0)) for i, v in enumerate(clustered())] + odd_rows()
    ids, vectors, labels = zip(*data, strict=True)
    with duckdb.connect() as db:
        db.register("embeddings", pa.table({"vec_id": ids, "embedding": pa.array(vectors, pa.list_(pa.float32())), "label": labels}))
        got = db.sql(vector_dedup.oracle_sql()).fetchall()
    want = plain_links(data, 0.93)
    assert len(got) == len(data)
    for i, links, component, kept in got:
        assert (links, component) == want.get(i, (0, i)) and kept == (i == component)


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    true, errors, over = x @ x.T, [], 0
    for turn in range(20):
        turned = x @ rotation(64, 3, turn)
        code = np.where(turned > 0, 1, -1) / 8
        factor = (code * turned).sum(axis=1)
        estimate = code @ turned.T / factor[:, None]
        errors.append(estimate - true)
        slack = 6 * np.sqrt(1 - factor**2) / factor / math.sqrt(63)
        over += (np.abs(estimate - true) > slack[:, None] * np.sqrt(np.maximum(1 - true**2, 0)) + 1e-9).sum()
    assert over == 0
    assert abs(np.mean(errors)) < 2e-3
    assert np.allclose(rotation(64, 3, 1) @ rotation(64, 3, 1).T, np.eye(64))


def test_keys_meet_often_enough():
    codes = vector_dedup.plan_codes(100_000, 0.93, 1024, 1e-6)
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=(2, 4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    met = (codes.keys(a) == codes.keys(0.93 * a + math.sqrt(1 - 0.93**2) * b)).any(axis=1)
    assert met.all()


def test_near_vectors_without_rows(spark):
    assert vector_dedup.near_vectors(frame(spark, [])).count() == 0
    assert vector_dedup.near_vectors(frame(spark, odd_rows()[:6])).where("kept and n_links = 0").count() == 6


def plain_nearest(rows, k):
    ok = [(i, np.array(v, float)) for i, v, _ in rows if i is not None and v and len(v) == 32 and None not in v
          and np.isfinite(v).all() and np.any(v)]
    out = {}
    for i, v in ok:
        if i % 10 == 0:
            best = sorted((math.sqrt(((v - w) ** 2).sum()), j) for j, w in ok if j != i)[:k]
            out[i] = [(j, pytest.approx(d)) for d, j in best]
    return out


@pytest.mark.parametrize(("leaf", "chunk", "rows"), [(40, 4096, 20_000), (20, 8, 1)])
def test_nearest_finds_most_and_scores_exactly(spark, leaf, chunk, rows):
    data = [(i, v.tolist(), 0) for i, v in enumerate(clustered(n=1200))] + [(2000 + i, [1.0] * 32, 0) for i in range(50)] + odd_rows()
    got = forest.nearest(frame(spark, data), F.col("vec_id") % 10 == 0, leaf=leaf, chunk=chunk, rows=rows).collect()
    want = plain_nearest(data, 10)
    by_query = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by_query.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(by_query) == set(want)
    hits = sum(len({j for j, _ in by_query[q]} & {j for j, _ in want[q]}) for q in want)
    assert hits >= 0.93 * 10 * len(want)
    vectors = {i: np.array(v, float) for i, v, _ in data if i in range(1200) or i in range(2000, 2050)}
    for q, found in by_query.items():
        assert len(found) == 10 and found == sorted(found, key=lambda f: (f[1], f[0])) and q not in {j for j, _ in found}
        assert all(s == pytest.approx(np.linalg.norm(vectors[q] - vectors[j]), abs=1e-12) for j, s in found)
    assert [j for j, _ in by_query[2000]] == list(range(2001, 2011))


def test_whole_search_is_exact(spark):
    data = [(i, v.tolist(), 0) for i, v in enumerate(clustered(seed=3))] + [(7, clustered(seed=3)[7].tolist(), 0)]
    got = forest.nearest(frame(spark, data), F.col("vec_id") % 10 == 0, recall=1.0, leaf=30, tests=1000).collect()
    want = plain_nearest(data[:-1], 10)
    assert {(r.query_id, r.rank): r.vec_id for r in got} == {(q, n + 1): j for q, best in want.items() for n, (j, _) in enumerate(best)}


def test_few_rows_and_none(spark):
    ask = F.col("vec_id") % 10 == 0
    assert forest.nearest(frame(spark, []), ask).count() == 0
    assert forest.nearest(frame(spark, [(10, [1.0, 2.0], 0)]), ask).count() == 0
    assert [(r.vec_id, r.score) for r in forest.nearest(frame(spark, [(10, [1.0, 2.0], 0), (3, [1.0, 0.0], 0)]), ask).collect()] == [(3, 2.0)]
