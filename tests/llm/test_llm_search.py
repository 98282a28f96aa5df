import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import ann_forest, vafile

SCHEMA = "vec_id long, embedding array<float>, label int, vector string, rank int"


def rows(n=400, d=16, seed=3):
    rng = np.random.default_rng(seed)
    data = [(i, [float(np.float32(x)) for x in rng.normal(size=d)], 0, "x", 1) for i in range(n)]
    same = data[7][1]
    data += [(n + i, same, 0, "x", 1) for i in range(150)]  # one vector, very often
    data += [(1000, None, 0, "x", 1), (1100, [], 0, "x", 1), (1200, [0.0] * d, 0, "x", 1), (1300, [1.0] * (d - 1) + [None], 0, "x", 1)]
    data += [(1400, [float("nan")] * d, 0, "x", 1), (1500, [float("inf")] * d, 0, "x", 1), (1600, [1.0, 2.0], 0, "x", 1)]
    data += [data[100], (None, same, 0, "x", 1)]  # a repeated row, a null id
    data += [(100, data[3][1], 0, "x", 1), (3, data[9][1], 0, "x", 1), (3, data[9][1], 0, "x", 1)]  # repeated ids
    return data


def valid(data, zero):
    return [(i, v) for i, v, *_ in data if i is not None and v is not None
            and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v))]


def by_query(found):
    """Lists of (rank, id, score) for each query id; ranks of repeated ids stay beside each other."""
    out = {}
    for r in found.collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {q: sorted(rs) for q, rs in out.items()}


def best_products(data, every, k, factor=256):
    """Every pair, in Python integers that stop at the ends of a long."""
    stop = lambda s: min(max(s, -(1 << 63)), (1 << 63) - 1)
    rows = [(i, [stop(math.floor(factor * x)) for x in v]) for i, v in valid(data, zero=True)]
    want = {}
    for n, (q, v) in enumerate(rows):
        if q % every == 0:
            scores = [(-stop(sum(a * b for a, b in zip(v, w))), i)
                      for m, (i, w) in enumerate(rows) if m != n and len(w) == len(v)]
            want.setdefault(q, []).extend((r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k]))
    return {q: sorted(rs) for q, rs in want.items() if rs}


def test_products_equal_brute_force(spark):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    want = best_products(data, 50, 5)
    assert len(want[100]) == 15  # three rows have this id
    assert by_query(vafile.top_products(df, every=50, k=5)) == want


def test_products_in_many_blocks(spark):
    data = rows(200)
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    assert by_query(vafile.top_products(df, every=10, k=5, block_rows=37, block_queries=7)) == best_products(data, 10, 5)


def test_zero_queries_do_not_reach_all_rows(spark, monkeypatch):
    read = []
    plain = vafile.exact_scores
    monkeypatch.setattr(vafile, "exact_scores", lambda pairs, *a: read.append(pairs.count()) or plain(pairs, *a))
    rng = np.random.default_rng(4)
    data = [(i, [0.0] * 8 if i % 30 == 0 else rng.normal(size=8).tolist(), 0, "x", 1) for i in range(600)]
    df = spark.createDataFrame(data, SCHEMA)
    assert by_query(vafile.top_products(df, every=30, k=5)) == best_products(
        [(i, [float(np.float32(x)) for x in v], *r) for i, v, *r in data], 30, 5
    )
    assert sum(read) == 20 * 5


def test_products_beyond_doubles_and_longs(spark):
    rng = np.random.default_rng(2)
    data = [(i, [float(x) for x in rng.normal(size=6) * 10.0 ** rng.integers(5, 8)], 0, "x", 1) for i in range(120)]
    data += [(200 + i, [float(x) * 1e17 for x in rng.normal(size=6)], 0, "x", 1) for i in range(40)]
    df = spark.createDataFrame([r[:1] + r[1:] for r in data], SCHEMA.replace("float", "double"))
    assert by_query(vafile.top_products(df, every=10, k=5)) == best_products(data, 10, 5)


def test_products_read_few_exact_vectors(spark, monkeypatch):
    read = []
    plain = vafile.exact_scores
    monkeypatch.setattr(vafile, "exact_scores", lambda pairs, *a: read.append(pairs.count()) or plain(pairs, *a))
    rng = np.random.default_rng(5)
    data = [(i, rng.normal(size=64).tolist(), 0, "x", 1) for i in range(4000)]
    assert vafile.top_products(spark.createDataFrame(data, SCHEMA), every=100, k=5).count() == 200
    assert read[0] == 200 and sum(read) < 40 * 4000 // 100


def test_nearest_recall_order_and_ties(spark):
    data = rows()
    found = valid(data, zero=False)
    got = by_query(ann_forest.nearest(spark.createDataFrame(data, SCHEMA).repartition(4), every=50, k=10, share=0.2))
    hit = total = 0
    for n, (q, v) in enumerate(found):
        if q % 50 or q == 100:
            continue
        near = sorted((math.dist(v, w), i) for m, (i, w) in enumerate(found) if m != n and len(w) == len(v))[:10]
        mine = got.get(q, [])
        assert [r for r, _, _ in mine] == list(range(1, len(mine) + 1))
        assert [(s, i) for _, i, s in mine] == sorted((s, i) for _, i, s in mine)
        for _, i, s in mine:
            assert any(s == pytest.approx(math.dist(v, w), rel=1e-12) for j, w in found if j == i and len(w) == len(v))
        hit += len({i for _, i in near} & {i for _, i, _ in mine})
        total += len(near)
    assert hit / total >= 0.9
    # the copies of row 7 are all equally near to each other: the smallest ids stand
    assert [i for _, i, _ in got[400]] == [7, *range(401, 410)]
    assert len(got[100]) == 30 and got[100].count((1, 100, 0.0)) == 2  # two of three rows of this id are copies


def test_nearest_does_not_depend_on_the_deal(spark):
    data = rows(300)
    df = spark.createDataFrame(data, SCHEMA)
    once = by_query(ann_forest.nearest(df.repartition(5), every=50, k=10, block_rows=64, block_queries=3))
    assert once == by_query(ann_forest.nearest(df.orderBy(F.desc("vec_id")).coalesce(2), every=50, k=10))


def test_nearest_recall_at_the_registered_settings(spark):
    """64 components without clusters, the hardest case; three seeds."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(2000, 64)).astype(np.float32).astype(float)
    df = spark.createDataFrame([(i, v.tolist(), 0, "x", 1) for i, v in enumerate(x)], SCHEMA)
    for seed in (7, 8, 9):
        got = by_query(ann_forest.nearest(df, every=20, k=10, seed=seed))
        hit = 0
        for q in range(0, 2000, 20):
            dist = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
            dist[q] = np.inf
            hit += len(set(np.argsort(dist)[:10].tolist()) & {i for _, i, _ in got[q]})
        assert hit / 1000 >= 0.9


@pytest.mark.parametrize("search", [lambda df: vafile.top_products(df, 50, 5), lambda df: ann_forest.nearest(df, 100, 10)])
def test_searches_of_nothing(spark, search):
    assert search(spark.createDataFrame([], SCHEMA)).count() == 0
    alone = spark.createDataFrame([(0, [1.0, 2.0], 0, "x", 1)], SCHEMA)
    assert search(alone).count() == 0
