import math
import random
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, vector string, n string, anchor string, score string"


def rows(n=300, d=8, seed=3, scale=0.3):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(4, d))
    data = [(i, [float(np.float32(x)) for x in scale * rng.normal(size=d) + base[i % 4] * 0.3], int(rng.integers(0, 5))) for i in range(n)]
    same = data[7][1]
    data += [(n + i, same, i % 2) for i in range(150)]  # one vector, very often
    data += [(1000, None, 0), (1001, [], 0), (1050, [], 0), (1003, [], 1), (1100, same, None), (1150, [1.0] * (d - 1) + [None], 0)]
    data += [(1200, [float("nan")] * d, 0), (1250, [float("inf")] * d, 0), (1300, [1.0, 2.0], 0), (1301, [2.0, 1.0], 0), (1302, [1.5, 1.0], 1)]
    data += [data[100], data[100], (100, data[3][1], 2), (None, same, 0)]  # rows and ids that repeat, a null id
    data += [(1400 + i, [0.0] * d, i % 3) for i in range(6)]
    return data


def plain(data, every=50):
    ok = [(i, [math.floor(256 * x) for x in v], y) for i, v, y in data
          if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    for a, (anchor, v, label) in enumerate(ok):
        if anchor % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, z) for b, (i, w, z) in enumerate(ok) if b != a and len(w) == len(v))
        for s, positive, _ in [r for r in scored if r[2] == label][:5]:
            found = [r for r in scored if r[2] != label and 50 * -s <= 100 * -r[0] <= 95 * -s][:3]
            out.update((anchor, positive, k + 1, i, -s, -t) for k, (t, i, _) in enumerate(found))
    return out


def frame(spark, data):
    return spark.createDataFrame([(*r, "x", "y", "z", "w") for r in data], SCHEMA).repartition(4)


@pytest.mark.parametrize("blocks", [{}, {"block_rows": 40, "block_anchors": 3}])
def test_mining_equals_brute_force(spark, blocks):
    data = rows()
    got = Counter(map(tuple, H.mine(frame(spark, data), **blocks).collect()))
    want = plain(data)
    assert got == want and len(want) > 50


def test_large_components(spark):
    data = [(i, [random.Random(i).choice([1e14, -1e13, 3.0]), 2.0], i % 2) for i in range(0, 60, 2)]
    data = [(i, v, i // 2 % 2) for i, v, _ in data]
    assert Counter(map(tuple, H.mine(frame(spark, data)).collect())) == plain(data_float(data))


def data_float(data):
    return [(i, [float(np.float32(x)) for x in v], y) for i, v, y in data]


def test_products_are_exact_and_stop_at_the_ends_of_a_long():
    rng = np.random.default_rng(1)
    for high in (1 << 10, 1 << 29, 1 << 40, 1 << 62):
        x, q = rng.integers(-high, high, (5, 3)), rng.integers(-high, high, (4, 3))
        want = [[max(H.BOTTOM, min(H.TOP, sum(int(a) * int(b) for a, b in zip(u, v)))) for v in x] for u in q]
        assert H.products(x, q).tolist() == want


def test_keys_sort_as_their_pairs():
    rng = random.Random(4)
    pairs = [(rng.randint(0, 3), rng.choice([H.TOP, H.BOTTOM, -1, 0, 5]), rng.randint(0, 1), rng.randint(-9, 9)) for _ in range(300)]
    keys = [H.packed(np.array([a]), np.array([s]), k, np.array([i])) for a, s, k, i in pairs]
    assert [tuple(int(c[0]) for c in H.unpacked(k)) for k in keys] == pairs
    by_bytes = sorted(range(300), key=lambda i: keys[i].tobytes())
    assert [pairs[i] for i in by_bytes] == sorted(pairs, key=lambda p: (p[0], -p[1], p[2], p[3]))


def test_mining_of_nothing(spark):
    assert H.mine(frame(spark, []).limit(0)).count() == 0
    assert H.mine(frame(spark, [(0, [1.0, 2.0], 0)])).count() == 0
