import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from llm_cases import documents, empty, texts

from tidemark.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_mix(rows, weights=(5, 2, 1), budget=Fraction(3, 2), most=2, seed=1):
    """(doc_id, source, size, source size, target, taken), by repeated sharing and full sorts."""
    sizes = [len(WORD.findall(t or "")) for _, t, _ in rows]
    names = sorted({s for *_, s in rows}, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    total, own = sum(sizes), {n: sum(z for z, (*_, s) in zip(sizes, rows) if s == n) for n in names}
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    target, left, takers = dict.fromkeys(names, Fraction(0)), total * budget, list(names)
    while left and takers:
        share = {n: target[n] + left * weight[n] / sum(weight[m] for m in takers) for n in takers}
        left = sum(max(Fraction(0), v - most * own[n]) for n, v in share.items())
        target.update({n: min(v, Fraction(most * own[n])) for n, v in share.items()})
        takers = [n for n in takers if target[n] < most * own[n]]
    taken = {}
    for n in names:
        groups = defaultdict(list)
        for i, (d, t, s) in enumerate(rows):
            if s == n:
                key = f"{seed}:{'' if d is None else d}:{t or ''}"
                groups[int(hashlib.md5(key.encode()).hexdigest()[:15], 16)].append(i)
        times = int(target[n] // own[n]) if own[n] else 0
        owed, before = target[n] - times * own[n], 0
        for h in sorted(groups):
            here = sum(sizes[i] for i in groups[h])
            more = owed > 0 and 2 * before + here <= 2 * owed
            before += here
            for i in groups[h]:
                taken[i] = sizes[i] * (times + more)
    return [(d, s, z, own[s], float(target[s]), taken[i]) for i, ((d, t, s), z) in enumerate(zip(rows, sizes))]


def frame(spark, rows):
    df = documents(spark, [t for _, t, _ in rows], list(range(len(rows))), clash=False).drop("source")
    names = spark.createDataFrame([(i, d, s) for i, (d, _, s) in enumerate(rows)], "doc_id long, own long, source string")
    df = df.join(names, "doc_id").drop("doc_id").withColumnRenamed("own", "doc_id")
    return df.selectExpr("*", "'x' as h", "'x' as src", "'x' as target", "'x' as taken", "'x' as size", "'x' as salt")


def cases():
    base = texts()
    names = ["é", "b", None, "B", "", "src10", "src2"]
    mixed = [(i if i % 11 else None, t, names[i % 7]) for i, t in enumerate(base * 3)]
    mixed += [(5, base[0], "b")] * 30  # a row repeated, as often as a hot key
    hot = [(i, base[i % 20], "hot") for i in range(200)] + [(900 + i, "a b c", f"s{i}") for i in range(7)]
    return [mixed, hot, [(1, None, "x"), (2, " \t", None)], [(None, "one two", None)]]


@pytest.mark.parametrize("n", range(4))
def test_mix_equals_brute_force(spark, n):
    rows = cases()[n]
    got = Counter((r.doc_id, r.source, r.size, r.source_size, round(r.target, 6), r.taken) for r in mixing.mix(frame(spark, rows)).collect())
    assert got == Counter((*v[:4], round(v[4], 6), v[5]) for v in plain_mix(rows))


def test_small_steps_refine_to_the_same(spark, monkeypatch):
    rows = cases()[0]
    df = frame(spark, rows)
    once = sorted(map(str, mixing.mix(df).collect()))
    monkeypatch.setattr(mixing, "STEP", 3)  # many levels, few buckets
    assert sorted(map(str, mixing.mix(df).collect())) == once


def test_mixes_are_nested_and_near_their_targets(spark):
    rows = [(i, "w " * (i % 17 + 1), f"s{i % 5}") for i in range(3000)]
    df = frame(spark, rows)
    taken = []
    for budget in ((1, 3), (2, 3), (3, 2)):
        out = mixing.mix(df, budget=budget).collect()
        taken.append({r.doc_id: r.taken for r in out})
        sums = Counter()
        for r in out:
            sums[r.source] += r.taken
        for r in out:
            assert abs(sums[r.source] - r.target) <= 9 and r.taken <= 2 * r.size
    assert all(a[d] <= b[d] for a, b in zip(taken, taken[1:]) for d in a)


def test_mix_of_nothing(spark):
    assert mixing.mix(empty(spark)).count() == 0
